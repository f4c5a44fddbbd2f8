import itertools
import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from captionloom.llm import language_model as lm
from tests.llm.helpers import docs


def test_stirling_numbers_count_weighted_seatings():
    d = 0.4

    def seatings(c):
        """Every partition of c customers, seated one after another, with its weight."""
        states = {(1,): 1.0}
        for _ in range(c - 1):
            new = Counter()
            for sizes, weight in states.items():
                for k, n in enumerate(sizes):
                    new[(*sizes[:k], n + 1, *sizes[k + 1 :])] += weight * (n - d)
                new[(*sizes, 1)] += weight
            states = new
        return states

    table = lm.log_stirling(d, 6)
    for c in range(1, 7):
        for t, group in itertools.groupby(sorted(seatings(c).items(), key=lambda x: len(x[0])), key=lambda x: len(x[0])):
            assert math.isclose(math.exp(table[c, t]), sum(w for _, w in group), rel_tol=1e-9)


def test_seat_stays_between_one_and_all():
    rng = np.random.default_rng(1)
    c = rng.integers(0, 500, 4000)
    t = lm.seat(c, np.full(4000, 3.0), 0.7, rng)
    assert (t[c == 0] == 0).all() and (t[c > 0] >= 1).all() and (t <= c).all()
    t = np.arange(1, 201)
    for d, g in ((0.5, 2.0), (0.8, 0.4), (0.8, 30.0), (0.6, 300.0)):
        law = lm.log_stirling(d, 200)[200, 1:] + t * np.log(g)
        law = np.exp(law - law.max())
        want = (law * t).sum() / law.sum()
        got = lm.seat(np.full(20_000, 200), np.full(20_000, g), d, rng).mean()
        assert abs(got - want) < 0.12 * want, (d, g, got, want)
    law = np.exp(lm.log_stirling(0.5, 20)[20, 1:] + np.arange(1, 21) * np.log(2.0))
    got = lm.seat(np.full(50_000, 20), np.full(50_000, 2.0), 0.5, rng).mean()
    assert abs(got - (law * np.arange(1, 21)).sum() / law.sum()) < 0.05


def corpus(n=150):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(300)]
    return [(i, " ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(300)], k=rng.randint(1, 60)))) for i in range(n)]


def test_base_score_and_counts(spark):
    rows = corpus() + [(500, None), (501, ""), (502, "A\tnew  W1\n"), (503, "w1 " * 30_000)]
    learn = lambda i: i % 7 != 2
    tokens = {i: [*(t or "").encode().lower().split(), b"\n"] for i, t in rows}
    seen = Counter(w for i, ws in tokens.items() if learn(i) for w in ws)
    n, v = sum(seen.values()), len(seen)
    out = lm.score(docs(spark, rows).withColumns({"learn": F.lit("x"), "Score": F.lit(0)}), F.col("doc_id") % 7 != 2, block_chars=900, part_tokens=1500)
    got = {r.doc_id: r for r in out.collect()}
    assert got.keys() == tokens.keys()
    for i, ws in tokens.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(seen[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert r.score < 0
    held = [r for i, r in got.items() if not learn(i) and i < 500]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_sums_to_one_in_a_partitioned_model():
    """The predictive distribution, from totals that two partitions of words share."""
    rng = np.random.default_rng(3)
    keys = {}
    for part in (0, 1):
        words = np.arange(50, dtype=np.uint64) + np.uint64(100 * part)
        spans = rng.integers(1, 4, 50).astype(np.uint32)
        contexts = np.concatenate([np.sort(rng.choice([7, 263, 519, 8], s, replace=False)) for s in spans]).astype(np.uint16)
        counts = rng.integers(1, 60, len(contexts)).astype(np.int64)
        keys[part] = {"part": part, "words": lm.pack(words), "spans": lm.pack(spans), "contexts": lm.pack(contexts), "counts": lm.pack(counts)}
    seats = [lm.Seating(keys[p]) for p in (0, 1)]

    def totals(discounts):
        found = {"t2": np.zeros(lm.CONTEXTS), "t1": np.zeros(lm.PARENTS), "c2": np.zeros(lm.CONTEXTS), "t0": 0.0, "v": 0}
        for s in seats:
            for kind, place, value in s.sums():
                if kind in ("t2", "t1", "c2"):
                    found[kind][place] += value
                elif kind in ("t0", "v"):
                    found[kind] += value
        return lm.Totals(int(found["v"]), discounts, found["c2"], found["t2"], found["t1"], found["t0"])

    g = totals((0.5, 0.6, 0.7))
    for k in range(4):
        for s in seats:
            s.sweep(g, k)
        g = totals(g.discounts)
    for u2 in (7, 263, 8, 9):
        u1, total = u2 % lm.PARENTS, 0.0
        for s in seats:
            p0 = g.root(s.c0, s.t0)
            w = np.arange(len(s.words))
            at1, there1 = lm._lookup(s.keys1, (w << 8) | u1)
            at2, there2 = lm._lookup(s.keys2, (w << 16) | u2)
            p1 = g.parent(np.full(len(w), u1), lm._taken(s.c1, at1, there1), lm._taken(s.t1, at1, there1), p0)
            total += g.leaf(np.full(len(w), u2), lm._taken(s.c2, at2, there2), lm._taken(s.t2, at2, there2), p1).sum()
        zero = np.zeros(1)
        unknown = g.leaf(np.array([u2]), zero, zero, g.parent(np.array([u1]), zero, zero, g.root(zero, zero)))[0]
        assert math.isclose(total + unknown, 1.0, rel_tol=1e-9)


def test_edges(spark):
    assert lm.score(docs(spark, []), F.lit(True)).count() == 0
    none = lm.score(docs(spark, [(1, "a b"), (1, "a b"), (None, "c")]), F.lit(None).cast("boolean")).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in none] == [(0, 0, 0.0)] * 3


def test_a_context_is_the_whole_word_before(spark):
    """Two words with the same last bytes are followed by different words."""
    train = [(2 * i, f"{'xaab red' if i % 2 else 'yaab blue'} {'one' if i % 3 else 'two'}") for i in range(200)]
    held = [(1, "xaab red"), (3, "xaab blue"), (5, "yaab blue"), (7, "yaab red")]
    got = {r.doc_id: r.score for r in lm.score(docs(spark, train + held), F.col("doc_id") % 2 == 0, block_chars=500, part_tokens=200).collect()}
    assert got[1] - got[3] > 1 and got[5] - got[7] > 1


def test_scores_of_all_continuations_sum_to_one(spark):
    """Through blocks and partitions: bigrams of all words, an unknown one and the end have a matrix whose greatest eigenvalue is 1."""
    rng = random.Random(4)
    words = [f"{a}{b}" for a in "abcd" for b in "xyz"]
    train = [(2 * i, " ".join(rng.choices(words, weights=range(1, 13), k=rng.randint(0, 9)))) for i in range(150)]
    seen = sorted({w for _, t in train for w in t.split()})
    every = [*seen, "unknown"]
    texts = ["", *every, *(f"{a} {b}" for a in every for b in every)]
    rows = train + [(2 * i + 1, t) for i, t in enumerate(texts)]
    out = lm.score(docs(spark, rows), F.col("doc_id") % 2 == 0, block_chars=700, part_tokens=300).collect()
    score = {texts[r.doc_id // 2]: r.score for r in out if r.doc_id % 2}
    # A text's score has the step to its end; with the steps to the end as the scale, only differences remain.
    n = len(every)
    steps = np.ones((n + 1, n + 1))
    steps[0, 0] = 10 ** score[""]
    for i, a in enumerate(every, 1):
        steps[0, i] = 10 ** score[a]
        for j, b in enumerate(every, 1):
            steps[i, j] = 10 ** (score[f"{a} {b}"] - score[a])
    assert math.isclose(max(abs(np.linalg.eigvals(steps))), 1, rel_tol=1e-6)
