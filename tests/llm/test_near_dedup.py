import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from captionloom.llm import common
from captionloom.llm import near_dedup as nd
from tests.llm.helpers import docs, table


def grams(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets, root = {i: grams(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def brute_by_prefixes(rows):
    """brute() for larger tables: sets that meet the threshold share one of their rarest tokens, so no other pair is looked at."""
    sets, root, often = {i: grams(t) for i, t in rows}, {i: i for i, _ in rows}, Counter()
    for s in sets.values():
        often.update(s)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index = defaultdict(list)
    for i, s in sets.items():
        head = sorted(s, key=lambda g: (often[g], g))[: len(s) - (75 * len(s) + 99) // 100 + 1]
        for j in {j for g in head for j in index[g]}:
            both = len(s & sets[j])
            if 100 * both >= 75 * len(s | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
        for g in head:
            index[g].append(i)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def corpus(seed, n):
    rng = random.Random(seed)
    fresh = lambda k: [f"w{rng.randrange(5000)}" for _ in range(k)]
    passage, rows = fresh(40), []
    for base in range(n):
        own = fresh(rng.randint(3, 120)) + (passage if base % 3 == 0 else [])
        rows.append(own)
        for _ in range(rng.choice([0, 0, 1, 2, 40 if base == 5 else 3])):
            copy = list(own)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(9)}"
            rows.append(copy)
    rng.shuffle(rows)
    return [(i + 1, " ".join(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed, 60) + [(9001, None), (9002, ""), (9003, " \t "), (9004, "One two"), (9005, "one  TWO\n"), (9006, "É é"), (9007, "é é")]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.near_dedup(docs(spark, rows)).collect()}
    assert got == brute(rows)


def star(n, seed):
    """n edits of one base (J to it over the threshold, to each other mostly under it), the base in the middle of the ids."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(304)]
    rows = []
    for _ in range(n):
        edit = list(base)
        # Each word is in five of the 300 shingles: 30 or 35 are new, and J to the base is 0.79 or 0.82.
        for k in rng.sample(range(0, 300, 6), rng.choice([6, 7])):
            edit[k + 2] = f"x{rng.random()}"
        rows.append(" ".join(edit))
    rows.insert(n // 2, " ".join(base))
    return [(i + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("n", [300, 3000])
def test_edits_of_one_base_whose_id_is_not_the_smallest(spark, n):
    rows = star(n, n)
    base = grams(rows[n // 2][1])
    near = [i for i, t in rows if 100 * len(base & grams(t)) >= 75 * len(base | grams(t))]
    assert len(near) == n + 1
    got = {r.doc_id: r.component_id for r in nd.near_dedup(docs(spark, rows)).collect()}
    assert got == {i: 1 for i, _ in rows}


def test_sketches_alone_join_nothing(spark, monkeypatch):
    """Sketches that make all documents look alike cost time and no links: labels are given on full sets only."""
    prints = nd._prints

    def alike(id_type):
        run = prints(id_type)

        def same(batches):
            for batch in run(batches):
                zeros = pa.array([[0] * 64 if n else None for n in batch.column("n").to_pylist()], pa.list_(pa.int32()))
                yield batch.set_column(batch.schema.get_field_index("sketch"), "sketch", zeros)

        return same

    monkeypatch.setattr(nd, "_prints", alike)
    monkeypatch.setattr(nd, "BLOCK", 32, raising=False)
    rows = corpus(3, 40)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.near_dedup(docs(spark, rows)).collect()}
    assert got == brute(rows)


def dense(n, seed):
    """n copies of one text with 1 to 4 of its 100 words changed: some links, many pairs just below the threshold."""
    rng = random.Random(seed)
    base, rows = [f"w{k}" for k in range(100)], []
    for _ in range(n):
        copy = list(base)
        for k in rng.sample(range(100), rng.randint(1, 4)):
            copy[k] = f"x{rng.random()}"
        rows.append(" ".join(copy))
    return [(i + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("block", [1024, 64])
@pytest.mark.parametrize("lines", [256, 0])
def test_a_dense_group_well_above_a_small_node(spark, monkeypatch, block, lines):
    """Every way through a large node: one block, blocks with hubs, finished nodes and branches; sets as bits and by sketches."""
    monkeypatch.setattr(nd, "BLOCK", block)
    monkeypatch.setattr(nd, "MOST_LONE", 2 * block)
    monkeypatch.setattr(nd, "MOST_LINES", lines)
    rows = dense(700, 5) + [(800 + i, t) for i, t in corpus(6, 30)]
    want = brute(rows)
    assert 300 < sum(w[2] for w in want.values()) < 760
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.near_dedup(docs(spark, rows)).collect()}
    wrong = [i for i in want if got[i] != want[i]]
    assert len(wrong) <= (0 if block == 1024 else 7), len(wrong)


def test_recall_on_a_table(spark):
    rows = [(r[0], r[1]) for r in table("sf0.01", "documents")]
    want = brute_by_prefixes(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.near_dedup(docs(spark, rows)).collect()}
    wrong = [i for i in want if got[i] != want[i]]
    assert len(wrong) <= 0.01 * sum(1 for i, w in want.items() if w[1] != i)


@pytest.mark.parametrize("rows", [100_000, 0])
def test_components_of_a_chain(spark, monkeypatch, rows):
    monkeypatch.setattr(common, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(common, "HOT_IDS", 60)
    ids = list(range(60))
    random.Random(4).shuffle(ids)
    links = spark.createDataFrame([(min(a, b), max(a, b)) for a, b in zip(ids[:40], ids[1:40], strict=False)] + [(ids[50], ids[51])], "a long, b long")
    got = defaultdict(set)
    for r in nd.components(links).collect():
        got[r.root].add(r.id)
    want = {min(ids[:40]): set(ids[:40]) - {min(ids[:40])}, min(ids[50:52]): {max(ids[50:52])}}
    assert got == want


def test_edges(spark):
    assert nd.near_dedup(docs(spark, [])).count() == 0
    long = " ".join(f"w{k}" for k in range(60_000))
    rows = [(1, long), (2, long + " z"), (3, "same text for each of them"), (3, "same text for each of them"), (None, "same text for each of them")]
    df = docs(spark, rows).withColumns({"id": F.lit(1), "node": F.lit(2), "KEY": F.lit(3), "root": F.lit(0)})
    got = sorted(((r.doc_id or 0, r.component_id, r.kept) for r in nd.near_dedup(df.drop("id")).collect()), key=str)
    assert got == sorted([(1, 1, True), (2, 1, False), (3, 3, True), (3, 3, True), (0, None, True)], key=str)
    assert nd.near_dedup(df).count() == 5
