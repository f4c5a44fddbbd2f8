import random

from pyspark.sql import functions as F

from captionloom.llm import decontamination as d
from tests.llm.helpers import docs


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def brute(rows, tests, window):
    out = {}
    for i, text in rows:
        own, hit, found = d.words(text), set(), set()
        for item, t in tests:
            w = d.words(t)
            n = min(window, len(w))
            for k in range(len(w) - n + 1 if n else 0):
                for p in range(len(own) - n + 1):
                    if own[p : p + n] == w[k : k + n]:
                        hit |= set(range(p, p + n))
                        found.add("null" if item is None else str(item))
        out[i] = (len(own), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(own))
    return out


def test_against_brute_force(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice("a b c d é Ff g2".split()) for _ in range(n))
    rows = [(i, text(rng.randint(0, 60))) for i in range(120)] + [(200, None), (201, ""), (202, "...")]
    tests = [(k, text(rng.randint(0, 9))) for k in range(12)] + [(None, "a b"), (50, None), (51, "--")]
    rows.append((203, "x " * 30_000 + (tests[3][1] or "") + " y"))
    for query_bytes in (10**6, 20):
        out = d.decontaminate(docs(spark, rows), items(spark, tests), window=5, block_bytes=300, query_bytes=query_bytes)
        got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in out.collect()}
        assert got == brute(rows, tests, 5)


def test_chunks_of_candidates(spark, monkeypatch):
    monkeypatch.setattr(d, "CANDIDATES", 7)
    text = "a b a b a c a b " * 30
    found = d.Postings.of([text, "b a", text]).find(d.Windows([("1", "a b a"), ("2", "c a"), ("3", "zz a")], 3))
    want = {(k, p) for x, base in ((text, 0), (text, 242)) for k, w in ((0, [b"a", b"b", b"a"]), (1, [b"c", b"a"])) for p in range(base, base + 240) if d.words(x)[p - base : p - base + len(w)] == w}
    assert set(zip(found[0].tolist(), found[1].tolist(), strict=True)) == want


def test_proximity(spark):
    made = d.Postings.of(["the quick brown fox", "quick x the brown y fox", "fox", "the far away quick brown fox"])
    query = d.Windows([("1", "the quick brown fox")], 4)
    docs_of = lambda slop: sorted({int(made.starts.searchsorted(p, "right") - 1) for p in made.find(query, slop)[1]})
    assert docs_of(0) == [0] and docs_of(3) == [0, 1, 3]


def test_empty_tables_and_clashing_names(spark):
    some = docs(spark, [(1, "a b c"), (1, "a b c")]).withColumns({"block": F.lit(1), "row": F.lit(2), "items": F.lit("x")})
    assert d.decontaminate(docs(spark, []), items(spark, [(1, "a")])).count() == 0
    assert [r.n_hit for r in d.decontaminate(some, items(spark, [])).collect()] == [0, 0]
    assert [r.n_hit for r in d.decontaminate(some, items(spark, [(1, "a b")])).collect()] == [2, 2]
