import numpy as np
from pyspark.sql import functions as F

from captionloom.llm.exact_dedup import BinaryFuse, Snapshots, exact_dedup
from tests.llm.helpers import docs


def test_filter_holds_its_keys_and_few_others():
    rng = np.random.default_rng(1)
    for n in (1, 2, 17, 500, 30_000):
        keys = rng.integers(0, 2**63, n).astype(np.uint64)
        made = BinaryFuse.build(keys)
        assert made.holds(keys).all()
        others = rng.integers(0, 2**63, 50_000).astype(np.uint64)
        assert made.holds(others).mean() < 0.001


def brute(rows):
    top, size = {}, {}
    for i, t in rows:
        t = t or ""
        top[t] = max(top.get(t, i), i)
        size[t] = size.get(t, 0) + 1
    return sorted((i, top[t or ""], size[t or ""], top[t or ""] == i) for i, t in rows)


def test_against_brute_force(spark):
    rows = [(i, ["a", "b b", None, "", "x" * 50_000, f"own {i}", "hot"][min(i % 9, 6)]) for i in range(200)]
    got = exact_dedup(docs(spark, rows), F.pmod("doc_id", F.lit(4)), segment_keys=20).drop("text_sha256").collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_empty_table_and_clashing_names(spark):
    empty = docs(spark, [])
    assert exact_dedup(empty, F.lit(0)).count() == 0
    clash = docs(spark, [(1, "a"), (2, "a")]).withColumns({"sha": F.lit(1), "epoch": F.lit("e"), "n": F.lit(2), "keep_id": F.lit(0)})
    assert sorted(r.keep_id for r in exact_dedup(clash, F.lit(3)).collect()) == [2, 2]


def test_repeated_and_null_ids(spark):
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, "b"), (2, "c")]
    got = exact_dedup(docs(spark, rows), F.lit(0)).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in got) == [
        ("1", "1", 3, True),
        ("1", "1", 3, True),
        ("2", "2", 1, True),
        ("None", "1", 3, False),
        ("None", "None", 1, False),
    ]


def test_snapshots_keep_their_filters(spark, tmp_path):
    texts = ["a", "b b", None, "", "x" * 50_000, "hot"]
    batches = [[(100 * k + i, texts[i % (k + 4)] if i % 2 and i % (k + 4) < 6 else f"own {k} {i % 40}") for i in range(60)] for k in range(3)] + [[]]
    store, first, largest = Snapshots(spark, str(tmp_path / "store"), segment_keys=7), {}, {}
    for k, rows in enumerate(batches):
        got = sorted((r.doc_id, r.found_in, r.found_id, r.repeats) for r in store.screen(docs(spark, rows)).collect())
        last = {t or "": i for i, t in sorted(rows)}
        assert got == [(i, first.get(t or ""), largest.get(t or ""), i < last[t or ""]) for i, t in rows]
        # Another object over the same folder goes on where this one ends.
        assert Snapshots(spark, str(tmp_path / "store"), segment_keys=7).add(docs(spark, rows)) == k
        for t, i in last.items():
            if t not in first:
                first[t], largest[t] = k, i
    assert store.numbers() == [0, 1, 2, 3]
