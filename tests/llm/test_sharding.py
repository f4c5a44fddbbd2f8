from collections import Counter, defaultdict

from pyspark.sql import functions as F

from captionloom.llm.sharding import shard
from tests.llm.helpers import docs


def check(rows, out, shards, slack):
    got = [r.asDict() for r in out.collect()]
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in rows)
    size, slots = Counter(), defaultdict(list)
    for r in got:
        assert 0 <= r["shard"] < shards
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    share = sum(size.values()) / shards
    most = max((r["size"] for r in got), default=0)
    assert all(abs(size[k] - share) <= max(most, slack) for k in range(shards))


def test_sizes_are_near_equal_with_a_hot_text(spark):
    rows = [(i, "hot text " * 20 if i % 3 == 0 else f"text {i} " * (i % 50 + 1)) for i in range(3000)]
    check(rows, shard(docs(spark, rows), 40, range_bytes=2000), 40, 0)


def test_nulls_long_and_repeated_rows(spark):
    rows = [(1, None), (2, ""), (3, "é" * 40_000), (4, "a"), (4, "a"), (5, "b")]
    out = shard(docs(spark, rows), 4)
    assert {r.doc_id: r.size for r in out.collect()}[3] == 80_016
    assert {r.doc_id: r.text_crc32 for r in out.collect()}[1] == 0
    assert out.count() == 6


def test_empty_and_clashing(spark):
    assert shard(docs(spark, []), 40).count() == 0
    clash = docs(spark, [(1, "a"), (2, "b")]).withColumns({"shard": F.lit("x"), "range": F.lit(1), "prefix": F.lit(2)})
    assert shard(clash, 2).count() == 2
