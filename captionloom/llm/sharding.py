"""Sharding by sampled splitters: size-weighted key samples, quantile boundaries, range partitions.

Records are ordered by (64-bit hash of the text, id), so equal texts lie side by side. Rows are
sampled with probability in proportion to their size; the sample's quantiles are the splitters of
many fine ranges, spread by the key alone or, inside a hot key, by the id as well. Ranges that
hold more than twice their share are subdivided with further samples of their own. Sizes and rows
of the ranges then give each record its exact place in the order, and a shard is an equal slice of
the bytes. Everything runs as DataFrame expressions.

Defined cases: null text has no bytes and crc32 0 (as the empty text); ties in key and id (repeated
rows) are ordered by size and crc32; null ids sort first; an empty table gives no rows; further
columns are ignored; with fewer rows than shards some shards stay empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from captionloom.llm.common import settle

#: Bytes that each record costs besides its text.
OVERHEAD = 16
#: Sampled keys for each fine range.
SAMPLES = 24
#: Bytes of a fine range, about; and the most ranges (their table is broadcast).
RANGE_BYTES, MOST_RANGES = 8_000_000, 16_384
ROUNDS = 3


def _unit(seed: int, *cols: str) -> Column:
    """A number from 0 to 1 that the row decides, so a task that runs again draws the same."""
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _place(df: DataFrame, splitters: DataFrame) -> DataFrame:
    """Adds `range`: how many splitters are at or below the row's (key, id).

    Splitters are grouped by the key's leading bits; the table has a row for each prefix, and holds
    at most 2 * MOST_RANGES splitters, which bounds what is broadcast.
    """
    prefix = F.shiftright("key", 52).cast("int")
    local = splitters.withColumn("prefix", prefix).groupBy("prefix").agg(F.sort_array(F.collect_list(F.struct("key", "id"))).alias("cuts"))
    every = F.broadcast(local).sparkSession.range(-2048, 2048).select(F.col("id").cast("int").alias("prefix"))
    below = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    table = every.join(local, "prefix", "left").withColumn("below", F.coalesce(F.sum(F.size(F.coalesce("cuts", F.array()))).over(below), F.lit(0)))
    inside = F.when(F.col("cuts").isNull(), F.lit(0)).otherwise(F.size(F.filter("cuts", lambda c: c <= F.struct("key", "id"))))
    return df.withColumn("prefix", prefix).join(F.broadcast(table), "prefix").withColumn("range", (F.col("below") + inside).cast("int")).drop("prefix", "below", "cuts")


def _quantiles(sample: DataFrame, ranges: int) -> DataFrame:
    """Splitters at equal weights of the sample; its size is bounded by SAMPLES * ranges, about."""
    order = Window.orderBy("key", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = sample.withColumn("run", F.sum("weight").over(order))
    whole = Window.partitionBy()
    step = F.floor(F.col("run") * ranges / F.max("run").over(whole))
    return run.withColumn("step", step).where(f"step < {ranges}").groupBy("step").agg(F.min(F.struct("key", "id")).alias("cut")).where("step > 0").select("cut.key", "cut.id").distinct()


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """id, size, text_crc32, law, shard, slot, grown_shard for each record (law `bytes`)."""
    raw = F.coalesce(F.col(text_col), F.lit(""))
    lean = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(raw) + OVERHEAD).cast("long").alias("size"),
        F.crc32(raw.cast("binary")).alias("crc"),
        F.xxhash64(raw).alias("key"),
    )
    lean = settle(lean)
    total, rows = lean.agg(F.sum("size"), F.count(F.lit(1))).first()
    total, rows = int(total or 0), int(rows)
    ranges = int(min(MOST_RANGES, max(8 * shards, -(-total // range_bytes))))
    goal = max(1.0, SAMPLES * ranges)
    chance = F.least(F.lit(1.0), F.col("size") * (goal / max(total, 1)))
    picked = lean.where(_unit(7, "key", "id", "size") < chance).select("key", "id", (F.col("size") / chance).alias("weight"))
    splitters = settle(_quantiles(picked, ranges))
    share = total / max(ranges, 1)
    for k in range(ROUNDS):
        placed = _place(lean, splitters)
        heavy = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).where((F.col("bytes") > 2 * share) & (F.col("n") > 1))
        heavy = settle(heavy)
        if heavy.isEmpty():
            break
        # Overfull ranges are drawn from again, and cut at their own quantiles.
        near = placed.join(F.broadcast(heavy), "range")
        more = near.where(_unit(11 + k, "key", "id", "size") < F.least(F.lit(1.0), F.col("size") * (SAMPLES / share)))
        in_range = Window.partitionBy("range")
        run = F.sum("size").over(in_range.orderBy("key", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        piece = F.floor(run * F.ceil(F.col("bytes") / share) / F.sum("size").over(in_range))
        cuts = more.withColumn("piece", piece).groupBy("range", "piece").agg(F.min(F.struct("key", "id")).alias("cut")).select("cut.key", "cut.id")
        splitters = settle(splitters.unionByName(cuts).distinct())
    placed = settle(_place(lean, splitters))
    at = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    stats = placed.groupBy("range").agg(F.sum("size").alias("bytes")).withColumn("before", F.coalesce(F.sum("bytes").over(at), F.lit(0))).select("range", "before")
    inside = Window.partitionBy("range").orderBy("key", "id", "size", "crc")
    run = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    # The middle of a record decides the slice it lies in, so slices differ by a record at most.
    middle = (F.col("before") + F.col("run") + F.col("size") / 2) * F.lit(shards / max(total, 1))
    laid = placed.withColumn("run", run).join(F.broadcast(stats), "range").withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle)).cast("int"))
    laid = laid.select("id", "size", "crc", "key", "range", "shard")
    pieces = laid.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"))
    pieces = pieces.withColumn("first", F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    rank = F.row_number().over(Window.partitionBy("range", "shard").orderBy("key", "id", "size", "crc")) - 1
    return (
        laid.withColumn("rank", rank)
        .join(F.broadcast(pieces), ["shard", "range"])
        .select(
            F.col("id").alias(id_col),
            "size",
            F.col("crc").alias("text_crc32"),
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("first") + F.col("rank")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
