"""Helpers that the text operators share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from captionloom.operators.lineage import release, settle, ship

__all__ = ["BROADCAST_IDS", "SALTS", "components", "crc_of_id", "few", "parts_for", "read", "release", "safe_name", "salt_of", "salted", "settle", "ship", "sliced", "without"]

#: Most narrow rows (some 50 bytes) that few() marks.
BROADCAST_ROWS = 100_000
#: Ids with more than such a part of all edges are broadcast where components() shuffles.
HOT_IDS = 10_000
#: Rounds of salt for groups that may hold a large share of all rows.
SALTS = 32


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crc_of_id(id_col: str = "doc_id") -> Column:
    """crc32 of the id written as text; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


def salt_of(col: str) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(SALTS)).cast("int")


def salted(df: DataFrame) -> DataFrame:
    """Every row once for each salt, so that a hot key's partners spread over SALTS tasks."""
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def sliced(batches, rows: int = 256):
    """Few rows of an Arrow batch at a time, so that their Python copies stay small."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def parts_for(rows: int, per_part: int) -> int:
    return max(1, math.ceil(rows / per_part))


def safe_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, whatever its letters' case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


#: Most ids that are broadcast to drop their rows (some bytes each); beyond it both sides are shuffled.
BROADCAST_IDS = 100_000


def without(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows whose id is not listed; rows with a null id stay."""
    ids = settle(ids.select(id_col).where(F.col(id_col).isNotNull()).distinct())
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, id_col, "left_anti")


def few(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if its counted, narrow rows are few; beyond that both sides of its join are shuffled."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def components(links: DataFrame) -> DataFrame:
    """(id, root): the smallest id that each linked id reaches, by alternating large and small stars."""
    edges = settle(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    before = _digest(edges)
    while True:
        n = 2 * before[0]
        # Large star: every larger neighbour of u is moved to the smallest id around u.
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("degree"))
        up = both.where("v > u")
        if n <= BROADCAST_ROWS:
            met = up.join(F.broadcast(least), "u")
        else:
            # Ids with more than a HOT_IDS-th of all edges, so fewer than HOT_IDS, are broadcast; no other id is a hot key.
            hot = F.col("degree") > n // HOT_IDS
            often = F.broadcast(least.where(hot))
            met = up.join(often, "u").unionByName(up.join(often.select("u"), "u", "left_anti").join(least.where(~hot), "u"))
        large = met.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # Small star: u and its smaller neighbours are moved to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(few(low, n), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        edges = settle(moved.union(low.select("u", F.col("m").alias("v"))).distinct())
        after = _digest(edges)
        if after == before:
            release(edges.sparkSession)
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
        before = after


def _digest(edges: DataFrame) -> tuple:
    """Rows and two sums of hashes, by which sets of edges are told apart."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 30)))).first())
