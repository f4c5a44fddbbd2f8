"""Exact deduplication: binary-fuse filters over immutable snapshots screen incoming digests.

Rows arrive in epochs. Each epoch, once taken in, is an immutable snapshot: its distinct digests
are cut into segments by digest, and each segment gets a static 3-wise binary-fuse filter with
16-bit fingerprints. A later epoch's distinct digests (its own duplicates are grouped first) are
screened against the filters of all earlier epochs; only positives join the exact buckets. Groups
of two or more rows are then compared byte by byte (least and greatest text of the group). Their texts
alone are moved for it: a bitmap of the groups' digests, of 64 MB at most, keeps the others where they are.

`Snapshots` keeps filters and exact buckets in a shared folder from batch to batch: `screen` tells which rows of a new batch
repeat an earlier text or one of their own batch, and `add` makes the batch the next immutable snapshot.

Defined cases: null text counts as empty and equals the empty text; texts are equal only when
identical; of equal rows the largest id stays; an empty table gives no rows; further columns are
ignored; null ids keep their rows, and a group of null ids alone has a null keep_id and no kept row.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from captionloom.llm.common import parts_for, salt_of, salted, settle, ship

#: Digests that one filter segment holds, about.
SEGMENT_KEYS = 60_000
#: Bits of a bitmap that a group's digest gets, about; bits of one row of a bitmap; most of its rows (64 MB).
BITS_A_GROUP, BITMAP_BITS, BITMAP_ROWS = 16, 32_768, 16_384
FILTER_SCHEMA = "epoch int, segment long, seed long, width long, filter binary"
HIT_SCHEMA = "sha binary, epoch int, found_in int"


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = keys + np.uint64(seed & 0xFFFFFFFFFFFFFFFF)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(33)
    return h


class BinaryFuse:
    """A static 3-wise binary-fuse filter with 16-bit fingerprints.

    Three neighbouring windows of `width` slots are probed; the windows' start moves with the key
    over all but the last two. Peeling runs in rounds: all slots with a single key go at once.
    """

    def __init__(self, seed: int, width: int, cells: np.ndarray):
        self.seed, self.width, self.cells = seed, width, cells

    @staticmethod
    def _slots(h: np.ndarray, width: int, windows: int) -> tuple[np.ndarray, np.ndarray]:
        start = ((h >> np.uint64(32)) * np.uint64(windows)) >> np.uint64(32)
        mask = np.uint64(width - 1)
        base = start * np.uint64(width)
        a = base + (h & mask)
        b = base + np.uint64(width) + ((h >> np.uint64(18)) & mask)
        c = base + np.uint64(2 * width) + (_mix(h, 77) & mask)
        return np.stack([a, b, c]).astype(np.int64), (_mix(h, 991) & np.uint64(0xFFFF)).astype(np.uint16)

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuse:
        keys = np.unique(keys)
        n = len(keys)
        width = 1 << max(2, int(np.log2(max(n, 2)) * 0.62 + 1.5))
        windows = max(1, int(np.ceil(n * (1.25 if n > 20_000 else 1.6) / width)))
        for seed in range(1, 200):
            h = _mix(keys, seed * 0x9E3779B97F4A7C15)
            slots, prints = cls._slots(h, width, windows)
            order = cls._peel(slots, (windows + 2) * width)
            if order is not None:
                cells = np.zeros((windows + 2) * width, np.uint16)
                for rows, own in reversed(order):
                    s = slots[:, rows]
                    # A peeled key's own slot is still zero here, so xoring all three leaves the other two.
                    cells[own] = prints[rows] ^ cells[s[0]] ^ cells[s[1]] ^ cells[s[2]]
                return cls(seed, width, cells)
            if seed % 10 == 0:
                windows += max(1, windows // 8)
        raise RuntimeError("no binary-fuse filter found for these keys")

    @staticmethod
    def _peel(slots: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
        n = slots.shape[1]
        flat, who = slots.ravel(), np.tile(np.arange(n), 3)
        count = np.bincount(flat, minlength=size)
        acc = np.zeros(size, np.int64)
        np.bitwise_xor.at(acc, flat, who)
        order, left = [], n
        while left:
            single = np.flatnonzero(count == 1)
            if not len(single):
                return None
            rows, first = np.unique(acc[single], return_index=True)
            order.append((rows, single[first]))
            gone = slots[:, rows].ravel()
            np.subtract.at(count, gone, 1)
            np.bitwise_xor.at(acc, gone, np.tile(rows, 3))
            left -= len(rows)
        return order

    def holds(self, keys: np.ndarray) -> np.ndarray:
        windows = len(self.cells) // self.width - 2
        h = _mix(keys, self.seed * 0x9E3779B97F4A7C15)
        s, prints = self._slots(h, self.width, windows)
        return (self.cells[s[0]] ^ self.cells[s[1]] ^ self.cells[s[2]]) == prints


def _keys(shas: pa.ChunkedArray) -> np.ndarray:
    """Bytes 8 to 15 of each digest; the segment is taken from the first eight."""
    joined = b"".join(shas.to_pylist())
    return np.frombuffer(joined, ">u8").reshape(-1, 4)[:, 1].astype(np.uint64)


def _build(table: pa.Table) -> pa.Table:
    made = BinaryFuse.build(_keys(table["sha"]))
    return pa.table(
        {
            "epoch": pa.array([table["epoch"][0].as_py()], pa.int32()),
            "segment": pa.array([table["segment"][0].as_py()], pa.int64()),
            "seed": pa.array([made.seed], pa.int64()),
            "width": pa.array([made.width], pa.int64()),
            "filter": pa.array([made.cells.tobytes()], pa.binary()),
        }
    )


def _probe(digests: pa.Table, filters: pa.Table) -> pa.Table:
    shas, epochs, found = [], [], []
    if digests.num_rows and filters.num_rows:
        keys, at = _keys(digests["sha"]), digests["epoch"].to_numpy()
        own = digests["sha"]
        for f in filters.to_pylist():
            hit = np.flatnonzero((at > f["epoch"]) & BinaryFuse(f["seed"], f["width"], np.frombuffer(f["filter"], np.uint16)).holds(keys))
            shas += own.take(pa.array(hit)).to_pylist()
            epochs += at[hit].tolist()
            found += [f["epoch"]] * len(hit)
    return pa.table({"sha": pa.array(shas, pa.binary()), "epoch": pa.array(epochs, pa.int32()), "found_in": pa.array(found, pa.int32())})


def _word(sha: Column, at: int) -> Column:
    """Six bytes of a digest as a number; the filters' fingerprints come from bytes 8 to 15."""
    return F.conv(F.hex(F.substring(sha, at, 6)), 16, 10).cast("long")


def _segment(sha: Column, segments: int) -> Column:
    return F.pmod(_word(sha, 1), F.lit(segments))


def snapshot_filters(cut: DataFrame) -> DataFrame:
    """The filters of distinct digests (sha, epoch, segment), one for each epoch and segment."""
    return cut.groupBy("epoch", "segment").applyInArrow(_build, FILTER_SCHEMA)


def positives(cut: DataFrame, filters: DataFrame) -> DataFrame:
    """(sha, epoch, found_in) where a filter of an earlier epoch holds the digest; a few of them wrongly."""
    return cut.groupBy("segment").cogroup(filters.groupBy("segment")).applyInArrow(_probe, HIT_SCHEMA)


def _likely(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows whose digest may be among the groups', and all whose digest is. Nothing is shuffled but the bitmap."""
    count = groups.count()
    wide = min(BITMAP_ROWS, max(1, parts_for(count * BITS_A_GROUP, BITMAP_BITS)))
    row = lambda: F.pmod(_word(F.col("sha"), 17), F.lit(wide))
    bit = lambda: F.pmod(_word(F.col("sha"), 23), F.lit(BITMAP_BITS))
    maps = groups.groupBy(row().alias("map_row")).agg(F.bitmap_construct_agg(bit()).alias("map"))
    byte = F.conv(F.hex(F.substring("map", (bit() / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.call_function("shiftright", byte, F.pmod(bit(), F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1
    # 4 KB a row and BITMAP_ROWS rows at most.
    return rows.withColumn("map_row", row()).join(F.broadcast(maps), "map_row").where(held).drop("map", "map_row")


class Snapshots:
    """Immutable snapshots in a folder that driver and executors share: `filters` and exact `buckets` of each, as Parquet.

    Null text counts as empty; ids are whole numbers, and a null id is found in snapshots but repeats nothing; an empty batch
    screens to no rows and makes a snapshot without filters; further columns are ignored.
    """

    def __init__(self, spark: SparkSession, folder: str, segment_keys: int = SEGMENT_KEYS):
        ship(spark)
        self.spark, self.folder, self.segment_keys = spark, folder.rstrip("/"), segment_keys

    def numbers(self) -> list[int]:
        """The finished snapshots: those whose mark was written last."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = files.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/snapshot-*/segments-*/_SUCCESS")) or []
        return sorted(int(f.getPath().getParent().getParent().getName().split("-")[1]) for f in found)

    def _place(self, number: int) -> str:
        return f"{self.folder}/snapshot-{number:08d}"

    def add(self, batch: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> int:
        """Makes the batch the next snapshot and returns its number. A run that was lost half way leaves no snapshot, and the
        next one writes over it."""
        number = max(self.numbers(), default=-1) + 1
        place = self._place(number)
        lean = batch.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        # Of a digest's texts each is kept once, so that bytes can be compared.
        own = lean.groupBy("text").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
        own.withColumn("sha", F.unhex(F.sha2("text", 256))).write.mode("overwrite").parquet(f"{place}/buckets")
        digests = self.spark.read.parquet(f"{place}/buckets").select("sha").distinct()
        segments = parts_for(max(1, digests.count()), self.segment_keys)
        cut = digests.select("sha", F.lit(number).alias("epoch"), _segment(F.col("sha"), segments).alias("segment"))
        snapshot_filters(cut).withColumn("segments", F.lit(segments)).write.mode("overwrite").parquet(f"{place}/segments-{segments}")
        return number

    def _segments(self, number: int) -> int:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._place(number)}/segments-*/_SUCCESS")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return int(found[0].getPath().getParent().getName().split("-")[1])

    def screen(self, batch: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """One row for each of the batch: id, found_in (the first snapshot that holds its text, else null), found_id (the largest
        id there) and repeats (whether an equal text with a larger id stands in the batch)."""
        lean = batch.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("sha", F.unhex(F.sha2("text", 256)))
        keyed = settle(lean.select("id", "sha"))
        digests = settle(keyed.select("sha").distinct())
        none = self.spark.createDataFrame([], "sha binary, text string, top long, found_in int")
        hits = [none]
        for number in self.numbers():
            segments = self._segments(number)
            filters = self.spark.read.schema(FILTER_SCHEMA).parquet(f"{self._place(number)}/segments-{segments}")
            cut = digests.select("sha", F.lit(number + 1).alias("epoch"), _segment(F.col("sha"), segments).alias("segment"))
            met = positives(cut, filters).select("sha")
            buckets = self.spark.read.parquet(f"{self._place(number)}/buckets")
            hits.append(buckets.join(met, "sha", "left_semi").select("sha", "text", F.col("top").cast("long").alias("top"), F.lit(number).alias("found_in")))
        old = settle(reduce(DataFrame.unionByName, hits).groupBy("sha", "text").agg(F.min("found_in").alias("found_in"), F.min_by("top", "found_in").alias("found_id")))
        own = keyed.groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top")).where("n > 1").select("sha")
        wanted = settle(own.union(old.select("sha")).distinct())
        likely = settle(_likely(lean, wanted).join(wanted, "sha", "left_semi").withColumn("salt", salt_of("id")))
        tops = likely.groupBy("sha", "text", "salt").agg(F.max("id").alias("top")).groupBy("sha", "text").agg(F.max("top").alias("last"))
        # Bytes are compared here: both joins are by the text itself.
        met = likely.join(salted(tops), ["sha", "text", "salt"]).join(salted(old), ["sha", "text", "salt"], "left")
        met = met.select("id", "found_in", "found_id", F.coalesce(F.col("id") < F.col("last"), F.lit(False)).alias("repeats"))
        new = keyed.join(wanted, "sha", "left_anti").select("id", F.lit(None).cast("int").alias("found_in"), F.lit(None).cast("long").alias("found_id"), F.lit(False).alias("repeats"))
        return new.unionByName(met).withColumnRenamed("id", id_col)


def exact_dedup(docs: DataFrame, epoch: Column, id_col: str = "doc_id", text_col: str = "text", segment_keys: int = SEGMENT_KEYS) -> DataFrame:
    """One row for each input row: id, keep_id, group_size, kept, text_sha256 (see the module's text)."""
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), epoch.cast("int").alias("epoch"))
    source = source.withColumn("sha", F.unhex(F.sha2("text", 256)))
    keyed = settle(source.select("id", "epoch", "sha"))
    # Duplicates inside an epoch are grouped first; a hot text is combined before the shuffle.
    buckets = settle(keyed.groupBy("epoch", "sha").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top")))
    segments = parts_for(keyed.count(), segment_keys)
    cut = buckets.select("sha", "epoch", _segment(F.col("sha"), segments).alias("segment"))
    hits = positives(cut, snapshot_filters(cut))
    # Positives meet the exact buckets of the snapshot that their filter stands for.
    met = buckets.select("sha", F.col("epoch").alias("found_in")).join(hits, ["sha", "found_in"]).select("sha").distinct()
    across = buckets.join(met, "sha").groupBy("sha").agg(F.sum("n").alias("n"), F.max("top").alias("top"))
    within = buckets.where("n > 1").join(met, "sha", "left_anti").select("sha", "n", "top")
    groups = settle(across.unionByName(within))
    # Byte check: all texts of a group are the same if the least and the greatest are.
    texts = _likely(source.select("sha", "text", salt_of("id").alias("salt")), groups).join(salted(groups.select("sha")), ["sha", "salt"])
    spans = texts.groupBy("sha", "salt").agg(F.min("text").alias("low"), F.max("text").alias("high"))
    spans = spans.groupBy("sha").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    clashes = settle(spans.where("low != high").select("sha"))
    rows = keyed.withColumn("salt", salt_of("id"))
    if not clashes.isEmpty():
        return _by_text(source, rows, groups, clashes, id_col)
    out = rows.join(salted(groups), ["sha", "salt"], "left")
    return _shape(out, id_col)


def _shape(out: DataFrame, id_col: str) -> DataFrame:
    keep = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("top"))
    return out.select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("id") == keep, F.lit(False)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def _by_text(source: DataFrame, rows: DataFrame, groups: DataFrame, clashes: DataFrame, id_col: str) -> DataFrame:
    """Digests that two texts share: their rows are grouped by the text itself."""
    clean = _shape(rows.join(clashes, "sha", "left_anti").join(salted(groups), ["sha", "salt"], "left"), id_col)
    odd = source.join(clashes, "sha").withColumn("salt", salt_of("id"))
    own = odd.groupBy("sha", "text").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    return clean.unionByName(_shape(odd.join(salted(own), ["sha", "text", "salt"], "left"), id_col))
