"""Benchmark decontamination with a distributed positional inverted index.

Training documents are cut into blocks of bounded text. Each block stores, for every term, the
sorted list of its positions (packed with zstd, kept through a reliable checkpoint). Test items are
cut into windows of 13 consecutive words; an item with fewer words is one window. In each block a
window whose terms all occur starts from its rarest term there: that term's positions, less the
term's offset, are candidate starts, and the other terms' offset-adjusted lists are intersected in
order of rarity. With slop 0 this is exact phrase search; with a larger slop it is a proximity
search: every term must stand within `slop` words of its place, counted from the rarest term, in
the same document.

The test set is searched in blocks of bounded size, one pass over the index for each, so what is
sent to the executors does not grow; every row of the documents is searched.

Defined cases: words are runs of [0-9a-z] and non-ASCII characters after lower-casing A-Z; null and
empty texts have no words and no hits; items without words match nothing; a null item id is the
text `null`; repeated rows give repeated results; an empty table gives no rows; an empty benchmark
marks nothing; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captionloom.llm.common import settle, sliced

#: Words of a window; text bytes of an index block; text bytes of a block of test items.
WINDOW, BLOCK_BYTES, QUERY_BYTES = 13, 8_000_000, 2_000_000
#: Candidates that are intersected at once.
CANDIDATES = 1_000_000

_UPPER = bytes(range(65, 91))
_WORDS = bytes(b + 32 if b in _UPPER else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORDS).split()


def hashed(terms: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))


def pack(a: np.ndarray) -> bytes:
    """zstd over byte planes, so that equal high bytes of neighbours compress."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


class Postings:
    """One block's positional index: terms, where their lists start, the lists, and the documents' first positions."""

    def __init__(self, terms: np.ndarray, counts: np.ndarray, positions: np.ndarray, lengths: np.ndarray):
        self.terms, self.counts, self.positions, self.lengths = terms, counts, positions, lengths
        self.starts = np.concatenate([[0], np.cumsum(lengths)])

    @classmethod
    def of(cls, texts: list[str | None]) -> Postings:
        # Words become hashes one document at a time, so that a block's words are never held together.
        each = [hashed(words(text)) for text in texts]
        lengths = np.fromiter(map(len, each), np.int64, len(each))
        h = np.concatenate([np.zeros(0, np.uint64), *each])
        order = np.argsort(h, kind="stable")
        terms, counts = np.unique(h[order], return_counts=True)
        return cls(terms, counts.astype(np.uint32), order.astype(np.uint32), lengths)

    def packed(self) -> tuple[bytes, bytes, bytes]:
        return pack(self.terms), pack(self.counts), pack(self.positions)

    @classmethod
    def unpacked(cls, terms: bytes, counts: bytes, positions: bytes, lengths: np.ndarray) -> Postings:
        return cls(unpack(terms, np.uint64), unpack(counts, np.uint32), unpack(positions, np.uint32), lengths)

    def find(self, query: Windows, slop: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each match: the window's number, its first position and its length."""
        at = np.searchsorted(self.terms, query.terms)
        at[at == len(self.terms)] = 0
        here = self.terms[at] == query.terms if len(self.terms) else np.zeros(len(query.terms), bool)
        first = np.concatenate([[0], np.cumsum(self.counts, dtype=np.int64)])
        counts = np.where(here, self.counts[at] if len(self.terms) else 0, 0).astype(np.int64)
        # The lists of the terms that the query asks for, as one sorted array of (term, position).
        own = np.flatnonzero(here)
        take = np.repeat(first[at[own]], counts[own]) + _ramp(counts[own])
        begin = np.zeros(len(query.terms) + 1, np.int64)
        begin[1:] = np.cumsum(counts)
        lists = (np.repeat(own.astype(np.uint64), counts[own]) << np.uint64(32)) | self.positions[take].astype(np.uint64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for number, rows in query.by_length.values():
            length = rows.shape[1]
            c = counts[rows]
            alive = np.flatnonzero((c > 0).all(axis=1))
            if not len(alive):
                continue
            rarest = np.argsort(c[alive], axis=1, kind="stable")
            anchors = c[alive, rarest[:, 0]]
            cut = np.searchsorted(np.cumsum(anchors), np.arange(CANDIDATES, anchors.sum() + CANDIDATES, CANDIDATES))
            lo = 0
            for hi in np.unique(np.minimum(cut + 1, len(alive))):
                if hi > lo:
                    found.append(self._intersect(lists, begin, rows[alive[lo:hi]], number[alive[lo:hi]], rarest[lo:hi], anchors[lo:hi], length, slop))
                lo = hi
        if not found:
            none = np.zeros(0, np.int64)
            return none, none, none
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _intersect(self, lists, begin, rows, number, rarest, anchors, length, slop):
        who = np.repeat(np.arange(len(rows)), anchors)
        offset = rarest[who, 0]
        at = (lists[begin[rows[who, offset]] + _ramp(anchors)] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        start = at - offset
        doc = np.searchsorted(self.starts, at, "right") - 1
        low, high = self.starts[doc], self.starts[doc + 1]
        ok = (start + length + slop > low) & (start - slop < high) if slop else (start >= low) & (start + length <= high)
        who, start, low, high = who[ok], start[ok], low[ok], high[ok]
        for j in range(1, length):
            if not len(who):
                break
            off = rarest[who, j]
            term = rows[who, off].astype(np.uint64) << np.uint64(32)
            place = start + off
            near, far = np.maximum(place - slop, low), np.minimum(place + slop, high - 1)
            k = np.searchsorted(lists, term | np.maximum(near, 0).astype(np.uint64))
            inside = k < len(lists)
            ok = inside & (near <= far) & (lists[np.where(inside, k, 0)] <= (term | np.maximum(far, 0).astype(np.uint64)))
            who, start, low, high = who[ok], start[ok], low[ok], high[ok]
        first, last = np.maximum(start - slop, low), np.minimum(start + length + slop, high)
        return number[who], first, last - first


def _ramp(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count, one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


class Windows:
    """The windows of a block of test items, by length, as numbers of the block's distinct terms."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        rows: dict[int, list[np.ndarray]] = {}
        owner: dict[int, list[np.ndarray]] = {}
        self.items: list[str] = []
        for item, text in items:
            h = hashed(words(text))
            n = min(window, len(h))
            if n:
                wins = np.lib.stride_tricks.sliding_window_view(h, n)
                rows.setdefault(n, []).append(wins)
                owner.setdefault(n, []).append(np.full(len(wins), len(self.items)))
                self.items.append(item)
        joined = {n: np.concatenate(x) for n, x in rows.items()}
        self.terms = np.unique(np.concatenate([x.ravel() for x in joined.values()])) if joined else np.zeros(0, np.uint64)
        self.by_length = {n: (np.concatenate(owner[n]), np.searchsorted(self.terms, x)) for n, x in joined.items()}


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The index's blocks: block, ids and word counts of its documents, packed terms, counts and positions."""
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    schema = f"block string, ids array<{kind}>, lengths array<int>, terms binary, counts binary, positions binary"

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        ids, texts, held = [], [], 0

        def flush() -> pa.RecordBatch:
            made = Postings.of(texts)
            terms, counts, positions = made.packed()
            row = {"block": f"{part}-{k}", "ids": ids, "lengths": made.lengths.tolist(), "terms": terms, "counts": counts, "positions": positions}
            own = pa.schema([("block", pa.string()), ("ids", pa.list_(id_type)), ("lengths", pa.list_(pa.int32())), ("terms", pa.binary()), ("counts", pa.binary()), ("positions", pa.binary())])
            return pa.RecordBatch.from_pylist([row], schema=own)

        for batch in sliced(batches):
            id_type = batch.schema.field(0).type
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(i)
                texts.append(text)
                held += len(text or "") + 1
                if held >= block_bytes:
                    yield flush()
                    ids, texts, held, k = [], [], 0, k + 1
        if ids:
            yield flush()

    return settle(docs.select(id_col, text_col).mapInArrow(blocks, schema))


def search(blocks: DataFrame, query: Windows, slop: int = 0) -> DataFrame:
    """Documents with matches: block, row (place in the block), id, spans of words (from, to), items."""
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    schema = f"block string, row int, id {kind}, spans array<struct<first:int,last:int>>, items array<string>"
    sent = blocks.sparkSession.sparkContext.broadcast(query)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            id_type = batch.schema.field("ids").type.value_type
            out = pa.schema([("block", pa.string()), ("row", pa.int32()), ("id", id_type), ("spans", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))), ("items", pa.list_(pa.string()))])
            for b in batch.to_pylist():
                made = Postings.unpacked(b["terms"], b["counts"], b["positions"], np.asarray(b["lengths"], np.int64))
                number, start, length = made.find(own, slop)
                doc = np.searchsorted(made.starts, start, "right") - 1
                order = np.lexsort((start, doc))
                rows = []
                for k in np.split(order, np.flatnonzero(np.diff(doc[order])) + 1) if len(order) else []:
                    d = int(doc[k[0]])
                    s = start[k] - made.starts[d]
                    e = np.maximum.accumulate(s + length[k])
                    new = np.concatenate([[True], s[1:] > e[:-1]])
                    last = np.concatenate([e[:-1][new[1:]], e[-1:]])
                    rows.append({"block": b["block"], "row": d, "id": b["ids"][d], "spans": [{"first": int(x), "last": int(y)} for x, y in zip(s[new], last, strict=True)], "items": sorted({own.items[x] for x in number[k]})})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=out)

    return blocks.mapInArrow(run, schema)


def _union_size(spans):
    """Words that a sorted list of spans covers together."""
    zero = F.struct(F.lit(0).alias("to"), F.lit(0).alias("n"))
    step = lambda a, s: F.struct(F.greatest(a["to"], s["last"]).alias("to"), (a["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(s["first"], a["to"]))).alias("n"))
    return F.aggregate(spans, zero, step, lambda a: a["n"])


def query_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, query_bytes: int) -> Iterator[Windows]:
    """The test items' windows, in blocks of about query_bytes of text."""
    named = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"), F.col(text_col).alias("text"))
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // query_bytes))
    for k in range(blocks):
        yield Windows([(r.id, r.text) for r in named.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).collect()], window)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, slop: int = 0, block_bytes: int = BLOCK_BYTES, query_bytes: int = QUERY_BYTES
) -> DataFrame:
    """One row for each document: id, n_words, n_hit, items (sorted array of strings), contaminated."""
    blocks = index(docs, id_col, text_col, block_bytes)
    every = blocks.select("block", F.posexplode(F.arrays_zip("ids", "lengths")).alias("row", "d"))
    none = F.array().cast("array<struct<first:int,last:int>>")
    rows = every.select("block", "row", F.col("d.ids").alias("id"), F.col("d.lengths").alias("n"), none.alias("spans"), F.array().cast("array<string>").alias("items"))
    for query in query_blocks(benchmark, item_col, item_text_col, window, query_bytes):
        rows = rows.unionByName(search(blocks, query, slop).withColumn("n", F.lit(0)))
    found = rows.groupBy("block", "row").agg(F.max("id").alias("id"), F.max("n").alias("n"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    hit = _union_size(F.array_sort("spans")).cast("long")
    out = found.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_words"), hit.alias("n_hit"), "items")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
