"""Language-model scoring with a hierarchical Pitman-Yor model.

Tokens are words and one end for each text. A word is served in the restaurant of its context, the
word before it (the end, for a text's first token); that restaurant's parent is the context of all
words with the same last byte, whose parent is the root that all contexts share, whose base is
uniform over the training words and one unknown word. Each table of a restaurant is a customer of
its parent. How many tables serve a dish is sampled by Gibbs sweeps (the seating of a dish's customers
given the rest: exactly, through generalised Stirling numbers, up to EXACT customers; beyond that by a
Poisson draw at the saddle point of the same law), and the predictive probabilities of the sweeps
after the burn-in are averaged.

How it is spread: documents become blocks of packed token numbers with a vocabulary of their own,
kept by a reliable checkpoint. The words' training counts are summed at the partition that a word's hash
gives, where each training word gets a name of few digits; the partition can be told from the name. Every
block then sends its (context, word) pairs with their training counts once to the word's partition; so a
partition holds a word in all its contexts and the whole chain of restaurants for it. There are as many
word contexts as training words; after each sweep a context's tables are summed at the partition that
owns it as a word, and the sum goes back to the partitions that may move its tables. Only the
256 parents and the root have totals that the driver sums. At the end each block asks for its pairs' customers and
tables and computes the probabilities itself. What is gathered grows with the corpus; nothing is capped or sampled.

Words are told apart by 64-bit hashes.

Defined cases: null text counts as empty, which is one end token; words unknown in training get the
uniform base's share, and as contexts have an empty restaurant below that of their last byte; without training
documents every score is that of the uniform base; ids may repeat or be null and keep their rows; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captionloom.llm.common import release, settle, sliced

#: Characters of a block; tokens for each partition of words.
BLOCK_CHARS, PART_TOKENS = 10_000_000, 6_000_000
#: Gibbs sweeps that are thrown away and that are averaged; customers up to which a dish's tables are sampled exactly.
BURN_IN, KEPT, EXACT = 2, 3, 32
#: Concentration of every restaurant; least and largest discount.
STRENGTH, DISCOUNTS = 1.0, (0.1, 0.95)
#: Bytes that part words; the last byte of an end.
SPACES, END = np.isin(np.arange(256), [*b" \t\n\r\x0b\x0c"]), np.frombuffer(b"\n", np.uint8)
#: Parents; contexts where each is a number of two bytes whose last byte is its parent.
CONTEXTS, PARENTS = 1 << 16, 1 << 8


def pack(a: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def bundle(**arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers from 0 on, in as few bytes as the greatest needs; sums of what comes back need a wider type."""
    slim = {k: a.astype(np.min_scalar_type(a.max()) if len(a) else np.uint8) for k, a in arrays.items()}
    return pickle.dumps({k: (a.dtype.str, pack(a)) for k, a in slim.items()})


def opened(data: bytes) -> dict[str, np.ndarray]:
    return {k: unpack(packed, np.dtype(kind)) for k, (kind, packed) in pickle.loads(data).items()}


def groups(owner: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each owner from 0 on, and the places that it has, in order."""
    order = np.argsort(owner, kind="stable")
    found, at = np.unique(owner[order], return_index=True)
    for r, places in zip(found.tolist(), np.split(order, at[1:]), strict=False):
        if r >= 0:
            yield r, places


# --- blocks ---------------------------------------------------------------------------------------


def tokenised(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Vocabulary (sorted hashes), its words' last bytes, the tokens' numbers in it, and tokens for each text."""
    # Words become numbers one text at a time, so that a block's words are never held together.
    each, ends = [], []
    lengths = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        data = (text or "").encode().lower()
        own = [*data.split(), b"\n"]
        lengths[k] = len(own)
        each.append(np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own)))
        raw = np.frombuffer(data + b" ", np.uint8)
        space = SPACES[raw]
        ends += [raw[:-1][space[1:] & ~space[:-1]], END]
    vocabulary, first, numbers = np.unique(np.concatenate(each), return_index=True, return_inverse=True)
    return vocabulary, np.concatenate(ends)[first], numbers.astype(np.uint32), lengths


BLOCK_COLS = ("ids", "learn", "lengths")


def blocks(docs: DataFrame, learn: Column, id_col: str, text_col: str, block_chars: int) -> DataFrame:
    lean = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    kind = lean.schema["id"].dataType.simpleString()
    schema = f"block string, ids array<{kind}>, learn array<boolean>, lengths array<int>, data binary, tokens long, training long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, held = TaskContext.get().partitionId(), 0, 0
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            ids, texts, learns = zip(*rows, strict=True)
            vocabulary, tails, numbers, lengths = tokenised(list(texts))
            row = {"block": f"{part}-{k}", "ids": list(ids), "learn": list(learns), "lengths": lengths.tolist(), "data": bundle(vocabulary=vocabulary, tails=tails, numbers=numbers), "tokens": int(lengths.sum()), "training": int(lengths[np.array(learns, bool)].sum())}
            own = pa.schema([("block", pa.string()), ("ids", pa.list_(id_type)), ("learn", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int32())), ("data", pa.binary()), ("tokens", pa.int64()), ("training", pa.int64())])
            return pa.RecordBatch.from_pylist([row], schema=own)

        for batch in sliced(batches):
            id_type = batch.schema.field(0).type
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows.append(row)
                held += len(row[1] or "") + 1
                if held >= block_chars:
                    yield flush()
                    rows, held, k = [], 0, k + 1
        if rows:
            yield flush()

    return settle(lean.mapInArrow(run, schema))


# --- names of words -------------------------------------------------------------------------------

ASK = "part int, block string, data binary"
ASKED = pa.schema([("part", pa.int32()), ("block", pa.string()), ("data", pa.binary())])


def rows_of(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def words_of(made: DataFrame, parts: int) -> DataFrame:
    """For each block and partition: hashes of words and their training counts."""
    edges = np.array([(k << 64) // parts for k in range(1, parts)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held = opened(row["data"])
                words = held["vocabulary"]
                counts = np.bincount(held["numbers"][np.repeat(np.array(row["learn"], bool), row["lengths"])], minlength=len(words))
                cut = [0, *np.searchsorted(words, edges).tolist(), len(words)]
                out = [(r, row["block"], bundle(words=words[lo:hi], counts=counts[lo:hi])) for r, (lo, hi) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if hi > lo]
                yield from rows_of(out, ASKED).to_batches()

    return made.select("block", "learn", "lengths", "data").mapInArrow(run, ASK)


def naming(parts: int) -> Callable[[pa.Table], pa.Table]:
    """Names of one partition's words: (rank + 1) * parts + partition, the commonest first, and 0 for words unknown in training."""

    def run(asked: pa.Table) -> pa.Table:
        part = asked["part"][0].as_py()
        got = [opened(d) for d in asked["data"].to_pylist()]
        words, back = np.unique(np.concatenate([g["words"] for g in got]), return_inverse=True)
        counts = np.bincount(back, np.concatenate([g["counts"] for g in got]), len(words)).astype(np.int64)
        rank = np.empty(len(words), np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(words))
        names = np.where(counts > 0, (rank + 1) * parts + part, 0).astype(np.uint64)
        ends = np.cumsum([len(g["words"]) for g in got])
        out = [(part, block, bundle(names=names[own], counts=counts[own])) for block, own in zip(asked["block"].to_pylist(), np.split(back, ends[:-1]), strict=True)]
        return rows_of(out, ASKED)

    return run


def numbered(made: DataFrame, parts: int) -> DataFrame:
    """Blocks whose vocabulary is (name, last byte), with its training counts; for each text its known tokens and sum of log10(count + 1)."""
    named = words_of(made, parts).groupBy("part").applyInArrow(naming(parts), ASK)

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        held = opened(row["data"])
        got = [opened(r["data"]) for r in sorted(answers.to_pylist(), key=lambda r: r["part"])]
        names, counts = (np.concatenate([g[k] for g in got]).astype(kind) for k, kind in (("names", np.uint64), ("counts", np.int64)))
        starts = np.concatenate([[0], np.cumsum(row["lengths"])[:-1]])
        c = counts[held["numbers"]]
        words, first, back = np.unique((names << np.uint64(8)) | held["tails"], return_index=True, return_inverse=True)
        table = block.select(["block", *BLOCK_COLS])
        table = table.append_column("known", pa.array([np.add.reduceat((c > 0).astype(np.int64), starts)], pa.list_(pa.int64())))
        table = table.append_column("logs", pa.array([np.add.reduceat(np.log10(c + 1), starts)], pa.list_(pa.float64())))
        data = bundle(words=words, counts=counts[first], numbers=back[held["numbers"]])
        return table.append_column("data", pa.array([data], pa.binary()))

    kind = made.schema["ids"].dataType.simpleString()
    schema = f"block string, ids {kind}, learn array<boolean>, lengths array<int>, known array<long>, logs array<double>, data binary"
    whole = made.select("block", *BLOCK_COLS, "data")
    return settle(whole.groupBy("block").cogroup(named.groupBy("block")).applyInArrow(run, schema))


class Pairs:
    """A numbered block's distinct (word, context) pairs in order, each token's place among them, and their (word, last byte) pairs."""

    def __init__(self, row: dict, parts: int):
        held = opened(row["data"])
        self.words, self.counts, numbers = held["words"].astype(np.uint64), held["counts"].astype(np.int64), held["numbers"].astype(np.int64)
        self.lengths = np.asarray(row["lengths"], np.int64)
        self.learn = np.asarray(row["learn"], bool)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        # A token's context is the word before it; a text's first token follows an end.
        before = np.concatenate([[0], numbers[:-1]])
        before[self.starts] = numbers[self.lengths[0] - 1]
        keys, self.place = np.unique((numbers << 32) | before, return_inverse=True)
        self.word, self.context = keys >> 32, keys & 0xFFFFFFFF
        self.tail = (self.words[self.context] % np.uint64(PARENTS)).astype(np.int64)
        self.keys1, self.up1 = np.unique((self.word << 8) | self.tail, return_inverse=True)
        names = (self.words >> np.uint64(8)).astype(np.int64)
        self.part = np.where(names > 0, names % parts, -1)

    def parts(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Each partition's words, pairs of word and last byte, and pairs; words unknown in training have none."""
        own = (groups(self.part), groups(self.part[self.keys1 >> 8]), groups(self.part[self.word]))
        for (r, words), (_, pairs1), (_, pairs2) in zip(*own, strict=True):
            yield r, words, pairs1, pairs2


def requests(named: DataFrame, parts: int, training: bool) -> DataFrame:
    """For each block and partition: names of words, pairs of each word, and contexts of the pairs; in training with their counts, where there are any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                p = Pairs(row, parts)
                counts = np.bincount(p.place[np.repeat(p.learn, p.lengths)], minlength=len(p.word))
                out = []
                for r, words, _, pairs in p.parts():
                    pairs = pairs[counts[pairs] > 0] if training else pairs
                    spans = np.bincount(np.searchsorted(words, p.word[pairs]), minlength=len(words))
                    more = {"counts": counts[pairs]} if training else {}
                    out.append((r, row["block"], bundle(words=p.words[words] >> np.uint64(8), spans=spans, contexts=p.words[p.context[pairs]], **more)))
                yield from rows_of(out, ASKED).to_batches()

    return named.select("block", "learn", "lengths", "data").mapInArrow(run, ASK)


# --- restaurants ----------------------------------------------------------------------------------

#: Rows of the sampler. fixed: a partition's pairs; state: its tables; up: contexts' tables for the partition that owns
#: them; down: their sums for the partition that asks; sums: totals for the driver.
ROW = "kind string, sweep int, part int, source int, data binary"
ROWS = pa.schema([("kind", pa.string()), ("sweep", pa.int32()), ("part", pa.int32()), ("source", pa.int32()), ("data", pa.binary())])


def merging(parts: int) -> Callable[[pa.Table], pa.Table]:
    """Sums the blocks' training counts in one partition of words, and seats each dish at one table."""

    def run(asked: pa.Table) -> pa.Table:
        part = asked["part"][0].as_py()
        word, context, counts = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = 0

        def fold() -> None:
            nonlocal word, context, counts, held
            # Old arrays go as soon as they can: a very common word's partition holds many pairs.
            pending.append((word, context, counts))
            word, context, counts = (np.concatenate(x) for x in zip(*pending, strict=True))
            pending.clear()
            names, at = np.unique(context, return_inverse=True)
            word <<= 32
            word |= at
            del at
            word, back = np.unique(word, return_inverse=True)
            counts = np.bincount(back, counts, len(word)).astype(np.int64)
            del back
            context = names[word & 0xFFFFFFFF]
            word >>= 32
            held = 0

        for data in asked["data"]:
            got = opened(data.as_py())
            ranks = got["words"].astype(np.int64) // parts - 1
            pending.append((np.repeat(ranks, got["spans"]), got["contexts"].astype(np.uint64), got["counts"].astype(np.int64)))
            held += len(got["contexts"])
            if held > 1_000_000:
                fold()
        fold()
        if not len(word):
            return rows_of([], ROWS)
        names, at = np.unique(context, return_inverse=True)
        # Each training word is some training token, so the ranks have no gaps.
        spread = np.bincount(at, minlength=len(names))
        fixed = bundle(spans=np.bincount(word), contexts=at, counts=counts, names=names)
        del word, context, counts, at
        own = Restaurants(part, fixed)
        rows = [("fixed", -1, part, part, fixed), own.sums_row(-1)]
        rows += own.up_rows(-1, parts, np.arange(len(names)), spread)
        return rows_of(rows, ROWS)

    return run


def log_stirling(discount: float, most: int = EXACT) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: ways to seat c customers at t tables."""
    s = np.full((most + 1, most + 1), -np.inf)
    s[1, 1] = 0.0
    for c in range(1, most):
        t = np.arange(1, c + 2)
        stay = np.where(c - discount * t > 0, np.log(np.maximum(c - discount * t, 1e-300)), -np.inf) + s[c, 1 : c + 2]
        s[c + 1, 1 : c + 2] = np.logaddexp(s[c, 0 : c + 1], stay)
    return s


def seat(customers: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Samples each dish's number of tables; weight: a new table's share against (customers - discount * tables)."""
    tables = np.minimum(customers, 1).astype(np.int64)
    ways = log_stirling(discount)
    few = np.flatnonzero((customers > 1) & (customers <= EXACT))
    few = few[np.argsort(customers[few], kind="stable")]
    for own in np.split(few, np.flatnonzero(np.diff(customers[few])) + 1) if len(few) else []:
        c = int(customers[own[0]])
        for lo in range(0, len(own), 200_000):
            k = own[lo : lo + 200_000]
            score = ways[c, 1 : c + 1] + np.log(weight[k])[:, None] * np.arange(1, c + 1) + rng.gumbel(size=(len(k), c))
            tables[k] = score.argmax(axis=1) + 1
    many = np.flatnonzero(customers > EXACT)
    if len(many):
        c, mean = customers[many], _mean_tables(customers[many], weight[many], discount)
        tables[many] = np.minimum(c, 1 + rng.poisson(mean))
    return tables


def _mean_tables(customers: np.ndarray, weight: np.ndarray, discount: float) -> np.ndarray:
    """Tables besides the first of a dish with many customers, at the saddle point of their law.

    The law, Stirling number times weight ** tables, is that of Poisson(weight / discount) tables whose
    sizes are independent with generating function 1 - (1 - x) ** discount, given that they sum to
    the customers; x is the tilt under which that sum is the expected one.
    """
    a = weight / discount
    low, high = np.full(len(a), -600.0), np.full(len(a), -1e-12)
    for _ in range(60):
        log_y = (low + high) / 2
        over = np.log(a * discount) + np.log1p(-np.exp(log_y)) + (discount - 1) * log_y > np.log(customers)
        low, high = np.where(over, log_y, low), np.where(over, high, log_y)
    return -a * np.expm1(discount * low)


class Totals:
    """What all partitions share: vocabulary size, discounts, customers and tables of each restaurant.

    c2, t2: of the contexts that the caller numbers; c1: of the parents, by itself where those are all contexts.
    """

    def __init__(self, v: int, discounts: tuple[float, float, float], c2: np.ndarray, t2: np.ndarray, t1: np.ndarray, t0: float, c1: np.ndarray | None = None):
        self.v, self.discounts = v, discounts
        self.c2, self.t2, self.t1, self.t0 = c2, t2, t1, t0
        self.c1 = np.bincount(np.arange(CONTEXTS) % PARENTS, t2, PARENTS) if c1 is None else c1
        self.c0 = float(t1.sum())

    def of(self, c2: np.ndarray, t2: np.ndarray) -> Totals:
        """The same above the contexts, for other contexts."""
        return Totals(self.v, self.discounts, c2, t2, self.t1, self.t0, self.c1)

    def root(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        d = self.discounts[0]
        return (c - d * t + (STRENGTH + d * self.t0) / (self.v + 1)) / (STRENGTH + self.c0)

    def parent(self, u: np.ndarray, c: np.ndarray, t: np.ndarray, below: np.ndarray) -> np.ndarray:
        d = self.discounts[1]
        return (c - d * t + (STRENGTH + d * self.t1[u]) * below) / (STRENGTH + self.c1[u])

    def leaf(self, u: np.ndarray, c: np.ndarray, t: np.ndarray, below: np.ndarray) -> np.ndarray:
        d = self.discounts[2]
        return (c - d * t + (STRENGTH + d * self.t2[u]) * below) / (STRENGTH + self.c2[u])


class Seating:
    """The restaurants of one partition of words, from the leaves (word, context) to the root (word)."""

    def __init__(self, row: dict):
        u2 = unpack(row["contexts"], np.uint16).astype(np.int64)
        self._open(row["part"], unpack(row["words"], np.uint64), unpack(row["spans"], np.uint32), u2, unpack(row["counts"], np.int64), 16, u2 % PARENTS)

    def _open(self, part: int, words: np.ndarray, spans: np.ndarray, contexts: np.ndarray, counts: np.ndarray, bits: int, parents: np.ndarray) -> None:
        """bits: of a context's number; parents: of each pair."""
        self.part, self.words, self.spans, self.u2, self.c2, self.bits = part, words, spans, contexts, counts, bits
        self.keys1, up1 = np.unique((self.places() << 8) | parents, return_inverse=True)
        self.up1 = up1.astype(np.min_scalar_type(len(up1)))
        self.up0, self.u1 = self.keys1 >> 8, self.keys1 % PARENTS
        # A dish with one customer has one table; only the others can move.
        self.many = np.flatnonzero(self.c2 > 1)
        self.t2 = np.ones(len(self.c2), np.int32)
        self.t1 = np.ones(len(self.keys1), np.int64)
        self.t0 = np.ones(len(self.words), np.int64)
        self._raise()

    def places(self) -> np.ndarray:
        """Each pair's word."""
        return np.repeat(np.arange(len(self.words)), self.spans)

    @property
    def keys2(self) -> np.ndarray:
        return (self.places() << self.bits) | self.u2

    def _raise(self) -> None:
        self._raise1()
        self.c0 = np.bincount(self.up0, self.t1, len(self.words)).astype(np.int64)

    def _raise1(self) -> None:
        beyond = np.bincount(self.up1[self.many], self.t2[self.many] - 1, len(self.keys1))
        self.c1 = np.bincount(self.up1, minlength=len(self.keys1)) + beyond.astype(np.int64)

    def sweep(self, g: Totals, number: int) -> None:
        """One Gibbs sweep, given the totals after the sweep before; the same whenever it is run again."""
        rng = np.random.default_rng([20_06, self.part, number])
        d0, d1, d2 = g.discounts
        p0 = g.root(self.c0, self.t0)
        p1 = g.parent(self.u1, self.c1, self.t1, p0[self.up0])
        k = self.many
        self.t2[k] = seat(self.c2[k].astype(np.int64), (STRENGTH + d2 * g.t2[self.u2[k]]) * p1[self.up1[k]], d2, rng)
        self._raise1()
        self.t1 = seat(self.c1, (STRENGTH + d1 * g.t1[self.u1]) * p0[self.up0], d1, rng)
        self.c0 = np.bincount(self.up0, self.t1, len(self.words)).astype(np.int64)
        self.t0 = seat(self.c0, np.full(len(self.words), (STRENGTH + d0 * g.t0) / (g.v + 1)), d0, rng)

    def sums(self) -> Iterator[tuple[str, int, float]]:
        for kind, size, u, x in (("t2", CONTEXTS, self.u2, self.t2), ("c2", CONTEXTS, self.u2, self.c2)):
            total = np.bincount(u, x, size)
            for k in np.flatnonzero(total):
                yield kind, int(k), float(total[k])
        yield from self.upper_sums()

    def upper_sums(self) -> Iterator[tuple[str, int, float]]:
        """Totals above the contexts, and how many dishes have one and two customers at each level."""
        for kind, x in (("t1", self.t1), ("c1", self.c1)):
            total = np.bincount(self.u1, x, PARENTS)
            for k in np.flatnonzero(total):
                yield kind, int(k), float(total[k])
        yield "t0", 0, float(self.t0.sum())
        yield "v", 0, float(len(self.words))
        for level, c in enumerate((self.c0, self.c1, self.c2)):
            yield "ones", level, float((c == 1).sum())
            yield "twos", level, float((c == 2).sum())


class Restaurants(Seating):
    """A partition's restaurants with words as contexts: numbers into names, each a word's name and last byte."""

    def __init__(self, part: int, fixed: bytes):
        held = opened(fixed)
        self.names = held["names"].astype(np.uint64)
        parents = (self.names % np.uint64(PARENTS)).astype(np.uint8)[held["contexts"]]
        self._open(part, np.arange(len(held["spans"])), held["spans"], held["contexts"], held["counts"], 32, parents)
        self.moving, self.at = np.unique(self.u2[self.many], return_inverse=True)

    def restore(self, state: dict[str, np.ndarray]) -> None:
        self.t2 = np.ones(len(self.c2), np.int32)
        self.t2[self.many], self.t1, self.t0 = (state[k].astype(np.int64) for k in ("t2", "t1", "t0"))
        self._raise()

    def owners(self, contexts: np.ndarray, parts: int) -> np.ndarray:
        return (self.names[contexts] >> np.uint64(8)).astype(np.int64) % parts

    def up_rows(self, sweep: int, parts: int, contexts: np.ndarray, tables: np.ndarray) -> list[tuple]:
        ranks = (self.names[contexts] >> np.uint64(8)).astype(np.int64) // parts - 1
        return [("up", sweep, q, self.part, bundle(ranks=ranks[k], tables=tables[k])) for q, k in groups(self.owners(contexts, parts))]

    def sums_row(self, sweep: int) -> tuple:
        return "sums", sweep, self.part, self.part, pickle.dumps(list(self.upper_sums()))


def owned(rows: list[dict], size: int = 0) -> np.ndarray:
    """Tables of the contexts that a partition owns, by rank, from what the partitions sent."""
    total = np.zeros(size, np.int64)
    for row in rows:
        got = opened(row["data"])
        if len(got["ranks"]) and (most := int(got["ranks"].max()) + 1) > len(total):
            total = np.concatenate([total, np.zeros(most - len(total), np.int64)])
        total[got["ranks"]] += got["tables"]  # a partition names a context once
    return total


def replied(sent: pa.Table) -> pa.Table:
    rows = sent.to_pylist()
    total = owned(rows)
    return rows_of([("down", r["sweep"], r["source"], r["part"], bundle(tables=total[opened(r["data"])["ranks"]])) for r in rows], ROWS)


def sweeping(g: Totals, number: int, parts: int) -> Callable[[pa.Table], pa.Table]:
    """One Gibbs sweep of a partition, given the totals after the sweep before."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        own = Restaurants(rows[0]["part"], next(r["data"] for r in rows if r["kind"] == "fixed"))
        asked = own.moving if number else np.arange(len(own.names))
        got, places = np.zeros(len(asked), np.int64), dict(groups(own.owners(asked, parts)))
        for r in rows:
            if r["kind"] == "down":
                got[places[r["source"]]] = opened(r["data"])["tables"]
        if number:
            # What goes up and down after the first time are the tables beyond one for each pair.
            state = next(opened(r["data"]) for r in rows if r["kind"] == "state")
            own.restore(state)
            least, now = state["least"], state["least"] + got
        else:
            least = now = got[own.moving]
        tables = np.zeros(len(own.names), np.int64)
        tables[own.moving] = now
        own.sweep(g.of(tables, tables), number)
        state = bundle(t2=own.t2[own.many], t1=own.t1, t0=own.t0, least=least)
        beyond = np.bincount(own.at, own.t2[own.many] - 1, len(own.moving)).astype(np.int64)
        return rows_of([("state", number, own.part, own.part, state), own.sums_row(number), *own.up_rows(number, parts, own.moving, beyond)], ROWS)

    return run


def totals(rows: DataFrame, discounts: tuple[float, float, float] | None = None) -> Totals:
    """Sums the totals above the contexts (some 500 numbers for each partition)."""
    found = {"t1": np.zeros(PARENTS), "c1": np.zeros(PARENTS), "t0": np.zeros(1), "v": np.zeros(1), "ones": np.zeros(3), "twos": np.zeros(3)}
    for r in rows.where("kind = 'sums'").select("part", "data").sort("part").toLocalIterator():
        for kind, place, value in pickle.loads(r.data):
            found[kind][place] += value
    if discounts is None:
        ones, twos = found["ones"], found["twos"]
        discounts = tuple(float(x) for x in np.clip(ones / np.maximum(ones + 2 * twos, 1), *DISCOUNTS))
    none = np.zeros(0)
    return Totals(int(found["v"][0]), discounts, none, none, found["t1"], float(found["t0"][0]), found["c1"])


def sample(named: DataFrame, parts: int) -> tuple[DataFrame, list[Totals]]:
    """Rows of the partitions (fixed, states and tables of the kept sweeps) and the totals after each kept sweep."""
    spark = named.sparkSession
    first = settle(requests(named, parts, training=True).groupBy("part").applyInArrow(merging(parts), ROW))
    release(spark)
    g, last, held, kept = totals(first), first, first.where("kind in ('fixed', 'up')"), []
    for k in range(BURN_IN + KEPT):
        down = last.where("kind = 'up'").groupBy("part").applyInArrow(replied, ROW)
        group = first.where("kind = 'fixed'").unionByName(last.where("kind = 'state'")).unionByName(down)
        last = settle(group.groupBy("part").applyInArrow(sweeping(g, k, parts), ROW))
        del down, group
        g = totals(last, g.discounts)
        if k >= BURN_IN:
            held = held.unionByName(last.where("kind in ('state', 'up')"))
            kept.append(g)
        release(spark)
    return held, kept


# --- answers --------------------------------------------------------------------------------------


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)


def _taken(values: np.ndarray, at: np.ndarray, there: np.ndarray) -> np.ndarray:
    return np.where(there, values[at], 0) if len(values) else np.zeros(len(at), np.int64)


#: What a block is told after each kept sweep of its words, its pairs of word and last byte, and its pairs.
TOLD = {"words": ("c0", "t0", "above"), "pairs1": ("c1", "t1"), "pairs2": ("t2",)}


def answering(parts: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For each block that asks: customers and tables of its words, as dishes and as contexts, and of its pairs."""

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return rows_of([], ASKED)
        rows = held.to_pylist()
        own = Restaurants(rows[0]["part"], next(r["data"] for r in rows if r["kind"] == "fixed"))
        keys2 = own.keys2
        sent = lambda k: owned([r for r in rows if r["kind"] == "up" and r["sweep"] == k], len(own.words))
        least, states = sent(-1), []
        for k in range(BURN_IN, BURN_IN + KEPT):
            own.restore(next(opened(r["data"]) for r in rows if r["kind"] == "state" and r["sweep"] == k))
            states.append({"c0": own.c0, "t0": own.t0, "above": least + sent(k), "c1": own.c1, "t1": own.t1, "t2": own.t2})
        out = []
        for part, block, data in zip(*(asked[n] for n in ("part", "block", "data")), strict=True):
            got = opened(data.as_py())
            at0, contexts = got["words"].astype(np.int64) // parts - 1, got["contexts"].astype(np.uint64)
            word = np.repeat(np.arange(len(at0)), got["spans"])
            u, there = _lookup(own.names, contexts)
            keys1 = np.unique((word << 8) | (contexts % np.uint64(PARENTS)).astype(np.int64))
            found = {
                "words": (at0, np.ones(len(at0), bool)),
                "pairs1": _lookup(own.keys1, (at0[keys1 >> 8] << 8) | (keys1 % PARENTS)),
                "pairs2": _lookup(keys2, np.where(there, (at0[word] << 32) | u, -1)),
            }
            told = {name: np.concatenate([_taken(s[name], *found[level]) for s in states]) for level, names in TOLD.items() for name in names}
            out.append((part.as_py(), block.as_py(), bundle(c2=_taken(own.c2, *found["pairs2"]), **told)))
        return rows_of(out, ASKED)

    return run


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS, part_tokens: int = PART_TOKENS) -> DataFrame:
    """One row for each document: id, n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    made = blocks(docs, learn, id_col, text_col, block_chars)
    tokens, training = made.agg(F.sum("tokens"), F.sum("training")).first()
    training = int(training or 0)
    parts = max(2, math.ceil((tokens or 0) / part_tokens))
    kind = made.schema["ids"].dataType.elementType.simpleString()
    named = numbered(made, parts)
    del made
    release(docs.sparkSession)
    held, kept = sample(named, parts)
    answered = requests(named, parts, training=False).groupBy("part").cogroup(held.groupBy("part")).applyInArrow(answering(parts), ASK)
    v = kept[-1].v

    def finish(block: pa.Table, answers: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        p = Pairs(row, parts)
        sizes = {"words": len(p.words), "pairs1": len(p.keys1), "pairs2": len(p.word)}
        told = {name: np.zeros((KEPT, sizes[level]), np.int64) for level, names in TOLD.items() for name in names}
        c2 = np.zeros(len(p.word), np.int64)
        got = {r["part"]: r["data"] for r in answers.to_pylist()}
        for r, *own in p.parts():
            data = opened(got[r])
            c2[own[2]] = data["c2"]
            for places, names in zip(own, TOLD.values(), strict=True):
                for name in names:
                    told[name][:, places] = data[name].reshape(KEPT, -1)
        total = np.zeros(len(p.word))
        for k, g in enumerate(kept):
            now = {name: x[k] for name, x in told.items()}
            own = g.of(p.counts, now["above"])
            p0 = own.root(now["c0"], now["t0"])
            p1 = own.parent(p.keys1 % PARENTS, now["c1"], now["t1"], p0[p.keys1 >> 8])
            total += own.leaf(p.context, c2, now["t2"], p1[p.up1])
        total = np.add.reduceat(np.log10(total / KEPT)[p.place], p.starts)
        return pa.table(
            {
                id_col: pa.array(row["ids"], block.schema.field("ids").type.value_type),
                "n_tokens": pa.array(p.lengths, pa.int64()),
                "n_known": pa.array(row["known"], pa.int64()),
                "train_tokens": pa.array([training] * len(p.lengths), pa.int64()),
                "base_score": pa.array(np.array(row["logs"]) - p.lengths * math.log10(training + v + 1), pa.float64()),
                "score": pa.array(total, pa.float64()),
                "perplexity": pa.array(10 ** np.minimum(-total / p.lengths, 300), pa.float64()),
            }
        )

    schema = f"`{id_col}` {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return named.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(finish, schema)
