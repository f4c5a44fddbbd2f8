"""Toxicity by multiple-instance learning: sentences are instances, documents are bags.

A sentence's probability is a logistic function of its words' weights; a document's is the noisy-or
of its sentences, 1 - prod(1 - p). Only documents carry labels, and the likelihood of the document
labels is what trains the word weights (full-batch Adam on the driver, over a bounded sample of
labelled documents). The sentences with the largest probabilities locate the offence.

The sample's bound is TRAIN_DOCS for each label; beyond it rows are chosen by a hash of the id.
Scoring covers every whole text.

Defined cases: null, empty and wordless texts score as a document without instances (0); a sentence
ends at . ! ? or a new line; documents without a label are scored all the same; where no document
or only one label can be learnt from, every text scores that label's share; further columns pass
through; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captionloom.llm.common import safe_name, sliced

TRAIN_DOCS, LEAST_DOCS, STEPS, RATE, L1 = 2500, 3, 200, 0.1, 2e-4
#: Features must differ between the labels by this many standard errors to be learnt; words that a worker remembers.
SCREEN_Z, CACHE_WORDS = 2.0, 150_000
#: Bytes of the beginnings of words that are features.
PREFIXES = range(4, 10)
_END = b"\x01"
_NONE: list[int] = []
_UPPER = bytes(range(65, 91))
_TABLE = bytes(1 if b in b".!?\n" else b + 32 if b in _UPPER else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def tokens(text: str | None) -> list[bytes]:
    """Words in order, with a mark at each sentence's end."""
    return (text or "").encode().translate(_TABLE).replace(_END, b" \x01 ").split()


def sentence_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the words' weights for each sentence that has a word; the bias is not in them."""
    starts = np.concatenate([[0], np.flatnonzero(ends) + 1])
    starts = starts[starts < len(values)]
    if not len(starts):
        return np.zeros(0)
    full = np.add.reduceat(~ends, starts) > 0
    return np.add.reduceat(values, starts)[full]


def features(word: bytes) -> list[bytes]:
    """The word, and its beginnings (marked by a final *), which inflected forms share."""
    return [word, *(word[:k] + b"*" for k in PREFIXES if len(word) >= k)]


class Model:
    """Weights of words and beginnings of words, and the bias of a sentence."""

    def __init__(self, weights: dict[bytes, float], bias: float, base: float | None = None):
        self.weights, self.bias, self.base = weights, bias, base
        self.known: dict[bytes, float] = {_END: 0.0}

    def _value(self, word: bytes) -> float:
        value = sum(self.weights.get(f, 0.0) for f in features(word))
        if len(self.known) >= CACHE_WORDS:
            self.known = {_END: 0.0}
        self.known[word] = value
        return value

    def sentences(self, text: str | None) -> np.ndarray:
        """Probability of each sentence that has a word, in order."""
        if self.base is not None:
            return np.zeros(0)
        own = tokens(text)
        ends = np.fromiter(map(_END.__eq__, own), bool, len(own))
        values = np.fromiter(map(self.known.get, own, repeat(np.nan)), float, len(own))
        for k in np.flatnonzero(np.isnan(values)):
            values[k] = self._value(own[k])
        return 1 / (1 + np.exp(-np.clip(sentence_sums(values, ends) + self.bias, -40, 40)))

    def _either(self, p: np.ndarray) -> float:
        if self.base is not None:
            return self.base
        return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())) if len(p) else 0.0

    def score(self, text: str | None) -> float:
        return self._either(self.sentences(text))

    def judged(self, text: str | None, least: float = 0.5) -> tuple[float, list[tuple[int, float]]]:
        """The score, and places (among sentences with words) and probabilities of the offending sentences: those of `least`
        and more, or the most probable one where only all of them together make the document's score so large."""
        p = self.sentences(text)
        whole, places = self._either(p), np.flatnonzero(p >= least)
        if not len(places) and len(p) and whole >= least:
            places = [int(p.argmax())]
        return whole, [(int(k), float(p[k])) for k in places]


class Packed:
    """Bags that are kept packed and unpacked one at a time, each time they are gone through."""

    def __init__(self, bags: list[bytes]):
        self.bags = bags

    def __iter__(self) -> Iterator[list[bytes]]:
        return (zlib.decompress(b).split() for b in self.bags)


def _hashed(words: set[bytes]) -> np.ndarray:
    own = {f for w in words if w != _END for f in features(w)}
    return np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))


def _screened(bags: Iterable[list[bytes]], y: np.ndarray, least_docs: int) -> np.ndarray:
    """Hashes, in order, of features in enough documents whose share differs between the labels by SCREEN_Z standard errors."""
    sets = [_hashed(set(bag)) for bag in bags]
    names, counts = np.unique(np.concatenate(sets), return_counts=True)
    names, counts = names[counts >= least_docs], counts[counts >= least_docs]
    toxic = np.zeros(len(names), np.int64)
    for own, label in zip(sets, y, strict=True):
        if label and len(names):
            at = np.searchsorted(names, own)
            at[at == len(names)] = 0
            toxic[at[names[at] == own]] += 1
    n1, n0 = y.sum(), len(y) - y.sum()
    both = counts / len(y)
    z = (toxic / n1 - (counts - toxic) / n0) / np.sqrt(np.maximum(both * (1 - both), 1e-9) * (1 / n1 + 1 / n0))
    return names[np.abs(z) >= SCREEN_Z]


def fit(bags: Iterable[list[bytes]], labels: list[int], steps: int = STEPS, least_docs: int = LEAST_DOCS, l1: float = L1) -> Model:
    """Trains the weights on the documents' labels: proximal full-batch Adam under an L1 penalty. The bags are gone
    through twice."""
    share = float(np.mean(labels)) if labels else 0.0
    if not labels or share in (0.0, 1.0):
        return Model({}, 0.0, share)
    y = np.asarray(labels, float)
    chosen = set(_screened(bags, y, least_docs).tolist())
    vocabulary: dict[bytes, int] = {}
    own_features: dict[bytes, list[int]] = {}
    rows, instance, document, at = array("q"), array("q"), array("q"), 0
    for d, bag in enumerate(bags):
        fresh = True
        for word in bag:
            if word == _END:
                fresh = True
                continue
            if fresh:
                document.append(d)
                at, fresh = at + 1, False
            ids = own_features.get(word)
            if ids is None:
                ids = own_features[word] = [vocabulary.setdefault(f, len(vocabulary)) for f in features(word) if xxhash.xxh3_64_intdigest(f) in chosen] or _NONE
            for k in ids:
                rows.append(k)
                instance.append(at - 1)
    size = len(vocabulary)
    rows, instance, document = (np.frombuffer(x, np.int64) if len(x) else np.zeros(0, np.int64) for x in (rows, instance, document))
    w, b = np.zeros(size), -5.0
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / len(y)
    for step in range(1, steps + 1):
        s = np.bincount(instance, w[rows], minlength=at) + b
        p = np.clip(1 / (1 + np.exp(-np.clip(s, -30, 30))), 1e-12, 1 - 1e-9)
        clean = np.exp(np.bincount(document, np.log1p(-p), minlength=len(y)))
        # d loss / d s of a sentence: p for clean documents; -p * clean / (1 - clean) for toxic ones.
        pull = np.where(y == 1, -clean / np.maximum(1 - clean, 1e-12), 1.0) * weight
        g = pull[document] * p
        gw = np.bincount(rows, g[instance], minlength=size)
        gb = g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        c1, c2 = 1 - 0.9**step, 1 - 0.99**step
        pace = RATE / (np.sqrt(v / c2) + 1e-4)
        w -= pace * (m / c1)
        w = np.sign(w) * np.maximum(np.abs(w) - pace * l1, 0)
        b -= RATE * (mb / c1) / (np.sqrt(vb / c2) + 1e-6)
    return Model({x: float(w[k]) for x, k in vocabulary.items() if w[k]}, float(b))


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_docs: int = TRAIN_DOCS) -> Model:
    """Learns from labelled documents for which `learn` (an expression of the id) holds."""
    named = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    named = named.groupBy("id").agg(F.max("label").alias("label")).withColumnRenamed("id", id_col).where(learn).withColumnRenamed(id_col, "id")
    counts = {r.label: r.n for r in named.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, train_docs / n))]) if counts else F.create_map(F.lit(0), F.lit(1.0))
    unit = F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(1 << 40)) / float(1 << 40)
    # About 2 * train_docs rows, whatever the table's size.
    sample = F.broadcast(named.where(unit < share[F.col("label")]))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(sample, "id")

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = [zlib.compress(b" ".join(tokens(t)), 1) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(rows, pa.binary())], names=["id", "label", "bag"])

    got = texts.mapInArrow(bags, T.StructType([texts.schema["id"], texts.schema["label"], T.StructField("bag", T.BinaryType())])).collect()
    got.sort(key=lambda r: (str(r.id), r.bag))
    return fit(Packed([bytes(r.bag) for r in got]), [r.label for r in got])


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score", worst_col: str | None = "offending") -> DataFrame:
    """Adds the score and, if wanted, the offending sentences (place, probability)."""
    score_col = safe_name(docs, score_col)
    # The vocabulary comes from the bounded training sample, and so is bounded itself.
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    fields = [T.StructField(score_col, T.DoubleType())]
    place = pa.struct([("sentence", pa.int32()), ("probability", pa.float64())])
    if worst_col:
        worst_col = safe_name(docs, worst_col)
        fields.append(T.StructField(worst_col, T.ArrayType(T.StructType([T.StructField("sentence", T.IntegerType()), T.StructField("probability", T.DoubleType())]))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = pickle.loads(sent.value)
        for batch in sliced(batches):
            texts = batch.column(text_col).to_pylist()
            judged = [own.judged(t) for t in texts]
            made = [pa.array([s for s, _ in judged], pa.float64())]
            if worst_col:
                made.append(pa.array([[{"sentence": k, "probability": p} for k, p in found] for _, found in judged], pa.list_(place)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *[f.name for f in fields]])

    return docs.mapInArrow(run, T.StructType(docs.schema.fields + fields))
