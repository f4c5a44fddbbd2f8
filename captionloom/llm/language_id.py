"""Language ID by string kernels: blended-spectrum n-gram presence, Nystroem landmarks, kernel ridge.

Texts are taken as UTF-8 bytes, A-Z lower-cased and everything but letters (and non-ASCII bytes) as a space. The kernel of two
texts is the mean, over n from 1 to 3, of the cosine between their sets of byte n-grams. Landmarks
are training texts of bounded length, as many from each language; kernel values against them, times
the inverse square root of the landmarks' own kernel matrix, are a text's features, on which
one-versus-rest ridge regressions are fitted. Texts are scored in batches: one matrix of n-gram
presence times one matrix of landmarks, then times the regressions.

The landmarks (LANDMARKS, from texts of at most LANDMARK_CHARS characters, or a label's FEWEST shortest texts where it
has fewer such) and the regression's rows
(TRAIN_ROWS) are bounded samples of the labelled rows, chosen by a hash of the id; every whole text is scored.

Defined cases: null texts and texts without a letter are `und` with score 0; so is every text where
nothing can be learnt from; of equal scores the first label in order wins; rows with a null label
teach nothing; an empty table gives no rows; further columns pass through.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from captionloom.llm.common import safe_name

ORDERS = (1, 2, 3)
LANDMARKS, LANDMARK_CHARS, TRAIN_ROWS, RIDGE = 160, 6_000, 4_000, 0.05
#: Texts that a label has as landmarks at least, if it has as many.
FEWEST = 8
#: Texts of a matrix product; how sharply scores tell the languages apart.
BATCH, SHARPNESS = 128, 8.0
UNKNOWN = "und"
_UPPER = bytes(range(65, 91))
_LETTERS = bytes(b + 32 if b in _UPPER else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_LETTER = regex.compile(r"\p{L}")


def grams(text: str) -> np.ndarray:
    """Distinct n-grams of a text as sorted numbers; the order n is in the highest bits."""
    a = np.frombuffer(text.encode().translate(_LETTERS), np.uint8).astype(np.uint32)
    one, two = a, (a[:-1] << 8) | a[1:]
    three = np.unique((two[:-1] << 8) | a[2:])
    # All pairs but the last begin a triple, all bytes but the last begin a pair.
    two = np.unique(np.concatenate([three >> 8, two[-1:]]))
    one = np.unique(np.concatenate([two >> 8, one[-1:]]))
    return np.concatenate([one | (1 << 24), two | (2 << 24), three | (3 << 24)])


class Landmarks:
    """Landmark texts as a matrix from n-grams to kernel values."""

    def __init__(self, texts: list[str]):
        sets = [grams(t) for t in texts]
        self.vocabulary = np.unique(np.concatenate(sets))
        self.matrix = self._rows(sets).T.copy()

    def _rows(self, sets: list[np.ndarray]) -> np.ndarray:
        """Presence of the vocabulary's n-grams, over the root of each order's number of n-grams in the whole text."""
        out = np.zeros((len(sets), len(self.vocabulary)), np.float32)
        for k, s in enumerate(sets):
            order = s >> 24
            weight = 1 / np.sqrt(np.bincount(order, minlength=max(ORDERS) + 1) * len(ORDERS))[order] if len(s) else np.zeros(0)
            at = np.searchsorted(self.vocabulary, s)
            at[at == len(self.vocabulary)] = 0
            here = self.vocabulary[at] == s
            out[k, at[here]] = weight[here]
        return out

    def kernel(self, texts: list[str]) -> np.ndarray:
        """One batched product: texts by landmarks."""
        return self._rows([grams(t) for t in texts]) @ self.matrix


class Model:
    def __init__(self, labels: list[str], landmarks: Landmarks | None, weights: np.ndarray | None):
        self.labels, self.landmarks, self.weights = labels, landmarks, weights

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        known = [k for k, t in enumerate(texts) if t and _LETTER.search(t)] if self.labels else []
        for lo in range(0, len(known), BATCH):
            own = known[lo : lo + BATCH]
            values = self.landmarks.kernel([texts[k] for k in own]) @ self.weights[:-1] + self.weights[-1]
            best = values.argmax(axis=1)
            shares = np.exp(SHARPNESS * (values - values.max(axis=1, keepdims=True)))
            for k, b, s in zip(own, best, 1 / shares.sum(axis=1), strict=True):
                names[k], scores[k] = self.labels[b], float(s)
        return names, scores


def _root_inverse(k: np.ndarray) -> np.ndarray:
    values, vectors = np.linalg.eigh(k.astype(float))
    keep = values > 1e-6 * values.max()
    return vectors[:, keep] / np.sqrt(values[keep])


def _sampled(rows: DataFrame, counts: dict[str, int], per_label: int, seed: int) -> DataFrame:
    share = F.create_map(*[F.lit(x) for label, n in counts.items() for x in (label, min(1.0, per_label / n))])
    unit = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 40)) / float(1 << 40)
    return rows.where(unit < share[F.col("label")])


def train(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", landmarks: int = LANDMARKS, train_rows: int = TRAIN_ROWS) -> Model:
    """Learns from rows with a label for which `learn` (an expression of the id) holds."""
    rows = docs.where(learn).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("label")).where(F.col("label").isNotNull() & F.col("text").rlike(r"\p{L}"))
    short = rows.where(F.length("text") <= LANDMARK_CHARS)
    count = lambda df: {r.label: r.n for r in df.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    whole, fit = count(rows), count(short)
    if not whole:
        return Model([], None, None)
    labels = sorted(whole)
    texts = {r.text for r in _sampled(short, fit, max(8, landmarks // len(fit)), 3).select("text").distinct().collect()} if fit else set()
    poor = [label for label in labels if fit.get(label, 0) < min(FEWEST, whole[label])]
    if poor:
        order = Window.partitionBy("label").orderBy(F.length("text"), "text")
        shortest = rows.where(F.col("label").isin(poor)).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= FEWEST)
        texts |= {r.text for r in shortest.select("text").collect()}
    chosen = sorted(texts)
    if not chosen:
        chosen = [r.text for r in short.select("text").limit(1).collect()]
    marks = Landmarks(chosen)
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(marks))
    sample = _sampled(rows, whole, max(50, train_rows // len(labels)), 4).select("label", "text")

    def kernels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Landmarks = pickle.loads(sent.value)
        for whole_batch in batches:
            for lo in range(0, whole_batch.num_rows, BATCH):
                batch = whole_batch.slice(lo, BATCH)
                made = own.kernel(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array([x.tobytes() for x in made], pa.binary())], names=["label", "kernel"])

    got = sorted((r.label, bytes(r.kernel)) for r in sample.mapInArrow(kernels, "label string, kernel binary").collect())
    if not got:
        return Model([], None, None)
    k = np.stack([np.frombuffer(x, np.float32) for _, x in got]).astype(float)
    root = _root_inverse(marks.kernel(chosen))
    features = np.hstack([k @ root, np.ones((len(k), 1))])
    y = np.array([[1.0 if label == own else -1.0 for own in labels] for label, _ in got])
    # Languages count alike, however many rows each has.
    weight = 1 / np.array([sum(label == x for x, _ in got) for label, _ in got])[:, None]
    penalty = RIDGE * np.eye(features.shape[1]) * weight.sum() / len(got)
    penalty[-1, -1] = 0
    w = np.linalg.solve(features.T @ (features * weight) + penalty, features.T @ (y * weight))
    return Model(labels, marks, np.vstack([root @ w[:-1], w[-1:]]).astype(np.float32))


def identify(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """Adds the predicted language and its score (0 to 1)."""
    fields = [T.StructField(safe_name(docs, lang_col), T.StringType()), T.StructField(safe_name(docs, score_col), T.DoubleType())]
    # Landmarks are a bounded sample of bounded texts, and so is the model.
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = pickle.loads(sent.value)
        for whole in batches:
            for lo in range(0, whole.num_rows, BATCH):
                batch = whole.slice(lo, BATCH)
                names, scores = own.predict(batch.column(text_col).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, *[f.name for f in fields]])

    return docs.mapInArrow(run, T.StructType(docs.schema.fields + fields))
