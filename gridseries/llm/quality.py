"""Quality classifier: Naive Bayes features under a linear support vector machine.

A text is the set of its n-grams (words, word pairs, and runs of word shapes), hashed into a fixed
number of slots. Each indicator is scaled by its class log-count ratio, a hinge-loss model is fitted
on the scaled indicators by dual coordinate descent, and a logistic curve over held-back margins of
the fitting sample turns margins into probabilities.

Only the fit is bounded: at most ``MAX_FIT_ROWS`` labelled rows, the ones whose hashed ids are
smallest, and of each the indicator slots alone go to the driver, all of them: as numbers, or as a
bitmap where that is shorter, so a row of any length takes 32 KB at most. Every row is scored, in tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.llm.common import text_key

#: Bound of the fitting sample, in labelled rows.
MAX_FIT_ROWS = 8000
SLOTS = 1 << 18
THRESHOLD = 0.3

_SHAPES = [(regex.compile(p), r) for p, r in ((r"\p{Lu}+", "A"), (r"(?:(?!A)\p{L})+", "a"), (r"\p{N}+", "0"), (r"(.)\1+", r"\1"))]

#: The same for ASCII words, as a table and runs.
_ASCII = {c: "A" if chr(c).isupper() else "a" if chr(c).isalpha() else "0" if chr(c).isdigit() else chr(c) for c in range(128)}
_RUNS = re.compile(r"(?s)(.)\1+")


def _shape(word: str) -> str:
    """Runs of upper-case letters, other letters, digits and each further character, one character a run."""
    if word.isascii():
        return _RUNS.sub(r"\1", word.translate(_ASCII))
    for pattern, run in _SHAPES:
        word = pattern.sub(run, word)
    return word


def pack_slots(slots: np.ndarray) -> bytes:
    """Sorted slots as bytes: one bit a slot of the whole range where that is shorter than the numbers."""
    if len(slots) * 32 < SLOTS:
        return b"n" + slots.astype("<i4").tobytes()
    bits = np.zeros(SLOTS, dtype=np.uint8)
    bits[slots] = 1
    return b"b" + np.packbits(bits).tobytes()


def unpack_slots(packed: bytes) -> np.ndarray:
    if packed[:1] == b"n":
        return np.frombuffer(packed, dtype="<i4", offset=1)
    return np.flatnonzero(np.unpackbits(np.frombuffer(packed, dtype=np.uint8, offset=1))).astype(np.int32)


class PackedRows:
    """Slot arrays of the fitting sample, unpacked one at a time."""

    def __init__(self, packed: list[bytes]):
        self.packed = packed

    def __len__(self) -> int:
        return len(self.packed)

    def __getitem__(self, i: int) -> np.ndarray:
        return unpack_slots(self.packed[i])

    def __iter__(self) -> Iterator[np.ndarray]:
        return map(unpack_slots, self.packed)

    def take(self, rows: np.ndarray) -> PackedRows:
        return PackedRows([self.packed[i] for i in rows])


class Slots:
    """Maps texts to arrays of indicator slots; remembers a bounded number of words."""

    def __init__(self, most_words: int = 300_000):
        self.most_words = most_words
        self.words: dict[str, int] = {}

    def _word(self, word: str) -> int:
        """Hash of the lower-case word in the upper, of its shape in the lower 32 bits."""
        if len(self.words) >= self.most_words:
            self.words.clear()
        h = xxhash.xxh32_intdigest(word.lower().encode("utf-8", "surrogatepass"))
        s = xxhash.xxh32_intdigest(_shape(word).encode("utf-8", "surrogatepass"))
        self.words[word] = out = (h << 31 | s >> 1) & 0x7FFFFFFFFFFFFFFF
        return out

    def of(self, text: str | None) -> np.ndarray:
        """Sorted distinct slots; the empty array for a null or wordless text."""
        words = (text or "").replace("\n", " \n ").split(" ")
        have, make = self.words.get, self._word
        codes = np.fromiter((have(w) or make(w) for w in words if w), dtype=np.int64)
        if not len(codes):
            return np.empty(0, dtype=np.int32)
        word, shape = (codes >> 31).astype(np.uint64), (codes & 0x7FFFFFFF).astype(np.uint64)
        same = np.zeros(len(codes), dtype=np.uint64)
        same[1:] = word[1:] == word[:-1]
        shape = shape * np.uint64(2) + same
        mix = np.uint64(0x9E3779B97F4A7C15)
        parts = [word * mix, (shape + np.uint64(1 << 40)) * mix]
        if len(codes) > 1:
            parts.append((word[1:] * np.uint64(31) + word[:-1] + np.uint64(1 << 41)) * mix)
            parts.append((shape[1:] * np.uint64(31) + shape[:-1] + np.uint64(1 << 42)) * mix)
        if len(codes) > 2:
            parts.append((shape[2:] * np.uint64(961) + shape[1:-1] * np.uint64(31) + shape[:-2] + np.uint64(1 << 43)) * mix)
        return np.unique((np.concatenate(parts) >> np.uint64(46)).astype(np.int32))


@dataclass
class Model:
    """Weights per slot (log-count ratio times hinge weight), bias, and the curve's two numbers."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, slots: np.ndarray) -> float:
        return float(self.weights[slots].sum(dtype=np.float64) / np.sqrt(max(1, len(slots)))) + self.bias

    def score(self, slots: np.ndarray) -> float:
        z = np.clip(self.slope * self.margin(slots) + self.offset, -500, 500)
        return float(1 / (1 + np.exp(-z)))


def log_count_ratio(rows: PackedRows, labels: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    counts = np.full((2, SLOTS), smooth)
    for slots, label in zip(rows, labels, strict=True):
        counts[int(label), slots] += 1
    totals = counts.sum(axis=1, keepdims=True)
    return np.log(counts[1] / totals[1]) - np.log(counts[0] / totals[0])


def dual_coordinate_descent(
    rows: PackedRows, labels: np.ndarray, scale: np.ndarray, cost: float = 1.0, epochs: int = 12, seed: int = 7
) -> tuple[np.ndarray, float]:
    """Weights over scaled indicators and the bias of the L1-loss support vector machine.

    Each row is scaled to 1 / sqrt(number of indicators). Classes weigh alike.
    """
    y = np.where(labels == 1, 1.0, -1.0)
    share = np.array([max(1, (y < 0).sum()), max(1, (y > 0).sum())])
    most = cost * len(y) / 2 / share[(y > 0).astype(int)]
    norm = np.array([1 / np.sqrt(max(1, len(r))) for r in rows])
    diagonal = np.array([float(scale[r] @ scale[r]) * n * n + 1.0 for r, n in zip(rows, norm, strict=True)])
    weights, bias, alpha = np.zeros(SLOTS), 0.0, np.zeros(len(rows))
    shuffle = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in shuffle.permutation(len(rows)):
            row = rows[i]
            values = scale[row] * norm[i]
            gradient = y[i] * (weights[row] @ values + bias) - 1
            new = min(max(alpha[i] - gradient / diagonal[i], 0.0), most[i])
            step = (new - alpha[i]) * y[i]
            if step:
                weights[row] += step * values
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    return weights, bias


def _curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve that fits labels to margins (Newton steps)."""
    spread = margins.std() or 1.0
    x, n1, n0 = margins / spread, labels.sum(), (1 - labels).sum()
    t = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -50, 50)))
        w, g = p * (1 - p), t - p
        h = np.array([[w @ (x * x) + 1e-6, w @ x], [w @ x, w.sum() + 1e-6]])
        da, db = np.linalg.solve(h, [g @ x - 1e-6 * a, g.sum()])
        a, b = a + np.clip(da, -2, 2), b + np.clip(db, -2, 2)
        if abs(da) + abs(db) < 1e-8:
            break
    return float(max(a, 0.0) / spread), float(b)


def fit_rows(rows: PackedRows, labels: np.ndarray, folds: int = 3) -> Model:
    """Model of labelled slot arrays. With one class or none the score is the smoothed share of label 1."""
    n1, n0 = int((labels == 1).sum()), int((labels == 0).sum())
    if min(n1, n0) < folds:
        return Model(np.zeros(SLOTS, np.float32), 0.0, 0.0, float(np.log((n1 + 1) / (n0 + 1))))
    margins = np.zeros(len(rows))
    fold = np.zeros(len(rows), dtype=int)
    for k in (0, 1):
        own = np.flatnonzero(labels == k)
        fold[own] = np.arange(len(own)) % folds
    fitted = None
    for k in [*range(folds), None]:  # the last fit uses all rows
        use = np.flatnonzero(fold != k) if k is not None else np.arange(len(rows))
        part = rows.take(use)
        scale = log_count_ratio(part, labels[use])
        weights, bias = dual_coordinate_descent(part, labels[use], scale)
        fitted = Model((weights * scale).astype(np.float32), bias, 1.0, 0.0)
        if k is not None:
            for i in np.flatnonzero(fold == k):
                margins[i] = fitted.margin(rows[i])
    fitted.slope, fitted.offset = _curve(margins, labels)
    return fitted


def held_out(doc_id: Column) -> Column:
    """True where the crc32 of the id as text is divisible by 5; a null id is not held out."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = MAX_FIT_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled documents that are not held out.

    Labels of one id are averaged (a half counts as 1); null ids and labels are left out. Of
    documents that repeat an id the one is taken whose text has the least hash.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg((F.avg(label_col) >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(max_rows)
    )

    def slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = Slots()
        for batch in batches:
            yield pd.DataFrame(
                {"doc_id": batch.doc_id, "label": batch.label,
                 "slots": [pack_slots(make.of(t)) for t in batch.text]}
            )

    # at most max_rows ids and labels are broadcast; of rows that repeat an id one stays, before anything is sent
    sample = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    sample = sample.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(text_key(F.col("text")), "text")).alias("text"))
    got = sample.mapInPandas(slots, "doc_id long, label int, slots binary").toPandas().sort_values("doc_id")
    return fit_rows(PackedRows([bytes(b) for b in got.slots]), got.label.to_numpy(dtype=int))


def score_column(model: Model, text: Column) -> Column:
    """Score of a text as a double; the model is broadcast (one float per slot, a fixed size)."""
    shared = SparkSession.active().sparkContext.broadcast((model.weights, model.bias, model.slope, model.offset))

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        make, fitted = Slots(), Model(*shared.value)
        for batch in batches:
            yield pd.Series([fitted.score(make.of(t)) for t in batch], dtype=float)

    return of(text)


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Null and empty texts get the score of a text without n-grams. Repeated rows stay repeated, null
    ids stay null, other columns are ignored. Without usable labels every score is 0.5.
    """
    model = fit(docs, labels, label_col)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with their columns."""
    model = fit(docs, labels)
    score = score_column(model, F.col("text"))
    return docs.where(score >= threshold)
