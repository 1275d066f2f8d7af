"""Quality classifier (operator 9): random Fourier features over document statistics, ridge, isotonic calibration.

1. `statistics`: a vector of statistics of each whole text (lengths, character classes, repetition of words and lines).
2. Standardised with the training rows' means and deviations, it goes through D random Fourier features, which approximate a
   Gaussian kernel of width WIDTH.
3. Ridge: every task sums its rows' part of the normal equations; Spark adds the parts entry by entry, so the
   driver gets one D x D system however many rows and partitions there are.
4. Isotonic calibration: scores of the training rows are counted in BINS bins by Spark; pool-adjacent-violators runs over the bins.

Defined cases: null texts count as empty; empty texts get a score like any other. Labels that are null are ignored, repeated
labels count each. Without labels the score is 0.5. Repeated rows give a row each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.llm.calibrate import calibrated, isotonic
from stratiform.llm.common import LOWER, SPACED, columns_of, freed, offsets_of, range_keys, text_slices, types_of, words_of, written

FOURIER = 128
WIDTH = 3.0
RIDGE = 1e-3
BINS = 2000
SEED = 9

_CLASSES = {
    "upper": [*range(65, 91)], "lower": [*range(97, 123)], "digit": [*range(48, 58)], "space": [32, 9, 11, 12, 13], "newline": [10],
    "stop": [46, 44, 59, 58], "bang": [33, 63], "quote": [34, 39, 40, 41, 45], "bar": [124], "symbol": [35, 36, 37, 38, 42, 43, 47, 60, 61, 62, 64, 91, 92, 93, 94, 95, 96, 123, 125, 126], "high": [*range(128, 256)],
}
_TABLES = {name: np.isin(np.arange(256), found) for name, found in _CLASSES.items()}
NAMES = ("log_bytes", "log_words", *_CLASSES, "word_length", "long_words", "caps_words", "marked_words", "distinct_words", "top_word", "stutter", "distinct_lines", "line_words")


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(documents, len(NAMES)) for concatenated UTF-8 texts."""
    n = np.diff(offsets)
    size = np.maximum(n, 1)
    starts, stops, first = words_of(data, offsets, SPACED)
    words = np.diff(first)
    w = np.maximum(words, 1)
    out = [np.log1p(n), np.log1p(words)]
    out += [_sums(table[data], offsets) / size for table in _TABLES.values()]
    length = stops - starts
    h = range_keys(LOWER[data], starts, stops)
    letters = _TABLES["upper"] | _TABLES["lower"] | _TABLES["high"]
    upper = np.concatenate(([0], np.cumsum(_TABLES["upper"][data])))
    caps = (length > 1) & (upper[stops] - upper[starts] >= 0.8 * length) if len(starts) else np.zeros(0, bool)
    plain = letters | _TABLES["digit"] | _TABLES["stop"]
    marked = ~plain[data[stops - 1]] if len(starts) else np.zeros(0, bool)
    same = np.concatenate(([False], h[1:] == h[:-1])) if len(h) else np.zeros(0, bool)
    if len(same):
        heads = first[:-1][first[:-1] < len(h)]
        same[heads] = False
    out += [_sums(length, first) / w / 10, _sums(length > 14, first) / w, _sums(caps, first) / w, _sums(marked, first) / w]
    lines, line_ends, line_first = words_of(data, offsets, _NOT_NEWLINE)
    line_hash = range_keys(data, lines, line_ends)
    distinct, top, distinct_lines = np.zeros(len(n)), np.zeros(len(n)), np.zeros(len(n))
    for i in range(len(n)):
        if words[i]:
            counts = np.unique(h[first[i] : first[i + 1]], return_counts=True)[1]
            distinct[i], top[i] = len(counts) / words[i] ** 0.8, counts.max() / words[i]
        k = line_first[i + 1] - line_first[i]
        if k:
            distinct_lines[i] = len(np.unique(line_hash[line_first[i] : line_first[i + 1]])) / k
    out += [distinct, top, _sums(same, first) / w, distinct_lines, np.log1p(words / np.maximum(np.diff(line_first), 1))]
    return np.stack(out, axis=1)


_NOT_NEWLINE = np.ones(256, bool)
_NOT_NEWLINE[10] = False


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in text_slices(batch, "text", 1_000_000):
            part = batch.slice(a, b - a)
            offsets, data = offsets_of(part.column(1))
            x = statistics(data, offsets).astype(np.float32)
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], x.reshape(-1))
            yield pa.RecordBatch.from_arrays([part.column(0), lists, *part.columns[2:]], names=["doc_id", "x", *part.schema.names[2:]])


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


class Model:
    """Standardisation, the Fourier features' draw, ridge weights and calibration points: a few hundred KB."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray) -> None:
        rng = np.random.default_rng(SEED)
        self.mean, self.deviation = mean, np.where(deviation > 1e-9, deviation, 1.0)
        self.w = rng.normal(size=(len(mean), FOURIER)) / WIDTH
        self.b = rng.uniform(0, 2 * np.pi, FOURIER)
        self.weights = np.zeros(FOURIER + 1)
        self.points = (np.array([0.0]), np.array([0.5]))

    def fourier(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.deviation, -6, 6)
        f = np.cos(z @ self.w + self.b) * np.sqrt(2 / FOURIER)
        return np.hstack([f, np.ones((len(f), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return calibrated(self.raw(x), self.points)


def fit(train: DataFrame) -> Model:
    """A model of rows (x array<float>, y int)."""
    width = len(NAMES)
    sums = train.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect()
    mean, deviation = np.zeros(width), np.ones(width)
    for r in sums:
        mean[r["i"]], deviation[r["i"]] = r["m"], r["s"]
    model = Model(mean, deviation)
    if not sums:
        return model
    size = FOURIER + 1
    upper = np.triu_indices(size)

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, c = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            f = model.fourier(matrix(batch.column(0), width))
            a += f.T @ f
            c += f.T @ batch.column(1).to_numpy(zero_copy_only=False).astype(float)
        values = np.concatenate([a[upper], c])
        yield pa.RecordBatch.from_arrays([np.arange(len(values)), values], names=["k", "v"])

    parts = train.mapInArrow(freed(equations), "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    values = np.zeros(len(upper[0]) + size)
    for r in parts:
        values[r["k"]] = r["v"]
    a = np.zeros((size, size))
    a[upper] = values[: len(upper[0])]
    a = a + np.triu(a, 1).T
    penalty = np.eye(size) * RIDGE * max(a[-1, -1], 1.0)
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(a + penalty, values[len(upper[0]) :])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, p = np.zeros(BINS, np.int64), np.zeros(BINS, np.int64)
        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            k = np.clip(((model.raw(matrix(batch.column(0), width)) + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
            n += np.bincount(k, minlength=BINS)
            p += np.bincount(k, weights=y, minlength=BINS).astype(np.int64)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([at, n[at], p[at]], names=["k", "n", "p"])

    bins = sorted(train.mapInArrow(freed(binned), "k long, n long, p long").groupBy("k").agg(F.sum("n"), F.sum("p")).collect())
    k, n, p = np.array(bins, float).T
    model.points = isotonic((k + 0.5) * 2 / BINS - 0.5, p, n)
    return model


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column | None = None, beside: Sequence[str] = ()) -> DataFrame:
    """doc_id, score for each row of docs, with its columns `beside` as _<name>. labels: doc_id, quality (0 or 1); `learn` says which of them to learn from, by doc_id."""
    stats = written(columns_of(docs, beside, doc_id="long", text="string").mapInArrow(freed(_statistics), "doc_id long, x array<float>" + types_of(docs, beside)), "statistics")
    known = columns_of(labels, doc_id="long", quality="int").filter("quality in (0, 1)")
    known = known.filter(learn) if learn is not None else known
    train = written(stats.join(known, "doc_id").select("x", F.col("quality").alias("y")), "quality-train")
    shared = docs.sparkSession.sparkContext.broadcast(fit(train))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            score = pa.array(model.score(matrix(batch.column(1), len(NAMES))))
            yield pa.RecordBatch.from_arrays([batch.column(0), score, *batch.columns[2:]], names=["doc_id", "score", *batch.schema.names[2:]])

    return stats.mapInArrow(freed(run), "doc_id long, score double" + types_of(docs, beside))
