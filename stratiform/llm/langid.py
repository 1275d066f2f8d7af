"""Language identification (operator 2): interpolated Kneser-Ney character models in sorted hash arrays.

A text is lower-cased, every run of non-letters becomes one space, and characters are folded to 16 bits, so that four
characters make one 64-bit n-gram key. Letters beyond the first 65,536 code points (rare ideographs, historic scripts) share the
8,448 places of surrogates and private characters, which no other letter has. Training counts the 4-grams of every training text by language: tasks add up counts locally and Spark
sums them by key. From the distinct 4-grams follow the continuation counts of all lower orders, and

    p(w|h) = max(c(hw) - D, 0) / c(h) + D * types(h) / c(h) * p(w|h')        D = n1 / (n1 + 2 n2) for each order

The model is, for each order, an array of hashed keys in sorted order (the hash is spread evenly, so the top bits index it) with a row of
log-probabilities, one per language, of each n-gram that any language has, and another with the back-off weights of contexts.
A text's score for a language is its cross-entropy per character; the lowest wins. Whether to trust it is calibrated: isotonic
regression of "was right" on the margin to the runner-up over a fold of the training rows (by hash of the text, bounded), which
a model of the other rows predicts; `rejected` marks predictions whose calibrated score is below REJECT.

No count is left out. Up to MAX_CELLS (distinct 4-grams times languages) the model is broadcast; a larger one stays in written tables
(`WrittenModel`): Spark takes continuation counts, discounts and totals by windows and groupings, and the texts' distinct 4-grams are
joined with it. Both give the same probabilities. Counting covers all training rows, and predictions read whole texts.

Defined cases: null texts and texts without a letter are `und` with score 0; so is everything if no language was learned.
Repeated rows give a row each; extra columns are ignored. Ties go to the language first in the alphabet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratiform.llm.calibrate import calibrated, isotonic
from stratiform.llm.common import U64, columns_of, mix64, text_slices, written

ORDER = 4
#: Distinct 4-grams times languages of a model that is broadcast; a larger one is joined.
MAX_CELLS = 8_000_000
#: Training rows that calibrate the margin: one in FOLDS, but about CALIBRATION_ROWS at most.
FOLDS, CALIBRATION_ROWS = 10, 20_000
#: Characters times languages whose log-probabilities are held at once.
HELD_CELLS = 4_000_000
REJECT = 0.5
BINS = 400
SPACE = 32
_FOLD: list[np.ndarray] = []


def fold() -> np.ndarray:
    """For each code point the 16-bit character that stands for it: a letter in lower case, or a space."""
    if not _FOLD:
        table = np.full(0x110000, SPACE, np.uint16)
        for c in range(0x110000):
            s = chr(c)
            if s.isalpha():
                low = ord(s.lower()[0])
                table[c] = low if low < 0x10000 else 0xD800 + (low - 0x10000) % 8448
        _FOLD.append(table)
    return _FOLD[0]


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised characters of all texts, the text of each, and each text's number of letters. Every text begins with a space."""
    lengths = np.array([len(t) + 1 if t else 1 for t in texts], np.int64)
    points = np.frombuffer("".join([f" {t}" if t else " " for t in texts]).encode("utf-32-le", "surrogatepass"), np.uint32)
    c = fold()[points]
    doc = np.repeat(np.arange(len(texts)), lengths)
    letters = np.bincount(doc[c != SPACE], minlength=len(texts))
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != SPACE) | (c[:-1] != SPACE) | (doc[1:] != doc[:-1])
    return c[keep], doc[keep], letters


def grams(c: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each character but a text's first the 4-gram that it ends; before a text's start there are spaces."""
    key = c.astype(U64)
    same = np.ones(len(c), bool)
    for i in range(1, ORDER):
        same[i:] &= doc[i:] == doc[:-i]
        same[:i] = False
        before = np.full(len(c), SPACE, U64)
        before[i:] = np.where(same[i:], c[:-i], SPACE)
        key |= before << U64(16 * i)
    inside = np.concatenate(([False], doc[1:] == doc[:-1])) if len(c) else np.zeros(0, bool)
    return np.where(inside, key, U64(0))


def _merge(old: tuple, new: list) -> tuple:
    keys, counts = np.concatenate([old[0], *(k for k, _ in new)]), np.concatenate([old[1], *(n for _, n in new)])
    u, at = np.unique(keys, return_inverse=True)
    return u, np.bincount(at, weights=counts, minlength=len(u)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[str, bool], tuple] = {}
    waiting: dict[tuple[str, bool], list] = {}
    none = (np.zeros(0, U64), np.zeros(0, np.int64))
    for batch in batches:
        for a, b in text_slices(batch, "text", 1_000_000):
            part = batch.slice(a, b - a)
            kinds = list(zip(part.column(1).to_pylist(), part.column(2).to_pylist()))
            number = {k: i for i, k in enumerate(sorted(set(kinds)))}
            of = np.array([number[k] for k in kinds])
            c, doc, _ = characters(part.column(0).to_pylist())
            g = grams(c, doc)
            for kind, i in number.items():
                mine = (of == i)[doc] & (g != 0)
                waiting.setdefault(kind, []).append(np.unique(g[mine], return_counts=True))
                if sum(len(k) for k, _ in waiting[kind]) > 1_000_000:
                    sums[kind] = _merge(sums.get(kind, none), waiting.pop(kind))
    for lang, held in sorted({*waiting, *sums}):
        keys, counts = _merge(sums.pop((lang, held), none), waiting.pop((lang, held), []))
        for i in range(0, len(keys), 50_000):
            k, n = keys[i : i + 50_000], counts[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k.view(np.int64)), pa.array(n), pa.array(n * (not held))], names=["lang", "gram", "n", "rest"])


def gram_counts(train: DataFrame) -> DataFrame:
    """lang, gram, n over all rows of train (text, lang, held), rest over those that are not held."""
    rows = train.select("text", "lang", "held").mapInArrow(_counted, "lang string, gram long, n long, rest long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("rest").alias("rest"))


class HashArray:
    """Keys hashed and sorted, found through an index of their top bits; rows of values beside them."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        h = mix64(keys)
        order = np.argsort(h)
        self.hashes, self.values = h[order], values[order]
        self.shift = U64(64 - max(1, int(len(keys)).bit_length()))
        top = (self.hashes >> self.shift).astype(np.int64)
        self.index = np.searchsorted(top, np.arange((1 << 64 - int(self.shift)) + 1)).astype(np.int32)
        self.deepest = int(np.diff(self.index).max()) if len(keys) else 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Rows of the keys, -1 for those that are absent."""
        h = mix64(keys)
        top = (h >> self.shift).astype(np.int64)
        at, end = self.index[top], self.index[top + 1]
        out = np.full(len(keys), -1, np.int32)
        todo = np.flatnonzero(at < end)
        for _ in range(self.deepest):
            if not len(todo):
                break
            hit = self.hashes[at[todo]] == h[todo]
            out[todo[hit]] = at[todo[hit]]
            todo = todo[~hit]
            at[todo] += 1
            todo = todo[at[todo] < end[todo]]
        return out


def discount(n1: int, n2: int) -> float:
    return min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 else 0.5


def decided(h: np.ndarray, letters: np.ndarray, langs: list[str], points: tuple) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, calibrated score and margin of each text from its cross-entropies."""
    best = h.argmin(axis=1)
    margin = np.partition(h, 1, axis=1)[:, 1] - h.min(axis=1) if len(langs) > 1 else np.full(len(h), 1.0)
    score = np.where(letters > 0, calibrated(margin, points), 0.0)
    return [langs[b] if k else "und" for b, k in zip(best, letters)], score, np.where(letters > 0, margin, 0.0)


class Model:
    """Log-probabilities of n-grams of each order and back-off weights of contexts, for all languages."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
        self.langs = sorted(counts)
        self.points = (np.array([0.0]), np.array([0.5]))
        per_order: list[dict] = [{} for _ in range(ORDER + 1)]
        for lang in self.langs:
            keys, n = counts[lang]
            for order in range(ORDER, 0, -1):
                per_order[order][lang] = (keys, n.astype(np.float64))
                # continuation counts: how many characters precede each shorter n-gram
                keys, n = np.unique(keys & U64((1 << 16 * (order - 1)) - 1), return_counts=True)
        vocabulary = len(np.unique(np.concatenate([per_order[1][lang][0] for lang in self.langs]))) + 1 if self.langs else 1
        self.floor = np.full(len(self.langs), 1.0 / vocabulary)
        self.orders: list[tuple[HashArray, HashArray] | None] = [None]
        for order in range(1, ORDER + 1):
            seen = np.unique(np.concatenate([per_order[order][lang][0] for lang in self.langs])) if self.langs else np.zeros(0, U64)
            contexts = np.unique(seen >> U64(16))
            p, back = np.zeros((len(seen), len(self.langs))), np.ones((len(contexts), len(self.langs)))
            for i, lang in enumerate(self.langs):
                keys, n = per_order[order][lang]
                n1, n2 = (n == 1).sum(), (n == 2).sum()
                d = discount(n1, n2)
                at = np.searchsorted(contexts, keys >> U64(16))
                total, types = np.bincount(at, weights=n, minlength=len(contexts)), np.bincount(at, minlength=len(contexts))
                has = total > 0
                back[has, i] = d * types[has] / total[has]
                p[np.searchsorted(seen, keys), i] = (n - d) / total[at]
            lower = self._probability(order - 1, seen & U64((1 << 16 * (order - 1)) - 1))
            p += back[np.searchsorted(contexts, seen >> U64(16))] * lower
            self.orders.append((HashArray(seen, p), HashArray(contexts, back)))
        self.logs = HashArray.__new__(HashArray)
        if self.langs:
            top = self.orders[ORDER][0]
            self.logs.__dict__.update(top.__dict__)
            self.logs.values = np.log(top.values).astype(np.float32)

    def _probability(self, order: int, keys: np.ndarray) -> np.ndarray:
        """p(w|h) of n-grams of an order, seen or not."""
        if order == 0:
            return np.broadcast_to(self.floor, (len(keys), len(self.langs)))
        table, contexts = self.orders[order]
        row = table.find(keys)
        out = table.values[row]
        gone = np.flatnonzero(row < 0)
        if len(gone):
            lower = self._probability(order - 1, keys[gone] & U64((1 << 16 * (order - 1)) - 1))
            at = contexts.find(keys[gone] >> U64(16))
            weight = np.where((at >= 0)[:, None], contexts.values[at], 1.0)
            out[gone] = weight * lower
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character, a row for each text and a column for each language; and letters of each text."""
        c, doc, letters = characters(texts)
        g = grams(c, doc)
        every = np.flatnonzero(g)
        sums = np.zeros((len(texts), len(self.langs)))
        step = max(1, HELD_CELLS // len(self.langs))
        for i in range(0, len(every), step):
            at = every[i : i + step]
            row = self.logs.find(g[at])
            logs = self.logs.values[row]
            gone = np.flatnonzero(row < 0)
            if len(gone):
                logs[gone] = np.log(self._probability(ORDER, g[at[gone]]))
            low, high = doc[at[0]], doc[at[-1]] + 1
            sums[low:high] += np.stack([np.bincount(doc[at] - low, weights=logs[:, k], minlength=high - low) for k in range(len(self.langs))], axis=1)
        n = np.bincount(doc[every], minlength=len(texts))
        return -sums / np.maximum(n, 1)[:, None], letters

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, calibrated score and margin of each text."""
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        return decided(*self.entropies(texts), self.langs, self.points)


def _dense(lists: pa.Array, width: int, absent: float) -> np.ndarray:
    """A row for each list of (i, v) pairs, with v at place i."""
    out = np.full((len(lists), width), absent)
    i, v = lists.flatten().flatten()
    out[np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy()), i.to_numpy()] = v.to_numpy()
    return out


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (key, text) the distinct 4-grams of each text and how often they occur; a text without any gives one row with none."""
    at = TaskContext.get().partitionId() << 33
    for batch in batches:
        for a, b in text_slices(batch, "text", 1_000_000):
            part = batch.slice(a, b - a)
            c, doc, letters = characters(part.column(1).to_pylist())
            g = grams(c, doc)
            n = np.bincount(doc[g != 0], minlength=len(part))
            rows, keys, times = [np.flatnonzero(n == 0)], [np.zeros((n == 0).sum(), U64)], [np.zeros((n == 0).sum(), np.int64)]
            edges = np.searchsorted(doc, np.arange(len(part) + 1))
            for i in np.flatnonzero(n):
                mine = g[edges[i] : edges[i + 1]]
                u, k = np.unique(mine[mine != 0], return_counts=True)
                rows.append(np.full(len(u), i))
                keys.append(u)
                times.append(k)
            row, key, m = np.concatenate(rows), np.concatenate(keys), np.concatenate(times)
            for i in range(0, len(row), 50_000):
                r, k = row[i : i + 50_000], key[i : i + 50_000]
                arrays = [part.column(0).take(pa.array(r)), r + at, letters[r], n[r], pa.array(k.view(np.int64), mask=k == 0), m[i : i + 50_000]]
                yield pa.RecordBatch.from_arrays([pa.array(x) if isinstance(x, np.ndarray) else x for x in arrays], names=["key", "row", "letters", "n", "gram", "m"])
            at += len(part)


class WrittenModel:
    """The probabilities of Model for counts of any size, as tables in the shared folder: for each order the n-grams and the contexts,

    each with a list of (language, value) of the languages that have it. A list is bounded by the languages, a window by the 16-bit characters.
    Texts meet them by n-gram: a hot n-gram is one row on the tables' side, and its many rows on the texts' side are left to the adaptive split of skewed joins.
    """

    def __init__(self, counts: DataFrame, langs: list[str]) -> None:
        self.langs = langs
        self.points = (np.array([0.0]), np.array([0.5]))
        self.orders: list[tuple[DataFrame, DataFrame] | None] = [None] * (ORDER + 1)
        for order in range(ORDER, 0, -1):
            ones = {r["lang"]: (r["n1"], r["n2"]) for r in counts.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2")).collect()}
            d = counts.sparkSession.createDataFrame([(lang, i, discount(*ones[lang])) for i, lang in enumerate(langs)], "lang string, i int, d double")
            rows = counts.withColumn("context", F.shiftrightunsigned("gram", 16)).join(d, "lang")
            pair = lambda v: F.collect_list(F.struct("i", v.alias("v")))
            p = (F.col("n") - F.col("d")) / F.sum("n").over(W.partitionBy("lang", "context"))
            seen = rows.withColumn("p", p).groupBy("gram").agg(pair(F.col("p")).alias("seen"))
            back = rows.groupBy("i", "context", "d").agg((F.col("d") * F.count("*") / F.sum("n")).alias("back")).groupBy("context").agg(pair(F.col("back")).alias("back"))
            self.orders[order] = (written(seen, "lang-grams"), written(back, "lang-contexts"))
            # continuation counts: how many characters precede each shorter n-gram
            counts = written(counts.groupBy("lang", F.col("gram").bitwiseAND((1 << 16 * (order - 1)) - 1).alias("gram")).agg(F.count("*").alias("n")), "lang-counts") if order > 1 else counts
        self.floor = 1.0 / (counts.select("gram").distinct().count() + 1)

    def logs(self, wanted: DataFrame) -> DataFrame:
        """gram, logs (a log-probability for each language) of distinct 4-grams, seen or not: from the unigrams up, an order at a time."""
        by_order = {ORDER: wanted}
        for order in range(ORDER - 1, 0, -1):
            by_order[order] = written(by_order[order + 1].select(F.col("gram").bitwiseAND((1 << 16 * order) - 1).alias("gram")).distinct(), "lang-wanted")
        width, floor = len(self.langs), self.floor
        out: DataFrame | None = None
        for order in range(1, ORDER + 1):
            seen, back = self.orders[order]
            rows = by_order[order].withColumns({"context": F.shiftrightunsigned("gram", 16), "suffix": F.col("gram").bitwiseAND((1 << 16 * (order - 1)) - 1)})
            rows = rows.join(seen, "gram", "left").join(back, "context", "left")
            rows = rows.withColumn("p", F.lit(None).cast("array<double>")) if out is None else rows.join(out.select(F.col("gram").alias("suffix"), "p"), "suffix")

            def run(batches: Iterator[pa.RecordBatch], last: bool = order == ORDER, first: bool = order == 1) -> Iterator[pa.RecordBatch]:
                step = max(1, 1_000_000 // width)
                for batch in batches:
                    for a in range(0, batch.num_rows, step):
                        part = batch.slice(a, step)
                        lower = floor if first else part.column(3).flatten().to_numpy().reshape(-1, width)
                        p = _dense(part.column(1), width, 0.0) + _dense(part.column(2), width, 1.0) * lower
                        p = np.log(p) if last else p
                        lists = pa.ListArray.from_arrays(np.arange(len(p) + 1, dtype=np.int32) * width, p.astype(np.float32 if last else np.float64).reshape(-1))
                        yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["gram", "logs" if last else "p"])

            out = rows.select("gram", "seen", "back", "p").mapInArrow(run, "gram long, logs array<float>" if order == ORDER else "gram long, p array<double>")
        return out

    def predicted(self, df: DataFrame) -> DataFrame:
        kind = df.schema["key"].dataType.simpleString()
        # written, so that a row keeps its number
        parts = written(df.mapInArrow(_exploded, f"key {kind}, row long, letters long, n long, gram long, m long"), "lang-texts")
        logs = self.logs(written(parts.filter("gram is not null").select("gram").distinct(), "lang-wanted"))
        sums = [F.sum(F.col("m") * F.col("logs")[i].cast("double")).alias(f"s{i}") for i in range(len(self.langs))]
        rows = parts.join(logs, "gram", "left").groupBy("row", "key", "letters", "n").agg(*sums)
        langs, points = self.langs, self.points

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                letters, n = (batch.column(i).to_numpy() for i in (2, 3))
                h = -np.stack([c.fill_null(0).to_numpy() for c in batch.columns[4:]], axis=1) / np.maximum(n, 1)[:, None]
                lang, score, margin = decided(h, letters, langs, points)
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(lang, pa.string()), pa.array(score), pa.array(margin)], names=["key", "lang_pred", "score", "margin"])

        return rows.mapInArrow(run, f"key {kind}, lang_pred string, score double, margin double")


def predicted(df: DataFrame, model: Model | WrittenModel) -> DataFrame:
    """key, lang_pred, score, margin for each row (key, text)."""
    if isinstance(model, WrittenModel):
        return model.predicted(df)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch, "text", 1_000_000):
                part = batch.slice(a, b - a)
                lang, score, margin = shared.value.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), score, margin], names=["key", "lang_pred", "score", "margin"])

    return df.mapInArrow(run, f"key {df.schema['key'].dataType.simpleString()}, lang_pred string, score double, margin double")


def model_of(counts: DataFrame) -> Model | WrittenModel:
    """A model of counts (lang, gram, n)."""
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if counts.select("gram").distinct().count() * len(langs) > MAX_CELLS:
        return WrittenModel(counts, langs)
    rows: dict[str, tuple] = {}
    for lang in langs:
        t = counts.filter(F.col("lang") == lang).select("gram", "n").toArrow()
        keys, n = t.column(0).to_numpy().view(U64), t.column(1).to_numpy()
        order = np.argsort(keys)
        rows[lang] = (keys[order], n[order])
    return Model(rows)


def learn(train: DataFrame) -> Model | WrittenModel:
    """A model of rows (text, lang), calibrated on a fold by one of the other rows."""
    train = train.filter("lang is not null")
    folds = max(FOLDS, train.count() // CALIBRATION_ROWS)
    train = train.withColumn("held", F.pmod(F.xxhash64("text"), F.lit(folds)) == 0)
    counts = written(gram_counts(train), "grams")
    model = model_of(counts.select("lang", "gram", "n"))
    if len(model.langs) > 1:
        other = model_of(counts.filter("rest > 0").select("lang", "gram", F.col("rest").alias("n")))
        some = predicted(train.filter("held").select(F.col("lang").alias("key"), "text"), other).filter("lang_pred <> 'und'")
        some = some.select(F.least(F.col("margin") * BINS / 2, F.lit(float(BINS))).cast("long").alias("k"), (F.col("lang_pred") == F.col("key")).alias("right"))
        bins = sorted(some.groupBy("k").agg(F.sum(F.col("right").cast("long")), F.count("*")).collect())
        if bins:
            k, p, n = np.array(bins, float).T
            model.points = isotonic((k + 0.5) * 2 / BINS, p, n)
    return model


def identify(docs: DataFrame, model: Model | WrittenModel) -> DataFrame:
    """doc_id, lang_pred, score, rejected for each row of docs."""
    out = predicted(columns_of(docs, doc_id="long", text="string").select(F.col("doc_id").alias("key"), "text"), model)
    return out.select(F.col("key").alias("doc_id"), "lang_pred", "score", (F.col("score") < REJECT).alias("rejected"))
