"""Helpers that several training-data operators share."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import secrets
from collections.abc import Callable, Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.shared import discard, scratch, written, written_at  # noqa: F401  the operators take them from here

U64 = np.uint64


def columns_of(df: DataFrame, beside: Sequence[str] = (), **wanted: str) -> DataFrame:
    """Only the wanted columns (name=type); a missing one is null. Other columns, whatever their names, stay out, but for those `beside`: as _<name>."""
    return df.select([(F.col(f"`{c}`").cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in wanted.items()] + [F.col(f"`{c}`").alias(f"_{c}") for c in beside])


def types_of(df: DataFrame, beside: Sequence[str]) -> str:
    """The columns `beside` as the end of a schema."""
    return "".join(f", _{c} {df.schema[c].dataType.simpleString()}" for c in beside)


#: Bits of the map of `marked`: 131,072 rows of 64 are broadcast, however many ids there are.
MAP_BITS = 1 << 23


def marked(df: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """df with `maybe`: false for rows whose `column` is surely not in ids, so that only the others need to be shuffled for a join with them.

    A bitmap of MAP_BITS bits by hash is broadcast. With more ids than bits it lets all rows through: then nothing is saved, but nothing is lost.
    """
    slot = F.pmod(F.xxhash64(column), F.lit(MAP_BITS))
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64({column}), {MAP_BITS}) % 64 as int))")
    bits = ids.select(F.shiftright(slot, 6).alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    near = df.withColumns({"_word": F.shiftright(slot, 6), "_at": (slot % 64).cast("int")}).join(F.broadcast(bits), "_word", "left")
    return near.withColumn("maybe", F.coalesce(F.expr("(shiftright(_bits, _at) & 1) = 1"), F.lit(False))).drop("_word", "_at", "_bits")


def fold_bucket(column: Column, folds: int) -> Column:
    """crc32 of a number as decimal text, modulo folds."""
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(folds))


def freed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, giving back to the system at a task's end the memory that it is done with: Spark keeps workers for later tasks, beside each other."""

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
            if trim:
                trim(0)

    return call


# ---------------------------------------------------------------- Arrow text


def text_slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch holding about `limit` bytes of text each; one long text gets a range of its own."""
    offsets = offsets_of(batch.column(batch.schema.get_field_index(column)))[0]
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(n, max(stop, start + 1))
        yield start, stop
        start = stop


def offsets_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and UTF-8 bytes of a string array; null counts as empty."""
    if array.null_count:
        array = array.fill_null("")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    if not len(array):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    o = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    d = np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data is not None and o[-1] > o[0] else np.zeros(0, np.uint8)
    return o - o[0], d


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads a 64-bit value over all bits."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def range_keys(data: np.ndarray, start: np.ndarray, stop: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each data[start:stop]: eight bytes after another are mixed in; ranges over LONG bytes go through BLAKE2b."""
    size = (stop - start).astype(np.int64)
    h = mix64((size.astype(U64) + U64(1)) * U64(0x9E3779B97F4A7C15) ^ U64(seed))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))  # the eight bytes from each place on
    on, at = np.arange(len(size)), 0
    while len(on := on[(size[on] > at) & (size[on] <= LONG)]):
        part = eight[start[on] + at] & _FIRST[np.minimum(size[on] - at, 8)]
        h[on] = mix64((h[on] ^ part) * U64(0x9FB21C651E98DF25) + (h[on] >> U64(32)))
        at += 8
    for i in np.flatnonzero(size > LONG):
        h[i] ^= U64(int.from_bytes(hashlib.blake2b(data[start[i] : stop[i]], digest_size=8).digest(), "little"))
    return mix64(h)


def same_ranges(a: np.ndarray, start: np.ndarray, stop: np.ndarray, b: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Whether each a[start:stop] holds the bytes from b[begin] on."""
    same = np.ones(len(start), bool)
    x, y = (np.ndarray((len(d) + 1,), "<u8", np.concatenate([d, np.zeros(8, np.uint8)]), 0, (1,)) for d in (a, b))
    on, at = np.arange(len(start)), 0
    while len(on := on[same[on] & (stop[on] - start[on] > at)]):
        same[on] = (x[start[on] + at] ^ y[begin[on] + at]) & _FIRST[np.minimum(stop[on] - start[on] - at, 8)] == 0
        at += 8
    return same


Key = tuple[int, int]


def secret_key() -> Key:
    """A key for one run of an operator: the driver draws it and sends it to all tasks."""
    return secrets.randbits(64), secrets.randbits(64)


def siphash(data: np.ndarray, start: np.ndarray, stop: np.ndarray, key: Key, rounds: tuple[int, int] = (1, 3)) -> np.ndarray:
    """SipHash of each data[start:stop] under a secret key: whoever writes texts can't find two words of one hash. Ranges over LONG bytes go through keyed BLAKE2b."""
    out = np.empty(len(start), U64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    for i in range(0, len(start), 1 << 14):  # so few that they stay in the cache
        out[i : i + (1 << 14)] = _sip(eight, start[i : i + (1 << 14)], stop[i : i + (1 << 14)], key, *rounds)
    whole = key[0].to_bytes(8, "little") + key[1].to_bytes(8, "little")
    for i in np.flatnonzero(stop - start > LONG):
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i] : stop[i]], digest_size=8, key=whole).digest(), "little")
    return out


def _sip(eight: np.ndarray, start: np.ndarray, stop: np.ndarray, key: Key, some: int, last: int) -> np.ndarray:
    size = (stop - start).astype(np.int64)
    size[size > LONG] = 0
    v = np.empty((4, len(size)), U64)
    for i, c in enumerate((0x736F6D6570736575, 0x646F72616E646F6D, 0x6C7967656E657261, 0x7465646279746573)):
        v[i] = c ^ key[i % 2]
    on, at = np.flatnonzero(size >= 8), 0
    while len(on):
        w, m = v[:, on], eight[start[on] + at]
        w[3] ^= m
        _rounds(w, some)
        w[0] ^= m
        v[:, on] = w
        at += 8
        on = on[size[on] >= at + 8]
    m = eight[start + (size & ~7)] & _FIRST[size & 7] | size.astype(U64) << U64(56)
    v[3] ^= m
    _rounds(v, some)
    v[0] ^= m
    v[2] ^= U64(0xFF)
    _rounds(v, last)
    return v[0] ^ v[1] ^ v[2] ^ v[3]


def _turn(x: np.ndarray, bits: int) -> None:
    high = x >> U64(64 - bits)
    x <<= U64(bits)
    x |= high


def _rounds(v: np.ndarray, n: int) -> None:
    a, b, c, d = v
    for _ in range(n):
        a += b
        c += d
        _turn(b, 13)
        _turn(d, 16)
        b ^= a
        d ^= c
        _turn(a, 32)
        c += b
        a += d
        _turn(b, 17)
        _turn(d, 21)
        b ^= c
        d ^= a
        _turn(c, 32)


LONG = 256
#: Masks of the first k of eight bytes.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)


def words_of(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes, none crossing a document, and for each document its first word."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = is_word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1])) & ~edge[:-1]
    after = np.concatenate((inside[1:], [False])) & ~edge[1:]
    starts, stops = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, stops, np.searchsorted(starts, offsets)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Every byte but a space and the controls \x09-\x0D.
SPACED = np.ones(256, bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False


# ---------------------------------------------------------------- components


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of `edges` (a long, b long): rows (node, component), the least node that each can reach.

    Every round each node takes the least label among its neighbours and then the label of its label,
    so the labels of a path of length n settle in about log n rounds. A round is three joins and
    a partial aggregation; the labels are written to the shared folder, so lineage stays short, and the tables of the round
    before go. Nothing is collected but one count.
    """
    spark = edges.sparkSession
    both, _ = written_at(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    labels, old = written_at(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), f"{name}-0")
    for i in count(1):
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        least = labels.join(near, labels.node == near.a).select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        least, half = written_at(least, f"{name}-{i}a")
        up = least.select(F.col("node").alias("up"), F.col("label").alias("of_label"))
        hop = least.join(up, least.label == up.up).select("node", F.least("label", "of_label").alias("label"), (F.least("label", "of_label") != F.col("was")).alias("moved"))
        hop, new = written_at(hop, f"{name}-{i}b")
        discard(spark, old, half)
        labels, old = hop.select("node", "label"), new
        if hop.filter("moved").limit(1).count() == 0:
            return labels.withColumnRenamed("label", "component")
    raise AssertionError


# ---------------------------------------------------------------- groups in sorted partitions


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The rows of each run of equal values in the first `keys` (integer) columns, across batches: a group, where rows are sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)])
        cuts = np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if held and tuple(k[:, a]) != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = tuple(k[:, a])
    if held:
        yield pa.Table.from_batches(held)


def by_group(df: DataFrame, keys: Sequence[str], run: Callable[[Iterator[pa.Table]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """run() over the groups of df by `keys` (long), one at a time; the keys come first, the other columns in their order."""
    rest = [c for c in df.columns if c not in keys]
    return df.select(*keys, *rest).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(freed(lambda batches: run(runs(batches, len(keys)))), schema)
