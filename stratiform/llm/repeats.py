"""Suffix-array dedup across documents (operator 8): later copies of LENGTH-byte strings go, the first stays.

A byte is removed if a LENGTH-byte string that covers it also starts in a document with a smaller doc_id: the string starts a suffix whose
longest previous factor, over earlier documents, reaches LENGTH. No task can hold a suffix array of the whole corpus, so suffixes are
first dealt out such that those with equal beginnings meet, and each bucket has a suffix array of its own:

1. Documents are packed (PACK bytes of text, compressed, in a row of a written table).
2. Each LENGTH-byte string is given an anchor: the GRAM-byte substring of least hash in it, the leftmost of equals. Equal strings
   have equal anchors at equal places. A run of strings with one anchor is a segment. Each pack sends the distinct
   hashes of its anchors, once each, to the bucket of the hash.
3. A bucket answers to each pack which of its anchors also occur in another document; other strings cannot repeat.
4. Each pack sends the segments of those anchors, equal ones once, with the least doc_id that has them; later documents
   in the same pack lose such a segment at once, and in a bucket so do documents of other packs (`copies`: found by a hash, compared byte by byte).
5. For anchors with several different segments the bucket sorts the suffixes that start in them (`suffix_array`), takes the LCP of
   neighbours, finds for each suffix the nearest one before and after it in suffix order that belongs to a smaller document, and from the LCPs on the way
   the longest previous factor (`longest_previous`). Where it reaches LENGTH, the string goes.
6. The verdicts go back to the packs, which cut the removed ranges.

A passage in a third of all documents reaches a bucket once per pack, so no bucket grows with the number of copies; texts move
compressed, and other messages are arrays. Nothing is collected but the sum of text lengths.

Defined cases: null texts are empty; rows with a null doc_id lose nothing and take nothing from others. Rows with equal doc_id are the same
document and take nothing from each other. Texts under LENGTH bytes are kept. Extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import U64, columns_of, freed, mix64, offsets_of, scratch, written

LENGTH = 50
GRAM = 20
SPAN = LENGTH - GRAM + 1  # places an anchor can have in a string
LONGEST = LENGTH + SPAN - 1  # of a segment's bytes
PACK = 8_000_000
SLICE = 500_000
BUCKET_BYTES = 8_000_000  # of the table's text per bucket
#: Text in one bucket of the written packs, and the most buckets that Spark takes.
STORED_BYTES, MOST_STORED = 64_000_000, 100_000
NO_ID = np.iinfo(np.int64).min


# ---------------------------------------------------------------- packs


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, seq = TaskContext.get().partitionId(), 0
    ids: list[np.ndarray] = []
    sizes: list[np.ndarray] = []
    texts: list[np.ndarray] = []
    held = 0

    def row() -> pa.RecordBatch:
        body = zstandard.ZstdCompressor(level=1).compress(np.concatenate(texts).tobytes())
        columns = [pa.array([part << 32 | seq], pa.int64()), *(pa.array([np.concatenate(x).tobytes()], pa.binary()) for x in (ids, sizes)), pa.array([body], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["pack", "ids", "sizes", "body"])

    for batch in batches:
        offsets, data = offsets_of(batch.column(1))
        every = batch.column(0).fill_null(NO_ID).to_numpy()
        start = 0
        while start < len(every):
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + PACK - held, "right")) - 1)
            ids.append(every[start:stop])
            sizes.append(np.diff(offsets[start : stop + 1]))
            texts.append(data[offsets[start] : offsets[stop]])
            held += int(offsets[stop] - offsets[start])
            start = stop
            if held >= PACK or start < len(every):
                yield row()
                ids, sizes, texts, held, seq = [], [], [], 0, seq + 1
    if ids:
        yield row()


class Pack:
    def __init__(self, ids: bytes, sizes: bytes, body: bytes) -> None:
        self.ids = np.frombuffer(ids, np.int64)
        self.offsets = np.concatenate(([0], np.cumsum(np.frombuffer(sizes, np.int64))))
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)

    def segments(self) -> Iterator[tuple[np.ndarray, ...]]:
        """By slices of documents: anchor hash, document index, place of the first string, number of strings, anchor's offset in it."""
        start, n = 0, len(self.ids)
        while start < n:
            stop = min(n, max(start + 1, int(np.searchsorted(self.offsets, self.offsets[start] + SLICE, "right")) - 1))
            base = self.offsets[start]
            found = segments(self.data[base : self.offsets[stop]], self.offsets[start : stop + 1] - base, self.ids[start:stop] != NO_ID)
            if found is not None:
                key, doc, place, count, shift = found
                yield key, doc + start, place + base, count, shift
            start = stop


def segments(data: np.ndarray, offsets: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, ...] | None:
    n = len(data)
    if n < LENGTH:
        return None
    eight = np.ndarray((n - 7,), "<u8", data, 0, (1,))  # the eight bytes from each place on
    m = n - GRAM + 1
    gram = mix64(eight[:m] * U64(0x9E3779B97F4A7C15) + eight[8 : 8 + m] * U64(0xC2B2AE3D27D4EB4F) + eight[GRAM - 8 : GRAM - 8 + m] * U64(0x9FB21C651E98DF25))
    value, at = gram, np.arange(len(gram), dtype=np.int32)
    width = 1
    while width < SPAN:
        step = min(width, SPAN - width)
        later = value[step:] < value[:-step]
        value, at = np.where(later, value[step:], value[:-step]), np.where(later, at[step:], at[:-step])
        width += step
    # strings that lie inside one document
    inside = np.zeros(len(at), bool)
    for a, b, ok in zip(offsets[:-1], offsets[1:], use):
        if ok and b - a >= LENGTH:
            inside[a : b - LENGTH + 1] = True
    place = np.flatnonzero(inside)
    if not len(place):
        return None
    anchor = at[place]
    first = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (place[1:] != place[:-1] + 1)))
    head = np.flatnonzero(first)
    begin = place[head]
    count = np.diff(np.append(head, len(place)))
    return value[begin], np.searchsorted(offsets, begin, "right") - 1, begin, count, anchor[head] - begin


# ---------------------------------------------------------------- rounds


def _short(key: np.ndarray) -> np.ndarray:
    return (key >> U64(32)).astype(np.uint32)


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key & U64(0xFFFFFFFF)) * U64(buckets) >> U64(32)).astype(np.int32)


def anchors_by_bucket(pack: Pack, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Bucket, distinct anchors, and which of them are in several documents of the pack."""
    keys, docs = [], []
    for key, doc, *_ in pack.segments():
        keys.append(key)
        docs.append(pack.ids[doc])
    if not keys:
        return
    key, doc = np.concatenate(keys), np.concatenate(docs)
    order = np.lexsort((doc, _short(key), _bucket(key, buckets)))
    short, bucket, doc = _short(key)[order], _bucket(key, buckets)[order], doc[order]
    new = np.concatenate(([True], (short[1:] != short[:-1]) | (bucket[1:] != bucket[:-1])))
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(doc)) - 1
    several = doc[head] != doc[last]
    short, bucket = short[head], bucket[head]
    cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
    for a, b in zip(cut[:-1], cut[1:]):
        yield int(bucket[a]), short[a:b], several[a:b]


def shared_anchors(pdf: pd.DataFrame) -> pd.DataFrame:
    """For one bucket: per pack, those of its anchors that another document has too."""
    sizes = [len(x) // 4 for x in pdf["keys"]]
    key = np.frombuffer(b"".join(pdf["keys"]), np.uint32)
    several = np.frombuffer(b"".join(pdf["several"]), np.bool_)
    u, at, n = np.unique(key, return_inverse=True, return_counts=True)
    shared = n > 1
    shared[at[several]] = True
    mine = shared[at]
    out, start = [], 0
    for pack, size in zip(pdf["pack"], sizes):
        k = key[start : start + size][mine[start : start + size]]
        start += size
        if len(k):
            out.append((pack, pdf["bucket"].iloc[0], k.tobytes()))
    return pd.DataFrame(out, columns=["pack", "bucket", "keys"])


def contents(data: np.ndarray, begin: np.ndarray, count: np.ndarray, key: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each segment's bytes, length, anchor and the anchor's place."""
    size = count + LENGTH - 1
    h = np.zeros(len(begin), U64)
    some, at = h, begin
    for j in range(int(size.max()) if len(size) else 0):
        if j >= LENGTH:  # all segments are that long
            on = np.flatnonzero(size > j)
            some, at = h[on], begin[on]
        some = (some + data[at + j] + U64(1)) * U64(0x9E3779B97F4A7C15) ^ some >> U64(29)
        if j >= LENGTH:
            h[on] = some
        else:
            h = some
    return mix64(h ^ mix64(key ^ (size.astype(U64) << U64(40)) ^ (shift.astype(U64) << U64(52))))


def equal_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether data[a:a + size] and data[b:b + size] are equal, for each row; sizes up to LONGEST."""
    windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(LONGEST, np.uint8)]), LONGEST)
    out = np.zeros(len(a), bool)
    for i in range(0, len(a), 50_000):
        j = slice(i, i + 50_000)
        out[j] = ((windows[a[j]] == windows[b[j]]) | (np.arange(LONGEST) >= size[j, None])).all(axis=1)
    return out


def copies(data: np.ndarray, begin: np.ndarray, count: np.ndarray, content: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each segment the one of the least document with equal bytes (itself, if there is none). A segment that only shares the hash stands alone."""
    order = np.lexsort((doc, content))
    new = np.concatenate(([True], content[order][1:] != content[order][:-1]))[: len(order)]
    first = np.empty(len(order), np.int64)
    first[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))] if len(order) else order
    size = count + LENGTH - 1
    some = np.flatnonzero(first != np.arange(len(first)))
    other = some[(size[some] != size[first[some]]) | ~equal_bytes(data, begin[some], begin[first[some]], size[some])]
    first[other] = other
    return first


def claims(pack: Pack, replies: list, buckets: int) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], np.ndarray]:
    """Segments to be judged, by bucket (their numbers and bytes), and strings (starts, counts) that an earlier document of the pack has."""
    wanted = np.sort(np.concatenate([np.frombuffer(r["keys"], np.uint32).astype(U64) | U64(r["bucket"]) << U64(32) for r in replies])) if replies else np.zeros(0, U64)
    rows = []
    wanted_one = max(len(wanted) - 1, 0)
    for key, doc, place, count, shift in pack.segments():
        full = _short(key).astype(U64) | _bucket(key, buckets).astype(U64) << U64(32)
        at = np.searchsorted(wanted, full)
        hit = np.flatnonzero(wanted[np.minimum(at, wanted_one)] == full) if len(wanted) else np.zeros(0, np.int64)
        if len(hit):
            rows.append((full[hit], pack.ids[doc[hit]], place[hit], count[hit], shift[hit]))
    if not rows:
        return [], np.zeros((0, 2), np.int64)
    full, doc, place, count, shift = (np.concatenate(x) for x in zip(*rows))
    size = count + LENGTH - 1
    first = copies(pack.data, place, count, contents(pack.data, place, count, full, shift), doc)
    later = doc > doc[first]
    lost, own = np.flatnonzero(later), np.flatnonzero(~later)
    out = []
    bucket = (full[own] >> U64(32)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    own, bucket = own[by], bucket[by]
    cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
    for a, b in zip(cut[:-1], cut[1:]):
        i = own[a:b]
        table = np.stack([full[i].view(np.int64), doc[i], place[i], count[i], shift[i].astype(np.int64)])
        out.append((int(bucket[a]), table, pack.data[np.repeat(place[i] - np.concatenate(([0], np.cumsum(size[i])[:-1])), size[i]) + np.arange(size[i].sum())]))
    return out, np.stack([place[lost], count[lost]], axis=1)


def verdicts(pdf: pd.DataFrame) -> pd.DataFrame:
    """For one bucket: per pack, the strings (start, mask of those that follow) that an earlier document has."""
    unzip = zstandard.ZstdDecompressor().decompress
    tables = [np.frombuffer(unzip(x), np.int64).reshape(5, -1) for x in pdf["claims"]]
    pack = np.repeat(pdf["pack"].to_numpy(), [t.shape[1] for t in tables])
    key, doc, place, count, shift = np.concatenate(tables, axis=1)
    data = np.frombuffer(b"".join(unzip(x) for x in pdf["bytes"]), np.uint8)
    begin = np.concatenate(([0], np.cumsum(count + LENGTH - 1)[:-1]))
    mask = np.zeros(len(doc), np.int64)
    # whole segments that an earlier document has too
    first = copies(data, begin, count, contents(data, begin, count, key.view(U64), shift), doc)
    later = doc > doc[first]
    mask[later] = (np.int64(1) << count[later]) - 1
    # anchors with several different segments: the suffixes that start in them
    own = np.flatnonzero(first == np.arange(len(first)))
    _, at, n = np.unique(key[own], return_inverse=True, return_counts=True)
    mixed = own[n[at] > 1]
    row = np.repeat(mixed, count[mixed])
    number = np.arange(len(row)) - np.repeat(np.cumsum(count[mixed]) - count[mixed], count[mixed])
    late = longest_previous(data, begin[row] + number, begin[row] + count[row] + LENGTH - 1, doc[row]) >= LENGTH
    np.bitwise_or.at(mask, row[late], np.int64(1) << number[late])
    # rows of one document with one segment share the verdict of the first
    same = np.flatnonzero(~later)
    mask[same] |= mask[first[same]]
    hit = np.flatnonzero(mask)
    out = []
    for p in np.unique(pack[hit]):
        i = hit[pack[hit] == p]
        out.append((p, np.stack([place[i], mask[i]], axis=1).tobytes()))
    return pd.DataFrame(out, columns=["pack", "masks"])


def suffix_array(data: np.ndarray, start: np.ndarray, stop: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes data[start:stop] (LONGEST bytes at most) in order of their bytes, then of document; and the LCP of each with the one before it."""
    size = stop - start
    rows = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(LONGEST, np.uint8)]), LONGEST)[start]
    rows[np.arange(LONGEST) >= size[:, None]] = 0
    order = np.argsort(doc, kind="stable")
    order = order[np.argsort(rows.view(f"S{LONGEST}")[order, 0], kind="stable")]
    lcp = np.zeros(len(order), np.int64)
    for i in range(1, len(order), 50_000):
        a, b = order[i - 1 : i + 49_999], order[i : i + 50_000]
        differ = rows[a[: len(b)]] != rows[b]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), LONGEST)
        lcp[i : i + 50_000] = np.minimum(same, np.minimum(size[a[: len(b)]], size[b]))
    return order, lcp


def to_smaller(doc: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each place the LCP with the nearest place before it that has a smaller document; 0 where it is under LENGTH.

    Each place looks at the one before it; where that has no smaller document, it jumps to where that one looks, as all between are no smaller either.
    """
    at, low = np.arange(len(doc)) - 1, lcp.copy()
    todo = np.flatnonzero((low >= LENGTH) & (doc[at] >= doc))
    while len(todo):
        j = at[todo]
        low[todo], at[todo] = np.minimum(low[todo], low[j]), at[j]
        todo = todo[(low[todo] >= LENGTH) & (doc[at[todo]] >= doc[todo])]
    return np.where(low >= LENGTH, low, 0)


def longest_previous(data: np.ndarray, start: np.ndarray, stop: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The longest previous factor of each suffix data[start:stop] over the suffixes of smaller documents; 0 for one under LENGTH."""
    if not len(start):
        return np.zeros(0, np.int64)
    order, lcp = suffix_array(data, start, stop, doc)
    before = to_smaller(doc[order], lcp)
    after = to_smaller(doc[order][::-1], np.append(0, lcp[:0:-1]))[::-1]
    out = np.zeros(len(order), np.int64)
    out[order] = np.maximum(before, after)
    return out


def cut_pack(pack: Pack, lost: np.ndarray, masks: list[np.ndarray]) -> pa.RecordBatch:
    n = len(pack.data)
    cover = np.zeros(n + 1, np.int32)
    np.add.at(cover, lost[:, 0], 1)
    np.add.at(cover, lost[:, 0] + lost[:, 1] + LENGTH - 1, -1)
    for m in masks:
        for bit in range(SPAN):
            at = m[m[:, 1] >> bit & 1 == 1, 0] + bit
            np.add.at(cover, at, 1)
            np.add.at(cover, at + LENGTH, -1)
    gone = np.cumsum(cover[:-1], dtype=np.int32) > 0
    del cover
    bound = pack.offsets
    edge = np.zeros(n + 1, bool)
    edge[bound] = True
    starts = np.flatnonzero(gone & (np.concatenate(([True], ~gone[:-1])) | edge[:-1]))
    stops = np.flatnonzero(gone & (np.concatenate((~gone[1:], [True])) | edge[1:])) + 1
    at = np.searchsorted(starts, bound)
    owner = np.searchsorted(bound, starts, "right") - 1
    spans = pa.StructArray.from_arrays([starts - bound[owner], stops - bound[owner]], ["start", "end"])
    kept_before = np.concatenate(([0], np.cumsum(~gone, dtype=np.int32)))[bound]
    kept = pa.BinaryArray.from_buffers(pa.binary(), len(pack.ids), [None, pa.py_buffer(kept_before.astype(np.int32).tobytes()), pa.py_buffer(pack.data[~gone].tobytes())])
    ids = pa.array(pack.ids, mask=pack.ids == NO_ID)
    return pa.RecordBatch.from_arrays([ids, np.diff(bound), pa.ListArray.from_arrays(at.astype(np.int32), spans), kept], names=["doc_id", "n_bytes", "spans", "kept"])


# ---------------------------------------------------------------- the operator


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans (removed byte ranges: maximal, in order), kept (the other bytes): a row for each row of docs."""
    spark = docs.sparkSession
    docs = columns_of(docs, doc_id="long", text="string")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(2 * parts, -(-total // BUCKET_BYTES))
    # bucketed by pack: the two joins below read it in place instead of shuffling the texts
    name = f"packs_{uuid.uuid4().hex}"
    rows = docs.mapInArrow(freed(_packed), "pack long, ids binary, sizes binary, body binary")
    rows.write.bucketBy(min(MOST_STORED, max(parts, -(-total // STORED_BYTES))), "pack").option("path", scratch(spark, "packs")).saveAsTable(name)
    packs = spark.table(name)
    spark.sql(f"drop table {name}")  # the name alone: the files are outside the warehouse and stay

    def send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            for bucket, key, several in anchors_by_bucket(Pack(row["ids"], row["sizes"], row["body"]), buckets):
                yield pa.RecordBatch.from_pylist([{"bucket": bucket, "pack": row["pack"], "keys": key.tobytes(), "several": several.tobytes()}], _ANCHORS)

    anchors = packs.mapInArrow(freed(send_anchors), "bucket int, pack long, keys binary, several binary")
    replies = anchors.groupBy("bucket").applyInPandas(shared_anchors, "pack long, bucket int, keys binary")
    replies = replies.groupBy("pack").agg(F.collect_list(F.struct("bucket", "keys")).alias("replies"))

    def send_claims(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=1).compress
        for row in _rows(batches):
            found, lost = claims(Pack(row["ids"], row["sizes"], row["body"]), row["replies"], buckets)
            if len(lost):
                yield pa.RecordBatch.from_pylist([{"bucket": -1, "pack": row["pack"], "claims": None, "bytes": zip_(lost.tobytes())}], _CLAIMS)
            for bucket, table, data in found:
                yield pa.RecordBatch.from_pylist([{"bucket": bucket, "pack": row["pack"], "claims": zip_(table.tobytes()), "bytes": zip_(data.tobytes())}], _CLAIMS)

    claimed = written(packs.join(replies, "pack").mapInArrow(freed(send_claims), "bucket int, pack long, claims binary, bytes binary"), "claims")
    masks = claimed.filter("bucket >= 0").groupBy("bucket").applyInPandas(verdicts, "pack long, masks binary")
    lost = claimed.filter("bucket < 0").select("pack", F.col("bytes").alias("lost"), F.lit(None).cast("binary").alias("masks"))
    found = lost.unionByName(masks.select("pack", F.lit(None).cast("binary").alias("lost"), "masks")).groupBy("pack").agg(F.collect_list("lost").alias("lost"), F.collect_list("masks").alias("masks"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor().decompress
        for row in _rows(batches):
            pairs = [np.frombuffer(unzip(x), np.int64).reshape(-1, 2) for x in row["lost"] or ()]
            marks = [np.frombuffer(x, np.int64).reshape(-1, 2) for x in row["masks"] or ()]
            yield cut_pack(Pack(row["ids"], row["sizes"], row["body"]), np.concatenate([np.zeros((0, 2), np.int64), *pairs]), marks)

    return packs.join(found, "pack", "left").mapInArrow(freed(cut), "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


_ANCHORS = pa.schema([("bucket", pa.int32()), ("pack", pa.int64()), ("keys", pa.binary()), ("several", pa.binary())])
_CLAIMS = pa.schema([("bucket", pa.int32()), ("pack", pa.int64()), ("claims", pa.binary()), ("bytes", pa.binary())])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]
