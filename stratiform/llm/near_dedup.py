"""MinHash near-dedup (operator 6): SuperMinHash, banding, verification on full sets, components.

Words are runs of anything but spaces and \\x09-\\x0D after lower-casing A-Z; a document's set holds its
distinct 5-word shingles as 64-bit hashes (a shorter text is one shingle). Words are hashed by SipHash under a key that is drawn anew for every run,
so that no one can write unlike words with equal hashes. Steps:

1. `signatures`: per document the set's size, its 128-bit BLAKE2b digest, a SuperMinHash signature as band keys and as
   one byte per slot. In SuperMinHash each element goes through the slots in an order of its own and puts j + r (r uniform) into
   the j-th; a slot keeps the least value. Once a document's slots are all filled, no later step can
   lower one: it stops there. Documents of a batch go through the steps together.
2. Equal sets (exact copies) become one representative by a partially aggregated minimum;
   a hot group of copies never meets in one task.
3. Banding: all members of a band are paired with its lead, the least of them: a pair per member, however large the band is.
   Pairs whose sizes or signatures rule a link out go; the rest are confirmed on their full sets. The sets are those of the
   representatives in shared bands only: a bitmap of fixed size says which texts to read for them, so the others aren't shuffled.
4. A band with members in several components after that may hold links that don't touch its lead. Its members' signatures are
   compared, in blocks of bounded size, across components only; members that have a possible partner get their sets and
   the same blocks confirm them, skipping what is joined already. So a group of copies costs one pair per member, and only bands
   with near but unlinked members are gone through.
5. Components of the confirmed links; each document takes its representative's.

A link at 0.85 shares no band with probability 3e-7, and agrees in fewer slots than LEAST_AGREE with probability under 1e-8.

Defined cases: null, empty and blank texts have an empty set, size 0, are linked with nothing and kept. So are rows without an id.
Repeated rows give one row each; rows that share an id are one node of the links. Extra columns are ignored. An empty table gives
an empty result. Ids tie to the least.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import LOWER, SPACED, U64, Key, by_group, columns_of, components, freed, marked, mix64, offsets_of, secret_key, siphash, text_slices, types_of, words_of, written

SLOTS = 192
ROWS = 6  # of a band
#: Agreeing slots below which a pair at 0.85 cannot be: six deviations under the mean.
LEAST_AGREE = 133
#: Members of a band, and shingles, that one block holds on average.
BLOCK_ROWS, BLOCK_SHINGLES = 2_000, 500_000
_TURN = [U64(x | 1) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, key: Key, size: int = 5) -> list[np.ndarray]:
    """For each document the sorted distinct hashes of its word shingles: sums of the words' hashes under a secret key."""
    data = LOWER[data]
    starts, stops, first = words_of(data, offsets, SPACED)
    w = siphash(data, starts, stops, key)
    n = max(len(w) - size + 1, 0)
    full = np.zeros(n, U64)
    for i in range(size):
        full += w[i : i + n] * (_TURN[i % 5] + U64(2 * (i // 5)))
    full = mix64(full)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            out.append(np.unique(full[a : b - size + 1]))
        elif b > a:
            k = np.array([sum(int(w[a + i]) * int(_TURN[i % 5]) for i in range(b - a)) + int(b - a) & (1 << 64) - 1], U64)
            out.append(mix64(mix64(k)))
        else:
            out.append(np.zeros(0, U64))
    return out


def superminhash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """Signatures as (documents, slots) of fixed-point values j + r; those of empty sets stay at the maximum."""
    sizes = np.array([len(s) for s in sets], np.int64)
    sig = np.full((len(sets), slots), np.iinfo(U64).max, U64)
    if not sizes.sum():
        return sig
    h = np.concatenate(sets)
    doc = np.repeat(np.arange(len(sets)), sizes)
    low, order = U64(0xFFFFFFFF), None
    flat = sig.reshape(-1)
    for j in range(slots):
        x = mix64(h + U64((j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        k = j + ((x >> U64(32)) * U64(slots - j) >> U64(32)).astype(np.int64)
        if j == 0:
            slot, first = k, k
        else:
            if order is None:  # the permutation after step 0
                order = np.tile(np.arange(slots, dtype=np.int16), (len(h), 1))
                order[np.arange(len(h)), first] = 0
                order[:, 0] = first
            rows = np.arange(len(h))
            slot = order[rows, k].astype(np.int64)
            order[rows, k] = order[:, j]
            order[:, j] = slot
        np.minimum.at(flat, doc * slots + slot, U64(j << 32) | (x & low))
        open_ = (sig == np.iinfo(U64).max).any(axis=1)
        keep = open_[doc]
        if not keep.any():
            break
        if not keep.all():
            h, doc, first = h[keep], doc[keep], first[keep]
            order = order[keep] if order is not None else None
    return sig


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    n, slots = sig.shape
    parts = sig[:, : slots // rows * rows].reshape(n, slots // rows, rows)
    key = np.broadcast_to(np.arange(1, slots // rows + 1, dtype=U64) * U64(0xC2B2AE3D27D4EB4F), (n, slots // rows)).copy()
    for i in range(rows):
        key = mix64(key ^ parts[:, :, i])
    return key.view(np.int64)


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    """(2, documents): 128 bits of each set's BLAKE2b digest."""
    return np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), np.int64).reshape(-1, 2).T


def _binary(rows: np.ndarray) -> pa.Array:
    """A cell for each row of a matrix of bytes."""
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1])), pa.py_buffer(np.ascontiguousarray(rows))])


_SIGNED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()), ("bands", pa.list_(pa.int64())), ("sig", pa.binary())])


def _signatures(batches: Iterator[pa.RecordBatch], key: Key) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 33
    for batch in batches:
        for a, b in text_slices(batch, "text", 400_000):
            part = batch.slice(a, b - a)
            offsets, data = offsets_of(part.column(1))
            sets = shingle_sets(data, offsets, key)
            sig = superminhash(sets)
            keys = band_keys(sig)
            lists = pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * keys.shape[1], keys.reshape(-1))
            beside = [part.schema.field(i) for i in range(2, part.num_columns)]
            fp1, fp2 = _digests(sets)
            n = np.array([len(s) for s in sets], np.int64)
            columns = [np.arange(row, row + len(sets)), part.column(0), n, fp1, fp2, lists, _binary(mix64(sig).astype(np.uint8)), *part.columns[2:]]
            yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], schema=pa.schema([*_SIGNED, *beside]))
            row += len(sets)


def signatures(docs: DataFrame, key: Key, beside: Sequence[str] = ()) -> DataFrame:
    """row (its number), doc_id, n_shingles, fp1, fp2 (digest of the set), bands, sig, columns `beside`: one row for each row of docs."""
    schema = "row long, doc_id long, n_shingles long, fp1 long, fp2 long, bands array<long>, sig binary" + types_of(docs, beside)
    return columns_of(docs, beside, doc_id="long", text="string").mapInArrow(freed(lambda batches: _signatures(batches, key)), schema)


def _sets(batches: Iterator[pa.RecordBatch], key: Key) -> Iterator[pa.RecordBatch]:
    done: set[tuple[int, int]] = set()  # a repeated row gives its set once in a task
    for batch in batches:
        for a, b in text_slices(batch, "text", 1_000_000):
            part = batch.slice(a, b - a)
            offsets, data = offsets_of(part.column(1))
            sets = shingle_sets(data, offsets, key)
            fp1, fp2 = _digests(sets)
            keys = list(zip(part.column(0).to_pylist(), fp1.tolist()))
            new = [i for i, k in enumerate(keys) if not (k in done or done.add(k))]
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(new, pa.int64())), pa.array(fp1[new]), pa.array(fp2[new]), pa.array([sets[i].tobytes() for i in new], pa.binary())], names=["doc_id", "fp1", "fp2", "shingles"])


def sets_of(docs: DataFrame, heads: DataFrame, key: Key) -> DataFrame:
    """node, shingles: the full sets of representatives (doc_id, fp1, fp2, node), from their texts; texts that are surely none of them aren't shuffled.

    A merge join at every size: where representatives are few enough to broadcast the sets would stay in place, and a larger table would shuffle them all of a sudden.
    """
    near = marked(docs, heads).filter("maybe")
    sets = near.select("doc_id", "text").mapInArrow(freed(lambda batches: _sets(batches, key)), "doc_id long, fp1 long, fp2 long, shingles binary")
    return sets.join(heads.hint("merge"), ["doc_id", "fp1", "fp2"]).select("node", "shingles")


def among(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows of df whose `column` is in ids (a column of that name, repeated or not); rows that surely aren't don't travel."""
    return marked(df, ids, column).filter("maybe").drop("maybe").join(ids.select(column).distinct().hint("merge"), column, "left_semi")


def without(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows of df whose `column` is not in ids; only rows that may be in it travel, so few ids cost little however wide the rows are."""
    near = marked(df, ids, column)
    return near.filter("not maybe").union(near.filter("maybe").join(ids.select(column).hint("merge"), column, "left_anti")).drop("maybe")


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The signatures of a column, a row each."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def possible(pairs: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """a, a_id, b, b_id: the pairs (a, b) of nodes whose sizes and signatures don't rule a link out."""
    of = lambda end: heads.select(F.col("node").alias(end), *(F.col(c).alias(f"{end}_{c}") for c in ("doc_id", "n", "sig")))
    met = pairs.join(of("a"), "a").join(of("b"), "b").filter(100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ok = (_matrix(batch.column(4)) == _matrix(batch.column(5))).sum(axis=1) >= LEAST_AGREE
                yield batch.select([0, 1, 2, 3]).filter(pa.array(ok))

    return met.select("a", F.col("a_doc_id").alias("a_id"), "b", F.col("b_doc_id").alias("b_id"), "a_sig", "b_sig").mapInArrow(freed(run), "a long, a_id long, b long, b_id long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: ids of the pairs that are links by their full sets. A set goes to each of its pairs; a hot lead's pairs are split by the adaptive join.

    Both joins are merge joins whatever the size of `pairs`: so the work grows in proportion, and doesn't change its kind where pairs become too many to broadcast.
    """
    of = lambda end, name: sets.select(F.col("node").alias(end), F.col("shingles").alias(name)).hint("merge")
    met = pairs.join(of("a", "x"), "a").join(of("b", "y"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [linked(np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64), percent) for x, y in zip(batch.column(2), batch.column(3))]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return met.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), "x", "y").mapInArrow(freed(run), "a long, b long")


def in_blocks(rows: DataFrame, size: Column, block: int) -> DataFrame:
    """rows (band, node, ...) with x, y, side: members of a band by pairs of blocks that hold about `block` of size. A block meets itself and every other once."""
    blocks = rows.groupBy("band").agg(F.ceil(F.sum(size) / block).cast("long").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    met = rows.join(blocks, "band").select(*rows.columns, own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    return met.select(*rows.columns, F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), (F.col("own") > F.col("other")).cast("long").alias("side"))


def partners(tables: Iterator[pa.Table], percent: int) -> Iterator[pa.RecordBatch]:
    """Of groups (band, x, y, node, doc_id, component, n, side, sig): members with a possible partner in another component."""
    for t in tables:
        node, doc_id, component, n, side = (t.column(i).to_numpy() for i in range(3, 8))
        sig, two = _matrix(t.column(8)), t.column(1)[0] != t.column(2)[0]
        found = np.zeros(len(node), bool)
        for i in range(len(node) - 1):
            rest = np.arange(i + 1, len(node))
            ok = (component[rest] != component[i]) & (100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i]))
            if two:
                ok &= side[rest] != side[i]
            rest = rest[ok]
            if len(rest):
                rest = rest[(sig[rest] == sig[i]).sum(axis=1) >= LEAST_AGREE]
                found[rest] = True
                found[i] |= bool(len(rest))
        if found.any():
            yield pa.RecordBatch.from_arrays([pa.array(c[found]) for c in (t.column(0).to_numpy(), node, doc_id, component, n)] + [_binary(sig[found])], names=["band", "node", "doc_id", "component", "n", "sig"])


def forest(tables: Iterator[pa.Table], percent: int) -> Iterator[pa.RecordBatch]:
    """Of groups (band, x, y, node, doc_id, component, n, side, sig, shingles): edges (ids) of a spanning forest of the links between components."""
    for t in tables:
        doc_id, component, n, side = (t.column(i).to_numpy() for i in range(4, 8))
        sig, two = _matrix(t.column(8)), t.column(1)[0] != t.column(2)[0]
        sets = [np.frombuffer(x.as_buffer(), U64) for x in t.column(9)]
        root, edges = component.copy(), []
        for i in range(len(sets) - 1):
            rest = np.arange(i + 1, len(sets))
            ok = (root[rest] != root[i]) & (100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i]))
            if two:
                ok &= side[rest] != side[i]
            rest = rest[ok]
            for j in rest[(sig[rest] == sig[i]).sum(axis=1) >= LEAST_AGREE]:
                if root[j] != root[i] and linked(sets[i], sets[j], percent):
                    edges.append((doc_id[i], doc_id[j]))
                    root[root == root[j]] = root[i]
        if edges:
            yield pa.RecordBatch.from_arrays([np.array(x, np.int64) for x in zip(*edges)], names=["a", "b"])


def near_dedup(docs: DataFrame, percent: int = 85, beside: Sequence[str] = ()) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept, and its columns `beside` as _<name>. Links: 100 * intersection >= percent * union."""
    secret = secret_key()
    signed = written(signatures(docs, secret, beside), "near-signatures")
    docs, beside = columns_of(docs, doc_id="long", text="string"), [f"_{c}" for c in beside]
    found = signed.filter("n_shingles > 0 and doc_id is not null")
    key = ["n_shingles", "fp1", "fp2"]
    # written, so that both sides of the join are exchanged for it and a hot group of copies can be split between tasks
    reps = written(found.groupBy(key).agg(F.min(F.struct("doc_id", "row")).alias("head")).select(*key, F.col("head.doc_id").alias("rep"), F.col("head.row").alias("node")), "near-reps")
    classes = written(found.select("row", "doc_id", *key, *beside).join(reps.hint("merge"), key).withColumn("copy", F.col("row") != F.col("node")).drop("node", "fp1", "fp2"), "near-classes")
    # signatures and bands are wide: those of the copies alone travel to be left out
    heads = without(found, classes.filter("copy").select("row"), "row").select(F.col("row").alias("node"), "doc_id", F.col("n_shingles").alias("n"), "fp1", "fp2", "sig", "bands")
    heads = written(heads, "near-heads")

    bands = heads.select("node", F.explode("bands").alias("band"))
    leads = bands.groupBy("band").agg(F.min("node").alias("lead"), F.count("*").alias("members")).filter("members > 1")
    met = written(bands.join(leads.hint("merge"), "band"), "near-bands")  # never broadcast: leads grow with the table
    heads = written(among(heads.drop("bands"), met.select("node"), "node"), "near-shared")
    pairs = met.filter("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct()
    pairs = written(possible(pairs, heads, percent), "near-pairs")
    sets = written(sets_of(docs, heads.select("node", "doc_id", "fp1", "fp2"), secret), "near-sets")
    links = written(confirmed(pairs, sets, percent), "near-links")
    joined = components(links, "near-coarse")

    # bands whose members, without the lead, are in several components
    rest = met.filter("members > 2 and node <> lead").select("band", "node").join(heads.select("node", "doc_id", "n"), "node")
    rest = rest.join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    open_ = rest.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("band")
    rest = written(rest.join(open_, "band").select("band", "node", "doc_id", "component", "n"), "near-rest")
    signs = in_blocks(rest, F.lit(1), BLOCK_ROWS).join(heads.select("node", "sig"), "node")
    some = by_group(signs.select("band", "x", "y", "node", "doc_id", "component", "n", "side", "sig"), ["band", "x", "y"], lambda t: partners(t, percent), "band long, node long, doc_id long, component long, n long, sig binary")
    some = written(some.dropDuplicates(["band", "node"]), "near-some")
    full = in_blocks(some, F.col("n"), BLOCK_SHINGLES).join(marked(sets, some, "node").filter("maybe").drop("maybe").hint("merge"), "node")
    more = written(by_group(full.select("band", "x", "y", "node", "doc_id", "component", "n", "side", "sig", "shingles"), ["band", "x", "y"], lambda t: forest(t, percent), "a long, b long"), "near-more")
    if more.limit(1).count():
        joined = components(links.union(more), "near-final")
    # a link names a representative; every document of its class follows it
    named = classes.join(joined, F.col("rep") == joined.node, "left").select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"), *beside)
    alone = signed.filter("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), *beside)
    return named.union(alone).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), *beside)
