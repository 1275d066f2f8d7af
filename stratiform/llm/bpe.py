"""Byte-level BPE encoding and decoding (operator 3).

A pre-token that is itself in the vocabulary is one id; any other starts as single bytes in a linked list and merges the
neighbours of least rank, leftmost first. The queue of possible merges is a hierarchical bitmap over ranks:
one bucket of list positions per rank, a bit per full bucket, a bit per 256 buckets; the lowest set bits give the next
rank without a heap over all pairs. An entry whose neighbours have changed is stale and skipped when it
comes up. Work is n log n in the length of a pre-token, so megabytes without a space are fine.

Ranks of pairs come from a table by two bytes at first and by two ids later, so no bytes are cut while merging (`Merges`).
A bucket is a bitmap of positions too for a pre-token of up to SHORT bytes, a heap for a longer one.

Texts are encoded whole, each row on its own, with no shuffle. A worker remembers the pieces it has merged, up to
`REMEMBER` of them. The rank file is read where the query is built and broadcast (bounded: a vocabulary).

Defined cases: a null text counts as empty and has no ids. Special-token strings in a text are ordinary text.
Decoding gives the bytes of the ids in order; null ids give null, an id outside the vocabulary no bytes.
"""

from __future__ import annotations

import base64
import re
import uuid
from array import array
from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import freed, text_slices

#: Pieces a worker keeps, in each of two generations.
REMEMBER = 250_000
#: Longer pieces are not kept.
REMEMBER_CHARS = 64
#: Bytes up to which a piece's positions are bits of one integer.
SHORT = 256
#: Unicode's White_Space; Python's own class also holds \x1c-\x1f.
WHITE = r"\t-\r \x85\xa0  -     　"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """The pre-tokeniser, with \\s and \\S as Unicode has them.

    Texts within the basic plane go through the standard library's expressions, with property classes written out as ranges, which take a third of the time;
    texts beyond it, and patterns with flags or groups, through the other library.
    """
    spaced = pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]").replace(r"\s", f"[{WHITE}]")
    full = regex.compile(spaced).findall
    if re.search(r"\((?!\?[!=])", spaced):
        return full
    plain = re.compile(without_properties(spaced)).findall
    return lambda text: plain(text) if text.isascii() or len(text.encode("utf-16-le")) == 2 * len(text) else full(text)


def without_properties(pattern: str) -> str:
    """The pattern with \\p{..} and \\P{..} as the ranges of the basic plane that they hold."""
    every = "".join(map(chr, (c for c in range(1 << 16) if not 0xD800 <= c < 0xE000)))

    def ranges(name: str) -> str:
        runs = (m.group() for m in regex.finditer(f"{name}+", every))
        return "".join(f"\\u{ord(r[0]):04x}-\\u{ord(r[-1]):04x}" for r in runs)

    out, inside = [], False
    for part in re.findall(r"\\[pP]\{[^}]*\}|\\.|.", pattern, re.DOTALL):
        if part[:2] in (r"\p", r"\P"):
            out.append(ranges(part) if inside else f"[{ranges(part)}]")
        else:
            inside = part == "[" or inside and part != "]"
            out.append(part)
    return "".join(out)


class RankQueue:
    """Positions by rank; pop gives the least rank and in it the leftmost position."""

    __slots__ = ("buckets", "leaves", "top")

    def __init__(self) -> None:
        self.buckets: dict[int, list[int]] = {}
        self.leaves: dict[int, int] = {}
        self.top = 0

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        leaf = rank >> 8
        self.leaves[leaf] = self.leaves.get(leaf, 0) | 1 << (rank & 255)
        self.top |= 1 << leaf

    def pop(self) -> tuple[int, int]:
        leaf = (self.top & -self.top).bit_length() - 1
        bits = self.leaves[leaf]
        rank = leaf << 8 | (bits & -bits).bit_length() - 1
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            bits &= bits - 1
            self.leaves[leaf] = bits
            if not bits:
                self.top &= self.top - 1
        return rank, position


class Merges:
    """The ranks of a vocabulary by pairs, and the queue's arrays, which are all zero between two pieces."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        last = max(ranks.values(), default=0)
        self.shift = last.bit_length()
        self.single = [ranks.get(bytes([b]), -1) for b in range(256)]
        self.first = [ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]
        get, shift = ranks.get, self.shift
        self.first = [NONE if r < 0 else r for r in self.first]
        self.pairs: dict[int, int] = {}
        for word, rank in ranks.items():
            for i in range(1, len(word)):
                left = get(word[:i])
                if left is not None and (right := get(word[i:])) is not None:
                    self.pairs[left << shift | right] = rank
        self.at = [0] * (last + 1)
        self.leaves = [0] * ((last >> 8) + 1)
        self.up = list(range(-1, SHORT + 1))

    def piece(self, piece: bytes) -> list[int]:
        """The ids of one pre-token. A byte that the vocabulary lacks is an error."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        return self.short(piece) if len(piece) <= SHORT else self.long(piece)

    def _start(self, piece: bytes) -> tuple[list[int], list[int]]:
        """The ids of the bytes and the ranks of neighbours (NONE: no merge), with two more at the end."""
        single, first = self.single, self.first
        ids = [single[b] for b in piece]
        if -1 in ids:
            raise KeyError(piece)
        want = [first[a << 8 | b] for a, b in zip(piece, piece[1:])]
        want += _ENDS
        return ids, want

    def long(self, piece: bytes) -> list[int]:
        n, pairs, shift = len(piece), self.pairs, self.shift
        ids, want = self._start(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = RankQueue()
        for i, rank in enumerate(want):
            if rank != NONE:
                queue.push(rank, i)
        while queue.top:
            rank, i = queue.pop()
            if want[i] != rank:
                continue
            j, h = after[i], before[i]
            after[i] = k = after[j]
            ids[i] = rank
            want[j] = want[i] = NONE
            if k < n:
                before[k] = i
                want[i] = new = pairs.get(rank << shift | ids[k], NONE)
                if new != NONE:
                    queue.push(new, i)
            if h >= 0:
                want[h] = new = pairs.get(ids[h] << shift | rank, NONE)
                if new != NONE:
                    queue.push(new, h)
        return _listed(ids, after)

    def short(self, piece: bytes) -> list[int]:
        """The same with three levels of bits: positions per rank, ranks per leaf, leaves. Every bit that is set is popped, so the arrays end as they began.

        Only a pair below the one on its left and not above the one on its right can be next among them, so only such pairs enter the queue; a pair that one
        of them kept out enters when that one's rank has changed.
        """
        n, get, shift, at, leaves = len(piece), self.pairs.get, self.shift, self.at, self.leaves
        ids, want = self._start(piece)
        top, bit, left = 0, 1, NONE
        for rank, right in zip(want, want[1:-1]):
            if left > rank <= right and rank != NONE:
                if not at[rank]:
                    leaf = rank >> 8
                    leaves[leaf] |= _BIT[rank & 255]
                    top |= 1 << leaf
                at[rank] |= bit
            left = rank
            bit += bit
        before, after = self.up[:n], self.up[2 : n + 2]
        while top:
            leaf = (top & -top).bit_length() - 1
            bits = leaves[leaf]
            low = bits & -bits
            rank = (leaf << 8) + low.bit_length() - 1
            spots = at[rank]
            bit = spots & -spots
            if spots == bit:
                at[rank] = 0
                leaves[leaf] = bits = bits ^ low
                if not bits:
                    top &= top - 1
            else:
                at[rank] = spots ^ bit
            i = bit.bit_length() - 1
            if want[i] != rank:
                continue
            # pairs from left to right: g, h, i (merges), j (goes), k
            j, h = after[i], before[i]
            after[i] = k = after[j]
            ids[i] = rank
            was_j, want[j] = want[j], NONE
            if k < n:
                before[k] = i
                want[i] = right = get(rank << shift | ids[k], NONE)
                beyond = want[k]
            else:
                want[i] = right = beyond = NONE
            if h >= 0:
                was_h, g = want[h], before[h]
                want[h] = left = get(ids[h] << shift | rank, NONE)
                behind = want[g]
                if behind > was_h and left >= behind < want[before[g]] and g >= 0:
                    top = self._push(top, behind, g)
                if behind > left <= right and left != NONE:
                    top = self._push(top, left, h)
            else:
                left = NONE
            if left > right <= beyond and right != NONE:
                top = self._push(top, right, i)
            if was_j <= beyond < right and beyond <= want[after[k]]:
                top = self._push(top, beyond, k)
        return _listed(ids, after)

    def _push(self, top: int, rank: int, position: int) -> int:
        at = self.at
        if at[rank]:
            at[rank] |= 1 << position
            return top
        at[rank] = 1 << position
        leaf = rank >> 8
        self.leaves[leaf] |= _BIT[rank & 255]
        return top | 1 << leaf


#: The rank of neighbours that don't merge, and what stands at both ends of a piece.
NONE = 1 << 60
_ENDS = [NONE, NONE, NONE]
_BIT = [1 << i for i in range(256)]


def _listed(ids: list[int], after: list[int]) -> list[int]:
    out, i, n = [], 0, len(ids)
    while i < n:
        out.append(ids[i])
        i = after[i]
    return out


class _Memory(dict):
    """Ids, as the bytes of 32-bit numbers, of the pieces merged so far, in two generations of bounded size."""

    def __init__(self, merges: Merges) -> None:
        super().__init__()
        self.merge, self.old = merges.piece, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = array("i", self.merge(piece.encode())).tobytes()
        if len(piece) <= REMEMBER_CHARS:
            if len(self) >= REMEMBER:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Whole texts to ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.find, self.ids = splitter(pattern), _Memory(Merges(ranks)).__getitem__

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.ids, self.find(text))), np.int32)


_ENCODERS: dict[str, Encoder] = {}


def encoder_for(key: str, shared, pattern: str) -> Encoder:
    """The worker's encoder for a broadcast of ranks, named by key; a worker keeps one from task to task."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value, pattern)
    return _ENCODERS[key]


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """df with a column of the ids of `text` (array of int); a column already so named is replaced."""
    spark = df.sparkSession
    shared, key = spark.sparkContext.broadcast(read_ranks(ranks_path)), uuid.uuid4().hex
    kept = [c for c in df.columns if c != ids]
    schema = df.select([f"`{c}`" for c in kept]).withColumn(ids, F.lit(None).cast("array<int>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(key, shared, pattern)
        for batch in batches:
            for a, b in text_slices(batch, text, 1_000_000):
                part = batch.slice(a, b - a)
                found = [encoder.encode(t) if t else _EMPTY for t in part.column(part.schema.get_field_index(text)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, int_lists(found)], names=[*part.schema.names, ids])

    return df.select([f"`{c}`" for c in kept]).mapInArrow(freed(run), schema)


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """df with the bytes of the ids (binary)."""
    spark = df.sparkSession
    ranks = read_ranks(ranks_path)
    words = [b""] * (max(ranks.values(), default=-1) + 1)
    for word, rank in ranks.items():
        words[rank] = word
    shared = spark.sparkContext.broadcast(words)
    kept = [c for c in df.columns if c != decoded]
    schema = df.select([f"`{c}`" for c in kept]).withColumn(decoded, F.lit(None).cast("binary")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        size = np.array([len(w) for w in words] or [0], np.int64)
        start = np.concatenate(([0], np.cumsum(size)[:-1]))
        flat = np.frombuffer(b"".join(words), np.uint8)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            for a in range(0, batch.num_rows, 256):
                lists = column.slice(a, 256)
                yield pa.RecordBatch.from_arrays([*batch.slice(a, 256).columns, joined(lists, size, start, flat)], names=[*batch.schema.names, decoded])

    return df.select([f"`{c}`" for c in kept]).mapInArrow(freed(run), schema)


def joined(lists: pa.Array, size: np.ndarray, start: np.ndarray, flat: np.ndarray) -> pa.Array:
    """For each list of ids its words' bytes, one after the other."""
    values = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    ok = (values >= 0) & (values < len(size))
    width = np.where(ok, size[np.where(ok, values, 0)], 0)
    ends = np.cumsum(width)
    at = np.repeat(start[np.where(ok, values, 0)] - (ends - width), width) + np.arange(ends[-1] if len(ends) else 0)
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cut = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))].astype(np.int32)
    out = pa.BinaryArray.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(cut.tobytes()), pa.py_buffer(flat[at].tobytes())])
    return pa.array([None if n else b for n, b in zip(lists.is_null().to_pylist(), out.to_pylist())], pa.binary()) if lists.null_count else out


def int_lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate([_EMPTY, *found]))


_EMPTY = np.zeros(0, np.int32)
