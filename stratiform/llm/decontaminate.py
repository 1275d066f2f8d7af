"""Benchmark decontamination (operator 7): one Aho-Corasick automaton over the windows of all test items.

Words are lower-cased (A-Z) runs of letters, digits and all non-ASCII characters. A window is ten consecutive words of an item, or
all words of a shorter one. The automaton works on words: those of the windows have numbers, and a node is
a beginning of windows. A word of a text finds its number by a 64-bit key, and has it only if the bytes are the same (words over LONG bytes: their SHA-256). Nodes are numbered level by level, so that the moves (node, word) of the whole automaton
are one sorted array, in which the place of a move is the node it leads to; failure links, windows that end in a node, and the next node along the failure
links in which one ends are arrays beside it: about 20 bytes for each node, 300 for a window.

Texts are scanned once. No node is deeper than a window, so the state after a word follows from the last ten words alone: texts are
cut into lanes of LANE words that begin a window early, and all lanes of a slice move together. Matches are mapped
back to words, and from words to byte offsets of the original text. Texts are not shuffled.

The windows come from a Spark job over the items; how many pairs of item and window there are is counted before they are broadcast. Up to
BLOCK (150 MB) there is one automaton and one scan. Beyond it pairs are dealt into blocks by hash, each with an automaton and a
scan of its own, and the hits gathered so far go through a written table: what is broadcast stays bounded, the result is the same.

Defined cases: null, empty and wordless texts have no words, no hits, no items. Null items and items without words have no windows.
Repeated items with equal ids count once, repeated documents give a row each. Extra columns of the items are ignored and
those of the documents stay; columns named like the results are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import LOWER, columns_of, freed, offsets_of, range_keys, same_ranges, text_slices, words_of, written

WINDOW = 10
#: Pairs of item and window in one automaton.
BLOCK = 500_000
LANE = 64
#: Bytes of a word above which its digest stands for it.
LONG = 64

_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = _IS_WORD[0x41:0x5B] = True
_PLAIN = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if _IS_WORD[b] else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_PLAIN).split() if text else []


def canonical(word: bytes) -> bytes:
    """The word, or for one over LONG bytes a mark that no word has and its SHA-256."""
    return word if len(word) <= LONG else b"\1" + hashlib.sha256(word).hexdigest().encode()


def word_places(array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased bytes of all texts, starts and ends of their words; each text's first word (one more at the end) and byte offset."""
    offsets, data = offsets_of(array)
    starts, stops, first = words_of(data, offsets, _IS_WORD)
    return LOWER[data], starts, stops, first, offsets


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, text in zip(batch.column(0), batch.column(1)):
            item, w = item.as_py(), [canonical(x) for x in words(text.as_py())]
            if item is not None and w:
                n = min(WINDOW, len(w))
                found = sorted({b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)})
                for i in range(0, len(found), 10_000):
                    some = found[i : i + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(some), pa.string()), pa.array(some, pa.binary())], names=["item_id", "window"])


def windows(items: DataFrame) -> DataFrame:
    """item_id (string), window (its words, joined by spaces, binary), distinct."""
    return columns_of(items, item_id="string", text="string").mapInArrow(freed(_windows), "item_id string, window binary").distinct()


class Automaton:
    """Windows (words joined by spaces) with the items that have them."""

    def __init__(self, pairs: pa.Table) -> None:
        names, window_of = pairs.column("item_id").to_pylist(), pairs.column("window").to_pylist()
        self.items = sorted(set(names))
        place = {name: i for i, name in enumerate(self.items)}
        texts = sorted(set(window_of))
        number = {w: i for i, w in enumerate(texts)}
        pair = np.array(sorted((number[w], place[name]) for w, name in zip(window_of, names)), np.int64).reshape(-1, 2)
        self.item_of = pair[:, 1].astype(np.int32)
        self.item_from = np.searchsorted(pair[:, 0], np.arange(len(texts) + 1))
        split = [w.split(b" ") for w in texts]
        self.length = np.array([len(w) for w in split], np.int32)
        self._learn(sorted({word for w in split for word in w}))
        grid = np.zeros((len(texts), WINDOW), np.int64)
        grid[np.arange(WINDOW) < self.length[:, None]] = [self.number[word] for w in split for word in w]
        self._grow(grid)
        self.number = {word: i for word, i in self.number.items() if word[:1] == b"\1"}

    def _learn(self, vocabulary: list[bytes]) -> None:
        """Numbers the words, in the order of keys that are unlike for unlike words."""
        self.words = max(1, len(vocabulary))
        stops = np.cumsum([0, *map(len, vocabulary)])
        data = np.frombuffer(b"".join(vocabulary), np.uint8)
        for self.seed in count():
            keys = range_keys(data, stops[:-1], stops[1:], self.seed)
            order = np.argsort(keys)
            if len(np.unique(keys)) == len(keys):
                break
        self.keys, self.data, self.begin, self.end = keys[order], data, stops[:-1][order], stops[1:][order]
        self.number = {vocabulary[k]: i for i, k in enumerate(order)}

    def numbers(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Of each word data[start:stop] its number, -1 for a word of no window. A key finds the number, the bytes decide."""
        out = np.full(len(starts), -1, np.int64)
        if not len(starts) or not len(self.keys):
            return out
        short = stops - starts <= LONG
        keys = range_keys(data, starts, np.where(short, stops, starts), self.seed)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = np.flatnonzero((self.keys[at] == keys) & short & (stops - starts == self.end[at] - self.begin[at]))
        found = found[same_ranges(data, starts[found], stops[found], self.data, self.begin[at[found]])]
        out[found] = at[found]
        for i in np.flatnonzero(~short) if self.number else ():
            out[i] = self.number.get(canonical(data[starts[i] : stops[i]].tobytes()), -1)
        return out

    def _grow(self, grid: np.ndarray) -> None:
        node = np.zeros(len(grid), np.int64)
        moves, levels = [], [1]
        for depth in range(WINDOW):
            on = np.flatnonzero(self.length > depth)
            level, at = np.unique(node[on] * self.words + grid[on, depth], return_inverse=True)
            node[on] = levels[-1] + at
            moves.append(level)
            levels.append(levels[-1] + len(level))
        self.moves = np.concatenate(moves)
        nodes = levels[-1]
        self.own = np.full(nodes, -1, np.int32)
        self.own[node] = np.arange(len(node))
        self.fail, self.more = np.zeros(nodes, np.int32), np.zeros(nodes, np.int32)
        for low, high in zip(levels[1:-1], levels[2:]):  # from the second level on
            parent, word = np.divmod(self.moves[low - 1 : high - 1], self.words)
            self.fail[low:high] = self.step(self.fail[parent].astype(np.int64), word)
            f = self.fail[low:high]
            self.more[low:high] = np.where(self.own[f] >= 0, f, self.more[f])
        self.ends = (self.own >= 0) | (self.more > 0)

    def step(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The states after one word each: along the failure links until there is a move, or back to the root."""
        out = np.zeros(len(state), np.int64)
        todo = np.arange(len(state))
        while len(todo) and len(self.moves):
            move = state[todo] * self.words + word[todo]
            at = np.searchsorted(self.moves, move)
            hit = self.moves[np.minimum(at, len(self.moves) - 1)] == move
            out[todo[hit]] = at[hit] + 1
            todo = todo[~hit & (state[todo] > 0)]
            state[todo] = self.fail[state[todo]]
        return out

    def scan(self, word: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last words and windows of all matches in texts given by their words' numbers; first: where each text begins."""
        if not len(word) or not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lanes = -(-np.diff(first) // LANE)
        begin = np.repeat(first[:-1], lanes) + LANE * (np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes))
        low, high = np.repeat(first[:-1], lanes), np.minimum(begin + LANE, np.repeat(first[1:], lanes))
        state = np.zeros(len(begin), np.int64)
        ends, states = [], []
        for t in range(1 - WINDOW, LANE):
            place = begin + t
            inside = (place >= low) & (place < high)
            now = np.where(inside, word[np.clip(place, 0, len(word) - 1)], -1)
            known = np.flatnonzero(now >= 0)
            new = np.zeros(len(state), np.int64)
            new[known] = self.step(state[known], now[known])
            state = new
            if t >= 0:
                found = known[self.ends[state[known]]]
                ends.append(place[found])
                states.append(state[found])
        end, state = np.concatenate(ends), np.concatenate(states)
        out = []
        while len(end):
            mine = self.own[state] >= 0
            out.append((end[mine], self.own[state[mine]].astype(np.int64)))
            state = self.more[state]
            end, state = end[state > 0], state[state > 0]
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def items_of(self, doc: np.ndarray, window: np.ndarray, docs: int) -> list[list[str]]:
        """For each document the sorted items of the windows found in it."""
        seen = np.unique(doc * max(1, len(self.length)) + window)
        doc, window = np.divmod(seen, max(1, len(self.length)))
        size = self.item_from[window + 1] - self.item_from[window]
        at = np.repeat(self.item_from[window] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        both = np.unique(np.repeat(doc, size) * max(1, len(self.items)) + self.item_of[at])
        out: list[list[str]] = [[] for _ in range(docs)]
        for d, i in zip(*np.divmod(both, max(1, len(self.items)))):
            out[d].append(self.items[i])
        return out


def covered(ends: np.ndarray, length: np.ndarray, first: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs of words inside matches, as starts and ends (exclusive); a run stays in its text."""
    cover = np.zeros(words + 1, np.int64)
    np.add.at(cover, ends - length + 1, 1)
    np.add.at(cover, ends + 1, -1)
    inside = np.concatenate(([False], np.cumsum(cover[:-1]) > 0, [False]))
    edge = np.zeros(words + 1, bool)
    edge[first] = True
    return np.flatnonzero(inside[1:] & (~inside[:-1] | edge)[: words + 1]), np.flatnonzero(inside[:-1] & (~inside[1:] | edge)[: words + 1])


_RANGE = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_TYPES = {"n_words": "long", "hits": "array<struct<start:int,end:int>>", "items": "array<string>", "byte_spans": "array<struct<start:int,end:int>>"}


def _ranges(starts: np.ndarray, stops: np.ndarray, at: np.ndarray) -> pa.Array:
    values = pa.StructArray.from_arrays([pa.array(starts.astype(np.int32)), pa.array(stops.astype(np.int32))], fields=list(_RANGE))
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), values)


def _block(docs: DataFrame, pairs: pa.Table, text: str) -> DataFrame:
    """Adds the hits of one block of windows to those that docs has already."""
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(pairs))
    kept = [c for c in docs.columns if c not in _TYPES]
    again = "hits" in docs.columns
    schema = docs.select([f"`{c}`" for c in kept] + [F.lit(None).cast(t).alias(c) for c, t in _TYPES.items()]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            for a, b in text_slices(batch, text, 1_000_000):
                part = batch.slice(a, b - a)
                get = lambda c: part.column(part.schema.get_field_index(c))  # noqa: B023, E731
                data, starts, stops, first, offsets = word_places(get(text))
                ends, window = automaton.scan(automaton.numbers(data, starts, stops), first)
                length = automaton.length[window]
                items = automaton.items_of(np.searchsorted(first, ends, "right") - 1, window, part.num_rows)
                if again:
                    old, of = get("hits"), np.repeat(first[:-1], get("hits").value_lengths().to_numpy())
                    s, e = (x.to_numpy() + of for x in old.flatten().flatten())
                    ends, length = np.concatenate([ends, e - 1]), np.concatenate([length, e - s])
                    items = [sorted({*x, *y}) for x, y in zip(items, get("items").to_pylist())]
                low, high = covered(ends, length, first, len(starts))
                doc = np.searchsorted(first, low, "right") - 1
                at = np.searchsorted(doc, np.arange(part.num_rows + 1))
                hits = _ranges(low - first[doc], high - first[doc], at)
                spans = _ranges(starts[low] - offsets[doc], stops[high - 1] - offsets[doc], at)
                yield pa.RecordBatch.from_arrays([*(get(c) for c in kept), pa.array(np.diff(first)), hits, pa.array(items, pa.list_(pa.string())), spans], names=[*kept, *_TYPES])

    return docs.mapInArrow(freed(run), schema)


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", block: int = BLOCK) -> DataFrame:
    """docs with n_words, hits (word ranges inside windows), items (sorted ids of the windows' items), byte_spans of the hits."""
    found = written(windows(items), "windows")
    docs = docs.select([f"`{c}`" for c in docs.columns if c not in _TYPES])
    pairs, size = found.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("window")), F.lit(0))).first()
    blocks = max(1, -(-pairs // block), -(-size // (200 * block)))
    for k in range(blocks):
        # about `block` pairs: counted above, dealt by hash
        pairs = found.filter(F.pmod(F.xxhash64("item_id", "window"), F.lit(blocks)) == k).toArrow()
        docs = _block(docs, pairs, text)
        if k < blocks - 1:
            docs = written(docs, "hits")
    return docs
