"""Chat formatting at token level (operator 10).

A turn is assembled from segments that are encoded separately; reserved ids go between them and no text can produce them:

    BEGIN HEAD role BODY text END        written   <s>[INST]role[/INST]text</s>

Control strings inside a role or text are escaped (a backslash after their first character, backslashes doubled), so the
written form is as unambiguous as the ids, and unescaping gives the original text. The loss mask covers the text of
assistant turns: +1 where such a segment begins, -1 where it ends, and a prefix sum over the tokens of a batch.

Encoding is a map over rows, before any shuffle. `digests` reads the result back: rows are brought
together by conversation and sorted by turn, and a task streams over them with running hashes, one conversation's state at a time; so a
conversation of any length needs constant memory, but that distinct rows with one turn, one role and the same first 40 characters are held together until their texts
are put in order. Its hash is sequential by nature, all other work on it is spread.

Defined cases: null texts and roles are empty. Rows of a conversation go by turn (null first), ties by role, then text; repeated rows
all count. A null conv_id is a conversation. An empty table has no conversations. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.bpe import encoder_for, int_lists, read_ranks
from stratiform.llm.common import columns_of, text_slices

#: Fixed: the control strings of the template, by reserved id after the vocabulary's last.
CONTROLS = ("<s>", "[INST]", "[/INST]", "</s>")
BEGIN, HEAD, BODY, END = range(4)
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\") if "\\" in text else text
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def format_turns(df: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """conv_id, turn, role, text, ids, loss_mask: a row for each row of df."""
    df = columns_of(df, conv_id="long", turn="long", role="string", text="string")
    df = df.withColumns({"role": F.coalesce("role", F.lit("")), "text": F.coalesce("text", F.lit(""))})
    ranks = read_ranks(ranks_path)
    shared, key = df.sparkSession.sparkContext.broadcast(ranks), uuid.uuid4().hex
    first = max(ranks.values()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(key, shared, pattern)
        for batch in batches:
            for a, b in text_slices(batch, "text", 2_000_000):
                part = batch.slice(a, b - a)
                tokens: list[np.ndarray] = []
                marks = []
                at = 0
                for role, text in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    head = np.concatenate([[first + BEGIN, first + HEAD], encoder.encode(escape(role)), [first + BODY]])
                    body = encoder.encode(escape(text))
                    if role == "assistant":
                        marks += [(at + len(head), 1), (at + len(head) + len(body), -1)]
                    tokens.append(np.concatenate([head, body, [first + END]]).astype(np.int32))
                    at += len(tokens[-1])
                step = np.zeros(at + 1, np.int32)
                for place, d in marks:
                    step[place] += d
                lists = int_lists(tokens)
                mask = pa.ListArray.from_arrays(lists.offsets, pa.array(np.cumsum(step)[:-1].astype(np.int8)))
                yield pa.RecordBatch.from_arrays([*part.columns, lists, mask], names=[*part.schema.names, "ids", "loss_mask"])

    return df.mapInArrow(run, "conv_id long, turn long, role string, text string, ids array<int>, loss_mask array<tinyint>")


class _Reader:
    """One conversation, read from its tokens."""

    def __init__(self, words: list[bytes]) -> None:
        self.words, self.first = words, len(words)
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def text(self, ids: np.ndarray) -> str:
        return b"".join([self.words[i] for i in ids]).decode()

    def add(self, ids: np.ndarray, mask: np.ndarray) -> None:
        cuts = np.flatnonzero(ids >= self.first)
        begin, head, body, end = cuts  # what the template puts into a turn
        role, text = self.text(ids[head + 1 : body]), self.text(ids[body + 1 : end])
        self.formatted_chars += len(role) + len(text) + sum(len(CONTROLS[ids[c] - self.first]) for c in cuts)
        self.turns.update(f"{unescape(role)}\n{unescape(text)}\n".encode())
        if mask.any():
            loss = unescape(self.text(ids[mask.astype(bool)]))
            self.loss.update(loss.encode())
            self.loss_chars += len(loss)
        self.n_turns += 1

    def row(self, conv) -> dict:
        return {"conv_id": conv, "n_turns": self.n_turns, "turns_sha256": self.turns.hexdigest(), "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.formatted_chars}


def _body(ids: np.ndarray, first: int) -> np.ndarray:
    """The ids of a turn's text."""
    cuts = np.flatnonzero(ids >= first)
    return ids[cuts[2] + 1 : cuts[3]]


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def digests(turns: DataFrame, ranks_path: str) -> DataFrame:
    """A row per conversation, read back from ids and loss_mask of format_turns()."""
    ranks = read_ranks(ranks_path)
    words = [b""] * (max(ranks.values()) + 1)
    for word, rank in ranks.items():
        words[rank] = word
    shared = turns.sparkSession.sparkContext.broadcast(words)
    # the text breaks ties of turn and role; it does not travel, its beginning and hash do, and `run` puts longer texts with one beginning in order
    keyed = turns.select("conv_id", "turn", "role", F.when(F.length("text") <= 40, F.col("text")).otherwise(F.concat(F.substring("text", 1, 40), F.sha2("text", 256))).alias("tie"), "ids", "loss_mask")
    together = keyed.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, conv, reader = shared.value, None, None
        done: list[dict] = []
        tied, waiting = None, {}  # of one turn, role and beginning: each text's ids, mask and number of rows

        def settle() -> None:
            for _, (ids, mask, n) in sorted(waiting.items(), key=lambda x: unescape(reader.text(_body(x[1][0], reader.first)))) if len(waiting) > 1 else waiting.items():
                for _ in range(n):
                    reader.add(ids, mask)
            waiting.clear()

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in (0, 1, 2, 3)))
            for i, (now, turn, role, tie) in enumerate(keys):
                if (now, turn, role, tie[:40]) != tied or len(tie) <= 40:
                    settle()
                    tied = (now, turn, role, tie[:40])
                if reader is None or now != conv:
                    if reader:
                        done.append(reader.row(conv))
                    conv, reader = now, _Reader(words)
                if tie in waiting:
                    waiting[tie][2] += 1
                else:
                    waiting[tie] = [*(batch.column(c)[i].values.to_numpy() for c in (4, 5)), 1]
            if len(done) >= 1000:
                yield pa.RecordBatch.from_pylist(done, _DIGEST)
                done = []
        settle()
        if reader:
            done.append(reader.row(conv))
        yield pa.RecordBatch.from_pylist(done, _DIGEST)

    return together.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
