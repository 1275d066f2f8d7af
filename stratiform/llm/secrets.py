"""Secret scans with multipart credential linking (operator 4).

Base kinds always count: `assign` (a secret's name, = or :, a value of 12 or more characters), `access` (access identifiers)
and `hex` (runs of 16 or more hex digits). Three weak kinds alone are noise: `ident` (user names, client ids), `weak`
(a secret's name with a value of 6 to 11 characters) and `endpoint` (URLs, host:port). An interval join links them:
parts of a text whose distance is at most SCOPE code points are in one scope, and a weak part is reported
only if complementary parts are in its scope:

    weak      with an identifier (access, ident) or an endpoint
    ident     with a secret (assign, weak)
    endpoint  with a secret and an identifier

A distance and not a block is the scope, as texts are of all kinds: parts of one configuration, log line or letter stand near each other whatever marks it has, and a
block that brackets or blank lines would make is longer or shorter than that as it happens.

The join is a sorted sweep per role: for each part the nearest part of the other role on either side decides, so a
text with n parts costs n log n, and no pair list is made. Each row is scanned whole and on its own, with no shuffle.

Defined cases: a null or empty text has no spans. Offsets are code points, the end exclusive. Matches of a kind are leftmost
and do not overlap; weak parts that overlap a base span are dropped. Repeated rows give a row each, extra columns stay.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import freed, text_slices

KINDS = ("assign", "access", "hex", "ident", "weak", "endpoint")
SCOPE = 300
MIN_ASSIGN, MIN_WEAK = 12, 6

_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}", re.ASCII)
_HEX = re.compile(r"[0-9a-f]{16,}", re.ASCII)
_IDENT = re.compile(r"""(?:user_?name|user|login|client_?id|account_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""", re.ASCII | re.IGNORECASE)
_ENDPOINT = re.compile(r"""[a-z][a-z0-9+]{1,15}://[^\s"'<>]+|(?<![A-Za-z0-9.-])[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+:[0-9]{2,5}(?![0-9])""", re.ASCII)

Span = tuple[int, int, int]  # start, index in KINDS, end


def scan(text: str | None) -> list[Span]:
    """All spans of a text, by start and kind."""
    if not text:
        return []
    lower = text.lower()
    strong: list[Span] = []
    weak: list[Span] = []
    if any(name in lower for name in _NAMES):
        for m in _ASSIGN.finditer(text):
            size = m.end(1) - m.start(1)
            if size >= MIN_ASSIGN:
                strong.append((m.start(), 0, m.end()))
            elif size >= MIN_WEAK:
                weak.append((m.start(), 4, m.end()))
    if "AKIA" in text:
        strong += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    secrets = bool(weak) or any(k == 0 for _, k, _ in strong)
    strong += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    if secrets:
        weak += [(m.start(), 3, m.end()) for m in _IDENT.finditer(text)]
        weak += [(m.start(), 5, m.end()) for m in _ENDPOINT.finditer(text)]
        strong += linked(sorted(strong), sorted(weak))
    return sorted(strong)


def linked(strong: list[Span], weak: list[Span]) -> list[Span]:
    """The weak spans that complementary parts within SCOPE confirm. Both lists are sorted."""
    starts, reach = [s for s, _, _ in strong], []
    for _, _, e in strong:
        reach.append(max(e, reach[-1] if reach else 0))

    def free(span: Span) -> bool:
        at = bisect_left(starts, span[2])
        return not at or reach[at - 1] <= span[0]

    weak = [w for w in weak if free(w)]
    parts = strong + weak
    roles = {
        "secret": _Role(s for s in parts if s[1] in (0, 4)),
        "identifier": _Role(s for s in parts if s[1] in (1, 3)),
        "endpoint": _Role(s for s in parts if s[1] == 5),
    }
    near = {name: role.near for name, role in roles.items()}
    out = []
    for span in weak:
        if span[1] == 4 and (near["identifier"](span) or near["endpoint"](span)) or span[1] == 3 and near["secret"](span) or span[1] == 5 and near["secret"](span) and near["identifier"](span):
            out.append(span)
    return out


class _Role:
    """Spans of one role, sorted by start, with the furthest end so far."""

    def __init__(self, spans) -> None:
        self.starts, self.reach = [], []
        for start, _, end in sorted(spans):
            self.starts.append(start)
            self.reach.append(max(end, self.reach[-1] if self.reach else 0))

    def near(self, span: Span) -> bool:
        """Whether a span of this role lies within SCOPE of the given one (which has another role)."""
        at = bisect_right(self.starts, span[2] + SCOPE)
        return bool(at) and self.reach[at - 1] >= span[0] - SCOPE


def redact(text: str, spans: list[Span]) -> str:
    """The text with a placeholder for every span; what an earlier span has covered isn't replaced again."""
    out, at = [], 0
    for start, kind, end in spans:
        out.append(text[at : max(start, at)])
        if end > at:
            out.append(f"[{KINDS[kind].upper()}]")
            at = end
    return "".join(out) + text[at:]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def find_secrets(df: DataFrame, text: str = "text", spans: str = "spans", redacted: str | None = None) -> DataFrame:
    """df with `spans`, an array of (kind, start, end) by start and then kind, and if asked for `redacted`, the text with placeholders for them; columns already so named are replaced."""
    new = [spans, *([redacted] if redacted else [])]
    df = df.select([f"`{c}`" for c in df.columns if c not in new or c == text])
    kept = [c for c in df.columns if c not in new]
    types = ("array<struct<kind:string,start:int,end:int>>", "string")
    schema = df.select([f"`{c}`" for c in kept] + [F.lit(None).cast(t).alias(c) for c, t in zip(new, types)]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch, text, 4_000_000):
                part = batch.slice(a, b - a)
                get = lambda c: part.column(part.schema.get_field_index(c))  # noqa: B023, E731
                texts = get(text).to_pylist()
                found = [scan(t) for t in texts]
                columns = [pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in f] for f in found], pa.list_(_SPAN))]
                if redacted:
                    columns.append(pa.array([redact(t, f) if f else t for t, f in zip(texts, found)], pa.string()))
                yield pa.RecordBatch.from_arrays([*(get(c) for c in kept), *columns], names=[*kept, *new])

    return df.mapInArrow(freed(run), schema)


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*KINDS[:3]))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
