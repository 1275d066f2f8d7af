"""Which text columns hold clocks and dates, decided on a sample of values that is the same however the rows are dealt."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratiform.functions import clock as D

#: Fixed: names that are clocks whatever they hold, and parts of names of times that are no clocks.
CLOCKS = ("studytime", "seriestime", "acquisitiontime", "contenttime", "instancecreationtime", "acquisitiondatetime")
SPANS = ("duration", "interval", "latency", "delay", "elapsed", "repetition", "echo", "inversion", "exposure", "trigger", "frame")


def bottom_values(df: DataFrame, names: Sequence[str], k: int = 50) -> DataFrame:
    """column, value: of each column the k distinct filled values with the least hashes. All columns in one pass; a task hands on k values a column at most."""
    cells = [c for i, n in enumerate(names) for c in (F.xxhash64(f"`{n}`").alias(f"h{i}"), F.nullif(F.trim(F.col(f"`{n}`").cast("string")), F.lit("")).alias(f"v{i}"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: list[dict[tuple[int, str], None]] = [{} for _ in names]
        for batch in batches:
            for i in range(len(names)):
                h, v = batch.column(2 * i).to_numpy(), batch.column(2 * i + 1)
                bound = max(least[i])[0] if len(least[i]) >= k else None
                at = np.flatnonzero(v.is_valid().to_numpy(zero_copy_only=False) & (h <= bound if bound is not None else True))
                _, first = np.unique(h[at], return_index=True)  # equal values have equal hashes
                for j in at[first][: 2 * k]:
                    least[i][int(h[j]), v[int(j)].as_py()] = None
                least[i] = dict.fromkeys(sorted(least[i])[:k])
        rows = [(i, h, v) for i, found in enumerate(least) for h, v in found]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.string()))], names=["i", "h", "value"])

    found = df.select(*cells).mapInArrow(run, "i int, h long, value string").distinct()
    rank = F.row_number().over(W.partitionBy("i").orderBy("h", "value"))
    found = found.withColumn("_r", rank).filter(F.col("_r") <= k)
    return found.select(F.element_at(F.array(*map(F.lit, names)), F.col("i") + 1).alias("column"), "value")


@dataclass(frozen=True)
class Found:
    """Columns that hold clocks, and columns that hold dates with whether an ambiguous one has its day first."""

    clocks: tuple[str, ...]
    dates: Mapping[str, bool]


_PARTS = r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{2,4})"


def _readable(c: Column, day: int) -> Column:
    """Whether a date like 3/4/2020 can be read with the day in this place."""
    part = lambda i: F.regexp_extract(c, _PARTS, i).try_cast("int")
    return F.coalesce(part(day).between(1, 31) & part(3 - day).between(1, 12), F.lit(False))


def clocks_and_dates(df: DataFrame, k: int = 50, share: float = 0.5) -> Found:
    """Columns named time or date that hold such. Clocks: well-known names and ...datetime, else no name of a span and half of the sampled values read as clocks.

    The day stands first where more of the ambiguous values can be read so; of equal votes a day over 12 in the first place decides, then one in the second; without any it is first.
    """
    texts = [c for c, t in df.dtypes if t == "string"]
    times = [c for c in texts if "time" in c.lower()]
    dates = [c for c in texts if "date" in c.lower() and not c.lower().endswith(("datetime", "_source"))]
    sure = [c for c in times if c.lower() in CLOCKS or c.lower().endswith("datetime")]
    unsure = [c for c in times if c not in sure and not any(s in c.lower() for s in SPANS)]
    if not unsure and not dates:
        return Found(tuple(sure), {})
    v = F.col("value")
    told = bottom_values(df, [*unsure, *(d for d in dates if d not in unsure)], k).groupBy("column").agg(
        F.avg(D.clock(v).isNotNull().cast("int")).alias("clock"), F.count_if(_readable(v, 1)).alias("first"), F.count_if(_readable(v, 2)).alias("second"),
        F.max(F.regexp_extract(v, _PARTS, 1).try_cast("int")).alias("a"), F.max(F.regexp_extract(v, _PARTS, 2).try_cast("int")).alias("b"),
    ).collect()  # fmt: skip  a row per column
    votes = {r["column"]: r for r in told}
    first = lambda r: True if r is None else r["first"] > r["second"] if r["first"] != r["second"] else (r["a"] or 0) > 12 or not (r["b"] or 0) > 12
    clocks = [c for c in times if c in sure or (c in votes and c in unsure and votes[c]["clock"] >= share)]
    return Found(tuple(clocks), {c: first(votes.get(c)) for c in dates})


def day_of(c: Column, day_first: bool) -> Column:
    """A date of 8 digits, ISO with - or /, or with the day and month in the column's order."""
    s = F.trim(c.cast("string"))
    part = lambda i: F.lpad(F.regexp_extract(s, _PARTS, i), 2, "0")
    year = F.regexp_extract(s, _PARTS, 3)
    year = F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year)
    orders = ((1, 2), (2, 1)) if day_first else ((2, 1), (1, 2))  # a date that can't be read so is read the other way
    other = F.coalesce(*(F.try_to_date(F.concat_ws("-", year, part(m), part(d)), "yyyy-MM-dd") for d, m in orders))
    return F.coalesce(D.date(s), F.when(s.rlike(r"^\d{4}/\d{2}/\d{2}$"), F.try_to_date(s, "yyyy/MM/dd")), F.when(s.rlike(_PARTS), other))


def with_clocks_and_dates(df: DataFrame, found: Found | None = None) -> DataFrame:
    """df with its date columns as dates and its clock columns as seconds of the day; date-times keep their text."""
    found = found or clocks_and_dates(df)
    out = {c: day_of(F.col(f"`{c}`"), first) for c, first in found.dates.items()}
    out |= {c: D.clock(F.col(f"`{c}`")) for c in found.clocks if not c.lower().endswith("datetime")}
    return df.withColumns(out) if out else df
