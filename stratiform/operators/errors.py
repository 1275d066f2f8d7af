"""Rows that fail go to a table of their own, with a message, out of the same evaluation that gives the results."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.functions.rules import blank
from stratiform.shared import written

ERROR = "error_message"


def checked(df: DataFrame, outputs: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """df with columns `output`: (value, input), and `error_message`: which inputs are filled but give no value; null where none."""
    values = {name: value for name, (value, _) in outputs.items()}
    found = df.withColumns({f"_v_{n}": v for n, v in values.items()})
    said = [F.when(F.col(f"_v_{n}").isNull() & ~blank(given), F.concat(F.lit(f"{n}: cannot read "), given.cast("string"))) for n, (_, given) in outputs.items()]
    found = found.withColumn("_said", F.nullif(F.concat_ws("; ", *said), F.lit("")))
    return found.withColumns({**{n: F.col(f"_v_{n}") for n in outputs}, ERROR: F.col("_said")}).drop("_said", *(f"_v_{n}" for n in outputs))


def hooked(df: DataFrame, function: Callable[..., Any], inputs: Sequence[str], outputs: Mapping[str, str], on_error: str = "raise") -> DataFrame:
    """A user's Python function over the values of a row as several columns {name: type}; for what Columns can't say.

    The function gives a value (one output), a tuple, or a dictionary by name. With on_error="record" a row whose call fails has null outputs and the error in `error_message`.
    """
    names, record = list(outputs), on_error == "record"
    schema = ", ".join(f"`{n}` {t}" for n, t in [*outputs.items(), *([(ERROR, "string")] if record else [])])

    def one(row: tuple) -> list:
        try:
            got = function(*row)
        except Exception as e:  # noqa: BLE001  it is told in the row
            if not record:
                raise
            return [*[None] * len(names), f"{type(e).__name__}: {e}"]
        values = [got.get(n) for n in names] if isinstance(got, Mapping) else list(got) if isinstance(got, tuple) else [got]
        if len(values) != len(names):
            raise ValueError(f"{len(values)} values for {names}")
        return values + [None] * record

    @F.pandas_udf(f"struct<{', '.join(x.replace(' ', ':', 1) for x in schema.split(', '))}>")
    def call(rows: pd.DataFrame) -> pd.DataFrame:
        found = [one(tuple(None if isinstance(v, float) and v != v else v for v in row)) for row in rows.itertuples(index=False, name=None)]
        return pd.DataFrame({n: pd.Series([f[i] for f in found], dtype=object) for i, n in enumerate([*names, *([ERROR] if record else [])])})

    out = df.withColumn("_out", call(F.struct(*(F.col(f"`{c}`") for c in inputs))))
    return out.withColumns({n: F.col(f"_out.`{n}`") for n in [*names, *([ERROR] if record else [])]}).drop("_out")


def parted(df: DataFrame, message: str = ERROR, name: str = "evaluated") -> tuple[DataFrame, DataFrame]:
    """(rows without a message, rows with one), read from one written table that has them in separate folders: whatever made df runs once."""
    rows = df.withColumn("_failed", F.col(message).isNotNull())
    stored = written(rows, name, by=["_failed"])
    return stored.filter("not _failed").drop("_failed", message), stored.filter("_failed").drop("_failed")


def joined_back(df: DataFrame, errors: DataFrame, key: str, message: str = ERROR) -> DataFrame:
    """All rows of df with the messages of their failures, in order, as one text; null where none failed."""
    one = errors.groupBy(F.col(key).alias("_k")).agg(F.array_join(F.array_sort(F.collect_list(message)), " | ").alias(message))
    return df.drop(message).join(one, F.col(key).eqNullSafe(F.col("_k")), "left").drop("_k")


def any_error(tables: Mapping[str, DataFrame], key: str, message: str = ERROR) -> DataFrame:
    """The error tables of several stages as one: key, stage, message."""
    return reduce(DataFrame.unionByName, [t.select(key, F.lit(stage).alias("stage"), F.col(message).alias(message)) for stage, t in tables.items()])
