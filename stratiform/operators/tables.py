"""Joins, derived columns and reports that stages share."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.functions.text import uniform


def ensure_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Absent columns as typed nulls."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def in_order(df: DataFrame, first: Sequence[str]) -> DataFrame:
    head = [c for c in first if c in df.columns]
    return df.select(*(f"`{c}`" for c in [*head, *(c for c in df.columns if c not in head)]))


def with_key(df: DataFrame, key: str, hook: Callable[[Column], Column]) -> DataFrame:
    """The key standardised by a hook; the raw one stays as _<key>_raw, and a flag marks keys that were lost."""
    raw = F.col(key)
    new = hook(raw)
    lost = F.coalesce(F.trim(raw.cast("string")) != "", F.lit(False)) & F.coalesce(F.trim(new.cast("string")) == "", F.lit(True))
    return df.withColumns({f"_{key}_raw": raw, f"_{key}_lost": lost, key: new})


def derive(df: DataFrame, columns: Mapping[str, Column], mode: str = "overwrite") -> DataFrame:
    """Derived columns; missing_only leaves those that the table has."""
    return df.withColumns({c: v for c, v in columns.items() if mode == "overwrite" or c not in df.columns})


def looked_up(df: DataFrame, column: str, table: DataFrame, key: str, value: str, out: str, default: Column | None = None) -> DataFrame:
    """A code table's value for each row; the table has one row per key (the first by value, if not)."""
    one = table.groupBy(F.col(key).alias("_k")).agg(F.min(value).alias("_v"))
    found = F.coalesce("_v", default) if default is not None else F.col("_v")
    return df.join(one, df[column] == one["_k"], "left").withColumn(out, found).drop("_k", "_v")


def described_as(df: DataFrame, column: str, table: DataFrame, out: str = "label") -> DataFrame:
    """Labels of normalised descriptions (table: text, label); texts without one keep their text."""
    named = df.withColumn("_u", uniform(F.col(column)))
    names = table.groupBy(uniform(F.col("text")).alias("_u")).agg(F.min("label").alias("_l"))
    return named.join(names, "_u", "left").withColumn(out, F.coalesce("_l", "_u")).drop("_u", "_l")


def mapped_lists(df: DataFrame, key: str, cells: str, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """List cells through a lookup (path, target), order kept; unknown elements go, rows left with none are the second table."""
    flat = df.select(key, F.posexplode(cells).alias("_i", "path")).join(mapping, "path", "left")
    back = flat.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.when(F.col("target").isNotNull(), F.struct("_i", "target")))), lambda x: x["target"]).alias(cells))
    out = df.drop(cells).join(back, key, "left").withColumn(cells, F.coalesce(cells, F.array().cast("array<string>")))
    lost = out.filter(F.size(cells) == 0).select(key, F.lit("no element of the cell could be mapped").alias("message"))
    return out.filter(F.size(cells) > 0), lost


def with_messages(df: DataFrame, errors: DataFrame, key: str) -> DataFrame:
    """All messages of a row as one text."""
    one = errors.groupBy(key).agg(F.array_join(F.sort_array(F.collect_list("message")), " | ").alias("errors"))
    return df.join(one, key, "left")


def status_report(df: DataFrame, group: str, status: str) -> DataFrame:
    """Per group a JSON object of how many rows have which status."""
    counts = df.groupBy(group, status).agg(F.count("*").alias("n"))
    entries = F.sort_array(F.collect_list(F.struct(F.col(status).alias("key"), F.col("n").alias("value"))))
    return counts.groupBy(group).agg(F.to_json(F.map_from_entries(entries)).alias("counts"))


def expanded(df: DataFrame, cells: str, size: int, drop_null: bool = True) -> DataFrame:
    """List cells as positional columns <cells>_value_1..size."""
    df = df.filter(F.col(cells).isNotNull()) if drop_null else df
    return df.withColumns({f"{cells}_value_{i}": F.try_element_at(F.col(cells), F.lit(i)) for i in range(1, size + 1)})


def protocol_matches(df: DataFrame, group: Sequence[str], text: str, pattern: str) -> DataFrame:
    """Rows without an ordinal token whose text, that token aside, is that of a numbered row of the group."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), pattern, " "), r"\s+", " "))
    rows = df.withColumns({"_bare": bare, "_numbered": F.lower(text).rlike(pattern)})
    numbered = rows.filter("_numbered").select(*group, "_bare").distinct()
    return rows.filter("not _numbered").join(numbered, [*group, "_bare"], "left_semi").drop("_bare", "_numbered")


def require(df: DataFrame, columns: Sequence[str], allow_blank: bool = False) -> DataFrame:
    """df, or ValueError if a column is absent or, unless allowed, blank anywhere (one pass)."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"columns {absent} are missing")
    if not allow_blank and columns:
        row = df.agg(*(F.count_if(F.coalesce(F.trim(F.col(f"`{c}`").cast("string")) == "", F.lit(True))).alias(f"c{i}") for i, c in enumerate(columns))).first()
        blank = [c for i, c in enumerate(columns) if row[i]]
        if blank:
            raise ValueError(f"columns {blank} have blank values")
    return df


def interval_join(df: DataFrame, value: str, windows: DataFrame, name: str, low: str = "low", high: str = "high") -> DataFrame:
    """df with the name of the one window (name, low, high; ends included) that its value lies in; null in none or in several.

    The windows are a table of settings. Their ends cut the line into pieces, of which each has its one name or none; so a row finds its piece by equality with
    the place of its value among the sorted ends, and no row meets more than one window.
    """
    ends = sorted({float(x) for r in windows.select(low, high).collect() for x in r})
    rows = windows.select(name, low, high).collect()
    at = lambda x: [r[name] for r in rows if float(r[low]) <= x <= float(r[high])]
    # places: 2 * i is the i-th end itself, 2 * i + 1 what lies between it and the next
    names = [at(x) for i, e in enumerate(ends) for x in (e, (e + ends[i + 1]) / 2 if i + 1 < len(ends) else float("inf"))]
    one = F.array(*(F.lit(n[0] if len(n) == 1 else None).cast("string") for n in names)) if names else F.array().cast("array<string>")
    v, bounds = F.col(f"`{value}`").cast("double"), F.array(*map(F.lit, ends)) if ends else F.array().cast("array<double>")
    below = F.size(F.filter(bounds, lambda e: e <= v))
    place = 2 * below - F.when(F.array_contains(bounds, v), 1).otherwise(0)  # from 1 on; 0 lies before all
    return df.withColumn(name, F.when(v.isNotNull() & (place > 0), F.try_element_at(one, place.cast("int"))))


def settings_for(df: DataFrame, column: str, settings: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Settings by modality as columns; a modality without settings is an error."""
    spark = df.sparkSession
    names = sorted({k for s in settings.values() for k in s})
    table = spark.createDataFrame([(m, *(float(s[n]) if n in s else None for n in names)) for m, s in settings.items()], f"{column} string, " + ", ".join(f"{n} double" for n in names))
    unknown = df.select(column).distinct().join(table, column, "left_anti").limit(5).collect()
    if unknown:
        raise ValueError(f"no settings for {[r[0] for r in unknown]}")
    return df.join(F.broadcast(table), column)


def joined_once(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """df with the columns of other, of which each row of df may have one match at most: a key that repeats in other is an error when the result is used."""
    rest = [c for c in other.columns if c not in on]
    one = other.groupBy(*on).agg(F.first(F.struct(*rest)).alias("_r"), F.count("*").alias("_n"))
    one = one.withColumn("_r", F.when(F.col("_n") == 1, F.col("_r")).otherwise(F.raise_error(F.concat_ws(" ", F.lit("repeated key"), *(F.col(c).cast("string") for c in on)))))
    return df.join(one.drop("_n"), list(on), "left").select(*df.columns, *(F.col(f"_r.`{c}`").alias(c) for c in rest))


def feature_columns(df: DataFrame, keys: Sequence[str], prefix: str, without: str = "diagnostics_") -> DataFrame:
    """The keys, and all other columns but those that begin with `without`, with a prefix before their names."""
    return df.select(*keys, *(F.col(f"`{c}`").alias(prefix + c) for c in df.columns if c not in keys and not c.startswith(without)))
