"""Aggregations: slice-to-volume rollup, volume identity, splitting and merging of stacks, counts and pivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def one(values: Column) -> Column:
    """The single element of an array, null unless there is exactly one."""
    return F.when(F.size(values) == 1, F.element_at(values, 1))


def volumes(df: DataFrame, key: str, columns: Sequence[str], earliest: Mapping[str, str] | None = None) -> DataFrame:
    """One row per key: for each column the sorted distinct values and `<col>_one`; n_files; earliest value with its source.

    `earliest` maps a value column to its provenance column. Rows without a key drop out.
    """
    aggs = [F.count("*").alias("n_files")]
    for c in columns:
        aggs.append(F.array_sort(F.collect_set(c)).alias(c))
    for value, source in (earliest or {}).items():
        first = F.min(F.when(F.col(value).isNotNull(), F.struct(value, source)))
        aggs += [first[value].alias(value), first[source].alias(source)]
    out = df.filter(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    return out.withColumns({f"{c}_one": one(F.col(c)) for c in columns})


def volume_length(n: Column, thickness: Column, spacing: Column) -> Column:
    return F.abs(thickness) + (n - 1) * F.abs(F.coalesce(spacing, thickness))


def position_histogram(df: DataFrame, keys: Sequence[str], slice_key: str) -> DataFrame:
    """Per series: distinct positions, share of repeated ones, modal count (least of equals), whether counts differ."""
    counts = df.groupBy(*keys, slice_key).agg(F.count("*").alias("n"))
    by_n = counts.groupBy(*keys, "n").agg(F.count("*").alias("freq"))
    return by_n.groupBy(*keys).agg(
        F.sum("freq").alias("n_unique"),
        (F.sum(F.when(F.col("n") > 1, F.col("freq")).otherwise(0)) / F.sum("freq")).alias("repeated"),
        F.max_by("n", F.struct("freq", (-F.col("n")).alias("m"))).alias("modal_count"),
        (F.count("*") > 1).alias("irregular"),
    )


def split_stacks(df: DataFrame, keys: Sequence[str], slice_key: str, order: Sequence[str | Column], volume: str, min_slices: int = 8, min_fraction: float = 0.7) -> DataFrame:
    """A series whose positions mostly repeat becomes as many volumes as its modal count; others keep their volume id.

    Adds n_detected and volume_number; the new id is a hash of the series' keys and the number.
    """
    stats = position_histogram(df, keys, slice_key)
    split = (F.col("n_unique") >= min_slices) & (F.col("repeated") >= min_fraction) & (F.col("modal_count") > 1)
    df = df.join(stats.select(*keys, split.alias("_split"), "modal_count"), list(keys), "left")
    number = F.row_number().over(W.partitionBy(*keys, slice_key).orderBy(*order))
    hit = F.coalesce(F.col("_split"), F.lit(False))
    new = F.sha1(F.concat_ws("||", *(F.col(k).cast("string") for k in keys), F.concat(F.lit("vol"), number.cast("string"))))
    df = df.withColumns({"volume_number": F.when(hit, number).otherwise(1), "n_detected": F.when(hit, F.col("modal_count")).otherwise(1).cast("long"), "_new": new})
    return df.withColumn(volume, F.when(hit, F.col("_new")).otherwise(F.col(volume))).drop("_split", "_new", "modal_count")


def even_spacing(positions: Column, tolerance: float) -> Column:
    """Whether sorted distinct positions are equally far apart: |d - d0| <= tolerance + 1e-5 * |d0|."""
    gaps = F.zip_with(F.slice(positions, 2, F.greatest(F.size(positions) - 1, F.lit(0))), F.slice(positions, 1, F.greatest(F.size(positions) - 1, F.lit(0))), lambda b, a: b - a)
    first = F.try_element_at(gaps, F.lit(1))
    return (F.size(positions) > 1) & F.forall(gaps, lambda d: F.abs(d - first) <= tolerance + 1e-5 * F.abs(first))


def merge_fragments(df: DataFrame, group: Sequence[str], volume: str, z: str, tolerance: float = 1e-3) -> DataFrame:
    """Several volume ids in one geometry group whose positions are evenly spaced get one id, a hash of the sorted ids.

    An id in several such groups takes the one of the greatest group key.
    """
    groups = df.groupBy(*group).agg(F.array_sort(F.collect_set(volume)).alias("_ids"), F.array_sort(F.collect_set(z)).alias("_z"))
    groups = groups.filter((F.size("_ids") > 1) & even_spacing(F.col("_z"), tolerance))
    new = groups.select(F.struct(*group).alias("_g"), F.sha1(F.concat_ws("|", "_ids")).alias("_new"), F.explode("_ids").alias(volume))
    new = new.groupBy(volume).agg(F.max_by("_new", "_g").alias("_new"))
    return df.join(new, volume, "left").withColumn(volume, F.coalesce("_new", volume)).drop("_new")


def stable_id(columns: Sequence[str | Column]) -> Column:
    """SHA-1 of the columns' texts joined by ||, nulls as empty."""
    return F.sha1(F.concat_ws("||", *(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns)))


def grain_counts(df: DataFrame, grains: Mapping[str, Sequence[str]], by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*(F.count_distinct(*(F.col(c) for c in cols)).alias(name) for name, cols in grains.items()))


def other_candidates(df: DataFrame, by: Sequence[str], rank: str, text: Column, name: str = "others") -> DataFrame:
    """The runners-up of each group as one text, in order of rank."""
    rows = F.array_sort(F.collect_list(F.when(F.col(rank) > 1, F.struct(F.col(rank).alias("r"), text.alias("t")))))
    return df.groupBy(*by).agg(F.array_join(F.transform(rows, lambda x: x["t"]), "; ").alias(name))


def wide(df: DataFrame, exam: Sequence[str], slot: str, slots: Sequence[str], value: Column, rank: str, text: Column) -> DataFrame:
    """One row per exam: for every slot its winner and a text of the other candidates. The slot list is given, so no pass finds it."""
    rows = df.select(*exam, slot, F.col(rank).alias("_r"), value.alias("_v"), text.alias("_t"))
    aggs = []
    for s in slots:
        mine = F.col(slot) == s
        aggs.append(F.max(F.when(mine & (F.col("_r") == 1), F.col("_v"))).alias(s))
        others = F.array_sort(F.collect_list(F.when(mine & (F.col("_r") > 1), F.struct("_r", "_t"))))
        aggs.append(F.array_join(F.transform(others, lambda x: x["_t"]), "; ").alias(f"{s}_other_candidates"))
    return rows.groupBy(*exam).agg(*aggs)


def drop_all_null(df: DataFrame, protect: Sequence[str] = ()) -> DataFrame:
    """Without the columns that hold nothing, in one pass; protected ones stay."""
    names = [c for c in df.columns if c not in protect]
    if not names:
        return df
    filled = df.agg(*(F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(names))).first()
    return df.drop(*(c for i, c in enumerate(names) if not filled[i]))
