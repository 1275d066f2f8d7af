"""Orders, ranks and top picks. Every window is partitioned and ends in an explicit tie-break, as Spark has no row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def visit_order(df: DataFrame, patient: str, study: str, date: str) -> DataFrame:
    """visit_order (0-based, by date and then study), days since the previous and the first visit, on every row.

    Windows run over distinct studies only, so their size does not grow with rows per study. Unknown differences are 0.
    """
    studies = df.groupBy(patient, study).agg(F.min(F.to_date(date)).alias("_date"))
    by = W.partitionBy(patient).orderBy(F.col("_date").asc_nulls_last(), study)
    first = F.min("_date").over(W.partitionBy(patient))
    studies = studies.select(
        patient, study,
        (F.row_number().over(by) - 1).alias("visit_order"),
        F.coalesce(F.datediff("_date", F.lag("_date").over(by)), F.lit(0)).alias("delay_since_prev_exam"),
        F.coalesce(F.datediff("_date", first), F.lit(0)).alias("delay_since_first_exam"),
    )
    return df.join(studies, [patient, study], "left")


def acquisition_order(df: DataFrame, study: Sequence[str], volume: str, stamp: str, numbers: Sequence[str], tie: str) -> DataFrame:
    """Per study over volumes: order by time, then numbers, nulls last; seconds since the previous and the first volume."""
    keys = [*study, volume]
    least = df.groupBy(*keys).agg(F.min(stamp).alias("_t"), *(F.min(n).alias(f"_{n}") for n in numbers), F.min(tie).alias("_tie"))
    by = W.partitionBy(*study).orderBy(F.col("_t").asc_nulls_last(), *(F.col(f"_{n}").asc_nulls_last() for n in numbers), "_tie", volume)
    seconds = F.unix_micros(F.col("_t").cast("timestamp")) / 1e6
    order = F.row_number().over(by) - 1
    out = least.select(
        *keys, order.alias("acquisition_order"),
        F.when(order == 0, F.lit(0.0)).otherwise(F.round(seconds - F.lag(seconds).over(by), 6)).alias("delay_since_prev_volume"),
        F.round(seconds - F.min(seconds).over(W.partitionBy(*study)), 6).alias("delay_since_first_volume"),
    )
    return df.join(out, keys, "left")


def ranked(df: DataFrame, by: Sequence[str | Column], order: Sequence[str | Column], name: str = "rank") -> DataFrame:
    """1-based place within the group."""
    return df.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order)))


def top(df: DataFrame, by: Sequence[str | Column], order: Sequence[str | Column], n: int = 1) -> DataFrame:
    """The first n rows of each group (Spark cuts each task's groups before the shuffle)."""
    return ranked(df, by, order, "_rank").filter(F.col("_rank") <= n).drop("_rank")


def series_order(df: DataFrame, series: Sequence[str], volume: str, stamp: str, order: str) -> DataFrame:
    """One row per volume: its order in the series, the series' size, whether several, and where the order comes from."""
    one = top(df, [*series, volume], [F.col(stamp).asc_nulls_last(), F.col(order).asc_nulls_last()])
    w = W.partitionBy(*series)
    times, orders = F.size(F.collect_set(stamp).over(w)), F.size(F.collect_set(order).over(w))
    return one.withColumns({
        "volume_order_in_series": F.row_number().over(w.orderBy(F.col(stamp).asc_nulls_last(), F.col(order).asc_nulls_last(), volume)),
        "n_volumes_in_series": F.count("*").over(w),
        "is_multivolume": F.count("*").over(w) > 1,
        "order_source": F.when((times > 1) | (orders > 1), "computed").otherwise("input_order"),
    })


def listed_position(c: Column, values: Sequence[str]) -> Column:
    """Place of a category in a priority list, unknown ones after the last."""
    at = F.array_position(F.array(*map(F.lit, values)), F.upper(F.trim(c)))
    return F.when(F.coalesce(at, F.lit(0)) == 0, len(values) + 1).otherwise(at)


def reference_rank(df: DataFrame, by: Sequence[str], criteria: Sequence[tuple], tie: str) -> DataFrame:
    """reference_rank i of n: criteria are (column, [values]) or (column, 'min' or 'max'); invalid numbers come last."""
    order = []
    for name, how in criteria:
        if isinstance(how, (list, tuple)):
            order.append(listed_position(F.col(name), how))
        else:
            n = F.col(name).cast("string").try_cast("double")
            n = F.when(~F.isnan(n), n)
            order.append(n.asc_nulls_last() if how == "min" else n.desc_nulls_last())
    w = W.partitionBy(*by)
    return df.withColumns({"reference_rank": F.row_number().over(w.orderBy(*order, tie)), "reference_of": F.count("*").over(w)})


def elapsed(df: DataFrame, by: Sequence[str], order: str, stamp: str, reference: str) -> DataFrame:
    """Seconds since the group's first row; null unless the group has exactly one reference value."""
    w = W.partitionBy(*by)
    seconds = F.unix_micros(F.col(stamp).cast("timestamp")) / 1e6
    one = (F.min(reference).over(w) == F.max(reference).over(w)) & (F.count(reference).over(w) == F.count("*").over(w))
    return df.withColumn("elapsed", F.when(one, F.round(seconds - F.min_by(seconds, order).over(w), 6)))


def chronology(df: DataFrame, by: Sequence[str], stamp: str, refine: str) -> DataFrame:
    """Dense rank by time; ties are split by `refine` only if it is complete and distinct inside the tie, else the rank is null."""
    tie = W.partitionBy(*by, stamp)
    usable = (F.count(refine).over(tie) == F.count("*").over(tie)) & (F.size(F.collect_set(refine).over(tie)) == F.count("*").over(tie))
    sure = (F.count("*").over(tie) == 1) | usable
    df = df.withColumns({"_sure": sure, "_refine": F.when(usable, F.col(refine))})
    rank = F.dense_rank().over(W.partitionBy(*by).orderBy(F.col(stamp).asc_nulls_last(), F.col("_refine").asc_nulls_last()))
    return df.withColumn("chronology", F.when(F.col("_sure") & F.col(stamp).isNotNull(), rank)).drop("_sure", "_refine")


def profile(df: DataFrame, by: Sequence[str], order: str, labels: dict[int, Sequence[str]]) -> DataFrame:
    """Labels by place for groups of known sizes whose order is complete and distinct."""
    w = W.partitionBy(*by)
    n = F.count("*").over(w)
    whole = (F.count(order).over(w) == n) & (F.size(F.collect_set(order).over(w)) == n)
    rank = F.row_number().over(w.orderBy(order))
    label = F.lit(None).cast("string")
    for size, names in labels.items():
        label = F.when(n == size, F.element_at(F.array(*map(F.lit, names)), F.least(rank, F.lit(len(names))))).otherwise(label)
    return df.withColumn("profile_label", F.when(whole, label))


def next_anchor(df: DataFrame, by: Sequence[str], order: str, anchor: Column) -> DataFrame:
    """The least order among later anchors, which bounds a row."""
    w = W.partitionBy(*by).orderBy(order).rangeBetween(1, W.unboundedFollowing)
    return df.withColumn("next_anchor", F.min(F.when(anchor, F.col(order))).over(w))


def first_acquisition(df: DataFrame, by: Sequence[str], candidates: Sequence[str]) -> DataFrame:
    """Whether a row is first in its group by the first candidate order that is complete and not constant; ties all are."""
    w = W.partitionBy(*by)
    n = F.count("*").over(w)
    first = F.lit(None).cast("boolean")
    for c in reversed(candidates):
        whole = (F.count(c).over(w) == n) & ((n == 1) | (F.min(c).over(w) < F.max(c).over(w)))
        first = F.when(whole, F.col(c) == F.min(c).over(w)).otherwise(first)
    return df.withColumn("is_first", F.coalesce(first, F.lit(False)))


def benjamini_hochberg(df: DataFrame, p: str, by: Sequence[str] = ()) -> DataFrame:
    """q-values over a result table (a row per test): running minimum from below of p * n / rank, at most 1."""
    w = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    rank = F.row_number().over(w.orderBy(p))
    df = df.withColumns({"_r": rank, "_n": F.count(p).over(w)})
    low = F.min(F.col(p) * F.col("_n") / F.col("_r")).over(w.orderBy("_r").rowsBetween(W.currentRow, W.unboundedFollowing))
    return df.withColumn("q_value", F.least(F.lit(1.0), low)).drop("_r", "_n")


def after_anchor(df: DataFrame, by: Sequence[str], order: str, anchor: Column) -> DataFrame:
    """The rows of a group that come after its first anchor: the anchors' minimum of each group, joined back, instead of a self join of the group's rows.

    Groups may be large and few: the minimum is partially aggregated, and no group meets in one task. Groups with a null key have no anchor.
    """
    first = df.filter(anchor).groupBy(*by).agg(F.min(order).alias("_first"))
    return df.join(first, list(by)).filter(F.col(order) > F.col("_first")).select(df.columns)


def n_largest(df: DataFrame, column: str, n: int, smallest: bool = False) -> DataFrame:
    """The rows whose value is among the n largest (or smallest), with all that tie with the last of them; nulls never are.

    The n-th value is found by a top-n of each task, merged; then the table is filtered by it. No window, and no sort of the table.
    """
    value = F.col(f"`{column}`")
    some = df.select(value.alias("_v")).filter("_v is not null").orderBy(F.asc("_v") if smallest else F.desc("_v")).limit(n)
    last = some.agg(F.max("_v") if smallest else F.min("_v")).first()[0]
    return df.filter(F.lit(False) if last is None else value <= last if smallest else value >= last)


def final_order(df: DataFrame, patient: str, date: str, seconds: str, tie: str) -> DataFrame:
    """Rows by patient (blank last), date and clock, nulls last."""
    key = F.when(F.coalesce(F.trim(F.col(patient).cast("string")), F.lit("")) == "", "~").otherwise(F.col(patient).cast("string"))
    return df.orderBy(key, F.col(date).asc_nulls_last(), F.col(seconds).asc_nulls_last(), tie)


def hash_sample(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """n rows without replacement, the same ones for the same seed whatever the partitioning."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)
