"""Exact ranks and percentiles without a task per group: values are counted, and the counts are dealt to pieces of their group by value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratiform.shared import discard, written, written_at

#: Distinct values that one window goes through. No result depends on it.
PIECE = 200_000


def same(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Joined on `by`, nulls being equal; the columns of `by` come from the left."""
    right = right.withColumnsRenamed({c: f"_r_{c}" for c in by})
    on: Column = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in by))
    return left.join(right, on, how).drop(*(f"_r_{c}" for c in by))


def cumulated(rows: DataFrame, by: Sequence[str], value: str = "value", sides: Mapping[str, Column] | None = None, points: Sequence[float] | None = None) -> DataFrame:
    """by, value, _k (rows of that value), _before (rows of lesser values) and _n (rows of the group) of non-null values; for each of `sides`
    (conditions by name) also _k_<name>, _before_<name>, _n_<name>, counting its rows only.

    A hot value is one row after the partial count; the counts are written, and how many values the largest group has is known before they are cut. If it
    has over PIECE values, all are dealt by ranges of group and value to pieces of some PIECE values; sums run within a piece, and a piece starts
    at the sum of those before it in its group, so no window holds much more than PIECE rows and each value is placed by its range alone, however many pieces
    there are. With `points`, values of pieces that hold none of these percentiles may be left out.
    """
    weights = {"": F.count("*"), **{f"_{name}": F.count_if(c) for name, c in (sides or {}).items()}}
    counts = rows.filter(F.col(value).isNotNull()).groupBy(F.struct(*by).alias("_g"), value).agg(*(w.alias(f"_k{s}") for s, w in weights.items()))  # fields of a struct are equal where both are null
    counts, path = written_at(counts, "counts")
    most, total = counts.groupBy("_g").count().agg(F.max("count"), F.sum("count")).first()
    group, sums = W.partitionBy("_g"), {s: F.col(f"_k{s}") for s in weights}
    lesser = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    if (most or 0) <= PIECE:
        ordered = group.orderBy(value)
        whole = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        found = counts.select("*", *(lesser(ordered, c).alias(f"_before{s}") for s, c in sums.items()), *(F.sum(c).over(whole).alias(f"_n{s}") for s, c in sums.items()))
    else:
        # written, as a sample draws the ranges: all that follows sees the same pieces
        counts = written(counts.repartitionByRange(-(-total // PIECE), "_g", value).withColumn("_piece", F.spark_partition_id()), "pieces")
        discard(rows.sparkSession, path)
        starts = counts.groupBy("_g", "_piece").agg(*(F.sum(c).alias(f"_sum{s}") for s, c in sums.items()))
        ahead = group.orderBy("_piece")
        starts = starts.select("_g", "_piece", "_sum", *(lesser(ahead, F.col(f"_sum{s}")).alias(f"_start{s}") for s in sums), *(F.sum(f"_sum{s}").over(group).alias(f"_n{s}") for s in sums))
        if points is not None:
            at = [f(F.lit(float(p)) * (F.col("_n") - 1)) for p in points for f in (F.floor, F.ceil)]
            starts = starts.filter(reduce(lambda a, b: a | b, ((F.col("_start") <= i) & (i < F.col("_start") + F.col("_sum")) for i in at), F.lit(False)))
            counts = counts.join(F.broadcast(starts.select("_piece").distinct()), "_piece", "left_semi")  # at most a number per PIECE values
        inside = W.partitionBy("_g", "_piece").orderBy(value)
        found = counts.select("*", *(lesser(inside, c).alias(f"_in{s}") for s, c in sums.items())).join(starts.drop("_sum"), ["_g", "_piece"])
        found = found.withColumns({f"_before{s}": F.col(f"_start{s}") + F.col(f"_in{s}") for s in sums})
    return found.select(*(F.col(f"_g.{c}").alias(c) for c in by), value, *(f"_{x}{s}" for s in sums for x in ("k", "before", "n")))


def percentiles_of(counts: DataFrame, by: Sequence[str], points: Sequence[float], value: str = "value", side: str = "") -> DataFrame:
    """by, _n and _p, an array of exact percentiles with linear interpolation, from cumulated(), of all rows or (`side`: _<name>) of one of its sides."""
    n, before, k = (F.col(f"_{x}{side}") for x in ("n", "before", "k"))
    at = [F.lit(float(p)) * (F.col("_n") - 1) for p in points]
    holds = lambda i: F.max(F.when((before <= i) & (i < before + k), F.col(value).cast("double")))
    found = counts.groupBy(*by, n.alias("_n")).agg(*(holds(f(x)).alias(f"_{name}{i}") for i, x in enumerate([F.lit(float(p)) * (n - 1) for p in points]) for name, f in (("low", F.floor), ("high", F.ceil))))
    between = lambda i, x: F.col(f"_low{i}") + (F.col(f"_high{i}") - F.col(f"_low{i}")) * (x - F.floor(x))
    level = lambda i, x: F.when(F.col(f"_low{i}") == F.col(f"_high{i}"), F.col(f"_low{i}")).otherwise(between(i, x))
    return found.select(*by, "_n", F.array(*(level(i, x) for i, x in enumerate(at))).alias("_p"))


def percentiles(rows: DataFrame, by: Sequence[str], points: Sequence[float], value: str = "value") -> DataFrame:
    """by and _p, an array of exact percentiles; groups without a value are absent."""
    return percentiles_of(cumulated(rows, by, value, points=points), by, points, value).drop("_n")
