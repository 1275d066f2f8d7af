"""Column profiles and feature statistics. Exact by default; wide aggregates in one pass, ranks and percentiles by pieces of a feature's values."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratiform.functions.rules import blank
from stratiform.operators.ordering import benjamini_hochberg
from stratiform.operators.ranks import cumulated, percentiles_of, percentiles, same


def unpivoted(df: DataFrame, names: Sequence[str], keys: Sequence[str] = (), name: str = "feature", value: str = "value") -> DataFrame:
    """Long form: a row per key and column, values as text unless all are numeric."""
    numeric = all(t in ("int", "bigint", "double", "float", "smallint", "tinyint") for c, t in df.dtypes if c in names)
    cells = F.array(*(F.struct(F.lit(c).alias(name), F.col(f"`{c}`").cast("double" if numeric else "string").alias(value)) for c in names))
    return df.select(*keys, F.explode(cells).alias("_x")).select(*keys, "_x.*")


def coverage(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """column, present, missing, percent, distinct: one aggregation over the table."""
    aggs = [F.count("*").alias("_n")]
    for i, c in enumerate(names):
        aggs += [F.count(f"`{c}`").alias(f"p{i}"), F.count_distinct(f"`{c}`").alias(f"d{i}")]
    rows = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"p{i}").alias("present"), (F.col("_n") - F.col(f"p{i}")).alias("missing"), (F.col(f"p{i}") * 100 / F.col("_n")).alias("percent"), F.col(f"d{i}").alias("distinct")) for i, c in enumerate(names)))
    return df.agg(*aggs).select(F.explode(rows).alias("r")).select("r.*")


def cardinality(df: DataFrame, names: Sequence[str], share: float = 0.8) -> DataFrame:
    """column, type, distinct, rows, and whether a column has more distinct values than `share` of the rows: one aggregation."""
    types = dict(df.dtypes)
    aggs = [F.count("*").alias("_n"), *(F.count_distinct(f"`{c}`").alias(f"d{i}") for i, c in enumerate(names))]
    rows = F.array(*(F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.col(f"d{i}").alias("distinct"), F.col("_n").alias("rows"), (F.col(f"d{i}") > share * F.col("_n")).alias("mostly_distinct")) for i, c in enumerate(names)))
    return df.agg(*aggs).select(F.explode(rows).alias("r")).select("r.*")


def critical_digest(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """column, rows, missing (null or blank) for critical columns; one that the table lacks is missing in every row."""
    gone = [blank(F.col(f"`{c}`")) if c in df.columns else F.lit(True) for c in names]
    aggs = [F.count("*").alias("_n"), *(F.count_if(g).alias(f"m{i}") for i, g in enumerate(gone))]
    rows = F.array(*(F.struct(F.lit(c).alias("column"), F.col("_n").alias("rows"), F.col(f"m{i}").alias("missing")) for i, c in enumerate(names)))
    return df.agg(*aggs).select(F.explode(rows).alias("r")).select("r.*")


def variance_ranking(df: DataFrame, names: Sequence[str], n: int = 20) -> DataFrame:
    """rank, feature, variance of the n features that vary most; a tie goes by name. A row per feature is ranked, whatever the rows."""
    variances = unpivoted(df, names).groupBy("feature").agg(F.var_samp("value").alias("variance"))
    rank = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.desc_nulls_last("variance"), "feature"))
    return variances.select(rank.alias("rank"), "feature", "variance").filter(F.col("rank") <= n)


def trajectory(df: DataFrame, patient: str, visit: str, feature: str) -> DataFrame:
    """Mean, deviation and number of a feature's values for each visit of a patient."""
    value = F.col(feature)
    return df.groupBy(patient, visit).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.count(value).alias("n"))


def label_coverage(df: DataFrame, exam: Sequence[str], label: str) -> DataFrame:
    """Per exam how many distinct labels it has, and which."""
    return df.groupBy(*exam).agg(F.count_distinct(label).alias("n"), F.array_sort(F.collect_set(label)).alias("labels"))


def group_statistics(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Per group count, mean, exact median, least and greatest value. Groups may be few and large (a modality): the median comes from counted values, not from a list of them."""
    rows = df.select(*by, F.col(f"`{value}`").cast("double").alias("value"))
    out = rows.groupBy(*by).agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.min("value").alias("low"), F.max("value").alias("high"))
    return same(out, percentiles(rows, by, (0.5,)), by, "left").select(*by, "n", "mean", F.col("_p")[0].alias("median"), "low", "high")


def top_values(df: DataFrame, names: Sequence[str], n: int = 20) -> DataFrame:
    counts = unpivoted(df, names, name="column").groupBy("column", "value").agg(F.count("*").alias("n"))
    rank = F.row_number().over(W.partitionBy("column").orderBy(F.desc("n"), "value"))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= n)


def described(df: DataFrame, names: Sequence[str], points: Sequence[float], by: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """Per feature: count, missing share, mean, deviation, min, percentiles, max, coefficient of variation; infinite is missing.

    `exact=False` takes percentiles from a bounded sketch, in the same aggregate.
    """
    key = [*by, "feature"]
    long = unpivoted(df, names, by).withColumn("value", F.when(F.abs("value") < float("inf"), F.col("value")))
    sketch = [] if exact else [F.percentile_approx("value", F.array(*(F.lit(float(p)) for p in points)), 10_000).alias("_p")]
    out = long.groupBy(*key).agg(
        F.count("value").alias("n"), (1 - F.count("value") / F.count("*")).alias("missing"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), *sketch, F.max("value").alias("max"), F.try_divide(F.stddev_samp("value"), F.avg("value")).alias("cv"),
    )
    out = same(out, percentiles(long, key, points), key, "left") if exact else out
    return out.select(*key, "n", "missing", "mean", "std", "min", *(F.col("_p")[i].alias(f"p{round(p * 100)}") for i, p in enumerate(points)), "max", "cv")


def outliers(df: DataFrame, names: Sequence[str], factor: float = 1.5) -> DataFrame:
    """Values outside the quartiles by more than `factor` ranges, of features with four values or more."""
    quartiles = (0.25, 0.75)
    q = percentiles_of(cumulated(unpivoted(df, names), ["feature"], points=quartiles), ["feature"], quartiles).filter("_n >= 4")
    reach = factor * (F.col("_p")[1] - F.col("_p")[0])
    ends = {"n": F.col("_n"), "low": F.col("_p")[0] - reach, "high": F.col("_p")[1] + reach}
    # the ends of all features are one row, sent to the rows of the table, which stay where they are
    row = q.agg(*(F.max(F.when(F.col("feature") == c, e)).alias(f"_{name}{i}") for i, c in enumerate(names) for name, e in ends.items()))
    cells = df.select(*(F.col(f"`{c}`").cast("double").alias(f"_c{i}") for i, c in enumerate(names))).crossJoin(F.broadcast(row))
    out = lambda i: (F.col(f"_c{i}") < F.col(f"_low{i}")) | (F.col(f"_c{i}") > F.col(f"_high{i}"))
    tally = cells.agg(*(x for i in range(len(names)) for x in (F.max(f"_n{i}").alias(f"n{i}"), F.count_if(out(i)).alias(f"o{i}"))))
    rows = F.array(*(F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n"), F.col(f"o{i}").alias("outliers")) for i, c in enumerate(names)))
    return tally.select(F.explode(rows).alias("r")).select("r.*").filter("n IS NOT NULL")


def average_ranks(long: DataFrame, row: str) -> DataFrame:
    """feature, row, rank with ties at their mean rank; null values have none."""
    ranks = cumulated(long, ["feature"]).select("feature", "value", (F.col("_before") + (F.col("_k") + 1) / 2).alias("rank"))
    return long.join(ranks, ["feature", "value"]).select("feature", row, "rank")


def spearman(df: DataFrame, names: Sequence[str], row: str) -> DataFrame:
    """a, b, rho for every two features: ranks back in wide form, all correlations in one aggregation."""
    ranks = average_ranks(unpivoted(df, names, [row]), row)
    wide = ranks.groupBy(row).pivot("feature", list(names)).agg(F.first("rank"))
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    rows = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("rho")) for i, (a, b) in enumerate(pairs)))
    return wide.agg(*(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs))).select(F.explode(rows).alias("r")).select("r.*")


def two_groups(df: DataFrame, names: Sequence[str], group: str, a, b, row: str) -> DataFrame:
    """Per feature: n, mean and median of both groups, Cohen's d, Welch's t with its degrees of freedom, Mann-Whitney's U and z (without continuity correction), and the sum of k**3 - k over groups of k ties."""
    long = unpivoted(df.filter(F.col(group).isin(a, b)).select(group, row, *names), names, [group, row])
    x, y = F.col(group) == a, F.col(group) == b
    of = lambda f, side: f(F.when(side, F.col("value")))
    m = long.groupBy("feature").agg(
        of(F.count, x).alias("n_a"), of(F.count, y).alias("n_b"), of(F.avg, x).alias("mean_a"), of(F.avg, y).alias("mean_b"),
        of(F.var_samp, x).alias("_va"), of(F.var_samp, y).alias("_vb"),
    )
    # ranks, medians and ties follow from how often each value occurs on either side; rows aren't ranked one by one
    counts = cumulated(long, ["feature"], sides={"a": x, "b": y})
    rank, k = F.col("_before") + (F.col("_k") + 1) / 2, F.col("_k")
    r = counts.groupBy("feature").agg(F.sum(F.col("_k_a") * rank).alias("_ra"), F.sum(k * k * k - k).cast("double").alias("_ties"))
    for side in ("a", "b"):
        r = r.join(percentiles_of(counts.filter(F.col(f"_n_{side}") > 0), ["feature"], (0.5,), side=f"_{side}").select("feature", F.col("_p")[0].alias(f"median_{side}")), "feature", "left")
    m = m.join(r, "feature")
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    n = na + nb
    pooled = F.sqrt(((na - 1) * F.col("_va") + (nb - 1) * F.col("_vb")) / (n - 2))
    se2 = F.col("_va") / na + F.col("_vb") / nb
    u = F.col("_ra") - na * (na + 1) / 2
    sd = F.sqrt(na * nb / 12 * (n + 1 - F.col("_ties") / (n * (n - 1))))
    diff = F.col("mean_a") - F.col("mean_b")
    return m.select(
        "feature", "n_a", "n_b", "mean_a", "mean_b", "median_a", "median_b", F.try_divide(diff, pooled).alias("cohens_d"), F.try_divide(diff, F.sqrt(se2)).alias("welch_t"),
        F.try_divide(se2 * se2, F.pow(F.col("_va") / na, 2.0) / (na - 1) + F.pow(F.col("_vb") / nb, 2.0) / (nb - 1)).alias("df"), u.alias("u"), F.try_divide(u - na * nb / 2, sd).alias("z"), F.col("_ties").alias("ties"),
    )


def _incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised, by its continued fraction."""
    if x <= 0 or x >= 1:
        return min(max(x, 0.0), 1.0)
    if x > (a + 1) / (a + b + 2):
        return 1 - _incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    f = c = 1.0
    d = 0.0
    for i in range(400):
        m = i // 2
        step = 1.0 if i == 0 else m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)) if i % 2 == 0 else -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / (1 + step * d or 1e-300)
        c = 1 + step / c or 1e-300
        f *= c * d
        if abs(1 - c * d) < 1e-12:
            break
    return front * (f - 1) if f != 1 else front


def student_p(t: float, df: float) -> float:
    """Two-sided p-value of t with df degrees of freedom."""
    return _incomplete_beta(df / 2, 0.5, df / (df + t * t))


def normal_p(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


#: The smaller group up to which, and the products of both sizes up to which U is tested by its exact distribution.
SMALL, EXACT = 8, 200_000


@lru_cache(maxsize=256)
def _ways(a: int, b: int) -> tuple[int, ...]:
    """In how many ways a of a + b ranks give U = 0, 1, ..., a * b: the coefficients of a Gaussian binomial, in whole numbers.

    Each further rank multiplies by (1 - q**(b + i)) / (1 - q**i).
    """
    a, b = min(a, b), max(a, b)
    ways = np.zeros(a * b + 1, dtype=object)
    ways[0] = 1
    for i in range(1, a + 1):
        ways[b + i :] = ways[b + i :] - ways[: max(len(ways) - b - i, 0)]
        for k in range(i, len(ways)):
            ways[k] += ways[k - i]
    return tuple(ways)


def mann_whitney_p(n_a: int, n_b: int, u: float, ties: float) -> float | None:
    """Two-sided p-value of U: exact for a small group without ties, else normal with continuity correction; null where nothing can be told."""
    if not n_a or not n_b:
        return None
    high = max(u, n_a * n_b - u)
    if not ties and min(n_a, n_b) <= SMALL and n_a * n_b <= EXACT:
        ways = _ways(*sorted((n_a, n_b)))
        return min(1.0, 2 * (sum(ways[round(high) :]) / math.comb(n_a + n_b, n_a)))
    n = n_a + n_b
    sd = math.sqrt(max(n_a * n_b / 12 * (n + 1 - ties / (n * (n - 1))), 0.0)) if n > 1 else 0.0
    return min(1.0, math.erfc((high - n_a * n_b / 2 - 0.5) / sd / math.sqrt(2))) if sd else None


def tested(groups: DataFrame) -> DataFrame:
    """The result of two_groups (a row per feature) with p-values of both tests and their Benjamini-Hochberg q-values; a missing p-value counts as 1 for these.

    A Python function, as SQL has no distribution functions; it sees one row per feature.
    """

    @F.pandas_udf("struct<welch_p:double,mann_whitney_p:double>")
    def p_values(rows: pd.DataFrame) -> pd.DataFrame:
        ok = lambda *v: all(x is not None and math.isfinite(x) for x in v)
        return pd.DataFrame({
            "welch_p": [student_p(t, d) if ok(t, d) else None for t, d in zip(rows["welch_t"], rows["df"])],
            "mann_whitney_p": [mann_whitney_p(int(a), int(b), u, k) if ok(a, b, u, k) else None for a, b, u, k in zip(rows["n_a"], rows["n_b"], rows["u"], rows["ties"])],
        })

    out = groups.withColumn("_p", p_values(F.struct("welch_t", "df", "n_a", "n_b", "u", "ties"))).select(*groups.columns, "_p.*")
    for test in ("welch", "mann_whitney"):
        out = benjamini_hochberg(out.withColumn("_known", F.coalesce(f"{test}_p", F.lit(1.0))), "_known").drop("_known").withColumnRenamed("q_value", f"{test}_q")
        out = out.withColumn(f"{test}_significant", F.col(f"{test}_q") < 0.05)
    return out


def path_like(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^([A-Za-z]:)?[\\/]|\.(nii|dcm|gz|csv|parquet)$|^[a-z]+://"), F.lit(False))


def path_columns(df: DataFrame, share: float = 0.8) -> list[str]:
    """Text columns whose filled values look like paths, found in one pass."""
    names = [c for c, t in df.dtypes if t == "string"]
    if not names:
        return []
    row = df.agg(*(F.avg(F.when(F.trim(f"`{c}`") != "", path_like(F.col(f"`{c}`")).cast("int"))).alias(f"c{i}") for i, c in enumerate(names))).first()
    return [c for i, c in enumerate(names) if (row[i] or 0) >= share]


def feature_columns(df: DataFrame, tokens: Sequence[str], without: Sequence[str] = ()) -> list[str]:
    """Numeric columns whose name has one of the tokens and none of the prefixes."""
    numeric = ("int", "bigint", "double", "float", "smallint", "tinyint")
    return [c for c, t in df.dtypes if t in numeric and any(x in c.lower() for x in tokens) and not c.lower().startswith(tuple(without))]
