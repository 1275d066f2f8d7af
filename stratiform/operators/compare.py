"""Cohorts against references and table versions against each other."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.operators.ordering import ranked, top


def keys_of(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    return df.select(*grain).dropna(how="any").distinct()


def set_metrics(predicted: DataFrame, reference: DataFrame, grains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per grain: predicted, reference, tp, fp, fn, precision, recall, f1, jaccard (null where undefined)."""
    parts = []
    for name, grain in grains.items():
        a, b = keys_of(predicted, grain).withColumn("_p", F.lit(1)), keys_of(reference, grain).withColumn("_t", F.lit(1))
        both = a.join(b, list(grain), "full")
        tp = F.count(F.when(F.col("_p").isNotNull() & F.col("_t").isNotNull(), 1))
        parts.append(both.agg(F.lit(name).alias("grain"), F.count("_p").alias("predicted"), F.count("_t").alias("reference"), tp.alias("tp")))
    m = reduce(DataFrame.union, parts)
    p, t, tp = F.col("predicted"), F.col("reference"), F.col("tp")
    return m.select(
        "grain", "predicted", "reference", "tp", (p - tp).alias("fp"), (t - tp).alias("fn"),
        F.try_divide(tp, p).alias("precision"), F.try_divide(tp, t).alias("recall"), F.try_divide(2 * tp, p + t).alias("f1"), F.try_divide(tp, p + t - tp).alias("jaccard"),
    )


def mismatches(predicted: DataFrame, reference: DataFrame, grain: Sequence[str]) -> DataFrame:
    a, b = keys_of(predicted, grain), keys_of(reference, grain)
    fp = a.join(b, list(grain), "left_anti").withColumn("kind", F.lit("false_positive"))
    fn = b.join(a, list(grain), "left_anti").withColumn("kind", F.lit("false_negative"))
    return fp.union(fn).orderBy(*grain, "kind")


def label_recovery(predicted: DataFrame, reference: DataFrame, exam: Sequence[str], label: str, order: Sequence[str]) -> DataFrame:
    """Per reference exam: expected, matched and missing labels in a fixed order, and whether all were found."""
    got = predicted.groupBy(*exam).agg(F.collect_set(label).alias("_got"))
    want = reference.groupBy(*exam).agg(F.collect_set(label).alias("_want"))
    both = want.join(got, list(exam), "left").withColumn("_got", F.coalesce("_got", F.array().cast("array<string>")))
    listed = lambda c: F.array_join(F.filter(F.array(*map(F.lit, order)), lambda x: F.array_contains(c, x)), "|")
    hit, gone = F.array_intersect("_want", "_got"), F.array_except("_want", "_got")
    return both.select(*exam, listed(F.col("_want")).alias("expected"), listed(hit).alias("matched"), listed(gone).alias("missing"), (F.size(gone) == 0).alias("full_match"))


def vanished(before: DataFrame, after: DataFrame, key: Sequence[str], study: str, show: Sequence[str], limit: int = 20) -> DataFrame:
    """Keys of the old table that the new one lacks: studies affected and up to three distinct values of some columns."""
    gone = before.join(keys_of(after, key), list(key), "left_anti")

    def shown(c: str) -> Column:
        values = F.array_sort(F.collect_set(F.col(c).cast("string")))
        more = F.when(F.size(values) > 3, F.concat(F.lit(" (+"), (F.size(values) - 3).cast("string"), F.lit(" more)"))).otherwise("")
        return F.concat(F.array_join(F.slice(values, 1, 3), ", "), more).alias(c)

    return gone.groupBy(*key).agg(F.count_distinct(study).alias("n_studies"), *map(shown, show)).orderBy(*key).limit(limit)


def step_funnel(df: DataFrame, steps: Sequence[tuple[str, Column]], counts: Mapping[str, Sequence[str]]) -> DataFrame:
    """What is left after each of a list of filters, in one pass: a row per step with rows and distinct keys."""
    alive, aggs = F.lit(True), []
    flags = {}
    for i, (_, mask) in enumerate(steps):
        alive = alive & F.coalesce(mask, F.lit(False))
        flags[f"_a{i}"] = alive
    df = df.withColumns(flags)
    for i in range(len(steps)):
        a = F.col(f"_a{i}")
        aggs.append(F.struct(F.lit(steps[i][0]).alias("step"), F.count_if(a).alias("rows"), *(F.count_distinct(*(F.when(a, F.col(c)) for c in cols)).alias(n) for n, cols in counts.items())).alias(f"s{i}"))
    return df.agg(*aggs).select(F.explode(F.array(*(F.col(f"s{i}") for i in range(len(steps))))).alias("s")).select("s.*")


def preserved(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """new with the columns that only old has, joined on the first key that is unique and filled on both sides.

    Tables have no row order here, so there is no positional way: without such a key it is an error.
    """
    extra = [c for c in old.columns if c not in new.columns]
    for k in keys:
        if k not in new.columns or k not in old.columns:
            continue
        unique = lambda df: df.agg(((F.count("*") == F.count(k)) & (F.count(k) == F.count_distinct(k))).alias("u")).first()["u"]  # noqa: B023, E731
        if unique(new) and unique(old):
            return new.join(old.select(k, *extra), k, "left")
    raise ValueError(f"none of {list(keys)} is unique on both sides")


def selected_cohort(df: DataFrame, eligible: Column, patient: str, exam: str, label: str, order: Sequence[Column | str]) -> tuple[DataFrame, DataFrame]:
    """The cohort and its audit. Of each patient's eligible rows the exam with most labels (a tie: the least exam), of each of its labels the first row by `order`.

    The audit has every row of df with a reason: selected, not_eligible, other_exam, other_candidate.
    """
    flagged = df.withColumn("_ok", F.coalesce(eligible, F.lit(False)))
    exams = flagged.filter("_ok").groupBy(patient, exam).agg(F.count_distinct(label).alias("n_labels"))
    best = top(exams, [patient], [F.desc("n_labels"), exam]).select(patient, F.col(exam).alias("_exam"), "n_labels")
    rows = flagged.join(best, patient, "left").withColumn("_in", F.col("_ok") & (F.col(exam) == F.col("_exam")))
    rows = ranked(rows, [patient, exam, label], [F.desc(F.coalesce("_in", F.lit(False))), *order], "_place")
    reason = F.when(~F.col("_ok"), "not_eligible").when(~F.col("_in"), "other_exam").when(F.col("_place") == 1, "selected").otherwise("other_candidate")
    audit = rows.withColumn("reason", reason).drop("_ok", "_exam", "_in", "_place")
    return audit.filter("reason = 'selected'").drop("reason"), audit


def recovery_summary(recovery: DataFrame, subgroup: Column) -> DataFrame:
    """Of the exams of label_recovery: all, complete, partial (some labels matched), none; and the same of a subgroup."""
    some = F.col("matched") != ""
    kinds = {"complete": F.col("full_match"), "partial": ~F.col("full_match") & some, "none": ~F.col("full_match") & ~some}
    inside = F.coalesce(subgroup, F.lit(False))
    aggs = [F.count("*").alias("exams"), *(F.count_if(k).alias(n) for n, k in kinds.items())]
    return recovery.agg(*aggs, F.count_if(inside).alias("subgroup_exams"), *(F.count_if(k & inside).alias(f"subgroup_{n}") for n, k in kinds.items()))
