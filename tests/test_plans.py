"""What steps need, columns by sampled values, ties, rank tests."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from stratiform.operators import columns, ordering, profile, ranks
from stratiform.plans import steps


def test_names_in_expressions(spark):
    assert steps.names_in("a.b > 1 AND `c d` = lower(e) AND exists(f, x -> x > g) OR CASE WHEN h IS NULL THEN cast(i as int) END IN (1, j)") == ["a", "c d", "e", "f", "g", "h", "i", "j"]
    assert steps.names_in("1 = 1") == []


PLAN = [
    {"type": "add_date", "candidates": ["StudyDate", "SeriesDate"]},
    {"type": "hook", "function": lambda c: c, "inputs": ["id"], "outputs": ["key"]},
    {"type": "row_expression", "expression": "key > 1 AND weight < 5"},
    {"type": "visit_order", "patient": "key", "study": "study", "date": "date"},
    {"type": "phase", "config": {"strategies": [{"name": "x", "type": "explicit", "assignments": [{"phase": "NATIVE", "rules": [{"column": "series", "op": "eq", "value": 1}]}]}, {"name": "o", "type": "ontology", "columns": ["term"], "mapping": {}}]}},
    {"type": "modality_curation", "exam": ["key", "date"], "volume": "volume_id", "texts": ["Text"], "config": {"strategies": [{"name": "r", "type": "rules"}]}},
    {"type": "select", "columns": ["key", "phase"]},
    {"type": "row_expression", "expression": "visit_order = 0"},
]


def test_required_inputs(spark, tmp_path):
    assert steps.missing(PLAN, ["id", "weight", "study", "series", "volume_id"]) == [(7, "row_expression", "visit_order")]  # the selection has dropped it
    assert [(i, c) for i, _, c in steps.missing(PLAN[:7], [])] == [(1, "id"), (2, "weight"), (3, "study"), (4, "series"), (5, "volume_id")]
    needed = steps.inputs_of(PLAN)
    assert {"id", "weight", "study", "series", "term", "volume_id", "Text", "StudyDate"} <= set(needed) and not {"key", "date", "phase", "visit_order"} & set(needed)
    edges = set(steps.dependencies(PLAN))
    assert {(2, 1, "key"), (2, -1, "weight"), (3, 0, "date"), (6, 5, "phase")} <= edges
    (tmp_path / "in.csv").write_text("id,weight\n1,2\n")
    with pytest.raises(ValueError, match=r"step 3 \(visit_order\) needs the column 'study'; step 4 \(phase\) needs the column 'series'"):
        steps.clean(spark, [f"file://{tmp_path}/in.csv"], PLAN[:5], f"file://{tmp_path}/out")
    assert steps.missing([{"type": "filter", "kind": "keep", "rules": [{"column": "a", "op": "eq", "value": 1}], "on_missing": "raise"}], []) == [(0, "filter", "a")]


def test_sampled_columns(spark):
    rows = [(f"{i % 24:02d}:10:00" if i % 2 else "soon", None, f"{i % 12 + 1}/{i % 28 + 1}/2020", f"0{i % 9 + 1}.11.2020", "20200101", " ") for i in range(400)]
    df = spark.createDataFrame(rows, "start_time string, blank_time string, us_date string, eu_date string, iso_date string, DelayTime string")
    found = columns.clocks_and_dates(df)
    samples = {tuple(sorted(map(tuple, columns.bottom_values(d, ["start_time", "us_date", "blank_time"], 7).collect()))) for d in (df, df.repartition(7), df.orderBy("us_date").coalesce(1), df.union(df))}
    assert len(samples) == 1 and sorted(c for c, _ in next(iter(samples))) == ["start_time"] * 7 + ["us_date"] * 7
    assert found.dates == {"us_date": False, "eu_date": True, "iso_date": True} and "blank_time" not in found.clocks and "DelayTime" not in found.clocks
    out = columns.with_clocks_and_dates(df, columns.Found(("start_time",), found.dates)).filter("start_time is not null").first()
    assert out["start_time"] == 3600 + 600 and str(out["us_date"]) == "2020-02-02" and str(out["eu_date"]) == "2020-11-02" and str(out["iso_date"]) == "2020-01-01"
    assert columns.clocks_and_dates(df.limit(0)).dates == {"us_date": True, "eu_date": True, "iso_date": True}
    assert columns.clocks_and_dates(df.select("DelayTime")) == columns.Found((), {})


def test_largest_with_ties(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5.0, 3.0, 5.0, 1.0, 3.0, None, 3.0])], "id int, v double").repartition(3)
    ids = lambda d: sorted(r["id"] for r in d.collect())
    assert ids(ordering.n_largest(df, "v", 1)) == [0, 2] and ids(ordering.n_largest(df, "v", 3)) == [0, 1, 2, 4, 6] and ids(ordering.n_largest(df, "v", 99)) == [0, 1, 2, 3, 4, 6]
    assert ids(ordering.n_largest(df, "v", 2, smallest=True)) == [1, 3, 4, 6] and ids(ordering.n_largest(df.filter("v is null"), "v", 2)) == []


def test_exact_rank_tests(spark):
    for a, b in ((1, 1), (1, 6), (2, 3), (3, 3), (4, 5)):
        ranks_ = range(1, a + b + 1)
        us = [sum(c) - a * (a + 1) / 2 for c in itertools.combinations(ranks_, a)]
        for u in set(us):
            high = max(u, a * b - u)
            assert profile.mann_whitney_p(a, b, u, 0) == pytest.approx(min(1.0, 2 * sum(x >= high for x in us) / len(us)))
    assert sum(profile._ways(8, 1000)) == math.comb(1008, 8)
    assert profile.mann_whitney_p(8, 3000, 0.0, 0) < 1e-5 and profile.mann_whitney_p(0, 5, 0.0, 0) is None and profile.mann_whitney_p(3, 3, 4.5, 6**3 - 6) is None
    z = (400 - 200 - 0.5) / math.sqrt(400 / 12 * 41)
    assert profile.mann_whitney_p(20, 20, 0.0, 0) == pytest.approx(math.erfc(z / math.sqrt(2)))
    df = spark.createDataFrame([(i, "a" if i < 3 else "b", float(i), 1.0, None) for i in range(6)], "id int, g string, up double, same double, none double")
    out = {r["feature"]: r for r in profile.tested(profile.two_groups(df, ["up", "same", "none"], "g", "a", "b", "id")).collect()}
    assert out["up"]["mann_whitney_p"] == pytest.approx(0.1) and out["same"]["mann_whitney_p"] is None and out["same"]["mann_whitney_q"] == 1.0 and out["up"]["median_b"] == 4.0


def test_ranks_by_pieces(spark, monkeypatch):
    """The same sums and percentiles whether groups are cut or not, for sides too."""
    df = spark.createDataFrame([(None if i % 7 == 0 else i % 3, float(i * 37 % 101) if i % 11 else None) for i in range(900)], "g int, value double")
    side = {"odd": F.col("value") % 2 == 1}
    results = []
    for piece in (200_000, 10):
        monkeypatch.setattr(ranks, "PIECE", piece)
        counts = ranks.cumulated(df, ["g"], sides=side)
        results.append((sorted(map(str, counts.collect())), sorted(map(str, ranks.percentiles_of(counts, ["g"], (0, 0.3, 1)).collect())), sorted(map(str, ranks.percentiles_of(counts.filter("_n_odd > 0"), ["g"], (0.5,), side="_odd").collect()))))
    assert results[0] == results[1] and len(results[0][1]) == 4


def test_values_are_placed_by_range(spark, monkeypatch):
    """A value's piece needs no look at all cuts of its group, and percentiles need no window over the pieces between them."""
    df = spark.createDataFrame([(None if i % 5 == 0 else i % 2, [float(i * 7919 % 10_007), -0.0, 0.0, float("nan")][i % 4 if i % 50 < 4 else 0]) for i in range(6_000)], "g int, value double")
    points = (0.0, 0.31, 0.5, 1.0)
    whole = sorted(map(str, ranks.cumulated(df, ["g"]).collect()))
    want = sorted(map(str, ranks.percentiles(df, ["g"], points).collect()))
    monkeypatch.setattr(ranks, "PIECE", 200)
    cut = ranks.cumulated(df, ["g"])
    assert sorted(map(str, cut.collect())) == whole and len(want) == 3
    assert "lambda" not in cut._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, ranks.percentiles(df, ["g"], points).collect())) == want
    some = ranks.cumulated(df, ["g"], points=points)
    assert set(map(str, some.collect())) < set(whole) and some.count() < len(whole) * 3 / 4


def test_outliers_stay_where_they_are(spark, monkeypatch):
    """Rows meet their feature's quartiles without being dealt by feature, at any size; what is counted is the same, cut or not."""
    import numpy as np

    g = np.random.default_rng(8)
    a, b = np.append(g.normal(size=1990), np.linspace(-90, 90, 10)), np.append(np.full(1500, 5.0), np.round(g.normal(size=500), 1))
    rows = [(float(x), float(y) if i % 9 else None, float(i) if i < 3 else None, None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, few double, none double")

    def counted(values):
        low, high = np.quantile(values, [0.25, 0.75])
        return len(values), int(((values < low - 1.5 * (high - low)) | (values > high + 1.5 * (high - low))).sum())

    want = {"a": counted(a), "b": counted(np.array([r[1] for r in rows if r[1] is not None]))}
    assert min(n for _, n in want.values()) > 5
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if all were too large
        for piece in (200_000, 300):
            monkeypatch.setattr(ranks, "PIECE", piece)
            out = profile.outliers(df, ["a", "b", "few", "none"])
            assert {r["feature"]: (r["n"], r["outliers"]) for r in out.collect()} == want
            assert "SortMergeJoin [feature" not in out._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_intervals_and_anchors(spark):
    from stratiform.operators import tables

    windows = spark.createDataFrame([("a", 0.0, 10.0), ("b", 10.0, 20.0), ("c", 15.0, 16.0), ("d", 30.0, 30.0)], "name string, low double, high double")
    want = {-1.0: None, 0.0: "a", 9.9: "a", 10.0: None, 10.1: "b", 15.0: None, 15.5: None, 16.0: None, 16.5: "b", 20.0: "b", 25.0: None, 30.0: "d", 30.1: None, None: None}
    df = spark.createDataFrame([(v,) for v in want], "v double")
    assert {r["v"]: r["name"] for r in tables.interval_join(df, "v", windows, "name").collect()} == want
    assert {r["name"] for r in tables.interval_join(df, "v", windows.limit(0), "name").collect()} == {None}
    rows = spark.createDataFrame([("g", 1, False), ("g", 2, True), ("g", 3, False), ("g", 4, True), ("h", 1, False), (None, 1, True), (None, 2, False)], "g string, at int, anchor boolean")
    assert sorted((r["g"], r["at"]) for r in ordering.after_anchor(rows, ["g"], "at", F.col("anchor")).collect()) == [("g", 3), ("g", 4)]
    stats = {r["g"]: (r["n"], r["mean"], r["median"], r["low"], r["high"]) for r in profile.group_statistics(rows, ["g"], "at").collect()}
    assert stats == {"g": (4, 2.5, 2.5, 1.0, 4.0), "h": (1, 1.0, 1.0, 1.0, 1.0), None: (2, 1.5, 1.5, 1.0, 2.0)}
