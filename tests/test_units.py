"""Cases that the tables do not hold: odd values, validation, small grids."""

import datetime
import tempfile

import pytest
from pyspark.sql import functions as F

from stratiform.functions import clock, rules, text, vectors
from stratiform.operators import compare, context, curation, incremental, ordering, phases, ranks, rollup, tables, voxels
from stratiform.plans import steps
from stratiform.sources import tables as sources


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


@pytest.mark.parametrize(
    "group",
    [{}, {"rules": []}, {"rules": [{"column": "a", "op": "eq", "value": 1}] * 2}, {"rules": [{"op": "eq", "value": 1}]}, {"rules": [{"column": "a", "op": "like", "value": 1}]}, {"rules": [{"column": "a", "op": "in", "value": "x"}]}, {"rules": [{"column": "a", "op": "eq", "value": [1]}]}, {"rules": [{"column": "a", "op": "lt"}]}, {"rules": [{"column": "a", "op": "regex", "value": "("}]}],
)
def test_bad_rules(group):
    with pytest.raises(Exception):
        rules.validated(group)


def test_null_handling_of_filters(spark):
    df = spark.createDataFrame([(1, None), (2, "5"), (3, "1"), (4, "nan"), (5, "x")], "id int, value string")
    rule = [{"column": "value", "op": "gte", "value": 5}]
    ids = lambda kind, keep: [r["id"] for r in df.filter(rules.keep_mask(df, {"kind": kind, "rules": rule, "keep_null": keep})).collect()]
    assert ids("keep", True) == [1, 2] and ids("keep", False) == [2] and ids("discard", True) == [1, 3, 4, 5] and ids("discard", False) == [1, 3, 4, 5]
    lists = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None), (4, [None])], "id int, v array<string>")
    hit = lambda op, v=None: [r["id"] for r in lists.filter(rules.rule(lists, {"column": "v", "op": op, "value": v})).collect()]
    assert hit("is_null") == [2, 3, 4] and hit("not_null") == [1] and hit("ne", "b") == [1] and hit("eq", "a") == [1]
    with pytest.raises(ValueError):
        rules.filtered(df, [{"kind": "keep", "rules": [{"column": "no", "op": "not_null"}]}], on_missing="raise")


def test_text(spark):
    assert values(spark, [("100",), ("  Foie\t ÉTÉ 1.0",), (None,)], "t string", text.uniform(F.col("t"))) == [("1",), ("foie ete 1",), ("",)]
    assert values(spark, [("late arterial",), ("ADC_ax",), ("maximal",)], "t string", text.plane(F.col("t")), text.has(F.col("t"), "arterial")) == [(None, True), ("AXIAL", False), (None, False)]
    assert values(spark, [("ab007-c000",), ("none",)], "t string", text.digits_key(F.col("t"))) == [("7-0",), ("none",)]


def test_clock(spark):
    rows = [("20200131",), ("2020-01-31T10:00:00",), ("20201331",), ("x",), (None,)]
    d = datetime.date(2020, 1, 31)
    assert values(spark, rows, "t string", clock.date(F.col("t"))) == [(d,), (d,), (None,), (None,), (None,)]
    rows = [("143921.5",), ("14:39:21",), ("2020-01-01 14:39:21",), ("20200101143921",), ("250000",), ("",)]
    assert values(spark, rows, "t string", clock.clock(F.col("t"))) == [(52761.5,), (52761.0,), (52761.0,), (52761.0,), (None,), (None,)]
    assert values(spark, [("delay 1 min 31 sec and 2h05",), ("1,5 min",), ("t3:00",), ("none",)], "t string", clock.durations(F.col("t"))) == [([91.0, 7500.0],), ([90.0],), ([180.0],), ([],)]


def test_vectors(spark):
    rows = [([1.0, 0.0, 0.0, 0.0, 1.0, 0.0],), ([0.0] * 6,), ([1.0, 2.0],), ([float("nan"), 0.0, 0.0, 0.0, 1.0, 0.0],), (None,)]
    p = vectors.plane(F.col("v"))
    assert values(spark, rows[:3], "v array<double>", p["plane"], p["angle"], p["axis"]) == [("AX", 0.0, "Z"), (None, None, None), (None, None, None)]
    assert [v for (v,) in values(spark, rows, "v array<double>", vectors.standardised(F.col("v")))][1:] == [None] * 4
    assert values(spark, [("1.5\\-2.0\\3.25",), ("[1, 0]",), ("x",)], "t string", vectors.parsed(F.col("t"), 3)) == [([1.5, -2.0, 3.25],), (None,), (None,)]


def test_repeated_stack(spark):
    rows = [("s", z, t, f"i{z}{t}", "v") for t in (1, 2) for z in range(8)]
    df = spark.createDataFrame(rows, "series string, z int, t int, id string, volume_id string")
    out = rollup.split_stacks(df, ["series"], "z", ["t", "id"], "volume_id", min_slices=4).groupBy("volume_id").agg(F.count("*").alias("n"), F.min("n_detected").alias("d")).collect()
    assert sorted((r["n"], r["d"]) for r in out) == [(8, 2), (8, 2)]


def test_fragments(spark):
    df = spark.createDataFrame([("g", "b", 0.0), ("g", "c", 5.0), ("h", "d", 0.0), ("h", "e", 1.0), ("h", "e", 5.0)], "g string, v string, z double")
    out = rollup.merge_fragments(df, ["g"], "v", "z").collect()
    one = spark.sql("select sha1('b|c') as h").first()["h"]
    assert sorted(r["v"] for r in out) == sorted([one, one, "d", "e", "e"])


def test_reference_rank(spark):
    df = spark.createDataFrame([("p", "a", "T2", "x"), ("p", "b", "t1 ", "2.0"), ("p", "c", "T1", "1.0"), ("p", "d", None, None)], "p string, id string, seq string, s string")
    out = ordering.reference_rank(df, ["p"], [("seq", ["T1", "T2"]), ("s", "min")], "id").orderBy("reference_rank").collect()
    assert [r["id"] for r in out] == ["c", "b", "a", "d"] and {r["reference_of"] for r in out} == {4}


def test_empty_prediction(spark):
    df = spark.createDataFrame([(1,)], "k int")
    m = compare.set_metrics(df.limit(0), df, {"k": ["k"]}).first()
    assert (m["precision"], m["recall"], m["jaccard"], m["fn"]) == (None, 0.0, 0.0, 1)
    with pytest.raises(ValueError):
        compare.preserved(df.union(df), df.withColumn("x", F.lit(1)), ["k"])


def test_phase_chain(spark):
    df = spark.createDataFrame([("derived", "PV"), ("localizer", "PV"), (None, None), (None, "other")], "phase_applicability_reason string, tag string")
    out = phases.resolve(df, {"strategies": [{"name": "o", "type": "ontology", "columns": ["tag", "gone"], "mapping": {"pv": "PORTAL_VENOUS", "other": "OTHER"}}], "fallback": "OTHER"})
    assert [(r["phase"], r["phase_status"], r["phase_source"]) for r in out.collect()] == [("PORTAL_VENOUS", "RESOLVED", "o"), (None, "NOT_APPLICABLE", "not_applicable"), ("OTHER", "UNRESOLVED", "fallback"), ("OTHER", "UNRESOLVED", "fallback")]
    with pytest.raises(ValueError):
        phases.resolve(df, {"strategies": []})


def test_curation_end_to_end(spark):
    rows = [("p", "v1", "CT", "AX native", 512, 512, 100, 2.0), ("p", "v2", "CT", "AX portal 70 s", 512, 512, 100, 2.0), ("p", "v3", "MRI", "AX T1 vibe arterial", 320, 320, 80, 3.0), ("p", "v4", "CT", "scout", 512, 512, 1, 2.0), ("p", "v5", "CT", "ax portal", 256, 256, 10, 9.0)]
    df = spark.createDataFrame(rows, "patient string, volume_id string, Modality string, SeriesDescription string, Rows int, Columns int, n_files int, SliceThickness double")
    out = context.curate(df, ["patient"], "volume_id", {"strategies": [{"name": "texts", "type": "rules"}]})
    wide = out["wide"].first()
    assert (wide["NATIVE"], wide["PORTAL_VENOUS"], wide["T1_ARTERIAL"]) == ("v1", "v2", "v3") and wide["PORTAL_VENOUS_other_candidates"].startswith("v5")
    assert out["curated"].count() == 5


def _phases(spark, rows):
    """Phases and sources of MR volumes (exam, volume, text, seconds, acquisition, tag) in the context of their exams."""
    df = spark.createDataFrame(rows, "exam string, volume_id string, SeriesDescription string, time_seconds double, acquisition_id string, ContrastBolusAgentPhase string")
    out = context.in_context(curation.annotate_mr(df.withColumn("Modality", F.lit("MR"))), ["exam"], "volume_id")
    return {r["volume_id"]: (r["rule_phase"], r["mri_perfusion_source"]) for r in out.collect()}


def test_hepatobiliary_and_strategies_ahead(spark):
    got = _phases(spark, [
        ("a", "a1", "T1 VIBE HBP", 0.0, None, None), ("a", "a2", "T1 vibe hepatobiliary", 1.0, None, None), ("a", "a3", "vibe hepatobiliary 20 min", 2.0, None, None), ("a", "a4", "T1 vibe delayed 20 min", 3.0, None, None),
        ("a", "a5", "T1 vibe delayed 40 min", 4.0, None, None), ("a", "a6", "T1 vibe 2h30", 5.0, None, None), ("b", "b1", "ax t1 vibe", 0.0, None, "HBP"),
        ("c", "c1", "ax t1 vibe dyn", 10.0, None, None), ("c", "c2", "ax t1 vibe dyn hbp", 20.0, None, None), ("c", "c3", "ax t1 vibe dyn portal", 70.0, None, None),
    ])
    assert all(got[f"a{i}"] == ("HEPATOBILIARY", "explicit_text") for i in (1, 2, 3, 4, 6)) and got["a5"] == ("DELAYED", "explicit_text") and got["b1"] == ("HEPATOBILIARY", "dicom_phase")
    assert got["c2"] == ("HEPATOBILIARY", "explicit_text") and got["c1"][0] in ("NATIVE", "ARTERIAL") and got["c3"][0] == "PORTAL_VENOUS"  # long after the series: no step of it
    rows = [("x", "x1", "ax t1 vibe", "arterial phase"), ("x", "x2", "ax t1 vibe", None), ("x", "x3", "ax t1 vibe portal", "delayed phase")]
    df = curation.annotate_mr(spark.createDataFrame(rows, "exam string, volume_id string, SeriesDescription string, term string").withColumn("Modality", F.lit("MR")))
    chain = {"strategies": [{"name": "terms", "type": "ontology", "columns": ["term"], "mapping": {"arterial phase": "ARTERIAL", "delayed phase": "DELAYED"}}, {"name": "rules", "type": "rules"}]}
    out = {r["volume_id"]: r for r in phases.resolve(context.in_context(df, ["exam"], "volume_id", chain=chain), chain).collect()}
    assert out["x1"]["rule_phase"] == "OTHER" and out["x1"]["phase"] == "ARTERIAL" and out["x1"]["phase_source"] == "terms"
    assert (out["x2"]["phase"], out["x2"]["mri_perfusion_source"], out["x2"]["mri_perfusion_confidence"]) == ("NATIVE", "exam_context", "fallback")  # known phases ahead make it one
    assert out["x3"]["rule_phase"] == "PORTAL_VENOUS" and out["x3"]["phase"] == "DELAYED" and "ax t1 vibe portal" in out["x3"]["mri_perfusion_reason"]
    plain = {r["volume_id"]: r["mri_perfusion_source"] for r in context.in_context(df, ["exam"], "volume_id").collect()}
    assert plain["x1"] == "exam_context"


def test_phases_in_order(spark):
    want = {
        "portal then arterial then late arterial": ["PORTAL_VENOUS", "ARTERIAL"], "late arterial, late": ["ARTERIAL", "DELAYED"], "native arterial native": ["NATIVE", "ARTERIAL"], "delayed 20 min portal": ["PORTAL_VENOUS"],
        "pre and post": [], "70 s": ["PORTAL_VENOUS"], "70 s 300 s": [], "": [], "delayed 5 min, portal, delayed": ["DELAYED", "PORTAL_VENOUS"], "porto venous": ["PORTAL_VENOUS"], "x" * 50_000 + " late": ["DELAYED"],
    }
    df = spark.createDataFrame([(t,) for t in [*want, None]], "t string")
    assert {r["t"]: r["p"] for r in df.select("t", phases.phases_in_order(F.col("t")).alias("p")).collect()} == {**want, None: None}


def test_context_of_an_exam(spark):
    got = _phases(spark, [
        ("a", "a1", "ax t1 vibe", 0.0, None, None), ("a", "a2", "ax t1 vibe dyn", 30.0, None, None), ("a", "a3", "ax t1 vibe dyn", 75.0, None, None), ("a", "a4", "ax t1 vibe dyn", 240.0, None, None), ("a", "a5", "t2 haste ax", 300.0, None, None),
        ("b", "b1", "ax t1 vibe art port", 10.0, None, None), ("b", "b2", "ax t1 vibe art port", 90.0, None, None),
        ("c", "c1", "ax t1 vibe arterial", 0.0, "q", None), ("c", "c2", "ax t1 vibe", 0.0, "q", None), ("c", "c3", "ax t1 lava", 9.0, "r", None),
        ("d", "d1", "ax t1 vibe", 0.0, None, "PORTAL VENOUS"), ("d", "d2", "ax t1 vibe", 1.0, None, "ARTERIAL\\\\PORTAL"), (None, "e1", None, None, None, None), (None, "e2", "", None, None, None),
        ("f", "f1", "ax t1 vibe native", 0.0, None, None), ("f", "f2", "ax t1 vibe native ph 2", 40.0, None, None),
        ("g", "g1", "ax t1 vibe mask arterial", 5.0, None, None),
        ("h", "h1", "ax t1 vibe art port", 10.0, None, None), ("h", "h2", "ax t1 vibe art port", 10.0, None, None),
    ])
    assert got["a1"] == ("NATIVE", "exam_context") and [got[f"a{i}"] for i in (2, 3, 4)] == [(p, "generic_dynamic") for p in ("ARTERIAL", "PORTAL_VENOUS", "DELAYED")] and got["a5"] == ("OTHER", "none")
    assert got["b1"] == ("ARTERIAL", "container_order") and got["b2"] == ("PORTAL_VENOUS", "container_order")
    assert got["c1"] == ("ARTERIAL", "explicit_text") and got["c2"] == ("ARTERIAL", "acquisition_phase") and got["c3"] == ("NATIVE", "native_no_perfusion_evidence")
    assert got["d1"] == ("PORTAL_VENOUS", "dicom_phase") and got["d2"] == ("OTHER", "dicom_phase_conflict") and got["e1"] == got["e2"] == ("OTHER", "none")
    assert got["f1"] == ("NATIVE", "explicit_text") and got["f2"] == ("OTHER", "ordinal_phase_conflict") and got["g1"] == ("NATIVE", "container_order")
    assert got["h1"] == got["h2"] == ("OTHER", "none")  # tied: no order tells them apart
    assert _phases(spark, []) == {}


def test_state(spark):
    now = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "source_id string, row_sha256 string")
    state = spark.createDataFrame([("a", "1", "completed"), ("b", "2", "failed"), ("c", "0", "completed")], "source_id string, row_sha256 string, status string")
    ids = lambda df: sorted(r["source_id"] for r in df.collect())
    assert ids(incremental.unchanged(state, now)) == ["a"] and ids(incremental.work(state, now)) == ["c"] and ids(incremental.work(state, now, True)) == ["b", "c"]
    df = spark.range(50).withColumn("x", F.col("id") * 2)
    one = incremental.dataset_hash(df, "id", ["id", "x"]).first()[0]
    assert one == incremental.dataset_hash(df.repartition(7).orderBy(F.desc("id")), "id", ["id", "x"]).first()[0] != incremental.dataset_hash(df.filter("id < 49"), "id", ["id", "x"]).first()[0]


def test_masks(spark):
    grid = spark.range(125).select(F.lit(1).alias("scan_id"), (F.col("id") % 5).cast("int").alias("x"), (F.floor(F.col("id") / 5) % 5).cast("int").alias("y"), F.floor(F.col("id") / 25).cast("int").alias("z"))
    box = grid.filter("x between 1 and 3 and y between 1 and 3 and z between 1 and 3")
    shell = box.filter("not (x = 2 and y = 2 and z = 2)")
    assert voxels.fill_holes(shell, grid).count() == 27
    assert voxels.morphology(box, grid, "erode", 1.0).count() == 1 and voxels.morphology(box, grid, "dilate", 0.5).count() == 27
    assert voxels.morphology(box, grid, "open", 1.0).count() == 7
    two = box.filter("x = 1").union(box.filter("x = 3 and y = 1"))
    assert voxels.largest_component(two).count() == 9 and voxels.largest_component(two, 3).count() == 9
    assert voxels.labelled(box.limit(0)).count() == 0


def test_long_winding_components(spark):
    """A way of over 200 voxels settles, and labels are those of a flood fill."""
    import random

    rng = random.Random(4)
    snake = {(x, y, 0) for y in range(0, 24, 2) for x in range(25)} | {(24 if y % 4 == 1 else 0, y, 0) for y in range(1, 23, 2)}
    masks = {1: snake, 2: {(x, y, z) for x in range(6) for y in range(6) for z in range(6) if rng.random() < 0.35}, 3: {(5, 5, 5)}}
    df = spark.createDataFrame([(s, *v) for s, m in masks.items() for v in sorted(m)], "scan_id long, x int, y int, z int")
    for connectivity in (1, 3):
        steps, want = voxels.neighbours(connectivity), {}
        for scan, mask in masks.items():
            for v in sorted(mask):
                todo = [] if (scan, v) in want else [v]
                while todo:
                    p = todo.pop()
                    if p in mask and (scan, p) not in want:
                        want[scan, p] = v
                        todo += [(p[0] + i, p[1] + j, p[2] + k) for i, j, k in steps]
        got = {(r["scan_id"], (r["x"], r["y"], r["z"])): tuple(r["label"]) for r in voxels.labelled(df, connectivity).collect()}
        assert got == want


def test_steps(spark):
    with pytest.raises(ValueError):
        steps.validated([{"type": "no"}])
    with pytest.raises(ValueError):
        steps.validated([{"type": "add_date"}])
    assert steps.inputs_of([{"type": "add_date", "candidates": ["A"]}, {"type": "visit_order", "patient": "p", "study": "s", "date": "date"}]) == ["A", "p", "s"]


def test_files(spark, tmp_path):
    sources.save(spark.createDataFrame([(1, "x")], "a int, b string"), f"{tmp_path}/one.csv", "csv")
    sources.save(spark.createDataFrame([(2, 3)], "a int, c int"), f"{tmp_path}/two.csv", "csv")
    both = sources.read_all(spark, [f"{tmp_path}/one.csv", f"{tmp_path}/two.csv"])
    assert sorted(both.columns) == ["a", "b", "c"] and both.count() == 2
    assert sources.load(spark, f"{tmp_path}/one.csv").first()["b"] == "x"
    both.write.csv(f"{tmp_path}/plain")
    assert sources.inventory(spark, f"{tmp_path}/plain", "*.csv").count() >= 1
    with pytest.raises(ValueError):
        sources.load(spark, "x.pkl")
    with pytest.raises(ValueError):
        sources.save_selection({"a": both, "b": both}, {"a": "p", "b": "p"})
    with pytest.raises(ValueError):
        tables.require(both, ["b"])


def test_p_values(spark):
    from stratiform.operators import profile

    assert abs(profile.student_p(2.228138852, 10) - 0.05) < 1e-8 and abs(profile.normal_p(1.959963985) - 0.05) < 1e-8 and profile.student_p(0, 5) == 1
    df = spark.createDataFrame([(i, "a" if i < 20 else "b", float(i), float(i % 7)) for i in range(40)], "id int, g string, up double, same double")
    out = {r["feature"]: r for r in profile.tested(profile.two_groups(df, ["up", "same"], "g", "a", "b", "id")).collect()}
    assert out["up"]["welch_significant"] and not out["same"]["mann_whitney_significant"] and out["up"]["u"] == 0 and out["up"]["welch_q"] <= 2 * out["up"]["welch_p"]


def test_pre_post_native(spark):
    rows = [("g", "v1", "pre and post contrast", None, 1), ("g", "v2", "ax", None, 2), ("h", "v3", "with contrast", None, 1), ("h", "v4", "pre/post", None, 2), ("i", "v5", "w and w/o", "ARTERIAL", 1), ("i", "v6", "x", None, 2), ("j", "v7", "plain", None, 1)]
    df = spark.createDataFrame(rows, "g string, id string, text string, phase string, t int")
    out = {r["id"]: r["phase"] for r in curation.pre_post_native(df, ["g"], "text", "phase", ["t"]).collect()}
    assert out == {"v1": "NATIVE", "v2": None, "v3": None, "v4": None, "v5": "ARTERIAL", "v6": None, "v7": None}


def test_headers_with_blanks_and_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text(',a,"b,1",c\n0,x,"y, z",\n1,u,v,\n')
    (tmp_path / "b.csv").write_text("a,d\nw,5\n")
    (tmp_path / "c.txt").write_text("k\tv,w\n1\t2,3\n")
    paths = [f"file://{tmp_path}/{n}" for n in ("a.csv", "b.csv", "c.txt")]
    assert sources.header_of(spark, paths[0]) == ["Unnamed: 0", "a", "b,1", "c"]
    df = sources.read_all(spark, paths[:2])
    assert df.columns == ["a", "b,1", "d"]
    assert sorted(map(str, map(tuple, df.collect()))) == ["('u', 'v', None)", "('w', None, '5')", "('x', 'y, z', None)"]
    assert sources.load(spark, paths[0]).columns == ["Unnamed: 0", "a", "b,1", "c"]
    assert [tuple(r) for r in sources.load(spark, paths[2]).collect()] == [("1", "2,3")]


def test_join_with_a_repeated_key_fails(spark):
    df = spark.createDataFrame([(1,), (2,)], "k long")
    other = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c")], "k long, v string")
    with pytest.raises(Exception, match="repeated key"):
        tables.joined_once(df, other, ["k"]).collect()
    assert sorted(map(tuple, tables.joined_once(df, other.filter("v <> 'b'"), ["k"]).collect())) == [(1, "a"), (2, None)]


def test_unchanged_dataset(spark):
    df = spark.range(20).withColumn("x", F.col("id") * 2)
    same, state = incremental.unchanged_dataset(df, "id", ["id", "x"], {"a": 1}, None)
    assert not same and incremental.unchanged_dataset(df.repartition(5), "id", ["id", "x"], {"a": 1}, state)[0]
    assert not incremental.unchanged_dataset(df, "id", ["id", "x"], {"a": 2}, state)[0] and not incremental.unchanged_dataset(df.filter("id > 0"), "id", ["id", "x"], {"a": 1}, state)[0]


def test_clean_end_to_end(spark, tmp_path):
    from stratiform.plans import steps

    (tmp_path / "in.csv").write_text('id,name,iop,kind,n,t,s\n1,Ä  B.0,"[2, 0, 0, 0, 1, 0]","ORIGINAL\\PRIMARY",5,2.0,1.5\n2,c,,,1,3.0,\n')
    plan = [{"type": "normalize_string", "columns": ["name"]}, {"type": "standardize_iop", "columns": ["iop"]}, {"type": "parse_image_type", "columns": ["kind"]}, {"type": "compute_volume_length", "count": "n", "thickness": "t", "spacing": "s"}]
    out = steps.clean(spark, [f"file://{tmp_path}/in.csv"], plan, f"file://{tmp_path}/out", ["id", "name", "iop", "kind_tokens", "volume_length"])
    rows = {r["id"]: r for r in out.collect()}
    assert rows["1"]["name"] == "a b" and list(rows["1"]["iop"]) == [1, 0, 0, 0, 1, 0] and rows["1"]["volume_length"] == 8.0 and rows["2"]["volume_length"] == 3.0 and len(rows["1"]["kind_tokens"]) == 2
    with pytest.raises(ValueError):
        steps.clean(spark, [], [{"type": "nothing"}], f"file://{tmp_path}/other")


def test_staple_by_scan(spark):
    # three raters agree but for one voxel in scan 1; in scan 2 the third marks all voxels, and only there is it distrusted
    grid = [(s, r, x, 0, 0) for s in (1, 2) for r in ("a", "b", "c") for x in range(10)]
    marks = [(s, r, x, 0, 0) for s, r, x, _, _ in grid if x < 4 or (s == 2 and r == "c") or (s == 1 and r == "a" and x == 4)]
    schema = "scan_id long, rater string, x long, y long, z long"
    both = voxels.staple(spark.createDataFrame(grid, schema), spark.createDataFrame(marks, schema), ["a", "b", "c"])
    got = {(r["scan_id"], r["x"]): r["fused"] for r in both.collect()}
    assert len(got) == 20 and all(fused == (x < 4) for (_, x), fused in got.items())
    alone = voxels.staple(spark.createDataFrame([g for g in grid if g[0] == 1], schema), spark.createDataFrame(marks, schema), ["a", "b", "c"])
    same = {(r["scan_id"], r["x"]): r["probability"] for r in both.filter("scan_id = 1").collect()}
    assert same == {(r["scan_id"], r["x"]): r["probability"] for r in alone.collect()}  # other scans have no say
    with pytest.raises(ValueError):
        voxels.staple(both, both, [str(i) for i in range(17)])


def test_ranks_and_percentiles(spark):
    import numpy as np

    g = np.random.default_rng(5)
    values = {"a": np.round(g.normal(size=3000), 2), "b": np.full(500, 7.0), "c": np.array([1.0]), None: g.normal(size=40)}
    rows = [(k, float(v)) for k, vs in values.items() for v in vs] + [("a", None), ("d", None)]
    df = spark.createDataFrame(rows, "g string, value double")
    got = {r["g"]: r["_p"] for r in ranks.percentiles(df, ["g"], (0.0, 0.25, 0.5, 0.99, 1.0)).collect()}
    assert got.keys() == values.keys()
    for k, vs in values.items():
        assert np.allclose(got[k], np.quantile(vs, [0.0, 0.25, 0.5, 0.99, 1.0]))
    before = {(r["g"], r["value"]): (r["_before"], r["_k"]) for r in ranks.cumulated(df, ["g"]).collect()}
    assert before == {(k, float(v)): (int((vs < v).sum()), int((vs == v).sum())) for k, vs in values.items() for v in set(vs)}
    assert ranks.cumulated(df.limit(0), ["g"]).count() == 0 == ranks.percentiles(df.limit(0), ["g"], (0.5,)).count()


def test_texts_are_marked_once(spark):
    """The marked text, the spans and the names are evaluated once for a text, not by every use; regular expressions per text stay few."""
    assert str(phases.phases_in_order(F.col("t"))).count("regexp_") < 100


def test_oblique_ties(spark):
    """Angles at the threshold: the query and its SQL call the same ones oblique."""
    import duckdb
    import math
    from stratiform.queries.base import ORACLE_SQL
    from stratiform.queries.texts import g03_plane

    def six(angle):
        t = math.radians(angle)
        return [math.cos(t), 0.0, -math.sin(t), 0.0, 1.0, 0.0, 0.0, 0.0, 0.0]

    angles = [24.9, 25.0, 25.0001, 25.0002, 25.0003, 25.1, 40.0, -25.0001]
    folder = tempfile.mkdtemp(prefix="spark-")
    spark.createDataFrame([(i, six(a)) for i, a in enumerate(angles)], "vec_id long, embedding array<double>").coalesce(1).write.parquet(f"{folder}/embeddings.parquet")
    got = sorted(map(tuple, g03_plane(spark, folder).select("vec_id", "plane").collect()))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{folder}/embeddings.parquet/*.parquet'")
    assert got == sorted(con.execute(f"select vec_id, plane from ({ORACLE_SQL['g03_plane']})").fetchall())
    assert [p for _, p in got] == ["AX", "AX", "AX", "AX", "OBL", "OBL", "OBL", "AX"]


def test_normal_is_computed_once(spark):
    assert str(vectors.normal(F.col("v"))).count("element_at") < 50


def test_published_csv_is_read(spark):
    """header_of, first_line and read_csv find the current version of a saved table."""
    path = tempfile.mkdtemp(prefix="spark-") + "/t.csv"
    for k in (1, 2):
        sources.save(spark.createDataFrame([(k, "a,b"), (k + 10, "c")], "n int, t string"), path, "csv")
    assert sources.header_of(spark, path) == ["n", "t"]
    for of in (path, [path]):
        assert sorted(map(tuple, sources.read_csv(spark, of, ["n", "t"], ["n", "t"]).collect())) == [("12", "c"), ("2", "a,b")]


def test_context_joins_nothing_and_is_dealt_by_rows(spark, monkeypatch):
    """The rules of an exam run where its rows are dealt to, in as many partitions as their number needs."""
    from stratiform import shared
    from stratiform.operators import context

    monkeypatch.setattr(shared.spread, "__kwdefaults__", {**shared.spread.__kwdefaults__, "rows": 5})
    rows = spark.createDataFrame([(i // 3, f"v{i}", "T1 vibe dyn", "MR", i) for i in range(60)], "patient int, volume string, SeriesDescription string, Modality string, time_seconds int")
    out = context.in_context(curation.annotate_mr(rows), ["patient"], "volume")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "RepartitionByExpression" in plan
    assert out.rdd.getNumPartitions() == 12


def test_fold_of_ties_and_rows_without_a_place(spark):
    """Every row comes back once: ones without a place, ones that share a place, and ones whose key is null, which have no phase."""
    rows = [(1, 1, "NATIVE", 0.0), (1, 2, None, 25.0), (1, 2, None, 70.0), (1, None, None, 200.0), (None, 1, None, 0.0)]
    out = curation.fold_phases(spark.createDataFrame(rows, "g int, at int, known string, sec double"), ["g"], "at", "known", "sec")
    got = sorted((tuple(r) for r in out.select("g", "sec", "folded_phase").collect()), key=str)
    assert got == sorted([(1, 0.0, "NATIVE"), (1, 25.0, "ARTERIAL"), (1, 70.0, "PORTAL_VENOUS"), (1, 200.0, None), (None, 0.0, None)], key=str)


def test_holes_are_filled_without_broadcasts(spark):
    """Tables with a row per scan or component aren't sent whole to the driver, however small."""
    grid = spark.range(27).selectExpr("1 as scan_id", "cast(id % 3 as int) as x", "cast(id div 3 % 3 as int) as y", "cast(id div 9 as int) as z")
    out = voxels.fill_holes(grid.filter("not (x = 1 and y = 1 and z = 1)"), grid)
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().sparkPlan().toString()
    assert out.count() == 27


def test_voxels_are_joined_by_as_many_tasks_as_their_rows_need(spark, monkeypatch):
    """More tasks than the session's shuffle partitions (4), which adaptive execution doesn't join again."""
    grid = spark.range(64).selectExpr("id div 64 as scan_id", "cast(id % 4 as int) as x", "cast(id div 4 % 4 as int) as y", "cast(id div 16 as int) as z")
    out = voxels._met(grid, grid.withColumn("seen", F.lit(True)), [(c, c) for c in voxels.VOXEL], 12)
    assert out.rdd.getNumPartitions() == 12 and out.count() == 64
    monkeypatch.setattr(voxels, "TASK_ROWS", 5)
    got = voxels.labelled(grid.filter("x <> 1")).groupBy("label").count().collect()
    assert sorted((tuple(r["label"]), r["count"]) for r in got) == [((0, 0, 0), 16), ((2, 0, 0), 32)]
