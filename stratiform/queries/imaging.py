"""Filters, projections and reports of imaging tables."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratiform.functions import text as T
from stratiform.operators import imaging as M
from stratiform.operators import voxels as X
from stratiform.operators.compare import keys_of
from stratiform.operators.errors import hooked
from stratiform.operators.incremental import short_id, source_id
from stratiform.operators.ordering import after_anchor, top
from stratiform.operators.profile import group_statistics, label_coverage, path_columns
from stratiform.queries.base import CANDIDATES, candidates, query, r6, table
from stratiform.queries.images import _A, _VOX, _masks, _only
from stratiform.queries.texts import _texts


@query("SELECT p_partkey FROM part WHERE p_type IN ('ECONOMY', 'SMALL') AND (p_size % 3 = 0 OR p_brand IN ('Brand#1', 'Brand#2'))")
def f07_supported(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("storage", F.when(F.col("p_size") % 3 != 0, F.col("p_brand")))
    return M.supported(p, "p_type", "storage", ["ECONOMY", "SMALL"], ["Brand#1", "Brand#2"]).select("p_partkey")


@query("SELECT o_orderkey FROM orders WHERE NOT contains(o_orderpriority, 'HIGH') AND NOT contains(o_orderpriority, 'LOW')")
def f08_without_listed(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("list", F.split("o_orderpriority", "-"))
    return M.without_listed(o, "list", ["HIGH", "LOW"]).select("o_orderkey")


@query("SELECT p_partkey FROM part WHERE p_size > 3 AND NOT regexp_matches(lower(p_name || '|' || p_type), 'ring|small')")
def f09_without_scouts(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("p_type", F.when(F.col("p_size") > 3, F.col("p_type")))
    return M.without_scouts(p, ["p_name", "p_type"], ["ring", "small"]).select("p_partkey")


@query("SELECT p_partkey FROM part WHERE NOT contains(lower(p_name), 'bolt')")
def f10_without_text(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("other", F.lit(None).cast("string"))
    return M.without_text(p, ["p_name", "other"], "bolt").select("p_partkey")


@query("SELECT p_partkey, lower(p_name) AS p_name FROM part WHERE NOT regexp_matches(lower(p_name), 'ring|gear')")
def f11_without_other_organs(spark, sf_dir):
    return M.without_other_organs(table(spark, sf_dir, "part"), "p_name", ["ring", "gear"]).select("p_partkey", "p_name")


@query("WITH v AS (SELECT vec_id, list_transform(embedding[1:6], lambda x: CAST(x AS DOUBLE)) AS o FROM embeddings), c AS (SELECT vec_id, abs(o[2] * o[6] - o[3] * o[5]) AS x, abs(o[3] * o[4] - o[1] * o[6]) AS y, abs(o[1] * o[5] - o[2] * o[4]) AS z FROM v) SELECT vec_id FROM c WHERE z > x AND z > y")
def f12_on_axis(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.slice(F.col("embedding").cast("array<double>"), 1, 6).alias("o"))
    return M.on_axis(e, "o").select("vec_id")


@query("SELECT count(*) FILTER (WHERE o_orderkey % 5 = 0) AS blank_keys, count(*) AS rows, count(DISTINCT o_orderkey) AS scans FROM orders")
def f18_identity(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("k", F.when(F.col("o_orderkey") % 5 == 0, " ").otherwise("x"))
    return M.identity_problems(o, ["k", "o_orderkey"], "o_orderkey")


@query(f"WITH {CANDIDATES} SELECT patient, yr, count(DISTINCT slot) AS n, list_sort(list(DISTINCT slot)) AS slots FROM candidates GROUP BY 1, 2")
def a10_label_coverage(spark, sf_dir):
    return label_coverage(candidates(spark, sf_dir), ["patient", "yr"], "slot").withColumnRenamed("labels", "slots")


@query(f"WITH {CANDIDATES}, d AS (SELECT n, count(*) AS exams FROM (SELECT patient, yr, count(DISTINCT slot) AS n FROM candidates GROUP BY 1, 2) GROUP BY 1) SELECT range AS n, coalesce(exams, 0) AS exams FROM range(0, 5) LEFT JOIN d ON n = range")
def a11_coverage_distribution(spark, sf_dir):
    return M.coverage_distribution(candidates(spark, sf_dir), ["patient", "yr"], "slot")


@query("SELECT o_custkey, year(o_orderdate) AS yr, round(avg(o_totalprice), 6) AS mean, round(median(o_totalprice), 6) AS median, min(o_totalprice) AS low, max(o_totalprice) AS high, count(*) AS n FROM orders GROUP BY 1, 2")
def a13_group_statistics(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("yr", F.year("o_orderdate"))
    return group_statistics(o, ["o_custkey", "yr"], "o_totalprice").withColumns({c: r6(F.col(c)) for c in ("mean", "median")})


@query("SELECT o_orderstatus, round(avg(o_totalprice), 6) AS mean, round(median(o_totalprice), 6) AS median, min(o_totalprice) AS low, max(o_totalprice) AS high, count(*) AS n FROM orders GROUP BY 1")
def a13_statistics_of_large_groups(spark, sf_dir):
    """A few groups of many rows, as modalities are."""
    return group_statistics(table(spark, sf_dir, "orders"), ["o_orderstatus"], "o_totalprice").withColumns({c: r6(F.col(c)) for c in ("mean", "median")})


@query("SELECT 'all' AS stage, count(*) AS rows FROM orders UNION ALL SELECT 'open', count(*) FROM orders WHERE o_orderstatus = 'O'")
def a20_stage_funnel(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return M.stage_funnel({"all": o, "open": o.filter("o_orderstatus = 'O'")})


@query(f"WITH {CANDIDATES}, w AS (SELECT patient, yr, max(score) AS best FROM candidates WHERE slot = '1-URGENT' GROUP BY 1, 2), e AS (SELECT DISTINCT patient, yr FROM candidates) SELECT e.patient, e.yr, best FROM w RIGHT JOIN e ON w.patient = e.patient AND w.yr = e.yr")
def j05_right_join(spark, sf_dir):
    c = candidates(spark, sf_dir)
    best = c.filter("slot = '1-URGENT'").groupBy("patient", "yr").agg(F.max("score").alias("best"))
    return best.join(keys_of(c, ["patient", "yr"]), ["patient", "yr"], "right")


@query("SELECT DISTINCT a.doc_id FROM documents a JOIN documents b ON a.source = b.source AND a.lang = b.lang WHERE b.doc_id % 50 = 0 AND a.doc_id > b.doc_id")
def j14_anchored_rows(spark, sf_dir):
    """Rows after the first anchor of their protocol: a few large groups, and no self join."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return after_anchor(d, ["source", "lang"], "doc_id", F.col("doc_id") % 50 == 0).select("doc_id")


@query("""SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 4 ELSE 99 END, lower(o_orderpriority), o_orderkey) AS place FROM orders""")
def o02_viewer_order(spark, sf_dir):
    """The order of the whole table, as places within each customer."""
    o = table(spark, sf_dir, "orders").withColumn("phase", F.when(F.col("o_orderstatus") == "F", "NATIVE").when(F.col("o_orderstatus") == "O", "delayed"))
    rows = M.viewer_order(o, "phase", ["o_orderpriority"], "o_orderkey").withColumn("_at", F.monotonically_increasing_id())
    return rows.select("o_orderkey", F.row_number().over(W.partitionBy("o_custkey").orderBy("_at")).alias("place"))


@query("SELECT 'CT' AS kind, count(*) AS n FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'MR', count(*) FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT 'OTHER', count(*) FROM orders WHERE o_orderstatus = 'P'")
def u2_by_modality(spark, sf_dir):
    m = F.when(F.col("o_orderstatus") == "F", "ct").when(F.col("o_orderstatus") == "O", "MRI")
    parts = M.by_modality(table(spark, sf_dir, "orders").withColumn("Modality", m))
    return M.stage_funnel(parts).withColumnRenamed("stage", "kind").withColumnRenamed("rows", "n")


@query("SELECT o_custkey, o_orderpriority FROM orders GROUP BY 1, 2 HAVING bool_and(o_orderkey % 3 = 0)")
def u4_vanished_keys(spark, sf_dir):
    """Priorities that a customer has in one version of the orders only."""
    o = table(spark, sf_dir, "orders")
    key = ["o_custkey", "o_orderpriority"]
    return keys_of(o, key).exceptAll(keys_of(o.filter("o_orderkey % 3 > 0"), key))


#: What the texts are without their phase, dynamic, ordinal and duration tokens.
_PROTOCOL = {0: "ax", 1: "ax t1", 2: "cor 3mm", 3: "sag", 5: "and", 9: "scout", 11: "axial", 13: "sub mip", 15: "and", 17: "tra bh nav", 19: "liver"}
_PROTOCOL_SQL = "CASE p_partkey % 20 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in _PROTOCOL.items()) + " ELSE '' END"


@query(f"SELECT p_partkey, {_PROTOCOL_SQL} AS name FROM part")
def t18_protocol_name(spark, sf_dir):
    return _texts(spark, sf_dir).select("p_partkey", M.protocol_name(F.col("text")).alias("name"))


@query("SELECT p_partkey, replace(replace(p_name, ' ', '%20'), '#', '%23') || '%2F' || replace(p_brand, '#', '%23') AS component FROM part")
def t22_path_component(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.path_component(F.concat_ws("/", "p_name", "p_brand")).alias("component"))


@query("SELECT o_orderkey, o_custkey / 4 AS x, 0.5 AS y, (o_custkey / 4 + 0.5) / 2 AS mean, o_custkey / 8 AS area FROM orders")
def m02_pixel_spacing(spark, sf_dir):
    s = M.spacing(F.concat(F.format_string("%.2f", F.col("o_custkey") / 4), F.lit("\\0.5")))
    return table(spark, sf_dir, "orders").select("o_orderkey", s["x"].alias("x"), s["y"].alias("y"), s["mean"].alias("mean"), s["area"].alias("area"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN least(CAST(o_custkey AS DOUBLE), 500.0) END AS n FROM orders")
def m01_first_number(spark, sf_dir):
    cells = F.when(F.col("o_orderkey") % 2 == 0, F.array(F.col("o_custkey").cast("string"), F.lit("500.0"), F.lit("x"))).otherwise(F.array(F.lit("none")))
    return table(spark, sf_dir, "orders").select("o_orderkey", M.first_number(cells, True).alias("n"))


@query(f"WITH {CANDIDATES} SELECT patient, o_orderkey FROM candidates QUALIFY row_number() OVER (PARTITION BY patient ORDER BY score DESC, o_orderkey) = 1")
def w11_best_per_patient(spark, sf_dir):
    return top(candidates(spark, sf_dir), ["patient"], [F.desc("score"), "o_orderkey"]).select("patient", "o_orderkey")


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'AB-' || c_nationkey || '-C' WHEN 1 THEN 'AB-' || c_nationkey END AS key FROM customer")
def p06_site_key(spark, sf_dir):
    n, k = F.col("c_nationkey").cast("string"), F.col("c_custkey") % 4
    raw = F.when(k == 0, F.concat(F.lit("123_ab00"), n, F.lit("c"))).when(k == 1, F.concat(F.lit("AB-"), n, F.lit("^AB-"), n)).when(k == 2, F.concat(F.lit("ZZ"), n)).otherwise("a^b")
    return table(spark, sf_dir, "customer").select("c_custkey", M.site_key(raw, {"AB": "Paris"}, {"C": "control"}).alias("key"))


@query("SELECT c_custkey, concat_ws('; ', CASE WHEN c_custkey % 2 = 0 THEN 'c_name=' || c_name END, 'c_mktsegment=' || c_mktsegment) AS summary FROM customer")
def p21_evidence_summary(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("c_name", F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise(" "))
    return c.select("c_custkey", M.evidence_summary(["c_name", "c_mktsegment"]).alias("summary"))


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'fixed' ELSE regexp_extract(url, '^(.*)/[^/]*$', 1) END AS folder FROM pages")
def p24_folder(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", M.folder_of(F.array("url"), F.when(F.col("page_id") % 3 == 0, "fixed").otherwise(" ")).alias("folder"))


@query("SELECT s_suppkey, 'liver' AS organ, CASE s_suppkey % 3 WHEN 0 THEN 'organ_minus_tumor' WHEN 1 THEN 'organ' ELSE 'tumor' END AS plan FROM supplier")
def p16_region_plan(spark, sf_dir):
    k = F.col("s_suppkey") % 3
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(k != 2, "a.nii").alias("mask_liver_path"), F.when(k != 1, "b.nii").otherwise(" ").alias("mask_liver_tumor_path"), F.lit("c").alias("source_mask_liver_path"), F.lit("d").alias("mask__path"))
    return M.region_plan(M.regions(s.drop("mask__path"), "s_suppkey"), "s_suppkey")


@query("SELECT s_suppkey, 'liver' AS organ, CASE WHEN s_suppkey % 3 = 2 THEN 'tumor' WHEN s_suppkey % 3 = 0 AND s_suppkey % 4 > 0 THEN 'organ_minus_tumor' ELSE 'organ' END AS plan FROM supplier WHERE NOT (s_suppkey % 3 = 2 AND s_suppkey % 4 = 0)")
def q11_plan_of_filled_masks(spark, sf_dir):
    """A tumour without voxels is not taken out: the plan falls back to the organ."""
    k = F.col("s_suppkey") % 3
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(k != 2, "a.nii").alias("mask_liver_path"), F.when(k != 1, "b.nii").alias("mask_liver_tumor_path"))
    found = M.regions(s, "s_suppkey")
    sizes = found.select("s_suppkey", "roi", F.when((F.col("roi") == "liver_tumor") & (F.col("s_suppkey") % 4 == 0), 0).otherwise(10).alias("n"))
    return M.region_plan(found, "s_suppkey", sizes)


@query("SELECT s_suppkey, s_name, s_acctbal AS source_s_acctbal, s_acctbal + 1 AS s_acctbal FROM supplier")
def p17_backup(spark, sf_dir):
    s = M.backed_up(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal"), ["s_acctbal"])
    once = s.withColumn("s_acctbal", F.col("s_acctbal") + 99)
    return M.backed_up(once, ["s_acctbal"]).withColumn("s_acctbal", F.col("s_acctbal") + 1)


@query("SELECT event_id, CAST(NULL AS VARCHAR) AS note, event_type AS kind, CASE WHEN event_id % 2 = 0 THEN 'done' ELSE 'not_run' END AS k_status, CASE WHEN event_type = 'error' THEN 'bad | worse' END AS errors FROM events")
def p18_quality_table(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("details", F.when(F.col("event_id") % 2 == 0, F.lit('{"k": {"status": "done"}}')).otherwise(F.lit("{}")))
    errors = e.filter("event_type = 'error'").select("event_id", F.explode(F.array(F.lit("worse"), F.lit("bad"))).alias("message"))
    return M.quality_table(e, {"note": "note", "event_type": "kind"}, "details", ["k"], errors, "event_id")


@query("SELECT 'url' AS \"column\", count(*) AS n FROM pages")
def p22_path_columns(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("url", "html", F.lit("x").alias("c"))
    found = path_columns(p)
    return p.select(F.explode(F.array(*map(F.lit, found))).alias("column")).groupBy("column").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, substr(sha256('{\"o_custkey\":' || o_custkey || '}'), 1, 20) AS id FROM orders")
def h02_short_id(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", short_id(["o_custkey"]).alias("id"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN sha256('{\"o_orderkey\":' || o_orderkey || '}') ELSE 'v' || o_orderkey END AS id FROM orders")
def i01_source_id(spark, sf_dir):
    volume = F.when(F.col("o_orderkey") % 4 == 0, " ").otherwise(F.concat(F.lit("v"), F.col("o_orderkey").cast("string")))
    return table(spark, sf_dir, "orders").select("o_orderkey", source_id(volume, ["o_orderkey"]).alias("id"))


@query(f"WITH {_VOX}, {_A}, b AS (SELECT * FROM vox WHERE value > 0.05 OR (x = 0 AND value > -0.1)), d AS (SELECT scan_id, x, y, z FROM a EXCEPT SELECT scan_id, x, y, z FROM b), u AS (SELECT * FROM d UNION SELECT scan_id, x, y, z FROM vox WHERE value > 0.05 OR (x = 0 AND value > -0.1)) SELECT scan_id, count(*) AS n FROM u GROUP BY 1")
def x02_mask_program(spark, sf_dir):
    v, m = _masks(spark, sf_dir)
    out = M.mask_program(m, v, [{"op": "difference", "inputs": ["a", "b"], "output": "rest"}, {"op": "union", "inputs": ["rest", "b"], "output": "all"}])
    return _only(out, "all").groupBy("scan_id").agg(F.count("*").alias("n"))


@query(f"WITH {_VOX}, {_A} SELECT scan_id, count(*) AS n FROM (SELECT scan_id, x, y, z FROM a EXCEPT SELECT scan_id, x, y, z FROM vox WHERE value > 0.05 OR (x = 0 AND value > -0.1)) GROUP BY 1")
def x06_organ_minus_tumor(spark, sf_dir):
    _, m = _masks(spark, sf_dir)
    return X.combine(m, ["a", "b"], "difference").groupBy("scan_id").agg(F.count("*").alias("n"))


@query(f"""WITH RECURSIVE {_VOX}, m AS (SELECT scan_id, x, y, z FROM vox WHERE value > 0.05 OR (x = 0 AND value > -0.1)), n6 AS (SELECT * FROM (VALUES (1,0,0),(-1,0,0),(0,1,0),(0,-1,0),(0,0,1),(0,0,-1)) t(i,j,k)),
r AS (SELECT *, x * 16 + y * 4 + z AS root FROM m UNION SELECT m.scan_id, m.x, m.y, m.z, r.root FROM r, n6, m WHERE m.scan_id = r.scan_id AND m.x = r.x + i AND m.y = r.y + j AND m.z = r.z + k),
s AS (SELECT scan_id, root, count(*) AS n FROM (SELECT scan_id, x, y, z, min(root) AS root FROM r GROUP BY ALL) GROUP BY 1, 2), o AS (SELECT scan_id, count(*) AS components, max(n) AS largest, sum(n) AS voxels FROM s GROUP BY 1), f AS (SELECT scan_id, count(*) AS ref FROM vox WHERE value > 0 GROUP BY 1)
SELECT scan_id, components, largest, round(1 - largest / voxels, 6) AS fragments, round((voxels - ref) / ref, 6) AS change FROM o LEFT JOIN f USING (scan_id)""")
def x11_fragments(spark, sf_dir):
    _, m = _masks(spark, sf_dir)
    return M.fragments(_only(m, "b"), _only(m, "a")).withColumns({c: r6(F.col(c)) for c in ("fragments", "change")})


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderstatus = 'P' AS INT), o_totalprice, o_orderkey) AS k FROM orders), g AS (SELECT o_custkey, max(CASE WHEN k = 1 THEN o_orderkey END) AS reference, count(*) AS members, count(*) FILTER (WHERE o_totalprice > 100000) AS contributors FROM r GROUP BY 1)
SELECT *, CASE WHEN members = 1 THEN 'single' WHEN contributors >= 2 THEN 'consensus' ELSE 'reference_only' END AS status FROM g""")
def x18_group_status(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("partial", F.col("o_orderstatus") == "P")
    return M.group_status(o, "o_custkey", "partial", ["o_totalprice", "o_orderkey"], F.col("o_totalprice") > 100000)


@query("SELECT p_partkey, CASE WHEN p_size % 7 > 0 THEN p_size * 2 + length(p_name) END AS made, CASE WHEN p_size % 7 > 0 THEN split_part(p_name, ' ', 1) END AS head, CASE WHEN p_size % 7 = 0 THEN 'ValueError: size ' || p_size END AS error_message FROM part")
def ud2_row_hook(spark, sf_dir):
    """Two outputs of one call; rows whose call fails keep the message."""

    def made(size, name):
        if size % 7 == 0:
            raise ValueError(f"size {size}")
        return {"made": size * 2 + len(name), "head": name.split(" ")[0]}

    return hooked(table(spark, sf_dir, "part"), made, ["p_size", "p_name"], {"made": "long", "head": "string"}, on_error="record").select("p_partkey", "made", "head", "error_message")


@query("SELECT p_partkey, CASE WHEN max(CAST(p_partkey % 20 NOT IN (9, 13, 17, 18, 19) AS INT)) OVER (PARTITION BY p_partkey // 3) = 0 THEN 'NATIVE' END AS phase FROM part")
def c17_native_default(spark, sf_dir):
    t = _texts(spark, sf_dir).withColumns({"phase": F.lit(None).cast("string"), "exam": F.floor(F.col("p_partkey") / 3)})
    return M.native_default(t, ["exam"], "phase", "text").select("p_partkey", "phase")


@query(f"""WITH t AS (SELECT p_partkey, p_partkey // 40 AS exam, p_partkey % 20 = 10 AS n, {_PROTOCOL_SQL} AS protocol FROM part)
SELECT p_partkey, bool_or(n) OVER w AS numbered, max(CAST(n AS INT)) OVER w AS numbers FROM t WINDOW w AS (PARTITION BY exam, protocol)""")
def c15_numbered_context(spark, sf_dir):
    t = _texts(spark, sf_dir).withColumn("exam", F.floor(F.col("p_partkey") / 40))
    return M.numbered_context(t, ["exam"], "text").select("p_partkey", F.col("in_numbered_protocol").alias("numbered"), "numbers")
