"""CT and MR curation, shared table operators, declared pipelines, sources and the incremental index."""

from pyspark.sql import functions as F

from stratiform.operators import context as X
from stratiform.operators import curation as C
from stratiform.operators import phases as PH
from stratiform.operators import tables as T
from stratiform.plans import steps as L
from stratiform.queries.base import query, r6, table
from stratiform.queries.texts import _MEANT, _PLANES, _TEXTS, _case
from stratiform.shared import scratch, spread
from stratiform.sources import tables as S
from stratiform.sources.publish import published
from stratiform.streaming.index import build_index

_CT_PHASE = _case({k: v for k, v in _MEANT.items() if v}, "VARCHAR")
_CT = f"""ct AS (SELECT p_partkey, p_brand, CASE WHEN p_partkey % 20 = 9 THEN 'OTHER' ELSE coalesce({_CT_PHASE}, 'OTHER') END AS phase, {_case(_PLANES, 'VARCHAR')} AS plane, p_size > 20 AS square, p_size, p_partkey % 2 = 0 AS original, p_partkey % 20 = 9 AS loc, p_partkey % 20 = 13 AS low FROM part),
scored AS (SELECT *, CASE phase WHEN 'PORTAL_VENOUS' THEN 110 WHEN 'ARTERIAL' THEN 105 WHEN 'DELAYED' THEN 95 WHEN 'NATIVE' THEN 80 ELSE 0 END + CASE WHEN plane = 'AXIAL' OR (plane IS NULL AND square) THEN 40 ELSE 0 END + CASE WHEN original THEN 30 ELSE 0 END
 + CASE WHEN square THEN 20 ELSE -10 END + CASE WHEN p_size * 4 >= 80 THEN 20 WHEN p_size * 4 < 20 THEN -50 ELSE 0 END + CASE WHEN p_size % 9 <= 3 THEN 10 WHEN p_size % 9 > 7 THEN -10 ELSE 0 END - CASE WHEN loc THEN 500 ELSE 0 END - CASE WHEN low THEN 200 ELSE 0 END AS score FROM ct)"""


def _ct(spark, sf_dir):
    text = F.element_at(F.array(*(F.lit(_TEXTS[i]) for i in range(20))), (F.col("p_partkey") % 20 + 1).cast("int"))
    df = table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", text.alias("SeriesDescription"), F.lit("").alias("ProtocolName"), F.when(F.col("p_size") > 20, 512).otherwise(256).alias("Rows"), F.lit(512).alias("Columns"), (F.col("p_size") * 4).alias("n_files"),
        (F.col("p_size") % 9).alias("SliceThickness"), F.when(F.col("p_partkey") % 2 == 0, "ORIGINAL\\PRIMARY\\AXIAL").otherwise("DERIVED\\SECONDARY").alias("ImageType"),
    )
    df = C.annotate_ct(df)
    df = df.withColumn("phase", F.col("rule_phase"))
    return df.withColumns({"selection_slot": F.col("phase"), "selection_score": C.score_ct(df)})


@query(f"WITH {_CT} SELECT p_partkey, phase, CAST(score AS DOUBLE) AS score FROM scored")
def c08_annotate_ct(spark, sf_dir):
    return _ct(spark, sf_dir).select("p_partkey", "phase", F.col("selection_score").alias("score"))


@query(f"""WITH {_CT}, r AS (SELECT *, row_number() OVER (PARTITION BY p_brand, phase ORDER BY score DESC, p_partkey) AS k FROM scored WHERE phase <> 'OTHER' AND score > -500) SELECT p_brand, """ + ", ".join(f"max(CASE WHEN phase = '{s}' AND k = 1 THEN p_partkey END) AS {s}, coalesce(string_agg(CASE WHEN phase = '{s}' AND k > 1 THEN p_partkey || ' (' || score || '.0)' END, '; ' ORDER BY k), '') AS {s}_other_candidates" for s in C.CT_SLOTS) + " FROM r GROUP BY 1")
def c09_select_ct(spark, sf_dir):
    return C.select(_ct(spark, sf_dir), ["p_brand"], C.CT_SLOTS, "p_partkey")[1]


_MR = {0: "AX T1 VIBE_W", 1: "T2 haste cor", 2: "dwi b 50", 3: "localizer", 4: "t2 tse fs bh", 5: "thrive portal 70 s", 6: "nothing", 7: "plain scan", 8: "key images", 9: "lava_opp gd tardif 8 min"}
_MR_SEQ = {0: "T1", 1: "T2", 2: "DWI", 3: "LOCALIZER", 4: "T2", 5: "T1", 6: "T1", 7: "T2", 8: "KEY_IMAGES", 9: "T1"}
_MR_SLOT = {0: "T1_OTHER", 1: "T2", 2: "DWI", 3: "OTHER", 4: "T2", 5: "T1_PORTAL_VENOUS", 6: "T1_OTHER", 7: "T2", 8: "OTHER", 9: "T1_DELAYED"}
_MR_SCORE = {0: 75.0, 1: 30.0, 2: 90.0 - 10.0, 4: 30.0 + 35 + 20 + 5, 5: 110.0 + 30 + 25, 6: 30.0, 7: 30.0, 9: 95.0 + 30 + 25}
_MR_DIXON = {0: "WATER", 9: "OUT_PHASE"}


def _ten(values, kind):
    return _case(values, kind).replace("% 20", "% 10")


@query(f"SELECT p_partkey, {_ten(_MR_SEQ, 'VARCHAR')} AS mri_sequence, {_ten(_MR_SLOT, 'VARCHAR')} AS selection_slot, CAST({_ten(_MR_SCORE, 'DOUBLE')} AS DOUBLE) AS score, {_ten(_MR_DIXON, 'VARCHAR')} AS dixon_component, {_ten({1: 'single_shot', 4: 'multi_shot'}, 'VARCHAR')} AS family FROM part")
def c23_score_mr(spark, sf_dir):
    text = F.element_at(F.array(*(F.lit(_MR[i]) for i in range(10))), (F.col("p_partkey") % 10 + 1).cast("int"))
    k = F.col("p_partkey") % 10
    df = table(spark, sf_dir, "part").select("p_partkey", text.alias("SeriesDescription"), F.when(k == 6, 500).when(k == 7, 3000).alias("RepetitionTime"), F.when(k == 6, 5).when(k == 7, 90).alias("EchoTime"), F.lit("MR").alias("Modality"), F.when(k == 9, "ORIGINAL\\PRIMARY\\OPP_PHASE").alias("ImageType"))
    df = C.annotate_mr(df).withColumn("phase", F.col("rule_phase"))
    df = C.score_mr(df)
    return df.select("p_partkey", "mri_sequence", "selection_slot", F.col("selection_score").alias("score"), "dixon_component", F.col("mri_t2_acquisition_family").alias("family"))


@query("""WITH e AS (SELECT event_id, user_id, date_trunc('hour', ts) AS h, event_type, CASE WHEN event_type = 'click' THEN 'NATIVE' WHEN event_type = 'purchase' THEN 'DELAYED' END AS label FROM events)
SELECT event_id, coalesce(label, CASE WHEN min(label) OVER w = max(label) OVER w THEN min(label) OVER w END) AS label FROM e WINDOW w AS (PARTITION BY user_id, h)""")
def c14_share_labels(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumns({"h": F.date_trunc("hour", "ts"), "label": F.when(F.col("event_type") == "click", "NATIVE").when(F.col("event_type") == "purchase", "DELAYED")})
    return C.share_labels(e, ["user_id", "h"], "label", F.lit(True), []).select("event_id", "label")


@query("""WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS d, event_type, value, CASE WHEN event_type = 'click' THEN 'NATIVE' END AS label FROM events),
w AS (SELECT *, count(*) FILTER (WHERE label = 'NATIVE') OVER p AS natives, count(DISTINCT event_type) OVER (PARTITION BY user_id, d) AS kinds, row_number() OVER (PARTITION BY user_id, d ORDER BY (event_type = 'view') DESC, value DESC, event_id) AS k FROM e WINDOW p AS (PARTITION BY user_id, d))
SELECT event_id, CASE WHEN natives = 0 AND kinds >= 2 AND k = 1 AND event_type = 'view' THEN 'NATIVE' ELSE label END AS label FROM w""")
def c16_missing_native(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumns({"d": F.to_date("ts"), "label": F.when(F.col("event_type") == "click", "NATIVE")})
    return C.missing_native(e, ["user_id", "d"], "event_type", "label", F.col("event_type") == "view", [F.desc("value"), F.col("event_id")]).select("event_id", "label")


@query("""WITH RECURSIVE e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS d, CASE event_type WHEN 'click' THEN 1 WHEN 'purchase' THEN 3 END AS place, value * 10 AS s FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, d ORDER BY event_id) AS k, coalesce(min(place) OVER (PARTITION BY user_id, d ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 5) AS bound,
 CASE WHEN s BETWEEN 20 AND 35 THEN 2 WHEN s BETWEEN 60 AND 90 THEN 3 WHEN s BETWEEN 180 AND 900 THEN 4 END AS timed FROM e),
f AS (SELECT user_id, d, 0::BIGINT AS k, 0 AS last, NULL::INT AS got, NULL::BIGINT AS event_id FROM (SELECT DISTINCT user_id, d FROM e)
UNION ALL SELECT user_id, d, k, coalesce(got, last), got, event_id FROM (SELECT r.user_id, r.d, r.k, f.last, r.event_id, coalesce(r.place, CASE WHEN guess < r.bound AND guess <= 4 THEN guess END) AS got
 FROM f JOIN (SELECT * FROM r) r ON r.user_id = f.user_id AND r.d = f.d AND r.k = f.k + 1, LATERAL (SELECT CASE WHEN r.timed >= f.last + 1 THEN r.timed WHEN r.s IS NULL OR f.last = 0 THEN f.last + 1 END AS guess)))
SELECT event_id, ['NATIVE', 'ARTERIAL', 'PORTAL_VENOUS', 'DELAYED'][got] AS folded_phase FROM f WHERE event_id IS NOT NULL""")
def w15_fold_phases(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.to_date("ts").alias("d"), F.when(F.col("event_type") == "click", "NATIVE").when(F.col("event_type") == "purchase", "PORTAL_VENOUS").alias("known"), (F.col("value") * 10).alias("elapsed"))
    return C.fold_phases(e, ["user_id", "d"], "event_id", "known", "elapsed").select("event_id", "folded_phase")


#: Series descriptions by event type, as they follow each other in an exam (a user's day).
_SERIES = {"view": "AX T1 vibe", "click": "AX T1 vibe arterial", "purchase": "T1 vibe tra portal 70 s", "error": "T2 haste"}


def _mr_exams(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    text = F.element_at(F.create_map(*[F.lit(x) for pair in _SERIES.items() for x in pair]), F.col("event_type"))
    rows = e.select("event_id", F.col("user_id").alias("patient_key"), F.to_date("ts").alias("date"), F.unix_timestamp("ts").alias("time_seconds"), text.alias("SeriesDescription"), F.lit("MR").alias("Modality"))
    return C.annotate_mr(spread(rows, "patient_key", "date"))


@query("""WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS d, event_type AS t FROM events),
x AS (SELECT *, count(*) FILTER (WHERE t IN ('click', 'purchase')) OVER (PARTITION BY user_id, d) AS known, row_number() OVER (PARTITION BY user_id, d, t = 'view' ORDER BY CAST(event_id AS VARCHAR)) AS k FROM e)
SELECT event_id, CASE t WHEN 'view' THEN 'NATIVE' WHEN 'click' THEN 'ARTERIAL' WHEN 'purchase' THEN 'PORTAL_VENOUS' ELSE 'OTHER' END AS rule_phase,
 CASE WHEN t = 'view' AND known > 0 AND k = 1 THEN 'exam_context' WHEN t = 'view' THEN 'native_no_perfusion_evidence' WHEN t IN ('click', 'purchase') THEN 'explicit_text' ELSE 'none' END AS source FROM x""")
def c19_in_context(spark, sf_dir):
    out = X.in_context(_mr_exams(spark, sf_dir), ["patient_key", "date"], "event_id")
    return out.select("event_id", "rule_phase", F.col("mri_perfusion_source").alias("source"))


#: Exams of several kinds: of each volume its text, seconds, acquisition, tag, ontology term, number within a series, and what the rules find, with the source.
_EXAMS = [
    [("T1 vibe", 0, "a", None, None, None, "NATIVE", "exam_context"), ("T1 vibe arterial", 10, "b", None, None, None, "ARTERIAL", "explicit_text"), ("T2 haste", 20, "c", None, None, None, "OTHER", "none")],
    [("T1 vibe", 0, "a", None, None, None, "NATIVE", "native_no_perfusion_evidence"), ("T1 vibe hbp", 10, "b", None, None, None, "HEPATOBILIARY", "explicit_text"), ("T1 vibe 20 min", 20, "c", None, None, None, "HEPATOBILIARY", "explicit_text")],
    [("T1 vibe ax", 0, "a", "PORTAL\\\\VENOUS", None, None, "PORTAL_VENOUS", "dicom_phase"), ("T1 vibe ax", 1, "a", None, None, None, "PORTAL_VENOUS", "acquisition_phase"), ("T1 vibe portal", 2, "b", "ARTERIAL\\\\DELAYED", None, None, "OTHER", "dicom_phase_conflict")],
    [("T1 vibe art portal late", 0, "a", None, None, 1, "ARTERIAL", "container_order"), ("T1 vibe art portal late", 30, "a2", None, None, 2, "PORTAL_VENOUS", "container_order"), ("T1 vibe art portal late", 60, "a3", None, None, 3, "DELAYED", "container_order")],
    [("T1 vibe native", 0, "a", None, None, None, "NATIVE", "explicit_text"), ("T1 vibe dyn", 30, "b", None, None, None, "ARTERIAL", "generic_dynamic"), ("T1 vibe dyn portal", 70, "c", None, None, None, "PORTAL_VENOUS", "explicit_text")],
    [("T1 lava", 0, "a", None, None, None, "NATIVE", "group_pre_post_order"), ("T1 vibe pre and post", 10, "b", None, None, None, "OTHER", "none")],
    [("T1 vibe native", 0, "a", None, None, None, "NATIVE", "explicit_text"), ("T1 vibe native ph 1", 10, "b", None, None, None, "OTHER", "ordinal_phase_conflict")],
    [("T1 vibe", 0, "a", None, None, None, "NATIVE", "exam_context"), ("T1 vibe gd", 30, "b", None, "veine porte", None, "OTHER", "none")],
    [("T1 vibe mask art", 0, "a", None, None, 1, "NATIVE", "container_order"), ("T1 vibe mask art", 30, "a2", None, None, 2, "ARTERIAL", "container_order")],
]
_AHEAD = {"strategies": [{"name": "terms", "type": "ontology", "columns": ["term"], "mapping": {"veine porte": "PORTAL_VENOUS"}, "confidence": "sure"}, {"name": "rules", "type": "rules"}]}
_SURE = {"explicit_text": "high", "dicom_phase": "high", "dicom_phase_conflict": "low", "acquisition_phase": "high", "container_order": "medium", "exam_context": "fallback", "generic_dynamic": "inferred", "group_pre_post_order": "inferred", "ordinal_phase_conflict": "low", "native_no_perfusion_evidence": "fallback", "none": "low"}


@query(f"""WITH v AS (SELECT * FROM (VALUES {", ".join(f"({e}, {k}, '{v[6]}', '{v[7]}', '{_SURE[v[7]]}', {v[4] is not None})" for e, exam in enumerate(_EXAMS) for k, v in enumerate(exam))}) t(kind, k, phase, source, confidence, named))
SELECT c_custkey, k, phase AS rule_phase, source, confidence, CASE WHEN named THEN 'PORTAL_VENOUS' ELSE phase END AS resolved, CASE WHEN named THEN 'terms' WHEN phase = 'OTHER' THEN 'unresolved' ELSE 'rules' END AS resolved_by FROM customer JOIN v ON kind = c_custkey % {len(_EXAMS)}""")
def c19_every_rule(spark, sf_dir):
    """An exam for each customer; every source of a phase occurs, and an ontology ahead of the rules anchors one exam without being overwritten by them."""
    kinds = spark.createDataFrame([(e, k, *v[:6]) for e, exam in enumerate(_EXAMS) for k, v in enumerate(exam)], "kind int, k int, SeriesDescription string, time_seconds int, acquisition_id string, ContrastBolusAgentPhase string, term string, volume_order_in_series int")
    n = kinds.groupBy("kind").agg(F.count("volume_order_in_series").alias("n_volumes_in_series"))
    c = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % len(_EXAMS)).cast("int").alias("kind"))
    rows = c.join(kinds.join(n, "kind"), "kind").withColumns({"volume": F.concat_ws("/", "c_custkey", "k"), "Modality": F.lit("MR"), "n_volumes_in_series": F.when(F.col("volume_order_in_series").isNotNull(), F.col("n_volumes_in_series"))})
    done = PH.resolve(X.in_context(C.annotate_mr(spread(rows, "c_custkey")), ["c_custkey"], "volume", chain=_AHEAD), _AHEAD)
    return done.select("c_custkey", "k", "rule_phase", F.col("mri_perfusion_source").alias("source"), F.col("mri_perfusion_confidence").alias("confidence"), F.when(F.col("mri_sequence") == "T1", F.col("phase")).otherwise("OTHER").alias("resolved"), F.when(F.col("phase_status") == "NOT_APPLICABLE", "unresolved").otherwise(F.col("phase_source")).alias("resolved_by"))


@query("""SELECT CAST(user_id AS VARCHAR) AS patient, CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'VIBE' ELSE 'UNSPECIFIED_T1' END AS family, CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'AXIAL' ELSE 'UNKNOWN' END AS plane, count(*) AS n FROM events GROUP BY ALL""")
def c27_protocol_key(spark, sf_dir):
    p = X.with_protocol(_mr_exams(spark, sf_dir), ["patient_key", "date"])
    return p.groupBy(F.col("protocol.patient_key").alias("patient"), F.col("protocol.family").alias("family"), F.col("protocol.plane").alias("plane")).agg(F.count("*").alias("n"))


# ------------------------------------------------------------ shared table operators


@query("SELECT c_custkey AS raw, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'p' || c_custkey END AS key, c_custkey % 4 = 0 AS lost, c_mktsegment FROM customer")
def p04_key_hook(spark, sf_dir):
    df = T.with_key(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_custkey", lambda c: F.when(c % 4 == 0, "").otherwise(F.concat(F.lit("p"), c.cast("string"))))
    return df.select(F.col("_c_custkey_raw").alias("raw"), F.col("c_custkey").alias("key"), F.col("_c_custkey_lost").alias("lost"), "c_mktsegment")


@query("SELECT o_orderkey, p[1] AS parts_value_1, p[2] AS parts_value_2, p[3] AS parts_value_3 FROM (SELECT o_orderkey, string_split(o_orderpriority, '-') AS p FROM orders WHERE o_orderstatus <> 'P')")
def p12_expand_list(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.split("o_orderpriority", "-")).alias("parts"))
    return T.expanded(df, "parts", 3).drop("parts")


@query("SELECT s_suppkey, n_name AS nation FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def p13_code_lookup(spark, sf_dir):
    return T.looked_up(table(spark, sf_dir, "supplier"), "s_nationkey", table(spark, sf_dir, "nation"), "n_nationkey", "n_name", "nation").select("s_suppkey", "nation")


@query("SELECT p_partkey, CASE WHEN lower(p_name) = 'red widget' THEN 'W' WHEN lower(p_name) = 'blue bolt' THEN 'B' ELSE lower(p_name) END AS label FROM part")
def p14_described(spark, sf_dir):
    names = spark.createDataFrame([("  Red  WIDGET", "W"), ("blue bolt", "B")], "text string, label string")
    return T.described_as(table(spark, sf_dir, "part"), "p_name", names).select("p_partkey", "label")


@query("""WITH g AS (SELECT o_custkey, list(o_orderkey ORDER BY o_orderkey) AS k FROM orders GROUP BY 1) SELECT o_custkey, list_transform(list_filter(k, lambda x: x % 3 > 0), lambda x: 'f' || x) AS cells FROM g WHERE len(list_filter(k, lambda x: x % 3 > 0)) > 0
UNION ALL SELECT o_custkey, ['lost'] FROM g WHERE len(list_filter(k, lambda x: x % 3 > 0)) = 0""")
def j18_mapped_lists(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    cells = o.groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda x: x.cast("string")).alias("cells"))
    mapping = o.filter("o_orderkey % 3 > 0").select(F.col("o_orderkey").cast("string").alias("path"), F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("target"))
    good, lost = T.mapped_lists(cells, "o_custkey", "cells", mapping)
    return good.select("o_custkey", "cells").union(lost.select("o_custkey", F.array(F.lit("lost"))))


@query("SELECT c_custkey, string_agg(o_orderpriority, ' | ' ORDER BY o_orderpriority) AS errors FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P' GROUP BY 1")
def j17_messages(spark, sf_dir):
    errors = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("message"))
    return T.with_messages(table(spark, sf_dir, "customer").select("c_custkey"), errors, "c_custkey")


@query("""WITH c AS (SELECT o_custkey, o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1, 2) SELECT o_custkey, '{' || string_agg('"' || s || '":' || n, ',' ORDER BY s) || '}' AS counts FROM c GROUP BY 1""")
def a09_status_report(spark, sf_dir):
    return T.status_report(table(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus")


@query("SELECT r_regionkey, n_nationkey FROM region CROSS JOIN (SELECT n_nationkey FROM nation WHERE n_nationkey < 4)")
def j07_fixed_labels(spark, sf_dir):
    """Every row with each of a fixed short list, by exploding the list: no join."""
    labels = F.explode(F.array(*(F.lit(i) for i in range(4))))
    return table(spark, sf_dir, "region").select("r_regionkey", labels.alias("n_nationkey"))


@query("SELECT doc_id FROM documents d WHERE doc_id % 3 > 0 AND EXISTS (SELECT 1 FROM documents x WHERE x.doc_id % 3 = 0 AND x.source = d.source AND x.lang = d.lang)")
def j15_protocol_match(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.when(F.col("doc_id") % 3 == 0, F.concat("lang", F.lit(" ph 2"))).otherwise(F.col("lang")).alias("text"))
    return T.protocol_matches(d, ["source"], "text", r"\bph \d+\b").select("doc_id")


@query("SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 25.0 ELSE 5.0 END AS bin_width FROM part")
def q14_settings(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_type") == "ECONOMY", "CT").otherwise("MR").alias("kind"))
    return T.settings_for(p, "kind", {"CT": {"bin_width": 25}, "MR": {"bin_width": 5}}).select("p_partkey", "bin_width")


_STEPS = [
    {"type": "filter", "kind": "keep", "rules": [{"column": "o_orderstatus", "op": "in", "value": ["F", "O"]}]},
    {"type": "add_date", "candidates": ["StudyDate", "SeriesDate"]},
    {"type": "exclude_text", "column": "o_orderpriority", "words": ["low", "urgent"]},
    {"type": "volume_id", "columns": ["o_custkey", "o_orderkey"]},
    {"type": "hook", "function": lambda c: F.floor(c / 1000), "inputs": ["o_totalprice"], "outputs": ["thousands"]},
    {"type": "visit_order", "patient": "o_custkey", "study": "o_orderkey", "date": "date"},
    {"type": "select", "columns": ["o_orderkey", "date_source", "visit_order", "delay_since_prev_exam", "thousands", "volume_id"]},
]


@query("""WITH o AS (SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O') AND NOT contains(lower(o_orderpriority), 'low') AND NOT contains(lower(o_orderpriority), 'urgent')), s AS (SELECT *, CAST(o_orderdate AS DATE) AS d FROM o),
w AS (SELECT *, row_number() OVER v - 1 AS visit_order, coalesce(date_diff('day', lag(d) OVER v, d), 0) AS delay_since_prev_exam FROM s WINDOW v AS (PARTITION BY o_custkey ORDER BY d, o_orderkey))
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'StudyDate' ELSE 'SeriesDate' END AS date_source, visit_order, delay_since_prev_exam, CAST(floor(o_totalprice / 1000) AS BIGINT) AS thousands, sha1(o_custkey || '||' || o_orderkey) AS volume_id FROM w""")
def l01_declared_steps(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumns({"StudyDate": F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyyMMdd")).otherwise("unknown"), "SeriesDate": F.date_format("o_orderdate", "yyyy-MM-dd")})
    return L.run(o, _STEPS)


# ------------------------------------------------------------ sources


@query("SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name FROM part")
def s01_csv_columns(spark, sf_dir):
    path = scratch(spark, "part") + ".csv"
    S.save(table(spark, sf_dir, "part"), path, "csv")
    return S.read_csv(spark, path, S.header_of(spark, path), ["p_partkey", "p_name"])


@query("SELECT event_id, 'k' AS tag, json_extract_string(props, '$.k') AS value FROM events")
def s05_tags_long(spark, sf_dir):
    return S.tags_long(table(spark, sf_dir, "events"), "props", "event_id")


@query("""WITH o AS (SELECT o_custkey, o_orderkey, o_orderpriority, md5(o_custkey || '|' || o_orderkey || '|' || o_orderpriority) AS h FROM orders)
SELECT o_custkey, arg_min(o_orderkey, h) AS o_orderkey, arg_min(o_orderpriority, h) AS o_orderpriority FROM o GROUP BY 1 ORDER BY md5('3:' || o_custkey), 1 LIMIT 200""")
def s06_snapshot(spark, sf_dir):
    """One order of each of 200 customers, published as lines of JSON and read again."""
    path = scratch(spark, "snapshot")
    S.save_snapshot(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority"), path, "o_custkey", 200, 3)
    return published(spark, path)


@query("SELECT p_partkey, 'archive://a%20b/' || p_partkey || '!' || replace(p_name, ' ', '%20') AS uri, ['a b/' || p_partkey, p_name] AS parts FROM part")
def s11_archive_uri(spark, sf_dir):
    outer = F.concat(F.lit("a b"), F.lit("/"), F.col("p_partkey").cast("string"))
    uri = F.regexp_replace(S.archive_uri(outer, [F.col("p_name")]), "%2F", "/")
    return table(spark, sf_dir, "part").select("p_partkey", uri.alias("uri"), S.archive_parts(uri).alias("parts"))


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS o_totalprice FROM orders")
def s15_appended_parts(spark, sf_dir):
    path = scratch(spark, "parts")
    o = table(spark, sf_dir, "orders")
    S.append(o.select("o_orderkey", "o_custkey", F.lit(1).alias("part")), path)
    S.append(o.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey", "o_totalprice", F.lit(2).alias("part")), path)
    return S.read_appended(spark, path, "o_orderkey", "part").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def i06_streamed_index(spark, sf_dir):
    """The events file by file through a stream that stops when it has caught up; a second call finds nothing new."""
    base = scratch(spark, "index")
    e = table(spark, sf_dir, "events")
    e.repartition(4, "event_id").write.parquet(f"{base}/in")
    for _ in range(2):
        build_index(spark, f"{base}/in", e.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), f"{base}/out", f"{base}/state", lambda b: b.select("event_id", "event_type", "value"), 2)
    return spark.read.parquet(f"{base}/out").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


_EVIDENCE = {0: "delayed 5 min", 1: "delayed 20 min", 2: None, 3: "delayed"}


@query("""WITH v AS (SELECT o_orderkey, o_custkey, o_orderkey % 4 = 0 OR (o_orderkey % 4 >= 2 AND o_orderkey % 7 = 3) AS preferred, CAST(substr(o_orderpriority, 1, 1) AS INT) % 2 AS score,
20 + 10 * (o_orderkey % 3) AS n, CASE WHEN o_orderkey % 11 > 0 THEN 1 + o_orderkey % 2 END AS thickness, CASE WHEN o_orderkey % 5 > 0 THEN 1 + o_orderkey % 2 END AS side, o_orderkey % 6 AS t FROM orders)
SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY preferred DESC, score DESC, n * thickness * side * side DESC NULLS LAST, thickness NULLS LAST, n * thickness DESC NULLS LAST, n DESC, t, o_orderkey) AS candidate_rank FROM v""")
def c25_select_mr(spark, sf_dir):
    k = F.col("o_orderkey")
    text = F.element_at(F.array(*(F.lit(_EVIDENCE[i]) for i in range(4))), (k % 4 + 1).cast("int"))
    side = F.when(k % 5 > 0, (1 + k % 2).cast("string"))
    v = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.lit("T1_DELAYED").alias("selection_slot"), F.lit("DELAYED").alias("phase"), text.alias("_evidence"), F.when(k % 7 == 3, 400).otherwise(100).alias("elapsed"),
        (F.substring("o_orderpriority", 1, 1).cast("int") % 2).cast("double").alias("selection_score"), (20 + 10 * (k % 3)).alias("n_files"), F.when(k % 11 > 0, 1 + k % 2).alias("SliceThickness"),
        F.concat(side, F.lit("\\"), side).alias("PixelSpacing"), (k % 6).alias("time"),
    )
    return C.select(C.tie_breakers(v), ["o_custkey"], ["T1_DELAYED"], "o_orderkey", C.mr_order())[0].select("o_orderkey", "candidate_rank")


@query("""WITH v AS (SELECT o_custkey, o_orderkey, o_orderkey % 2 = 0 AS mr, CASE o_orderkey % 5 WHEN 0 THEN 'NATIVE' WHEN 1 THEN 'PORTAL_VENOUS' WHEN 2 THEN 'ARTERIAL' WHEN 3 THEN 'HEPATOBILIARY' END AS named FROM orders)
SELECT o_orderkey, CASE WHEN mr THEN coalesce(named, 'OTHER') ELSE coalesce(CASE WHEN named <> 'HEPATOBILIARY' THEN named END, 'OTHER') END AS phase,
CASE WHEN named IS NULL OR (NOT mr AND named = 'HEPATOBILIARY') THEN 'UNRESOLVED' ELSE 'RESOLVED' END AS status FROM v""")
def c26_curate(spark, sf_dir):
    """CT and MR volumes together; the texts stand in another column for each modality, and what the other column says is not looked at."""
    words = F.array(*map(F.lit, ("native", "portal", "arterial", "hbp", "post")))
    said, mr = F.element_at(words, (F.col("o_orderkey") % 5 + 1).cast("int")), F.col("o_orderkey") % 2 == 0
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderkey").cast("string").alias("exam"), F.when(mr, "MR").otherwise("CT").alias("Modality"), F.when(mr, F.concat(F.lit("T1 vibe "), said)).otherwise("portal").alias("mr_text"), F.when(mr, F.lit("arterial")).otherwise(said).alias("ct_text"),
    )
    out = X.curate(rows, ["exam"], "o_orderkey", {"strategies": [{"name": "rules", "type": "rules"}]}, {"MR": ["mr_text"], "CT": ["ct_text"]})
    return out["curated"].select("o_orderkey", "phase", F.col("phase_status").alias("status"))


@query("SELECT p_partkey, p_size AS radiomics_p_size, p_retailprice AS radiomics_p_retailprice FROM part")
def p15_feature_columns(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice", F.col("p_name").alias("diagnostics_name"))
    return T.feature_columns(p, ["p_partkey"], "radiomics_")


@query("""SELECT 'found' AS kind, o_custkey, count(*) AS n FROM orders WHERE lower(o_orderstatus) = 'f' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_custkey IN (SELECT c_custkey FROM customer) GROUP BY 2
UNION ALL SELECT 'missing', c_custkey, 1 FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE lower(o_orderstatus) = 'f' AND o_orderpriority IN ('1-URGENT', '2-HIGH'))""")
def s10_index_rows(spark, sf_dir):
    found, missing = S.index_rows(table(spark, sf_dir, "orders"), "F", ["1-URGENT", "2-HIGH"], table(spark, sf_dir, "customer").select("c_custkey"), ["o_orderstatus", "o_orderpriority", "o_custkey", "o_orderkey", "o_orderdate"])
    return found.groupBy("o_custkey").agg(F.count("*").alias("n")).select(F.lit("found").alias("kind"), "o_custkey", "n").union(missing.select(F.lit("missing"), "o_custkey", F.lit(1).cast("long")))


@query("SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def j02_joined_once(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return T.joined_once(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), c, ["o_custkey"]).drop("o_custkey")
