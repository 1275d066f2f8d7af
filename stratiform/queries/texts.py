"""Text, clock, vector and phase functions over the driver's tables."""

from pyspark.sql import functions as F

from stratiform.functions import clock as D
from stratiform.functions import text as T
from stratiform.functions import vectors as V
from stratiform.operators import phases as P
from stratiform.operators.tables import interval_join
from stratiform.queries.base import query, r6, table

_ACC, _PLAIN = T.ACCENTED, T.PLAIN


@query(f"SELECT doc_id, translate(lower(trim(regexp_replace(rtrim(coalesce(text, ''), '.0'), '[ \\t\\n\\r\\f\\v]+', ' ', 'g'))), '{_ACC}', '{_PLAIN}') AS uniform FROM documents")
def t01_uniform_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.uniform(F.col("text")).alias("uniform"))


@query("SELECT p_partkey, nullif(regexp_replace(regexp_replace(upper(trim(p_name || '-' || p_brand)), '[^A-Z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), '') AS label, coalesce(nullif(upper(trim(CASE WHEN p_size < 10 THEN '' ELSE p_type END)), ''), 'OTHER') AS kind FROM part")
def t03_labels(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", T.label(F.concat_ws("-", "p_name", "p_brand")).alias("label"), T.label_or_other(F.when(F.col("p_size") < 10, "").otherwise(F.col("p_type"))).alias("kind"))


def _tok(words: str) -> str:
    return f"regexp_matches(lower(p_name), '(^|[^a-z0-9])({words})([^a-z0-9]|$)')"


@query(f"SELECT p_partkey, {_tok('ring|bolt')} AS hit FROM part")
def t05_whole_token(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").rlike(T.token("ring", "BOLT")).alias("hit"))


#: Series descriptions made from the parts table, with what they should mean.
_TEXTS = {
    0: "AX native", 1: "AX T1 portal venous", 2: "COR late arterial 3mm", 3: "sag delayed 5 min", 4: "delayed 30 s", 5: "pre and post contrast", 6: "inj 70 sec", 7: "t 1 min 31 sec", 8: "tardif 3:00", 9: "scout", 10: "DYN Ph 2",
    11: "axial 25s", 12: "w/o contrast", 13: "sub MIP", 14: "equilibrium 2h05", 15: "w and w/o", 16: "0,5 min", 17: "tra bh nav", 18: "", 19: "liver",
}
_MEANT = {0: "NATIVE", 1: "PORTAL_VENOUS", 2: "ARTERIAL", 3: "DELAYED", 4: "ARTERIAL", 5: None, 6: "PORTAL_VENOUS", 7: None, 8: "DELAYED", 9: None, 10: None, 11: "ARTERIAL", 12: "NATIVE", 13: None, 14: None, 15: None, 16: "ARTERIAL", 17: None, 18: None, 19: None}
_SECONDS = {3: [300.0], 4: [30.0], 6: [70.0], 7: [91.0], 8: [180.0], 11: [25.0], 14: [7500.0], 16: [30.0]}
_PLANES = {0: "AXIAL", 1: "AXIAL", 2: "COR", 3: "SAGITTAL", 11: "AXIAL", 17: "AXIAL"}
_PLANES[2] = "CORONAL"


def _case(values, kind: str) -> str:
    whens = " ".join(f"WHEN {k} THEN {v!r}" for k, v in values.items() if v is not None)
    return f"CASE p_partkey % 20 {whens} ELSE NULL::{kind} END"


def _texts(spark, sf_dir):
    text = F.element_at(F.array(*(F.lit(_TEXTS[i]) for i in range(20))), (F.col("p_partkey") % 20 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", text.alias("text"))


@query(f"SELECT p_partkey, {_case(_PLANES, 'VARCHAR')} AS plane FROM part")
def t07_plane(spark, sf_dir):
    return _texts(spark, sf_dir).select("p_partkey", T.plane(F.col("text")).alias("plane"))


@query(f"SELECT p_partkey, coalesce({_case(_SECONDS, 'DOUBLE[]')}, []) AS seconds FROM part")
def t08_durations(spark, sf_dir):
    return _texts(spark, sf_dir).select("p_partkey", D.durations(F.col("text")).alias("seconds"))


@query(f"SELECT p_partkey, {_case(_MEANT, 'VARCHAR')} AS phase FROM part")
def t09_phase_of_text(spark, sf_dir):
    return _texts(spark, sf_dir).select("p_partkey", P.phase_of(F.col("text")).alias("phase"))


@query("SELECT p_partkey, p_partkey % 20 IN (5, 15) AS mixed, p_partkey % 20 NOT IN (9, 13, 17, 18, 19) AS evidence FROM part")
def t12_mixed_and_evidence(spark, sf_dir):
    return _texts(spark, sf_dir).select("p_partkey", P.mixed(F.col("text")).alias("mixed"), P.phase_evidence(F.col("text")).alias("evidence"))


@query("""SELECT p_partkey, CASE WHEN contains(p_name, 'ring') THEN 'p_name' WHEN contains(p_type, 'A') THEN 'p_type' END AS source,
CASE WHEN contains(p_name, 'ring') THEN p_name WHEN contains(p_type, 'A') THEN p_type END AS found, p_name || ' | ' || p_type AS series_text FROM part""")
def t14_first_text(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    first = T.first_with({"p_name": F.col("p_name"), "p_type": F.col("p_type")}, lambda c: F.contains(c, F.lit("ring")) | ((c == F.col("p_type")) & F.contains(c, F.lit("A"))))
    return p.select("p_partkey", first["column"].alias("source"), first["text"].alias("found"), T.series_text([F.col("p_name"), F.lit(" "), F.col("p_type")]).alias("series_text"))


@query(f"SELECT p_partkey, {_case({10: 2}, 'INTEGER')} AS ordinal FROM part")
def t17_ordinal(spark, sf_dir):
    return _texts(spark, sf_dir).select("p_partkey", T.ordinal(F.col("text")).alias("ordinal"))


@query("SELECT p_partkey, list_filter(list_transform(string_split_regex(p_name || '\\\\' || p_type || ',' || p_brand, '[\\\\,;]+'), lambda x: regexp_replace(upper(trim(x)), '[ -]+', '_', 'g')), lambda x: x <> '') AS tokens FROM part")
def t19_image_type_tokens(spark, sf_dir):
    c = F.concat(F.col("p_name"), F.lit("\\"), F.col("p_type"), F.lit(","), F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", T.image_type_tokens(c).alias("tokens"))


@query("SELECT doc_id, CASE WHEN length(t) > 40 THEN substr(t, 1, 40) || '…' ELSE t END AS shown FROM (SELECT doc_id, replace(text, chr(10), ' ') AS t FROM documents)")
def t20_display(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.display(F.col("text")).alias("shown"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'liver' WHEN 1 THEN 'liver' WHEN 2 THEN 'liver_tumor' END AS mask, CASE p_partkey % 4 WHEN 0 THEN 'a/b' WHEN 1 THEN 'c' END AS member, CASE WHEN p_partkey % 2 = 0 THEN 'MR' ELSE 'CT' END AS modality FROM part""")
def t23_names(spark, sf_dir):
    k = F.col("p_partkey") % 4
    pick = lambda *v: F.element_at(F.array(*map(F.lit, v)), (k + 1).cast("int"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", T.mask_name(pick("mask_liver_path", "liver.nii.gz", "mask_liver_tumor", "a/b")).alias("mask"),
        T.safe_member(pick("a\\b", "./c", "/root", "x/../y")).alias("member"), T.modality(pick(" mri ", "ct", "MRI", "CT")).alias("modality"),
    )


@query("SELECT c_custkey, regexp_replace(regexp_extract(c_name, '[0-9]+'), '^0+([0-9])', '\\1') || '-' || c_nationkey AS key FROM customer")
def p05_digits_key(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", T.digits_key(F.concat_ws("/", "c_name", "c_nationkey")).alias("key"))


@query("SELECT page_id, nullif(string_split(url, '/')[3], '') AS host, CASE WHEN len(list_filter(string_split(url, '/'), lambda x: x <> '')) > 3 THEN list_filter(string_split(url, '/'), lambda x: x <> '')[4] END AS fourth FROM pages")
def p01_path_parts(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", T.path_part(F.col("url"), 1, 1).alias("host"), T.path_part(F.col("url"), 3, 3).alias("fourth"))


@query("SELECT c_custkey, coalesce(nullif(trim(CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE c_name END), ''), nullif(trim(CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END), ''), 'UNKNOWN') AS id FROM customer")
def p02_choose_id(spark, sf_dir):
    tag, path = F.when(F.col("c_custkey") % 3 == 0, " ").otherwise(F.col("c_name")), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select("c_custkey", T.first_text(tag, path, F.lit("UNKNOWN")).alias("id"))


_DATES = """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y%m%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN 'not a date' ELSE '20241350' END AS a, strftime(o_orderdate, '%Y%m%d') || '120000.5+0100' AS b FROM orders"""


def _dates(spark, sf_dir):
    d = F.col("o_orderdate")
    a = F.when(F.col("o_orderkey") % 4 == 0, F.date_format(d, "yyyyMMdd")).when(F.col("o_orderkey") % 4 == 1, F.date_format(d, "yyyy-MM-dd")).when(F.col("o_orderkey") % 4 == 2, "not a date").otherwise("20241350")
    return table(spark, sf_dir, "orders").select("o_orderkey", a.alias("a"), F.concat(F.date_format(d, "yyyyMMdd"), F.lit("120000.5+0100")).alias("b"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_orderkey % 4 < 2 THEN 'StudyDate' ELSE 'AcquisitionDateTime' END AS date_source FROM orders")
def d02_first_date(spark, sf_dir):
    day, source = D.first_of({"StudyDate": F.col("a"), "AcquisitionDateTime": F.col("b")}, D.date)
    return _dates(spark, sf_dir).select("o_orderkey", day.cast("string").alias("day"), source.alias("date_source"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 2 THEN 'b' ELSE 'a' END AS time_source, CASE event_id % 3 WHEN 2 THEN 43200.5 ELSE extract(hour FROM ts) * 3600.0 + extract(minute FROM ts) * 60 + floor(extract(second FROM ts)) END AS seconds FROM events")
def d04_first_clock(spark, sf_dir):
    t, k = F.col("ts"), F.col("event_id") % 3
    a = F.when(k == 0, F.date_format(t, "HHmmss")).when(k == 1, F.date_format(t, "HH:mm:ss")).otherwise("25:00:00")
    seconds, source = D.first_of({"a": a, "b": F.lit("120000.5")}, D.clock)
    return table(spark, sf_dir, "events").select("event_id", source.alias("time_source"), seconds.alias("seconds"))


@query("SELECT event_id, CASE event_id % 5 WHEN 0 THEN 34215.0 WHEN 1 THEN 32400.0 WHEN 2 THEN 34200.0 WHEN 3 THEN NULL ELSE 34260.0 END AS seconds FROM events")
def d05_short_clock(spark, sf_dir):
    c = F.element_at(F.array(*map(F.lit, ("93015", "09", "0930", "000000", "093060"))), (F.col("event_id") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", D.short_clock(c).alias("seconds"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp FROM events")
def d08_stamp(spark, sf_dir):
    s = D.stamp(D.date(F.date_format("ts", "yyyyMMdd")), D.clock(F.date_format("ts", "HHmmss")))
    return table(spark, sf_dir, "events").select("event_id", F.date_format(s, "yyyy-MM-dd HH:mm:ss").alias("stamp"))


_VEC = "v AS (SELECT vec_id, list_transform(embedding[1:6], lambda x: CAST(x AS DOUBLE)) AS o, list_transform(embedding[7:9], lambda x: CAST(x AS DOUBLE)) AS p FROM embeddings)"


def _vectors(spark, sf_dir):
    e = F.col("embedding").cast("array<double>")
    return table(spark, sf_dir, "embeddings").select("vec_id", F.slice(e, 1, 6).alias("o"), F.slice(e, 7, 3).alias("p"))


@query(f"WITH {_VEC}, n AS (SELECT vec_id, o, sqrt(o[1]**2 + o[2]**2 + o[3]**2) AS a, sqrt(o[4]**2 + o[5]**2 + o[6]**2) AS b FROM v) SELECT vec_id, [round_even(o[1] / a, 3), round_even(o[2] / a, 3), round_even(o[3] / a, 3), round_even(o[4] / b, 3), round_even(o[5] / b, 3), round_even(o[6] / b, 3)] AS iop FROM n")
def g01_standardised(spark, sf_dir):
    return _vectors(spark, sf_dir).select("vec_id", V.standardised(F.col("o")).alias("iop"))


_NORMAL = f"{_VEC}, c AS (SELECT vec_id, p, o[2] * o[6] - o[3] * o[5] AS x, o[3] * o[4] - o[1] * o[6] AS y, o[1] * o[5] - o[2] * o[4] AS z FROM v), n AS (SELECT vec_id, p, x / sqrt(x*x + y*y + z*z) AS x, y / sqrt(x*x + y*y + z*z) AS y, z / sqrt(x*x + y*y + z*z) AS z FROM c)"


@query(f"WITH {_NORMAL}, m AS (SELECT vec_id, greatest(abs(x), abs(y), abs(z)) AS top, abs(x) AS x, abs(y) AS y FROM n), a AS (SELECT vec_id, degrees(acos(least(1.0, top))) AS angle, CASE top WHEN x THEN 1 WHEN y THEN 2 ELSE 3 END AS k FROM m) SELECT vec_id, round(angle, 6) AS angle, ['X', 'Y', 'Z'][k] AS axis, CASE WHEN angle > 25 AND abs(angle - 25) > 1e-6 + 1e-5 * 25 THEN 'OBL' ELSE ['SAG', 'COR', 'AX'][k] END AS plane FROM a")
def g03_plane(spark, sf_dir):
    p = V.plane(F.col("o"), 25.0)
    return _vectors(spark, sf_dir).select("vec_id", r6(p["angle"]).alias("angle"), p["axis"].alias("axis"), p["plane"].alias("plane"))


@query(f"WITH {_NORMAL} SELECT vec_id, round(p[1] * x + p[2] * y + p[3] * z, 6) AS coordinate, CAST(round_even((p[1] * x + p[2] * y + p[3] * z) / 0.01, 0) AS BIGINT) AS key FROM n")
def g04_coordinate(spark, sf_dir):
    c = V.coordinate(F.col("p"), F.col("o"), F.lit(0.0))
    return _vectors(spark, sf_dir).select("vec_id", r6(c).alias("coordinate"), V.slice_key(c, 0.01).alias("key"))


@query("SELECT o_orderkey, [CAST(o_custkey AS DOUBLE), o_totalprice] AS v, NULL::DOUBLE[] AS short FROM orders")
def v01_parse_vector(spark, sf_dir):
    s = F.concat(F.lit("["), F.col("o_custkey").cast("string"), F.lit("\\"), F.format_string("%.2f", "o_totalprice"), F.lit("]"))
    return table(spark, sf_dir, "orders").select("o_orderkey", V.parsed(s, 2).alias("v"), V.parsed(s, 3).alias("short"))


_CHAIN = {
    "unresolved_labels": ["OTHER"],
    "strategies": [
        {"name": "by_hand", "type": "explicit", "confidence": "high", "assignments": [{"phase": "NATIVE", "rules": [{"column": "o_totalprice", "op": "lt", "value": 50000}]}, {"phase": "ARTERIAL", "logic": "and", "rules": [{"column": "o_totalprice", "op": "gt", "value": 450000}, {"column": "o_orderstatus", "op": "eq", "value": "F"}]}]},
        {"name": "codes", "type": "ontology", "confidence": "medium", "columns": ["parts"], "mapping": {"urgent": "PORTAL_VENOUS", "low": "OTHER"}},
        {"name": "texts", "type": "rules"},
        {"name": "model", "type": "prediction", "column": "guess", "mapping": {"p": "DELAYED"}, "modalities": ["MR"], "confidence_columns": ["c1", "c2"]},
    ],
}
_PHASES = """p AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_totalprice < 50000 OR (o_totalprice > 450000 AND o_orderstatus = 'F') THEN 'by_hand' WHEN o_orderpriority = '1-URGENT' THEN 'codes'
  WHEN o_orderkey % 3 = 0 THEN 'texts' WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'model' ELSE 'unresolved' END AS src, o_totalprice, o_orderstatus FROM orders)"""


def _chain(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", F.split("o_orderpriority", "-").alias("parts"), F.when(k % 11 == 0, "localizer").when(k % 13 == 0, "derived").alias("phase_applicability_reason"),
        F.when(k % 3 == 0, "hepatic late").otherwise("other").alias("rule_phase"), F.lit("sure").alias("rule_phase_confidence"), F.lit("why").alias("rule_phase_reason"),
        F.col("o_orderstatus").alias("guess"), F.when(k % 2 == 0, "MRI").otherwise("CT").alias("Modality"), F.lit("").alias("c1"), F.lit("0.9").alias("c2"),
    )


@query(f"""WITH {_PHASES} SELECT o_orderkey, CASE src WHEN 'by_hand' THEN CASE WHEN o_totalprice < 50000 THEN 'NATIVE' ELSE 'ARTERIAL' END WHEN 'codes' THEN 'PORTAL_VENOUS' WHEN 'texts' THEN 'HEPATIC_LATE' WHEN 'model' THEN 'DELAYED' WHEN 'unresolved' THEN 'OTHER' END AS phase,
CASE WHEN src IS NULL THEN 'NOT_APPLICABLE' WHEN src = 'unresolved' THEN 'UNRESOLVED' ELSE 'RESOLVED' END AS phase_status, coalesce(src, 'not_applicable') AS phase_source,
CASE src WHEN 'by_hand' THEN 'high' WHEN 'codes' THEN 'medium' WHEN 'texts' THEN 'sure' WHEN 'model' THEN '0.9' END AS phase_confidence, CASE WHEN src = 'by_hand' THEN 1000 ELSE 0 END AS bonus FROM p""")
def r05_resolve_chain(spark, sf_dir):
    out = P.resolve(_chain(spark, sf_dir), _CHAIN)
    return out.select("o_orderkey", "phase", "phase_status", "phase_source", "phase_confidence", P.selection_bonus(out).alias("bonus"))


@query(f"WITH {_PHASES} SELECT o_orderkey FROM p WHERE src IN ('model', 'unresolved')")
def r06_needs_strategy(spark, sf_dir):
    return P.needs(_chain(spark, sf_dir), _CHAIN, "prediction").select("o_orderkey")


@query("""WITH w AS (SELECT * FROM (VALUES ('PORTAL_VENOUS', 60, 90), ('ARTERIAL', 20, 35), ('DELAYED', 180, 900), ('LATE', 600, 1200), ('EDGE', 90, 90)) t(phase, low, high)), o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 90 WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice / 200 END AS s FROM orders)
SELECT o_orderkey, CASE WHEN count(phase) = 1 THEN min(phase) END AS phase FROM o LEFT JOIN w ON s BETWEEN low AND high GROUP BY 1""")
def j13_interval_join(spark, sf_dir):
    """A table of windows that overlap and touch; a row in no or several windows has none."""
    windows = spark.createDataFrame([*((n, float(a), float(b)) for n, (a, b) in P.WINDOWS.items()), ("LATE", 600.0, 1200.0), ("EDGE", 90.0, 90.0)], "phase string, low double, high double")
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 9 == 0, 90.0).when(k % 11 == 0, None).otherwise(F.col("o_totalprice") / 200).alias("s"))
    return interval_join(o, "s", windows, "phase").select("o_orderkey", "phase")
