"""Functions of series texts, curation features and phase strategies over descriptions composed from the parts table.

The SQL evaluates the vocabulary with the other engine's regular expressions: a whole term is one between characters that are neither letters nor digits.
"""

from pyspark.sql import functions as F

from stratiform.functions import clock as D
from stratiform.functions import text as T
from stratiform.functions import vectors as V
from stratiform.operators import curation as C
from stratiform.operators import imaging as I
from stratiform.operators import phases as P
from stratiform.queries.base import query, r6, table

# parts of different, coprime numbers: 1,144 descriptions, with one of three separators
_FIRST = ["AX", "cor", "tra", "sagittal", "3D", "axial", "Liver", "scout", "localizer", "", "COR"]
_MIDDLE = ["native", "T1 vibe", "t2 haste", "T2_tse", "DWI", "key images", "post iv", "portal", "arterial late", "delayed", "w/o contrast", "sub", "mip"]
_LAST = ["", "BH", "nav", "fs", "map", "dyn", "w", "smart prep"]
_SEPARATORS = [" ", "_", "-"]


def _sql_item(values, by: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][1 + {by} % {len(values)}]"


def _item(values, by: str):
    return F.element_at(F.array(*map(F.lit, values)), (F.col(by) % len(values) + 1).cast("int"))


_SEP = _sql_item(_SEPARATORS, "p_size")
SERIES = f"""series AS (SELECT *, {_sql_item(_FIRST, "p_partkey")} || {_SEP} || {_sql_item(_MIDDLE, "p_partkey")} || {_SEP} || {_sql_item(_LAST, "p_partkey")} AS t,
  CASE p_size % 4 WHEN 0 THEN 'ORIGINAL\\PRIMARY\\AXIAL' WHEN 1 THEN 'DERIVED\\SECONDARY\\W' WHEN 2 THEN 'ORIGINAL\\PRIMARY\\IP\\OP' END AS image_type FROM part)"""


def series(spark, sf_dir):
    sep = _item(_SEPARATORS, "p_size")
    text = F.concat(_item(_FIRST, "p_partkey"), sep, _item(_MIDDLE, "p_partkey"), sep, _item(_LAST, "p_partkey"))
    kind = F.when(F.col("p_size") % 4 == 0, "ORIGINAL\\PRIMARY\\AXIAL").when(F.col("p_size") % 4 == 1, "DERIVED\\SECONDARY\\W").when(F.col("p_size") % 4 == 2, "ORIGINAL\\PRIMARY\\IP\\OP")
    return table(spark, sf_dir, "part").withColumns({"t": text, "image_type": kind})


_EDGE = r"[^\p{L}\p{N}]"


def _term(pattern: str, text: str = "t") -> str:
    """SQL: whether a text has a whole term."""
    return f"coalesce(regexp_matches({text}, '(?i)(?:^|{_EDGE})(?:{pattern})(?:$|{_EDGE})'), false)"


def _has(name: str, text: str = "t") -> str:
    return _term(T.VOCABULARY[name], text)


_PLANE = f"CASE WHEN {_has('axial')} THEN 'AXIAL' WHEN {_has('coronal')} THEN 'CORONAL' WHEN {_has('sagittal')} THEN 'SAGITTAL' END"


def _post(text: str = "t") -> str:
    return _has("post_contrast", rf"regexp_replace({text}, '([_-])w($|[\s_.-])', '\1 \2', 'gi')")


_REST = f"regexp_replace(t, '(^|{_EDGE})(?:{T.VOCABULARY['native']})($|{_EDGE})', '\\1 \\2', 'gi')"
#: No description has a duration, or both words of a pair (pre and post, with and without) beside each other.
_MIXED = f"({_has('native')} AND {_post(_REST)})"
_PHASE = f"CASE WHEN {_has('native')} AND NOT {_MIXED} THEN 'NATIVE' WHEN {_has('portal')} THEN 'PORTAL_VENOUS' WHEN {_has('arterial')} THEN 'ARTERIAL' WHEN {_has('delayed')} THEN 'DELAYED' END"
_EVIDENCE = "(" + " OR ".join([_post(), *(_has(n) for n in ("native", "portal", "arterial", "delayed", "dynamic"))]) + ")"
_CLASSES = ["localizer", "key_images", "subtraction", "mip_mpr", "quantitative", "axial", "coronal", "sagittal", "breath_hold", "respiratory", "dynamic", "bolus_monitoring", "derived"]

# ------------------------------------------------------------ texts


@query(r"SELECT page_id, lower(trim(regexp_replace(coalesce(html, ''), '[ \t\n\r\f\v]+', ' ', 'g'))) AS clean FROM pages")
def t02_clean_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.clean(F.col("html")).alias("clean"))


@query(f"WITH {SERIES} SELECT p_partkey, {', '.join(f'{_has(n)} AS {n}' for n in _CLASSES)} FROM series")
def t06_vocabulary(spark, sf_dir):
    return series(spark, sf_dir).select("p_partkey", *(T.has(F.col("t"), n).alias(n) for n in _CLASSES))


@query(f"WITH {SERIES} SELECT p_partkey, {_PLANE} AS plane FROM series")
def t07_plane_of_series(spark, sf_dir):
    return series(spark, sf_dir).select("p_partkey", T.plane(F.col("t")).alias("plane"))


@query(f"WITH {SERIES} SELECT p_partkey, {_PHASE} AS phase FROM series")
def t09_phase_of_series(spark, sf_dir):
    return series(spark, sf_dir).select("p_partkey", P.phase_of(F.col("t")).alias("phase"))


#: Pieces of texts with the phase that each names, and its delay in seconds; four of them make a text, with `then` between.
_PIECES = [
    ("portal", "PORTAL_VENOUS", None), ("late arterial", "ARTERIAL", None), ("late", "DELAYED", None), ("x", None, None), ("arterial", "ARTERIAL", None), ("native", "NATIVE", None), ("70 s", None, 70), ("delayed 5 min", "DELAYED", 300),
    ("delayed 20 min", None, 1200), ("porto venous", "PORTAL_VENOUS", None), ("early_arterial", "ARTERIAL", None), ("80 sec", None, 80), ("plate", None, None), ("équilibre", "DELAYED", None), ("25s", None, 25),
]
_STEPS = (1, 7, 49, 343)
_PICKED = "(p_partkey // {0} + p_partkey) % 15"
_NO_NAMES = """CASE WHEN len(list_filter(secs, lambda s: s IS NULL OR NOT (s BETWEEN 60 AND 90 OR s BETWEEN 20 AND 35 OR s BETWEEN 180 AND 900))) > 0 THEN [] ELSE list_distinct(list_transform(secs, lambda s: CASE WHEN s BETWEEN 60 AND 90 THEN 'PORTAL_VENOUS' WHEN s BETWEEN 20 AND 35 THEN 'ARTERIAL' ELSE 'DELAYED' END)) END"""


@query(f"""WITH w AS (SELECT * FROM (VALUES {", ".join(f"({i}, {repr(l) if l else 'NULL'}, {s or 'NULL'})" for i, (_, l, s) in enumerate(_PIECES))}) t(i, label, sec)),
p AS (SELECT p_partkey, k, label, sec FROM part, (VALUES {", ".join(f"({k}, {k})" for k in _STEPS)}) s(k, k2) JOIN w ON w.i = (p_partkey // k + p_partkey) % 15),
g AS (SELECT p_partkey, list(label ORDER BY k) AS labels, list(sec ORDER BY k) FILTER (WHERE sec IS NOT NULL) AS secs FROM p GROUP BY 1),
n AS (SELECT p_partkey, list_filter(labels, lambda l, i: l IS NOT NULL AND list_position(labels, l) = i) AS named, coalesce(secs, []) AS secs FROM g), t AS (SELECT p_partkey, named, {_NO_NAMES} AS timed FROM n)
SELECT p_partkey, CASE WHEN len(named) > 0 THEN named WHEN len(timed) = 1 THEN timed ELSE [] END AS phases FROM t""")
def t10_phases_in_order(spark, sf_dir):
    """All mentions of phases: repeated ones, ones inside longer ones, delayed ones whose delay doesn't fit, texts with delays only."""
    pieces = F.array(*(F.lit(t) for t, _, _ in _PIECES))
    text = F.concat_ws(" then ", *(F.element_at(pieces, ((F.floor(F.col("p_partkey") / k) + F.col("p_partkey")) % 15 + 1).cast("int")) for k in _STEPS))
    return table(spark, sf_dir, "part").select("p_partkey", P.phases_in_order(text).alias("phases"))


_DELAYS = [("", []), ("20 min", [1200]), ("2h", [7200]), ("5 min", [300]), ("70 sec", [70]), ("25s", [25]), ("2h30", [9000]), ("40 min", [2400]), ("20 min 5 min", [1200, 300]), ("70 s 75 s", [70, 75]), ("3h", [10800])]
_NAMED = [("", None), ("hbp", "HEPATOBILIARY"), ("hepato-biliary", "HEPATOBILIARY"), ("bili", "HEPATOBILIARY"), ("mask", "NATIVE"), ("pre gado", "NATIVE"), ("delayed", "DELAYED"), ("portal", "PORTAL_VENOUS"), ("late hepatobiliaire", "HEPATOBILIARY"), ("tardif", "DELAYED"), ("arterial", "ARTERIAL"), ("gd", None), ("sans injection", "NATIVE")]
_MR_WINDOW = "CASE WHEN s BETWEEN 60 AND 90 THEN 'PORTAL_VENOUS' WHEN s BETWEEN 20 AND 35 THEN 'ARTERIAL' WHEN s BETWEEN 180 AND 900 THEN 'DELAYED' WHEN s = 1200 OR s BETWEEN 7200 AND 10799 THEN 'HEPATOBILIARY' ELSE '' END"


@query(f"""WITH n AS (SELECT * FROM (VALUES {", ".join(f"({i}, {repr(l) if l else 'NULL'})" for i, (_, l) in enumerate(_NAMED))}) t(i, named)), d AS (SELECT * FROM (VALUES {", ".join(f"({i}, {s}::INT[])" for i, (_, s) in enumerate(_DELAYS))}) t(i, secs)),
x AS (SELECT p_partkey, named, list_distinct(list_transform(secs, lambda s: {_MR_WINDOW})) AS fits FROM part JOIN n ON n.i = p_partkey % 13 JOIN d ON d.i = p_partkey % 11), t AS (SELECT p_partkey, named, CASE WHEN len(fits) = 1 THEN nullif(fits[1], '') END AS timed FROM x)
SELECT p_partkey, CASE WHEN named = 'DELAYED' AND timed = 'HEPATOBILIARY' THEN timed ELSE coalesce(named, timed, 'OTHER') END AS phase FROM t""")
def c12_hepatobiliary(spark, sf_dir):
    """T1 volumes by name and delay: a delayed name with a hepatobiliary delay, delays that fit two phases, native by mask and agent."""
    df = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", F.lit("T1 vibe"), _item([t for t, _ in _NAMED], "p_partkey"), _item([t for t, _ in _DELAYS], "p_partkey")).alias("SeriesDescription"), F.lit("MR").alias("Modality"))
    return C.annotate_mr(df).select("p_partkey", F.col("rule_phase").alias("phase"))


@query(f"WITH {SERIES} SELECT p_partkey, {_post()} AS post FROM series")
def t11_post_contrast(spark, sf_dir):
    return series(spark, sf_dir).select("p_partkey", P.post_contrast(F.col("t")).alias("post"))


@query(f"WITH {SERIES} SELECT p_partkey, {_MIXED} AS mixed FROM series")
def t12_mixed_series(spark, sf_dir):
    return series(spark, sf_dir).select("p_partkey", P.mixed(F.col("t")).alias("mixed"))


@query(f"WITH {SERIES} SELECT p_partkey, {_EVIDENCE} AS evidence FROM series")
def t13_phase_evidence(spark, sf_dir):
    return series(spark, sf_dir).select("p_partkey", P.phase_evidence(F.col("t")).alias("evidence"))


@query(f"WITH {SERIES} SELECT p_partkey, concat_ws(' | ', nullif(trim(t), ''), nullif(trim(image_type), ''), nullif(trim(CASE WHEN p_size > 25 THEN ' ' ELSE p_brand END), '')) AS text FROM series")
def t16_series_text(spark, sf_dir):
    parts = [F.col("t"), F.col("image_type"), F.when(F.col("p_size") > 25, " ").otherwise(F.col("p_brand"))]
    return series(spark, sf_dir).select("p_partkey", T.series_text(parts).alias("text"))


_SCANNERS = ["MRI", " mri", "MR", "ct ", "CT", "pt"]


@query(f"WITH m AS (SELECT o_orderkey, {_sql_item(_SCANNERS, 'o_orderkey')} AS m FROM orders) SELECT o_orderkey, CASE upper(trim(m)) WHEN 'MRI' THEN 'MR' ELSE upper(trim(m)) END AS modality FROM m")
def t21_modality(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", T.modality(_item(_SCANNERS, "o_orderkey")).alias("modality"))


_STARTS = ["", "./", "/", "C:", "../", "a/../", "a\\b\\", "././x/"]


@query(rf"""WITH m AS (SELECT page_id, {_sql_item(_STARTS, "page_id")} || split_part(url, '://', 2) AS m FROM pages), f AS (SELECT page_id, regexp_replace(replace(m, '\', '/'), '^(\./)+', '') AS f FROM m)
SELECT page_id, CASE WHEN f <> '' AND f NOT LIKE '/%' AND NOT regexp_matches(f, '^[A-Za-z]:') AND NOT list_contains(string_split(f, '/'), '..') THEN f END AS member FROM f""")
def t24_safe_member(spark, sf_dir):
    name = F.concat(_item(_STARTS, "page_id"), F.split_part("url", F.lit("://"), F.lit(2)))
    return table(spark, sf_dir, "pages").select("page_id", T.safe_member(name).alias("member"))


# ------------------------------------------------------------ dates, clocks, vectors

_STAMPS = """stamps AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN strftime(ts, '%Y%m%d') WHEN 1 THEN strftime(ts, '%Y%m%d%H%M%S') WHEN 2 THEN strftime(ts, '%Y-%m-%d') WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN 4 THEN strftime(ts, '%d/%m/%Y') ELSE '20231345' END AS s, ts FROM events)"""


def _stamps(spark, sf_dir):
    forms = ["yyyyMMdd", "yyyyMMddHHmmss", "yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss", "dd/MM/yyyy"]
    s = F.lit("20231345")
    for i, form in enumerate(forms):
        s = F.when(F.col("event_id") % 6 == i, F.date_format("ts", form)).otherwise(s)
    return table(spark, sf_dir, "events").select("event_id", s.alias("s"), "ts")


@query(f"WITH {_STAMPS} SELECT event_id, CASE WHEN event_id % 6 < 4 THEN CAST(CAST(ts AS DATE) AS VARCHAR) END AS day FROM stamps")
def d01_parse_date(spark, sf_dir):
    return _stamps(spark, sf_dir).select("event_id", D.date(F.col("s")).cast("string").alias("day"))


_CLOCKS = ["HH:mm:ss", "HHmmss", "yyyy-MM-dd HH:mm:ss", "yyyyMMddHHmmss", "HH:mm"]


@query("SELECT event_id, CASE WHEN event_id % 5 < 4 THEN CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS DOUBLE) END AS seconds FROM events")
def d03_parse_clock(spark, sf_dir):
    s = F.lit(None).cast("string")
    for i, form in enumerate(_CLOCKS):
        s = F.when(F.col("event_id") % 5 == i, F.date_format("ts", form)).otherwise(s)
    return table(spark, sf_dir, "events").select("event_id", D.clock(s).alias("seconds"))


@query("SELECT event_id, CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS DOUBLE) + CAST(strftime(ts, '0.%f') AS DOUBLE) AS seconds FROM events")
def d07_seconds_of_day(spark, sf_dir):
    out = table(spark, sf_dir, "events").select("event_id", D.clock(F.date_format("ts", "HH:mm:ss.SSSSSS")).alias("seconds"))
    return out.withColumn("seconds", r6(F.col("seconds")))


_SIX = "six AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS DOUBLE) AS a, CAST(l_linenumber AS DOUBLE) AS b, l_discount * 10 AS c, l_tax * 10 AS d, CAST(l_linenumber % 3 AS DOUBLE) AS e, 1.0::DOUBLE AS f FROM lineitem)"


@query(f"""WITH {_SIX}, n AS (SELECT *, b * f - c * e AS x, c * d - a * f AS y, a * e - b * d AS z FROM six), s AS (SELECT *, sqrt(x * x + y * y + z * z) AS size FROM n)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN size > 0 THEN round(x / size, 6) END AS x, CASE WHEN size > 0 THEN round(y / size, 6) END AS y, CASE WHEN size > 0 THEN round(z / size, 6) END AS z FROM s""")
def g02_normal(spark, sf_dir):
    six = F.array(F.col("l_quantity").cast("double"), F.col("l_linenumber").cast("double"), F.col("l_discount") * 10, F.col("l_tax") * 10, (F.col("l_linenumber") % 3).cast("double"), F.lit(1.0))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    out = table(spark, sf_dir, "lineitem").select(*keys, V.normal(six).alias("n"))
    return out.select(*keys, *(r6(V.part(F.col("n"), i)).alias(c) for i, c in enumerate("xyz", 1)))


@query("SELECT o_orderkey, CAST(round_even(o_totalprice / 0.5, 0) AS BIGINT) AS slice FROM orders")
def g05_slice_key(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", V.slice_key(F.col("o_totalprice"), 0.5).alias("slice"))


# ------------------------------------------------------------ CT features

_CT = f"""ct AS (SELECT *, CASE WHEN p_size > 20 THEN 512 ELSE 256 END AS h, p_size * 4 AS n, p_size % 9 AS thick, {_has("localizer")} AS loc, {_has("bolus_monitoring")} AS bolus, {_has("derived")} AS low, {_PLANE} AS plane, {_PHASE} AS named,
  {_has("original", "image_type")} AND {_has("primary", "image_type")} AS orig, p_size > 20 AS square FROM series), features AS (SELECT *, plane = 'AXIAL' OR (plane IS NULL AND square) AS ax,
  CASE WHEN loc THEN 'LOCALIZER' WHEN bolus THEN 'BOLUS_MONITORING' END AS reason FROM ct), done AS (SELECT *, CASE WHEN reason IS NOT NULL THEN 'OTHER' ELSE coalesce(named, 'OTHER') END AS phase FROM features)"""


def _ct(spark, sf_dir):
    df = series(spark, sf_dir).select("p_partkey", F.col("t").alias("SeriesDescription"), F.col("image_type").alias("ImageType"), F.when(F.col("p_size") > 20, 512).otherwise(256).alias("Rows"), F.lit(512).alias("Columns"), (F.col("p_size") * 4).alias("n_files"), (F.col("p_size") % 9).alias("SliceThickness"))
    return C.annotate_ct(df)


@query(f"WITH {SERIES}, {_CT} SELECT p_partkey, loc AS is_localizer, coalesce(ax, false) AS is_axial, orig AS is_original, low AS is_derived_low_value, reason FROM done")
def c04_ct_features(spark, sf_dir):
    return _ct(spark, sf_dir).select("p_partkey", "is_localizer", "is_axial", "is_original", "is_derived_low_value", F.col("phase_applicability_reason").alias("reason"))


@query(f"WITH {SERIES}, {_CT} SELECT reason, count(*) AS n FROM done GROUP BY 1")
def c05_ct_applicability(spark, sf_dir):
    return _ct(spark, sf_dir).groupBy(F.col("phase_applicability_reason").alias("reason")).agg(F.count("*").alias("n"))


@query(f"WITH {SERIES}, {_CT} SELECT p_partkey, phase, CASE WHEN reason IS NOT NULL THEN 'not_applicable' WHEN named IS NULL THEN 'low' ELSE 'high' END AS confidence FROM done")
def c06_ct_phase(spark, sf_dir):
    return _ct(spark, sf_dir).select("p_partkey", F.col("rule_phase").alias("phase"), F.col("rule_phase_confidence").alias("confidence"))


@query(f"""WITH {SERIES}, {_CT} SELECT p_partkey, CAST(CASE phase WHEN 'PORTAL_VENOUS' THEN 110 WHEN 'ARTERIAL' THEN 105 WHEN 'DELAYED' THEN 95 WHEN 'NATIVE' THEN 80 ELSE 0 END + CASE WHEN ax THEN 40 ELSE 0 END + CASE WHEN orig THEN 30 ELSE 0 END + CASE WHEN square THEN 20 ELSE -10 END
 + CASE WHEN n >= 80 THEN 20 WHEN n < 20 THEN -50 ELSE 0 END + CASE WHEN thick <= 3 THEN 10 WHEN thick > 7 THEN -10 ELSE 0 END - CASE WHEN loc THEN 500 ELSE 0 END - CASE WHEN low THEN 200 ELSE 0 END AS DOUBLE) AS score FROM done""")
def c07_ct_score(spark, sf_dir):
    return _ct(spark, sf_dir).select("p_partkey", C.score_ct(_ct(spark, sf_dir), "rule_phase").alias("score"))


# ------------------------------------------------------------ MR features

_SEQ = f"""CASE WHEN {_has("localizer")} THEN 'LOCALIZER' WHEN kind = 'KO' OR {_has("key_images")} THEN 'KEY_IMAGES' {" ".join(f"WHEN {_term(p)} THEN '{n}'" for n, p in C.SEQUENCES.items())} END"""
_MR = f"""mr AS (SELECT *, CASE WHEN p_size = 50 THEN 'KO' ELSE 'MR' END AS kind, p_size * 50 AS tr, p_size * 2 AS te FROM series), named AS (SELECT *, {_SEQ} AS by_text, CASE WHEN tr < 800 AND te < 35 THEN 'T1' WHEN tr > 1500 AND te > 60 THEN 'T2' END AS by_time,
  CASE WHEN {_term(C._T2_SINGLE)} THEN 'single_shot' WHEN {_term(C._T2_MULTI)} THEN 'multi_shot' END AS family, {_PLANE} AS plane, {_PHASE} AS named FROM mr), found AS (SELECT *, coalesce(by_text, by_time, 'OTHER') AS seq FROM named)"""


def _mr(spark, sf_dir):
    df = series(spark, sf_dir).select("p_partkey", "p_size", F.col("t").alias("SeriesDescription"), F.col("image_type").alias("ImageType"), F.when(F.col("p_size") == 50, "KO").otherwise("MR").alias("Modality"), (F.col("p_size") * 50).alias("RepetitionTime"), (F.col("p_size") * 2).alias("EchoTime"))
    return C.annotate_mr(df)


@query(f"WITH {SERIES}, {_MR} SELECT p_partkey, seq AS sequence, CASE WHEN by_text IS NOT NULL THEN 'high' WHEN by_time IS NOT NULL THEN 'medium' ELSE 'low' END AS confidence FROM found")
def c10_mr_sequence(spark, sf_dir):
    return _mr(spark, sf_dir).select("p_partkey", F.col("mri_sequence").alias("sequence"), F.col("mri_sequence_confidence").alias("confidence"))


@query(f"WITH {SERIES}, {_MR} SELECT p_partkey, CASE WHEN seq = 'T2' THEN family END AS family FROM found")
def c11_t2_family(spark, sf_dir):
    return _mr(spark, sf_dir).select("p_partkey", F.col("mri_t2_acquisition_family").alias("family"))


@query(f"WITH {SERIES}, {_MR} SELECT p_partkey, CASE WHEN seq = 'T1' THEN coalesce(named, 'OTHER') ELSE 'OTHER' END AS phase, CASE WHEN seq = 'T1' AND named IS NOT NULL THEN 'explicit_text' ELSE 'none' END AS source FROM found")
def c12_t1_phase(spark, sf_dir):
    return _mr(spark, sf_dir).select("p_partkey", F.col("rule_phase").alias("phase"), F.col("mri_perfusion_source").alias("source"))


@query(f"WITH {SERIES}, {_MR} SELECT p_partkey, CASE WHEN seq = 'LOCALIZER' THEN 'LOCALIZER' WHEN seq <> 'T1' THEN 'NON_T1' END AS reason FROM found")
def c13_mr_applicability(spark, sf_dir):
    return _mr(spark, sf_dir).select("p_partkey", F.col("phase_applicability_reason").alias("reason"))


_BY_NAME = r"regexp_matches(t, '(?i)[_ -](w|water)(?:$|[\s_.-])')"


@query(f"WITH {SERIES}, d AS (SELECT p_partkey, CASE WHEN {_BY_NAME} THEN 'WATER' END AS x, CASE p_size % 4 WHEN 1 THEN 'WATER' WHEN 2 THEN 'UNKNOWN' END AS y FROM series) SELECT p_partkey, CASE WHEN x IS NULL THEN y WHEN y IS NULL OR x = y THEN x ELSE 'UNKNOWN' END AS component FROM d")
def c20_dixon(spark, sf_dir):
    return _mr(spark, sf_dir).select("p_partkey", F.col("dixon_component").alias("component"))


@query(f"WITH {SERIES} SELECT p_partkey, {_has('subtraction')} AS is_subtraction, {_has('mip_mpr')} AS is_mip_mpr, {_term(C._QUANT)} AS is_quant_or_report FROM series")
def c21_product_flags(spark, sf_dir):
    return _mr(spark, sf_dir).select("p_partkey", "is_subtraction", "is_mip_mpr", "is_quant_or_report")


@query(f"WITH {SERIES} SELECT p_partkey, {_PLANE} AS plane, {_term(C._T1_GRE)} AS is_3d_gre, {_has('dynamic')} AS is_dynamic_t1_text, {_has('breath_hold')} AS is_breath_hold, {_has('respiratory')} AS is_resp_triggered, {', '.join(f'{_term(p)} AS {n}' for n, p in C.T2_FEATURES.items())} FROM series")
def c22_feature_flags(spark, sf_dir):
    return _mr(spark, sf_dir).select("p_partkey", "plane", "is_3d_gre", "is_dynamic_t1_text", "is_breath_hold", "is_resp_triggered", *C.T2_FEATURES)


@query("""SELECT p_partkey, p_size AS rows_in_volume, CAST(p_size % 5 AS DOUBLE) AS slice_thickness, CAST(p_size * (p_size % 5) AS DOUBLE) AS z_coverage, CASE WHEN p_size % 3 > 0 THEN CAST(p_size * (p_size % 5) * 0.5 * (p_size % 3) AS DOUBLE) END AS volume_mm3,
p_type = 'ECONOMY' AND p_size * 30 BETWEEN 300 AND 600 AS delay_preferred FROM part""")
def c24_tie_breakers(spark, sf_dir):
    x = F.when(F.col("p_size") % 3 > 0, F.format_string("[0.5, %d]", F.col("p_size") % 3))
    df = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("n_files"), (F.col("p_size") % 5).alias("SliceThickness"), x.alias("PixelSpacing"), F.when(F.col("p_type") == "ECONOMY", "DELAYED").otherwise("PORTAL_VENOUS").alias("phase"), (F.col("p_size") * 30).alias("elapsed"))
    return C.tie_breakers(df).select("p_partkey", F.col("rows_in_volume").cast("int").alias("rows_in_volume"), "slice_thickness", "z_coverage", "volume_mm3", "delay_preferred")


# ------------------------------------------------------------ phase strategies


def _rows(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", "p_brand", F.col("p_type").alias("tag"), F.when(F.col("p_size") < 20, "portal venous").when(F.col("p_size") < 30, " ").alias("rule_phase"), F.lit("high").alias("rule_phase_confidence"), F.lit("text").alias("rule_phase_reason"),
                    F.when(F.col("p_size") > 10, F.col("p_name")).alias("predicted"), F.when(F.col("p_size") % 2 == 0, "MRI").otherwise("CT").alias("Modality"), (F.col("p_size") / 50).alias("sure"))


def _resolved(df, strategy):
    return P.resolve(df, {"strategies": [strategy]}).select("p_partkey", "phase", "phase_status", "phase_strategy", "phase_confidence")


def _status(strategy: str, phase: str, confidence: str) -> str:
    return f"SELECT p_partkey, coalesce({phase}, 'OTHER') AS phase, CASE WHEN {phase} IS NULL THEN 'UNRESOLVED' ELSE 'RESOLVED' END AS phase_status, CASE WHEN {phase} IS NULL THEN 'unresolved' ELSE '{strategy}' END AS phase_strategy, CASE WHEN {phase} IS NOT NULL THEN {confidence} END AS phase_confidence FROM part"


@query(_status("explicit", "(CASE WHEN p_brand = 'Brand#2' OR p_size > 45 THEN 'ARTERIAL' WHEN p_name LIKE '%ring%' THEN 'DELAYED' END)", "'sure'"))
def r01_explicit(spark, sf_dir):
    df = table(spark, sf_dir, "part")
    first = {"phase": "ARTERIAL", "logic": "or", "rules": [{"column": "p_brand", "op": "eq", "value": "Brand#2"}, {"column": "p_size", "op": "gt", "value": 45}]}
    second = {"phase": "DELAYED", "rules": [{"column": "p_name", "op": "contains", "value": "ring"}]}
    return _resolved(df, {"type": "explicit", "name": "by_hand", "confidence": "sure", "assignments": [first, second]})


@query(_status("ontology", "(CASE p_type WHEN 'ECONOMY' THEN 'NATIVE' WHEN 'SMALL' THEN 'ARTERIAL' ELSE CASE p_brand WHEN 'Brand#5' THEN 'DELAYED' END END)", "''"))
def r02_ontology(spark, sf_dir):
    return _resolved(table(spark, sf_dir, "part"), {"type": "ontology", "name": "codes", "columns": ["p_type", "p_brand"], "mapping": {"economy": "NATIVE", "Small": "ARTERIAL", "brand#5": "DELAYED"}})


@query(_status("rules", "(CASE WHEN p_size < 20 THEN 'PORTAL_VENOUS' END)", "'high'"))
def r03_rules(spark, sf_dir):
    return _resolved(_rows(spark, sf_dir), {"type": "rules", "name": "text"})


@query(_status("prediction", "(CASE WHEN p_size > 10 AND p_size % 2 = 0 THEN nullif(regexp_replace(regexp_replace(upper(trim(p_name)), '[^A-Z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), '') END)", "CAST(p_size / 50 AS VARCHAR)"))
def r04_prediction(spark, sf_dir):
    return _resolved(_rows(spark, sf_dir), {"type": "prediction", "name": "model", "column": "predicted", "modalities": ["MR"], "confidence_columns": ["sure"]})


@query("SELECT p_partkey, CASE WHEN p_size > 40 THEN 1000 ELSE 0 END AS bonus FROM part")
def r08_selection_bonus(spark, sf_dir):
    hand = {"type": "explicit", "name": "by_hand", "assignments": [{"phase": "ARTERIAL", "rules": [{"column": "p_size", "op": "gt", "value": 40}]}]}
    df = P.resolve(_rows(spark, sf_dir).withColumn("p_size", F.col("sure") * 50), {"strategies": [hand, {"type": "rules", "name": "text"}]})
    return df.select("p_partkey", P.selection_bonus(df).alias("bonus"))


@query("SELECT p_partkey FROM part WHERE p_size BETWEEN 20 AND 29 AND p_type = 'SMALL' OR p_size > 29")
def f19_unresolved(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    phase = F.when(F.col("p_size") > 40, None).when(F.col("p_size") > 29, " ").when((F.col("p_size") > 19) & (F.col("p_type") == "SMALL"), "other").otherwise("NATIVE")
    return I.unresolved(p.withColumn("phase", phase)).select("p_partkey")
