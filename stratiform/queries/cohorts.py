"""Cohorts against references, versions against versions."""

from pyspark.sql import functions as F

from stratiform.operators import compare as E
from stratiform.operators.ordering import top
from stratiform.queries.base import CANDIDATES, candidates, query, r6, table

_PRED = "pred AS (SELECT doc_id, lang, source FROM documents WHERE n_chars BETWEEN 600 AND 6000 AND lang IN ('en', 'fr'))"
_TRUE = "truth AS (SELECT d.doc_id, lang, source FROM documents d JOIN labels USING (doc_id) WHERE quality = 1)"


def _cohorts(spark, sf_dir):
    d, l = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars"), table(spark, sf_dir, "labels")
    pred = d.filter("n_chars between 600 and 6000 and lang in ('en', 'fr')")
    return pred, d.join(l.filter("quality = 1").select("doc_id"), "doc_id", "left_semi")


_GRAINS = {"document": ["doc_id"], "lang": ["lang"], "lang_source": ["lang", "source"]}


def _grain_sql(name, cols):
    c = ", ".join(cols)
    return f"""SELECT '{name}' AS grain, p AS predicted, t AS reference, k AS tp, p - k AS fp, t - k AS fn, round(k / nullif(p, 0), 6) AS precision, round(k / nullif(t, 0), 6) AS recall,
    round(2 * k / nullif(p + t, 0), 6) AS f1, round(k / nullif(p + t - k, 0), 6) AS jaccard FROM (SELECT (SELECT count(*) FROM (SELECT DISTINCT {c} FROM pred)) AS p, (SELECT count(*) FROM (SELECT DISTINCT {c} FROM truth)) AS t,
    (SELECT count(*) FROM (SELECT DISTINCT {c} FROM pred INTERSECT SELECT DISTINCT {c} FROM truth)) AS k)"""


@query(f"WITH {_PRED}, {_TRUE} " + " UNION ALL ".join(_grain_sql(n, c) for n, c in _GRAINS.items()))
def e02_set_metrics(spark, sf_dir):
    m = E.set_metrics(*_cohorts(spark, sf_dir), _GRAINS)
    return m.withColumns({c: r6(F.col(c)) for c in ("precision", "recall", "f1", "jaccard")})


@query(f"""WITH {_PRED}, {_TRUE} SELECT doc_id, 'false_positive' AS kind FROM (SELECT doc_id FROM pred EXCEPT SELECT doc_id FROM truth)
UNION ALL SELECT doc_id, 'false_negative' FROM (SELECT doc_id FROM truth EXCEPT SELECT doc_id FROM pred)""")
def e03_mismatches(spark, sf_dir):
    return E.mismatches(*_cohorts(spark, sf_dir), ["doc_id"])


_ORDER = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _joined(cond: str) -> str:
    return "array_to_string(list_filter([" + ", ".join(f"'{o}'" for o in _ORDER) + f"], lambda x: {cond}), '|')"


@query(f"""WITH {CANDIDATES}, g AS (SELECT patient, yr, list(DISTINCT slot) AS got FROM candidates WHERE score > 150000 GROUP BY 1, 2), w AS (SELECT patient, yr, list(DISTINCT slot) AS want FROM candidates WHERE o_orderstatus <> 'P' GROUP BY 1, 2),
b AS (SELECT w.*, coalesce(got, []) AS got FROM w LEFT JOIN g USING (patient, yr))
SELECT patient, yr, {_joined("list_contains(want, x)")} AS expected, {_joined("list_contains(want, x) AND list_contains(got, x)")} AS matched,
{_joined("list_contains(want, x) AND NOT list_contains(got, x)")} AS missing, list_has_all(got, want) AS full_match FROM b""")
def e04_label_recovery(spark, sf_dir):
    c = candidates(spark, sf_dir)
    return E.label_recovery(c.filter("score > 150000"), c.filter("o_orderstatus <> 'P'"), ["patient", "yr"], "slot", _ORDER)


@query(f"""WITH {CANDIDATES}, e AS (SELECT * FROM candidates WHERE o_orderstatus <> 'P' AND slot <> '5-LOW'), d AS (SELECT patient, yr, count(DISTINCT slot) AS n FROM e GROUP BY 1, 2),
best AS (SELECT patient, yr, n FROM d QUALIFY row_number() OVER (PARTITION BY patient ORDER BY n DESC, yr) = 1)
SELECT patient, yr, n AS n_slots, slot, o_orderkey FROM e JOIN best USING (patient, yr) QUALIFY row_number() OVER (PARTITION BY patient, slot ORDER BY score DESC, o_orderkey) = 1""")
def e01_build_cohort(spark, sf_dir):
    """Eligible candidates, each patient's best exam, the best candidate of each of its slots."""
    e = candidates(spark, sf_dir).filter("o_orderstatus <> 'P' and slot <> '5-LOW'")
    exams = e.groupBy("patient", "yr").agg(F.count_distinct("slot").alias("n_slots"))
    best = top(exams, ["patient"], [F.desc("n_slots"), "yr"])
    return top(e.join(best, ["patient", "yr"]), ["patient", "slot"], [F.desc("score"), "o_orderkey"]).select("patient", "yr", "n_slots", "slot", "o_orderkey")


@query(f"WITH {_PRED}, {_TRUE}, j AS (SELECT doc_id, p.doc_id IS NOT NULL AS p FROM truth LEFT JOIN pred p USING (doc_id)) SELECT count(*) AS reference, count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM pred)) AS recovered, round(count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM pred)) / count(*), 6) AS share FROM truth")
def e05_summary(spark, sf_dir):
    pred, truth = _cohorts(spark, sf_dir)
    hit = truth.join(pred.select("doc_id", F.lit(True).alias("hit")), "doc_id", "left")
    return hit.agg(F.count("*").alias("reference"), F.count("hit").alias("recovered"), r6(F.count("hit") / F.count("*")).alias("share"))


_OK = "o_orderstatus <> 'P' AND slot <> '5-LOW'"


@query(f"""WITH {CANDIDATES}, e AS (SELECT * FROM candidates WHERE {_OK}), best AS (SELECT patient, yr FROM (SELECT patient, yr, count(DISTINCT slot) AS n FROM e GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY patient ORDER BY n DESC, yr) = 1),
won AS (SELECT o_orderkey FROM e JOIN best USING (patient, yr) QUALIFY row_number() OVER (PARTITION BY patient, slot ORDER BY score DESC, o_orderkey) = 1)
SELECT c.o_orderkey, CASE WHEN NOT ({_OK}) THEN 'not_eligible' WHEN c.yr <> b.yr THEN 'other_exam' WHEN w.o_orderkey IS NOT NULL THEN 'selected' ELSE 'other_candidate' END AS reason FROM candidates c LEFT JOIN best b ON c.patient = b.patient LEFT JOIN won w ON c.o_orderkey = w.o_orderkey""")
def e01_audit(spark, sf_dir):
    _, audit = E.selected_cohort(candidates(spark, sf_dir), F.expr(_OK), "patient", "yr", "slot", [F.desc("score"), "o_orderkey"])
    return audit.select("o_orderkey", "reason")


@query(f"""WITH {CANDIDATES}, g AS (SELECT patient, yr, list(DISTINCT slot) AS got FROM candidates WHERE score > 150000 GROUP BY 1, 2), w AS (SELECT patient, yr, list(DISTINCT slot) AS want FROM candidates WHERE o_orderstatus <> 'P' GROUP BY 1, 2),
b AS (SELECT w.*, coalesce(got, []) AS got FROM w LEFT JOIN g USING (patient, yr)), f AS (SELECT patient % 5 = 0 AS s, list_has_all(got, want) AS full_, list_has_any(got, want) AS any_ FROM b)
SELECT count(*) AS exams, count(*) FILTER (WHERE full_) AS complete, count(*) FILTER (WHERE any_ AND NOT full_) AS partial, count(*) FILTER (WHERE NOT any_) AS "none", count(*) FILTER (WHERE s) AS subgroup_exams,
count(*) FILTER (WHERE s AND full_) AS subgroup_complete, count(*) FILTER (WHERE s AND any_ AND NOT full_) AS subgroup_partial, count(*) FILTER (WHERE s AND NOT any_) AS subgroup_none FROM f""")
def e05_recovery_summary(spark, sf_dir):
    return E.recovery_summary(e04_label_recovery(spark, sf_dir), F.col("patient") % 5 == 0)


@query(f"WITH {_PRED}, {_TRUE} SELECT lang, source, 'both' AS side FROM (SELECT DISTINCT lang, source FROM pred INTERSECT SELECT DISTINCT lang, source FROM truth) UNION ALL SELECT lang, source, 'only_reference' FROM (SELECT DISTINCT lang, source FROM truth EXCEPT SELECT DISTINCT lang, source FROM pred)")
def u3_key_sets(spark, sf_dir):
    p, t = (E.keys_of(x, ["lang", "source"]) for x in _cohorts(spark, sf_dir))
    return p.intersect(t).withColumn("side", F.lit("both")).union(t.subtract(p).withColumn("side", F.lit("only_reference")))


@query(f"WITH {_PRED}, {_TRUE} SELECT count(*) AS n FROM pred WHERE doc_id IN (SELECT doc_id FROM truth)")
def j10_semi_join(spark, sf_dir):
    p, t = _cohorts(spark, sf_dir)
    return p.join(t, "doc_id", "left_semi").agg(F.count("*").alias("n"))


@query(f"WITH {_PRED}, {_TRUE} SELECT count(*) AS n FROM pred WHERE doc_id NOT IN (SELECT doc_id FROM truth)")
def j11_anti_join(spark, sf_dir):
    p, t = _cohorts(spark, sf_dir)
    return p.join(t, "doc_id", "left_anti").agg(F.count("*").alias("n"))


@query("""WITH gone AS (SELECT * FROM orders WHERE o_custkey % 17 = 0), v AS (SELECT o_custkey, count(DISTINCT o_orderkey) AS n_studies, list_sort(list(DISTINCT o_orderpriority)) AS p FROM gone GROUP BY 1)
SELECT o_custkey, n_studies, array_to_string(p[1:3], ', ') || CASE WHEN len(p) > 3 THEN ' (+' || CAST(len(p) - 3 AS VARCHAR) || ' more)' ELSE '' END AS o_orderpriority FROM v ORDER BY o_custkey LIMIT 20""")
def a19_vanished_keys(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return E.vanished(o, o.filter("o_custkey % 17 <> 0"), ["o_custkey"], "o_orderkey", ["o_orderpriority"])


@query("""SELECT 'status' AS step, count(*) AS rows, count(DISTINCT o_custkey) AS patients FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT 'price', count(*), count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice > 200000
UNION ALL SELECT 'priority', count(*), count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice > 200000 AND o_orderpriority <> '5-LOW'""")
def a21_step_funnel(spark, sf_dir):
    steps = [("status", F.col("o_orderstatus") != "P"), ("price", F.col("o_totalprice") > 200000), ("priority", F.col("o_orderpriority") != "5-LOW")]
    return E.step_funnel(table(spark, sf_dir, "orders"), steps, {"patients": ["o_custkey"]})


@query("SELECT o_orderkey, o_custkey, o_totalprice * 2 AS doubled FROM orders WHERE o_orderkey % 3 > 0")
def j09_preserved_columns(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    old = o.select("o_orderkey", "o_custkey", (F.col("o_totalprice") * 2).alias("doubled"))
    return E.preserved(o.filter("o_orderkey % 3 > 0").select("o_orderkey", "o_custkey"), old, ["o_custkey", "o_orderkey"])
