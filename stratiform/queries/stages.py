"""Columns, keys, eligibility and joins that stages share."""

from pyspark.sql import functions as F

from stratiform.functions import rules as R
from stratiform.functions import text as X
from stratiform.functions import vectors as V
from stratiform.operators import profile as Q
from stratiform.operators import tables as T
from stratiform.operators import voxels
from stratiform.operators.ordering import top
from stratiform.queries.base import CANDIDATES, candidates, query, r6, table


@query("SELECT o_orderkey, o_custkey, o_orderpriority, NULL::VARCHAR AS site, NULL::DOUBLE AS dose FROM orders")
def p03_effective_columns(spark, sf_dir):
    df = T.ensure_columns(table(spark, sf_dir, "orders").select("o_orderpriority", "o_custkey", "o_orderkey"), {"site": "string", "o_custkey": "string", "dose": "double"})
    return T.in_order(df, ["o_orderkey", "absent", "o_custkey"])


@query("SELECT s_suppkey, coalesce(n_name, 'unknown') AS country FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND n_nationkey < 20")
def p07_code_map(spark, sf_dir):
    codes = table(spark, sf_dir, "nation").filter("n_nationkey < 20")
    return T.looked_up(table(spark, sf_dir, "supplier"), "s_nationkey", codes, "n_nationkey", "n_name", "country", F.lit("unknown")).select("s_suppkey", "country")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice > 200000 AS dear, upper(o_orderpriority) AS overwritten FROM orders")
def p08_derived_columns(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("overwritten", F.lit(""))
    new = {"o_orderstatus": F.lit("not this"), "dear": F.col("o_totalprice") > 200000}
    return T.derive(T.derive(o, new, "missing_only"), {"overwritten": F.upper("o_orderpriority")}).select("o_orderkey", "o_orderstatus", "dear", "overwritten")


@query("SELECT p_partkey, CASE WHEN p_size % 3 > 0 THEN round(p_size / 10, 6) END AS x FROM part")
def p11_first_spacing(spark, sf_dir):
    cell = F.when(F.col("p_size") % 3 == 1, F.concat(F.lit("["), (F.col("p_size") / 10).cast("string"), F.lit(", 2.5]"))).when(F.col("p_size") % 3 == 2, F.concat((F.col("p_size") / 10).cast("string"), F.lit("\\7")))
    return table(spark, sf_dir, "part").select("p_partkey", r6(V.part(V.parsed(cell), 1)).alias("x"))


@query("SELECT 'l_quantity' AS feature, count(*) AS n, round(sum(l_quantity), 2) AS total FROM lineitem UNION ALL SELECT 'l_tax', count(*), round(sum(l_tax), 2) FROM lineitem UNION ALL SELECT 'l_linenumber', count(*), round(sum(l_linenumber), 2) FROM lineitem")
def p19_feature_columns(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    long = Q.unpivoted(li, Q.feature_columns(li, ("quantity", "tax", "number", "flag", "price"), ("l_extended",)))
    return long.groupBy("feature").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("SELECT p_partkey, concat_ws(', ', 'brand=' || trim(p_brand), CASE WHEN p_size > 20 THEN 'type=' || p_type END, 'size=' || p_size) AS label FROM part")
def p20_group_label(spark, sf_dir):
    label = X.group_label({"brand": F.col("p_brand"), "type": F.when(F.col("p_size") > 20, F.col("p_type")).otherwise(" "), "size": F.col("p_size")})
    return table(spark, sf_dir, "part").select("p_partkey", label.alias("label"))


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN lang WHEN doc_id % 4 = 1 THEN source ELSE CAST(n_chars AS VARCHAR) END AS first FROM documents")
def p25_first_text(spark, sf_dir):
    a, b = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit(" "), "lang")).otherwise("  "), F.when(F.col("doc_id") % 4 == 1, F.col("source"))
    return table(spark, sf_dir, "documents").select("doc_id", X.first_text(a, b, F.col("n_chars")).alias("first"))


@query("SELECT p_partkey FROM part WHERE p_size % 5 = 0 OR p_size BETWEEN 10 AND 30")
def f13_length_range(spark, sf_dir):
    df = table(spark, sf_dir, "part").withColumn("length", F.when(F.col("p_size") % 5 > 0, F.col("p_size")))
    rules = [{"column": "length", "op": "gte", "value": 10}, {"column": "length", "op": "lte", "value": 30}]
    return R.filtered(df, [{"kind": "keep", "logic": "and", "keep_null": True, "rules": rules}]).select("p_partkey")


@query(f"WITH {CANDIDATES} SELECT o_orderkey, c_mktsegment = 'BUILDING' AND slot IN ('1-URGENT', '2-HIGH') AND o_orderstatus <> 'P' OR c_mktsegment = 'MACHINERY' AND slot <> '5-LOW' AS eligible FROM candidates")
def f16_eligibility(spark, sf_dir):
    c = candidates(spark, sf_dir)
    one = [{"column": "c_mktsegment", "op": "eq", "value": "BUILDING"}, {"column": "slot", "op": "in", "value": ["1-URGENT", "2-HIGH"]}, {"column": "o_orderstatus", "op": "ne", "value": "P"}]
    two = [{"column": "c_mktsegment", "op": "eq", "value": "MACHINERY"}, {"column": "slot", "op": "ne", "value": "5-LOW"}]
    return c.select("o_orderkey", (R.combined(c, one) | R.combined(c, two)).alias("eligible"))


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def f17_required_columns(spark, sf_dir):
    return T.require(table(spark, sf_dir, "orders"), ["o_orderkey", "o_orderpriority"]).groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey AND s_acctbal > 0")
def j04_enriched_index(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    known = table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return T.joined_once(table(spark, sf_dir, "lineitem").select(keys), known, ["l_suppkey"])


@query(f"""WITH {CANDIDATES}, chosen AS (SELECT patient, max(yr) AS yr FROM candidates GROUP BY 1), best AS (SELECT * FROM candidates QUALIFY row_number() OVER (PARTITION BY patient, yr, slot ORDER BY score DESC, o_orderkey) = 1)
SELECT patient, yr, slot, o_orderkey FROM best JOIN chosen USING (patient, yr)""")
def j08_chosen_exams(spark, sf_dir):
    c = candidates(spark, sf_dir)
    best = top(c, ["patient", "yr", "slot"], [F.desc("score"), "o_orderkey"])
    chosen = c.groupBy("patient").agg(F.max("yr").alias("yr"))  # a row per patient: many to one by construction
    return best.join(chosen, ["patient", "yr"]).select("patient", "yr", "slot", "o_orderkey")


@query("""SELECT o_orderkey, CASE WHEN o_totalprice / 500000 >= 0.5 AND o_orderkey % 20 >= 5 AND o_custkey % 9 >= 4 THEN CASE WHEN o_totalprice / 500000 >= 0.8 THEN 'high' ELSE 'acceptable' END ELSE 'low' END AS confidence FROM orders""")
def x09_confidence(spark, sf_dir):
    found = voxels.confidence(F.col("o_totalprice") / 500000, F.col("o_orderkey") % 20 / 100, F.col("o_custkey") % 9)
    return table(spark, sf_dir, "orders").select("o_orderkey", found.alias("confidence"))
