"""Predicates, filters and unions."""

from pyspark.sql import functions as F

from stratiform.functions import rules as R
from stratiform.queries.base import query, table

_ORDERS = "SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price FROM orders"


def _orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("price"), F.split("o_orderpriority", "-").alias("parts"))


_RULES = {
    "eq": ({"column": "o_orderstatus", "op": "eq", "value": "F"}, "o_orderstatus = 'F'"),
    "ne": ({"column": "o_orderstatus", "op": "ne", "value": "F"}, "o_orderstatus <> 'F'"),
    "in": ({"column": "o_orderpriority", "op": "in", "value": ["1-URGENT", "5-LOW"]}, "o_orderpriority IN ('1-URGENT', '5-LOW')"),
    "not_in": ({"column": "o_orderpriority", "op": "not_in", "value": ["1-URGENT", "5-LOW"]}, "o_orderpriority NOT IN ('1-URGENT', '5-LOW')"),
    "contains": ({"column": "o_orderpriority", "op": "contains", "value": "NOT"}, "contains(o_orderpriority, 'NOT')"),
    "icontains": ({"column": "o_orderpriority", "op": "icontains", "value": "hi"}, "contains(lower(o_orderpriority), 'hi')"),
    "regex": ({"column": "o_orderpriority", "op": "regex", "value": "^[12]-"}, "regexp_matches(o_orderpriority, '^[12]-')"),
    "lt": ({"column": "price", "op": "lt", "value": 100000}, "coalesce(price < 100000, false)"),
    "lte": ({"column": "price", "op": "lte", "value": 100000}, "coalesce(price <= 100000, false)"),
    "gt": ({"column": "price", "op": "gt", "value": 400000}, "coalesce(price > 400000, false)"),
    "gte": ({"column": "price", "op": "gte", "value": 400000}, "coalesce(price >= 400000, false)"),
    "is_null": ({"column": "price", "op": "is_null"}, "price IS NULL"),
    "not_null": ({"column": "price", "op": "not_null"}, "price IS NOT NULL"),
    "absent": ({"column": "nothing", "op": "not_null"}, "false"),
}


@query(f"WITH o AS ({_ORDERS}) SELECT o_orderkey, " + ", ".join(f"{sql} AS r_{k}" for k, (_, sql) in _RULES.items()) + " FROM o")
def f01_scalar_rules(spark, sf_dir):
    df = _orders(spark, sf_dir)
    return df.select("o_orderkey", *(R.rule(df, r).alias(f"r_{k}") for k, (r, _) in _RULES.items()))


@query("""WITH o AS (SELECT o_orderkey, string_split(o_orderpriority, '-') AS p FROM orders)
SELECT o_orderkey, list_contains(p, '1') OR list_contains(p, 'LOW') AS any_in, NOT list_contains(p, 'LOW') AS none_in,
       len(list_filter(p, lambda x: contains(lower(x), 'hi'))) > 0 AS any_text, NOT (list_contains(p, '3')) AS all_ne, false AS nothing FROM o""")
def f02_list_rules(spark, sf_dir):
    df = _orders(spark, sf_dir)
    rules = {"any_in": ("in", ["1", "LOW"]), "none_in": ("not_in", ["LOW"]), "any_text": ("icontains", "HI"), "all_ne": ("ne", "3"), "nothing": ("is_null", None)}
    return df.select("o_orderkey", *(R.rule(df, {"column": "parts", "op": op, "value": v}).alias(n) for n, (op, v) in rules.items()))


_PAIR = [{"column": "o_orderstatus", "op": "eq", "value": "F"}, {"column": "price", "op": "gt", "value": 200000}]


@query(f"WITH o AS ({_ORDERS}) SELECT o_orderkey, o_orderstatus = 'F' AND coalesce(price > 200000, false) AS both_match, o_orderstatus = 'F' OR coalesce(price > 200000, false) AS any_match FROM o")
def f03_combined_rules(spark, sf_dir):
    df = _orders(spark, sf_dir)
    return df.select("o_orderkey", R.combined(df, _PAIR, "and").alias("both_match"), R.combined(df, _PAIR, "or").alias("any_match"))


@query(f"""WITH o AS ({_ORDERS}) SELECT o_orderkey FROM o
WHERE (o_orderstatus = 'F' AND coalesce(price > 100000, false) OR price IS NULL OR o_orderstatus IS NULL)
  AND NOT (coalesce(price > 400000, false) OR o_orderpriority = '5-LOW')""")
def f04_keep_discard(spark, sf_dir):
    groups = [
        {"kind": "keep", "keep_null": True, "logic": "and", "rules": [_PAIR[0], {"column": "price", "op": "gt", "value": 100000}]},
        {"kind": "discard", "logic": "or", "rules": [{"column": "price", "op": "gt", "value": 400000}, {"column": "o_orderpriority", "op": "eq", "value": "5-LOW"}]},
        {"kind": "keep", "rules": [{"column": "nothing", "op": "not_null"}]},
    ]
    return R.filtered(_orders(spark, sf_dir), groups).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority IN ('1-URGENT')")
def f06_value_filters(spark, sf_dir):
    groups = R.from_arguments(["o_orderstatus=P", "o_orderpriority=1-URGENT"], R.from_values({"o_orderstatus": ["F", "O"]}))
    return R.filtered(_orders(spark, sf_dir), groups, on_missing="raise").select("o_orderkey")


@query("SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring') OR contains(lower(p_type), 'ring')")
def f14_text_search(spark, sf_dir):
    return R.searched(table(spark, sf_dir, "part"), "RING", ["p_name", "p_type"]).select("p_partkey", "p_name")


@query("SELECT p_partkey FROM part WHERE p_size > 10 AND p_type <> 'SMALL'")
def f15_row_expression(spark, sf_dir):
    return table(spark, sf_dir, "part").filter(F.expr("p_size > 10 AND p_type <> 'SMALL'")).select("p_partkey")


@query("SELECT count(*) FILTER (WHERE text IS NULL OR trim(text) = '') AS blank, count(*) FILTER (WHERE NOT (text IS NULL OR trim(text) = '')) AS filled FROM (SELECT CASE WHEN doc_id % 5 = 0 THEN '  ' WHEN doc_id % 7 = 0 THEN NULL ELSE text END AS text FROM documents)")
def f20_blank(spark, sf_dir):
    t = F.when(F.col("doc_id") % 5 == 0, "  ").when(F.col("doc_id") % 7 == 0, None).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select(t.alias("text")).agg(F.count_if(R.blank(F.col("text"))).alias("blank"), F.count_if(~R.blank(F.col("text"))).alias("filled"))


@query("""SELECT 'customer' AS kind, c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_acctbal, NULL FROM supplier""")
def u1_union_by_name(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return c.unionByName(s, allowMissingColumns=True)
