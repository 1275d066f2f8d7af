"""Visit and acquisition order, ranks, top picks, rank statistics."""

from pyspark.sql import functions as F

from stratiform.operators import ordering as O
from stratiform.queries.base import CANDIDATES, candidates, query, r6, table


@query("""WITH s AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
w AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY d NULLS LAST, o_orderkey) - 1 AS visit_order,
  lag(d) OVER (PARTITION BY o_custkey ORDER BY d NULLS LAST, o_orderkey) AS p, min(d) OVER (PARTITION BY o_custkey) AS f FROM s)
SELECT o_custkey, o_orderkey, visit_order, coalesce(date_diff('day', p, d), 0) AS delay_since_prev_exam, coalesce(date_diff('day', f, d), 0) AS delay_since_first_exam FROM w""")
def w01_visit_order(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return O.visit_order(o, "o_custkey", "o_orderkey", "o_orderdate").drop("o_orderdate")


@query("""WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS d, ts, value, epoch_us(ts) / 1e6 AS s FROM events),
w AS (SELECT *, row_number() OVER v - 1 AS acquisition_order, lag(s) OVER v AS p, min(s) OVER (PARTITION BY user_id, d) AS f FROM e
      WINDOW v AS (PARTITION BY user_id, d ORDER BY ts NULLS LAST, value NULLS LAST, event_id))
SELECT event_id, acquisition_order, CASE WHEN acquisition_order = 0 THEN 0.0 ELSE round(s - p, 6) END AS delay_since_prev_volume, round(s - f, 6) AS delay_since_first_volume FROM w""")
def w02_acquisition_order(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.to_date("ts").alias("d"), "ts", "value")
    return O.acquisition_order(e, ["user_id", "d"], "event_id", "ts", ["value"], "event_id").select("event_id", "acquisition_order", "delay_since_prev_volume", "delay_since_first_volume")


@query("""WITH e AS (SELECT *, CAST(ts AS DATE) AS d FROM events)
SELECT event_id, row_number() OVER (PARTITION BY user_id, d ORDER BY ts, value, event_id) AS volume_order_in_series, count(*) OVER (PARTITION BY user_id, d) AS n_volumes_in_series,
  count(*) OVER (PARTITION BY user_id, d) > 1 AS is_multivolume,
  CASE WHEN len(list_distinct(list(ts) OVER (PARTITION BY user_id, d))) > 1 OR len(list_distinct(list(value) OVER (PARTITION BY user_id, d))) > 1 THEN 'computed' ELSE 'input_order' END AS order_source FROM e""")
def w04_series_order(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("d", F.to_date("ts"))
    return O.series_order(e, ["user_id", "d"], "event_id", "ts", "value").select("event_id", "volume_order_in_series", "n_volumes_in_series", "is_multivolume", "order_source")


@query(f"WITH {CANDIDATES} SELECT o_orderkey, row_number() OVER (PARTITION BY patient, yr, slot ORDER BY score DESC, o_orderkey) - 1 AS candidate_rank FROM candidates")
def w05_candidate_rank(spark, sf_dir):
    df = O.ranked(candidates(spark, sf_dir), ["patient", "yr", "slot"], [F.desc("score"), "o_orderkey"], "r")
    return df.select("o_orderkey", (F.col("r") - 1).alias("candidate_rank"))


@query(f"WITH {CANDIDATES} SELECT patient, yr, slot, o_orderkey, score FROM candidates QUALIFY row_number() OVER (PARTITION BY patient, yr, slot ORDER BY score DESC, o_orderkey) = 1")
def w06_top_per_slot(spark, sf_dir):
    return O.top(candidates(spark, sf_dir), ["patient", "yr", "slot"], [F.desc("score"), "o_orderkey"]).select("patient", "yr", "slot", "o_orderkey", "score")


_W7 = "o_orderstatus = 'F' DESC, round(score, -5) DESC, c_mktsegment, o_orderdate, o_orderkey"


@query(f"WITH {CANDIDATES} SELECT yr, slot, c_mktsegment, o_orderkey FROM candidates QUALIFY row_number() OVER (PARTITION BY yr, slot, c_mktsegment ORDER BY (o_orderstatus = 'F') DESC, floor(score / 1e5) DESC NULLS LAST, o_orderdate NULLS LAST, o_orderkey) = 1")
def w07_top_by_many_keys(spark, sf_dir):
    order = [F.desc(F.col("o_orderstatus") == "F"), F.floor(F.col("score") / 1e5).desc_nulls_last(), F.col("o_orderdate").asc_nulls_last(), "o_orderkey"]
    return O.top(candidates(spark, sf_dir), ["yr", "slot", "c_mktsegment"], order).select("yr", "slot", "c_mktsegment", "o_orderkey")


@query("""SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 3 END, o_totalprice NULLS LAST, o_orderkey) AS reference_rank,
count(*) OVER (PARTITION BY o_custkey) AS reference_of FROM orders""")
def w08_reference_rank(spark, sf_dir):
    df = O.reference_rank(table(spark, sf_dir, "orders"), ["o_custkey"], [("o_orderpriority", ["1-URGENT", "3-MEDIUM"]), ("o_totalprice", "min")], "o_orderkey")
    return df.select("o_orderkey", "reference_rank", "reference_of")


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS ordinal FROM orders")
def w09_ordinal(spark, sf_dir):
    return O.ranked(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderkey"], "ordinal").select("o_orderkey", "ordinal")


@query(f"""WITH {CANDIDATES}, d AS (SELECT patient, CAST(o_orderdate AS DATE) AS dt, count(DISTINCT slot) AS n FROM candidates GROUP BY 1, 2)
SELECT patient, CAST(dt AS VARCHAR) AS best_date, n FROM d QUALIFY row_number() OVER (PARTITION BY patient ORDER BY n DESC, dt) = 1""")
def w10_best_date(spark, sf_dir):
    days = candidates(spark, sf_dir).groupBy("patient", F.to_date("o_orderdate").alias("dt")).agg(F.count_distinct("slot").alias("n"))
    return O.top(days, ["patient"], [F.desc("n"), "dt"]).select("patient", F.col("dt").cast("string").alias("best_date"), "n")


@query("""WITH e AS (SELECT *, CAST(ts AS DATE) AS d, epoch_us(ts) / 1e6 AS s, CASE WHEN user_id % 3 = 0 THEN event_type ELSE 'scan' END AS ref FROM events)
SELECT event_id, CASE WHEN count(ref) OVER w = count(*) OVER w AND min(ref) OVER w = max(ref) OVER w THEN round(s - first_value(s) OVER (PARTITION BY user_id, d ORDER BY event_id), 6) END AS elapsed
FROM e WINDOW w AS (PARTITION BY user_id, d)""")
def w12_elapsed(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumns({"d": F.to_date("ts"), "ref": F.when(F.col("user_id") % 3 == 0, F.col("event_type")).otherwise("scan")})
    return O.elapsed(e, ["user_id", "d"], "event_id", "ts", "ref").select("event_id", "elapsed")


@query("""WITH e AS (SELECT event_id, user_id, date_trunc('hour', ts) AS h, CASE WHEN event_id % 4 > 0 THEN value END AS v FROM events),
t AS (SELECT *, count(*) OVER w AS n, count(v) OVER w AS k, len(list_distinct(list_filter(list(v) OVER w, lambda x: x IS NOT NULL))) AS u FROM e WINDOW w AS (PARTITION BY user_id, h)),
x AS (SELECT *, n = 1 OR (k = n AND u = n) AS sure, CASE WHEN k = n AND u = n THEN v END AS refine FROM t)
SELECT event_id, CASE WHEN sure THEN dense_rank() OVER (PARTITION BY user_id ORDER BY h NULLS LAST, refine NULLS LAST) END AS chronology FROM x""")
def w13_chronology(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.date_trunc("hour", "ts").alias("h"), F.when(F.col("event_id") % 4 > 0, F.col("value")).alias("v"))
    return O.chronology(e, ["user_id"], "h", "v").select("event_id", "chronology")


@query("""WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS d, ts FROM events), w AS (SELECT event_id, count(*) OVER (PARTITION BY user_id, d) AS n, row_number() OVER (PARTITION BY user_id, d ORDER BY ts) AS r,
count(DISTINCT ts) OVER (PARTITION BY user_id, d) AS u FROM e)
SELECT event_id, CASE WHEN u <> n THEN NULL WHEN n = 2 THEN ['NATIVE', 'PORTAL_VENOUS'][least(r, 2)] WHEN n = 4 THEN ['NATIVE', 'ARTERIAL', 'PORTAL_VENOUS', 'DELAYED'][least(r, 4)] END AS profile_label FROM w""")
def w14_profile(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("d", F.to_date("ts"))
    labels = {2: ["NATIVE", "PORTAL_VENOUS"], 4: ["NATIVE", "ARTERIAL", "PORTAL_VENOUS", "DELAYED"]}
    return O.profile(e, ["user_id", "d"], "ts", labels).select("event_id", "profile_label")


@query("""WITH e AS (SELECT event_id, user_id, CASE WHEN event_id % 5 > 0 THEN value END AS a, CAST(ts AS DATE) AS d, event_id AS b FROM events),
w AS (SELECT event_id, a, b, count(*) OVER p AS n, count(a) OVER p AS ka, min(a) OVER p AS ma, max(a) OVER p AS xa, min(b) OVER p AS mb, max(b) OVER p AS xb FROM e WINDOW p AS (PARTITION BY user_id, d))
SELECT event_id, coalesce(CASE WHEN ka = n AND (n = 1 OR ma < xa) THEN a = ma WHEN n = 1 OR mb < xb THEN b = mb END, false) AS is_first FROM w""")
def w16_first_acquisition(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.when(F.col("event_id") % 5 > 0, F.col("value")).alias("a"), F.to_date("ts").alias("d"), F.col("event_id").alias("b"))
    return O.first_acquisition(e, ["user_id", "d"], ["a", "b"]).select("event_id", "is_first")


@query("SELECT event_id, min(CASE WHEN event_type = 'purchase' THEN event_id END) OVER (PARTITION BY user_id ORDER BY event_id RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_anchor FROM events")
def j16_next_anchor(spark, sf_dir):
    return O.next_anchor(table(spark, sf_dir, "events"), ["user_id"], "event_id", F.col("event_type") == "purchase").select("event_id", "next_anchor")


_TIED = "t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem)"


@query(f"WITH {_TIED} SELECT 'largest' AS side, * FROM t QUALIFY rank() OVER (ORDER BY l_quantity DESC) <= 25 UNION ALL SELECT 'smallest', * FROM t QUALIFY rank() OVER (ORDER BY l_quantity) <= 25")
def w17_largest_with_ties(spark, sf_dir):
    """Quantities repeat, so many rows tie with the 25th."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    sides = [O.n_largest(l, "l_quantity", 25, smallest).select(F.lit(name).alias("side"), "*") for name, smallest in (("largest", False), ("smallest", True))]
    return sides[0].union(sides[1])


@query(f"WITH {CANDIDATES} SELECT o_orderkey FROM candidates QUALIFY row_number() OVER (PARTITION BY patient, yr ORDER BY score DESC, o_orderkey) <= 2")
def w18_head_per_exam(spark, sf_dir):
    return O.top(candidates(spark, sf_dir), ["patient", "yr"], [F.desc("score"), "o_orderkey"], 2).select("o_orderkey")


@query("""WITH p AS (SELECT p_brand, avg(p_retailprice) / 2500 AS p FROM part GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY p) AS k, count(*) OVER () AS n FROM p)
SELECT p_brand, round(least(1.0, min(p * n / k) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS q_value FROM r""")
def w19_benjamini_hochberg(spark, sf_dir):
    p = table(spark, sf_dir, "part").groupBy("p_brand").agg((F.avg("p_retailprice") / 2500).alias("p"))
    return O.benjamini_hochberg(p, "p").select("p_brand", r6(F.col("q_value")).alias("q_value"))


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS patient FROM orders""")
def o01_final_order(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 10 == 0, "").otherwise(F.col("o_custkey").cast("string")).alias("patient"), "o_orderdate", "o_totalprice")
    return O.final_order(o, "patient", "o_orderdate", "o_totalprice", "o_orderkey").select("o_orderkey", "patient")


@query("SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order FROM orders GROUP BY 1")
def o03_first_and_last(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    first = O.top(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", F.col("o_orderkey").alias("first_order"))
    last = O.top(o, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", F.col("o_orderkey").alias("last_order"))
    return first.join(last, "o_custkey")


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('7:' || o_orderkey), o_orderkey LIMIT 100")
def o04_hash_sample(spark, sf_dir):
    return O.hash_sample(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), 100, "o_orderkey", 7)
