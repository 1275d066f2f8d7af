"""Column profiles, feature statistics, incremental state."""

from pyspark.sql import functions as F

from stratiform.operators import incremental as I
from stratiform.operators import profile as Q
from stratiform.operators.columns import clocks_and_dates, with_clocks_and_dates
from stratiform.operators.ordering import benjamini_hochberg
from stratiform.queries.base import query, r6, table

_COLS = ["o_orderstatus", "o_orderpriority", "price"]
_ORD = "o AS (SELECT *, CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice END AS price FROM orders)"


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("price", F.when(F.col("o_orderkey") % 7 > 0, F.col("o_totalprice")))


@query(f"WITH {_ORD} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS present, count(*) - count({c}) AS missing, round(count({c}) * 100 / count(*), 6) AS percent, count(DISTINCT {c}) AS \"distinct\" FROM o" for c in _COLS))
def q01_column_coverage(spark, sf_dir):
    return Q.coverage(_orders(spark, sf_dir), _COLS).withColumn("percent", r6(F.col("percent")))


@query("""WITH v AS (SELECT 'p_brand' AS "column", p_brand AS value FROM part UNION ALL SELECT 'p_type', p_type FROM part), c AS (SELECT "column", value, count(*) AS n FROM v GROUP BY 1, 2)
SELECT "column", value, n, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank FROM c QUALIFY rank <= 20""")
def q03_top_values(spark, sf_dir):
    return Q.top_values(table(spark, sf_dir, "part"), ["p_brand", "p_type"])


_NUM = ["l_quantity", "l_extendedprice", "l_discount"]
_LONG = "u AS (" + " UNION ALL ".join(f"SELECT l_linestatus, '{c}' AS feature, {c} AS value FROM lineitem" for c in _NUM) + ")"
_POINTS = [0.01, 0.05, 0.5, 0.95, 0.99]


@query(f"""WITH {_LONG} SELECT feature, count(value) AS n, round(1 - count(value) / count(*), 6) AS missing, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min,
{", ".join(f"round(quantile_cont(value, {p}), 6) AS p{round(p * 100)}" for p in _POINTS)}, max(value) AS max, round(stddev_samp(value) / avg(value), 6) AS cv FROM u GROUP BY 1""")
def q04_describe(spark, sf_dir):
    d = Q.described(table(spark, sf_dir, "lineitem"), _NUM, _POINTS)
    return d.withColumns({c: r6(F.col(c)) for c in ("missing", "mean", "std", "cv", *(f"p{round(p * 100)}" for p in _POINTS))})


@query(f"""WITH {_LONG}, q AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3, count(*) AS n FROM u GROUP BY 1)
SELECT feature, n, count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outliers FROM u JOIN q USING (feature) WHERE n >= 4 GROUP BY 1, 2""")
def q05_outliers(spark, sf_dir):
    return Q.outliers(table(spark, sf_dir, "lineitem"), _NUM)


@query("SELECT string_split(url, '/')[3] AS first_part, count(*) AS n, count(*) - count(DISTINCT url) AS repeated FROM pages GROUP BY 1")
def q06_path_counts(spark, sf_dir):
    return table(spark, sf_dir, "pages").groupBy(F.split("url", "/")[2].alias("first_part")).agg(F.count("*").alias("n"), (F.count("*") - F.count_distinct("url")).alias("repeated"))


@query(f"WITH {_LONG} SELECT l_linestatus, feature, round(var_samp(value), 4) AS variance FROM u GROUP BY 1, 2")
def q08_variance(spark, sf_dir):
    long = Q.unpivoted(table(spark, sf_dir, "lineitem"), _NUM, ["l_linestatus"])
    return long.groupBy("l_linestatus", "feature").agg(F.round(F.var_samp("value"), 4).alias("variance"))


_PART = ["p_size", "p_retailprice", "half"]
_PARTS = "p AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_retailprice, p_partkey % 50 / 2 AS half FROM part)"


@query(f"""WITH {_PARTS}, r AS (SELECT {", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS {c}" for c in _PART)} FROM p)
SELECT 'p_size' AS a, 'p_retailprice' AS b, round(corr(p_size, p_retailprice), 6) AS rho FROM r UNION ALL SELECT 'p_size', 'half', round(corr(p_size, half), 6) FROM r UNION ALL SELECT 'p_retailprice', 'half', round(corr(p_retailprice, half), 6) FROM r""")
def q09_spearman(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice", (F.col("p_partkey") % 50 / 2).alias("half"))
    return Q.spearman(p, _PART, "p_partkey").withColumn("rho", r6(F.col("rho")))


@query(f"""WITH {_PARTS}, g AS (SELECT p.*, p_type FROM p JOIN part USING (p_partkey) WHERE p_type IN ('ECONOMY', 'SMALL')), u AS ({" UNION ALL ".join(f"SELECT p_partkey, p_type, '{c}' AS feature, g.{c} AS value FROM g" for c in _PART)}),
r AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2 AS rk FROM u), t AS (SELECT feature, sum(k * k * k - k) AS ties FROM (SELECT feature, value, count(*) AS k FROM u GROUP BY 1, 2) GROUP BY 1),
m AS (SELECT feature, count(*) FILTER (WHERE p_type = 'ECONOMY') AS n_a, count(*) FILTER (WHERE p_type = 'SMALL') AS n_b, avg(value) FILTER (WHERE p_type = 'ECONOMY') AS ma, avg(value) FILTER (WHERE p_type = 'SMALL') AS mb,
 median(value) FILTER (WHERE p_type = 'ECONOMY') AS da, median(value) FILTER (WHERE p_type = 'SMALL') AS db, var_samp(value) FILTER (WHERE p_type = 'ECONOMY') AS va, var_samp(value) FILTER (WHERE p_type = 'SMALL') AS vb, sum(rk) FILTER (WHERE p_type = 'ECONOMY') AS ra FROM r GROUP BY 1)
SELECT feature, n_a, n_b, round(ma, 6) AS mean_a, round(mb, 6) AS mean_b, round(da, 6) AS median_a, round(db, 6) AS median_b, round((ma - mb) / sqrt(((n_a - 1) * va + (n_b - 1) * vb) / (n_a + n_b - 2)), 6) AS cohens_d,
round((ma - mb) / sqrt(va / n_a + vb / n_b), 6) AS welch_t, round((va / n_a + vb / n_b)**2 / ((va / n_a)**2 / (n_a - 1) + (vb / n_b)**2 / (n_b - 1)), 4) AS df, round(ra - n_a * (n_a + 1) / 2, 6) AS u,
round((ra - n_a * (n_a + 1) / 2 - n_a * n_b / 2) / sqrt(n_a * n_b / 12 * (n_a + n_b + 1 - ties / ((n_a + n_b) * (n_a + n_b - 1)))), 6) AS z FROM m JOIN t USING (feature)""")
def q10_two_groups(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", F.col("p_size").cast("double").alias("p_size"), "p_retailprice", (F.col("p_partkey") % 50 / 2).alias("half"))
    out = Q.two_groups(p, _PART, "p_type", "ECONOMY", "SMALL", "p_partkey")
    return out.withColumns({**{c: r6(F.col(c)) for c in out.columns if c not in ("feature", "n_a", "n_b", "df")}, "df": F.round("df", 4)}).drop("ties")


#: The two-sided tails by Simpson's rule: of the normal distribution from z on, of Student's from |t| on (by 1 - the inside).
_TAIL = "2 * list_sum(list_transform(range(0, 4001), lambda i: (CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * exp(-1 * (({z}) + i * 0.01) ** 2 / 2))) * 0.01 / 3 / sqrt(2 * pi())"
_STUDENT = "1 - 2 * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(pi() * df) * list_sum(list_transform(range(0, 4001), lambda i: (CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * (1 + (abs(t) * i / 4000) ** 2 / df) ** (-(df + 1) / 2))) * abs(t) / 4000 / 3"
_BH = "least(1.0, min({p} * n / k_{p}) OVER (ORDER BY k_{p} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"
_MOMENTS = """r AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2 AS rk FROM u WHERE value IS NOT NULL), t AS (SELECT feature, sum(k * k * k - k) AS ties FROM (SELECT feature, value, count(*) AS k FROM u WHERE value IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
m AS (SELECT feature, count(*) FILTER (WHERE side = 'a') AS na, count(*) FILTER (WHERE side = 'b') AS nb, avg(value) FILTER (WHERE side = 'a') AS ma, avg(value) FILTER (WHERE side = 'b') AS mb, var_samp(value) FILTER (WHERE side = 'a') AS va, var_samp(value) FILTER (WHERE side = 'b') AS vb, sum(rk) FILTER (WHERE side = 'a') AS ra FROM r GROUP BY 1),
s AS (SELECT *, (ma - mb) / sqrt(va / na + vb / nb) AS t, (va / na + vb / nb)**2 / ((va / na)**2 / (na - 1) + (vb / nb)**2 / (nb - 1)) AS df, ra - na * (na + 1) / 2 AS u FROM m JOIN t USING (feature))"""


@query(f"""WITH {_PARTS}, g AS (SELECT p.*, CASE p_type WHEN 'ECONOMY' THEN 'a' ELSE 'b' END AS side FROM p JOIN part USING (p_partkey) WHERE p_type IN ('ECONOMY', 'SMALL')), u AS ({" UNION ALL ".join(f"SELECT p_partkey, side, '{c}' AS feature, g.{c} AS value FROM g" for c in _PART)}), {_MOMENTS},
z AS (SELECT feature, t, df, (greatest(u, na * nb - u) - na * nb / 2 - 0.5) / sqrt(na * nb / 12 * (na + nb + 1 - ties / ((na + nb) * (na + nb - 1)))) AS z FROM s), pv AS (SELECT feature, {_STUDENT} AS w, least(1.0, {_TAIL.format(z="z")}) AS u FROM z),
k AS (SELECT *, row_number() OVER (ORDER BY w) AS k_w, row_number() OVER (ORDER BY u) AS k_u, count(*) OVER () AS n FROM pv)
SELECT feature, round(w, 6) AS welch_p, round(u, 6) AS mann_whitney_p, round({_BH.format(p="w")}, 6) AS welch_q, round({_BH.format(p="u")}, 6) AS mann_whitney_q FROM k""")
def q10_p_values(spark, sf_dir):
    """Large groups with ties: the normal distribution with continuity correction, which the SQL integrates."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", F.col("p_size").cast("double").alias("p_size"), "p_retailprice", (F.col("p_partkey") % 50 / 2).alias("half"))
    out = Q.tested(Q.two_groups(p, _PART, "p_type", "ECONOMY", "SMALL", "p_partkey"))
    return out.select("feature", *(r6(F.col(c)).alias(c) for c in ("welch_p", "mann_whitney_p", "welch_q", "mann_whitney_q")))


_NATIONS = ["customers", "balance", "suppliers", "code"]


@query(f"""WITH n AS (SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 'a' ELSE 'b' END AS side, count(c_custkey) AS customers, round(avg(c_acctbal), 6) AS balance, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) % 3 AS suppliers, n_nationkey * 7 % 25 AS code
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey WHERE n_regionkey IN (0, 1) GROUP BY ALL), u AS ({" UNION ALL ".join(f"SELECT n_nationkey, side, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM n" for c in _NATIONS)}), {_MOMENTS},
places AS (SELECT feature, na, nb, u, ties, unnest(range(0, CAST(2 ** (na + nb) AS BIGINT))) AS mask FROM s), subsets AS (SELECT *, list_filter(range(0, na + nb), lambda i: (mask >> i) & 1 = 1) AS chosen FROM places),
ways AS (SELECT feature, count(*) AS every, count(*) FILTER (WHERE list_sum(chosen) + na - na * (na + 1) / 2 >= greatest(u, na * nb - u)) AS far FROM subsets WHERE len(chosen) = na GROUP BY 1),
p AS (SELECT feature, na, nb, u, ties, CASE WHEN ties = 0 THEN least(1.0, 2 * far / every) ELSE least(1.0, {_TAIL.format(z="(greatest(u, na * nb - u) - na * nb / 2 - 0.5) / sqrt(na * nb / 12 * (na + nb + 1 - ties / ((na + nb) * (na + nb - 1))))")}) END AS p FROM s JOIN ways USING (feature))
SELECT feature, na AS n_a, nb AS n_b, u, round(p, 6) AS mann_whitney_p FROM p""")
def q10_exact_u(spark, sf_dir):
    """Five nations against five: without ties by the exact distribution of U, for which the SQL goes through all subsets of the ranks."""
    n, c, s = (table(spark, sf_dir, t) for t in ("nation", "customer", "supplier"))
    per = n.filter("n_regionkey < 2").join(c.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"), F.round(F.avg("c_acctbal"), 6).alias("balance")), "n_nationkey", "left")
    per = per.join(s.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg((F.count("*") % 3).alias("suppliers")), "n_nationkey", "left")
    rows = per.select("n_nationkey", F.when(F.col("n_regionkey") == 0, "a").otherwise("b").alias("side"), F.coalesce("customers", F.lit(0)).cast("double").alias("customers"), "balance", F.coalesce("suppliers", F.lit(0)).cast("double").alias("suppliers"), (F.col("n_nationkey") * 7 % 25).cast("double").alias("code"))
    return Q.tested(Q.two_groups(rows, _NATIONS, "side", "a", "b", "n_nationkey")).select("feature", "n_a", "n_b", "u", r6(F.col("mann_whitney_p")).alias("mann_whitney_p"))


@query("""SELECT o_custkey, year(o_orderdate) AS visit, round(avg(o_totalprice), 6) AS mean, round(stddev_samp(o_totalprice), 6) AS std, count(*) AS n FROM orders GROUP BY 1, 2""")
def q13_trajectory(spark, sf_dir):
    visits = table(spark, sf_dir, "orders").withColumn("visit", F.year("o_orderdate"))
    return Q.trajectory(visits, "o_custkey", "visit", "o_totalprice").withColumns({"mean": r6(F.col("mean")), "std": r6(F.col("std"))}).orderBy("o_custkey", "visit")


_CLOCKS = ["HH:mm:ss", "HHmmss", "H 'o''clock'"]


@query("""SELECT 'at_time' AS "column", 'clock' AS kind UNION ALL SELECT 'seen_datetime', 'clock' UNION ALL SELECT 'due_date', 'day first' UNION ALL SELECT 'us_date', 'month first' UNION ALL SELECT 'iso_date', 'day first'""")
def d06_clocks_and_dates(spark, sf_dir):
    """Columns of events by name and sampled values: two thirds of at_time are clocks, wait_time and other_time aren't; US dates have days over 12 in the second place."""
    e = table(spark, sf_dir, "events")
    at = F.lit(None).cast("string")
    for i, form in enumerate(_CLOCKS):
        at = F.when(F.col("event_id") % 3 == i, F.date_format("ts", form)).otherwise(at)
    rows = e.select(
        at.alias("at_time"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("seen_datetime"), F.date_format("ts", "HH:mm:ss").alias("delay_time"), F.concat(F.lit("about "), F.date_format("ts", "HH")).alias("other_time"),
        F.date_format(F.date_add(F.to_date("ts"), (F.col("event_id") % 40).cast("int")), "dd/MM/yyyy").alias("due_date"), F.date_format(F.date_add(F.to_date("ts"), (F.col("event_id") % 40).cast("int")), "MM/dd/yyyy").alias("us_date"), F.date_format("ts", "yyyyMMdd").alias("iso_date"), F.lit("x").alias("date_source"),
    )
    found = clocks_and_dates(rows)
    told = [(c, "clock") for c in found.clocks] + [(c, "day first" if first else "month first") for c, first in found.dates.items()]
    return rows.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.lit(k).alias("kind")) for c, k in told))).alias("x")).select("x.*").distinct()


@query("SELECT event_id, CAST(CAST(ts AS DATE) + CAST(event_id % 40 AS INT) AS VARCHAR) AS us_date, CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS DOUBLE) AS at_time FROM events")
def d06_read_dates(spark, sf_dir):
    day = F.date_add(F.to_date("ts"), (F.col("event_id") % 40).cast("int"))
    rows = table(spark, sf_dir, "events").select("event_id", F.date_format(day, "M/d/yyyy").alias("us_date"), F.date_format("ts", "HHmmss").alias("at_time"))
    out = with_clocks_and_dates(rows)
    return out.select("event_id", F.col("us_date").cast("string").alias("us_date"), "at_time")


_KINDS = {"l_orderkey": "bigint", "l_linenumber": "int", "l_extendedprice": "double", "l_returnflag": "string"}


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{t}' AS type, count(DISTINCT {c}) AS \"distinct\", count(*) AS rows, count(DISTINCT {c}) > 0.8 * count(*) AS mostly_distinct FROM lineitem" for c, t in _KINDS.items()))
def q02_cardinality(spark, sf_dir):
    return Q.cardinality(table(spark, sf_dir, "lineitem"), list(_KINDS))


@query(f"WITH {_ORD} SELECT 'price' AS \"column\", count(*) AS rows, count(*) FILTER (WHERE price IS NULL) AS missing FROM o UNION ALL SELECT 'status', count(*), count(*) FILTER (WHERE o_orderstatus IN ('P')) FROM o UNION ALL SELECT 'site', count(*), count(*) FROM o")
def q06_critical_digest(spark, sf_dir):
    o = _orders(spark, sf_dir).withColumn("status", F.when(F.col("o_orderstatus") == "P", "  ").otherwise(F.col("o_orderstatus")))
    return Q.critical_digest(o, ["price", "status", "site"])


@query(f"WITH {_LONG}, v AS (SELECT feature, var_samp(value) AS variance FROM u GROUP BY 1) SELECT CAST(row_number() OVER (ORDER BY variance DESC, feature) AS INTEGER) AS rank, feature, round(variance, 4) AS variance FROM v QUALIFY rank <= 2")
def q08_variance_ranking(spark, sf_dir):
    return Q.variance_ranking(table(spark, sf_dir, "lineitem"), _NUM, 2).withColumn("variance", F.round("variance", 4))


# ------------------------------------------------------------ versions of one table

_V = "v1 AS (SELECT o_orderkey, o_totalprice FROM orders), v2 AS (SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS o_totalprice FROM orders WHERE o_orderkey % 17 > 0)"


def _versions(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    v2 = o.filter("o_orderkey % 17 > 0").withColumn("o_totalprice", F.col("o_totalprice") + F.when(F.col("o_orderkey") % 10 == 0, 1).otherwise(0))
    hashed = lambda df: df.select(F.col("o_orderkey").alias("source_id"), I.row_hash(["o_orderkey", "o_totalprice"]).alias("row_sha256"), "o_orderstatus")
    state = hashed(o).withColumn("status", F.when(F.col("o_orderstatus") == "P", "failed").otherwise("completed"))
    return state, hashed(v2)


@query("SELECT o_orderkey AS source_id FROM orders WHERE o_orderkey % 17 > 0 AND o_orderkey % 10 > 0 AND o_orderstatus <> 'P'")
def i02_unchanged(spark, sf_dir):
    state, now = _versions(spark, sf_dir)
    return I.unchanged(state, now)


@query("SELECT o_orderkey AS source_id, 'all' AS kind FROM orders WHERE o_orderkey % 17 > 0 AND (o_orderkey % 10 = 0 OR o_orderstatus = 'P') UNION ALL SELECT o_orderkey, 'new' FROM orders WHERE o_orderkey % 17 > 0 AND o_orderkey % 10 = 0")
def i03_work(spark, sf_dir):
    state, now = _versions(spark, sf_dir)
    retry = I.work(state, now, retry_failed=True).select("source_id", F.lit("all").alias("kind"))
    return retry.union(I.work(state, now).select("source_id", F.lit("new").alias("kind")))


@query("SELECT o_orderkey AS source_id, CASE WHEN o_orderkey % 10 > 0 AND o_orderstatus <> 'P' THEN o_totalprice * 2 END AS doubled FROM orders WHERE o_orderkey % 17 > 0")
def i04_carried(spark, sf_dir):
    state, now = _versions(spark, sf_dir)
    old = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("source_id"), (F.col("o_totalprice") * 2).alias("doubled"))
    return I.carried(now, old, I.unchanged(state, now), ["doubled"]).select("source_id", "doubled")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority ELSE CASE WHEN o_totalprice > g.top * 0.9 THEN 'top' ELSE 'other' END END AS label FROM orders JOIN (SELECT o_custkey, max(o_totalprice) AS top FROM orders GROUP BY 1) g USING (o_custkey)")
def r09_reannotated(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("label", F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderpriority")))

    def annotate(df):  # an exam's context is all its rows, those that keep their label too
        best = df.groupBy("o_custkey").agg(F.max("o_totalprice").alias("best"))
        return df.join(best, "o_custkey").withColumn("label", F.when(F.col("o_totalprice") > F.col("best") * 0.9, "top").otherwise("other")).drop("best")

    return I.reannotated(o, annotate, ["label"], F.col("label").isNull()).select("o_orderkey", "label")


@query("SELECT o_orderkey AS source_id, CASE WHEN o_orderkey % 10 > 0 AND o_orderstatus <> 'P' THEN o_orderstatus END AS predicted, o_orderkey % 10 = 0 AND o_orderstatus <> 'P' AS stale FROM orders WHERE o_orderkey % 17 > 0")
def r10_merged_predictions(spark, sf_dir):
    state, now = _versions(spark, sf_dir)
    made = state.filter("o_orderstatus <> 'P'").select("source_id", "row_sha256", F.col("o_orderstatus").alias("predicted"))
    return I.merged_predictions(now, made, ["predicted"]).select("source_id", "predicted", "stale")


@query("SELECT o_custkey FROM orders GROUP BY 1 HAVING bool_and(o_orderkey % 10 > 0)")
def i05_reusable_groups(spark, sf_dir):
    return I.reusable_groups(table(spark, sf_dir, "orders"), "o_custkey", F.col("o_orderkey") % 10 > 0)


@query("SELECT count(*) AS total, count(*) FILTER (WHERE o_orderstatus <> 'P') AS succeeded, count(*) FILTER (WHERE o_orderstatus <> 'P' AND o_orderkey % 3 = 0) AS resumed, count(*) FILTER (WHERE o_orderstatus = 'P') AS failed, 0::BIGINT AS skipped FROM orders")
def i08_summary(spark, sf_dir):
    state = _versions(spark, sf_dir)[0]
    return I.summary(state.withColumn("status", F.when((F.col("status") == "completed") & (F.col("source_id") % 3 == 0), "resumed").otherwise(F.col("status"))))


@query("SELECT l_orderkey, bool_and(l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 5)) AS complete FROM lineitem GROUP BY 1")
def i09_outputs_present(spark, sf_dir):
    have = table(spark, sf_dir, "part").filter("p_size > 5").select(F.col("p_partkey").alias("path"))
    return I.outputs_present(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey"), have, "l_orderkey", "l_partkey")


@query("""SELECT o_orderkey AS path, CAST(o_totalprice + CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS length FROM orders WHERE o_orderkey % 17 > 0 AND o_orderkey % 10 = 0""")
def i10_inventory_diff(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("path"), F.col("o_totalprice").alias("length"), F.col("o_orderdate").alias("modified"))
    now = o.filter("path % 17 > 0").withColumn("length", F.col("length") + F.when(F.col("path") % 10 == 0, 1).otherwise(0))
    return I.inventory_diff(o, now).select("path", "length")


@query("SELECT o_orderkey, sha256('{\"o_custkey\":' || o_custkey || CASE WHEN o_orderkey % 3 > 0 THEN ',\"o_orderstatus\":\"' || o_orderstatus || '\"' ELSE '' END || '}') AS h FROM orders")
def h03_row_hash(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderstatus")).alias("o_orderstatus"))
    return o.select("o_orderkey", I.row_hash(["o_orderstatus", "o_custkey"]).alias("h"))


@query("""WITH r AS (SELECT sha256(o_orderkey || ':' || sha256('{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || '}')) AS h FROM orders)
SELECT sha256(concat_ws(':', count(*), sum(CAST('0x' || substr(h, 1, 15) AS HUGEINT)), sum(CAST('0x' || substr(h, 16, 15) AS HUGEINT)), sum(CAST('0x' || substr(h, 31, 15) AS HUGEINT)), sum(CAST('0x' || substr(h, 46, 15) AS HUGEINT)))) AS dataset_sha256 FROM r""")
def a14_dataset_hash(spark, sf_dir):
    return I.dataset_hash(table(spark, sf_dir, "orders"), "o_orderkey", ["o_orderkey", "o_custkey"])
