"""Published tables, states, error tables, the index that keeps last rows, and fingerprints."""

from pyspark.sql import functions as F

from stratiform.functions import clock
from stratiform.operators import errors as E
from stratiform.operators import incremental as I
from stratiform.queries.base import query, table
from stratiform.shared import scratch
from stratiform.sources import publish as P
from stratiform.sources import tables as S
from stratiform.streaming.index import build_latest, merge_batch, read_index


@query("SELECT o_custkey, count(*) AS n, sum(o_orderkey % 1000) AS total FROM orders GROUP BY 1")
def s07_published(spark, sf_dir):
    """A table published twice, the second time from itself; a third job fails after half of its rows and changes nothing."""
    path = scratch(spark, "published")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    S.save(o, path)
    S.save(P.published(spark, path).groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum(F.col("o_orderkey") % 1000).alias("total")), path)
    try:
        S.save(o.withColumn("n", F.when(F.col("o_orderkey") % 2 == 0, F.raise_error(F.lit("no"))).otherwise(F.lit(1))), path)
        raise AssertionError("the job was to fail")
    except Exception as e:
        if "no" not in str(e):
            raise
    return P.published(spark, path)


@query("SELECT count(*) AS rows, max(o_orderkey) AS last, 2 AS version FROM orders")
def s08_state(spark, sf_dir):
    """A JSON state, replaced; then a writer that started from the first version and is refused."""
    path = scratch(spark, "state")
    row = table(spark, sf_dir, "orders").agg(F.count("*").alias("rows"), F.max("o_orderkey").alias("last")).first().asDict()
    P.save_state(spark, path, {"rows": 0})
    P.save_state(spark, path, row, expected=1)
    try:
        P.save_state(spark, path, {"rows": -1}, expected=1)
        raise AssertionError("this writer was to be refused")
    except P.Conflict:
        pass
    return spark.createDataFrame([(*(P.load_state(spark, path)[k] for k in ("rows", "last")), P.version(spark, path))], "rows long, last long, version int")


@query("""SELECT 'long' AS name, count(*) AS n FROM orders UNION ALL SELECT 'wide', count(DISTINCT o_custkey) FROM orders UNION ALL SELECT 'unresolved', count(*) FROM orders WHERE o_orderstatus = 'P'""")
def s13_selection(spark, sf_dir):
    base = scratch(spark, "selection")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    tables = {"long": o, "wide": o.groupBy("o_custkey").agg(F.count("*").alias("n")), "unresolved": o.filter("o_orderstatus = 'P'")}
    S.save_selection(tables, {n: f"{base}/{n}.csv" for n in tables}, "csv")
    return _counted(spark, {n: S.load(spark, f"{base}/{n}.csv") for n in tables})


def _counted(spark, tables):
    out = None
    for name, df in tables.items():
        one = df.agg(F.lit(name).alias("name"), F.count("*").alias("n"))
        out = one if out is None else out.union(one)
    return out


_GIVEN = """g AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'on ' || strftime(o_orderdate, '%d %b') ELSE strftime(o_orderdate, '%Y%m%d') END AS day,
CASE WHEN o_orderkey % 11 = 0 THEN '99:' || o_orderkey % 60 ELSE '08:' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') || ':00' END AS clock FROM orders)"""


@query(f"""WITH {_GIVEN}, e AS (SELECT *, concat_ws('; ', CASE WHEN day LIKE 'on %' THEN 'date: cannot read ' || day END, CASE WHEN clock LIKE '99%' THEN 'time: cannot read ' || clock END) AS said FROM g)
SELECT o_orderkey, CASE WHEN said = '' AND day IS NOT NULL THEN CAST(strptime(day, '%Y%m%d') AS DATE) END AS date, 'result' AS part, CAST(NULL AS VARCHAR) AS error_message FROM e WHERE said = ''
UNION ALL SELECT o_orderkey, CASE WHEN day NOT LIKE 'on %' THEN CAST(strptime(day, '%Y%m%d') AS DATE) END, 'error', said FROM e WHERE said <> ''""")
def s14_errors(spark, sf_dir):
    """Dates and clocks read; rows with an unreadable one go to the error table, out of the same evaluation."""
    k = F.col("o_orderkey")
    day = F.when(k % 5 == 0, None).when(k % 7 == 0, F.concat(F.lit("on "), F.date_format("o_orderdate", "dd MMM"))).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    at = F.when(k % 11 == 0, F.concat(F.lit("99:"), (k % 60).cast("string"))).otherwise(F.concat(F.lit("08:"), F.lpad((k % 60).cast("string"), 2, "0"), F.lit(":00")))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", day.alias("day"), at.alias("at"))
    read = E.checked(rows, {"date": (clock.date(F.col("day")), F.col("day")), "time": (clock.clock(F.col("at")), F.col("at"))})
    good, bad = E.parted(read)
    base = scratch(spark, "errors")
    S.save_errors(bad, base)
    bad = P.published(spark, base)
    return good.select("o_orderkey", "date", F.lit("result").alias("part"), F.lit(None).cast("string").alias("error_message")).union(bad.select("o_orderkey", "date", F.lit("error"), "error_message"))


@query("""SELECT o_orderkey, concat_ws(' | ', CASE WHEN o_orderkey % 9 = 0 THEN 'ValueError: 9 in ' || o_orderkey END, CASE WHEN o_totalprice > 200000 THEN 'price: ' || o_orderkey END) AS error_message FROM orders WHERE o_orderkey % 9 = 0 OR o_totalprice > 200000
UNION ALL SELECT o_orderkey, NULL FROM orders WHERE NOT (o_orderkey % 9 = 0 OR o_totalprice > 200000)""")
def s14_joined_back(spark, sf_dir):
    """Errors of a Python hook and of a rule, joined back to the rows by their key."""

    def odd(k):
        if k % 9 == 0:
            raise ValueError(f"9 in {k}")
        return k + 1

    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    good, failed = E.parted(E.hooked(o, odd, ["o_orderkey"], {"next": "long"}, on_error="record"))
    dear = o.filter("o_totalprice > 200000").select("o_orderkey", F.concat(F.lit("price: "), F.col("o_orderkey").cast("string")).alias("error_message"))
    return E.joined_back(o, E.any_error({"hook": failed, "price": dear}, "o_orderkey"), "o_orderkey").select("o_orderkey", "error_message")


@query("SELECT o_orderkey, o_orderkey % 4 AS part, CASE WHEN o_orderkey % 4 >= 2 THEN o_custkey END AS late, CASE WHEN o_orderkey % 4 = 1 THEN 2 ELSE 1 END AS version FROM orders")
def i06_keep_last(spark, sf_dir):
    """Four batches of files that repeat ids, the later ones with one column more; the first batch is replayed, and a second run finds nothing new."""
    base = scratch(spark, "latest")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    for k in range(4):
        rows = o.filter(F.col("o_orderkey") % 4 >= k).withColumns({"part": F.lit(k).cast("long"), "version": F.lit(1)})
        rows = rows.union(rows.filter("part = 1").withColumn("version", F.lit(2)))  # twice in one batch
        rows.coalesce(1).write.parquet(f"{base}/in{k}")
        rows.sparkSession.read.parquet(f"{base}/in{k}").coalesce(1).write.mode("append").parquet(f"{base}/in")
        late = lambda b, k=k: b.withColumn("late", F.col("o_custkey")) if k >= 2 else b
        parse = lambda b, late=late: late(b.select("o_orderkey", "o_custkey", "part", "version")).drop("o_custkey")
        build_latest(spark, f"{base}/in", "o_orderkey long, o_custkey long, part long, version int", f"{base}/out", f"{base}/state", parse, ["o_orderkey"], ["version"], 1, 8)
    replayed = merge_batch(spark.read.parquet(f"{base}/in0").select("o_orderkey", "part", "version"), f"{base}/out", ["o_orderkey"], ["version"], 0)
    if replayed:
        raise AssertionError("a replayed batch was taken again")
    return read_index(spark, f"{base}/out").select("o_orderkey", "part", "late", "version")


_TREE = "sha256(array_to_string(list_transform(range(0, greatest((length(t) + 3) // 4, 1)), lambda k: sha256(substr(t, 4 * k + 1, 4))), ''))"


@query(f"WITH f AS (SELECT n_nationkey, n_name || chr(10) AS t FROM nation) SELECT n_nationkey, CAST(length(t) AS BIGINT) AS length, {_TREE} AS sha256 FROM f")
def h04_content_hashes(spark, sf_dir):
    """A file for each nation, hashed as a tree over pieces of four bytes."""
    path = scratch(spark, "files")
    table(spark, sf_dir, "nation").select("n_nationkey", "n_name").repartition("n_nationkey").write.partitionBy("n_nationkey").text(path)
    out = S.content_hashes(S.inventory(spark, path, "part-*"), 4)
    return out.select(F.regexp_extract("path", r"n_nationkey=(\d+)", 1).cast("int").alias("n_nationkey"), "length", "sha256")


@query("""WITH inv AS (SELECT p_partkey AS path, p_size AS length, md5(p_name) AS sha256 FROM part WHERE p_partkey % 5 > 0), c AS (SELECT o_orderkey, l_linenumber AS i, l_partkey AS path FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey),
e AS (SELECT o_orderkey, i, c.path, c.path || '|' || (inv.path IS NOT NULL) || '|' || coalesce(CAST(length AS VARCHAR), '-') || '|' || coalesce(sha256, '-') AS e FROM c LEFT JOIN inv ON c.path = inv.path)
SELECT o_orderkey, sha256(coalesce(string_agg(e, chr(10) ORDER BY i, path), '')) AS artifact_sha256 FROM e GROUP BY 1""")
def h06_cell_hashes(spark, sf_dir):
    """Lists of paths element by element, with presence, length and content hash."""
    inventory = table(spark, sf_dir, "part").filter("p_partkey % 5 > 0").select(F.col("p_partkey").alias("path"), F.col("p_size").alias("length"), F.md5("p_name").alias("sha256"))
    l = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"]).alias("cells"))
    return I.cell_hashes(table(spark, sf_dir, "orders").select("o_orderkey").join(l, "o_orderkey", "left"), "o_orderkey", "cells", inventory, strict=True)


@query("""SELECT l_orderkey, bool_and(p_partkey IS NOT NULL AND (l_linenumber % 2 = 0 OR p_size = CASE WHEN l_linenumber = 3 THEN l_partkey % 50 ELSE p_size END) AND (l_linenumber < 6 OR p_brand = 'Brand#1')) AS complete
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 2) p ON l_partkey = p_partkey GROUP BY 1""")
def i09_recorded_outputs(spark, sf_dir):
    """Outputs that are there but of another length or hash than recorded are not complete; what isn't recorded isn't compared."""
    have = table(spark, sf_dir, "part").filter("p_size > 2").select(F.col("p_partkey").alias("path"), F.col("p_size").alias("length"), F.col("p_brand").alias("sha256"))
    n = F.col("l_linenumber")
    expected = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.when(n == 3, (F.col("l_partkey") % 50).cast("int")).alias("length"), F.when(n >= 6, "Brand#1").alias("sha256"))
    return I.outputs_present(expected, have, "l_orderkey", "l_partkey", ["length", "sha256"])


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 101 = 0 THEN 'gone' WHEN o_orderkey % 103 = 0 THEN 'new' ELSE 'changed' END AS change FROM orders WHERE o_orderkey % 101 = 0 OR o_orderkey % 103 = 0 OR o_orderkey % 107 = 0""")
def h04_changed_rows(spark, sf_dir):
    """Two versions of a table compared by a tree over buckets of keys."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    k = F.col("o_orderkey")
    now = o.filter(k % 101 > 0).withColumn("o_totalprice", F.when(k % 107 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return I.changed_rows(o.filter((k % 103 > 0) | (k % 101 == 0)), now, ["o_orderkey"], ["o_custkey", "o_totalprice"], 256)
