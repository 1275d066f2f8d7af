"""Slice-to-volume rollups, volume identity, counts, pivots."""

from pyspark.sql import functions as F

from stratiform.operators import rollup as A
from stratiform.operators.ordering import ranked
from stratiform.queries.base import CANDIDATES, SLICES, candidates, query, r6, slices, table


@query(f"""WITH {SLICES} SELECT study, count(*) AS n_files, list_sort(list_distinct(list(z))) AS z, list_sort(list_distinct(list(modality))) AS modality,
CASE WHEN count(DISTINCT z) = 1 THEN min(z) END AS z_one, CASE WHEN count(DISTINCT modality) = 1 THEN min(modality) END AS modality_one FROM slices GROUP BY study""")
def a01_volume_rollup(spark, sf_dir):
    return A.volumes(slices(spark, sf_dir).select("study", "z", "modality"), "study", ["z", "modality"])


@query(f"""WITH {SLICES} SELECT study, CAST(min(l_shipdate) AS VARCHAR) AS first_date, arg_min(modality, (l_shipdate, modality)) AS source FROM slices GROUP BY study""")
def a02_earliest_with_source(spark, sf_dir):
    out = A.volumes(slices(spark, sf_dir).select("study", "l_shipdate", "modality"), "study", [], {"l_shipdate": "modality"})
    return out.select("study", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("first_date"), F.col("modality").alias("source"))


@query(f"""WITH {SLICES} SELECT study, count(*) AS n, round(abs(min(thickness)) + (count(*) - 1) * abs(coalesce(max(CASE WHEN l_quantity > 25 THEN l_quantity END), min(thickness))), 6) AS length FROM slices GROUP BY study""")
def a03_volume_length(spark, sf_dir):
    g = slices(spark, sf_dir).groupBy("study").agg(F.count("*").alias("n"), F.min("thickness").alias("t"), F.max(F.when(F.col("l_quantity") > 25, F.col("l_quantity"))).alias("s"))
    return g.select("study", "n", r6(A.volume_length(F.col("n"), F.col("t"), F.col("s"))).alias("length"))


_HIST = f"""{SLICES}, c AS (SELECT series, z, count(*) AS n FROM slices GROUP BY 1, 2), h AS (SELECT series, n, count(*) AS freq FROM c GROUP BY 1, 2),
hist AS (SELECT series, CAST(sum(freq) AS BIGINT) AS n_unique, sum(CASE WHEN n > 1 THEN freq ELSE 0 END) / sum(freq) AS repeated, arg_max(n, (freq, -n)) AS modal_count, count(*) > 1 AS irregular FROM h GROUP BY 1)"""


@query(f"WITH {_HIST} SELECT series, n_unique, round(repeated, 6) AS repeated, modal_count, irregular FROM hist")
def a04_position_histogram(spark, sf_dir):
    h = A.position_histogram(slices(spark, sf_dir).select("series", "z"), ["series"], "z")
    return h.withColumn("repeated", r6(F.col("repeated")))


@query(f"""WITH {SLICES}, g AS (SELECT study, list_sort(list_distinct(list(CAST(z AS DOUBLE)))) AS p FROM slices GROUP BY study)
SELECT study, len(p) > 1 AND len(list_filter(range(2, len(p) + 1), lambda i: abs((p[i] - p[i - 1]) - (p[2] - p[1])) > 0.001 + 1e-5 * abs(p[2] - p[1]))) = 0 AS even FROM g""")
def a05_even_spacing(spark, sf_dir):
    g = slices(spark, sf_dir).groupBy("study").agg(F.array_sort(F.collect_set(F.col("z").cast("double"))).alias("p"))
    return g.select("study", A.even_spacing(F.col("p"), 0.001).alias("even"))


@query(f"WITH {SLICES} SELECT count(DISTINCT patient) AS patients, count(DISTINCT study) AS studies, count(DISTINCT (study, series)) AS series FROM slices")
def a06_grain_counts(spark, sf_dir):
    return A.grain_counts(slices(spark, sf_dir), {"patients": ["patient"], "studies": ["study"], "series": ["study", "series"]})


@query(f"WITH {SLICES} SELECT patient, modality, count(DISTINCT study) AS studies, count(DISTINCT series) AS series FROM slices GROUP BY 1, 2")
def a07_counts_by_group(spark, sf_dir):
    return A.grain_counts(slices(spark, sf_dir), {"studies": ["study"], "series": ["series"]}, ["patient", "modality"])


@query("SELECT CASE WHEN p_size > 5 THEN p_type END AS p_type, count(*) AS n FROM part GROUP BY 1")
def a08_value_counts(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy(F.when(F.col("p_size") > 5, F.col("p_type")).alias("p_type")).agg(F.count("*").alias("n"))


@query("SELECT o_custkey, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS first_priority FROM orders GROUP BY 1")
def a15_first_per_group(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("first_priority"))


_RANKED = f"WITH {CANDIDATES}, r AS (SELECT *, row_number() OVER (PARTITION BY patient, yr, slot ORDER BY score DESC, o_orderkey) AS rank FROM candidates)"


@query(f"{_RANKED} SELECT patient, yr, slot, coalesce(string_agg(CASE WHEN rank > 1 THEN CAST(o_orderkey AS VARCHAR) END, '; ' ORDER BY rank), '') AS others FROM r GROUP BY 1, 2, 3")
def a16_other_candidates(spark, sf_dir):
    df = ranked(candidates(spark, sf_dir), ["patient", "yr", "slot"], [F.desc("score"), "o_orderkey"])
    return A.other_candidates(df, ["patient", "yr", "slot"], "rank", F.col("o_orderkey").cast("string"))


_SLOTS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_WIDE = ", ".join(
    f"""max(CASE WHEN slot = '{s}' AND rank = 1 THEN o_orderkey END) AS "{s}", coalesce(string_agg(CASE WHEN slot = '{s}' AND rank > 1 THEN CAST(o_orderkey AS VARCHAR) END, '; ' ORDER BY rank), '') AS "{s}_other_candidates" """ for s in _SLOTS
)


@query(f"{_RANKED} SELECT patient, yr, {_WIDE} FROM r GROUP BY 1, 2")
def a17_wide_selection(spark, sf_dir):
    df = ranked(candidates(spark, sf_dir), ["patient", "yr", "slot"], [F.desc("score"), "o_orderkey"])
    return A.wide(df, ["patient", "yr"], "slot", _SLOTS, F.col("o_orderkey"), "rank", F.col("o_orderkey").cast("string"))


@query(f"WITH {CANDIDATES} SELECT slot, count(*) FILTER (WHERE o_orderstatus = 'F') AS F, count(*) FILTER (WHERE o_orderstatus = 'O') AS O, count(*) FILTER (WHERE o_orderstatus = 'P') AS P FROM candidates GROUP BY 1")
def a18_pivot_counts(spark, sf_dir):
    return candidates(spark, sf_dir).groupBy("slot").pivot("o_orderstatus", ["F", "O", "P"]).count().na.fill(0)


@query(f"""WITH {SLICES}, x AS (SELECT series, z, study, row_number() OVER (PARTITION BY series, z ORDER BY l_shipdate, study, l_extendedprice, l_quantity, volume) AS k FROM slices)
SELECT series, z, max(k) AS repeats, sum(k) AS total FROM x GROUP BY 1, 2""")
def w03_repeat_index(spark, sf_dir):
    order = ["l_shipdate", "study", "l_extendedprice", "l_quantity", "volume"]
    return ranked(slices(spark, sf_dir), ["series", "z"], order, "k").groupBy("series", "z").agg(F.max("k").alias("repeats"), F.sum("k").alias("total"))


@query(f"""WITH {_HIST}, x AS (SELECT s.*, n_unique >= 5 AND repeated >= 0.7 AND modal_count > 1 AS hit, h.modal_count,
 row_number() OVER (PARTITION BY s.series, z ORDER BY l_shipdate, study, l_extendedprice, l_quantity, volume) AS k FROM slices s JOIN hist h USING (series)),
v AS (SELECT series, CASE WHEN hit THEN sha1(CAST(series AS VARCHAR) || '||vol' || CAST(k AS VARCHAR)) ELSE CAST(volume AS VARCHAR) END AS volume, CASE WHEN hit THEN modal_count ELSE 1 END AS n_detected FROM x)
SELECT series, volume, n_detected, count(*) AS n FROM v GROUP BY 1, 2, 3""")
def c01_split_stacks(spark, sf_dir):
    df = slices(spark, sf_dir).withColumn("id", F.col("volume").cast("string"))
    out = A.split_stacks(df, ["series"], "z", ["l_shipdate", "study", "l_extendedprice", "l_quantity", "volume"], "id", min_slices=5)
    return out.groupBy("series", F.col("id").alias("volume"), "n_detected").agg(F.count("*").alias("n"))


@query(f"""WITH {SLICES}, g AS (SELECT study, list_sort(list_distinct(list(CAST(volume AS VARCHAR)))) AS ids, list_sort(list_distinct(list(CAST(z AS DOUBLE)))) AS p FROM slices GROUP BY 1),
ok AS (SELECT study, ids FROM g WHERE len(ids) > 1 AND len(p) > 1 AND len(list_filter(range(2, len(p) + 1), lambda i: abs((p[i] - p[i - 1]) - (p[2] - p[1])) > 0.001 + 1e-5 * abs(p[2] - p[1]))) = 0),
m AS (SELECT id, arg_max(sha1(array_to_string(ids, '|')), study) AS new FROM (SELECT study, ids, unnest(ids) AS id FROM ok) GROUP BY id)
SELECT coalesce(new, CAST(volume AS VARCHAR)) AS volume, count(*) AS n FROM slices LEFT JOIN m ON CAST(volume AS VARCHAR) = id GROUP BY 1""")
def c02_merge_fragments(spark, sf_dir):
    df = slices(spark, sf_dir).select("study", F.col("volume").cast("string").alias("volume"), F.col("z").cast("double").alias("z"))
    return A.merge_fragments(df, ["study"], "volume", "z").groupBy("volume").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, sha1(CAST(o_custkey AS VARCHAR) || '||' || o_orderstatus || '||' || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END) AS id FROM orders")
def h01_stable_id(spark, sf_dir):
    priority = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select("o_orderkey", A.stable_id(["o_custkey", "o_orderstatus", priority]).alias("id"))


@query("SELECT p_partkey, p_name, NULL::VARCHAR AS spare FROM part")
def s12_drop_all_null(spark, sf_dir):
    df = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.lit(None).cast("string").alias("empty"), F.lit(None).cast("string").alias("spare"))
    return A.drop_all_null(df, ["spare"])
