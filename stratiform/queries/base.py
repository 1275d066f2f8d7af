"""The registry and the views that stand for cohort tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLE_SQL[key] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c) -> F.Column:
    """Rounded to six places, for comparison with the other engine."""
    return F.round(c, 6)


# ------------------------------------------------------------ views

SLICES = """slices AS (
  SELECT o_custkey AS patient, o_orderkey AS study, l_partkey AS series, l_suppkey AS volume, l_linenumber AS z,
         l_quantity, l_extendedprice, l_tax * 100 AS thickness, l_shipdate, l_orderkey, l_discount, l_linestatus,
         CASE l_returnflag WHEN 'A' THEN 'CT' WHEN 'R' THEN 'MR' ELSE 'OTHER' END AS modality
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slice rows: order lines as slices, orders as studies, customers as patients."""
    l, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return l.join(o, l.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("patient"), F.col("o_orderkey").alias("study"), F.col("l_partkey").alias("series"), F.col("l_suppkey").alias("volume"), F.col("l_linenumber").alias("z"),
        "l_quantity", "l_extendedprice", (F.col("l_tax") * 100).alias("thickness"), "l_shipdate", "l_orderkey", "l_discount", "l_linestatus",
        F.when(F.col("l_returnflag") == "A", "CT").when(F.col("l_returnflag") == "R", "MR").otherwise("OTHER").alias("modality"),
    )


CANDIDATES = """candidates AS (
  SELECT o_orderkey, o_custkey AS patient, year(o_orderdate) AS yr, o_orderpriority AS slot, o_totalprice AS score, o_orderdate, c_mktsegment, o_orderstatus
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of selection slots within exams."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", F.col("o_custkey").alias("patient"), F.year("o_orderdate").alias("yr"), F.col("o_orderpriority").alias("slot"), F.col("o_totalprice").alias("score"), "o_orderdate", "c_mktsegment", "o_orderstatus")
