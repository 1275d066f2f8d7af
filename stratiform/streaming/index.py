"""Resumable index building: new files only, exactly once, by a file stream that stops when it has caught up."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.operators.ordering import top
from stratiform.shared import discard, spread, written_at
from stratiform.sources.publish import current, settle

BUCKETS = 64
#: Rows of the index that one task sorts and writes.
ROWS = 1_000_000


def _followed(spark: SparkSession, source: str, schema: str, checkpoint: str, files_per_batch: int, write: Callable[[DataFrame, int], None]) -> int:
    done = []

    def each(batch: DataFrame, number: int) -> None:
        write(batch, number)
        done.append(number)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return len(done)


def build_index(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, parse: Callable[[DataFrame], DataFrame], files_per_batch: int = 1000) -> int:
    """Parses what `source` has gained since the last call and appends it to `target`; returns the number of batches.

    A batch is written under its own number and overwritten if it is replayed, so a lost run leaves no double rows.
    """
    write = lambda batch, number: parse(batch).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{target}/batch={number:09d}")
    return _followed(spark, source, schema, checkpoint, files_per_batch, write)


def merge_batch(batch: DataFrame, target: str, keys: Sequence[str], latest: Sequence[str], number: int, buckets: int = BUCKETS) -> bool:
    """Merges a batch into the index at `target`, which has the last row of each key: that of the latest batch, within it that with the greatest `latest`.

    Rows live in buckets by key. Only the buckets that a batch has keys of are read and written again, under new names, by as many tasks as their rows need; the manifest that is put in
    place last names the folder of every bucket and the batch, so a run that is lost changes nothing and a batch that is replayed is known and left out (false).
    Columns that a later batch brings are null in rows from before.
    """
    spark = batch.sparkSession
    state = current(spark, target) or {"batch": -1, "folders": {}, "buckets": buckets, "schema": T.StructType().jsonValue()}
    if number <= state["batch"]:
        return False
    bucket = F.pmod(F.xxhash64(*keys), F.lit(state["buckets"])).cast("int")
    rows, path = written_at(top(spread(batch, *keys, rows=ROWS), list(keys), [F.desc_nulls_last(c) for c in latest]).withColumns({"_bucket": bucket, "_new": F.lit(1)}), "batch", by=["_bucket"])
    touched = [r["_bucket"] for r in rows.select("_bucket").distinct().collect()]
    folders = dict(state["folders"])
    n = rows.count()
    old = [f"{target}/{f}" for b, f in folders.items() if int(b) in touched]
    if old:
        before = spark.read.schema(T.StructType.fromJson(state["schema"])).parquet(*old)
        n += before.count()
        both = rows.unionByName(before.withColumns({"_bucket": bucket, "_new": F.lit(0)}), allowMissingColumns=True)
        rows = top(spread(both, *keys, rows=ROWS, count=n), list(keys), [F.desc("_new")])
    out = rows.drop("_new")
    schema = T.StructType([f for f in out.schema if f.name != "_bucket"])
    known = {f.name for f in schema}
    schema = T.StructType([*schema, *(f for f in T.StructType.fromJson(state["schema"]) if f.name not in known)])
    folder = f"_versions/{uuid.uuid4().hex}"
    slices = -(-n // (ROWS * max(1, len(touched))))  # a bucket of more rows than a task's is several files
    spread(out, "_bucket", F.pmod(F.hash(*keys), F.lit(max(1, slices))), rows=ROWS, count=n).write.partitionBy("_bucket").parquet(f"{target}/{folder}")
    discard(spark, path)
    folders |= {str(b): f"{folder}/_bucket={b}" for b in touched}
    settle(spark, target, {**state, "batch": number, "folders": folders, "schema": schema.jsonValue()}, None)
    return True


def read_index(spark: SparkSession, target: str) -> DataFrame:
    """The index as its last complete batch left it."""
    state = current(spark, target)
    if not state:
        raise FileNotFoundError(f"no index at {target}")
    schema = T.StructType.fromJson(state["schema"])
    paths = [f"{target}/{f}" for f in state["folders"].values()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def build_latest(
    spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, parse: Callable[[DataFrame], DataFrame], keys: Sequence[str], latest: Sequence[str], files_per_batch: int = 1000, buckets: int = BUCKETS
) -> int:
    """As build_index(), but the index (see read_index) keeps the last row of each key, also where a key comes again in a later batch."""
    return _followed(spark, source, schema, checkpoint, files_per_batch, lambda batch, number: merge_batch(parse(batch), target, keys, latest, number, buckets) and None)
