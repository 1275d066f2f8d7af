"""Incremental recomputation from row fingerprints: what is unchanged is carried over, the rest is the work."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the JSON of the filled columns in order of name; nulls leave no trace, so an added empty column changes nothing."""
    return F.sha2(F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(columns)))), 256)


def short_id(columns: Sequence[str]) -> Column:
    return F.substring(row_hash(columns), 1, 20)


def source_id(volume: Column, columns: Sequence[str]) -> Column:
    """The volume id, else a hash of the row (there is no row number to fall back on)."""
    return F.coalesce(F.nullif(F.trim(volume.cast("string")), F.lit("")), row_hash(columns))


def dataset_hash(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row with a hash of the table whatever its order: SHA-256 of the number of rows and of four sums over the rows' hashes.

    A row's hash takes in its key; its first 60 hexadecimal digits are four numbers, and numbers are summed with partial sums, so no rows meet in a task.
    """
    row = F.sha2(F.concat_ws(":", F.col(key).cast("string"), row_hash(columns)), 256)
    parts = [F.sum(F.conv(F.substring(row, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")) for i in range(4)]
    text = F.concat_ws(":", F.count("*").cast("string"), *(F.coalesce(x, F.lit(0)).cast("string") for x in parts))
    return df.agg(F.sha2(text, 256).alias("dataset_sha256"))


def unchanged_dataset(df: DataFrame, key: str, columns: Sequence[str], config: Mapping, state: Mapping | None) -> tuple[bool, dict[str, str]]:
    """Whether a run may be skipped as table and settings are those of the last one (state: None, if there was none), and the state to keep."""
    now = {"config_hash": config_hash(config), "dataset_sha256": dataset_hash(df, key, columns).first()[0]}
    return state is not None and all(state.get(k) == v for k, v in now.items()), now


def config_hash(config: Mapping, without: Sequence[str] = ()) -> str:
    return hashlib.sha256(json.dumps({k: v for k, v in config.items() if k not in without}, sort_keys=True, default=str).encode()).hexdigest()


def unchanged(state: DataFrame, current: DataFrame) -> DataFrame:
    """source_id of rows that the state has as completed with the same hash."""
    return current.join(state.filter("status = 'completed'").select("source_id", "row_sha256"), ["source_id", "row_sha256"], "left_semi").select("source_id")


def work(state: DataFrame, current: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Rows to compute: neither unchanged nor, unless retried, failed with the same hash before."""
    done = state.filter(F.col("status") == "completed") if retry_failed else state.filter(F.col("status").isin("completed", "failed"))
    return current.join(done.select("source_id", "row_sha256"), ["source_id", "row_sha256"], "left_anti")


def carried(current: DataFrame, previous: DataFrame, same: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Enriched columns of unchanged rows; null for the others."""
    kept = previous.join(same, "source_id", "left_semi").select("source_id", *columns)
    return current.join(kept, "source_id", "left")


def reannotated(df: DataFrame, annotate: Callable[[DataFrame], DataFrame], columns: Sequence[str], lacking: Column) -> DataFrame:
    """annotate() sees all rows, but only those that lack evidence get its values; the others keep theirs. Columns that df lacks are new for all."""
    old = [c for c in columns if c in df.columns]
    kept = df.withColumns({"_lacking": F.coalesce(lacking, F.lit(True)), **{f"_old_{c}": F.col(c) for c in old}})
    out = annotate(kept)
    return out.withColumns({c: F.when(F.col("_lacking"), F.col(c)).otherwise(F.col(f"_old_{c}")) for c in old}).drop("_lacking", *(f"_old_{c}" for c in old))


def merged_predictions(current: DataFrame, predictions: DataFrame, columns: Sequence[str]) -> DataFrame:
    """current (source_id, row_sha256, ...) with imported predictions; those made for another state of the row are null, and `stale` says so."""
    found = predictions.select("source_id", F.col("row_sha256").alias("_made_for"), *(F.col(c).alias(f"_new_{c}") for c in columns))
    out = current.join(found, "source_id", "left")
    fits = F.col("_made_for").eqNullSafe(F.col("row_sha256"))
    out = out.withColumn("stale", F.col("_made_for").isNotNull() & ~fits)
    return out.withColumns({c: F.when(fits, F.col(f"_new_{c}")) for c in columns}).drop("_made_for", *(f"_new_{c}" for c in columns))


def reusable_groups(rows: DataFrame, group: str, ok: Column) -> DataFrame:
    return rows.groupBy(group).agg(F.bool_and(F.coalesce(ok, F.lit(False))).alias("reusable")).filter("reusable").select(group)


def inventory_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files that are new or differ in length or time."""
    return after.join(before, ["path", "length", "modified"], "left_anti")


def outputs_present(expected: DataFrame, inventory: DataFrame, row: str, path: str, compared: Sequence[str] = ()) -> DataFrame:
    """Per row whether all its expected outputs exist; expected has a row per output. Of the columns `compared` (length, modified, sha256) recorded
    in expected those that are filled must be the inventory's."""
    found = inventory.groupBy(F.col("path").alias(path)).agg(F.lit(True).alias("_there"), *(F.first(c).alias(f"_now_{c}") for c in compared))
    met = expected.join(found, path, "left")
    ok = F.coalesce("_there", F.lit(False))
    for c in compared:
        ok = ok & (F.col(c).isNull() | F.col(c).eqNullSafe(F.col(f"_now_{c}")))
    return met.groupBy(row).agg(F.bool_and(ok).alias("complete"))


def cell_hashes(df: DataFrame, key: str, cells: str, inventory: DataFrame, strict: bool = False) -> DataFrame:
    """key and artifact_sha256: of a cell, or list of cells, of paths a hash of its elements in order, each with its path, whether it is there, and length and time
    (strict: its content's sha256, a column of the inventory, instead of the time). An empty or null cell has the hash of no elements."""
    listed = df.select(key, cells).withColumn(cells, F.col(cells) if dict(df.dtypes)[cells].startswith("array") else F.array(cells))
    flat = listed.select(key, F.posexplode_outer(cells).alias("_i", "path"))
    state = ["length", "sha256"] if strict else ["length", "modified"]
    one = inventory.groupBy("path").agg(*(F.first(c).alias(c) for c in state), F.lit(True).alias("_there"))
    met = flat.join(one, "path", "left")
    element = F.concat_ws("|", "path", F.coalesce("_there", F.lit(False)).cast("string"), *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in state))
    listed_ = F.transform(F.array_sort(F.collect_list(F.when(F.col("path").isNotNull(), F.struct("_i", element.alias("e"))))), lambda x: x["e"])
    return met.groupBy(key).agg(F.sha2(F.array_join(listed_, "\n"), 256).alias("artifact_sha256"))


def bucket_hashes(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int = 1024) -> DataFrame:
    """bucket, n, sha256: the leaves of a tree over a table, whatever its order. A bucket's hash is that of four sums over its rows' hashes, so no rows meet in a task."""
    row = F.sha2(F.concat_ws(":", row_hash(keys), row_hash(columns)), 256)
    parts = [F.sum(F.conv(F.substring("_h", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")) for i in range(4)]
    rows = df.select(bucket_of(keys, buckets).alias("bucket"), row.alias("_h"))
    return rows.groupBy("bucket").agg(F.count("*").alias("n"), F.sha2(F.concat_ws(":", F.count("*").cast("string"), *(x.cast("string") for x in parts)), 256).alias("sha256"))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """A bucket by the hash of a row's key."""
    return F.pmod(F.conv(F.substring(row_hash(keys), 1, 15), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def table_hash(leaves: DataFrame) -> DataFrame:
    """One row with the root over bucket_hashes(): a bounded number of leaves, in order."""
    return leaves.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "sha256"))), lambda x: F.concat_ws(":", x["bucket"].cast("string"), x["sha256"])), ","), 256).alias("table_sha256"))


def changed_buckets(before: DataFrame, after: DataFrame) -> DataFrame:
    """Buckets whose hashes are new, gone or other than before."""
    both = before.select("bucket", F.col("sha256").alias("_a")).join(after.select("bucket", F.col("sha256").alias("_b")), "bucket", "full")
    return both.filter(~F.col("_a").eqNullSafe(F.col("_b"))).select("bucket")


def changed_rows(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int = 1024) -> DataFrame:
    """keys and change (new, gone, changed) between two tables of one row per key; only rows in buckets whose hashes differ are compared."""
    some = changed_buckets(bucket_hashes(before, keys, columns, buckets), bucket_hashes(after, keys, columns, buckets))
    near = lambda df, name: df.select(*keys, row_hash(columns).alias(name), bucket_of(keys, buckets).alias("bucket")).join(F.broadcast(some), "bucket", "left_semi").drop("bucket")  # noqa: E731  at most `buckets` rows
    both = near(before, "_a").join(near(after, "_b"), list(keys), "full")
    change = F.when(F.col("_a").isNull(), "new").when(F.col("_b").isNull(), "gone").when(F.col("_a") != F.col("_b"), "changed")
    return both.select(*keys, change.alias("change")).filter("change is not null")


def summary(state: DataFrame) -> DataFrame:
    """How many rows have which status; resumed ones were completed by an earlier run."""
    s = F.col("status")
    return state.agg(F.count("*").alias("total"), *(F.count_if(s.isin(*of)).alias(name) for name, of in (("succeeded", ("completed", "resumed")), ("resumed", ("resumed",)), ("failed", ("failed",)), ("skipped", ("skipped",)))))
