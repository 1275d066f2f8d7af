"""Readers and writers. Schemas are given or all text: nothing is inferred over data, and columns are pruned in the scan."""

from __future__ import annotations

import csv
import hashlib
import os
import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.operators.rollup import drop_all_null
from stratiform.sources.publish import publish, publish_all, published, resolved


def read_csv(spark: SparkSession, paths: Sequence[str] | str, columns: Sequence[str], wanted: Sequence[str] | None = None, sep: str = ",", by_position: bool = False) -> DataFrame:
    """Delimited text with the given header as strings; only the wanted columns. The files' own headers are checked, unless columns go by position. Of a published table the current version is read."""
    paths = resolved(spark, paths) if isinstance(paths, str) else [resolved(spark, p) for p in paths]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = spark.read.schema(schema).option("header", True).option("sep", sep).option("enforceSchema", by_position).csv(paths)
    return df.select(*(f"`{c}`" for c in wanted if c in columns)) if wanted else df


def header_of(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names of a delimited file: one line is read. Quotes may hold separators; a blank cell gets a name by its place."""
    line = first_line(spark, path)
    return [c.strip() or f"Unnamed: {i}" for i, c in enumerate(next(csv.reader([line], delimiter=sep)))] if line else []


def first_line(spark: SparkSession, path: str) -> str:
    line = spark.read.text(resolved(spark, path)).limit(1).collect()
    return line[0][0].removeprefix("\ufeff") if line else ""


def read_all(spark: SparkSession, paths: Sequence[str], protect: Sequence[str] = (), sep: str = ",") -> DataFrame:
    """Several files of different columns, united by name, without unnamed and all-null columns."""
    out = None
    for path in (resolved(spark, p) for p in paths):
        names = header_of(spark, path, sep)
        part = read_csv(spark, path, names, [c for c in names if not c.startswith("Unnamed")], sep, by_position=True)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return drop_all_null(out, protect)


def load(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """By extension: csv, tsv, tab, txt (tab or comma, by the header), json, parquet. Pickles are refused."""
    kind = os.path.splitext(path.rstrip("/"))[1].lower().lstrip(".")
    path = resolved(spark, path)
    if kind == "parquet":
        return spark.read.parquet(path)
    if kind in ("json", "ndjson", "jsonl"):
        return (spark.read.schema(schema) if schema else spark.read).json(path)
    if kind in ("csv", "tsv", "tab", "txt"):
        sep = {"csv": ",", "tsv": "\t", "tab": "\t"}.get(kind) or ("\t" if "\t" in first_line(spark, path) else ",")
        return read_csv(spark, path, header_of(spark, path, sep), sep=sep, by_position=True)
    raise ValueError(f"cannot read {path}")


def inventory(spark: SparkSession, roots: Sequence[str] | str, pattern: str = "*") -> DataFrame:
    """path, length, modified of all files below the roots, once each; contents are not read. Empty files are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(roots)
    return files.select("path", "length", F.col("modificationTime").alias("modified")).dropDuplicates(["path"])


def content_hashes(files: DataFrame, piece: int = 64 << 20) -> DataFrame:
    """files (path, length) with sha256: of the SHA-256s (hex, joined) of the file's pieces of `piece` bytes, in order.

    A piece is a row, so that a large file is many tasks; pieces are read by pyarrow's file systems, by the file's URI. A file that can't be read, or ends early, is null.
    """
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("length") / piece) - 1, F.lit(0).cast("long"))))
    pieces = files.select("path", "length", at.alias("_k"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path, length, k in zip(*(c.to_pylist() for c in batch.columns)):
                size = min(piece, length - k * piece)
                try:
                    fs, place = FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
                    with fs.open_input_file(place) as file:
                        file.seek(k * piece)
                        data = file.read(size)
                    found.append(hashlib.sha256(data).hexdigest() if len(data) == size else None)
                except OSError:
                    found.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=["path", "length", "_k", "_h"])

    n = max(1, pieces.count())
    hashed = pieces.repartition(min(n, 10_000)).mapInArrow(run, "path string, length long, _k long, _h string")
    whole = hashed.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_k", "_h"))), lambda x: x["_h"]), "").alias("_t"), F.count_if(F.col("_h").isNull()).alias("_lost"))
    return files.join(whole.select("path", F.when(F.col("_lost") == 0, F.sha2("_t", 256)).alias("sha256")), "path", "left")


def preferred(files: DataFrame, extension: str = ".dcm", never: str = "DICOMDIR") -> DataFrame:
    """Files with the extension in folders that have any, otherwise all but the excluded name."""
    files = files.filter(~F.upper(F.regexp_extract("path", "([^/]*)$", 1)).eqNullSafe(never))
    yes = F.lower("path").endswith(extension)
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    has = files.filter(yes).select(folder.alias("_f")).distinct().withColumn("_has", F.lit(True))
    return files.withColumn("_f", folder).join(has, "_f", "left").filter(F.col("_has").isNull() | yes).drop("_f", "_has")


def tags_long(df: DataFrame, json: str, key: str) -> DataFrame:
    """key, tag, value for each tag of a JSON column."""
    return df.select(key, F.explode(F.from_json(json, "map<string,string>")).alias("tag", "value"))


def snapshot(df: DataFrame, series: str, n: int, seed: int = 0) -> DataFrame:
    """One row of each of n series, that of the least hash, and the series of the least hashes under a seed; blank texts are null."""
    row = F.md5(F.concat_ws("|", *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("-")) for c in df.columns)))
    one = df.groupBy(series).agg(*(F.min_by(c, row).alias(c) for c in df.columns if c != series))
    picked = one.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(series).cast("string"))), series).limit(n)
    return picked.select(*(F.nullif(F.trim(c), F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in picked.dtypes))


def save_snapshot(df: DataFrame, path: str, series: str, n: int, seed: int = 0) -> int:
    """snapshot() as published lines of JSON, a row each; null cells leave no trace."""
    return publish(snapshot(df, series, n, seed), path, "json")


def archive_uri(outer: Column, members: Sequence[Column]) -> Column:
    return F.concat(F.lit("archive://"), F.concat_ws("!", *(F.regexp_replace(F.url_encode(p), r"\+", "%20") for p in (outer, *members))))


def archive_parts(uri: Column) -> Column:
    """Outer path and members of an archive URI, null for other texts."""
    parts = F.transform(F.split(F.substring(uri, 11, 10_000_000), "!"), lambda p: F.url_decode(p))
    return F.when(uri.startswith("archive://"), parts)


def reference_rows(df: DataFrame, file: str, pattern: str, names: Sequence[str], date: str) -> DataFrame:
    """Keys taken from a file name by groups of a pattern, dates of 8 digits or ISO."""
    keys = {n: F.nullif(F.regexp_extract(file, pattern, i), F.lit("")) for i, n in enumerate(names, 1)}
    return df.withColumns({**keys, date: F.coalesce(F.try_to_date(date, "yyyyMMdd"), F.try_to_date(date, "yyyy-MM-dd"))})


def save(df: DataFrame, path: str, kind: str = "parquet") -> int:
    """Replaces the table at a path, or leaves the one that is there if the job fails; readers of this module find the current version. Gives its number."""
    return publish(df, path, kind, **({"header": "true"} if kind == "csv" else {}))


def save_selection(tables: Mapping[str, DataFrame], paths: Mapping[str, str], kind: str = "parquet") -> None:
    """The long, wide and unresolved tables: all are written before the first is replaced. Two that would go to one place are an error before anything is written."""
    if len(set(paths.values())) < len(paths):
        raise ValueError("two tables would be written to one path")
    publish_all({path: tables[name] for name, path in paths.items()}, kind, **({"header": "true"} if kind == "csv" else {}))


def save_errors(errors: DataFrame, path: str) -> int:
    """The table of failed rows of the last run: replaced by every run, and empty after one without failures. Gives how many rows it has."""
    publish(errors, path)
    return published(errors.sparkSession, path).count()


def append(df: DataFrame, path: str) -> None:
    """A part with maybe more columns than before; read_appended gives the union of columns."""
    df.write.mode("append").parquet(path)


def read_appended(spark: SparkSession, path: str, key: str, order: str) -> DataFrame:
    """All parts by union of columns, the last row of each key by `order`."""
    from stratiform.operators.ordering import top

    return top(spark.read.option("mergeSchema", True).parquet(path), [key], [F.desc(order)])


def index_rows(index: DataFrame, collection: str, modalities: Sequence[str], patients: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of an external index (columns: collection, modality, patient and two more) for the patients (one column), and the patients that it lacks."""
    c, m, p = (F.col(f"`{x}`") for x in columns[:3])
    found = index.filter((F.lower(c) == collection.lower()) & m.isin(*modalities)).select([f"`{x}`" for x in columns])
    wanted = patients.select(F.col(patients.columns[0]).alias(columns[2])).distinct()
    found = found.join(wanted, columns[2], "left_semi").select([f"`{x}`" for x in columns])
    return found, wanted.join(found.select(f"`{columns[2]}`"), columns[2], "left_anti")
