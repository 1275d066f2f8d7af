"""Tables that are replaced as a whole: versions in folders of their own, and a manifest that names the current one and is put in place last.

    <path>/_versions/<random>/...       the data of a version, written by an ordinary Spark job
    <path>/_manifests/<number>.json     what the version with this number is

A job that fails leaves no manifest, so readers stay with the version before. A manifest is written under another name and renamed without
overwriting, so of two writers that finish together one gets the number and the other takes the next (or, if it expected a certain version, an error).
Readers take the manifest with the highest number; a version stays readable until vacuum() takes it away. Whole states (settings, counts) are
manifests without data. Only names and small texts pass through the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_VERSIONS, _MANIFESTS = "_versions", "_manifests"


class Conflict(RuntimeError):
    """Another writer has published since the version that this one started from."""


def _place(spark: SparkSession, path: str):  # noqa: ANN202  a JVM path and its file system
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    place, fs = _place(spark, f"{path}/{_MANIFESTS}")
    if not fs.exists(place):
        return []
    names = (str(s.getPath().getName()) for s in fs.listStatus(place))
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def _manifest(spark: SparkSession, path: str, number: int) -> dict[str, Any]:
    return json.loads("\n".join(r[0] for r in spark.read.text(f"{path}/{_MANIFESTS}/{number:012d}.json", wholetext=True).collect()))


def _put(spark: SparkSession, path: str, number: int, content: Mapping[str, Any]) -> bool:
    """Puts a manifest in place; false if its number is taken."""
    jvm = spark._jvm
    draft, fs = _place(spark, f"{path}/{_MANIFESTS}/.{uuid.uuid4().hex}")
    final, _ = _place(spark, f"{path}/{_MANIFESTS}/{number:012d}.json")
    out = fs.create(draft, False)
    out.write(json.dumps(content, sort_keys=True).encode())
    out.close()
    never = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    never[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(draft), fs.makeQualified(final), never)
        return True
    except Exception as e:  # noqa: BLE001  Py4J hands over what the JVM threw
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in str(getattr(e, "java_exception", e)):
            return False
        raise


def settle(spark: SparkSession, path: str, content: Mapping[str, Any], expected: int | None) -> int:
    """Puts a manifest in place as the next version, or as the one after `expected`; gives its number."""
    if expected is not None:
        if version(spark, path) == expected and _put(spark, path, expected + 1, content):
            return expected + 1
        raise Conflict(f"{path} is no longer at version {expected}")
    while not _put(spark, path, number := version(spark, path) + 1, content):
        pass
    return number


def version(spark: SparkSession, path: str) -> int:
    """The number of the current version, 0 if there is none."""
    return max(_numbers(spark, path), default=0)


def publish_all(tables: Mapping[str, DataFrame], kind: str = "parquet", expected: int | None = None, **options: Any) -> dict[str, int]:
    """Publishes several tables by path: all are written before the first is put in place, so a failing job changes none of them. Gives their versions."""
    drafts: dict[str, dict[str, Any]] = {}
    done: dict[str, int] = {}
    try:
        for path, df in tables.items():
            drafts[path] = {"folder": uuid.uuid4().hex, "kind": kind, "options": options, "schema": df.schema.jsonValue()}
            df.write.format(kind).options(**options).save(f"{path}/{_VERSIONS}/{drafts[path]['folder']}")
        for path, draft in drafts.items():
            done[path] = settle(tables[path].sparkSession, path, draft, expected)
    finally:
        for path in drafts.keys() - done.keys():
            place, fs = _place(tables[path].sparkSession, f"{path}/{_VERSIONS}/{drafts[path]['folder']}")
            fs.delete(place, True)
    return done


def publish(df: DataFrame, path: str, kind: str = "parquet", expected: int | None = None, **options: Any) -> int:
    """Replaces the table at a path by df, which may come from that table; gives the new version. With `expected` only if that is still the current one."""
    return publish_all({path: df}, kind, expected, **options)[path]


def resolved(spark: SparkSession, path: str, number: int | None = None) -> str:
    """The folder with the data of a published table; any other path as it is."""
    number = number or version(spark, path)
    return f"{path}/{_VERSIONS}/{_manifest(spark, path, number)['folder']}" if number else path


def published(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The current (or an earlier) version of a published table, with the schema it was written with."""
    number = number or version(spark, path)
    if not number:
        raise FileNotFoundError(f"nothing is published at {path}")
    m = _manifest(spark, path, number)
    return spark.read.format(m["kind"]).schema(T.StructType.fromJson(m["schema"])).options(**m["options"]).load(f"{path}/{_VERSIONS}/{m['folder']}")


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Takes away all but the last `keep` versions and their data; gives how many. Data that no manifest names may be a running job's and stays."""
    gone = _numbers(spark, path)[:-keep]
    for number in gone:
        folder = _manifest(spark, path, number).get("folder")
        for name in (f"{_MANIFESTS}/{number:012d}.json", *([f"{_VERSIONS}/{folder}"] if folder else [])):
            place, fs = _place(spark, f"{path}/{name}")
            fs.delete(place, True)
    return len(gone)


def current(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """The current manifest, None if there is none."""
    number = version(spark, path)
    return _manifest(spark, path, number) if number else None


def save_state(spark: SparkSession, path: str, state: Mapping[str, Any], expected: int | None = None) -> int:
    """A small JSON object as the new state at a path."""
    return settle(spark, path, {"state": dict(state)}, expected)


def load_state(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """The current state at a path, None if there is none."""
    number = version(spark, path)
    return _manifest(spark, path, number)["state"] if number else None
