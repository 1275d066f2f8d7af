"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession


_LOCAL: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in spark.checkpoint.dir. Only a purely local session may do without the setting: it gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master, app = spark.sparkContext.master, spark.sparkContext.applicationId
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if app not in _LOCAL:
            _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="spark-")
        base = _LOCAL[app]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Rows of a partition that spread() aims at: wide rows go through several sorts of a task at once.
ROWS = 50_000


def spread(df: DataFrame, *by: str | Column, rows: int = ROWS, count: int | None = None) -> DataFrame:
    """df dealt by columns to partitions of some `rows` rows, counted first unless the count is given: as a table grows there are more tasks, not larger ones.

    The number is given, so adaptive execution doesn't join partitions that are small on disk only; a session's parallelism is the least.
    """
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-(df.count() if count is None else count) // rows))
    return df.repartition(n, *by)


def written_at(df: DataFrame, name: str = "table", by: Sequence[str] = ()) -> tuple[DataFrame, str]:
    """df as a Parquet table in the shared folder (in a folder for each value of the columns `by`), and its path."""
    path = scratch(df.sparkSession, name)
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str = "table", by: Sequence[str] = ()) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage, and lost executors don't matter to later reads."""
    return written_at(df, name, by)[0]


def discard(spark: SparkSession, *paths: str) -> None:
    """Deletes tables that written_at() made and nothing reads any more."""
    conf = spark._jsc.hadoopConfiguration()
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
