"""Published tables, the index of last rows, error tables and fingerprints."""

import hashlib
import tempfile
import threading

import pytest
from pyspark.sql import functions as F

from stratiform.operators import errors, incremental
from stratiform.sources import publish as P
from stratiform.sources import tables as S
from stratiform.streaming.index import merge_batch, read_index


def test_published_tables(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    assert P.version(spark, path) == 0 and P.load_state(spark, path) is None
    with pytest.raises(FileNotFoundError):
        P.published(spark, path)
    df = spark.range(10).withColumn("s", F.lit("a,b"))
    assert P.publish(df, path) == 1 and P.publish(df.filter("id < 3"), path, "csv", header="true") == 2
    assert P.published(spark, path).count() == 3 and P.published(spark, path).dtypes == df.dtypes and P.published(spark, path, 1).count() == 10
    failing = df.withColumn("s", F.when(F.col("id") == 9, F.raise_error(F.lit("stop"))).otherwise("x"))
    with pytest.raises(Exception, match="stop"):
        P.publish(failing, path)
    with pytest.raises(Exception, match="stop"):  # the first table is written, but none is put in place
        P.publish_all({path: df, f"{path}2": failing})
    assert P.version(spark, path) == 2 and P.version(spark, f"{path}2") == 0 and len(list((tmp_path / "t/_versions").iterdir())) == 2
    with pytest.raises(P.Conflict):
        P.publish(df, path, expected=1)
    assert P.publish(P.published(spark, path).filter("id = 0"), path, expected=2) == 3 and P.published(spark, path).count() == 1
    assert P.vacuum(spark, path, keep=1) == 2 and P.published(spark, path).count() == 1 and len(list((tmp_path / "t/_versions").iterdir())) == 1


def test_two_writers(spark, tmp_path):
    """All of several writers are heard, each in a version of its own; of those that expect one version a single one is."""
    path = f"file://{tmp_path}/state"
    writers = [threading.Thread(target=lambda k=k: P.save_state(spark, path, {"writer": k})) for k in range(6)]
    [t.start() for t in writers]
    [t.join() for t in writers]
    assert P.version(spark, path) == 6 and {P._manifest(spark, path, n)["state"]["writer"] for n in range(1, 7)} == set(range(6))
    assert not P._put(spark, path, 6, {"state": {}})  # a number that is taken stays as it is
    assert P.save_state(spark, path, {"writer": 9}, expected=6) == 7
    with pytest.raises(P.Conflict):
        P.save_state(spark, path, {"writer": 10}, expected=6)
    assert P.load_state(spark, path) == {"writer": 9}


def test_selection_is_saved_whole(spark, tmp_path):
    a, bad = spark.range(3), spark.range(3).withColumn("x", F.raise_error(F.lit("stop")).cast("string"))
    paths = {n: f"file://{tmp_path}/{n}.csv" for n in ("long", "wide")}
    S.save_selection({"long": a, "wide": a}, paths, "csv")
    with pytest.raises(Exception, match="stop"):
        S.save_selection({"long": a.limit(0), "wide": bad}, paths, "csv")
    assert [S.load(spark, p).count() for p in paths.values()] == [3, 3] and S.read_all(spark, list(paths.values())).count() == 6
    none = spark.createDataFrame([], "id long, error_message string")
    assert S.save_errors(none.union(spark.createDataFrame([(1, "m")], none.schema)), f"file://{tmp_path}/e") == 1 and S.save_errors(none, f"file://{tmp_path}/e") == 0


def test_index_of_last_rows(spark, tmp_path):
    target = f"file://{tmp_path}/index"
    with pytest.raises(FileNotFoundError):
        read_index(spark, target)
    one = spark.createDataFrame([(k, 0, k % 3) for k in range(50)] + [(0, 0, 7), (None, 0, 1)], "id long, batch int, v int")
    assert merge_batch(one, target, ["id"], ["v"], 0, 8)
    before = P.current(spark, target)["folders"]
    assert merge_batch(spark.createDataFrame([(3, 1, -5, "x"), (99, 1, 0, None)], "id long, batch int, v int, more string"), target, ["id"], ["v"], 1)
    after = P.current(spark, target)["folders"]
    assert 1 <= sum(before.get(b) != f for b, f in after.items()) <= 2  # only the buckets of the batch are written anew
    for number in (0, 1):
        assert not merge_batch(one.limit(3), target, ["id"], ["v"], number)
    assert merge_batch(one.limit(0), target, ["id"], ["v"], 2)
    got = {r["id"]: tuple(r)[1:] for r in read_index(spark, target).select("id", "batch", "v", "more").collect()}
    assert len(got) == 52 and got[3] == (1, -5, "x") and got[0] == (0, 7, None) and got[None] == (0, 1, None) and got[99] == (1, 0, None)


def test_error_tables(spark):
    calls = spark.sparkContext.accumulator(0)

    def odd(a, b):
        calls.add(1)
        if b is None:
            raise KeyError("b")
        return a + 1, b * 2

    df = spark.createDataFrame([(1, "x", "o"), (2, None, "o"), (3, "", "o")], "id long, b string, error_message string")
    good, bad = errors.parted(errors.hooked(df, odd, ["id", "b"], {"next": "long", "twice": "string"}, "record"))
    assert [tuple(r) for r in good.orderBy("id").collect()] == [(1, "x", 2, "xx"), (3, "", 4, "")] and good.count() + bad.count() == 3
    assert [(r["id"], r["next"], r["error_message"]) for r in bad.collect()] == [(2, None, "KeyError: 'b'")]
    assert calls.value == 3  # both tables come from one evaluation
    back = errors.joined_back(df, errors.any_error({"hook": bad, "again": bad}, "id"), "id")
    assert {r["id"]: r["error_message"] for r in back.collect()} == {1: None, 2: "KeyError: 'b' | KeyError: 'b'", 3: None}
    with pytest.raises(Exception, match="KeyError"):
        errors.hooked(df, odd, ["id", "b"], {"next": "long", "twice": "string"}).collect()
    with pytest.raises(Exception, match="1 values for"):
        errors.hooked(df, lambda a: a, ["id"], {"x": "long", "y": "long"}).collect()
    read = errors.checked(df, {"n": (F.expr("try_cast(b as int)"), F.col("b"))}).orderBy("id").collect()
    assert [(r["n"], r["error_message"]) for r in read] == [(None, "n: cannot read x"), (None, None), (None, None)]


def test_content_hashes(spark, tmp_path):
    texts = {"empty": b"", "short": b"abc", "even": b"x" * 20, "long": bytes(range(256)) * 5}
    for name, data in texts.items():
        (tmp_path / name).write_bytes(data)
    files = S.inventory(spark, f"file://{tmp_path}")  # Spark lists no empty files
    files = files.union(spark.createDataFrame([(f"file://{tmp_path}/empty", 0, None)], files.schema))
    tree = lambda d: hashlib.sha256("".join(hashlib.sha256(d[i : i + 10]).hexdigest() for i in range(0, max(len(d), 1), 10)).encode()).hexdigest()
    got = {r["path"].rsplit("/", 1)[1]: r["sha256"] for r in S.content_hashes(files, 10).collect()}
    assert got == {n: tree(d) for n, d in texts.items()}
    gone = files.filter("path like '%short'").withColumn("path", F.concat("path", F.lit("-not-there"))).union(files.filter("path like '%even'").withColumn("length", F.lit(25).cast("long")))
    assert {r["sha256"] for r in S.content_hashes(gone, 10).collect()} == {None} and S.content_hashes(files.limit(0)).count() == 0


def test_fingerprints_of_cells_and_tables(spark):
    inventory = spark.createDataFrame([("a", 1, 10, "h1"), ("b", 2, 20, "h2")], "path string, length long, modified long, sha256 string")
    cells = spark.createDataFrame([(1, ["a", "b"]), (2, ["b", "a"]), (3, ["a", "c"]), (4, []), (5, None), (6, ["a", None, "b"])], "id int, cells array<string>")
    one = {r["id"]: r["artifact_sha256"] for r in incremental.cell_hashes(cells, "id", "cells", inventory).collect()}
    assert len({one[k] for k in (1, 2, 3, 4)}) == 4 and one[4] == one[5] and one[1] == one[6]
    other = inventory.withColumn("sha256", F.lit("h3")).withColumn("modified", F.lit(0).cast("long"))
    assert {r["id"]: r["artifact_sha256"] for r in incremental.cell_hashes(cells, "id", "cells", other).collect()}[1] != one[1]
    strict = [{r["id"]: r["artifact_sha256"] for r in incremental.cell_hashes(cells, "id", "cells", i, True).collect()}[1] for i in (inventory, inventory.withColumn("modified", F.lit(0).cast("long")), other)]
    assert strict[0] == strict[1] != strict[2]
    plain = spark.createDataFrame([(1, "a")], "id int, cells string")
    assert incremental.cell_hashes(plain, "id", "cells", inventory).count() == 1

    df = spark.range(200).withColumn("v", F.col("id") * 2)
    leaves = incremental.bucket_hashes(df, ["id"], ["v"], 16)
    same = incremental.bucket_hashes(df.repartition(5).orderBy(F.desc("id")), ["id"], ["v"], 16)
    assert incremental.changed_buckets(leaves, same).count() == 0 and incremental.table_hash(leaves).first() == incremental.table_hash(same).first()
    now = df.filter("id <> 7").withColumn("v", F.when(F.col("id") == 9, 0).otherwise(F.col("v"))).union(spark.createDataFrame([(500, 1)], "id long, v long"))
    assert 1 <= incremental.changed_buckets(leaves, incremental.bucket_hashes(now, ["id"], ["v"], 16)).count() <= 3
    assert sorted(tuple(r) for r in incremental.changed_rows(df, now, ["id"], ["v"], 16).collect()) == [(7, "gone"), (9, "changed"), (500, "new")]


def test_a_large_bucket_is_several_files(spark, monkeypatch):
    """A bucket's rows are sorted and written by as many tasks as they need; the last row of each key stays."""
    from stratiform.streaming import index

    monkeypatch.setattr(index, "ROWS", 100)
    target = tempfile.mkdtemp(prefix="spark-")
    rows = spark.range(2_000).selectExpr("id as k", "id % 7 as v")
    assert index.merge_batch(rows, target, ["k"], ["v"], 0, 2)
    assert index.merge_batch(rows.filter("k % 2 = 0").selectExpr("k", "v + 10 as v"), target, ["k"], ["v"], 1, 2)
    out = index.read_index(spark, target)
    assert len(out.inputFiles()) > 4
    assert out.count() == 2_000 and out.filter("v = k % 7 + if(k % 2 = 0, 10, 0)").count() == 2_000
