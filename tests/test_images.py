"""Distances and mask quality against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratiform.operators import voxels as X
from stratiform.operators.distance import envelope, signed_distances, squared_distances
from stratiform.operators.imaging import mask_program


def test_envelope():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 40):
        f = np.where(rng.random((60, n)) < 0.5, np.inf, rng.integers(0, 50, (60, n)).astype(float))
        p = np.sort(rng.choice(200, (60, n)) + np.arange(n) * 200, axis=1) * 0.5
        want = (f[:, None, :] + (p[:, :, None] - p[:, None, :]) ** 2).min(axis=2)
        assert np.array_equal(envelope(f, p), want)


@pytest.mark.parametrize("spacing", [(1, 1, 1), (0.7, 2.5, 1.3)])
def test_distances(spark, spacing):
    """Images of several shapes with gaps in the grid, keys of two columns, features outside the grid; batches that cut lines."""
    rng = random.Random(4)
    grid, features = [], []
    for scan, rater, shape in (("a", None, (9, 7, 5)), ("a", "r", (1, 1, 30)), ("b", "r", (6, 1, 1)), ("full", "r", (2, 2, 2)), ("none", "r", (3, 2, 2))):
        for x in range(shape[0]):
            for y in range(shape[1]):
                for z in range(shape[2]):
                    if scan == "full" or rng.random() < 0.9:
                        grid.append((scan, rater, x - 3, y, z))
                        if scan == "full" or (scan != "none" and rng.random() < 0.15):
                            features.append(grid[-1])
    g = spark.createDataFrame(grid, "scan_id string, rater string, x int, y int, z int")
    f = spark.createDataFrame([*features, *features[:5], ("b", "r", 99, 9, 9)], g.schema)
    near = lambda v, others: min((sum(((a - b) * s) ** 2 for a, b, s in zip(v[2:], o[2:], spacing)) for o in others if o[:2] == v[:2]), default=math.inf)
    inside, known = set(features), [v for v in grid if v[1] is not None]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 11)
    try:
        got = {tuple(r)[:5]: r["d2"] for r in squared_distances(f, g, spacing, ("scan_id", "rater")).filter("rater is not null").collect()}
        signed = {tuple(r)[:5]: r["value"] for r in signed_distances(f, g, spacing, ("scan_id", "rater")).filter("rater is not null").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(known) == len(signed)
    for v in known:
        assert got[v] == pytest.approx(near(v, features))
        assert signed[v] == pytest.approx(-math.sqrt(near(v, [o for o in grid if o not in inside])) if v in inside else math.sqrt(near(v, features)))
    assert squared_distances(f.limit(0), g.limit(0), spacing, ("scan_id", "rater")).collect() == []


def test_morphology_by_distance(spark):
    """Against balls around every voxel, with radii of several voxels."""
    rng = random.Random(9)
    grid = [("s", x, y, z) for x in range(8) for y in range(7) for z in range(6)]
    mask = [v for v in grid if rng.random() < 0.4]
    g, m = (spark.createDataFrame(r, "scan_id string, x int, y int, z int") for r in (grid, mask))
    near = lambda v, others, r, s: any(sum(((a - b) * k) ** 2 for a, b, k in zip(v[1:], o[1:], s)) <= r * r + 1e-9 for o in others)
    for r, s in ((1.0, (1, 1, 1)), (2.2, (1, 1.5, 0.5))):
        dilated = {v for v in grid if near(v, mask, r, s)}
        eroded = {v for v in mask if not near(v, [o for o in grid if o not in set(mask)], r, s)}
        assert {tuple(x) for x in X.morphology(m, g, "dilate", r, s).collect()} == dilated
        assert {tuple(x) for x in X.morphology(m, g, "erode", r, s).collect()} == eroded
        assert {tuple(x) for x in X.morphology(m, g, "open", r, s).collect()} == {v for v in grid if near(v, eroded, r, s)}
    assert X.morphology(m, g, "close", 0.0).count() == len(mask)


def test_fused_organs(spark):
    """One rater far off doesn't move what two others agree on; an anchor counts alone; voxels that nobody saw are absent."""
    seen = [("s", r, x, 0, 0) for r in "abc" for x in range(12) if not (r == "b" and x == 11) and x != 3]
    masks = [("s", r, x, 0, 0) for r, (low, high) in {"a": (4, 7), "b": (4, 7), "c": (9, 11)}.items() for x in range(low, high + 1) if ("s", r, x, 0, 0) in seen]
    c, m = (spark.createDataFrame(x, "scan_id string, rater string, x int, y int, z int") for x in (seen, masks))
    got = {r["x"]: r for r in X.fuse_organs(m, c).collect()}
    assert [x for x, r in sorted(got.items()) if r["fused"]] == [4, 5, 6, 7] and 3 not in got and got[11]["observed"] == 2 and got[9]["probability"] == 1 / 3
    assert [r["x"] for r in X.fuse_organs(m, c, anchor="c").filter("fused").orderBy("x").collect()] == [9, 10, 11]


def test_mask_quality(spark):
    cube = lambda *r: [(x, y, z) for x in range(*r[0]) for y in range(*r[1]) for z in range(*r[2])]
    ball = [(x, y, z) for x, y, z in cube((2, 15), (2, 15), (2, 15)) if (x - 8) ** 2 + (y - 8) ** 2 + (z - 8) ** 2 <= 30]
    scans = {"ball": ball, "cut": [v for v in ball if v[2] <= 8], "edge": cube((0, 3), (5, 6), (5, 6)) + cube((1, 2), (4, 7), (4, 7)), "few": ball[:3], "empty": [], "parts": ball + cube((15, 17), (0, 13), (0, 13)), "all": cube((0, 17), (0, 17), (0, 17))}
    grid = spark.createDataFrame([(s, *v) for s in scans for v in cube((0, 17), (0, 17), (0, 17))], "scan_id string, x int, y int, z int")
    mask = spark.createDataFrame([(s, *v) for s, vs in scans.items() for v in vs], "scan_id string, x int, y int, z int")
    got = {r["scan_id"]: r for r in X.mask_quality(mask, grid, (1, 1, 2)).collect()}
    assert {s: (r["status"], r["reasons"]) for s, r in got.items()} == {
        "ball": ("complete", []), "cut": ("partial", ["straight_side"]), "edge": ("partial", []), "few": ("invalid", ["insufficient_foreground"]), "empty": ("invalid", ["empty"]), "parts": ("invalid", ["fragmented"]), "all": ("invalid", ["fills_entire_fov"]),
    }
    assert got["ball"]["volume"] == 2 * len(ball) and got["ball"]["largest_share"] == 1 and got["empty"]["x0"] is None and got["edge"]["touch_x0"] > 0


def test_masks_of_unlike_grids(spark):
    masks = spark.createDataFrame([("s", "a", 0, 0, 0), ("s", "b", 0, 0, 0), ("t", "a", 0, 0, 0), ("t", "b", 1, 0, 0)], "scan_id string, mask string, x int, y int, z int")
    grid = spark.createDataFrame([(s, x, 0, 0) for s in "st" for x in range(2)], "scan_id string, x int, y int, z int")
    shapes = spark.createDataFrame([(s, m, [2, 1, 1], 1.0) for s in "st" for m in "ab"], "scan_id string, mask string, shape array<int>, spacing double")
    union = [{"op": "union", "inputs": ["a", "b"], "output": "u"}]
    assert mask_program(masks, grid, union, shapes).filter("mask = 'u'").count() == 3
    other = shapes.withColumn("spacing", F.when((F.col("scan_id") == "t") & (F.col("mask") == "b"), 2.0).otherwise(F.col("spacing")))
    with pytest.raises(ValueError, match="operation 0.*union.*t"):
        mask_program(masks, grid, union, other)
    with pytest.raises(ValueError, match="outside the grid"):
        mask_program(masks.union(spark.createDataFrame([("s", "a", 5, 0, 0)], masks.schema)), grid, union)
    with pytest.raises(ValueError, match="c"):
        mask_program(masks, grid, [{"op": "union", "inputs": ["a", "c"], "output": "u"}])
