"""Exact Euclidean distances on voxel tables: three passes along lines of voxels, each the lower envelope of parabolas.

A pass deals lines of one axis to tasks, sorts them there and replaces each value f by the least f(q) + (p - q)**2 of its line. After a pass along each axis
a voxel has the squared distance to the nearest feature. A line is as long as an image is wide, so no task holds more than some lines at a
time, however large or many the images are; the lines of a batch go through the envelope side by side.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

XYZ = ["x", "y", "z"]
#: Lines that go through the envelope together.
LINES = 512


def envelope(f: np.ndarray, p: np.ndarray) -> np.ndarray:
    """For each row of f the least f[q] + (p - p[q])**2 at each place p; places ascend, infinite values are no parabolas."""
    lines, n = f.shape
    every = np.arange(lines)
    hull, cut, top = np.zeros((lines, n), np.int64), np.full((lines, n + 1), -np.inf), np.full(lines, -1)
    raised = f + p * p
    for q in range(n):
        on = np.flatnonzero(np.isfinite(f[:, q]))
        begin, todo = np.full(lines, -np.inf), on
        while len(todo := todo[top[todo] >= 0]):
            last = hull[todo, top[todo]]
            meet = (raised[todo, q] - raised[todo, last]) / (2 * (p[todo, q] - p[todo, last]))
            hidden = meet <= cut[todo, top[todo]]
            begin[todo[~hidden]] = meet[~hidden]
            todo = todo[hidden]
            top[todo] -= 1
        top[on] += 1
        hull[on, top[on]], cut[on, top[on]] = q, begin[on]
    out, at = np.full((lines, n), np.inf), np.zeros(lines, np.int64)
    some = top >= 0
    for q in range(n):
        while (ahead := some & (at < top) & (cut[every, at + 1] < p[:, q])).any():
            at[ahead] += 1
        best = hull[every, at]
        out[some, q] = (f[every, best] + (p[:, q] - p[every, best]) ** 2)[some]
    return out


def _changes(column: pa.ChunkedArray) -> np.ndarray:
    """Where a value differs from the one before."""
    a, b = column[1:], column[:-1]
    return pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy()


def _passed(table: pa.Table, starts: np.ndarray, scale: float) -> pa.Array:
    """The new values of whole lines, whose first rows are `starts`."""
    place, value = table.column(-2).to_numpy().astype(float) * scale, table.column(-1).to_numpy()
    out, ends = np.empty(len(value)), np.append(starts[1:], len(value))
    for k in range(0, len(starts), LINES):
        a, size = starts[k : k + LINES], (ends - starts)[k : k + LINES]
        within = np.arange(size.max())
        there = within < size[:, None]
        rows = np.minimum(a[:, None] + within, len(value) - 1)
        out[rows[there]] = envelope(np.where(there, value[rows], np.inf), place[rows])[there]
    return pa.array(out)


def _along(df: DataFrame, by: Sequence[str], axis: str, scale: float) -> DataFrame:
    line = [*by, *(c for c in XYZ if c != axis)]
    rows = df.select(*line, axis, "d2").repartition(*line).sortWithinPartitions(*line, axis)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]) if held is not None else table
            changed = np.zeros(max(held.num_rows - 1, 0), bool)
            for i in range(len(line)):
                changed |= _changes(held.column(i))
            starts = np.append(0, np.flatnonzero(changed) + 1)
            if len(starts) > 1:  # the last line may go on
                whole = held.slice(0, starts[-1])
                yield from whole.set_column(len(line) + 1, "d2", _passed(whole, starts[:-1], scale)).to_batches()
                held = held.slice(starts[-1])
        if held is not None and held.num_rows:
            yield from held.set_column(len(line) + 1, "d2", _passed(held, np.zeros(1, np.int64), scale)).to_batches()

    return rows.mapInArrow(run, rows.schema)


def squared_distances(features: DataFrame, grid: DataFrame, spacing: Sequence[float] = (1, 1, 1), by: Sequence[str] = ("scan_id",)) -> DataFrame:
    """by, x, y, z of the grid and d2, the squared distance to the nearest feature of the same image that is in the grid; infinite where it has none."""
    key = [*by, *XYZ]
    there = features.select(key).distinct().withColumn("_f", F.lit(0.0))
    rows = grid.select(key).join(there, key, "left").select(*key, F.coalesce("_f", F.lit(float("inf"))).alias("d2"))
    for axis, scale in sorted(zip(XYZ, spacing), reverse=True):
        rows = _along(rows, by, axis, float(scale))
    return rows.select(*key, "d2")


def signed_distances(mask: DataFrame, grid: DataFrame, spacing: Sequence[float] = (1, 1, 1), by: Sequence[str] = ("scan_id",)) -> DataFrame:
    """by, x, y, z of the grid and value: the distance to the nearest voxel of the mask, or within it minus the distance to the nearest other voxel.

    Zero lies between the voxels of the two sides. An image without a mask is infinitely far, one filled by it minus infinity.
    """
    key = [*by, *XYZ]
    inside = mask.select(key).distinct()
    outside = grid.select(key).join(inside, key, "left_anti")
    near = squared_distances(inside, grid, spacing, by).withColumnRenamed("d2", "_in")
    far = squared_distances(outside, grid, spacing, by).withColumnRenamed("d2", "_out")
    return near.join(far, key).select(*key, F.when(F.col("_in") > 0, F.sqrt("_in")).otherwise(-F.sqrt("_out")).alias("value"))
