"""Masks and images as long tables: mask(scan_id, mask, x, y, z) of foreground voxels, voxels(scan_id, x, y, z, value)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratiform.operators.distance import XYZ, signed_distances, squared_distances
from stratiform.operators.ranks import percentiles, same
from stratiform.shared import discard, written_at

VOXEL = ["scan_id", *XYZ]


def combine(masks: DataFrame, names: Sequence[str], how: str, grid: DataFrame | None = None) -> DataFrame:
    """union, intersection, xor, difference (first without the others) or not (the grid without the first), by one grouping of voxels."""
    if how == "not":
        return grid.select(VOXEL).join(masks.filter(F.col("mask") == names[0]).select(VOXEL), VOXEL, "left_anti")
    rows = masks.filter(F.col("mask").isin(*names))
    has = [F.max(F.when(F.col("mask") == n, 1).otherwise(0)) for n in names]
    hits = reduce(lambda a, b: a + b, has)
    keep = {"union": hits > 0, "intersection": hits == len(names), "xor": hits % 2 == 1, "difference": (has[0] == 1) & (hits == 1)}[how]
    return rows.groupBy(*VOXEL).agg(keep.alias("_keep")).filter("_keep").drop("_keep")


def dilate(mask: DataFrame, grid: DataFrame, radius: float, spacing: Sequence[float] = (1, 1, 1)) -> DataFrame:
    """Voxels of the grid within a radius of the mask; a radius under the spacing is the mask itself."""
    return squared_distances(mask, grid, spacing).filter(F.col("d2") <= radius**2 + 1e-9).select(VOXEL)


def erode(mask: DataFrame, grid: DataFrame, radius: float, spacing: Sequence[float] = (1, 1, 1)) -> DataFrame:
    """Voxels of the mask farther than a radius from all other voxels of the grid; what is beyond the grid doesn't count."""
    outside = grid.select(VOXEL).join(mask.select(VOXEL), VOXEL, "left_anti")
    return mask.select(VOXEL).join(squared_distances(outside, grid, spacing).filter(F.col("d2") > radius**2 + 1e-9).select(VOXEL), VOXEL, "left_semi")


def morphology(mask: DataFrame, grid: DataFrame, how: str, radius: float, spacing: Sequence[float] = (1, 1, 1), iterations: int = 1) -> DataFrame:
    plan = {"dilate": [dilate] * iterations, "erode": [erode] * iterations, "open": [erode] * iterations + [dilate] * iterations, "close": [dilate] * iterations + [erode] * iterations}[how]
    for f in plan if radius > 0 else ():
        mask = f(mask, grid, radius, spacing)
    return mask


def neighbours(connectivity: int) -> list[tuple[int, int, int]]:
    r = (-1, 0, 1)
    return [(i, j, k) for i in r for j in r for k in r if 0 < abs(i) + abs(j) + abs(k) <= connectivity]


class _Rounds:
    """Tables of a loop, written to the shared folder; each is deleted when its successors are written."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.name, self.paths = spark, name, {}

    def keep(self, df: DataFrame) -> DataFrame:
        out, path = written_at(df, self.name)
        self.paths[id(out)] = out, path  # with the table itself, so that its id stays taken
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        discard(self.spark, *(self.paths.pop(id(t))[1] for t in tables if t is not None))


def _merged(df: DataFrame) -> DataFrame:
    """df as the side of a join that is never sent whole to the driver and to every task: it has rows by voxel, run or scan."""
    return df.hint("merge")


#: Rows (of voxels, runs or edges) that a task of labelled() and its components takes, of either side of a join.
TASK_ROWS = 100_000


def _met(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], n: int, how: str = "inner") -> DataFrame:
    """Merge join of left and right (columns in pairs), both dealt to n tasks: adaptive execution would join partitions that are small on disk only."""
    dealt = left.repartition(n, *(a for a, _ in on)), _merged(right.repartition(n, *(b for _, b in on)))
    return dealt[0].join(dealt[1], [a for a, _ in on] if all(a == b for a, b in on) else reduce(lambda x, y: x & y, (F.col(a) == F.col(b) for a, b in on)), how)


def _tasks(df: DataFrame, rows: int) -> int:
    """Tasks for a table of so many rows; a session's parallelism is the least."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def _components(edges: DataFrame, rounds: _Rounds, n: int) -> DataFrame:
    """Connected components of edges (a, b): rows (node, component), the least node that each can reach; nodes without an edge are absent. The first round has n tasks.

    Every node takes its least neighbour, of two that take each other the lesser is a root, and pointers are doubled until all name a root. Then roots are
    the nodes. A tree has two nodes at least, so a round leaves at most half of them, and a round's doublings are the logarithm of its deepest tree.
    """
    live = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b")
    live = rounds.keep(live.repartition(n, "a", "b").distinct())
    found: DataFrame | None = None
    most = 0
    while (left := live.count()) or found is None:
        n = _tasks(live, left)
        most = max(most, n)  # of the first round, which has all nodes
        pick = rounds.keep(live.repartition(n, "a").groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up")))
        back = pick.select(F.col("node").alias("_n"), F.col("up").alias("_u"))
        mutual = (F.col("_u") == F.col("node")) & (F.col("node") < F.col("up"))
        tree = rounds.keep(_met(pick, back, [("up", "_n")], n).select("node", F.when(mutual, F.col("node")).otherwise(F.col("up")).alias("up")))
        rounds.drop(pick)
        moved = True
        while moved:
            step = _met(tree, tree.select(F.col("node").alias("_n"), F.col("up").alias("_u")), [("up", "_n")], n)
            step = rounds.keep(step.select("node", F.col("_u").alias("up"), (F.col("_u") != F.col("up")).alias("moved")))
            moved = step.filter("moved").limit(1).count() > 0
            rounds.drop(tree)
            tree = step
        root = tree.select(F.col("node").alias("_n"), F.col("up").alias("_u"))
        after = tree if found is None else rounds.keep(_met(found, root, [("up", "_n")], most, "left").select("node", F.coalesce("_u", "up").alias("up")))
        less = _met(_met(live, root, [("a", "_n")], n).select(F.col("_u").alias("a"), "b"), root, [("b", "_n")], n).select("a", F.col("_u").alias("b"))
        less = rounds.keep(less.filter("a <> b").repartition(n, "a", "b").distinct())
        rounds.drop(live, *([] if found is None else [found, tree]))
        live, found = less, after
    rounds.drop(live)
    least = found.groupBy(F.col("up").alias("_n")).agg(F.min("node").alias("component"))
    out = rounds.keep(_met(found, least, [("up", "_n")], most).select("node", "component"))
    rounds.drop(found)
    return out


def labelled(mask: DataFrame, connectivity: int = 1) -> DataFrame:
    """Connected components: each voxel takes the least voxel of its component as label.

    Runs along z come from a window; neighbouring voxels tie runs, and components of runs are contracted, so rounds grow with the logarithm of the runs,
    not with the way through a component. Every round is written to the shared folder, so lineage stays short and lost executors do no harm; rounds that are done with are deleted.
    Rows are counted, and each step has as many tasks as they need.
    """
    rounds = _Rounds(mask.sparkSession, "labels")
    mask = rounds.keep(mask.select(VOXEL))
    n = _tasks(mask, mask.count())
    along = W.partitionBy("scan_id", "x", "y").orderBy("z")
    starts = F.coalesce(F.col("z") - F.lag("z").over(along) > 1, F.lit(True))
    run = F.last(F.when(F.col("_s"), F.col("z")), True).over(along.rowsBetween(W.unboundedPreceding, 0))
    now = mask.repartition(n, "scan_id", "x", "y").withColumn("_s", starts).withColumn("_z", run)
    now = rounds.keep(now.select(*VOXEL, F.struct("scan_id", "x", "y", F.col("_z").alias("z")).alias("run")))
    rounds.drop(mask)
    steps = [s for s in neighbours(connectivity) if s[:2] > (0, 0)]  # along z the runs have done it, and one of two directions is enough
    near = F.explode(F.array(*(F.struct((F.col("x") + i).alias("x"), (F.col("y") + j).alias("y"), (F.col("z") + k).alias("z")) for i, j, k in steps)))
    sent = now.select("scan_id", F.col("run").alias("a"), near.alias("_p")).select("scan_id", "a", "_p.*")
    tied = _met(sent, now, [(c, c) for c in VOXEL], n * len(steps)).select("a", F.col("run").alias("b")).distinct()
    tied = _components(tied, rounds, n)
    out = _met(now, tied, [("run", "node")], n, "left").withColumn("_l", F.coalesce("component", "run"))
    done = rounds.keep(out.select(*VOXEL, F.struct(*(F.col(f"_l.{c}") for c in XYZ)).alias("label")))
    rounds.drop(now, tied)
    return done


def largest_component(mask: DataFrame, connectivity: int = 1) -> DataFrame:
    found = labelled(mask, connectivity)
    sizes = found.groupBy("scan_id", "label").agg(F.count("*").alias("n"))
    best = sizes.withColumn("_r", F.row_number().over(W.partitionBy("scan_id").orderBy(F.desc("n"), "label"))).filter("_r = 1")
    return found.join(_merged(best.select("scan_id", "label")), ["scan_id", "label"], "left_semi").select(VOXEL)


def fill_holes(mask: DataFrame, grid: DataFrame) -> DataFrame:
    """The mask and the background components that do not touch the grid's border."""
    box = grid.groupBy("scan_id").agg(*(f(c).alias(f"{c}{i}") for c in XYZ for i, f in ((0, F.min), (1, F.max))))
    back = labelled(grid.select(VOXEL).join(_merged(mask.select(VOXEL)), VOXEL, "left_anti"), 1).join(_merged(box), "scan_id")
    edge = reduce(lambda a, b: a | b, [(F.col(c) == F.col(f"{c}0")) | (F.col(c) == F.col(f"{c}1")) for c in XYZ])
    open_ = back.filter(edge).select("scan_id", "label").distinct()
    return mask.select(VOXEL).union(back.join(_merged(open_), ["scan_id", "label"], "left_anti").select(VOXEL))


def crop(voxels: DataFrame, masks: DataFrame, margin: int = 0) -> DataFrame:
    """Voxels inside the bounding box of all masks of their scan, grown by a margin (a box is one row per scan)."""
    box = masks.groupBy("scan_id").agg(*(f(c).alias(f"{c}{i}") for c in XYZ for i, f in ((0, F.min), (1, F.max))))
    inside = reduce(lambda a, b: a & b, [F.col(c).between(F.col(f"{c}0") - margin, F.col(f"{c}1") + margin) for c in XYZ])
    return voxels.join(box, "scan_id").filter(inside).select(voxels.columns)


def overlap(a: DataFrame, b: DataFrame, common: DataFrame | None = None) -> DataFrame:
    """Per scan: foreground counts, intersection, Dice over everything and inside a common field of view."""
    both = a.select(VOXEL).withColumn("_a", F.lit(1)).join(b.select(VOXEL).withColumn("_b", F.lit(1)), VOXEL, "full")
    both = both.join(common.select(VOXEL).withColumn("_c", F.lit(1)), VOXEL, "left") if common is not None else both.withColumn("_c", F.lit(1))
    hit = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    inside = F.col("_c").isNotNull()
    n = both.groupBy("scan_id").agg(
        F.count("_a").alias("n_a"), F.count("_b").alias("n_b"), F.count_if(hit).alias("n_both"), F.count_if(F.col("_a").isNotNull() & inside).alias("_ca"),
        F.count_if(F.col("_b").isNotNull() & inside).alias("_cb"), F.count_if(hit & inside).alias("_ch"),
    )
    dice = lambda h, x, y: F.try_divide(2 * F.col(h), F.col(x) + F.col(y))
    return n.select("scan_id", "n_a", "n_b", "n_both", dice("n_both", "n_a", "n_b").alias("dice"), dice("_ch", "_ca", "_cb").alias("dice_common"), F.try_divide(F.col("_ca"), F.col("n_a")).alias("common_fraction"))


def confidence(dice: Column, common: Column, foreground: Column) -> Column:
    ok = (dice >= 0.5) & (common >= 0.05) & (foreground >= 4)
    return F.when(F.coalesce(ok, F.lit(False)), F.when(dice >= 0.8, "high").otherwise("acceptable")).otherwise("low")


def fuse(coverage: DataFrame, votes: DataFrame, how: str = "majority", threshold: float = 0.5, anchor: str | None = None) -> DataFrame:
    """Votes of raters per voxel: coverage(scan_id, rater, x, y, z) is who saw it, votes who marked it.

    majority is strictly over the threshold of those who saw the voxel; intersection is all of them; union any; anchor one rater.
    """
    seen = coverage.join(votes.select("scan_id", "rater", *XYZ).withColumn("_v", F.lit(1)), ["scan_id", "rater", *XYZ], "left")
    n = seen.groupBy(*VOXEL).agg(F.count("*").alias("observed"), F.count("_v").alias("votes"), F.max(F.when(F.col("rater") == (anchor or ""), F.col("_v"))).alias("_anchor"))
    n = n.withColumn("probability", F.col("votes") / F.col("observed"))
    keep = {"majority": F.col("probability") > threshold, "intersection": F.col("votes") == F.col("observed"), "union": F.col("votes") > 0, "anchor": F.col("_anchor").isNotNull()}[how]
    return n.withColumn("fused", keep).drop("_anchor")


def _performance(patterns: np.ndarray, counts: np.ndarray, raters: int, iterations: int, tolerance: float) -> np.ndarray:
    """EM over one scan's patterns of votes: the probability of each pattern to be foreground."""
    votes = (patterns[:, None] >> np.arange(raters)) & 1 == 1
    prior = float(counts @ votes.mean(1)) / counts.sum()
    sensitive, specific = np.full(raters, 0.99), np.full(raters, 0.99)
    weight = np.zeros(len(patterns))
    for _ in range(iterations):
        one = prior * np.where(votes, sensitive, 1 - sensitive).prod(1)
        zero = (1 - prior) * np.where(votes, 1 - specific, specific).prod(1)
        weight = np.divide(one, one + zero, out=np.zeros_like(one), where=one + zero > 0)
        on, off = counts * weight, counts * (1 - weight)
        before = np.concatenate([sensitive, specific])
        sensitive, specific = on @ votes / max(on.sum(), 1e-12), off @ ~votes / max(off.sum(), 1e-12)
        if np.abs(before - np.concatenate([sensitive, specific])).max() < tolerance:
            break
    return weight


def staple(coverage: DataFrame, votes: DataFrame, raters: Sequence[str], iterations: int = 100, tolerance: float = 1e-6) -> DataFrame:
    """Simultaneous truth and performance, scan by scan: EM over patterns of votes at voxels that all raters saw.

    Spark counts voxels by scan and pattern, so a scan is at most 2**raters counts whatever its image (more than 16 raters are an error); a small Python
    function iterates on those, and each voxel takes its pattern's probability.
    """
    if len(raters) > 16:
        raise ValueError(f"{len(raters)} raters: more than 16 make too many patterns")

    @F.pandas_udf("array<double>")
    def weights(patterns: pd.Series, counts: pd.Series) -> pd.Series:
        return pd.Series([_performance(np.asarray(p), np.asarray(c, float), len(raters), iterations, tolerance).tolist() for p, c in zip(patterns, counts)])

    seen = coverage.join(votes.select("scan_id", "rater", *XYZ).withColumn("_v", F.lit(1)), ["scan_id", "rater", *XYZ], "left")
    pattern = F.sum(reduce(lambda a, b: a + b, [F.when((F.col("rater") == r) & F.col("_v").isNotNull(), 2**i).otherwise(0) for i, r in enumerate(raters)]))
    voxel = seen.groupBy(*VOXEL).agg(pattern.alias("pattern"), F.count_distinct("rater").alias("n")).filter(F.col("n") == len(raters)).drop("n")
    counts = voxel.groupBy("scan_id", "pattern").agg(F.count("*").alias("k")).groupBy("scan_id").agg(F.array_sort(F.collect_list(F.struct("pattern", "k"))).alias("c"))
    found = counts.withColumn("w", weights("c.pattern", "c.k")).select("scan_id", F.explode(F.arrays_zip(F.col("c.pattern").alias("pattern"), F.col("w").alias("probability"))).alias("z")).select("scan_id", "z.*")
    return voxel.join(found, ["scan_id", "pattern"]).select(*VOXEL, "pattern", "probability").withColumn("fused", F.col("probability") >= 0.5)


def upper_median(distances: DataFrame, value: str = "value") -> DataFrame:
    """Per voxel the upper median over the raters that saw it (as many values as raters)."""
    d = F.array_sort(F.collect_list(value))
    return distances.groupBy(*VOXEL).agg(F.element_at(d, F.floor(F.size(d) / 2).cast("int") + 1).alias("median"), F.count(value).alias("observed"))


def fuse_organs(masks: DataFrame, coverage: DataFrame, spacing: Sequence[float] = (1, 1, 1), anchor: str | None = None) -> DataFrame:
    """Organ surfaces of several raters, masks and coverage(scan_id, rater, x, y, z), fused by the upper median of their signed distances.

    Per voxel that anyone saw: value (the median over those who saw it), observed, probability (share of them that marked it), fused (value not over 0).
    With an anchor only that rater counts. A tie of votes is decided as a strict majority would; one rater of three, however far off, moves nothing beyond the other two.
    """
    by = ["scan_id", "rater"]
    if anchor is not None:
        masks, coverage = masks.filter(F.col("rater") == anchor), coverage.filter(F.col("rater") == anchor)
    field = signed_distances(masks, coverage, spacing, by)
    d = F.array_sort(F.collect_list("value"))  # as many as raters
    out = field.groupBy(*VOXEL).agg(F.element_at(d, F.floor(F.size(d) / 2).cast("int") + 1).alias("value"), F.count("*").alias("observed"), (F.count_if(F.col("value") <= 0) / F.count("*")).alias("probability"))
    return out.withColumn("fused", F.col("value") <= 0)


def seams(coverage: DataFrame) -> DataFrame:
    """Per scan: pairs of adjacent voxels that different numbers of raters saw; each axis by a window along it."""
    n = coverage.groupBy(*VOXEL).agg(F.count("*").alias("n"))
    parts = []
    for axis in XYZ:
        others = [c for c in XYZ if c != axis]
        w = W.partitionBy("scan_id", *others).orderBy(axis)
        parts.append(n.select("scan_id", ((F.lead(axis).over(w) == F.col(axis) + 1) & (F.lead("n").over(w) != F.col("n"))).alias("seam")))
    return reduce(DataFrame.union, parts).groupBy("scan_id").agg(F.count_if("seam").alias("seams"))


def window_levels(voxels: DataFrame, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Percentiles of the finite values per scan; equal ones are set one apart."""
    finite = voxels.filter(F.abs("value") < float("inf"))
    p = same(voxels.select("scan_id").distinct(), percentiles(finite, ["scan_id"], (low, high)), ["scan_id"], "left").select("scan_id", F.col("_p")[0].alias("low"), F.col("_p")[1].alias("high"))
    return p.withColumn("high", F.when(F.col("high") <= F.col("low"), F.col("low") + 1).otherwise(F.col("high")))


def moments(mask: DataFrame, spacing: Sequence[float] = (1, 1, 1), origin: Sequence[float] = (0, 0, 0)) -> DataFrame:
    p = {c: F.col(c) * float(s) + float(o) for c, s, o in zip(XYZ, spacing, origin)}
    pairs = [(a, b) for i, a in enumerate(XYZ) for b in XYZ[i:]]
    return mask.groupBy("scan_id").agg(*(F.avg(p[c]).alias(f"c{c}") for c in XYZ), *(F.covar_samp(p[a], p[b]).alias(f"cov_{a}{b}") for a, b in pairs))


def first_order(voxels: DataFrame, mask: DataFrame, bin_width: float = 25.0) -> DataFrame:
    """First-order statistics of each region: count, min, max, mean, variance, quartiles, energy, entropy of fixed-width bins."""
    roi = voxels.join(mask.select("scan_id", "mask", *XYZ), VOXEL)
    key = ["scan_id", "mask"]
    stats = roi.groupBy(*key).agg(
        F.count("*").alias("n"), F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"), F.var_pop("value").alias("variance"),
        F.sum(F.col("value") * F.col("value")).alias("energy"),
    )
    quartiles = percentiles(roi, key, (0.25, 0.75)).select(*key, F.col("_p")[0].alias("p25"), F.col("_p")[1].alias("p75"))
    bins = roi.groupBy(*key, F.floor(F.col("value") / bin_width).alias("bin")).agg(F.count("*").alias("k"))
    p = F.col("k") / F.sum("k").over(W.partitionBy(*key))
    entropy = bins.withColumn("p", p).groupBy(*key).agg((-F.sum(F.col("p") * F.log2("p"))).alias("entropy"))
    return stats.join(quartiles, key, "left").join(entropy, key).select(*key, "n", "min", "max", "mean", "variance", "p25", "p75", "energy", "entropy")


def straight_sides(mask: DataFrame) -> DataFrame:
    """scan_id, straight: whether a mask ends in a broad, abrupt face on an axis, as one that the image cuts off does.

    The first or last section along the axis has four voxels and a quarter of the largest section at least, and nine tenths of its inward neighbour. Under three sections say nothing.
    """
    places = F.explode(F.array(*(F.struct(F.lit(c).alias("axis"), F.col(c).alias("at")) for c in XYZ)))
    areas = mask.select("scan_id", places.alias("p")).groupBy("scan_id", "p.axis", "p.at").agg(F.count("*").alias("area"))
    along = W.partitionBy("scan_id", "axis").orderBy("at")
    whole = along.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    beside = lambda f, step: F.when(f("at").over(along) == F.col("at") + step, f("area").over(along)).otherwise(0)
    rows = areas.select("scan_id", "area", F.lag("at").over(along).isNull().alias("first"), F.lead("at").over(along).isNull().alias("last"), beside(F.lead, 1).alias("next"), beside(F.lag, -1).alias("former"), F.max("area").over(whole).alias("most"), F.count("*").over(whole).alias("n"))
    broad = (F.col("n") >= 3) & (F.col("area") >= F.greatest(F.lit(4), 0.25 * F.col("most")))
    cut = (F.col("first") & (F.col("area") >= 0.9 * F.col("next"))) | (F.col("last") & (F.col("area") >= 0.9 * F.col("former")))
    return rows.groupBy("scan_id").agg(F.max(broad & cut).alias("straight"))


def mask_quality(mask: DataFrame, grid: DataFrame, spacing: Sequence[float] = (1, 1, 1), margin: float = 1.0, least_share: float = 0.8) -> DataFrame:
    """Per scan of the grid: volume, bounding box, voxels near each side of the grid, share of the largest component, reasons and a status.

    `invalid`: empty, under four voxels, a largest component below the least share, or the whole grid; `partial`: within the margin of a side (touch_* counts
    the voxels there) or a straight side of the largest component; else `complete`.
    """
    m = mask.select(VOXEL).distinct()
    box = grid.groupBy("scan_id").agg(F.count("*").alias("_all"), *(f(c).alias(f"g{c}{i}") for c in XYZ for i, f in ((0, F.min), (1, F.max))))
    steps = dict(zip(XYZ, map(float, spacing)))
    touch = [F.count_if(F.abs(F.col(c) - F.col(f"g{c}{i}")) * steps[c] <= margin).alias(f"touch_{c}{i}") for c in XYZ for i in (0, 1)]
    found = box.join(m, "scan_id", "left").groupBy("scan_id", "_all").agg(F.count("x").alias("_n"), *(f(c).alias(f"{c}{i}") for c in XYZ for i, f in ((0, F.min), (1, F.max))), *touch)
    parts = labelled(m, 1)
    sizes = parts.groupBy("scan_id", "label").agg(F.count("*").alias("_k"))
    best = sizes.withColumn("_r", F.row_number().over(W.partitionBy("scan_id").orderBy(F.desc("_k"), "label"))).filter("_r = 1").drop("_r")
    straight = straight_sides(parts.join(best.select("scan_id", "label"), ["scan_id", "label"], "left_semi"))
    out = found.join(best.select("scan_id", "_k"), "scan_id", "left").join(straight, "scan_id", "left")
    n, share = F.col("_n"), F.coalesce(F.col("_k") / F.col("_n"), F.lit(0.0))
    why = {"empty": n == 0, "insufficient_foreground": (n > 0) & (n < 4), "fragmented": (n > 0) & (share < least_share), "fills_entire_fov": (n > 0) & (n == F.col("_all"))}
    bad = reduce(lambda a, b: a | b, why.values())
    cut = ~bad & F.coalesce("straight", F.lit(False))
    touched = reduce(lambda a, b: a | b, [F.col(f"touch_{c}{i}") > 0 for c in XYZ for i in (0, 1)])
    reasons = F.filter(F.array(*(F.when(c, name) for name, c in {**why, "straight_side": cut}.items())), lambda r: r.isNotNull())
    volume = n * steps["x"] * steps["y"] * steps["z"]
    return out.select("scan_id", volume.alias("volume"), *(f"{c}{i}" for c in XYZ for i in (0, 1)), *(f"touch_{c}{i}" for c in XYZ for i in (0, 1)), share.alias("largest_share"), reasons.alias("reasons"), F.when(bad, "invalid").when(touched | cut, "partial").otherwise("complete").alias("status"))
