"""Approximate nearest neighbours (operator 1): balanced posting lists with replicated boundaries.

1. A bounded sample (about SAMPLE vectors by hash) is cut in two again and again, each time into halves of equal size along the line between
   two means, until the pieces are small: balanced lists, whose means are the centroids.
2. The centroids form an in-memory graph (each tied to its nearest and to a ring); a beam search over it, for a batch
   of vectors at once, finds the lists of a vector.
3. Every vector of the table goes to its nearest list and, on a boundary, to further lists within CLOSE of that distance, REPLICAS at most;
   the nearest always has it, so no row is lost.
4. A query searches the lists whose centroid is within a ratio of the distance of the nearest: on clustered data few, on evenly
   spread data many. The ratio is measured on the sample (SAMPLE_RECALL).
5. Lists are counted, and both sides of a large one are split (rows by hash, queries by hash), so a list that holds
   a third of the table is searched by many tasks. A task finds the nearest of its part for its queries; a query's
   finds are reduced to the best k by a window over at most (lists x splits x k) rows.

Distances are exact, in double precision, on the original vectors. Null and zero vectors, and those with null or non-finite
components, take no part, neither do vectors whose length isn't the most frequent one. Ties go to the smaller id. An empty table
gives no rows. Repeated rows of one id count once (the nearest); as a query an id asks by its least vector. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stratiform.llm.common import columns_of, written

SAMPLE = 20_000
LIST_ROWS = 400  # aimed at; lists get longer where the sample's bound limits their number
MAX_LISTS = 1024
DEGREE = 24
BEAM, ASSIGN_BEAM = 192, 16  # for queries, for rows
REPLICAS = 4
CLOSE = 1.06
#: The pruning ratio is set such that this share of a sample's own nearest pairs is found, within bounds.
SAMPLE_RECALL, SAMPLE_QUERIES, RATIOS = 0.995, 256, (1.05, 4.0)
SPLIT_ROWS = 50_000
SPLIT_QUERIES = 2_000


def centroids_of(sample: np.ndarray, lists: int, seed: int = 1) -> np.ndarray:
    """Means of balanced pieces of the sample, at most `lists`."""
    rng = np.random.default_rng(seed)
    pieces, limit = [np.arange(len(sample))], max(1, -(-len(sample) // max(lists, 1)))
    done = []
    while pieces:
        piece = pieces.pop()
        if len(piece) <= limit:
            done.append(sample[piece].mean(axis=0))
            continue
        x = sample[piece]
        a, b = x[rng.choice(len(x), 2, replace=False)]
        for _ in range(6):
            along = x @ (a - b)
            order = np.argsort(along, kind="stable")
            half = len(x) // 2
            b, a = x[order[:half]].mean(axis=0), x[order[half:]].mean(axis=0)
        pieces += [piece[order[:half]], piece[order[half:]]]
    return np.array(done)


class Graph:
    """Centroids and their neighbours; `search` walks it for a batch of vectors."""

    def __init__(self, centroids: np.ndarray) -> None:
        n = len(centroids)
        self.centroids = centroids
        near = [np.argsort(((centroids - c) ** 2).sum(axis=1), kind="stable")[1 : DEGREE + 1] for c in centroids]
        ring = [[(i + s) % n for s in (1, 7, 61)] for i in range(n)]
        self.edges = np.array([np.resize(np.append(x, r), DEGREE + 3) for x, r in zip(near, ring)], np.int64).reshape(n, -1)
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 16)).astype(int))

    def search(self, x: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """(vectors, beam) centroids found and distances, nearest first; missing ones are at infinity."""
        c, n = self.centroids, len(self.centroids)
        beam = min(beam, n)
        dist = lambda rows, ids: np.sqrt(np.maximum(((x[rows][:, None, :] - c[ids]) ** 2).sum(axis=2), 0))
        every = np.arange(len(x))
        seen = np.zeros((len(x), n), bool)
        ids = np.full((len(x), beam), -1, np.int64)
        far = np.full((len(x), beam), np.inf)
        first = np.broadcast_to(self.entries, (len(x), len(self.entries)))[:, :beam]
        ids[:, : first.shape[1]], far[:, : first.shape[1]] = first, dist(every, first)
        seen[:, first[0]] = True
        grown = np.zeros((len(x), beam), bool)
        rows = every
        while len(rows):
            open_ = np.where(grown[rows] | (ids[rows] < 0), np.inf, far[rows])
            k = open_.argmin(axis=1)
            rows, k = rows[np.isfinite(open_.min(axis=1))], k[np.isfinite(open_.min(axis=1))]
            if not len(rows):
                break
            grown[rows, k] = True
            new = self.edges[ids[rows, k]]
            known = seen[rows[:, None], new]
            seen[rows[:, None], new] = True
            new_far = np.where(known, np.inf, dist(rows, new))
            # a neighbour named twice in one step counts once
            twice = np.sort(new, axis=1)
            if (twice[:, 1:] == twice[:, :-1]).any():
                order = np.argsort(new, axis=1, kind="stable")
                same = np.concatenate([np.zeros((len(new), 1), bool), np.take_along_axis(new, order, 1)[:, 1:] == np.take_along_axis(new, order, 1)[:, :-1]], axis=1)
                drop = np.zeros_like(same)
                np.put_along_axis(drop, order, same, 1)
                new_far[drop] = np.inf
            all_ids, all_far = np.concatenate([ids[rows], new], 1), np.concatenate([far[rows], new_far], 1)
            all_grown = np.concatenate([grown[rows], np.zeros_like(known)], 1)
            best = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
            ids[rows], far[rows], grown[rows] = (np.take_along_axis(z, best, 1) for z in (all_ids, all_far, all_grown))
        ids[~np.isfinite(far)] = -1
        return ids, far


def prune_ratio(sample: np.ndarray, centroids: np.ndarray, k: int = 10) -> float:
    """How much further than the nearest centroid a list's may be, from bounded brute force within the sample.

    Neighbours within a sample are further away than those in the whole table, so the ratio errs on the safe side.
    """
    if len(sample) < 2 or len(centroids) < 2:
        return RATIOS[0]
    q = np.linspace(0, len(sample) - 1, min(SAMPLE_QUERIES, len(sample))).astype(int)
    dist = lambda a, b: np.sqrt(np.maximum((a**2).sum(axis=1)[:, None] - 2 * a @ b.T + (b**2).sum(axis=1), 0))
    apart = dist(sample[q], sample)
    apart[np.arange(len(q)), q] = np.inf
    near = np.argsort(apart, axis=1)[:, : min(k, len(sample) - 1)]
    to = dist(sample[q], centroids)
    to = to / np.maximum(to.min(axis=1, keepdims=True), 1e-12)
    needed = []
    for i, row in enumerate(near):
        d = dist(sample[row], centroids)
        lists = np.argsort(d, axis=1)[:, :REPLICAS]
        far = np.take_along_axis(d, lists, 1)
        needed += list(np.where(far <= CLOSE * far[:, :1], to[i][lists], np.inf).min(axis=1))
    return float(np.clip(np.quantile(needed, SAMPLE_RECALL), *RATIOS))


def usable(vector: Column) -> Column:
    ok = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vector.isNotNull() & F.coalesce(ok, F.lit(False)) & F.exists(vector, lambda v: v != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def nearest(pdf: pd.DataFrame, other: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest rows of one part of a list for each of its queries."""
    if not len(pdf) or not len(other):
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
    v, q = np.stack(pdf["vector"].to_numpy()), np.stack(other["vector"].to_numpy())
    ids, queries = pdf["vec_id"].to_numpy(), other["query_id"].to_numpy()
    out = []
    norm = (v**2).sum(axis=1)
    for a in range(0, len(q), 64):
        rough = norm - 2 * q[a : a + 64] @ v.T + (q[a : a + 64] ** 2).sum(axis=1)[:, None]
        for i, row in enumerate(rough, a):
            row = np.where(ids == queries[i], np.inf, row)
            if len(row) > k:
                kth = np.partition(row, k - 1)[k - 1]
                at = np.flatnonzero(row <= kth + 1e-9 * (1 + abs(kth) + norm.max()))
            else:
                at = np.arange(len(row))
            at = at[ids[at] != queries[i]]
            exact = np.sqrt(((v[at] - q[i]) ** 2).sum(axis=1))
            best = np.lexsort((ids[at], exact))
            # repeated rows of an id may stand before others: as many distinct ids as asked for
            _, firsts = np.unique(ids[at][best], return_index=True)
            best = best[np.sort(firsts)[:k]]
            out.append(pd.DataFrame({"query_id": queries[i], "vec_id": ids[at][best], "score": exact[best]}))
    return pd.concat(out, ignore_index=True)


def search(table: DataFrame, queries: Column, k: int = 10, vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for the rows of `table` (vec_id, embedding) that `queries` selects."""
    spark = table.sparkSession
    rows = columns_of(table, vec_id="long", **{vector: "array<double>"}).select("vec_id", F.col(vector).alias("vector")).filter(usable(F.col("vector")) & F.col("vec_id").isNotNull())
    widths = rows.groupBy(F.size("vector").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    width, total = (widths[0]["w"], widths[0]["count"]) if widths else (1, 0)
    rows = rows.filter(F.size("vector") == width)
    every = max(1, total // SAMPLE)
    some = rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(every)) == 0).select("vec_id", "vector").orderBy("vec_id", F.xxhash64("vector")).limit(4 * SAMPLE).collect()
    sample = np.array([r["vector"] for r in some], float).reshape(-1, width)
    if not len(sample):
        sample = np.zeros((1, width))
    graph = Graph(centroids_of(sample, max(1, min(MAX_LISTS, total // LIST_ROWS, len(sample) // 4))))
    ratio = prune_ratio(sample, graph.centroids)
    shared = spark.sparkContext.broadcast(graph)

    def lists_of(x: np.ndarray, ratio: float, most: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        at, lists = [], []
        for a in range(0, len(x), 512):
            ids, far = shared.value.search(x[a : a + 512], beam)
            ok = (ids >= 0) & (far <= ratio * far[:, :1])
            ok[:, 0] = True
            ok[:, most:] = False
            i, j = np.nonzero(ok)
            at.append(i + a)
            lists.append(ids[i, j])
        return np.concatenate(at), np.concatenate(lists)

    def assign(ratio: float, most: int, beam: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, 2048):
                    part = batch.slice(a, 2048)
                    at, lists = lists_of(_matrix(part.column(1)), ratio, most, beam)
                    moved = part.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([lists, *moved.columns], names=["list", *moved.schema.names])

        return run

    postings = written(rows.mapInArrow(assign(CLOSE, REPLICAS, ASSIGN_BEAM), "list long, vec_id long, vector array<double>"), "postings")
    asked = rows.filter(queries).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    asked = written(asked.mapInArrow(assign(ratio, BEAM, BEAM), "list long, query_id long, vector array<double>"), "asked")
    sizes = postings.groupBy("list").agg(F.ceil(F.count("*") / SPLIT_ROWS).cast("int").alias("parts"))
    query_sizes = asked.groupBy("list").agg(F.ceil(F.count("*") / SPLIT_QUERIES).cast("int").alias("query_parts"))
    split = sizes.join(query_sizes, "list")  # a row per list
    left = postings.join(split, "list").select("list", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1)).alias("query_part"), "vec_id", "vector")
    right = asked.join(split, "list").select("list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.pmod(F.xxhash64("query_id"), F.col("query_parts")).cast("int").alias("query_part"), "query_id", "vector")
    key = ["list", "part", "query_part"]
    found = left.groupBy(key).cogroup(right.groupBy(key)).applyInPandas(lambda a, b: nearest(a, b, k), "query_id long, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
