"""Merkle manifest of a dataset (operator 13): a hash tree over the rows of each group, and one over the groups' roots.

Leaves get their places in a group by a range shuffle and a running sum over partition counts. Every BLOCK consecutive nodes of a
group are an aligned block, one row, that keeps each of its levels as one string of concatenated hex digests: a parent is the
hash of a substring of 2 * WIDTH characters, the siblings of a node are the substrings that flank it. The roots of the blocks are the
nodes of the next round, until a group has one block; the groups' roots, in order, make the last tree. Then the way back: each block hands
its path to its nodes. All of it is SQL over written tables; no row holds more than a block, so a group may have any size.

Strings are kept as binary, where a substring costs its own length and not its distance from the start.

Defined cases: a null field is `-`; a null group comes first. Rows go by the order columns (nulls first) and then by their leaf; equal rows
have equal leaves and stand side by side. A group of one row has its leaf as subroot, and a table of one group that subroot as root.
An empty table gives no rows. Other columns, whatever their names, stay out, but for those asked for with `beside`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratiform.llm.common import written

WIDTH = 64  # hex characters of a SHA-256
BITS = 10
BLOCK = 1 << BITS
#: From a level's string to the string of its parents.
_PARENTS = f"cast(array_join(transform(sequence(0L, (octet_length(element_at(acc, -1)) - 1) div {2 * WIDTH}), j -> sha2(substring(element_at(acc, -1), cast(j * {2 * WIDTH} + 1 as int), {2 * WIDTH}), 256)), '') as binary)"
#: A path holds a step per level: the digest of the sibling ('' for a node that is alone in its run) and whether it stands to the left.
_PATH = (
    "transform(slice(levels, 1, size(levels) - 1), (level, l) -> named_struct('left', (shiftright(i, l) & 1) = 1, "
    f"'digest', cast(substring(level, (shiftright(i, l) ^ 1) * {WIDTH} + 1, {WIDTH}) as string)))"
)


def leaf_of(*fields: Column) -> Column:
    """The digest of a row: of each field its UTF-8 byte count, a colon and the value, or `-` for null."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]).cast("binary"), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda acc, step: F.sha2(F.when(step["left"], F.concat(step["digest"], acc)).otherwise(F.concat(acc, step["digest"])).cast("binary"), 256))


def proof_hash(path: Column) -> Column:
    """The digest of a path's siblings, from leaf to root."""
    return F.sha2(F.array_join(F.transform(path, lambda step: step["digest"]), "").cast("binary"), 256)


def placed(df: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """df with `pos`, the place of each row within its group from 0 on, and `size`, the rows of the group.

    Range partitions are written in order, so a row's number is a running number of its partition plus the rows of the group in
    the partitions before. Equal rows are told apart by a running number, so that any number of them is dealt to many partitions.
    """
    order = [group, *order, "_salt"]
    sorted_ = df.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    stored = written(sorted_.drop("_salt").withColumn("_at", F.monotonically_increasing_id()), f"{name}-sorted").withColumn("_part", F.shiftright("_at", 33))
    parts = stored.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(group)
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = written(parts.select(group, "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("size")), f"{name}-parts")
    return stored.join(parts, [group, "_part"]).withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def _blocks(nodes: DataFrame, beside: Sequence[str]) -> DataFrame:
    """A row per block of nodes (g, pos, size, digest): its nodes in order, its levels and its root."""
    rows = F.sort_array(F.collect_list(F.struct("pos", "digest", *beside))).alias("nodes")
    found = nodes.groupBy("g", F.shiftright("pos", BITS).alias("block")).agg(F.first("size").alias("size"), rows)
    # a block among others goes through all levels, the only one of a group until one node is left
    depth = f"CASE WHEN size > {BLOCK} THEN {BITS} WHEN size = 1 THEN 0 ELSE length(bin(size - 1)) END"
    levels = f"aggregate(slice(sequence(1, {BITS}), 1, {depth}), array(cast(array_join(nodes.digest, '') as binary)), (acc, step) -> concat(acc, array({_PARENTS})))"
    return found.withColumn("levels", F.expr(levels)).withColumn("top", F.expr("cast(element_at(levels, -1) as string)"))


def _grown(nodes: DataFrame, beside: Sequence[str], name: str) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of blocks over nodes, each a written table, and the root (g, digest) of each group."""
    rounds: list[DataFrame] = []
    while True:
        rounds.append(written(_blocks(nodes, () if rounds else beside), f"{name}-{len(rounds)}"))
        nodes = rounds[-1].select("g", F.col("block").alias("pos"), F.ceil(F.col("size") / BLOCK).cast("long").alias("size"), F.col("top").alias("digest"))
        if (nodes.agg(F.max("size")).first()[0] or 1) == 1:
            return rounds, nodes.select("g", "digest")


def _opened(rounds: list[DataFrame], top: DataFrame) -> DataFrame:
    """The nodes below all rounds, each with its path to the top: `top` holds for each group (g) the path from its root on, and columns to hand down."""
    handed = [c for c in top.columns if c not in ("g", "path")]
    found = top.withColumn("block", F.lit(0).cast("long"))
    for table in reversed(rounds):
        each = table.join(found, ["g", "block"]).withColumn("node", F.explode(F.expr(f"transform(nodes, (n, i) -> struct(n, concat({_PATH}, path) AS path))")))
        found = each.select("g", F.col("node.n.*"), F.col("node.path").alias("path"), *handed).withColumn("block", F.col("pos"))
    return found.drop("block")


def manifest(df: DataFrame, group: str, order: Sequence[str], fields: Sequence[str], beside: dict[str, Column] | None = None) -> DataFrame:
    """A row per row of df: the columns `beside`, `leaf`, `subroot` of its group, `root`, and `path`, the siblings from leaf to root."""
    beside = beside or {}
    key = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))
    by = {f"_by{k}": F.col(c) for k, c in enumerate(order)}
    leaves = df.select(key.alias("g"), leaf_of(*[F.col(f) for f in fields]).alias("digest"), *[c.alias(n) for n, c in by.items()], *[c.alias(f"_{n}") for n, c in beside.items()])
    leaves = placed(leaves, "g", [*by, "digest"], "manifest").drop(*by)
    rounds, subroots = _grown(leaves, [f"_{n}" for n in beside], "manifest-blocks")
    groups = placed(subroots.select(F.lit("").alias("g"), F.col("g").alias("_group"), "digest"), "g", ["_group"], "manifest-groups")
    upper, root = _grown(groups, ["_group"], "manifest-upper")
    empty = F.expr("cast(array() as array<struct<left:boolean,digest:string>>)")
    above = _opened(upper, root.select("g", empty.alias("path"), F.col("digest").alias("root")))
    above = written(above.select(F.col("_group").alias("g"), "path", F.col("digest").alias("subroot"), "root"), "manifest-above")
    return _opened(rounds, above).select(*[F.col(f"_{n}").alias(n) for n in beside], F.col("digest").alias("leaf"), "subroot", "root", "path")
