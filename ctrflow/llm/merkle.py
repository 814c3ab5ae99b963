"""Merkle manifest of a table: a tree of hashes per group, a tree over the groups, and the proof of every row.

The leaves of a group, in order, are cut into aligned blocks of ``3 ** LEVELS``. A block keeps a level of its tree as one
string of fixed-width hex digests: the substring of three digests is the input of a parent, its flanks beside a node's own
digest are the node's siblings, so no level is ever joined with another. The root of a block is a leaf of the next tier,
and the tiers recurse until every group is one block; the roots of the groups go through the same tiers once more.

Rows are numbered by ranges: a range counts its rows of each group, and sums of these counts say where it starts. So
a group that holds most rows is spread over many tasks like any other. What moves is digests; texts are read once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ctrflow.llm.common import Scratch, partitions

#: Children of a node.
ARITY = 3
#: Levels that one block covers.
LEVELS = 5
BLOCK = ARITY ** LEVELS
#: Hex digits of a digest.
WIDTH = 64
#: The powers of ARITY that fit into 64 bits.
POWERS = [ARITY ** k for k in range(40)]


def leaf_hash(*columns: Column) -> Column:
    """Digest of a row: of each value its length in bytes, a colon and the value as text; ``-`` for null."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda h, at: F.sha2(F.concat(at["before"], h, at["after"]), 256))


def proof(path: Column) -> Column:
    """All siblings of a path, from the leaf up, left to right."""
    return F.array_join(F.transform(path, lambda at: F.concat(at["before"], at["after"])), "")


@dataclass
class Manifest:
    """``rows``: (group, id, position, leaf, path, subroot, root, carried columns), one row per input row. ``groups``: (group,
    n_rows, subroot, root), the manifest to publish."""

    rows: DataFrame
    groups: DataFrame


def merkle_manifest(
    df: DataFrame, id_col: str, group_col: str, leaf: Column, scratch: Scratch, carry: dict[str, Column] | None = None
) -> Manifest:
    """Trees over the rows of ``df`` and where each row stands in them.

    Within a group leaves ascend by id, rows without an id first, rows that share one by leaf; repeated rows are leaves of
    their own. Groups ascend by the bytes of their text, rows without a group being the first one. ``carry`` are
    further columns to take along. An empty table has no rows and no groups. ``path`` holds of each level, up to the
    root over all groups, the siblings before and after, one text each, both empty where a node is alone in its run.
    """
    carried = carry or {}
    group = F.col(group_col).cast("string")
    narrow = df.select(
        # Null sorts before all texts, and the empty text before others, in this form.
        F.coalesce(F.concat(F.lit("1"), group), F.lit("0")).alias("grp"), F.col(id_col).alias("id"), leaf.alias("leaf"),
        *[c.alias(f"c_{name}") for name, c in carried.items()])
    narrow = scratch.stage(narrow.withColumn("nr", F.monotonically_increasing_id()), "leaves")
    nodes = _number(narrow, ["id", "leaf", "nr"], scratch, "rows").withColumnRenamed("leaf", "hash").drop("nr")
    blocks, tops = _forest(nodes, scratch, "t")
    roots = _number(tops.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "n", "hash").withColumnRenamed("n", "rows"),
                    ["name"], scratch, "groups")
    group_blocks, top = _forest(roots, scratch, "g")
    over = top.select("grp", F.lit(0).cast("long").alias("position"), F.array().cast("array<struct<before:string,after:string>>").alias("upper"),
                      F.col("hash").alias("root"))
    groups = scratch.stage(_descend(group_blocks, over, ["root"]).select(
        F.col("name").alias("grp"), F.lit(0).cast("long").alias("position"), F.col("path").alias("upper"), F.col("hash").alias("subroot"),
        "root", "rows"), "roots")
    rows = _descend(blocks, groups.drop("rows"), ["subroot", "root"])
    name = F.when(F.col("grp") != "0", F.expr("substring(grp, 2)"))
    return Manifest(
        rows.select(name.alias("group"), "id", "position", F.col("hash").alias("leaf"), "path", "subroot", "root",
                    *[F.col(f"c_{c}").alias(c) for c in carried]),
        groups.select(name.alias("group"), F.col("rows").alias("n_rows"), "subroot", "root"))


def _number(df: DataFrame, order: list[str], scratch: Scratch, name: str) -> DataFrame:
    """``df`` with ``position``, the number of a row in its group from 0 on, and ``n``, the rows of the group.

    The ranges are stored with the rows, so that counts and numbers speak of the same ranges whatever is computed again.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(partitions(spark), "grp", *order).withColumn("part", F.spark_partition_id())
    ranged = scratch.stage(ranged, f"{name}-ranged")
    counts = ranged.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("here"))
    whole = Window.partitionBy("grp")
    starts = counts.select(
        "grp", "part", F.sum("here").over(whole).alias("n"),
        (F.sum("here").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("here")).alias("start"))
    within = F.row_number().over(Window.partitionBy("grp", "part").orderBy(*order))
    return (ranged.withColumn("place", within - 1).join(starts, ["grp", "part"])
            .withColumn("position", F.col("start") + F.col("place")).drop("start", "place", "part"))


def _tiers(n: Column) -> Column:
    """Levels above ``n`` leaves: the powers below n."""
    return F.size(F.filter(F.array(*[F.lit(p).cast("long") for p in POWERS]), lambda p: p < n))


def _parents(level: Column) -> Column:
    run = ARITY * WIDTH
    starts = F.sequence(F.lit(0), F.floor((F.length(level) - 1) / run).cast("int"))
    return F.array_join(F.transform(starts, lambda i: F.sha2(F.substring(level, i * run + 1, F.lit(run)), 256)), "")


def _siblings(level: Column, node: Column) -> Column:
    """The flanks of a node's run, from the string of its level."""
    run = ARITY * WIDTH
    segment = F.substring(level, (F.floor(node / ARITY) * run + 1).cast("int"), F.lit(run))
    own = (node % ARITY) * WIDTH
    return F.struct(F.substring(segment, F.lit(1), own.cast("int")).alias("before"),
                    F.substring(segment, (own + WIDTH + 1).cast("int"), F.lit(run)).alias("after"))


def _block_rows(nodes: DataFrame, tier: int) -> DataFrame:
    """(grp, n, position, hash, members): one row per block; members are its nodes in order, each with its path in it."""
    payload = [c for c in nodes.columns if c not in ("grp", "n")]
    block = F.floor(F.col("position") / BLOCK).alias("block")
    gathered = nodes.groupBy("grp", "n", block).agg(F.sort_array(F.collect_list(F.struct("position", *[c for c in payload if c != "position"]))).alias("members"))
    steps = F.least(F.lit(LEVELS), F.greatest(F.lit(0), _tiers(F.col("n")) - LEVELS * tier))
    rows = gathered.withColumn("steps", steps).withColumn("level_0", F.array_join(F.col("members")["hash"], ""))
    for k in range(LEVELS):
        level = F.col(f"level_{k}")
        rows = rows.withColumn(f"level_{k + 1}", F.when(F.col("steps") > k, _parents(level)).otherwise(level))
    path = lambda i: F.slice(F.array(*[_siblings(F.col(f"level_{k}"), F.floor(i / ARITY ** k)) for k in range(LEVELS)]), F.lit(1), F.col("steps"))
    members = F.transform("members", lambda m, i: F.struct(*[m[c].alias(c) for c in payload], path(i).alias("own")))
    return rows.select("grp", "n", F.col("block").alias("position"), F.col(f"level_{LEVELS}").alias("hash"), members.alias("members"))


def _forest(nodes: DataFrame, scratch: Scratch, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of all tiers, the lowest first, and (grp, n, hash) of the whole groups."""
    tiers: list[DataFrame] = []
    while True:
        rows = scratch.stage(_block_rows(nodes, len(tiers)), f"{name}{len(tiers)}")
        tiers.append(rows)
        nodes = rows.drop("members")
        if nodes.where("position > 0").isEmpty():
            return tiers, nodes.select("grp", "n", "hash")


def _descend(tiers: list[DataFrame], over: DataFrame, keep: list[str]) -> DataFrame:
    """The nodes of the lowest tier with their paths through all tiers and on through ``over`` (grp, position, upper, keep)."""
    for tier in reversed(range(len(tiers))):
        rows = tiers[tier].drop("n", "hash").join(over, ["grp", "position"]).drop("position")
        rows = rows.select("grp", "upper", *keep, F.explode("members").alias("m")).select("grp", "upper", *keep, "m.*")
        path = F.concat("own", "upper")
        if tier:
            over = rows.select("grp", "position", path.alias("upper"), *keep)
        else:
            over = rows.withColumn("path", path).drop("own", "upper")
    return over
