"""Comparing tables by a tree of digests: only key ranges whose digests differ are opened.

Rows are dealt to leaves by ranges of their key's hash. A leaf's digest is the
number of its rows and two sums of row hashes, so it needs no order, and a
leaf of any size leaves each task as one row. A node of the tree adds up the
digests of ``FAN_OUT`` children. Two tables are compared from the root down; rows
are fetched for leaves that differ, and for no others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.plans.quality import differences
from ebbtide.session import work_dir

#: Bits of a child's number within its parent.
FAN_OUT_BITS = 8
#: Levels below the root: 65,536 leaves by default. A leaf should hold some thousand rows.
DEPTH = 2

DIGEST = ("n", "low", "high")


def leaf(key: Sequence[str], depth: int = DEPTH) -> Column:
    """The leaf of a row: the upper bits of its key's hash."""
    return F.shiftrightunsigned(_hash(key, 1), 64 - depth * FAN_OUT_BITS)


def _hash(columns: Sequence[str], seed: int) -> Column:
    """A hash in which null differs from every value, and from null in another column."""
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (F.col(c), F.col(c).isNull())])


def tree(df: DataFrame, key: Sequence[str], depth: int = DEPTH) -> DataFrame:
    """``level, node, n, low, high`` for all nodes that have rows: level 0 is the root, level ``depth`` the leaves.

    The rows are scanned once and shuffled as one digest for each task and leaf; the levels above are sums over that.
    It can be kept as a table, to compare with later or from elsewhere.
    """
    columns = sorted(df.columns)
    wide = [_hash(columns, seed).cast("decimal(20,0)") for seed in (2, 3)]
    leaves = df.groupBy(leaf(key, depth).alias("leaf")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(wide[0]).alias("low"), F.sum(wide[1]).alias("high")
    )
    spread = leaves.select("*", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level"))
    node = F.expr(f"shiftrightunsigned(leaf, ({depth} - level) * {FAN_OUT_BITS})").alias("node")
    return spread.groupBy("level", node).agg(*[F.sum(c).alias(c) for c in DIGEST])


def saved_tree(df: DataFrame, key: Sequence[str], depth: int = DEPTH) -> DataFrame:
    """``tree`` as a table in the shared folder, with a folder for each level."""
    path = work_dir(df.sparkSession, "digest-tree")
    tree(df, key, depth).write.partitionBy("level").parquet(path)
    return df.sparkSession.read.schema("node BIGINT, n BIGINT, low DECIMAL(38,0), high DECIMAL(38,0), level INT").parquet(path)


def differing_nodes(left: DataFrame, right: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``level, node`` of the nodes of two trees that differ and whose parents do, from the root down to the leaves."""
    found = None
    above = None
    for level in range(depth + 1):
        sides = []
        for tree_, name in ((left, "l"), (right, "r")):
            side = tree_.where(F.col("level") == level)
            if above is not None:
                parent = F.shiftrightunsigned(F.col("node"), FAN_OUT_BITS)
                side = side.withColumn("_p", parent).join(above.select(F.col("node").alias("_p")), "_p", "left_semi")
            sides.append(side.select("node", F.struct(*DIGEST).alias(name)))
        both = sides[0].join(sides[1], "node", "full_outer").where(~F.col("l").eqNullSafe(F.col("r")))
        above = both.select(F.lit(level).alias("level"), "node")
        found = above if found is None else found.unionByName(above)
    return found


def rows_to_open(df: DataFrame, nodes: DataFrame, key: Sequence[str], depth: int = DEPTH) -> DataFrame:
    """Rows of the leaves among ``nodes``. The leaves are what is joined, so rows elsewhere are not shuffled."""
    leaves = nodes.where(F.col("level") == depth).select(F.col("node").alias("_leaf"))
    return df.withColumn("_leaf", leaf(key, depth)).join(leaves, "_leaf", "left_semi").drop("_leaf")


def _opened(left: DataFrame, right: DataFrame, key: Sequence[str], depth: int) -> tuple[list[DataFrame], DataFrame]:
    """Both trees, and the differences among rows of differing leaves."""
    trees = [saved_tree(df, key, depth) for df in (left, right)]
    path = work_dir(left.sparkSession, "digest-nodes")
    differing_nodes(*trees, depth).write.parquet(path)
    nodes = left.sparkSession.read.parquet(path)
    return trees, differences(*[rows_to_open(df, nodes, key, depth) for df in (left, right.select(*left.columns))])


def differences_by_digests(left: DataFrame, right: DataFrame, key: Sequence[str], depth: int = DEPTH) -> DataFrame:
    """``quality.differences`` with rows of differing leaves only; the same result."""
    return _opened(left, right, key, depth)[1]


def reconcile_by_digests(left: DataFrame, right: DataFrame, key: Sequence[str], name: str, depth: int = DEPTH) -> DataFrame:
    """``quality.reconcile`` from the two trees and the rows of differing leaves."""
    trees, found = _opened(left, right, key, depth)
    of_side = {s: F.sum(F.when(F.col("side") == s, F.col("surplus")).otherwise(0)) for s in ("left", "right")}
    by_key = found.groupBy(*key).agg(of_side["left"].alias("only_left"), of_side["right"].alias("only_right"))
    changed = F.count_if((F.col("only_left") > 0) & (F.col("only_right") > 0))
    zero = F.lit(0).cast("bigint")
    sums = by_key.agg(
        *[F.coalesce(F.sum(c), zero).alias(c) for c in ("only_left", "only_right")], changed.alias("changed_keys")
    )
    roots = [t.where("level = 0").agg(F.coalesce(F.sum("n"), zero).alias(f"{s}_rows")) for t, s in zip(trees, ("left", "right"))]
    # three tables of one row each
    one = [df.withColumn("_one", F.lit(1)) for df in (*roots, sums)]
    out = one[0].join(one[1], "_one").join(one[2], "_one")
    same = (F.col("only_left") == 0) & (F.col("only_right") == 0)
    return out.select(
        F.lit(name).alias("table_name"), "left_rows", "right_rows", "only_left", "only_right", "changed_keys", same.alias("identical")
    )
