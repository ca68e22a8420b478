"""Signed rows: relational operators that understand insertions and retractions.

A signed DataFrame has an integer column ``w``: +1 for a row that appears, -1
for one that goes away.  A DataFrame without ``w`` is a plain table, every row
of which weighs 1, so each operator here also works on plain tables.

* filter and project keep ``w``;
* an inner join multiplies the weights;
* union concatenates;
* ``count(*)`` is ``sum(w)`` and ``sum(x)`` is ``sum(w * x)``;
* a group whose weights sum to 0 does not exist.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

W = "w"


def is_signed(df: DataFrame) -> bool:
    return W in df.columns


def weight(df: DataFrame) -> Column:
    """The weight column, or 1 for a plain table."""
    return F.col(W) if is_signed(df) else F.lit(1)


def payload(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != W]


def project(df: DataFrame, *columns: Column | str) -> DataFrame:
    """Select ``columns`` and carry the weight along if there is one."""
    return df.select(*columns, W) if is_signed(df) else df.select(*columns)


def negate(df: DataFrame) -> DataFrame:
    return df.withColumn(W, -weight(df))


def union(*parts: DataFrame) -> DataFrame:
    """Concatenate signed tables; plain ones join in with weight 1."""
    signed = [p if is_signed(p) else p.withColumn(W, F.lit(1)) for p in parts]
    out = signed[0]
    for part in signed[1:]:
        out = out.unionByName(part)
    return out


def join(left: DataFrame, right: DataFrame, on: Sequence[str] | str, salts: int = 1) -> DataFrame:
    """Inner equi-join; the weights multiply.

    On a batch, adaptive execution splits skewed partitions by itself and
    ``salts`` stays 1.  A stream-stream join has a fixed hash partitioning, so a
    hot key would sit in one state store: there ``salts`` spreads the rows of
    each ``left`` key over that many partitions and repeats the (small, keyed)
    ``right`` side once per salt.  The result is the same.
    """
    keys = [on] if isinstance(on, str) else list(on)
    clash = (set(payload(left)) & set(payload(right))) - set(keys)
    if clash:
        raise ValueError(f"columns {sorted(clash)} occur on both sides; rename them first")
    if is_signed(right):
        right = right.withColumnRenamed(W, "_w_right")
    if salts > 1:
        left = left.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in payload(left)]), F.lit(salts)).cast("int"))
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        keys = [*keys, "_salt"]
    out = left.join(right, keys, "inner").drop("_salt")
    if "_w_right" in out.columns:
        out = out.withColumn(W, weight(left) * F.col("_w_right")).drop("_w_right")
    return out


def count(df: DataFrame) -> Column:
    """``COUNT(*)`` under retraction."""
    return F.sum(W) if is_signed(df) else F.count(F.lit(1))


def total(df: DataFrame, x: Column) -> Column:
    """``SUM(x)`` under retraction; NULL once no non-null value is left."""
    if not is_signed(df):
        return F.sum(x)
    return F.when(present(df, x) != 0, F.sum(F.col(W) * x))


def present(df: DataFrame, x: Column) -> Column:
    """``COUNT(x)`` under retraction."""
    return F.sum(F.when(x.isNotNull(), F.col(W)).otherwise(0)) if is_signed(df) else F.count(x)


def aggregate(df: DataFrame, by: Sequence[Column | str], **aggregates: Column) -> DataFrame:
    """Group a plain or signed table; groups that net to nothing are dropped.

    Every aggregate splits into a partial and a final step, so a hot group
    leaves each task as one row.
    """
    columns = [c.alias(name) for name, c in aggregates.items()]
    if not is_signed(df):
        return df.groupBy(*by).agg(*columns)
    return df.groupBy(*by).agg(*columns, count(df).alias("_n")).where("_n <> 0").drop("_n")


def consolidate(df: DataFrame) -> DataFrame:
    """One row per distinct payload with its net weight; zeros disappear."""
    if not is_signed(df):
        raise ValueError("a plain table has nothing to consolidate")
    columns = payload(df)
    return df.groupBy(*columns).agg(F.sum(W).alias(W)).where(F.col(W) != 0).select(*columns, W)


def current(df: DataFrame) -> DataFrame:
    """The plain table that the signed rows add up to.

    Rows that net to less than nothing (a retraction of something never seen)
    are left out; ``unmatched`` counts them.
    """
    net = consolidate(df).where(F.col(W) > 0)
    repeated = net.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(W).cast("int"))))
    return repeated.drop("_copy", W)


def unmatched(df: DataFrame) -> DataFrame:
    """How many distinct rows were retracted more often than they were inserted."""
    return (
        consolidate(df)
        .where(F.col(W) < 0)
        .agg(
            F.count(F.lit(1)).alias("unmatched_rows"),
            F.coalesce(-F.sum(W), F.lit(0)).cast("bigint").alias("unmatched_weight"),
        )
    )


def count_distinct(df: DataFrame, by: Sequence[str], x: str, name: str) -> DataFrame:
    """``COUNT(DISTINCT x)`` per group under retraction.

    A value counts while its own net weight is positive.  The first grouping is
    by (group, value), so a hot group is spread over all partitions.
    """
    if not is_signed(df):
        return df.groupBy(*by).agg(F.countDistinct(x).alias(name))
    alive = df.where(F.col(x).isNotNull()).groupBy(*by, x).agg(F.sum(W).alias(W)).where(F.col(W) > 0)
    return alive.groupBy(*by).agg(F.count(F.lit(1)).alias(name))
