"""Reports over result tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def section(df: DataFrame, title: str) -> DataFrame:
    """The rows of one report section, each labelled with the section's title."""
    return df.select(F.lit(title).alias("section"), "*")


def next_id(df: DataFrame, column: str, start: int) -> DataFrame:
    """The first free id at or above ``start``."""
    return df.where(F.col(column) >= start).agg(
        F.coalesce(F.max(column) + 1, F.lit(start)).cast("bigint").alias("next_id")
    )


def sample_ids(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` smallest ids: a sample that does not change from run to run."""
    return df.select(column).orderBy(column).limit(n)


def category_ranking(categories: DataFrame) -> DataFrame:
    """Categories, highest revenue first; unpriced ones last."""
    return categories.orderBy(F.col("revenue").desc_nulls_last())


def latest_windows(windows: DataFrame, n: int = 5) -> DataFrame:
    """The newest windows with revenue to the cent; each task keeps only its own top ``n``."""
    newest = windows.orderBy(F.col("window_start").desc()).limit(n)
    return newest.withColumn("revenue", F.round("revenue", 2))


def row_counts(tables: Mapping[str, DataFrame], label: str = "sink_table") -> DataFrame:
    """How many rows each table has."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias(label), "rows")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def largest_first(df: DataFrame, size: Column, *ties: str) -> DataFrame:
    """Order by an expression, largest first."""
    return df.orderBy(size.desc(), *ties)
