"""Bulk copy of selected tables between stores."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JdbcSource:
    """Reads a database table in parallel slices of its numeric key."""

    spark: SparkSession
    url: str
    options: Mapping[str, str]

    def slices(self, table: str, key: str, low: int, high: int, parts: int) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": table,
            "partitionColumn": key,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(parts),
            **self.options,
        }

    def bounds_query(self, table: str, key: str) -> str:
        return f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}"

    def read(self, table: str, key: str, parts: int = 4) -> DataFrame:
        reader = self.spark.read.format("jdbc").option("url", self.url).options(**self.options)
        ends = reader.option("query", self.bounds_query(table, key)).load().first()
        low, high = (0, 0) if ends["low"] is None else (int(ends["low"]), int(ends["high"]))
        return self.spark.read.format("jdbc").options(**self.slices(table, key, low, high, parts)).load()


def select_tables(names: Iterable[str], including: Iterable[str]) -> list[str]:
    """The names that match one of the patterns in full, sorted."""
    patterns = [re.compile(p) for p in including]
    return sorted(n for n in names if any(p.fullmatch(n) for p in patterns))


def copy_tables(
    read: Callable[[str], DataFrame],
    names: Iterable[str],
    including: Iterable[str],
    target: str,
    schema: str = "public",
) -> dict[str, str]:
    """Copy the included tables to ``target/schema/<table>``.

    A table that is already there is replaced.  Returns the path per table.
    The copy is one narrow stage per table: nothing is shuffled.
    """
    paths = {}
    for name in select_tables(names, including):
        paths[name] = f"{target.rstrip('/')}/{schema}/{name}"
        read(name).write.mode("overwrite").parquet(paths[name])
    return paths


def merged_counts(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """Row counts on both sides of a copy."""
    tagged = left.select(F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return tagged.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("l"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("copied_rows"),
    ).withColumn("complete", F.col("source_rows") == F.col("copied_rows"))
