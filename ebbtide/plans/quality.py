"""Data-quality checks and profiles, computed from the data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions import megabytes
from ebbtide.plans.reports import largest_first, row_counts
from ebbtide.specs import TableSpec


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# -- keys

def key_check(df: DataFrame, name: str, key: Sequence[str]) -> DataFrame:
    """Whether ``key`` identifies the rows: rows, distinct keys, NULL keys, surplus rows.

    Rows are counted per key first, so a key repeated very often leaves each
    task as one row.
    """
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).select(no_key.alias("no_key"), "n")
    found = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.when(~F.col("no_key"), 1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(F.col("no_key"), F.col("n"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum(F.when(~F.col("no_key"), F.col("n") - 1)), F.lit(0)).alias("duplicates"),
    )
    return found.select(F.lit(name).alias("table_name"), F.lit(",".join(key)).alias("key_columns"), "*")


def tables_without_key(checks: DataFrame) -> DataFrame:
    """The tables whose declared key does not hold, by name."""
    broken = (F.col("null_keys") > 0) | (F.col("duplicates") > 0)
    return checks.where(broken).select("table_name").orderBy("table_name")


def missing_constraints(
    tables: DataFrame, constraints: DataFrame, on: Sequence[str], kind: str = "PRIMARY KEY"
) -> DataFrame:
    """Catalog rows of ``tables`` with no constraint of ``kind``, matched on all of ``on``."""
    wanted = constraints.where(F.col("constraint_type") == kind)
    return tables.join(wanted, list(on), "left_anti")


# -- references

@dataclass(frozen=True)
class Reference:
    """``child.column`` refers to ``parent.parent_column``."""

    child: str
    column: str
    parent: str
    parent_column: str


def references_between(specs: Iterable[TableSpec]) -> list[Reference]:
    """References implied by shared single-column keys of declared tables."""
    specs = list(specs)
    found = [
        Reference(child.name, p.key[0], p.name, p.key[0])
        for p in specs
        if len(p.key) == 1
        for child in specs
        if child is not p and p.key[0] in child.columns
    ]
    return sorted(found, key=lambda r: (r.child, r.column))


def orphans(child: DataFrame, parent: DataFrame, on: str, parent_on: str | None = None) -> DataFrame:
    """Rows of ``child`` whose reference is set and finds no parent."""
    keys = parent.select(F.col(parent_on or on).alias(on))
    return child.where(F.col(on).isNotNull()).join(keys, on, "left_anti")


def reference_check(tables: Mapping[str, DataFrame], reference: Reference) -> DataFrame:
    """One row: how many child rows refer to a parent, lack one, or have no reference.

    Child rows are counted per reference before the join, so a parent with a
    third of all children joins as one row.
    """
    key = F.col(reference.column).alias("k")
    children = tables[reference.child].groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    parents = tables[reference.parent].select(F.col(reference.parent_column).alias("k"), F.lit(True).alias("found"))
    parents = parents.where("k IS NOT NULL").dropDuplicates(["k"])
    joined = children.join(parents, "k", "left")
    sums = {
        "child_rows": F.sum("n"),
        "null_references": F.sum(F.when(F.col("k").isNull(), F.col("n"))),
        "orphans": F.sum(F.when(F.col("k").isNotNull() & F.col("found").isNull(), F.col("n"))),
    }
    found = joined.agg(*[F.coalesce(c, F.lit(0)).alias(n) for n, c in sums.items()])
    covered = F.col("child_rows") - F.col("null_references") - F.col("orphans")
    return found.select(
        F.lit(reference.child).alias("child_table"),
        F.lit(reference.column).alias("fk_column"),
        F.lit(reference.parent).alias("parent_table"),
        F.lit(reference.parent_column).alias("parent_column"),
        "*",
        F.when(F.col("child_rows") > 0, F.round(covered / F.col("child_rows"), 4)).alias("coverage"),
    )


def reference_report(tables: Mapping[str, DataFrame], references: Iterable[Reference]) -> DataFrame:
    return _union(reference_check(tables, r) for r in references).orderBy("child_table", "fk_column")


# -- sizes and shapes

def file_sizes(spark: SparkSession, paths: Mapping[str, str], suffix: str = "*.parquet") -> DataFrame:
    """Files and bytes per table.  Only the listing is used; no file content is read."""
    parts = []
    for name, path in paths.items():
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", suffix)
            .load(path)
            .select("length")
        )
        parts.append(
            files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).select(
                F.lit(name).alias("table_name"), "*"
            )
        )
    return _union(parts)


def size_report(spark: SparkSession, tables: Mapping[str, DataFrame], paths: Mapping[str, str]) -> DataFrame:
    """Exact rows and megabytes on disk per table, largest first."""
    counts = row_counts(tables, "table_name")
    sized = counts.join(file_sizes(spark, paths), "table_name").select(
        "table_name", "rows", "files", megabytes(F.col("bytes")).alias("total_mb"), "bytes"
    )
    return largest_first(sized, F.col("bytes"), "table_name").drop("bytes")


def table_list(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables and views of a database, by name."""
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "table_name STRING, table_type STRING, is_temporary BOOLEAN").orderBy("table_name")


def schema_list(spark: SparkSession, ignore: Sequence[str] = ()) -> DataFrame:
    """Databases of the catalog, without the ignored ones."""
    rows = [(d.name,) for d in spark.catalog.listDatabases()]
    return spark.createDataFrame(rows, "schema_name STRING").where(~F.col("schema_name").isin(*ignore))


def server(df: DataFrame) -> DataFrame:
    """Add the engine version and the current database to a report."""
    return df.select("*", F.version().alias("engine_version"), F.current_database().alias("current_schema"))


def _is_time(t: T.DataType) -> bool:
    return isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType))


def date_columns(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every date and time column with its type, nullability, NULLs and range.

    One pass per table computes all its columns.
    """
    parts = []
    for name, df in tables.items():
        fields = [(i, f) for i, f in enumerate(df.schema.fields) if _is_time(f.dataType)]
        if not fields:
            continue
        one_row = df.agg(
            *[F.min(f.name).alias(f"min_{i}") for i, f in fields],
            *[F.max(f.name).alias(f"max_{i}") for i, f in fields],
            *[F.count(F.when(F.col(f.name).isNull(), 1)).alias(f"null_{i}") for i, f in fields],
        )
        described = F.array(*[_describe(i, f) for i, f in fields])
        parts.append(one_row.select(F.lit(name).alias("table_name"), F.inline(described)))
    if not parts:
        raise ValueError("no table has a date or time column")
    return _union(parts).orderBy("table_name", "ordinal_position")


def _describe(i: int, field: T.StructField) -> Column:
    return F.struct(
        F.lit(i + 1).alias("ordinal_position"),
        F.lit(field.name).alias("column_name"),
        F.lit(field.dataType.simpleString()).alias("data_type"),
        F.lit("YES" if field.nullable else "NO").alias("is_nullable"),
        F.col(f"null_{i}").alias("nulls"),
        F.col(f"min_{i}").cast("string").alias("earliest"),
        F.col(f"max_{i}").cast("string").alias("latest"),
    )


# -- reconciliation

def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that occur more often on one side: the row, ``side`` and ``surplus``.

    One grouping finds the differences in both directions, with duplicates and
    NULLs counted exactly.
    """
    columns = left.columns
    tagged = left.withColumn("_d", F.lit(1)).unionByName(right.select(*columns).withColumn("_d", F.lit(-1)))
    net = tagged.groupBy(*columns).agg(F.sum("_d").alias("_d")).where("_d <> 0")
    return net.select(
        *columns, F.when(F.col("_d") > 0, "left").otherwise("right").alias("side"), F.abs("_d").alias("surplus")
    )


def reconcile(left: DataFrame, right: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """One row: counts on both sides, rows only on one side, keys whose row differs."""
    columns = [c for c in left.columns if c not in key]
    tagged = left.withColumn("_d", F.lit(1)).unionByName(right.select(*left.columns).withColumn("_d", F.lit(-1)))
    by_row = tagged.groupBy(*key, *columns).agg(
        F.sum("_d").alias("net"),
        F.sum(F.when(F.col("_d") > 0, 1).otherwise(0)).alias("l"),
        F.sum(F.when(F.col("_d") < 0, 1).otherwise(0)).alias("r"),
    )
    by_key = by_row.groupBy(*key).agg(
        F.sum("l").alias("l"),
        F.sum("r").alias("r"),
        F.sum(F.when(F.col("net") > 0, F.col("net")).otherwise(0)).alias("only_left"),
        F.sum(F.when(F.col("net") < 0, -F.col("net")).otherwise(0)).alias("only_right"),
    )
    changed = (F.col("only_left") > 0) & (F.col("only_right") > 0)
    sums = {
        "left_rows": F.sum("l"),
        "right_rows": F.sum("r"),
        "only_left": F.sum("only_left"),
        "only_right": F.sum("only_right"),
        "changed_keys": F.count(F.when(changed, 1)),
    }
    out = by_key.agg(*[F.coalesce(c, F.lit(0)).alias(n) for n, c in sums.items()])
    same = (F.col("only_left") == 0) & (F.col("only_right") == 0)
    return out.select(F.lit(name).alias("table_name"), "*", same.alias("identical"))
