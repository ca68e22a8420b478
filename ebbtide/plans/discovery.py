"""Finding keys and references that nobody declared.

Keys: level by level, sets of columns that identify the rows and have no
smaller such set in them. A set whose columns have too few values between them
is passed over unread, one whose estimated number of values is far from the
number of rows unread a second time; the others are counted.

References: columns whose values all occur in a key. Sketches of the values
rule out most pairs: if the values of a child are among those of a parent, the
union of both sketches is the parent's. What is left is compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from itertools import combinations
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.session import shuffles_removed
from ebbtide.streaming.parallel import together

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: What can be part of a key.
IDENTIFYING = (*WHOLE, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)

#: Relative deviation of the estimates, and how many of them a set may miss the number of rows by.
DEVIATION = 0.02
DEVIATIONS = 6
#: Sketches hold 2 to this many registers.
SKETCH_BITS = 12
#: Values that are grouped at once to see whether one of them repeats.
VALUES_AT_ONCE = 1 << 24

REFERENCE_COLUMNS = {
    "child_table": "STRING", "fk_column": "STRING", "parent_table": "STRING", "parent_column": "STRING",
    "n_values": "BIGINT", "n_parent_values": "BIGINT", "named_alike": "BOOLEAN",
}
KEY_SCHEMA = "table_name STRING, key_columns STRING, n_columns INT"


def identifying_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, IDENTIFYING)]


def _row(columns: Iterable[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in columns])


def minimal_keys(df: DataFrame, columns: Sequence[str] | None = None, largest: int = 5) -> list[tuple[str, ...]]:
    """Sets of at most ``largest`` columns that are never null, identify the rows, and have no part that does.

    The driver sees one row of counts for each level. A level estimates all its sets in one
    pass; the values of sets that may be keys are counted in a second one, within each task before the shuffle.
    """
    names = list(columns or identifying_columns(df))
    first = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(c).alias(f"c{i}") for i, c in enumerate(names)],
        *[F.approx_count_distinct(c, DEVIATION).alias(f"d{i}") for i, c in enumerate(names)],
    ).first()
    n = first["n"]
    if n == 0:
        return []
    slack = 1 + DEVIATIONS * DEVIATION
    distinct = {c: first[f"d{i}"] * slack for i, c in enumerate(names) if first[f"c{i}"] == n}
    keys: list[tuple[str, ...]] = []
    for size in range(1, largest + 1):
        wide = [
            s
            for s in combinations([c for c in names if c in distinct], size)
            if prod(distinct[c] for c in s) >= n and not any(set(k) <= set(s) for k in keys)
        ]
        if size > 1 and wide:
            near = df.agg(*[F.approx_count_distinct(_row(s), DEVIATION).alias(str(i)) for i, s in enumerate(wide)]).first()
            wide = [s for i, s in enumerate(wide) if near[i] * slack >= n]
        repeated = _repeated(df, wide, n)
        keys += [s for i, s in enumerate(wide) if i not in repeated]
    return keys


def _repeated(df: DataFrame, sets: Sequence[tuple[str, ...]], n: int) -> set[int]:
    """Which of some sets of columns have a value that occurs twice among ``n`` rows: by 128 bits of it.

    Values are dealt over slices by their hash, so equal ones are in one slice, and about ``VALUES_AT_ONCE`` are grouped in
    a job. A set that repeats a value in one slice is not looked at in the next; what is no key mostly does in the first.
    """
    slices, at = max(1, -(-n * len(sets) // VALUES_AT_ONCE)), 0
    left = set(range(len(sets)))
    while left and at < slices:
        end = min(slices, at + max(1, slices * VALUES_AT_ONCE // max(1, n * len(left))))
        values = [F.struct(F.lit(i).alias("i"), _row(sets[i]).alias("h1"), F.xxhash64(F.lit(1), *sets[i]).alias("h2")) for i in sorted(left)]
        each = df.select(F.explode(F.array(*values)).alias("v")).select("v.*")
        if slices > 1:
            slice_ = F.pmod(F.col("h1"), F.lit(slices))
            each = each.where((slice_ >= at) & (slice_ < end))
        twice = each.groupBy("i", "h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        left -= {r["i"] for r in twice.select("i").distinct().collect()}
        at = end
    return set(range(len(sets))) - left


def discovered_keys(tables: Mapping[str, DataFrame], largest: int = 5) -> DataFrame:
    """``table_name, key_columns, n_columns``: the minimal keys of each table."""
    spark = next(iter(tables.values())).sparkSession
    with shuffles_removed(spark):
        found = together(spark, *[lambda df=df: minimal_keys(df, largest=largest) for df in tables.values()])
    rows = [(name, ",".join(k), len(k)) for name, keys in zip(tables, found) for k in keys]
    return spark.createDataFrame(rows, KEY_SCHEMA)


# -- references

def _comparable(df: DataFrame, column: str) -> str | None:
    """The type in which a column can be compared with others, if any."""
    kind = df.schema[column].dataType
    return "bigint" if isinstance(kind, WHOLE) else "string" if isinstance(kind, T.StringType) else None


def _sketches(name: str, df: DataFrame) -> list[dict]:
    """Name, type, sketch, least and greatest value of each column with values; one pass over the table."""
    columns = [c for c in df.columns if _comparable(df, c)]
    if not columns:
        return []
    aggregates = []
    for i, c in enumerate(columns):
        value = F.col(c).cast(_comparable(df, c))
        aggregates += [
            F.hll_sketch_agg(value, F.lit(SKETCH_BITS)).alias(f"s{i}"),
            F.min(value).alias(f"a{i}"),
            F.max(value).alias(f"z{i}"),
        ]
    row = df.agg(*aggregates).first()
    return [
        {"table": name, "column": c, "type": _comparable(df, c), "sketch": row[f"s{i}"], "low": row[f"a{i}"], "high": row[f"z{i}"]}
        for i, c in enumerate(columns)
        if row[f"a{i}"] is not None
    ]


def possible_references(tables: Mapping[str, DataFrame], parents: Iterable[tuple[str, str]]) -> list[tuple[dict, dict]]:
    """Pairs of child column and parent key that sketches and ranges do not rule out.

    A pair is ruled out if the child has values beyond the parent's range, or its sketch adds more to the parent's than
    ``DEVIATIONS`` standard deviations of an estimate.
    Held on the driver are sketches of some kilobytes for each column of each table, whatever the tables' size.
    """
    spark = next(iter(tables.values())).sparkSession
    found = together(spark, *[lambda n=n, df=df: _sketches(n, df) for n, df in tables.items()])
    seen = [s for of_table in found for s in of_table]
    wanted = set(parents)
    keys = [s for s in seen if (s["table"], s["column"]) in wanted]
    pairs = [
        (i, j, c["sketch"], p["sketch"])
        for i, c in enumerate(seen)
        for j, p in enumerate(keys)
        if (c["table"], c["column"]) != (p["table"], p["column"])
        and c["type"] == p["type"]
        and p["low"] <= c["low"]
        and c["high"] <= p["high"]
    ]
    if not pairs:
        return []
    both = F.hll_sketch_estimate(F.hll_union("child", "parent"))
    alone = F.hll_sketch_estimate("parent")
    # the registers are the same if the child adds nothing, but they may be estimated in another way
    near = both <= alone * (1 + DEVIATIONS * 1.04 / 2 ** (SKETCH_BITS / 2))
    left = spark.createDataFrame(pairs, "i INT, j INT, child BINARY, parent BINARY").where(near)
    return [(seen[r["i"]], keys[r["j"]]) for r in left.select("i", "j").collect()]


def discovered_references(tables: Mapping[str, DataFrame], parents: Iterable[tuple[str, str]]) -> DataFrame:
    """``child_table, fk_column, parent_table, parent_column, n_values, n_parent_values, named_alike``.

    One row for each column with values all of which occur in a key among ``parents`` (table, column).
    Small whole numbers occur in many keys by chance: ``named_alike`` tells columns whose names end
    in the same word. The values of all children that a parent may have are joined with it at once, each value once.
    """
    spark = next(iter(tables.values())).sparkSession
    by_parent: dict[tuple[str, str], list[dict]] = {}
    for child, parent in possible_references(tables, parents):
        by_parent.setdefault((parent["table"], parent["column"]), []).append(child)
    parts = []
    for (table, column), children in by_parent.items():
        kind = children[0]["type"]
        parent = tables[table].select(F.col(column).cast(kind).alias("value"), F.lit(True).alias("there")).where("value IS NOT NULL")
        parent = parent.distinct()
        values = [
            tables[c["table"]].select(
                F.lit(c["table"]).alias("child_table"), F.lit(c["column"]).alias("fk_column"), F.col(c["column"]).cast(kind).alias("value")
            )
            for c in children
        ]
        stacked = reduce(DataFrame.unionByName, values).where("value IS NOT NULL").distinct()
        alike = F.element_at(F.split("fk_column", "_"), -1) == F.lit(column.split("_")[-1])
        size = parent.agg(F.count(F.lit(1)).alias("n_parent_values")).withColumn("parent_column", F.lit(column))
        parts.append(
            stacked.join(parent, "value", "left")
            .groupBy("child_table", "fk_column")
            .agg(F.count(F.lit(1)).alias("n_values"), F.count_if(F.col("there").isNull()).alias("n_missing"))
            .where("n_missing = 0")
            .select("child_table", "fk_column", F.lit(table).alias("parent_table"), F.lit(column).alias("parent_column"), "n_values", alike.alias("named_alike"))
            .join(size, "parent_column")
            .select(*REFERENCE_COLUMNS)
        )
    if not parts:
        return spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in REFERENCE_COLUMNS.items()))
    return reduce(DataFrame.unionByName, parts)
