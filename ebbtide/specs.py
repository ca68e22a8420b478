"""Declared tables: a name, typed columns and a key.

As in the systems that feed us, the key is declared and not enforced;
``plans.quality.key_check`` tells whether the data honours it.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}


def fields(**types: str) -> list[T.StructField]:
    """Fields from names and type names; needs no session."""
    return [T.StructField(name, TYPES[t]) for name, t in types.items()]


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    key: tuple[str, ...]

    @classmethod
    def of(cls, name: str, key: str | tuple[str, ...], **types: str) -> TableSpec:
        return cls(name, T.StructType(fields(**types)), (key,) if isinstance(key, str) else tuple(key))

    def __post_init__(self):
        missing = [k for k in self.key if k not in self.schema.names]
        if missing or not self.key:
            raise ValueError(f"{self.name}: key columns {missing or '(none)'} are not declared")

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def values(self) -> list[str]:
        return [c for c in self.schema.names if c not in self.key]

    def retyped(self, **types: str) -> TableSpec:
        """The same table with some columns declared as another type."""
        changed = [T.StructField(f.name, TYPES.get(types.get(f.name), f.dataType)) for f in self.schema.fields]
        return replace(self, schema=T.StructType(changed))

    def widened(self, **types: str) -> TableSpec:
        """The same table with further columns."""
        return replace(self, schema=T.StructType([*self.schema.fields, *fields(**types)]))

    def conform(self, df: DataFrame) -> DataFrame:
        """Only the declared columns, in order, in their declared types."""
        return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])


# Source tables.  ``order_date`` travels as days since 1970-01-01.
ORDER_INFO = TableSpec.of(
    "order_info",
    "order_id",
    order_id="int",
    user_id="int",
    country="string",
    zipcode="string",
    goods_amount="double",
    order_date="int",
    year="int",
)
ORDER_GOODS = TableSpec.of(
    "order_goods",
    "rec_id",
    rec_id="bigint",
    order_id="int",
    goods_id="bigint",
    goods_price="double",
    deal_price="double",
    goods_number="int",
)
GOODS_INFO = TableSpec.of(
    "goods_info",
    "goods_id",
    goods_id="bigint",
    goods_name="string",
    brand="string",
    category_level1="string",
    category_level2="string",
)

# Result tables.  The first-seen columns belong to the sink and not to the views.
ENRICHED_LINE_ITEMS = TableSpec.of(
    "enriched_line_items",
    "rec_id",
    rec_id="bigint",
    order_id="int",
    country="string",
    brand="string",
    category="string",
    deal_price="double",
    goods_number="int",
)
REVENUE_BY_CATEGORY = TableSpec.of(
    "revenue_by_category", "category", category="string", line_items="bigint", revenue="double"
)
REVENUE_BY_WINDOW = TableSpec.of(
    "revenue_by_window",
    ("window_start", "window_end"),
    window_start="timestamp",
    window_end="timestamp",
    line_items="bigint",
    revenue="double",
)
PRICING_ANOMALIES = TableSpec.of(
    "pricing_anomalies",
    "rec_id",
    rec_id="bigint",
    order_id="int",
    brand="string",
    goods_price="double",
    deal_price="double",
    goods_number="int",
)

# Totals as the sinks store them: the number of priced line-items tells an
# unpriced group (NULL revenue) from one worth nothing.
CATEGORY_TOTALS = REVENUE_BY_CATEGORY.widened(priced="bigint")
WINDOW_TOTALS = REVENUE_BY_WINDOW.widened(priced="bigint")

# Retractions of rows that the job never saw, by source table.
UNMATCHED = TableSpec.of("unmatched_retractions", "table_name", table_name="string", retractions="bigint")
