"""Upsert into a relational table: stage with Spark, merge inside the database.

Spark's JDBC writer appends or replaces but does not upsert.  The changes are
therefore written in parallel to a staging table, and two statements in one
transaction apply them.  Running a batch again applies the same rows again,
which changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ebbtide.specs import TableSpec

# SQL types of the result tables.
SQL_TYPES = {
    T.IntegerType: "integer",
    T.LongType: "bigint",
    T.StringType: "text",
    T.DoubleType: "double precision",
    T.TimestampType: "timestamp",
    T.DateType: "date",
    T.BooleanType: "boolean",
}


def quoted(name: str) -> str:
    """An identifier, as standard SQL quotes it."""
    return '"' + name.replace('"', '""') + '"'


def _list(names) -> str:
    return ", ".join(map(quoted, names))


@dataclass(frozen=True)
class JdbcUpsert:
    """Keys may be NULL (a category can be unknown), so a unique index in which NULLs are equal stands in for a primary key."""

    url: str
    options: Mapping[str, str]
    first_seen: str | None = None

    def create_statement(self, spec: TableSpec) -> str:
        columns = [f"{quoted(f.name)} {SQL_TYPES[type(f.dataType)]}" for f in spec.schema.fields]
        if self.first_seen:
            columns.append(f"{quoted(self.first_seen)} timestamp DEFAULT now()")
        return f"CREATE TABLE IF NOT EXISTS {quoted(spec.name)} ({', '.join(columns)})"

    def key_statement(self, spec: TableSpec) -> str:
        return (
            f"CREATE UNIQUE INDEX IF NOT EXISTS {quoted(spec.name + '_key')} ON {quoted(spec.name)} "
            f"({_list(spec.key)}) NULLS NOT DISTINCT"
        )

    def delete_statement(self, spec: TableSpec, staging: str) -> str:
        same = " AND ".join(f"t.{quoted(k)} IS NOT DISTINCT FROM s.{quoted(k)}" for k in spec.key)
        return f'DELETE FROM {quoted(spec.name)} t USING {quoted(staging)} s WHERE s."_deleted" AND {same}'

    def upsert_statement(self, spec: TableSpec, staging: str) -> str:
        names = _list(spec.columns)
        updates = ", ".join(f"{quoted(c)} = EXCLUDED.{quoted(c)}" for c in spec.values)
        action = f"UPDATE SET {updates}" if updates else "NOTHING"
        return (
            f'INSERT INTO {quoted(spec.name)} ({names}) SELECT {names} FROM {quoted(staging)} WHERE NOT "_deleted" '
            f"ON CONFLICT ({_list(spec.key)}) DO {action}"
        )

    def write(self, changes: DataFrame, spec: TableSpec) -> None:
        """Apply one row per key, with ``_deleted``, to the target table."""
        staging = f"{spec.name}_staging"
        writer = changes.select(*spec.columns, "_deleted").write.format("jdbc").mode("overwrite")
        writer.option("url", self.url).option("dbtable", quoted(staging)).options(**self.options).save()
        self._run(
            changes,
            self.create_statement(spec),
            self.key_statement(spec),
            self.delete_statement(spec, staging),
            self.upsert_statement(spec, staging),
        )

    def _run(self, df: DataFrame, *statements: str) -> None:
        jvm = df.sparkSession.sparkContext._jvm
        properties = jvm.java.util.Properties()
        for key, value in self.options.items():
            properties.setProperty(key, value)
        connection = jvm.java.sql.DriverManager.getConnection(self.url, properties)
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            for sql in statements:
                statement.executeUpdate(sql)
            connection.commit()
        finally:
            connection.close()
