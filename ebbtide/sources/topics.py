"""Change topics as unbounded or bounded tables.

Each reader returns ``topic, value`` and, where the transport numbers its
records, ``seq``; ``decode_topic`` turns one topic into envelopes.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.sources.changelog import decode
from ebbtide.specs import TableSpec

EARLIEST, LATEST = "earliest", "latest"

FILE_SCHEMA = T.StructType([T.StructField("value", T.StringType()), T.StructField("topic", T.StringType())])


def kafka_options(
    servers: str, topics: Sequence[str], start: str | Mapping[str, Mapping[str, int]] = LATEST
) -> dict[str, str]:
    """Options of Spark's Kafka source.

    ``start`` is ``earliest``, ``latest`` or offsets per topic and partition.
    It only applies to a first start; afterwards the checkpoint decides.
    """
    if isinstance(start, str) and start not in (EARLIEST, LATEST):
        raise ValueError(f"start position {start!r} is neither {EARLIEST} nor {LATEST}")
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": start if isinstance(start, str) else json.dumps(start),
    }


def kafka_changes(
    spark: SparkSession,
    servers: str,
    topics: Mapping[str, str | Mapping[str, Mapping[str, int]]],
    streaming: bool = True,
    **options: str,
) -> DataFrame:
    """Topics from Kafka, each with its own start position.

    Needs the Kafka source package on the class path.  Facts usually start at
    ``latest`` and a catalog that is seeded once at ``earliest``; one source is
    opened per distinct position.
    """
    by_start: dict[str, list[str]] = {}
    for topic, start in topics.items():
        by_start.setdefault(start if isinstance(start, str) else json.dumps(start), []).append(topic)
    parts = []
    for start, names in by_start.items():
        where = start if start in (EARLIEST, LATEST) else json.loads(start)
        opts = {**kafka_options(servers, names, where), **options}
        reader = spark.readStream if streaming else spark.read
        if not streaming:
            if where == LATEST:
                raise ValueError(f"a bounded read of {names} cannot start at {LATEST}: nothing comes after it")
        raw = reader.format("kafka").options(**opts).load()
        parts.append(
            raw.select("topic", F.col("value").cast("string").alias("value"), F.col("offset").alias("seq"))
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def file_changes(spark: SparkSession, path: str, streaming: bool = True, **options: str) -> DataFrame:
    """Topics kept as JSON lines under ``path/topic=<name>/``."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("text").schema(FILE_SCHEMA).options(**options).load(path).select("topic", "value")


def write_changes(encoded: DataFrame, path: str, mode: str = "append", compression: str | None = None) -> None:
    """Append encoded events (``topic, value``) as JSON lines, one folder per topic; ``file_changes`` reads any ``compression``."""
    encoded.select("topic", "value").write.partitionBy("topic").mode(mode).text(path, compression=compression)


def with_processing_time(changes: DataFrame, column: str = "proc_time") -> DataFrame:
    """When the row was read.

    In a stream this is the start of the micro-batch as the offset log records
    it, so a batch that runs again sees the same time.
    """
    return changes.withColumn(column, F.current_timestamp())


def from_position(events: DataFrame, seq: int) -> DataFrame:
    """Decoded events at or after a position of the log."""
    return events.where(F.col("seq") >= seq)


def decode_topic(changes: DataFrame, spec: TableSpec, topic: str | None = None) -> DataFrame:
    return decode(changes.where(F.col("topic") == (topic or spec.name)).drop("topic"), spec)
