"""Row views as native stream-stream joins.

Signed streams are joined in append mode with the state of both sides in the
state store.  There is no time bound: bounding a signed join by an interval
would keep an insertion and lose its retraction.  State therefore grows with
the live and retracted history; ``statement_set`` is the form that can expire
idle rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ebbtide.operators import signed as S
from ebbtide.plans import views
from ebbtide.sinks.keyed import SumTable, UpsertTable, keyed_changes
from ebbtide.sources import changelog, topics
from ebbtide.specs import TableSpec
from ebbtide.streaming.parallel import adaptive


def signed_topic(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """A topic as an unbounded signed table."""
    return S.project(changelog.signed(topics.decode_topic(changes, spec)), *spec.columns)


def start_upserts(
    rows: DataFrame, table: UpsertTable, checkpoint: str, every: str | None = "30 seconds", drain: bool = False
) -> StreamingQuery:
    """Keep a keyed table up to date with a signed stream."""
    table.create_if_absent()

    def write(batch: DataFrame, number: int) -> None:
        table.compact(number - 1)
        batch = batch.persist()
        at = batch.agg(F.max("_at").alias("at")).first()["at"]
        if at is not None:
            table.write(number, keyed_changes(batch.drop("_at"), table.spec), F.lit(at))
        batch.unpersist()

    return _start(topics.with_processing_time(rows, "_at"), write, checkpoint, every, drain)


def start_totals(
    joined: DataFrame, by: str, table: SumTable, checkpoint: str, every: str | None = "30 seconds", drain: bool = False
) -> StreamingQuery:
    """Keep ``line_items, revenue, priced`` per ``by`` up to date with a signed stream
    that has a column ``amount``.

    Spark takes no running aggregate behind a stream-stream join, so each batch
    is aggregated on its own and added to the table.
    """
    table.create_if_absent()

    def write(batch: DataFrame, number: int) -> None:
        table.compact(number - 1)
        table.write(number, batch.groupBy(by).agg(*views.signed_sums(batch, F.col("amount"))))

    return _start(joined, write, checkpoint, every, drain)


def windowed(lines: DataFrame, time: str, duration: str, late_by: str) -> DataFrame:
    """Event-time windows in append mode: a window appears once the watermark has
    passed its end.  The watermark is our addition; processing-time windows, which
    need none, are in ``statement_set``."""
    return views.revenue_by_window(lines.withWatermark(time, late_by), time, duration)


def _start(df: DataFrame, write, checkpoint: str, every: str | None, drain: bool) -> StreamingQuery:
    def apply(batch: DataFrame, number: int) -> None:
        with adaptive(batch):
            write(batch, number)

    writer = df.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=every)
    return writer.start()
