"""The continuous job, run to the end of the change log, and the keyed sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide import specs
from ebbtide.session import work_dir
from ebbtide.sinks.files import Folder
from ebbtide.sinks.keyed import SumTable, UpsertTable, keyed_changes
from ebbtide.sources import changelog, segments, topics
from ebbtide.streaming.statement_set import Settings, StatementSet
from ebbtide.operators import signed as S
from ebbtide.plans import views
from ebbtide.suite import retail as R
from ebbtide.suite.changes import SIGNED_WINDOW_SQL
from ebbtide.suite.registry import ORACLES, query
from ebbtide.suite.relational import ANOMALY_SQL, CATEGORY_SQL, ENRICHED_SQL, rounded

_runs: dict[tuple, StatementSet] = {}


def _consumed(spark: SparkSession, inbox: str) -> None:
    """Delete topic files that the job has read and committed, as the retention of a topic would."""
    folder = Folder(spark, inbox)
    for topic in folder.list():
        folder.remove(topic)


def _drained(job: StatementSet, log: R.ChangeLog, periods: Sequence[int], inbox: str) -> None:
    """Periods of the log as topic files, each read to its end by the job's stream before the next one is written."""
    for period in periods:
        log.append(inbox, period)
        job.start(topics.file_changes(job.spark, inbox), drain=True).awaitTermination()
        _consumed(job.spark, inbox)


def finished_job(spark: SparkSession, d: str, reseeded: bool = False) -> StatementSet:
    """The statement set after it has consumed the whole log, once per session and folder.

    The topic files are read back as a stream, a micro-batch for each period.
    Line-items come with and after the seeds of their products.
    """
    run = (spark.sparkContext.applicationId, d, reseeded)
    if run not in _runs:
        log = R.log(spark, d, reseeded)
        settings = Settings(
            window_on="event_time",
            fan_in=3,
            line_items=R.LINES,
            orders=R.ORDERS,
            products=R.PRODUCTS,
            topics={s.name: log.prefix + s.name for s in (R.LINES, R.ORDERS, R.PRODUCTS)},
        )
        job = StatementSet(spark, work_dir(spark, "statement-set"), settings)
        _drained(job, log, log.periods, work_dir(spark, "topics"))
        _runs[run] = job
    return _runs[run]


@query("streamed_enriched_line_items", R.SQL + ENRICHED_SQL.format(li="li2", oi="oi2", gi="gi2"))
def streamed_enriched_line_items(spark: SparkSession, d: str) -> DataFrame:
    return finished_job(spark, d).read("enriched_line_items").drop("seen_at")


@query("streamed_revenue_by_category", R.SQL + CATEGORY_SQL.format(li="li2", gi="gi2"))
def streamed_revenue_by_category(spark: SparkSession, d: str) -> DataFrame:
    return rounded(finished_job(spark, d).read("revenue_by_category"), "revenue")


@query("streamed_revenue_by_window", R.SQL + SIGNED_WINDOW_SQL)
def streamed_revenue_by_window(spark: SparkSession, d: str) -> DataFrame:
    rows = finished_job(spark, d).read("revenue_by_window")
    for c in ("window_start", "window_end"):
        rows = rows.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return rounded(rows, "revenue")


@query("streamed_pricing_anomalies", R.SQL + ANOMALY_SQL.format(li="li2", gi="gi2"))
def streamed_pricing_anomalies(spark: SparkSession, d: str) -> DataFrame:
    return finished_job(spark, d).read("pricing_anomalies").drop("detected_at")


# -- a log with prefixed topics, ordered by source.lsn, whose catalog is seeded by updates that change nothing

@query("streamed_enriched_reseeded_catalog", R.SQL + ENRICHED_SQL.format(li="li2", oi="oi2", gi="gi2"))
def streamed_enriched_reseeded_catalog(spark: SparkSession, d: str) -> DataFrame:
    return finished_job(spark, d, reseeded=True).read("enriched_line_items").drop("seen_at")


@query("streamed_category_revenue_reseeded", R.SQL + CATEGORY_SQL.format(li="li2", gi="gi2"))
def streamed_category_revenue_reseeded(spark: SparkSession, d: str) -> DataFrame:
    return rounded(finished_job(spark, d, reseeded=True).read("revenue_by_category"), "revenue")


@query("streamed_anomalies_reseeded", R.SQL + ANOMALY_SQL.format(li="li2", gi="gi2"))
def streamed_anomalies_reseeded(spark: SparkSession, d: str) -> DataFrame:
    return finished_job(spark, d, reseeded=True).read("pricing_anomalies").drop("detected_at")


@query("category_revenue_reseeded", R.SQL + CATEGORY_SQL.format(li="li2", gi="gi2"))
def category_revenue_reseeded(spark: SparkSession, d: str) -> DataFrame:
    """The same log in batch: rows that it takes for granted are added first."""
    tables = []
    for spec in (R.LINES, R.PRODUCTS):
        events = R.decoded(spark, d, spec, reseeded=True)
        signed = S.project(changelog.signed(events), *spec.columns)
        tables.append(S.union(signed, changelog.opening(events, spec)))
    return rounded(views.revenue_by_category(*tables), "revenue")


# -- by the clock, after a restart, and with rows that expire

def _settings(**other) -> Settings:
    return Settings(fan_in=3, line_items=R.LINES, orders=R.ORDERS, products=R.PRODUCTS, **other)


def _applied(job: StatementSet, log: R.ChangeLog) -> None:
    """Each period of the log as one micro-batch, read from topic files at the beginning of that period."""
    inbox = work_dir(job.spark, "topics")
    for number, period in enumerate(log.periods):
        log.append(inbox, period)
        changes = topics.file_changes(job.spark, inbox, streaming=False).select("topic", "value")
        job.apply(changes.withColumn("proc_time", F.expr(f"make_timestamp({period}, 1, 1, 0, 0, 0)")), number)
        _consumed(job.spark, inbox)


@query(
    "windows_by_read_time",
    R.SQL + """SELECT make_timestamp(year(tm) - year(tm) % 2, 1, 1, 0, 0, 0) AS window_start,
  make_timestamp(year(tm) - year(tm) % 2, 1, 1, 0, 0, 0) + INTERVAL '10 seconds' AS window_end,
  CAST(SUM(w) AS BIGINT) AS line_items, ROUND(SUM(w * (deal_price * goods_number)), 2) AS revenue
FROM lc GROUP BY 1, 2 HAVING SUM(w) <> 0""",
)
def windows_by_read_time(spark: SparkSession, d: str) -> DataFrame:
    """Windows of processing time: all changes of a micro-batch fall into the window in which it was read."""
    job = StatementSet(spark, work_dir(spark, "read-time"), _settings())
    job.create_if_absent()
    _applied(job, R.log(spark, d))
    rows = job.read("revenue_by_window")
    for c in ("window_start", "window_end"):
        rows = rows.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return rounded(rows, "revenue")


@query("streamed_revenue_resumed", R.SQL + CATEGORY_SQL.format(li="li2", gi="gi2"))
def streamed_revenue_resumed(spark: SparkSession, d: str) -> DataFrame:
    """The job stopped halfway and started again from its checkpoint, by another instance, with new files since."""
    log, root, inbox = R.log(spark, d), work_dir(spark, "resumed"), work_dir(spark, "inbox")
    half = len(log.periods) // 2
    for periods in (log.periods[:half], log.periods[half:]):
        job = StatementSet(spark, root, _settings(window_on="event_time"))
        _drained(job, log, periods, inbox)
    return rounded(job.read("revenue_by_category"), "revenue")


@query(
    "streamed_lines_with_expiry",
    R.SQL + """, seen AS (SELECT rec_id, MAX(year(tm) - year(tm) % 2) AS touched FROM lc GROUP BY 1)
SELECT rec_id, order_id, goods_id, deal_price FROM li2 JOIN seen USING (rec_id)
WHERE touched > (SELECT MAX(touched) - 4 FROM seen)""",
)
def streamed_lines_with_expiry(spark: SparkSession, d: str) -> DataFrame:
    """The join state under a time to live of four years: rows touched in the last two periods."""
    job = StatementSet(spark, work_dir(spark, "expiry"), _settings(ttl={R.LINES.name: "4 years"}))
    job.create_if_absent()
    periods = R.log(spark, d).periods
    _applied(job, R.log(spark, d))
    last = F.expr(f"make_timestamp({periods[-1]}, 1, 1, 0, 0, 0)")
    lines = job.state["lines"].read(len(periods) - 1, last - F.expr("INTERVAL 4 years"))
    return lines.select("rec_id", "order_id", "goods_id", "deal_price")


@query(
    "upserted_line_items",
    R.SQL + """SELECT rec_id, order_id, goods_id, goods_price, deal_price, goods_number,
  make_timestamp(year(ts) - year(ts) % 2, 1, 1, 0, 0, 0) AS seen_at FROM li2""",
)
def upserted_line_items(spark: SparkSession, d: str) -> DataFrame:
    """The keyed sink, fed period by period; each row keeps the time it was first seen."""
    sink = UpsertTable(spark, work_dir(spark, "upserts"), R.LINES, first_seen="seen_at")
    sink.create_if_absent()
    log = R.log(spark, d)
    for period in log.periods:
        events = log.period(period, R.LINES)
        at = F.expr(f"make_timestamp({period}, 1, 1, 0, 0, 0)")
        sink.write(period, keyed_changes(changelog.signed(events), R.LINES), at)
        sink.compact(period - 1, fan_in=3)
    return sink.read().withColumn("seen_at", F.col("seen_at").cast("timestamp_ntz"))


@query("accumulated_category_revenue", R.SQL + CATEGORY_SQL.format(li="li2", gi="gi"))
def accumulated_category_revenue(spark: SparkSession, d: str) -> DataFrame:
    """Running totals, fed period by period with signed sums."""
    sink = SumTable(spark, work_dir(spark, "totals"), specs.CATEGORY_TOTALS, "line_items")
    sink.create_if_absent()
    log = R.log(spark, d)
    for period in log.periods:
        events = log.period(period, R.LINES)
        sink.write(period, views.category_deltas(changelog.signed(events), R.products(spark, d)))
        sink.compact(period - 1, fan_in=3)
    return rounded(views.published(sink.read()), "revenue")


@query("events_from_segments", ORACLES["change_events_per_topic"])
def events_from_segments(spark: SparkSession, d: str) -> DataFrame:
    """The log, a segment for each period, read by a stream that stops half-way and goes on: no event is lost or read twice."""
    log, root = R.log(spark, d), work_dir(spark, "segments")
    key = F.coalesce(
        *(
            F.when(F.col("topic") == s.name, F.get_json_object("value", f"$.{image}.{s.key[0]}"))
            for s in (R.LINES, R.ORDERS, R.PRODUCTS)
            for image in ("after", "before")
        )
    )

    def append(number: int, period: int) -> None:
        segments.append_segment(log.changes(period), f"{root}/topics", key, 4, number)

    def drain() -> None:
        (
            segments.segment_changes(spark, f"{root}/topics", "earliest")
            .writeStream.format("parquet")
            .option("path", f"{root}/read")
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )

    half = len(log.periods) // 2
    for number, period in enumerate(log.periods):
        if number == half:
            drain()
        append(number, period)
    drain()
    read = spark.read.schema(segments.SCHEMA).parquet(f"{root}/read")
    return read.groupBy("topic", F.get_json_object("value", "$.op").alias("op")).agg(F.count(F.lit(1)).alias("events"))
