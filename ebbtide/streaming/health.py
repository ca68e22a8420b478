"""Whether a continuous job is alive and its results are current."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ebbtide.functions import age_seconds, or_text

JOB_SCHEMA = "name STRING, state STRING, batches BIGINT, input_rows BIGINT, failure STRING"
BATCH_SCHEMA = """name STRING, batch BIGINT, observed STRING, metrics MAP<STRING, BIGINT>,
  input_rows BIGINT, seconds DOUBLE"""


def watched(df: DataFrame, name: str, **metrics: Column) -> DataFrame:
    """``df`` with whole-number aggregates worked out as its rows pass: ``events`` and those given.

    They come with the progress of each batch, so nothing is read twice.
    """
    return df.observe(name, F.count(F.lit(1)).alias("events"), *(c.alias(n) for n, c in metrics.items()))


def _batch_rows(progress) -> list[tuple]:
    """A row for each observation of a batch."""
    took = (progress.durationMs or {}).get("triggerExecution", 0) / 1000
    return [
        (
            progress.name or str(progress.id),
            int(progress.batchId),
            observed,
            {n: None if v is None else int(v) for n, v in row.asDict().items()},
            int(progress.numInputRows),
            float(took),
        )
        for observed, row in (progress.observedMetrics or {}).items()
    ]


def batches(spark: SparkSession, queries: Iterable[StreamingQuery]) -> DataFrame:
    """What was ``watched`` in the recent batches of queries, one row per batch and observation.

    Spark keeps ``spark.sql.streaming.numRecentProgressUpdates`` batches; ``BatchMetrics`` hears of all.
    """
    return spark.createDataFrame([r for q in queries for p in q.recentProgress for r in _batch_rows(p)], BATCH_SCHEMA)


class BatchMetrics(StreamingQueryListener):
    """Hears of every batch while queries run, and of how they end.

    Register with ``spark.streams.addListener``. The last ``keep`` rows stay;
    Spark tells a little after the batch.
    """

    def __init__(self, keep: int = 10_000):
        self.rows: deque[tuple] = deque(maxlen=keep)
        self.failures: deque[tuple[str, str]] = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.rows.extend(_batch_rows(event.progress))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception is not None:
            self.failures.append((str(event.id), str(event.exception).splitlines()[0]))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), BATCH_SCHEMA)


def job_states(spark: SparkSession, queries: Iterable[StreamingQuery]) -> DataFrame:
    """One row per continuous query."""
    rows = []
    for q in queries:
        failed = q.exception()
        state = "FAILED" if failed is not None else "RUNNING" if q.isActive else "FINISHED"
        last = q.lastProgress
        rows.append(
            (
                q.name or q.id,
                state,
                None if last is None else int(last["batchId"]) + 1,
                None if last is None else int(last["numInputRows"]),
                None if failed is None else str(failed).splitlines()[0],
            )
        )
    return spark.createDataFrame(rows, JOB_SCHEMA)


def freshness(windows: DataFrame, now: Column | None = None) -> DataFrame:
    """The newest window and its age in seconds; ``none`` and ``n/a`` for an empty table."""
    newest = F.max("window_end")
    now = F.current_timestamp() if now is None else now
    return windows.agg(newest.alias("_newest")).select(
        or_text(F.col("_newest"), "none").alias("newest_window"),
        or_text(age_seconds(F.col("_newest"), now), "n/a").alias("age_seconds"),
    )


def verdict(windows: DataFrame, stale_after: int, now: Column | None = None) -> DataFrame:
    """``freshness`` with a verdict: ``empty``, ``stale`` or ``current``."""
    age = F.col("age_seconds")
    return freshness(windows, now).withColumn(
        "verdict",
        F.when(age == "n/a", "empty").when(age.cast("bigint") > stale_after, "stale").otherwise("current"),
    )


def job_verdict(jobs: DataFrame, windows: DataFrame, stale_after: int, now: Column | None = None) -> DataFrame:
    """``verdict`` that knows the queries (``job_states``) as well, with the names of those that failed.

    ``failed`` if any query has failed and ``stopped`` if none runs, before what the windows say.
    """
    counted = jobs.agg(
        F.count_if(F.col("state") == "RUNNING").alias("running"),
        F.sort_array(F.collect_list(F.when(F.col("state") == "FAILED", F.col("name")))).alias("failed"),
    ).withColumn("_one", F.lit(1))
    seen = verdict(windows, stale_after, now).withColumn("_one", F.lit(1))  # one row each
    state = F.when(F.size("failed") > 0, "failed").when(F.col("running") == 0, "stopped").otherwise(F.col("verdict"))
    return seen.join(counted, "_one").select("newest_window", "age_seconds", "running", "failed", state.alias("verdict"))
