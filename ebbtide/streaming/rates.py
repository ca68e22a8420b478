"""Throughput and latency of a change log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.sources.changelog import judged
from ebbtide.specs import TableSpec

#: Upper bounds of latency buckets in seconds.
BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)


def rates(events: DataFrame, time: Column | str, by: str, every: str = "1 second") -> DataFrame:
    """Events per ``every`` and kind.  Works on batch and streaming input."""
    time = F.col(time) if isinstance(time, str) else time
    grouped = events.groupBy(F.window(time, every).alias("_window"), F.col(by)).agg(
        F.count(F.lit(1)).alias("events")
    )
    return grouped.select(F.col("_window.start").alias("second"), by, "events")


def totals(events: DataFrame, by: str) -> DataFrame:
    """Events per kind over the whole log."""
    return events.groupBy(by).agg(F.count(F.lit(1)).alias("events"))


def latencies(events: DataFrame, seconds: Column | str, by: str, buckets: Sequence[float] = BUCKETS) -> DataFrame:
    """A latency histogram per kind: ``<by>, le, events, seconds``.

    ``events`` counts those that took at most ``le`` seconds; the row with a
    null ``le`` counts all. ``seconds`` is the total of the kind, on each of its
    rows. Null latencies do not count. One aggregate with a row per kind, so a
    hot kind leaves each task as one row; works on batch and streaming input.
    """
    took = (F.col(seconds) if isinstance(seconds, str) else seconds).cast("double")
    at_most = [F.count_if(took <= F.lit(float(b))).alias(f"_le{i}") for i, b in enumerate(buckets)]
    grouped = events.groupBy(by).agg(*at_most, F.count(took).alias("_all"), F.coalesce(F.sum(took), F.lit(0.0)).alias("seconds"))
    bounds = [F.struct(F.lit(float(b)).alias("le"), F.col(f"_le{i}").alias("events")) for i, b in enumerate(buckets)]
    everything = F.struct(F.lit(None).cast("double").alias("le"), F.col("_all").alias("events"))
    return grouped.select(by, "seconds", F.inline(F.array(*bounds, everything))).select(by, "le", "events", "seconds")


def outcomes(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """``outcome, events`` of raw events (``value``): how many can be applied, and how many show which fault."""
    return totals(judged(raw, spec).select(F.coalesce("fault", F.lit("applied")).alias("outcome")), "outcome")
