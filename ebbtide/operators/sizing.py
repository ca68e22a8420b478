"""Size checks that decide between broadcasting and another way."""

from __future__ import annotations

from pyspark.sql import DataFrame


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan.

    For file scans it starts from the real file sizes, so it grows with the data.
    """
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    return int(
        str(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    )


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst itself would broadcast ``df``."""
    return not df.isStreaming and estimated_bytes(df) <= broadcast_limit(df)
