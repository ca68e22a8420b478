"""Independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def together(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Submit independent jobs at once and wait for all; the first failure is raised.

    Small jobs then share the cluster instead of queueing behind each other.
    The threads carry the caller's job group, so stopping a stream stops them.
    """
    if not jobs:
        return []
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [r.result() for r in running]


@contextmanager
def adaptive(batch: DataFrame) -> Iterator[None]:
    """Adaptive execution for the work inside ``foreachBatch``.

    A stream runs in a copy of the session in which adaptive execution may be
    off.  The jobs on a micro-batch are ordinary batch jobs: skewed joins should
    be split and small partitions merged there as well.
    """
    conf, key = batch.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        yield
    finally:
        conf.set(key, before)
