"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Keyed streaming state lives on disk and is checkpointed as a changelog, so a
# checkpoint costs what changed in the batch and not the whole state.
STREAM_STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def builder(app: str = "ebbtide", master: str | None = None, shuffle_partitions: int | None = None):
    """A session builder with UTC, adaptive execution and on-disk stream state.

    ``shuffle_partitions`` is the parallelism of keyed state.  A streaming
    checkpoint keeps the number it was started with; batch stages start from it
    and are coalesced or split by adaptive execution.
    """
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Split a skewed join even if that costs one more exchange afterwards.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    )
    for key, value in STREAM_STATE.items():
        b = b.config(key, value)
    if master is not None:
        b = b.master(master)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b


@contextmanager
def stream_state(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """``STREAM_STATE`` for the queries started inside, on any session: ``transformWithState`` needs the store on disk.

    ``partitions`` is their parallelism of keyed state, where it is not the session's. A query keeps the settings that it
    was started with, so those of the session come back at the end.
    """
    wanted = STREAM_STATE if partitions is None else {**STREAM_STATE, "spark.sql.shuffle.partitions": str(partitions)}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go when each of them ends, and not when the driver happens to collect garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for ``name`` under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names storage every executor can reach.  Only a
    local master may fall back to a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        return tempfile.mkdtemp(prefix=f"ebbtide-{name}-")
    run = spark.sparkContext._jvm.java.util.UUID.randomUUID().toString()
    return f"{shared.rstrip('/')}/ebbtide/{name}-{run}"
