"""Latency buckets, metrics of batches as they run, and reports of catalog and files."""

import os
import time

import pytest
from pyspark.sql import functions as F

from ebbtide.plans import quality
from ebbtide.streaming import health, rates


def test_latency_buckets(spark):
    took = [("a", 0.004), ("a", 0.005), ("a", 0.3), ("a", 99.0), ("a", None), ("b", None), (None, 1.0)]
    events = spark.createDataFrame(took, "op string, s double")
    got = rates.latencies(events, "s", "op", (0.005, 0.5)).collect()
    counted = {(r["op"], r["le"]): r["events"] for r in got}
    assert counted == {
        ("a", 0.005): 2, ("a", 0.5): 3, ("a", None): 4,
        ("b", 0.005): 0, ("b", 0.5): 0, ("b", None): 0,
        (None, 0.005): 0, (None, 0.5): 0, (None, None): 1,
    }
    assert {r["op"]: r["seconds"] for r in got} == {"a": pytest.approx(99.309), "b": 0.0, None: 1.0}
    assert rates.latencies(events.limit(0), "s", "op").collect() == []


def test_batches_are_observed_as_they_run(spark, tmp_path):
    for i in range(3):
        spark.range(10 * (i + 1)).select((F.col("id") % 5).alias("k")).coalesce(1).write.parquet(str(tmp_path / f"in/part={i}"))
    heard = health.BatchMetrics()
    spark.streams.addListener(heard)
    try:
        rows = spark.readStream.schema("k bigint").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/part=*"))
        seen = health.watched(rows, "rows", zeros=F.count_if(F.col("k") == 0))
        q = seen.writeStream.format("noop").queryName("watch").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination()
        now = health.batches(spark, [q]).where("input_rows > 0").collect()
        assert sorted((r["metrics"]["events"], r["metrics"]["zeros"]) for r in now) == [(10, 2), (20, 4), (30, 6)]
        assert {(r["name"], r["observed"]) for r in now} == {("watch", "rows")} and len({r["batch"] for r in now}) == 3
        until = time.time() + 20
        while time.time() < until and sum(r[3]["events"] for r in heard.rows) < 60:
            time.sleep(0.1)
        assert sorted(r["metrics"]["events"] for r in heard.frame(spark).where("input_rows > 0").collect()) == [10, 20, 30]

        bad = rows.select(F.raise_error(F.lit("broken")).alias("x"))
        q = bad.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "d")).trigger(availableNow=True).start()
        with pytest.raises(Exception, match="broken"):
            q.awaitTermination()
        until = time.time() + 20
        while time.time() < until and not heard.failures:
            time.sleep(0.1)
        assert [f[0] for f in heard.failures] == [str(q.id)]
    finally:
        spark.streams.removeListener(heard)


def test_schemas_without_ignored_ones(spark, tmp_path):
    spark.sql(f"CREATE DATABASE shop LOCATION '{tmp_path}/shop'")
    try:
        assert {"default", "shop"} <= {r[0] for r in quality.schema_list(spark).collect()}
        left = {r[0] for r in quality.schema_list(spark, ["default"]).collect()}
        assert "shop" in left and "default" not in left
    finally:
        spark.sql("DROP DATABASE shop")


def test_server_and_sizes(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "a"))
    spark.range(10).write.parquet(str(tmp_path / "b"))
    tables = {n: spark.read.parquet(str(tmp_path / n)) for n in ("b", "a")}
    got = quality.server(quality.size_report(spark, tables, {n: str(tmp_path / n) for n in tables})).collect()
    files = {n: [f for f in os.listdir(tmp_path / n) if f.endswith(".parquet")] for n in tables}
    size = {n: sum(os.path.getsize(tmp_path / n / f) for f in files[n]) for n in tables}
    assert [r["table_name"] for r in got] == sorted(size, key=size.get, reverse=True)
    for r in got:
        assert r["rows"] == {"a": 1000, "b": 10}[r["table_name"]] and r["files"] == len(files[r["table_name"]])
        assert float(r["total_mb"]) == pytest.approx(size[r["table_name"]] / 2**20, abs=0.006)
        assert r["engine_version"].startswith(spark.version) and r["current_schema"] == "default"


def test_now_is_the_clock(spark):
    newest = spark.sql("SELECT current_timestamp() - INTERVAL 100 SECONDS AS window_end")
    assert 100 <= int(health.freshness(newest).first()["age_seconds"]) <= 130
