import edgelog as E
import pytest
from conftest import rows
from pyspark.sql import functions as F

from ebbtide import specs
from ebbtide.functions import line_amount
from ebbtide.operators import signed as S
from ebbtide.plans import views
from ebbtide.sinks.keyed import SumTable, UpsertTable
from ebbtide.sources import changelog, topics
from ebbtide.specs import GOODS_INFO, ORDER_GOODS, ORDER_INFO
from ebbtide.streaming import health, live, rates


@pytest.fixture
def source(spark, tmp_path):
    """The rich log in three files per topic, read one file at a time."""
    path, events = str(tmp_path / "topics"), E.rich().events
    for begin in range(0, len(events), 10):
        topics.write_changes(E.Log().df(spark, events[begin : begin + 10]).coalesce(1), path)
    return lambda: topics.file_changes(spark, path, maxFilesPerTrigger="3")


def test_stream_stream_join_feeds_a_keyed_table(spark, source, tmp_path):
    li, oi, gi = (live.signed_topic(source(), s) for s in (ORDER_GOODS, ORDER_INFO, GOODS_INFO))
    table = UpsertTable(spark, str(tmp_path / "enriched"), specs.ENRICHED_LINE_ITEMS, "seen_at")
    q = live.start_upserts(views.enriched(li, oi, gi), table, str(tmp_path / "c"), drain=True)
    q.awaitTermination()
    assert rows(table.read().drop("seen_at")) == sorted(E.ENRICHED, key=repr)


def test_salted_stream_join_gives_the_same_anomalies(spark, source, tmp_path):
    li, gi = (live.signed_topic(source(), s) for s in (ORDER_GOODS, GOODS_INFO))
    table = UpsertTable(spark, str(tmp_path / "anomalies"), specs.PRICING_ANOMALIES)
    live.start_upserts(
        views.pricing_anomalies(li, gi, salts=3), table, str(tmp_path / "c"), drain=True
    ).awaitTermination()
    assert rows(table.read()) == sorted(E.ANOMALIES, key=repr)


def test_running_totals_behind_a_stream_stream_join(spark, source, tmp_path):
    li, gi = (live.signed_topic(source(), s) for s in (ORDER_GOODS, GOODS_INFO))
    joined = S.join(
        S.project(li, "goods_id", line_amount().alias("amount")),
        S.project(gi, "goods_id", F.col("category_level1").alias("category")),
        "goods_id",
    )
    table = SumTable(spark, str(tmp_path / "totals"), specs.CATEGORY_TOTALS, "line_items")
    live.start_totals(joined, "category", table, str(tmp_path / "c"), drain=True).awaitTermination()
    assert rows(views.published(table.read())) == sorted(E.CATEGORIES, key=repr)


def test_event_time_windows_appear_once_the_watermark_has_passed(spark, tmp_path):
    row = E.line(1, 1, 1, 1.0, 3.0, 2)
    log = E.Log().insert(ORDER_GOODS, row, at=E.CLOCK).insert(ORDER_GOODS, {**row, "rec_id": 2}, at=E.CLOCK + 1000)
    log.insert(ORDER_GOODS, {**row, "rec_id": 3}, at=E.CLOCK + 3_600_000)
    path = str(tmp_path / "topics")
    topics.write_changes(log.df(spark).coalesce(1), path)
    events = topics.decode_topic(topics.file_changes(spark, path), ORDER_GOODS)
    li = changelog.signed(events).withColumn("t", F.timestamp_millis("ts_ms"))
    q = (
        live.windowed(li, "t", "10 seconds", "1 minute")
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "line_items", "revenue") == [(2, 12.0)]
    states = health.job_states(spark, [q]).first()
    assert states["state"] == "FINISHED" and states["failure"] is None


def test_a_failed_query_is_reported(spark, tmp_path):
    path = str(tmp_path / "topics")
    topics.write_changes(spark.createDataFrame([("order_goods", "{broken")], "topic STRING, value STRING"), path)
    li = live.signed_topic(topics.file_changes(spark, path), ORDER_GOODS)
    table = UpsertTable(spark, str(tmp_path / "t"), ORDER_GOODS)
    q = live.start_upserts(li, table, str(tmp_path / "c"), drain=True)
    with pytest.raises(Exception):
        q.awaitTermination()
    states = health.job_states(spark, [q]).first()
    assert states["state"] == "FAILED" and states["failure"]


def test_rates_and_totals(spark):
    events = topics.decode_topic(E.rich().df(spark), ORDER_GOODS).withColumn("t", F.timestamp_millis("ts_ms"))
    assert rows(rates.totals(events, "op")) == [("c", 8), ("d", 2), ("u", 2)]
    assert sum(r["events"] for r in rates.rates(events, "t", "op").collect()) == 12
    assert rates.rates(events, "t", "op", "1 hour").count() <= 6


def test_freshness_and_verdict(spark):
    now = F.expr("TIMESTAMP'2024-01-01 01:00:00'")
    windows = spark.sql("SELECT TIMESTAMP'2024-01-01 00:59:10' AS window_end")
    assert rows(health.freshness(windows, now)) == [("2024-01-01 00:59:10", "50")]
    assert health.verdict(windows, 60, now).first()["verdict"] == "current"
    assert health.verdict(windows, 40, now).first()["verdict"] == "stale"
    assert rows(health.verdict(windows.limit(0), 60, now)) == [("none", "n/a", "empty")]
    assert int(health.freshness(windows).first()["age_seconds"]) > 0
