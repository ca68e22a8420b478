"""Input that used to vanish without an error."""

import json

import pytest
from conftest import rows
from edgelog import CATEGORIES, ENRICHED, Log, line, order, product, rich
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ebbtide.operators import signed as S
from ebbtide.plans import views
from ebbtide.sources import changelog, topics
from ebbtide.specs import GOODS_INFO, ORDER_GOODS, ORDER_INFO
from ebbtide.streaming.statement_set import Settings, StatementSet


def no_op(log, spec, row):
    return log.update(spec, row, row)


def job_of(spark, tmp_path, batches, settings=None):
    job = StatementSet(spark, str(tmp_path), settings or Settings())
    job.create_if_absent()
    for number, log in enumerate(batches):
        stamped = log.df(spark).withColumn("proc_time", F.lit(f"2024-01-01 00:{number:02d}:00").cast("timestamp"))
        job.apply(stamped, number)
    return job


@pytest.mark.parametrize("seed_in", [0, 1, 2])
def test_catalog_seeded_by_updates_without_change(spark, tmp_path, seed_in):
    """Seeds before, with and after the line-items."""
    batches = [Log(), Log(), Log()]
    no_op(batches[seed_in], GOODS_INFO, product(5, "food"))
    batches[1].insert(ORDER_INFO, order(10)).insert(ORDER_GOODS, line(1, 10, 5, 10.0, 12.0, 2))
    job = job_of(spark, tmp_path, [b for b in batches if b.events])
    assert rows(job.read("revenue_by_category")) == [("food", 1, 24.0)]
    assert rows(job.read("enriched_line_items").drop("seen_at")) == [(1, 10, "US", "acme", "food", 12.0, 2)]
    assert rows(job.read("pricing_anomalies").drop("detected_at")) == [(1, 10, "acme", 10.0, 12.0, 2)]


def test_seeding_again_changes_nothing(spark, tmp_path):
    again = Log()
    for row in (product(5, "food"), product(6, "games", "bolt"), product(7, None)):
        no_op(again, GOODS_INFO, row)
    job = job_of(spark, tmp_path, [rich(), again])
    assert rows(job.read("revenue_by_category")) == CATEGORIES_IN_ORDER
    assert rows(job.read("enriched_line_items").drop("seen_at")) == ENRICHED


CATEGORIES_IN_ORDER = sorted(CATEGORIES, key=repr)


def test_update_without_change_keeps_a_row_from_expiring(spark, tmp_path):
    settings = Settings(ttl={"order_goods": "90 seconds"})
    first, touch, price = Log(), Log(), Log()
    one = line(1, 10, 5, 10.0, 12.0, 2)
    first.insert(GOODS_INFO, product(5, "food")).insert(ORDER_INFO, order(10)).insert(ORDER_GOODS, one)
    no_op(touch, ORDER_GOODS, one)
    price.update(GOODS_INFO, product(5, "food"), product(5, "toys"))
    job = job_of(spark, tmp_path, [first, touch, price], settings)
    assert rows(job.read("revenue_by_category")) == [("toys", 1, 24.0)]


def test_batch_views_over_a_log_that_begins_in_the_middle(spark):
    log = Log()
    one = line(1, 10, 5, 10.0, 12.0, 2)
    no_op(log, GOODS_INFO, product(5, "food"))
    log.update(ORDER_GOODS, one, {**one, "deal_price": 9.0})
    parts = []
    for spec in (ORDER_GOODS, GOODS_INFO):
        events = topics.decode_topic(log.df(spark), spec)
        parts.append(S.union(S.project(changelog.signed(events), *spec.columns), changelog.opening(events, spec)))
    assert rows(views.revenue_by_category(*parts)) == [("food", 1, 18.0)]


def test_events_are_ordered_by_source_position(spark):
    events = [
        {"before": None, "after": product(5, "a"), "op": "c", "ts_ms": 1, "source": {"lsn": 30}},
        {"before": product(5, "a"), "after": product(5, "c"), "op": "u", "ts_ms": 1, "source": {"lsn": 50}},
        {"before": product(5, "c"), "after": product(5, "b"), "op": "u", "ts_ms": 1, "source": {"lsn": 200}},
    ]
    raw = spark.createDataFrame([(json.dumps(e), 9 - i) for i, e in enumerate(events)], "value STRING, seq BIGINT")
    decoded = changelog.decode(raw, GOODS_INFO)
    assert [r["category_level1"] for r in changelog.replay(decoded, GOODS_INFO).collect()] == ["b"]
    back = changelog.decode(changelog.encode(decoded, GOODS_INFO, "lsn"), GOODS_INFO)
    assert sorted(r["seq"] for r in back.collect()) == [30, 50, 200]


def test_an_event_without_position_is_a_fault(spark):
    raw = spark.createDataFrame(
        [(json.dumps({"before": None, "after": product(5, "a"), "op": "c", "ts_ms": 1}),)], "value STRING"
    )
    with pytest.raises(PySparkException, match="no position"):
        changelog.decode(raw, GOODS_INFO).collect()
    good, bad = changelog.split_rejects(raw, GOODS_INFO)
    assert good.count() == 0 and "no position" in bad.first()["fault"]


def test_topic_names(spark, tmp_path):
    log = rich()
    log.events = [(f"shop.public.{t}", v) for t, v in log.events]
    with pytest.raises(ValueError, match="unknown topics"):
        job_of(spark, tmp_path / "a", [log])
    named = Settings(topics={s.name: f"shop.public.{s.name}" for s in (ORDER_GOODS, ORDER_INFO, GOODS_INFO)})
    assert rows(job_of(spark, tmp_path / "b", [log], named).read("revenue_by_category")) == CATEGORIES_IN_ORDER
    with pytest.raises(ValueError, match="none of"):
        StatementSet(spark, str(tmp_path / "c"), Settings(topics={"goods": "x"}))


def test_a_bounded_read_cannot_start_at_the_end(spark):
    with pytest.raises(ValueError, match="bounded"):
        topics.kafka_changes(spark, "nowhere:9092", {"order_goods": topics.LATEST}, streaming=False)


def test_unmatched_retractions_are_counted(spark, tmp_path):
    log = Log()
    log.delete(ORDER_GOODS, line(1, 10, 5, 10.0, 12.0, 2)).update(ORDER_GOODS, line(2, 10, 5, 10.0, 12.0, 2), line(2, 10, 5, 10.0, 11.0, 2))
    no_op(log, GOODS_INFO, product(5, "food"))
    log.insert(ORDER_INFO, order(10)).update(ORDER_INFO, order(10), order(10, "FR"))
    job = job_of(spark, tmp_path, [log])
    assert rows(job.read("unmatched_retractions")) == [("order_goods", 2)]
    assert rows(job.read("revenue_by_category")) == [("food", 1, 22.0)]
