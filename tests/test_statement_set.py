import datetime
import os

import edgelog as E
import pytest
from conftest import rows
from pyspark.sql import functions as F

from ebbtide.plans import views
from ebbtide.sources import changelog, topics
from ebbtide.specs import GOODS_INFO, ORDER_GOODS, ORDER_INFO
from ebbtide.streaming.statement_set import Settings, StatementSet

ENRICHED = ["rec_id", "order_id", "country", "brand", "category", "deal_price", "goods_number"]


def batch(spark, events, minute):
    at = datetime.datetime(2024, 1, 1, 0, 0) + datetime.timedelta(minutes=minute)
    return E.Log().df(spark, events).withColumn("proc_time", F.lit(at).cast("timestamp"))


def feed(job, events, size, minutes=1, start=0):
    """Apply the events in micro-batches of ``size``."""
    job.create_if_absent()
    for i, begin in enumerate(range(0, len(events), size)):
        job.apply(batch(job.spark, events[begin : begin + size], (start + i) * minutes), start + i)


def check_rich(job):
    assert rows(job.read("enriched_line_items"), *ENRICHED) == sorted(E.ENRICHED, key=repr)
    assert rows(job.read("revenue_by_category")) == sorted(E.CATEGORIES, key=repr)
    assert rows(job.read("pricing_anomalies").drop("detected_at")) == sorted(E.ANOMALIES, key=repr)


def across_tables(events, first):
    """The same log with one table's events moved to the front, as separate topics allow."""
    return [e for e in events if e[0] == first] + [e for e in events if e[0] != first]


def test_micro_batches_equal_the_batch_result(spark, tmp_path):
    job = StatementSet(spark, str(tmp_path), Settings(fan_in=2))
    feed(job, E.rich().events, 8)
    check_rich(job)


@pytest.mark.parametrize("first", ["order_goods", "order_info"])
def test_tables_may_arrive_in_any_order(spark, tmp_path, first):
    job = StatementSet(spark, str(tmp_path))
    feed(job, across_tables(E.rich().events, first), 14)
    check_rich(job)


def test_a_failed_batch_is_repaired_by_running_it_again(spark, tmp_path):
    job = StatementSet(spark, str(tmp_path), Settings(fan_in=2))
    events = E.rich().events
    feed(job, events[:12], 12)

    def fail(*_):
        raise RuntimeError("executor lost")

    write, job.categories.write = job.categories.write, fail
    with pytest.raises(RuntimeError):
        job.apply(batch(spark, events[12:18], 1), 1)
    job.categories.write = write
    again = StatementSet(spark, str(tmp_path), Settings(fan_in=2))
    again.apply(batch(spark, events[12:18], 1), 1)
    again.apply(batch(spark, events[12:18], 1), 1)
    feed(again, events[18:], 20, start=2)
    check_rich(again)


def test_rows_keep_the_time_they_were_first_seen(spark, tmp_path):
    job = StatementSet(spark, str(tmp_path))
    one = E.line(1, 10, 5, 10.0, 12.0, 2)
    start = E.Log().insert(GOODS_INFO, E.product(5, "food")).insert(ORDER_INFO, E.order(10)).insert(ORDER_GOODS, one)
    feed(job, start.events, 9)
    change = E.Log().update(ORDER_GOODS, one, {**one, "deal_price": 11.0})
    feed(job, change.events, 9, start=1)
    seen = job.read("enriched_line_items").select("deal_price", F.minute("seen_at").alias("m"))
    assert rows(seen) == [(11.0, 0)]
    gone = E.Log().delete(ORDER_GOODS, {**one, "deal_price": 11.0})
    feed(job, gone.events, 9, start=2)
    assert job.read("enriched_line_items").count() == 0
    feed(job, E.Log().insert(ORDER_GOODS, one).events, 9, start=3)
    assert rows(job.read("pricing_anomalies").select(F.minute("detected_at"))) == [(3,)]


def test_idle_state_expires_without_phantom_rows(spark, tmp_path):
    ttl = {"order_goods": "1 hour", "order_info": "1 hour"}
    job = StatementSet(spark, str(tmp_path), Settings(ttl=ttl, fan_in=2))
    one, late = E.line(1, 10, 5, 10.0, 12.0, 2), E.line(2, 10, 5, 10.0, 12.0, 1)
    log = E.Log().insert(GOODS_INFO, E.product(5, "food")).insert(ORDER_INFO, E.order(10)).insert(ORDER_GOODS, one)
    feed(job, log.events, 9, minutes=180)
    # Three hours later: the order is gone from the state, the catalog is not.
    feed(job, E.Log().insert(ORDER_GOODS, late).events, 9, minutes=180, start=1)
    assert rows(job.read("enriched_line_items"), "rec_id") == [(1,)]
    assert rows(job.read("revenue_by_category")) == [("food", 2, 36.0)]
    # Line and order are deleted together, long after both have expired: no
    # product of two retractions may appear as a new row.
    both = E.Log().delete(ORDER_GOODS, one).delete(ORDER_INFO, E.order(10))
    feed(job, both.events, 9, minutes=180, start=2)
    assert rows(job.read("enriched_line_items"), "rec_id") == [(1,)]
    assert rows(job.read("revenue_by_category")) == [("food", 1, 12.0)]
    feed(job, E.Log().insert(GOODS_INFO, E.product(6, "toys")).events, 9, minutes=180, start=3)
    feed(job, E.Log().insert(GOODS_INFO, E.product(7, "toys")).events, 9, minutes=180, start=4)
    assert job.state["lines"].read().count() == 0 and job.state["products"].read().count() == 3


def test_windows_by_reading_and_by_commit_time(spark, tmp_path):
    row = E.line(1, 1, 1, 1.0, 3.0, 2)
    events = E.Log().insert(ORDER_GOODS, row).delete(ORDER_GOODS, row, at=E.CLOCK + 60_000).events
    read = StatementSet(spark, str(tmp_path / "read"))
    feed(read, events, 1)
    found = rows(read.read("revenue_by_window").select(F.minute("window_start"), "line_items", "revenue"))
    assert found == [(0, 1, 6.0), (1, -1, -6.0)]
    commit = StatementSet(spark, str(tmp_path / "commit"), Settings(window_on="event_time"))
    feed(commit, events, 2)
    assert rows(commit.read("revenue_by_window"), "line_items") == [(-1,), (1,)]


def test_stream_stops_and_resumes_on_its_checkpoint(spark, tmp_path):
    events = E.rich().events
    source, root = str(tmp_path / "topics"), str(tmp_path / "job")

    def write(part):
        topics.write_changes(E.Log().df(spark, part).coalesce(1), source)

    def drain():
        job = StatementSet(spark, root, Settings(window_on="event_time"))
        stream = topics.file_changes(spark, source, maxFilesPerTrigger="4")
        job.start(stream, drain=True).awaitTermination()
        return job

    write(events[:10])
    drain()
    write(events[10:])
    check_rich(drain())
    check_rich(drain())
    assert os.path.isdir(f"{root}/checkpoint/commits")
    li = changelog.signed(topics.decode_topic(E.rich().df(spark), ORDER_GOODS))
    want = views.revenue_by_window(li.withColumn("t", F.timestamp_millis("ts_ms")), "t")
    assert rows(drain().read("revenue_by_window")) == rows(want)


class Mirror:
    """Stands in for a database: applies rows by key."""

    def __init__(self):
        self.rows = {}

    def write(self, changes, spec):
        for r in changes.collect():
            key = tuple(r[k] for k in spec.key)
            if r["_deleted"]:
                self.rows.pop(key, None)
            else:
                self.rows[key] = tuple(r[c] for c in spec.columns)


def test_targets_hold_what_the_results_hold(spark, tmp_path):
    names = ["revenue_by_category", "revenue_by_window", "enriched_line_items", "pricing_anomalies"]
    mirrors = {n: Mirror() for n in names}
    job = StatementSet(spark, str(tmp_path), Settings(targets=mirrors, window_on="event_time"))
    feed(job, E.rich().events, 9)
    for name in names:
        found = job.read(name)
        own = [c for c in found.columns if c not in ("seen_at", "detected_at")]
        want = sorted((tuple(r) for r in found.select(*own).collect()), key=repr)
        assert sorted(mirrors[name].rows.values(), key=repr) == want
