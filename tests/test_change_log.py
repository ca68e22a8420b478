"""The change log that the suite derives from its tables, on rows of this test."""

import datetime
import pathlib

import pytest
from conftest import rows

from ebbtide.plans import quality
from ebbtide.sources import changelog, topics
from ebbtide.streaming import statement_set
from ebbtide.suite import changes, checks, retail, streams


@pytest.fixture()
def tables(spark, tmp_path):
    """Two lines with one key, a pending and a deleted order, a part that moves, and rows with nulls."""
    day = lambda y: datetime.datetime(y, 3, 1)
    data = {
        "lineitem": (
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
            "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
            [
                (1, 1, 1, 1, 2.0, 10.0, 0.1, 0.0, "N", "O", day(1996)),
                (1, 1, 1, 1, 2.0, 10.0, 0.1, 0.0, "N", "O", day(1996)),
                (1, 2, 1, 2, 3.0, 10.0, 0.0, 0.2, "R", "F", day(1994)),
                (2, None, 1, 1, 4.0, None, 0.1, 0.0, "A", "F", day(1995)),
                (2, 1, 1, 2, 4.0, 9.0, 0.1, 0.0, "R", "F", None),  # never was in the log
            ],
        ),
        "orders": (
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
            [(1, 1, "P", 20.0, day(1996), "1-URGENT"), (2, 1, "F", None, day(1994), "5-LOW")],
        ),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(1, "c", 1, 0.0, "m")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(1, "PERU", 1)]),
        "part": (
            "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
            [(1, "a", "b", "t", 41, 1.0), (2, "a", None, "t", 4, 1.0)],
        ),
    }
    for name, (schema, values) in data.items():
        spark.createDataFrame(values, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("reseeded", [False, True])
def test_batch_readers_put_no_log_on_disk(spark, tables, monkeypatch, reseeded):
    def refuse(*_):
        raise AssertionError("a batch reader wrote files")

    with monkeypatch.context() as m:
        m.setattr(retail, "work_dir", refuse)
        specs = (retail.LINES, retail.ORDERS, retail.PRODUCTS)
        read = [rows(retail.decoded(spark, tables, s, reseeded)) for s in specs]
        got = rows(changes.change_outcomes(spark, tables)), rows(changes.change_events_per_topic(spark, tables))
        log = retail.log(spark, tables, reseeded)
        by_period = {p: rows(log.changes(p)) for p in log.periods}
    # the topic files that streams read hold the same records
    assert rows(log.changes()) == rows(topics.file_changes(spark, log.path, streaming=False).select("topic", "value"))
    for p, records in by_period.items():
        assert records and records == rows(topics.file_changes(spark, f"{log.path}/period={p}", streaming=False).select("topic", "value"))
    assert [len(r) for r in read] == [7, 4, 3]
    assert got[0] == [("applied", 6), ("unknown operation x", 1)]
    assert {tuple(r) for r in got[1]} >= {("order_goods", "c", 4), ("order_goods", "u", 2), ("order_goods", "d", 1), ("order_info", "d", 1)}


def test_totals_fed_by_periods_without_topic_files(spark, tables, monkeypatch):
    def refuse(*_):
        raise AssertionError("topic files were written")

    monkeypatch.setattr(retail, "work_dir", refuse)
    assert rows(streams.accumulated_category_revenue(spark, tables)) == [("t", 2, 16.2)]


def test_differences_compare_where_rows_were_replayed(spark, tables):
    found = checks.line_item_differences(spark, tables)
    old, new = retail.LINES.conform(retail.lines(spark, tables)), changelog.replay(retail.decoded(spark, tables, retail.LINES), retail.LINES)
    want = quality.differences(old, new).select("rec_id", "deal_price", "side", "surplus")
    assert rows(found) == rows(want)
    assert [r["surplus"] for r in found.where("side = 'left' AND deal_price = 4.5").collect()] == [2]  # of two lines with one key
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    plan = checks.line_item_differences(spark, tables)._jdf.queryExecution().explainString(mode)
    assert "Exchange" not in plan[: plan.index("Union")]


def test_replay_by_key(spark):
    events = "before struct<{0}>, after struct<{0}>, op string, ts_ms long, seq long".format("goods_id long, goods_name string, brand string, category_level1 string, category_level2 string")
    row = lambda key, name: (key, name, None, "c", None)
    log = [
        (None, row(1, "a"), "c", 0, 0),
        (row(1, "a"), row(1, "b"), "u", 1, 1),
        (None, row(2, None), "r", 0, 0),
        (row(3, "x"), None, "d", 5, 5),
        (None, row(3, "x"), "c", 2, 2),
        (None, row(None, "n"), "c", 3, 3),
    ]
    df = spark.createDataFrame(log, events)
    assert rows(changelog.replay_by_key(df, retail.PRODUCTS)) == rows(changelog.replay(df, retail.PRODUCTS)) == [row(1, "b"), row(2, None), row(None, "n")]
    lost = spark.createDataFrame([(row(1, "a"), row(None, "a"), "u", 1, 1)], events)
    with pytest.raises(Exception, match="lost the key"):
        changelog.replay_by_key(lost, retail.PRODUCTS).collect()


@pytest.mark.parametrize("name", ["streamed_revenue_resumed", "streamed_revenue_by_category"])
def test_streams_keep_no_topic_files_they_have_read(spark, tables, monkeypatch, name):
    made, appended = [], []
    work_dir, append = streams.work_dir, retail.ChangeLog.append
    monkeypatch.setattr(streams, "work_dir", lambda s, n: made.append(work_dir(s, n)) or made[-1])

    def seen(log, path, period):
        append(log, path, period)
        appended.extend(p.name for p in pathlib.Path(path).rglob("part-*"))

    monkeypatch.setattr(retail.ChangeLog, "append", seen)
    assert rows(getattr(streams, name)(spark, tables)) == [("CLEARANCE", 1, 8.1)]  # the job holds one row of a key
    assert appended and all(p.endswith(".gz") for p in appended)
    assert not [p for d in made for p in pathlib.Path(d).rglob("topic=*")]


def test_segments_are_fed_without_topic_files(spark, tables, monkeypatch):
    def refuse(*_):
        raise AssertionError("topic files were written")

    monkeypatch.setattr(retail, "work_dir", refuse)
    monkeypatch.setattr(topics, "write_changes", refuse)
    assert rows(streams.events_from_segments(spark, tables)) == rows(changes.change_events_per_topic(spark, tables))


def test_caches_of_a_batch_take_no_disk():
    assert statement_set.CACHED.useMemory and not statement_set.CACHED.useDisk
