import json
import random

import pytest
from conftest import rows
from edgelog import Log, basic, line, product
from pyspark.sql import functions as F

from ebbtide.functions import age_seconds, days_to_date, megabytes, or_text, to_millis
from ebbtide.sources import changelog, topics
from ebbtide.specs import GOODS_INFO, ORDER_GOODS, TableSpec

PAIR = TableSpec.of("pair", "k", k="bigint", v="string", x="double")


def pairs(spark, data):
    return spark.createDataFrame(data, PAIR.schema)


def test_decode_gives_signed_rows(spark):
    events = topics.decode_topic(basic().df(spark), ORDER_GOODS)
    signed = changelog.signed(events)
    assert signed.columns == [*ORDER_GOODS.columns, "ts_ms", "w"]
    assert rows(signed, "rec_id", "deal_price", "w") == sorted(
        [(1, 12.0, 1), (2, 8.0, 1), (3, 8.0, 1), (2, 8.0, -1), (1, 12.0, -1), (1, 9.0, 1)], key=repr
    )


@pytest.mark.parametrize(
    "value, message",
    [
        ("{broken", "Malformed"),
        (json.dumps({"op": "t", "after": product(1, "a")}), "unknown operation"),
        (json.dumps({"op": "u", "after": product(1, "a")}), "no before-image"),
        (json.dumps({"op": "d"}), "no before-image"),
        (json.dumps({"op": "c"}), "no after-image"),
        (json.dumps({"after": product(1, "a")}), "not a change event"),
    ],
)
def test_bad_events_fail_the_query(spark, value, message):
    raw = spark.createDataFrame([(value,)], "value STRING")
    with pytest.raises(Exception, match=message):
        changelog.signed(changelog.decode(raw, GOODS_INFO)).collect()
    good, bad = changelog.split_rejects(raw, GOODS_INFO)
    assert good.count() == 0 and bad.count() == 1


def test_tombstones_are_skipped_and_good_events_kept(spark):
    raw = spark.createDataFrame([(None,), (basic().events[0][1],)], "value STRING")
    assert changelog.decode(raw, GOODS_INFO).count() == 1
    good, bad = changelog.split_rejects(raw, GOODS_INFO)
    assert good.count() == 1 and bad.count() == 0


def test_transport_offsets_overrule_the_envelope(spark):
    raw = spark.createDataFrame([(basic().events[0][1], 77)], "value STRING, seq BIGINT")
    assert changelog.decode(raw, GOODS_INFO).first()["seq"] == 77


def test_encode_is_the_inverse_of_decode(spark):
    events = topics.decode_topic(basic().df(spark), ORDER_GOODS)
    again = changelog.decode(changelog.encode(events, ORDER_GOODS), ORDER_GOODS)
    assert rows(again) == rows(events)


def test_net_changes_keep_first_before_and_last_after(spark):
    one, two = line(1, 1, 1, 1.0, 1.0, 1), line(2, 1, 1, 1.0, 1.0, 1)
    log = Log().insert(ORDER_GOODS, one).update(ORDER_GOODS, one, {**one, "deal_price": 2.0})
    log.delete(ORDER_GOODS, {**one, "deal_price": 2.0})  # came and went
    log.delete(ORDER_GOODS, two)  # was there before the log
    three = line(3, 1, 1, 1.0, 1.0, 1)
    log.update(ORDER_GOODS, three, {**three, "deal_price": 5.0}).update(ORDER_GOODS, {**three, "deal_price": 5.0}, three)
    log.insert(ORDER_GOODS, line(4, 1, 1, 1.0, 4.0, 1))
    net = changelog.net_changes(topics.decode_topic(log.df(spark), ORDER_GOODS), ORDER_GOODS)
    assert rows(net, "rec_id", "before.deal_price", "after.deal_price") == [(2, 1.0, None), (4, None, 4.0)]
    assert rows(changelog.signed_changes(net), "rec_id", "w") == [(2, -1), (4, 1)]


def test_replay_takes_the_last_event_per_key(spark):
    events = topics.decode_topic(basic().df(spark), ORDER_GOODS)
    assert rows(changelog.replay(events, ORDER_GOODS), "rec_id", "deal_price") == [(1, 9.0), (3, 8.0)]


@pytest.mark.parametrize("seed", range(3))
def test_applying_a_difference_gives_the_new_snapshot(spark, seed):
    rng = random.Random(seed)

    def table():
        return [
            (k, rng.choice(["a", "b", None]), rng.choice([1.0, 2.5, None]))
            for k in range(40)
            if rng.random() < 0.7
        ]

    old, new = pairs(spark, table()), pairs(spark, table())
    steps = changelog.diff(old, new, PAIR, 1, 1)
    log = changelog.snapshot_events(old, PAIR, 0, 0).unionByName(steps)
    assert rows(changelog.replay(log, PAIR)) == rows(new)
    assert changelog.diff(old, old, PAIR, 0).count() == 0


def test_start_positions():
    assert topics.kafka_options("h:1", ["a", "b"], "earliest") == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
    }
    assert topics.kafka_options("h:1", ["a"], {"a": {"0": 5}})["startingOffsets"] == '{"a": {"0": 5}}'
    with pytest.raises(ValueError):
        topics.kafka_options("h:1", ["a"], "yesterday")


def test_from_position(spark):
    events = topics.decode_topic(basic().df(spark), ORDER_GOODS)
    assert {r["seq"] for r in topics.from_position(events, 7).collect()} == {7, 8}


def test_topic_files_round_trip(spark, tmp_path):
    topics.write_changes(basic().df(spark), str(tmp_path / "t"))
    back = topics.file_changes(spark, str(tmp_path / "t"), streaming=False)
    assert rows(back) == rows(basic().df(spark))


def test_specs_conform_and_check_their_key(spark):
    df = spark.createDataFrame([("1", "x", 2, "extra")], "k STRING, v STRING, x INT, y STRING")
    assert PAIR.conform(df).schema == PAIR.schema
    assert PAIR.retyped(k="string").schema["k"].dataType.simpleString() == "string"
    with pytest.raises(ValueError):
        TableSpec.of("t", "missing", k="bigint")


def test_scalar_functions(spark):
    df = spark.sql(
        "SELECT 19723 AS d, TIMESTAMP'2024-01-01 00:00:00.123456' AS t, "
        "TIMESTAMP'2024-01-01 00:01:30.7' AS now, 5 * 1024 * 1024 AS b, CAST(NULL AS INT) AS n"
    )
    r = df.select(
        days_to_date(F.col("d")).cast("string").alias("date"),
        to_millis(F.col("t")).cast("string").alias("ms"),
        age_seconds(F.col("t"), F.col("now")).alias("age"),
        megabytes(F.col("b")).alias("mb"),
        or_text(F.col("n"), "n/a").alias("na"),
    ).first()
    assert tuple(r) == ("2024-01-01", "2024-01-01 00:00:00.123", 91, 5.0, "n/a")


def test_net_changes_keep_the_keys_of_their_images(spark):
    row = lambda key, v: line(key, 1, 1, v, None, 1)
    log = Log().update(ORDER_GOODS, row(1, 1.0), row(2, 2.0))  # another key: an event of key 2
    log.insert(ORDER_GOODS, row(None, 3.0)).delete(ORDER_GOODS, row(5, 1.0))
    log.update(ORDER_GOODS, row(4, 1.0), row(None, 4.0)).update(ORDER_GOODS, row(None, 6.0), row(6, 6.0))
    log.update(ORDER_GOODS, row(7, 7.0), row(7, 7.0))
    events = topics.decode_topic(log.df(spark), ORDER_GOODS)
    net = rows(changelog.net_changes(events, ORDER_GOODS, keep_unchanged=True))
    image = lambda key, v: (key, 1, 1, v, None, 1)
    assert net == sorted(
        [
            (2, image(1, 1.0), image(2, 2.0)),
            (None, None, image(None, 3.0)),
            (5, image(5, 1.0), None),
            (4, image(4, 1.0), image(None, 4.0)),
            (6, image(None, 6.0), image(6, 6.0)),
            (7, image(7, 7.0), image(7, 7.0)),
        ],
        key=repr,
    )
    assert len(net) - 1 == changelog.net_changes(events, ORDER_GOODS).count()
    assert changelog.net_changes(events, ORDER_GOODS).schema["before"].dataType.names == ORDER_GOODS.columns


def test_net_changes_group_narrow_rows(spark):
    events = topics.decode_topic(Log().insert(ORDER_GOODS, line(1, 1, 1, 1.0, 1.0, 1)).df(spark).repartition(3), ORDER_GOODS)
    net = changelog.net_changes(events, ORDER_GOODS)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    text = net._jdf.queryExecution().explainString(mode)
    # what a task sorts for grouping has neither the envelope nor the key in its images
    sorted_rows = text[text.index("Sort [", text.index("Exchange hashpartitioning(rec_id")) :].split("\n")[1]
    assert "Project [" in sorted_rows and "struct(_order_id" in sorted_rows and "struct(rec_id" not in sorted_rows.split("_own")[0]
