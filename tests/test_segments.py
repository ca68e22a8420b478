"""Start positions, restarts and splits of topics kept as segments."""

import pytest
from pyspark.sql import functions as F

from ebbtide.sources import segments


def append(spark, path, segment, first, n, topics=("a", "b")):
    rows = [(t, f"{t}{i} é") for i in range(first, first + n) for t in topics]
    segments.append_segment(spark.createDataFrame(rows, "topic string, value string"), path, "value", 3, segment)


def values(first, n, topics=("a", "b")):
    return sorted(f"{t}{i} é" for i in range(first, first + n) for t in topics)


def drain(spark, path, out, checkpoint, start):
    q = (
        segments.segment_changes(spark, path, start)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .start()
    )
    try:
        q.processAllAvailable()
        yield q
    finally:
        q.stop()


def written(spark, out):
    return sorted(r["value"] for r in spark.read.schema(segments.SCHEMA).parquet(out).collect())


@pytest.mark.parametrize("start", ["latest", "earliest"])
def test_start_and_restart(spark, tmp_path, start):
    path, out, checkpoint = (str(tmp_path / n) for n in ("t", "out", "c"))
    append(spark, path, 0, 0, 20)
    for q in drain(spark, path, out, checkpoint, start):
        had = [] if start == "latest" else values(0, 20)
        assert written(spark, out) == had
        append(spark, path, 1, 20, 5)
        q.processAllAvailable()
        assert written(spark, out) == sorted(had + values(20, 5))
    append(spark, path, 2, 25, 7)  # while no query runs
    append(spark, path, 2, 100, 4, topics=("c",))  # a topic that is new
    for _ in drain(spark, path, out, checkpoint, start):
        assert written(spark, out) == sorted(had + values(20, 12) + values(100, 4, ("c",)))


def test_explicit_start_topics_and_splits(spark, tmp_path):
    path = str(tmp_path / "t")
    for s in range(3):
        append(spark, path, s, 10 * s, 10)
    whole = segments.segment_changes(spark, path, "earliest", streaming=False)
    rows = whole.collect()
    assert sorted(r["value"] for r in rows) == values(0, 30)
    small = segments.segment_changes(spark, path, "earliest", streaming=False, splitBytes="7").collect()
    assert sorted(map(tuple, small)) == sorted(map(tuple, rows))
    assert len({(r["topic"], r["partition"], r["seq"]) for r in rows}) == 60
    assert {r["seq"] >> segments.PLACE_BITS for r in rows} == {0, 1, 2}
    every = {str(p): 2 for p in range(3)}
    late = segments.segment_changes(spark, path, {"a": every, "b": {"0": 3, "1": 3, "2": 3}}, streaming=False)
    assert sorted(r["value"] for r in late.collect()) == values(20, 10, ("a",))
    one = segments.segment_changes(spark, path, "earliest", ("b",), streaming=False)
    assert one.select("topic").distinct().collect() == [("b",)]
    assert segments.segment_changes(spark, str(tmp_path / "none"), "earliest", streaming=False).collect() == []


def test_later_records_have_greater_numbers(spark, tmp_path):
    path = str(tmp_path / "t")
    for s in range(2):
        rows = spark.createDataFrame([("a", f"{k}:{s}{i}") for i in range(4) for k in "xyz"], "topic string, value string").coalesce(1)
        segments.append_segment(rows, path, F.substring("value", 1, 1), 2, s)
    got = segments.segment_changes(spark, path, "earliest", streaming=False).orderBy("seq").collect()
    for k in "xyz":
        own = [r["value"] for r in got if r["value"][0] == k]
        assert own == sorted(own) and len(own) == 8
        assert len({r["partition"] for r in got if r["value"][0] == k}) == 1


def test_bounded_read_at_latest_is_refused(spark, tmp_path):
    with pytest.raises(Exception, match="bounded read"):
        segments.segment_changes(spark, str(tmp_path), "latest", streaming=False).collect()
