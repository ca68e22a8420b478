import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ebbtide.sinks import keyed
from ebbtide.sinks.jdbc import JdbcUpsert
from ebbtide.sinks.keyed import Segment, SumTable, UpsertTable, keyed_changes
from ebbtide.specs import PRICING_ANOMALIES, TableSpec

PAIR = TableSpec.of("pair", "k", k="string", v="int")
TOTAL = TableSpec.of("total", "k", k="string", n="bigint", x="double")


def at(minute):
    return F.lit(f"2024-01-01 00:{minute:02d}:00").cast("timestamp")


def put(table, batch, data):
    """``data``: {key: value or None for a deletion}."""
    changes = table.spark.createDataFrame(
        [(k, v, v is None) for k, v in data.items()], "k STRING, v INT, _deleted BOOLEAN"
    )
    table.write(batch, changes, at(batch))


def contents(table, **k):
    return rows(table.read(**k).withColumn("seen", F.minute("seen")), "k", "v", "seen")


@pytest.fixture
def table(spark, tmp_path):
    t = UpsertTable(spark, str(tmp_path / "pair"), PAIR, first_seen="seen")
    t.create_if_absent()
    return t


def test_creation_is_idempotent_and_empty(table):
    assert table.read().columns == ["k", "v", "seen"] and table.read().count() == 0
    put(table, 0, {"a": 1})
    table.create_if_absent()
    assert contents(table) == [("a", 1, 0)]


def test_last_value_wins_and_first_seen_stays(table):
    put(table, 1, {"a": 1, "b": 1, None: 5})
    put(table, 2, {"a": 2, "b": None})
    put(table, 3, {"b": 7, None: 6})
    assert contents(table) == sorted([("a", 2, 1), ("b", 7, 3), (None, 6, 1)], key=repr)
    assert contents(table, as_of=1) == sorted([("a", 1, 1), ("b", 1, 1), (None, 5, 1)], key=repr)


def test_writing_a_batch_again_changes_nothing(table):
    put(table, 1, {"a": 1})
    put(table, 2, {"a": 2, "b": 2})
    before = contents(table)
    put(table, 2, {"a": 2, "b": 2})
    assert contents(table) == before


def test_an_uncommitted_segment_is_invisible(table):
    put(table, 1, {"a": 1})
    put(table, 2, {"a": 2})
    table.folder.revoke(Segment(2, 2).name)
    assert contents(table) == [("a", 1, 1)]


@pytest.mark.parametrize("fan_in", [2, 3])
def test_compaction_keeps_the_contents(spark, tmp_path, fan_in):
    rng = random.Random(fan_in)
    compacted = UpsertTable(spark, str(tmp_path / "c"), PAIR, "seen")
    plain = UpsertTable(spark, str(tmp_path / "p"), PAIR, "seen")
    for t in (compacted, plain):
        t.create_if_absent()
    merged = []
    for batch in range(5):
        data = {k: rng.choice([None, 1, 2, 3]) for k in rng.sample("abcdef", 3)}
        for t in (compacted, plain):
            put(t, batch, data)
        merged.append(compacted.compact(batch - 1, fan_in))
        assert contents(compacted) == contents(plain)
    assert any(merged)
    with_old = len(compacted.folder.list())
    assert compacted.vacuum() and len(compacted.folder.list()) < with_old
    assert contents(compacted) == contents(plain)


def test_partial_compaction_remembers_deletions(table):
    put(table, 0, {"a": 1, "b": 1})
    table._write(Segment(-1, 0), table._as_base(table._merged(table.segments())))
    put(table, 1, {"a": None})
    put(table, 2, {"a": 3, "b": None})
    table._write(Segment(1, 2), table.fold(table._rows([Segment(1, 1), Segment(2, 2)])))
    assert [s.name for s in table.segments()] == ["s_-1_0", "s_1_2"]
    assert contents(table) == [("a", 3, 2)]


def test_expired_rows_disappear(table):
    put(table, 1, {"a": 1, "b": 1})
    put(table, 9, {"b": 2})
    assert contents(table, newer_than=at(5)) == [("b", 2, 1)]
    assert table.compact(9, fan_in=2, newer_than=at(5)) == Segment(-1, 9)
    assert contents(table) == [("b", 2, 1)]


def test_loading_a_snapshot(spark, tmp_path):
    t = UpsertTable(spark, str(tmp_path / "l"), PAIR, "seen")
    t.load(spark.createDataFrame([("a", 1), ("b", 2)], PAIR.schema), at(3))
    put(t, 4, {"b": 5, "c": 6})
    assert contents(t) == [("a", 1, 3), ("b", 5, 3), ("c", 6, 4)]


def test_totals_add_up_and_empty_groups_go(spark, tmp_path):
    t = SumTable(spark, str(tmp_path / "t"), TOTAL, "n")
    t.create_if_absent()

    def add(batch, *data):
        t.write(batch, spark.createDataFrame(data, TOTAL.schema))

    add(0, ("a", 2, 0.1), ("b", 1, 1.0), (None, 1, 1.0))
    add(1, ("a", 1, 0.2), ("b", -1, -1.0))
    add(1, ("a", 1, 0.2), ("b", -1, -1.0))  # the same batch again
    add(2, ("d", -1, -4.0))
    want = sorted([("a", 3, 0.1 + 0.2), (None, 1, 1.0)], key=repr)
    assert rows(t.read()) == want
    assert t.compact(2, fan_in=2) == Segment(-1, 2)
    assert rows(t.read()) == want
    add(3, ("b", 1, 5.0))
    assert rows(t.read(), "k", "n") == sorted([("a", 3), (None, 1), ("b", 1)], key=repr)
    t.positive_only = False
    assert ("d", -1, -4.0) in rows(t.read())


def test_signed_rows_fold_to_one_change_per_key(spark):
    signed = spark.createDataFrame(
        [("a", 1, -1), ("a", 2, 1), ("b", 1, -1), ("c", 1, 1), ("c", 1, -1), ("d", None, 1), ("d", 4, 1), ("d", 4, -1)],
        "k STRING, v INT, w INT",
    )
    assert rows(keyed_changes(signed, PAIR)) == [("a", 2, False), ("b", None, True), ("d", None, False)]


def test_replaced_segments_go_while_the_job_runs(spark, tmp_path, monkeypatch):
    """However many batches there were, the folder holds the live segments and those replaced lately."""
    monkeypatch.setattr(keyed, "KEEP_REPLACED", 4)
    table = SumTable(spark, str(tmp_path / "total"), TOTAL, "n")
    table.create_if_absent()
    most = 0
    for batch in range(60):
        table.compact(batch - 1, fan_in=3)
        table.write(batch, spark.createDataFrame([("a", 1, 1.0)], "k STRING, n BIGINT, x DOUBLE"))
        most = max(most, len(table.folder.list()))
    assert most <= 20
    assert rows(SumTable(spark, str(tmp_path / "total"), TOTAL, "n").read()) == [("a", 60, 60.0)]
    assert rows(table.read(as_of=58)) == [("a", 59, 59.0)]


def test_upsert_statements():
    sink = JdbcUpsert("jdbc:x", {}, first_seen="detected_at")
    assert "PRIMARY KEY" not in sink.create_statement(PRICING_ANOMALIES)
    assert '"detected_at" timestamp DEFAULT now()' in sink.create_statement(PRICING_ANOMALIES)
    assert sink.key_statement(PRICING_ANOMALIES) == (
        'CREATE UNIQUE INDEX IF NOT EXISTS "pricing_anomalies_key" ON "pricing_anomalies" ("rec_id") NULLS NOT DISTINCT'
    )
    assert sink.delete_statement(PRICING_ANOMALIES, "stage") == (
        'DELETE FROM "pricing_anomalies" t USING "stage" s WHERE s."_deleted" AND t."rec_id" IS NOT DISTINCT FROM s."rec_id"'
    )
    upsert = sink.upsert_statement(TOTAL, "stage")
    assert upsert.startswith('INSERT INTO "total" ("k", "n", "x") SELECT "k", "n", "x" FROM "stage" WHERE NOT "_deleted" ')
    assert upsert.endswith('ON CONFLICT ("k") DO UPDATE SET "n" = EXCLUDED."n", "x" = EXCLUDED."x"')
    odd = TableSpec.of('a"b', "k", k="string")
    assert '"a""b"' in sink.create_statement(odd) and sink.upsert_statement(odd, "s").endswith("DO NOTHING")
