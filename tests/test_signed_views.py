import edgelog as E
import pytest
from conftest import rows
from pyspark.sql import functions as F

from ebbtide.operators import signed as S
from ebbtide.operators.sizing import fits_broadcast
from ebbtide.plans import views
from ebbtide.sources import changelog, topics
from ebbtide.specs import GOODS_INFO, ORDER_GOODS, ORDER_INFO

SPECS = (ORDER_GOODS, ORDER_INFO, GOODS_INFO)


def tables(spark, log):
    return [S.project(changelog.signed(topics.decode_topic(log.df(spark), s)), *s.columns) for s in SPECS]


@pytest.fixture(params=["broadcast", "shuffle"])
def either_join(spark, request):
    """Run a test with and without broadcasts."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before if request.param == "broadcast" else "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_known_category_totals(spark, either_join):
    li, _, gi = tables(spark, E.basic())
    assert rows(views.revenue_by_category(li, gi)) == [("food", 1, 18.0), ("games", 1, 8.0)]


def test_views_after_a_rich_log(spark, either_join):
    li, oi, gi = tables(spark, E.rich())
    assert rows(S.current(views.enriched(li, oi, gi))) == sorted(E.ENRICHED, key=repr)
    assert rows(views.revenue_by_category(li, gi)) == sorted(E.CATEGORIES, key=repr)
    assert rows(S.current(views.pricing_anomalies(li, gi))) == sorted(E.ANOMALIES, key=repr)


def test_signed_views_equal_plain_views_of_the_final_tables(spark):
    log = E.rich()
    signed = tables(spark, log)
    plain = [changelog.replay(topics.decode_topic(log.df(spark), s), s) for s in SPECS]
    for view in (lambda l, o, g: views.enriched(l, o, g), lambda l, o, g: views.pricing_anomalies(l, g)):
        assert rows(S.current(view(*signed))) == rows(view(*plain))
    assert rows(views.revenue_by_category(signed[0], signed[2])) == rows(views.revenue_by_category(plain[0], plain[2]))
    assert rows(views.orders_per_category(signed[0], signed[2])) == rows(views.orders_per_category(plain[0], plain[2]))
    assert rows(views.abnormal_order_totals(signed[0], signed[1], 5.0)) == rows(
        views.abnormal_order_totals(plain[0], plain[1], 5.0)
    )


def test_salts_do_not_change_the_join(spark):
    li, oi, gi = tables(spark, E.rich())
    assert rows(views.enriched(li, oi, gi, salts=5)) == rows(views.enriched(li, oi, gi))


def test_a_log_and_its_inverse_leave_nothing(spark):
    li, oi, gi = tables(spark, E.rich())
    both = S.union(li, S.negate(li))
    assert S.consolidate(both).count() == 0
    assert views.revenue_by_category(both, gi).count() == 0
    assert S.consolidate(views.enriched(both, oi, gi)).count() == 0


def test_revenue_of_unpriced_lines_is_null_again_after_retraction(spark):
    priced, unpriced = E.line(1, 1, 5, 1.0, 2.0, 1), E.line(2, 1, 5, 1.0, None, 1)
    log = E.Log().insert(GOODS_INFO, E.product(5, "food"))
    log.insert(ORDER_GOODS, priced).insert(ORDER_GOODS, unpriced).delete(ORDER_GOODS, priced)
    li, _, gi = tables(spark, log)
    assert rows(views.revenue_by_category(li, gi)) == [("food", 1, None)]


def test_unseen_retractions_are_counted_and_left_out(spark):
    log = E.Log().delete(ORDER_GOODS, E.line(9, 1, 1, 1.0, 1.0, 1)).insert(ORDER_GOODS, E.line(1, 1, 1, 1.0, 1.0, 1))
    li = tables(spark, log)[0]
    assert rows(S.unmatched(li)) == [(1, 1)]
    assert rows(S.current(li), "rec_id") == [(1,)]


def test_current_repeats_rows_with_a_higher_weight(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", -1)], "x STRING, w INT")
    assert rows(S.current(df)) == [("a",), ("a",)]
    with pytest.raises(ValueError):
        S.consolidate(df.drop("w"))


def test_joins_refuse_ambiguous_columns(spark):
    a = spark.createDataFrame([(1, 2)], "k INT, x INT")
    with pytest.raises(ValueError, match="both sides"):
        S.join(a, a, "k")


def test_windows_can_go_negative_or_ignore_retractions(spark):
    row = E.line(1, 1, 1, 1.0, 3.0, 2)
    log = E.Log().insert(ORDER_GOODS, row, at=E.CLOCK).delete(ORDER_GOODS, row, at=E.CLOCK + 60_000)
    li = changelog.signed(topics.decode_topic(log.df(spark), ORDER_GOODS)).withColumn("t", F.timestamp_millis("ts_ms"))
    both = views.revenue_by_window(li, "t", "10 seconds")
    assert sorted(r["line_items"] for r in both.collect()) == [-1, 1]
    assert [r["revenue"] for r in views.revenue_by_window(li, "t", "10 seconds", inserts_only=True).collect()] == [6.0]
    bounds = views.millisecond_windows(both).where("line_items = 1").first()
    assert (bounds["window_end"] - bounds["window_start"]).total_seconds() == 10


def test_demand_spikes_need_a_full_history(spark):
    days = [("2024-01-01", 1), ("2024-01-02", 1), ("2024-01-03", 9), ("2024-01-04", 2)]
    li = spark.createDataFrame([(5, n, d) for d, n in days], "goods_id BIGINT, goods_number INT, d STRING").withColumn(
        "t", F.to_timestamp("d")
    )
    found = views.demand_spikes(li, "t", "1 day", history=2, factor=3.0)
    assert rows(found, "goods_id", "quantity", "usual") == [(5, 9, 1.0)]
    # Days without a sale count as zero.
    gap = li.where("d <> '2024-01-02'")
    found = views.demand_spikes(gap, "t", "1 day", history=2, factor=3.0)
    assert rows(found, "goods_id", "quantity", "usual") == [(5, 9, 0.5)]


def test_size_check_follows_the_limit(spark):
    df = spark.range(10)
    assert fits_broadcast(df)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert not fits_broadcast(df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
