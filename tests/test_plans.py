"""Properties of physical plans that matter at scale."""

import edgelog as E
import pytest
from conftest import rows
from pyspark.sql import functions as F

from ebbtide.operators import signed as S
from ebbtide.plans import quality, views
from ebbtide.sinks.keyed import UpsertTable
from ebbtide.sources import changelog, topics
from ebbtide.specs import GOODS_INFO, ORDER_GOODS


def plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return df._jdf.queryExecution().explainString(mode)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def hot_tables(spark):
    """Line-items of which a third belong to one product and one order."""
    li = spark.range(0, 3000, 1, 3).select(
        F.col("id").alias("rec_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 200).alias("order_id"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 100).alias("goods_id"),
        F.lit(1.0).alias("goods_price"),
        F.lit(2.0).alias("deal_price"),
        F.lit(1).alias("goods_number"),
    )
    gi = spark.range(0, 100, 1, 3).select(
        F.col("id").alias("goods_id"),
        F.lit("b").alias("brand"),
        F.concat(F.lit("c"), (F.col("id") % 4).cast("string")).alias("category_level1"),
    )
    return li, gi


def test_lines_are_summed_per_product_before_a_large_join(spark, hot_tables, no_broadcast):
    li, gi = hot_tables
    df = views.revenue_by_category(li, gi)
    text = plan(df)
    join = text.index("SortMergeJoin")
    assert "partial_sum" in text[join:], "no aggregation below the join"
    assert sum(r["line_items"] for r in df.collect()) == 3000


def test_nothing_is_shuffled_by_a_small_product_table_but_sums(spark, hot_tables):
    text = plan(views.revenue_by_category(*hot_tables))
    assert "BroadcastHashJoin" in text and text.count("Exchange hashpartitioning") == 1


def test_hot_keys_do_not_change_results(spark, hot_tables, no_broadcast):
    li, gi = hot_tables
    assert views.pricing_anomalies(li, gi, salts=8).count() == views.pricing_anomalies(li, gi).count() == 3000
    check = quality.key_check(li, "lines", ["goods_id"]).first()
    assert (check["rows"], check["distinct_keys"], check["duplicates"]) == (3000, 100, 2900)
    reference = quality.Reference("lines", "goods_id", "products", "goods_id")
    report = quality.reference_report({"lines": li, "products": gi}, [reference]).first()
    assert (report["child_rows"], report["orphans"], report["coverage"]) == (3000, 0, 1.0)


def test_the_price_filter_runs_before_the_join(spark, hot_tables, tmp_path):
    li, gi = hot_tables
    li.write.parquet(str(tmp_path / "li"))
    text = plan(views.pricing_anomalies(spark.read.parquet(str(tmp_path / "li")), gi))
    assert text.index("Filter") > text.index("Join")
    assert "(deal_price" in text[text.index("Filter") :].splitlines()[0]


def test_events_are_parsed_once_whatever_is_filtered(spark, tmp_path):
    topics.write_changes(E.rich().df(spark), str(tmp_path))
    events = topics.decode_topic(topics.file_changes(spark, str(tmp_path), streaming=False), ORDER_GOODS)
    late = changelog.signed(topics.from_position(events, 5)).where("ts_ms > 0 AND w > 0")
    text = plan(late)
    assert text.count("from_json") == 1
    assert "(topic#" in text and "PartitionFilters: []" not in text


def test_state_reads_push_their_range_to_the_scan(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path), ORDER_GOODS, sort_by="order_id")
    lines = [E.line(k, k, 5, 1.0, 1.0, 1) for k in range(20)]
    table.load(spark.createDataFrame([tuple(r.values()) for r in lines], ORDER_GOODS.schema), F.lit("2024-01-01"))
    change = spark.createDataFrame([(3, 4, 5, 1.0, 2.0, 1, False)], "rec_id BIGINT, order_id INT, goods_id BIGINT, goods_price DOUBLE, deal_price DOUBLE, goods_number INT, _deleted BOOLEAN")
    table.write(0, change, F.lit("2024-01-02"))
    near = table.read().where(F.col("order_id").between(3, 4))
    text = plan(near)
    assert "GreaterThanOrEqual(order_id,3)" in text and "LeftAnti, BuildRight" in text
    assert rows(near, "rec_id", "order_id") == [(3, 4), (4, 4)]


def test_distinct_orders_spread_over_category_and_order(spark, hot_tables):
    text = plan(views.orders_per_category(*hot_tables))
    assert "hashpartitioning(category" in text and text.count("HashAggregate") == 4
    signed = hot_tables[0].withColumn(S.W, F.lit(1))
    assert rows(views.orders_per_category(signed, hot_tables[1])) == rows(views.orders_per_category(*hot_tables))


def test_replay_combines_within_tasks(spark):
    events = topics.decode_topic(E.rich().df(spark).repartition(3), GOODS_INFO)
    text = plan(changelog.replay(events, GOODS_INFO))
    assert "partial_max_by" in text[text.index("Exchange hashpartitioning") :]
