"""Views, aggregates and reports on plain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions import days_to_date, line_amount
from ebbtide.operators import signed as S
from ebbtide.plans import reports, views
from ebbtide.streaming import rates
from ebbtide.suite import retail as R
from ebbtide.suite.registry import query

CATEGORY_SQL = """SELECT category_level1 AS category, COUNT(*) AS line_items,
  ROUND(SUM(deal_price * goods_number), 2) AS revenue
FROM {li} JOIN {gi} USING (goods_id) GROUP BY category_level1"""

ENRICHED_SQL = """SELECT rec_id, order_id, country, brand, category_level1 AS category, deal_price, goods_number
FROM {li} JOIN {oi} USING (order_id) JOIN {gi} USING (goods_id)"""

ANOMALY_SQL = """SELECT rec_id, order_id, brand, goods_price, deal_price, goods_number
FROM {li} JOIN {gi} USING (goods_id) WHERE deal_price > goods_price"""

WINDOW_SQL = """SELECT time_bucket(INTERVAL '{every}', {ts}, TIMESTAMP '1970-01-01') AS window_start,
  time_bucket(INTERVAL '{every}', {ts}, TIMESTAMP '1970-01-01') + INTERVAL '{every}' AS window_end,
  COUNT(*) AS line_items, ROUND(SUM(deal_price * goods_number), 2) AS revenue
FROM li GROUP BY 1, 2"""


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, F.round(c, 2))
    return df


# -- joins and the four views

@query("enriched_line_items", R.SQL + ENRICHED_SQL.format(li="li", oi="oi", gi="gi"))
def enriched_line_items(spark: SparkSession, d: str) -> DataFrame:
    return views.enriched(R.lines(spark, d), R.orders(spark, d), R.products(spark, d))


@query("revenue_by_category", R.SQL + CATEGORY_SQL.format(li="li", gi="gi"))
def revenue_by_category(spark: SparkSession, d: str) -> DataFrame:
    return rounded(views.revenue_by_category(R.lines(spark, d), R.products(spark, d)), "revenue")


@query("revenue_by_window", R.SQL + WINDOW_SQL.format(every="10 seconds", ts="ts"))
def revenue_by_window(spark: SparkSession, d: str) -> DataFrame:
    return rounded(views.revenue_by_window(R.lines(spark, d), "ts", "10 seconds"), "revenue")


@query("pricing_anomalies", R.SQL + ANOMALY_SQL.format(li="li", gi="gi"))
def pricing_anomalies(spark: SparkSession, d: str) -> DataFrame:
    return views.pricing_anomalies(R.lines(spark, d), R.products(spark, d))


@query(
    "line_item_products",
    R.SQL + "SELECT rec_id, goods_id, goods_name, brand, deal_price FROM li JOIN gi USING (goods_id)",
)
def line_item_products(spark: SparkSession, d: str) -> DataFrame:
    """The two-way join behind the category and anomaly views."""
    li = R.lines(spark, d).select("rec_id", "goods_id", "deal_price")
    gi = R.products(spark, d).select("goods_id", "goods_name", "brand")
    return S.join(li, gi, "goods_id").select("rec_id", "goods_id", "goods_name", "brand", "deal_price")


@query("line_amounts", R.SQL + "SELECT rec_id, order_id AS order_no, deal_price * goods_number AS amount FROM li")
def line_amounts(spark: SparkSession, d: str) -> DataFrame:
    return R.lines(spark, d).select("rec_id", F.col("order_id").alias("order_no"), line_amount().alias("amount"))


@query("priced_above_list", R.SQL + "SELECT rec_id, goods_price, deal_price FROM li WHERE deal_price > goods_price")
def priced_above_list(spark: SparkSession, d: str) -> DataFrame:
    return views.priced_above_list(R.lines(spark, d)).select("rec_id", "goods_price", "deal_price")


@query(
    "category_revenue_exact",
    """SELECT p_type AS category, COUNT(*) AS line_items,
  CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS INTEGER)) AS VARCHAR) AS revenue
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def category_revenue_exact(spark: SparkSession, d: str) -> DataFrame:
    """Prices to the cent read back as decimals: the sum is the same in any order."""
    li = R.table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("goods_id"),
        F.col("l_extendedprice").alias("deal_price"),
        F.col("l_quantity").cast("int").alias("goods_number"),
    )
    exact = views.revenue_by_category(li, R.products(spark, d), exact=True)
    return exact.withColumn("revenue", F.col("revenue").cast("string"))


@query(
    "order_dates",
    R.SQL + "SELECT order_id, order_date, year FROM oi",
)
def order_dates(spark: SparkSession, d: str) -> DataFrame:
    """Days since 1970 turned into dates."""
    return R.orders(spark, d).select("order_id", days_to_date(F.col("order_date")).alias("order_date"), "year")


# -- filters

@query(
    "null_and_list_filters",
    """SELECT o_orderkey AS order_id, o_orderpriority AS priority, o_orderstatus AS status FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('F')
  AND o_orderdate IS NOT NULL AND NOT (o_totalprice IS NULL)""",
)
def null_and_list_filters(spark: SparkSession, d: str) -> DataFrame:
    o = R.table(spark, d, "orders")
    kept = o.where(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        & ~F.col("o_orderstatus").isin("F")
        & F.col("o_orderdate").isNotNull()
        & ~F.col("o_totalprice").isNull()
    )
    return kept.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
    )


@query("next_order_id", "SELECT COALESCE(MAX(o_orderkey) + 1, 500) AS next_id FROM orders WHERE o_orderkey >= 500")
def next_order_id(spark: SparkSession, d: str) -> DataFrame:
    """The first free order number at or above an offset."""
    return reports.next_id(R.orders(spark, d), "order_id", 500)


@query(
    "next_order_id_unused",
    "SELECT COALESCE(MAX(o_orderkey) + 1, 900000000) AS next_id FROM orders WHERE o_orderkey >= 900000000",
)
def next_order_id_unused(spark: SparkSession, d: str) -> DataFrame:
    return reports.next_id(R.orders(spark, d), "order_id", 900_000_000)


@query("product_sample", "SELECT p_partkey AS goods_id FROM part ORDER BY p_partkey LIMIT 5000")
def product_sample(spark: SparkSession, d: str) -> DataFrame:
    """Up to 5000 product ids, the same ones each time."""
    return reports.sample_ids(R.products(spark, d), "goods_id", 5000)


# -- reports over results

@query("category_ranking", R.SQL + CATEGORY_SQL.format(li="li", gi="gi") + " ORDER BY revenue DESC")
def category_ranking(spark: SparkSession, d: str) -> DataFrame:
    result = views.revenue_by_category(R.lines(spark, d), R.products(spark, d))
    return rounded(reports.category_ranking(result), "revenue")


@query("latest_windows", R.SQL + WINDOW_SQL.format(every="10 seconds", ts="ts") + " ORDER BY window_start DESC LIMIT 5")
def latest_windows(spark: SparkSession, d: str) -> DataFrame:
    return reports.latest_windows(views.revenue_by_window(R.lines(spark, d), "ts", "10 seconds"), 5)


@query(
    "result_row_counts",
    R.SQL + f"""SELECT 'enriched_line_items' AS sink_table, count(*) AS rows FROM ({ENRICHED_SQL.format(li="li", oi="oi", gi="gi")})
UNION ALL SELECT 'revenue_by_category', count(*) FROM ({CATEGORY_SQL.format(li="li", gi="gi")})
UNION ALL SELECT 'revenue_by_window', count(*) FROM ({WINDOW_SQL.format(every="10 seconds", ts="ts")})
UNION ALL SELECT 'pricing_anomalies', count(*) FROM ({ANOMALY_SQL.format(li="li", gi="gi")})""",
)
def result_row_counts(spark: SparkSession, d: str) -> DataFrame:
    li, oi, gi = R.lines(spark, d), R.orders(spark, d), R.products(spark, d)
    return reports.row_counts(
        {
            "enriched_line_items": views.enriched(li, oi, gi),
            "revenue_by_category": views.revenue_by_category(li, gi),
            "revenue_by_window": views.revenue_by_window(li, "ts", "10 seconds"),
            "pricing_anomalies": views.pricing_anomalies(li, gi),
        }
    )


# -- windows over real timestamps

@query(
    "event_windows",
    """SELECT time_bucket(INTERVAL '10 seconds', ts, TIMESTAMP '1970-01-01') AS window_start,
  time_bucket(INTERVAL '10 seconds', ts, TIMESTAMP '1970-01-01') + INTERVAL '10 seconds' AS window_end,
  COUNT(*) AS line_items, ROUND(SUM(value * 2), 2) AS revenue FROM events GROUP BY 1, 2""",
)
def event_windows(spark: SparkSession, d: str) -> DataFrame:
    """Ten-second windows over events, each counted as two units of its value."""
    e = R.table(spark, d, "events").select("ts", F.col("value").alias("deal_price"), F.lit(2).alias("goods_number"))
    return rounded(views.revenue_by_window(e, "ts", "10 seconds"), "revenue")


@query(
    "revenue_per_minute",
    """SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
  COUNT(*) AS line_items, ROUND(SUM(value), 2) AS revenue FROM events GROUP BY 1, 2""",
)
def revenue_per_minute(spark: SparkSession, d: str) -> DataFrame:
    e = R.table(spark, d, "events").select("ts", F.col("value").alias("deal_price"), F.lit(1).alias("goods_number"))
    return rounded(views.revenue_by_window(e, "ts", "1 minute"), "revenue")


@query(
    "event_rates",
    "SELECT date_trunc('second', ts) AS second, event_type, count(*) AS events FROM events GROUP BY 1, 2",
)
def event_rates(spark: SparkSession, d: str) -> DataFrame:
    return rates.rates(R.table(spark, d, "events"), "ts", "event_type", "1 second")


@query("event_totals", "SELECT event_type, count(*) AS events FROM events GROUP BY 1")
def event_totals(spark: SparkSession, d: str) -> DataFrame:
    return rates.totals(R.table(spark, d, "events"), "event_type")


DAYS = (1, 7, 30, 60, 90, 121)


@query(
    "shipping_latency",
    f"""WITH t AS (SELECT l_returnflag, date_diff('second', o_orderdate, l_shipdate) AS took
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
k AS (SELECT l_returnflag, COUNT(took) AS n, CAST(COALESCE(SUM(took), 0) AS DOUBLE) AS seconds FROM t GROUP BY 1),
b AS (SELECT CAST(unnest([{", ".join(str(n * 86400) for n in DAYS)}]) AS DOUBLE) AS le)
SELECT l_returnflag, le, (SELECT COUNT(*) FROM t WHERE t.l_returnflag = k.l_returnflag AND took <= le) AS events, seconds
FROM k CROSS JOIN b UNION ALL SELECT l_returnflag, NULL, n, seconds FROM k""",
)
def shipping_latency(spark: SparkSession, d: str) -> DataFrame:
    """Seconds from order to shipment in buckets, for each return flag."""
    lines = R.table(spark, d, "lineitem").select("l_orderkey", "l_shipdate", "l_returnflag")
    orders = R.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    both = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    took = F.timestamp_diff("SECOND", F.col("o_orderdate"), F.col("l_shipdate"))
    return rates.latencies(both, took, "l_returnflag", [n * 86400 for n in DAYS])


# -- further analyses

@query(
    "orders_per_category",
    R.SQL + "SELECT category_level1 AS category, COUNT(DISTINCT order_id) AS orders FROM li JOIN gi USING (goods_id) GROUP BY 1",
)
def orders_per_category(spark: SparkSession, d: str) -> DataFrame:
    return views.orders_per_category(R.lines(spark, d), R.products(spark, d))


@query(
    "abnormal_order_totals",
    R.SQL + """SELECT order_id, ROUND(goods_amount, 2) AS goods_amount, ROUND(line_total, 2) AS line_total,
  ROUND(goods_amount - line_total, 2) AS difference
FROM (SELECT order_id, goods_amount, COALESCE(t, 0) AS line_total FROM oi
      LEFT JOIN (SELECT order_id, SUM(deal_price * goods_number) AS t FROM li GROUP BY 1) USING (order_id))
WHERE abs(goods_amount - line_total) > 100000""",
)
def abnormal_order_totals(spark: SparkSession, d: str) -> DataFrame:
    off = views.abnormal_order_totals(R.lines(spark, d), R.orders(spark, d), 100_000)
    return rounded(off, "goods_amount", "line_total", "difference")


@query(
    "demand_spikes",
    R.SQL + """, q AS (
  SELECT goods_id, time_bucket(INTERVAL '90 days', ts, TIMESTAMP '1970-01-01') AS window_start,
    CAST(SUM(goods_number) AS BIGINT) AS quantity FROM li GROUP BY 1, 2),
f AS (SELECT goods_id, MIN(window_start) AS first FROM q GROUP BY 1),
p AS (SELECT q.goods_id, q.window_start, q.quantity, COALESCE(SUM(o.quantity), 0) / 3.0 AS usual
      FROM q JOIN f ON q.goods_id = f.goods_id AND q.window_start >= f.first + INTERVAL '270 days'
      LEFT JOIN q o ON o.goods_id = q.goods_id AND o.window_start < q.window_start
        AND o.window_start >= q.window_start - INTERVAL '270 days' GROUP BY ALL)
SELECT goods_id, window_start, quantity, ROUND(usual, 2) AS usual FROM p WHERE quantity > 2.0 * usual""",
)
def demand_spikes(spark: SparkSession, d: str) -> DataFrame:
    return rounded(views.demand_spikes(R.lines(spark, d), "ts", "90 days", 3, 2.0), "usual")
