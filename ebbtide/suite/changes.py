"""Change-log operators: decode, replay, capture, and the views under retraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators import signed as S
from ebbtide.plans import views
from ebbtide.sources import changelog, topics
from ebbtide.streaming import rates
from ebbtide.suite import retail as R
from ebbtide.suite.registry import query
from ebbtide.suite.relational import ANOMALY_SQL, CATEGORY_SQL, ENRICHED_SQL, rounded

FINAL_LINES = "SELECT rec_id, order_id, goods_id, goods_price, deal_price, goods_number FROM li2"
FINAL_ORDERS = """SELECT order_id, user_id, country, zipcode, goods_amount,
  date_diff('day', DATE '1970-01-01', order_date) AS order_date, year FROM oi2"""


@query(
    "change_events_per_topic",
    R.SQL + """SELECT 'order_goods' AS topic, op, CAST(SUM(CASE WHEN op = 'u' AND w < 0 THEN 0 ELSE 1 END) AS BIGINT) AS events FROM lc GROUP BY op
UNION ALL SELECT 'order_info', 'c', count(*) FROM oi
UNION ALL SELECT 'order_info', 'u', count(*) FROM oi WHERE status = 'P'
UNION ALL SELECT 'order_info', 'd', count(*) FROM oi WHERE priority = '5-LOW'
UNION ALL SELECT 'goods_info', 'r', count(*) FROM gi
UNION ALL SELECT 'goods_info', 'u', count(*) FROM gi WHERE size >= 40""",
)
def change_events_per_topic(spark: SparkSession, d: str) -> DataFrame:
    """Scan all three topics and decode every event."""
    parts = [
        R.decoded(spark, d, spec).select(F.lit(spec.name).alias("topic"), "op")
        for spec in (R.LINES, R.ORDERS, R.PRODUCTS)
    ]
    log = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return log.groupBy("topic", "op").agg(F.count(F.lit(1)).alias("events"))


@query(
    "signed_line_items",
    R.SQL + """SELECT rec_id, goods_id, deal_price, goods_number, w, epoch_ms(tm) AS ts_ms FROM lc""",
)
def signed_line_items(spark: SparkSession, d: str) -> DataFrame:
    """Every event as its retraction and its insertion."""
    return R.signed(spark, d, R.LINES).select("rec_id", "goods_id", "deal_price", "goods_number", "w", "ts_ms")


@query(
    "events_from_position",
    R.SQL + f"""SELECT op, COUNT(*) AS events, COUNT(DISTINCT rec_id) AS line_items FROM lc
WHERE tm >= TIMESTAMP '{R.CATALOG_MOVE}' AND NOT (op = 'u' AND w < 0) GROUP BY op""",
)
def events_from_position(spark: SparkSession, d: str) -> DataFrame:
    """Facts read from a position in the middle of the log."""
    start = 915_148_800_000  # 1999-01-01 in milliseconds
    late = topics.from_position(R.decoded(spark, d, R.LINES), start)
    rec_id = F.coalesce("after.rec_id", "before.rec_id")
    return late.groupBy("op").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct(rec_id).alias("line_items")
    )


@query(
    "change_times",
    R.SQL + "SELECT rec_id, w, tm AS changed_at FROM lc",
)
def change_times(spark: SparkSession, d: str) -> DataFrame:
    """The time attribute of a change, from the log and not from the clock."""
    return R.signed(spark, d, R.LINES).select("rec_id", "w", R.at_time().alias("changed_at"))


@query("replayed_line_items", R.SQL + FINAL_LINES)
def replayed_line_items(spark: SparkSession, d: str) -> DataFrame:
    return changelog.replay(R.decoded(spark, d, R.LINES), R.LINES)


@query("replayed_orders", R.SQL + FINAL_ORDERS)
def replayed_orders(spark: SparkSession, d: str) -> DataFrame:
    return changelog.replay(R.decoded(spark, d, R.ORDERS), R.ORDERS)


@query("replayed_products", R.SQL + "SELECT * FROM gi2")
def replayed_products(spark: SparkSession, d: str) -> DataFrame:
    return changelog.replay(R.decoded(spark, d, R.PRODUCTS), R.PRODUCTS)


@query("current_line_items", R.SQL + FINAL_LINES)
def current_line_items(spark: SparkSession, d: str) -> DataFrame:
    """The same table as the net of all signed rows."""
    return S.current(S.project(R.signed(spark, d, R.LINES), *R.LINES.columns))


@query(
    "net_line_item_changes",
    R.SQL + """SELECT CASE WHEN flag = 'R' THEN 'gone' ELSE 'there' END AS outcome, COUNT(*) AS line_items FROM li
WHERE flag <> 'R' GROUP BY 1""",
)
def net_line_item_changes(spark: SparkSession, d: str) -> DataFrame:
    """One net change per key; lines that came and went leave none."""
    net = changelog.net_changes(R.decoded(spark, d, R.LINES), R.LINES)
    return net.groupBy(F.when(F.col("after").isNull(), "gone").otherwise("there").alias("outcome")).agg(
        F.count(F.lit(1)).alias("line_items")
    )


DIFF_SQL = R.SQL + """SELECT rec_id, op, before_price, after_price FROM (
  SELECT rec_id, CASE WHEN li2.rec_id IS NULL THEN 'd' WHEN li.deal_price <> li2.deal_price THEN 'u' END AS op,
         li.deal_price AS before_price, li2.deal_price AS after_price
  FROM li LEFT JOIN li2 USING (rec_id)) WHERE op IS NOT NULL"""


@query("snapshot_diff", DIFF_SQL)
def snapshot_diff(spark: SparkSession, d: str) -> DataFrame:
    """Change events from comparing the first with the last state of the line-items."""
    old, new = R.lines(spark, d), changelog.replay(R.decoded(spark, d, R.LINES), R.LINES)
    events = changelog.diff(old, new, R.LINES, 0)
    return events.select(
        F.coalesce("after.rec_id", "before.rec_id").alias("rec_id"),
        "op",
        F.col("before.deal_price").alias("before_price"),
        F.col("after.deal_price").alias("after_price"),
    )


@query("diff_applied", R.SQL + FINAL_LINES)
def diff_applied(spark: SparkSession, d: str) -> DataFrame:
    """Seeding with the first state and applying the difference gives the last state."""
    old, new = R.lines(spark, d), changelog.replay(R.decoded(spark, d, R.LINES), R.LINES)
    seed = changelog.snapshot_events(old, R.LINES, 0, 0)
    step = changelog.diff(old, new, R.LINES, 1, 1)
    return changelog.replay(seed.unionByName(step), R.LINES)


@query("catalog_seed", R.SQL + "SELECT goods_id, goods_name, brand, category_level1, category_level2, 'r' AS op FROM gi")
def catalog_seed(spark: SparkSession, d: str) -> DataFrame:
    """Every catalog row published as a snapshot event, and read back."""
    events = changelog.snapshot_events(R.products(spark, d), R.PRODUCTS, 0)
    back = changelog.decode(changelog.encode(events, R.PRODUCTS), R.PRODUCTS)
    return back.select("after.*", "op")


# -- the views under retraction

def _signed_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(
        S.project(R.signed(spark, d, spec), *spec.columns) for spec in (R.LINES, R.ORDERS, R.PRODUCTS)
    )


@query("enriched_after_changes", R.SQL + ENRICHED_SQL.format(li="li2", oi="oi2", gi="gi2"))
def enriched_after_changes(spark: SparkSession, d: str) -> DataFrame:
    return S.current(views.enriched(*_signed_tables(spark, d)))


@query("category_revenue_after_changes", R.SQL + CATEGORY_SQL.format(li="li2", gi="gi2"))
def category_revenue_after_changes(spark: SparkSession, d: str) -> DataFrame:
    li, _, gi = _signed_tables(spark, d)
    return rounded(views.revenue_by_category(li, gi), "revenue")


@query("anomalies_after_changes", R.SQL + ANOMALY_SQL.format(li="li2", gi="gi2"))
def anomalies_after_changes(spark: SparkSession, d: str) -> DataFrame:
    li, _, gi = _signed_tables(spark, d)
    return S.current(views.pricing_anomalies(li, gi))


SIGNED_WINDOW_SQL = """SELECT time_bucket(INTERVAL '10 seconds', tm, TIMESTAMP '1970-01-01') AS window_start,
  time_bucket(INTERVAL '10 seconds', tm, TIMESTAMP '1970-01-01') + INTERVAL '10 seconds' AS window_end,
  CAST(SUM(w) AS BIGINT) AS line_items, ROUND(SUM(w * (deal_price * goods_number)), 2) AS revenue
FROM lc GROUP BY 1, 2 HAVING SUM(w) <> 0"""


@query("windows_over_changes", R.SQL + SIGNED_WINDOW_SQL)
def windows_over_changes(spark: SparkSession, d: str) -> DataFrame:
    """A deletion counts in the window it falls into."""
    log = R.signed(spark, d, R.LINES).withColumn("at", R.at_time())
    return rounded(views.revenue_by_window(log, "at", "10 seconds"), "revenue")


@query(
    "windows_of_insertions",
    R.SQL + SIGNED_WINDOW_SQL.replace("FROM lc", "FROM lc WHERE w > 0"),
)
def windows_of_insertions(spark: SparkSession, d: str) -> DataFrame:
    log = R.signed(spark, d, R.LINES).withColumn("at", R.at_time())
    return rounded(views.revenue_by_window(log, "at", "10 seconds", inserts_only=True), "revenue")


@query(
    "orders_per_category_after_changes",
    R.SQL + "SELECT category_level1 AS category, COUNT(DISTINCT order_id) AS orders FROM li2 JOIN gi2 USING (goods_id) GROUP BY 1",
)
def orders_per_category_after_changes(spark: SparkSession, d: str) -> DataFrame:
    li, _, gi = _signed_tables(spark, d)
    return views.orders_per_category(li, gi)


@query(
    "abnormal_totals_after_changes",
    R.SQL + """SELECT order_id, goods_amount, ROUND(line_total, 8) AS line_total,
  ROUND(goods_amount - line_total, 8) AS difference
FROM (SELECT order_id, goods_amount, COALESCE(t, 0) AS line_total FROM oi2
      LEFT JOIN (SELECT order_id, SUM(deal_price * goods_number) AS t FROM li2 GROUP BY 1) USING (order_id))
WHERE abs(goods_amount - line_total) > 100000""",
)
def abnormal_totals_after_changes(spark: SparkSession, d: str) -> DataFrame:
    li, oi, _ = _signed_tables(spark, d)
    off = views.abnormal_order_totals(li, oi, 100_000)
    # Eight digits: more than the amounts have, so that none lies between two results.
    return off.withColumns({c: F.round(c, 8) for c in ("line_total", "difference")})


@query(
    "unmatched_retractions",
    R.SQL + f"""SELECT COUNT(*) AS unmatched_rows, CAST(COALESCE(-SUM(n), 0) AS BIGINT) AS unmatched_weight FROM (
  SELECT rec_id, deal_price, SUM(w) AS n FROM lc WHERE tm >= TIMESTAMP '{R.CATALOG_MOVE}' GROUP BY 1, 2 HAVING SUM(w) < 0)""",
)
def unmatched_retractions(spark: SparkSession, d: str) -> DataFrame:
    """Updates and deletions of rows from before the start position."""
    late = topics.from_position(R.decoded(spark, d, R.LINES), 915_148_800_000)
    return S.unmatched(S.project(changelog.signed(late), *R.LINES.columns))


@query(
    "change_rates",
    R.SQL + """SELECT tm AS second, op, COUNT(*) AS events FROM lc WHERE NOT (op = 'u' AND w < 0) GROUP BY 1, 2""",
)
def change_rates(spark: SparkSession, d: str) -> DataFrame:
    events = R.decoded(spark, d, R.LINES).select("op", R.at_time().alias("at"))
    return rates.rates(events, "at", "op", "1 second")


@query(
    "change_outcomes",
    R.SQL + """SELECT CASE WHEN op = 'd' THEN 'unknown operation x' ELSE 'applied' END AS outcome, COUNT(*) AS events
FROM lc WHERE NOT (op = 'u' AND w < 0) GROUP BY 1""",
)
def change_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Error counts of a log in which deletions carry an operation that nobody knows."""
    raw = R.log(spark, d).changes().where(F.col("topic") == R.LINES.name)
    broken = raw.withColumn("value", F.replace("value", F.lit('"op":"d"'), F.lit('"op":"x"')))
    return rates.outcomes(broken, R.LINES)
