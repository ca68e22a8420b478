"""The four result views, and the further analyses built on the same tables.

Each function takes plain or signed tables and returns a plain or signed
table.  The row views (``enriched``, ``pricing_anomalies``) also accept
streaming input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions import line_amount, to_millis
from ebbtide.operators import signed as S
from ebbtide.operators.sizing import fits_broadcast


def enriched(lines: DataFrame, orders: DataFrame, products: DataFrame, salts: int = 1) -> DataFrame:
    """Each line-item with the country of its order and its product's brand and category.

    Facts meet the product table first: it is the side that may be small enough
    to broadcast, and then only the order join shuffles.
    """
    li = S.project(lines, "rec_id", "order_id", "goods_id", "deal_price", "goods_number")
    oi = S.project(orders, "order_id", "country")
    gi = S.project(products, "goods_id", "brand", F.col("category_level1").alias("category"))
    joined = S.join(S.join(li, gi, "goods_id", salts), oi, "order_id")
    return S.project(
        joined, "rec_id", "order_id", "country", "brand", "category", "deal_price", "goods_number"
    )


def sold_products(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Lines with their product: what the category, anomaly and enriched results have in common."""
    li = S.project(lines, "rec_id", "order_id", "goods_id", "goods_price", "deal_price", "goods_number")
    gi = S.project(products, "goods_id", "brand", F.col("category_level1").alias("category"))
    return S.join(li, gi, "goods_id")


def with_orders(sold: DataFrame, orders: DataFrame) -> DataFrame:
    """``enriched`` of lines that have met their product."""
    joined = S.join(sold, S.project(orders, "order_id", "country"), "order_id")
    return S.project(
        joined, "rec_id", "order_id", "country", "brand", "category", "deal_price", "goods_number"
    )


def category_sums(sold: DataFrame, exact: bool = False) -> DataFrame:
    """``category_deltas`` of lines that have met their product."""
    return sold.groupBy("category").agg(*signed_sums(sold, line_amount(exact)))


def anomalies_among(sold: DataFrame) -> DataFrame:
    """``pricing_anomalies`` of lines that have met their product."""
    return S.project(
        priced_above_list(sold), "rec_id", "order_id", "brand", "goods_price", "deal_price", "goods_number"
    )


def category_deltas(lines: DataFrame, products: DataFrame, exact: bool = False) -> DataFrame:
    """Line-items, revenue and priced line-items per category, summed with their signs.

    If the product table fits a broadcast, the join costs no shuffle and the
    aggregate shuffles one row per task and category.  Otherwise the lines are
    first summed per product: that is far smaller than the lines, and a product
    with a third of all lines leaves each task as a single row.
    """
    gi = S.project(products, "goods_id", F.col("category_level1").alias("category"))
    li = S.project(lines, "goods_id", line_amount(exact).alias("amount"))
    if fits_broadcast(gi):
        joined = S.join(li, gi, "goods_id")
        return joined.groupBy("category").agg(*signed_sums(joined, F.col("amount")))
    per_product = li.groupBy("goods_id").agg(*signed_sums(li, F.col("amount")))
    joined = S.join(per_product, gi, "goods_id")
    sums = [F.sum(S.weight(joined) * F.col(n)).alias(n) for n in ("line_items", "revenue", "priced")]
    return joined.groupBy("category").agg(*sums)


def signed_sums(df: DataFrame, amount: Column) -> list[Column]:
    """Line-items, revenue and priced line-items of a plain or signed table."""
    signs = S.weight(df).cast("bigint")
    return [
        F.sum(signs).alias("line_items"),
        F.sum(signs * amount).alias("revenue"),
        F.sum(F.when(amount.isNotNull(), signs).otherwise(0)).alias("priced"),
    ]


def published(deltas: DataFrame) -> DataFrame:
    """Summed deltas as result rows: empty groups vanish, unpriced revenue is NULL."""
    return deltas.where("line_items <> 0").withColumn(
        "revenue", F.when(F.col("priced") != 0, F.col("revenue"))
    ).drop("priced")


def revenue_by_category(lines: DataFrame, products: DataFrame, exact: bool = False) -> DataFrame:
    """Line-items and revenue per product category; NULL is a category of its own."""
    return published(category_deltas(lines, products, exact))


def window_deltas(lines: DataFrame, time: Column | str, duration: str = "10 seconds", exact: bool = False) -> DataFrame:
    """As ``category_deltas``, per tumbling window of ``time``."""
    time = F.col(time) if isinstance(time, str) else time
    grouped = lines.groupBy(F.window(time, duration).alias("_window")).agg(
        *signed_sums(lines, line_amount(exact))
    )
    return grouped.select(
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        "line_items",
        "revenue",
        "priced",
    )


def revenue_by_window(
    lines: DataFrame,
    time: Column | str,
    duration: str = "10 seconds",
    inserts_only: bool = False,
    exact: bool = False,
) -> DataFrame:
    """Line-items and revenue per tumbling window.

    On a change log a deletion counts in the window it falls into, which can go
    negative.  ``inserts_only`` leaves retractions out.
    """
    if inserts_only and S.is_signed(lines):
        lines = lines.where(F.col(S.W) > 0)
    return published(window_deltas(lines, time, duration, exact))


def millisecond_windows(windows: DataFrame) -> DataFrame:
    """Window bounds cut to the millisecond, as the result table declares them."""
    return windows.withColumn("window_start", to_millis(F.col("window_start"))).withColumn(
        "window_end", to_millis(F.col("window_end"))
    )


def priced_above_list(lines: DataFrame) -> DataFrame:
    """Line-items whose deal price is above the list price; unknown prices are not."""
    return lines.where(F.col("deal_price") > F.col("goods_price"))


def pricing_anomalies(lines: DataFrame, products: DataFrame, salts: int = 1) -> DataFrame:
    """Line-items sold above list price, with the brand.  The filter runs before the join."""
    li = S.project(
        priced_above_list(lines), "rec_id", "order_id", "goods_id", "goods_price", "deal_price", "goods_number"
    )
    gi = S.project(products, "goods_id", "brand")
    return S.project(
        S.join(li, gi, "goods_id", salts), "rec_id", "order_id", "brand", "goods_price", "deal_price", "goods_number"
    )


def orders_per_category(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct orders with a live line-item, per category."""
    li = S.project(lines, "order_id", "goods_id")
    gi = S.project(products, "goods_id", F.col("category_level1").alias("category"))
    return S.count_distinct(S.join(li, gi, "goods_id"), ["category"], "order_id", "orders")


def abnormal_order_totals(lines: DataFrame, orders: DataFrame, tolerance: float) -> DataFrame:
    """Orders whose stated total is off the sum of their line-items by more than ``tolerance``.

    An order without line-items has a line total of 0.  Lines are summed before
    the join, so an order with very many lines joins as one row.
    """
    li = S.project(lines, "order_id", line_amount().alias("amount"))
    totals = S.aggregate(li, ["order_id"], line_total=S.total(li, F.col("amount")))
    stated = S.project(orders, "order_id", "goods_amount")
    stated = S.current(stated) if S.is_signed(stated) else stated
    both = stated.join(totals, "order_id", "left").withColumn(
        "line_total", F.coalesce(F.col("line_total"), F.lit(0.0))
    )
    off = F.col("goods_amount") - F.col("line_total")
    return both.withColumn("difference", off).where(F.abs(off) > tolerance)


def demand_spikes(
    lines: DataFrame, time: Column | str, duration: str, history: int, factor: float
) -> DataFrame:
    """Products whose quantity in a window exceeds ``factor`` times the mean of the ``history`` windows before it.

    A window in which the product did not sell counts as zero. Windows count
    from the product's first one, so a product is judged once it has been known
    for ``history`` windows. Quantities are summed per product and window first;
    the ordered frame then sees at most one row per product and time window.
    """
    time = F.col(time) if isinstance(time, str) else time
    start = F.col("_window.start")
    second = start.cast("timestamp").cast("bigint")
    length = F.col("_window.end").cast("timestamp").cast("bigint") - second
    quantities = S.aggregate(
        lines.withColumn("_window", F.window(time, duration)),
        ["goods_id", "_window"],
        quantity=S.total(lines, F.col("goods_number")),
    ).select("goods_id", start.alias("window_start"), F.floor(second / length).alias("_at"), "quantity")
    product = Window.partitionBy("goods_id").orderBy("_at")
    past = product.rangeBetween(-history, -1)
    first = F.min("_at").over(product.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        quantities.withColumn("usual", F.coalesce(F.sum("quantity").over(past), F.lit(0)) / F.lit(history))
        .withColumn("_first", first)
        .where((F.col("_at") - F.col("_first") >= history) & (F.col("quantity") > factor * F.col("usual")))
        .select("goods_id", "window_start", "quantity", "usual")
    )
