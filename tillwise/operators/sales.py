"""Sales cockpit: headline figures, trends, breakdowns and anomaly months.

``order_id`` is the primary key of the order table, so orders per group are
counted; only buyers need a distinct count. Windows run over months, channels
or categories after aggregation, never over raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tillwise.functions.exprs import change, is_paid, percent, round_to, safe_divide, year_month
from tillwise.functions.scale import one_row, scalars


def headline(orders: DataFrame, lines: DataFrame, refunds: DataFrame, traffic: DataFrame) -> DataFrame:
    """One row of nine figures. ``lines`` carries its order's status."""
    paid = is_paid()
    o = scalars(orders, gmv=F.coalesce(F.sum(F.when(paid, F.col("paid_amount"))), F.lit(0.0)),
                orders=F.count(F.when(paid, F.col("order_id"))), total=F.count(F.lit(1)),
                buyers=F.count_distinct(F.when(paid, F.col("user_id"))))
    r = scalars(refunds.where(F.col("status") == "approved"),
                amount=F.coalesce(F.sum("amount"), F.lit(0.0)), orders=F.count_distinct("order_id"))
    p = scalars(lines.where(paid), profit=F.coalesce(F.sum("gross_profit"), F.lit(0.0)))
    s = session_totals(traffic)
    raw = one_row(orders.sparkSession, o=o, r=r, p=p, s=s)
    gmv, n = F.col("o.gmv"), F.col("o.orders")
    return raw.select(
        round_to(gmv, 2).alias("gmv"), round_to(gmv - F.col("r.amount"), 2).alias("net_sales"),
        round_to("p.profit", 2).alias("gross_profit"), percent("p.profit", gmv).alias("gross_margin"),
        n.alias("order_count"), F.col("o.buyers").alias("buyer_count"), round_to(safe_divide(gmv, n), 2).alias("aov"),
        percent("r.orders", "o.total").alias("refund_rate"),
        percent("s.paying", "s.sessions").alias("conversion_rate"))


def session_totals(traffic: DataFrame):
    """Struct (sessions, paying): one distinct key instead of two distinct counts."""
    per_session = (traffic.where(F.col("session_id").isNotNull()).groupBy("session_id")
                   .agg(F.max((F.col("event_type") == "pay_success").cast("int")).alias("paid")))
    return scalars(per_session, sessions=F.count(F.lit(1)), paying=F.coalesce(F.sum("paid"), F.lit(0)))


def core_metrics(orders: DataFrame, lines: DataFrame, refunds: DataFrame, traffic: DataFrame) -> DataFrame:
    """The eight figures of the summary call: the headline without the conversion rate."""
    return headline(orders, lines, refunds, traffic).drop("conversion_rate")


# fixed values: the wording of each metric definition
DEFINITIONS = {
    "gmv": "SUM(orders.paid_amount) WHERE status IN ('paid', 'completed')",
    "netSales": "GMV - SUM(refunds.amount) WHERE status = 'approved'",
    "grossProfit": "SUM((unit_price - unit_cost) * quantity - discount_amount)",
    "orderCount": "COUNT(DISTINCT order_id) WHERE status IN ('paid', 'completed')",
    "buyerCount": "COUNT(DISTINCT user_id) WHERE status IN ('paid', 'completed')",
    "avgOrderValue": "GMV / 订单数",
    "refundRate": "退款订单数 / 支付订单数",
    "funnel": "page_events 各 event_type 计数",
}


def defined_metrics(orders: DataFrame, lines: DataFrame, refunds: DataFrame, traffic: DataFrame,
                    stages=("view_home", "view_product", "add_to_cart", "checkout", "pay_success")) -> DataFrame:
    """Rows (metric, value, definition); refund rate over PAID orders, funnel by event counts."""
    paid = is_paid()
    o = scalars(orders.where(paid), gmv=round_to(F.sum("paid_amount"), 2), n=F.count("order_id"),
                buyers=F.count_distinct("user_id"))
    r = scalars(refunds.where(F.col("status") == "approved"), amount=round_to(F.sum("amount"), 2),
                n=F.count_distinct("order_id"))
    p = scalars(lines.where(paid), profit=round_to(F.sum("gross_profit"), 2))
    t = scalars(traffic, **{s: F.count_if(F.col("event_type") == s) for s in stages})
    raw = one_row(orders.sparkSession, o=o, r=r, p=p, t=t)
    gmv = F.coalesce("o.gmv", F.lit(0.0))
    values = {
        "gmv": F.col("o.gmv"), "netSales": round_to(gmv - F.coalesce("r.amount", F.lit(0.0)), 2),
        "grossProfit": F.col("p.profit"), "orderCount": F.col("o.n"), "buyerCount": F.col("o.buyers"),
        "avgOrderValue": round_to(safe_divide(gmv, "o.n"), 2), "refundRate": round_to(safe_divide("r.n", "o.n"), 4),
        **{f"funnel.{s}": F.col(f"t.{s}") for s in stages},
    }
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value"),
                              F.lit(DEFINITIONS[m.split(".")[0]]).alias("definition")) for m, v in values.items()])
    return raw.select(F.inline(rows))


def _monthly(orders: DataFrame, *more) -> DataFrame:
    return (orders.where(is_paid()).groupBy(year_month("order_date").alias("ym"))
            .agg(F.sum("paid_amount").alias("gmv"), F.count("order_id").alias("orders"), *more))


def monthly_trend(orders: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Per month gmv, orders, order value and change on the previous month that has sales.

    With ``lines`` a gross profit column is added.
    """
    by_month = W.orderBy("ym")  # one row per month
    aov = round_to(F.col("gmv") / F.col("orders"), 2)
    out = _monthly(orders).withColumn("aov", aov)
    for c in ("gmv", "orders", "aov"):
        out = out.withColumn(f"{c}_mom", change(c, F.lag(c).over(by_month)))
    out = out.select("ym", round_to("gmv", 2).alias("gmv"), "orders", "aov",
                     *[round_to(f"{c}_mom", 6).alias(f"{c}_mom") for c in ("gmv", "orders", "aov")])
    if lines is not None:
        profit = (lines.where(is_paid()).groupBy(year_month("order_date").alias("ym"))
                  .agg(round_to(F.sum("gross_profit"), 2).alias("gross_profit")))
        out = out.join(profit, "ym", "left")
    return out


def _share(df: DataFrame, value: str = "gmv") -> DataFrame:
    """Percent of the column total; the window sees one row per group value."""
    return df.withColumn("share", percent(value, F.sum(value).over(W.partitionBy())))


def channel_breakdown(orders: DataFrame) -> DataFrame:
    g = (orders.where(is_paid()).groupBy("channel")
         .agg(F.sum("paid_amount").alias("gmv"), F.count("order_id").alias("orders"),
              F.count_distinct("user_id").alias("buyers")))
    return _share(g).withColumn("gmv", round_to("gmv", 2))


def category_breakdown(lines: DataFrame, products: DataFrame, statuses=None) -> DataFrame:
    """Per category gmv, orders and SKUs. All order states by default; ``statuses`` narrows them.

    Sales are summed per SKU before the product join, so a hot SKU is one row
    there; distinct orders need (order, SKU) pairs and are counted apart.
    """
    if statuses:
        lines = lines.where(F.col("status").isin(*statuses))
    category = products.select("sku_id", "category_name")
    totals = (lines.groupBy("sku_id").agg(F.sum("net_amount").alias("gmv"))
              .join(category, "sku_id").groupBy("category_name")
              .agg(F.sum("gmv").alias("gmv"), F.count(F.lit(1)).alias("sku_count")))
    orders = (lines.select("order_id", "sku_id").join(category, "sku_id")
              .groupBy("category_name").agg(F.count_distinct("order_id").alias("orders")))
    out = totals.join(orders, "category_name")
    return _share(out).select("category_name", round_to("gmv", 2).alias("gmv"), "orders", "sku_count", "share")


def member_contribution(orders: DataFrame, users: DataFrame) -> DataFrame:
    """Buyers, orders and gmv per member level, from one row per user."""
    per_user = (orders.where(is_paid()).groupBy("user_id")
                .agg(F.count("order_id").alias("orders"), F.sum("paid_amount").alias("gmv")))
    return (per_user.join(users.select("user_id", "member_level"), "user_id").groupBy("member_level")
            .agg(F.count(F.lit(1)).alias("buyers"), F.sum("orders").alias("orders"),
                 round_to(F.sum("gmv"), 2).alias("gmv")))


def top_bottom_products(lines: DataFrame, products: DataFrame, top_n: int = 10) -> DataFrame:
    """Best and worst products by sales; ties by sku_id. Two top-k scans of per-SKU totals."""
    per_sku = (lines.groupBy("sku_id").agg(F.sum("quantity").alias("total_qty"), F.sum("net_amount").alias("gmv"))
               .join(products.select("sku_id", "product_name", "category_name"), "sku_id"))
    top = per_sku.orderBy(F.desc("gmv"), "sku_id").limit(top_n).withColumn("side", F.lit("top"))
    bottom = per_sku.orderBy("gmv", F.desc("sku_id")).limit(top_n).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom).withColumn("gmv", round_to("gmv", 2))


def daily_by_channel(orders: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    o = orders.where(is_paid())
    if start:
        o = o.where(F.col("order_date") >= F.lit(start).cast("date"))
    if end:
        o = o.where(F.col("order_date") <= F.lit(end).cast("date"))
    return (o.groupBy("order_date", "channel")
            .agg(round_to(F.sum("paid_amount"), 2).alias("gmv"), F.count("order_id").alias("orders")))


def latest_month_change(orders: DataFrame) -> DataFrame:
    """Percent change of the latest month with sales on the one before it."""
    m = (_monthly(orders, F.count_distinct("user_id").alias("buyers"))
         .withColumn("aov", round_to(F.col("gmv") / F.col("orders"), 2)))
    by_month = W.orderBy("ym")
    m = m.withColumn("previous_month", F.lag("ym").over(by_month))
    for c in ("gmv", "orders", "buyers", "aov"):
        m = m.withColumn(f"{c}_mom", round_to(change(c, F.lag(c).over(by_month)) * 100, 2))
    return (m.where(F.col("previous_month").isNotNull()).orderBy(F.desc("ym")).limit(1)
            .select(F.col("ym").alias("current_month"), "previous_month", "gmv_mom", "orders_mom", "buyers_mom",
                    "aov_mom"))


def anomaly_months(orders: DataFrame, threshold: float = 0.10) -> DataFrame:
    """Months whose gmv or order count moved by more than ``threshold``, one row per indicator."""
    by_month = W.orderBy("ym")
    m = _monthly(orders)
    rows = F.array(*[F.struct(F.lit(label).alias("indicator"), change(c, F.lag(c).over(by_month)).alias("move"),
                              round_to(F.col(c).cast("double"), 2).alias("value"))
                     for c, label in (("gmv", "GMV"), ("orders", "订单数"))])
    return (m.select("ym", rows.alias("rows")).select(F.col("ym").alias("month"), F.inline("rows"))
            .where(F.abs("move") > threshold)
            .select("month", "indicator", round_to(F.col("move") * 100, 2).alias("change_pct"),
                    F.when(F.col("move") > 0, "up").otherwise("down").alias("direction"), "value"))


def calendar_growth(orders: DataFrame) -> DataFrame:
    """Month and year change on a gap-free calendar: a month without sales counts as 0."""
    m = _monthly(orders).select(F.to_date(F.concat("ym", F.lit("-01"))).alias("month"), "gmv")
    span = m.agg(F.explode(F.sequence(F.min("month"), F.max("month"), F.expr("interval 1 month"))).alias("month"))
    by_month = W.orderBy("month")
    full = span.join(m, "month", "left").withColumn("gmv", F.coalesce("gmv", F.lit(0.0)))
    return full.select(year_month("month").alias("ym"), round_to("gmv", 2).alias("gmv"),
                       round_to(change("gmv", F.lag("gmv", 1).over(by_month)), 6).alias("mom"),
                       round_to(change("gmv", F.lag("gmv", 12).over(by_month)), 6).alias("yoy"))
