"""The star schema: fourteen views over the shop's source tables.

``Shop`` wraps any ``name -> DataFrame`` source. Views are built on first use and
stay lazy, so a query reads only the tables and columns it needs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tillwise.functions.exprs import is_paid, is_weekend, price_band, round_to, year_month

SOURCE_TABLES = (
    "users", "addresses", "categories", "spu", "sku", "campaigns", "coupons", "user_coupons", "carts",
    "cart_items", "orders", "order_items", "payments", "refunds", "shipments", "inventory_movements",
    "product_reviews", "page_events", "ads_spend", "admin_action_logs",
)


class Shop:
    def __init__(self, source: Callable[[str], DataFrame], price_edges: tuple[float, float] = (100.0, 500.0)):
        self._source = source
        self._frames: dict[str, DataFrame] = {}
        self.price_edges = price_edges

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            build = VIEWS.get(name)
            if build is None and name not in SOURCE_TABLES:
                raise AttributeError(f"no table or view named {name}")
            self._frames[name] = build(self) if build else self._source(name)
        return self._frames[name]

    def register(self) -> None:
        """Make every table and view available to spark.sql under its own name."""
        for name in (*SOURCE_TABLES, *PUBLIC_VIEWS):
            getattr(self, name).createOrReplaceTempView(name)


def _dim_product(s: Shop) -> DataFrame:
    spu = s.spu.select("spu_id", "category_id", "brand", F.col("name").alias("product_name"),
                       F.col("status").alias("product_status"))
    category = s.categories.select("category_id", F.col("name").alias("category_name"))
    return (s.sku.select("sku_id", "spu_id", "sku_name", "spec", "price", "cost", "supplier", "listing_date")
            .join(spu, "spu_id").join(category, "category_id")
            .select("sku_id", "spu_id", "category_id", "category_name", "brand", "product_name", "sku_name",
                    "spec", "price", "cost", "supplier", "listing_date",
                    price_band("price", *s.price_edges).alias("price_band"), "product_status"))


def _dim_user(s: Shop) -> DataFrame:
    return s.users.select("user_id", "name", "province", "city", "register_channel", "segment", "gender",
                          "birth_year", "member_level", "status", F.to_date("created_at").alias("register_date"))


def _dim_campaign(s: Shop) -> DataFrame:
    return s.campaigns.select("campaign_id", "name", "channel", "campaign_type", "target_segment",
                              "has_control_group", "start_date", "end_date", "budget", "status")


def _dim_date(s: Shop) -> DataFrame:
    # each branch is made distinct before the union: the shuffle moves days, not rows
    days = None
    for frame, column in ((s.orders, "created_at"), (s.page_events, "created_at"),
                          (s.ads_spend, "spend_date"), (s.refunds, "created_at")):
        part = frame.select(F.to_date(column).alias("date_id")).distinct()
        days = part if days is None else days.union(part)
    d = F.col("date_id")
    return (days.where(d.isNotNull()).distinct()
            .select("date_id", F.year(d).alias("year"), F.month(d).alias("month"), year_month(d).alias("year_month"),
                    (F.dayofweek(d) - 1).alias("weekday"), is_weekend(d).alias("is_weekend")))


def _fact_order(s: Shop) -> DataFrame:
    return s.orders.select("order_id", "user_id", "campaign_id", F.to_date("created_at").alias("order_date"),
                           "channel", "status", "subtotal", "discount_amount", "shipping_fee", "total_amount",
                           "paid_amount")


def _sales_lines(s: Shop) -> DataFrame:
    """Order lines with their header's user, date, channel and status: the one lines-orders join."""
    head = s.orders.select("order_id", "user_id", "campaign_id", F.to_date("created_at").alias("order_date"),
                           "channel", "status")
    price, cost, qty = F.col("unit_price"), F.col("unit_cost"), F.col("quantity")
    return (s.order_items.join(head, "order_id")
            .withColumn("gross_profit", (price - cost) * qty - F.col("discount_amount"))
            .withColumn("net_amount", price * qty - F.col("discount_amount")))


def _fact_order_item(s: Shop) -> DataFrame:
    return s.sales_lines.select("order_item_id", "order_id", "user_id", "campaign_id", "order_date", "sku_id",
                                "spu_id", "quantity", "unit_price", "unit_cost", "discount_amount", "line_amount",
                                "gross_profit")


def _fact_traffic(s: Shop) -> DataFrame:
    return s.page_events.select("event_id", "user_id", "session_id", "event_type", "page", "channel", "device",
                                "campaign_id", "sku_id", F.to_date("created_at").alias("event_date"), "created_at")


def _fact_ads_spend(s: Shop) -> DataFrame:
    return s.ads_spend.select("spend_id", "campaign_id", "spend_date", "channel", "impressions", "clicks",
                              "conversions", "spend_amount")


def _fact_coupon_use(s: Shop) -> DataFrame:
    template = s.coupons.select("coupon_id", "campaign_id", "threshold", "discount")
    return (s.user_coupons.join(template, "coupon_id")
            .select("user_coupon_id", "user_id", "coupon_id", "campaign_id", "order_id",
                    F.to_date("issued_at").alias("issued_date"), F.to_date("used_at").alias("used_date"),
                    "threshold", "discount", F.col("used_at").isNotNull().cast("int").alias("is_used")))


def _fact_refund(s: Shop) -> DataFrame:
    head = s.orders.select("order_id", "user_id", "campaign_id")
    return (s.refunds.join(head, "order_id")
            .select("refund_id", "order_id", "user_id", "campaign_id", F.to_date("created_at").alias("refund_date"),
                    "amount", "reason", "status"))


def _fact_fulfillment(s: Shop) -> DataFrame:
    head = s.orders.select("order_id", "user_id", F.to_date("created_at").alias("order_date"))
    late = F.when(F.col("delivery_days") > F.col("promised_days"), 1).otherwise(0)
    return (s.shipments.join(head, "order_id")
            .select("shipment_id", "order_id", "user_id", "order_date", F.to_date("shipped_at").alias("shipped_date"),
                    F.to_date("delivered_at").alias("delivered_date"), "carrier", "province", "promised_days",
                    "delivery_days", late.alias("is_late"), "status"))


def _fact_inventory_movement(s: Shop) -> DataFrame:
    return s.inventory_movements.select("movement_id", "sku_id", "movement_type", "quantity", "reason",
                                        "related_order_id", F.to_date("created_at").alias("movement_date"),
                                        "created_at")


def _fact_product_review(s: Shop) -> DataFrame:
    return s.product_reviews.select("review_id", "order_id", "user_id", "sku_id", "rating", "sentiment",
                                    "content_tag", F.to_date("created_at").alias("review_date"))


def daily_summary(orders: DataFrame) -> DataFrame:
    """Sales per day and channel. ``order_id`` is a primary key, so orders are counted, not de-duplicated."""
    return (orders.where(is_paid())
            .groupBy(F.col("order_date").alias("summary_date"), "channel")
            .agg(F.count("order_id").alias("orders"), F.count_distinct("user_id").alias("buyers"),
                 round_to(F.sum("paid_amount"), 2).alias("gmv"),
                 round_to(F.sum("discount_amount"), 2).alias("discount_amount"),
                 round_to(F.avg("paid_amount"), 2).alias("avg_order_value")))


VIEWS: dict[str, Callable[[Shop], DataFrame]] = {
    "dim_product": _dim_product, "dim_user": _dim_user, "dim_campaign": _dim_campaign, "dim_date": _dim_date,
    "fact_order": _fact_order, "fact_order_item": _fact_order_item, "fact_traffic": _fact_traffic,
    "fact_ads_spend": _fact_ads_spend, "fact_coupon_use": _fact_coupon_use, "fact_refund": _fact_refund,
    "fact_fulfillment": _fact_fulfillment, "fact_inventory_movement": _fact_inventory_movement,
    "fact_product_review": _fact_product_review,
    "daily_business_summary": lambda s: daily_summary(s.fact_order),
    "sales_lines": _sales_lines,
}
PUBLIC_VIEWS = tuple(v for v in VIEWS if v != "sales_lines")
