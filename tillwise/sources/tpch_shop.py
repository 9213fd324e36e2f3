"""Adapter: presents the TPC-H-like Parquet tables as the shop's source tables.

Every column is computed from the given tables, so each derived table grows with
them. Facts that the tables lack (refunds, shipments, coupons, advertising) are
derived from order lines; see FIXTURES.md section 3.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwise.plans.star import Shop

# fixed values: how the driver's codes read as shop codes
ORDER_STATUS = {"F": "completed", "O": "paid", "P": "refunded"}
ORDER_CHANNEL = {"1-URGENT": "organic", "2-HIGH": "search", "3-MEDIUM": "social", "4-NOT SPECIFIED": "email",
                 "5-LOW": "affiliate"}
EVENT_TYPE = {"view": "view_home", "click": "view_product", "signup": "add_to_cart", "error": "checkout",
              "purchase": "pay_success"}
TRAFFIC_CHANNELS = ("organic", "search", "social", "email", "affiliate", "live")
DEVICES = ("mobile", "desktop", "tablet")
PRICE_EDGES = (930.0, 970.0)
# fixed values: column types of the given files, stated so that opening a table needs no scan
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
}


def _recode(column: str, codes: dict[str, str]):
    c = F.col(column)
    out = None
    for k, v in codes.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out


class TpchShop:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in SCHEMAS:
            reader = reader.schema(SCHEMAS[name])
        return reader.parquet(f"{self.folder}/{name}.parquet")

    def __call__(self, name: str) -> DataFrame:
        return getattr(self, name)

    @cached_property
    def _lineitem(self) -> DataFrame:
        return self.raw("lineitem")

    @cached_property
    def _orders(self) -> DataFrame:
        channel = _recode("o_orderpriority", ORDER_CHANNEL)
        campaign = F.when(F.col("o_orderkey") % 3 == 0,
                          F.concat(F.substring("o_orderpriority", 1, 1), F.lit("-"),
                                   F.date_format("o_orderdate", "yyyy-MM")))
        return self.raw("orders").withColumn("channel", channel).withColumn("campaign_id", campaign)

    @cached_property
    def users(self) -> DataFrame:
        first_order = (self.raw("orders").groupBy(F.col("o_custkey").alias("c_custkey"))
                       .agg(F.min("o_orderdate").alias("created_at")))
        bal = F.col("c_acctbal")
        return (self.raw("customer")
                .join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
                .join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
                .join(first_order, "c_custkey", "left")
                .select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"),
                        F.concat(F.lit("user"), "c_custkey", F.lit("@shop.example")).alias("email"),
                        F.when(bal < 0, None).when(bal < 1000, "")
                        .otherwise(F.concat(F.lit("555-"), "c_custkey")).alias("phone"),
                        F.col("n_name").alias("province"), F.col("r_name").alias("city"),
                        F.lower("c_mktsegment").alias("register_channel"),
                        F.when(bal < 0, "at_risk").when(bal < 5000, "regular").otherwise("loyal").alias("segment"),
                        F.when(bal > 9000, None).when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
                        F.when(bal.between(0, 500), None)
                        .otherwise((F.col("c_custkey") % 50 + 1950).cast("int")).alias("birth_year"),
                        F.col("c_mktsegment").alias("member_level"), F.lit("active").alias("status"), "created_at"))

    @cached_property
    def addresses(self) -> DataFrame:
        u = self.users
        return u.select(F.concat(F.lit("addr-"), "user_id").alias("address_id"), "user_id",
                        F.col("name").alias("receiver"), "phone", "province", "city",
                        F.col("email").alias("detail"), F.lit(1).alias("is_default"))

    @cached_property
    def categories(self) -> DataFrame:
        return self.raw("part").select(F.lower("p_type").alias("category_id"), F.col("p_type").alias("name")).distinct()

    @cached_property
    def spu(self) -> DataFrame:
        return (self.raw("part").select("p_brand", "p_type").distinct()
                .select(F.concat("p_brand", F.lit("/"), "p_type").alias("spu_id"),
                        F.lower("p_type").alias("category_id"), F.col("p_brand").alias("brand"),
                        F.concat("p_brand", F.lit(" "), "p_type").alias("name"), F.lit("on_sale").alias("status")))

    @cached_property
    def sku(self) -> DataFrame:
        size, price = F.col("p_size"), F.col("p_retailprice")
        return self.raw("part").select(
            F.col("p_partkey").alias("sku_id"), F.concat("p_brand", F.lit("/"), "p_type").alias("spu_id"),
            F.col("p_name").alias("sku_name"), size.cast("string").alias("spec"), price.alias("price"),
            F.when(size >= 48, price * 1.1).otherwise(price * 0.6).alias("cost"),
            F.concat(F.lit("supplier-"), (size % 10).cast("string")).alias("supplier"),
            F.lit(None).cast("date").alias("listing_date"), (size - 3).alias("stock"),
            F.when(size <= 40, "on_sale").otherwise("off_sale").alias("status"))

    @cached_property
    def campaigns(self) -> DataFrame:
        seen = (self._orders.where(F.col("campaign_id").isNotNull())
                .groupBy("campaign_id", "channel").agg(F.min(F.trunc("o_orderdate", "month")).alias("m")))
        return seen.select(
            "campaign_id", F.concat(F.lit("Campaign "), "campaign_id").alias("name"), "channel",
            F.lit("promo").alias("campaign_type"), F.lit("all").alias("target_segment"),
            (F.month("m") % 3 == 0).cast("int").alias("has_control_group"), F.date_add("m", 4).alias("start_date"),
            F.date_add("m", 18).alias("end_date"), F.lit(10000.0).alias("budget"), F.lit("ended").alias("status"))

    @cached_property
    def orders(self) -> DataFrame:
        total = F.col("o_totalprice")
        discount = F.when(F.col("campaign_id").isNotNull(), total * 0.05).otherwise(F.lit(0.0))
        shipping = F.when(total < 20000, F.lit(8.0)).otherwise(F.lit(0.0))
        return self._orders.select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), "campaign_id",
            F.concat(F.lit("NO"), "o_orderkey").alias("order_no"),
            _recode("o_orderstatus", ORDER_STATUS).alias("status"), "channel",
            (total + discount - shipping).alias("subtotal"), discount.alias("discount_amount"),
            shipping.alias("shipping_fee"), total.alias("total_amount"), total.alias("paid_amount"),
            F.col("o_orderdate").alias("created_at"))

    @cached_property
    def order_items(self) -> DataFrame:
        price = F.col("l_extendedprice") / F.col("l_quantity")
        return self._lineitem.select(
            F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
            F.lit(None).cast("string").alias("spu_id"), F.col("l_quantity").cast("long").alias("quantity"),
            price.alias("unit_price"), (price * (F.col("l_tax") * 8 + 0.5)).alias("unit_cost"),
            (F.col("l_extendedprice") * F.col("l_discount")).alias("discount_amount"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("line_amount"))

    @cached_property
    def carts(self) -> DataFrame:
        return self.raw("orders").select(F.col("o_orderkey").alias("cart_id"), F.col("o_custkey").alias("user_id"),
                                         F.col("o_orderdate").alias("created_at"))

    @cached_property
    def cart_items(self) -> DataFrame:
        return self._lineitem.select(
            F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("cart_item_id"),
            F.col("l_orderkey").alias("cart_id"), F.col("l_partkey").alias("sku_id"),
            F.col("l_quantity").cast("long").alias("quantity"), F.col("l_shipdate").alias("created_at"))

    @cached_property
    def payments(self) -> DataFrame:
        return (self._lineitem.groupBy(F.col("l_orderkey").alias("order_id"))
                .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount"),
                     F.min("l_shipdate").alias("paid_at"))
                .select(F.concat(F.lit("pay-"), "order_id").alias("payment_id"), "order_id",
                        F.lit("card").alias("provider"), "amount", F.lit("success").alias("status"), "paid_at"))

    @cached_property
    def refunds(self) -> DataFrame:
        returned = (self._lineitem.where(F.col("l_returnflag") == "R")
                    .groupBy(F.col("l_orderkey").alias("order_id"))
                    .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount"),
                         F.max("l_shipdate").alias("created_at")))
        head = self.raw("orders").select(F.col("o_orderkey").alias("order_id"), "o_orderstatus", "o_orderpriority")
        return returned.join(head, "order_id").select(
            F.concat(F.lit("refund-"), "order_id").alias("refund_id"), "order_id", "amount",
            F.col("o_orderpriority").alias("reason"),
            F.when(F.col("o_orderstatus") == "O", "pending").otherwise("approved").alias("status"), "created_at")

    @cached_property
    def shipments(self) -> DataFrame:
        sent = (self._lineitem.groupBy(F.col("l_orderkey").alias("order_id"))
                .agg(F.min("l_shipdate").alias("shipped_at"), F.max("l_shipdate").alias("delivered_at"),
                     F.min("l_suppkey").alias("supp"), F.min("l_linestatus").alias("line_state")))
        home = (self.raw("orders").select(F.col("o_orderkey").alias("order_id"), "o_orderdate", "o_custkey")
                .join(self.raw("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
                .join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey")))
        days = F.datediff("delivered_at", "o_orderdate").cast("double")
        return sent.join(home, "order_id").select(
            F.concat(F.lit("ship-"), "order_id").alias("shipment_id"), "order_id",
            F.concat(F.lit("carrier-"), (F.col("supp") % 5).cast("string")).alias("carrier"),
            F.col("n_name").alias("province"),
            F.when(F.col("n_regionkey").isin(2, 3), 3).otherwise(5).alias("promised_days"), "shipped_at",
            "delivered_at", F.when(F.col("line_state") == "O", None).otherwise(days).alias("delivery_days"),
            F.when(F.col("line_state") == "O", "shipping").otherwise("delivered").alias("status"))

    @cached_property
    def inventory_movements(self) -> DataFrame:
        out = F.col("l_returnflag") == "A"
        qty = F.col("l_quantity").cast("long")
        return self._lineitem.select(
            F.concat("l_orderkey", F.lit("-"), "l_linenumber", F.lit("-"), "l_partkey").alias("movement_id"),
            F.col("l_partkey").alias("sku_id"), F.when(out, "out").otherwise("in").alias("movement_type"),
            F.when(out, -qty).otherwise(qty).alias("quantity"),
            F.when(out, "sale").otherwise("restock").alias("reason"),
            F.col("l_orderkey").alias("related_order_id"), F.col("l_shipdate").alias("created_at"))

    @cached_property
    def user_coupons(self) -> DataFrame:
        used = F.col("l_returnflag") != "N"
        return (self._lineitem.where(F.col("l_discount") > 0)
                .join(self.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
                .select(F.concat("l_orderkey", F.lit("-"), "l_linenumber", F.lit("-"), "l_partkey").alias("user_coupon_id"),
                        F.col("o_custkey").alias("user_id"),
                        F.round(F.col("l_discount") * 100).cast("long").alias("coupon_id"),
                        F.col("o_orderdate").alias("issued_at"), F.when(used, F.col("o_orderdate")).alias("used_at"),
                        F.when(used, F.col("l_orderkey")).alias("order_id")))

    @cached_property
    def coupons(self) -> DataFrame:
        c = F.col("coupon_id")
        return (self._lineitem.where(F.col("l_discount") > 0)
                .groupBy(F.round(F.col("l_discount") * 100).cast("long").alias("coupon_id"))
                .agg(F.count(F.lit(1)).alias("issued_count"),
                     F.count_if(F.col("l_returnflag") != "N").alias("used_count"))
                .select("coupon_id", F.lit(None).cast("string").alias("campaign_id"),
                        F.concat(F.lit("SAVE"), c).alias("code"), F.concat(F.lit("Save "), c).alias("name"),
                        (c * 1000.0).alias("threshold"), c.cast("double").alias("discount"),
                        F.lit("1995-01-01").cast("date").alias("start_date"),
                        F.lit("2001-12-31").cast("date").alias("end_date"), "issued_count", "used_count",
                        F.when(c <= 8, "active").otherwise("expired").alias("status")))

    @cached_property
    def page_events(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        pick = lambda names, n: F.element_at(F.array(*[F.lit(x) for x in names]), (k % n) + 1)
        return self.raw("events").select(
            "event_id", F.when(F.col("event_id") % 10 != 0, F.col("user_id")).alias("user_id"),
            F.concat("user_id", F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
            _recode("event_type", EVENT_TYPE).alias("event_type"), F.col("event_type").alias("page"),
            pick(TRAFFIC_CHANNELS, 6).alias("channel"), pick(DEVICES, 3).alias("device"),
            F.when(k % 4 == 0, F.concat(F.lit("E-"), (k % 12).cast("string"))).alias("campaign_id"),
            k.cast("long").alias("sku_id"), F.col("ts").alias("created_at"))

    @cached_property
    def ads_spend(self) -> DataFrame:
        head = (self._orders.where(F.col("campaign_id").isNotNull())
                .select(F.col("o_orderkey").alias("l_orderkey"), "campaign_id", "channel",
                        F.to_date("o_orderdate").alias("spend_date")))
        return (self._lineitem.join(head, "l_orderkey").groupBy("campaign_id", "channel", "spend_date")
                .agg((F.sum(F.col("l_quantity").cast("long")) * 10).alias("impressions"),
                     F.sum(F.col("l_quantity").cast("long")).alias("clicks"),
                     F.count_if(F.col("l_returnflag") == "N").alias("conversions"),
                     F.sum(F.col("l_extendedprice") * F.col("l_tax")).alias("spend_amount"))
                .select(F.concat("campaign_id", F.lit("/"), F.col("spend_date").cast("string")).alias("spend_id"),
                        "campaign_id", "spend_date", "channel", "impressions", "clicks", "conversions",
                        "spend_amount"))

    @cached_property
    def product_reviews(self) -> DataFrame:
        rating = (F.col("quality") * 2 + (1 - F.col("toxic")) * 2 + 1).cast("int")
        return (self.raw("labels").join(self.raw("documents").select("doc_id", "source"), "doc_id")
                .select(F.col("doc_id").alias("review_id"), F.lit(None).cast("long").alias("order_id"),
                        F.col("doc_id").alias("user_id"), (F.col("doc_id") % 200).alias("sku_id"),
                        rating.alias("rating"),
                        F.when(rating >= 4, "positive").when(rating == 3, "neutral").otherwise("negative").alias("sentiment"),
                        F.col("source").alias("content_tag"),
                        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 90).cast("int")).alias("created_at")))

    @cached_property
    def admin_action_logs(self) -> DataFrame:
        o = self._orders
        return o.select(F.col("o_orderkey").alias("log_id"), F.lit("ops").alias("admin_name"),
                        F.col("channel").alias("action_type"), F.lit("order").alias("entity_type"),
                        F.col("o_orderkey").cast("string").alias("entity_id"),
                        F.col("o_orderpriority").alias("detail"), F.col("o_orderdate").alias("created_at"))


def open_shop(spark: SparkSession, folder: str) -> Shop:
    """The star schema over one folder of the driver's Parquet tables."""
    return Shop(TpchShop(spark, folder), price_edges=PRICE_EDGES)
