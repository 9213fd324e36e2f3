"""Delivery, refund and review analysis, and the risk list."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tillwise.functions.exprs import percent, round_to, safe_divide, year_month


def _all() -> W:
    """The whole frame; used only over group results, a few rows."""
    return W.partitionBy()


def approved(refunds: DataFrame) -> DataFrame:
    return refunds.where(F.col("status") == "approved")


def late_by(shipments: DataFrame, group: str) -> DataFrame:
    """Shipments, late ones, mean delivery days and late rate per carrier or province."""
    return (shipments.where(F.col(group).isNotNull()).groupBy(group)
            .agg(F.count("shipment_id").alias("shipments"), F.sum("is_late").alias("late_count"),
                 round_to(F.avg("delivery_days"), 4).alias("avg_delivery_days"))
            .withColumn("late_rate", percent("late_count", "shipments")))


def late_totals(shipments: DataFrame) -> DataFrame:
    return shipments.agg(F.count(F.lit(1)).alias("total_shipments"),
                         round_to(F.avg("is_late") * 100, 2).alias("overall_late_rate"))


def late_refund_impact(shipments: DataFrame, refunds: DataFrame) -> DataFrame:
    """Refunded orders per 100 shipments, late against on time."""
    refunded = approved(refunds).select("order_id").distinct().withColumn("refunded", F.lit(True))
    g = (shipments.select("order_id", "is_late").join(refunded, "order_id", "left").groupBy("is_late")
         .agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.when(F.col("refunded"), F.col("order_id"))).alias("r")))

    def rate(late):
        pick = lambda c: F.max(F.when(F.col("is_late") == late, F.col(c)))
        return safe_divide(pick("r"), pick("n")) * 100

    return g.agg(round_to(rate(1), 2).alias("delayed_refund_rate"), round_to(rate(0), 2).alias("ontime_refund_rate"),
                 round_to(rate(1) - rate(0), 2).alias("impact"))


def monthly_refunds(refunds: DataFrame, orders: DataFrame, last: int = 12) -> DataFrame:
    o = orders.groupBy(year_month("order_date").alias("ym")).agg(F.count(F.lit(1)).alias("orders"))
    r = approved(refunds).groupBy(year_month("refund_date").alias("ym")).agg(F.count(F.lit(1)).alias("refunds"))
    return (o.join(r, "ym", "left").fillna(0, ["refunds"])
            .withColumn("refund_rate", percent("refunds", "orders")).orderBy(F.desc("ym")).limit(last))


def refund_reasons(refunds: DataFrame) -> DataFrame:
    return (approved(refunds).where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count(F.lit(1)).alias("count"))
            .withColumn("share", percent("count", F.sum("count").over(_all()), 1)))


def refund_totals(refunds: DataFrame) -> DataFrame:
    return approved(refunds).agg(F.count(F.lit(1)).alias("total_refunds"), round_to(F.sum("amount"), 2).alias("total_amount"))


def refunded_lines_per_sku(refunds: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines of refunded orders per SKU. Refunds are counted per order first, then join once."""
    per_order = approved(refunds).groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    return (lines.select("order_id", "sku_id").join(per_order, "order_id").groupBy("sku_id")
            .agg(F.sum("n").alias("refund_count")))


def top_refunded_skus(refunds, lines, products, top_n: int = 20) -> DataFrame:
    return (refunded_lines_per_sku(refunds, lines)
            .join(products.select("sku_id", "product_name", "category_name"), "sku_id")
            .orderBy(F.desc("refund_count"), "sku_id").limit(top_n))


def top_refunded_suppliers(refunds, lines, products, top_n: int = 10) -> DataFrame:
    return (refunded_lines_per_sku(refunds, lines).join(products.select("sku_id", "supplier"), "sku_id")
            .where(F.col("supplier").isNotNull()).groupBy("supplier").agg(F.sum("refund_count").alias("refund_count"))
            .orderBy(F.desc("refund_count"), "supplier").limit(top_n))


def category_ratings(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Mean rating per category, from one row per SKU."""
    per_sku = reviews.groupBy("sku_id").agg(F.sum("rating").alias("s"), F.count("rating").alias("n"))
    return (per_sku.join(products.select("sku_id", "category_name"), "sku_id").groupBy("category_name")
            .agg(percent(F.sum("s"), F.sum("n") * 100).alias("rating")))


def most_reviewed_skus(reviews: DataFrame, products: DataFrame, top_n: int = 10) -> DataFrame:
    return (reviews.groupBy("sku_id").agg(round_to(F.avg("rating"), 2).alias("avg_rating"),
                                          F.count("rating").alias("review_count"))
            .join(products.select("sku_id"), "sku_id", "left_semi")
            .orderBy(F.desc("review_count"), "sku_id").limit(top_n))


def review_totals(reviews: DataFrame) -> DataFrame:
    return reviews.agg(percent(F.count_if(F.col("rating") <= 2), F.count(F.lit(1))).alias("bad_rate"),
                       percent(F.count_if(F.col("rating") >= 4), F.count(F.lit(1))).alias("good_rate"),
                       F.count(F.lit(1)).alias("total_reviews"), round_to(F.avg("rating"), 2).alias("avg_rating"))


def sentiment_share(reviews: DataFrame) -> DataFrame:
    return (reviews.where(F.col("sentiment").isNotNull()).groupBy("sentiment").agg(F.count(F.lit(1)).alias("count"))
            .withColumn("share", percent("count", F.sum("count").over(_all()), 1)))


def top_tags(reviews: DataFrame, top_n: int = 15) -> DataFrame:
    return (reviews.where(F.col("content_tag").isNotNull()).groupBy("content_tag").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "content_tag").limit(top_n))


# fixed values: report wording
SKU_RISK, AREA_RISK = "高退款商品", "高延迟地区"
SKU_ADVICE = "排查质量或描述不符问题，考虑优化详情页"
AREA_ADVICE = "增加该地区仓储覆盖或切换承运商"


def risk_list(refunds, lines, products, shipments, least: int = 5, late_share: float = 0.1,
              top_skus: int = 10, top_areas: int = 5) -> DataFrame:
    """SKUs with many refunded lines and provinces with a high late share."""
    n = F.col("refund_count")
    skus = (refunded_lines_per_sku(refunds, lines).where(n >= least)
            .join(products.select("sku_id", "product_name", "category_name"), "sku_id")
            .orderBy(F.desc("refund_count"), "sku_id").limit(top_skus)
            .select(F.lit(SKU_RISK).alias("type"),
                    F.format_string("%s(%s)", "product_name", F.col("sku_id").cast("string")).alias("target"),
                    F.format_string("%d 次退款，品类 %s", n, "category_name").alias("evidence"),
                    F.lit(SKU_ADVICE).alias("action"), F.when(n > 15, "high").otherwise("medium").alias("severity")))
    share = F.col("late") / F.col("total")
    areas = (shipments.where(F.col("province").isNotNull()).groupBy("province")
             .agg(F.count(F.lit(1)).alias("total"), F.sum("is_late").alias("late"))
             .where(share > late_share).orderBy(F.desc(share), "province").limit(top_areas)
             .select(F.lit(AREA_RISK).alias("type"), F.col("province").alias("target"),
                     F.format_string("延迟率 %.1f%%（%d/%d）", share * 100, "late", "total").alias("evidence"),
                     F.lit(AREA_ADVICE).alias("action"), F.when(share > 0.15, "high").otherwise("medium").alias("severity")))
    return skus.unionByName(areas)


def category_delays(shipments: DataFrame, lines: DataFrame, products: DataFrame) -> DataFrame:
    """Late rate per category of the shipped lines; an order counts once per category."""
    pairs = (lines.select("order_id", "sku_id").join(products.select("sku_id", "category_name"), "sku_id")
             .select("order_id", "category_name").distinct())
    return (pairs.join(shipments.select("order_id", "is_late"), "order_id").groupBy("category_name")
            .agg(F.count(F.lit(1)).alias("shipments"), F.sum("is_late").alias("late_count"))
            .withColumn("late_rate", percent("late_count", "shipments")))


def worst_reviewed(reviews: DataFrame, products: DataFrame, group: str = "sku_id", least: int = 1, top_n: int = 20) -> DataFrame:
    """Bad-review rate (rating <= 2) per SKU or supplier, worst first."""
    per_sku = reviews.groupBy("sku_id").agg(F.count(F.lit(1)).alias("r"), F.count_if(F.col("rating") <= 2).alias("b"))
    g = (per_sku.join(products.select(*dict.fromkeys(["sku_id", group])), "sku_id").groupBy(group)
         .agg(F.sum("r").alias("reviews"), F.sum("b").alias("bad")).where(F.col("reviews") >= least)
         .withColumn("bad_rate", percent("bad", "reviews")))
    return g.orderBy(F.desc("bad_rate"), F.desc("reviews"), group).limit(top_n)


def refunded_overstock(refunds, lines, stock: DataFrame, least_refunds: int = 5, least_stock: int = 100) -> DataFrame:
    """SKUs often refunded and still well stocked."""
    return (refunded_lines_per_sku(refunds, lines).where(F.col("refund_count") >= least_refunds)
            .join(stock.select("sku_id", "current_stock"), "sku_id").where(F.col("current_stock") >= least_stock))
