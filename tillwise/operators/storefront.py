"""Shop-facing reads: product listing, order history, coupons and cart pricing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwise.functions.exprs import price_band, round_to, safe_divide


def _products(sku: DataFrame, spu: DataFrame, categories: DataFrame, edges) -> DataFrame:
    spu = spu.select("spu_id", "category_id", "brand", F.col("name").alias("product_name"),
                     F.col("status").alias("product_status"))
    return (sku.join(spu, "spu_id")
            .join(categories.select("category_id", F.col("name").alias("category_name")), "category_id")
            .select("sku_id", "spu_id", "category_id", "category_name", "brand", "product_name", "sku_name", "spec",
                    "price", "cost", "stock", F.col("status").alias("sku_status"), "product_status",
                    price_band("price", *edges).alias("price_band")))


def product_listing(sku: DataFrame, spu: DataFrame, categories: DataFrame, category_id: str | None = None,
                    text: str | None = None, edges=(100.0, 500.0)) -> DataFrame:
    """Products on sale; ``text`` matches product, brand or category name without regard to case."""
    out = _products(sku.where(F.col("status") == "on_sale"), spu.where(F.col("status") == "on_sale"), categories, edges)
    if category_id is not None:
        out = out.where(F.col("category_id") == category_id)
    if text:
        needle = f"%{text}%"
        out = out.where(F.col("product_name").ilike(needle) | F.col("brand").ilike(needle)
                        | F.col("category_name").ilike(needle))
    return out.drop("sku_status").orderBy("category_name", "product_name", "price", "sku_id")


def product(sku: DataFrame, spu: DataFrame, categories: DataFrame, sku_id, edges=(100.0, 500.0)) -> DataFrame:
    return _products(sku.where(F.col("sku_id") == sku_id), spu, categories, edges).drop("sku_status")


def active_coupons(coupons: DataFrame) -> DataFrame:
    return (coupons.where(F.col("status") == "active")
            .select("coupon_id", "campaign_id", "code", "name", "threshold", "discount", "start_date", "end_date")
            .orderBy(F.desc("discount"), "coupon_id"))


def category_list(categories: DataFrame) -> DataFrame:
    return categories.select("category_id", "name").orderBy("name")


def order_lines_of(orders: DataFrame, items: DataFrame, sku: DataFrame, user_id, newest: int = 50) -> DataFrame:
    """Lines of a user's newest orders. The order page is taken first, so only its lines are joined."""
    page = (orders.where(F.col("user_id") == user_id).orderBy(F.desc("created_at"), F.desc("order_id")).limit(newest)
            .select("order_id", "order_no", "status", "channel", "subtotal", "discount_amount", "shipping_fee",
                    "paid_amount", "created_at"))
    lines = items.select("order_id", "sku_id", "quantity", "unit_price", "line_amount")
    return page.join(lines, "order_id", "left").join(sku.select("sku_id", "sku_name"), "sku_id", "left")


def order_history(orders: DataFrame, items: DataFrame, sku: DataFrame, user_id, newest: int = 50) -> DataFrame:
    """The same with items nested per order (at most ``newest`` orders of one user)."""
    head = ["order_id", "order_no", "status", "channel", "subtotal", "discount_amount", "shipping_fee",
            "paid_amount", "created_at"]
    item = F.when(F.col("quantity").isNotNull(), F.struct("sku_name", "sku_id", "quantity", "unit_price", "line_amount"))
    return (order_lines_of(orders, items, sku, user_id, newest).groupBy(*head)
            .agg(F.sort_array(F.collect_list(item)).alias("items")).orderBy(F.desc("created_at"), F.desc("order_id")))


def price_carts(carts: DataFrame, items: DataFrame, sku: DataFrame, coupons: DataFrame,
                free_from: float = 99.0, shipping_fee: float = 8.0) -> DataFrame:
    """Price every cart line as a checkout would.

    ``carts`` has cart_id and coupon_code. A coupon counts when it is active and the
    subtotal reaches its threshold; its discount is shared over the lines by value.
    A cart is accepted when every line is on sale and in stock. Cart totals come
    from an aggregate joined back, so one large cart can be split over tasks.
    """
    on_sale = sku.where(F.col("status") == "on_sale").select("sku_id", "price", F.col("stock").alias("in_stock"))
    lines = items.select("cart_id", "sku_id", "quantity").join(on_sale, "sku_id", "left")
    amount = F.col("price") * F.col("quantity")
    fits = F.coalesce((F.col("in_stock") >= F.col("quantity")) & (F.col("quantity") >= 1), F.lit(False))
    totals = lines.groupBy("cart_id").agg(round_to(F.coalesce(F.sum(amount), F.lit(0.0)), 2).alias("subtotal"),
                                          F.min(fits.cast("int")).alias("accepted"))
    offer = (coupons.where(F.col("status") == "active")
             .select(F.col("code").alias("coupon_code"), "threshold", F.col("discount").alias("offer")))
    priced = (totals.join(carts.select("cart_id", "coupon_code"), "cart_id").join(offer, "coupon_code", "left")
              .withColumn("discount", F.when(F.col("subtotal") >= F.col("threshold"), round_to("offer", 2)).otherwise(F.lit(0.0)))
              .withColumn("shipping", F.when(F.col("subtotal") >= free_from, F.lit(0.0)).otherwise(F.lit(shipping_fee)))
              .withColumn("paid", round_to(F.col("subtotal") - F.col("discount") + F.col("shipping"), 2)))
    share = round_to(safe_divide(amount, "subtotal") * F.col("discount"), 2)
    return (lines.join(priced, "cart_id")
            .select("cart_id", "sku_id", "quantity", "price", "subtotal", "discount", "shipping", "paid", "accepted",
                    fits.cast("int").alias("line_ok"), share.alias("line_discount"),
                    round_to(amount - share, 2).alias("line_amount")))


def coupon_counters(coupons: DataFrame, user_coupons: DataFrame) -> DataFrame:
    """Issued and used counts recomputed from the coupons users hold."""
    held = user_coupons.groupBy("coupon_id").agg(F.count(F.lit(1)).alias("issued_count"),
                                                 F.count("used_at").alias("used_count"))
    return (coupons.drop("issued_count", "used_count").join(held, "coupon_id", "left")
            .fillna(0, ["issued_count", "used_count"]))
