"""Customer and product feature tables, one row per user or SKU.

Each feature frame ends in a ``groupBy(user_id)``, so the joins of the wide table
reuse its partitioning; a reader of few columns makes Catalyst drop the joins it
does not need. ``as_of`` replaces the wall clock and defaults to the data's end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillwise.functions.exprs import clip, is_paid, is_weekend, round_to, safe_divide
from tillwise.functions.scale import durable, exact_quantiles, stats
from tillwise.operators.cleaning import correlations, numeric_columns
from tillwise.operators.fulfilment import refunded_lines_per_sku
from tillwise.operators.inventory import stock_levels

EVENT_TYPES = ("view_home", "search", "view_category", "view_product", "add_to_cart", "checkout", "pay_success")
NO_ORDERS = "无订单"  # fixed value: segment of users without a paid order


def last_date(df: DataFrame, column: str = "order_date"):
    return stats(df, d=F.max(column))["d"]


def _day(as_of) -> Column:
    return F.lit(as_of).cast("date")


# ---- RFM -------------------------------------------------------------------------
def rfm(orders: DataFrame, as_of=None) -> DataFrame:
    """Days since the last paid order, paid orders and their sum per user."""
    paid = orders.where(is_paid() & F.col("user_id").isNotNull())
    end = as_of or last_date(paid)
    return paid.groupBy("user_id").agg(F.datediff(_day(end), F.max("order_date")).alias("recency"),
                                       F.count("order_id").alias("frequency"),
                                       F.coalesce(F.sum("paid_amount"), F.lit(0.0)).alias("monetary"))


QUINTILES = (0.2, 0.4, 0.6, 0.8)


def rfm_scores(base: DataFrame, one_to_five: bool = False) -> DataFrame:
    """Quintile scores. The bin of a value is 1 plus the number of edges below it.

    R is 5 minus its bin (0..4); ``one_to_five`` makes it 6 minus the bin. Equal
    edges merge bins, so equal values never get different scores.
    """
    base = durable(base)  # one row per user; the quantile passes read it instead of the orders
    edges = exact_quantiles(base, ["recency", "frequency", "monetary"], QUINTILES)

    def bin_of(c):
        out = F.lit(1)
        for p in QUINTILES:
            e = edges[c, p]
            if e is not None:
                out = out + (F.col(c) > F.lit(e)).cast("int")
        return out

    return base.withColumns({"R_score": F.lit(6 if one_to_five else 5) - bin_of("recency"),
                             "F_score": bin_of("frequency"), "M_score": bin_of("monetary")})


def rfm_segment(scored: DataFrame) -> DataFrame:
    """First matching rule, in order."""
    r, f, m = F.col("R_score"), F.col("F_score"), F.col("M_score")
    # fixed values: segment names
    segment = (F.when((r >= 4) & (f >= 4) & (m >= 4), "核心价值").when((r >= 4) & (f >= 4), "重要发展")
               .when((r >= 4) & (f < 3), "潜力客户").when((r >= 3) & (f >= 3), "一般维持").when(r >= 3, "一般挽留")
               .when(r < 2, "流失客户").when(r < 3, "沉睡客户").otherwise("其他"))
    return scored.withColumn("rfm_segment", segment)


def rfm_table(orders: DataFrame, as_of=None, one_to_five: bool = False) -> DataFrame:
    return rfm_segment(rfm_scores(rfm(orders, as_of), one_to_five))


# ---- behaviour ---------------------------------------------------------------------
def _user_days(traffic: DataFrame, types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    """One row per user and day; every distinct-day count becomes a row count on it."""
    e, d = F.col("event_type"), F.col("device")
    return (traffic.where(F.col("user_id").isNotNull() & (F.col("user_id").cast("string") != ""))
            .groupBy("user_id", "event_date")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(e.isNotNull()).alias("typed"),
                 *[F.count_if(e == t).alias(t) for t in types], F.count_if(e.contains("view")).alias("views"),
                 F.count_if(d == "mobile").alias("mobile"), F.count_if(d == "desktop").alias("desktop")))


def behaviour(traffic: DataFrame, types: Sequence[str] = EVENT_TYPES) -> DataFrame:
    """Counts per event type, active days, events per active day, mobile share of mobile and desktop."""
    g = _user_days(traffic, types).groupBy("user_id").agg(
        *[F.sum(t).alias(t) for t in types], F.sum("typed").alias("total_events"),
        F.count("event_date").alias("active_days"), F.sum("mobile").alias("m"), F.sum("desktop").alias("d"))
    return g.select("user_id", *types, "total_events", "active_days",
                    safe_divide("m", F.col("m") + F.col("d")).alias("mobile_ratio"),
                    (F.col("search") if "search" in types else F.lit(0)).alias("search_count"),
                    (F.col("total_events") / F.greatest("active_days", F.lit(1))).alias("avg_daily_events"))


def window_features(traffic: DataFrame, as_of=None, windows=(7, 30, 90)) -> DataFrame:
    """Events, views, cart adds and active days of the last 7, 30 and 90 days; no upper date bound."""
    end = as_of or last_date(traffic, "event_date")
    cols = []
    for w in windows:
        inside = F.col("event_date") >= F.date_sub(_day(end), w)
        for src, name in (("n", "events"), ("views", "views"), ("add_to_cart", "cart")):
            cols.append(F.sum(F.when(inside, F.col(src)).otherwise(0)).alias(f"{name}_{w}d"))
        cols.append(F.count_if(inside).alias(f"active_days_{w}d"))
    widest = F.date_sub(_day(end), max(windows))
    return _user_days(traffic.where(F.col("event_date") >= widest)).groupBy("user_id").agg(*cols)


def coupon_features(coupons: DataFrame, as_of=None) -> DataFrame:
    """Issued, used, discounts, use rate and days since the last use (999 when never used)."""
    end = as_of or last_date(coupons, "used_date")
    g = coupons.groupBy("user_id").agg(
        F.count("user_coupon_id").alias("coupons_issued_count"), F.count_if(F.col("is_used") == 1).alias("coupons_used_count"),
        F.coalesce(F.avg("discount"), F.lit(0.0)).alias("avg_coupon_discount"),
        F.coalesce(F.sum("discount"), F.lit(0.0)).alias("total_coupon_savings"),
        F.max(F.when(F.col("is_used") == 1, F.col("used_date"))).alias("last"))
    return (g.withColumn("coupon_use_rate", F.col("coupons_used_count") / F.greatest("coupons_issued_count", F.lit(1)))
            .withColumn("days_since_last_coupon", F.coalesce(F.datediff(_day(end), "last"), F.lit(999))).drop("last"))


def category_features(lines: DataFrame, products: DataFrame, low: float = 100.0, high: float = 500.0) -> DataFrame:
    """Favourite category (alphabetical on ties), categories bought, mean price, share of dear and cheap lines.

    Lines meet their product first and shrink to (user, category) after it: a step by
    (user, SKU) before would move nearly every line once more, as few repeat.
    """
    p = products.select("sku_id", "category_name", "price")
    bought = lines.where(F.col("user_id").isNotNull()).select("user_id", "sku_id", "unit_price")
    per_category = (bought.join(p, "sku_id", "left").groupBy("user_id", "category_name")
                    .agg(F.count(F.lit(1)).alias("n"), F.sum("unit_price").alias("s"), F.count("unit_price").alias("np"),
                         F.count_if(F.col("price") > high).alias("dear"), F.count_if(F.col("price") < low).alias("cheap")))
    best = F.min(F.when(F.col("category_name").isNotNull(), F.struct((-F.col("n")).alias("n"), "category_name")))
    return per_category.groupBy("user_id").agg(
        best["category_name"].alias("top_category"), F.count("category_name").alias("category_diversity"),
        (F.sum("s") / F.sum("np")).alias("avg_unit_price"), (F.sum("dear") / F.sum("n")).alias("high_price_ratio"),
        (F.sum("cheap") / F.sum("n")).alias("low_price_ratio"))


def shopping_features(orders: DataFrame, refunds: DataFrame | None = None, as_of=None) -> DataFrame:
    """Order rhythm over all order states, and refunds when given."""
    end = as_of or last_date(orders)
    g = orders.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.min("order_date").alias("first"), F.max("order_date").alias("last"), F.count("order_id").alias("order_count"),
        F.avg(is_weekend("order_date")).alias("weekend_order_ratio"))
    g = g.withColumn("lifecycle_days", F.datediff("last", "first"))
    g = g.withColumns({"lifecycle_months": F.greatest(F.col("lifecycle_days") / 30, F.lit(1.0)),
                       "avg_order_interval": F.col("lifecycle_days") / F.greatest("order_count", F.lit(1)),
                       "first_order_days_ago": F.datediff(_day(end), "first")})
    g = g.withColumn("monthly_orders", F.col("order_count") / F.col("lifecycle_months"))
    if refunds is not None:
        r = refunds.groupBy("user_id").agg(F.count(F.lit(1)).alias("refund_count"))
        g = g.join(r, "user_id", "left")
    else:
        g = g.withColumn("refund_count", F.lit(0).cast("long"))
    g = g.withColumn("refund_count", F.coalesce("refund_count", F.lit(0)))
    return g.withColumn("has_refund", (F.col("refund_count") > 0).cast("int")).drop("first", "last")


# ---- wide tables -------------------------------------------------------------------
def user_wide(users: DataFrame, orders: DataFrame, lines: DataFrame, traffic: DataFrame, coupons: DataFrame,
              refunds: DataFrame, products: DataFrame, as_of=None, traffic_as_of=None,
              price_edges=(100.0, 500.0)) -> DataFrame:
    """One row per user with all features; numbers default to 0, texts to 'unknown'.

    ``traffic_as_of`` is for sources whose traffic covers another period than orders.
    """
    end = as_of or last_date(orders)
    parts = [rfm_table(orders, end), behaviour(traffic), window_features(traffic, traffic_as_of or end),
             coupon_features(coupons, end), category_features(lines, products, *price_edges),
             shopping_features(orders, refunds, end)]
    wide = users
    for p in parts:
        wide = wide.join(p, "user_id", "left")
    keep = ("user_id", "birth_year", "name", "city")
    fill = {"rfm_segment": F.coalesce("rfm_segment", F.lit(NO_ORDERS))}
    for f in wide.schema.fields:
        if f.name in keep or f.name in fill:
            continue
        if isinstance(f.dataType, T.NumericType):
            fill[f.name] = F.coalesce(F.col(f.name), F.lit(0).cast(f.dataType))
        elif isinstance(f.dataType, T.StringType):
            fill[f.name] = F.coalesce(F.col(f.name), F.lit("unknown"))
    return wide.withColumns(fill)


def wide_check(wide: DataFrame, users: DataFrame) -> DataFrame:
    """Rows, distinct users and expected rows; a sound table has all three equal."""
    n = users.agg(F.count(F.lit(1)).alias("n")).scalar()
    return wide.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("user_id").alias("users")).withColumn("expected", n)


def high_correlations(wide: DataFrame, threshold: float = 0.8, columns: Sequence[str] | None = None,
                      limit: int | None = None) -> DataFrame:
    """Feature pairs with abs(r) above the threshold, in column order."""
    exclude = {"user_id", "birth_year", "R_score", "F_score", "M_score"}
    columns = columns or [c for c in numeric_columns(wide) if c not in exclude]
    out = correlations(wide, columns).where(F.abs("r") > threshold).orderBy("i", "j")
    out = out.limit(limit) if limit else out
    return out.select("feature1", "feature2", round_to("r", 4).alias("correlation"))


def product_wide(products: DataFrame, lines: DataFrame, reviews: DataFrame, refunds: DataFrame, movements: DataFrame,
                 raw_sign: bool = False) -> DataFrame:
    """One row per SKU: sales of paid orders, rating, refund rate, turnover and 90-day trend (-1..5)."""
    paid = lines.where(is_paid())
    end = _day(last_date(paid))
    recent, older = F.date_sub(end, 90), F.date_sub(end, 180)
    d, q = F.col("order_date"), F.col("quantity")
    sold = paid.groupBy("sku_id").agg(
        F.sum("quantity").alias("total_quantity"), F.sum("line_amount").alias("total_sales"),
        F.avg("unit_price").alias("avg_order_price"), F.sum("gross_profit").alias("total_gross_profit"),
        F.sum(F.when(d >= recent, q)).alias("recent_qty"), F.sum(F.when((d >= older) & (d < recent), q)).alias("older_qty"))
    rating = reviews.groupBy("sku_id").agg(F.avg("rating").alias("avg_rating"))
    stock = stock_levels(movements, raw_sign).select(
        "sku_id", (F.col("total_out") / F.greatest(F.col("total_in") - F.col("total_out"), F.lit(1))).alias("turnover_rate"))
    trend = (F.col("recent_qty") - F.col("older_qty")) / F.greatest("older_qty", F.lit(1))
    s = (sold.join(rating, "sku_id", "left").join(refunded_lines_per_sku(refunds, lines), "sku_id", "left")
         .join(stock, "sku_id", "left"))
    s = s.select("sku_id", "total_quantity", "total_sales", "avg_order_price", "total_gross_profit",
                 F.coalesce("avg_rating", F.lit(0.0)).alias("avg_rating"), F.coalesce("refund_count", F.lit(0)).alias("refund_count"),
                 (F.coalesce("refund_count", F.lit(0)) / F.greatest("total_quantity", F.lit(1))).alias("refund_rate"),
                 F.coalesce("turnover_rate", F.lit(0.0)).alias("turnover_rate"),
                 clip(F.coalesce(trend, F.lit(0.0)), F.lit(-1.0), F.lit(5.0)).alias("sales_trend"))
    return products.join(s, "sku_id", "left")
