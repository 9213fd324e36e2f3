"""SKU performance, ABC classes, product strategies and stock alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwise.functions.exprs import percent, round_to, stock
from tillwise.functions.scale import running_totals

CLASSES = ("A", "B", "C")


def stock_levels(movements: DataFrame, raw_sign: bool = False) -> DataFrame:
    """Per SKU quantity in, out and on hand. Stored 'out' is negative; see exprs.stock."""
    q = F.col("quantity")
    out = q if raw_sign else F.abs(q)
    return (movements.groupBy("sku_id")
            .agg(F.sum(F.when(F.col("movement_type") == "in", q).otherwise(0)).alias("total_in"),
                 F.sum(F.when(F.col("movement_type") == "out", out).otherwise(0)).alias("total_out"))
            .withColumn("current_stock", F.col("total_in") - F.col("total_out")))


def sku_performance(lines: DataFrame, products: DataFrame, movements: DataFrame, raw_sign: bool = False) -> DataFrame:
    """Sales, profit, orders, stock and turnover per sold SKU."""
    sold = (lines.groupBy("sku_id")
            .agg(F.sum("quantity").alias("total_qty"), F.sum("net_amount").alias("total_sales"),
                 F.sum("gross_profit").alias("gross_profit"), F.count_distinct("order_id").alias("order_count")))
    out = (sold.join(products.select("sku_id", "product_name", "category_name", "supplier"), "sku_id")
           .join(stock_levels(movements, raw_sign), "sku_id", "left")
           .fillna(0, ["total_in", "total_out", "current_stock"]))
    shelf = F.greatest(F.col("current_stock") + 1, F.lit(1))
    times = round_to(F.col("total_qty") / shelf, 2)
    return (out.withColumn("turnover_times", times)
            .withColumn("turnover_days", F.coalesce(round_to(F.try_divide(F.lit(365.0), "turnover_times"), 0), F.lit(365.0)))
            .withColumns({c: round_to(c, 2) for c in ("total_sales", "gross_profit")}))


def performance_totals(performance: DataFrame) -> DataFrame:
    active = F.count_if(F.col("total_qty") > 0)
    return performance.agg(F.count(F.lit(1)).alias("total_skus"), active.alias("active_skus"),
                           percent(active, F.count(F.lit(1)), 1).alias("sell_through_rate"),
                           round_to(F.sum("total_sales"), 2).alias("total_revenue"),
                           round_to(F.sum("gross_profit"), 2).alias("total_profit"))


def abc_classify(df: DataFrame, value: str, label: str, key: str = "sku_id",
                 a: float = 0.7, b: float = 0.9) -> DataFrame:
    """Class by cumulative share of ``value`` from the largest down; ties by ``key``.

    An item that alone passes the first limit is B or C, as its own value counts.
    """
    ranked = running_totals(df, [F.desc(value), F.asc(key)], cumulative=F.col(value))
    share = round_to(F.try_divide("cumulative", "total_cumulative"), 10)
    return (ranked.withColumn(f"abc_{label}", F.when(share <= a, "A").when(share <= b, "B").otherwise("C"))
            .drop("cumulative", "total_cumulative"))


def _per_sku(lines: DataFrame, products: DataFrame) -> DataFrame:
    return (lines.groupBy("sku_id").agg(F.sum("quantity").alias("qty"), round_to(F.sum("net_amount"), 4).alias("sales"),
                                        round_to(F.sum("gross_profit"), 4).alias("profit"))
            .join(products.select("sku_id", "product_name", "category_name"), "sku_id"))


def abc_skus(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Every SKU with its class by sales, profit and volume."""
    out = _per_sku(lines, products)
    for value, label in (("sales", "sales"), ("profit", "profit"), ("qty", "volume")):
        out = abc_classify(out, value, label)
    return out


def abc_matrix(skus: DataFrame) -> DataFrame:
    return (skus.groupBy("abc_sales", "abc_profit")
            .agg(F.count("sku_id").alias("sku_count"), round_to(F.sum("sales"), 2).alias("total_sales")))


def abc_summary(skus: DataFrame) -> DataFrame:
    """SKUs per measure and class, in one pass; empty classes are 0."""
    measures = ("abc_sales", "abc_profit", "abc_volume")
    counted = skus.agg(*[F.count_if(F.col(m) == c).alias(f"{m}_{c}") for m in measures for c in CLASSES])
    rows = F.array(*[F.struct(F.lit(m).alias("measure"), *[F.col(f"{m}_{c}").alias(c) for c in CLASSES]) for m in measures])
    return counted.select(F.inline(rows))


# fixed values: strategy names in rule order
RESTOCK, CLEAR, REPRICE, DELIST, FOCUS = "补货", "清仓", "提价/控成本", "考虑下架", "重点运营"


def product_strategies(lines: DataFrame, products: DataFrame, movements: DataFrame, raw_sign: bool = False) -> DataFrame:
    """First matching rule per SKU; SKUs without a rule are left out."""
    level = movements.groupBy("sku_id").agg(stock(raw_sign=raw_sign).alias("stock"))
    df = abc_classify(_per_sku(lines, products), "sales", "class").join(level, "sku_id", "left").fillna(0, ["stock"])
    cls, qty, sales, profit, on_hand = (F.col(c) for c in ("abc_class", "qty", "sales", "profit", "stock"))
    rule = (F.when((cls == "A") & (on_hand < qty * 0.5), RESTOCK)
            .when((cls == "C") & (on_hand > qty * 3), CLEAR)
            .when((cls == "A") & (profit < sales * 0.2), REPRICE)
            .when((cls == "C") & (qty < 10), DELIST)
            .when((cls == "B") & (profit > sales * 0.5), FOCUS))
    return (df.withColumn("strategy", rule).where(F.col("strategy").isNotNull())
            .select("sku_id", "product_name", F.col("category_name").alias("category"), "abc_class", "strategy",
                    round_to("sales", 2).alias("sales"), "stock", "qty"))


def strategy_summary(strategies: DataFrame) -> DataFrame:
    names = (RESTOCK, CLEAR, REPRICE, DELIST, FOCUS)
    counted = strategies.agg(*[F.count_if(F.col("strategy") == s).alias(f"s{i}") for i, s in enumerate(names)])
    return counted.select(F.inline(F.array(*[F.struct(F.lit(s).alias("strategy"), F.col(f"s{i}").alias("skus"))
                                             for i, s in enumerate(names)])))


STOCKOUT, SLOW = "缺货预警", "滞销预警"  # fixed values: alert names


def stock_alerts(performance: DataFrame, slow_limit: int | None = None) -> DataFrame:
    """Stock below three days of demand, and turnover over 180 days.

    All alerts are returned; ``slow_limit`` keeps only that many slow movers by sku_id.
    """
    daily = F.when(F.col("total_qty") > 0, F.col("total_qty") / 365).otherwise(F.lit(0.0))
    low = (performance.where((F.col("current_stock") < daily * 3) & (F.col("total_qty") > 10))
           .select("sku_id", F.lit(STOCKOUT).alias("type"), "current_stock", round_to(daily, 1).alias("avg_daily_demand"),
                   F.lit(None).cast("double").alias("turnover_days"),
                   F.when(F.col("current_stock") <= 0, "high").otherwise("medium").alias("severity")))
    slow = performance.where(F.col("turnover_days") > 180)
    if slow_limit is not None:
        slow = slow.orderBy("sku_id").limit(slow_limit)
    slow = slow.select("sku_id", F.lit(SLOW).alias("type"), "current_stock",
                       F.lit(None).cast("double").alias("avg_daily_demand"), "turnover_days",
                       F.lit("medium").alias("severity"))
    return low.unionByName(slow)


def alert_counts(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count_if(F.col("type") == STOCKOUT).alias("stockout_count"),
                      F.count_if(F.col("type") == SLOW).alias("overstock_count"))
