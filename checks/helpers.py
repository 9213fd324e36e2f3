from pyspark.sql import functions as F

from checks import check
from tillwise.functions import exprs as x


@check("q01_format_money", "SELECT order_id, '¥' || format('{:,.2f}', coalesce(CASE WHEN status = 'refunded' THEN NULL ELSE paid_amount END, 0)) AS paid FROM s_orders")
def _(s, spark):
    return s.orders.select("order_id", x.format_money(F.when(F.col("status") != "refunded", F.col("paid_amount"))).alias("paid"))


@check("q02_format_percent", "SELECT sku_id, CASE WHEN stock <= 0 THEN '0.00%' ELSE printf('%.2f%%', round(1 - cost / price, 6) * 100) END AS margin FROM s_sku")
def _(s, spark):
    return s.sku.select("sku_id", x.format_percent(F.when(F.col("stock") > 0, x.round_to(1 - F.col("cost") / F.col("price"), 6))).alias("margin"))


@check("q03_parse_date", """SELECT order_id, CASE WHEN status = 'paid' THEN NULL ELSE CAST(created_at AS DATE) END AS day FROM s_orders""")
def _(s, spark):
    text = F.when(F.col("status") == "paid", F.lit("n/a")).otherwise(F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))
    return s.orders.select("order_id", x.parse_date(text).alias("day"))


@check("q04_json_rows")
def _(s, spark):
    df = s.fact_refund.withColumn("amount", F.when(F.col("status") == "pending", F.lit(float("nan"))).otherwise(F.col("amount")))
    return df.select("refund_id", x.json_row(df).alias("json"))
