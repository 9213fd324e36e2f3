import uuid

from checks import check
from tillwise.functions.exprs import round_to
from pyspark.sql import functions as F
from tillwise.operators import storefront as sf
from tillwise.plans.star import PUBLIC_VIEWS, SOURCE_TABLES
from tillwise.sources import sinks, tables
from tillwise.sources.tpch_shop import PRICE_EDGES


def rounded(df, *cols):
    return df.withColumns({c: round_to(c, 2) for c in cols})


@check("a01_scan_orders", "SELECT order_id, user_id, status, channel, paid_amount FROM s_orders")
def _(s, spark):
    return s.orders.select("order_id", "user_id", "status", "channel", "paid_amount")


@check("a02_paged_lookup", """SELECT order_id, user_id, created_at, paid_amount FROM s_orders
    WHERE status = 'paid' AND channel = 'search' ORDER BY created_at, order_id LIMIT 100 OFFSET 50""")
def _(s, spark):
    return tables.query_table(s.orders, "order_id", 100, 50, "created_at", filters={"status": "paid", "channel": "search"}
                              ).select("order_id", "user_id", "created_at", "paid_amount")


@check("a03_paged_lookup_desc", """SELECT order_id, paid_amount FROM s_orders WHERE channel = 'email'
    ORDER BY paid_amount DESC, order_id LIMIT 9000""")
def _(s, spark):
    return tables.query_table(s.orders, "order_id", 9000, 0, "paid_amount", True, {"channel": "email"}
                              ).select("order_id", "paid_amount")


@check("a03_page_total", "SELECT count(*) AS total FROM s_orders WHERE channel = 'email'")
def _(s, spark):
    return tables.page_total(s.orders, {"channel": "email"})


AMOUNTS = dict.fromkeys(("subtotal", "discount_amount", "shipping_fee", "total_amount", "paid_amount"), "double")
ORDER_TYPES = {"order_id": "bigint", "user_id": "bigint", **dict.fromkeys(("campaign_id", "order_no", "status", "channel"), "string"), **AMOUNTS, "created_at": "timestamp_ntz"}
FACT_TYPES = {"order_id": "bigint", "user_id": "bigint", "campaign_id": "string", "order_date": "date", "channel": "string", "status": "string", **AMOUNTS}


def schema_sql(name, tag, source, types):
    """A row per column with what the table holds there."""
    return " UNION ALL ".join(f"""SELECT '{name}' AS table_name, '{tag}' AS table_type, {i} AS position, '{c}' AS name, '{t}' AS type, {c == 'shipping_fee'} AS not_null,
        {c == 'order_id'} AS pk, count(*) - count({c}) AS missing_count, round((count(*) - count({c})) / count(*), 4) AS missing_rate FROM {source}""" for i, (c, t) in enumerate(types.items()))


@check("a04_table_schema", schema_sql("orders", "source", "s_orders", ORDER_TYPES))
def _(s, spark):
    return tables.table_profile(s.orders, "orders", ["order_id"])


CATALOGUED = [t for t in (*SOURCE_TABLES, *PUBLIC_VIEWS)]
SQL_NAME = {t: (t if t in PUBLIC_VIEWS else f"s_{t}") for t in CATALOGUED} | {"addresses": "s_users"}


def tag(t):
    return "dimension" if t[:4] == "dim_" else "fact" if t[:5] == "fact_" else "summary" if t[:5] == "daily" else "source"


@check("a05_table_catalog", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{tag(t)}' AS table_type, count(*) AS record_count FROM {SQL_NAME[t]}" for t in CATALOGUED))
def _(s, spark):
    return tables.catalog(s)


@check("a06_table_catalog_views", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{tag(t)}' AS table_type, count(*) AS record_count FROM {t}" for t in PUBLIC_VIEWS))
def _(s, spark):
    return tables.catalog(s, PUBLIC_VIEWS)


@check("a07_load_table")
def _(s, spark):
    folder = s._source.folder
    return tables.load_table(spark, "orders", parquet=folder)


@check("a08_load_table_page", """SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_custkey LIMIT 200 OFFSET 20""")
def _(s, spark):
    return tables.load_table(spark, "customer", parquet=s._source.folder, offset=20, limit=200, key="c_custkey"
                             ).select("c_custkey", "c_name", "c_acctbal")


@check("a09_fetch_all", "SELECT order_id, user_id, status, paid_amount FROM s_orders WHERE status = 'refunded'")
def _(s, spark):
    return tables.fetch_all(s.orders, {"status": "refunded"}).select("order_id", "user_id", "status", "paid_amount")


@check("a12_order_range_scan", """SELECT order_id, user_id, order_date, channel, paid_amount FROM fact_order
    WHERE order_date BETWEEN '1996-03-01' AND '1997-02-28' AND channel IN ('search', 'email')""")
def _(s, spark):
    return tables.load_range(s, "fact_order", "1996-03-01", "1997-02-28", ["search", "email"]
                           ).select("order_id", "user_id", "order_date", "channel", "paid_amount")


@check("a13_line_range_scan", """SELECT order_id, sku_id, order_date, quantity, round(line_amount, 2) AS line_amount
    FROM fact_order_item WHERE order_date BETWEEN '1998-01-01' AND '1998-06-30'""")
def _(s, spark):
    return rounded(tables.load_range(s, "fact_order_item", "1998-01-01", "1998-06-30"), "line_amount"
                   ).select("order_id", "sku_id", "order_date", "quantity", "line_amount")


@check("a14_traffic_range_scan", """SELECT event_id, user_id, session_id, event_type, channel, event_date FROM fact_traffic
    WHERE event_date BETWEEN '2024-01-05' AND '2024-01-20' AND channel IN ('live', 'social')""")
def _(s, spark):
    return tables.load_range(s, "fact_traffic", "2024-01-05", "2024-01-20", ["live", "social"]
                           ).select("event_id", "user_id", "session_id", "event_type", "channel", "event_date")


@check("a15_dimension_loaders", """
    SELECT 'dim_user' AS view_name, count(*) AS n, count(DISTINCT user_id) AS keys FROM dim_user
    UNION ALL SELECT 'dim_product', count(*), count(DISTINCT sku_id) FROM dim_product
    UNION ALL SELECT 'dim_date', count(*), count(DISTINCT date_id) FROM dim_date
    UNION ALL SELECT 'dim_campaign', count(*), count(DISTINCT campaign_id) FROM dim_campaign""")
def _(s, spark):
    return _key_counts(s, {"dim_user": "user_id", "dim_product": "sku_id", "dim_date": "date_id", "dim_campaign": "campaign_id"})


FACT_KEYS = {"fact_coupon_use": "coupon_id", "fact_refund": "refund_id", "fact_fulfillment": "shipment_id",
             "fact_inventory_movement": "sku_id", "fact_product_review": "review_id", "fact_ads_spend": "spend_id"}


@check("a16_fact_loaders", " UNION ALL ".join(
    f"SELECT '{v}' AS view_name, count(*) AS n, count(DISTINCT {k}) AS keys FROM {v}" for v, k in FACT_KEYS.items()))
def _(s, spark):
    return _key_counts(s, FACT_KEYS)


def _key_counts(s, keys):
    out = None
    for v, k in keys.items():
        one = getattr(s, v).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(k).alias("keys")).select(
            F.lit(v).alias("view_name"), "n", "keys")
        out = one if out is None else out.union(one)
    return out


@check("a17_daily_summary_range", """SELECT * FROM daily_business_summary
    WHERE summary_date BETWEEN '1996-01-01' AND '1996-12-31' AND channel IN ('organic', 'social')""")
def _(s, spark):
    return tables.in_range(s.daily_business_summary, "summary_date", "1996-01-01", "1996-12-31", ["organic", "social"]
                           ).orderBy("summary_date", "channel")


@check("a18_latest_daily_rows", "SELECT * FROM daily_business_summary ORDER BY summary_date DESC, channel LIMIT 120")
def _(s, spark):
    return tables.latest_summary(s.daily_business_summary)


PRODUCT = """sku_id, spu_id, category_id, category_name, brand, product_name, sku_name, spec, price, cost, stock,
    product_status, CASE WHEN price < 930 THEN 'low' WHEN price < 970 THEN 'mid' ELSE 'high' END AS price_band
    FROM (SELECT sk.*, sp.category_id, c.name AS category_name, sp.brand, sp.name AS product_name, sp.status AS product_status
          FROM s_sku sk JOIN s_spu sp ON sk.spu_id = sp.spu_id JOIN s_categories c ON c.category_id = sp.category_id)"""


@check("a22_product_listing", f"""SELECT {PRODUCT} WHERE status = 'on_sale' AND
    (product_name ILIKE '%promo%' OR brand ILIKE '%promo%' OR category_name ILIKE '%promo%')""")
def _(s, spark):
    return sf.product_listing(s.sku, s.spu, s.categories, text="promo", edges=PRICE_EDGES)


@check("a23_product_by_key", f"SELECT {PRODUCT} WHERE sku_id = 17")
def _(s, spark):
    return sf.product(s.sku, s.spu, s.categories, 17, PRICE_EDGES)


@check("a24_active_coupons", """SELECT coupon_id, campaign_id, code, name, threshold, discount, start_date, end_date
    FROM s_coupons WHERE status = 'active'""")
def _(s, spark):
    return sf.active_coupons(s.coupons)


ORDER_PAGE = "SELECT * FROM s_orders WHERE user_id = 42 ORDER BY created_at DESC, order_id DESC LIMIT 50"


@check("a25_order_history_lines", f"""
    SELECT o.order_id, order_no, o.status, channel, subtotal, o.discount_amount, shipping_fee, paid_amount, o.created_at,
           i.sku_id, quantity, round(unit_price, 4) AS unit_price, round(line_amount, 4) AS line_amount, sku_name
    FROM ({ORDER_PAGE}) o LEFT JOIN s_order_items i ON i.order_id = o.order_id LEFT JOIN s_sku k ON k.sku_id = i.sku_id""")
def _(s, spark):
    return sf.order_lines_of(s.orders, s.order_items, s.sku, 42).withColumns(
        {c: round_to(c, 4) for c in ("unit_price", "line_amount")})


@check("a25_order_history_nested", f"""
    SELECT o.order_id, paid_amount, count(i.sku_id) AS n_items,
           coalesce(string_agg(sku_name || ':' || i.sku_id || ':' || quantity, ',' ORDER BY sku_name, i.sku_id, quantity), '') AS items
    FROM ({ORDER_PAGE}) o LEFT JOIN s_order_items i ON i.order_id = o.order_id LEFT JOIN s_sku k ON k.sku_id = i.sku_id
    GROUP BY o.order_id, paid_amount""")
def _(s, spark):
    text = F.transform("items", lambda x: F.concat_ws(":", x["sku_name"], x["sku_id"].cast("string"), x["quantity"].cast("string")))
    return sf.order_history(s.orders, s.order_items, s.sku, 42).select(
        "order_id", "paid_amount", F.size("items").cast("long").alias("n_items"), F.array_join(text, ",").alias("items"))


@check("a26_cart_pricing", """
    WITH l AS (SELECT i.cart_id, i.sku_id, quantity, price, stock FROM s_cart_items i
               LEFT JOIN (SELECT * FROM s_sku WHERE status = 'on_sale') k ON k.sku_id = i.sku_id),
         t AS (SELECT cart_id, round(coalesce(sum(price * quantity), 0), 2) AS subtotal,
                      min(CASE WHEN coalesce(stock >= quantity, false) THEN 1 ELSE 0 END) AS accepted FROM l GROUP BY cart_id),
         p AS (SELECT t.*, CAST(CASE WHEN subtotal >= k.threshold THEN k.discount ELSE 0 END AS DOUBLE) AS discount,
                      CAST(CASE WHEN subtotal >= 99 THEN 0 ELSE 8 END AS DOUBLE) AS shipping
               FROM t JOIN s_carts c ON c.cart_id = t.cart_id
               LEFT JOIN (SELECT * FROM s_coupons WHERE status = 'active') k ON k.code = 'SAVE' || (c.user_id % 12))
    SELECT l.cart_id, sku_id, quantity, price, subtotal, discount, shipping, round(subtotal - discount + shipping, 2) AS paid, accepted,
           CASE WHEN coalesce(stock >= quantity, false) THEN 1 ELSE 0 END AS line_ok,
           round(coalesce(price * quantity / nullif(subtotal, 0), 0) * discount, 2) AS line_discount,
           round(price * quantity - round(coalesce(price * quantity / nullif(subtotal, 0), 0) * discount, 2), 2) AS line_amount
    FROM l JOIN p ON l.cart_id = p.cart_id""")
def _(s, spark):
    carts = s.carts.withColumn("coupon_code", F.concat(F.lit("SAVE"), (F.col("user_id") % 12).cast("string")))
    return sf.price_carts(carts, s.cart_items, s.sku, s.coupons)


@check("a27_consistency", """
    WITH b AS (SELECT order_id, user_id, status, CASE WHEN channel = 'live' THEN 'x' ELSE channel END AS channel FROM s_orders WHERE paid_amount > 5000),
         a AS (SELECT order_id, user_id, status, channel FROM s_orders)
    SELECT 'orders' AS table_name, (SELECT count(*) FROM a) AS rows_a, (SELECT count(*) FROM b) AS rows_b, 4 AS shared_columns,
           (SELECT count(*) FROM (FROM a EXCEPT ALL FROM b)) AS only_a, (SELECT count(*) FROM (FROM b EXCEPT ALL FROM a)) AS only_b""")
def _(s, spark):
    cols = ["order_id", "user_id", "status", "channel"]
    return tables.consistency(s.orders.select(*cols), s.orders.where("paid_amount > 5000").select(*cols), "orders")


@check("a31_latest_actions", """SELECT * FROM s_admin_action_logs WHERE action_type = 'search' ORDER BY created_at DESC, log_id DESC LIMIT 50""")
def _(s, spark):
    return sinks.latest_actions(s.admin_action_logs, "search")


@check("a32_coupon_counters", """SELECT c.coupon_id, c.code, (SELECT count(*) FROM s_user_coupons u WHERE u.coupon_id = c.coupon_id) AS issued_count,
    (SELECT count(used_at) FROM s_user_coupons u WHERE u.coupon_id = c.coupon_id) AS used_count FROM s_coupons c""")
def _(s, spark):
    return sf.coupon_counters(s.coupons, s.user_coupons).select("coupon_id", "code", "issued_count", "used_count")


@check("a33_category_list", "SELECT category_id, name FROM s_categories ORDER BY name")
def _(s, spark):
    return sf.category_list(s.categories)


@check("a34_schema_with_tags", schema_sql("fact_order", "fact", "fact_order", FACT_TYPES))
def _(s, spark):
    return tables.table_profile(s.fact_order, "fact_order", ["order_id"])


# ---- round trips through files in the shared folder -----------------------------------
def fresh(spark):
    from tillwise.functions.scale import shared_folder
    return f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"


@check("a10_csv_scan", "SELECT order_id, order_date, status, paid_amount FROM fact_order")
def _(s, spark):
    path = sinks.export_table(s.fact_order.select("order_id", "order_date", "status", "paid_amount"), f"{fresh(spark)}/orders.csv")
    df = tables.read_csv(spark, path)
    return df.select(F.col("order_id").cast("long").alias("order_id"), F.to_date("order_date").alias("order_date"), "status",
                     F.col("paid_amount").cast("double").alias("paid_amount"))


@check("a11_csv_folder", "SELECT 'orders' AS table_name, count(*) AS n FROM fact_order UNION ALL SELECT 'refunds', count(*) FROM fact_refund")
def _(s, spark):
    folder = fresh(spark)
    sinks.export_table(s.fact_order, f"{folder}/orders.csv")
    sinks.export_table(s.fact_refund, f"{folder}/refunds.csv")
    frames = tables.read_csv_folder(spark, folder)
    out = None
    for name, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.union(one)
    return out


@check("a19_json_export", "SELECT sku_id, sku_name, price FROM s_sku")
def _(s, spark):
    path = sinks.export_table(s.sku.select("sku_id", "sku_name", "price"), f"{fresh(spark)}/sku", "json")
    return spark.read.schema("sku_id long, sku_name string, price double").json(path)


@check("a20_csv_export", "SELECT sku_id, product_name || ', \"' || sku_name || '\"' AS label FROM dim_product")
def _(s, spark):
    label = F.concat("product_name", F.lit(', "'), "sku_name", F.lit('"'))
    path = sinks.export_table(s.dim_product.select("sku_id", label.alias("label")), f"{fresh(spark)}/label.csv")
    return tables.read_csv(spark, path).select(F.col("sku_id").cast("long").alias("sku_id"), "label")


@check("a21_wide_table_sink", "SELECT user_id, rfm_segment, frequency FROM user_wide")
def _(s, spark):
    from checks.features import wide
    return spark.read.parquet(sinks.write_wide(wide(s).select("user_id", "rfm_segment", "frequency"), f"{fresh(spark)}/wide"))


@check("a28_action_log", "SELECT channel AS action_type, status AS detail, count(*) AS n FROM s_orders GROUP BY 1, 2")
def _(s, spark):
    path = f"{fresh(spark)}/log"
    sinks.append_actions(s.orders.select(F.col("channel").alias("action_type"), F.col("order_id").alias("entity_id"), F.col("status").alias("detail")), path)
    return spark.read.parquet(path).groupBy("action_type", "detail").agg(F.count(F.lit(1)).alias("n"))


@check("a29_tag_users", "SELECT 'tag_user' AS action_type, 'wake up' AS detail, CAST(user_id AS VARCHAR) AS entity_id FROM user_wide WHERE rfm_segment = '沉睡客户'")
def _(s, spark):
    from checks.features import wide
    path = f"{fresh(spark)}/log"
    sinks.tag_users(wide(s).where(F.col("rfm_segment") == "沉睡客户"), "wake up", path)
    return spark.read.parquet(path).select("action_type", "detail", "entity_id")


@check("a30_create_action", "SELECT 'restock' AS action_type, '[P0] ' || count(*) || ' SKUs low' AS detail FROM s_sku WHERE stock < 5")
def _(s, spark):
    path = f"{fresh(spark)}/log"
    low = s.sku.where(F.col("stock") < 5).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    sinks.create_action(spark, path, "restock", "all", f"{low} SKUs low", "P0")
    return spark.read.parquet(path).select("action_type", "detail")
