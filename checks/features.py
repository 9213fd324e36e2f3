
from checks import check, ctes
from tillwise.functions.exprs import round_to
from tillwise.operators import features as f

PAID = "status IN ('paid', 'completed')"
TYPES = f.EVENT_TYPES
LAST = "(SELECT max(order_date) FROM fact_order)"
TLAST = "(SELECT max(event_date) FROM fact_traffic)"


def bins(c):
    return "1" + "".join(f" + CASE WHEN {c} > (SELECT quantile_cont({c}, {p}) FROM rfm_base) THEN 1 ELSE 0 END" for p in f.QUINTILES)


ctes.register(
    rfm_base=f"""SELECT user_id, CAST({LAST} - max(order_date) AS INTEGER) AS recency, count(DISTINCT order_id) AS frequency,
        sum(paid_amount) AS monetary FROM fact_order WHERE {PAID} GROUP BY user_id""",
    rfm_scored=f"SELECT *, 5 - ({bins('recency')}) AS R_score, {bins('frequency')} AS F_score, {bins('monetary')} AS M_score FROM rfm_base",
    rfm_seg="""SELECT *, CASE WHEN R_score >= 4 AND F_score >= 4 AND M_score >= 4 THEN '核心价值' WHEN R_score >= 4 AND F_score >= 4 THEN '重要发展'
        WHEN R_score >= 4 AND F_score < 3 THEN '潜力客户' WHEN R_score >= 3 AND F_score >= 3 THEN '一般维持' WHEN R_score >= 3 THEN '一般挽留'
        WHEN R_score < 2 THEN '流失客户' WHEN R_score < 3 THEN '沉睡客户' ELSE '其他' END AS rfm_segment FROM rfm_scored""",
    f_behaviour="SELECT user_id, " + ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS {t}" for t in TYPES) + """,
        count(*) AS total_events, count(DISTINCT event_date) AS active_days,
        coalesce(count(*) FILTER (WHERE device = 'mobile') / nullif(count(*) FILTER (WHERE device IN ('mobile', 'desktop')), 0), 0) AS mobile_ratio,
        count(*) FILTER (WHERE event_type = 'search') AS search_count, count(*) / count(DISTINCT event_date) AS avg_daily_events
        FROM fact_traffic WHERE user_id IS NOT NULL GROUP BY user_id""",
    f_window="SELECT user_id, " + ", ".join(f"""count(*) FILTER (WHERE event_date >= {TLAST} - {w}) AS events_{w}d,
        count(*) FILTER (WHERE event_date >= {TLAST} - {w} AND event_type LIKE '%view%') AS views_{w}d,
        count(*) FILTER (WHERE event_date >= {TLAST} - {w} AND event_type = 'add_to_cart') AS cart_{w}d,
        count(DISTINCT CASE WHEN event_date >= {TLAST} - {w} THEN event_date END) AS active_days_{w}d""" for w in (7, 30, 90))
        + f" FROM fact_traffic WHERE user_id IS NOT NULL AND event_date >= {TLAST} - 90 GROUP BY user_id",
    f_coupon=f"""SELECT user_id, count(*) AS coupons_issued_count, CAST(sum(is_used) AS BIGINT) AS coupons_used_count,
        avg(discount) AS avg_coupon_discount, sum(discount) AS total_coupon_savings, sum(is_used) / count(*) AS coupon_use_rate,
        CAST(coalesce({LAST} - max(used_date), 999) AS INTEGER) AS days_since_last_coupon FROM fact_coupon_use GROUP BY user_id""",
    f_category="""SELECT user_id, (SELECT category_name FROM (SELECT category_name, count(*) AS n FROM fact_order_item j JOIN dim_product e ON e.sku_id = j.sku_id
             WHERE j.user_id = i.user_id GROUP BY 1) ORDER BY n DESC, category_name LIMIT 1) AS top_category,
        count(DISTINCT category_name) AS category_diversity, avg(unit_price) AS avg_unit_price,
        avg(CASE WHEN price > 970 THEN 1 ELSE 0 END) AS high_price_ratio, avg(CASE WHEN price < 930 THEN 1 ELSE 0 END) AS low_price_ratio
        FROM fact_order_item i LEFT JOIN dim_product d ON d.sku_id = i.sku_id GROUP BY user_id""",
    f_shopping=f"""SELECT o.*, coalesce(refund_count, 0) AS refund_count, CASE WHEN refund_count > 0 THEN 1 ELSE 0 END AS has_refund FROM (
        SELECT user_id, count(DISTINCT order_id) AS order_count, avg(CASE WHEN dayofweek(order_date) IN (0, 6) THEN 1 ELSE 0 END) AS weekend_order_ratio,
            CAST(max(order_date) - min(order_date) AS INTEGER) AS lifecycle_days, greatest((max(order_date) - min(order_date)) / 30, 1.0::DOUBLE) AS lifecycle_months,
            (max(order_date) - min(order_date)) / count(DISTINCT order_id) AS avg_order_interval, CAST({LAST} - min(order_date) AS INTEGER) AS first_order_days_ago,
            count(DISTINCT order_id) / greatest((max(order_date) - min(order_date)) / 30, 1) AS monthly_orders FROM fact_order GROUP BY user_id) o
        LEFT JOIN (SELECT user_id, count(*) AS refund_count FROM fact_refund GROUP BY 1) r ON r.user_id = o.user_id""",
    sku_sold=f"""SELECT sku_id, CAST(sum(quantity) AS BIGINT) AS total_quantity, sum(line_amount) AS total_sales, avg(unit_price) AS avg_order_price,
        sum(gross_profit) AS total_gross_profit, sum(quantity) FILTER (WHERE i.order_date >= m - 90) AS rq,
        sum(quantity) FILTER (WHERE i.order_date >= m - 180 AND i.order_date < m - 90) AS oq
        FROM fact_order_item i JOIN fact_order o ON o.order_id = i.order_id, (SELECT max(order_date) AS m FROM fact_order WHERE {PAID}) WHERE {PAID} GROUP BY sku_id""")

NUMS = {"f_behaviour": ("mobile_ratio", "avg_daily_events"), "f_coupon": ("avg_coupon_discount", "total_coupon_savings", "coupon_use_rate"),
        "f_category": ("avg_unit_price", "high_price_ratio", "low_price_ratio"),
        "f_shopping": ("weekend_order_ratio", "lifecycle_months", "avg_order_interval", "monthly_orders")}


def r4(df, cols):
    return df.withColumns({c: round_to(c, 4) for c in cols})


def rep(cols, d=4):
    return "REPLACE (" + ", ".join(f"round({c}, {d}) AS {c}" for c in cols) + ")"


def wide(s):
    return f.user_wide(s.dim_user, s.fact_order, s.fact_order_item, s.fact_traffic, s.fact_coupon_use, s.fact_refund,
                       s.dim_product, traffic_as_of=f.last_date(s.fact_traffic, "event_date"), price_edges=(930.0, 970.0))


@check("e01_rfm", f"SELECT * {rep(['monetary'], 2)} FROM rfm_base")
def _(s, spark):
    return f.rfm(s.fact_order, f.last_date(s.fact_order)).withColumn("monetary", round_to("monetary", 2))


@check("e02_rfm_scores", "SELECT user_id, R_score, F_score, M_score FROM rfm_scored")
def _(s, spark):
    return f.rfm_scores(f.rfm(s.fact_order, f.last_date(s.fact_order))).select("user_id", "R_score", "F_score", "M_score")


@check("e03_rfm_segments", "SELECT user_id, rfm_segment FROM rfm_seg")
def _(s, spark):
    return f.rfm_table(s.fact_order, f.last_date(s.fact_order)).select("user_id", "rfm_segment")


@check("e04_behaviour_features", f"SELECT * {rep(NUMS['f_behaviour'])} FROM f_behaviour")
def _(s, spark):
    return r4(f.behaviour(s.fact_traffic), NUMS["f_behaviour"])


@check("e05_window_features", "SELECT * FROM f_window")
def _(s, spark):
    return f.window_features(s.fact_traffic)


@check("e06_coupon_features", f"SELECT * {rep(NUMS['f_coupon'])} FROM f_coupon")
def _(s, spark):
    return r4(f.coupon_features(s.fact_coupon_use, f.last_date(s.fact_order)), NUMS["f_coupon"])


@check("e07_category_features", f"SELECT * {rep(NUMS['f_category'])} FROM f_category")
def _(s, spark):
    return r4(f.category_features(s.fact_order_item, s.dim_product, 930.0, 970.0), NUMS["f_category"])


@check("e08_shopping_features", f"SELECT * {rep(NUMS['f_shopping'])} FROM f_shopping")
def _(s, spark):
    return r4(f.shopping_features(s.fact_order, s.fact_refund), NUMS["f_shopping"])


TEXTS = ("province", "register_channel", "segment", "gender", "member_level", "status", "top_category")
WIDE_INT = ("recency", "frequency", "R_score", "F_score", "M_score", *TYPES, "total_events", "active_days", "search_count",
            *[f"{n}_{w}d" for w in (7, 30, 90) for n in ("events", "views", "cart", "active_days")],
            "coupons_issued_count", "coupons_used_count", "days_since_last_coupon", "category_diversity", "order_count",
            "lifecycle_days", "first_order_days_ago", "refund_count", "has_refund")
WIDE_NUM = ("monetary", *[c for cols in NUMS.values() for c in cols])
ctes.register(user_wide="SELECT user_id, name, city, birth_year, register_date, "
              + ", ".join(f"coalesce({c}, 'unknown') AS {c}" for c in TEXTS) + ", coalesce(rfm_segment, '无订单') AS rfm_segment, "
              + ", ".join(f"coalesce({c}, 0) AS {c}" for c in WIDE_INT) + ", " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in WIDE_NUM)
              + " FROM dim_user" + "".join(f" LEFT JOIN {t} USING (user_id)" for t in
                                           ("rfm_seg", "f_behaviour", "f_window", "f_coupon", "f_category", "f_shopping")))


@check("e09_user_wide_table", f"SELECT * {rep(WIDE_NUM)} FROM user_wide")
def _(s, spark):
    return r4(wide(s), WIDE_NUM)


@check("e09_user_wide_check", "SELECT count(*) AS rows, count(DISTINCT user_id) AS users, (SELECT count(*) FROM dim_user) AS expected FROM user_wide")
def _(s, spark):
    return f.wide_check(wide(s), s.dim_user)


CORR_COLS = ("recency", "frequency", "monetary", "total_events", "active_days", "events_7d", "events_30d", "coupons_issued_count",
             "coupons_used_count", "total_coupon_savings", "category_diversity", "order_count", "lifecycle_days", "lifecycle_months")


@check("e10_high_correlations", " UNION ALL ".join(
    f"SELECT '{a}' AS feature1, '{b}' AS feature2, round(r, 4) AS correlation FROM (SELECT corr({a}, {b}) AS r FROM user_wide) WHERE abs(r) > 0.8"
    for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]))
def _(s, spark):
    return f.high_correlations(wide(s), columns=CORR_COLS)


P_NUM = ("total_sales", "avg_order_price", "total_gross_profit", "avg_rating", "refund_rate", "turnover_rate", "sales_trend", "cost")


@check("e12_product_wide_table", f"""SELECT p.* {rep(['cost'])}, total_quantity, round(total_sales, 4) AS total_sales, round(avg_order_price, 4) AS avg_order_price,
    round(total_gross_profit, 4) AS total_gross_profit, CASE WHEN s.sku_id IS NOT NULL THEN round(coalesce(avg_rating, 0), 4) END AS avg_rating,
    CASE WHEN s.sku_id IS NOT NULL THEN coalesce(refund_count, 0) END AS refund_count,
    CASE WHEN s.sku_id IS NOT NULL THEN round(coalesce(refund_count, 0) / greatest(total_quantity, 1), 4) END AS refund_rate,
    CASE WHEN s.sku_id IS NOT NULL THEN round(coalesce(turnover, 0), 4) END AS turnover_rate,
    CASE WHEN s.sku_id IS NOT NULL THEN round(greatest(least(coalesce((rq - oq) / greatest(oq, 1), 0), 5), -1), 4) END AS sales_trend
    FROM dim_product p LEFT JOIN sku_sold s ON s.sku_id = p.sku_id
    LEFT JOIN (SELECT sku_id, avg(rating) AS avg_rating FROM fact_product_review GROUP BY 1) v ON v.sku_id = s.sku_id
    LEFT JOIN (SELECT i.sku_id, count(*) AS refund_count FROM fact_refund r JOIN fact_order_item i ON i.order_id = r.order_id WHERE r.status = 'approved' GROUP BY 1) g ON g.sku_id = s.sku_id
    LEFT JOIN (SELECT sku_id, sum(CASE WHEN movement_type = 'out' THEN abs(quantity) ELSE 0 END)
                 / greatest(sum(CASE WHEN movement_type = 'in' THEN quantity ELSE -abs(quantity) END), 1) AS turnover FROM fact_inventory_movement GROUP BY 1) t ON t.sku_id = s.sku_id""")
def _(s, spark):
    return r4(f.product_wide(s.dim_product, s.sales_lines, s.fact_product_review, s.fact_refund, s.fact_inventory_movement), P_NUM)
