from checks import check
from tillwise.functions.exprs import round_to, safe_divide
from tillwise.operators import sales

PAID = "status IN ('paid', 'completed')"
ONE_ROW = f"""
    WITH o AS (SELECT coalesce(sum(paid_amount) FILTER (WHERE {PAID}), 0) AS gmv,
                      count(DISTINCT order_id) FILTER (WHERE {PAID}) AS n,
                      count(DISTINCT user_id) FILTER (WHERE {PAID}) AS buyers, count(*) AS total FROM fact_order),
         r AS (SELECT coalesce(sum(amount), 0) AS amount, count(DISTINCT order_id) AS n FROM fact_refund WHERE status = 'approved'),
         p AS (SELECT sum((i.unit_price - i.unit_cost) * i.quantity - i.discount_amount) AS profit
               FROM fact_order_item i JOIN fact_order f ON i.order_id = f.order_id WHERE {PAID}),
         t AS (SELECT count(DISTINCT session_id) AS sessions,
                      count(DISTINCT session_id) FILTER (WHERE event_type = 'pay_success') AS paying FROM fact_traffic)
    SELECT round(gmv, 2) AS gmv, round(gmv - r.amount, 2) AS net_sales, round(profit, 2) AS gross_profit,
           round(profit / gmv * 100, 2) AS gross_margin, o.n AS order_count, buyers AS buyer_count,
           round(gmv / o.n, 2) AS aov, round(r.n / total * 100, 2) AS refund_rate"""


@check("f01_headline_kpis", ONE_ROW + ", round(paying / sessions * 100, 2) AS conversion_rate FROM o, r, p, t")
def _(s, spark):
    return sales.headline(s.fact_order, s.sales_lines, s.fact_refund, s.fact_traffic)


@check("f02_core_metrics", ONE_ROW + " FROM o, r, p, t")
def _(s, spark):
    return sales.core_metrics(s.fact_order, s.sales_lines, s.fact_refund, s.fact_traffic)


def _definition_sql():
    v = {"gmv": "round(gmv, 2)", "netSales": "round(round(gmv, 2) - round(refund, 2), 2)", "grossProfit": "round(profit, 2)",
         "orderCount": "n", "buyerCount": "buyers", "avgOrderValue": "round(round(gmv, 2) / n, 2)",
         "refundRate": "round(rn / n, 4)"}
    v.update({f"funnel.{s}": s for s in ("view_home", "view_product", "add_to_cart", "checkout", "pay_success")})
    rows = " UNION ALL ".join(
        "SELECT '{}' AS metric, CAST({} AS DOUBLE) AS value, '{}' AS definition FROM x".format(
            m, e, sales.DEFINITIONS[m.split(".")[0]].replace("'", "''")) for m, e in v.items())
    funnel = ", ".join(f"count(*) FILTER (WHERE event_type = '{s}') AS {s}"
                       for s in ("view_home", "view_product", "add_to_cart", "checkout", "pay_success"))
    return f"""
    WITH x AS (SELECT * FROM
      (SELECT sum(paid_amount) AS gmv, count(DISTINCT order_id) AS n, count(DISTINCT user_id) AS buyers FROM fact_order WHERE {PAID}),
      (SELECT sum(amount) AS refund, count(DISTINCT order_id) AS rn FROM fact_refund WHERE status = 'approved'),
      (SELECT sum(gross_profit) AS profit FROM fact_order_item i JOIN fact_order f ON i.order_id = f.order_id WHERE {PAID}),
      (SELECT {funnel} FROM fact_traffic)) {rows}"""


@check("f03_defined_metrics", _definition_sql())
def _(s, spark):
    return sales.defined_metrics(s.fact_order, s.sales_lines, s.fact_refund, s.fact_traffic)


MONTHLY = f"""m AS (SELECT strftime(order_date, '%Y-%m') AS ym, sum(paid_amount) AS gmv, count(DISTINCT order_id) AS orders,
                           count(DISTINCT user_id) AS buyers, round(sum(paid_amount) / count(DISTINCT order_id), 2) AS aov
                    FROM fact_order WHERE {PAID} GROUP BY 1)"""


def mom(c, digits=6, scale=1):
    return f"round((1.0 * {c} / lag({c}) OVER (ORDER BY ym) - 1) * {scale}, {digits}) AS {c}_mom"


def mom_abs(c, digits, scale):
    return f"round((CAST({c} AS DOUBLE) - lag({c}) OVER (ORDER BY ym)) / lag({c}) OVER (ORDER BY ym) * {scale}, {digits}) AS {c}_mom"


@check("f04_monthly_trend", f"""
    WITH {MONTHLY}, p AS (SELECT strftime(i.order_date, '%Y-%m') AS ym, round(sum(gross_profit), 2) AS gross_profit
         FROM fact_order_item i JOIN fact_order f ON i.order_id = f.order_id WHERE {PAID} GROUP BY 1)
    SELECT m.ym, round(gmv, 2) AS gmv, orders, aov, {mom_abs('gmv', 6, 1)}, {mom_abs('orders', 6, 1)}, {mom_abs('aov', 6, 1)}, gross_profit
    FROM (SELECT * FROM m) m LEFT JOIN p USING (ym)""")
def _(s, spark):
    return sales.monthly_trend(s.fact_order, s.sales_lines)


@check("f05_channel_breakdown", f"""
    SELECT channel, round(sum(paid_amount), 2) AS gmv, count(DISTINCT order_id) AS orders, count(DISTINCT user_id) AS buyers,
           round(sum(paid_amount) / sum(sum(paid_amount)) OVER () * 100, 2) AS share
    FROM fact_order WHERE {PAID} GROUP BY channel""")
def _(s, spark):
    return sales.channel_breakdown(s.fact_order)


@check("f06_category_breakdown", """
    SELECT category_name, round(sum(unit_price * quantity - discount_amount), 2) AS gmv, count(DISTINCT order_id) AS orders,
           count(DISTINCT i.sku_id) AS sku_count,
           round(sum(unit_price * quantity - discount_amount) / sum(sum(unit_price * quantity - discount_amount)) OVER () * 100, 2) AS share
    FROM fact_order_item i JOIN dim_product d ON i.sku_id = d.sku_id GROUP BY category_name""")
def _(s, spark):
    return sales.category_breakdown(s.sales_lines, s.dim_product)


@check("f07_member_contribution", f"""
    SELECT member_level, count(DISTINCT o.user_id) AS buyers, count(DISTINCT order_id) AS orders, round(sum(paid_amount), 2) AS gmv
    FROM fact_order o JOIN dim_user u ON o.user_id = u.user_id WHERE o.{PAID} GROUP BY member_level""")
def _(s, spark):
    return sales.member_contribution(s.fact_order, s.dim_user)


@check("f08_top_bottom_products", """
    WITH x AS (SELECT d.sku_id, product_name, category_name, CAST(sum(quantity) AS BIGINT) AS total_qty,
                      sum(unit_price * quantity - discount_amount) AS gmv
               FROM fact_order_item i JOIN dim_product d ON i.sku_id = d.sku_id GROUP BY d.sku_id, product_name, category_name),
         y AS (SELECT *, row_number() OVER (ORDER BY gmv DESC, sku_id) AS a, row_number() OVER (ORDER BY gmv, sku_id DESC) AS b FROM x)
    SELECT sku_id, product_name, category_name, total_qty, round(gmv, 2) AS gmv, 'top' AS side FROM y WHERE a <= 10
    UNION ALL SELECT sku_id, product_name, category_name, total_qty, round(gmv, 2), 'bottom' FROM y WHERE b <= 10""")
def _(s, spark):
    return sales.top_bottom_products(s.sales_lines, s.dim_product)


@check("f09_daily_by_channel", f"""
    SELECT order_date, channel, round(sum(paid_amount), 2) AS gmv, count(DISTINCT order_id) AS orders
    FROM fact_order WHERE {PAID} AND order_date BETWEEN '1996-01-01' AND '1999-12-31' GROUP BY 1, 2""")
def _(s, spark):
    return sales.daily_by_channel(s.fact_order, "1996-01-01", "1999-12-31")


@check("f10_latest_month_change", f"""
    WITH {MONTHLY} SELECT ym AS current_month, lag(ym) OVER (ORDER BY ym) AS previous_month, {mom_abs('gmv', 2, 100)},
           {mom_abs('orders', 2, 100)}, {mom_abs('buyers', 2, 100)}, {mom_abs('aov', 2, 100)} FROM m ORDER BY ym DESC LIMIT 1""")
def _(s, spark):
    return sales.latest_month_change(s.fact_order)


@check("f11_anomaly_months", f"""
    WITH {MONTHLY}, c AS (SELECT ym, gmv, orders, (gmv - lag(gmv) OVER (ORDER BY ym)) / lag(gmv) OVER (ORDER BY ym) AS g,
         (CAST(orders AS DOUBLE) - lag(orders) OVER (ORDER BY ym)) / lag(orders) OVER (ORDER BY ym) AS n FROM m)
    SELECT ym AS month, 'GMV' AS indicator, round(g * 100, 2) AS change_pct, CASE WHEN g > 0 THEN 'up' ELSE 'down' END AS direction,
           round(gmv, 2) AS value FROM c WHERE abs(g) > 0.1
    UNION ALL SELECT ym, '订单数', round(n * 100, 2), CASE WHEN n > 0 THEN 'up' ELSE 'down' END, CAST(orders AS DOUBLE) FROM c WHERE abs(n) > 0.1""")
def _(s, spark):
    return sales.anomaly_months(s.fact_order)


@check("f13_calendar_growth", f"""
    WITH {MONTHLY}, sp AS (SELECT strftime(d, '%Y-%m') AS ym FROM (SELECT unnest(generate_series(
             (SELECT CAST(min(ym) || '-01' AS DATE) FROM m), (SELECT CAST(max(ym) || '-01' AS DATE) FROM m), INTERVAL 1 MONTH)) AS d)),
         f AS (SELECT ym, coalesce(gmv, 0) AS gmv FROM sp LEFT JOIN m USING (ym))
    SELECT ym, round(gmv, 2) AS gmv, round((gmv - lag(gmv) OVER w) / nullif(lag(gmv) OVER w, 0), 6) AS mom,
           round((gmv - lag(gmv, 12) OVER w) / nullif(lag(gmv, 12) OVER w, 0), 6) AS yoy FROM f WINDOW w AS (ORDER BY ym)""")
def _(s, spark):
    return sales.calendar_growth(s.fact_order)


@check("f14_safe_divide", """
    SELECT sku_id, round(coalesce(price / nullif(stock, 0), 0), 4) AS price_per_piece FROM s_sku""")
def _(s, spark):
    return s.sku.select("sku_id", round_to(safe_divide("price", "stock"), 4).alias("price_per_piece"))
