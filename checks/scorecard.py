from checks import check, ctes
from checks.features import wide
from tillwise.operators import marketing, sales, scorecard as c

PAID = "status IN ('paid', 'completed')"
ctes.register(
    health_in=f"""SELECT (l - f) / f AS trend, round(profit / gmv * 100, 2) AS gross_margin, rn / n * 100 AS refund_rate, paying / sessions * 100 AS conversion,
        late AS late_rate, turnover, active FROM
        (SELECT arg_max(g, ym) AS l, arg_min(g, ym) AS f FROM (SELECT strftime(order_date, '%Y-%m') AS ym, sum(paid_amount) AS g FROM fact_order WHERE {PAID} GROUP BY 1 ORDER BY 1 DESC LIMIT 6)),
        (SELECT sum(paid_amount) FILTER (WHERE {PAID}) AS gmv, count(*) AS n FROM fact_order),
        (SELECT sum(gross_profit) AS profit FROM fact_order_item i JOIN fact_order o ON o.order_id = i.order_id WHERE {PAID}),
        (SELECT count(*) AS rn FROM fact_refund WHERE status = 'approved'),
        (SELECT count(DISTINCT session_id) AS sessions, count(DISTINCT session_id) FILTER (WHERE event_type = 'pay_success') AS paying FROM fact_traffic),
        (SELECT avg(is_late) AS late FROM fact_fulfillment),
        (SELECT avg(o / (abs(s) + 1)) AS turnover FROM (SELECT sku_id, sum(CASE WHEN movement_type = 'out' THEN abs(quantity) ELSE 0 END) AS o,
            sum(CASE WHEN movement_type = 'in' THEN quantity ELSE -abs(quantity) END) AS s FROM fact_inventory_movement GROUP BY 1)),
        (SELECT count(DISTINCT user_id) AS active FROM fact_order WHERE {PAID} AND order_date >= (SELECT max(order_date) - 90 FROM fact_order))""",
    health_parts="""SELECT round(least(20, greatest(0, 12 + trend * 30)), 1) AS a, round(CASE WHEN gross_margin <> 0 THEN least(20, gross_margin * 0.4) ELSE 15 END, 1) AS b,
        round(greatest(0, 15 - refund_rate * 1.5), 1) AS c, round(least(15, conversion * 0.3), 1) AS d, round(greatest(0, 10 - late_rate * 20), 1) AS e,
        round(least(10, greatest(0, turnover * 2)), 1) AS f, round(CASE WHEN active > 0 THEN least(10, active / 1800 * 10) ELSE 5 END, 1) AS g, * FROM health_in""",
    health=" UNION ALL ".join(f"SELECT '{n}' AS dimension, {w} AS weight, {k} AS score, {v} AS value, CAST(NULL AS VARCHAR) AS grade FROM health_parts" for n, w, k, v in (
        ("GMV 趋势", 20, "a", "CAST(NULL AS DOUBLE)"), ("毛利率", 20, "b", "round(gross_margin, 1)"), ("退款率", 15, "c", "round(refund_rate, 1)"),
        ("转化率", 15, "d", "round(conversion, 1)"), ("配送时效", 10, "e", "round(late_rate * 100, 1)"), ("库存周转", 10, "f", "CAST(NULL AS DOUBLE)"),
        ("客户活跃度", 10, "g", "CAST(NULL AS DOUBLE)"))) + """ UNION ALL SELECT 'total', 100, round(a + b + c + d + e + f + g, 1), NULL,
        CASE WHEN round(a + b + c + d + e + f + g, 4) >= 85 THEN 'A' WHEN round(a + b + c + d + e + f + g, 4) >= 70 THEN 'B' WHEN round(a + b + c + d + e + f + g, 4) >= 55 THEN 'C' ELSE 'D' END FROM health_parts""",
    chances=f"""SELECT * FROM (SELECT 1 AS rank, 'channel_conversion' AS kind, channel AS subject, conversion AS value, coalesce(share, 0) AS benchmark FROM
        (SELECT channel, round(count(DISTINCT session_id) FILTER (WHERE event_type = 'pay_success') / count(DISTINCT session_id) FILTER (WHERE event_type = 'view_home') * 100, 2) AS conversion
         FROM fact_traffic GROUP BY 1) LEFT JOIN (SELECT channel, round(sum(paid_amount) / sum(sum(paid_amount)) OVER () * 100, 2) AS share FROM fact_order WHERE {PAID} GROUP BY 1) USING (channel)
        ORDER BY conversion DESC, channel LIMIT 1)
        UNION ALL SELECT 2, 'lapsed_customers', '流失客户+沉睡客户', round(count(*) FILTER (WHERE rfm_segment IN ('流失客户', '沉睡客户')) / count(*) * 100, 2),
            round(sum(monetary) FILTER (WHERE rfm_segment IN ('流失客户', '沉睡客户')) / sum(monetary) * 100, 2) FROM user_wide
        UNION ALL SELECT 3, 'late_delivery', 'refund rate late, on time', max(r) FILTER (WHERE is_late = 1), max(r) FILTER (WHERE is_late = 0) FROM
            (SELECT is_late, round(count(DISTINCT CASE WHEN order_id IN (SELECT order_id FROM fact_refund WHERE status = 'approved') THEN order_id END) / count(*) * 100, 2) AS r FROM fact_fulfillment GROUP BY 1)""",
    dangers=f"""SELECT 1 AS rank, 'gmv_fall' AS kind, arg_max(ym, g) AS subject, round((arg_max(g, ym) - max(g)) / max(g) * 100, 2) AS value, round(max(g), 2) AS benchmark
            FROM (SELECT strftime(order_date, '%Y-%m') AS ym, sum(paid_amount) AS g FROM fact_order WHERE {PAID} GROUP BY 1)
        UNION ALL SELECT 2, 'low_roas_channel', arg_max(channel, rank), arg_max(roas, rank), max(roas) FROM ranking
        UNION ALL SELECT 3, 'bad_reviews', 'rating <= 2', round(count(*) FILTER (WHERE rating <= 2) / count(*) * 100, 2), CAST(count(*) AS DOUBLE) FROM fact_product_review""")


def health(s):
    return c.health_score(c.health_inputs(s.fact_order, s.sales_lines, s.fact_refund, s.fact_traffic, s.fact_fulfillment,
                                          s.fact_inventory_movement), buyer_target=1800)


def chances(s):
    return c.opportunities(s.fact_traffic, s.fact_order, wide(s), s.fact_fulfillment, s.fact_refund)


def dangers(s):
    return c.risks(s.fact_order, marketing.channel_ranking(s.fact_ads_spend, s.fact_order), s.fact_product_review)


@check("p01_health_score", "SELECT * FROM health")
def _(s, spark):
    return health(s)


@check("p02_opportunities", "SELECT * FROM chances")
def _(s, spark):
    return chances(s)


@check("p03_risks", "SELECT * FROM dangers")
def _(s, spark):
    return dangers(s)


def _metrics_sql():
    from checks.sales import ONE_ROW
    names = ("gmv", "net_sales", "gross_profit", "gross_margin", "order_count", "buyer_count", "aov", "refund_rate")
    return f"WITH v AS ({ONE_ROW} FROM o, r, p, t) " + " UNION ALL ".join(
        f"SELECT 'metrics' AS section, {i + 1} AS rank, '{n}' AS item, CAST({n} AS DOUBLE) AS value, '' AS note FROM v" for i, n in enumerate(names))


@check("p04_weekly_report", f"""SELECT 'health' AS section, CAST(row_number() OVER (ORDER BY weight DESC, dimension) AS INTEGER) AS rank, dimension AS item, score AS value, coalesce(grade, '') AS note FROM health
    UNION ALL SELECT * FROM ({_metrics_sql()})
    UNION ALL SELECT 'opportunities', rank, kind, value, subject || ' / ' || printf('%.2f', benchmark) FROM chances
    UNION ALL SELECT 'risks', rank, kind, value, subject || ' / ' || printf('%.2f', benchmark) FROM dangers""")
def _(s, spark):
    metrics = sales.core_metrics(s.fact_order, s.sales_lines, s.fact_refund, s.fact_traffic)
    return c.weekly_report(health(s), metrics, chances(s), dangers(s))
