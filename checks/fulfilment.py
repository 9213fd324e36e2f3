from checks import check
from tillwise.operators import fulfilment as f


def late(group):
    return f"""SELECT {group}, count(DISTINCT shipment_id) AS shipments, CAST(sum(is_late) AS BIGINT) AS late_count,
        round(avg(delivery_days), 4) AS avg_delivery_days, round(sum(is_late) / count(DISTINCT shipment_id) * 100, 2) AS late_rate
        FROM fact_fulfillment GROUP BY {group}"""


@check("n01_carrier_delays", late("carrier"))
def _(s, spark):
    return f.late_by(s.fact_fulfillment, "carrier")


@check("n02_province_delays", late("province"))
def _(s, spark):
    return f.late_by(s.fact_fulfillment, "province")


@check("n03_late_refund_impact", """
    WITH x AS (SELECT is_late, count(DISTINCT CASE WHEN order_id IN (SELECT order_id FROM fact_refund WHERE status = 'approved') THEN order_id END)
                      / count(*) * 100 AS rate FROM fact_fulfillment GROUP BY is_late)
    SELECT round(a.rate, 2) AS delayed_refund_rate, round(b.rate, 2) AS ontime_refund_rate, round(a.rate - b.rate, 2) AS impact
    FROM x a, x b WHERE a.is_late = 1 AND b.is_late = 0""")
def _(s, spark):
    return f.late_refund_impact(s.fact_fulfillment, s.fact_refund)


@check("n03_late_totals", "SELECT count(*) AS total_shipments, round(avg(is_late) * 100, 2) AS overall_late_rate FROM fact_fulfillment")
def _(s, spark):
    return f.late_totals(s.fact_fulfillment)


@check("n04_monthly_refunds", """
    SELECT ym, orders, coalesce(refunds, 0) AS refunds, round(coalesce(refunds, 0) / orders * 100, 2) AS refund_rate
    FROM (SELECT strftime(order_date, '%Y-%m') AS ym, count(*) AS orders FROM fact_order GROUP BY 1)
    LEFT JOIN (SELECT strftime(refund_date, '%Y-%m') AS ym, count(*) AS refunds FROM fact_refund WHERE status = 'approved' GROUP BY 1) USING (ym)
    ORDER BY ym DESC LIMIT 12""")
def _(s, spark):
    return f.monthly_refunds(s.fact_refund, s.fact_order)


@check("n05_refund_reasons", """SELECT reason, count(*) AS count, round(count(*) / sum(count(*)) OVER () * 100, 1) AS share
    FROM fact_refund WHERE status = 'approved' GROUP BY reason""")
def _(s, spark):
    return f.refund_reasons(s.fact_refund)


@check("n05_refund_totals", """SELECT count(*) AS total_refunds, round(sum(amount), 2) AS total_amount
    FROM fact_refund WHERE status = 'approved'""")
def _(s, spark):
    return f.refund_totals(s.fact_refund)


JOINED = """FROM fact_refund r JOIN fact_order_item i ON r.order_id = i.order_id JOIN dim_product d ON d.sku_id = i.sku_id
    WHERE r.status = 'approved'"""


@check("n06_top_refunded_skus", f"""SELECT i.sku_id, product_name, category_name, count(*) AS refund_count {JOINED}
    GROUP BY ALL ORDER BY refund_count DESC, sku_id LIMIT 20""")
def _(s, spark):
    return f.top_refunded_skus(s.fact_refund, s.order_items, s.dim_product)


@check("n06_top_refunded_suppliers", f"""SELECT supplier, count(*) AS refund_count {JOINED}
    GROUP BY ALL ORDER BY refund_count DESC, supplier LIMIT 10""")
def _(s, spark):
    return f.top_refunded_suppliers(s.fact_refund, s.order_items, s.dim_product)


@check("n07_category_ratings", """SELECT category_name, round(avg(rating), 2) AS rating
    FROM fact_product_review r JOIN dim_product d ON r.sku_id = d.sku_id GROUP BY 1""")
def _(s, spark):
    return f.category_ratings(s.fact_product_review, s.dim_product)


@check("n07_most_reviewed_skus", """SELECT sku_id, round(avg(rating), 2) AS avg_rating, count(*) AS review_count
    FROM fact_product_review WHERE sku_id IN (SELECT sku_id FROM dim_product) GROUP BY 1 ORDER BY review_count DESC, sku_id LIMIT 10""")
def _(s, spark):
    return f.most_reviewed_skus(s.fact_product_review, s.dim_product)


@check("n08_review_totals", """SELECT round(count(*) FILTER (WHERE rating <= 2) / count(*) * 100, 2) AS bad_rate,
    round(count(*) FILTER (WHERE rating >= 4) / count(*) * 100, 2) AS good_rate, count(*) AS total_reviews,
    round(avg(rating), 2) AS avg_rating FROM fact_product_review""")
def _(s, spark):
    return f.review_totals(s.fact_product_review)


@check("n09_sentiment_share", """SELECT sentiment, count(*) AS count, round(count(*) / sum(count(*)) OVER () * 100, 1) AS share
    FROM fact_product_review GROUP BY sentiment""")
def _(s, spark):
    return f.sentiment_share(s.fact_product_review)


@check("n09_top_tags", """SELECT content_tag, count(*) AS count FROM fact_product_review GROUP BY 1
    ORDER BY count DESC, content_tag LIMIT 15""")
def _(s, spark):
    return f.top_tags(s.fact_product_review)


@check("n10_risk_list", f"""
    SELECT * FROM (SELECT '{f.SKU_RISK}' AS type, product_name || '(' || i.sku_id || ')' AS target,
        count(*) || ' 次退款，品类 ' || category_name AS evidence, '{f.SKU_ADVICE}' AS action,
        CASE WHEN count(*) > 15 THEN 'high' ELSE 'medium' END AS severity {JOINED}
        GROUP BY i.sku_id, product_name, category_name HAVING count(*) >= 5 ORDER BY count(*) DESC, i.sku_id LIMIT 10)
    UNION ALL
    SELECT '{f.AREA_RISK}', province, printf('延迟率 %.1f%%（%d/%d）', late / total * 100, late, total), '{f.AREA_ADVICE}',
        CASE WHEN late / total > 0.15 THEN 'high' ELSE 'medium' END
    FROM (SELECT province, count(*) AS total, CAST(sum(is_late) AS BIGINT) AS late FROM fact_fulfillment GROUP BY province
          HAVING sum(is_late) / count(*) > 0.1 ORDER BY late / total DESC, province LIMIT 5)""")
def _(s, spark):
    return f.risk_list(s.fact_refund, s.order_items, s.dim_product, s.fact_fulfillment)
