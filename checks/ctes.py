"""The star schema in SQL over the driver's tables, written apart from the adapter."""

from __future__ import annotations

import re

# name -> SQL; names used inside another CTE are pulled in automatically
CTES: dict[str, str] = {
    "src_orders": """
        SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 'organic' WHEN '2-HIGH' THEN 'search'
                    WHEN '3-MEDIUM' THEN 'social' WHEN '4-NOT SPECIFIED' THEN 'email' WHEN '5-LOW' THEN 'affiliate' END AS channel,
               CASE WHEN o_orderkey % 3 = 0
                    THEN substr(o_orderpriority, 1, 1) || '-' || strftime(o_orderdate, '%Y-%m') END AS campaign_id
        FROM orders""",
    "s_users": """
        SELECT c_custkey AS user_id, c_name AS name, 'user' || c_custkey || '@shop.example' AS email,
               CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 1000 THEN '' ELSE '555-' || c_custkey END AS phone,
               n_name AS province, r_name AS city, lower(c_mktsegment) AS register_channel,
               CASE WHEN c_acctbal < 0 THEN 'at_risk' WHEN c_acctbal < 5000 THEN 'regular' ELSE 'loyal' END AS segment,
               CASE WHEN c_acctbal > 9000 THEN NULL WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               CASE WHEN c_acctbal BETWEEN 0 AND 500 THEN NULL ELSE CAST(1950 + c_custkey % 50 AS INTEGER) END AS birth_year,
               c_mktsegment AS member_level, 'active' AS status, f.created_at
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS created_at FROM orders GROUP BY 1) f ON f.o_custkey = c_custkey""",
    "s_categories": "SELECT DISTINCT lower(p_type) AS category_id, p_type AS name FROM part",
    "s_spu": """
        SELECT DISTINCT p_brand || '/' || p_type AS spu_id, lower(p_type) AS category_id, p_brand AS brand,
               p_brand || ' ' || p_type AS name, 'on_sale' AS status FROM part""",
    "s_sku": """
        SELECT p_partkey AS sku_id, p_brand || '/' || p_type AS spu_id, p_name AS sku_name, CAST(p_size AS VARCHAR) AS spec,
               p_retailprice AS price, CASE WHEN p_size >= 48 THEN p_retailprice * 1.1 ELSE p_retailprice * 0.6 END AS cost,
               'supplier-' || (p_size % 10) AS supplier, CAST(NULL AS DATE) AS listing_date, p_size - 3 AS stock,
               CASE WHEN p_size <= 40 THEN 'on_sale' ELSE 'off_sale' END AS status FROM part""",
    "s_campaigns": """
        SELECT campaign_id, 'Campaign ' || campaign_id AS name, channel, 'promo' AS campaign_type, 'all' AS target_segment,
               CASE WHEN month(min(o_orderdate)) % 3 = 0 THEN 1 ELSE 0 END AS has_control_group,
               CAST(date_trunc('month', min(o_orderdate)) AS DATE) + 4 AS start_date,
               CAST(date_trunc('month', min(o_orderdate)) AS DATE) + 18 AS end_date,
               CAST(10000 AS DOUBLE) AS budget, 'ended' AS status
        FROM src_orders WHERE campaign_id IS NOT NULL GROUP BY campaign_id, channel""",
    "s_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id, campaign_id, 'NO' || o_orderkey AS order_no,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'paid' WHEN 'P' THEN 'refunded' END AS status, channel,
               o_totalprice + CASE WHEN campaign_id IS NOT NULL THEN o_totalprice * 0.05 ELSE 0 END
                 - CASE WHEN o_totalprice < 20000 THEN 8 ELSE 0 END AS subtotal,
               CAST(CASE WHEN campaign_id IS NOT NULL THEN o_totalprice * 0.05 ELSE 0 END AS DOUBLE) AS discount_amount,
               CAST(CASE WHEN o_totalprice < 20000 THEN 8 ELSE 0 END AS DOUBLE) AS shipping_fee,
               o_totalprice AS total_amount, o_totalprice AS paid_amount, o_orderdate AS created_at
        FROM src_orders""",
    "s_order_items": """
        SELECT l_orderkey || '-' || l_linenumber AS order_item_id, l_orderkey AS order_id, l_partkey AS sku_id,
               CAST(NULL AS VARCHAR) AS spu_id, CAST(l_quantity AS BIGINT) AS quantity,
               l_extendedprice / l_quantity AS unit_price,
               (l_extendedprice / l_quantity) * (l_tax * 8 + 0.5) AS unit_cost,
               l_extendedprice * l_discount AS discount_amount, l_extendedprice * (1 - l_discount) AS line_amount
        FROM lineitem""",
    "s_payments": """
        SELECT 'pay-' || l_orderkey AS payment_id, l_orderkey AS order_id, 'card' AS provider,
               sum(l_extendedprice * (1 - l_discount)) AS amount, 'success' AS status, min(l_shipdate) AS paid_at
        FROM lineitem GROUP BY l_orderkey""",
    "s_refunds": """
        SELECT 'refund-' || l_orderkey AS refund_id, l_orderkey AS order_id, sum(l_extendedprice * (1 - l_discount)) AS amount,
               o_orderpriority AS reason, CASE WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'approved' END AS status,
               max(l_shipdate) AS created_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'
        GROUP BY l_orderkey, o_orderpriority, o_orderstatus""",
    "s_shipments": """
        SELECT 'ship-' || l_orderkey AS shipment_id, l_orderkey AS order_id, 'carrier-' || (min(l_suppkey) % 5) AS carrier,
               n_name AS province, CASE WHEN n_regionkey IN (2, 3) THEN 3 ELSE 5 END AS promised_days,
               min(l_shipdate) AS shipped_at, max(l_shipdate) AS delivered_at,
               CASE WHEN min(l_linestatus) = 'O' THEN NULL
                    ELSE CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(max(l_shipdate) AS DATE)) AS DOUBLE) END AS delivery_days,
               CASE WHEN min(l_linestatus) = 'O' THEN 'shipping' ELSE 'delivered' END AS status
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        GROUP BY l_orderkey, o_orderdate, n_name, n_regionkey""",
    "s_inventory_movements": """
        SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS movement_id, l_partkey AS sku_id,
               CASE WHEN l_returnflag = 'A' THEN 'out' ELSE 'in' END AS movement_type,
               CAST(CASE WHEN l_returnflag = 'A' THEN -l_quantity ELSE l_quantity END AS BIGINT) AS quantity,
               CASE WHEN l_returnflag = 'A' THEN 'sale' ELSE 'restock' END AS reason,
               l_orderkey AS related_order_id, l_shipdate AS created_at FROM lineitem""",
    "s_user_coupons": """
        SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS user_coupon_id, o_custkey AS user_id,
               CAST(round(l_discount * 100) AS BIGINT) AS coupon_id, o_orderdate AS issued_at,
               CASE WHEN l_returnflag <> 'N' THEN o_orderdate END AS used_at,
               CASE WHEN l_returnflag <> 'N' THEN l_orderkey END AS order_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_discount > 0""",
    "s_coupons": """
        SELECT coupon_id, CAST(NULL AS VARCHAR) AS campaign_id, 'SAVE' || coupon_id AS code, 'Save ' || coupon_id AS name,
               CAST(coupon_id * 1000 AS DOUBLE) AS threshold, CAST(coupon_id AS DOUBLE) AS discount,
               DATE '1995-01-01' AS start_date, DATE '2001-12-31' AS end_date,
               count(*) AS issued_count, count(*) FILTER (WHERE l_returnflag <> 'N') AS used_count,
               CASE WHEN coupon_id <= 8 THEN 'active' ELSE 'expired' END AS status
        FROM (SELECT CAST(round(l_discount * 100) AS BIGINT) AS coupon_id, l_returnflag FROM lineitem WHERE l_discount > 0)
        GROUP BY coupon_id""",
    "s_page_events": """
        SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN user_id END AS user_id,
               user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
               CASE event_type WHEN 'view' THEN 'view_home' WHEN 'click' THEN 'view_product' WHEN 'signup' THEN 'add_to_cart'
                    WHEN 'error' THEN 'checkout' WHEN 'purchase' THEN 'pay_success' END AS event_type,
               event_type AS page,
               CASE k % 6 WHEN 0 THEN 'organic' WHEN 1 THEN 'search' WHEN 2 THEN 'social' WHEN 3 THEN 'email'
                    WHEN 4 THEN 'affiliate' ELSE 'live' END AS channel,
               CASE k % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device,
               CASE WHEN k % 4 = 0 THEN 'E-' || (k % 12) END AS campaign_id, CAST(k AS BIGINT) AS sku_id, ts AS created_at
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "s_ads_spend": """
        SELECT campaign_id || '/' || strftime(o_orderdate, '%Y-%m-%d') AS spend_id, campaign_id,
               CAST(o_orderdate AS DATE) AS spend_date, channel,
               CAST(sum(l_quantity) * 10 AS BIGINT) AS impressions, CAST(sum(l_quantity) AS BIGINT) AS clicks,
               count(*) FILTER (WHERE l_returnflag = 'N') AS conversions, sum(l_extendedprice * l_tax) AS spend_amount
        FROM lineitem JOIN src_orders ON l_orderkey = o_orderkey WHERE campaign_id IS NOT NULL
        GROUP BY campaign_id, channel, o_orderdate""",
    "s_product_reviews": """
        SELECT doc_id AS review_id, CAST(NULL AS BIGINT) AS order_id, doc_id AS user_id, doc_id % 200 AS sku_id, rating,
               CASE WHEN rating >= 4 THEN 'positive' WHEN rating = 3 THEN 'neutral' ELSE 'negative' END AS sentiment,
               source AS content_tag, DATE '2024-01-01' + CAST(doc_id % 90 AS INTEGER) AS created_at
        FROM (SELECT labels.doc_id, source, 1 + 2 * quality + 2 * (1 - toxic) AS rating
              FROM labels JOIN documents ON labels.doc_id = documents.doc_id)""",
    "s_admin_action_logs": """
        SELECT o_orderkey AS log_id, 'ops' AS admin_name, channel AS action_type, 'order' AS entity_type,
               CAST(o_orderkey AS VARCHAR) AS entity_id, o_orderpriority AS detail, o_orderdate AS created_at FROM src_orders""",
    "s_carts": "SELECT o_orderkey AS cart_id, o_custkey AS user_id, o_orderdate AS created_at FROM orders",
    "s_cart_items": """
        SELECT l_orderkey || '-' || l_linenumber AS cart_item_id, l_orderkey AS cart_id, l_partkey AS sku_id,
               CAST(l_quantity AS BIGINT) AS quantity, l_shipdate AS created_at FROM lineitem""",
    # ---- views, from the driver's tables ----
    "dim_product": """
        SELECT p_partkey AS sku_id, p_brand || '/' || p_type AS spu_id, lower(p_type) AS category_id, p_type AS category_name,
               p_brand AS brand, p_brand || ' ' || p_type AS product_name, p_name AS sku_name, CAST(p_size AS VARCHAR) AS spec,
               p_retailprice AS price, CASE WHEN p_size >= 48 THEN p_retailprice * 1.1 ELSE p_retailprice * 0.6 END AS cost,
               'supplier-' || (p_size % 10) AS supplier, CAST(NULL AS DATE) AS listing_date,
               CASE WHEN p_retailprice < 930 THEN 'low' WHEN p_retailprice < 970 THEN 'mid' ELSE 'high' END AS price_band,
               'on_sale' AS product_status
        FROM part""",
    "dim_user": """
        SELECT c_custkey AS user_id, c_name AS name, n_name AS province, r_name AS city, lower(c_mktsegment) AS register_channel,
               CASE WHEN c_acctbal < 0 THEN 'at_risk' WHEN c_acctbal < 5000 THEN 'regular' ELSE 'loyal' END AS segment,
               CASE WHEN c_acctbal > 9000 THEN NULL WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               CASE WHEN c_acctbal BETWEEN 0 AND 500 THEN NULL ELSE CAST(1950 + c_custkey % 50 AS INTEGER) END AS birth_year,
               c_mktsegment AS member_level, 'active' AS status,
               (SELECT CAST(min(o_orderdate) AS DATE) FROM orders WHERE o_custkey = c_custkey) AS register_date
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "dim_campaign": "SELECT * FROM s_campaigns",
    "dim_date": """
        SELECT d AS date_id, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, strftime(d, '%Y-%m') AS year_month,
               CAST(dayofweek(d) AS INTEGER) AS weekday, CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
        FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(ts AS DATE) FROM events
              UNION SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey)
        WHERE d IS NOT NULL""",
    "fact_order": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id, campaign_id, CAST(o_orderdate AS DATE) AS order_date, channel,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'paid' WHEN 'P' THEN 'refunded' END AS status,
               o_totalprice + CASE WHEN campaign_id IS NOT NULL THEN o_totalprice * 0.05 ELSE 0 END
                 - CASE WHEN o_totalprice < 20000 THEN 8 ELSE 0 END AS subtotal,
               CAST(CASE WHEN campaign_id IS NOT NULL THEN o_totalprice * 0.05 ELSE 0 END AS DOUBLE) AS discount_amount,
               CAST(CASE WHEN o_totalprice < 20000 THEN 8 ELSE 0 END AS DOUBLE) AS shipping_fee,
               o_totalprice AS total_amount, o_totalprice AS paid_amount
        FROM src_orders""",
    "fact_order_item": """
        SELECT l_orderkey || '-' || l_linenumber AS order_item_id, l_orderkey AS order_id, o_custkey AS user_id, campaign_id,
               CAST(o_orderdate AS DATE) AS order_date, l_partkey AS sku_id, CAST(NULL AS VARCHAR) AS spu_id, CAST(l_quantity AS BIGINT) AS quantity,
               l_extendedprice / l_quantity AS unit_price, (l_extendedprice / l_quantity) * (l_tax * 8 + 0.5) AS unit_cost,
               l_extendedprice * l_discount AS discount_amount, l_extendedprice * (1 - l_discount) AS line_amount,
               CAST(l_quantity AS BIGINT) * (l_extendedprice / l_quantity - (l_extendedprice / l_quantity) * (l_tax * 8 + 0.5))
                 - l_extendedprice * l_discount AS gross_profit
        FROM lineitem JOIN src_orders ON l_orderkey = o_orderkey""",
    "fact_traffic": """
        SELECT event_id, user_id, session_id, event_type, page, channel, device, campaign_id, sku_id,
               CAST(created_at AS DATE) AS event_date, created_at FROM s_page_events""",
    "fact_ads_spend": "SELECT * FROM s_ads_spend",
    "fact_coupon_use": """
        SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS user_coupon_id, o_custkey AS user_id,
               CAST(round(l_discount * 100) AS BIGINT) AS coupon_id, CAST(NULL AS VARCHAR) AS campaign_id,
               CASE WHEN l_returnflag <> 'N' THEN l_orderkey END AS order_id, CAST(o_orderdate AS DATE) AS issued_date,
               CASE WHEN l_returnflag <> 'N' THEN CAST(o_orderdate AS DATE) END AS used_date,
               CAST(CAST(round(l_discount * 100) AS BIGINT) * 1000 AS DOUBLE) AS threshold,
               CAST(CAST(round(l_discount * 100) AS BIGINT) AS DOUBLE) AS discount, CASE WHEN l_returnflag <> 'N' THEN 1 ELSE 0 END AS is_used
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_discount > 0""",
    "fact_refund": """
        SELECT 'refund-' || l_orderkey AS refund_id, l_orderkey AS order_id, o_custkey AS user_id, campaign_id,
               CAST(max(l_shipdate) AS DATE) AS refund_date, sum(l_extendedprice * (1 - l_discount)) AS amount, o_orderpriority AS reason,
               CASE WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'approved' END AS status
        FROM lineitem JOIN src_orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'
        GROUP BY l_orderkey, o_custkey, campaign_id, o_orderpriority, o_orderstatus""",
    "fact_fulfillment": """
        SELECT shipment_id, s_shipments.order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS order_date,
               CAST(shipped_at AS DATE) AS shipped_date, CAST(delivered_at AS DATE) AS delivered_date, carrier, province, promised_days,
               delivery_days, CASE WHEN delivery_days > promised_days THEN 1 ELSE 0 END AS is_late, status
        FROM s_shipments JOIN orders ON s_shipments.order_id = o_orderkey""",
    "fact_inventory_movement": """
        SELECT movement_id, sku_id, movement_type, quantity, reason, related_order_id, CAST(created_at AS DATE) AS movement_date, created_at
        FROM s_inventory_movements""",
    "fact_product_review": """
        SELECT review_id, order_id, user_id, sku_id, rating, sentiment, content_tag, created_at AS review_date FROM s_product_reviews""",
    "daily_business_summary": """
        SELECT CAST(o_orderdate AS DATE) AS summary_date, channel, count(*) AS orders, count(DISTINCT o_custkey) AS buyers,
               round(sum(o_totalprice), 2) AS gmv,
               round(sum(CASE WHEN campaign_id IS NOT NULL THEN o_totalprice * 0.05 ELSE 0 END), 2) AS discount_amount,
               round(avg(o_totalprice), 2) AS avg_order_value
        FROM src_orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1, 2""",
}


def register(**more: str) -> None:
    """Add CTEs for a business area (feature tables, scored series, ...)."""
    CTES.update(more)


def decimal_rounding(sql: str) -> str:
    """round(x, d) of a double as rounding of its decimal value, free of the noise a sum's order leaves in the last bits."""
    out, i = [], 0
    while (m := re.compile(r"\bround\(").search(sql, i)) is not None:
        depth, j, comma = 1, m.end(), None
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[j], 0)
            if sql[j] == "," and depth == 1:
                comma = j
            j += 1
        digits = sql[comma + 1:j - 1].strip() if comma else ""
        if digits.isdigit():
            inner = decimal_rounding(sql[m.end():comma])
            text = f"CAST(round(TRY_CAST({inner} AS DECIMAL(38,{int(digits) + 6})), {digits}) AS DOUBLE)"
        else:
            text = "round(" + decimal_rounding(sql[m.end():j - 1]) + ")"
        out += [sql[i:m.start()], text]
        i = j
    return "".join(out) + sql[i:]


def expand(body: str) -> str:
    """Prefix ``body`` with the CTEs it names, dependencies first."""
    body = decimal_rounding(body)
    needed: list[str] = []

    def visit(text: str, me: str | None = None) -> None:
        for name in CTES:
            if name != me and name not in needed and re.search(rf"\b{name}\b", text):
                visit(CTES[name], name)
                if name not in needed:
                    needed.append(name)

    visit(body)
    parts = [f"{name} AS ({decimal_rounding(CTES[name].strip())})" for name in needed]
    own = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", body, re.I)
    if own:
        rest = body[own.end():]
        recursive = "RECURSIVE " if own.group(1) else ""
        return f"WITH {recursive}" + ",\n".join(parts + [rest]) if parts else body
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
