from functools import reduce

from pyspark.sql import DataFrame, functions as F

from checks import check
from checks.baskets import BASKET_SQL, baskets, rules, ruletext
from checks.features import wide
from checks.inventory import performance
from tillwise.operators import baskets as b, clusters, experiments as x, fulfilment, funnel, inventory, marketing, scorecard
from tillwise.plans import bundles

STAGES = funnel.STAGES
PAID = "status IN ('paid', 'completed')"


def sizes(frames):
    return reduce(DataFrame.union, [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("part"), "n") for k, df in frames.items()])


@check("f12_cockpit_bundle")
def _(s, spark):
    return sizes(bundles.cockpit(s))


@check("g13_funnel_bundle")
def _(s, spark):
    return sizes(bundles.funnel_report(s))


@check("r01_category_funnel", f"""SELECT category_name, {', '.join(f"count(DISTINCT session_id) FILTER (WHERE event_type = '{t}') AS {t}" for t in STAGES)},
    round(count(DISTINCT session_id) FILTER (WHERE event_type = 'pay_success') / count(DISTINCT session_id) FILTER (WHERE event_type = 'view_home') * 100, 2) AS conversion
    FROM fact_traffic t JOIN dim_product d ON d.sku_id = t.sku_id GROUP BY 1""")
def _(s, spark):
    return funnel.by_category(s.fact_traffic, s.dim_product)


REACHED = ["m1 AS (SELECT session_id, min(created_at) AS t FROM fact_traffic WHERE event_type = 'view_home' AND session_id IS NOT NULL GROUP BY 1)"] + [
    f"m{i} AS (SELECT e.session_id, min(e.created_at) AS t FROM fact_traffic e JOIN m{i - 1} m ON e.session_id = m.session_id AND e.created_at >= m.t"
    f" WHERE e.event_type = '{t}' GROUP BY 1)" for i, t in list(enumerate(STAGES, 1))[1:]]


@check("r01_sequential_funnel", "WITH " + ", ".join(REACHED) + " " + " UNION ALL ".join(
    f"SELECT {i} AS step, '{t}' AS stage, count(*) AS sessions FROM m{i}" for i, t in enumerate(STAGES, 1)))
def _(s, spark):
    return funnel.sequential(s.fact_traffic)


@check("r02_abandoned_checkouts", """SELECT session_id, max(user_id) AS user_id, max(created_at) AS last_seen, count(*) FILTER (WHERE event_type = 'add_to_cart') AS cart_adds,
    count(*) FILTER (WHERE event_type = 'checkout') AS checkouts FROM fact_traffic GROUP BY 1
    HAVING count(*) FILTER (WHERE event_type = 'checkout') > 0 AND count(*) FILTER (WHERE event_type = 'pay_success') = 0""")
def _(s, spark):
    return funnel.abandoned_checkouts(s.fact_traffic)


@check("r02_unconverted_sessions", """SELECT session_id, max(created_at) AS last_seen, round(coalesce(sum(price) FILTER (WHERE event_type = 'add_to_cart'), 0), 2) AS cart_value,
    count(DISTINCT category_name) AS categories FROM fact_traffic t LEFT JOIN dim_product d ON d.sku_id = t.sku_id
    WHERE session_id NOT IN (SELECT session_id FROM fact_traffic WHERE event_type = 'pay_success') GROUP BY 1""")
def _(s, spark):
    return funnel.unconverted_sessions(s.fact_traffic, s.dim_product)


@check("r07_pruned_rules", """SELECT * FROM cat_rules r WHERE NOT EXISTS (SELECT 1 FROM cat_rules q WHERE q.consequents = r.consequents
    AND len(string_split(q.antecedents, '|')) < len(string_split(r.antecedents, '|')) AND list_has_all(string_split(r.antecedents, '|'), string_split(q.antecedents, '|')) AND q.confidence >= r.confidence)""")
def _(s, spark):
    return ruletext(b.prune_redundant(rules(s, "cat")))


@check("r08_bundle_revenue", f"""WITH n AS (SELECT count(*) AS n FROM ({BASKET_SQL.format('sku')})),
    u AS (SELECT antecedents, consequents, support, unnest(string_split(antecedents || '|' || consequents, '|')) AS item FROM sku_rules),
    g AS (SELECT antecedents, consequents, support, sum(price) AS p, sum(cost) AS c FROM u JOIN dim_product d ON CAST(d.sku_id AS VARCHAR) = u.item GROUP BY 1, 2, 3)
    SELECT antecedents, consequents, round(p, 2) AS bundle_price, round(support * n, 1) AS expected_orders, round(support * n * p * 0.9, 2) AS expected_revenue,
           round(support * n * (p * 0.9 - c), 2) AS expected_margin FROM g, n""")
def _(s, spark):
    return ruletext(b.bundle_revenue(rules(s, "sku"), baskets(s, "sku"), s.dim_product))


@check("r09_before_and_during", f"""WITH g AS (SELECT order_date, sum(paid_amount) AS g FROM fact_order WHERE {PAID} GROUP BY 1),
    c AS (SELECT campaign_id, start_date, end_date, CAST(end_date - start_date + 1 AS INTEGER) AS n FROM dim_campaign WHERE has_control_group = 0),
    x AS (SELECT campaign_id, n, coalesce((SELECT sum(g) FROM g WHERE order_date >= start_date - n AND order_date < start_date), 0) AS b,
                 coalesce((SELECT sum(g) FROM g WHERE order_date BETWEEN start_date AND end_date), 0) AS d FROM c)
    SELECT campaign_id, round(b / n, 2) AS daily_before, round(d / n, 2) AS daily_during, round(coalesce((d - b) / nullif(b, 0), 0) * 100, 2) AS change_pct FROM x""")
def _(s, spark):
    return marketing.before_and_during(s.dim_campaign, s.fact_order)


@check("r10_category_delays", """SELECT category_name, count(*) AS shipments, CAST(sum(is_late) AS BIGINT) AS late_count, round(sum(is_late) / count(*) * 100, 2) AS late_rate
    FROM (SELECT DISTINCT order_id, category_name FROM fact_order_item i JOIN dim_product d ON d.sku_id = i.sku_id) p JOIN fact_fulfillment f ON f.order_id = p.order_id GROUP BY 1""")
def _(s, spark):
    return fulfilment.category_delays(s.fact_fulfillment, s.order_items, s.dim_product)


def worst(group):
    return f"""SELECT {group}, reviews, bad, round(bad / reviews * 100, 2) AS bad_rate FROM (SELECT {group}, count(*) AS reviews, count(*) FILTER (WHERE rating <= 2) AS bad
        FROM fact_product_review r JOIN dim_product d USING (sku_id) GROUP BY 1) ORDER BY bad_rate DESC, reviews DESC, {group} LIMIT 20"""


@check("r10_worst_reviewed_skus", worst("sku_id"))
def _(s, spark):
    return fulfilment.worst_reviewed(s.fact_product_review, s.dim_product)


@check("r10_worst_reviewed_suppliers", worst("supplier"))
def _(s, spark):
    return fulfilment.worst_reviewed(s.fact_product_review, s.dim_product, "supplier")


@check("r10_refunded_overstock", """SELECT r.sku_id, refund_count, stock AS current_stock FROM (SELECT i.sku_id, count(*) AS refund_count FROM fact_refund f JOIN fact_order_item i ON i.order_id = f.order_id
    WHERE f.status = 'approved' GROUP BY 1 HAVING count(*) >= 5) r JOIN (SELECT sku_id, CAST(sum(CASE WHEN movement_type = 'in' THEN quantity ELSE -abs(quantity) END) AS BIGINT) AS stock
    FROM fact_inventory_movement GROUP BY 1) v ON v.sku_id = r.sku_id WHERE stock >= 100""")
def _(s, spark):
    return fulfilment.refunded_overstock(s.fact_refund, s.order_items, inventory.stock_levels(s.fact_inventory_movement))


@check("r11_action_effect", f"""WITH g AS (SELECT order_date, sum(paid_amount) AS g FROM fact_order WHERE {PAID} GROUP BY 1),
    a AS (SELECT action_type, CAST(created_at AS DATE) AS action_day, count(*) AS actions FROM s_admin_action_logs GROUP BY 1, 2),
    x AS (SELECT a.action_type, a.action_day, a.actions, coalesce(sum(g) FILTER (WHERE order_date < action_day), 0) / 7 AS b, coalesce(sum(g) FILTER (WHERE order_date > action_day), 0) / 7 AS f
          FROM a LEFT JOIN g ON order_date BETWEEN action_day - 7 AND action_day + 7 GROUP BY 1, 2, 3)
    SELECT action_type, action_day, actions, round(b, 2) AS before, round(f, 2) AS after, round(coalesce((f - b) / nullif(b, 0), 0) * 100, 2) AS change_pct FROM x""")
def _(s, spark):
    return scorecard.action_effect(s.admin_action_logs, s.fact_order)


@check("r13_daily_insights", f"""WITH g AS (SELECT order_date AS day, sum(paid_amount) AS v FROM fact_order WHERE {PAID} GROUP BY 1),
    c AS (SELECT day, coalesce((v - lag(v) OVER w) / nullif(lag(v) OVER w, 0), 0) AS c FROM g WINDOW w AS (ORDER BY day)),
    r AS (SELECT refund_date AS day, count(*) AS v FROM fact_refund WHERE status = 'approved' GROUP BY 1),
    u AS (SELECT day, v, avg(v) OVER (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS u FROM r),
    t AS (SELECT channel, event_date AS day, coalesce(count(DISTINCT session_id) FILTER (WHERE event_type = 'pay_success') / nullif(count(DISTINCT session_id) FILTER (WHERE event_type = 'view_home'), 0), 0) AS c
          FROM fact_traffic GROUP BY 1, 2),
    f AS (SELECT channel, day, coalesce((c - lag(c) OVER w) / nullif(lag(c) OVER w, 0), 0) AS f FROM t WINDOW w AS (PARTITION BY channel ORDER BY day))
    SELECT day, 'gmv_move' AS kind, 'all' AS subject, round(c * 100, 2) AS value FROM c WHERE abs(c) > 0.1
    UNION ALL SELECT day, 'refund_spike', 'all', round(v / u, 2) FROM u WHERE v > u * 2
    UNION ALL SELECT day, 'conversion_drop', channel, round(f * 100, 2) FROM f WHERE f < -0.2
    UNION ALL SELECT (SELECT max(order_date) FROM fact_order), 'low_stock', CAST(sku_id AS VARCHAR), CAST(current_stock AS DOUBLE) FROM perf WHERE current_stock < total_qty / 365 * 3""")
def _(s, spark):
    return scorecard.daily_insights(s.fact_order, s.fact_refund, s.fact_traffic, performance(s))


@check("r14_welch_t", """WITH g AS (SELECT avg(paid_amount) FILTER (WHERE a) AS m1, var_samp(paid_amount) FILTER (WHERE a) AS v1, count(*) FILTER (WHERE a) AS n1,
    avg(paid_amount) FILTER (WHERE NOT a) AS m0, var_samp(paid_amount) FILTER (WHERE NOT a) AS v0, count(*) FILTER (WHERE NOT a) AS n0 FROM (SELECT paid_amount, campaign_id IS NOT NULL AS a FROM fact_order))
    SELECT n1, n0, round(m1, 4) AS mean1, round(m0, 4) AS mean0, round((m1 - m0) / sqrt(v1 / n1 + v0 / n0), 4) AS t,
    round(pow(v1 / n1 + v0 / n0, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v0 / n0, 2) / (n0 - 1)), 2) AS degrees, abs((m1 - m0) / sqrt(v1 / n1 + v0 / n0)) > 1.959964 AS significant FROM g""")
def _(s, spark):
    return x.welch_t(s.fact_order.withColumn("arm", F.col("campaign_id").isNotNull().cast("int")), "arm", "paid_amount")


@check("r14_chi_square", """WITH c AS (SELECT channel, status, count(*) AS n FROM fact_order GROUP BY 1, 2), e AS (SELECT *, sum(n) OVER (PARTITION BY channel) * sum(n) OVER (PARTITION BY status) / sum(n) OVER () AS e FROM c)
    SELECT round(sum((n - e) * (n - e) / e), 4) AS chi_square, (count(DISTINCT channel) - 1) * (count(DISTINCT status) - 1) AS degrees FROM e""")
def _(s, spark):
    return x.chi_square(s.fact_order, "channel", "status")


@check("r14_sample_size", """SELECT round(p, 6) AS base_rate, CAST(ceil(7.848879734349088 * (p * (1 - p) + p * 1.1 * (1 - p * 1.1)) / pow(p * 1.1 - p, 2)) AS BIGINT) AS per_arm
    FROM (SELECT avg(CASE WHEN status = 'refunded' THEN 1 ELSE 0 END) AS p FROM fact_order)""")
def _(s, spark):
    return x.sample_size(s.fact_order.withColumn("c", (F.col("status") == "refunded").cast("int")), "c")


OUT = ("total_amount", "discount_amount", "subtotal")


@check("r15_robust_outliers", "WITH m AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in OUT) + " FROM amounts), a AS (SELECT order_id, "
       + ", ".join(f"abs(x.{c} - m.{c}) AS {c}" for c in OUT) + " FROM amounts x, m), d AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) * 1.4826 AS {c}" for c in OUT)
       + " FROM a), z AS (SELECT order_id, greatest(" + ", ".join(f"coalesce(a.{c} / nullif(d.{c}, 0), 0)" for c in OUT) + ") AS z FROM a, d) SELECT order_id, round(z, 4) AS outlier_score, z > 3.5 AS is_outlier FROM z")
def _(s, spark):
    return x.robust_outliers(s.orders.select("order_id", *OUT), OUT, "order_id")


@check("r15_principal_components")
def _(s, spark):
    return x.principal_components(clusters.vectors(wide(s), clusters.COMPARED_FEATURES, ("user_id",)), "user_id")


@check("r15_isolation_forest")
def _(s, spark):
    return x.isolation_scores(s.orders.select("order_id", *OUT), OUT, "order_id")
