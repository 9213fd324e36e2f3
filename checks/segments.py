from checks import check
from checks.features import wide
from tillwise.operators import segments as g

PAID = "status IN ('paid', 'completed')"
TEXT = "(VALUES " + ", ".join("({})".format(", ".join(f"'{t}'" for t in row)) for row in g.STRATEGIES) + \
    ") t(rfm_segment, description, strategy, action, suggested_coupon)"
LIST = "user_id, name, province, member_level, rfm_segment, recency, frequency, round(monetary, 2) AS monetary"


@check("h01_segment_overview", f"""
    SELECT rfm_segment AS segment, user_count, round(gmv, 2) AS total_gmv, round(gmv / sum(gmv) OVER () * 100, 2) AS gmv_share, avg_recency, avg_frequency,
           avg_monetary, coalesce(description, '') AS description, coalesce(strategy, '') AS strategy, coalesce(action, '') AS action
    FROM (SELECT rfm_segment, count(*) AS user_count, sum(monetary) AS gmv, round(avg(recency), 1) AS avg_recency, round(avg(frequency), 1) AS avg_frequency,
                 round(avg(monetary), 2) AS avg_monetary FROM user_wide GROUP BY 1) LEFT JOIN {TEXT} USING (rfm_segment)""")
def _(s, spark):
    return g.overview(wide(s))


MONTHS = (1, 2, 3, 6, 12)


def retention(cohort):
    return f"""WITH u AS ({cohort}), o AS (SELECT DISTINCT user_id, date_trunc('month', order_date) AS m FROM fact_order WHERE {PAID}),
        z AS (SELECT c, count(*) AS size FROM u GROUP BY 1),
        h AS (SELECT c, {', '.join(f"count(DISTINCT u.user_id) FILTER (WHERE date_diff('month', c, m) = {k}) AS month_{k}" for k in MONTHS)} FROM u LEFT JOIN o ON o.user_id = u.user_id GROUP BY 1)
        SELECT strftime(c, '%Y-%m') AS cohort, size, {', '.join(f'month_{k}' for k in MONTHS)},
               {', '.join(f'round(month_{k} / size * 100, 2) AS retention_{k}' for k in MONTHS)} FROM z JOIN h USING (c)"""


BY_REGISTER = retention("SELECT user_id, date_trunc('month', register_date) AS c FROM dim_user WHERE register_date IS NOT NULL")


@check("h02_cohort_retention", BY_REGISTER)
def _(s, spark):
    return g.cohort_retention(s.dim_user, s.fact_order)


@check("h03_cohort_heatmap", f"WITH x AS ({BY_REGISTER}) " + " UNION ALL ".join(
    f"SELECT cohort, {k} AS month, retention_{k} AS rate FROM x" for k in MONTHS))
def _(s, spark):
    return g.cohort_heatmap(g.cohort_retention(s.dim_user, s.fact_order))


@check("r03_first_order_cohorts", retention(f"SELECT user_id, date_trunc('month', min(order_date)) AS c FROM fact_order WHERE {PAID} GROUP BY 1"))
def _(s, spark):
    return g.first_order_retention(s.fact_order)


@check("h04_user_profiles", f"""
    SELECT u.*, coalesce(total_orders, 0) AS total_orders, coalesce(total_spent, 0) AS total_spent, first_order, last_order, top_events,
           coalesce(coupons_issued, 0) AS coupons_issued, coalesce(coupons_used, 0) AS coupons_used, coalesce(refund_count, 0) AS refund_count,
           coalesce(refund_amount, 0) AS refund_amount
    FROM dim_user u
    LEFT JOIN (SELECT user_id, count(*) AS total_orders, round(sum(paid_amount), 2) AS total_spent, min(order_date) AS first_order, max(order_date) AS last_order
               FROM fact_order WHERE {PAID} GROUP BY 1) o USING (user_id)
    LEFT JOIN (SELECT user_id, string_agg(event_type || '=' || n, ', ' ORDER BY n DESC, event_type) AS top_events FROM
               (SELECT user_id, event_type, count(*) AS n FROM fact_traffic WHERE user_id IS NOT NULL GROUP BY 1, 2) GROUP BY 1) e USING (user_id)
    LEFT JOIN (SELECT user_id, count(*) AS coupons_issued, CAST(sum(is_used) AS BIGINT) AS coupons_used FROM fact_coupon_use GROUP BY 1) c USING (user_id)
    LEFT JOIN (SELECT user_id, count(*) AS refund_count, round(sum(amount), 2) AS refund_amount FROM fact_refund WHERE status = 'approved' GROUP BY 1) r USING (user_id)""")
def _(s, spark):
    return g.profiles(s.dim_user, s.fact_order, s.fact_traffic, s.fact_coupon_use, s.fact_refund)


@check("h05_segment_comparison", """SELECT rfm_segment, count(*) AS user_count, round(sum(monetary), 2) AS total_gmv, round(sum(monetary) / count(*), 4) AS avg_aov,
    round(avg(frequency), 4) AS avg_frequency, round(avg(recency), 4) AS avg_recency, round(avg(has_refund), 4) AS refund_rate FROM user_wide GROUP BY 1""")
def _(s, spark):
    return g.comparison(wide(s))


def money(df):
    from tillwise.functions.exprs import round_to
    return df.withColumn("monetary", round_to("monetary"))


@check("h06_user_search", f"""SELECT {LIST} FROM user_wide WHERE rfm_segment = '流失客户' AND (regexp_matches(name, '0[12]$') OR regexp_matches(CAST(user_id AS VARCHAR), '0[12]$'))
    ORDER BY user_id LIMIT 50""")
def _(s, spark):
    return money(g.search_users(wide(s), "0[12]$", "流失客户"))


@check("h07_user_list", f"SELECT {LIST} FROM user_wide WHERE rfm_segment = '潜力客户'")
def _(s, spark):
    return money(g.user_list(wide(s), "潜力客户"))


@check("h08_coupon_suggestions", f"""SELECT rfm_segment AS segment, user_count, coalesce(strategy, '') AS strategy, coalesce(action, '') AS action,
    coalesce(suggested_coupon, '{g.DEFAULT_COUPON}') AS suggested_coupon
    FROM (SELECT rfm_segment, count(*) AS user_count FROM user_wide GROUP BY 1) LEFT JOIN {TEXT} USING (rfm_segment)""")
def _(s, spark):
    return g.coupon_suggestions(wide(s))


@check("h09_top_spenders", f"""SELECT u.user_id, name, segment, CAST((SELECT max(order_date) FROM fact_order WHERE {PAID}) - max(order_date) AS INTEGER) AS recency_days,
    count(order_id) AS frequency, round(sum(paid_amount), 2) AS monetary FROM dim_user u JOIN fact_order o ON o.user_id = u.user_id WHERE o.{PAID}
    GROUP BY 1, 2, 3 ORDER BY monetary DESC, user_id LIMIT 100""")
def _(s, spark):
    return g.top_spenders(s.dim_user, s.fact_order)
