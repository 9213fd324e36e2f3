from checks import check, ctes
from tillwise.operators import marketing as m

PAID = "status IN ('paid', 'completed')"


def z(a, b, k="", d=2):
    return f"round(coalesce({a} / nullif({b}, 0), 0){k}, {d})"


ctes.register(
    kpis=f"""SELECT campaign_id, name, channel, impressions, clicks, conversions, round(spend, 4) AS spend, round(gmv, 2) AS gmv,
        {z('clicks', 'impressions', ' * 100')} AS ctr, {z('conversions', 'clicks', ' * 100')} AS cvr, {z('spend', 'clicks')} AS cpc,
        {z('spend', 'impressions', ' * 1000')} AS cpm, {z('spend', 'conversions')} AS cpa, {z('gmv', 'spend')} AS roas,
        {z('(gmv - spend)', 'spend', ' * 100', 1)} AS roi
        FROM (SELECT c.campaign_id, c.name, c.channel, coalesce(impressions, 0) AS impressions, coalesce(clicks, 0) AS clicks,
                     coalesce(conversions, 0) AS conversions, coalesce(spend, 0) AS spend, coalesce(gmv, 0) AS gmv
              FROM dim_campaign c
              LEFT JOIN (SELECT campaign_id, CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(clicks) AS BIGINT) AS clicks,
                                CAST(sum(conversions) AS BIGINT) AS conversions, sum(spend_amount) AS spend FROM fact_ads_spend GROUP BY 1) a USING (campaign_id)
              LEFT JOIN (SELECT campaign_id, sum(paid_amount) AS gmv FROM fact_order WHERE {PAID} AND campaign_id IS NOT NULL GROUP BY 1) g USING (campaign_id))""",
    coupon_ret=f"""SELECT c.coupon_id, name, c.campaign_id, threshold, discount, issued_count AS issued, used_count AS redeemed,
        round(coalesce(gmv, 0), 2) AS gmv, {z('used_count', 'issued_count', ' * 100')} AS redemption_rate,
        round(used_count * discount, 2) AS coupon_cost, {z('coalesce(gmv, 0)', '(used_count * discount)')} AS roas
        FROM s_coupons c LEFT JOIN (SELECT coupon_id, sum(paid_amount) AS gmv FROM s_user_coupons u JOIN fact_order o ON u.order_id = o.order_id
             WHERE {PAID} AND used_at IS NOT NULL GROUP BY 1) g ON g.coupon_id = c.coupon_id""",
    affinity="""SELECT user_id, used, issued, round(used / issued, 4) AS use_rate,
        CASE WHEN used / issued >= 0.5 THEN 'sensitive' WHEN used / issued < 0.2 THEN 'insensitive' ELSE 'neutral' END AS kind
        FROM (SELECT user_id, count(used_at) AS used, count(*) AS issued FROM s_user_coupons GROUP BY 1 HAVING count(*) >= 3)""",
    ranking=f"""SELECT channel, round(spend, 2) AS spend, campaigns, round(gmv, 2) AS gmv, roas, CAST(rank AS INTEGER) AS rank,
        CASE WHEN n >= 2 AND rank <= 2 THEN 1 ELSE 0 END AS increase, CASE WHEN n >= 4 AND rank BETWEEN 3 AND 4 THEN 1 ELSE 0 END AS maintain,
        CASE WHEN n >= 2 AND rank > n - 2 THEN 1 ELSE 0 END AS decrease
        FROM (SELECT *, row_number() OVER (ORDER BY roas DESC, channel) AS rank, count(*) OVER () AS n
              FROM (SELECT a.channel, spend, campaigns, coalesce(gmv, 0) AS gmv, {z('coalesce(gmv, 0)', 'spend')} AS roas
                    FROM (SELECT channel, sum(spend_amount) AS spend, count(DISTINCT campaign_id) AS campaigns FROM fact_ads_spend GROUP BY 1) a
                    LEFT JOIN (SELECT channel, sum(paid_amount) AS gmv FROM fact_order WHERE {PAID} AND campaign_id IS NOT NULL GROUP BY 1) g USING (channel)))""")


def kpis(s):
    return m.campaign_kpis(s.dim_campaign, s.fact_ads_spend, s.fact_order)


@check("m01_campaign_kpis", "SELECT * FROM kpis")
def _(s, spark):
    return kpis(s)


@check("m01_channel_summary", f"""SELECT channel, count(DISTINCT campaign_id) AS campaigns, round(sum(spend), 2) AS total_spend,
    round(sum(gmv), 2) AS total_gmv, {z('sum(gmv)', 'sum(spend)')} AS roas FROM kpis GROUP BY channel""")
def _(s, spark):
    return m.channel_summary(kpis(s))


@check("m01_campaign_totals", f"""SELECT round(sum(spend), 2) AS total_spend, round(sum(gmv), 2) AS total_gmv,
    {z('sum(gmv)', 'sum(spend)')} AS overall_roas FROM kpis""")
def _(s, spark):
    return m.campaign_totals(kpis(s))


@check("m02_coupon_returns", "SELECT * FROM coupon_ret")
def _(s, spark):
    return m.coupon_returns(s.coupons, s.user_coupons, s.fact_order)


@check("m02_coupon_totals", """SELECT CAST(sum(issued) AS BIGINT) AS total_issued, CAST(sum(redeemed) AS BIGINT) AS total_redeemed,
    round(sum(redeemed) / sum(issued) * 100, 2) AS overall_rate FROM coupon_ret""")
def _(s, spark):
    return m.coupon_totals(m.coupon_returns(s.coupons, s.user_coupons, s.fact_order))


@check("m03_coupon_affinity", "SELECT * FROM affinity")
def _(s, spark):
    return m.coupon_affinity(s.user_coupons)


@check("m03_coupon_affinity_totals", """SELECT count(*) FILTER (WHERE kind = 'sensitive') AS sensitive_users,
    count(*) FILTER (WHERE kind = 'insensitive') AS insensitive_users FROM affinity""")
def _(s, spark):
    return m.coupon_affinity_totals(m.coupon_affinity(s.user_coupons))


@check("m04_campaign_increment", f"""
    WITH d AS (SELECT c.campaign_id, o.order_date, sum(paid_amount) AS g FROM dim_campaign c
               JOIN fact_order o ON o.order_date BETWEEN c.start_date AND c.end_date AND o.{PAID} AND (o.campaign_id IS NULL OR o.campaign_id <> c.campaign_id)
               WHERE has_control_group = 1 GROUP BY 1, 2),
         x AS (SELECT c.*, coalesce((SELECT avg(g) FROM d WHERE d.campaign_id = c.campaign_id), 0) * greatest(end_date - start_date + 1, 1) AS control,
                      coalesce((SELECT sum(paid_amount) FROM fact_order o WHERE o.campaign_id = c.campaign_id AND o.{PAID}), 0) AS test
               FROM dim_campaign c WHERE has_control_group = 1)
    SELECT campaign_id, name AS campaign_name, channel, round(test, 2) AS test_gmv, round(control, 2) AS estimated_control_gmv,
           round(test - control, 2) AS increment, round((test - control) / (control + 1) * 100, 1) AS increment_pct, budget FROM x""")
def _(s, spark):
    return m.increment(s.dim_campaign, s.fact_order)


@check("m05_channel_ranking", "SELECT * FROM ranking")
def _(s, spark):
    return m.channel_ranking(s.fact_ads_spend, s.fact_order)


@check("m05_budget_move", """SELECT round(sum(spend), 2) AS total_spend, CAST(20 AS DOUBLE) AS migrate_pct, round(sum(spend) * 0.2, 2) AS migrated_amount,
    round(sum(spend) * 0.2 * (arg_min(roas, rank) - arg_max(roas, rank)), 2) AS estimated_gain FROM ranking""")
def _(s, spark):
    return m.budget_move(m.channel_ranking(s.fact_ads_spend, s.fact_order))
