from checks import check
from tillwise.operators import funnel

STAGES = funnel.STAGES
COUNTS = ", ".join(f"count(DISTINCT session_id) FILTER (WHERE event_type = '{s}') AS {s}" for s in STAGES)
STEPS = "WITH c AS (SELECT {} FROM fact_traffic), f AS ({})".format(
    COUNTS, " UNION ALL ".join(f"SELECT {i + 1} AS step, '{s}' AS stage, {s} AS sessions FROM c" for i, s in enumerate(STAGES)))


@check("g01_overall_funnel", STEPS + """
    SELECT step, stage, sessions, round(sessions / lag(sessions) OVER (ORDER BY step) * 100, 2) AS step_rate,
           round(sessions / first(sessions) OVER (ORDER BY step) * 100, 2) AS overall_rate FROM f""")
def _(s, spark):
    return funnel.overall(s.fact_traffic)


def grouped(column, tail=""):
    return f"""SELECT {column}, {COUNTS}, round(count(DISTINCT session_id) FILTER (WHERE event_type = 'pay_success')
        / nullif(count(DISTINCT session_id) FILTER (WHERE event_type = 'view_home'), 0) * 100, 2) AS conversion
        FROM fact_traffic WHERE {column} IS NOT NULL GROUP BY {column} {tail}"""


@check("g02_funnel_by_channel", grouped("channel"))
def _(s, spark):
    return funnel.by_group(s.fact_traffic, "channel")


@check("g03_funnel_by_device", grouped("device"))
def _(s, spark):
    return funnel.by_group(s.fact_traffic, "device")


@check("g04_funnel_by_campaign", grouped("campaign_id", "ORDER BY campaign_id"))
def _(s, spark):
    return funnel.by_campaign(s.fact_traffic)


@check("g05_monthly_funnel", """
    SELECT *, round(add_to_cart / greatest(view_home, 1) * 100, 4) AS cart_rate, round(pay_success / greatest(view_home, 1) * 100, 4) AS pay_rate
    FROM (SELECT strftime(event_date, '%Y-%m') AS ym, count(DISTINCT session_id) FILTER (WHERE event_type = 'view_home') AS view_home,
                 count(DISTINCT session_id) FILTER (WHERE event_type = 'add_to_cart') AS add_to_cart,
                 count(DISTINCT session_id) FILTER (WHERE event_type = 'pay_success') AS pay_success
          FROM fact_traffic WHERE event_type IN ('view_home', 'add_to_cart', 'pay_success') GROUP BY 1)""")
def _(s, spark):
    return funnel.monthly(s.fact_traffic)


def leaky(a, b, before, after, rate, least):
    return f"""SELECT sku_id, {a}, {b}, round({b} / {a} * 100, 2) AS {rate}
        FROM (SELECT sku_id, count(*) FILTER (WHERE event_type = '{before}') AS {a}, count(*) FILTER (WHERE event_type = '{after}') AS {b}
              FROM fact_traffic WHERE sku_id IS NOT NULL GROUP BY sku_id) WHERE {a} >= {least} ORDER BY {b} / {a}, sku_id LIMIT 20"""


@check("g06_many_views_few_carts", leaky("views", "carts", "view_product", "add_to_cart", "cart_rate", 10))
def _(s, spark):
    return funnel.many_views_few_carts(s.fact_traffic)


@check("g07_many_carts_few_checkouts", leaky("carts", "checkouts", "add_to_cart", "checkout", "checkout_rate", 5))
def _(s, spark):
    return funnel.many_carts_few_checkouts(s.fact_traffic)


@check("g08_biggest_dropoff", STEPS + """, d AS (SELECT step, lag(stage) OVER w AS from_stage, stage AS to_stage,
        lag(sessions) OVER w AS before, lag(sessions) OVER w - sessions AS loss FROM f WINDOW w AS (ORDER BY step))
    SELECT step, from_stage, to_stage, loss, round(loss / before * 100, 2) AS loss_rate,
           CASE WHEN row_number() OVER (ORDER BY loss DESC, step) = 1 THEN 1 ELSE 0 END AS biggest FROM d WHERE step > 1""")
def _(s, spark):
    return funnel.drop_offs(s.fact_traffic)


def lost(events, any_status=False):
    paid = "" if any_status else "AND status IN ('paid', 'completed')"
    return f"""SELECT DISTINCT user_id FROM fact_traffic
        WHERE event_date >= (SELECT max(event_date) - 90 FROM fact_traffic) AND event_type IN ({events}) AND user_id IS NOT NULL
          AND user_id NOT IN (SELECT user_id FROM fact_order WHERE order_date >= (SELECT max(order_date) - 90 FROM fact_order) {paid})"""


BROWSE, CART, CHECKOUT = lost("'view_product', 'add_to_cart'"), lost("'add_to_cart'"), lost("'checkout'", True)


@check("g09_browsed_without_order", BROWSE)
def _(s, spark):
    return funnel.browsed_without_order(s.fact_traffic, s.fact_order, own_cutoff=True)


@check("g10_cart_abandoners", CART)
def _(s, spark):
    return funnel.cart_abandoners(s.fact_traffic, s.fact_order, own_cutoff=True)


@check("g11_checkout_abandoners", CHECKOUT)
def _(s, spark):
    return funnel.checkout_abandoners(s.fact_traffic, s.fact_order, own_cutoff=True)


@check("g12_remarketing_list", f"""SELECT user_id, 'browse_no_order' AS reason FROM ({BROWSE})
    UNION ALL SELECT user_id, 'cart_abandon' FROM ({CART}) UNION ALL SELECT user_id, 'checkout_abandon' FROM ({CHECKOUT})""")
def _(s, spark):
    return funnel.remarketing_list(s.fact_traffic, s.fact_order, own_cutoff=True)


@check("g14_latest_event_date", "SELECT max(event_date) AS max_date FROM fact_traffic")
def _(s, spark):
    return funnel.latest_event_date(s.fact_traffic)
