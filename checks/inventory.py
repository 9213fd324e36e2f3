from checks import check, ctes
from tillwise.operators import inventory as inv


def level(sign):
    return f"""SELECT sku_id, CAST(sum(CASE WHEN movement_type = 'in' THEN quantity ELSE 0 END) AS BIGINT) AS total_in,
        CAST(sum(CASE WHEN movement_type = 'out' THEN {sign} ELSE 0 END) AS BIGINT) AS total_out
        FROM fact_inventory_movement GROUP BY sku_id"""


PERF = """
    SELECT o.*, coalesce(total_in, 0) AS total_in, coalesce(total_out, 0) AS total_out,
           coalesce(total_in, 0) - coalesce(total_out, 0) AS current_stock,
           round(total_qty / greatest(coalesce(total_in, 0) - coalesce(total_out, 0) + 1, 1), 2) AS turnover_times,
           coalesce(round(365 / nullif(round(total_qty / greatest(coalesce(total_in, 0) - coalesce(total_out, 0) + 1, 1), 2), 0), 0), 365) AS turnover_days
    FROM (SELECT i.sku_id, product_name, category_name, supplier, CAST(sum(quantity) AS BIGINT) AS total_qty,
                 round(sum(unit_price * quantity - i.discount_amount), 2) AS total_sales, round(sum(gross_profit), 2) AS gross_profit,
                 count(DISTINCT order_id) AS order_count
          FROM fact_order_item i JOIN dim_product d ON i.sku_id = d.sku_id GROUP BY ALL) o
    LEFT JOIN ({}) v ON v.sku_id = o.sku_id"""


def _abc(src, value, label):
    return f"""SELECT * EXCLUDE (cum, tot), CASE WHEN round(cum / tot, 10) <= 0.7 THEN 'A' WHEN round(cum / tot, 10) <= 0.9 THEN 'B' ELSE 'C' END AS abc_{label}
        FROM (SELECT *, sum({value}) OVER (ORDER BY {value} DESC, sku_id ROWS UNBOUNDED PRECEDING) AS cum, sum({value}) OVER () AS tot FROM {src})"""


ctes.register(
    perf=PERF.format(level("abs(quantity)")),
    per_sku="""SELECT i.sku_id, product_name, category_name, CAST(sum(quantity) AS BIGINT) AS qty,
        round(sum(unit_price * quantity - i.discount_amount), 4) AS sales, round(sum(gross_profit), 4) AS profit
        FROM fact_order_item i JOIN dim_product d ON i.sku_id = d.sku_id GROUP BY ALL""",
    abc1=_abc("per_sku", "sales", "sales"), abc2=_abc("abc1", "profit", "profit"), abc3=_abc("abc2", "qty", "volume"),
    strategies="""SELECT sku_id, product_name, category_name AS category, abc_sales AS abc_class, strategy, round(sales, 2) AS sales, stock, qty FROM (
        SELECT a.*, coalesce(stock, 0) AS stock, CASE WHEN abc_sales = 'A' AND coalesce(stock, 0) < qty * 0.5 THEN '补货'
            WHEN abc_sales = 'C' AND coalesce(stock, 0) > qty * 3 THEN '清仓' WHEN abc_sales = 'A' AND profit < sales * 0.2 THEN '提价/控成本'
            WHEN abc_sales = 'C' AND qty < 10 THEN '考虑下架' WHEN abc_sales = 'B' AND profit > sales * 0.5 THEN '重点运营' END AS strategy
        FROM abc1 a LEFT JOIN (SELECT sku_id, CAST(sum(CASE WHEN movement_type = 'in' THEN quantity ELSE -abs(quantity) END) AS BIGINT) AS stock
             FROM fact_inventory_movement GROUP BY 1) v ON v.sku_id = a.sku_id) WHERE strategy IS NOT NULL""",
    alerts="""SELECT sku_id, '缺货预警' AS type, current_stock, round(total_qty / 365, 1) AS avg_daily_demand, CAST(NULL AS DOUBLE) AS turnover_days,
            CASE WHEN current_stock <= 0 THEN 'high' ELSE 'medium' END AS severity FROM perf WHERE current_stock < total_qty / 365 * 3 AND total_qty > 10
        UNION ALL SELECT sku_id, '滞销预警', current_stock, NULL, turnover_days, 'medium' FROM perf WHERE turnover_days > 180""")


def performance(s, **kw):
    return inv.sku_performance(s.sales_lines, s.dim_product, s.fact_inventory_movement, **kw)


@check("o01_sku_performance", "SELECT * FROM perf")
def _(s, spark):
    return performance(s)


@check("o01_sku_performance_raw_sign", PERF.format(level("quantity")))
def _(s, spark):
    return performance(s, raw_sign=True)


@check("o01_performance_totals", """SELECT count(*) AS total_skus, count(*) FILTER (WHERE total_qty > 0) AS active_skus,
    round(count(*) FILTER (WHERE total_qty > 0) / count(*) * 100, 1) AS sell_through_rate, round(sum(total_sales), 2) AS total_revenue,
    round(sum(gross_profit), 2) AS total_profit FROM perf""")
def _(s, spark):
    return inv.performance_totals(performance(s))


@check("o02_abc_by_sales", "SELECT * FROM abc1")
def _(s, spark):
    return inv.abc_classify(inv._per_sku(s.sales_lines, s.dim_product), "sales", "sales")


@check("o03_abc_skus", "SELECT * FROM abc3")
def _(s, spark):
    return inv.abc_skus(s.sales_lines, s.dim_product)


@check("o03_abc_matrix", "SELECT abc_sales, abc_profit, count(*) AS sku_count, round(sum(sales), 2) AS total_sales FROM abc2 GROUP BY 1, 2")
def _(s, spark):
    return inv.abc_matrix(inv.abc_skus(s.sales_lines, s.dim_product))


@check("o03_abc_summary", " UNION ALL ".join(f"""SELECT 'abc_{m}' AS measure, count(*) FILTER (WHERE abc_{m} = 'A') AS A,
    count(*) FILTER (WHERE abc_{m} = 'B') AS B, count(*) FILTER (WHERE abc_{m} = 'C') AS C FROM abc3""" for m in ("sales", "profit", "volume")))
def _(s, spark):
    return inv.abc_summary(inv.abc_skus(s.sales_lines, s.dim_product))


def strategies(s):
    return inv.product_strategies(s.sales_lines, s.dim_product, s.fact_inventory_movement)


@check("o04_product_strategies", "SELECT * FROM strategies")
def _(s, spark):
    return strategies(s)


@check("o04_strategy_summary", """SELECT n.strategy, count(x.sku_id) AS skus
    FROM (VALUES ('补货'), ('清仓'), ('提价/控成本'), ('考虑下架'), ('重点运营')) n(strategy) LEFT JOIN strategies x ON x.strategy = n.strategy GROUP BY 1""")
def _(s, spark):
    return inv.strategy_summary(strategies(s))


@check("o05_stock_alerts", "SELECT * FROM alerts")
def _(s, spark):
    return inv.stock_alerts(performance(s))


@check("o05_alert_counts", """SELECT count(*) FILTER (WHERE type = '缺货预警') AS stockout_count,
    count(*) FILTER (WHERE type = '滞销预警') AS overstock_count FROM alerts""")
def _(s, spark):
    return inv.alert_counts(inv.stock_alerts(performance(s)))
