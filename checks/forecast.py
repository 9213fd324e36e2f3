
from checks import check, ctes
from tillwise.functions.exprs import round_to
from tillwise.operators import forecast as f

PAID = "status IN ('paid', 'completed')"
SPINE = "SELECT series, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT series, min(day) AS a, max(day) AS b FROM {0} GROUP BY 1)"
FILLED = "SELECT s.series, s.day, coalesce(y, 0) AS y FROM (" + SPINE + ") s LEFT JOIN {0} d ON d.series = s.series AND d.day = s.day"
ctes.register(
    raw_gmv=f"SELECT 'gmv' AS series, order_date AS day, sum(paid_amount) AS y FROM fact_order WHERE {PAID} GROUP BY 2",
    gmv_series=FILLED.format("raw_gmv"),
    raw_cat="SELECT category_name AS series, order_date AS day, CAST(sum(quantity) AS DOUBLE) AS y FROM fact_order_item i JOIN dim_product d ON d.sku_id = i.sku_id GROUP BY 1, 2",
    raw_cat5="SELECT * FROM raw_cat WHERE series IN (SELECT series FROM raw_cat GROUP BY 1 ORDER BY sum(y) DESC, series LIMIT 5)",
    cat_series=FILLED.format("raw_cat5"),
    gmv_train="SELECT * FROM gmv_series WHERE day <= (SELECT max(day) - 30 FROM gmv_series)",
    gmv_test="SELECT * FROM gmv_series WHERE day > (SELECT max(day) - 30 FROM gmv_series)",
    safety="""SELECT *, CASE WHEN cv > 1 AND avg_daily_demand > 3 THEN 'urgent' WHEN cv < 0.5 AND avg_daily_demand < 2 THEN 'excess' END AS flag FROM (
        SELECT sku_id, round(a, 2) AS avg_daily_demand, round(CASE WHEN a > 0 THEN s / a ELSE 0 END, 2) AS cv, round(1.65 * sqrt(3) * s, 0) AS safety_stock,
               round(a * 3 + 1.65 * sqrt(3) * s, 0) AS reorder_point FROM (SELECT sku_id, avg(q) AS a, coalesce(stddev_samp(q), 0) AS s FROM
               (SELECT sku_id, order_date, sum(quantity) AS q FROM fact_order_item GROUP BY 1, 2) GROUP BY 1))""")


def rnd(df, *cols, d=4):
    return df.withColumns({c: round_to(c, d) for c in cols})


def cats(s):
    return f.category_daily(s.fact_order_item, s.dim_product)


@check("l01_daily_sales_series", "SELECT series, day, round(y, 2) AS y FROM gmv_series")
def _(s, spark):
    return rnd(f.daily_sales(s.fact_order), "y", d=2)


@check("l02_category_series", "SELECT series, day, y FROM cat_series")
def _(s, spark):
    return cats(s)


def centred(w):
    back, ahead = w // 2, (w - 1) // 2
    win = f"OVER (PARTITION BY series ORDER BY day ROWS BETWEEN {back} PRECEDING AND {ahead} FOLLOWING)"
    return f"CASE WHEN count(y) {win} = {w} THEN avg(y) {win} END"


@check("l03_centred_averages", f"SELECT series, day, y, round({centred(7)}, 4) AS ma7, round({centred(30)}, 4) AS ma30 FROM cat_series")
def _(s, spark):
    return rnd(f.centred_average(f.centred_average(cats(s), 7, "ma7"), 30, "ma30"), "ma7", "ma30")


@check("l04_weekend_effect", """SELECT series, round(a, 2) AS weekend_avg, round(b, 2) AS weekday_avg, round((a - b) / b * 100, 2) AS weekend_effect_pct FROM (
    SELECT series, avg(y) FILTER (WHERE dayofweek(day) IN (0, 6)) AS a, avg(y) FILTER (WHERE dayofweek(day) NOT IN (0, 6)) AS b FROM gmv_series GROUP BY 1)""")
def _(s, spark):
    return f.weekend_effect(f.daily_sales(s.fact_order))


@check("l05_monthly_summary", """SELECT series, strftime(day, '%Y-%m') AS year_month, round(sum(y), 2) AS sum, round(avg(y), 4) AS mean, round(stddev_samp(y), 4) AS std
    FROM gmv_series GROUP BY 1, 2 ORDER BY year_month DESC LIMIT 12""")
def _(s, spark):
    return f.monthly_summary(f.daily_sales(s.fact_order))


@check("l06_adf_test")
def _(s, spark):
    return f.adf_test(f.daily_sales(s.fact_order))


def kpss_sql(lags):
    weights = " + ".join(f"2 * {1 - i / (lags + 1)!r} * coalesce(sum(e * l{i}), 0)" for i in range(1, lags + 1))
    cols = ", ".join(f"lag(e, {i}) OVER w AS l{i}" for i in range(1, lags + 1))
    pts = list(zip(f.KPSS_POINTS, f.KPSS_LEVELS))
    p = f"CASE WHEN k <= {pts[0][0]} THEN {pts[0][1]}" + "".join(
        f" WHEN k <= {b[0]} THEN {a[1]} + (k - {a[0]}) / {b[0] - a[0]!r} * {b[1] - a[1]!r}" for a, b in zip(pts, pts[1:])) + f" ELSE {pts[-1][1]} END"
    return f"""WITH e AS (SELECT series, day, y - avg(y) OVER (PARTITION BY series) AS e FROM cat_series),
        x AS (SELECT *, sum(e) OVER (PARTITION BY series ORDER BY day ROWS UNBOUNDED PRECEDING) AS s, {cols} FROM e WINDOW w AS (PARTITION BY series ORDER BY day)),
        g AS (SELECT series, sum(s * s) / (count(*) * (sum(e * e) + {weights})) AS k FROM x GROUP BY 1)
        SELECT series, {lags} AS lags, round(k, 4) AS kpss_statistic, round({p}, 4) AS kpss_pvalue, {p} > 0.05 AS kpss_stationary FROM g"""


@check("l07_kpss_test", kpss_sql(10))
def _(s, spark):
    return f.kpss_test(cats(s), 10)


@check("l08_stationarity")
def _(s, spark):
    return f.stationarity(f.daily_sales(s.fact_order))


AHEAD = "SELECT series, CAST(step AS INTEGER) AS step, last + CAST(step AS INTEGER) AS day, round(level, 4) AS forecast FROM ({}), (SELECT unnest(range(1, 31)) AS step)"
LAST7 = "SELECT series, avg(y) AS level, max(day) AS last FROM (SELECT * FROM {0} QUALIFY row_number() OVER (PARTITION BY series ORDER BY day DESC) <= 7) GROUP BY 1"
SMOOTH = """SELECT series, sum(CASE WHEN age = n - 1 THEN 1.0::DOUBLE ELSE 0.3 END * pow(0.7, age) * y) AS level, max(day) AS last FROM (
    SELECT *, row_number() OVER (PARTITION BY series ORDER BY day DESC) - 1 AS age, count(*) OVER (PARTITION BY series) AS n FROM {0}) GROUP BY 1"""


@check("l09_naive_forecast", AHEAD.format(LAST7.format("cat_series")))
def _(s, spark):
    return rnd(f.naive(cats(s)), "forecast")


@check("l10_moving_average_forecast", AHEAD.format(LAST7.format("cat_series")))
def _(s, spark):
    return rnd(f.moving_average_forecast(cats(s)), "forecast")


@check("l11_exponential_smoothing", AHEAD.format(SMOOTH.format("cat_series")))
def _(s, spark):
    return rnd(f.exponential_smoothing(cats(s)), "forecast")


@check("l12_arima_forecast")
def _(s, spark):
    return f.arima(f.daily_sales(s.fact_order))


SIMPLE = ("naive", "moving_avg", "exp_smooth")
EVAL = " UNION ALL ".join(f"""SELECT 'gmv' AS series, '{m}' AS model, round(avg(abs(y - level)), 2) AS mae, round(sqrt(avg((y - level) * (y - level))), 2) AS rmse,
    round(avg(abs((y - level) / greatest(y, 1))) * 100, 1) AS mape FROM gmv_test, ({src.format('gmv_train')})"""
                          for m, src in zip(SIMPLE, (LAST7, LAST7, SMOOTH)))


@check("l13_model_comparison", EVAL)
def _(s, spark):
    return f.evaluate(f.daily_sales(s.fact_order), SIMPLE)


@check("l13_best_forecast", f"""WITH v AS ({EVAL}), b AS (SELECT model FROM v ORDER BY rmse, model LIMIT 1)
    SELECT series, model, step, day, round(forecast, 2) AS forecast FROM (SELECT 'naive' AS model, * FROM ({AHEAD.format(LAST7.format('gmv_series'))})
        UNION ALL SELECT 'moving_avg', * FROM ({AHEAD.format(LAST7.format('gmv_series'))})
        UNION ALL SELECT 'exp_smooth', * FROM ({AHEAD.format(SMOOTH.format('gmv_series'))})) WHERE model IN (SELECT model FROM b)""")
def _(s, spark):
    return f.best_forecast(f.daily_sales(s.fact_order), models=SIMPLE)


@check("l13_four_model_comparison")
def _(s, spark):
    return f.evaluate(f.daily_sales(s.fact_order))


@check("l14_category_forecast")
def _(s, spark):
    return f.forecast_with_error(cats(s))


@check("l15_safety_stock", "SELECT * FROM safety")
def _(s, spark):
    return f.safety_stock(s.fact_order_item)


@check("l16_trailing_average", "SELECT series, day, y, round(avg(y) OVER (PARTITION BY series ORDER BY day ROWS 6 PRECEDING), 4) AS ma FROM cat_series")
def _(s, spark):
    return rnd(f.moving_average(cats(s)), "ma")


@check("r04_first_difference", "SELECT * FROM (SELECT series, day, y - lag(y) OVER (PARTITION BY series ORDER BY day) AS y FROM cat_series) WHERE y IS NOT NULL")
def _(s, spark):
    return f.difference(cats(s))


ACF = f"""WITH e AS (SELECT series, day, y - avg(y) OVER (PARTITION BY series) AS e FROM cat_series),
    x AS (SELECT series, e, {', '.join(f'lag(e, {i}) OVER (PARTITION BY series ORDER BY day) AS l{i}' for i in range(1, 11))} FROM e)
    """ + " UNION ALL ".join(f"SELECT series, {i} AS lag, round(sum(e * l{i}) / sum(e * e), 6) AS acf FROM x GROUP BY 1" for i in range(1, 11))


@check("r04_autocorrelation", ACF)
def _(s, spark):
    return rnd(f.autocorrelation(cats(s), 10).select("series", "lag", "acf"), "acf", d=6)


PACF = f"""WITH RECURSIVE e AS (SELECT series, day, y - avg(y) OVER (PARTITION BY series) AS e FROM cat_series),
    x AS (SELECT series, e, {', '.join(f'lag(e, {i}) OVER (PARTITION BY series ORDER BY day) AS l{i}' for i in range(1, 31))} FROM e),
    r AS (SELECT series, [{', '.join(f'sum(e * l{i}) / sum(e * e)' for i in range(1, 31))}] AS r FROM x GROUP BY 1),
    d AS (SELECT series, r, 0 AS k, []::DOUBLE[] AS phi, 0.0::DOUBLE AS part FROM r
          UNION ALL
          SELECT series, r, k + 1, list_append(list_transform(range(1, k + 1), lambda i: phi[i] - p * phi[k + 1 - i]), p), p
          FROM (SELECT *, (r[k + 1] - coalesce(list_sum(list_transform(range(1, k + 1), lambda i: phi[i] * r[k + 1 - i])), 0))
                          / (1 - coalesce(list_sum(list_transform(range(1, k + 1), lambda i: phi[i] * r[i])), 0)) AS p FROM d WHERE k < 30))
    SELECT series, k AS lag, round(r[k], 6) AS acf, round(part, 6) AS pacf FROM d WHERE k > 0"""


@check("r04_partial_autocorrelation", PACF)
def _(s, spark):
    return rnd(f.autocorrelation(cats(s), 30), "acf", "pacf", d=6)


@check("r05_decomposition", f"""WITH t AS (SELECT series, day, y, CAST(dayofweek(day) AS INTEGER) AS weekday, {centred(7)} AS trend FROM cat_series),
    m AS (SELECT series, weekday, avg(y - trend) AS s FROM t WHERE trend IS NOT NULL GROUP BY 1, 2),
    k AS (SELECT series, weekday, s - avg(s) OVER (PARTITION BY series) AS seasonal FROM m)
    SELECT t.series, t.weekday, day, y, round(trend, 4) AS trend, round(seasonal, 4) AS seasonal, round(y - trend - seasonal, 4) AS residual
    FROM t LEFT JOIN k ON k.series = t.series AND k.weekday = t.weekday""")
def _(s, spark):
    return rnd(f.decompose(cats(s)), "trend", "seasonal", "residual")


@check("r06_sku_forecast")
def _(s, spark):
    return f.forecast_with_error(f.sku_daily(s.fact_order_item))


@check("r06_stock_out_risk", """SELECT s.sku_id, avg_daily_demand, reorder_point, coalesce(v.stock, 0) AS current_stock,
    round(greatest(0, least(1, 1 - coalesce(coalesce(v.stock, 0) / nullif(reorder_point, 0), 1))), 4) AS stock_out_risk FROM safety s
    LEFT JOIN (SELECT sku_id, CAST(sum(CASE WHEN movement_type = 'in' THEN quantity ELSE -abs(quantity) END) AS BIGINT) AS stock FROM fact_inventory_movement GROUP BY 1) v
    ON v.sku_id = s.sku_id""")
def _(s, spark):
    from tillwise.operators.inventory import stock_levels
    return f.stock_out_risk(f.safety_stock(s.fact_order_item), stock_levels(s.fact_inventory_movement))
