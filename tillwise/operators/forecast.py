"""Daily series, trend, stationarity tests, forecasts and safety stock.

A series frame has (series, day, y), one row per calendar day and series, so its
size per series is bounded by the calendar. Raw rows are summed per day before
any window runs, and every window is partitioned by series.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tillwise.functions import small_series
from tillwise.functions.exprs import is_paid, is_weekend, round_to, safe_divide, year_month
from tillwise.functions.scale import durable

# the small numeric helpers travel inside the job, so executors need no copy of the package
cloudpickle.register_pickle_by_value(small_series)

HOLD_OUT = 30
ALPHA = 0.3


def _in_time():
    return W.partitionBy("series").orderBy("day")


# ---- series ------------------------------------------------------------------------
def fill_days(daily: DataFrame) -> DataFrame:
    """Add the missing days of each series between its first and last day, as 0."""
    spine = daily.groupBy("series").agg(F.explode(F.sequence(F.min("day"), F.max("day"))).alias("day"))
    return spine.join(daily, ["series", "day"], "left").select("series", "day", F.coalesce("y", F.lit(0.0)).alias("y"))


def daily_sales(orders: DataFrame) -> DataFrame:
    """Paid gmv per day as series 'gmv'."""
    d = orders.where(is_paid()).groupBy(F.col("order_date").alias("day")).agg(F.sum("paid_amount").alias("y"))
    return fill_days(d.select(F.lit("gmv").alias("series"), "day", "y"))


def category_daily(lines: DataFrame, products: DataFrame, top_n: int | None = 5) -> DataFrame:
    """Quantity per category and day; the ``top_n`` categories by quantity, all when None."""
    per_sku_day = lines.groupBy("sku_id", F.col("order_date").alias("day")).agg(F.sum("quantity").alias("q"))
    d = (per_sku_day.join(products.select("sku_id", F.col("category_name").alias("series")), "sku_id")
         .groupBy("series", "day").agg(F.sum("q").cast("double").alias("y")))
    d = durable(d)  # one row per category and day, read three times below
    return fill_days(_largest(d, top_n) if top_n else d)


def sku_daily(lines: DataFrame, top_n: int | None = 20) -> DataFrame:
    """Quantity per SKU and day; the ``top_n`` SKUs by quantity, found first, or all when None."""
    named = lines.select(F.col("sku_id").cast("string").alias("series"), F.col("order_date").alias("day"),
                         F.col("quantity").cast("double").alias("y"))
    if top_n:
        named = _largest(named, top_n)
    return fill_days(named.groupBy("series", "day").agg(F.sum("y").alias("y")))


def _largest(d: DataFrame, top_n: int) -> DataFrame:
    top = d.groupBy("series").agg(F.sum("y").alias("t")).orderBy(F.desc("t"), "series").limit(top_n).select("series")
    return d.join(F.broadcast(top), "series", "left_semi")  # top has top_n rows


# ---- trend -------------------------------------------------------------------------
def centred_average(series: DataFrame, window: int, name: str) -> DataFrame:
    """Centred moving average, NULL where the window is not full. Even windows reach one day further back."""
    frame = _in_time().rowsBetween(-(window // 2), (window - 1) // 2)
    return series.withColumn(name, F.when(F.count("y").over(frame) == window, F.avg("y").over(frame)))


def moving_average(series: DataFrame, window: int = 7, name: str = "ma") -> DataFrame:
    """Trailing average over up to ``window`` days."""
    return series.withColumn(name, F.avg("y").over(_in_time().rowsBetween(-(window - 1), 0)))


def weekend_effect(series: DataFrame) -> DataFrame:
    end = is_weekend("day") == 1
    g = series.groupBy("series").agg(F.avg(F.when(end, F.col("y"))).alias("we"), F.avg(F.when(~end, F.col("y"))).alias("wd"))
    return g.select("series", round_to("we").alias("weekend_avg"), round_to("wd").alias("weekday_avg"),
                    round_to(safe_divide(F.col("we") - F.col("wd"), "wd") * 100).alias("weekend_effect_pct"))


def monthly_summary(series: DataFrame, last: int = 12) -> DataFrame:
    m = series.groupBy("series", year_month("day").alias("year_month")).agg(
        round_to(F.sum("y")).alias("sum"), round_to(F.avg("y"), 4).alias("mean"), round_to(F.stddev_samp("y"), 4).alias("std"))
    newest = F.row_number().over(W.partitionBy("series").orderBy(F.desc("year_month")))
    return m.withColumn("_n", newest).where(F.col("_n") <= last).drop("_n")


def difference(series: DataFrame) -> DataFrame:
    return series.withColumn("y", F.col("y") - F.lag("y").over(_in_time())).where(F.col("y").isNotNull())


def decompose(series: DataFrame, period: int = 7) -> DataFrame:
    """Additive split: centred moving average, centred weekday means of the rest, residual."""
    t = centred_average(series, period, "trend").withColumn("weekday", F.dayofweek("day") - 1)
    season = (t.where(F.col("trend").isNotNull()).groupBy("series", "weekday")
              .agg(F.avg(F.col("y") - F.col("trend")).alias("s")))
    season = season.withColumn("seasonal", F.col("s") - F.avg("s").over(W.partitionBy("series"))).drop("s")
    out = t.join(season, ["series", "weekday"], "left")
    return out.withColumn("residual", F.col("y") - F.col("trend") - F.col("seasonal"))


# ---- stationarity --------------------------------------------------------------------
def _lagged(series: DataFrame, lags: int, column: str = "y", prefix: str = "l") -> DataFrame:
    return series.withColumns({f"{prefix}{i}": F.lag(column, i).over(_in_time()) for i in range(1, lags + 1)})


def autocorrelation(series: DataFrame, lags: int = 30) -> DataFrame:
    """ACF and PACF per series and lag. Lag products are summed by Spark; PACF is the Durbin-Levinson recursion."""
    mean = F.avg("y").over(W.partitionBy("series"))
    e = _lagged(series.withColumn("e", F.col("y") - mean), lags, "e")
    sums = e.groupBy("series").agg(F.sum(F.col("e") * F.col("e")).alias("c0"),
                                   *[F.coalesce(F.sum(F.col("e") * F.col(f"l{i}")), F.lit(0.0)).alias(f"c{i}")
                                     for i in range(1, lags + 1)])
    acf = F.array(*[safe_divide(f"c{i}", "c0") for i in range(1, lags + 1)])
    rows = sums.select("series", acf.alias("acf")).withColumn("pacf", partial_autocorrelation("acf"))
    return rows.select("series", F.posexplode(F.arrays_zip("acf", "pacf")).alias("i", "v")).select(
        "series", (F.col("i") + 1).alias("lag"), "v.acf", "v.pacf")


def partial_autocorrelation(acf: str) -> Column:
    """Durbin-Levinson recursion as a fold over an array of autocorrelations of lags 1, 2, ...

    The state holds the coefficients of the last order and the parts so far. An order whose
    remaining variance is 0 has part 0; a NULL autocorrelation makes its part and the later ones NULL.
    """
    r, none = F.col(acf), F.array().cast("array<double>")

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, v: t + v)

    def step(state, k):
        phi = state["phi"]
        before = F.slice(r, F.lit(1), k - 1)
        rest = F.lit(1.0) - dot(phi, before)
        part = F.when(rest == 0, F.lit(0.0)).otherwise((F.get(r, k - 1) - dot(phi, F.reverse(before))) / F.nullif(rest, F.lit(0.0)))
        lower = F.zip_with(phi, F.reverse(phi), lambda a, b: a - part * b)
        return F.struct(F.concat(lower, F.array(part)).alias("phi"), F.concat(state["pacf"], F.array(part)).alias("pacf"))

    start = F.struct(none.alias("phi"), none.alias("pacf"))
    folded = F.aggregate(F.sequence(F.lit(1), F.size(r)), start, step, lambda s: s["pacf"])
    return F.when(F.size(r) > 0, folded).otherwise(none)


# fixed values: KPSS level critical points
KPSS_POINTS, KPSS_LEVELS = (0.347, 0.463, 0.574, 0.739), (0.10, 0.05, 0.025, 0.01)


def adf_test(series: DataFrame) -> DataFrame:
    """Augmented Dickey-Fuller test with constant, lag by AIC, one row per series.

    A group is one daily series, so its rows are bounded by the calendar.
    """
    rows = small_series.adf_row

    def test(pdf):
        pdf = pdf.sort_values("day")
        return rows(pdf["series"].iloc[0], pdf["y"].to_numpy(dtype=float))

    return series.groupBy("series").applyInPandas(
        test, "series string, lags int, n int, adf_statistic double, adf_pvalue double, adf_stationary boolean")


def kpss_test(series: DataFrame, lags: int | None = None) -> DataFrame:
    """KPSS level test per series; ``lags`` None picks the data-driven bandwidth."""
    whole = W.partitionBy("series")
    e = series.withColumn("e", F.col("y") - F.avg("y").over(whole))
    if lags is None:
        n = e.groupBy("series").count().agg(F.max("count")).first()[0]
        first = int(n ** (2 / 9))
        pre = _lagged(e, first, "e").groupBy("series").agg(
            F.count("e").alias("n"), F.sum(F.col("e") * F.col("e")).alias("c0"),
            *[F.sum(F.col("e") * F.col(f"l{i}")).alias(f"c{i}") for i in range(1, first + 1)])
        own = F.floor(F.pow(F.col("n").cast("double"), F.lit(2 / 9)))  # each series' own first bandwidth
        s0 = F.col("c0") / F.col("n")
        s1 = F.lit(0.0)
        for i in range(1, first + 1):
            c = F.when(F.lit(i) <= own, F.col(f"c{i}") / (F.col("n") / 2)).otherwise(F.lit(0.0))
            s0, s1 = s0 + c, s1 + c * i
        width = F.least(F.floor(1.1447 * F.pow(F.pow(s1 / s0, 2), F.lit(1 / 3)) * F.pow("n", F.lit(1 / 3))), F.col("n") - 1)
        chosen = pre.select("series", width.cast("int").alias("lags"))
        top = chosen.agg(F.max("lags")).first()[0]
    else:
        chosen, top = e.select("series").distinct().withColumn("lags", F.lit(lags)), lags
    run = F.sum("e").over(_in_time().rowsBetween(W.unboundedPreceding, 0))
    f = _lagged(e.withColumn("s", run), top, "e")
    g = f.groupBy("series").agg(F.count("e").alias("n"), F.sum(F.col("s") * F.col("s")).alias("ss"),
                                F.sum(F.col("e") * F.col("e")).alias("c0"),
                                *[F.sum(F.col("e") * F.col(f"l{i}")).alias(f"c{i}") for i in range(1, top + 1)]).join(chosen, "series")
    long_run = F.col("c0")
    for i in range(1, top + 1):
        weight = F.greatest(1 - F.lit(float(i)) / (F.col("lags") + 1), F.lit(0.0))
        long_run = long_run + 2 * weight * F.coalesce(F.col(f"c{i}"), F.lit(0.0))
    stat = F.try_divide("ss", F.col("n") * long_run)
    pieces = list(zip(KPSS_POINTS, KPSS_LEVELS))
    p = F.when(F.col("k") <= KPSS_POINTS[0], KPSS_LEVELS[0])
    for (x0, p0), (x1, p1) in zip(pieces, pieces[1:]):
        p = p.when(F.col("k") <= x1, F.lit(p0) + (F.col("k") - x0) / (x1 - x0) * (p1 - p0))
    p = p.otherwise(KPSS_LEVELS[-1])
    return (g.withColumn("k", stat).withColumn("p", p)
            .select("series", "lags", round_to("k", 4).alias("kpss_statistic"), round_to("p", 4).alias("kpss_pvalue"),
                    (F.col("p") > 0.05).alias("kpss_stationary")))


def stationarity(series: DataFrame) -> DataFrame:
    """ADF, KPSS, ADF of the first difference and the suggested degree of differencing."""
    a = adf_test(series).drop("lags", "n")
    d = adf_test(difference(series)).select("series", F.col("adf_pvalue").alias("diff1_pvalue"),
                                            F.col("adf_stationary").alias("diff1_stationary"))
    out = a.join(kpss_test(series).drop("lags"), "series").join(d, "series")
    return (out.withColumn("needs_differencing", ~F.col("adf_stationary"))
            .withColumn("suggested_d", F.when(~F.col("adf_stationary") & F.col("diff1_stationary"), 1).otherwise(0)))


# ---- forecasts -----------------------------------------------------------------------
def _ahead(levels: DataFrame, periods: int) -> DataFrame:
    """Flat forecast rows after the last day of each series."""
    steps = levels.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(periods))))
    return steps.select("series", "step", F.date_add("last_day", F.col("step")).alias("day"), F.col("level").alias("forecast"))


def naive(series: DataFrame, periods: int = 30, window: int = 7) -> DataFrame:
    """Mean of the last ``window`` days, repeated."""
    back = F.row_number().over(W.partitionBy("series").orderBy(F.desc("day")))
    last = series.withColumn("_b", back).where(F.col("_b") <= window)
    return _ahead(last.groupBy("series").agg(F.avg("y").alias("level"), F.max("day").alias("last_day")), periods)


def moving_average_forecast(series: DataFrame, periods: int = 30, window: int = 7) -> DataFrame:
    """Last trailing average, repeated; NULL for a series shorter than the window."""
    frame = _in_time().rowsBetween(-(window - 1), 0)
    ma = series.withColumn("_m", F.when(F.count("y").over(frame) == window, F.avg("y").over(frame)))
    return _ahead(ma.groupBy("series").agg(F.max_by("_m", "day").alias("level"), F.max("day").alias("last_day")), periods)


def exponential_smoothing(series: DataFrame, periods: int = 30, alpha: float = ALPHA) -> DataFrame:
    """Simple smoothing in closed form: weights alpha·(1-alpha)^age, (1-alpha)^age for the first day."""
    age = F.row_number().over(W.partitionBy("series").orderBy(F.desc("day"))) - 1
    first = F.min("day").over(W.partitionBy("series"))
    share = F.when(F.col("day") == F.col("_f"), F.lit(1.0)).otherwise(F.lit(alpha)) * F.pow(F.lit(1 - alpha), F.col("_a"))
    w = series.withColumn("_a", age).withColumn("_f", first)
    return _ahead(w.groupBy("series").agg(F.sum(share * F.col("y")).alias("level"), F.max("day").alias("last_day")), periods)


ARIMA_COLUMNS = ("series string, model string, aic double, step int, day date, forecast double, lower_bound double, "
                 "upper_bound double")


def arima(series: DataFrame, periods: int = 30) -> DataFrame:
    """ARIMA(p,1,q), p and q in {1, 2}, best AIC, with a 95 % interval, per series.

    Two-stage least squares (Hannan-Rissanen) in place of maximum likelihood, so
    values are close to, not equal to, an exact ML fit. A group is one daily
    series, so its rows are bounded by the calendar. Short series get the naive forecast.
    """
    rows = small_series.arima_rows

    def fit(pdf):
        pdf = pdf.sort_values("day")
        return rows(pdf["series"].iloc[0], pdf["day"].iloc[-1], pdf["y"].to_numpy(dtype=float), periods)

    return series.groupBy("series").applyInPandas(fit, ARIMA_COLUMNS)


MODELS = {"naive": naive, "moving_avg": moving_average_forecast, "exp_smooth": exponential_smoothing, "arima": arima}


def hold_out(series: DataFrame, days: int = HOLD_OUT) -> tuple[DataFrame, DataFrame]:
    """Training part and the last ``days`` days of each series."""
    back = F.row_number().over(W.partitionBy("series").orderBy(F.desc("day")))
    marked = series.withColumn("_b", back)
    return marked.where(F.col("_b") > days).drop("_b"), marked.where(F.col("_b") <= days).drop("_b")


def _errors(actual: DataFrame, predicted: DataFrame) -> DataFrame:
    gap = F.col("y") - F.col("forecast")
    m = actual.join(predicted.select("series", "day", "forecast"), ["series", "day"])
    return m.groupBy("series").agg(F.avg(F.abs(gap)).alias("mae"), F.sqrt(F.avg(gap * gap)).alias("rmse"),
                                   (F.avg(F.abs(gap / F.greatest("y", F.lit(1.0)))) * 100).alias("mape"))


def evaluate(series: DataFrame, models: Sequence[str] = tuple(MODELS), days: int = HOLD_OUT) -> DataFrame:
    """Hold-out errors per series and model."""
    train, test = hold_out(series, days)
    out = None
    for m in models:
        one = _errors(test, MODELS[m](train, days)).select(
            "series", F.lit(m).alias("model"), round_to("mae").alias("mae"), round_to("rmse").alias("rmse"), round_to("mape", 1).alias("mape"))
        out = one if out is None else out.unionByName(one)
    return out


def best_forecast(series: DataFrame, periods: int = 30, models: Sequence[str] = tuple(MODELS), refit: bool = True,
                  days: int = HOLD_OUT) -> DataFrame:
    """Forecast by the model with least hold-out RMSE, per series.

    The winner is refitted on the whole series. ``refit=False`` instead reuses its
    hold-out forecast under future dates.
    """
    best = evaluate(series, models, days).groupBy("series").agg(F.min(F.struct("rmse", "model"))["model"].alias("model"))
    train, _ = hold_out(series, days)
    out = None
    for m in models:
        f = MODELS[m](series, periods) if refit else MODELS[m](train, days).withColumn("day", F.date_add("day", days))
        one = f.select("series", F.lit(m).alias("model"), "step", "day", round_to("forecast").alias("forecast"))
        out = one if out is None else out.unionByName(one)
    return out.join(best, ["series", "model"])


def forecast_with_error(series: DataFrame, days: int = HOLD_OUT) -> DataFrame:
    """ARIMA forecast of the hold-out days with its MAE and MAPE, per series."""
    train, test = hold_out(series, days)
    f = arima(train, days)
    e = _errors(test, f)
    return f.join(e, "series").select("series", "model", "step", "day", round_to("forecast").alias("forecast"),
                                      round_to("mae").alias("mae"), round_to("mape", 1).alias("mape"))


# ---- safety stock ----------------------------------------------------------------------
def safety_stock(lines: DataFrame, lead_days: int = 3, z: float = 1.65) -> DataFrame:
    """Demand, variation, safety stock and reorder point per SKU, over days with sales.

    ``flag`` is 'urgent' (cv > 1, demand > 3), 'excess' (cv < 0.5, demand < 2) or NULL.
    """
    per_day = lines.groupBy("sku_id", "order_date").agg(F.sum("quantity").alias("q"))
    g = per_day.groupBy("sku_id").agg(F.avg("q").alias("a"), F.coalesce(F.stddev_samp("q"), F.lit(0.0)).alias("s"))
    stock = F.lit(z * math.sqrt(lead_days)) * F.col("s")
    out = g.select("sku_id", round_to("a").alias("avg_daily_demand"), round_to(F.when(F.col("a") > 0, F.col("s") / F.col("a")).otherwise(0.0)).alias("cv"),
                   round_to(stock, 0).alias("safety_stock"), round_to(F.col("a") * lead_days + stock, 0).alias("reorder_point"))
    flag = (F.when((F.col("cv") > 1.0) & (F.col("avg_daily_demand") > 3), "urgent")
            .when((F.col("cv") < 0.5) & (F.col("avg_daily_demand") < 2), "excess"))
    return out.withColumn("flag", flag)


def stock_out_risk(safety: DataFrame, stock: DataFrame, lead_days: int = 3) -> DataFrame:
    """Share of the reorder point that stock on hand does not cover, 0..1."""
    m = safety.join(stock.select("sku_id", "current_stock"), "sku_id", "left").fillna(0, ["current_stock"])
    risk = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - safe_divide("current_stock", "reorder_point", 1.0)))
    return m.select("sku_id", "avg_daily_demand", "reorder_point", "current_stock", round_to(risk, 4).alias("stock_out_risk"))
