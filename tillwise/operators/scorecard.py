"""Business health score, opportunities, risks and the weekly report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tillwise.functions.exprs import is_paid, percent, round_to, safe_divide, year_month
from tillwise.functions.scale import one_row, scalars
from tillwise.operators import fulfilment, funnel, sales
from tillwise.operators.fulfilment import approved

BUYER_TARGET = 18000  # fixed value: active buyers for a full activity score


def health_inputs(orders: DataFrame, lines: DataFrame, refunds: DataFrame, traffic: DataFrame, shipments: DataFrame,
                  movements: DataFrame, as_of=None, raw_sign: bool = False) -> DataFrame:
    """One row with the seven measures the score is made of."""
    paid = orders.where(is_paid())
    monthly = (paid.groupBy(year_month("order_date").alias("ym")).agg(F.sum("paid_amount").alias("gmv"))
               .orderBy(F.desc("ym")).limit(6))
    m = scalars(monthly, latest=F.max_by("gmv", "ym"), oldest=F.min_by("gmv", "ym"), n=F.count(F.lit(1)))
    end = F.lit(as_of).cast("date") if as_of else scalars(orders, d=F.max("order_date"))["d"]
    since = F.date_sub(end, 90)
    o = scalars(orders, gmv=F.sum(F.when(is_paid(), F.col("paid_amount"))), n=F.count(F.lit(1)))
    a = scalars(paid.where(F.col("order_date") >= since), n=F.count_distinct("user_id"))
    p = scalars(lines.where(is_paid()), profit=F.sum("gross_profit"))
    r = scalars(approved(refunds), n=F.count(F.lit(1)))
    s = sales.session_totals(traffic)
    late = scalars(shipments, rate=F.coalesce(F.avg("is_late"), F.lit(0.0)))
    q = F.col("quantity")
    out = q if raw_sign else F.abs(q)
    per_sku = movements.groupBy("sku_id").agg(
        F.sum(F.when(F.col("movement_type") == "out", out).otherwise(0)).alias("o"),
        F.sum(F.when(F.col("movement_type") == "in", q).otherwise(-out)).alias("s"))
    t = scalars(per_sku, turnover=F.avg(F.col("o") / (F.abs("s") + 1)))
    raw = one_row(orders.sparkSession, m=m, o=o, a=a, p=p, r=r, s=s, late=late, t=t)
    return raw.select(
        F.when(F.col("m.n") >= 2, safe_divide(F.col("m.latest") - F.col("m.oldest"), "m.oldest")).alias("trend"),
        round_to(safe_divide("p.profit", "o.gmv") * 100).alias("gross_margin"),
        (safe_divide("r.n", "o.n") * 100).alias("refund_rate"), (safe_divide("s.paying", "s.sessions") * 100).alias("conversion"),
        F.col("late.rate").alias("late_rate"), F.coalesce("t.turnover", F.lit(0.0)).alias("turnover"), F.col("a.n").alias("active"))


def health_score(inputs: DataFrame, buyer_target: int = BUYER_TARGET) -> DataFrame:
    """Seven scored rows and the total with its grade."""
    c = F.col
    cap = lambda v, top: F.least(F.lit(float(top)), v)
    # fixed values: dimension, weight
    parts = [("GMV 趋势", 20, F.when(c("trend").isNotNull(), cap(F.greatest(F.lit(0.0), c("trend") * 30 + 12), 20)).otherwise(15.0), None),
             ("毛利率", 20, F.when(c("gross_margin") != 0, cap(c("gross_margin") * 0.4, 20)).otherwise(15.0), c("gross_margin")),
             ("退款率", 15, F.greatest(F.lit(0.0), F.lit(15.0) - c("refund_rate") * 1.5), c("refund_rate")),
             ("转化率", 15, cap(c("conversion") * 0.3, 15), c("conversion")),
             ("配送时效", 10, F.greatest(F.lit(0.0), F.lit(10.0) - c("late_rate") * 20), c("late_rate") * 100),
             ("库存周转", 10, cap(F.greatest(F.lit(0.0), c("turnover") * 2), 10), None),
             ("客户活跃度", 10, F.when(c("active") > 0, cap(c("active") / buyer_target * 10, 10)).otherwise(5.0), None)]
    rounded = [round_to(score, 1) for _, _, score, _ in parts]
    total = reduce(lambda a, b: a + b, rounded)
    grade = F.when(total >= 85 - 1e-9, "A").when(total >= 70 - 1e-9, "B").when(total >= 55 - 1e-9, "C").otherwise("D")

    def row(name, weight, score: Column, value, text) -> Column:
        return F.struct(F.lit(name).alias("dimension"), F.lit(weight).alias("weight"), score.alias("score"),
                        (round_to(value, 1) if value is not None else F.lit(None).cast("double")).alias("value"), text.alias("grade"))

    rows = [row(n, w, r, v, F.lit(None).cast("string")) for (n, w, _, v), r in zip(parts, rounded)]
    rows.append(row("total", 100, round_to(total, 1), None, grade))
    return inputs.select(F.inline(F.array(*rows)))


def opportunities(traffic: DataFrame, orders: DataFrame, wide: DataFrame, shipments: DataFrame, refunds: DataFrame,
                  lapsed=("流失客户", "沉睡客户")) -> DataFrame:
    """Derived from the data: best-converting channel with its gmv share, lapsed users, late-delivery refunds."""
    conv = funnel.by_group(traffic, "channel").join(sales.channel_breakdown(orders).select("channel", "share"), "channel", "left")
    best = conv.orderBy(F.desc("conversion"), "channel").limit(1).select(
        F.lit(1).alias("rank"), F.lit("channel_conversion").alias("kind"), F.col("channel").alias("subject"),
        F.col("conversion").alias("value"), F.coalesce("share", F.lit(0.0)).alias("benchmark"))
    gone = F.col("rfm_segment").isin(*lapsed)
    users = wide.agg(F.lit(2).alias("rank"), F.lit("lapsed_customers").alias("kind"), F.lit("+".join(lapsed)).alias("subject"),
                     percent(F.count_if(gone), F.count(F.lit(1))).alias("value"),
                     percent(F.sum(F.when(gone, F.col("monetary"))), F.sum("monetary")).alias("benchmark"))
    late = fulfilment.late_refund_impact(shipments, refunds).select(
        F.lit(3).alias("rank"), F.lit("late_delivery").alias("kind"), F.lit("refund rate late, on time").alias("subject"),
        F.col("delayed_refund_rate").alias("value"), F.col("ontime_refund_rate").alias("benchmark"))
    return best.unionByName(users).unionByName(late)


def risks(orders: DataFrame, ranking: DataFrame, reviews: DataFrame) -> DataFrame:
    """Derived from the data: fall from the peak month, channel with the lowest return, bad reviews."""
    m = (orders.where(is_paid()).groupBy(year_month("order_date").alias("ym")).agg(F.sum("paid_amount").alias("gmv"))
         .agg(F.max("gmv").alias("peak"), F.min_by("ym", F.struct(-F.col("gmv"), "ym")).alias("peak_ym"), F.max_by("gmv", "ym").alias("latest")))
    fall = m.select(F.lit(1).alias("rank"), F.lit("gmv_fall").alias("kind"), F.col("peak_ym").alias("subject"),
                    percent(F.col("latest") - F.col("peak"), "peak").alias("value"), round_to("peak").alias("benchmark"))
    low = ranking.agg(F.lit(2).alias("rank"), F.lit("low_roas_channel").alias("kind"), F.max_by("channel", "rank").alias("subject"),
                      F.max_by("roas", "rank").alias("value"), F.max("roas").alias("benchmark"))
    bad = fulfilment.review_totals(reviews).select(F.lit(3).alias("rank"), F.lit("bad_reviews").alias("kind"), F.lit("rating <= 2").alias("subject"),
                                                   F.col("bad_rate").alias("value"), F.col("total_reviews").cast("double").alias("benchmark"))
    return fall.unionByName(low).unionByName(bad)


def weekly_report(health: DataFrame, metrics: DataFrame, chances: DataFrame, dangers: DataFrame) -> DataFrame:
    """Long table (section, rank, item, value, note) of all parts, ready to be written as a dataset."""
    order = F.row_number().over(W.orderBy(F.desc("weight"), "dimension"))  # eight rows
    h = health.select(F.lit("health").alias("section"), order.alias("rank"), F.col("dimension").alias("item"), F.col("score").alias("value"),
                      F.coalesce("grade", F.lit("")).alias("note"))
    names = [c for c, t in metrics.dtypes]
    m = metrics.select(F.inline(F.array(*[F.struct(F.lit("metrics").alias("section"), F.lit(i + 1).alias("rank"), F.lit(c).alias("item"),
                                                   F.col(c).cast("double").alias("value"), F.lit("").alias("note")) for i, c in enumerate(names)])))
    out = h.unionByName(m)
    for section, df in (("opportunities", chances), ("risks", dangers)):
        out = out.unionByName(df.select(F.lit(section).alias("section"), "rank", F.col("kind").alias("item"), "value",
                                        F.concat_ws(" / ", "subject", F.format_string("%.2f", "benchmark")).alias("note")))
    return out


def action_effect(actions: DataFrame, orders: DataFrame, days: int = 7) -> DataFrame:
    """Mean daily gmv before and after each action day, per action type.

    Actions shrink to distinct (type, day); their days become rows that join the
    daily totals on equality.
    """
    per_day = orders.where(is_paid()).groupBy("order_date").agg(F.sum("paid_amount").alias("g"))
    a = actions.groupBy("action_type", F.to_date("created_at").alias("action_day")).agg(F.count(F.lit(1)).alias("actions"))
    span = a.withColumn("k", F.explode(F.array(*[F.lit(k) for k in range(-days, days + 1) if k])))
    m = span.withColumn("order_date", F.date_add("action_day", F.col("k"))).join(per_day, "order_date", "left")
    part = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("g"))), F.lit(0.0)) / days
    g = m.groupBy("action_type", "action_day", "actions").agg(part(F.col("k") < 0).alias("b"), part(F.col("k") > 0).alias("a"))
    return g.select("action_type", "action_day", "actions", round_to("b").alias("before"), round_to("a").alias("after"),
                    percent(F.col("a") - F.col("b"), "b").alias("change_pct"))


def daily_insights(orders: DataFrame, refunds: DataFrame, traffic: DataFrame, performance: DataFrame, move: float = 0.10,
                   spike: float = 2.0, drop: float = 0.20) -> DataFrame:
    """Rows (day, kind, subject, value): gmv moves, refund spikes, channel conversion drops, low stock.

    Every window runs over day totals, at most one row per day and channel.
    """
    gmv = orders.where(is_paid()).groupBy(F.col("order_date").alias("day")).agg(F.sum("paid_amount").alias("v"))
    by_day = W.orderBy("day")
    change = safe_divide(F.col("v") - F.lag("v").over(by_day), F.lag("v").over(by_day))
    out = gmv.withColumn("c", change).where(F.abs("c") > move).select(
        "day", F.lit("gmv_move").alias("kind"), F.lit("all").alias("subject"), round_to(F.col("c") * 100).alias("value"))
    r = approved(refunds).groupBy(F.col("refund_date").alias("day")).agg(F.count(F.lit(1)).alias("v"))
    usual = F.avg("v").over(by_day.rowsBetween(-7, -1))
    out = out.unionByName(r.withColumn("u", usual).where(F.col("v") > F.col("u") * spike).select(
        "day", F.lit("refund_spike").alias("kind"), F.lit("all").alias("subject"), round_to(F.col("v") / F.col("u")).alias("value")))
    t = funnel.stage_sessions(traffic.withColumnRenamed("event_date", "day"), ["channel", "day"])
    rate = safe_divide(funnel.STAGES[-1], funnel.STAGES[0])
    by_channel = W.partitionBy("channel").orderBy("day")
    t = t.withColumn("c", rate).withColumn("p", F.lag("c").over(by_channel))
    fall = safe_divide(F.col("c") - F.col("p"), "p")
    out = out.unionByName(t.where(fall < -drop).select("day", F.lit("conversion_drop").alias("kind"), F.col("channel").alias("subject"),
                                                       round_to(fall * 100).alias("value")))
    last = scalars(orders, d=F.max("order_date"))["d"]
    low = performance.where(F.col("current_stock") < F.col("total_qty") / 365 * 3)
    return out.unionByName(low.select(last.alias("day"), F.lit("low_stock").alias("kind"), F.col("sku_id").cast("string").alias("subject"),
                                      F.col("current_stock").cast("double").alias("value")))
