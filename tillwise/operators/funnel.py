"""Conversion funnel, loss points and remarketing lists.

Stages are counted independently per session, as sessions that show the event.
Events are first reduced to one row per (group, session) with a flag per stage,
so no query needs several distinct counts over raw events.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from tillwise.functions.exprs import is_paid, percent, round_to, year_month
from tillwise.functions.scale import scalars

STAGES = ("view_home", "view_product", "add_to_cart", "checkout", "pay_success")


def stage_sessions(traffic: DataFrame, by: Sequence[str] = (), stages: Sequence[str] = STAGES) -> DataFrame:
    """Distinct sessions per stage, optionally per group."""
    hit = traffic.where(F.col("event_type").isin(*stages) & F.col("session_id").isNotNull())
    per_session = hit.groupBy(*by, "session_id").agg(
        *[F.max((F.col("event_type") == s).cast("int")).alias(s) for s in stages])
    return per_session.groupBy(*by).agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in stages])


def overall(traffic: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """One row per stage: sessions, rate from the stage before, overall rate."""
    rows = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(s).alias("stage"), F.col(s).alias("sessions"))
                     for i, s in enumerate(stages)])
    steps = stage_sessions(traffic, stages=stages).select(F.inline(rows))
    by_step = W.orderBy("step")  # one row per stage
    first = F.first("sessions").over(by_step)
    return (steps.withColumn("step_rate", F.when(F.col("step") > 1, percent("sessions", F.lag("sessions").over(by_step))))
            .withColumn("overall_rate", percent("sessions", first)))


def by_group(traffic: DataFrame, group: str, stages: Sequence[str] = STAGES) -> DataFrame:
    g = F.col(group)
    known = traffic.where(g.isNotNull() & (g.cast("string") != ""))
    out = stage_sessions(known, [group], stages)
    # groups that only have other events still appear, with zero stages
    seen = known.select(group).distinct()
    out = seen.join(out, group, "left").fillna(0, list(stages))
    return out.withColumn("conversion", percent(stages[-1], stages[0]))


def by_campaign(traffic: DataFrame, first: int | None = None) -> DataFrame:
    """Every campaign, or the ``first`` smallest campaign ids."""
    out = by_group(traffic, "campaign_id").orderBy("campaign_id")
    return out if first is None else out.limit(first)


def monthly(traffic: DataFrame, start: str = "view_home", cart: str = "add_to_cart", pay: str = "pay_success") -> DataFrame:
    m = stage_sessions(traffic.withColumn("ym", year_month("event_date")), ["ym"], [start, cart, pay])
    base = F.greatest(F.col(start), F.lit(1))
    return m.select("ym", start, cart, pay, round_to(F.col(cart) / base * 100, 4).alias("cart_rate"),
                    round_to(F.col(pay) / base * 100, 4).alias("pay_rate"))


def _leaky_products(traffic: DataFrame, before: str, after: str, names, least: int, top_n: int) -> DataFrame:
    a, b, rate = names
    g = (traffic.where(F.col("sku_id").isNotNull()).groupBy("sku_id")
         .agg(F.count_if(F.col("event_type") == before).alias(a), F.count_if(F.col("event_type") == after).alias(b)))
    ratio = F.try_divide(F.col(b).cast("double"), F.col(a))
    return (g.where(F.col(a) >= least).orderBy(ratio, "sku_id").limit(top_n)
            .withColumn(rate, percent(b, a)))


def many_views_few_carts(traffic: DataFrame, top_n: int = 20, least: int = 10) -> DataFrame:
    return _leaky_products(traffic, "view_product", "add_to_cart", ("views", "carts", "cart_rate"), least, top_n)


def many_carts_few_checkouts(traffic: DataFrame, top_n: int = 20, least: int = 5) -> DataFrame:
    return _leaky_products(traffic, "add_to_cart", "checkout", ("carts", "checkouts", "checkout_rate"), least, top_n)


def drop_offs(traffic: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """Loss per step; ``biggest`` marks the first step with the largest loss."""
    by_step = W.orderBy("step")
    steps = (overall(traffic, stages).withColumn("from_stage", F.lag("stage").over(by_step))
             .withColumn("before", F.lag("sessions").over(by_step)).where(F.col("step") > 1)
             .withColumn("loss", F.col("before") - F.col("sessions")))
    best = F.row_number().over(W.orderBy(F.desc("loss"), "step"))
    return steps.select("step", "from_stage", F.col("stage").alias("to_stage"), "loss",
                        percent("loss", "before").alias("loss_rate"), (best == 1).cast("int").alias("biggest"))


def latest_event_date(traffic: DataFrame) -> DataFrame:
    return traffic.agg(F.max("event_date").alias("max_date"))


def _without_order(traffic: DataFrame, orders: DataFrame, events: Sequence[str], days: int, own_cutoff: bool,
                   any_status: bool = False, limit: int | None = None) -> DataFrame:
    """Users with one of ``events`` in the last ``days`` and no order since.

    Both cut-offs come from the latest event date; ``own_cutoff`` takes the order
    one from the latest order instead, for sources whose periods differ.
    Anonymous events are left out. Both sides are distinct users before the join.
    """
    since = F.date_sub(scalars(traffic, d=F.max("event_date"))["d"], days)
    orders_since = F.date_sub(scalars(orders, d=F.max("order_date"))["d"], days) if own_cutoff else since
    active = (traffic.where((F.col("event_date") >= since) & F.col("event_type").isin(*events)
                            & F.col("user_id").isNotNull()).select("user_id").distinct())
    bought = orders.where(F.col("order_date") >= orders_since)
    bought = (bought if any_status else bought.where(is_paid())).select("user_id").distinct()
    out = active.join(bought, "user_id", "left_anti")
    return out.orderBy("user_id").limit(limit) if limit else out


def browsed_without_order(traffic, orders, days=90, own_cutoff=False, limit=None) -> DataFrame:
    return _without_order(traffic, orders, ("view_product", "add_to_cart"), days, own_cutoff, limit=limit)


def cart_abandoners(traffic, orders, days=90, own_cutoff=False, limit=None) -> DataFrame:
    return _without_order(traffic, orders, ("add_to_cart",), days, own_cutoff, limit=limit)


def checkout_abandoners(traffic, orders, days=90, own_cutoff=False, limit=None) -> DataFrame:
    return _without_order(traffic, orders, ("checkout",), days, own_cutoff, any_status=True, limit=limit)


def remarketing_list(traffic, orders, days=90, own_cutoff=False) -> DataFrame:
    parts = {"browse_no_order": browsed_without_order, "cart_abandon": cart_abandoners,
             "checkout_abandon": checkout_abandoners}
    out = None
    for reason, fn in parts.items():
        one = fn(traffic, orders, days, own_cutoff).withColumn("reason", F.lit(reason))
        out = one if out is None else out.unionByName(one)
    return out


# ---- session views --------------------------------------------------------------------
def by_category(traffic: DataFrame, products: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """Funnel per category of the viewed SKU. Events shrink to (SKU, session, stage) before the join."""
    seen = (traffic.where(F.col("sku_id").isNotNull() & F.col("event_type").isin(*stages))
            .select("sku_id", "session_id", "event_type").distinct())
    named = seen.join(products.select("sku_id", "category_name"), "sku_id")
    return stage_sessions(named, ["category_name"], stages).withColumn("conversion", percent(stages[-1], stages[0]))


def sequential(traffic: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """Sessions that reach each stage in order: each stage by its first event at or after the one matched for the stage before.

    Taking the earliest event that fits leaves the most room for the stages to come, so no later choice could reach further.
    Each event is read for its own stage only and meets one row of its session; minima are formed before the shuffle.
    """
    matched, counts = None, []
    for i, stage in enumerate(stages):
        events = traffic.where((F.col("event_type") == stage) & F.col("session_id").isNotNull()).select("session_id", "created_at")
        if matched is not None:
            events = events.join(matched, "session_id").where(F.col("created_at") >= F.col("at")).drop("at")
        matched = events.groupBy("session_id").agg(F.min("created_at").alias("at"))
        counts.append(matched.agg(F.count("at").alias("sessions")).select(F.lit(i + 1).alias("step"), F.lit(stage).alias("stage"), "sessions"))
    return reduce(DataFrame.unionByName, counts)


def abandoned_checkouts(traffic: DataFrame) -> DataFrame:
    """Sessions with a checkout and no payment, with last visit and cart adds."""
    has = lambda e: F.count_if(F.col("event_type") == e)
    g = traffic.where(F.col("session_id").isNotNull()).groupBy("session_id").agg(
        F.max("user_id").alias("user_id"), F.max("created_at").alias("last_seen"), has("add_to_cart").alias("cart_adds"),
        has("checkout").alias("checkouts"), has("pay_success").alias("payments"))
    return g.where((F.col("checkouts") > 0) & (F.col("payments") == 0)).drop("payments")


def unconverted_sessions(traffic: DataFrame, products: DataFrame) -> DataFrame:
    """Sessions without payment: last visit, value of SKUs put in the cart, categories seen."""
    paid = traffic.where(F.col("event_type") == "pay_success").select("session_id").distinct()
    per_sku = (traffic.where(F.col("session_id").isNotNull()).join(paid, "session_id", "left_anti").groupBy("session_id", "sku_id")
               .agg(F.max("created_at").alias("last_seen"), F.count_if(F.col("event_type") == "add_to_cart").alias("adds")))
    m = per_sku.join(products.select("sku_id", "price", "category_name"), "sku_id", "left")
    by_category_ = m.groupBy("session_id", "category_name").agg(F.max("last_seen").alias("l"), F.sum(F.col("adds") * F.col("price")).alias("v"))
    return by_category_.groupBy("session_id").agg(F.max("l").alias("last_seen"), round_to(F.coalesce(F.sum("v"), F.lit(0.0))).alias("cart_value"),
                                                  F.count("category_name").alias("categories"))
