"""Campaign, coupon and channel returns, campaign increment, budget moves."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tillwise.functions.exprs import is_paid, percent, round_to, safe_divide


def campaign_kpis(campaigns: DataFrame, ads: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per campaign. A ratio with base 0 is 0."""
    spent = ads.groupBy("campaign_id").agg(F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
                                           F.sum("conversions").alias("conversions"), F.sum("spend_amount").alias("spend"))
    sold = (orders.where(is_paid() & F.col("campaign_id").isNotNull()).groupBy("campaign_id")
            .agg(F.sum("paid_amount").alias("gmv")))
    m = (campaigns.join(spent, "campaign_id", "left").join(sold, "campaign_id", "left")
         .fillna(0, ["impressions", "clicks", "conversions", "spend", "gmv"]))
    c = F.col
    return m.select(
        "campaign_id", "name", "channel", "impressions", "clicks", "conversions", round_to("spend", 4).alias("spend"),
        round_to("gmv", 2).alias("gmv"), percent("clicks", "impressions").alias("ctr"),
        percent("conversions", "clicks").alias("cvr"), round_to(safe_divide("spend", "clicks")).alias("cpc"),
        round_to(safe_divide("spend", "impressions") * 1000).alias("cpm"),
        round_to(safe_divide("spend", "conversions")).alias("cpa"), round_to(safe_divide("gmv", "spend")).alias("roas"),
        round_to(safe_divide(c("gmv") - c("spend"), "spend") * 100, 1).alias("roi"))


def channel_summary(kpis: DataFrame) -> DataFrame:
    return (kpis.groupBy("channel").agg(F.count("campaign_id").alias("campaigns"), F.sum("spend").alias("s"),
                                        F.sum("gmv").alias("g"))
            .select("channel", "campaigns", round_to("s").alias("total_spend"), round_to("g").alias("total_gmv"),
                    round_to(safe_divide("g", "s")).alias("roas")))


def campaign_totals(kpis: DataFrame) -> DataFrame:
    return kpis.agg(round_to(F.sum("spend")).alias("total_spend"), round_to(F.sum("gmv")).alias("total_gmv"),
                    round_to(safe_divide(F.sum("gmv"), F.sum("spend"))).alias("overall_roas"))


def coupon_returns(coupons: DataFrame, user_coupons: DataFrame, orders: DataFrame) -> DataFrame:
    """Redemption, gmv of orders paid with the coupon, cost and return per template."""
    used = user_coupons.where(F.col("used_at").isNotNull()).select("coupon_id", "order_id")
    gmv = (used.join(orders.where(is_paid()).select("order_id", "paid_amount"), "order_id")
           .groupBy("coupon_id").agg(F.sum("paid_amount").alias("gmv")))
    m = coupons.join(gmv, "coupon_id", "left").fillna(0, ["gmv"]).withColumn(
        "coupon_cost", F.col("used_count") * F.col("discount"))
    return m.select("coupon_id", "name", "campaign_id", "threshold", "discount", F.col("issued_count").alias("issued"),
                    F.col("used_count").alias("redeemed"), round_to("gmv").alias("gmv"),
                    percent("used_count", "issued_count").alias("redemption_rate"),
                    round_to("coupon_cost").alias("coupon_cost"), round_to(safe_divide("gmv", "coupon_cost")).alias("roas"))


def coupon_totals(returns: DataFrame) -> DataFrame:
    return returns.agg(F.sum("issued").alias("total_issued"), F.sum("redeemed").alias("total_redeemed"),
                       percent(F.sum("redeemed"), F.sum("issued")).alias("overall_rate"))


def coupon_affinity(user_coupons: DataFrame, threshold: float = 0.5, low: float = 0.2, least: int = 3) -> DataFrame:
    """Users with at least ``least`` coupons, marked sensitive, insensitive or neutral."""
    rate = F.col("used") / F.col("issued")
    return (user_coupons.groupBy("user_id").agg(F.count("used_at").alias("used"), F.count(F.lit(1)).alias("issued"))
            .where(F.col("issued") >= least)
            .select("user_id", "used", "issued", round_to(rate, 4).alias("use_rate"),
                    F.when(rate >= threshold, "sensitive").when(rate < low, "insensitive").otherwise("neutral").alias("kind")))


def coupon_affinity_totals(affinity: DataFrame) -> DataFrame:
    return affinity.agg(F.count_if(F.col("kind") == "sensitive").alias("sensitive_users"),
                        F.count_if(F.col("kind") == "insensitive").alias("insensitive_users"))


def increment(campaigns: DataFrame, orders: DataFrame) -> DataFrame:
    """Campaign sales minus the mean daily sales of all other orders in its dates times its days.

    The date range becomes one row per campaign day, so both lookups are equi
    joins on day totals; a day's other orders are its total minus the campaign's own.
    """
    paid = orders.where(is_paid())
    per_day = paid.groupBy("order_date").agg(F.sum("paid_amount").alias("day_gmv"), F.count(F.lit(1)).alias("day_n"))
    own = (paid.where(F.col("campaign_id").isNotNull()).groupBy("campaign_id", "order_date")
           .agg(F.sum("paid_amount").alias("own_gmv"), F.count(F.lit(1)).alias("own_n")))
    test = own.groupBy("campaign_id").agg(F.sum("own_gmv").alias("test_gmv"))
    camps = campaigns.where(F.col("has_control_group") == 1)
    days = camps.select("campaign_id", F.explode(F.sequence("start_date", "end_date")).alias("order_date"))
    others = (days.join(per_day, "order_date").join(own, ["campaign_id", "order_date"], "left")
              .fillna(0, ["own_gmv", "own_n"]).where(F.col("day_n") > F.col("own_n"))
              .groupBy("campaign_id").agg(F.avg(F.col("day_gmv") - F.col("own_gmv")).alias("control_daily")))
    n_days = F.greatest(F.datediff("end_date", "start_date") + 1, F.lit(1))
    m = (camps.join(test, "campaign_id", "left").join(others, "campaign_id", "left")
         .fillna(0, ["test_gmv", "control_daily"]).withColumn("control", F.col("control_daily") * n_days))
    gain = F.col("test_gmv") - F.col("control")
    return m.select("campaign_id", F.col("name").alias("campaign_name"), "channel", round_to("test_gmv").alias("test_gmv"),
                    round_to("control").alias("estimated_control_gmv"), round_to(gain).alias("increment"),
                    round_to(gain / (F.col("control") + 1) * 100, 1).alias("increment_pct"),
                    F.coalesce("budget", F.lit(0.0)).alias("budget"))


def channel_ranking(ads: DataFrame, orders: DataFrame) -> DataFrame:
    """Channels by return, with what to do: the best two up, the next two keep, the last two down."""
    per_campaign = ads.groupBy("channel", "campaign_id").agg(F.sum("spend_amount").alias("spend"))
    spent = per_campaign.groupBy("channel").agg(F.sum("spend").alias("spend"), F.count("campaign_id").alias("campaigns"))
    sold = (orders.where(is_paid() & F.col("campaign_id").isNotNull()).groupBy("channel")
            .agg(F.sum("paid_amount").alias("gmv")))
    m = spent.join(sold, "channel", "left").fillna(0, ["gmv"]).withColumn("roas", round_to(safe_divide("gmv", "spend")))
    rank = F.row_number().over(W.orderBy(F.desc("roas"), "channel"))  # one row per channel
    n = F.count(F.lit(1)).over(W.partitionBy())
    m = m.withColumn("rank", rank).withColumn("n", n)
    flag = lambda cond: cond.cast("int")
    return m.select("channel", round_to("spend").alias("spend"), "campaigns", round_to("gmv").alias("gmv"), "roas", "rank",
                    flag((F.col("n") >= 2) & (F.col("rank") <= 2)).alias("increase"),
                    flag((F.col("n") >= 4) & F.col("rank").between(3, 4)).alias("maintain"),
                    flag((F.col("n") >= 2) & (F.col("rank") > F.col("n") - 2)).alias("decrease"))


def budget_move(ranking: DataFrame, migrate_pct: float = 20.0) -> DataFrame:
    """Gain from moving part of all spend from the worst channel to the best."""
    r = ranking.agg(F.sum("spend").alias("total"), F.max_by("roas", -F.col("rank")).alias("best"),
                    F.max_by("roas", "rank").alias("worst"), F.count(F.lit(1)).alias("n"))
    moved = F.when(F.col("n") >= 2, F.col("total") * migrate_pct / 100).otherwise(F.lit(0.0))
    return r.select(round_to("total").alias("total_spend"), F.lit(float(migrate_pct)).alias("migrate_pct"),
                    round_to(moved).alias("migrated_amount"),
                    round_to(moved * (F.col("best") - F.col("worst"))).alias("estimated_gain"))


def before_and_during(campaigns: DataFrame, orders: DataFrame) -> DataFrame:
    """Campaigns without control group: mean daily gmv in their dates against as many days before."""
    per_day = orders.where(is_paid()).groupBy("order_date").agg(F.sum("paid_amount").alias("g"))
    c = campaigns.where(F.col("has_control_group") == 0).withColumn("n", F.datediff("end_date", "start_date") + 1)
    days = c.select("campaign_id", "start_date", "n", F.explode(
        F.sequence(F.expr("date_sub(start_date, n)"), "end_date")).alias("order_date"))
    during = F.col("order_date") >= F.col("start_date")
    g = (days.join(per_day, "order_date", "left").groupBy("campaign_id")
         .agg(F.coalesce(F.sum(F.when(~during, F.col("g"))), F.lit(0.0)).alias("b"),
              F.coalesce(F.sum(F.when(during, F.col("g"))), F.lit(0.0)).alias("d"), F.max("n").alias("n")))
    return g.select("campaign_id", round_to(F.col("b") / F.col("n")).alias("daily_before"), round_to(F.col("d") / F.col("n")).alias("daily_during"),
                    percent(F.col("d") - F.col("b"), "b").alias("change_pct"))
