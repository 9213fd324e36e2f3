"""RFM segments, cohorts, user profiles and user lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from tillwise.functions.exprs import is_paid, month_diff, percent, round_to
from tillwise.operators.features import last_date

# fixed values: segment, description, strategy, action, suggested coupon
STRATEGIES = (
    ("核心价值", "高频高消费近期活跃，平台最优质客户", "VIP 专属服务 + 新品优先体验 + 高端商品推荐",
     "发高端品专属券，不扰动价格体系", "专属券 9 折，上限 ¥200"),
    ("重要发展", "高频高消费但近期活跃度略低", "大促召回 + 会员升级引导 + 积分激励",
     "发大额满减券，引导升 platinum", "满 ¥500 减 ¥80"),
    ("潜力客户", "近期活跃但消费力待提升", "客单价提升 + 品类拓展 + 首单升级",
     "发跨品类券，推荐高关联商品", "跨品类券 满 ¥200 减 ¥30"),
    ("一般维持", "中等活跃度和消费力", "维持活跃 + 提升频次 + 小额激励",
     "发小额无门槛券，签到积分", "无门槛 ¥10 券"),
    ("一般挽留", "消费力尚可但活跃度下降", "流失预警 + 定向召回 + 大促触达",
     "发限时大额券，push 消息触达", "限时满 ¥300 减 ¥60"),
    ("流失风险", "曾经消费但已长时间未购买", "强召回 + 高折扣 + 首单优惠",
     "发新人级大额券，短信/邮件触达", "大额满 ¥200 减 ¥50"),
    ("沉睡客户", "近期沉默，历史消费一般", "内容唤醒 + 低价爆款 + 限时秒杀",
     "发低价引流品券，参加秒杀活动", "秒杀资格券 + ¥5 无门槛"),
    ("流失客户", "长期未购买或低频低消费", "低成本召回 + 品牌再教育 + 转介绍激励",
     "发极低门槛券，邀请有礼活动", "新人券 满 ¥100 减 ¥30"),
)
DEFAULT_COUPON = "通用 满 ¥100 减 ¥10"
PROFILE_COLUMNS = ("user_id", "name", "province", "member_level", "rfm_segment", "recency", "frequency", "monetary")


def _texts(df: DataFrame) -> DataFrame:
    """Eight fixed rows of segment texts."""
    return df.sparkSession.createDataFrame(
        list(STRATEGIES), "rfm_segment string, description string, strategy string, action string, suggested_coupon string")


def overview(wide: DataFrame) -> DataFrame:
    """Users, gmv, share, means and strategy text per segment."""
    g = wide.groupBy("rfm_segment").agg(
        F.count("user_id").alias("user_count"), F.sum("monetary").alias("gmv"), round_to(F.avg("recency"), 1).alias("avg_recency"),
        round_to(F.avg("frequency"), 1).alias("avg_frequency"), round_to(F.avg("monetary"), 2).alias("avg_monetary"))
    g = g.withColumn("gmv_share", percent("gmv", F.sum("gmv").over(W.partitionBy())))  # one row per segment
    texts = _texts(wide).drop("suggested_coupon")
    out = g.join(F.broadcast(texts), "rfm_segment", "left").fillna("", ["description", "strategy", "action"])
    return out.select(F.col("rfm_segment").alias("segment"), "user_count", round_to("gmv").alias("total_gmv"), "gmv_share",
                      "avg_recency", "avg_frequency", "avg_monetary", "description", "strategy", "action")


def comparison(wide: DataFrame) -> DataFrame:
    return wide.groupBy("rfm_segment").agg(
        F.count("user_id").alias("user_count"), round_to(F.sum("monetary"), 2).alias("total_gmv"),
        round_to(F.avg("monetary"), 4).alias("avg_aov"), round_to(F.avg("frequency"), 4).alias("avg_frequency"),
        round_to(F.avg("recency"), 4).alias("avg_recency"), round_to(F.avg("has_refund"), 4).alias("refund_rate"))


def cohort_retention(users: DataFrame, orders: DataFrame, months: Sequence[int] = (1, 2, 3, 6, 12)) -> DataFrame:
    """Share of each register-month cohort with a paid order in month 1, 2, 3, 6, 12 after it.

    Orders shrink to one row per user and month first, so each later count is a plain sum.
    """
    cohort = users.where(F.col("register_date").isNotNull()).select("user_id", F.trunc("register_date", "month").alias("c"))
    return _retention(cohort, orders, months)


def first_order_retention(orders: DataFrame, months: Sequence[int] = (1, 2, 3, 6, 12)) -> DataFrame:
    """The same with the month of the first paid order as cohort."""
    cohort = (orders.where(is_paid() & F.col("user_id").isNotNull()).groupBy("user_id")
              .agg(F.trunc(F.min("order_date"), "month").alias("c")))
    return _retention(cohort, orders, months)


def _retention(cohort: DataFrame, orders: DataFrame, months: Sequence[int]) -> DataFrame:
    active = (orders.where(is_paid() & F.col("user_id").isNotNull())
              .select("user_id", F.trunc("order_date", "month").alias("m")).distinct())
    diff = month_diff("m", "c")
    per_user = cohort.join(active, "user_id", "left")
    # users are counted once through their own flag row, months through the joined rows
    size = cohort.groupBy("c").agg(F.count("user_id").alias("size"))
    hits = per_user.groupBy("c").agg(*[F.count_if(diff == k).alias(f"month_{k}") for k in months])
    out = size.join(hits, "c")
    return out.select(F.date_format("c", "yyyy-MM").alias("cohort"), "size", *[f"month_{k}" for k in months],
                      *[percent(f"month_{k}", "size").alias(f"retention_{k}") for k in months])


def cohort_heatmap(retention: DataFrame) -> DataFrame:
    """(cohort, month, rate) rows of a retention table."""
    months = [int(c.split("_")[1]) for c in retention.columns if c.startswith("retention_")]
    cells = F.array(*[F.struct(F.lit(k).alias("month"), F.col(f"retention_{k}").alias("rate")) for k in months])
    return retention.select("cohort", F.inline(cells))


def profiles(users: DataFrame, orders: DataFrame, traffic: DataFrame, coupons: DataFrame, refunds: DataFrame,
             user_id=None, top_events: int = 10) -> DataFrame:
    """Profile of every user, or of one: attributes, order summary, top events, coupons, refunds."""
    if user_id is not None:
        users, orders, traffic, coupons, refunds = (d.where(F.col("user_id") == user_id)
                                                    for d in (users, orders, traffic, coupons, refunds))
    o = orders.where(is_paid()).groupBy("user_id").agg(
        F.count("order_id").alias("total_orders"), round_to(F.sum("paid_amount")).alias("total_spent"),
        F.min("order_date").alias("first_order"), F.max("order_date").alias("last_order"))
    # event types are a short coded list, so a user's list of counts is short too
    e = (traffic.where(F.col("user_id").isNotNull()).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
         .groupBy("user_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "event_type"))),
                                         1, top_events).alias("e")))
    text = F.array_join(F.transform("e", lambda x: F.concat(x["event_type"], F.lit("="), (-x["n"]).cast("string"))), ", ")
    c = coupons.groupBy("user_id").agg(F.count(F.lit(1)).alias("coupons_issued"), F.sum("is_used").alias("coupons_used"))
    r = refunds.where(F.col("status") == "approved").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("refund_count"), round_to(F.sum("amount")).alias("refund_amount"))
    out = users
    for part in (o, e.select("user_id", text.alias("top_events")), c, r):
        out = out.join(part, "user_id", "left")
    return out.fillna(0, ["total_orders", "total_spent", "coupons_issued", "coupons_used", "refund_count", "refund_amount"])


def search_users(wide: DataFrame, keyword: str = "", segment: str = "", limit: int = 50) -> DataFrame:
    """First ``limit`` users by id whose name or id matches the pattern."""
    out = wide.select(*PROFILE_COLUMNS)
    if segment:
        out = out.where(F.col("rfm_segment") == segment)
    if keyword:
        out = out.where(F.col("name").rlike(keyword) | F.col("user_id").cast("string").rlike(keyword))
    return out.orderBy("user_id").limit(limit)


def user_list(wide: DataFrame, segment: str = "") -> DataFrame:
    out = wide.select(*PROFILE_COLUMNS)
    return out.where(F.col("rfm_segment") == segment) if segment else out


def coupon_suggestions(wide: DataFrame) -> DataFrame:
    """Users, strategy, action and suggested coupon per segment."""
    g = wide.groupBy("rfm_segment").agg(F.count("user_id").alias("user_count"))
    out = g.join(F.broadcast(_texts(wide)), "rfm_segment", "left")
    return out.select(F.col("rfm_segment").alias("segment"), "user_count", F.coalesce("strategy", F.lit("")).alias("strategy"),
                      F.coalesce("action", F.lit("")).alias("action"),
                      F.coalesce("suggested_coupon", F.lit(DEFAULT_COUPON)).alias("suggested_coupon"))


def top_spenders(users: DataFrame, orders: DataFrame, as_of=None, top_n: int = 100) -> DataFrame:
    """The biggest spenders with recency and frequency."""
    paid = orders.where(is_paid())
    end = as_of or last_date(paid)
    g = paid.groupBy("user_id").agg(F.datediff(F.lit(end).cast("date"), F.max("order_date")).alias("recency_days"),
                                    F.count("order_id").alias("frequency"), round_to(F.sum("paid_amount")).alias("monetary"))
    return (g.join(users.select("user_id", "name", "segment"), "user_id")
            .orderBy(F.desc("monetary"), "user_id").limit(top_n))
