"""Several operators over one shop as named frames, each still lazy."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillwise.operators import funnel, sales
from tillwise.plans.star import Shop


def cockpit(s: Shop) -> dict[str, DataFrame]:
    return {"kpi": sales.headline(s.fact_order, s.sales_lines, s.fact_refund, s.fact_traffic),
            "monthly_trends": sales.monthly_trend(s.fact_order), "channel_breakdown": sales.channel_breakdown(s.fact_order),
            "category_breakdown": sales.category_breakdown(s.sales_lines, s.dim_product),
            "member_contribution": sales.member_contribution(s.fact_order, s.dim_user),
            "top_bottom_products": sales.top_bottom_products(s.sales_lines, s.dim_product),
            "mom_changes": sales.latest_month_change(s.fact_order), "anomalies": sales.anomaly_months(s.fact_order)}


def funnel_report(s: Shop) -> dict[str, DataFrame]:
    t = s.fact_traffic
    return {"funnel": funnel.overall(t), "by_channel": funnel.by_group(t, "channel"), "by_device": funnel.by_group(t, "device"),
            "by_campaign": funnel.by_campaign(t), "monthly_trend": funnel.monthly(t), "drop_offs": funnel.drop_offs(t),
            "high_exposure_low_cart": funnel.many_views_few_carts(t), "high_cart_low_checkout": funnel.many_carts_few_checkouts(t),
            "remarketing": funnel.remarketing_list(t, s.fact_order)}
