"""Headline queries, timed: prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

from __future__ import annotations

import json
import os
import time

from checks import spark_queries
from tillwise.session import get_session

HEADLINE = ("f01_headline_kpis", "f04_monthly_trend", "f05_channel_breakdown", "f06_category_breakdown", "f08_top_bottom_products",
            "b14_daily_business_summary", "g01_overall_funnel", "g02_funnel_by_channel", "g12_remarketing_list", "h02_cohort_retention",
            "e03_rfm_segments", "e07_category_features", "e12_product_wide_table", "k05_association_rules_cat", "l02_category_series",
            "l15_safety_stock", "m01_campaign_kpis", "m04_campaign_increment", "n03_late_refund_impact", "n06_top_refunded_skus",
            "o01_sku_performance", "o03_abc_matrix", "p01_health_score", "c09_header_against_lines", "d13_quantiles")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", master=f"local[{cpus}]", partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    queries = spark_queries()
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()  # start the engine
    times: dict[str, float] = {}
    for name in HEADLINE:
        begin = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
