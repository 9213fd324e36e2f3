"""Hand-made frames, one per decision that differs from a naive reading."""

import datetime as dt
import math
import random

import pytest

from tillwise.functions import exprs as x
from tillwise.functions.scale import exact_quantiles, running_totals
from tillwise.operators import (baskets, cleaning, clusters, experiments, features, forecast, funnel, inventory, marketing, propensity,
                                quality, sales, segments)
from pyspark.sql import functions as F

D = dt.date


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def orders(spark, data):
    """(order_id, user_id, campaign_id, order_date, status, paid_amount)"""
    return spark.createDataFrame(data, "order_id long, user_id long, campaign_id string, order_date date, status string, paid_amount double").withColumn("channel", F.lit("search"))


def test_rfm_tied_edges_merge_bins(spark):
    base = spark.createDataFrame([(i, 5 if i < 8 else 9, 1, float(i)) for i in range(10)], "user_id long, recency int, frequency long, monetary double")
    got = features.rfm_scores(base)
    assert {r["F_score"] for r in got.collect()} == {1}
    assert all(0 <= r["R_score"] <= 4 for r in got.collect())
    assert sorted(r["M_score"] for r in got.collect()) == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    assert {r["R_score"] for r in features.rfm_scores(base, one_to_five=True).collect()} <= {1, 2, 3, 4, 5}


def test_stock_signs(spark):
    m = spark.createDataFrame([(1, "in", 100), (1, "out", -30), (1, "out", -5)], "sku_id long, movement_type string, quantity long")
    assert m.agg(x.stock()).first()[0] == 65
    assert m.agg(x.stock(raw_sign=True)).first()[0] == 135
    assert inventory.stock_levels(m).first()["current_stock"] == 65


def test_anti_join_leaves_out_anonymous(spark):
    t = spark.createDataFrame([(1, "s1", "view_product", D(2024, 1, 5)), (2, "s2", "view_product", D(2024, 1, 5)), (None, "s3", "view_product", D(2024, 1, 5))],
                              "user_id long, session_id string, event_type string, event_date date")
    o = orders(spark, [(1, 2, None, D(2024, 1, 4), "paid", 10.0)])
    assert [r[0] for r in funnel.browsed_without_order(t, o).collect()] == [1]


def test_zero_spend_gives_zero_ratios(spark):
    c = spark.createDataFrame([("c1", "C", "search")], "campaign_id string, name string, channel string")
    a = spark.createDataFrame([("c1", 0, 0, 0, 0.0)], "campaign_id string, impressions long, clicks long, conversions long, spend_amount double")
    k = marketing.campaign_kpis(c, a, orders(spark, [(1, 1, "c1", D(2024, 1, 1), "paid", 50.0)])).first()
    assert [k[n] for n in ("ctr", "cvr", "cpc", "cpm", "cpa", "roas", "roi")] == [0.0] * 7 and k["gmv"] == 50.0


def test_abc_single_large_item_and_ties(spark):
    df = spark.createDataFrame([(1, 80.0), (2, 15.0), (3, 5.0)], "sku_id long, v double")
    assert rows(inventory.abc_classify(df, "v", "v"), "sku_id", "abc_v") == [(1, "B"), (2, "C"), (3, "C")]
    tied = spark.createDataFrame([(i, 10.0) for i in range(10)], "sku_id long, v double")
    got = dict(rows(inventory.abc_classify(tied, "v", "v"), "sku_id", "abc_v"))
    assert [got[i] for i in range(10)] == ["A"] * 7 + ["B"] * 2 + ["C"]


def test_features_do_not_see_the_label_period(spark):
    users = spark.createDataFrame([(1, "a", "p", "c", "r", "s", "F", 1990, "vip", "active", D(2024, 1, 1))],
                                  "user_id long, name string, province string, city string, register_channel string, segment string, gender string, birth_year int, member_level string, status string, register_date date")
    early = [(1, 1, None, D(2024, 1, 10), "paid", 10.0), (2, 1, None, D(2024, 2, 10), "paid", 20.0)]
    late = early + [(3, 1, None, D(2024, 6, 10), "paid", 99.0)]
    lines = spark.createDataFrame([(1, 1, 7, D(2024, 1, 10), 5.0)], "order_id long, user_id long, sku_id long, order_date date, unit_price double")
    traffic = spark.createDataFrame([(1, "s", "view_home", "mobile", D(2024, 1, 9))], "user_id long, session_id string, event_type string, device string, event_date date")
    coupons = spark.createDataFrame([(1, 1, D(2024, 1, 1), D(2024, 6, 1), 5.0, 1)], "user_coupon_id long, user_id long, issued_date date, used_date date, discount double, is_used int")
    refunds = spark.createDataFrame([(1, 1, D(2024, 6, 1))], "refund_id long, user_id long, refund_date date")
    products = spark.createDataFrame([(7, "cat", 5.0)], "sku_id long, category_name string, price double")
    a, b = (propensity.features_until(users, orders(spark, o), lines, traffic, coupons, refunds, products, "2024-03-01").first() for o in (early, late))
    assert a == b and a["frequency"] == 2 and a["coupons_used_count"] == 0 and a["has_refund"] == 0


def test_user_without_orders(spark):
    users = spark.createDataFrame([(1, "a", "p", "c", "r", "s", None, None, "vip", "active", None), (2, "b", "p", "c", "r", "s", "M", 1980, "vip", "active", None)],
                                  "user_id long, name string, province string, city string, register_channel string, segment string, gender string, birth_year int, member_level string, status string, register_date date")
    o = orders(spark, [(1, 2, None, D(2024, 1, 10), "paid", 10.0)])
    empty = lambda ddl: spark.createDataFrame([], ddl)
    w = features.user_wide(users, o, empty("order_id long, user_id long, sku_id long, order_date date, unit_price double"),
                           empty("user_id long, session_id string, event_type string, device string, event_date date"),
                           empty("user_coupon_id long, user_id long, issued_date date, used_date date, discount double, is_used int"),
                           empty("refund_id long, user_id long, refund_date date"), empty("sku_id long, category_name string, price double"), as_of=D(2024, 1, 31),
                           traffic_as_of=D(2024, 1, 31))
    r = w.where("user_id = 1").first()
    assert r["rfm_segment"] == features.NO_ORDERS and r["monetary"] == 0 and r["gender"] == "unknown" and r["birth_year"] is None
    assert features.wide_check(w, users).first() == (2, 2, 2)


def test_price_band_edges(spark):
    df = spark.createDataFrame([(99.99,), (100.0,), (500.0,), (500.01,)], "p double")
    assert [r[0] for r in df.select(x.price_band("p")).collect()] == ["low", "mid", "high", "high"]
    assert [r[0] for r in df.select(x.price_band("p", high_inclusive=True)).collect()] == ["low", "mid", "mid", "high"]


def test_month_gap(spark):
    o = orders(spark, [(1, 1, None, D(2024, 1, 3), "paid", 100.0), (2, 1, None, D(2024, 3, 3), "paid", 150.0)])
    got = {r["ym"]: r["gmv_mom"] for r in sales.monthly_trend(o).collect()}
    assert got == {"2024-01": None, "2024-03": 0.5}
    cal = {r["ym"]: r["mom"] for r in sales.calendar_growth(o).collect()}
    assert cal == {"2024-01": None, "2024-02": -1.0, "2024-03": None}


def test_series_gap_and_centred_edges(spark):
    d = spark.createDataFrame([("a", D(2024, 1, 1), 1.0), ("a", D(2024, 1, 4), 4.0), ("a", D(2024, 1, 5), 7.0)], "series string, day date, y double")
    full = forecast.fill_days(d)
    assert [r["y"] for r in full.orderBy("day").collect()] == [1.0, 0.0, 0.0, 4.0, 7.0]
    got = [r["m"] for r in forecast.centred_average(full, 3, "m").orderBy("day").collect()]
    assert got[0] is None and got[-1] is None and got[2] == pytest.approx(4 / 3)


def test_exponential_smoothing_matches_recursion(spark):
    ys = [3.0, 8.0, 1.0, 4.0, 9.0]
    d = spark.createDataFrame([("a", D(2024, 1, i + 1), y) for i, y in enumerate(ys)], "series string, day date, y double")
    s = ys[0]
    for y in ys[1:]:
        s = 0.3 * y + 0.7 * s
    assert forecast.exponential_smoothing(d, 1).first()["forecast"] == pytest.approx(s)


def test_rules_cover_every_split(spark):
    b = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a", "b", "c"]), (3, ["a", "b"]), (4, ["c"]), (5, ["a"])], "order_id long, items array<string>")
    sets = {tuple(r["items"]): r["n"] for r in baskets.frequent_itemsets(b, 0.3).collect()}
    assert sets == {("a",): 4, ("b",): 3, ("c",): 3, ("a", "b"): 3, ("a", "c"): 2, ("b", "c"): 2, ("a", "b", "c"): 2}
    rules = {(tuple(r["antecedents"]), tuple(r["consequents"])): r["confidence"] for r in baskets.association_rules(baskets.frequent_itemsets(b, 0.3), 0.0, 0.0).collect()}
    assert len(rules) == 12 and rules[("a",), ("b", "c")] == 0.5 and rules[("b", "c"), ("a",)] == 1.0


def test_funnel_counts_sessions_once(spark):
    t = spark.createDataFrame([(1, "s1", "view_home")] * 3 + [(1, "s1", "pay_success")], "user_id long, session_id string, event_type string")
    got = {r["stage"]: r["sessions"] for r in funnel.overall(t).collect()}
    assert got["view_home"] == 1 and got["pay_success"] == 1 and got["checkout"] == 0


def test_quantiles_with_a_hot_value(spark):
    rng = random.Random(3)
    values = [7.0] * 400 + [round(rng.random() * 100, 3) for _ in range(800)] + [None] * 5
    df = spark.createDataFrame([(v,) for v in values], "v double")
    known = sorted(v for v in values if v is not None)
    for p in (0.0, 0.1, 0.25, 0.5, 0.77, 1.0):
        k = p * (len(known) - 1)
        expect = known[math.floor(k)] + (known[math.ceil(k)] - known[math.floor(k)]) * (k - math.floor(k))
        assert exact_quantiles(df, ["v"], [p])["v", p] == pytest.approx(expect)
    assert exact_quantiles(df.where("v < 0"), ["v"], [0.5])["v", 0.5] is None


def test_running_totals_over_ties(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("v"))
    got = running_totals(df, [F.desc("v"), F.asc("id")], c=F.col("v")).collect()
    expect, total = {}, 0
    for i, v in sorted(((r["id"], r["v"]) for r in got), key=lambda t: (-t[1], t[0])):
        total += v
        expect[i] = total
    assert {r["id"]: r["c"] for r in got} == expect and {r["total_c"] for r in got} == {total}


def test_planted_quality_defects(spark):
    o = spark.createDataFrame([(1, 1, -5.0, 1.0, 1.0, "paid"), (1, 9, 30.0, 1.0, 10.0, "paid")], "order_id long, user_id long, paid_amount double, subtotal double, total_amount double, status string")
    users = spark.createDataFrame([(1,)], "user_id long")
    st = lambda df: [r["status"] for r in df.collect()]
    assert st(quality.negative_amounts(o)) == ["fail", "pass"]
    assert st(quality.uniqueness({"orders": o}, {"orders": "order_id"})) == ["fail"]
    assert st(quality.orphans({"orders": o, "users": users}, [("orders", "user_id", "users", "user_id")])) == ["fail"]
    bad = quality.amount_anomalies(o).first()
    assert bad["status"] == "fail" and bad["metrics"]["paid_over_total"] == "1"


def test_auc_and_top_share(spark):
    s = spark.createDataFrame([(1, 1, 0.9), (2, 0, 0.9), (3, 1, 0.4), (4, 0, 0.1)], "user_id long, label int, score double")
    assert propensity.metrics(s).first()["auc"] == pytest.approx((0.5 + 1 + 0 + 1) / 4)
    assert rows(propensity.confusion_matrix(s), "label", "predicted_0", "predicted_1") == [(0, 1, 1), (1, 1, 1)]


def test_model_finds_a_planted_signal(spark):
    w = spark.range(400).select(F.col("id").alias("user_id"), (F.col("id") % 10).cast("double").alias("f"), F.rand(1).alias("noise"))
    y = w.select("user_id", (F.col("f") > 5).cast("int").alias("label"))
    out = propensity.run(w, y, trees=5, rounds=3, columns=["f", "noise"])
    assert all(r["auc"] > 0.95 for r in out["report"].collect())
    assert out["importance"].first()["feature"] == "f"


def test_density_clusters_match_components(spark):
    rng = random.Random(5)
    blobs = [(cx + rng.gauss(0, 0.1), cy + rng.gauss(0, 0.1)) for cx, cy in ((0, 0), (10, 10)) for _ in range(60)] + [(50.0, -50.0)]
    df = spark.createDataFrame([(i, [float(a), float(b)]) for i, (a, b) in enumerate(blobs)], "id long, x array<double>")
    got = {r["id"]: r["cluster"] for r in clusters.density(df, "id", "x", eps=1.5, min_points=10).collect()}
    assert len({got[i] for i in range(60)}) == 1 and len({got[i] for i in range(60, 120)}) == 1
    assert got[0] != got[60] and got[120] == -1


def test_robust_outlier(spark):
    df = spark.createDataFrame([(i, float(i % 5)) for i in range(50)] + [(99, 1000.0)], "id long, v double")
    assert [r["id"] for r in experiments.robust_outliers(df, ["v"], "id").where("is_outlier").collect()] == [99]


def test_isolation_scores_follow_the_trees(spark):
    rng = random.Random(7)
    points = [(i, rng.gauss(0, 1), rng.gauss(5, 2), None if i % 9 == 0 else 1.0) for i in range(700)] + [(900, 40.0, 5.0, 1.0), (901, 0.0, -60.0, 1.0)]
    df = spark.createDataFrame(points, "id long, a double, b double, c double").repartition(5)
    got = {r["id"]: r["outlier_score"] for r in experiments.isolation_scores(df, ["a", "b", "c"], "id", trees=20, sample=32).collect()}
    assert got == {r["id"]: r["outlier_score"] for r in experiments.isolation_scores(df.repartition(2), ["a", "b", "c"], "id", trees=20, sample=32).collect()}
    hashed = df.selectExpr("xxhash64(42, id) AS h", "array(a, b, coalesce(c, 0D)) AS x").orderBy("h").limit(640).collect()
    forest = experiments.grow_forest([r["x"] for r in hashed], 20, 32)

    def plain(x):
        total = 0.0
        for column, cut, length in zip(*forest):
            node = 0
            while column[node] >= 0:
                node = 2 * node + (1 if x[column[node]] < cut[node] else 2)
            total += length[node]
        return 2 ** (-total / 20 / experiments.mean_depth(32))

    assert all(abs(got[i] - plain((a, b, c or 0.0))) < 1e-6 for i, a, b, c in points) and len(got) == 702
    two = {r["id"]: r["outlier_score"] for r in experiments.isolation_scores(df, ["a", "b"], "id").collect()}
    assert set(sorted(two, key=two.get)[-2:]) == {900, 901}
    assert experiments.isolation_scores(df.where("false"), ["a"], "id", trees=5).count() == 0
    flat = experiments.isolation_scores(spark.range(30).selectExpr("id", "1D AS v"), ["v"], "id", trees=4, sample=8).select("outlier_score").distinct().collect()
    assert [r[0] for r in flat] == [0.5]


def test_sequential_funnel_takes_later_events_too(spark):
    t = lambda m: dt.datetime(2024, 1, 1, 0, m)
    stages = ("view_home", "view_product", "add_to_cart", "checkout", "pay_success")
    whole = [("s1", e, t(i)) for i, e in enumerate(stages)]
    early = [("s2", "checkout", t(0)), ("s2", "pay_success", t(1))] + [("s2", e, t(5 + i)) for i, e in enumerate(stages)]  # first times are not in order
    back = [("s3", e, t(9 - i)) for i, e in enumerate(stages)]
    same = [("s4", e, t(3)) for e in stages[:3]]
    df = spark.createDataFrame(whole + early + back + same + [(None, "view_home", t(1))], "session_id string, event_type string, created_at timestamp")
    assert [(r["step"], r["stage"], r["sessions"]) for r in funnel.sequential(df).collect()] == [
        (1, "view_home", 4), (2, "view_product", 3), (3, "add_to_cart", 3), (4, "checkout", 2), (5, "pay_success", 2)]


def test_missing_values_by_type(spark):
    df = spark.createDataFrame([(1.0, "a"), (3.0, "b"), (None, "b"), (9.0, None)], "n double, t string")
    assert rows(cleaning.handle_missing(df), "n", "t") == [(1.0, "a"), (3.0, "b"), (3.0, "b"), (9.0, "b")]
    assert cleaning.handle_missing(df, "drop").count() == 2


def test_retention_counts_users_once(spark):
    users = spark.createDataFrame([(1, D(2024, 1, 5)), (2, D(2024, 1, 9))], "user_id long, register_date date")
    o = orders(spark, [(1, 1, None, D(2024, 2, 3), "paid", 1.0), (2, 1, None, D(2024, 2, 9), "paid", 1.0), (3, 2, None, D(2024, 4, 1), "refunded", 1.0)])
    r = segments.cohort_retention(users, o).first()
    assert (r["size"], r["month_1"], r["retention_1"], r["month_3"]) == (2, 1, 50.0, 0)


def test_rounding_happens_once(spark):
    rows = spark.createDataFrame([(2.344996,), (0.004951,), (2.675,), (-2.345,), (0.1 + 0.2,)], "v double")
    assert [r[0] for r in rows.select(x.round_to("v")).collect()] == [2.34, 0.0, 2.68, -2.35, 0.3]


def test_bandwidth_of_a_series_does_not_depend_on_others(spark):
    from tillwise.operators import forecast

    wave = lambda n: [(f"s{n}", i, float((i * 37) % 11 + i % 5)) for i in range(n)]
    make = lambda rows: spark.createDataFrame(rows, "series string, t int, y double").withColumn("day", F.date_add(F.lit("2020-01-01").cast("date"), F.col("t")))
    alone = forecast.kpss_test(make(wave(60))).where("series = 's60'").collect()
    beside = forecast.kpss_test(make(wave(60) + wave(900))).where("series = 's60'").collect()
    assert alone == beside
