from pyspark.sql import functions as F

from checks import check, ctes
from checks.features import wide
from tillwise.functions.exprs import round_to
from tillwise.functions.scale import durable
from tillwise.operators import propensity as p

PAID = "status IN ('paid', 'completed')"
REF = "2000-12-31"
FEW = ("recency", "frequency", "monetary", "order_count", "lifecycle_days", "monthly_orders", "avg_order_interval",
       "coupons_used_count", "category_diversity", "refund_count", "weekend_order_ratio")
ctes.register(
    sample=f"""SELECT user_id, CASE WHEN user_id IN (SELECT user_id FROM fact_order WHERE {PAID} AND order_date > DATE '{REF}' AND order_date <= DATE '{REF}' + 60)
        THEN 1 ELSE 0 END AS label FROM (SELECT DISTINCT user_id FROM fact_order WHERE {PAID} AND order_date BETWEEN DATE '{REF}' - 365 AND DATE '{REF}')""",
    scored=f"""SELECT s.user_id, s.label, least(CAST(1 AS DOUBLE), round(0.1 * n, 4)) AS score FROM sample s
        JOIN (SELECT user_id, count(*) AS n FROM fact_order GROUP BY 1) o ON o.user_id = s.user_id""")


def sample(s):
    return p.samples(s.fact_order, REF)


def scored(s):
    n = s.fact_order.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return sample(s).join(n, "user_id").select("user_id", "label", F.least(F.lit(1.0), round_to(F.col("n") * 0.1, 4)).alias("score"))


def until(s):
    return p.features_until(s.dim_user, s.fact_order, s.fact_order_item, s.fact_traffic, s.fact_coupon_use, s.fact_refund,
                            s.dim_product, REF, (930.0, 970.0))


def stored(s, *columns):
    """The named columns of the wide table, built once for training and scoring."""
    return durable(until(s).select("user_id", *columns))


@check("i01_repurchase_samples", "SELECT * FROM sample")
def _(s, spark):
    return sample(s)


@check("i01_sample_summary", "SELECT count(*) AS users, CAST(sum(label) AS BIGINT) AS positive, count(*) - CAST(sum(label) AS BIGINT) AS negative, round(sum(label) / count(*), 4) AS ratio FROM sample")
def _(s, spark):
    return p.sample_summary(sample(s))


@check("i02_feature_matrix")
def _(s, spark):
    from pyspark.ml.functions import vector_to_array
    f = p.prepare_features(until(s), FEW)
    x = vector_to_array("features")
    return f.select("user_id", *[round_to(x[i], 6).alias(c) for i, c in enumerate(FEW)])


@check("i03_train_test_split")
def _(s, spark):
    a, b = p.split(sample(s))
    return (a.withColumn("part", F.lit("train")).unionByName(b.withColumn("part", F.lit("test")))
            .groupBy("part", "label").count())


def fitted(s, name, **kw):
    w = stored(s, *FEW)
    model = p.train(w, sample(s), FEW, names=[name], **kw)[name]
    held = p.split(w.join(sample(s), "user_id"))[1]
    return p.metrics(p.score(model, held, FEW, ("user_id", "label"))).withColumn("model", F.lit(name)), model


for _name, _model, _kw in (("i04_logistic_regression", p.LOGISTIC, {}), ("i05_decision_tree", p.TREE, {}),
                           ("i06_random_forest", p.FOREST, {"trees": 20}), ("i07_gradient_boosting", p.BOOSTED, {"rounds": 5})):
    check(_name)(lambda s, spark, m=_model, kw=_kw: fitted(s, m, **kw)[0])

AUC = "(SELECT sum(CASE WHEN a.score > b.score THEN 1 WHEN a.score = b.score THEN 0.5 ELSE 0 END) / count(*) FROM scored a, scored b WHERE a.label = 1 AND b.label = 0)"


@check("i08_model_metrics", f"""SELECT round({AUC}, 4) AS auc, round(tp / (tp + fp), 4) AS precision, round(tp / pos, 4) AS recall,
    round(2 * (tp / (tp + fp)) * (tp / pos) / ((tp / (tp + fp)) + (tp / pos)), 4) AS f1 FROM (SELECT count(*) FILTER (WHERE label = 1 AND score >= 0.8) AS tp,
    count(*) FILTER (WHERE label = 0 AND score >= 0.8) AS fp, sum(label) AS pos FROM scored)""")
def _(s, spark):
    return p.metrics(scored(s), 0.8)


CURVE = """SELECT score, sum(sum(label)) OVER (ORDER BY score DESC) AS tp, sum(count(*) - sum(label)) OVER (ORDER BY score DESC) AS fp,
    sum(sum(label)) OVER () AS p, sum(count(*) - sum(label)) OVER () AS n FROM scored GROUP BY score"""


@check("i09_roc_curve", f"SELECT score, round(fp / n, 4) AS fpr, round(tp / p, 4) AS tpr FROM ({CURVE})")
def _(s, spark):
    return p.roc_curve(scored(s))


@check("i10_confusion_matrix", " UNION ALL ".join(f"SELECT {y} AS label, count(*) FILTER (WHERE score < 0.8) AS predicted_0, count(*) FILTER (WHERE score >= 0.8) AS predicted_1 FROM scored WHERE label = {y}" for y in (0, 1)))
def _(s, spark):
    return p.confusion_matrix(scored(s), 0.8)


@check("i11_top_share_metrics", """WITH r AS (SELECT *, row_number() OVER (ORDER BY score DESC, user_id) AS rank, count(*) OVER () AS n, sum(label) OVER () AS allpos FROM scored)
    """ + " UNION ALL ".join(f"""SELECT {t} AS top_pct, count(*) AS users, round(coalesce(count(*) FILTER (WHERE label = 1 AND score >= 0.8) / nullif(count(*) FILTER (WHERE score >= 0.8), 0), 0), 4) AS precision,
    round(coalesce(count(*) FILTER (WHERE label = 1 AND score >= 0.8) / nullif(sum(label), 0), 0), 4) AS recall_in_top, round(sum(label) / max(allpos), 4) AS recall_of_all
    FROM r WHERE rank <= greatest(1, floor(n * {t} / 100))""" for t in (5, 10, 20)))
def _(s, spark):
    return p.top_share_metrics(scored(s), threshold=0.8)


@check("i12_feature_importance")
def _(s, spark):
    return p.importances(fitted(s, p.FOREST, trees=20)[1], FEW)


@check("i13_score_thresholds", """SELECT count(*) AS total_users, round(quantile_cont(score, 0.95), 4) AS top5, round(quantile_cont(score, 0.9), 4) AS top10,
    round(quantile_cont(score, 0.8), 4) AS top20 FROM scored""")
def _(s, spark):
    return p.score_thresholds(scored(s))


@check("i13_top_users", "SELECT user_id, score FROM scored ORDER BY score DESC, user_id LIMIT 100")
def _(s, spark):
    return p.top_users(scored(s))


@check("i13_score_all_users")
def _(s, spark):
    w = stored(s, *FEW)
    model = p.train(w, sample(s), FEW, names=[p.LOGISTIC])[p.LOGISTIC]
    return p.score(model, w, FEW)


CONTACTS = "SELECT user_id, round(score, 4) AS repurchase_score FROM scored WHERE score >= (SELECT quantile_cont(score, 0.95) FROM scored)"


def returns(src, keep=""):
    return f"""SELECT {keep} n AS contact_count, n * 5 AS contact_cost, CAST(floor(round(coalesce(s, 0), 8)) AS BIGINT) AS expected_repurchasers,
        CAST(floor(round(coalesce(s, 0), 8)) AS BIGINT) * 1444 AS expected_revenue,
        round(coalesce((floor(round(coalesce(s, 0), 8)) * 1444 - n * 5) / nullif(n * 5, 0), 0), 2) AS roi FROM ({src})"""


@check("i14_contact_list", CONTACTS)
def _(s, spark):
    return p.contact_list(scored(s))


@check("i14_contact_return", returns(f"SELECT count(*) AS n, sum(repurchase_score) AS s FROM ({CONTACTS})"))
def _(s, spark):
    return p.contact_return(p.contact_list(scored(s)))


STEPS = (0.2, 0.4, 0.6, 0.8, 0.95)


@check("i15_roi_sweep", returns(" UNION ALL ".join(f"SELECT CAST({t} AS DOUBLE) AS threshold, count(*) AS n, sum(score) AS s FROM scored WHERE score >= {t}" for t in STEPS), "threshold,"))
def _(s, spark):
    return p.roi_sweep(scored(s), STEPS)


@check("i16_training_run")
def _(s, spark):
    return p.run(until(s), sample(s), trees=10, rounds=3, columns=FEW)["report"]


@check("e11_forest_importances")
def _(s, spark):
    return p.forest_importances(wide(s), "has_refund", FEW[:9], trees=10)


@check("r12_churn_labels", f"""SELECT user_id, CASE WHEN user_id IN (SELECT user_id FROM fact_order WHERE {PAID} AND order_date > DATE '{REF}' AND order_date <= DATE '{REF}' + 90)
    THEN 0 ELSE 1 END AS label FROM sample""")
def _(s, spark):
    return p.churn_labels(s.fact_order, REF)


@check("r12_coupon_use_labels", f"""SELECT user_id, CASE WHEN count(*) FILTER (WHERE used_date > DATE '{REF}' AND used_date <= DATE '{REF}' + 60) > 0 THEN 1 ELSE 0 END AS label
    FROM fact_coupon_use GROUP BY 1 HAVING count(*) FILTER (WHERE issued_date <= DATE '{REF}') > 0""")
def _(s, spark):
    return p.coupon_use_labels(s.fact_coupon_use, REF)


@check("r12_refund_labels", """SELECT order_id, user_id, CASE WHEN order_id IN (SELECT order_id FROM fact_refund WHERE status = 'approved') THEN 1 ELSE 0 END AS label FROM fact_order""")
def _(s, spark):
    return p.refund_labels(s.fact_order, s.fact_refund)


@check("r16_precision_recall_curve", f"SELECT score, round(tp / (tp + fp), 4) AS precision, round(tp / p, 4) AS recall FROM ({CURVE})")
def _(s, spark):
    return p.precision_recall_curve(scored(s))


@check("r16_one_hot_model")
def _(s, spark):
    w = stored(s, *FEW[:4], "member_level", "top_category")
    m = p.train(w, sample(s), FEW[:4], ("member_level", "top_category"), names=[p.LOGISTIC])[p.LOGISTIC]
    return p.score(m, w, FEW[:4])
