"""Repurchase prediction: samples, features, models, evaluation, contact lists.

Evaluation works on a scored frame (user_id, label, score) of any size: ranks
come from range-placed running totals, never from one global window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier)
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window as W, functions as F

from tillwise.functions.exprs import is_paid, round_to, safe_divide
from tillwise.functions.scale import durable, exact_quantiles, running_totals, stats
from tillwise.operators.cleaning import numeric_columns
from tillwise.operators.features import user_wide

NOT_FEATURES = {"user_id", "R_score", "F_score", "M_score"}
CONTACT_COST, ORDER_VALUE = 5, 1444  # fixed values: cost per contact, value of a repurchase


# ---- samples and features --------------------------------------------------------------
def samples(orders: DataFrame, ref: str, observation_days: int = 365, prediction_days: int = 60) -> DataFrame:
    """Users who bought in the year up to ``ref``; label 1 when they bought in the 60 days after it."""
    return _labelled(orders.where(is_paid()), orders.where(is_paid()), ref, observation_days, prediction_days)


def _labelled(seen: DataFrame, events: DataFrame, ref: str, observation_days: int, prediction_days: int,
              date: str = "order_date", positive: bool = True) -> DataFrame:
    day = F.lit(ref).cast("date")
    base = (seen.where(F.col("order_date").between(F.date_sub(day, observation_days), day) & F.col("user_id").isNotNull())
            .select("user_id").distinct())
    hit = (events.where((F.col(date) > day) & (F.col(date) <= F.date_add(day, prediction_days)))
           .select("user_id").distinct().withColumn("_hit", F.lit(1)))
    found = F.col("_hit").isNotNull()
    return base.join(hit, "user_id", "left").select("user_id", (found if positive else ~found).cast("int").alias("label"))


def churn_labels(orders: DataFrame, ref: str, observation_days: int = 365, silent_days: int = 90) -> DataFrame:
    """Label 1 when a user of the past year stays without a paid order."""
    paid = orders.where(is_paid())
    return _labelled(paid, paid, ref, observation_days, silent_days, positive=False)


def coupon_use_labels(coupons: DataFrame, ref: str, days: int = 60) -> DataFrame:
    """Users who held a coupon issued up to ``ref``; label 1 when one is used in the days after it."""
    day = F.lit(ref).cast("date")
    g = coupons.groupBy("user_id").agg(
        F.count_if(F.col("issued_date") <= day).alias("held"),
        F.count_if((F.col("used_date") > day) & (F.col("used_date") <= F.date_add(day, days))).alias("used"))
    return g.where(F.col("held") > 0).select("user_id", (F.col("used") > 0).cast("int").alias("label"))


def refund_labels(orders: DataFrame, refunds: DataFrame) -> DataFrame:
    """One row per order, label 1 when it has an approved refund."""
    r = refunds.where(F.col("status") == "approved").select("order_id").distinct().withColumn("_r", F.lit(1))
    return orders.join(r, "order_id", "left").select("order_id", "user_id", F.col("_r").isNotNull().cast("int").alias("label"))


def sample_summary(labelled: DataFrame) -> DataFrame:
    pos, n = F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1))
    return labelled.agg(n.alias("users"), pos.alias("positive"), (n - pos).alias("negative"),
                        round_to(safe_divide(pos, n), 4).alias("ratio"))


def features_until(users: DataFrame, orders: DataFrame, lines: DataFrame, traffic: DataFrame, coupons: DataFrame,
                   refunds: DataFrame, products: DataFrame, ref: str, price_edges=(100.0, 500.0)) -> DataFrame:
    """The user wide table from data up to ``ref`` only, so no feature sees the label period."""
    day = F.lit(ref).cast("date")
    coupons = (coupons.where(F.col("issued_date") <= day)
               .withColumn("is_used", F.when(F.col("used_date") <= day, F.col("is_used")).otherwise(0))
               .withColumn("used_date", F.when(F.col("used_date") <= day, F.col("used_date"))))
    return user_wide(users, orders.where(F.col("order_date") <= day), lines.where(F.col("order_date") <= day),
                     traffic.where(F.col("event_date") <= day), coupons, refunds.where(F.col("refund_date") <= day),
                     products, as_of=ref, price_edges=price_edges)


def feature_columns(wide: DataFrame) -> list[str]:
    return [c for c in numeric_columns(wide) if c not in NOT_FEATURES]


def _fill(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    return wide.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})


def feature_stages(columns: Sequence[str], categorical: Sequence[str] = ()) -> list:
    """Assemble and standardise numbers; with ``categorical`` also index and one-hot texts."""
    stages: list = []
    for c in categorical:
        stages += [StringIndexer(inputCol=c, outputCol=f"_i_{c}", handleInvalid="keep", stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCol=f"_i_{c}", outputCol=f"_h_{c}")]
    stages += [VectorAssembler(inputCols=[*columns, *[f"_h_{c}" for c in categorical]], outputCol="_raw", handleInvalid="keep"),
               StandardScaler(inputCol="_raw", outputCol="features", withMean=not categorical, withStd=True)]
    return stages


def prepare_features(wide: DataFrame, columns: Sequence[str] | None = None, categorical: Sequence[str] = ()) -> DataFrame:
    """(user_id, features); the columns are stored once, as fitting and the result both read them."""
    columns = list(columns or feature_columns(wide))
    ready = durable(_fill(wide, columns).select("user_id", *columns, *categorical))
    return Pipeline(stages=feature_stages(columns, categorical)).fit(ready).transform(ready).select("user_id", "features")


def split(labelled: DataFrame, share: float = 0.7, key: str = "user_id") -> tuple[DataFrame, DataFrame]:
    """Repeatable split by key hash; each class splits in the same proportion."""
    bucket = F.pmod(F.xxhash64(key, "label"), F.lit(1000))
    cut = int(share * 1000)
    return labelled.where(bucket < cut), labelled.where(bucket >= cut)


# ---- models -------------------------------------------------------------------------------
# fixed values: model names
LOGISTIC, TREE, FOREST, BOOSTED = "逻辑回归", "决策树", "随机森林", "梯度提升"


def classifiers(n_train: int, trees: int = 100, rounds: int = 100) -> dict:
    """The four models. The summed-loss penalty C=1 equals 1/n on Spark's mean loss."""
    common = {"labelCol": "label", "featuresCol": "features"}
    return {LOGISTIC: LogisticRegression(maxIter=1000, regParam=1.0 / max(n_train, 1), **common),
            TREE: DecisionTreeClassifier(maxDepth=8, seed=42, **common),
            FOREST: RandomForestClassifier(numTrees=trees, maxDepth=12, seed=42, **common),
            BOOSTED: GBTClassifier(maxIter=rounds, maxDepth=5, seed=42, **common)}


def train(wide: DataFrame, labelled: DataFrame, columns: Sequence[str] | None = None, categorical: Sequence[str] = (),
          trees: int = 100, rounds: int = 100, share: float = 0.7, names: Sequence[str] | None = None) -> dict[str, PipelineModel]:
    """Fit the models on the training part of the sample; scaling is fitted there too."""
    columns = list(columns or feature_columns(wide))
    table = _fill(wide, columns).join(labelled, "user_id").select("user_id", "label", *columns, *categorical)
    fit_on = durable(split(table, share)[0])  # fitting passes over the rows many times
    models = classifiers(fit_on.count(), trees, rounds)
    return {n: Pipeline(stages=[*feature_stages(columns, categorical), m]).fit(fit_on)
            for n, m in models.items() if names is None or n in names}


def score(model: PipelineModel, wide: DataFrame, columns: Sequence[str] | None = None, keep: Sequence[str] = ("user_id",)) -> DataFrame:
    columns = list(columns or feature_columns(wide))
    out = model.transform(_fill(wide, columns))
    return out.select(*keep, vector_to_array("probability")[1].alias("score"))


def importances(model: PipelineModel, columns: Sequence[str], top_n: int = 15) -> DataFrame:
    """Feature importances of a tree model, largest first."""
    from pyspark.sql import SparkSession

    values = model.stages[-1].featureImportances.toArray()
    rows = sorted(((c, round(float(v), 6)) for c, v in zip(columns, values)), key=lambda r: (-r[1], r[0]))[:top_n]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double")


def forest_importances(wide: DataFrame, target: str, columns: Sequence[str] | None = None, trees: int = 100,
                       depth: int = 10, top_n: int = 15) -> DataFrame:
    """Random-forest importances of the features for a 0/1 column of the wide table."""
    columns = [c for c in (columns or feature_columns(wide)) if c not in (target, "birth_year")]
    ready = durable(_fill(wide, columns).select(*columns, F.coalesce(F.col(target), F.lit(0)).cast("int").alias("label")))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=42)
    return importances(Pipeline(stages=[*feature_stages(columns), forest]).fit(ready), columns, top_n)


# ---- evaluation ---------------------------------------------------------------------------
def _per_score(scored: DataFrame) -> DataFrame:
    """Positives and negatives per distinct score: ties, however many, are one row."""
    return scored.groupBy("score").agg(F.sum("label").alias("pos"), (F.count(F.lit(1)) - F.sum("label")).alias("neg"))


def metrics(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """AUC by rank sums (ties count half), precision, recall and F1 at the threshold."""
    ranked = running_totals(_per_score(scored), [F.asc("score")], upto=F.col("neg"), hits=F.col("pos"))
    wins = F.col("pos") * (F.col("upto") - F.col("neg") / 2)
    chosen = F.col("score") >= threshold
    tp = F.sum(F.when(chosen, F.col("pos")).otherwise(0))
    fp = F.sum(F.when(chosen, F.col("neg")).otherwise(0))
    n_pos = F.sum("pos")
    precision, recall = safe_divide(tp, tp + fp), safe_divide(tp, n_pos)
    return ranked.agg(round_to(safe_divide(F.sum(wins), n_pos * F.sum("neg")), 4).alias("auc"),
                      round_to(precision, 4).alias("precision"), round_to(recall, 4).alias("recall"),
                      round_to(safe_divide(2 * precision * recall, precision + recall), 4).alias("f1"))


def compare_models(scored: Mapping[str, DataFrame], threshold: float = 0.5) -> DataFrame:
    """Metrics per model, the best AUC marked."""
    parts = [metrics(df, threshold).withColumn("model", F.lit(n)) for n, df in scored.items()]
    out = reduce(DataFrame.unionByName, parts)
    rank = F.row_number().over(W.orderBy(F.desc("auc"), "model"))  # one row per model
    return out.withColumn("best", (rank == 1).cast("int"))


def roc_curve(scored: DataFrame) -> DataFrame:
    """(score, fpr, tpr) at every distinct score, highest first."""
    r = running_totals(_per_score(scored), [F.desc("score")], tp=F.col("pos"), fp=F.col("neg"))
    return r.select("score", round_to(safe_divide("fp", "total_fp"), 4).alias("fpr"), round_to(safe_divide("tp", "total_tp"), 4).alias("tpr"))


def precision_recall_curve(scored: DataFrame) -> DataFrame:
    r = running_totals(_per_score(scored), [F.desc("score")], tp=F.col("pos"), fp=F.col("neg"))
    return r.select("score", round_to(safe_divide("tp", F.col("tp") + F.col("fp")), 4).alias("precision"),
                    round_to(safe_divide("tp", "total_tp"), 4).alias("recall"))


def confusion_matrix(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Two rows (label) by predicted_0 and predicted_1."""
    hit = F.col("score") >= threshold
    g = scored.agg(*[F.count_if((F.col("label") == y) & (hit if p else ~hit)).alias(f"c{y}{p}") for y in (0, 1) for p in (0, 1)])
    return g.select(F.inline(F.array(*[F.struct(F.lit(y).alias("label"), F.col(f"c{y}0").alias("predicted_0"),
                                                F.col(f"c{y}1").alias("predicted_1")) for y in (0, 1)])))


def top_share_metrics(scored: DataFrame, shares: Sequence[int] = (5, 10, 20), threshold: float = 0.5) -> DataFrame:
    """Precision and recall inside the top n % by score, and recall over all positives."""
    r = running_totals(scored, [F.desc("score"), F.asc("user_id")], rank=F.lit(1), found=F.col("label"))
    called = F.col("score") >= threshold
    rows = []
    for s in shares:
        n = F.greatest(F.lit(1), F.floor(F.col("total_rank") * s / 100))
        top = F.col("rank") <= n
        tp = F.count_if(top & called & (F.col("label") == 1))
        rows.append((s, tp, F.count_if(top & called), F.count_if(top & (F.col("label") == 1)), F.max("total_found"), F.count_if(top)))
    wide = r.agg(*[v.alias(f"{k}{s}") for s, *vs in rows for k, v in zip("abcde", vs)])
    return wide.select(F.inline(F.array(*[F.struct(
        F.lit(s).alias("top_pct"), F.col(f"e{s}").alias("users"), round_to(safe_divide(f"a{s}", f"b{s}"), 4).alias("precision"),
        round_to(safe_divide(f"a{s}", f"c{s}"), 4).alias("recall_in_top"),
        round_to(safe_divide(f"c{s}", f"d{s}"), 4).alias("recall_of_all")) for s in shares])))


# ---- use -----------------------------------------------------------------------------------
def score_thresholds(scored: DataFrame) -> DataFrame:
    """Score at the top 5, 10 and 20 %."""
    q = exact_quantiles(scored, ["score"], (0.95, 0.9, 0.8))
    n = stats(scored, n=F.count(F.lit(1)))["n"]
    row = [(n, *[round(q["score", p], 4) if q["score", p] is not None else None for p in (0.95, 0.9, 0.8)])]
    return scored.sparkSession.createDataFrame(row, "total_users long, top5 double, top10 double, top20 double")


def top_users(scored: DataFrame, top_n: int = 100) -> DataFrame:
    return scored.select("user_id", "score").orderBy(F.desc("score"), "user_id").limit(top_n)


def contact_list(scored: DataFrame, threshold: float | None = None, top_pct: float = 5.0) -> DataFrame:
    """Users at or above a score, or in the top percent; scores rounded to 4 digits first."""
    r = scored.select("user_id", round_to("score", 4).alias("repurchase_score"))
    if threshold is None:
        threshold = exact_quantiles(r, ["repurchase_score"], [1 - top_pct / 100])["repurchase_score", 1 - top_pct / 100]
    return r.where(F.col("repurchase_score") >= F.lit(threshold))


def contact_return(contacts: DataFrame, cost: int = CONTACT_COST, value: int = ORDER_VALUE) -> DataFrame:
    """Cost, expected buyers (whole), revenue and return of contacting a list."""
    return _return(contacts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("repurchase_score"), F.lit(0.0)).alias("s")), cost, value)


def _return(agg: DataFrame, cost: int, value: int, *keep: str) -> DataFrame:
    buyers = F.floor(round_to("s", 8))
    spend = F.col("n") * cost
    return agg.select(*keep, F.col("n").alias("contact_count"), spend.alias("contact_cost"), buyers.alias("expected_repurchasers"),
                      (buyers * value).alias("expected_revenue"), round_to(safe_divide(buyers * value - spend, spend)).alias("roi"))


def roi_sweep(scored: DataFrame, thresholds: Sequence[float], cost: int = CONTACT_COST, value: int = ORDER_VALUE) -> DataFrame:
    """Return at many thresholds, from one pass."""
    r = scored.select(round_to("score", 4).alias("p"))
    wide = r.agg(*[x for i, t in enumerate(thresholds) for x in (
        F.count_if(F.col("p") >= t).alias(f"n{i}"), F.coalesce(F.sum(F.when(F.col("p") >= t, F.col("p"))), F.lit(0.0)).alias(f"s{i}"))])
    rows = wide.select(F.inline(F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"n{i}").alias("n"), F.col(f"s{i}").alias("s"))
                                          for i, t in enumerate(thresholds)])))
    return _return(rows, cost, value, "threshold")


def run(wide: DataFrame, labelled: DataFrame, trees: int = 100, rounds: int = 100,
        columns: Sequence[str] | None = None) -> dict:
    """Train all models, evaluate them on the held-out part and keep the best."""
    columns = list(columns or feature_columns(wide))
    wide = durable(wide.select("user_id", *columns))
    models = train(wide, labelled, columns, trees=trees, rounds=rounds)
    held = split(_fill(wide, columns).join(labelled, "user_id"))[1]
    scored = {n: score(m, held, columns, ("user_id", "label")) for n, m in models.items()}
    report = compare_models(scored)
    best = report.where(F.col("best") == 1).first()["model"]
    return {"models": models, "scored": scored, "report": report, "best": best,
            "importance": importances(models[FOREST], columns)}
