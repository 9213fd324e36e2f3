"""Steps of the user wide table that move many rows: how often they run, and what they return."""

from checks import propensity as checked
from tillwise.operators import features, propensity


def test_lines_are_not_grouped_by_user_and_sku(spark):
    lines = spark.createDataFrame([(1, 7, 10.0), (1, 7, 20.0), (1, 8, None), (1, 9, 30.0), (None, 7, 1.0)], "user_id long, sku_id long, unit_price double")
    products = spark.createDataFrame([(7, "b", 50.0), (8, "a", 900.0)], "sku_id long, category_name string, price double")
    got = features.category_features(lines, products)
    assert "keys=[user_id#" in got._jdf.queryExecution().toString() and not [
        line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Aggregate" in line and "sku_id" in line]
    assert [tuple(r) for r in got.collect()] == [(1, "b", 2, 20.0, 0.25, 0.5)]


def test_feature_matrix_reads_its_input_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(len(b))
            yield b

    wide = spark.range(20).selectExpr("id AS user_id", "id * 1.5D AS v").mapInPandas(counted, "user_id long, v double")
    assert propensity.prepare_features(wide, ["v"]).count() == 20
    assert propensity.prepare_features(wide, ["v"]).select("features").distinct().count() == 20
    assert read.value == 40


def test_models_store_their_columns(spark, monkeypatch):
    wide = spark.range(5).selectExpr("id AS user_id", "id AS v", "id AS w")
    monkeypatch.setattr(checked, "until", lambda s: wide)
    kept = checked.stored(None, "v")
    assert kept.columns == ["user_id", "v"] and "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()
