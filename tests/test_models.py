"""Properties of the models, on the smallest data and with few trees."""

import pytest
from pyspark.sql import functions as F

from plumbline.checks.analysis_queries import air_energy_weather, features
from plumbline.checks.plan_queries import TARGETS
from plumbline.operators import impute, models, stats
from plumbline.plans import analysis

SF_DIR = "/root/testdata/sf0.001"


def test_hash_split_is_stable_and_close_to_its_share(spark):
    frame = spark.range(5000)
    first = models.hash_split(frame, ["id"])
    again = models.hash_split(frame.repartition(7), ["id"])
    assert first.exceptAll(again).count() == 0
    assert 0.77 < first.filter("is_train").count() / 5000 < 0.83


def test_boosted_trees_beat_the_mean_and_repeat(spark):
    frame = spark.range(600).select(
        "id", F.pmod(F.xxhash64("id"), F.lit(100)).cast("double").alias("x"), F.lit(None).cast("double").alias("empty")
    )
    frame = models.hash_split(frame.withColumn("y", F.sin(F.col("x") / 15) * 3), ["id"])
    train, test = frame.filter("is_train"), frame.filter("not is_train")
    fits = [models.fit_boosted_trees(train, test, "y", ["x", "empty"], ["id"], maxIter=5) for _ in range(2)]
    assert stats.regression_metrics(fits[0].predictions, "y", "prediction").first().r2 > 0.8
    assert [r.feature for r in fits[0].importances.collect()] == ["x"]
    first, second = (sorted(map(tuple, f.predictions.select("id", "prediction").collect())) for f in fits)
    assert first == second


def test_trees_take_missing_features(spark):
    """Missing values that tell the target, on the side of neither low nor high values."""
    x = F.pmod(F.xxhash64("id"), F.lit(90)).cast("double")
    frame = spark.range(1_500).select("id", x.alias("x"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(7))).cast("double").alias("z"))
    gap = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(4)) == 0
    frame = frame.withColumn("y", F.when(gap, 25.0).otherwise(F.abs(F.col("x") - 45)) + F.col("z"))
    frame = models.hash_split(frame.withColumn("x", F.when(~gap, F.col("x"))).withColumn("none", F.lit(None).cast("double")), ["id"])
    train, test = frame.filter("is_train"), frame.filter("not is_train")
    fitted = models.fit_boosted_trees(train, test, "y", ["x", "z", "none"], ["id"], missing="sides", maxIter=15)
    assert fitted.predictions.filter("prediction IS NOT NULL").count() == test.count()
    assert set(fitted.predictions.columns) == {*test.columns, "prediction"}
    error = stats.regression_metrics(fitted.predictions, "y", "prediction").first()
    assert error.r2 > 0.9
    filled = impute.impute_group_mean(frame.withColumn("all", F.lit(1)), ["x"], ["all"])
    mean = models.fit_boosted_trees(filled.filter("is_train"), filled.filter("not is_train"), "y", ["x", "z"], ["id"], maxIter=15)
    assert error.mse <= stats.regression_metrics(mean.predictions, "y", "prediction").first().mse
    weights = {r.feature: r.importance for r in fitted.importances.collect()}
    assert set(weights) == {"x", "z"} and sum(weights.values()) == pytest.approx(1.0)
    unseen = test.withColumns({"z": F.lit(None).cast("double"), "y": F.lit(None).cast("double")})
    assert fitted.model.transform(models._with_sides(unseen, ["x", "z"], {"x"})[0]).filter("prediction IS NULL").count() == 0


def test_air_rows_with_gaps_are_no_worse_than_filled_ones(spark):
    """Held-out rows of the given tables: all predicted, errors below the mean's and not above those of filled rows."""
    view = air_energy_weather(spark, "/root/testdata/sf0.01")
    whole = analysis.air_regression(view, {"N": "pm25"}, missing="sides", maxIter=8)["N"].predictions
    mean = analysis.air_regression(view, {"N": "pm25"}, maxIter=8)["N"].predictions
    # Only rows with a measured target tell an error; the other form fills the target itself.
    keyed = whole.filter("pm25 IS NOT NULL").select("station", "datetime_iso", F.col("pm25").alias("y"), F.col("prediction").alias("p"))
    both = keyed.join(mean.select("station", "datetime_iso", "prediction"), ["station", "datetime_iso"])
    sided, filled = (stats.regression_metrics(both, "y", c).first() for c in ("p", "prediction"))
    assert both.count() == keyed.count() and sided.r2 > 0
    assert sided.mse <= 1.02 * filled.mse


def test_regression_per_station(spark):
    fitted = analysis.air_regression(air_energy_weather(spark, SF_DIR), {"A": TARGETS["A"]}, maxIter=2)
    predicted = fitted["A"].predictions
    assert predicted.filter("prediction is null").count() == 0 and predicted.count() > 0
    shapes = analysis.error_distribution(predicted, "pm25")
    assert shapes["histogram"].agg(F.sum("n")).first()[0] == predicted.count()
    assert shapes["density"].count() == 100


def test_severity_model_and_its_results(spark, tmp_path):
    rows = features(spark, SF_DIR)
    parts = analysis.severity_parts(rows)
    fitted = analysis.severity_model(parts, numTrees=3, maxDepth=4)
    assert sum(r.importance for r in fitted.importances.collect()) == pytest.approx(1.0)
    results = analysis.accident_results(rows, parts, fitted)
    paths = stats.save_results(results, str(tmp_path))
    read = {name: spark.read.parquet(path) for name, path in paths.items()}
    assert read["correlations"].count() == 81
    assert read["feature_importance"].count() <= 20
    assert read["classification_report"].agg(F.sum("support")).first()[0] == parts.filter("part = 'validation'").count()


def test_the_cut_reads_written_rows(spark, monkeypatch, plan):
    """The cut takes many passes over its rows: no join or shuffle is left to run in each."""
    taken = []
    cut = analysis.chronological_cut
    monkeypatch.setattr(analysis, "chronological_cut", lambda rows, *names: taken.append(plan(rows)) or cut(rows, *names))
    analysis.severity_parts(features(spark, SF_DIR))
    assert len(taken) == 1 and "Join" not in taken[0] and "Exchange" not in taken[0]
