"""Scores of the trained models on rows whose answers are known."""

import math
import random

from pyspark.sql import functions as F

from harmlens.operators import features as feat


def rows(spark, n=900):
    """Categories that the inputs decide, in very different numbers."""
    r = random.Random(3)
    out = []
    for i in range(n):
        deaths = r.choice([0, 0, 0, 3, 8, 25, 70])
        out.append((f"e{i}", 2000 + i % 20, r.randint(1, 4000), r.randint(0, 900), deaths))
    df = spark.createDataFrame(out, "name string, year int, total_cases bigint, days_lost bigint, total_deaths bigint")
    return feat.derive_features(df)


def test_boosting_finds_categories_that_inputs_decide(spark):
    scores = {r.risk_category: r for r in feat.boost_category(rows(spark), key=("name",), rounds=6, depth=3).collect()}
    assert set(scores) == set(feat.CATEGORIES)
    for r in scores.values():
        assert r.correct == r.scored == r.test_rows > 0 and r.train_rows > r.test_rows
        assert r.accuracy == 1.0 and r.rmse == 0.0


def test_boosting_beats_the_most_frequent_class_on_noisy_labels(spark):
    df = rows(spark).withColumn("risk_category", F.when(F.crc32("name") % 10 == 0, "LOW").otherwise(F.col("risk_category")))
    table = feat._split(df, feat.FEATURES, F.array_position(F.array(*map(F.lit, feat.CATEGORIES)), F.col("risk_category")) - 1, ("name",), 0.8)
    predicted = feat.boost_classes(table, 4, 6, 3, 0.3, 1).filter("not __train").select("label", "prediction").collect()
    right = sum(r.label == r.prediction for r in predicted) / len(predicted)
    assert 0.8 < right < 1.0 and right > max(sum(r.label == k for r in predicted) for k in range(4)) / len(predicted)


def test_boosting_of_one_class_and_of_no_rows(spark):
    one = rows(spark, 60).withColumn("risk_category", F.lit("HIGH"))
    found = feat.boost_category(one, key=("name",), rounds=2, depth=2).collect()
    assert [(r.risk_category, r.accuracy) for r in found] == [("HIGH", 1.0)]


def test_scores_of_the_binary_and_the_severity_model(spark):
    df = rows(spark)
    high = {r.label: r for r in feat.classify_high_risk(df, key=("name",), trees=5, depth=3).collect()}
    assert all(r.correct == r.test_rows == r.scored > 0 for r in high.values()) and set(high) == {0.0, 1.0}
    severity = feat.regress_severity(df, key=("name",), trees=20, depth=5).first()
    spread = df.select(F.stddev("severity_score")).first()[0]
    assert severity.test_rows == severity.scored > 0 and 0 < severity.rmse < spread / 3 and math.isfinite(severity.rmse)


def test_equal_rows_are_trained_once_with_their_number(spark):
    df = rows(spark, 400)
    many = df.crossJoin(spark.range(20)).withColumn("name", F.concat_ws("/", "name", "id"))
    place = F.array_position(F.array(*map(F.lit, feat.CATEGORIES)), F.col("risk_category")) - 1
    table = feat._split(many, feat.FEATURES, place, ("name",), 0.8)
    binned = feat._binned(table, len(feat.FEATURES))
    assert binned.count() <= 2 * 400 and binned.agg(F.sum("n")).first()[0] == 8000 == table.count()
    assert sorted(binned.groupBy("label", "__train").agg(F.sum("n")).collect()) == sorted(table.groupBy("label", "__train").count().collect())
    assert all(0 <= b < feat.BINS for r in binned.collect() for b in r.inputs)


def test_limits_lie_between_values():
    assert feat._between([1.0, 1.0, 2.0, 4.0]) == [1.5, 3.0] and feat._between([5.0]) == feat._between([]) == []
    limits = feat._between([float(i) for i in range(1024)])
    assert len(limits) == feat.BINS - 1 and limits[0] == 31.5 and limits == sorted(limits)
    skewed = feat._between([0.0] * 900 + [float(i) for i in range(1, 101)])
    assert skewed[0] == 0.5 and len(skewed) <= feat.BINS - 1


def test_weighted_rows_train_as_rows_do(spark):
    """Mean labels and weights give the scores of the rows themselves, where the rows hold few values."""
    r = random.Random(5)
    data = [(f"e{i}", r.randint(1, 6), r.randint(0, 9), r.randint(0, 50) / 7) for i in range(1500)]
    df = spark.createDataFrame(data, "name string, a int, b int, y double")
    from pyspark.ml.regression import GBTRegressor

    learner = lambda: GBTRegressor(maxIter=8, maxDepth=4, seed=1)
    got = feat._evaluated(df, learner(), ("a", "b"), F.col("y"), ("name",), mean=True).agg(F.sum("squared_error"), F.sum("test_rows")).first()
    table = feat._split(df, ("a", "b"), F.col("y"), ("name",), 0.8)
    model = learner().setFeaturesCol("inputs").fit(table.filter("__train"))
    error = F.col("prediction") - F.col("label")
    plain = model.transform(table.filter("not __train")).agg(F.sum(error * error), F.count("*")).first()
    assert got[1] == plain[1] and math.isclose(got[0], plain[0], rel_tol=1e-6)
