import random

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from talusflow.operators import ml
from talusflow.schemas import LOGREG_PARAMS, REGIONS
from talusflow.sources.sinks import load_model, save_model
from talusflow.session import shared_path


@pytest.fixture(scope="module")
def separable(spark):
    """Two clouds far apart, in both regions and outside."""
    rng = random.Random(5)
    places = [(100.0, 0.0), (-100.0, 0.0), (0.0, 80.0)]
    rows = []
    for i in range(300):
        label = i % 2
        lon, lat = places[i % 3]
        rows.append((i, label, [rng.gauss(8 * label, 1), rng.gauss(-8 * label, 1)], lon, lat))
    df = spark.createDataFrame(rows, "event_id long, label int, a array<double>, "
                                     "longitude double, latitude double")
    return df.withColumn("features", array_to_vector("a")).drop("a")


def test_split_depends_on_the_key_alone(spark, separable):
    one = {r.event_id: r.split for r in ml.with_split(separable, "event_id").collect()}
    two = {r.event_id: r.split
           for r in ml.with_split(separable.repartition(9), "event_id").collect()}
    assert one == two
    share = sum(v == "train" for v in one.values()) / len(one)
    assert 0.7 < share < 0.9
    other = {r.event_id: r.split for r in ml.with_split(separable, "event_id", seed=1).collect()}
    assert other != one


def test_both_split_forms_are_whole(separable):
    for key in ("event_id", None):
        train, test = ml.train_test_split(separable, key)
        assert train.count() + test.count() == 300
        assert train.join(test, "event_id").count() == 0


def test_training_separates_clouds(separable):
    model = ml.train_classifier(separable)
    scores = ml.score(separable, model)
    assert ml.area_under_roc(scores) == pytest.approx(1.0)
    result = ml.evaluate_binary(scores).first()
    assert result.n_rows == 300 and result.accuracy == 1.0
    assert scores.where("probability < 0 or probability > 1").count() == 0
    assert model.stages[-1].getMaxIter() == LOGREG_PARAMS["maxIter"]


def test_each_region_is_scored_by_its_own_model(separable):
    models = ml.train_per_region(separable)
    assert set(models) == {r.name for r in REGIONS}
    scored = ml.score_regions(separable, models)
    assert {r.region: r["count"] for r in scored.groupBy("region").count().collect()} == {
        "asia_pacific": 100, "america": 100}
    only = ml.score_regions(separable, {"america": models["america"]})
    assert only.count() == 100
    assert ml.score_regions(separable, {}) is None


def test_saved_models_score_the_same(spark, separable):
    model = ml.train_classifier(separable)
    root = shared_path(spark, "models")
    path = save_model(model, root, "america", "2024-02-01")
    assert path.endswith("region=america/run_date=2024-02-01")
    again = load_model(root, "america", "2024-02-01")
    assert ml.score(separable, again).select("probability").collect() == ml.score(
        separable, model).select("probability").collect()


def test_metrics_without_positive_predictions(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.0)], "label int, prediction double")
    row = ml.evaluate_binary(df).first()
    assert (row.accuracy, row.precision, row.recall) == (0.5, None, 0.0)
    assert sorted(map(tuple, ml.confusion_counts(df).collect())) == [(0, 0, 1), (1, 0, 1)]


def test_scores_join_keeps_both_sides(spark):
    scores = spark.createDataFrame([(1, 0.5)], "Index long, probability double")
    meta = spark.createDataFrame([(2, 7)], "Index long, elevation int")
    assert sorted((r.Index, r.probability, r.elevation)
                  for r in ml.join_scores(scores, meta).collect()) == [(1, 0.5, None), (2, None, 7)]


def test_text_classifier_learns_words(spark):
    df = spark.createDataFrame(
        [(i, "slope rain fall" if i % 2 else "calm dry plain", float(i % 2)) for i in range(40)],
        "id long, text string, label double")
    scored = ml.train_text_classifier(df, n_features=1024).transform(df)
    assert scored.where(F.col("label") != F.col("prediction")).count() == 0


def test_groups_are_evaluated_in_one_pass(spark):
    rng = random.Random(9)
    rows = [("abc"[i % 3], int(rng.random() < 0.4), rng.randrange(20) / 20) for i in range(600)]
    rows += [("single", 1, 0.7), ("single", 1, 0.2)]
    df = spark.createDataFrame(rows, "region string, label int, probability double").withColumn(
        "prediction", (F.col("probability") >= 0.5).cast("double")).repartition(7)
    found = {r.region: r for r in ml.evaluate_groups(df, "region").collect()}
    for name in "abc":
        part = df.where(F.col("region") == name)
        assert found[name].area == pytest.approx(ml.area_under_roc(part))
        one = ml.evaluate_binary(part).first()
        assert (found[name].n_rows, found[name].accuracy, found[name].precision, found[name].recall) == tuple(one)
    assert found["single"].area is None and found["single"].recall == 0.5
