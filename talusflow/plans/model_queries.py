"""Queries: splits, training, scoring, evaluation, text."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from talusflow.functions.text import tokens
from talusflow.operators import features as feat
from talusflow.operators import ml
from talusflow.operators.statistics import risk_trigger
from talusflow.plans import proxy
from talusflow.plans.jobs import score_points, training_features
from talusflow.plans.registry import VIEWS, query
from talusflow.schemas import REGIONS
from talusflow.session import shared_path, stored
from talusflow.sources.sinks import load_model, save_model

BUCKET_SQL = ("CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':42'), 1, 8)) AS UBIGINT) "
              "% 10000")


@query("train_test_split",
       "SELECT event_id, CASE WHEN " + BUCKET_SQL.format(key="event_id") + " < 8000 THEN 'train' "
       "ELSE 'test' END AS split FROM events")
def train_test_split(spark, sf_dir):
    return ml.with_split(proxy.table(spark, sf_dir, "events").select("event_id"), "event_id")


@query("split_counts",
       "SELECT event_type, CASE WHEN " + BUCKET_SQL.format(key="event_id")
       + " < 8000 THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows FROM events "
         "GROUP BY ALL")
def split_counts(spark, sf_dir):
    events = proxy.table(spark, sf_dir, "events").select("event_id", "event_type")
    return ml.with_split(events, "event_id").groupBy("event_type", "split").agg(
        F.count(F.lit(1)).alias("n_rows"))


def _flags(threshold=0.5):
    """What SQL can say of a score: it lies between 0 and 1, and decides the prediction."""
    score = F.col("probability")
    decided = (F.col("prediction") == 1) == (score > threshold)
    return {"in_range": F.coalesce(score.between(0, 1), F.lit(False)),
            "decided": F.coalesce(decided | (score == threshold), F.lit(False))}


def _embeddings(spark, sf_dir):
    rows = proxy.table(spark, sf_dir, "embeddings")
    return rows.select(
        "vec_id", (F.col("label") >= 5).cast("int").alias("label"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


@query("train_logreg",
       "SELECT vec_id, CAST(label >= 5 AS BIGINT) AS label, CAST(64 AS BIGINT) AS n_features, true AS in_range, "
       "true AS decided, CASE WHEN " + BUCKET_SQL.format(key="vec_id") + " < 8000 THEN 'train' "
       "ELSE 'test' END AS split FROM embeddings")
def train_logreg(spark, sf_dir):
    """Every vector, scored by a model that was trained on the training share."""
    rows = _embeddings(spark, sf_dir)
    train, _ = ml.train_test_split(rows, "vec_id")
    model = ml.train_classifier(train)
    scored = ml.with_split(ml.score(rows, model), "vec_id").withColumns(_flags())
    return scored.select("vec_id", "label", F.lit(int(model.stages[-1].numFeatures)).alias("n_features"),
                         "in_range", "decided", "split")


# Events with a feature vector, in the regions of their places.
IN_A_REGION = " ".join(
    f"WHEN longitude BETWEEN {r.min_longitude} AND {r.max_longitude} AND latitude BETWEEN "
    f"{r.min_latitude} AND {r.max_latitude} THEN '{r.name}'" for r in REGIONS)
VIEWS["trained_events"] = (
    f"SELECT event_id, max(label) AS label, any_value(CASE {IN_A_REGION} END) AS region "
    f"FROM deduped JOIN location USING (location_id) WHERE CASE {IN_A_REGION} END IS NOT NULL GROUP BY event_id")


@query("train_per_region",
       "SELECT event_id, region, CAST(label AS BIGINT) AS label, true AS in_range, true AS decided "
       "FROM trained_events")
def train_per_region(spark, sf_dir):
    """The events of each region under the model of their own region."""
    features = training_features(proxy.star(spark, sf_dir))
    models = ml.train_per_region(features)
    scored = ml.score_regions(features, models).withColumns(_flags())
    return scored.select("event_id", "region", "label", "in_range", "decided")


EVENT_BUCKET = BUCKET_SQL.format(key="event_id")


@query("train_evaluation",
       f"SELECT region, count(*) FILTER (WHERE {EVENT_BUCKET} < 8000) AS n_train, "
       f"count(*) FILTER (WHERE {EVENT_BUCKET} >= 8000) AS n_rows, "
       f"count(*) FILTER (WHERE {EVENT_BUCKET} >= 8000 AND label = 1) AS n_positive, true AS measured "
       "FROM trained_events GROUP BY region")
def train_evaluation(spark, sf_dir):
    """How each region's model does on its test share: one row per region."""
    features = stored(training_features(proxy.star(spark, sf_dir)), "features")
    found = ml.train_evaluation(features, ml.train_per_region(features))
    measured = F.lit(True)
    for name in ("accuracy", "area"):
        measured = measured & F.col(name).between(0, 1)
    return found.select("region", "n_train", "n_rows", "n_positive", measured.alias("measured"))


VIEWS["region_scores"] = (
    "SELECT event_id, event_type AS region, CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END AS label, "
    "CAST((event_id * 7919) % 1009 AS DOUBLE) / 1009 AS probability FROM events")


@query("evaluate_groups",
       "SELECT region, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_positive, "
       "count(*) FILTER (WHERE (label = 1) = (probability >= 0.5)) / count(*) AS accuracy, "
       "count(*) FILTER (WHERE label = 1 AND probability >= 0.5) "
       "/ count(*) FILTER (WHERE probability >= 0.5) AS precision, "
       "count(*) FILTER (WHERE label = 1 AND probability >= 0.5) / count(*) FILTER (WHERE label = 1) AS recall, "
       "round(sum(CASE WHEN label = 1 THEN upto - ties / 2.0 ELSE 0 END) "
       "/ (CAST(sum(label) AS DOUBLE) * (count(*) - sum(label))), 6) AS area FROM "
       "(SELECT *, CAST(sum(1 - label) OVER (PARTITION BY region ORDER BY probability RANGE BETWEEN UNBOUNDED "
       "PRECEDING AND CURRENT ROW) AS DOUBLE) AS upto, "
       "sum(1 - label) OVER (PARTITION BY region, probability) AS ties FROM region_scores) GROUP BY region")
def evaluate_groups(spark, sf_dir):
    """Given scores of five groups, evaluated in one pass."""
    scores = proxy.table(spark, sf_dir, "events").selectExpr(
        "event_type AS region", "CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END AS label",
        "CAST((event_id * 7919) % 1009 AS DOUBLE) / 1009 AS probability",
    ).withColumn("prediction", (F.col("probability") >= 0.5).cast("double"))
    return ml.evaluate_groups(scores, "region").withColumn("area", F.round("area", 6))


@query("score_region",
       'SELECT point_id AS "Index", any_value(CAST(longitude_info AS DOUBLE)) AS longitude_info, '
       "any_value(CAST(latitude_info AS DOUBLE)) AS latitude_info, any_value(CAST(date AS BIGINT)) AS date, "
       "any_value(CAST(year AS BIGINT)) AS year, any_value(CAST(month AS BIGINT)) AS month, "
       "any_value(CAST(elevation AS BIGINT)) AS elevation, any_value(time) AS time, "
       "count(DISTINCT hour(ts)) AS n_hours, "
       f"any_value(CASE {IN_A_REGION} END) AS region, any_value(CASE {IN_A_REGION} END) IS NOT NULL AS scored "
       "FROM (SELECT *, longitude_info AS longitude, latitude_info AS latitude FROM points) GROUP BY point_id")
def score_region(spark, sf_dir):
    """All points under the model of their region; points outside the regions have no score."""
    models = ml.train_per_region(training_features(proxy.star(spark, sf_dir)))
    scored = score_points(proxy.points(spark, sf_dir), models).withColumns(_flags())
    return scored.select("Index", *feat.POINT_INFO, "n_hours", "region",
                         (F.col("in_range") & F.col("decided")).alias("scored"))


@query("sink_model", "SELECT event_id, region, true AS equal FROM trained_events")
def sink_model(spark, sf_dir):
    """Models that were saved and loaded again give each event the score of the fitted ones."""
    features = stored(training_features(proxy.star(spark, sf_dir)), "features")
    root = shared_path(spark, "models")
    models = ml.train_per_region(features)
    for name, model in models.items():
        save_model(model, root, name, "2024-02-01")
    loaded = {name: load_model(root, name, "2024-02-01") for name in models}
    fitted = ml.score_regions(features, models).select("event_id", "region", "probability")
    again = ml.score_regions(features, loaded).select("event_id", F.col("probability").alias("_again"))
    return fitted.join(again, "event_id").select(
        "event_id", "region", (F.col("probability") == F.col("_again")).alias("equal"))


# A given score table: any two columns in [0, 1] of the same rows.
VIEWS["scores"] = (
    "SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label, "
    "CAST(event_id % 101 AS DOUBLE) / 100 AS probability FROM events")


def _scores(spark, sf_dir):
    return proxy.table(spark, sf_dir, "events").selectExpr(
        "event_id", "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label",
        "CAST(event_id % 101 AS DOUBLE) / 100 AS probability",
    ).withColumn("prediction", (F.col("probability") >= 0.5).cast("double"))


@query("confusion_counts",
       "SELECT CAST(label AS BIGINT) AS label, CAST(probability >= 0.5 AS BIGINT) AS prediction, "
       "count(*) AS n_rows FROM scores GROUP BY ALL")
def confusion_counts(spark, sf_dir):
    return ml.confusion_counts(_scores(spark, sf_dir))


@query("evaluate_binary",
       "SELECT count(*) AS n_rows, count(*) FILTER (WHERE (label = 1) = (probability >= 0.5)) "
       "/ count(*) AS accuracy, count(*) FILTER (WHERE label = 1 AND probability >= 0.5) "
       "/ count(*) FILTER (WHERE probability >= 0.5) AS precision, "
       "count(*) FILTER (WHERE label = 1 AND probability >= 0.5) "
       "/ count(*) FILTER (WHERE label = 1) AS recall FROM scores")
def evaluate_binary(spark, sf_dir):
    return ml.evaluate_binary(_scores(spark, sf_dir))


@query("area_under_roc",
       "SELECT round(pairs / (CAST(positives AS DOUBLE) * negatives), 6) AS area FROM (SELECT "
       "sum(CASE WHEN label = 1 THEN upto - ties / 2.0 ELSE 0 END) AS pairs, "
       "sum(label) AS positives, count(*) - sum(label) AS negatives FROM "
       "(SELECT label, CAST(sum(1 - label) OVER (ORDER BY probability RANGE BETWEEN UNBOUNDED "
       "PRECEDING AND CURRENT ROW) AS DOUBLE) AS upto, "
       "sum(1 - label) OVER (PARTITION BY probability) AS ties FROM scores))")
def area_under_roc(spark, sf_dir):
    scores = _scores(spark, sf_dir)
    area = round(ml.area_under_roc(scores), 6)
    return scores.agg(F.lit(area).alias("area"))


@query("risk_trigger", "SELECT event_id, probability FROM scores WHERE probability >= 0.7")
def risk_trigger_query(spark, sf_dir):
    return risk_trigger(_scores(spark, sf_dir), 0.7).select("event_id", "probability")


@query("tokenize_lower",
       "SELECT token, count(*) AS n FROM (SELECT "
       "unnest(regexp_split_to_array(regexp_replace(lower(text), '\\s+$', ''), '\\s')) AS token "
       "FROM documents) GROUP BY token")
def tokenize_lower(spark, sf_dir):
    words = proxy.table(spark, sf_dir, "documents").select(F.explode(tokens("text")).alias(
        "token"))
    return words.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query("text_classifier",
       "SELECT doc_id, CAST(l.quality AS DOUBLE) AS label, true AS in_range, true AS decided "
       "FROM documents JOIN labels l USING (doc_id)")
def text_classifier(spark, sf_dir):
    """The labelled documents under the word-count model."""
    texts = proxy.table(spark, sf_dir, "documents").join(
        proxy.table(spark, sf_dir, "labels"), "doc_id").select(
        "doc_id", "text", F.col("quality").cast("double").alias("label"))
    scored = ml.train_text_classifier(texts).transform(texts)
    return scored.withColumn("probability", vector_to_array("probability")[1]).withColumns(_flags()).select(
        "doc_id", "label", "in_range", "decided")
