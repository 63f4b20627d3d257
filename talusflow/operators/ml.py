"""Splitting, training, scoring and evaluation with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from talusflow.operators.indexing import running_totals
from talusflow.operators.regions import assign_region, filter_region
from talusflow.schemas import (
    LOGREG_PARAMS,
    REGIONS,
    SPLIT_SEED,
    SPLIT_WEIGHTS,
    TEXT_LOGREG_PARAMS,
    Region,
)

_BUCKETS = 10_000


def split_bucket(key: str, seed: int = SPLIT_SEED) -> Column:
    """A number from 0 to 9,999 that depends on the key and seed alone."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % _BUCKETS


def with_split(df: DataFrame, key: str, train_share: float = SPLIT_WEIGHTS[0],
               seed: int = SPLIT_SEED) -> DataFrame:
    """Add `split` ('train' or 'test'), the same for a key in every run and layout."""
    edge = round(train_share * _BUCKETS)
    return df.withColumn(
        "split", F.when(split_bucket(key, seed) < edge, F.lit("train")).otherwise(F.lit("test")))


def train_test_split(df: DataFrame, key: str | None = None,
                     weights: Sequence[float] = SPLIT_WEIGHTS, seed: int = SPLIT_SEED
                     ) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by key; without a key by `randomSplit`, which depends on the layout."""
    if key is None:
        train, test = df.randomSplit(list(weights), seed=seed)
        return train, test
    split = with_split(df, key, weights[0] / sum(weights), seed)
    return (split.where(F.col("split") == "train").drop("split"),
            split.where(F.col("split") == "test").drop("split"))


def train_classifier(features: DataFrame, params: dict | None = None) -> PipelineModel:
    """A fitted logistic regression on `features` and `label`."""
    stage = LogisticRegression(featuresCol="features", labelCol="label",
                               **(params or LOGREG_PARAMS))
    return Pipeline(stages=[stage]).fit(features)


def train_text_classifier(texts: DataFrame, params: dict | None = None,
                          n_features: int | None = None) -> PipelineModel:
    """Words, hashed counts and a logistic regression on `text` and `label`."""
    words = Tokenizer(inputCol="text", outputCol="words")
    counts = HashingTF(inputCol="words", outputCol="features")
    if n_features:
        counts = counts.setNumFeatures(n_features)
    model = LogisticRegression(**(params or TEXT_LOGREG_PARAMS))
    return Pipeline(stages=[words, counts, model]).fit(texts)


def train_per_region(features: DataFrame, regions: Sequence[Region] = REGIONS,
                     params: dict | None = None, key: str = "event_id"
                     ) -> dict[str, PipelineModel]:
    """One model per region that has training rows, on the training share of its events.

    The loop is over the configured boxes. The features are computed once and kept for all
    iterations of all regions; lost parts are recomputed.
    """
    kept = features.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        models = {}
        for region in regions:
            train, _ = train_test_split(filter_region(kept, region), key)
            if not train.isEmpty():
                models[region.name] = train_classifier(train, params)
        return models
    finally:
        kept.unpersist()


def score(features: DataFrame, model: PipelineModel) -> DataFrame:
    """Add `probability` of label 1 and `prediction`, on the executors."""
    scored = model.transform(features)
    return scored.withColumn("probability", vector_to_array("probability")[1]).drop(
        "rawPrediction")


def score_regions(features: DataFrame, models: dict[str, PipelineModel],
                  regions: Sequence[Region] = REGIONS, keep_unmatched: bool = False
                  ) -> DataFrame | None:
    """Each row scored by the model of its region; rows outside all boxes go, or stay without a score.

    The features are read once: every model scores the routed rows, and each row keeps the score
    of its own region. One more dot product per region is cheaper than a second feature plan.
    """
    served = [r for r in regions if r.name in models]
    if not served:
        return None
    routed = assign_region(features, served, keep_unmatched=keep_unmatched)
    for i, region in enumerate(served):
        routed = score(routed, models[region.name]).withColumnsRenamed(
            {"probability": f"_probability_{i}", "prediction": f"_prediction_{i}"})

    def own(column: str) -> Column:
        return F.coalesce(*[F.when(F.col("region") == r.name, F.col(f"_{column}_{i}"))
                            for i, r in enumerate(served)]).alias(column)

    return routed.select(*features.columns, "region", own("probability"), own("prediction"))


def evaluate_groups(scores: DataFrame, group: str, label: str = "label",
                    prediction: str = "prediction", probability: str = "probability") -> DataFrame:
    """One row per group: n_rows, n_positive, accuracy, precision, recall and the area under its ROC curve.

    The area is the share of (positive, negative) pairs in which the positive scores higher, ties
    counting half. Equal scores of a group are counted first; the negatives below each score come
    from running totals over parts of the ordered scores, so no task holds a group, and all groups
    share the one pass. NULL where a group has one label only.
    """
    want, got = F.col(label) == 1, F.col(prediction) == 1
    counts = scores.groupBy(F.col(group).alias("_group"), F.col(probability).alias("_score")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(want).alias("_pos"), F.count_if(~want).alias("_neg"),
        F.count_if(want == got).alias("_hit"), F.count_if(got).alias("_got"),
        F.count_if(want & got).alias("_both"))
    placed = running_totals(counts, ["_group", "_score"], {"_below": "_neg"})
    wide = {c: F.col(c).cast("decimal(18,0)") for c in ("_pos", "_neg", "_below")}
    # twice the pairs won, counted from the first negative of the first group
    totals = placed.groupBy("_group").agg(
        *[F.sum(c).alias(c) for c in ("_n", "_pos", "_neg", "_hit", "_got", "_both")],
        F.sum(wide["_pos"] * (wide["_below"] * 2 + wide["_neg"])).alias("_won"),
        F.min("_below").alias("_before"))
    won = F.col("_won") - wide["_pos"] * F.col("_before").cast("decimal(18,0)") * 2
    pairs = F.col("_pos").cast("double") * F.col("_neg").cast("double") * 2
    return totals.select(
        F.col("_group").alias(group), F.col("_n").alias("n_rows"), F.col("_pos").alias("n_positive"),
        (F.col("_hit") / F.col("_n")).alias("accuracy"),
        F.try_divide("_both", "_got").alias("precision"), F.try_divide("_both", "_pos").alias("recall"),
        F.try_divide(won.cast("double"), pairs).alias("area"))


def train_evaluation(features: DataFrame, models: dict[str, PipelineModel],
                     regions: Sequence[Region] = REGIONS, key: str = "event_id") -> DataFrame:
    """One row per region: its training rows, and how its model does on the test share of its events."""
    scored = score_regions(with_split(features, key), models, regions)
    trained = scored.where("split = 'train'").groupBy("region").agg(F.count(F.lit(1)).alias("n_train"))
    tested = evaluate_groups(scored.where("split = 'test'"), "region")
    # A row per region on both sides.
    return trained.join(tested, "region", "left")


def join_scores(scores: DataFrame, metadata: DataFrame, key: str = "Index") -> DataFrame:
    """Full outer join of scores and point descriptions."""
    return scores.join(metadata, key, "full")


def confusion_counts(scores: DataFrame, label: str = "label", prediction: str = "prediction"
                     ) -> DataFrame:
    """Rows per (label, prediction)."""
    return scores.groupBy(F.col(label).cast("long").alias("label"),
                          F.col(prediction).cast("long").alias("prediction")
                          ).agg(F.count(F.lit(1)).alias("n_rows"))


def evaluate_binary(scores: DataFrame, label: str = "label", prediction: str = "prediction"
                    ) -> DataFrame:
    """Accuracy, precision and recall in one row."""
    hit, want, got = (F.col(label) == F.col(prediction), F.col(label) == 1, F.col(prediction) == 1)
    n = F.count(F.lit(1))
    true_positive = F.count_if(want & got)
    return scores.agg(
        n.alias("n_rows"), (F.count_if(hit) / n).alias("accuracy"),
        F.try_divide(true_positive, F.count_if(got)).alias("precision"),
        F.try_divide(true_positive, F.count_if(want)).alias("recall"),
    )


def area_under_roc(scores: DataFrame, label: str = "label", probability: str = "probability"
                   ) -> float:
    """Area under the ROC curve of the scores."""
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=probability, metricName="areaUnderROC", numBins=0
    ).evaluate(scores)
