"""The corpus pipeline: score out toxic texts, drop near-duplicates, mask personal data, mix, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of `documents`, with `n_chars` kept true. `run` writes each stage as Parquet before the next reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talusflow.llm import mixing, near_duplicates, packing, personal_data, toxicity
from talusflow.llm.common import table
from talusflow.session import remove, shared_path, work_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
THRESHOLD = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold; a text without words is kept."""
    docs = docs.select(*COLUMNS)
    with work_folder(spark):  # the model is all that stays of the training
        model = toxicity.train(toxicity.labelled_texts(docs, table(spark, sf_dir, "labels")), cut=THRESHOLD)
    return toxicity.scored(docs, model).where(
        (F.col("toxicity") < THRESHOLD) | (F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]")) == 0)
    ).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return near_duplicates.distinct_documents(docs.select(*COLUMNS))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each span of personal data replaced by its kind."""
    found = personal_data.find_personal_data(docs, keep=tuple(COLUMNS[1:]))
    clean = personal_data.masked(F.col("text"), F.col("all"))
    return found.select("doc_id", clean.alias("text"), "lang", "source",
                        F.when(F.size("all") > 0, F.length(clean).cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources, a row for each copy taken."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in windows, with the ids."""
    return packing.pack_documents(docs, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixing", mix),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; what a stage wrote on its way, and its predecessor's output, go when its own
    output stands."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        with work_folder(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        if before is not None:
            remove(spark, before)
        docs, before = spark.read.schema(result.schema).parquet(path), path
    return docs
