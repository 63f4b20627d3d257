"""Arrays to ML vectors, without a Python UDF."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talusflow.schemas import HOURS, METRIC_NAMES


def sequence_name(metric: str) -> str:
    return f"features_{metric}"


def feature_array(metrics: list[str] = METRIC_NAMES) -> Column:
    """All metric sequences one after the other."""
    return F.concat(*[F.col(sequence_name(m)) for m in metrics])


def vectorise(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace array columns by vectors."""
    return df.withColumns({name: array_to_vector(F.col(name)) for name in columns})


def assemble_features(df: DataFrame, metrics: list[str] = METRIC_NAMES,
                      hours: int = HOURS) -> DataFrame:
    """Add `features`, one vector of fixed length.

    Rows whose sequences are not all `hours` long raise, since a shorter vector would shift the
    meaning of every later position.
    """
    whole = F.lit(True)
    for metric in metrics:
        whole = whole & (F.size(sequence_name(metric)) == hours)
    checked = F.when(whole, feature_array(metrics)).otherwise(
        F.raise_error(F.lit(f"a sequence does not have {hours} values"))
    )
    return df.withColumn("features", array_to_vector(checked))
