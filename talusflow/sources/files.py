"""Typed scans of CSV and JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line; lines that do not fit keep their text in `_corrupt_record`.

    Columns are taken by the names in the header, in any order; others are ignored, and a column
    of the schema that no header names is an error. The files of a folder must share one header.
    A line is judged by all columns, whichever of them are used later.
    """
    known = {f.name: f for f in schema.fields}
    header = spark.read.option("header", True).csv(path).columns
    if missing := [name for name in known if name not in header]:
        raise ValueError(f"no column {', '.join(missing)} in {path}")
    fields = [known.get(name, T.StructField(name, T.StringType())) for name in header]
    rows = (
        spark.read.schema(T.StructType([*fields, T.StructField(CORRUPT, T.StringType())]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    # Naming all columns here keeps Spark from parsing only those that a later step selects.
    whole_line = F.length(F.concat_ws("", *[F.col(f"`{name}`").cast("string") for name in known])) >= 0
    return rows.select(*[f"`{name}`" for name in known], F.when(whole_line, F.col(CORRUPT)).alias(CORRUPT))


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that were read whole, and the raw text of the others."""
    return (df.where(F.col(CORRUPT).isNull()).drop(CORRUPT),
            df.where(F.col(CORRUPT).isNotNull()).select(CORRUPT))


def read_json_records(spark: SparkSession, path: str, schema: T.StructType,
                      multi_line: bool = False) -> DataFrame:
    """JSON records: one object or one array of objects per line.

    `multi_line` reads a file that is a single array over many lines; Spark cannot split such a
    file, so large feeds should come as lines.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)
