"""Cleaning, scaling and describing measurements, per group of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talusflow.operators.indexing import moving, running_totals
from talusflow.operators.skew import hot_keys, salted_join, skew_join
from talusflow.session import stored


def noise_filter(df: DataFrame, sensor: str, order_by: list[str], value: str,
                 before: int = 2, after: int = 2, block_rows: int = 100_000) -> DataFrame:
    """Add `smoothed`, the mean of the readings around each one of the same sensor."""
    return moving(df, sensor, order_by, before, after,
                  {"smoothed": lambda frame: F.avg(value).over(frame)}, block_rows)


def group_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Count, mean, sample deviation, lowest and highest value per group."""
    return df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("stddev"), F.min(value).alias("low"),
        F.max(value).alias("high"),
    )


def with_group_stats(df: DataFrame, keys: list[str], value: str, by: list[str]) -> DataFrame:
    """Each row with the statistics of its group (NULL without a key); very large groups are joined in parts.

    The statistics, one row per group, are written once: finding the large groups and joining both
    read them, and not the table again.
    """
    stats = stored(group_stats(df, keys, value), "group-stats")
    return salted_join(df, stats, keys, by, hot_keys(stats, keys, "n"), "left")


def standardize(df: DataFrame, keys: list[str], value: str, by: list[str]) -> DataFrame:
    """Add `scaled`: distance from the group mean in deviations (NULL without spread)."""
    joined = with_group_stats(df, keys, value, by)
    scaled = F.when(F.col("stddev") > 0, (F.col(value) - F.col("mean")) / F.col("stddev"))
    return joined.select(*df.columns, scaled.alias("scaled"))


def minmax_normalize(df: DataFrame, keys: list[str], value: str, by: list[str]) -> DataFrame:
    """Add `scaled`: position between the lowest and highest value of the group, 0 to 1."""
    joined = with_group_stats(df, keys, value, by)
    width = F.col("high") - F.col("low")
    return joined.select(*df.columns,
                         F.when(width > 0, (F.col(value) - F.col("low")) / width).alias("scaled"))


def outlier_filter(df: DataFrame, sensor: str, value: str, by: list[str],
                   limit: float = 3.0) -> DataFrame:
    """Rows within `limit` deviations of their sensor's mean.

    Rows of sensors without spread, without a sensor or without a value are kept.
    """
    joined = with_group_stats(df, [sensor], value, by)
    near = F.abs(F.col(value) - F.col("mean")) <= limit * F.col("stddev")
    return joined.where(F.coalesce(near, F.lit(True))).select(*df.columns)


def ranked_counts(counts: DataFrame, groups: list[str], value: str, by: list[str]) -> DataFrame:
    """Counted values with `_upto`, the rows of their group up to and with this value, and `_n`, all its rows.

    `counts` has `_c` rows per group and value. Running totals over parts of the ordered table give
    the rows before each value; a group's own start is taken off. A group with very many values lies
    in many parts, and no task holds more than its part. Groups without a key are left out.
    """
    for key in groups:
        counts = counts.where(F.col(key).isNotNull())
    placed = running_totals(counts, [*groups, value], {"_before": "_c"})
    starts = placed.groupBy(*groups).agg(F.min("_before").alias("_start"), F.sum("_c").alias("_n"),
                                         F.count(F.lit(1)).alias("_values"))
    starts = stored(starts, "group-starts")
    joined = salted_join(placed, starts.drop("_values"), groups, by, hot_keys(starts, groups, "_values"))
    return joined.withColumn("_upto", F.col("_before") - F.col("_start") + F.col("_c")).drop("_before", "_start")


def exact_quantiles(df: DataFrame, keys: list[str], value: str,
                    probabilities: dict[str, float]) -> DataFrame:
    """Interpolated quantiles per group, named as in `probabilities`; rows without a key have none.

    Equal values are counted before the shuffle, and the counts ranked by `ranked_counts`, so a
    group of any number of rows and values spreads over many tasks.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("_c"))
    ranked = ranked_counts(counts, keys, value, [value])
    aggregates, results = [], []
    for name, p in probabilities.items():
        position = (F.col("_n") - 1) * F.lit(p)
        at_or_after = {"low": F.floor(position), "high": F.ceil(position)}
        for side, index in at_or_after.items():
            aggregates.append(
                F.min(F.when(F.col("_upto") > index, F.col(value))).cast("double").alias(
                    f"_{name}_{side}"))
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        results.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return ranked.groupBy(*keys).agg(F.max("_n").alias("_n"), *aggregates).select(*keys, *results)


def outlier_filter_iqr(df: DataFrame, sensor: str, value: str, by: list[str],
                       reach: float = 1.5) -> DataFrame:
    """Rows within `reach` interquartile ranges of their sensor's quartiles.

    Rows without a sensor or a value are kept.
    """
    quartiles = exact_quantiles(df, [sensor], value, {"_q1": 0.25, "_q3": 0.75})
    joined = skew_join(df, quartiles, [sensor], by, "left")
    margin = (F.col("_q3") - F.col("_q1")) * reach
    near = F.col(value).between(F.col("_q1") - margin, F.col("_q3") + margin)
    return joined.where(F.coalesce(near, F.lit(True))).select(*df.columns)


def metric_statistics(facts: DataFrame, keys: list[str], metrics: dict[str, str]) -> DataFrame:
    """Count, mean, deviation, range and quartiles of each metric per group.

    `metrics` maps each metric to its decimal type. Values are counted per group first; every
    statistic then comes from the counts. Rows without a key are left out.
    """
    long = facts.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast(kind).cast("decimal(9,3)").alias("v"))
        for m, kind in metrics.items()
    ]))).where(F.col("v").isNotNull())
    groups = [*keys, "metric"]
    counts = long.groupBy(*groups, "v").agg(F.count(F.lit(1)).alias("_c"))
    ranked = ranked_counts(counts, groups, "v", ["v"])

    def at(index):
        return F.min(F.when(F.col("_upto") > index, F.col("v"))).cast("double")

    aggregates = []
    for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        position = (F.col("_n") - 1) * F.lit(p)
        aggregates += [at(F.floor(position)).alias(f"_{name}_low"),
                       at(F.ceil(position)).alias(f"_{name}_high")]

    def quantile(name: str, p: float):
        position = (F.col("n") - 1) * F.lit(p)
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        return (low + (high - low) * (position - F.floor(position))).alias(name)

    n, total, squares = F.col("n"), F.col("_sum"), F.col("_squares")
    spread = (squares * n - total * total).cast("double") / (n * (n - 1))
    return ranked.groupBy(*groups).agg(
        F.max("_n").alias("n"), F.min("v").cast("double").alias("low"),
        F.max("v").cast("double").alias("high"),
        F.sum(F.col("v") * F.col("_c").cast("decimal(18,0)")).cast("decimal(24,3)").alias("_sum"),
        F.sum((F.col("v") * F.col("v")).cast("decimal(18,6)")
              * F.col("_c").cast("decimal(18,0)")).cast("decimal(32,6)").alias("_squares"),
        *aggregates,
    ).select(
        *groups, "n", (total.cast("double") / n).alias("mean"),
        F.when(n > 1, F.sqrt(spread)).alias("stddev"), "low", "high",
        quantile("q1", 0.25), quantile("median", 0.5), quantile("q3", 0.75),
    )


def risk_trigger(scores: DataFrame, threshold: float, probability: str = "probability"
                 ) -> DataFrame:
    """Scores that reach the threshold."""
    return scores.where(F.col(probability) >= threshold)
