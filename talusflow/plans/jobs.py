"""The three jobs: ingest catalogues, train per region, score points."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talusflow.functions.scalars import to_schema
from talusflow.functions.vectors import assemble_features
from talusflow.operators import catalogue as cat
from talusflow.operators import features as feat
from talusflow.operators import ml
from talusflow.operators.indexing import with_row_index
from talusflow.operators.quality import load_audit, with_violations
from talusflow.operators.reduction import key_bits, likely_keys
from talusflow.operators.regions import in_any_box
from talusflow.operators.warehouse import PLACE, load_star, without_loaded
from talusflow.schemas import (
    BLOCK_KEYS,
    COORD,
    DAY_KEYS,
    EVENT_KEYS,
    HOURLY_FILE,
    METRICS,
    RAW_METRIC_NAMES,
    REGIONS,
    RULES,
    STAGED_HOUR,
    WAREHOUSE,
    Region,
)
from talusflow.session import stored, work_folder
from talusflow.sources.sinks import path_exists, save_model, write_csv
from talusflow.sources.warehouse import finished_rows
from talusflow.streaming.gate import POINT, HourGate, PointNumbers


def _stamped(observations: DataFrame) -> DataFrame:
    """Observations (place, datetime, elevation, raw metrics) with exact place and day columns."""
    return observations.select(
        *[F.col(c).cast(COORD).alias(c) for c in PLACE],
        F.year("datetime").alias("year"), F.month("datetime").alias("month"),
        F.dayofmonth("datetime").alias("date"), "datetime", "elevation", *RAW_METRIC_NAMES)


# Of repeated observations of one time the one with the lowest values counts.
_LOWEST_OBSERVED = ("elevation", *RAW_METRIC_NAMES)


def _placed(records: DataFrame) -> DataFrame:
    return records.withColumns({c: F.col(c).cast(COORD) for c in PLACE})


def enrich_with_observations(records: DataFrame, observations: DataFrame) -> DataFrame:
    """Catalogue records with the hourly rows of their place and day, in staging names.

    A record without an observation keeps one row, without hours; `observed` tells them apart.
    """
    seen = _stamped(observations).withColumn("observed", F.lit(True))
    joined = feat.join_point_observation(_placed(records), seen, BLOCK_KEYS, "datetime",
                                         _LOWEST_OBSERVED, how="left")
    return joined.withColumnsRenamed({
        **{raw: name for name, raw in METRICS.items()},
        "continentcode": "continent", "landslide_size": "size",
    }).withColumns({"timezone": F.lit("UTC"), "observed": F.coalesce("observed", F.lit(False))})


# What becomes of a checked hour.
GOOD, BROKEN, SURPLUS, UNOBSERVED = "good", "broken", "surplus", "unobserved"


def with_verdict(hourly: DataFrame) -> DataFrame:
    """Staged rows with the rules they break and a verdict, in one pass over the joined hours.

    Of the rows of a block's hour that keep the rules the first is good and becomes the hour's
    fact; the others are surplus. Rows that break a rule are spread by their content, so that
    records without an id do not meet in one task.
    """
    staged = cat.conform(hourly, T.StructType(
        [*STAGED_HOUR.fields, T.StructField("observed", T.BooleanType())]))
    checked = with_violations(staged, RULES["staged_hour"])
    broken = F.size("violations") > 0
    values = [c for c in STAGED_HOUR.fieldNames() if c not in (*BLOCK_KEYS, "datetime")]
    spread = F.when(broken, F.xxhash64("datetime", *values)).otherwise(F.lit(0))
    hour = Window.partitionBy(*BLOCK_KEYS, F.date_trunc("hour", "datetime"), broken, spread)
    rank = F.row_number().over(hour.orderBy("datetime", *values))
    verdict = (F.when(~F.col("observed"), UNOBSERVED).when(broken, BROKEN)
               .when(rank > 1, SURPLUS).otherwise(GOOD))
    return checked.withColumn("verdict", verdict).drop("observed")


def hours_of_points(numbered: DataFrame, observations: DataFrame) -> DataFrame:
    """Numbered points with the hourly rows of their place and day: the rows of an hourly file.

    A point without an observation keeps one row, without a time and values.
    """
    joined = feat.join_point_observation(_placed(numbered), _stamped(observations), ["Index"],
                                         "datetime", _LOWEST_OBSERVED, how="left")
    return joined.withColumnsRenamed(
        {"longitude": "longitude_info", "latitude": "latitude_info"}
    ).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in HOURLY_FILE.fields])


def enrich_points(points: DataFrame, observations: DataFrame) -> DataFrame:
    """`hours_of_points`, with `Index` numbering the points in the order of their place, day and time."""
    return hours_of_points(with_row_index(_placed(points), POINT, "Index"), observations)


def split_repeated(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One record of each block, the lowest in its columns, and the others with their number `n_rows`.

    Equal records are counted first, so copies of one block meet in one row. A record without a
    source or an id belongs to no block and stays: the rules on staged rows send it to quarantine.
    """
    keyed = F.lit(True)
    for key in BLOCK_KEYS:
        keyed = keyed & F.col(key).isNotNull()
    row = F.struct(*records.columns)
    counted = records.where(keyed).groupBy(*records.columns).agg(F.count(F.lit(1)).alias("n_rows"))
    first = counted.groupBy(*BLOCK_KEYS).agg(F.min(row).alias("_first"))
    surplus = counted.join(first, BLOCK_KEYS).select(
        *records.columns, (F.col("n_rows") - row.eqNullSafe(F.col("_first")).cast("long")).alias("n_rows"))
    return (first.select("_first.*").unionByName(records.where(~keyed)),
            surplus.where("n_rows > 0"))


def _free_load_id(finished: DataFrame, load_id: str) -> str:
    """The load id, or with a number behind it if that load is finished: it is never rewritten."""
    runs = finished.where((F.col("load_id") == load_id) | F.col("load_id").startswith(f"{load_id}.run"))
    taken = runs.select("load_id").distinct().count()
    return f"{load_id}.run{taken + 1}" if taken else load_id


def run_ingestion(spark: SparkSession, catalogues: dict[str, DataFrame],
                  observations: DataFrame, country_dim: DataFrame, warehouse: str,
                  load_id: str) -> dict[str, str]:
    """Catalogues to warehouse tables; returns the paths written.

    The checked hours are written once, a folder per verdict; the tables of the load and its
    quarantine are projections of them, so the observations are scanned once and the hours joined
    to their keys once. Work files go when the load is written.

    Each load has its own folder per table. Before it is marked as finished, its keys are audited
    against themselves and the stored tables (`load_audit`); a load that breaks a key raises and
    stays unfinished. `event_keys` is written last and marks the load as finished: the folders of an
    unfinished load are ignored, and overwritten when it is repeated. A finished load stays as it
    is, with its keys; repeating it adds the blocks that no load has taken, in a folder of its own.
    Undated, unobserved and repeated records, rows that break a rule and further rows of a block's
    hour go to quarantine folders.
    """
    with work_folder(spark):
        return _ingest(spark, catalogues, observations, country_dim, warehouse, load_id)


def _ingest(spark: SparkSession, catalogues: dict[str, DataFrame], observations: DataFrame,
            country_dim: DataFrame, warehouse: str, load_id: str) -> dict[str, str]:
    parsed = cat.parse_catalogue(cat.catalogue_union(**catalogues))
    dated, undated = cat.split_undated(parsed)
    controlled = cat.with_country_code(cat.with_negative_controls(dated), country_dim).withColumn(
        "id", to_schema("id", EVENT_KEYS["id"].dataType))
    records, repeated = split_repeated(controlled)

    existing = None
    if path_exists(spark, f"{warehouse}/event_keys"):
        before = {name: finished_rows(spark, warehouse, name, schema)
                  for name, schema in {**WAREHOUSE, "event_keys": EVENT_KEYS}.items()}
        load_id = _free_load_id(before["event_keys"], load_id)
        # The folder that is written must not be scanned, not even for rows that are then ignored.
        existing = {name: rows.where(F.col("load_id") != load_id).drop("load_id")
                    for name, rows in before.items()}
        records = without_loaded(records, existing["event_keys"])

    hourly = enrich_with_observations(
        records.withColumn("country", F.col("country_code")), observations)
    checked = stored(with_verdict(hourly), "checked", partition_by=("verdict",))

    def of(verdict: str) -> DataFrame:
        return checked.where(F.col("verdict") == verdict).drop("verdict")

    tables = load_star(of(GOOD).drop("violations"), existing, lambda df: stored(df, "facts"))
    event_keys = tables.pop("event_keys")
    tables |= {
        "quarantine_rows": of(BROKEN), "quarantine_records": undated,
        "quarantine_repeated": repeated, "quarantine_hours": of(SURPLUS).drop("violations"),
        "quarantine_unobserved": of(UNOBSERVED).drop("violations", "datetime", *METRICS)}
    paths = {}

    def write(name: str, df: DataFrame) -> None:
        paths[name] = f"{warehouse}/{name}"
        df.write.mode("overwrite").parquet(f"{paths[name]}/load_id={load_id}")

    for name, df in tables.items():
        write(name, df)
    loaded = {name: spark.read.schema(schema).parquet(f"{warehouse}/{name}/load_id={load_id}")
              for name, schema in WAREHOUSE.items()}
    audit = stored(load_audit(loaded, existing or {}, RULES), "audit")
    write("load_audit", audit)
    if broken := audit.where("n_violations > 0").collect():  # one row per rule at most
        raise ValueError(f"load {load_id} breaks " + ", ".join(
            f"{r.table_name}.{r.column_name} {r.rule} ({r.n_violations})" for r in broken))
    write("event_keys", event_keys)
    return paths


def training_hours(weather: DataFrame, times: DataFrame, labelled: DataFrame) -> DataFrame:
    """The weather of the places and days on which an event falls, with its calendar columns.

    The calendar days of all events are few (a calendar bounds them), so the time table is reduced
    to them before it is shuffled; the join to places and days then leaves only hours that some event uses.
    """
    days = labelled.select(*DAY_KEYS).distinct()
    calendar = days.select("year", "month", "date").distinct()
    times = times.join(F.broadcast(calendar), ["year", "month", "date"], "left_semi")
    values = [F.col(m).cast("double").alias(m) for m in feat.WEATHER_METRICS]
    weather = weather.join(days.select("location_id").distinct(), "location_id", "left_semi")
    hours = feat.join_datetime(weather.select("fact_id", "location_id", "datetime_id", *values), times)
    return hours.join(days, DAY_KEYS, "left_semi").select("fact_id", *DAY_KEYS, "time",
                                                          *feat.WEATHER_METRICS)


def training_features(tables: dict[str, DataFrame], regions: Sequence[Region] = REGIONS,
                      fill: float | str = 0.0) -> DataFrame:
    """`event_id`, `label`, `features` and coordinates of the events inside the regions.

    Each step reduces the next larger table: the boxes the places, the places the events, the
    places and days of the events the hourly weather, and the facts of those hours the soil, the
    largest table. Soil is reduced by hashed bits of the fact keys in its scan, so that what is
    shuffled for the pivot is about what the pivot needs, whatever the size of the warehouse. Events
    and hours are written once, since several steps read them.
    """
    coordinates = ["longitude", "latitude"]
    places = tables["location"].where(in_any_box(regions)).select("location_id", *coordinates)
    events = tables["landslide_event"].join(places, "location_id")
    labelled = stored(feat.label_events(events, tables["datetime"], coordinates), "labelled")
    hours = stored(training_hours(tables["weather_data"], tables["datetime"], labelled), "hours")
    soil = likely_keys(tables["soil"], "weather_data_id", key_bits(hours, "fact_id"))
    layers = feat.pivot_soil(soil).withColumnRenamed("weather_data_id", "fact_id")
    sequences = feat.event_sequences(labelled, hours.join(layers, "fact_id"), fill, coordinates)
    return assemble_features(sequences).select("event_id", "label", "features", *coordinates)


def run_training(spark: SparkSession, tables: dict[str, DataFrame], model_dir: str,
                 run_date: str, regions: Sequence[Region] = REGIONS) -> dict[str, str]:
    """Train, evaluate and save one model per region; returns the model paths.

    The features are computed once. What the models make of the test share, which they have not
    seen, is written to `evaluation`, one row per region.
    """
    with work_folder(spark):
        features = stored(training_features(tables, regions), "features")
        models = ml.train_per_region(features, regions)
        paths = {name: save_model(model, model_dir, name, run_date)
                 for name, model in models.items()}
        if models:
            ml.train_evaluation(features, models, regions).write.mode("overwrite").parquet(
                f"{model_dir}/evaluation/run_date={run_date}")
        return paths


def score_points(hourly: DataFrame, models: dict[str, PipelineModel],
                 regions: Sequence[Region] = REGIONS) -> DataFrame:
    """Hourly rows of points to one row per point, scored by the model of its region.

    One aggregation gives the sequences and the description of a point; the hourly rows are read
    once and nothing is joined back. Points outside the regions, and points without a single
    observed hour (`n_hours` 0), keep their row without a score.
    """
    points = feat.predict_sequences(hourly, describe=feat.POINT_INFO)
    vectors = assemble_features(points).select(
        "Index", *feat.POINT_INFO, "n_hours", "features", F.col("longitude_info").alias("longitude"),
        F.col("latitude_info").alias("latitude"))
    scored = ml.score_regions(vectors, models, regions, keep_unmatched=True)
    if scored is None:
        raise ValueError("no model fits the regions")
    known = F.col("n_hours") > 0
    return scored.select(
        "Index", "region", *[F.when(known, F.col(c)).alias(c) for c in ("probability", "prediction")],
        *feat.POINT_INFO, "n_hours")


def score_outline(points: DataFrame, observations: DataFrame, models: dict[str, PipelineModel],
                  regions: Sequence[Region] = REGIONS) -> DataFrame:
    """Arriving points to scores: enrich, pack, route by region, score."""
    return score_points(enrich_points(points, observations), models, regions)


def outline_scorer(spark: SparkSession, observations: DataFrame, models: dict[str, PipelineModel],
                   state: str, regions: Sequence[Region] = REGIONS, delay: str = "1 day"
                   ) -> Callable[[DataFrame, int], DataFrame]:
    """What `score_stream` does with a batch of arriving points: number, enrich, gate, route, score.

    A point that is delivered again is not scored again, and numbers run on over all batches. A
    point is scored when its 24 hours are observed, or with what there is once its day is over for `delay`.
    """
    numbers = PointNumbers(spark, f"{state}/points")
    gate = HourGate(spark, f"{state}/hours", delay)

    def score(batch: DataFrame, batch_id: int) -> DataFrame:
        new = numbers.first_seen(batch, batch_id)
        return score_points(gate.ready(hours_of_points(new, observations), batch_id), models, regions)

    return score


def run_predicting(spark: SparkSession, hourly: DataFrame, models: dict[str, PipelineModel],
                   out: str, run_date: str, regions: Sequence[Region] = REGIONS) -> str:
    """Score the points and write CSV by region and day, replacing the day's files of these regions.

    Points without a region have no score.
    """
    scores = score_points(hourly, models, regions).withColumn("run_date", F.lit(run_date))
    write_csv(scores, out, partition_by=("region", "run_date"))
    return out
