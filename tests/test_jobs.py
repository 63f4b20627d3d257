"""The three jobs from catalogue text to scores."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from talusflow.plans import jobs
from talusflow.schemas import METRICS, POINT_RECORD, RAW_METRIC_NAMES, WAREHOUSE
from talusflow.sources.sinks import load_model
from talusflow.sources.warehouse import load_warehouse
from talusflow.streaming import points as stream

PLACES = [(1, "Peru", -75.5, -10.25), (2, "Chile", -70.0, -33.0), (3, "Vietnam", 105.0, 20.0),
          (4, "Myanmar (Burma)", 96.0, 21.5), (5, "Atlantis", 0.0, 0.0)]


def observation_rows(places, days, shift=0.0):
    for number, _, lon, lat in places:
        for day in days:
            for hour in range(24):
                yield (lon, lat, day + timedelta(hours=hour), 100,
                       *[number + hour / 10 + shift] * 12)


def observations(spark, rows):
    metrics = ", ".join(f"{m} double" for m in RAW_METRIC_NAMES)
    return spark.createDataFrame(
        list(rows), f"longitude double, latitude double, datetime timestamp, elevation int, {metrics}")


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warehouse"))
    columns = ("id long, date string, time string, country string, near string, "
               "continentcode string, hazard_type string, landslide_type string, "
               "landslide_size string, latitude double, longitude double")
    records = [(n, "3/5/2021", "7:00:00", country, "x", "NA", "landslide", "fall", "small", lat, lon)
               for n, country, lon, lat in PLACES]
    csv = spark.createDataFrame(records, columns)
    other = spark.createDataFrame(
        [(1, "13/45/2020", "xx", "Peru", "x", "NA", "landslide", "fall", "nan", -10.25, -75.5)],
        columns)
    days = [datetime(2021, 3, 5), datetime(2020, 3, 5)]
    hourly = observations(spark, observation_rows(PLACES, days))
    countries = spark.createDataFrame([("Peru", "PER"), ("Chile", "CHL"), ("Vietnam", "VNM")],
                                      "name string, code string")

    def load(load_id):
        return jobs.run_ingestion(spark, {"csv": csv, "xlsx": other}, hourly, countries, path,
                                  load_id)

    load("day1")
    return path, load


def count_all(spark, path):
    return {n: df.count() for n, df in load_warehouse(spark, path).items()}


def test_ingestion_fills_the_warehouse_once(spark, warehouse):
    path, load = warehouse
    want = {"location": 5, "datetime": 10 * 25, "weather_data": 240, "soil": 960,
            "landslide_event": 10}
    assert count_all(spark, path) == want
    load("day1")
    assert count_all(spark, path) == want
    load("day2")
    assert count_all(spark, path) == want
    assert spark.read.parquet(f"{path}/quarantine_records").where("load_id = 'day1'").count() == 1
    codes = {r.country for r in load_warehouse(spark, path)["location"].collect()}
    assert codes == {"PER", "CHL", "VNM", "MMR", "Unknown"}


def test_training_and_scoring(spark, warehouse, tmp_path):
    tables = load_warehouse(spark, warehouse[0])
    features = jobs.training_features(tables)
    rows = features.collect()
    assert len(rows) == 8 and {r.label for r in rows} == {0, 1}
    assert all(r.features.size == 288 for r in rows)

    models_at = str(tmp_path / "models")
    paths = jobs.run_training(spark, tables, models_at, "2024-02-01")
    assert set(paths) == {"asia_pacific", "america"}
    models = {name: load_model(models_at, name, "2024-02-01") for name in paths}
    measured = spark.read.parquet(f"{models_at}/evaluation/run_date=2024-02-01").collect()
    assert {r.region for r in measured} == set(paths)
    # a region whose few events all fell into training has no test rows
    assert sum(r.n_train + (r.n_rows or 0) for r in measured) == 8

    hourly = observations(spark, observation_rows(PLACES, [datetime(2022, 1, 1)])).select(
        F.dense_rank().over(_by_place()).cast("long").alias("Index"),
        F.col("longitude").alias("longitude_info"), F.col("latitude").alias("latitude_info"),
        F.lit(1).alias("date"), F.lit(2022).alias("year"), F.lit(1).alias("month"), "elevation",
        F.lit("00:00:00").alias("time"), "datetime", *METRICS.values())
    out = str(tmp_path / "scores")
    jobs.run_predicting(spark, hourly, models, out, "2024-02-02")
    scores = spark.read.option("header", True).csv(out)
    assert scores.count() == 5
    assert scores.where("probability is null").count() == 1
    assert {r.region for r in scores.where("probability is not null").collect()} == {
        "asia_pacific", "america"}

    outline = spark.createDataFrame(
        [(lat, lon, 2022, 1, 1, country, "00:00:00") for _, country, lon, lat in PLACES],
        POINT_RECORD)
    seen = observations(spark, observation_rows(PLACES, [datetime(2022, 1, 1)]))
    from_outline = jobs.score_outline(outline, seen, models)
    want = jobs.score_points(hourly, models)
    where = ["longitude_info", "latitude_info", "region", "probability"]
    assert sorted(map(str, from_outline.select(*where).collect())) == sorted(
        map(str, want.select(*where).collect()))

    landing = str(tmp_path / "landing")
    hourly.write.parquet(landing)
    incoming = stream.read_points_stream(spark, landing, hourly.schema, "parquet")
    streamed = str(tmp_path / "streamed")
    stream.score_stream(incoming, lambda b, _: jobs.score_points(b, models), streamed,
                        str(tmp_path / "state")).awaitTermination()
    key = ["Index", "probability"]
    assert sorted(map(str, spark.read.parquet(streamed).select(*key).collect())) == sorted(
        map(str, jobs.score_points(hourly, models).select(*key).collect()))


def _by_place():
    from pyspark.sql import Window
    return Window.orderBy("longitude")


def test_warehouse_schemas_are_read_back(spark, warehouse):
    for name, df in load_warehouse(spark, warehouse[0]).items():
        assert df.schema.fieldNames() == WAREHOUSE[name].fieldNames()


RECORD = ("id long, date string, time string, country string, near string, continentcode string, "
          "hazard_type string, landslide_type string, landslide_size string, latitude double, "
          "longitude double")
DAYS = [datetime(2021, 3, 5), datetime(2020, 3, 5)]


def record(number, place, near="x"):
    _, country, lon, lat = PLACES[place - 1]
    return (number, "3/5/2021", "7:0:0", country, near, "NA", "landslide", "fall", "small", lat, lon)


def ingest(spark, path, load_id, records, seen):
    countries = spark.createDataFrame([("Peru", "PER"), ("Peru", "PEX"), ("Chile", "CHL")],
                                      "name string, code string")
    return jobs.run_ingestion(spark, {"csv": spark.createDataFrame(records, RECORD)}, seen, countries,
                              path, load_id)


def audit(tables):
    """Keys that occur twice or lead nowhere, over all tables."""
    from talusflow.operators.quality import check_foreign_key, check_primary_key
    from talusflow.schemas import RULES

    found = 0
    for name, df in tables.items():
        found += check_primary_key(df, list(RULES[name].primary_key)).count()
        for key, (parent, parent_key) in RULES[name].foreign_keys.items():
            found += check_foreign_key(df, key, tables[parent], parent_key).count()
    return found


def test_ingestion_loses_no_row(spark, tmp_path):
    path, long_id = str(tmp_path), 10**15
    records = [record(long_id, 1), record(2, 2), record(2, 2, "y"), record(2, 2), record(None, 3),
               record(4, 5)]
    twice = [(PLACES[0][2], PLACES[0][3], DAYS[0] + timedelta(hours=7, minutes=30), 90, *[0.0] * 12)]
    seen = observations(spark, [*observation_rows(PLACES[:3], DAYS), *twice])
    ingest(spark, path, "d1", records, seen)
    tables = load_warehouse(spark, path)
    kept = {name: spark.read.parquet(f"{path}/quarantine_{name}") for name in ("rows", "repeated", "unobserved", "hours")}
    assert {r.id for r in spark.read.parquet(f"{path}/event_keys").collect()} == {long_id, 2}
    assert kept["rows"].count() == 48 and kept["rows"].where("id is null").count() == 48
    assert [(r.id, r.datetime.minute) for r in kept["hours"].collect()] == [(long_id, 30)]
    assert kept["repeated"].agg(F.sum("n_rows")).first()[0] == 4
    assert [r.id for r in kept["unobserved"].collect()] == [4, 4]
    assert tables["landslide_event"].count() == 4 and tables["weather_data"].count() == 96
    assert audit(tables) == 0


def test_older_load_repeated_and_unfinished_load(spark, tmp_path):
    path = str(tmp_path)
    seen = observations(spark, observation_rows(PLACES, DAYS))
    ingest(spark, path, "d1", [record(1, 1), record(2, 2)], seen)
    ingest(spark, path, "d2", [record(3, 2), record(4, 3)], seen)
    before = {n: sorted(map(str, df.collect())) for n, df in load_warehouse(spark, path).items()}
    ingest(spark, path, "d1", [record(1, 1), record(2, 2)], seen)
    after = {n: sorted(map(str, df.collect())) for n, df in load_warehouse(spark, path).items()}
    assert after == before
    ingest(spark, path, "d1", [record(1, 1), record(5, 4)], seen)
    tables = load_warehouse(spark, path)
    assert tables["landslide_event"].count() == 10 and audit(tables) == 0

    # A load that ended before its event keys: all tables but that one.
    for name in WAREHOUSE:
        rows = spark.read.parquet(f"{path}/{name}").where("load_id = 'd2'").drop("load_id")
        rows.write.parquet(f"{path}/{name}/load_id=d3")
    assert {n: df.count() for n, df in load_warehouse(spark, path).items()} == {
        n: df.count() for n, df in tables.items()}
    ingest(spark, path, "d3", [record(6, 5)], seen)
    tables = load_warehouse(spark, path)
    assert tables["landslide_event"].count() == 12 and audit(tables) == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ingestion_scans_the_observations_once_and_joins_the_hours_once(spark, tmp_path, monkeypatch):
    from talusflow.operators import warehouse

    seen_path = str(tmp_path / "seen")
    observations(spark, observation_rows(PLACES, DAYS)).write.parquet(seen_path)
    plans, facts = [], []
    original_stored, original_keyed = jobs.stored, warehouse.keyed_hours

    def stored(df, purpose, **options):
        plans.append((purpose, plan(df)))
        return original_stored(df, purpose, **options)

    def keyed(*frames):
        facts.append(original_keyed(*frames))
        return facts[-1]

    monkeypatch.setattr(jobs, "stored", stored)
    monkeypatch.setattr(warehouse, "keyed_hours", keyed)
    ingest(spark, str(tmp_path / "w"), "d1", [record(1, 1), record(2, 2), record(4, 5)],
           spark.read.parquet(seen_path))
    scans = {purpose: text.count("FileScan parquet") for purpose, text in plans}
    assert scans["checked"] == 1 and len(facts) == 1
    assert all(seen_path not in text for purpose, text in plans if purpose != "checked")
    assert plans[[p for p, _ in plans].index("facts")][1].count("Join [source") == 1


def test_work_files_go_with_the_job(spark, tmp_path, monkeypatch):
    from talusflow import session

    monkeypatch.setattr(session, "shared_root", lambda _: str(tmp_path / "shared"))
    ingest(spark, str(tmp_path / "w"), "d1", [record(1, 1)],
           observations(spark, observation_rows(PLACES[:1], DAYS)))
    assert list((tmp_path / "shared").iterdir()) == []


def test_a_load_that_breaks_a_key_stays_unfinished(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    seen = observations(spark, observation_rows(PLACES, DAYS))
    ingest(spark, path, "d1", [record(1, 1)], seen)
    before = {n: df.count() for n, df in load_warehouse(spark, path).items()}
    original = jobs.load_star

    def clashing(staged, existing, store):
        """Numbers events from 1 again, as a load without the stored tables would."""
        return original(staged, {**existing, "landslide_event": existing["landslide_event"].limit(0)}, store)

    monkeypatch.setattr(jobs, "load_star", clashing)
    with pytest.raises(ValueError, match="landslide_event.event_id taken_key"):
        ingest(spark, path, "d2", [record(2, 2)], seen)
    assert {n: df.count() for n, df in load_warehouse(spark, path).items()} == before
    monkeypatch.setattr(jobs, "load_star", original)
    ingest(spark, path, "d2", [record(2, 2)], seen)
    assert audit(load_warehouse(spark, path)) == 0
    audits = spark.read.parquet(f"{path}/load_audit").where("load_id = 'd2'")
    assert audits.count() > 20 and audits.agg(F.sum("n_violations")).first()[0] == 0


def test_soil_is_reduced_below_its_shuffle(spark, warehouse):
    from talusflow.schemas import REGIONS

    tables = load_warehouse(spark, warehouse[0])
    text = plan(jobs.training_features(tables, REGIONS))
    soil = text.index("/soil")
    above = text[:soil].splitlines()
    # From the scan upwards: the filter on key bits comes before the exchange of the pivot.
    kinds = [next(k for k in ("BroadcastHashJoin", "Exchange hashpartitioning(weather_data_id") if k in line)
             for line in reversed(above)
             if "Exchange hashpartitioning(weather_data_id" in line or ("BroadcastHashJoin" in line and "_word" in line)]
    assert kinds[:2] == ["BroadcastHashJoin", "Exchange hashpartitioning(weather_data_id"]


def test_reduced_training_equals_the_whole_tables(spark, warehouse):
    from talusflow.functions.vectors import assemble_features
    from talusflow.operators import features as feat
    from talusflow.operators.regions import in_any_box

    tables = load_warehouse(spark, warehouse[0])
    whole = feat.event_sequences(
        feat.label_events(tables["landslide_event"].join(
            tables["location"].where(in_any_box()), "location_id"), tables["datetime"]),
        feat.hourly_facts(tables["weather_data"], tables["soil"], tables["datetime"]))
    want = assemble_features(whole).select("event_id", "label", "features")
    got = jobs.training_features(tables).select("event_id", "label", "features")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_points_without_observations_are_kept(spark, warehouse, tmp_path):
    models = {}
    tables = load_warehouse(spark, warehouse[0])
    paths = jobs.run_training(spark, tables, str(tmp_path / "m"), "d")
    models = {name: load_model(str(tmp_path / "m"), name, "d") for name in paths}
    outline = spark.createDataFrame(
        [(lat, lon, 2022, 1, 1, country, "00:00:00") for _, country, lon, lat in PLACES], POINT_RECORD)
    seen = observations(spark, observation_rows(PLACES[:2], [datetime(2022, 1, 1)]))
    rows = jobs.score_outline(outline, seen, models).collect()
    assert sorted(r.n_hours for r in rows) == [0, 0, 0, 24, 24]
    assert all((r.probability is None) == (r.n_hours == 0) for r in rows)


def test_points_are_numbered_and_scored_once_over_batches(spark, warehouse, tmp_path):
    paths = jobs.run_training(spark, load_warehouse(spark, warehouse[0]), str(tmp_path / "m"), "d")
    models = {name: load_model(str(tmp_path / "m"), name, "d") for name in paths}
    day = datetime(2022, 1, 1)
    rows = [*observation_rows(PLACES[:3], [day]),
            *list(observation_rows(PLACES[3:4], [day]))[:5],
            *list(observation_rows(PLACES[3:4], [day + timedelta(days=3)]))]
    seen = observations(spark, rows)
    point = lambda n, when=day: (PLACES[n][3], PLACES[n][2], when.year, when.month, when.day,
                                 PLACES[n][1], "00:00:00")
    score = jobs.outline_scorer(spark, seen, models, str(tmp_path / "state"))
    batches = [[point(0), point(1), point(3)], [point(1), point(2), point(0)],
               [point(3, day + timedelta(days=3)), point(3)]]
    for batch in batches:
        spark.createDataFrame(batch, POINT_RECORD).write.mode("append").json(str(tmp_path / "in"))
        arriving = stream.read_points_stream(spark, str(tmp_path / "in"), POINT_RECORD)
        stream.score_stream(arriving, score, str(tmp_path / "out"), str(tmp_path / "offsets")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    by_batch = {b: sorted((r.n_hours, r.date) for r in found if r.batch_id == b) for b in {r.batch_id for r in found}}
    # the point with five hours waits, until an observation two days after its day has been seen
    assert by_batch == {0: [(24, 1), (24, 1)], 1: [(24, 1)], 2: [(5, 1), (24, 4)]}
    assert len({r.Index for r in found}) == len(found) == 5 and max(r.Index for r in found) == 4
