from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from talusflow.operators import catalogue as cat
from talusflow.operators import quality as qc
from talusflow.operators import warehouse as wh
from talusflow.operators.reshape import explode_hourly, unpivot_soil
from talusflow.plans import proxy
from talusflow.schemas import BLOCK_KEYS, METRIC_NAMES, RULES, STAGED_HOUR, WAREHOUSE


def block(source, number, lon, lat, day=1, control=False, hours=24):
    start = datetime(2024, 1, day)
    for h in range(hours):
        yield {
            "source": source, "id": number, "is_control": control,
            "datetime": start + timedelta(hours=h), "time": "10:00:00", "year": 2024, "month": 1,
            "date": day, "timezone": "UTC", "country": f"C{number}", "near": "n",
            "continent": "NA", "hazard_type": None if control else "landslide",
            "landslide_type": None if control else "fall", "size": "small", "elevation": 5,
            "longitude": lon, "latitude": lat,
            **{m: float(h) for m in METRIC_NAMES},
        }


def staged(spark, *blocks):
    rows = [row for b in blocks for row in b]
    names = STAGED_HOUR.fieldNames()
    loose = spark.createDataFrame(
        [tuple(r[n] for n in names) for r in rows],
        ", ".join(f"{f.name} " + ("double" if f.name in (*METRIC_NAMES, "longitude", "latitude")
                                  else f.dataType.simpleString()) for f in STAGED_HOUR.fields)
        .replace("smallint", "int"))
    return cat.stage_rows(loose)


def test_one_block_gives_the_documented_row_counts(spark):
    star = wh.load_star(staged(spark, block("a", 1, 10.0, 20.0)))
    counts = {name: df.count() for name, df in star.items()}
    assert counts == {"location": 1, "datetime": 25, "landslide_event": 1, "weather_data": 24,
                      "soil": 96, "event_keys": 1}
    fact = {r.fact_id: r for r in star["weather_data"].collect()}
    assert fact[1].temperature == 0 and fact[24].temperature == 23
    assert fact[24].datetime_id == 25
    assert star["soil"].agg(F.max("soil_value_id")).first()[0] == 96


def test_places_are_shared_after_rounding_to_eight_digits(spark):
    star = wh.load_star(staged(
        spark, block("a", 1, 1.123456784, 2.0), block("a", 2, 1.123456779, 2.0),
        block("a", 2, 1.123456779, 2.0, control=True), block("b", 1, 9.0, 2.0)))
    places = star["location"].orderBy("location_id").collect()
    assert [(p.location_id, p.country) for p in places] == [(1, "C1"), (2, "C1")]
    assert places[0].longitude == Decimal("1.12345678")
    assert star["landslide_event"].count() == 4
    assert {r.continent for r in places} == {"NA"}


def test_tables_keep_their_rules(spark):
    star = wh.load_star(staged(spark, block("a", 1, 1.0, 2.0), block("b", 7, 3.0, 4.0, day=9)))
    for name, rules in RULES.items():
        if name not in star:
            continue
        assert qc.split_quarantine(star[name], rules)[1].count() == 0
        assert qc.check_primary_key(star[name], list(rules.primary_key)).count() == 0
        for column, (parent, key) in rules.foreign_keys.items():
            assert qc.check_foreign_key(star[name], column, star[parent], key).count() == 0


def test_second_load_continues_keys_and_skips_loaded_blocks(spark):
    first = wh.load_star(staged(spark, block("a", 1, 1.0, 2.0)))
    more = staged(spark, block("a", 1, 1.0, 2.0), block("a", 2, 1.0, 2.0), block("a", 3, 5.0, 2.0))
    fresh = wh.without_loaded(more, first["event_keys"])
    second = wh.load_star(fresh, {n: first[n] for n in WAREHOUSE})
    events = second["landslide_event"].orderBy("event_id").collect()
    assert [(e.event_id, e.location_id, e.datetime_id) for e in events] == [(2, 1, 26), (3, 2, 51)]
    assert second["location"].collect()[0].location_id == 2
    facts = second["weather_data"].agg(F.min("fact_id"), F.max("fact_id")).first()
    assert tuple(facts) == (25, 72)


def test_lookup_takes_the_lowest_of_double_places(spark):
    places = spark.createDataFrame([(5, 1.0, 2.0), (3, 1.0, 2.0)],
                                   "location_id long, longitude double, latitude double").select(
        "location_id", F.col("longitude").cast("decimal(11,8)").alias("longitude"),
        F.col("latitude").cast("decimal(11,8)").alias("latitude"))
    points = spark.createDataFrame([(1, 1.0, 2.0), (2, 1.0, 3.0)],
                                   "id long, longitude double, latitude double")
    got = {r.id: r.location_id for r in wh.location_lookup(points, places, ["id"]).collect()}
    assert got == {1: 3, 2: None}


def test_bad_staging_rows_go_to_quarantine(spark):
    rows = list(block("a", 1, 1.0, 2.0))
    rows[3]["relative_humidity"] = 100.6
    rows[4]["temperature"] = 12345.0
    rows[5]["rain"] = float("nan")
    good, bad = qc.split_quarantine(staged(spark, rows), RULES["staged_hour"])
    assert good.count() == 21
    assert sorted(r.violations[0] for r in bad.collect()) == [
        "rain:not_null", "relative_humidity:range", "temperature:not_null"]


def test_catalogue_controls_and_undated(spark):
    raw = spark.createDataFrame(
        [(1, "2/29/2016", "7:05:00", "Peru", "x", "NA", "landslide", "fall", "nan", 1.0, 2.0),
         (2, "13/45/2020", "xx", "Peru", "x", "NA", "landslide", "fall", "big", 1.0, 2.0)],
        "id long, date string, time string, country string, near string, continentcode string, "
        "hazard_type string, landslide_type string, landslide_size string, latitude double, "
        "longitude double")
    dated, undated = cat.split_undated(cat.parse_catalogue(cat.catalogue_union(csv=raw)))
    assert [r.id for r in undated.collect()] == [2]
    both = cat.with_negative_controls(dated).orderBy("is_control").collect()
    original, control = both
    assert (original.month, original.date, original.landslide_type) == (2, 29, "fall")
    assert (control.year, control.month, control.date) == (2015, 2, 28)
    assert control.landslide_type is None and control.hazard_type is None
    assert original.landslide_size is None and control.continentcode == "NA"
    assert str(control.event_date) == "2015-02-28"


def test_country_fallbacks(spark):
    names = spark.createDataFrame([("Peru",), ("Myanmar (Burma)",), ("Atlantis",), (None,)],
                                  "country string")
    dim = spark.createDataFrame([("Peru", "PER")], "name string, code string")
    got = {r.country: r.country_code for r in cat.with_country_code(names, dim).collect()}
    assert got == {"Peru": "PER", "Myanmar (Burma)": "MMR", "Atlantis": "Unknown", None: "Unknown"}


def test_arrays_to_rows_and_soil_layers(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], [3.0, 4.0])],
                               "id long, a array<double>, b array<double>")
    df = df.withColumns({"start": F.to_timestamp(F.lit("2024-01-01 05:00:00")),
                         "end": F.to_timestamp(F.lit("2024-01-01 07:00:00"))})
    rows = [(r.datetime.hour, r.a, r.b) for r in explode_hourly(df, ["id"], ["a", "b"]).collect()]
    assert rows == [(5, 1.0, 3.0), (6, 2.0, 4.0)]
    wide = spark.range(1).select("id", *[F.lit(1.0).alias(m) for m in METRIC_NAMES[4:]])
    assert [r.layer for r in unpivot_soil(wide, ["id"]).collect()] == [0, 1, 2, 3]


@pytest.mark.parametrize("ids", [(1, 2, 3), (1, 2, 4)])
def test_outer_merge_keeps_every_id(spark, ids):
    a, b, c = (spark.createDataFrame([(i, n)], f"id long, {n} string") for i, n in zip(ids, "abc"))
    assert sorted(r.id for r in cat.outer_merge_id(a, b, c).collect()) == list(ids)


def test_event_keys_cover_every_block(spark):
    rows = staged(spark, block("a", 1, 1.0, 2.0), block("b", 1, 1.0, 2.0))
    keys = wh.load_star(rows)["event_keys"]
    back = wh.backfill_keys(wh.first_of_block(rows).select(*BLOCK_KEYS), keys)
    assert back.where("event_id is null or location_id is null").count() == 0 and back.count() == 2


def test_blocks_of_a_task_do_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(proxy, "BLOCK_ROWS", 100, raising=False)
    spark.range(4000).selectExpr(
        "id AS event_id", "id % 90 AS user_id", "CAST('2024-01-05 07:00:00' AS timestamp_ntz) AS ts",
        "IF(id % 2 = 0, 'error', 'purchase') AS event_type", "CAST(id AS double) AS value",
    ).write.parquet(f"{tmp_path}/events.parquet")
    hours = proxy.block_hours(spark, str(tmp_path))
    per_task = hours.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 4000 * 24
    assert max(r["count"] for r in per_task) <= 2 * 100 * 24
