import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from talusflow.functions.vectors import assemble_features, sequence_name
from talusflow.operators import features as feat
from talusflow.operators import skew
from talusflow.plans import feature_queries as fq
from talusflow.schemas import DAY_KEYS, DEPTHS, METRIC_NAMES, METRICS

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def soil_rows(spark, rows):
    return spark.createDataFrame(
        rows, "weather_data_id long, depth string, temperature decimal(5,2), moisture decimal(6,3)")


def test_pivot_keeps_sub_zero_and_missing_layers(spark):
    soil = soil_rows(spark, [(1, "0 to 7 cm", Decimal("-3.5"), Decimal("0.4"))])
    row = feat.pivot_soil(soil).first()
    assert row.soil_temp_0_to_7 == -3.5 and row.soil_temp_7_to_28 is None
    layers = soil.unionByName(soil_rows(spark, [(1, "7 to 28 cm", Decimal("-1"), Decimal("0"))]))
    floored = feat.pivot_soil(layers, floor_zero=True).first()
    assert floored.soil_temp_0_to_7 == 0.0 and floored.soil_temp_28_to_100 == 0.0
    assert floored.soil_moisture_0_to_7 == 0.4
    assert feat.pivot_soil(layers).first().soil_temp_7_to_28 == -1.0


def facts_frame(spark, rows):
    """(fact_id, location_id, day, time, temperature); the other metrics are 1."""
    df = spark.createDataFrame(rows, "fact_id long, location_id long, date int, time string, "
                                     "temperature double")
    others = [F.lit(1.0).alias(m) for m in METRIC_NAMES if m != "temperature"]
    return df.select("fact_id", "location_id", F.lit(2024).alias("year"), F.lit(1).alias("month"),
                     "date", "time", "temperature", *others)


def events_frame(spark, rows):
    """(event_id, location_id, day, type)"""
    df = spark.createDataFrame(rows, "event_id long, location_id long, date int, "
                                     "landslide_type string")
    return df.select("event_id", "landslide_type", F.lit("small").alias("size"), "location_id",
                     F.lit(2024).alias("year"), F.lit(1).alias("month"), "date",
                     feat.label_of().alias("label"))


def day_of_facts(location, day, first_id):
    return [(first_id + h, location, day, f"{h:02d}:00:00", float(h)) for h in range(24)]


def test_two_events_on_one_day_get_24_rows_each(spark):
    facts = facts_frame(spark, day_of_facts(1, 5, 100) + day_of_facts(1, 5, 200))
    events = events_frame(spark, [(1, 1, 5, "fall"), (2, 1, 5, None), (3, 1, 6, None)])
    rows = feat.dedup_event_hour(events, facts).collect()
    assert len(rows) == 48
    assert {r.fact_id for r in rows} == set(range(100, 124))
    counted = feat.join_event_weather_day(events, feat.facts_per_hour(facts))
    assert counted.agg(F.sum("n_facts")).first()[0] == 96


def test_sequences_are_ordered_dense_and_labelled(spark):
    rows = day_of_facts(1, 5, 100)
    random.Random(1).shuffle(rows)
    missing = [r for r in rows if not r[3].startswith("03")]
    facts = facts_frame(spark, missing)
    events = events_frame(spark, [(1, 1, 5, "fall"), (2, 1, 5, None)])
    got = {r.event_id: r for r in feat.event_sequences(events, facts, fill=-1.0).collect()}
    want = [float(h) if h != 3 else -1.0 for h in range(24)]
    assert got[1].features_temperature == want == got[2].features_temperature
    assert (got[1].label, got[2].label, got[1].n_hours) == (1, 0, 23)


def test_null_hour_and_mean_fill(spark):
    rows = [(f, 1, 5, t, v if v is None else float(v)) for f, _, _, t, v in day_of_facts(1, 5, 1)]
    rows[0] = (1, 1, 5, "00:00:00", None)
    facts = facts_frame(spark, rows)
    events = events_frame(spark, [(1, 1, 5, None)])
    by_zero = feat.event_sequences(events, facts).first().features_temperature
    by_mean = feat.event_sequences(events, facts, fill="mean").first().features_temperature
    assert by_zero[0] == 0.0 and by_mean[0] == pytest.approx(sum(range(1, 24)) / 23)
    assert len(by_zero) == len(by_mean) == 24


def test_vector_has_288_values_and_rejects_short_sequences(spark):
    facts = facts_frame(spark, day_of_facts(1, 5, 1))
    sequences = feat.event_sequences(events_frame(spark, [(1, 1, 5, "x")]), facts)
    vector = assemble_features(sequences).first().features
    assert vector.size == 288 and list(vector[:24]) == [float(h) for h in range(24)]
    short = sequences.withColumn(sequence_name("rain"), F.slice(sequence_name("rain"), 1, 23))
    with pytest.raises(Exception, match="does not have 24"):
        assemble_features(short).collect()


def test_layout_does_not_change_results(spark):
    labelled, facts = fq._labelled(spark, SF), fq._facts(spark, SF)

    def run(n):
        return sorted(map(str, feat.event_sequences(
            labelled.repartition(n, F.rand(7)), facts.repartition(n, F.rand(n))).collect()))

    assert run(1) == run(7)


def test_hot_days_give_the_same_result(spark, monkeypatch):
    labelled, facts = fq._labelled(spark, SF), fq._facts(spark, SF)
    plain = sorted(map(str, feat.event_sequences(labelled, facts).collect()))
    joined = sorted(map(str, feat.dedup_event_hour(labelled, facts).collect()))
    counted = []
    original = skew.hot_keys

    def sharp(counts, keys, rows, parts=20, floor=1):
        hot = original(counts, keys, rows, parts=200, floor=1)
        counted.append(0 if hot is None else hot.count())
        return hot

    monkeypatch.setattr(skew, "hot_keys", sharp)
    salted = feat.event_sequences(labelled, facts)
    assert "_salt" in plan(salted) and counted[0] > 0
    assert sorted(map(str, salted.collect())) == plain
    assert sorted(map(str, feat.dedup_event_hour(labelled, facts).collect())) == joined


def test_a_hot_day_copies_its_packed_row_and_no_fact(spark, monkeypatch):
    events = events_frame(spark, [(i, 1, 5, None) for i in range(300)] + [(900, 1, 6, "fall")])
    facts = facts_frame(spark, day_of_facts(1, 5, 100) + day_of_facts(1, 5, 200) + day_of_facts(1, 6, 300))
    copied, hot_tables = [], []
    original_hot, original_replicate = skew.hot_keys, skew.replicate

    def sharp(counts, keys, rows, parts=20, floor=1):
        hot_tables.append(original_hot(counts, keys, rows, parts=20, floor=1))
        return hot_tables[-1]

    def replicate(df, hot, keys):
        copied.append(original_replicate(df, hot, keys))
        return copied[-1]

    monkeypatch.setattr(skew, "hot_keys", sharp)
    monkeypatch.setattr(skew, "replicate", replicate)
    rows = feat.event_sequences(events, facts).collect()
    assert len(rows) == 301 and all(r.n_hours == 24 for r in rows)
    salts = sum(r._salts for r in hot_tables[0].collect())
    assert salts > 1 and copied[0].count() == 1 + salts  # the other day, and the hot one per salt


def test_predict_sequences_take_the_first_row_of_an_hour(spark):
    rows = [(7, f"2024-01-01 {h:02d}:{m:02d}:00", float(h * 100 + m)) for h in range(24)
            for m in (30, 10)]
    df = spark.createDataFrame(rows, "Index long, datetime string, v double").select(
        "Index", F.to_timestamp("datetime").alias("datetime"),
        *[F.col("v").alias(raw) for raw in METRICS.values()])
    got = feat.predict_sequences(df).first()
    assert got.features_rain == [h * 100.0 + 10 for h in range(24)]


def test_union_form_equals_the_label_expression(spark):
    events = events_frame(spark, [(1, 1, 5, "fall"), (2, 1, 5, None)])
    by_union = feat.union_labelled(events.drop("label")).select("event_id", "label")
    assert sorted(by_union.collect()) == sorted(events.select("event_id", "label").collect())


def test_plan_of_the_flagship(spark):
    text = plan(fq.assembled(spark, SF))
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert "rangepartitioning" not in text and "CartesianProduct" not in text
    assert text.count("Generate inline") == 1  # the soil table is read once
    days = text[text.index("SortAggregate"):]
    assert days.count("hashpartitioning(location_id") == 1  # dedup, grid and order in one shuffle


def test_dedup_keeps_one_row_per_task_before_the_shuffle(spark):
    text = plan(feat.first_per_key(fq._facts(spark, SF), [*DAY_KEYS, "time"], ["fact_id"]))
    assert text.count("WindowGroupLimit") == 2


def test_layers_cover_the_metrics():
    layers = [f"soil_temp_{s}" for s in DEPTHS.values()]
    assert METRIC_NAMES[4:8] == layers and len(METRIC_NAMES) == 12
