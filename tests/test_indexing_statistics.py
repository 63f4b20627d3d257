import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from talusflow.operators import indexing as ix
from talusflow.operators import statistics as st
from talusflow.operators.skew import count_hot_keys, hot_keys, salted_join


def readings(spark, n=400, seed=3):
    """One sensor holds a third of the rows."""
    rng = random.Random(seed)
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 7}", rng.randrange(50), rng.randrange(-500, 500) / 100)
            for i in range(n)]
    df = spark.createDataFrame(rows, "id long, sensor string, t int, v double")
    return rows, df.repartition(5)


def test_row_index_is_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), F.lit("x").alias("v"))
    got = ix.with_row_index(df.repartition(7), ["k"], start=1).collect()
    assert sorted((r.k, r.row_index) for r in got) == [(k, k + 1) for k in range(1000)]


def test_row_index_of_nothing(spark):
    assert ix.with_row_index(spark.range(0), ["id"]).count() == 0


def test_first_per_key(spark):
    rows, df = readings(spark)
    got = {r.sensor: r.id for r in ix.first_per_key(df, ["sensor"], ["t", "id"]).collect()}
    want = {}
    for i, s, t, _ in sorted(rows, key=lambda r: (r[2], r[0])):
        want.setdefault(s, i)
    assert got == want


@pytest.mark.parametrize("block", [7, 50, 10_000])
def test_moving_mean_over_blocks(spark, block):
    rows, df = readings(spark)
    got = {r.id: r.smoothed for r in st.noise_filter(df, "sensor", ["t", "id"], "v",
                                                     block_rows=block).collect()}
    want = {}
    for sensor in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == sensor), key=lambda r: (r[2], r[0]))
        for i, r in enumerate(own):
            near = [x[3] for x in own[max(0, i - 2):i + 3]]
            want[r[0]] = sum(near) / len(near)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], abs_tol=1e-9) for k in want)


def test_frame_must_fit_a_block(spark):
    with pytest.raises(ValueError):
        st.noise_filter(readings(spark)[1], "sensor", ["t"], "v", before=5, after=5, block_rows=5)


@pytest.mark.parametrize("n", [0, 1, 7, 100, 101])
def test_positional_splits_round_down(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k")
    got = {r.k: r.split for r in ix.positional_splits(
        df, ["k"], {"dev": 0.1, "test": 0.2}, "production").collect()}
    dev, test = int(n * 0.1), int(n * 0.2)
    assert got == {k: "dev" if k < dev else "test" if k < dev + test else "production"
                   for k in range(n)}
    assert ix.head_share(df, ["k"], 0.1).count() == dev


def test_hot_keys_are_few_and_salts_bounded(spark):
    _, df = readings(spark, 900)
    hot = count_hot_keys(df, ["sensor"], parts=8, floor=1)
    rows = hot.collect()
    assert {r.sensor for r in rows} == {"hot"} and sum(r._salts for r in rows) <= 16
    assert count_hot_keys(df, ["sensor"]) is None
    assert count_hot_keys(df.limit(0), ["sensor"]) is None


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    _, df = readings(spark)
    df = df.withColumn("sensor", F.when(F.col("id") % 5 != 1, F.col("sensor")))
    few = spark.createDataFrame([("hot", 1), ("hot", 2), ("s1", 3)], "sensor string, w int")
    hot = count_hot_keys(df, ["sensor"], parts=50, floor=1)
    got = salted_join(df, few, ["sensor"], ["id"], hot, how).select("id", "sensor", "w")
    want = df.join(few, "sensor", how).select("id", "sensor", "w")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_hot_keys_from_given_counts(spark):
    counts = spark.createDataFrame([("a", 90), ("b", 10)], "k string, n long")
    assert [tuple(r) for r in hot_keys(counts, ["k"], "n", parts=4, floor=1).collect()] == [("a", 4)]


def test_scaling(spark):
    rows, df = readings(spark)
    scaled = {r.id: r.scaled for r in st.standardize(df, ["sensor"], "v", ["id"]).collect()}
    unit = {r.id: r.scaled for r in st.minmax_normalize(df, ["sensor"], "v", ["id"]).collect()}
    hot = [r[3] for r in rows if r[1] == "hot"]
    mean, dev = statistics.mean(hot), statistics.stdev(hot)
    for i, s, _, v in rows:
        if s == "hot":
            assert math.isclose(scaled[i], (v - mean) / dev, abs_tol=1e-9)
            assert math.isclose(unit[i], (v - min(hot)) / (max(hot) - min(hot)), abs_tol=1e-9)
    flat = spark.createDataFrame([(1, "a", 2.0), (2, "a", 2.0)], "id long, sensor string, v double")
    assert [r.scaled for r in st.standardize(flat, ["sensor"], "v", ["id"]).collect()] == [None, None]


def test_quantiles_match_interpolation(spark):
    rows, df = readings(spark)
    exact = df.withColumn("v", F.col("v").cast("decimal(5,2)"))
    got = {r.sensor: (r.a, r.b, r.c) for r in st.exact_quantiles(
        exact, ["sensor"], "v", {"a": 0.1, "b": 0.5, "c": 1.0}).collect()}
    for sensor, found in got.items():
        own = sorted(r[3] for r in rows if r[1] == sensor)
        for p, value in zip((0.1, 0.5, 1.0), found):
            at = (len(own) - 1) * p
            low, high = own[math.floor(at)], own[math.ceil(at)]
            assert math.isclose(value, low + (high - low) * (at - math.floor(at)), abs_tol=1e-9)


def test_outliers(spark):
    rows = [(i, "a", 1.0 + i % 3) for i in range(50)] + [(99, "a", 1000.0), (100, "b", 5.0)]
    df = spark.createDataFrame(rows, "id long, sensor string, v double")
    kept = {r.id for r in st.outlier_filter(df, "sensor", "v", ["id"]).collect()}
    assert kept == {r[0] for r in rows} - {99}
    exact = df.withColumn("v", F.col("v").cast("decimal(6,2)"))
    kept = {r.id for r in st.outlier_filter_iqr(exact, "sensor", "v", ["id"]).collect()}
    assert kept == {r[0] for r in rows} - {99}


def test_trigger_includes_the_threshold(spark):
    df = spark.createDataFrame([(0.69,), (0.7,), (None,)], "probability double")
    assert [r[0] for r in st.risk_trigger(df, 0.7).collect()] == [0.7]


def test_running_totals_and_numbers_per_key(spark):
    rows = [(i, "hot" if i % 3 else None if i % 5 == 0 else "c", i % 4) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, k string, w int").repartition(9)
    got = {r.id: r.before for r in ix.running_totals(df, ["id"], {"before": "w"}).collect()}
    assert got == {i: sum(j % 4 for j in range(i)) for i in range(200)}
    numbers = {}
    for r in ix.with_number_per_key(df, "k", ["id"]).collect():
        numbers.setdefault(r.k, []).append((r.id, r.number))
    for found in numbers.values():
        assert [n for _, n in sorted(found)] == list(range(1, len(found) + 1))


def test_quantiles_hold_no_group_in_one_task(spark):
    """One sensor with 5,000 values: ranked in parts, without a window or a list per sensor."""
    df = spark.range(5_000).select(F.lit("s").alias("sensor"), (F.col("id") / 100).cast("decimal(5,2)").alias("v"))
    counts = df.groupBy("sensor", "v").agg(F.count(F.lit(1)).alias("_c"))
    ranked = st.ranked_counts(counts, ["sensor"], "v", ["v"])
    text = ranked._jdf.queryExecution().executedPlan().toString()
    assert text.count("Window [") == text.count("Window [sum") == 2  # inside a part, and over the parts' sums
    assert "windowspecdefinition(sensor" not in text
    row = st.exact_quantiles(df, ["sensor"], "v", {"q": 0.25}).first()
    assert row.q == pytest.approx(12.4975)


def test_group_statistics_are_computed_once(spark, tmp_path):
    rows, df = readings(spark)
    df.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    text = st.standardize(table, ["sensor"], "v", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert text.count(f"{tmp_path}/t") == 1
