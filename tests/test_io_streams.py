import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talusflow import session
from talusflow.schemas import CATALOGUE_RAW, WAREHOUSE
from talusflow.sources import files, sinks
from talusflow.sources.warehouse import (
    CONF_ROOT,
    jdbc_connection,
    load_table,
    range_predicates,
    split_points,
)
from talusflow.streaming import points as stream
from talusflow.streaming.state import BatchState

POINT = T.StructType([T.StructField("id", T.LongType()), T.StructField("topic", T.StringType()),
                      T.StructField("ts", T.TimestampType())])


def land(folder: Path, name: str, rows: list[dict]) -> None:
    """A file that appears whole, as a landing folder needs."""
    folder.mkdir(exist_ok=True)
    hidden = folder / f".{name}"
    hidden.write_text("\n".join(json.dumps(r) for r in rows))
    hidden.rename(folder / name)


def test_csv_keeps_na_and_separates_broken_lines(spark, tmp_path):
    head = ",".join(CATALOGUE_RAW.fieldNames())
    (tmp_path / "a.csv").write_text(
        f"{head}\n1,1/2/2020,1:00:00,Peru,x,NA,landslide,fall,small,1.5,2.5\n"
        f"two,1/2/2020,1:00:00,Peru,x,NA,landslide,fall,small,abc,2.5\n")
    good, bad = files.split_corrupt(files.read_csv(spark, str(tmp_path), CATALOGUE_RAW))
    row = good.first()
    assert good.count() == 1 and row.continentcode == "NA" and row.latitude == 1.5
    assert bad.count() == 1 and "two" in bad.first()[0]


def test_csv_takes_columns_by_name(spark, tmp_path):
    from pyspark.sql import types as T

    (tmp_path / "a.csv").write_text("id,lon,note,lat\n1,2.5,x,1.5\n2,bad,x,1.5\n")
    schema = T.StructType().add("id", "integer").add("lat", "double").add("lon", "double")
    good, bad = files.split_corrupt(files.read_csv(spark, str(tmp_path), schema))
    assert [tuple(r) for r in good.collect()] == [(1, 1.5, 2.5)]
    assert good.select("id").collect()[0].id == 1 and good.select("id").count() == 1
    assert bad.count() == 1
    with pytest.raises(ValueError, match="depth"):
        files.read_csv(spark, str(tmp_path), schema.add("depth", "integer"))


def test_append_orders_and_takes_null_keys_once(spark, tmp_path):
    from talusflow.sources.sinks import append_new

    rows = spark.createDataFrame([(1, "b"), (1, "a"), (None, "n")], "k int, v string")
    for _ in range(2):
        append_new(rows, str(tmp_path / "t"), ["k"])
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "t")).collect()), key=str) == [(1, "a"), (None, "n")]


def test_append_reads_only_keys_in_range(spark, tmp_path, monkeypatch):
    path, read = str(tmp_path / "t"), []
    original = sinks._near_keys

    def near(present, rows, keys):
        read.append(original(present, rows, keys))
        return read[-1]

    monkeypatch.setattr(sinks, "_near_keys", near)
    sinks.append_new(spark.range(1000).withColumn("v", F.lit("a")), path, ["id"])
    sinks.append_new(spark.range(990, 1010).withColumn("v", F.lit("b")), path, ["id"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(1010))
    text = read[0]._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,990)" in text and "LessThanOrEqual(id,1009)" in text
    assert read[0].count() == 10


def test_json_array_over_many_lines(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text(json.dumps([{"id": 1, "country": "Peru"}, {"id": 2}], indent=1))
    got = files.read_json_records(spark, str(path), CATALOGUE_RAW, multi_line=True)
    assert sorted((r.id, r.country) for r in got.collect()) == [(1, "Peru"), (2, None)]


def test_append_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([(1, 2020, "a"), (2, 2021, "b"), (2, 2021, "b")],
                                 "id long, year int, v string")
    for _ in range(2):
        sinks.append_new(rows, path, ["id", "year"], partition_by=("year",))
    sinks.append_new(rows.withColumn("id", F.col("id") + 1), path, ["id", "year"],
                     partition_by=("year",))
    got = sorted((r.id, r.year) for r in spark.read.parquet(path).collect())
    assert got == [(1, 2020), (2, 2020), (2, 2021), (3, 2021)]


def test_tables_come_with_their_schema(spark, tmp_path):
    spark.createDataFrame([], WAREHOUSE["soil"]).write.parquet(str(tmp_path / "soil"))
    assert load_table(spark, "soil", str(tmp_path)).schema == WAREHOUSE["soil"]
    with pytest.raises(ValueError):
        load_table(spark, "soil")


def test_jdbc_takes_secrets_from_conf(spark):
    for key, value in (("url", "jdbc:x:"), ("user", "u"), ("password", "p")):
        spark.conf.set(CONF_ROOT + key, value)
    options = jdbc_connection(spark)
    assert (options["url"], options["user"], options["password"]) == ("jdbc:x:", "u", "p")
    spark.conf.unset(CONF_ROOT + "url")


@pytest.mark.parametrize("keys", [
    list(range(1, 10_001)),
    [*range(1, 9_001), *(10**9 + 7 * i for i in range(1_000))],
    [*range(5), *range(10**6, 10**6 + 9_995)],
    [3], [],
])
def test_key_ranges_hold_equal_numbers_of_rows(spark, keys):
    """Counted as the database would count them, also where the keys lie far apart."""
    low, width = (min(keys), -(-(max(keys) - min(keys) + 1) // 4096)) if keys else (0, 1)
    histogram = {}
    for key in keys:
        bucket = low + (key - low) // width * width
        histogram[bucket] = histogram.get(bucket, 0) + 1
    points = split_points(list(histogram.items()), width, 8)
    assert points == sorted(set(points)) and len(points) < 8
    table = spark.createDataFrame([(k,) for k in keys] + [(None,)], "k long")
    counts = [table.where(p).count() for p in range_predicates("k", points)]
    assert sum(counts) == len(keys) + 1
    if len(keys) >= 10_000 and max(keys) < 10**8:
        assert max(counts) <= 1.1 * len(keys) / 8 + 2
    elif keys:
        assert max(counts) <= len(keys) / 8 + width + 2 or len(keys) == 1


def test_shared_folder_follows_the_session(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return "hdfs://shared/checkpoints/" if key == "spark.checkpoint.dir" else default

    class Fake:
        conf = Conf()

    assert session.shared_path(Fake(), "x").startswith("hdfs://shared/checkpoints/x-")

    class Unset:
        def get(self, key, default=None):
            return default

    class Cluster:
        conf = Unset()
        sparkContext = type("C", (), {"master": "yarn", "applicationId": "app"})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_path(Cluster(), "x")


def test_stream_restarts_where_it_stopped(spark, tmp_path):
    land(tmp_path / "in", "1.json", [{"id": 1, "topic": "a"}, {"id": 2, "topic": "b"}])
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        df = stream.read_points_stream(spark, str(tmp_path / "in"), POINT, files_per_trigger=1)
        stream.write_files(df, out, state).awaitTermination()
        return sorted(r.id for r in spark.read.schema(POINT).parquet(out).collect())

    assert run() == [1, 2]
    assert run() == [1, 2]  # nothing new
    land(tmp_path / "in", "2.json", [{"id": 3, "topic": "a"}])
    assert run() == [1, 2, 3]


@pytest.mark.parametrize("spread", [1, 4])
def test_repeated_messages_are_dropped_across_batches(spark, tmp_path, spread):
    at = "2024-01-01T00:00:00"
    land(tmp_path / "in", "1.json", [{"id": 1, "ts": at}] * 50)
    land(tmp_path / "in", "2.json", [{"id": 1, "ts": "2024-01-01T00:10:00"}, {"id": 2, "ts": at}])
    df = stream.read_points_stream(spark, str(tmp_path / "in"), POINT, files_per_trigger=1)
    out = str(tmp_path / "out")
    stream.write_files(stream.dedup_stream(df, ["id"], "ts", spread=spread), out,
                       str(tmp_path / "state")).awaitTermination()
    rows = spark.read.schema(POINT).parquet(out).collect()
    assert sorted(r.id for r in rows) == [1, 2]
    assert {r.ts for r in rows} == {datetime(2024, 1, 1)}


def test_counts_run_over_batches_and_per_topic(spark, tmp_path):
    land(tmp_path / "in", "1.json", [{"id": 1, "topic": "a"}, {"id": 2, "topic": "b"}])
    land(tmp_path / "in", "2.json", [{"id": 3, "topic": "a"}])
    df = stream.read_points_stream(spark, str(tmp_path / "in"), POINT, files_per_trigger=1)
    for name, topic, want in (("all", (), [(3,)]), ("by", ("topic",), [("a", 2), ("b", 1)])):
        path = str(tmp_path / name)
        stream.write_snapshots(stream.count_stream(df, *topic), path,
                               path + "-state").awaitTermination()
        assert sorted(map(tuple, stream.latest_snapshot(spark, path).collect())) == want


def test_snapshots_of_old_batches_go(spark, tmp_path):
    for i in range(5):
        land(tmp_path / "in", f"{i}.json", [{"id": i, "topic": "ab"[i % 2]}])
    df = stream.read_points_stream(spark, str(tmp_path / "in"), POINT, files_per_trigger=1)
    path = str(tmp_path / "counts")
    stream.write_snapshots(stream.count_stream(df, "topic"), path, str(tmp_path / "state")).awaitTermination()
    assert sorted(p.name for p in Path(path).iterdir() if p.is_dir()) == ["batch_id=3", "batch_id=4"]
    assert sorted(map(tuple, stream.latest_snapshot(spark, path).collect())) == [("a", 3), ("b", 2)]


def test_file_arrivals_keep_no_state(spark, tmp_path):
    """A hundred batches: a row per file, each batch writes its own, and nothing is remembered."""
    for i in range(100):
        land(tmp_path / "in", f"{i}.json", [{"id": i, "topic": "a"}] * (i % 3 + 1))
    df = stream.read_points_stream(spark, str(tmp_path / "in"), POINT, files_per_trigger=1)
    stream.log_file_arrivals(df, str(tmp_path / "log"), str(tmp_path / "state")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "log")).collect()
    assert sorted((r.file_name, r.n_rows) for r in rows) == sorted((f"{i}.json", i % 3 + 1) for i in range(100))
    assert {len([r for r in rows if r.batch_id == b]) for b in range(100)} == {1}
    assert not (tmp_path / "state" / "state").exists()
    assert len(list((tmp_path / "log" / "batch_id=99").glob("*.parquet"))) == 1


def test_batch_state_keeps_the_last_two_batches(spark, tmp_path):
    schema = T.StructType([T.StructField("n", T.LongType())])
    state = BatchState(spark, str(tmp_path / "s"), {"t": schema})
    assert state.read("t", 0).count() == 0
    for batch in range(100 // 10):
        before = [r.n for r in state.read("t", batch).collect()]
        assert before == ([batch - 1] if batch else [])
        state.write("t", spark.createDataFrame([(batch,)], schema), batch)
    assert sorted(p.name for p in (tmp_path / "s" / "t").iterdir()) == ["batch=8", "batch=9"]
    assert [r.n for r in state.read("t", 9).collect()] == [8]  # a repeated batch starts where it did


def test_numbers_run_on_per_topic_over_batches(spark, tmp_path):
    land(tmp_path / "in", "1.json", [{"id": i, "topic": "ab"[i % 2]} for i in range(7)] + [{"id": 50}])
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        df = stream.read_points_stream(spark, str(tmp_path / "in"), POINT).withColumn("text", F.lit('say "x"'))
        stream.publish_stream(df, "text", "topic", ["id"], out, state).awaitTermination()
        return spark.read.parquet(out).collect()

    run()
    land(tmp_path / "in", "2.json", [{"id": i, "topic": "abc"[i % 3]} for i in range(6)] + [{"id": 51}])
    rows = run()
    numbers = {}
    for r in rows:
        numbers.setdefault(r.topic, []).append(r.number)
        assert json.loads(r.payload) == f'say "x" [{r.number}]'
    assert {t: sorted(n) for t, n in numbers.items()} == {
        "a": [1, 2, 3, 4, 5, 6], "b": [1, 2, 3, 4, 5], "c": [1, 2], None: [1, 2]}


def test_published_messages(spark):
    df = spark.createDataFrame([("hello", 3, "t")], "text string, n long, topic string")
    assert [tuple(r) for r in stream.to_messages(df, "text", "n", "topic").collect()] == [
        ("t", '"hello [3]"')]
