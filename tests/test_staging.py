"""Tables staged as streams: order, state, late records, and what is left behind."""

import random

import pytest
from pyspark.sql import functions as F

from wayfare.operators import travel_time
from wayfare.plans import queries
from wayfare.session import new_folder
from wayfare.sources import tables
from wayfare.streaming import jobs, sinks, staging

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def events(spark):
    return tables.read_table(spark, FOLDER, "events").select("event_id", "user_id", "ts")


def test_files_are_equal_in_order_and_dated(spark, events, tmp_path):
    folder, each = staging.stage_in_order(events.repartition(5), [F.col("ts"), F.col("event_id")], 7)
    assert each == 1
    stream = staging.read_in_order(spark, folder, events.schema, each)
    seen = []

    def note(batch, batch_id):
        rows = batch.agg(F.min(F.struct("ts", "event_id")), F.max(F.struct("ts", "event_id")), F.count("*")).first()
        seen.append(tuple(rows))

    stream.writeStream.foreachBatch(note).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 7 and sum(n for *_, n in seen) == events.count()
    assert max(n for *_, n in seen) - min(n for *_, n in seen) <= 1
    assert all(one[1] < other[0] for one, other in zip(seen, seen[1:]))


def test_many_files_for_a_batch_and_few_rows(spark, monkeypatch):
    monkeypatch.setattr(staging, "ROWS_PER_FILE", 10)
    rows = spark.range(200).withColumn("ts", -F.col("id"))
    folder, each = staging.stage_in_order(rows, [F.col("ts")], 4)
    assert each == 5
    sizes = spark.read.parquet(folder).groupBy(F.input_file_name()).count().collect()
    assert len(sizes) == 20 and {r["count"] for r in sizes} == {10}
    folder, each = staging.stage_in_order(rows.limit(0), [F.col("ts")], 4)
    assert spark.read.schema(rows.schema).parquet(folder).count() == 0
    with pytest.raises(ValueError):
        staging.stage_in_order(rows, [F.col("ts")], 0)


def test_state_of_a_join_is_that_of_the_open_windows(spark, events):
    size_ms = queries.JOIN_WINDOW_MS
    staged, each = staging.stage_in_order(events.repartition(3), [F.col("ts"), F.col("event_id")], 10)
    streams = [staging.read_in_order(spark, staged, events.schema, each) for _ in range(2)]
    joined = jobs.increment_and_join(tables.left_tuples(streams[0]), tables.right_tuples(streams[1]), size_ms)
    folder = new_folder(spark, "stream")
    query = sinks.append_to_files(joined, f"{folder}/out", f"{folder}/checkpoint", True)
    query.awaitTermination()
    want = jobs.increment_and_join(tables.left_tuples(events), tables.right_tuples(events), size_ms)
    found = spark.read.schema(joined.schema).parquet(f"{folder}/out")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    # two rows an event would be the whole table; a batch and the open window stay below a fifth of it
    assert len(states) >= 10 and max(states) < 2 * events.count() / 5


@pytest.mark.parametrize("name", ["earliest_stop_stream", "rides_per_window_stream"])
def test_another_delay_gives_another_result(spark, name, monkeypatch):
    as_it_is = sorted(map(tuple, queries.QUERIES[name](spark, FOLDER).collect()))
    timed = {"earliest_stop_stream": "cars_with_event_time", "rides_per_window_stream": "rides_with_event_time"}[name]
    plain = getattr(jobs, timed)
    monkeypatch.setattr(jobs, timed, lambda df, delay: plain(df, 12 * 86_400))
    assert sorted(map(tuple, queries.QUERIES[name](spark, FOLDER).collect())) != as_it_is


def test_state_is_on_disk_in_a_plain_session(spark, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.unset(key)
    try:
        spark.range(10).write.parquet(str(tmp_path / "in"))
        counts = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in")).groupBy(F.col("id") % 3).count()
        query = sinks.replace_in_files(counts, str(tmp_path / "out"), str(tmp_path / "checkpoint"), True)
        query.awaitTermination()
        metrics = query.recentProgress[0]["stateOperators"][0]["customMetrics"]
        assert any(name.startswith("rocksdb") for name in metrics)
        assert "RocksDB" not in spark.conf.get(key)
    finally:
        spark.conf.set(key, before)


def test_two_versions_stay(spark, tmp_path):
    path = str(tmp_path / "versions")
    store = sinks.Versions(spark, path)
    assert store.versions() == []
    with pytest.raises(FileNotFoundError):
        store.newest()
    for version in range(10):
        store.write(spark.range(version, version + 1), version)
        assert store.versions() == [v for v in (version - 1, version) if v >= 0]
    store.write(spark.range(3), 9)  # a repeated micro-batch
    assert store.newest().count() == 3 and store.read(8).count() == 1
    (tmp_path / "versions" / "batch_id=10").mkdir()  # not complete
    assert store.versions() == [8, 9]


def test_records_are_predicted_one_by_one_over_a_restart(spark, tmp_path):
    draw = random.Random(4)
    rows = [(i, draw.randrange(0, 360), draw.random() * 9, draw.random() * 900, draw.randrange(3)) for i in range(300)]
    features = spark.createDataFrame(rows, "ride_id bigint, direction int, distance double, travel_time double, driver int")
    features = features.withColumn("event_time", F.timestamp_seconds(F.col("ride_id") % 50))
    order = [F.col("event_time"), F.col("ride_id")]
    for keys in ([], ["driver"]):
        out = new_folder(spark, "refined")
        staged, _ = staging.stage_in_order(features, order, 5)
        parts = sorted(p for p in spark.read.parquet(staged).inputFiles())
        schema = features.schema
        for upto in (2, 5):
            source = f"{out}/source"
            for k in range(0 if upto == 2 else 2, upto):
                spark.read.schema(schema).parquet(parts[k]).coalesce(1).write.mode("append").parquet(source)
                stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
                jobs.predict_then_refine(stream, f"{out}/times", f"{out}/model", f"{out}/checkpoint", keys, True).awaitTermination()
        found = spark.read.parquet(f"{out}/times").select("ride_id", "predicted_time")
        want = travel_time.prequential(features, keys).select("ride_id", "predicted_time")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
        assert sinks.Versions(spark, f"{out}/model").versions() == [3, 4]
