import pytest
from pyspark.sql import functions as F

from wayfare.operators import windows
from wayfare.sources import tables
from wayfare.sources.tuples import increment_value, key_by, keyed_tuples
from wayfare.streaming import jobs, sinks, staging

TUPLE = "source_id string, tuple_id bigint, value bigint, seconds double"
OUT = ("l_source_id", "l_tuple_id", "l_value", "r_source_id", "r_tuple_id", "r_value")


def tuples(spark, source, *rows):
    """Rows are (tuple id, value, event time in seconds)."""
    frame = spark.createDataFrame([(source, *row) for row in rows], TUPLE)
    return frame.select(
        "source_id", "tuple_id", "value", F.timestamp_seconds("seconds").alias("event_ts")
    )


@pytest.fixture
def sides(spark):
    left = tuples(spark, "Source1", (1, 0, 0.0), (1, 5, 4.999), (2, 0, 5.0), (3, 0, 9.0))
    right = tuples(spark, "Source2", (1, 0, 0.0), (2, 0, 5.0), (3, 1, 7.0), (4, 1, 4.0), (5, 2, 10.0))
    return left, right


EXPECTED = sorted(
    [
        # the right value is joined after it is incremented, both values leave incremented
        ("Source1", 1, 1, "Source2", 1, 1),
        ("Source1", 1, 6, "Source2", 1, 1),
        ("Source1", 2, 1, "Source2", 3, 2),
    ]
)


@pytest.mark.parametrize("shares", [1, 50])
def test_join_in_tumbling_windows(sides, shares, monkeypatch):
    monkeypatch.setattr(windows, "HOT_SHARES", shares)
    joined = jobs.increment_and_join(*sides, size_ms=5000)
    assert tuple(joined.columns) == OUT
    assert sorted(map(tuple, joined.collect())) == EXPECTED


@pytest.mark.parametrize("shares", [1, 3, 200])
def test_many_pairs_of_one_key_are_all_kept_once(spark, shares, monkeypatch):
    monkeypatch.setattr(windows, "HOT_SHARES", shares)
    rows = [(7, 6, n / 10) for n in range(40)] + [(8, 1, 1.0), (9, 2, 2.0), (9, 2, 2.0)]
    joined = jobs.increment_and_join(tuples(spark, "a", *rows), tuples(spark, "b", *rows))
    assert joined.count() == 1600


def test_join_key_contains_the_window(sides):
    plan = windows.window_join(*sides)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.fixture
def small_splits(spark):
    """Adaptive execution as on large data: no broadcast, and partitions soon count as too big."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4096",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_sides(spark, left_hot, right_hot):
    """A third of the rows of a side, equal to one another, in one key."""
    key = lambda hot: F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")) if hot else F.col("id")
    value = lambda hot: F.lit(5) if hot else F.col("id")
    large, small = spark.range(0, 12_000, 1, 8), spark.range(0, 12_000, 500, 2)
    left, right = large if left_hot else small, large if right_hot and not left_hot else small
    if left_hot and right_hot:
        right = spark.range(0, 300, 1, 2)
    return (
        keyed_tuples(left, "a", key(left_hot), value(left_hot), F.timestamp_seconds(F.lit(0))),
        keyed_tuples(right, "b", value(right_hot), key(right_hot), F.timestamp_seconds(F.lit(1))),
    )


@pytest.mark.parametrize("left_hot,right_hot", [(True, False), (False, True), (True, True)])
def test_a_hot_key_is_cut_on_either_side(spark, small_splits, left_hot, right_hot):
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        left, right = hot_sides(spark, left_hot, right_hot)
        hot = windows.hot_keys(left, right).collect()
        assert [row["hot_key"] for row in hot if row["l_parts"] * row["r_parts"] > 20] == [0]
        assert len(hot) < 2 * windows.HOT_SHARES
        joined = windows.window_join(left, right)
        pairs = joined.groupBy(F.spark_partition_id()).count().collect()
        want = left.join(right, left["tuple_id"] == right["value"]).count()
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    assert sum(row["count"] for row in pairs) == want > 4_000
    assert len(pairs) == 16 and max(row["count"] for row in pairs) < 0.15 * want


def stream_of(spark, folder):
    return spark.readStream.schema(
        "source_id string, tuple_id bigint, value bigint, event_ts timestamp"
    ).option("maxFilesPerTrigger", 1).parquet(str(folder))


@pytest.mark.parametrize("cut", [False, True])
def test_stream_gives_what_the_batch_gives(spark, sides, tmp_path, cut, monkeypatch):
    monkeypatch.setattr(windows, "HOT_SHARES", 50)
    hot = jobs.hot_keys_of(*sides) if cut else None
    for name, side in zip(("left", "right"), sides):
        side.write.parquet(str(tmp_path / name))
    # all files in one trigger, so that no row is late
    streams = [
        spark.readStream.schema(side.schema).parquet(str(tmp_path / name))
        for name, side in zip(("left", "right"), sides)
    ]
    result = jobs.run_to_files(jobs.increment_and_join(*streams, hot=hot))
    assert sorted(map(tuple, result.collect())) == EXPECTED


def test_stream_of_unordered_files_loses_nothing(spark, tmp_path):
    events = tables.read_table(spark, "/root/testdata/sf0.001", "events")
    events.repartition(6).write.parquet(str(tmp_path / "events.parquet"))
    delay = tables.seconds_spanned(events, "ts")
    streams = [tables.stream_table(spark, str(tmp_path), "events", files_per_batch=1) for _ in range(2)]
    joined = [
        jobs.increment_and_join(tables.left_tuples(left), tables.right_tuples(right), 6 * 3_600_000, max_delay_secs=delay)
        for left, right in (streams, (events, events))
    ]
    found, want = sorted(map(tuple, jobs.run_to_files(joined[0]).collect())), sorted(map(tuple, joined[1].collect()))
    assert found == want and len(want) > 0


def add_file(frame, folder):
    frame.coalesce(1).write.mode("append").parquet(str(folder))


def test_restart_adds_only_new_pairs_and_late_rows_vanish(spark, tmp_path):
    left, right, out = (str(tmp_path / name) for name in ("left", "right", "out"))
    checkpoint = str(tmp_path / "checkpoint")

    def run():
        joined = jobs.increment_and_join(stream_of(spark, left), stream_of(spark, right))
        sinks.append_to_files(joined, out, checkpoint, available_now=True).awaitTermination()
        return sorted(tuple(r)[1::3] for r in spark.read.parquet(out).collect())

    add_file(tuples(spark, "a", (1, 0, 0.0)), left)
    add_file(tuples(spark, "b", (10, 0, 1.0)), right)
    assert run() == [(1, 10)]
    # a pair across runs: the left row waits in the state
    add_file(tuples(spark, "b", (11, 0, 2.0)), right)
    assert run() == [(1, 10), (1, 11)]
    # time moves on: the first window is over
    add_file(tuples(spark, "a", (2, 0, 60.0)), left)
    add_file(tuples(spark, "b", (12, 1, 61.0)), right)
    assert run() == [(1, 10), (1, 11), (2, 12)]
    add_file(tuples(spark, "a", (3, 0, 120.0)), left)
    add_file(tuples(spark, "b", (13, 5, 120.0)), right)
    assert run() == [(1, 10), (1, 11), (2, 12)]
    # too late for the first window
    add_file(tuples(spark, "b", (14, 0, 3.0)), right)
    assert run() == [(1, 10), (1, 11), (2, 12)]


def test_ingestion_time_replaces_an_earlier_stamp(spark):
    stamped = windows.with_ingestion_time(tuples(spark, "a", (1, 1, 0.0)))
    assert stamped.columns == ["source_id", "tuple_id", "value", "event_ts"]
    assert stamped.filter("event_ts > timestamp'2020-01-01'").count() == 1


def test_stream_joined_on_ingestion_time(spark, sides, tmp_path):
    for name, side in zip(("left", "right"), sides):
        side.write.parquet(str(tmp_path / name))
    streams = [
        spark.readStream.schema(side.schema).parquet(str(tmp_path / name))
        for name, side in zip(("left", "right"), sides)
    ]
    # all rows pass at once, so event times of the data do not matter
    result = jobs.run_to_files(jobs.ingestion_time_join(*streams, size_ms=3_600_000))
    pairs = sorted((r.l_tuple_id, r.r_tuple_id) for r in result.collect())
    assert pairs == [(1, 1), (1, 1), (1, 2), (1, 2), (2, 3), (2, 4), (3, 5)]


def test_negative_delay_is_rejected(sides):
    with pytest.raises(ValueError):
        windows.with_watermark(sides[0], "event_ts", -1)


def test_keyed_tuples(spark):
    shaped = keyed_tuples(spark.range(3), "s", F.col("id") + 1, F.col("id") * 2)
    assert sorted(map(tuple, increment_value(shaped).collect())) == [
        ("s", 1, 1),
        ("s", 2, 3),
        ("s", 3, 5),
    ]
    assert key_by(shaped, "tuple_id").count() == 3


CARS = "car_id string, ms bigint, speed float"


def test_earliest_stop(spark):
    rows = [("a", 9000, 0.0), ("a", 4000, 0.0), ("a", 1000, 5.0), ("b", 1000, 5.0), ("a", 12000, 1.0)]
    cars = spark.createDataFrame(rows, CARS).withColumn("ts", F.timestamp_millis("ms"))
    assert dict(windows.earliest_stop(cars).collect()) == {"a": 4000, "b": 2**63 - 1}
    per_window = windows.earliest_stop(cars, size_ms=5000).collect()
    assert sorted(map(tuple, per_window)) == [
        ("a", 0, 4000),
        ("a", 5000, 9000),
        ("a", 10000, 2**63 - 1),
        ("b", 0, 2**63 - 1),
    ]


def test_lateness(spark):
    rows = [("s", 1, 100_000), ("s", 2, 70_000), ("s", 3, 70_001), ("s", 4, 140_000), ("s", 5, 110_000)]
    events = spark.createDataFrame(rows, "source string, arrival int, ts_ms bigint")
    audit = windows.lateness_audit(events, "source", "ts_ms", [F.col("arrival").asc()])
    found = [(r.watermark_ms, r.is_late) for r in audit.orderBy("arrival").collect()]
    assert found == [(None, False), (70_000, True), (70_000, False), (70_000, False), (110_000, True)]
