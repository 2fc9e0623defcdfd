import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wayfare.operators import travel_time
from wayfare.streaming import jobs

POINTS = "ride_id bigint, direction int, distance double, travel_time double"


@pytest.fixture
def points(spark):
    rows = [(1, 0, 1.0, 10.0), (2, 44, 2.0, 26.0), (3, 45, 1.0, 7.0), (4, -1, 3.0, 33.0), (5, 359, 0.0, 5.0), (6, 359, 0.0, 5.0)]
    frame = spark.createDataFrame(rows, POINTS)
    return frame.withColumn("event_time", F.timestamp_seconds("ride_id"))


def model_rows(model):
    return {r.bucket: (r.n, r.sum_xx, r.sum_xy) for r in model.collect()}


def test_fit(points):
    model = travel_time.fit(points)
    assert model_rows(model) == {0: (3, 14.0, 161.0), 1: (1, 1.0, 7.0), 7: (2, 0.0, 0.0)}
    assert model_rows(travel_time.fit(points.repartition(5))) == model_rows(model)


def test_merged_models_equal_one_fit(points):
    first, second = points.filter("ride_id < 3"), points.filter("ride_id >= 3")
    merged = travel_time.merge_models(travel_time.fit(first), travel_time.fit(second))
    assert model_rows(merged) == model_rows(travel_time.fit(points))


def test_predictions(spark, points):
    asked = spark.createDataFrame(
        [(1, 10, 2.0, 0.0), (2, 50, 2.0, 0.0), (3, 350, 2.0, 0.0), (4, 100, 2.0, 0.0),
         (5, 10, float("nan"), 0.0), (6, 10, 1e12, 0.0), (7, 10, -0.05, 0.0)],
        POINTS,
    )
    predicted = travel_time.predict(asked, travel_time.fit(points))
    found = {r.ride_id: r.predicted_time for r in predicted.collect()}
    # slope 11.5; one point or only zero distances are no model; saturates; cut towards zero
    assert found == {1: 23, 2: -1, 3: -1, 4: -1, 5: -1, 6: 2**31 - 1, 7: 0}


def test_predictions_by_key(points):
    keyed = points.withColumn("driver", F.col("ride_id") % 2)
    model = travel_time.fit(keyed, ["driver"])
    predicted = travel_time.predict(keyed, model, ["driver"])
    # driver 0 has rides 2 and 4 in bucket 0: slope 151/13
    assert {r.ride_id: r.predicted_time for r in predicted.collect()} == {
        1: -1, 2: 23, 3: -1, 4: 34, 5: -1, 6: -1,
    }


def test_a_model_in_parts_is_added_up(points):
    parts = travel_time.fit(points.filter("ride_id < 2")).unionByName(travel_time.fit(points.filter("ride_id >= 2")))
    asked = points.select("ride_id", "direction", "distance")
    whole = travel_time.predict(asked, travel_time.fit(points))
    assert sorted(travel_time.predict(asked, parts).collect()) == sorted(whole.collect())


def test_model_of_all_rides_is_broadcast(points):
    plan = travel_time.predict(points, travel_time.fit(points))._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan


def test_each_point_is_predicted_from_earlier_ones(points):
    predicted = travel_time.prequential(points)
    assert {r.ride_id: r.predicted_time for r in predicted.collect()} == {
        1: -1,
        2: -1,  # one point so far
        3: -1,
        4: 37,  # (10 + 52) / 5 * 3
        5: -1,
        6: -1,
    }


def test_buckets(spark):
    angles = [-44, -1, 0, 44, 45, 359, 360, -45, 45 * 256]
    frame = spark.createDataFrame([(a,) for a in angles], "direction int")
    bucket = travel_time.direction_bucket(F.col("direction"), "quarantine")
    assert [r.b for r in frame.select(bucket.alias("b")).collect()] == [
        0, 0, 0, 0, 1, 7, None, None, 0,
    ]
    with pytest.raises(PySparkException, match="No direction bucket for angle 360"):
        frame.select(travel_time.direction_bucket(F.col("direction"))).collect()
    with pytest.raises(ValueError):
        travel_time.direction_bucket(F.col("direction"), "other")


def test_features(spark):
    rides = spark.sql(
        "select 1L ride_id, false is_start, timestamp'2013-01-01 00:00:00' start_time, "
        "timestamp'2013-01-01 00:01:30' end_time, cast(-73.9 as float) start_lon, "
        "cast(40.7 as float) start_lat, cast(-73.9 as float) end_lon, "
        "cast(40.8 as float) end_lat, 5L taxi_id"
    )
    (row,) = travel_time.ride_features(rides.unionByName(rides.withColumn("is_start", F.lit(True)))).collect()
    assert (row.direction, row.travel_time) == (269, 90.0)
    assert row.distance == pytest.approx(11.025, abs=1e-3)
    assert row.event_time.minute == 1


def test_online_prediction_by_micro_batches(spark, points, tmp_path):
    source, predictions, model = (str(tmp_path / n) for n in ("source", "predictions", "model"))

    def step(low, high):
        points.filter(F.col("ride_id").between(low, high)).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(points.schema).parquet(source)
        jobs.predict_then_refine(
            stream, predictions, model, str(tmp_path / "checkpoint"), available_now=True
        ).awaitTermination()
        return {r.ride_id: r.predicted_time for r in spark.read.parquet(predictions).collect()}

    assert step(1, 2) == {1: -1, 2: -1}
    assert step(3, 6) == {1: -1, 2: -1, 3: -1, 4: 37, 5: -1, 6: -1}
    final = spark.read.parquet(f"{model}/batch_id=1")
    assert model_rows(final) == model_rows(travel_time.fit(points))
