"""Every operator as a query over the given tables: ``name -> (spark, folder) -> DataFrame``.

Instants leave a query as epoch milliseconds, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions import codecs, geo
from wayfare.functions.grid_path import path_cells
from wayfare.functions.mail import MAIL_PREFIX, RECORD_DELIMITER, mail_line, parse_mails
from wayfare.operators import ordering, travel_time, windows
from wayfare.session import new_folder, use_utc
from wayfare.sources import tables, text
from wayfare.sources.messages import decode_rides
from wayfare.sources.tuples import increment_value
from wayfare.streaming import jobs, sinks, staging

Query = Callable[[SparkSession, str], DataFrame]

HOUR_MS = 3_600_000
JOIN_WINDOW_MS = 6 * HOUR_MS
DAY_MS = 24 * HOUR_MS
#: micro-batches in which a staged table is read
BATCHES = 8
#: the point distances are measured to
POINT = (-73.9857, 40.7484)

QUERIES: dict[str, Query] = {}


def query(function: Query, name: str | None = None) -> Query:
    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(use_utc(spark), folder)

    QUERIES[name or function.__name__] = run
    return run


def named(name: str) -> Callable[[Query], Query]:
    """A query whose name is that of a library function used in here."""
    return lambda function: query(function, name)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return tables.read_table(spark, folder, "events")


def _rides(spark: SparkSession, folder: str) -> DataFrame:
    return tables.rides(_events(spark, folder))


def _fares(spark: SparkSession, folder: str) -> DataFrame:
    return tables.fares(_events(spark, folder))


def _cars(spark: SparkSession, folder: str) -> DataFrame:
    return tables.cars(_events(spark, folder))


def _raw_mails(spark: SparkSession, folder: str) -> DataFrame:
    return tables.mails(tables.read_table(spark, folder, "documents"))


def _mails(spark: SparkSession, folder: str) -> DataFrame:
    return parse_mails(_raw_mails(spark, folder))


def _ms(df: DataFrame, **instants: str) -> DataFrame:
    """Replace timestamp columns by epoch milliseconds under a new name."""
    renamed = [F.unix_millis(column).alias(name) for name, column in instants.items()]
    return df.select(*(c for c in df.columns if c not in instants.values()), *renamed)


def _ride_rows(rides: DataFrame) -> DataFrame:
    return _ms(rides, start_ms="start_time", end_ms="end_time")


def _stored_lines(lines: DataFrame) -> str:
    path = new_folder(lines.sparkSession, "lines")
    lines.write.text(path)
    return path


# -- sources and codecs ------------------------------------------------------------------------


@query
def scan_rides(spark: SparkSession, folder: str) -> DataFrame:
    path = _stored_lines(sinks.encode_rides(_rides(spark, folder), "roundtrip"))
    return _ride_rows(text.read_rides(spark, path))


@query
def scan_fares(spark: SparkSession, folder: str) -> DataFrame:
    path = _stored_lines(_fares(spark, folder).select(codecs.fare_line().alias("value")))
    return _ms(text.read_fares(spark, path), start_ms="start_time")


@query
def scan_cars(spark: SparkSession, folder: str) -> DataFrame:
    path = _stored_lines(tables.car_records(_events(spark, folder)))
    return _ms(text.read_cars(spark, path), ts_ms="ts")


@query
def scan_mails(spark: SparkSession, folder: str) -> DataFrame:
    path = _stored_lines(_raw_mails(spark, folder))
    mails = text.read_mail_archive(spark, path)
    # what comes before the first mail of a file is empty
    found = mails.filter(F.col("value") != MAIL_PREFIX)
    return found.select(
        F.md5(F.col("value").cast("binary")).alias("mail_md5"),
        F.length("value").alias("n_chars"),
    )


@named("decode_rides")
def decode_ride_messages(spark: SparkSession, folder: str) -> DataFrame:
    messages = sinks.encode_rides(_rides(spark, folder))
    return _ride_rows(decode_rides(messages.select(F.col("value").cast("binary"))))


@query
def encode_rides(spark: SparkSession, folder: str) -> DataFrame:
    return sinks.encode_rides(_rides(spark, folder))


@query
def encode_fares(spark: SparkSession, folder: str) -> DataFrame:
    return _fares(spark, folder).select(codecs.fare_line().alias("value"))


@query
def encode_cars(spark: SparkSession, folder: str) -> DataFrame:
    return _cars(spark, folder).select(codecs.car_line().alias("value"))


@query
def bad_rides(spark: SparkSession, folder: str) -> DataFrame:
    lines = tables.unreliable_ride_lines(_events(spark, folder))
    return codecs.bad_records(codecs.parse_rides(lines, mode="quarantine"))


@query
def good_rides(spark: SparkSession, folder: str) -> DataFrame:
    lines = tables.unreliable_ride_lines(_events(spark, folder))
    return _ride_rows(codecs.good_records(codecs.parse_rides(lines, mode="quarantine")))


@query
def ride_event_time(spark: SparkSession, folder: str) -> DataFrame:
    return _rides(spark, folder).select(
        "ride_id", "is_start", F.unix_millis(codecs.ride_event_time()).alias("event_ms")
    )


@query
def fare_event_time(spark: SparkSession, folder: str) -> DataFrame:
    return _fares(spark, folder).select(
        "ride_id", F.unix_millis(codecs.fare_event_time()).alias("event_ms")
    )


# -- geography ---------------------------------------------------------------------------------


def _corners() -> list[Column]:
    return [F.col(name) for name in ("start_lon", "start_lat", "end_lon", "end_lat")]


@query
def nyc_rides(spark: SparkSession, folder: str) -> DataFrame:
    start_lon, start_lat, end_lon, end_lat = _corners()
    inside = geo.in_nyc(start_lon, start_lat) & geo.in_nyc(end_lon, end_lat)
    return _rides(spark, folder).filter(inside).select("ride_id", "is_start")


@query
def grid_cell(spark: SparkSession, folder: str) -> DataFrame:
    start_lon, start_lat, end_lon, end_lat = _corners()
    return _rides(spark, folder).select(
        "ride_id",
        "is_start",
        geo.grid_cell(start_lon, start_lat).alias("start_cell"),
        geo.grid_cell(end_lon, end_lat).alias("end_cell"),
    )


@query
def cell_center(spark: SparkSession, folder: str) -> DataFrame:
    start_lon, start_lat, _, _ = _corners()
    cells = _rides(spark, folder).select("ride_id", geo.grid_cell(start_lon, start_lat).alias("cell"))
    return cells.select(
        "ride_id",
        "cell",
        geo.cell_center_lon(F.col("cell")).alias("lon"),
        geo.cell_center_lat(F.col("cell")).alias("lat"),
    )


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query
def grid_path_cells(spark: SparkSession, folder: str) -> DataFrame:
    """All cells on the way of every record, added up so that each cell and its place in the order count."""
    ways = path_cells(_rides(spark, folder), *_corners(), ["ride_id", "is_start"], _partitions(spark))
    cells = ways.withColumn("cell", F.col("cell").cast("bigint"))
    return cells.groupBy("ride_id", "is_start").agg(
        F.count("*").alias("n_cells"),
        F.max("step").alias("last_step"),
        F.sum("cell").alias("cell_sum"),
        F.sum(F.col("step") * F.col("cell")).alias("ordered_sum"),
        F.sum(F.col("step") * F.col("step") * F.col("cell")).alias("twice_ordered_sum"),
        F.min("cell").alias("least_cell"),
        F.max("cell").alias("largest_cell"),
    )


@query
def grid_traffic(spark: SparkSession, folder: str) -> DataFrame:
    """How many records pass each cell, and how far into their way."""
    cells = path_cells(_rides(spark, folder), *_corners(), [], _partitions(spark))
    return cells.groupBy("cell").agg(F.count("*").alias("n_passed"), F.sum("step").alias("steps"))


@query
def ride_distance(spark: SparkSession, folder: str) -> DataFrame:
    distance = F.round(geo.euclidean_distance(*_corners()), 6)
    return _rides(spark, folder).select("ride_id", "is_start", distance.alias("distance"))


@query
def ride_direction(spark: SparkSession, folder: str) -> DataFrame:
    direction = geo.direction_angle(*_corners())
    return _rides(spark, folder).select("ride_id", "is_start", direction.alias("direction"))


@query
def distance_to_point(spark: SparkSession, folder: str) -> DataFrame:
    distance = F.round(geo.distance_to_point(*POINT), 6)
    return _rides(spark, folder).select("ride_id", "is_start", distance.alias("distance"))


@query
def random_points(spark: SparkSession, folder: str) -> DataFrame:
    event = F.col("event_id")
    return _events(spark, folder).select(
        "event_id", geo.random_nyc_lon(7, event).alias("lon"), geo.random_nyc_lat(8, event).alias("lat")
    )


# -- travel time -------------------------------------------------------------------------------


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return travel_time.ride_features(_rides(spark, folder))


def _model_rows(model: DataFrame) -> DataFrame:
    return model.select(
        "bucket",
        "n",
        F.round(F.col("sum_xx").cast("double"), 2).alias("sum_xx"),
        F.round(F.col("sum_xy").cast("double"), 2).alias("sum_xy"),
    )


@query
def ride_features(spark: SparkSession, folder: str) -> DataFrame:
    features = _ms(_features(spark, folder), event_ms="event_time")
    return features.withColumn("distance", F.round("distance", 6))


@query
def direction_bucket(spark: SparkSession, folder: str) -> DataFrame:
    bucket = travel_time.direction_bucket(F.col("direction"))
    return _features(spark, folder).select("ride_id", "direction", bucket.alias("bucket"))


@query
def fit_travel_time(spark: SparkSession, folder: str) -> DataFrame:
    return _model_rows(travel_time.fit(_features(spark, folder)))


@query
def fit_travel_time_stream(spark: SparkSession, folder: str) -> DataFrame:
    rides = tables.rides(tables.stream_table(spark, folder, "events"))
    return _model_rows(jobs.run_to_latest(travel_time.fit(travel_time.ride_features(rides))))


@query
def predict_travel_time(spark: SparkSession, folder: str) -> DataFrame:
    features = _features(spark, folder)
    predicted = travel_time.predict(features, travel_time.fit(features))
    return predicted.select("ride_id", "bucket", "predicted_time")


@query
def prequential_travel_time(spark: SparkSession, folder: str) -> DataFrame:
    predicted = travel_time.prequential(_features(spark, folder))
    return predicted.select("ride_id", "bucket", "predicted_time")


@query
def prequential_travel_time_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same record by record on a stream, started twice: the second run goes on where the first ended."""
    staged, files = staging.stage_in_order(_features(spark, folder), [F.col("event_time"), F.col("ride_id")], 4)
    schema = spark.read.parquet(staged).schema
    out = new_folder(spark, "predictions")
    for _ in range(2):
        features = staging.read_in_order(spark, staged, schema, files)
        jobs.predict_then_refine(
            features, f"{out}/times", f"{out}/model", f"{out}/checkpoint", available_now=True
        ).awaitTermination()
    times = spark.read.schema("ride_id bigint, bucket int, predicted_time int").parquet(f"{out}/times")
    return times.select("ride_id", "bucket", "predicted_time")


# -- keyed tuples and windows ------------------------------------------------------------------


@query
def keyed_tuples(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder)
    both = tables.left_tuples(events).unionByName(tables.right_tuples(events))
    return both.select("source_id", "tuple_id", "value")


@query
def map_increment(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder)
    both = [increment_value(side(events)) for side in (tables.left_tuples, tables.right_tuples)]
    return both[0].unionByName(both[1]).select("source_id", "tuple_id", "value")


@query
def ingestion_stamps(spark: SparkSession, folder: str) -> DataFrame:
    """Tuples of a stream stamped twice as they pass: the event time is gone, the stamp lies within the run."""
    started = spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]
    tuples = tables.left_tuples(tables.stream_table(spark, folder, "events"))
    timed = tuples.withColumn("event_us", F.unix_micros("event_ts"))
    stamped = windows.with_ingestion_time(windows.with_ingestion_time(timed))
    rows = jobs.run_to_files(stamped)
    ended = spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]
    stamp = F.unix_micros("event_ts")
    return rows.select(
        "source_id",
        "tuple_id",
        "value",
        "event_us",
        stamp.between(started, ended).alias("in_run"),
        (stamp != F.col("event_us")).alias("replaced"),
    )


@query
def window_join(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder)
    return jobs.increment_and_join(
        tables.left_tuples(events), tables.right_tuples(events), JOIN_WINDOW_MS
    )


@query
def window_join_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Events staged in the order of time, so that no record is late and state is that of the open windows."""
    events = _events(spark, folder).select("event_id", "user_id", "ts")
    hot = jobs.hot_keys_of(tables.left_tuples(events), tables.right_tuples(events), JOIN_WINDOW_MS)
    staged, files = staging.stage_in_order(events, [F.col("ts"), F.col("event_id")], 4)
    streams = [staging.read_in_order(spark, staged, events.schema, files) for _ in range(2)]
    left, right = tables.left_tuples(streams[0]), tables.right_tuples(streams[1])
    return jobs.run_to_files(jobs.increment_and_join(left, right, JOIN_WINDOW_MS, hot))


@query
def earliest_stop(spark: SparkSession, folder: str) -> DataFrame:
    return windows.earliest_stop(_cars(spark, folder))


@query
def earliest_stop_per_window(spark: SparkSession, folder: str) -> DataFrame:
    return windows.earliest_stop(_cars(spark, folder), size_ms=24 * HOUR_MS)


def _arriving(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a stream in the order of their arrival."""
    events = tables.late_arrivals(_events(spark, folder)).drop("props")
    staged, files = staging.stage_in_order(events, [F.col("arrival_ms"), F.col("event_id")], BATCHES)
    return staging.read_in_order(spark, staged, events.schema, files)


@query
def earliest_stop_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Windows that are over; events that come after their window was closed do not count."""
    cars = tables.cars(_arriving(spark, folder))
    return jobs.run_to_files(jobs.earliest_stop_per_window(cars, DAY_MS))


@query
def rides_per_window_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same for rides, which may be a day late."""
    rides = tables.rides(_arriving(spark, folder))
    return jobs.run_to_files(jobs.rides_per_window(rides, DAY_MS, max_delay_secs=86_400))


@query
def lateness_audit(spark: SparkSession, folder: str) -> DataFrame:
    arrivals = tables.arrivals(_events(spark, folder))
    order = [F.col("arrival_ms").asc(), F.col("event_id").asc()]
    audit = windows.lateness_audit(arrivals, "source", "ts_ms", order)
    return audit.select("source", "event_id", "ts_ms", "watermark_ms", "is_late")


@query
def rides_stream(spark: SparkSession, folder: str) -> DataFrame:
    path = _stored_lines(sinks.encode_rides(_rides(spark, folder), "roundtrip"))
    rides = jobs.rides_with_event_time(text.read_rides(spark, path, stream=True), 60)
    stream = rides.select("ride_id", "is_start", "event_time")
    return _ms(jobs.run_to_files(stream), event_ms="event_time")


@query
def fares_stream(spark: SparkSession, folder: str) -> DataFrame:
    path = _stored_lines(_fares(spark, folder).select(codecs.fare_line().alias("value")))
    fares = jobs.fares_with_event_time(text.read_fares(spark, path, stream=True), 60)
    stream = fares.select("ride_id", "payment_type", "total_fare", "event_time")
    return _ms(jobs.run_to_files(stream), event_ms="event_time")


@query
def cars_stream(spark: SparkSession, folder: str) -> DataFrame:
    path = _stored_lines(tables.car_records(_events(spark, folder)))
    cars = jobs.cars_with_event_time(text.read_cars(spark, path, stream=True))
    return _ms(jobs.run_to_files(cars.select("id", "car_id", "speed", "ts")), ts_ms="ts")


@query
def fan_out_rides(spark: SparkSession, folder: str) -> DataFrame:
    """Ride files streamed to three sinks as the lines they came in; each sink must hold every ride."""
    path = _stored_lines(sinks.encode_rides(_rides(spark, folder), "roundtrip"))
    out = new_folder(spark, "sinks")
    writers = [sinks.file_batch_writer(f"{out}/sink={number}", "text") for number in (1, 2, 3)]
    jobs.fan_out_rides(
        spark, path, writers, f"{out}-checkpoint", available_now=True
    ).awaitTermination()
    return spark.read.schema("value string, sink int, batch_id bigint").text(out).drop("batch_id")


# -- order and identity ------------------------------------------------------------------------


@query
def order_rides(spark: SparkSession, folder: str) -> DataFrame:
    ranked = ordering.rank_rides(_rides(spark, folder))
    return ranked.select("taxi_id", "ride_id", "is_start", "position")


@query
def order_cars(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.rank_cars(_cars(spark, folder)).select("car_id", "id", "position")


@query
def unique_rides(spark: SparkSession, folder: str) -> DataFrame:
    return _ride_rows(ordering.unique_rides(_rides(spark, folder)))


@query
def unique_fares(spark: SparkSession, folder: str) -> DataFrame:
    fares = _fares(spark, folder)
    return _ms(ordering.unique_fares(fares.unionByName(fares)), start_ms="start_time")


# -- mails -------------------------------------------------------------------------------------


@named("parse_mails")
def parsed_mails(spark: SparkSession, folder: str) -> DataFrame:
    return _mails(spark, folder)


@query
def distinct_mails(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.distinct_mails(_mails(spark, folder))


@query
def mail_lines(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.distinct_mails(_mails(spark, folder)).select(mail_line().alias("value"))


@query
def mail_archive_job(spark: SparkSession, folder: str) -> DataFrame:
    """Archive files -> scan -> parse -> one mail per id -> delimited file, read back."""
    archive = _stored_lines(_raw_mails(spark, folder))
    output = new_folder(spark, "mails")
    jobs.mail_archive_to_text(spark, archive, output)
    return text.read_lines(spark, output, line_separator=RECORD_DELIMITER)
