"""Adapters: the analytics tables ``events`` and ``documents`` in the shapes of the records.

Everything is a projection over the given tables, batch or stream, so the columns needed by a query
reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.mail import MAIL_PREFIX
from wayfare.session import use_utc
from wayfare.sources.tuples import keyed_tuples


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{folder}/{name}.parquet")


def stream_table(spark: SparkSession, folder: str, name: str, files_per_batch: int = 1000) -> DataFrame:
    """The same table as a stream; its parquet is one file or a folder of files."""
    use_utc(spark)
    path = f"{folder}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if _is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def seconds_spanned(df: DataFrame, column: str) -> int:
    """Seconds from the earliest to the latest time, rounded up; 0 for none."""
    ends = df.agg(F.min(column).cast("timestamp").alias("first"), F.max(column).cast("timestamp").alias("last"))
    span = ends.select(F.unix_seconds("last") - F.unix_seconds("first") + 1).first()[0]
    return span or 0


def _is_folder(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return file_system.getFileStatus(jvm_path).isDirectory()


def _scaled(column: str, factor: int, modulus: int, origin: float) -> Column:
    """``origin + (column * factor % modulus) / 1e5`` as float: points spread around the box."""
    spread = (F.col(column) * F.lit(factor)) % F.lit(modulus)
    return (F.lit(origin) + spread / F.lit(1e5)).cast("float")


def _lon(factor: int) -> Column:
    return _scaled("event_id", factor, 37000, -74.06)


def _lat(factor: int) -> Column:
    return _scaled("event_id", factor, 52000, 40.49)


def _start_time() -> Column:
    return F.date_trunc("second", F.col("ts").cast("timestamp"))


def rides(events: DataFrame) -> DataFrame:
    """A START and an END record per event."""
    seconds = (F.lit(120) + (F.col("event_id") * 7919) % 3480).cast("int")
    start = _start_time()
    both = F.explode(F.array(F.lit(True), F.lit(False)))
    return events.select(
        F.col("event_id").alias("ride_id"),
        both.alias("is_start"),
        start.alias("start_time"),
        F.timestamp_add("SECOND", seconds, start).alias("end_time"),
        _lon(7919).alias("start_lon"),
        _lat(104729).alias("start_lat"),
        _lon(15485863).alias("end_lon"),
        _lat(32452843).alias("end_lat"),
        (F.col("event_id") % 6 + 1).cast("smallint").alias("passenger_cnt"),
        (F.col("user_id") + 2013000000).alias("taxi_id"),
        (F.col("user_id") + 2014000000).alias("driver_id"),
    )


def fares(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("ride_id"),
        (F.col("user_id") + 2013000000).alias("taxi_id"),
        (F.col("user_id") + 2014000000).alias("driver_id"),
        _start_time().alias("start_time"),
        F.when(F.col("event_id") % 2 == 0, "CSH").otherwise("CRD").alias("payment_type"),
        (F.col("event_id") % 7).cast("float").alias("tip"),
        (F.col("event_id") % 3).cast("float").alias("tolls"),
        F.col("value").cast("float").alias("total_fare"),
    )


def cars(events: DataFrame) -> DataFrame:
    """A car event per event; an ``error`` is a stop."""
    stopped = F.col("event_type") == "error"
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("user_id").cast("string").alias("car_id"),
        F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp"))).alias("ts"),
        _lon(7919).alias("longitude"),
        _lat(104729).alias("latitude"),
        (F.col("event_id") % 13).cast("float").alias("consumption"),
        F.when(stopped, 0.0).otherwise(F.col("value")).cast("float").alias("speed"),
        (F.col("event_id") % 100).cast("float").alias("throttle"),
        (F.col("event_id") % 90).cast("float").alias("engineload"),
    )


def arrivals(events: DataFrame) -> DataFrame:
    """Events of a source (their type) with the time they arrive, up to two hours late."""
    ts_ms = F.unix_millis(F.col("ts").cast("timestamp"))
    delay = ((F.col("event_id") * 7919) % 7200) * 1000
    return events.select(
        F.col("event_type").alias("source"),
        "event_id",
        ts_ms.alias("ts_ms"),
        (ts_ms + delay).alias("arrival_ms"),
    )


def late_arrivals(events: DataFrame) -> DataFrame:
    """The events with ``arrival_ms``: most within two hours, every seventh ten days later."""
    lag = F.when(F.col("event_id") % 7 == 0, 864_000_000).otherwise(0)
    delay = ((F.col("event_id") * 7919) % 7200) * 1000
    return events.withColumn("arrival_ms", F.unix_millis(F.col("ts").cast("timestamp")) + delay + lag)


def left_tuples(events: DataFrame) -> DataFrame:
    return keyed_tuples(
        events, "Source1", F.col("event_id") % 50, F.col("event_id") % 97, F.col("ts")
    )


def right_tuples(events: DataFrame) -> DataFrame:
    return keyed_tuples(events, "Source2", F.col("event_id"), F.col("user_id") - 1, F.col("ts"))


def mails(documents: DataFrame) -> DataFrame:
    """A raw archive mail per document, with repeated, dirty and folded parts."""
    doc = F.col("doc_id")
    seconds = ((doc * 61) % 1728000).cast("int")
    sent = F.timestamp_add("SECOND", seconds, F.lit("2013-01-10 00:00:00").cast("timestamp"))
    reply = F.concat(F.lit("In-Reply-To: <m"), doc % 5, F.lit("@x>\n"))
    return documents.select(
        F.concat(
            F.lit(MAIL_PREFIX + "-"),
            doc,
            F.lit("-x@y "),
            F.date_format(sent, "EEE MMM dd HH:mm:ss yyyy"),
            F.lit("\nMessage-ID: <m"),
            doc % 700,
            F.lit("@x>\nFROM: user"),
            doc % 17,
            F.lit(" <u@x>\nSubject: old\nSubject: "),
            F.when(doc % 11 == 0, "bad#|#").otherwise(""),
            F.col("source"),
            F.lit(" "),
            F.col("lang"),
            F.lit("\n"),
            F.when(doc % 3 == 0, reply).otherwise(""),
            F.lit("\nsoft=\n"),
            F.col("text"),
        ).alias("value")
    )


def car_records(events: DataFrame) -> DataFrame:
    """Car events as 23-field source lines with mixed separators and time offsets."""
    filler = F.lit("x")
    time = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss")
    offset = F.when(F.col("speed") == 0, "Z").otherwise("+0000")
    kept = {
        0: F.col("car_id"),
        1: F.col("id"),
        7: F.col("consumption").cast("string"),
        9: F.col("speed").cast("string"),
        12: F.col("throttle").cast("string"),
        19: F.col("engineload").cast("string"),
        20: F.col("longitude").cast("string"),
        21: F.col("latitude").cast("string"),
        22: F.concat(time, offset),
    }
    parts = [kept[0]]
    for position in range(1, 23):
        parts += [F.lit("; " if position % 2 else ","), kept.get(position, filler)]
    return cars(events).select(F.concat(*parts).alias("value"))


def unreliable_ride_lines(events: DataFrame) -> DataFrame:
    """Ride lines of which some are broken, by the type of their event."""
    start = F.date_format(_start_time(), "yyyy-MM-dd HH:mm:ss")
    kind = F.col("event_type")
    parts = [
        F.col("event_id"),
        F.when(kind == "error", "STOP").otherwise("START"),
        start,
        F.when(kind == "signup", "2024-13-01 00:00:00").otherwise(start),
        F.lit(""),
        F.when(kind == "view", " ").otherwise(""),
        F.lit("-73.95"),
        F.lit("40.78"),
        F.when(kind == "purchase", "99999").otherwise("1"),
        F.col("user_id"),
        F.col("user_id"),
    ]
    line = [parts[0].cast("string")]
    for part in parts[1:]:
        line += [F.lit(","), part.cast("string")]
    return events.select(F.concat(*line, F.lit(",,")).alias("value"))
