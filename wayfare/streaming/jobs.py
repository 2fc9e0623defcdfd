"""The streaming programs: window join, ride fan-out, mail archive, travel-time model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wayfare.functions.codecs import fare_event_time, ride_event_time
from wayfare.functions.mail import parse_mails
from wayfare.operators import travel_time
from wayfare.operators.ordering import distinct_mails
from wayfare.operators.windows import earliest_stop, hot_keys, ride_counts, window_join, with_ingestion_time, with_watermark
from wayfare.session import ensure_checkpoint_dir, new_folder, no_idle_partitions, use_utc
from wayfare.sources.text import read_mail_archive, read_rides
from wayfare.sources.tuples import increment_value
from wayfare.streaming import sinks


def rides_with_event_time(rides: DataFrame, max_delay_secs: float = 0) -> DataFrame:
    timed = rides.withColumn("event_time", ride_event_time())
    return with_watermark(timed, "event_time", max_delay_secs)


def fares_with_event_time(fares: DataFrame, max_delay_secs: float = 0) -> DataFrame:
    timed = fares.withColumn("event_time", fare_event_time())
    return with_watermark(timed, "event_time", max_delay_secs)


def cars_with_event_time(cars: DataFrame, max_delay_secs: float = 30) -> DataFrame:
    return with_watermark(cars, "ts", max_delay_secs)


def earliest_stop_per_window(cars: DataFrame, size_ms: int, max_delay_secs: float = 30) -> DataFrame:
    """Earliest stop of each car and window, once the window is over; what comes too late for it is dropped."""
    return earliest_stop(cars_with_event_time(cars, max_delay_secs), size_ms=size_ms)


def rides_per_window(rides: DataFrame, size_ms: int, max_delay_secs: float = 60) -> DataFrame:
    """Records of each window, once the window is over; what comes too late for it is dropped."""
    return ride_counts(rides_with_event_time(rides, max_delay_secs), size_ms)


def increment_and_join(
    left: DataFrame,
    right: DataFrame,
    size_ms: int = 5000,
    hot: DataFrame | None = None,
    max_delay_secs: float = 0,
) -> DataFrame:
    """Both sides get their value incremented before they are joined."""
    return window_join(increment_value(left), increment_value(right), size_ms, hot, max_delay_secs)


def hot_keys_of(left: DataFrame, right: DataFrame, size_ms: int = 5000) -> DataFrame:
    """The hot keys of :func:`increment_and_join`, for streams of the same tuples; stored, since every micro-batch reads them."""
    ensure_checkpoint_dir(left.sparkSession)
    return hot_keys(increment_value(left), increment_value(right), size_ms).checkpoint()


def ingestion_time_join(left: DataFrame, right: DataFrame, size_ms: int = 5000) -> DataFrame:
    """The same, with both sides stamped by the time they pass (per micro-batch in a stream)."""
    stamped = with_ingestion_time(left), with_ingestion_time(right)
    return increment_and_join(*stamped, size_ms=size_ms)


def fan_out_rides(
    spark: SparkSession,
    path: str,
    writers: Sequence[sinks.BatchWriter],
    checkpoint: str,
    layout: str = "reference",
    available_now: bool = False,
    **options: str,
) -> StreamingQuery:
    """Ride files to several sinks of text lines."""
    rides = read_rides(use_utc(spark), path, stream=True, **options)
    return sinks.fan_out(sinks.encode_rides(rides, layout), writers, checkpoint, available_now)


def mail_archive_to_text(
    spark: SparkSession, archive: str, output: str, mode: str = "failfast"
) -> None:
    """Scan, parse, keep one mail per message id, write delimited text."""
    mails = parse_mails(read_mail_archive(use_utc(spark), archive), mode)
    sinks.write_mails(distinct_mails(mails), output)


def run_to_files(stream: DataFrame) -> DataFrame:
    """Run a stream over all that is available, and give the files it wrote as a batch frame."""
    spark = stream.sparkSession
    folder = new_folder(spark, "stream")
    with no_idle_partitions(spark):
        query = sinks.append_to_files(stream, f"{folder}/out", f"{folder}/checkpoint", True)
        query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def run_to_latest(stream: DataFrame) -> DataFrame:
    """The same for an aggregate that is replaced with every micro-batch."""
    spark = stream.sparkSession
    folder = new_folder(spark, "stream")
    with no_idle_partitions(spark):
        query = sinks.replace_in_files(stream, f"{folder}/out", f"{folder}/checkpoint", True)
        query.awaitTermination()
    return sinks.latest_version(spark, f"{folder}/out")


def predict_then_refine(
    features: DataFrame,
    predictions_path: str,
    model_path: str,
    checkpoint: str,
    keys: Sequence[str] = (),
    available_now: bool = False,
) -> StreamingQuery:
    """Online use of the model: each record is predicted from those before it, and then adds to the sums.

    Records of a micro-batch are taken in the order of event time and ride id. What the model held before the
    micro-batch is added to the running sums inside it, which :func:`travel_time.prequential` cuts over tasks, so a bucket
    with most of the records is no single task. Predictions are stored under the batch id, and so is
    the model, of which two versions stay: a repeated batch starts from the same model and replaces what it wrote.
    """
    schema = travel_time.fit(features, keys).schema
    write_predictions = sinks.file_batch_writer(predictions_path)

    def step(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        models = sinks.Versions(session, model_path)
        model = models.read(batch_id - 1, schema) if batch_id else session.createDataFrame([], schema)
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_predictions(travel_time.prequential(batch, keys, model=model), batch_id)
            models.write(travel_time.merge_models(model, travel_time.fit(batch, keys), keys), batch_id)
        finally:
            batch.unpersist()

    writer = features.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return sinks.started(features.sparkSession, writer, available_now)
