"""Sinks for batch frames and streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from wayfare.functions.codecs import ride_line
from wayfare.functions.mail import RECORD_DELIMITER, mail_line
from wayfare.session import disk_state
from wayfare.sources.messages import DEFAULT_BROKER, RIDES_TOPIC

BatchWriter = Callable[[DataFrame, int], None]

#: how often a long-running stream records its progress
CHECKPOINT_INTERVAL = "10 seconds"


def encode_rides(rides: DataFrame, layout: str = "reference") -> DataFrame:
    """One message per ride: ``value`` is its text line."""
    return rides.select(ride_line(layout).alias("value"))


def write_mails(mails: DataFrame, path: str) -> None:
    """Delimited text without quoting: no field can hold a delimiter. Fails if the path exists."""
    lines = mails.select(mail_line().alias("value"))
    lines.write.option("lineSep", RECORD_DELIMITER).mode("errorifexists").text(path)


def message_writer(
    values: DataFrame,
    checkpoint: str,
    broker: str = DEFAULT_BROKER,
    topic: str = RIDES_TOPIC,
) -> DataStreamWriter:
    """Stream of ``value`` to a topic, at least once; ``start()`` needs the broker's connector."""
    return (
        values.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", broker)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=CHECKPOINT_INTERVAL)
    )


def message_batch_writer(broker: str = DEFAULT_BROKER, topic: str = RIDES_TOPIC) -> BatchWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.format("kafka").option("kafka.bootstrap.servers", broker)
        writer.option("topic", topic).save()

    return write


def file_batch_writer(path: str, file_format: str = "parquet") -> BatchWriter:
    """Each micro-batch in a folder of its own: a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(file_format).mode("overwrite").save(f"{path}/batch_id={batch_id}")

    return write


def fan_out(
    stream: DataFrame, writers: Sequence[BatchWriter], checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Write every record to each of the sinks, reading the source once.

    Kept on disk between the writes, so a batch larger than memory is no problem. A restart repeats
    a batch in all sinks: at least once, or exactly once with :func:`file_batch_writer`.
    """

    def write_all(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for write in writers:
                write(batch, batch_id)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(write_all).option("checkpointLocation", checkpoint)
    return started(stream.sparkSession, writer, available_now)


def print_record(record: Row) -> None:
    print(*record, sep="\t")


def print_stream(stream: DataFrame, emit: Callable[[Row], None] = print_record) -> DataStreamWriter:
    """Print every record where it is, to the output of its executor; ``emit`` does the printing."""
    return stream.writeStream.foreach(emit)


def append_to_files(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Append to parquet exactly once."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return started(stream.sparkSession, writer, available_now)


class Versions:
    """A table that is replaced as a whole, version by version, of which the last two are kept.

    A version is written beside the one before and counts once it is complete. Then all before the previous one go, so
    the folder never holds more than a few, and finding the newest means listing those. The previous one is
    what a repeated micro-batch starts from.
    """

    KEPT = 2

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path
        self._folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._system = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def _place(self, version: int) -> str:
        return f"{self._path}/batch_id={version}"

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        if not self._system.exists(self._folder):
            return []
        names = [status.getPath().getName() for status in self._system.listStatus(self._folder)]
        numbers = [int(name.partition("=")[2]) for name in names if name.startswith("batch_id=")]
        done = self._spark._jvm.org.apache.hadoop.fs.Path
        return sorted(n for n in numbers if self._system.exists(done(f"{self._place(n)}/_SUCCESS")))

    def write(self, df: DataFrame, version: int) -> None:
        """Write or replace a version."""
        df.write.mode("overwrite").parquet(self._place(version))
        for old in self.versions():
            if old <= version - self.KEPT:
                self._system.delete(self._spark._jvm.org.apache.hadoop.fs.Path(self._place(old)), True)

    def read(self, version: int, schema: T.StructType | None = None) -> DataFrame:
        reader = self._spark.read.schema(schema) if schema else self._spark.read
        return reader.parquet(self._place(version))

    def newest(self) -> DataFrame:
        versions = self.versions()
        if not versions:
            raise FileNotFoundError(f"{self._path} holds no version")
        return self.read(versions[-1])


def replace_in_files(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Keep a whole aggregate result (``complete`` mode), a version per micro-batch of which two stay."""
    writer = (
        stream.writeStream.outputMode("complete")
        .foreachBatch(lambda batch, batch_id: Versions(batch.sparkSession, path).write(batch, batch_id))
        .option("checkpointLocation", checkpoint)
    )
    return started(stream.sparkSession, writer, available_now)


def latest_version(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`replace_in_files` wrote last."""
    return Versions(spark, path).newest()


def started(spark: SparkSession, writer: DataStreamWriter, available_now: bool) -> StreamingQuery:
    """Start with state on disk: once over what is there, or for good."""
    trigger = {"availableNow": True} if available_now else {"processingTime": CHECKPOINT_INTERVAL}
    with disk_state(spark):
        return writer.trigger(**trigger).start()
