"""Message-broker source. The connector is an optional package of the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions import codecs

# Topic, and the broker used if none is named.
RIDES_TOPIC = "rides"
DEFAULT_BROKER = "kafka:9092"


def read_messages(
    spark: SparkSession, broker: str = DEFAULT_BROKER, topic: str = RIDES_TOPIC, **options: str
) -> DataFrame:
    """Messages as a stream with ``value`` and the broker's ``timestamp``; it never ends."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", broker)
        .option("subscribe", topic)
    )
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load().select("value", "timestamp")


def decode_rides(messages: DataFrame, mode: str = "failfast") -> DataFrame:
    """Rides of any frame with a binary or string ``value`` column."""
    return codecs.parse_rides(messages.select(F.col("value").cast("string")), mode)
