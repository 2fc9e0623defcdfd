"""Keyed tuples: (source id, tuple id, value), with the time they are joined on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keyed_tuples(
    df: DataFrame,
    source_id: str,
    tuple_id: Column,
    value: Column,
    event_ts: Column | None = None,
) -> DataFrame:
    """Shape any batch or streaming frame into keyed tuples."""
    columns = [
        F.lit(source_id).alias("source_id"),
        tuple_id.cast("bigint").alias("tuple_id"),
        value.cast("bigint").alias("value"),
    ]
    if event_ts is not None:
        columns.append(event_ts.cast("timestamp").alias("event_ts"))
    return df.select(*columns)


def increment_value(tuples: DataFrame) -> DataFrame:
    return tuples.withColumn("value", F.col("value") + F.lit(1).cast("bigint"))


def key_by(tuples: DataFrame, *columns: str) -> DataFrame:
    """Co-locate equal keys. Joins and aggregations do this on their own; use it before a sink."""
    return tuples.repartition(*columns)
