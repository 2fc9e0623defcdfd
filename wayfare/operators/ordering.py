"""Order and identity of rides, fares and car events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.codecs import fare_event_time, ride_event_time
from wayfare.operators.prefix import position_in_group


def ride_order() -> list[Column]:
    """Event time, START before END; ride id makes it total."""
    return [ride_event_time().asc(), F.col("is_start").desc(), F.col("ride_id").asc()]


def car_order() -> list[Column]:
    return [F.col("ts").asc(), F.col("id").asc()]


def order_rides(rides: DataFrame) -> DataFrame:
    return rides.orderBy(*ride_order())


def order_cars(cars: DataFrame) -> DataFrame:
    return cars.orderBy(*car_order())


def rank_rides(rides: DataFrame, per: str = "taxi_id", ranges: int | None = None) -> DataFrame:
    return position_in_group(rides, [per], ride_order(), ranges=ranges)


def rank_cars(cars: DataFrame, per: str = "car_id", ranges: int | None = None) -> DataFrame:
    return position_in_group(cars, [per], car_order(), ranges=ranges)


def _first_by(df: DataFrame, key: str, order: list[tuple[str, Column]]) -> DataFrame:
    """The first row per key. The minimum is combined before the shuffle, so no key gets too big."""
    others = [name for name in df.columns if name != key]
    ordered = F.struct(*(column.alias(name) for name, column in order), *others)
    first = df.groupBy(key).agg(F.min(ordered).alias("first"))
    return first.select(key, *(f"first.{name}" for name in others)).select(*df.columns)


def unique_rides(rides: DataFrame) -> DataFrame:
    """One record per ride id: START and END of a ride are the same ride, the earlier one stays."""
    return _first_by(
        rides, "ride_id", [("_time", ride_event_time()), ("_after_start", ~F.col("is_start"))]
    )


def unique_fares(fares: DataFrame) -> DataFrame:
    return _first_by(fares, "ride_id", [("_time", fare_event_time())])


def unique_cars(cars: DataFrame) -> DataFrame:
    return _first_by(cars, "id", [("_time", F.col("ts"))])


def distinct_mails(mails: DataFrame) -> DataFrame:
    """One mail per message id: the first by time, sender, subject, body and reply-to."""
    fields = ("message_id", "time", "sender", "subject", "body", "reply_to")
    return _first_by(mails.select(*fields), "message_id", [])
