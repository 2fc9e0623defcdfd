"""Text records <-> typed columns for rides, fares and connected cars.

``parse_*`` take any frame (batch or stream) with a text column and return the typed columns.
A malformed record is handled by ``mode``:

* ``failfast``: the job fails on the first one, whichever columns are selected later;
* ``quarantine``: every record is kept, with ``is_valid`` and the ``value`` it came from. Split the
  result with :func:`good_records` and :func:`bad_records`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare import schemas
from wayfare.functions.numeric import parse_float, parse_integer

# Text patterns of the record formats. Single letters accept one or two digits.
READ_TIME = "y-M-d H:m:s"
FOUR_DIGIT_YEAR_TIME = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"
WRITE_TIME = "yyyy-MM-dd HH:mm:ss"
READ_OFFSET_TIME = ("y-M-d'T'H:m:sXX", "y-M-d'T'H:m:sXXX")
BLANKS = " \t\n\x0b\f\r"
RIDE_FIELDS = 11
FARE_FIELDS = 8
CAR_FIELDS = 23

MODES = ("failfast", "quarantine")


def _apply_mode(fields: DataFrame, schema: T.StructType, is_valid: Column, mode: str) -> DataFrame:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    names = schema.fieldNames()
    # A generator is neither pruned nor filtered through: every record is checked, and parsed once
    # even if a filter on a parsed column follows.
    if mode == "quarantine":
        checked = F.struct(*names, "value", F.coalesce(is_valid, F.lit(False)).alias("is_valid"))
        return fields.select(F.inline(F.array(checked)))
    message = F.concat(F.lit("Malformed record: "), F.col("value"))
    record = F.when(is_valid, F.struct(*names)).otherwise(F.raise_error(message))
    return fields.select(F.inline(F.array(record)))


def good_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter("is_valid").drop("value", "is_valid")


def bad_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter("not is_valid").select("value")


def _all_present(names: list[str]) -> Column:
    present = F.lit(True)
    for name in names:
        present = present & F.col(name).isNotNull()
    return present


def _comma_tokens(df: DataFrame, column: str) -> DataFrame:
    """Trailing empty fields do not count, so they are stripped before splitting."""
    text = F.col(column).cast("string")
    return df.select(
        text.alias("value"), F.split(F.rtrim(text, F.lit(",")), ",").alias("tokens")
    )


def _car_tokens(df: DataFrame, column: str) -> DataFrame:
    """Fields apart by ``,`` or ``;``, still with the blanks that may follow a separator.

    Plain text functions, as splitting by a pattern would compile it for every row.
    """
    text = F.col(column).cast("string")
    commas = F.replace(text, F.lit(";"), F.lit(","))
    empty_end = F.right(text, F.lit(1)).isin(*",;", *BLANKS)
    stripped = F.when(empty_end, F.regexp_replace(commas, r"(,\s*)+$", "")).otherwise(commas)
    return df.select(text.alias("value"), F.split(stripped, ",").alias("tokens"))


def _token(position: int) -> Column:
    return F.get("tokens", F.lit(position))


def _time(token: Column) -> Column:
    # a cast is over twice as fast as a pattern, but reads other layouts and no short years
    usual = token.rlike(FOUR_DIGIT_YEAR_TIME)
    return F.when(usual, token.try_cast("timestamp")).otherwise(
        F.try_to_timestamp(token, F.lit(READ_TIME))
    )


def parse_rides(df: DataFrame, mode: str = "failfast", column: str = "value") -> DataFrame:
    """Ride lines; the event's own time comes first, so END lines carry end before start."""
    starts = _token(1) == "START"
    fields = _comma_tokens(df, column).select(
        "value",
        (F.size("tokens") == RIDE_FIELDS).alias("complete"),
        parse_integer(_token(0), "bigint").alias("ride_id"),
        F.when(starts, True).when(_token(1) == "END", False).alias("is_start"),
        _time(_token(2)).alias("first_time"),
        _time(_token(3)).alias("second_time"),
        *(
            parse_float(_token(4 + i)).alias(name)
            for i, name in enumerate(("start_lon", "start_lat", "end_lon", "end_lat"))
        ),
        parse_integer(_token(8), "smallint").alias("passenger_cnt"),
        parse_integer(_token(9), "bigint").alias("taxi_id"),
        parse_integer(_token(10), "bigint").alias("driver_id"),
    )
    fields = fields.select(
        "*",
        F.when(F.col("is_start"), F.col("first_time"))
        .otherwise(F.col("second_time"))
        .alias("start_time"),
        F.when(F.col("is_start"), F.col("second_time"))
        .otherwise(F.col("first_time"))
        .alias("end_time"),
    )
    valid = F.col("complete") & _all_present(schemas.RIDE.fieldNames())
    return _apply_mode(fields, schemas.RIDE, valid, mode)


def parse_fares(df: DataFrame, mode: str = "failfast", column: str = "value") -> DataFrame:
    fields = _comma_tokens(df, column).select(
        "value",
        (F.size("tokens") == FARE_FIELDS).alias("complete"),
        parse_integer(_token(0), "bigint").alias("ride_id"),
        parse_integer(_token(1), "bigint").alias("taxi_id"),
        parse_integer(_token(2), "bigint").alias("driver_id"),
        _time(_token(3)).alias("start_time"),
        _token(4).alias("payment_type"),
        parse_float(_token(5)).alias("tip"),
        parse_float(_token(6)).alias("tolls"),
        parse_float(_token(7)).alias("total_fare"),
    )
    valid = F.col("complete") & _all_present(schemas.FARE.fieldNames())
    return _apply_mode(fields, schemas.FARE, valid, mode)


def parse_cars(df: DataFrame, mode: str = "failfast", column: str = "value") -> DataFrame:
    """Car lines: 23 fields apart by ``,`` or ``;`` and blanks, of which nine are kept."""

    def token(position: int) -> Column:
        return F.ltrim(_token(position), F.lit(BLANKS))

    time = token(22)
    fields = _car_tokens(df, column).select(
        "value",
        (F.size("tokens") == CAR_FIELDS).alias("complete"),
        token(1).alias("id"),
        _token(0).alias("car_id"),
        F.coalesce(
            *(F.try_to_timestamp(time, F.lit(pattern)) for pattern in READ_OFFSET_TIME)
        ).alias("ts"),
        parse_float(token(20)).alias("longitude"),
        parse_float(token(21)).alias("latitude"),
        parse_float(token(7)).alias("consumption"),
        parse_float(token(9)).alias("speed"),
        parse_float(token(12)).alias("throttle"),
        parse_float(token(19)).alias("engineload"),
    )
    valid = F.col("complete") & _all_present(schemas.CAR.fieldNames())
    return _apply_mode(fields, schemas.CAR, valid, mode)


def _line(*parts: Column) -> Column:
    # concat_ws would leave out nulls and shift the fields behind them
    pieces = [F.coalesce(part.cast("string"), F.lit("null")) for part in parts]
    joined = [pieces[0]]
    for piece in pieces[1:]:
        joined += [F.lit(","), piece]
    return F.concat(*joined)


def _text_time(column: Column) -> Column:
    return F.date_format(column, WRITE_TIME)


def ride_line(layout: str = "reference") -> Column:
    """A ride as text.

    ``reference`` always writes start before end, so reading an END line back swaps its times;
    ``roundtrip`` writes the event's own time first, as :func:`parse_rides` expects.
    """
    if layout not in ("reference", "roundtrip"):
        raise ValueError("layout must be 'reference' or 'roundtrip'")
    first, second = F.col("start_time"), F.col("end_time")
    if layout == "roundtrip":
        swap = ~F.col("is_start")
        first, second = F.when(swap, second).otherwise(first), F.when(swap, first).otherwise(second)
    return _line(
        F.col("ride_id"),
        F.when(F.col("is_start"), "START").otherwise("END"),
        _text_time(first),
        _text_time(second),
        *(
            F.col(name)
            for name in (
                "start_lon",
                "start_lat",
                "end_lon",
                "end_lat",
                "passenger_cnt",
                "taxi_id",
                "driver_id",
            )
        ),
    )


def fare_line() -> Column:
    return _line(
        F.col("ride_id"),
        F.col("taxi_id"),
        F.col("driver_id"),
        _text_time(F.col("start_time")),
        *(F.col(name) for name in ("payment_type", "tip", "tolls", "total_fare")),
    )


def car_line() -> Column:
    """A car event as text; car id and consumption are not part of it, so it cannot be read back."""
    return _line(
        F.col("id"),
        F.unix_millis("ts"),
        *(F.col(name) for name in ("longitude", "latitude", "speed", "throttle", "engineload")),
    )


def ride_event_time() -> Column:
    return F.when(F.col("is_start"), F.col("start_time")).otherwise(F.col("end_time"))


def fare_event_time() -> Column:
    return F.col("start_time")
