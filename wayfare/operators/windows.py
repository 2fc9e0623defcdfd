"""Tumbling event-time windows: the two-stream join, earliest stops, lateness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.operators.prefix import running_before
from wayfare.schemas import JOINED_TUPLE

#: a group without a stop gets the largest bigint
NO_STOP = 2**63 - 1

#: a key with over this share (one in so many) of a side's rows is joined in several tasks
HOT_SHARES = 200


def tumbling(event_ts: Column, size_ms: int) -> Column:
    """Epoch-aligned, half-open window of ``size_ms``."""
    return F.window(event_ts, f"{size_ms} milliseconds")


def with_ingestion_time(df: DataFrame, column: str = "event_ts") -> DataFrame:
    """Stamp records with the time they pass; an earlier stamp is replaced."""
    return df.withColumn(column, F.current_timestamp())


def with_watermark(df: DataFrame, event_time: str, max_delay_secs: float = 0) -> DataFrame:
    """Allow events to be late by ``max_delay_secs``; has no effect on a batch frame."""
    if max_delay_secs < 0:
        raise ValueError("a delay cannot be negative")
    return df.withWatermark(event_time, f"{round(max_delay_secs * 1000)} milliseconds")


def hot_keys(left: DataFrame, right: DataFrame, size_ms: int = 5000) -> DataFrame:
    """(hot_window, hot_key, l_parts, r_parts): keys of :func:`window_join` that are cut, and into how many parts.

    Of batch frames. A key is in the table if a side has over ``1 / HOT_SHARES`` of its rows there, so the table has
    fewer than ``2 * HOT_SHARES`` rows, however large the sides are.
    """

    def counted(df: DataFrame, key: str, parts: str) -> DataFrame:
        window = tumbling(F.col("event_ts"), size_ms).alias("hot_window")
        counts = df.groupBy(window, F.col(key).alias("hot_key")).agg(F.count("*").alias("n"))
        share = F.ceil(F.col("n") * HOT_SHARES / counts.agg(F.sum("n")).scalar()).cast("int")
        return counts.select("hot_window", "hot_key", share.alias(parts)).filter(F.col(parts) > 1)

    both = counted(left, "tuple_id", "l_parts").join(
        counted(right, "value", "r_parts"), ["hot_window", "hot_key"], "full_outer"
    )
    return both.fillna(1, ["l_parts", "r_parts"])


def _in_cells(df: DataFrame, hot: DataFrame, window: str, key: str, side: str, other: str) -> DataFrame:
    """Rows of a hot key are in one of the parts of their side, and there once for each part of the other side.

    The part is drawn for the row, so equal rows are dealt out, too.
    """
    cut = df.join(F.broadcast(hot), (df[window] == hot["hot_window"]) & (df[key] == hot["hot_key"]), "left")
    parts, copies = F.coalesce(f"{side}_parts", F.lit(1)), F.coalesce(f"{other}_parts", F.lit(1))
    drawn = cut.withColumn(f"{side}_in_{side}", F.floor(F.rand(0) * parts).cast("int"))
    return drawn.withColumn(f"{side}_in_{other}", F.explode(F.sequence(F.lit(0), copies - 1)))


def window_join(
    left: DataFrame,
    right: DataFrame,
    size_ms: int = 5000,
    hot: DataFrame | None = None,
    max_delay_secs: float = 0,
) -> DataFrame:
    """All pairs with ``left.tuple_id = right.value`` in the same tumbling window.

    Works on two batch frames or two streams; the window is part of the join key, which lets a
    stream drop its state when the window is over. A stream loses records that come more than
    ``max_delay_secs`` after the latest of an earlier micro-batch.

    Keys that one task could not hold, on either side, are cut into a grid: rows of the left fall into one row of
    cells, rows of the right into one column, and every pair meets in one cell. Only hot keys are copied. In
    a batch they are looked up by :func:`hot_keys`; for streams, ``hot`` is that table from an earlier batch.
    """
    if hot is None and not (left.isStreaming or right.isStreaming):
        hot = hot_keys(left, right, size_ms)
    left = with_watermark(left, "event_ts", max_delay_secs).select(
        tumbling(F.col("event_ts"), size_ms).alias("l_window"),
        F.col("source_id").alias("l_source_id"),
        F.col("tuple_id").alias("l_tuple_id"),
        F.col("value").alias("l_value"),
    )
    right = with_watermark(right, "event_ts", max_delay_secs).select(
        tumbling(F.col("event_ts"), size_ms).alias("r_window"),
        F.col("source_id").alias("r_source_id"),
        F.col("tuple_id").alias("r_tuple_id"),
        F.col("value").alias("r_value"),
    )
    match = (F.col("l_window") == F.col("r_window")) & (F.col("l_tuple_id") == F.col("r_value"))
    if hot is not None:
        left = _in_cells(left, hot, "l_window", "l_tuple_id", "l", "r")
        right = _in_cells(right, hot, "r_window", "r_value", "r", "l")
        match = match & (F.col("l_in_l") == F.col("r_in_l")) & (F.col("l_in_r") == F.col("r_in_r"))
    return left.join(right, match, "inner").select(*JOINED_TUPLE)


def earliest_stop(
    cars: DataFrame, per: Sequence[str] = ("car_id",), size_ms: int | None = None
) -> DataFrame:
    """Earliest time (epoch ms) at speed 0 of each car, or of each car and window.

    On a stream with a watermark, a window is final when the watermark has passed its end; events of it that come
    later are dropped.
    """
    keys: list[Column] = [F.col(name) for name in per]
    if size_ms is not None:
        keys.append(tumbling(F.col("ts"), size_ms).alias("window"))
    stop_ms = F.min(F.when(F.col("speed") == 0, F.unix_millis("ts")))
    stops = cars.groupBy(*keys).agg(F.coalesce(stop_ms, F.lit(NO_STOP)).alias("earliest_stop_ms"))
    if size_ms is None:
        return stops
    return stops.select(
        *per, F.unix_millis("window.start").alias("window_start_ms"), "earliest_stop_ms"
    )


def ride_counts(rides: DataFrame, size_ms: int, event_time: str = "event_time") -> DataFrame:
    """Records, and starts among them, of each tumbling window."""
    counts = rides.groupBy(tumbling(F.col(event_time), size_ms).alias("window")).agg(
        F.count("*").alias("n_records"), F.count_if("is_start").alias("n_starts")
    )
    return counts.select(F.unix_millis("window.start").alias("window_start_ms"), "n_records", "n_starts")


def lateness_audit(
    events: DataFrame,
    source: str,
    ts_ms: str,
    arrival_order: Sequence[Column],
    delay_ms: int = 30_000,
    ranges: int | None = None,
) -> DataFrame:
    """Watermark each event meets on arrival, and whether it is late.

    After every event the watermark of its source is the largest time seen less the delay; an event
    is late if its time is not above the watermark it meets.
    """
    seen = running_before(events, [source], arrival_order, {"watermark_ms": ("max", F.col(ts_ms))}, ranges)
    watermark = F.col("watermark_ms") - F.lit(delay_ms).cast("bigint")
    late = F.coalesce(F.col(ts_ms) <= F.col("watermark_ms"), F.lit(False))
    return seen.withColumn("watermark_ms", watermark).withColumn("is_late", late)
