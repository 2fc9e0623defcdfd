"""Travel time by direction: one regression through the origin per 45 degree bucket.

A model is a table of sums per bucket, ``(*keys, bucket, n, sum_xx, sum_xy)``, which any number of
partitions or micro-batches can add to. The sums are decimals: each product is rounded once, by itself, and
then added without rounding, so neither the order of rows nor how they are cut can change a fit or a prediction.
A product beyond LARGEST_TERM counts as that, and one that is not a number counts as nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.codecs import ride_event_time
from wayfare.functions.geo import direction_angle, euclidean_distance
from wayfare.functions.numeric import to_int_saturating, wrap_byte
from wayfare.operators.prefix import running_before

# Buckets per full turn, result without a model, smallest usable sum of squares.
BUCKETS = 8
BUCKET_DEGREES = 45
NO_PREDICTION = -1
SMALLEST_SUM_XX = 4.9e-323

#: Products of distances (km) and times (s) in a sum: 1e-17 is far below what floats of coordinates can tell apart, and a
#: billion products at the bound still fit the 38 digits of a sum.
TERM = "decimal(37,17)"
SUM = "decimal(38,17)"
LARGEST_TERM = 1e12


def direction_bucket(direction: Column, mode: str = "failfast") -> Column:
    """Bucket 0 to 7 of an angle; anything else is an error, or null in quarantine mode."""
    quotient = wrap_byte((direction / F.lit(BUCKET_DEGREES)).cast("bigint"))
    # picking from a constant array checks the range without repeating the angle's expression
    buckets = F.array(*(F.lit(bucket) for bucket in range(BUCKETS)))
    bucket = F.get(buckets, quotient.cast("int"))
    if mode == "quarantine":
        return bucket
    if mode != "failfast":
        raise ValueError("mode must be 'failfast' or 'quarantine'")
    angle = F.coalesce(direction.cast("string"), F.lit("null"))
    message = F.concat(F.lit("No direction bucket for angle "), angle)
    return F.coalesce(bucket, F.raise_error(message).cast("int"))


def ride_features(rides: DataFrame) -> DataFrame:
    """Direction, distance (km) and travel time (s) of completed rides."""
    corners = [F.col(name) for name in ("start_lon", "start_lat", "end_lon", "end_lat")]
    seconds = (F.unix_millis("end_time") - F.unix_millis("start_time")) / F.lit(1000.0)
    return rides.filter(~F.col("is_start")).select(
        "ride_id",
        "taxi_id",
        ride_event_time().alias("event_time"),
        direction_angle(*corners).alias("direction"),
        euclidean_distance(*corners).alias("distance"),
        seconds.alias("travel_time"),
    )


def exact_term(product: Column) -> Column:
    """A product as a decimal of fixed scale."""
    bounded = F.greatest(F.least(product, F.lit(LARGEST_TERM)), F.lit(-LARGEST_TERM))
    return F.when(product.isNotNull() & ~F.isnan(product), bounded).cast(TERM)


def fit(features: DataFrame, keys: Sequence[str] = (), mode: str = "failfast") -> DataFrame:
    """Sums per key and bucket; a partial aggregate runs before the shuffle."""
    bucketed = features.withColumn("bucket", direction_bucket(F.col("direction"), mode))
    if mode == "quarantine":
        bucketed = bucketed.filter(F.col("bucket").isNotNull())
    return bucketed.groupBy(*keys, "bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(exact_term(F.col("distance") * F.col("distance"))).alias("sum_xx"),
        F.sum(exact_term(F.col("distance") * F.col("travel_time"))).alias("sum_xy"),
    )


def merge_models(one: DataFrame, other: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return (
        one.unionByName(other)
        .groupBy(*keys, "bucket")
        .agg(F.sum("n").alias("n"), *(F.sum(name).cast(SUM).alias(name) for name in ("sum_xx", "sum_xy")))
    )


def predicted_time(n: Column, sum_xx: Column, sum_xy: Column, distance: Column) -> Column:
    """Slope times distance, cut to a whole number; -1 while there is no slope."""
    sum_xx, sum_xy = sum_xx.cast("double"), sum_xy.cast("double")
    prediction = F.try_divide(sum_xy, sum_xx) * distance
    no_slope = n.isNull() | (n < 2) | (F.abs(sum_xx) < F.lit(SMALLEST_SUM_XX))
    return F.when(no_slope | F.isnan(prediction), NO_PREDICTION).otherwise(
        to_int_saturating(prediction)
    )


def predict(
    points: DataFrame, model: DataFrame, keys: Sequence[str] = (), mode: str = "failfast"
) -> DataFrame:
    """Add ``bucket`` and ``predicted_time`` to points with ``direction`` and ``distance``.

    Without keys a model is added up to one row per bucket, eight at most, and is broadcast; with keys it can
    be of any size, and the join strategy is left to the optimizer.
    """
    points = points.withColumn("bucket", direction_bucket(F.col("direction"), mode))
    joined = points.join(_looked_up(model, keys), [*keys, "bucket"], "left")
    prediction = predicted_time(*(F.col(c) for c in ("n", "sum_xx", "sum_xy", "distance")))
    return joined.withColumn("predicted_time", prediction).drop("n", "sum_xx", "sum_xy")


def _looked_up(model: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The model as the other side of a join. Without keys it is broadcast, as one row for each bucket that there can be."""
    # never null, so the join adds no null check that would be pushed through the fit
    bucket = F.coalesce("bucket", F.lit(-1)).alias("bucket")
    rows = model.select(*keys, bucket, "n", "sum_xx", "sum_xy")
    if keys:
        return rows
    known = rows.filter(F.col("bucket").between(0, BUCKETS - 1)).groupBy("bucket")
    return F.broadcast(
        known.agg(F.sum("n").alias("n"), *(F.sum(c).cast(SUM).alias(c) for c in ("sum_xx", "sum_xy")))
    )


def prequential(
    features: DataFrame,
    keys: Sequence[str] = (),
    mode: str = "failfast",
    ranges: int | None = None,
    model: DataFrame | None = None,
) -> DataFrame:
    """Predict every point from the points before it, by event time and then ride id.

    ``model`` is what was fitted to points before all of these.
    """
    distance, travel_time = F.col("distance"), F.col("travel_time")
    bucketed = features.withColumn("bucket", direction_bucket(F.col("direction"), mode))
    seen = running_before(
        bucketed,
        [*keys, "bucket"],
        [F.col("event_time").asc(), F.col("ride_id").asc()],
        {
            "n": ("sum", F.lit(1).cast("bigint")),
            "sum_xx": ("sum", exact_term(distance * distance)),
            "sum_xy": ("sum", exact_term(distance * travel_time)),
        },
        ranges,
    )
    if model is not None:
        seen = _with_model(seen, model, keys)
    prediction = predicted_time(*(F.col(c) for c in ("n", "sum_xx", "sum_xy", "distance")))
    return seen.withColumn("predicted_time", prediction).drop("n", "sum_xx", "sum_xy")


def _with_model(seen: DataFrame, model: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums over the points before, and those of a model of earlier points."""
    names = ("n", "sum_xx", "sum_xy")
    earlier = _looked_up(model, keys).withColumnsRenamed({c: f"_model_{c}" for c in names})
    joined = seen.join(earlier, [*keys, "bucket"], "left")
    zero = {"n": F.lit(0).cast("bigint"), "sum_xx": F.lit(0).cast(TERM), "sum_xy": F.lit(0).cast(TERM)}
    kind = {"n": "bigint", "sum_xx": TERM, "sum_xy": TERM}  # a sum of two such is exact
    return joined.withColumns(
        {c: F.coalesce(F.col(c).cast(kind[c]), zero[c]) + F.coalesce(F.col(f"_model_{c}").cast(kind[c]), zero[c]) for c in names}
    ).select(*seen.columns)
