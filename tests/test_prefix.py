from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wayfare.operators import ordering, travel_time, windows
from wayfare.operators.prefix import position_in_group, running_before
from wayfare.session import ensure_checkpoint_dir, new_folder, shared_folder


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group; times repeat; a null group."""
    return spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 30 == 1, None)
        .otherwise((F.col("id") % 7).cast("string"))
        .alias("key"),
        ((F.col("id") * 7919) % 100).alias("time"),
        ((F.col("id") * 104729) % 1000).alias("amount"),
    )


def order():
    return [F.col("time").desc(), F.col("id").asc()]


def running():
    return {
        "total": ("sum", F.col("amount")),
        "largest": ("max", F.col("amount")),
        "smallest": ("min", F.col("amount")),
    }


def as_window(df, group_by, order_by, aggregates):
    """The same by one window, a task for each group."""
    window = Window.partitionBy(*group_by).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    kinds = {"sum": F.sum, "max": F.max, "min": F.min}
    return df.withColumns({name: kinds[kind](value).over(window) for name, (kind, value) in aggregates.items()})


def same_rows(one, other):
    return one.columns == other.columns and sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


@pytest.mark.parametrize("ranges", [1, 2, 17, 64])
def test_ranges_give_what_one_window_gives(skewed, ranges):
    plain = as_window(skewed, ["key"], order(), running())
    assert same_rows(running_before(skewed, ["key"], order(), running(), ranges), plain)


def test_small_batches_nulls_and_two_group_columns(spark, skewed):
    aggregates = {
        "total": ("sum", F.when(F.col("amount") > 300, F.col("amount"))),
        "exact": ("sum", (F.when(F.col("id") % 4 > 0, F.col("amount") - 400) / 7).cast("decimal(37,17)")),
        "largest": ("max", F.when(F.col("amount") % 5 == 0, F.col("amount"))),
    }
    rows = skewed.withColumn("other", F.when(F.col("id") % 2 == 0, F.col("id") % 3))
    plain = as_window(rows, ["key", "other"], order(), aggregates)
    plain = plain.withColumn("exact", F.col("exact").cast("decimal(37,17)"))
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, 7)
    try:
        got = running_before(rows, ["key", "other"], order(), aggregates, 5)
        got = got.withColumn("exact", F.col("exact").cast("decimal(37,17)"))
        assert same_rows(got, plain)
    finally:
        spark.conf.set(batch, before)


def test_no_task_gets_the_hot_group_and_rows_move_once(skewed):
    ranked = position_in_group(skewed, ["key"], order(), ranges=16)
    sizes = ranked.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 12 and max(r["count"] for r in sizes) < 500
    # the stored rows are joined where they are: the exchanges left are those of one row per range
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    positions = [r.position for r in ranked.filter("key = 'hot'").collect()]
    assert sorted(positions) == list(range(1, 1001))


def test_empty_frame_and_sums_of_doubles(skewed):
    assert position_in_group(skewed.limit(0), ["key"], order()).collect() == []
    with pytest.raises(ValueError):
        running_before(skewed, ["key"], order(), {"total": ("sum", F.col("amount") / 2)})
    with pytest.raises(ValueError):
        running_before(skewed, ["key"], order(), {"mean": ("avg", F.col("amount"))})


def test_hot_taxi(spark, skewed):
    rides = skewed.select(
        F.col("id").alias("ride_id"),
        (F.col("amount") % 2 == 0).alias("is_start"),
        F.timestamp_seconds("time").alias("start_time"),
        F.timestamp_seconds(F.col("time") + 3).alias("end_time"),
        F.coalesce("key", F.lit("none")).alias("taxi_id"),
    )
    place = Window.partitionBy("taxi_id").orderBy(*ordering.ride_order())
    assert same_rows(ordering.rank_rides(rides, ranges=30), rides.withColumn("position", F.row_number().over(place).cast("bigint")))


def test_hot_source_in_the_lateness_audit(skewed):
    events = skewed.na.fill("none").withColumn("arrival", F.col("time") + F.col("amount"))
    arrival = [F.col("arrival").asc(), F.col("id").asc()]
    audits = [windows.lateness_audit(events, "key", "time", arrival, 5, ranges) for ranges in (1, 30)]
    assert same_rows(*audits)
    assert 0 < audits[0].filter("is_late").count() < 3000


def test_prequential_is_equal_at_one_and_many_ranges_with_inexact_doubles(skewed):
    features = skewed.select(
        F.col("id").alias("ride_id"),
        F.timestamp_seconds("time").alias("event_time"),
        ((F.col("id") * 17) % 360).cast("int").alias("direction"),
        (F.col("amount") / 7.0 * F.when(F.col("id") % 11 == 0, 1e5).otherwise(1.0)).alias("distance"),
        (F.sqrt(F.col("time") + 0.1) * 1e4).alias("travel_time"),
    )
    rows = [travel_time.prequential(features, ranges=ranges) for ranges in (1, 64)]
    assert same_rows(*rows)
    assert rows[0].filter("predicted_time > 0").count() > 200
    fits = [travel_time.fit(features.orderBy(*by).coalesce(n)) for by, n in ((["ride_id"], 1), (["distance"], 7))]
    assert same_rows(*fits)


def test_terms_that_are_no_numbers_or_too_large(spark):
    values = spark.createDataFrame([(float("nan"),), (float("inf"),), (-1e300,), (0.1,), (None,)], "x double")
    terms = [r[0] for r in values.select(travel_time.exact_term(F.col("x"))).collect()]
    assert terms == [None, Decimal(10**12), Decimal(-(10**12)), Decimal("0.1"), None]


def test_shared_folder_is_kept_and_usable_for_checkpoints(spark):
    assert new_folder(spark, "x").startswith(shared_folder(spark) + "/x-")
    assert new_folder(spark, "x") != new_folder(spark, "x")
    ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir()


class _Cluster:
    """As much of a session as the choice of the folder looks at."""

    def __init__(self, **settings):
        self.settings = settings
        self.conf = self.sparkContext = self
        self.master = "spark://cluster"

    def getConf(self):  # noqa: N802
        return self

    def getCheckpointDir(self):  # noqa: N802
        return self.settings.get("set_by_hand")

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_a_cluster_names_the_folder():
    assert shared_folder(_Cluster(**{"spark.checkpoint.dir": "hdfs://x/y/"})) == "hdfs://x/y"
    with pytest.raises(RuntimeError):
        shared_folder(_Cluster())
