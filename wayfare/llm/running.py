"""Running totals over shuffled rows, for groups of any size.

The order is that of a fraction spread evenly over [0, 1), such as a hash. Cutting the fractions into equal
buckets therefore cuts every group, however large, into pieces of about equal size, without sampling: each
bucket is added up, the totals of earlier buckets are carried into it, and rows are ordered inside it only.
How many buckets there are changes the work of a task but no result.
"""

from __future__ import annotations

import gc
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.session import ensure_checkpoint_dir, new_folder

#: buckets of a group for each shuffle partition
BUCKETS_PER_PARTITION = 16


def kept(df: DataFrame) -> DataFrame:
    """The rows, stored in the shared checkpoint folder, so that they are computed once."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


class Stored:
    """Rows written as a table in the shared folder; ``rows`` reads them, ``drop`` deletes them.

    Columns of numbers take a fraction of the room they have in a checkpoint. After the writing, the shuffle files of
    the steps before are of no more use; they go when the driver collects its garbage, so it is asked to.
    """

    def __init__(self, df: DataFrame, purpose: str):
        self._spark = df.sparkSession
        self._path = new_folder(self._spark, purpose)
        df.write.parquet(self._path)
        self.rows = self._spark.read.schema(df.schema).parquet(self._path)
        gc.collect()
        self._spark.sparkContext._jvm.System.gc()

    def drop(self) -> None:
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self._path)
        path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)


def seeded_fraction(seed: int, *values: Column) -> Column:
    """A fraction that looks random but is fixed by the seed and the values; nulls count as empty."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(v.cast("string"), F.lit("")) for v in values))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("bigint") / F.lit(2.0**48)


def group_key(column: Column) -> Column:
    """A group's name without nulls, so that joins and windows deal rows alike."""
    return F.when(column.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), column.cast("string")))


def totals_before(
    df: DataFrame, group: str, fraction: str, order_by: Sequence[str], value: Column, name: str, total: str
) -> DataFrame:
    """Add ``name``, the sum of ``value`` over the rows of the group before this one, and ``total`` over all.

    ``df`` is read twice, so it should be stored; ``group`` must not be null.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = BUCKETS_PER_PARTITION * partitions
    rows = df.withColumns({"_value": value, "_bucket": F.floor(F.col(fraction) * buckets)})
    all_before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy(group, "_bucket")
        .agg(F.sum("_value").alias("_sum"))
        .select(
            group,
            "_bucket",
            F.coalesce(F.sum("_sum").over(all_before), F.lit(0)).alias("_carried"),
            F.sum("_sum").over(Window.partitionBy(group)).alias(total),
        )
    )
    inside = (
        Window.partitionBy(group, "_bucket")
        .orderBy(fraction, *order_by)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.join(carried, [group, "_bucket"])
        .withColumn(name, F.col("_carried") + F.coalesce(F.sum("_value").over(inside), F.lit(0)))
        .drop("_value", "_bucket", "_carried")
    )
