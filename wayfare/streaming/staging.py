"""A table as a stream of files in a stated order.

Files of a table are in no order of time, and a stream reads them by the time they were written. Here the rows are
numbered in the order wanted, cut into files of equal size, and the files are dated in that order, so that every
micro-batch holds the rows that come next. Nothing is late then: a join or window needs no delay, and keeps the state of
what is open at one time and not of the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.operators.prefix import position_in_group
from wayfare.session import new_folder

#: rows of a file, which one task writes and a micro-batch holds some of
ROWS_PER_FILE = 1_000_000


def files_per_batch(rows: int, batches: int) -> int:
    """How many files each of so many micro-batches takes."""
    return max(1, -(-rows // (batches * ROWS_PER_FILE)))


def stage_in_order(df: DataFrame, order_by: Sequence[Column], batches: int) -> tuple[str, int]:
    """Write the rows as files of equal size in a total order; gives their folder and the files of a micro-batch.

    Row ``i`` of ``n`` (from 0) is in file ``i * files div n``. Two shuffles: one to number the rows, one to deal them to
    their files. Runs when it is called.
    """
    if batches < 1:
        raise ValueError("there must be a batch")
    spark = df.sparkSession
    numbered = position_in_group(df, [], order_by, "_place")
    rows = numbered.count()
    each = files_per_batch(rows, batches)
    files = batches * each
    place = F.expr(f"cast((_place - 1) * {files} div {max(1, rows)} as int)")
    folder = new_folder(spark, "staged")
    numbered.withColumn("_file", place).repartitionById(files, F.col("_file")).sortWithinPartitions("_place").drop(
        "_place", "_file"
    ).write.parquet(folder)
    _date_in_order(spark, folder)
    return folder, each


def read_in_order(spark: SparkSession, folder: str, schema: str | object, files: int) -> DataFrame:
    """The staged files as a stream of so many files each micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def _date_in_order(spark: SparkSession, folder: str) -> None:
    """Give the files of a folder times of writing in the order of their partitions, a second apart.

    A file system that does not keep them would have rows read out of order, so that is an error.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def parts() -> list:
        found = [status for status in system.listStatus(path) if status.getPath().getName().startswith("part-")]
        return sorted(found, key=lambda status: int(status.getPath().getName().split("-")[1]))

    files = parts()
    latest = max((status.getModificationTime() for status in files), default=0)
    for number, status in enumerate(files):
        system.setTimes(status.getPath(), latest - 1000 * (len(files) - 1 - number), -1)
    times = [status.getModificationTime() for status in parts()]
    if any(one >= other for one, other in zip(times, times[1:])):
        raise RuntimeError(f"{folder}: the file system does not keep times of files")
