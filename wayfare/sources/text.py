"""Text sources. Each returns a frame with one string column ``value`` or the parsed records.

All of them work on batch and on streams; ``stream=True`` reads a folder that files arrive in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions import codecs
from wayfare.functions.mail import MAIL_PREFIX


def read_lines(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    line_separator: str | None = None,
    partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """Lines of plain or gzipped UTF-8 text.

    A gzip file is one task, however large: give ``partitions`` to spread its lines before the
    parse, or store many smaller files.
    """
    reader = spark.readStream if stream else spark.read
    if line_separator:
        reader = reader.option("lineSep", line_separator)
    for key, value in options.items():
        reader = reader.option(key, value)
    lines = reader.text(path)
    return lines.repartition(partitions) if partitions else lines


def read_rides(
    spark: SparkSession, path: str, mode: str = "failfast", stream: bool = False, **options
) -> DataFrame:
    return codecs.parse_rides(read_lines(spark, path, stream, **options), mode)


def read_fares(
    spark: SparkSession, path: str, mode: str = "failfast", stream: bool = False, **options
) -> DataFrame:
    return codecs.parse_fares(read_lines(spark, path, stream, **options), mode)


def read_cars(
    spark: SparkSession, path: str, mode: str = "failfast", stream: bool = False, **options
) -> DataFrame:
    return codecs.parse_cars(read_lines(spark, path, stream, **options), mode)


def read_mail_archive(
    spark: SparkSession, path: str, stream: bool = False, prefix: str = MAIL_PREFIX, **options
) -> DataFrame:
    """Raw mails of an archive, split wherever the prefix occurs (in a body as well).

    The separator is searched by the text source, so large archives are read in parallel splits.
    """
    pieces = read_lines(spark, path, stream, line_separator=prefix, **options)
    mail = F.when(F.startswith("value", F.lit("From ")), F.col("value")).otherwise(
        F.concat(F.lit(prefix), F.col("value"))
    )
    return pieces.select(mail.alias("value"))
