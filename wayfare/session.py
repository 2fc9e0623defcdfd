"""Session helpers: UTC time and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_STATE = "spark.sql.streaming.stateStore"
#: state on disk, of which a micro-batch writes what it changed and not all
_DISK_STATE = {
    f"{_STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_folder: str | None = None


def use_utc(spark: SparkSession) -> SparkSession:
    """All record texts are in UTC, so parsing, formatting and windows must be too."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def build_session(app_name: str = "wayfare", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # the state of a stream join is kept on disk, not in the heap of the executors
        **_DISK_STATE,
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return use_utc(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session, where all tasks share one disk, may fall back to a folder of our own.
    """
    global _local_folder
    named = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        or (_local_folder is None and spark.sparkContext.getCheckpointDir())
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="wayfare-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh, not yet existing path below the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable without overriding what the cluster chose."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


@contextmanager
def disk_state(spark: SparkSession) -> Iterator[None]:
    """Streams started in here keep their state on disk, whatever the session was built with.

    A stream keeps the settings of the session it starts in; one that was started before with another store goes on
    with the store its checkpoint names.
    """
    configured = {key: spark.conf.get(key, None) for key in _DISK_STATE}
    for key, value in _DISK_STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in configured.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def no_idle_partitions(spark: SparkSession) -> Iterator[None]:
    """Streams started in here get at most one shuffle partition per core of a local session.

    A stream keeps the number it starts with, without adaptive coalescing, and opens state stores in
    each. On a cluster the configured number stays.
    """
    key = "spark.sql.shuffle.partitions"
    configured = spark.conf.get(key)
    if spark.sparkContext.master.startswith("local"):
        spark.conf.set(key, min(int(configured), spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, configured)
