"""Session settings, the fixed clock, and durable materialisation."""

from __future__ import annotations

import atexit
import contextlib
import sys
import uuid
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# No operator reads the wall clock; these are the defaults for `as_of`.
ORDERS_AS_OF = "2001-12-31 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where that costs one more shuffle further up
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the JVM never compiles methods above 8000 bytes; longer ones are generated operator by operator
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(app: str = "ordermill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_RUNTIME_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Set the run-time options results or skew handling depend on."""
    for key, value in _RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by `spark.checkpoint.dir`."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return named


_STAGES: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, owned by this driver until it is dropped."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _STAGES.append(path)
    return path


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a stage as a table in the shared folder and go on from there.

    Cuts lineage without tying blocks to an executor, and later readers prune columns. The table belongs to the
    enclosing `stages` block, or to the driver until it ends.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a stage or a folder of one; what is not there is no error."""
    context = spark.sparkContext
    gone = context._jvm.org.apache.hadoop.fs.Path(path)
    gone.getFileSystem(context._jsc.hadoopConfiguration()).delete(gone, True)


def drop_stages(spark: SparkSession, first: int = 0) -> None:
    """Remove the stages written so far (from the given one on); frames that still read them become unusable."""
    while len(_STAGES) > first:
        remove(spark, _STAGES.pop())


_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffles of what is written inside are removed with the end of its job; for tables that are read from then on."""
    before = spark.conf.get(_SHUFFLES_GO, "false")
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLES_GO, before)


@contextlib.contextmanager
def stages(spark: SparkSession) -> Iterator[None]:
    """Own the stages written inside: they are removed at the end, when the results have been written or collected."""
    first = len(_STAGES)
    try:
        yield
    finally:
        drop_stages(spark, first)


@atexit.register
def _drop_at_exit() -> None:
    spark = SparkSession.getActiveSession() if _STAGES else None
    if spark is not None:
        with contextlib.suppress(Exception):  # the JVM may be gone already
            drop_stages(spark)


def ship(module: str) -> None:
    """Send a module's functions to the Python workers by value, so executors need no install."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def clock(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")
