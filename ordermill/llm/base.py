"""Helpers the operators of this subpackage share: stages in the shared folder, code shipping, output schemas."""

from __future__ import annotations

import contextlib
import pickle
import sys
import types
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from ordermill.session import fresh_path


def ship(*modules: str) -> None:
    """Send these modules' functions to the Python workers by value, so that executors need no install."""
    for module in (__name__, *modules):
        cloudpickle.register_pickle_by_value(sys.modules[module])


def worker_cache() -> dict:
    """What one Python worker keeps between its tasks (tables built from a broadcast, say)."""
    return sys.modules.setdefault("ordermill_worker_cache", types.ModuleType("ordermill_worker_cache")).__dict__


def once(kind: str, key: str, make):
    """`make()` once for each Python worker and key.

    A kind is named `operator.thing`; a worker keeps the last key of each thing, and those of one operator only: when
    the next one begins, memory of the one before goes back to the system.
    """
    cache = worker_cache()
    if cache.get(kind, (None,))[0] != key:
        operator = kind.partition(".")[0]
        others = [k for k in cache if "." in k and k.partition(".")[0] != operator]
        for k in [*others, kind]:
            cache.pop(k, None)
        if others:
            _give_back()
        cache[kind] = (key, make())
    return cache[kind][1]


def _give_back() -> None:
    import ctypes
    import gc

    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # where the C library cannot do that
        ctypes.CDLL(None).malloc_trim(0)


def send(spark: SparkSession, value):
    """Broadcast a value of bounded size; gives the function that loads it in a Python worker.

    Rows that come after it are texts: a batch of them for Python has fewer rows than Spark's default.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    data = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(data.value)


def new_key(name: str) -> str:
    return f"{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a Parquet table below `spark.checkpoint.dir` and go on from the written rows.

    That cuts the lineage: a lost executor costs the tasks it ran, not the steps before. The table belongs to the
    enclosing `ordermill.session.stages` block, or to the driver until it ends.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def add_columns(df: DataFrame, fields: str) -> str:
    """The schema of `df` with new fields after it; a clashing name of the input is replaced by the new field."""
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(fields)
    names = {f.name.lower() for f in new}
    return StructType([f for f in df.schema if f.name.lower() not in names] + list(new))


def text_blocks(frame, column: str, chars: int = 4_000_000):
    """Slices of a pandas frame whose texts have about `chars` characters together; one longer text stands alone."""
    begin = total = 0
    for i, t in enumerate(frame[column]):
        n = len(t) if t else 0
        if total and total + n > chars:
            yield frame.iloc[begin:i]
            begin, total = i, 0
        total += n + 1
    if begin < len(frame):
        yield frame.iloc[begin:]
