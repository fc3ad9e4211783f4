"""Sinks and upserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import finite
from ..operators.dedup import dedup_by_key
from ..session import clock


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", **options) -> None:
    """Header, UTF-8, values kept as they are (no trimming, quotes doubled)."""
    writer = df.write.mode(mode).option("header", True).option("encoding", "UTF-8").option("escape", '"').options(**options)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("dateFormat", "yyyy-MM-dd").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss").json(path)


def write_parquet(df: DataFrame, path: str, codec: str = "gzip", partition_by: list[str] | None = None, mode: str = "errorifexists") -> None:
    """Partitioned writes cluster rows by partition first, so a task does not open a file per partition.

    The rebalance may split a partition that is too large, so one busy month is still written by many tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("compression", codec)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def prepare_for_store(df: DataFrame, as_of: str) -> DataFrame:
    """Values as the store takes them, by column type; missing stamps are added."""

    def ready(field: T.StructField) -> Column:
        c, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.StringType):
            return F.when(~c.isin("nan", "None"), c)
        if isinstance(kind, T.BooleanType):
            return c.cast("int")
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            return F.coalesce(c, F.lit(0))
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            usable = F.when(~F.abs(c).isin(float("inf")), finite(c))
            return F.coalesce(usable, F.lit(0.0))
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        return c.cast("string")

    out = df.select(*[ready(f).alias(f.name) for f in df.schema.fields])
    stamp = F.date_format(clock(as_of), "yyyy-MM-dd HH:mm:ss")
    return out.withColumns({c: stamp for c in ("created_at", "updated_at", "processed_at") if c not in df.columns})


def project_to_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns the target table has; others are dropped, none in common is an error."""
    common = [c for c in df.columns if c in set(columns) - {"id"}]
    if not common:
        raise ValueError("no column in common with the target table")
    return df.select(*common)


def upsert(base: DataFrame, delta: DataFrame, keys: list[str], order_by: list) -> DataFrame:
    """Base rows whose key is not in the delta, plus the latest delta row per key (whole-row replace).

    `order_by` lists delta columns, newest first. Columns the delta lacks become null. Each side is read once: the
    delta keeps one row per key on the map side, then a row of the base stays if no row of the delta has its key. Base
    rows with a null in the key match none; they are dealt out by their values, not gathered under the null.
    """
    new = dedup_by_key(delta, keys, order_by).withColumn("_new", F.lit(True))
    both = base.withColumn("_new", F.lit(False)).unionByName(new, allowMissingColumns=True).select(*base.columns, "_new")
    lone = ~F.col("_new") & reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    spread = F.when(lone, F.xxhash64(*base.columns))
    replaced = F.max("_new").over(Window.partitionBy(*keys, spread))
    return both.withColumn("_replaced", replaced).filter(F.col("_new") | ~F.col("_replaced")).select(*base.columns)
