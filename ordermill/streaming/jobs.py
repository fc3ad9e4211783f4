"""Structured Streaming jobs. Each returns a started query; progress lives in its checkpoint, so a
restarted job continues where the last one committed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.dates import micros
from ..functions.numeric import exact_sum
from ..operators.alerting import MINUTE, evaluate_alert_rules
from ..operators.cleaning import clean_rows
from ..operators.validation import order_errors, split_checked
from ..session import ROCKSDB_PROVIDER
from ..sources.bucketed import BucketedTable
from ..sources.files import CSV_SCHEMA


def read_files(spark: SparkSession, src: str, fmt: str, schema: T.StructType, archive: str | None = None, files_per_trigger: int | None = None,
               **options) -> DataFrame:
    """New files of a folder, each once; processed files can be moved to an archive folder."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(src)


def _start(df: DataFrame, dst: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.format("parquet").option("path", dst).start()


def _each_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_files(spark: SparkSession, src: str, dst: str, checkpoint: str, archive: str | None = None, schema: T.StructType = CSV_SCHEMA,
                 files_per_trigger: int | None = None) -> StreamingQuery:
    """Order CSV files to a table, tagged with their file name; processed once and archived.

    A stream has one schema for all its files, so `schema` lists their columns in the order of their header. A file
    whose header differs fails the query instead of shifting its columns (`enforceSchema` is off).
    """
    rows = read_files(spark, src, "csv", schema, archive, files_per_trigger, header=True, enforceSchema=False, escape='"')
    return _start(rows.withColumn("source_file", F.col("_metadata.file_name")), dst, checkpoint)


def stream_incremental(rows: DataFrame, dst: str, checkpoint: str) -> StreamingQuery:
    """Append what is new since the last run; the checkpoint's offsets replace a stored watermark."""
    return _start(rows, dst, checkpoint)


def stream_dedup(rows: DataFrame, dst: str, checkpoint: str, keys: list[str], ts: str, delay: str) -> StreamingQuery:
    """One row per key among rows within `delay` of each other; state older than that is dropped."""
    stamped = rows.withColumn("_event_time", F.col(ts).cast("timestamp")).withWatermark("_event_time", delay)
    return _start(stamped.dropDuplicatesWithinWatermark(keys).drop("_event_time"), dst, checkpoint)


def stream_clean_validate(rows: DataFrame, dst: str, checkpoint: str, as_of: str, min_severity: str = "low") -> StreamingQuery:
    """Each batch is split into cleaned good rows and rejected rows with reasons.

    A batch writes folders named after its id and overwrites them when it is retried.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = order_errors(batch, as_of).persist()
        try:
            good, bad = split_checked(checked, min_severity)
            clean_rows(good, as_of).write.mode("overwrite").parquet(f"{dst}/good/batch={batch_id}")
            bad.write.mode("overwrite").parquet(f"{dst}/bad/batch={batch_id}")
        finally:
            checked.unpersist()

    return _each_batch(rows, write, checkpoint)


def stream_upsert(rows: DataFrame, dst: str, checkpoint: str, order_by: list) -> StreamingQuery:
    """Replace rows of the bucketed table at `dst` by its keys, batch by batch; only touched buckets are rewritten.

    The table's manifest names the last batch of this checkpoint that is in, so a retried batch changes nothing. Two
    versions stay readable.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table = BucketedTable(batch.sparkSession, dst)
        table.upsert(batch, order_by, source=checkpoint, batch=batch_id)
        table.vacuum(keep=2)

    return _each_batch(rows, write, checkpoint)


def stream_hourly_rollup(metrics: DataFrame, dst: str, checkpoint: str, delay: str = "10 minutes") -> StreamingQuery:
    """Statistics per metric and hour, emitted once the watermark passes the end of the hour."""
    timed = metrics.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", delay)
    stats = timed.groupBy("name", F.window("event_time", "1 hour")).agg(
        F.count(F.lit(1)).alias("n"), exact_sum(F.col("value")).alias("total"), F.min("value").alias("min_value"), F.max("value").alias("max_value"),
        F.percentile_approx("value", 0.95, 10000).alias("p95_approx"),
    )
    flat = stats.select("name", F.col("window.start").cast("timestamp_ntz").alias("hour_start"), "n", "total", "min_value", "max_value", "p95_approx")
    return _start(flat, dst, checkpoint)


def stream_alerts(records: DataFrame, dst: str, checkpoint: str, rules: list[dict], keys: list[str], row_id: str, ts: str = "ts") -> StreamingQuery:
    """Rules per record, then per-key cooldown held in the state store."""
    from .cooldown_state import Cooldown

    spark = records.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    fired = evaluate_alert_rules(records, rules)
    gap: Column = F.col("cooldown_minutes").cast("bigint") * MINUTE
    slim = fired.select(*keys, F.col(row_id).alias("id"), micros(F.col(ts)).alias("tick"), gap.alias("gap"))
    schema = T.StructType([f for f in slim.schema.fields if f.name != "gap"])
    kept = slim.groupBy(*keys).transformWithStateInPandas(statefulProcessor=Cooldown(keys), outputStructType=schema, outputMode="Append", timeMode="None")
    return _start(kept.withColumn(ts, F.timestamp_micros("tick").cast("timestamp_ntz")).drop("tick"), dst, checkpoint)
