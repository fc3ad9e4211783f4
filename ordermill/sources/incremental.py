"""Watermark pulls from tables and over JDBC, and their state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..operators.monitoring import upsert_runs
from ..session import clock

FULL, TIMESTAMP, ID = "full", "timestamp", "id"


def watermark(mode: str, last_value, as_of: str) -> Column:
    """The bound to pull from; a first run starts 30 days back, or at id 0."""
    if mode == TIMESTAMP:
        return clock(as_of) - F.expr("interval 30 days") if last_value is None else F.lit(str(last_value)).cast("timestamp_ntz")
    return F.lit(0 if last_value is None else int(last_value)).cast("bigint")


def incremental_extract(df: DataFrame, mode: str, column: str | None, as_of: str, last_value=None, limit: int | None = None,
                        order_by: list | None = None, source_id: str = "orders", connection: str = "lake") -> DataFrame:
    """Rows beyond the watermark; the bound is a literal, so it reaches the scan."""
    rows = df if mode == FULL else df.filter(F.col(column) > watermark(mode, last_value, as_of))
    if limit is not None:
        rows = rows.orderBy(*(order_by or [column])).limit(limit)
    return rows.withColumns(
        {"source_id": F.lit(source_id), "source_type": F.lit("database"), "extracted_at": clock(as_of), "connection_name": F.lit(connection)}
    )


def next_watermark(df: DataFrame, mode: str, column: str | None) -> DataFrame:
    """One row: the new last value as text, or null."""
    if mode == FULL or not column or column not in df.columns:
        return df.sparkSession.createDataFrame([(None,)], "last_value string")
    return df.agg(F.max(column).cast("string").alias("last_value"))


def watermark_state(events: DataFrame) -> DataFrame:
    """Latest saved value per source; write it after the sink has committed, never before."""
    return upsert_runs(events.withColumnRenamed("source_id", "run_id")).withColumnRenamed("run_id", "source_id")


def jdbc_query(table: str, mode: str, column: str | None, last_value=None, columns: list[str] = V.ORDER_EXTRACT_COLUMNS) -> str:
    """The projection and watermark as a subquery the database evaluates."""
    where = ""
    if mode == TIMESTAMP and last_value is not None:
        where = f" where {column} > timestamp '{last_value}'"
    elif mode == ID:
        where = f" where {column} > {int(last_value or 0)}"
    return f"(select {', '.join(columns)} from {table}{where}) src"


def jdbc_options(url: str, table: str, mode: str = FULL, column: str | None = None, last_value=None, columns: list[str] = V.ORDER_EXTRACT_COLUMNS,
                 split: tuple[str, str, str, int] | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    """Reader options; `split` is (column, lower, upper, partitions) for parallel reads."""
    options = {"url": url, "dbtable": jdbc_query(table, mode, column, last_value, columns), "fetchsize": str(fetch_size)}
    if split:
        options.update(zip(("partitionColumn", "lowerBound", "upperBound", "numPartitions"), map(str, split)))
    return options


def jdbc_extract(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()
