"""Filtered reads, top-k, sampling, updates and deletes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import clock

CRITICAL_COLUMNS = ["order_id", "customer_name", "product", "price"]


def matches(filters: dict) -> Column:
    """AND over columns: a list means IN, a scalar means equality."""
    tests = [F.col(c).isin(*v) if isinstance(v, (list, tuple, set)) else F.col(c) == F.lit(v) for c, v in filters.items()]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def get_orders(df: DataFrame, filters: dict | None = None, limit: int | None = None, offset: int = 0,
               order_by: list | None = None) -> DataFrame:
    out = df.filter(matches(filters or {}))
    if order_by:
        out = out.orderBy(*order_by)
    if offset:
        out = out.offset(offset)
    return out if limit is None else out.limit(limit)


def since(ts: str, hours: float, as_of: str) -> Column:
    """Within the last `hours` before `as_of`."""
    return F.col(ts) >= clock(as_of) - F.expr(f"interval {int(hours * 3600)} seconds")


def recent_rows(df: DataFrame, ts: str, hours: float, as_of: str, order_by: list | None = None) -> DataFrame:
    return df.filter(since(ts, hours, as_of)).orderBy(*(order_by or [F.desc(ts)]))


def top_runs(df: DataFrame, k: int, order_by: list, job_id: str | None = None) -> DataFrame:
    chosen = df if job_id is None else df.filter(F.col("job_id") == job_id)
    return chosen.orderBy(*order_by).limit(k)


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), column).limit(k)


def custom_sql(spark: SparkSession, sql: str, tables: dict[str, DataFrame], args: dict | None = None) -> DataFrame:
    """The user's SQL; `{table}` names a given DataFrame and `:name` binds a value."""
    return spark.sql(sql, args=args, **tables) if args else spark.sql(sql, **tables)


def sample_rows(df: DataFrame, method: str, key: list[str], fraction: float, seed: int = 0,
                strata: str | None = None, order_by: list | None = None) -> DataFrame:
    """random / stratified: by a hash of the key, so repeatable; systematic: evenly spaced rows in order.

    Any fraction is met: the hash has 60 bits, and row i is taken where i * fraction passes a whole number.
    """
    if method == "systematic":
        from .ranking import position_in_group

        placed = position_in_group(df, [], order_by or key)
        taken = F.floor((F.col("position") + 1) * fraction) > F.floor(F.col("position") * fraction)
        return placed.filter(taken).drop("position")
    parts = [F.lit(str(seed))] + ([F.col(strata).cast("string")] if strata and method == "stratified" else [])
    digest = F.md5(F.concat_ws("|", *parts, *[F.col(k).cast("string") for k in key]))
    bucket = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    return df.filter(bucket < F.lit(int(fraction * 2**60)).cast("bigint"))


def retain_complete(df: DataFrame, columns: list[str] = CRITICAL_COLUMNS) -> DataFrame:
    return df.dropna(subset=[c for c in columns if c in df.columns])


def update_where(df: DataFrame, updates: dict, filters: dict) -> DataFrame:
    hit = F.coalesce(matches(filters), F.lit(False))
    return df.withColumns({c: F.when(hit, F.lit(v)).otherwise(F.col(c)) for c, v in updates.items()})


def delete_where(df: DataFrame, filters: dict) -> DataFrame:
    return df.filter(~F.coalesce(matches(filters), F.lit(False)))


def retention_split(df: DataFrame, ts: str, days: int, as_of: str, condition: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, expired): expired rows are older than `days` and meet the condition."""
    old = F.col(ts) < clock(as_of) - F.expr(f"interval {days} days")
    expired = F.coalesce(old if condition is None else old & condition, F.lit(False))
    return df.filter(~expired), df.filter(expired)
