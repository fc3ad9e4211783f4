"""De-duplication and duplicate reports.

"First" always means first by an explicit `order_by` with a total tie-break. `row_number() = 1`
lets Spark keep one row per key on the map side (window group limit), so a key that owns a third
of the rows reaches the shuffle as one row per map task.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import fresh_path, remove, shuffles_dropped

COMPOSITE_KEY = ["customer_name", "product", "order_date", "price"]


def dedup_exact(df: DataFrame) -> DataFrame:
    return df.distinct()


def dedup_by_key(df: DataFrame, keys: list[str], order_by: list) -> DataFrame:
    """First row per key; rows with a null key count as one key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def dedup_in_slices(df: DataFrame, passes: list[list[str]], order_by: list, slices: int, then: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`then` of `dedup_by_key` by each list of keys in turn, for rows of which a shuffle holds too many; the result is a stage.

    A pass writes its rows, as packed columns, in slices by a hash of its keys. One slice after the other is then
    shuffled and written for the next pass, and it and its shuffle go before the next one's turn. So the disk holds the
    packed rows once and one slice of them as shuffled rows. A key is in one slice, so the rows are those of `dedup_by_key`.
    """
    spark = df.sparkSession
    parts = [(df, None)]

    def written(name: str, keys: list[str]) -> str:
        path = fresh_path(spark, name)
        for rows, source in parts:
            # not Spark's own hash: its partitions would then hold a slice in a few of them
            dealt = rows.withColumn("_slice", F.pmod(F.xxhash64(*keys), F.lit(slices)).cast("int")) if keys else then(rows)
            writer = dealt.write.mode("append").option("compression", "zstd")
            (writer.partitionBy("_slice") if keys else writer).parquet(path)
            if source:
                remove(spark, source)
        return path

    with shuffles_dropped(spark):
        for keys in passes:
            path = written("dealt", keys)
            whole = spark.read.schema(df.withColumn("_slice", F.lit(0)).schema).parquet(path)
            parts = [(dedup_by_key(whole.filter(F.col("_slice") == i).drop("_slice"), keys, order_by), f"{path}/_slice={i}") for i in range(slices)]
        return spark.read.schema(then(df).schema).parquet(written("first", []))


def dedup_composite(df: DataFrame, order_by: list, keys: list[str] = COMPOSITE_KEY, at_least: int = 3) -> DataFrame:
    present = [k for k in keys if k in df.columns]
    return dedup_by_key(df, present, order_by) if len(present) >= at_least else df


def dedup_orders(df: DataFrame, order_by: list, key: str = "order_id", slices: int | None = None,
                 then: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """By order id, then by the composite key; identical rows share an id, so they need no pass of their own.

    `then` is a narrow step on the rows that stay. With `slices`, rows that have these columns go by `dedup_in_slices`.
    """
    if slices and {key, *COMPOSITE_KEY} <= set(df.columns):
        return dedup_in_slices(df, [[key], COMPOSITE_KEY], order_by, slices, then)
    first = dedup_by_key(df, [key], order_by) if key in df.columns else dedup_exact(df)
    return then(dedup_composite(first, order_by))


def key_counts(df: DataFrame, keys: list[str], name: str = "n_rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def duplicated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return key_counts(df, keys).filter("n_rows > 1")


def duplicate_keys_report(df: DataFrame, key: str, sample: int = 5) -> DataFrame:
    """Rows that share a key with another row, number of such keys, and the smallest few of them."""
    dups = duplicated_keys(df, [key])
    totals = dups.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("affected_records"), F.count(F.lit(1)).alias("duplicate_keys")
    )
    smallest = dups.filter(F.col(key).isNotNull()).select(key).orderBy(key).limit(sample)
    listed = smallest.agg(F.array_join(F.array_sort(F.collect_list(key)), ", ").alias("ids"))
    return totals.select("*", listed.scalar().alias("sample_ids"))


def redundant_rows() -> Column:
    return F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0))


def duplicate_rows_count(df: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """Redundant copies of whole rows, and redundant rows per (non-null) key."""
    exact = key_counts(df, columns or df.columns).agg(redundant_rows().alias("exact_duplicates"))
    keyed = key_counts(df.filter(F.col(key).isNotNull()), [key]).agg(redundant_rows().alias("key_duplicates"))
    return exact.select("*", keyed.scalar().alias("key_duplicates"))


def suspicious_duplicates(
    df: DataFrame, fields: tuple[str, ...] = ("customer_name", "product", "order_date", "total_amount")
) -> DataFrame:
    return duplicated_keys(df, list(fields))


def union_sources(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
