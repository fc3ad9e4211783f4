"""Positions, exact quantiles and trends without putting a group into one task.

A window per group would sort a hot group in a single task. For positions, rows are range-partitioned on (keys, order)
and sorted: the sort gives a row its place in its run, and a small table of run offsets does the rest. There are
at most `MAX_RUNS` runs; each grows with the rows, as a sort spills. Quantiles are selected by radix: histograms
over the leading bits of the values are refined around the wanted ranks, and rows are never shuffled.

Where a task must hold a range in memory, `range_chunks` makes as many ranges as the rows need.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join where a null key matches a null key; the right side's keys are dropped."""
    renamed = reduce(lambda d, k: d.withColumnRenamed(k, f"_r_{k}"), keys, right)
    matches = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, matches, how).drop(*[f"_r_{k}" for k in keys])


CHUNK_ROWS = 250_000


def range_chunks(df: DataFrame, keys: list[str], order_by: list, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows with a `chunk` number that grows with (keys, order); written out so that it cannot change.

    The rows are written first: they are counted, sampled for the range borders and then dealt out, and none of that
    computes the input again. There are as many ranges as the count needs, each of about `chunk_rows`.
    """
    rows = materialize(df, "unranged")
    n = max(1, -(-rows.count() // chunk_rows))
    spread = rows.repartitionByRange(n, *keys, *order_by)
    return materialize(spread.withColumn("chunk", F.spark_partition_id()), "chunks")


def _with_offsets(chunked: DataFrame, keys: list[str], size: Column) -> DataFrame:
    """Add `_before`, the size of the earlier chunks of the group, and `_total`, that of the group.

    The windows run over one row per (group, chunk), never over the data.
    """
    sizes = chunked.groupBy(*keys, "chunk").agg(size.alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *keys,
        "chunk",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy(*keys)).alias("_total"),
    )
    return null_safe_join(chunked, offsets, [*keys, "chunk"])


MAX_RUNS = 10_000  # Spark samples a million rows for all borders, so that is a hundred for each
_IN_RUN = 33  # bits of a row's number that say where it is in its partition


def sorted_runs(df: DataFrame, keys: list[str], order_by: list, run_rows: int = CHUNK_ROWS, max_runs: int = MAX_RUNS) -> DataFrame:
    """Rows in sorted runs: `_run` grows with (keys, order), `_place` counts from 0 in the run. Both are written out."""
    rows = materialize(df, "unsorted")
    n = min(max_runs, max(1, -(-rows.count() // run_rows)))
    ordered = rows.repartitionByRange(n, *keys, *order_by).sortWithinPartitions(*keys, *order_by)
    at = F.monotonically_increasing_id()
    return materialize(ordered.withColumn("_at", at), "runs").select(
        *df.columns, F.shiftright("_at", _IN_RUN).cast("int").alias("_run"), F.col("_at").bitwiseAND((1 << _IN_RUN) - 1).alias("_place")
    )


def position_in_group(df: DataFrame, keys: list[str], order_by: list, name: str = "position", run_rows: int = CHUNK_ROWS, max_runs: int = MAX_RUNS) -> DataFrame:
    """0-based position of each row in its group; `order_by` must be a total order.

    A group lies in consecutive runs, so a row's position is its place in the run, less that of the group's first row
    there, plus the group's rows in earlier runs. The window is over one row per group and run. Without keys there is
    one offset a run, `max_runs` at most, which is broadcast, and rows are shuffled by the sort only.
    """
    runs = sorted_runs(df, keys, order_by, run_rows, max_runs)
    parts = runs.groupBy(*keys, "_run").agg(F.count(F.lit(1)).alias("_size"), F.min("_place").alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first")
    shifts = parts.select(*keys, "_run", shift.alias("_shift"))
    placed = null_safe_join(runs, shifts if keys else F.broadcast(shifts), [*keys, "_run"])
    return placed.withColumn(name, F.col("_place") + F.col("_shift")).select(*[c for c in df.columns if c != name], name)


def sequential_id(df: DataFrame, order_by: list, name: str = "record_id") -> DataFrame:
    """1..n over the whole table."""
    return position_in_group(df, [], order_by, name).withColumn(name, F.col(name) + 1)


def ordered_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Distinct values per group with the 0-based position of their first copy and the group size."""
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("copies"))
    chunked = _with_offsets(range_chunks(counted, keys, [value]), keys, F.sum("copies"))
    upto = Window.partitionBy(*keys, "chunk").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    first = F.col("_before") + F.sum("copies").over(upto) - F.col("copies")
    return chunked.withColumn("first", first).withColumnRenamed("_total", "n").drop("_before", "chunk")


_EXPONENT, _MANTISSA = 1001, 1 << 52
MAX_GROUPS = 10_000  # of which the wanted cells are broadcast


def radix_code(value: Column) -> Column:
    """A long that never falls as the number grows: sign, exponent and leading bits of the fraction.

    Numbers may share a code (integers beyond 2^53, the tiniest fractions); infinities and NaN take the ends, in Spark's
    order.
    """
    x = value.cast("double")
    size = F.abs(x)
    exponent = F.greatest(F.floor(F.log2(size)), F.lit(1 - _EXPONENT))
    fraction = F.floor((size * F.pow(F.lit(2.0), -exponent.cast("double")) - 1) * float(_MANTISSA))
    code = (exponent + _EXPONENT) * F.lit(_MANTISSA) + F.greatest(F.lit(0), F.least(fraction, F.lit(_MANTISSA - 1)))
    code = F.when(size == float("inf"), F.lit((1 << 63) - 2)).otherwise(code)
    return F.when(F.isnan(x), F.lit((1 << 63) - 1)).when(x == 0, F.lit(0)).when(x < 0, -code).otherwise(code).cast("bigint")


def select_ranks(df: DataFrame, keys: list[str], value: str, ranks: dict[str, Column]) -> DataFrame | None:
    """The values at 0-based ranks of each group (expressions of the group's size `n`): one row a group, with `n`.

    Four passes over the written rows. Each counts the cells of 16 more bits around the wanted ranks, on the map side
    first, and keeps the cells that hold them; the last counts the different values of a cell, 65536 codes at most.
    What is shuffled depends on groups, ranks and cells, not on rows. None if there are more than `MAX_GROUPS` groups.
    """
    rows = materialize(df.filter(F.col(value).isNotNull()).select(*keys, value, radix_code(F.col(value)).alias("_code")), "coded")
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), at.cast("bigint").alias("at")) for name, at in ranks.items()])
    state, known = None, 0
    for bits in (16, 32, 48, 64):
        cell = F.col(value) if bits == 64 else F.shiftright("_code", 64 - bits)
        within = rows.withColumn("_parent", F.shiftright("_code", 64 - known) if known else F.lit(0).cast("bigint"))
        if state is not None:
            within = null_safe_join(within, F.broadcast(state.select(*keys, "_parent").distinct()), [*keys, "_parent"])
        counted = within.groupBy(*keys, "_parent", cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_copies"))
        upto = F.sum("_copies").over(Window.partitionBy(*keys, "_parent").orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0))
        counted = counted.withColumns({"_end": upto, "_first": upto - F.col("_copies")})
        if state is None:
            sized = counted.withColumn("n", F.sum("_copies").over(Window.partitionBy(*keys)))
            targets = sized.select(*keys, "_cell", "_first", "_end", "n", F.explode(wanted).alias("_w"))
            targets = targets.select(*keys, "_cell", "_first", "_end", "n", F.col("_w.name").alias("_name"), F.col("_w.at").alias("_rank"))
        else:
            targets = null_safe_join(state, counted, [*keys, "_parent"]).withColumns({"_first": F.col("_base") + F.col("_first"), "_end": F.col("_base") + F.col("_end")})
        hit = targets.filter((F.col("_first") <= F.col("_rank")) & (F.col("_rank") < F.col("_end")))
        state = hit.select(*keys, "n", "_name", "_rank", F.col("_first").alias("_base"), F.col("_cell").alias("_parent"))
        if bits < 64:
            state = materialize(state, "cells")
        if known == 0 and keys and state.select(*keys).distinct().limit(MAX_GROUPS + 1).count() > MAX_GROUPS:
            return None
        known = bits
    found = [F.max(F.when(F.col("_name") == name, F.col("_parent"))).alias(name) for name in ranks]
    return state.groupBy(*keys).agg(F.max("n").alias("n"), *found)


def _ranks_by_order(df: DataFrame, keys: list[str], value: str, ranks: dict[str, Column]) -> DataFrame:
    """The same from sorted distinct values, for any number of groups."""
    hit = [(F.col("first") <= at) & (at < F.col("first") + F.col("copies")) for at in ranks.values()]
    found = [F.max(F.when(h, F.col(value))).alias(name) for name, h in zip(ranks, hit)]
    return ordered_counts(df, keys, value).groupBy(*keys).agg(F.max("n").alias("n"), *found)


def quantiles(df: DataFrame, keys: list[str], value: str, wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """Exact quantiles per group.

    `wanted` maps a column name to ("linear", q), interpolated, or ("rank", q), the element at
    0-based position floor(q * n).
    """
    n, ranks = F.col("n"), {}
    for name, (method, q) in wanted.items():
        if method == "rank":
            ranks[f"_at_{name}"] = F.floor(F.lit(q) * n)
        else:
            ranks |= {f"_lo_{name}": F.floor(F.lit(q) * (n - 1)), f"_hi_{name}": F.ceil(F.lit(q) * (n - 1))}
    numeric = isinstance(df.schema[value].dataType, T.NumericType) and all(q < 1 or method == "linear" for method, q in wanted.values())
    found = select_ranks(df, keys, value, ranks) if numeric else None
    if found is None:
        found = _ranks_by_order(df, keys, value, ranks)
    columns = []
    for name, (method, q) in wanted.items():
        if method == "rank":
            columns.append(F.col(f"_at_{name}").alias(name))
            continue
        step = F.lit(q) * (n - 1)
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        share = step - F.floor(step)
        columns.append(F.when(low == high, low).otherwise(low * (1 - share) + high * share).alias(name))
    return found.select(*keys, *columns)


def trend(df: DataFrame, keys: list[str], value: str, order_by: list) -> DataFrame:
    """Correlation of the value with its position in time, as a label; no variance means stable."""
    placed = position_in_group(df.filter(F.col(value).isNotNull()), keys, order_by)
    stats = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), correlation("position", value).alias("r"))
    return stats.withColumn("trend", trend_label(F.col("n"), F.col("r"))).drop("n", "r")


def correlation(x: str, y: str) -> Column:
    """Pearson correlation; null without variance (`corr` would fail there by dividing by zero)."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def trend_label(n: Column, r: Column) -> Column:
    return (
        F.when(n < 2, "insufficient_data")
        .when(r.isNull() | (F.abs(r) < 0.1), "stable")
        .when(r > 0, "increasing")
        .otherwise("decreasing")
    )
