"""Array helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def each_element(df: DataFrame, array: Column | str, name: str) -> DataFrame:
    """One row per non-null element of the array.

    A plain `explode` makes Spark derive a "not empty" filter from the array's whole expression and
    push it, inlined, down to the joins and scans, where it is computed a second time. The outer
    form with a filter on its result does not.
    """
    return df.withColumn(name, F.explode_outer(array)).filter(F.col(name).isNotNull())
