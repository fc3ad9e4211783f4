"""Joins and lookups. Lookup tables of fixed size are literals; table joins are left to the optimizer,
which broadcasts a side only below its measured size threshold and splits skewed partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.arrays import each_element
from ..functions.categorical import segment_by_customer, segment_priority
from ..functions.numeric import money
from ..functions.text import literal_map, lookup


def revenue_by_tier(orders: DataFrame, customers: DataFrame, key: str = "customer_id") -> DataFrame:
    """Orders joined to the customer's tier, summed per tier.

    Amounts are summed per customer first: the join then moves one row per customer, so a customer
    with a third of all orders cannot skew it.
    """
    per_customer = orders.groupBy(key).agg(F.sum(money(F.col("total_amount"))).alias("revenue"), F.count(F.lit(1)).alias("orders"))
    tiered = per_customer.join(customers.select(key, "tier"), key, "left").filter(F.col("tier").isNotNull())
    return tiered.groupBy("tier").agg(F.sum("revenue").cast("double").alias("revenue"), F.sum("orders").alias("orders"))


def customer_totals(df: DataFrame, key: str = "customer_name", amount: str = "total_amount") -> DataFrame:
    dates = [F.min("order_date").alias("first_order"), F.max("order_date").alias("last_order")]
    if "order_date" not in df.columns:
        dates = [F.lit(None).cast("timestamp_ntz").alias(n) for n in ("first_order", "last_order")]
    spent, n = F.sum(money(F.col(amount))), F.count(F.col(amount))
    return df.groupBy(key).agg(
        spent.cast("decimal(20,2)").alias("total_spent"),
        n.alias("order_count"),
        F.try_divide(spent, n).cast("decimal(18,2)").alias("avg_order_value"),
        *dates,
    )


def segment_back_join(df: DataFrame, key: str = "customer_name", whole: DataFrame | None = None) -> DataFrame:
    """Each order with its customer's segment, lifetime value and priority, by the amounts of `whole`, or its own.

    Aggregate and join back rather than a window per customer: the aggregate combines on the map
    side and the join can be split, so one dominant customer never sits in one task.
    """
    amounts = df if whole is None else whole
    totals = customer_totals(amounts.filter(F.col(key).isNotNull()), key).select(
        key,
        F.col("total_spent").cast("double").alias("customer_ltv"),
        segment_by_customer(F.col("total_spent"), F.col("order_count")).alias("customer_segment"),
    )
    joined = df.join(totals, key, "left")
    segment = F.coalesce(F.col("customer_segment"), F.lit("Budget"))
    return joined.withColumns(
        {
            "customer_segment": segment,
            "customer_ltv": F.coalesce(F.col("customer_ltv"), F.lit(0.0)),
            "customer_priority": segment_priority(segment),
        }
    )


def map_values(df: DataFrame, column: str, mapping: dict, name: str, default=None) -> DataFrame:
    return df.withColumn(name, lookup(F.col(column), mapping, None if default is None else F.lit(default)))


DEFAULT_CHANNELS = [
    {"channel": "log", "enabled": True, "threshold": "LOW"},
    {"channel": "console", "enabled": True, "threshold": "MEDIUM"},
    {"channel": "slack", "enabled": True, "threshold": "HIGH"},
    {"channel": "email", "enabled": True, "threshold": "HIGH"},
    {"channel": "sms", "enabled": False, "threshold": "CRITICAL"},
    {"channel": "webhook", "enabled": True, "threshold": "CRITICAL"},
]


def severity_number(severity: Column) -> Column:
    return F.element_at(literal_map(V.SEVERITY_LEVELS), severity)


def route_notifications(alerts: DataFrame, channels: list[dict] = DEFAULT_CHANNELS, severity: str = "severity") -> DataFrame:
    """One row per alert and enabled channel whose threshold the severity reaches.

    Channels are configuration, so they are an array literal: no join.
    """
    level = severity_number(F.col(severity))
    reached = [F.when(level >= V.SEVERITY_LEVELS[c["threshold"]], F.lit(c["channel"])) for c in channels if c["enabled"]]
    return each_element(alerts, F.array(*reached), "channel")


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    return children.join(parents.select(key), key, "left_anti")
