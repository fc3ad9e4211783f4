"""Business aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregates as A
from . import sqltext as S
from .bindings import table
from .orders import dirty, raw
from .registry import query

_REVENUE = f"sum({S.cents('total_amount')}) / 100.0"
# mean to the cent, half away from zero (an order total can be negative)
_AVG = f"sign(sum({S.cents('total_amount')})) * floor((2 * abs(sum({S.cents('total_amount')})) + count(*)) / (2.0 * count(*))) / 100.0"


@query("customer_metrics", f"select customer_name, {_REVENUE} as total_spent, count(*) as order_count, {_AVG} as avg_order_value, min(order_date) as first_order, max(order_date) as last_order from {{orders_raw}} group by 1")
def customer_metrics(spark, sf):
    out = A.customer_metrics(raw(spark, sf))
    return out.withColumns({c: F.col(c).cast("double") for c in ("total_spent", "avg_order_value")})


@query("value_distribution", "select status, count(*) as n, count(*) * 100.0e0 / sum(count(*)) over () as pct from {orders_dirty} where status is not null group by 1")
def value_distribution(spark, sf):
    return A.value_distribution(dirty(spark, sf), "status")


@query("revenue_by_source", f"select source, {_REVENUE} as revenue from {{orders_raw}} group by 1")
def revenue_by_source(spark, sf):
    return A.revenue_by(raw(spark, sf), "source")


@query("daily_orders", "select cast(o_orderdate as date) as day, count(*) as orders from orders group by 1")
def daily_orders(spark, sf):
    return A.daily_orders(table(spark, sf, "orders"), "o_orderdate")


@query("daily_analytics", f"""select cast(order_date as date) as day, count(*) as order_count, {_REVENUE} as total_revenue, {_AVG} as avg_order_value,
   count(distinct customer_id) as unique_customers, max(order_date) as updated_at from {{orders_raw}} where cast(order_date as date) > date '1998-06-30' group by 1""")
def daily_analytics(spark, sf):
    return A.daily_analytics(raw(spark, sf), "1998-06-30")


@query("dataset_overview", f"""select count(*) as records, count(distinct customer_name) as unique_customers, count(distinct product) as unique_products, min(order_date) as first_date,
   max(order_date) as last_date, sum({S.cents('price')}) / 100.0 as sum_price, {S.mean_money('price')} as avg_price, max(price) as max_price, min(price) as min_price,
   count(*) / count(distinct customer_name) as orders_per_customer from {{orders_raw}}""")
def dataset_overview(spark, sf):
    return A.dataset_overview(raw(spark, sf))


@query("price_histogram", """with m as (select min(price) as lo, max(price) as hi from {orders_raw}),
   b as (select least(cast(floor((price - lo) * 10 / (hi - lo)) as int), 9) as bin, count(*) as n from {orders_raw}, m group by 1)
   select cast(i as int) as bin, lo + i * ((hi - lo) / 10) as bin_start, coalesce(n, 0) as n from range(10) r(i) cross join m left join b on b.bin = i""")
def price_histogram(spark, sf):
    return A.equal_width_histogram(raw(spark, sf), "price", 10)


_BUCKETS = [1, 5, 10, 30, 60, 300, 600, 1800, 3600]


@query("bucket_histogram", f"select event_type, {', '.join(f'count(*) filter (where value <= {b}) as le_{b}' for b in _BUCKETS)}, count(value) as le_inf from events group by 1")
def bucket_histogram(spark, sf):
    return A.bucket_histogram(table(spark, sf, "events"), "value", _BUCKETS, ["event_type"])


def _sets(columns: list[str], measures: str, source: str) -> str:
    parts = [f"select '{c}' as dimension, coalesce(cast({c} as varchar), '(none)') as member, {measures} from {source} group by 2" for c in columns]
    return " union all ".join([*parts, f"select 'all', 'all', {measures} from {source}"])


@query("business_kpis", _sets(["source", "product_category"], f"count(*) as orders, {_REVENUE} as revenue, {_AVG} as avg_order_value, count(distinct customer_id) as customers", "{orders_raw}"))
def business_kpis(spark, sf):
    return A.business_kpis(raw(spark, sf))


@query("table_stats", """select 'orders' as table_name, count(*) as n_rows, count(*) filter (where o_orderdate >= timestamp '2001-08-01' - interval 24 hours) as recent_rows from orders
   union all select 'customer', count(*), 0 from customer union all select 'events', count(*), count(*) filter (where ts >= timestamp '2024-01-30' - interval 24 hours) from events""")
def table_stats(spark, sf):
    tables = {n: table(spark, sf, n) for n in ("orders", "customer", "events")}
    recent = {"orders": A.last_day("o_orderdate", "2001-08-01 00:00:00"), "events": A.last_day("ts", "2024-01-30 00:00:00")}
    return A.table_stats(tables, recent)


def request_log(spark: SparkSession, sf: str) -> DataFrame:
    """One request per event: the endpoint, whether it succeeded, and how long it took."""
    return table(spark, sf, "events").select(
        F.concat(F.lit("/"), "event_type").alias("endpoint"), (F.col("event_id") % 11 != 0).alias("success"), (F.col("value") / 100).alias("response_time")
    )


_REQUESTS = "(select '/' || event_type as endpoint, event_id % 11 <> 0 as success, value / 100 as response_time from events)"


@query("request_statistics", f"select endpoint, count(*) as calls, count(*) filter (where success) as successes, count(*) filter (where success) * 100.0e0 / count(*) as success_rate, sum(cast(response_time as decimal(38,10)))::double / count(*) as avg_response_time from {_REQUESTS} group by 1")
def request_statistics(spark, sf):
    return A.request_statistics(request_log(spark, sf), ["endpoint"])


_RUNS = "(select value < 200 as passed, least(value, 100.0) as score, value / 10 as execution_time from events)"


@query("validation_history_summary", f"select count(*) as runs, count(*) filter (where passed) as passed_runs, count(*) filter (where passed) * 100.0e0 / count(*) as success_rate, sum(cast(score as decimal(38,10)))::double / count(*) as avg_score, sum(cast(execution_time as decimal(38,10)))::double / count(*) as avg_time from {_RUNS}")
def validation_history_summary(spark, sf):
    runs = table(spark, sf, "events").select((F.col("value") < 200).alias("passed"), F.least("value", F.lit(100.0)).alias("score"), (F.col("value") / 10).alias("execution_time"))
    return A.validation_history(runs)
