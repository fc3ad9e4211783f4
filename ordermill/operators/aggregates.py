"""Business and operational aggregates (partial aggregation on the map side throughout)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_mean, exact_sum, money, pct
from ..session import clock
from .joins import customer_totals
from .ranking import null_safe_join, quantiles
from .reads import since

def rows() -> Column:
    return F.count(F.lit(1))


def revenue(column: str = "total_amount") -> Column:
    """Exact: money is summed as decimal."""
    return F.sum(money(F.col(column))).cast("double")


def average_money(column: str = "total_amount") -> Column:
    return F.try_divide(F.sum(money(F.col(column))), F.count(F.col(column))).cast("decimal(18,2)").cast("double")


customer_metrics = customer_totals


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(rows().alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.withColumn("pct", F.col("n") * 100.0 / total)


def revenue_by(df: DataFrame, by: str) -> DataFrame:
    return df.filter(F.col(by).isNotNull()).groupBy(by).agg(revenue().alias("revenue"))


def daily_orders(df: DataFrame, column: str = "order_date") -> DataFrame:
    return df.groupBy(F.to_date(column).alias("day")).agg(rows().alias("orders"))


def daily_analytics(df: DataFrame, last_value: str | None = None, customer: str = "customer_id") -> DataFrame:
    day = F.to_date("order_date")
    chosen = df if last_value is None else df.filter(F.col("order_date") >= F.date_add(F.lit(last_value).cast("date"), 1))
    return chosen.groupBy(day.alias("day")).agg(
        rows().alias("order_count"),
        revenue().alias("total_revenue"),
        average_money().alias("avg_order_value"),
        F.countDistinct(customer).alias("unique_customers"),
        F.max("updated_at" if "updated_at" in df.columns else "order_date").alias("updated_at"),
    )


def dataset_overview(df: DataFrame) -> DataFrame:
    return df.agg(
        rows().alias("records"),
        F.countDistinct("customer_name").alias("unique_customers"),
        F.countDistinct("product").alias("unique_products"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
        revenue("price").alias("sum_price"),
        average_money("price").alias("avg_price"),
        F.max("price").alias("max_price"),
        F.min("price").alias("min_price"),
    ).withColumn("orders_per_customer", F.try_divide("records", "unique_customers"))


def equal_width_histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Counts per bin over [min, max], the last bin closed; empty bins are listed too."""
    value = F.col(column)
    span = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    low, high = span["lo"], span["hi"]
    # computed the same way in any engine: position of the value on the scale of bins
    # a column with one value has no width and falls into the first bin
    place = F.coalesce(F.floor(F.try_divide((value - low) * bins, high - low)), F.lit(0))
    slot = F.least(place, F.lit(bins - 1)).cast("int")
    counted = df.filter(value.isNotNull()).groupBy(slot.alias("bin")).agg(rows().alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    filled = every.join(counted, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    width = (high - low) / bins
    return filled.select("bin", (low + F.col("bin") * width).alias("bin_start"), "n")


def bucket_histogram(df: DataFrame, column: str, buckets: list[float], by: list[str] | None = None) -> DataFrame:
    """Cumulative counts: how many values are at most each bucket bound (and in all)."""
    names = [f"le_{str(b).replace('.', '_')}" for b in buckets]
    counts = [F.count_if(F.col(column) <= b).alias(n) for b, n in zip(buckets, names)]
    return df.groupBy(*(by or [])).agg(*counts, F.count(column).alias("le_inf"))


SUMMARY_QUANTILES = {"median": ("linear", 0.5), "p95": ("rank", 0.95), "p99": ("rank", 0.99)}


def summary_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """count, sum, min, max, mean, deviation (0 for one value), median, p95 and p99 per group."""
    given = df.filter(F.col(value).isNotNull())
    basic = given.groupBy(*keys).agg(
        rows().alias("n"),
        exact_sum(F.col(value)).alias("total"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        exact_mean(F.col(value)).alias("mean"),
        F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("std_dev"),
    )
    return null_safe_join(basic, quantiles(given.select(*keys, value), keys, value, SUMMARY_QUANTILES), keys)


def metric_summary(metrics: DataFrame, as_of: str, hours: float = 24) -> DataFrame:
    return summary_stats(metrics.filter(since("ts", hours, as_of)), ["name"], "value")


def pipeline_report(metrics: DataFrame, as_of: str, hours: float = 24, pipeline_id: str | None = None) -> DataFrame:
    """Executions, success, quality and errors per pipeline in one pass."""
    tagged = metrics.filter(since("ts", hours, as_of)).withColumn("pipeline", F.get_json_object("tags", "$.pipeline_id"))
    if pipeline_id is not None:
        tagged = tagged.filter(F.col("pipeline") == pipeline_id)

    def when(name: str) -> Column:
        return F.when(F.col("long_name") == name, F.col("value"))

    run, quality = when("pipeline.execution_time"), when("pipeline.data_quality.score")
    good, bad = F.count(when("pipeline.successes")), F.count(when("pipeline.failures"))
    return tagged.groupBy("pipeline").agg(
        F.count(run).alias("executions"), exact_mean(run).alias("avg_duration"), F.min(run).alias("min_duration"), F.max(run).alias("max_duration"),
        good.alias("successes"), bad.alias("failures"), pct(good, good + bad).alias("success_rate"),
        exact_mean(quality).alias("avg_quality"), F.min(quality).alias("min_quality"), F.max(quality).alias("max_quality"),
        F.coalesce(F.floor(exact_sum(when("pipeline.errors"))), F.lit(0)).cast("bigint").alias("total_errors"),
    )


def pipeline_stage_times(metrics: DataFrame, as_of: str, hours: float = 24) -> DataFrame:
    timed = metrics.filter(since("ts", hours, as_of) & F.col("long_name").like("pipeline.stage.%.execution_time"))
    stage = F.split_part("long_name", F.lit("."), F.lit(3))
    return timed.groupBy(stage.alias("stage")).agg(exact_mean(F.col("value")).alias("avg_time"), rows().alias("executions"))


def stage_means(df: DataFrame, value: str = "value") -> DataFrame:
    return df.filter(F.col("stage").isNotNull()).groupBy("stage").agg(exact_mean(F.col(value)).alias("mean_value"), rows().alias("n"))


def run_success_rate(df: DataFrame) -> DataFrame:
    """Pipelines, those with a failed execution, and the share without one."""
    per_id = pipeline_status(df)
    return per_id.agg(
        rows().alias("pipelines"), F.count_if(F.col("status") == "FAILED").alias("failed"),
        pct(F.count_if(F.col("status") == "SUCCESS"), rows()).alias("success_rate"),
    )


def pipeline_status(df: DataFrame) -> DataFrame:
    failed = F.bool_or(F.col("metric_name") == "execution_failed")
    return df.groupBy("pipeline_id").agg(F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"))


def execution_stats(execs: DataFrame, as_of: str, hours: float = 24) -> DataFrame:
    good, bad = F.count_if(F.col("status") == "COMPLETED"), F.count_if(F.col("status") == "FAILED")
    return execs.filter(since("ts", hours, as_of)).agg(
        rows().alias("executions"), good.alias("successful"), bad.alias("failed"), pct(good, rows()).alias("success_rate")
    )


def counts_by_each(df: DataFrame, columns: list[str], measures: list[Column]) -> DataFrame:
    """Grouping sets: one row per value of each column and one for the whole table, in one pass."""
    text = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("(none)")) for c in columns})
    sets = [[F.col(c)] for c in columns] + [[]]
    grouped = text.groupingSets(sets, *columns).agg(*measures)
    label = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in columns], F.lit("all"))
    return grouped.withColumns({"dimension": label, "member": F.coalesce(*columns, F.lit("all"))}).drop(*columns)


def alert_summary(alerts: DataFrame, as_of: str, hours: float = 24) -> DataFrame:
    recent = alerts.filter(since("ts", hours, as_of))
    return counts_by_each(recent, ["severity", "status", "rule"], [rows().alias("alerts"), F.count_if("escalated").alias("escalated")])


def business_kpis(df: DataFrame) -> DataFrame:
    return counts_by_each(
        df,
        ["source", "product_category"],
        [rows().alias("orders"), revenue().alias("revenue"), average_money().alias("avg_order_value"), F.countDistinct("customer_id").alias("customers")],
    )


def table_stats(tables: dict[str, DataFrame], recent: dict[str, Column] | None = None) -> DataFrame:
    """Row count per table, and rows meeting the table's condition (e.g. the last 24 hours)."""
    parts = []
    for name, df in tables.items():
        condition = (recent or {}).get(name, F.lit(False))
        parts.append(df.agg(F.lit(name).alias("table_name"), rows().alias("n_rows"), F.count_if(condition).alias("recent_rows")))
    return reduce(DataFrame.unionByName, parts)


def last_day(column: str, as_of: str) -> Column:
    return F.col(column) >= clock(as_of) - F.expr("interval 24 hours")


def enrichment_summary(df: DataFrame) -> DataFrame:
    """Distribution of each label column and the mean completeness, long form."""
    labels = [c for c in ("customer_segment", "product_brand", "order_priority", "risk_score", "data_quality_grade") if c in df.columns]
    grouped = counts_by_each(df, labels, [rows().alias("n"), F.avg("data_completeness_score").alias("avg_completeness")])
    return grouped.filter("dimension = 'all' or member <> '(none)'")


def _completeness(df: DataFrame, name: str) -> DataFrame:
    missing = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in df.columns])
    return df.agg(F.struct(rows().alias("records"), missing.alias("missing"), F.lit(len(df.columns)).alias("columns")).alias(name))


def transformation_impact(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows, columns, retention and missing cells before and after; new columns by kind."""
    b, a = _completeness(before, "b"), _completeness(after, "a").scalar()
    new = [c.lower() for c in after.columns if c not in before.columns]
    calculated = [c for c in new if "total" in c or "amount" in c]
    enriched = [c for c in new if c not in calculated and any(w in c for w in ("brand", "category", "segment", "priority", "risk"))]

    def complete(s: Column) -> Column:
        cells = s["records"] * s["columns"]
        return pct(cells - s["missing"], cells)

    both = b.select("b", a.alias("a"))
    b_, a_ = F.col("b"), F.col("a")
    return both.select(
        b_["records"].alias("records_before"), a_["records"].alias("records_after"),
        pct(a_["records"], b_["records"]).alias("retention_rate"),
        b_["columns"].alias("columns_before"), a_["columns"].alias("columns_after"),
        b_["missing"].alias("missing_before"), a_["missing"].alias("missing_after"),
        complete(b_).alias("completeness_before"), complete(a_).alias("completeness_after"),
        F.lit(len(calculated)).alias("calculated_fields"), F.lit(len(enriched)).alias("enrichment_fields"),
        F.lit(len(new) - len(calculated) - len(enriched)).alias("standardized_fields"),
    )


def request_statistics(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    good = F.count_if("success")
    return log.groupBy(*(by or [])).agg(
        rows().alias("calls"), good.alias("successes"), pct(good, rows()).alias("success_rate"), exact_mean(F.col("response_time")).alias("avg_response_time")
    )


def validation_history(runs: DataFrame) -> DataFrame:
    good = F.count_if("passed")
    return runs.agg(
        rows().alias("runs"), good.alias("passed_runs"), pct(good, rows()).alias("success_rate"),
        exact_mean(F.col("score")).alias("avg_score"), exact_mean(F.col("execution_time")).alias("avg_time"),
    )
