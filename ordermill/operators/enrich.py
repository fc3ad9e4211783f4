"""Order enrichment.

Dataset-wide figures (revenue total, the two 95 % thresholds) are one-row aggregates read through
scalar subqueries, never unpartitioned windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import categorical as C
from ..functions import dates as D
from ..functions import fixed_values as V
from ..functions import numeric as N
from ..functions import text as X
from ..session import materialize, shuffles_dropped, stages
from .cleaning import number, record_completeness, stamp_metadata, timestamp
from .joins import segment_back_join
from .ranking import quantiles


def financials(df: DataFrame) -> DataFrame:
    """Total (if absent), unit price after discount, discount share, profit at 30 %."""
    out = df
    have = set(df.columns)
    if "total_amount" not in have and {"quantity", "price"} <= have:
        gross = F.col("quantity") * F.col("price")
        discount = F.coalesce(F.col("discount"), F.lit(0.0)) if "discount" in have else F.lit(0.0)
        out = out.withColumn("total_amount", N.round_money(gross - discount))
    columns = {}
    if {"total_amount", "quantity"} <= set(out.columns):
        columns["unit_price_after_discount"] = N.safe_divide(F.col("total_amount"), F.col("quantity").cast("double"))
    if {"discount", "quantity", "price"} <= set(out.columns):
        gross = F.col("quantity") * F.col("price")
        columns["discount_percentage"] = N.safe_divide(F.coalesce(F.col("discount"), F.lit(0.0)), gross) * 100
    if "total_amount" in out.columns:
        columns["estimated_profit"] = F.col("total_amount") * 0.30
    return out.withColumns(columns)


def product_intelligence(df: DataFrame) -> DataFrame:
    if "product" not in df.columns:
        return df
    out = df.withColumns(C.product_traits(F.col("product")))
    return out if "product_category" in df.columns else out.withColumn("product_category", C.category_from_product(F.col("product")))


def temporal_features(df: DataFrame, as_of: str) -> DataFrame:
    if "order_date" not in df.columns:
        return df
    dated = df.withColumn("order_date", timestamp(df, "order_date"))
    d = F.col("order_date")
    return dated.withColumns(
        {**D.date_parts(d), **D.calendar_flags(d), "days_since_order": D.days_since(d, as_of), "order_timing": D.order_timing(d)}
    )


def revenue_total(df: DataFrame, amount: str = "total_amount") -> Column:
    return df.agg(F.sum(N.money(F.col(amount))).cast("double")).scalar()


def revenue_contribution(df: DataFrame, whole: DataFrame | None = None, amount: str = "total_amount") -> DataFrame:
    share = F.try_divide(F.col(amount), revenue_total(df if whole is None else whole, amount)) * 100
    return df.withColumn("revenue_contribution_pct", F.round(share, 2))


def quantile_threshold(df: DataFrame, column: str, q: float = 0.95) -> DataFrame:
    """One row: the exact, interpolated quantile."""
    numbers = df.select(number(df, column).alias(column))
    return quantiles(numbers, [], column, {f"{column}_q": ("linear", q)})


def business_metrics(df: DataFrame, whole: DataFrame | None = None) -> DataFrame:
    out = df.withColumns(
        {
            "order_size_category": C.order_size_category(F.col("total_amount")),
            "quantity_category": C.quantity_category(F.col("quantity")),
            "channel_type": C.channel_type(F.col("source")),
        }
    )
    return revenue_contribution(out, whole)


def risk_assessment(df: DataFrame, amount_p95: Column, quantity_p95: Column) -> DataFrame:
    score = C.risk_score(
        F.col("total_amount") > amount_p95,
        F.col("quantity") > quantity_p95,
        F.col("customer_segment") == "Budget",
        F.col("is_weekend"),
        F.col("discount_percentage") > 20,
    )
    return df.withColumn("risk_score", score).withColumn("risk_level", C.risk_level(F.col("risk_score")))


def enrich_orders(df: DataFrame, as_of: str, customer_key: str = "customer_name", written: bool = False) -> DataFrame:
    """All enrichment steps; the input is written once because four aggregates read it again, unless it is `written` already.

    Customers are joined to the rows as given, and what a row tells of itself is added after: that join shuffles no column
    that can be computed. What was shuffled or written for the input and the thresholds goes as soon as they are there.
    """
    spark, thresholds = df.sparkSession, []
    with shuffles_dropped(spark):
        base = df if written else materialize(df, "enrich")
        priced = financials(base)
        for column in ("total_amount", "quantity"):
            with stages(spark):
                thresholds.append(F.lit(quantile_threshold(priced, column).first()[0]).cast("double"))
    joined = segment_back_join(base, customer_key, priced)
    told = temporal_features(product_intelligence(financials(joined)), as_of)
    customer = [c for c in joined.columns if c not in base.columns]
    sized = business_metrics(told.select(*[c for c in told.columns if c not in customer], *customer), priced)
    risky = risk_assessment(sized, *thresholds)
    seasonal = risky.withColumns(D.season_features(F.col("order_month"), F.col("total_amount")))
    return stamp_metadata(seasonal, "enriched", as_of)


def enrich_orders_nb(df: DataFrame, as_of: str) -> DataFrame:
    """The tutorial variant: exact product facts, per-order segment, priority, risk class, completeness."""
    d = F.col("order_date")
    facts = df.withColumns(C.product_facts(F.col("product_name")))
    parts = {k: v for k, v in D.date_parts(d).items() if k != "order_week_of_year"}
    staged = facts.withColumns(
        {
            "product_age_years": F.year(F.lit(as_of).cast("date")) - F.col("product_release_year"),
            "customer_segment": C.segment_by_order(F.col("total_amount")),
            "customer_name_length": X.name_length(F.col("customer_name")),
            "customer_has_title": X.has_title(F.col("customer_name")),
            "seasonal_factor": F.coalesce(D.seasonal_factor(F.month(d), V.SEASONAL_FACTORS_SIMPLE), F.lit(1.0)),
            "days_since_order": D.days_since(d, as_of),
            "estimated_profit": F.col("total_amount") * 0.30,
            "data_completeness_score": record_completeness(df),
            **parts,
        }
    )
    return staged.withColumns(
        {
            "order_priority": C.order_priority(F.col("total_amount"), F.col("customer_segment"), F.col("product_avg_rating")),
            "risk_score": C.risk_category(F.col("total_amount"), F.col("product_age_years"), F.col("customer_type")),
            "data_quality_grade": C.quality_grade(F.col("data_completeness_score")),
        }
    )
