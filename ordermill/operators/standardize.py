"""Order standardization: one narrow select."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import categorical as C
from ..functions import dates as D
from ..functions import fixed_values as V
from ..functions import numeric as N
from ..functions import text as X
from .cleaning import number, stamp_metadata, staged, timestamp


def _amount(df: DataFrame, name: str):
    if isinstance(df.schema[name].dataType, T.StringType):
        return N.strip_currency(F.col(name))
    return number(df, name)


def standardize_orders(df: DataFrame, as_of: str) -> DataFrame:
    text = staged(
        df,
        {
            "customer_name": [X.clean_text, X.title_case],
            "product": [X.clean_text, X.title_case, X.brand_spelling],
            "store_location": [X.clean_text, X.squeeze, X.title_case, X.expand_address],
            "notes": [X.clean_text, X.title_case],
            "customer_email": [X.normalize_email],
            "phone": [X.normalize_phone],
            "customer_phone": [X.normalize_phone],
            "contact_phone": [X.normalize_phone],
            "address": [X.squeeze, X.title_case, X.expand_address],
            "shipping_address": [X.squeeze, X.title_case, X.expand_address],
            "billing_address": [X.squeeze, X.title_case, X.expand_address],
            "source": [C.source_standard],
            "product_category": [C.category_alias, X.title_case],
            "customer_segment": [C.canonical_segment],
            "order_id": [X.normalize_order_id],
        },
    )
    dates = {c: D.iso_date(timestamp(df, c)) for c in ("order_date", "delivery_date", "created_at", "updated_at") if c in df.columns}
    money = {c: N.round_money(_amount(df, c)) for c in ("price", "discount", "total_amount") if c in df.columns}
    whole = {c: N.to_quantity(_amount(df, c)) for c in ("quantity",) if c in df.columns}
    return stamp_metadata(text.withColumns({**dates, **money, **whole}), "standardized", as_of)


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[X.snake_case(c) for c in df.columns])


def standardize_orders_nb(df: DataFrame) -> DataFrame:
    """Ids, first-match category, email domain and customer type, total, value class, hash."""
    ids = df.withColumn("order_id", X.normalize_order_id_ext(F.col("order_id")))
    domain = X.email_domain(F.col("customer_email"))
    total = N.round_money(F.col("price") * F.col("quantity"))
    added = ids.withColumns(
        {
            "product_category": C.category_by_first_key(F.col("product_name")),
            "customer_domain": F.coalesce(domain, F.lit("Unknown")),
            "total_amount": total,
            "record_hash": X.record_hash(F.col("order_id"), F.col("customer_email"), F.col("product_name")),
        }
    )
    labelled = added.withColumns(
        {
            "customer_type": X.customer_type(F.col("customer_domain")),
            "order_value_category": C.order_value_category(F.col("total_amount")),
        }
    )
    return snake_case_columns(labelled)


def validate_standardization(df: DataFrame) -> DataFrame:
    """One row per check: valid, total, percentage, whether the share passes, and the overall score."""
    total = F.count(F.lit(1))
    checks = []
    if "order_id" in df.columns:
        checks.append(("order_id_format", F.count_if(F.col("order_id").rlike(V.ORDER_ID_PATTERN)), total, 0.90))
    if "customer_email" in df.columns:
        given = F.count("customer_email")
        checks.append(("email_format", F.count_if(X.is_valid_email(F.col("customer_email"))), given, 0.95))
    for name in ("price", "quantity", "total_amount"):
        if name in df.columns:
            checks.append((f"{name}_numeric", F.count(number(df, name)), total, 0.95))
    counted = df.agg(*[F.struct(valid.alias("valid"), all_.alias("total")).alias(name) for name, valid, all_, _ in checks])
    rows = F.array(
        *[F.struct(F.lit(n).alias("check"), F.col(n)["valid"].alias("valid"), F.col(n)["total"].alias("total"), F.lit(t).alias("threshold")) for n, _, _, t in checks]
    )
    long = counted.select(F.explode(rows).alias("c")).select("c.*")
    scored = long.withColumn("percentage", N.pct(F.col("valid"), F.col("total"))).withColumn(
        "passed", F.coalesce(F.try_divide(F.col("valid"), F.col("total")) > F.col("threshold"), F.lit(False))
    )
    overall = scored.agg(F.count_if("passed") * 100.0 / F.count(F.lit(1)))
    return scored.withColumn("overall_score", overall.scalar())
