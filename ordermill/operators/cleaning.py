"""Order cleaning: one narrow stage after the de-duplication shuffles."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import categorical as C
from ..functions import dates as D
from ..functions import numeric as N
from ..functions import text as X
from ..session import clock
from .dedup import dedup_exact, dedup_orders
from .reads import retain_complete

FILL_DEFAULTS = {"quantity": 1, "discount": 0.0, "source": "unknown", "product_category": "Electronics"}


def present(df: DataFrame, columns: dict[str, Column]) -> dict[str, Column]:
    return {name: col for name, col in columns.items() if name in df.columns}


def parsed(df: DataFrame, numbers: list[str] = (), dates: list[str] = ()) -> DataFrame:
    """Add helper columns with the parsed values, so that many rules on a column parse it once.

    `number` and `any_date` pick them up; `unparsed` drops them.
    """
    helpers = {f"_num_{c}": number(df, c) for c in numbers if c in df.columns}
    helpers.update({f"_date_{c}": any_date(df, c) for c in dates if c in df.columns})
    return df.withColumns(helpers)


def unparsed(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(("_num_", "_date_"))])


def any_date(df: DataFrame, name: str) -> Column:
    """The column as timestamp, from any of the known formats."""
    if f"_date_{name}" in df.columns:
        return F.col(f"_date_{name}")
    if not isinstance(df.schema[name].dataType, T.StringType):
        return F.col(name).cast("timestamp_ntz")
    return F.coalesce(D.parse_date(F.col(name)), D.parse_date_multi(F.col(name)))


def number(df: DataFrame, name: str) -> Column:
    """The column as double: text is parsed, floats lose NaN."""
    if f"_num_{name}" in df.columns:
        return F.col(f"_num_{name}")
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return N.to_number(F.col(name))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return N.finite(F.col(name)).cast("double")
    return F.col(name).cast("double")


def timestamp(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        return D.parse_date(F.col(name))
    return F.col(name).cast("timestamp_ntz")


def fill_defaults(df: DataFrame, defaults: dict = FILL_DEFAULTS) -> DataFrame:
    return df.fillna({k: v for k, v in defaults.items() if k in df.columns})


def staged(df: DataFrame, steps: dict[str, list[Callable[[Column], Column]]]) -> DataFrame:
    """Apply the n-th step of every column in the n-th projection.

    A step uses its input more than once; as a column of the projection below, it is computed once.
    """
    out = df
    for depth in range(max(map(len, steps.values()))):
        todo = {c: fns[depth](F.col(c)) for c, fns in steps.items() if c in df.columns and depth < len(fns)}
        out = out.withColumns(todo)
    return out


def clean_text_fields(df: DataFrame) -> DataFrame:
    return staged(
        df,
        {
            "customer_name": [X.clean_text, X.title_case, X.plain_name],
            "product": [X.clean_text, X.canonical_product],
            "store_location": [X.clean_text, X.known_location, X.title_case],
            "notes": [X.clean_text],
            "source": [X.clean_text, C.source_clean],
        },
    )


def fix_types(df: DataFrame) -> DataFrame:
    numbers = {c: number(df, c) for c in ("quantity", "price", "discount", "total_amount") if c in df.columns}
    stamps = {c: timestamp(df, c) for c in ("order_date", "delivery_date", "created_at", "updated_at") if c in df.columns}
    emails = {c: X.clean_email(F.col(c)) for c in ("customer_email", "contact_email") if c in df.columns}
    return df.withColumns({**numbers, **stamps, **emails})


def clean_numbers(df: DataFrame) -> DataFrame:
    """Positive quantity and price, no negative discount, a known non-negative total."""
    tests = {"quantity": F.col("quantity") > 0, "price": F.col("price") > 0, "total_amount": F.col("total_amount") >= 0}
    kept = df.filter(reduce(lambda a, b: a & b, present(df, tests).values(), F.lit(True)))
    discount = F.when(F.col("discount") < 0, 0.0).otherwise(F.col("discount"))
    return kept.withColumns(
        present(
            kept,
            {
                "quantity": N.to_quantity(F.col("quantity")),
                "price": N.round_money(F.col("price")),
                "discount": N.round_money(discount),
                "total_amount": N.round_money(F.col("total_amount")),
            },
        )
    )


def date_window_filter(df: DataFrame, as_of: str, days: int = 3650, column: str = "order_date") -> DataFrame:
    return df.filter(D.in_date_window(F.col(column), as_of, days)) if column in df.columns else df


def clean_categories(df: DataFrame) -> DataFrame:
    return df.withColumns(
        present(
            df,
            {
                "source": C.known_source(F.col("source")),
                "product_category": C.category_clean(F.col("product_category")),
            },
        )
    )


def drop_implausible(df: DataFrame, max_value: float = 100_000, whole_words: bool = False) -> DataFrame:
    """Orders above `max_value`, one-letter names and test names go."""
    out = df
    if {"quantity", "price"} <= set(df.columns):
        out = out.filter(~(F.col("quantity") * F.col("price") > max_value))
    if "customer_name" in df.columns:
        name = F.col("customer_name")
        out = out.filter((F.length(name) >= 2) & ~X.is_test_name(name, whole_words=whole_words))
    return out


def record_quality_score(df: DataFrame) -> Column:
    optional = [c for c in ("customer_email", "store_location", "product_category", "notes") if c in df.columns]
    losses = [F.when(F.col(c).isNull(), 5).otherwise(0) for c in optional]
    if "customer_name" in df.columns:
        losses.append(F.when(F.length("customer_name") < 5, 10).otherwise(0))
    if {"quantity", "price"} <= set(df.columns):
        losses.append(F.when(F.col("quantity") > 10, 5).otherwise(0))
        losses.append(F.when(F.col("price") > 5000, 5).otherwise(0))
    return F.greatest(F.lit(100.0) - reduce(lambda a, b: a + b, losses, F.lit(0)), F.lit(0.0))


def record_quality_compact(df: DataFrame) -> Column:
    blank = [F.coalesce(F.trim(F.col(c)) == "", F.lit(True)) for c in ("customer_email", "store_location") if c in df.columns]
    losses = [F.when(b, 10).otherwise(0) for b in blank]
    losses.append(F.when(F.length("customer_name") < 3, 15).otherwise(0))
    if "total_amount" in df.columns:
        losses.append(F.when(F.col("total_amount") > 5000, 5).otherwise(0))
    return F.greatest(F.lit(100) - reduce(lambda a, b: a + b, losses), F.lit(0))


COMPLETENESS_FIELDS = ["order_id", "customer_name", "product_name", "quantity", "price"]


def record_completeness(df: DataFrame, fields: list[str] = COMPLETENESS_FIELDS) -> Column:
    """Share of the required fields that are neither null nor blank."""
    filled = [F.when(F.trim(F.col(c).cast("string")) != "", 1).otherwise(0) for c in fields if c in df.columns]
    return reduce(lambda a, b: a + b, filled, F.lit(0)) * F.lit(100.0) / len(fields)


def stamp_metadata(df: DataFrame, stage: str, as_of: str) -> DataFrame:
    """`<stage>_at` from the given clock; standardized and enriched rows also carry a version."""
    stamped = df.withColumn(f"{stage}_at", clock(as_of))
    versions = {"standardized": "standardization_version", "enriched": "enrichment_version"}
    return stamped.withColumn(versions[stage], F.lit("1.0")) if stage in versions else stamped


def clean_rows(df: DataFrame, as_of: str) -> DataFrame:
    """Everything after de-duplication; stateless, so streams use it as it is."""
    typed = fix_types(clean_text_fields(df))
    complete = fill_defaults(retain_complete(typed))
    dated = date_window_filter(clean_numbers(complete), as_of)
    kept = drop_implausible(clean_categories(dated))
    return stamp_metadata(kept.withColumn("data_quality_score", record_quality_score(kept)), "cleaned", as_of)


def clean_orders(df: DataFrame, as_of: str, order_by: list, slices: int | None = None) -> DataFrame:
    """With `slices`, the cleaned rows are a stage (`dedup_in_slices`), and no shuffle holds more than one slice."""
    return dedup_orders(df, order_by, slices=slices, then=lambda rows: clean_rows(rows, as_of))


def clean_numbers_text(df: DataFrame) -> DataFrame:
    """Text amounts with currency marks to numbers, whole quantities."""
    return df.withColumns(
        present(df, {"price": N.strip_currency(F.col("price")), "quantity": N.to_quantity(N.to_number(F.col("quantity")))})
    )


def clean_orders_nb(df: DataFrame) -> DataFrame:
    """The tutorial variant: titles, brands, currency text, mixed date formats, phones, fills."""
    rows = dedup_exact(df)
    text = staged(
        rows,
        {
            "customer_name": [X.squeeze, X.title_case, X.fix_titles],
            "product_name": [X.squeeze, X.title_case, X.brand_spelling],
            "status": [X.squeeze, F.lower],
            "customer_email": [F.lower, F.trim],
            "order_date": [D.parse_date_multi],
            "phone_number": [X.normalize_phone_digits],
        },
    )
    return fill_defaults(clean_numbers_text(text), {"status": "pending", "quantity": 1})


def change_counts(before: DataFrame, after: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """How many values of each field a transform changed, compared as text."""
    old = before.select(*key, *[F.col(f).cast("string").alias(f"_old_{f}") for f in fields])
    both = after.select(*key, *[F.col(f).cast("string").alias(f) for f in fields]).join(old, key)
    counts = both.agg(*[F.count_if(~F.col(f).eqNullSafe(F.col(f"_old_{f}"))).alias(f) for f in fields])
    return counts.unpivot([], fields, "field", "changed")


def transform_nb6(df: DataFrame) -> DataFrame:
    """The compact transform: names, short alias list, totals, size, segment, score."""
    base = df.withColumns(
        {
            "customer_name": X.title_case(F.trim("customer_name")),
            "product": X.canonical_product(F.lower("product"), X.V.PRODUCT_ALIASES_SHORT),
            "quantity": F.coalesce(number(df, "quantity"), F.lit(1.0)).cast("int"),
            "price": N.round_money(number(df, "price")),
        }
    )
    total = N.round_money(F.col("quantity") * F.col("price"))
    priced = base.withColumn("total_amount", total).withColumns(
        {"order_size": C.order_size_compact(F.col("total_amount")), "customer_segment": C.segment_by_order_wide(F.col("total_amount"))}
    )
    scored = priced.withColumn("quality_score", record_quality_compact(priced))
    return scored.dropna(subset=["order_id", "customer_name", "product"])
