"""Feeds of other shapes mapped to orders and customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as X
from ..functions.categorical import product_from_title
from ..operators.dedup import dedup_by_key, union_sources
from ..operators.ranking import sequential_id
from ..session import clock


def partner_orders_map(df: DataFrame, last_value: str) -> DataFrame:
    newer = df.filter(F.col("created_at") > F.lit(last_value).cast("timestamp_ntz"))
    return newer.selectExpr(
        "order_reference as order_id", "customer_email", "customer_name", "product_sku as product", "'Electronics' as product_category",
        "quantity", "unit_price as price", "0.0d as discount", "quantity * unit_price as total_amount", "to_date(created_at) as order_date",
        "'Partner Store' as store_location", "'partner' as source", "created_at", "created_at as updated_at",
    )


def customers_extract_map(df: DataFrame, last_value: str) -> DataFrame:
    newer = df.filter(F.col("updated_at") > F.lit(last_value).cast("timestamp_ntz"))
    merged = {
        "customer_name": F.concat("first_name", F.lit(" "), "last_name"),
        "address": F.concat("address_line1", F.lit(", "), "city", F.lit(", "), "state"),
    }
    return newer.withColumns(merged).drop("first_name", "last_name", "address_line1")


def api_orders_map(posts: DataFrame, as_of: str) -> DataFrame:
    """Landed posts (id, userId, title) to orders."""
    user = F.col("userId").cast("string")
    price = N.round_money(F.lit(50.0) + F.pmod(F.col("id"), F.lit(20)) * 25.99)
    number = F.col("id").cast("string")
    padded = F.when(F.length(number) < 4, F.lpad(number, 4, "0")).otherwise(number)
    return posts.select(
        F.concat(F.lit("API-"), padded).alias("order_id"),
        F.concat(F.lit("Customer "), user).alias("customer_name"),
        F.concat(F.lit("customer"), user, F.lit("@example.com")).alias("customer_email"),
        product_from_title(F.col("title")).alias("product"),
        F.lit("Electronics").alias("product_category"),
        F.lit(1).alias("quantity"), price.alias("price"), F.lit(0.0).alias("discount"), price.alias("total_amount"),
        clock(as_of).cast("date").alias("order_date"), F.lit("api").alias("source"), F.col("id").alias("api_post_id"),
        F.lit("api_rest").alias("source_type"),
    )


def api_customers_map(users: DataFrame) -> DataFrame:
    """Landed users with nested address and company to customers."""
    number = F.col("id").cast("string")
    padded = F.when(F.length(number) < 3, F.lpad(number, 3, "0")).otherwise(number)
    parts = [F.nullif(F.col(f"address.{p}"), F.lit("")) for p in ("street", "suite", "city", "zipcode")]
    return users.select(
        F.concat(F.lit("CUST-"), padded).alias("customer_id"),
        F.coalesce("name", F.lit("Unknown Customer")).alias("name"),
        F.coalesce("email", F.lit("unknown@example.com")).alias("email"),
        F.coalesce("phone", F.lit("")).alias("phone"),
        F.concat_ws(", ", *parts).alias("address"),
        F.coalesce("company.name", F.lit("")).alias("company"),
        F.coalesce("website", F.lit("")).alias("website"),
        F.lit("api_rest").alias("source_type"),
    )


def _transform(c: Column, kind: str, params: dict) -> Column:
    if kind == "prefix":
        return F.concat(F.lit(params["prefix"]), c)
    if kind == "truncate":
        return F.substring(c, 1, params["max_length"])
    if kind == "clean_text":
        return X.clean_text(c)
    if kind == "to_decimal":
        return N.money(N.to_number(c)).cast("double")
    return c


def field_mapping(df: DataFrame, spec: dict, payload: str = "payload") -> DataFrame:
    """Columns from JSON text by path (`customer.name`, `items[0].price`), with transforms, constants and formulas.

    spec: {"fields": [{"from", "to", "transform"?, "params"?}], "static": {name: value}, "calculated": {name: SQL}}
    """
    rows = df
    for f in spec.get("fields", []):
        found = F.get_json_object(payload, f"$.{f['from']}")
        rows = rows.withColumn(f["to"], _transform(found, f.get("transform", "none"), f.get("params", {})))
    rows = rows.withColumns({n: F.lit(v) for n, v in spec.get("static", {}).items()})
    return calculated_fields(rows, spec.get("calculated", {})).drop(payload)


def calculated_fields(df: DataFrame, formulas: dict[str, str]) -> DataFrame:
    """Columns from formula text, in order; a later formula may use an earlier column."""
    out = df
    for name, formula in formulas.items():
        out = out.withColumn(name, F.expr(formula))
    return out


def align_and_union_sources(sources: dict[str, DataFrame], order_by: list, as_of: str) -> DataFrame:
    """Union by name with nulls for absent columns, tagged by source, stamped and numbered 1..n."""
    tagged = [df.withColumn("source_type", F.lit(name)) for name, df in sources.items()]
    return sequential_id(union_sources(tagged).withColumn("combined_at", clock(as_of)), order_by)


def combine_sources_dedup(dfs: list[DataFrame], keys: list[str], order_by: list) -> DataFrame:
    """First row per key over all sources; `_source` (position in the list) decides before `order_by`."""
    ranked = [df.withColumn("_source", F.lit(i)) for i, df in enumerate(dfs)]
    return dedup_by_key(union_sources(ranked), keys, ["_source", *order_by]).drop("_source")
