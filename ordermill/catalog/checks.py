"""Validation, schema and rule checks, quality dimensions and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.arrays import each_element
from ..operators import aggregates as A
from ..operators import quality as P
from ..operators import rules as R
from ..operators import standardize as Z
from ..operators import validation as W
from ..session import ORDERS_AS_OF
from . import sqltext as S
from .bindings import LINE_ORDER, table
from .metrics import rounded
from .orders import CLEANED, CLEANED_COLUMNS, STANDARD_ID, cleaned, dirty, raw
from .registry import query

CHECKED = [*LINE_ORDER, "order_id", "customer_name", "customer_email", "product", "quantity", "price", "discount", "total_amount", "order_date"]


def checked(spark: SparkSession, sf: str) -> DataFrame:
    return dirty(spark, sf).select(*CHECKED)


# (field, type, severity, message, condition) in the order they are tried per field
_Q, _P, _X, _T, _D = S.number("quantity"), S.number("price"), S.number("discount"), S.number("total_amount"), S.any_date("order_date")
_GAP = f"abs(cast({_T} as decimal(18,2)) - cast(cast({_P} * {_Q} - {_X} as decimal(18,4)) as decimal(18,2)))"
_OLD = f"{_D} < {S.AS_OF} - interval 1825 days"
ROW_RULES = [
    ("order_id", "required_field_error", "critical", "order_id is required", S.blank("order_id")),
    ("order_id", "format_error", "medium", "order id does not follow the pattern", r"not regexp_full_match(trim(order_id), '[A-Z]{3}-\d{4}-\d{3}')"),
    ("customer_name", "required_field_error", "critical", "customer_name is required", S.blank("customer_name")),
    ("customer_name", "validation_error", "medium", "customer name is too short", "length(trim(customer_name)) < 2"),
    ("customer_name", "validation_error", "low", "customer name is too long", "length(trim(customer_name)) > 100"),
    ("product", "required_field_error", "critical", "product is required", S.blank("product")),
    ("product", "validation_error", "medium", "product name is too short", "length(trim(product)) < 2"),
    ("quantity", "required_field_error", "critical", "quantity is required", "quantity is null"),
    ("quantity", "data_type_error", "high", "quantity is not a number", f"{_Q} is null"),
    ("quantity", "business_rule_error", "high", "quantity must be positive", f"{_Q} <= 0"),
    ("quantity", "business_rule_error", "low", "quantity is unusually high", f"{_Q} > 1000"),
    ("quantity", "validation_error", "medium", "quantity should be a whole number", f"{_Q} <> floor({_Q})"),
    ("price", "required_field_error", "critical", "price is required", "price is null"),
    ("price", "data_type_error", "high", "price is not a number", f"{_P} is null"),
    ("price", "business_rule_error", "high", "price must be positive", f"{_P} <= 0"),
    ("price", "business_rule_error", "low", "price is unusually high", f"{_P} > 50000"),
    ("price", "validation_error", "medium", "price is too low", f"{_P} < 0.01"),
    ("order_date", "required_field_error", "critical", "order_date is required", S.blank("order_date")),
    ("order_date", "data_type_error", "high", "order date is not a date", f"{_D} is null"),
    ("order_date", "business_rule_error", "high", "order date is in the future", f"{_D} > {S.AS_OF}"),
    ("order_date", "business_rule_error", "low", "order date is very old", _OLD),
    ("customer_email", "format_error", "medium", "email is not valid", f"not {S.blank('customer_email')} and not {S.email_ok('trim(customer_email)')}"),
    ("discount", "data_type_error", "medium", "discount is not a number", f"discount is not null and {_X} is null"),
    ("discount", "business_rule_error", "high", "discount cannot be negative", f"{_X} < 0"),
    ("discount", "business_rule_error", "high", "discount cannot exceed price", f"{_X} > {_P}"),
    ("total_amount", "data_type_error", "medium", "total is not a number", f"total_amount is not null and {_T} is null"),
    ("total_amount", "calculation_error", "medium", "total does not match price, quantity and discount", f"{_GAP} > 0.01"),
]


def errors_sql(rules=ROW_RULES, source: str = "{orders_dirty}") -> str:
    """One row per error: the first rule of each field that holds."""
    parts = []
    for field in dict.fromkeys(r[0] for r in rules):
        whens = " ".join(f"when {cond} then {{'type': '{t}', 'severity': '{s}', 'message': '{m}'}}" for f, t, s, m, cond in rules if f == field)
        parts.append(f"select {S.KEYS}, '{field}' as field, cast({field} as varchar) as value, case {whens} end as e from src")
    union = " union all ".join(parts)
    return f"(with src as materialized (select * from {source}) select {S.KEYS}, field, value, e.type as type, e.severity as severity, e.message as message from ({union}) where e is not null)"


ERRORS = errors_sql()


@query("validation_errors", f"select {S.KEYS}, field, type, severity, value, message from {ERRORS}")
def validation_errors(spark, sf):
    return W.validation_errors(checked(spark, sf), ORDERS_AS_OF, LINE_ORDER)


@query("validation_error_counts", f"select type, field, severity, count(*) as n from {ERRORS} group by all")
def validation_error_counts(spark, sf):
    return W.error_counts(W.validation_errors(checked(spark, sf), ORDERS_AS_OF, LINE_ORDER))


_LEVEL = "case when {s} >= 95 then 'excellent' when {s} >= 85 then 'good' when {s} >= 70 then 'fair' when {s} >= 50 then 'poor' else 'critical' end"
_VALIDATED = f"""(with e as materialized (select * from {ERRORS}), t as (select count(*) as total from {{orders_dirty}}),
   b as (select count(distinct ({S.KEYS})) as bad from e)
   select total as total_records, total - bad as valid_records, bad as invalid_records, (total - bad) * 100.0e0 / total as quality_score,
     {_LEVEL.replace('{s}', '((total - bad) * 100.0e0 / total)')} as quality_level,
     {', '.join(f"(select count(*) from e where severity = '{s}') as {s}_errors" for s in W.ROW_SEVERITIES)} from t, b)"""


@query("validate_orders", f"select * from {_VALIDATED}")
def validate_orders(spark, sf):
    return W.validate_orders(checked(spark, sf), ORDERS_AS_OF)


@query("validation_verdict", f"select total_records, quality_score, true as schema_valid, quality_score >= 50 as passed from {_VALIDATED}")
def validation_verdict(spark, sf):
    return W.validation_verdict(checked(spark, sf), ORDERS_AS_OF)


@query("quarantine_split", f"""with e as materialized (select {S.KEYS}, string_agg(message, '; ' order by list_position(['order_id', 'customer_name', 'product', 'quantity', 'price', 'order_date', 'customer_email', 'discount', 'total_amount'], field)) as reason
   from {ERRORS} group by all) select {S.KEYS}, case when reason is null then 'good' else 'bad' end as part, reason from {{orders_dirty}} left join e using ({S.KEYS})""")
def quarantine_split(spark, sf):
    good, bad = W.quarantine_split(checked(spark, sf), ORDERS_AS_OF)
    kept = good.select(*LINE_ORDER, F.lit("good").alias("part"), F.lit(None).cast("string").alias("reason"))
    return kept.unionByName(bad.select(*LINE_ORDER, F.lit("bad").alias("part"), "reason"))


for _field in dict.fromkeys(r[0] for r in ROW_RULES):
    _rules = [r for r in ROW_RULES if r[0] == _field]

    def _single(spark: SparkSession, sf: str, field: str = _field) -> DataFrame:
        rows = checked(spark, sf)
        found = W.with_errors(rows, {field: W.order_rules(rows, ORDERS_AS_OF)[field]})
        return each_element(found, "errors", "e").select(*LINE_ORDER, "e.type", "e.severity")

    query(f"rule_{_field}", f"select {S.KEYS}, type, severity from {errors_sql(_rules)}")(_single)


@query("schema_presence", "select 'schema_error' as type, f as field, 'critical' as severity from (values ('order_id'), ('price')) t(f) where exists (select 1 from {orders_raw})")
def schema_presence(spark, sf):
    return W.schema_presence(raw(spark, sf).drop("order_id", "price"))


@query("type_check", " union all ".join(f"select '{f}' as field, count(*) filter (where {S.number(f)} is null) as affected_records, 'high' as severity from {{orders_dirty}}" for f in ("quantity", "price", "discount")))
def type_check(spark, sf):
    return W.type_check(checked(spark, sf))


@query("completeness_warning", "select field, missing_count, missing_percentage, case when missing_percentage > 10 then 'medium' else 'low' end as severity from ("
       + " union all ".join(f"select '{f}' as field, count(*) filter (where {f} is null) as missing_count, count(*) filter (where {f} is null) * 100.0e0 / count(*) as missing_percentage from {{orders_dirty}}" for f in V.REQUIRED_FIELDS)
       + ") where missing_count > 0")
def completeness_warning(spark, sf):
    return W.completeness_warnings(checked(spark, sf))


@query("suspicious_name_frequency", "select case when line_no = 2 then 'Guest' else customer_name end as customer_name, count(*) as n from {orders_raw} group by 1 having count(*) > 0.1 * (select count(*) from {orders_raw})")
def suspicious_name_frequency(spark, sf):
    """Every second line of an order is a guest's."""
    name = F.when(F.col("line_no") == 2, "Guest").otherwise(F.col("customer_name"))
    return W.frequent_names(raw(spark, sf).withColumn("customer_name", name))


_SCHEMA_CHECKS = [
    ("order_id", "min_length", "'medium'", "length(order_id) < 8"), ("order_id", "max_length", "'medium'", "length(order_id) > 20"),
    ("order_id", "pattern", "'medium'", r"not regexp_full_match(order_id, '[A-Z]{3}-\d{4}-\d{3}')"),
    ("customer_name", "min_length", "'medium'", "length(customer_name) < 2"), ("customer_name", "max_length", "'medium'", "length(customer_name) > 100"),
    ("product", "min_length", "'medium'", "length(product) < 2"), ("product", "max_length", "'medium'", "length(product) > 200"),
    ("quantity", "type_integer", "'high'", f"quantity is not null and {_Q} is null"), ("quantity", "min_value", "'high'", f"{_Q} < 1"),
    ("quantity", "max_value", f"case when count(*) filter (where {_Q} > 1000) < 0.1 * count({_Q}) then 'medium' else 'high' end", f"{_Q} > 1000"),
    ("price", "type_float", "'high'", f"price is not null and {_P} is null"), ("price", "min_value", "'high'", f"{_P} < 0.01"),
    ("price", "max_value", f"case when count(*) filter (where {_P} > 50000) < 0.1 * count({_P}) then 'medium' else 'high' end", f"{_P} > 50000"),
    ("order_date", "type_date", "'high'", f"order_date is not null and {_D} is null"),
    ("source", "max_length", "'medium'", "length(source) > 50"),
    ("source", "allowed_values", "'medium'", "source not in ('website', 'mobile_app', 'store', 'phone', 'partner')"),
    ("customer_email", "type_email", "'medium'", f"not {S.email_ok('customer_email')}"),
    ("discount", "type_float", "'high'", f"discount is not null and {_X} is null"), ("discount", "min_value", "'high'", f"{_X} < 0"),
    ("discount", "max_value", f"case when count(*) filter (where {_X} > 10000) < 0.1 * count({_X}) then 'medium' else 'high' end", f"{_X} > 10000"),
    ("total_amount", "type_float", "'high'", f"total_amount is not null and {_T} is null"), ("total_amount", "min_value", "'high'", f"{_T} < 0"),
    ("store_location", "max_length", "'medium'", "length(store_location) > 100"),
    ("product_category", "max_length", "'medium'", "length(product_category) > 50"),
    ("notes", "max_length", "'medium'", "length(notes) > 500"),
    ("status", "unexpected_column", "'warning'", "true"),
]


def schema_sql(checks, source: str) -> str:
    one = " union all ".join(f"select '{f}' as field, '{c}' as constraint_name, {sev} as severity, count(*) filter (where {cond}) as failing from {source}" for f, c, sev, cond in checks)
    return f"select * from ({one}) where failing > 0"


@query("validate_schema", schema_sql(_SCHEMA_CHECKS, "{orders_dirty}"))
def validate_schema(spark, sf):
    return R.validate_schema(dirty(spark, sf).drop(*LINE_ORDER, "seq", "legacy_id", "phone", "address"), "orders")


@query("validate_schema_customers", schema_sql([
    ("customer_id", "min_length", "'medium'", "length(customer_code) < 5"), ("customer_id", "max_length", "'medium'", "length(customer_code) > 20"),
    ("customer_id", "pattern", "'medium'", r"not regexp_full_match(customer_code, 'CUST-\d{3}')"), ("name", "min_length", "'medium'", "length(name) < 2"),
    ("email", "type_email", "'medium'", f"not {S.email_ok('name')}"), ("address", "max_length", "'medium'", "length(nation) > 500")], "{customers}"))
def validate_schema_customers(spark, sf):
    rows = table(spark, sf, "customers")
    return R.validate_schema(rows.select(F.col("customer_code").alias("customer_id"), "name", F.col("name").alias("email"), F.col("nation").alias("address")), "customers")


@query("custom_schema", schema_sql([
    ("o_orderkey", "type_integer", "'high'", "false"), ("o_orderkey", "min_value", "'high'", "o_orderkey < 100"),
    ("o_orderstatus", "allowed_values", "'medium'", "o_orderstatus not in ('O', 'F')"), ("o_orderpriority", "pattern", "'medium'", "not regexp_full_match(o_orderpriority, '[1-5]-[A-Z]+')"),
    ("o_clerk", "missing_required_field", "'critical'", "true"), ("o_custkey", "unexpected_column", "'warning'", "true"), ("o_totalprice", "unexpected_column", "'warning'", "true"),
    ("o_orderdate", "unexpected_column", "'warning'", "true")], "orders"))
def custom_schema(spark, sf):
    spec = R.schema_from_dicts([
        {"name": "o_orderkey", "type": "integer", "required": True, "min_value": 100},
        {"name": "o_orderstatus", "allowed": ["O", "F"]},
        {"name": "o_orderpriority", "pattern": "^[1-5]-[A-Z]+$"},
        {"name": "o_clerk", "required": True},
    ])
    return R.validate_schema(table(spark, sf, "orders"), spec)


BUSINESS_RULES = [
    ("order_id", "format_error", "high", "", r"not regexp_full_match(order_id, '[A-Z]{3}-\d{4}-\d{3}')"),
    ("customer_email", "format_error", "medium", "", f"not {S.blank('customer_email')} and not {S.email_ok('customer_email')}"),
    ("price", "data_type_error", "high", "", f"price is not null and {_P} is null"), ("price", "business_rule_error", "high", "", f"{_P} < 0.01"),
    ("price", "business_rule_error", "medium", "", f"{_P} > 10000"),
    ("quantity", "data_type_error", "high", "", f"quantity is not null and {_Q} is null"), ("quantity", "business_rule_error", "high", "", f"{_Q} < 1"),
    ("quantity", "business_rule_error", "medium", "", f"{_Q} > 100"),
    ("customer_name", "business_rule_error", "medium", "", f"not {S.blank('customer_name')} and length(customer_name) < 2"),
    ("customer_name", "business_rule_error", "low", "", f"not {S.blank('customer_name')} and length(customer_name) > 100"),
    ("order_date", "data_type_error", "high", "", f"not {S.blank('order_date')} and {_D} is null"), ("order_date", "business_rule_error", "high", "", f"{_D} > {S.AS_OF}"),
    ("order_date", "business_rule_error", "low", "", _OLD),
    ("status", "business_rule_error", "medium", "", f"lower(status) not in ({S.quoted(V.ORDER_STATUSES)})"),
]
_TEST_NAME = "regexp_matches(lower(customer_name), 'test|dummy|sample|example')"
_DUP_ROWS = "select cast(coalesce(sum(c), 0) as bigint) as n from (select count(*) as c from {orders_dirty} where order_id is not null group by order_id having count(*) > 1)"


@query("validate_business_rules", f"""select type, field, severity, count(*) as n from {errors_sql(BUSINESS_RULES)} group by all
   union all select 'duplicate_error', 'order_id', 'high', n from ({_DUP_ROWS}) where n > 0
   union all select * from (select 'data_quality_warning', 'customer_name', 'medium', count(*) filter (where {_TEST_NAME}) as n from {{orders_dirty}}) where n > 0""")
def validate_business_rules(spark, sf):
    return W.validate_business_rules(dirty(spark, sf).select(*CHECKED, "status"), ORDERS_AS_OF)


_FRAME = ["order_id", "customer_name", "customer_email", "product_category", "source"]


@query("validate_file_frame", f"""with c as (select count(*) as total_rows, {' + '.join(f"count(*) filter (where {f} is null)" for f in _FRAME)} as missing_values,
     {' + '.join(f"case when count(*) filter (where {f} is null) > 0.5 * count(*) then 1 else 0 end" for f in _FRAME)} as mostly_empty_columns from {{orders_dirty}})
   select total_rows, {len(_FRAME)} as total_columns, missing_values, mostly_empty_columns,
     (select cast(sum(n - 1) as bigint) from (select count(*) as n from {{orders_dirty}} group by {', '.join(_FRAME)})) as duplicate_rows, 'price' as missing_columns, false as is_valid from c""")
def validate_file_frame(spark, sf):
    return W.validate_file_frame(dirty(spark, sf).select(*_FRAME), ["order_id", "price"])


@query("validate_nb6", f"""select *, quality_score >= 80 as meets_threshold from (select count(*) as total_records, count(*) filter (where ok) as valid_records,
   count(*) filter (where ok) * 100.0e0 / count(*) as quality_score from (select not {S.blank('order_id')} and not {S.blank('customer_name')} and not {S.blank('product')}
     and not {S.blank('quantity')} and not {S.blank('price')} and coalesce({_Q} > 0, false) and coalesce({_P} > 0, false) as ok from {{orders_dirty}}))""")
def validate_nb6(spark, sf):
    return W.validate_nb6(checked(spark, sf))


@query("validity_flags", f"select *, case when is_valid then 100 else 0 end as validation_score from (select {S.KEYS}, coalesce({_P} > 0, false) and customer_email is not null as is_valid from {{orders_dirty}})")
def validity_flags(spark, sf):
    return W.validity_flags(checked(spark, sf)).select(*LINE_ORDER, "is_valid", "validation_score")


_SCANNED = ["order_id", "customer_name", "product", "quantity", "price", "order_date", "customer_email"]


@query("issue_scan", "select * from (" + " union all ".join(f"select 'empty' as issue, '{f}' as field, count(*) filter (where {f} is null or {f} = '') as n from {{orders_dirty}}" for f in _SCANNED)
       + f""" union all select 'non_positive', 'quantity', count(*) filter (where {_Q} <= 0) from {{orders_dirty}} union all select 'non_positive', 'price', count(*) filter (where {_P} <= 0) from {{orders_dirty}}
   union all select 'invalid', 'customer_email', count(*) filter (where not coalesce({S.email_ok('customer_email')}, false)) from {{orders_dirty}}
   union all select 'duplicate', 'order_id', cast(sum(c - 1) as bigint) from (select count(*) as c from {{orders_dirty}} group by order_id)) where n > 0""")
def issue_scan(spark, sf):
    return W.issue_scan(checked(spark, sf), _SCANNED)


@query("validate_standardization", f"""with s as materialized (select {STANDARD_ID} as id, customer_email, {S.currency('price')} as p, {S.currency('quantity')} as q, {S.currency('total_amount')} as t from {{orders_dirty}}),
   c as (select 'order_id_format' as "check", count(*) filter (where regexp_full_match(id, '[A-Z]{{3}}-\\d{{4}}-\\d{{3}}')) as valid, count(*) as total, 0.9e0 as threshold from s
     union all select 'email_format', count(*) filter (where {S.email_ok('customer_email')}), count(customer_email), 0.95 from s
     union all select 'price_numeric', count(p), count(*), 0.95 from s union all select 'quantity_numeric', count(q), count(*), 0.95 from s
     union all select 'total_amount_numeric', count(t), count(*), 0.95 from s)
   select *, valid * 100.0e0 / total as percentage, valid / total > threshold as passed, (select count(*) filter (where valid / total > threshold) * 100.0e0 / count(*) from c) as overall_score from c""")
def validate_standardization(spark, sf):
    # the email is checked as landed: standardizing it already drops bad ones
    rows = checked(spark, sf).withColumnRenamed("customer_email", "landed")
    ready = Z.standardize_orders(rows, ORDERS_AS_OF).withColumnRenamed("landed", "customer_email")
    return Z.validate_standardization(ready.select("order_id", "customer_email", "price", "quantity", "total_amount"))


# --- rule engine ------------------------------------------------------------------------------

_PLAIN = r"regexp_full_match(customer_name, '[a-zA-Z\s\-'']+')"
_TIME = "coalesce(hour(" + _D + "), 0)"
_RULE_SQL = {
    "order_id_format": r"not regexp_full_match(order_id, '[A-Z]{3}-\d{4}-\d{3}')", "order_id_not_null": "order_id is null", "order_id_length": "length(order_id) <> 11",
    "customer_name_not_null": "customer_name is null", "customer_name_not_empty": "trim(customer_name) = ''", "customer_name_length": "length(customer_name) < 2 or length(customer_name) > 100",
    "customer_name_characters": f"not {_PLAIN}", "customer_name_test_data": "lower(trim(customer_name)) in ('test', 'dummy', 'sample', 'example', 'null', 'none', 'unknown')",
    "product_not_null": "product is null", "product_not_empty": "trim(product) = ''", "product_length": "length(product) < 2 or length(product) > 200",
    "valid_products": f"product not in ({S.quoted(V.PRODUCT_CATALOG)})",
    "quantity_not_null": "quantity is null", "quantity_positive": f"{_Q} < 1", "quantity_reasonable": f"{_Q} < 1 or {_Q} > 1000",
    "quantity_integer": f"quantity is not null and ({_Q} is null or {_Q} <> floor({_Q}))",
    "price_not_null": "price is null", "price_positive": f"{_P} < 0.01", "price_reasonable": f"{_P} < 0.01 or {_P} > 50000", "price_decimal_places": f"round({_P} * 100) <> {_P} * 100 and abs(round({_P} * 100) - {_P} * 100) > 1e-6",
    "order_date_not_null": "order_date is null", "order_date_valid": f"order_date is not null and {_D} is null", "order_date_not_future": f"{_D} > {S.AS_OF}",
    "order_date_not_too_old": f"{_D} > {S.AS_OF} or {_D} < {S.AS_OF} - interval 1825 days", "order_date_business_hours": f"not (hour({_D}) >= 8 and hour({_D}) < 22)",
    "email_format": f"not {S.email_ok('customer_email')}", "email_domain": f"split_part(lower(trim(customer_email)), '@', -1) not in ({S.quoted(R.ALLOWED_DOMAINS)})",
    "discount_non_negative": f"{_X} < 0", "discount_reasonable": f"{_X} > {_P} * 90 / 100", "total_calculation": f"{_GAP} > 0.01",
    "order_value_reasonable": f"{_T} < 0.01 or {_T} > 100000", "source_consistency": "source not in ('website', 'mobile_app', 'store', 'partner', 'api')",
}


def rule_sql() -> str:
    parts = []
    for r in R.ORDER_RULES:
        if r["name"] in _RULE_SQL:
            parts.append(f"select '{r['name']}' as rule, '{r['field']}' as field, '{r['severity']}' as severity, count(*) filter (where {_RULE_SQL[r['name']]}) as failing from src")
        else:
            keys = r.get("fields") or [r["field"]]
            where = f"where {keys[0]} is not null" if r["type"] == "unique" else ""
            parts.append(f"select '{r['name']}', '{','.join(keys)}', '{r['severity']}', cast(coalesce(sum(n), 0) as bigint) from (select count(*) as n from src {where} group by {', '.join(keys)} having count(*) > 1)")
    return "(with src as materialized (select * from {orders_dirty}) " + " union all ".join(parts) + ")"


@query("rule_engine", f"select * from {rule_sql()}")
def rule_engine(spark, sf):
    return R.rule_engine(dirty(spark, sf).select(*CHECKED, "source"), R.ORDER_RULES, ORDERS_AS_OF)


@query("rule_verdict", f"select cast(sum(failing) as bigint) as findings, count(*) filter (where failing > 0 and severity in ('critical', 'error')) = 0 as passed from {rule_sql()}")
def rule_verdict(spark, sf):
    return R.rule_verdict(R.rule_engine(dirty(spark, sf).select(*CHECKED, "source"), R.ORDER_RULES, ORDERS_AS_OF))


TYPED_RULES = [
    {"name": "discount_vs_price", "type": "comparison", "condition": "discount <= price", "severity": "error"},
    {"name": "total_formula", "type": "calculation", "formula": "total_amount == quantity * price - discount", "tolerance": 0.01, "severity": "error"},
    {"name": "exact_duplicates", "type": "exact", "severity": "warning"},
    {"name": "order_id_duplicates", "type": "field", "fields": ["order_id"], "severity": "error"},
]
_TYPED_COLUMNS = ["order_id", "quantity", "price", "discount", "total_amount"]


@query("rule_engine_typed", """select 'discount_vs_price' as rule, '' as field, 'error' as severity, count(*) filter (where discount > price) as failing from {orders_raw}
   union all select 'total_formula', '', 'error', 0 union all select 'exact_duplicates', '', 'warning',
     (select cast(coalesce(sum(n), 0) as bigint) from (select count(*) as n from {orders_raw} group by order_id, quantity, price, discount, total_amount having count(*) > 1))
   union all select 'order_id_duplicates', 'order_id', 'error', (select cast(coalesce(sum(n), 0) as bigint) from (select count(*) as n from {orders_raw} group by order_id having count(*) > 1))""")
def rule_engine_typed(spark, sf):
    return R.rule_engine(raw(spark, sf).select(*_TYPED_COLUMNS), TYPED_RULES, ORDERS_AS_OF)


@query("custom_rule_function", """select 'night_price' as rule, 'price' as field, 'info' as severity, count(*) filter (where price > 100 and quantity % 2 = 0) as failing from {orders_raw}""")
def custom_rule_function(spark, sf):
    if "even_and_expensive" not in R.CUSTOM_RULES:
        R.custom_rule("even_and_expensive")(lambda df, rule: (F.col(rule["field"]) > rule["limit"]) & (F.col("quantity") % 2 == 0))
    rule = {"name": "night_price", "field": "price", "type": "custom", "function": "even_and_expensive", "limit": 100, "severity": "info"}
    return R.rule_engine(raw(spark, sf), [rule], ORDERS_AS_OF)


# --- quality ----------------------------------------------------------------------------------

_SCORED = ["order_id", "customer_name", "customer_email", "product", "quantity", "price", "order_date", "status"]


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return dirty(spark, sf).select(*_SCORED)


_EMPTY_CELLS = " + ".join(f"count(*) filter (where {f} is null or {f} = '')" for f in _SCORED)
DQ_COMPLETENESS = f"(select (count(*) * {len(_SCORED)} - ({_EMPTY_CELLS})) * 100.0e0 / (count(*) * {len(_SCORED)}) from src)"
DQ_VALIDITY = f"""(select greatest(0.0, 100 - (select sum(case severity when 'critical' then 10 when 'high' then 5 when 'medium' then 2 else 1 end)
   from {errors_sql(BUSINESS_RULES)}) * 100.0e0 / (count(*) * 10)) from src)"""


def _styled(c: str) -> str:
    cased = f"lower({c}) <> upper({c})"
    return f"case when sum(case when {cased} then (case when {c} = lower({c}) then 1 else 0 end + case when {c} = upper({c}) then 1 else 0 end + case when {c} = {S.title(c)} then 1 else 0 end) else 0 end) < 0.8 * count({c}) then 1 else 0 end"


DQ_CONSISTENCY = f"""(select (3 - {_styled('customer_name')} - {_styled('status')} - case when count(distinct case when order_date = '' then null when order_date like '%-%' then 'd' when order_date like '%/%' then 's' else 'o' end) > 1 then 1 else 0 end)
   * 100.0e0 / 3 from src where true)"""
DQ_CONSISTENCY = DQ_CONSISTENCY.replace("case when order_date = ''", "case when order_date is null or order_date = ''")
DQ_ACCURACY = f"""(select (count(*) - count(*) filter (where coalesce({_TEST_NAME}, false) or (price is not null and coalesce({_P} > 10000 or {_P} < 0.01, true))
   or (quantity is not null and coalesce({_Q} > 100 or {_Q} < 1, true)))) * 100.0e0 / count(*) from src)"""
DQ_UNIQUENESS = f"""(select (count(*) - greatest((select sum(n - 1) from (select count(*) as n from src group by {', '.join(_SCORED)})),
   (select sum(n - 1) from (select count(*) as n from src where order_id is not null group by order_id)))) * 100.0e0 / count(*) from src)"""
_SRC = f"with src as materialized (select {', '.join(_SCORED)} from {{orders_dirty}}) "


@query("dq_completeness", _SRC + f"select {DQ_COMPLETENESS} as completeness")
def dq_completeness(spark, sf):
    return P.dq_completeness(scored(spark, sf))


@query("dq_validity", _SRC + f"select {DQ_VALIDITY} as validity")
def dq_validity(spark, sf):
    return P.dq_validity(W.business_errors(scored(spark, sf), ORDERS_AS_OF))


@query("dq_consistency", _SRC + f"select {DQ_CONSISTENCY} as consistency")
def dq_consistency(spark, sf):
    return P.dq_consistency(scored(spark, sf))


@query("dq_accuracy", _SRC + f"select {DQ_ACCURACY} as accuracy")
def dq_accuracy(spark, sf):
    return P.dq_accuracy(scored(spark, sf))


@query("dq_uniqueness", _SRC + f"select {DQ_UNIQUENESS} as uniqueness")
def dq_uniqueness(spark, sf):
    return P.dq_uniqueness(scored(spark, sf))


_ADVICE = (
    "case when completeness < 90 then '; fill in what is missing' else '' end || case when validity < 85 then '; repair rows that break a rule' else '' end"
    " || case when consistency < 80 then '; bring names and dates into one style' else '' end || case when accuracy < 85 then '; look into unlikely values and test rows' else '' end"
    " || case when uniqueness < 95 then '; take out repeated records' else '' end"
)


@query("dq_score", _SRC + f"""select *, {_LEVEL.replace('{s}', 'overall_score')} as quality_level,
   case when ({_ADVICE}) = '' then 'nothing to do' else substr({_ADVICE}, 3) end as recommendations from (
   select *, completeness * 0.25e0 + validity * 0.25e0 + consistency * 0.2e0 + accuracy * 0.15e0 + uniqueness * 0.15e0 as overall_score from (
   select {DQ_COMPLETENESS} as completeness, {DQ_VALIDITY} as validity, {DQ_CONSISTENCY} as consistency, {DQ_ACCURACY} as accuracy, {DQ_UNIQUENESS} as uniqueness))""")
def dq_score(spark, sf):
    return P.dq_score(scored(spark, sf), lambda rows: W.business_errors(rows, ORDERS_AS_OF))


_PROFILED_TEXT, _PROFILED_NUMBERS = ["product", "source", "notes"], ["quantity", "price", "discount"]


def _profile_sql(name: str, numeric: bool) -> str:
    value, size = (name, "cast(null as int)") if numeric else ("cast(null as double)", f"length({name})")
    mean = S.mean(name) if numeric else "cast(null as double)"
    empty = "0" if numeric else f"count(*) filter (where {name} = '')"
    return f"""select '{name}' as column_name, '{'numeric' if numeric else 'string'}' as kind, count(*) as total_count, count(*) - count({name}) as null_count, count(distinct {name}) as distinct_count,
      cast(min({value}) as double) as min_value, cast(max({value}) as double) as max_value, {mean} as mean_value, round(stddev_samp(cast({value} as double)), 6) as std_value,
      min({size}) as min_length, max({size}) as max_length, avg({size}) as avg_length, {empty} as empty_count,
      (count(*) - count({name})) * 100.0e0 / count(*) as null_pct, count(distinct {name}) * 100.0e0 / count(*) as distinct_pct from {{orders_raw}}"""


@query("column_profile", " union all ".join([_profile_sql(c, False) for c in _PROFILED_TEXT] + [_profile_sql(c, True) for c in _PROFILED_NUMBERS]))
def column_profile(spark, sf):
    return rounded(P.column_profile(raw(spark, sf), [*_PROFILED_TEXT, *_PROFILED_NUMBERS]), "std_value")


@query("describe_numeric", " union all ".join(f"""select '{c}' as column_name, count({c}) as n, {S.mean(c)} as mean, round(stddev_samp(cast({c} as double)), 6) as std, cast(min({c}) as double) as min_value,
   cast(max({c}) as double) as max_value, quantile_cont(cast({c} as double), 0.25) as q25, quantile_cont(cast({c} as double), 0.5) as q50, quantile_cont(cast({c} as double), 0.75) as q75 from {{orders_raw}}""" for c in ("quantity", "price", "discount", "total_amount")))
def describe_numeric(spark, sf):
    return rounded(P.describe_numeric(raw(spark, sf), ["quantity", "price", "discount", "total_amount"]), "std")


_MISSING = " + ".join(f"count(*) filter (where {f} is null)" for f in _SCORED)


@query("missing_matrix", " union all ".join(f"""select count(*) as total, {_MISSING} as total_missing, (count(*) * {len(_SCORED)} - ({_MISSING})) * 100.0e0 / (count(*) * {len(_SCORED)}) as completeness,
   '{f}' as column_name, count(*) filter (where {f} is null) as missing from {{orders_dirty}}""" for f in _SCORED))
def missing_matrix(spark, sf):
    return P.missing_matrix(scored(spark, sf))


_EXPORTED = ["order_id", "price", "quantity"]


@query("export_profile", " union all ".join(f"""select '{c}' as column_name, count(*) as n_rows, count(*) filter (where {c} is null) as null_count,
   {', '.join(f"{e} as {n}" for n, e in ((('mean', S.mean(c)), ('std', f'round(stddev_samp(cast({c} as double)), 6)'), ('min_value', f'cast(min({c}) as double)'), ('max_value', f'cast(max({c}) as double)'), ('q25', f'quantile_cont(cast({c} as double), 0.25)'), ('q50', f'quantile_cont(cast({c} as double), 0.5)'), ('q75', f'quantile_cont(cast({c} as double), 0.75)')) if c != 'order_id' else ((n, 'cast(null as double)') for n in ('mean', 'std', 'min_value', 'max_value', 'q25', 'q50', 'q75'))))} from {{orders_raw}}""" for c in _EXPORTED))
def export_profile(spark, sf):
    return rounded(P.export_profile(raw(spark, sf).select(*_EXPORTED)), "std")


_TEXT_IN = ["order_id", "customer_name", "customer_email", "product", "product_category", "quantity", "price", "discount", "total_amount", "order_date", "source", "store_location", "notes"]


def _nulls(columns: list[str]) -> str:
    return " + ".join(f"count(*) filter (where {c} is null)" for c in columns)


_IN, _OUT = len(_TEXT_IN) + len(LINE_ORDER), len(CLEANED_COLUMNS) + len(LINE_ORDER)


@query("transformation_impact", f"""select r0 as records_before, r1 as records_after, r1 * 100.0e0 / r0 as retention_rate, {_IN} as columns_before, {_OUT} as columns_after, m0 as missing_before, m1 as missing_after,
   (r0 * {_IN} - m0) * 100.0e0 / (r0 * {_IN}) as completeness_before, (r1 * {_OUT} - m1) * 100.0e0 / (r1 * {_OUT}) as completeness_after, 0 as calculated_fields, 0 as enrichment_fields, 1 as standardized_fields
   from (select count(*) as r0, {_nulls(_TEXT_IN)} as m0 from {{orders_dirty}}) b, (select count(*) as r1, {_nulls(CLEANED_COLUMNS)} as m1 from {CLEANED}) a""")
def transformation_impact(spark, sf):
    before = dirty(spark, sf).drop("seq", "legacy_id", "status", "phone", "address")
    return A.transformation_impact(before, cleaned(spark, sf).drop("cleaned_at"))
