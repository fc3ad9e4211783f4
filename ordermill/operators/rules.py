"""Declarative schemas and rules, compiled to columns.

Schemas and rules are small dict specs. All row rules of a spec are counted in one aggregate; set
rules (uniqueness, duplicates) are grouped counts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import fixed_values as V
from ..functions import numeric as N
from ..functions import text as X
from ..session import clock
from .cleaning import any_date, number, parsed
from .dedup import duplicated_keys


@dataclass(frozen=True)
class FieldSpec:
    name: str
    type: str = "string"
    required: bool = False
    min_length: int | None = None
    max_length: int | None = None
    min_value: float | None = None
    max_value: float | None = None
    pattern: str | None = None
    allowed: tuple | None = None


# FIXED VALUES: the standard schemas
SCHEMAS: dict[str, list[FieldSpec]] = {
    "orders": [
        FieldSpec("order_id", required=True, min_length=8, max_length=20, pattern=V.ORDER_ID_PATTERN),
        FieldSpec("customer_name", required=True, min_length=2, max_length=100),
        FieldSpec("product", required=True, min_length=2, max_length=200),
        FieldSpec("quantity", "integer", True, min_value=1, max_value=1000),
        FieldSpec("price", "float", True, min_value=0.01, max_value=50000),
        FieldSpec("order_date", "date", True),
        FieldSpec("source", max_length=50, allowed=("website", "mobile_app", "store", "phone", "partner")),
        FieldSpec("customer_email", "email", max_length=255),
        FieldSpec("discount", "float", min_value=0, max_value=10000),
        FieldSpec("total_amount", "float", min_value=0),
        FieldSpec("store_location", max_length=100),
        FieldSpec("product_category", max_length=50),
        FieldSpec("notes", max_length=500),
    ],
    "customers": [
        FieldSpec("customer_id", required=True, min_length=5, max_length=20, pattern=r"^CUST-\d{3}$"),
        FieldSpec("name", required=True, min_length=2, max_length=100),
        FieldSpec("email", "email", max_length=255),
        FieldSpec("phone", min_length=10, max_length=20),
        FieldSpec("address", max_length=500),
    ],
    "products": [
        FieldSpec("product_id", required=True, min_length=5, max_length=20, pattern=r"^PROD-\d{3}$"),
        FieldSpec("name", required=True, min_length=2, max_length=200),
        FieldSpec("category", max_length=50),
        FieldSpec("price", "float", True, min_value=0.01, max_value=50000),
        FieldSpec("in_stock", "boolean"),
    ],
}


def schema_from_dicts(fields: list[dict]) -> list[FieldSpec]:
    return [FieldSpec(**{**f, "allowed": tuple(f["allowed"]) if f.get("allowed") else None}) for f in fields]


def schema_to_dicts(schema: list[FieldSpec]) -> list[dict]:
    return [asdict(f) for f in schema]


def _wrong_type(df: DataFrame, f: FieldSpec, strict_integer: bool) -> tuple[Column, str] | None:
    c = F.col(f.name)
    text = c.cast("string")
    if f.type in ("integer", "float"):
        value = number(df, f.name)
        wrong = value.isNull()
        if f.type == "integer" and strict_integer:
            wrong = wrong | (value != F.floor(value))
        return wrong, "high"
    if f.type == "boolean":
        return ~text.isin("true", "false", "True", "False", "1", "0"), "medium"
    if f.type == "date":
        return any_date(df, f.name).isNull(), "high"
    if f.type == "email":
        return ~X.is_valid_email(text), "medium"
    return None


def _field_checks(df: DataFrame, f: FieldSpec, strict_integer: bool) -> list[tuple[str, str, Column]]:
    """(constraint, severity, failing condition) of a present field; nulls never fail."""
    text = F.col(f.name).cast("string")
    checks = []
    typed = _wrong_type(df, f, strict_integer)
    if typed is not None:
        checks.append((f"type_{f.type}", typed[1], typed[0]))
    if f.type == "string":
        if f.min_length is not None:
            checks.append(("min_length", "medium", F.length(text) < f.min_length))
        if f.max_length is not None:
            checks.append(("max_length", "medium", F.length(text) > f.max_length))
    if f.type in ("integer", "float"):
        value = number(df, f.name)
        if f.min_value is not None:
            checks.append(("min_value", "high", value < f.min_value))
        if f.max_value is not None:
            checks.append(("max_value", "high", value > f.max_value))
    if f.pattern is not None:
        checks.append(("pattern", "medium", ~text.rlike(f.pattern)))
    if f.allowed is not None:
        checks.append(("allowed_values", "medium", ~text.isin(*f.allowed)))
    return [(name, severity, F.col(f.name).isNotNull() & F.coalesce(cond, F.lit(False))) for name, severity, cond in checks]


def validate_schema(df: DataFrame, schema: list[FieldSpec] | str, strict_integer: bool = False) -> DataFrame:
    """Failing constraints as (field, constraint, severity, failing) rows, counted in one aggregate."""
    fields = SCHEMAS[schema] if isinstance(schema, str) else schema
    given_columns = df.columns
    df = parsed(df, [f.name for f in fields if f.type in ("integer", "float")], [f.name for f in fields if f.type == "date"])
    have = set(given_columns)
    checks = [(f.name, *c) for f in fields if f.name in have for c in _field_checks(df, f, strict_integer)]
    named = [(f"c{i}", *c) for i, c in enumerate(checks)]
    given = {n: F.count(number(df, n)).alias(f"n_{n}") for n in {c[0] for c in checks if c[1] == "max_value"}}
    one = df.agg(*[F.count_if(cond).alias(alias) for alias, _, _, _, cond in named], *given.values())

    def severity(field: str, constraint: str, level: str, alias: str) -> Column:
        if constraint != "max_value":
            return F.lit(level)
        return F.when(F.col(alias) < F.col(f"n_{field}") * 0.1, "medium").otherwise("high")

    rows = [
        F.struct(F.lit(field).alias("field"), F.lit(constraint).alias("constraint_name"),
                 severity(field, constraint, level, alias).alias("severity"), F.col(alias).alias("failing"))
        for alias, field, constraint, level, _ in named
    ]
    found = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*").filter("failing > 0")
    absent = [F.struct(F.lit(f.name).alias("field"), F.lit("missing_required_field").alias("constraint_name"),
                       F.lit("critical").alias("severity"), F.count(F.lit(1)).alias("failing")) for f in fields if f.required and f.name not in have]
    extra = [F.struct(F.lit(c).alias("field"), F.lit("unexpected_column").alias("constraint_name"),
                      F.lit("warning").alias("severity"), F.count(F.lit(1)).alias("failing")) for c in given_columns if c not in {f.name for f in fields}]
    if absent + extra:
        named_structs = [s.alias(f"s{i}") for i, s in enumerate(absent + extra)]
        notes = df.agg(*named_structs).select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(named_structs))])).alias("r"))
        found = found.unionByName(notes.select("r.*"))
    return found


# --- rule engine ------------------------------------------------------------------------------

CUSTOM_RULES: dict[str, Callable[[DataFrame, dict], Column]] = {}


def custom_rule(name: str):
    """Register a function (df, rule) -> Column that is true where the rule is violated."""

    def register(fn):
        CUSTOM_RULES[name] = fn
        return fn

    return register


@custom_rule("validate_business_hours")
def _business_hours(df: DataFrame, rule: dict) -> Column:
    return ~D.in_business_hours(any_date(df, rule["field"]), rule.get("start", 8), rule.get("end", 22))


# FIXED VALUES: accepted e-mail providers
ALLOWED_DOMAINS = ["gmail.com", "yahoo.com", "outlook.com", "hotmail.com", "company.com"]


@custom_rule("validate_email_domain")
def _email_domain(df: DataFrame, rule: dict) -> Column:
    return ~F.substring_index(F.lower(F.trim(rule["field"])), "@", -1).isin(*rule.get("allowed_domains", ALLOWED_DOMAINS))


@custom_rule("validate_discount_vs_price")
def _discount_share(df: DataFrame, rule: dict) -> Column:
    return number(df, "discount") > number(df, "price") * rule.get("max_discount_percent", 90) / 100


@custom_rule("validate_total_calculation")
def _total(df: DataFrame, rule: dict) -> Column:
    expected = number(df, "price") * number(df, "quantity") - number(df, "discount")
    return N.differ(number(df, "total_amount"), expected, rule.get("tolerance", 0.01))


@custom_rule("validate_source_consistency")
def _source(df: DataFrame, rule: dict) -> Column:
    return ~F.col("source").isin(*rule.get("expected_sources", ["website", "mobile_app", "store", "partner", "api"]))


def _row_rule(df: DataFrame, rule: dict, as_of: str) -> Column:
    """The violation condition of a row rule; null values violate only the presence rules."""
    kind, field = rule["type"], rule.get("field")
    c = F.col(field) if field else None
    text = c.cast("string") if field else None
    if kind == "not_null":
        return c.isNull()
    if kind == "not_empty":
        return F.trim(text) == ""
    if kind == "regex":
        return ~text.rlike(rule["pattern"])
    if kind == "length":
        return (F.length(text) < rule["min_length"]) | (F.length(text) > rule["max_length"])
    if kind in ("in", "not_in"):
        fold = not rule.get("case_sensitive", True)
        values = [v.lower() if fold else v for v in rule["values"]]
        hit = (F.lower(F.trim(text)) if fold else text).isin(*values)
        return hit if kind == "not_in" else ~hit
    if kind == "range":
        value = number(df, field)
        limits = [value < rule["min_value"]] if rule.get("min_value") is not None else []
        limits += [value > rule["max_value"]] if rule.get("max_value") is not None else []
        return reduce(lambda a, b: a | b, limits)
    if kind == "integer":
        value = number(df, field)
        return value.isNull() | (value != F.floor(value))
    if kind == "decimal_places":
        return ~N.has_decimal_places(number(df, field), rule["max_places"])
    if kind == "date":
        return any_date(df, field).isNull()
    if kind == "date_range":
        value = any_date(df, field)
        late = value > clock(as_of)
        days = rule.get("max_age_days")
        return late if days is None else late | (value < clock(as_of) - F.expr(f"interval {days} days"))
    if kind == "comparison":
        return ~F.expr(rule["condition"])
    if kind == "calculation":
        left, right = rule["formula"].split("==")
        return N.differ(F.expr(left), F.expr(right), rule.get("tolerance", 0))
    if kind == "custom":
        return CUSTOM_RULES[rule["function"]](df, rule)
    raise ValueError(f"unknown rule type {kind}")


SET_RULES = {"unique", "exact", "field", "field_combination"}


def violations(df: DataFrame, rules: list[dict], as_of: str) -> list[tuple[dict, Column]]:
    out = []
    for rule in rules:
        if rule["type"] in SET_RULES:
            continue
        hit = F.coalesce(_row_rule(df, rule, as_of), F.lit(False))
        if rule.get("field") and rule["type"] != "not_null":
            hit = F.col(rule["field"]).isNotNull() & hit
        out.append((rule, hit))
    return out


def rule_errors(df: DataFrame, rules: list[dict], as_of: str, name: str = "errors") -> DataFrame:
    """Rows with the array of row rules they violate."""
    hits = [
        F.when(hit, F.struct(F.lit(r["name"]).alias("rule"), F.lit(r.get("field")).cast("string").alias("field"), F.lit(r["severity"]).alias("severity")))
        for r, hit in violations(df, rules, as_of)
    ]
    return df.withColumn(name, F.array_compact(F.array(*hits)))


def _parsed_for(df: DataFrame, rules: list[dict]) -> DataFrame:
    amounts = {"quantity", "price", "discount", "total_amount"}
    numbers = {r["field"] for r in rules if r["type"] in ("range", "integer", "decimal_places")}
    dates = {r["field"] for r in rules if r["type"] in ("date", "date_range")}
    custom = any(r["type"] == "custom" for r in rules)
    return parsed(df, sorted(numbers | (amounts if custom else set())), sorted(dates))


def rule_engine(df: DataFrame, rules: list[dict], as_of: str) -> DataFrame:
    """Failing rows per rule: (rule, field, severity, failing)."""
    rows = _parsed_for(df, rules)
    row_rules = violations(rows, rules, as_of)
    one = rows.agg(*[F.count_if(hit).alias(f"r{i}") for i, (_, hit) in enumerate(row_rules)])
    cells = [
        F.struct(F.lit(r["name"]).alias("rule"), F.lit(r.get("field") or "").alias("field"), F.lit(r["severity"]).alias("severity"), F.col(f"r{i}").alias("failing"))
        for i, (r, _) in enumerate(row_rules)
    ]
    parts = [one.select(F.explode(F.array(*cells)).alias("c")).select("c.*")]
    for r in rules:
        if r["type"] in SET_RULES:
            keys = df.columns if r["type"] == "exact" else r.get("fields") or [r["field"]]
            keyed = df if r["type"] in ("exact", "field_combination") else df.dropna(subset=keys)
            found = duplicated_keys(keyed, keys).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("failing"))
            parts.append(found.select(F.lit(r["name"]).alias("rule"), F.lit(",".join(r.get("fields") or [r.get("field") or ""])).alias("field"), F.lit(r["severity"]).alias("severity"), "failing"))
    return reduce(DataFrame.unionByName, parts)


def rule_verdict(result: DataFrame, mode: str = "strict") -> DataFrame:
    """strict: no critical or error finding; permissive: no critical one."""
    blocking = ["critical", "error"] if mode == "strict" else ["critical"]
    return result.agg(
        F.sum("failing").alias("findings"), (F.count_if((F.col("failing") > 0) & F.col("severity").isin(*blocking)) == 0).alias("passed")
    )


# FIXED VALUES: the standard rule set
ORDER_RULES = [
    {"name": "order_id_format", "field": "order_id", "type": "regex", "pattern": V.ORDER_ID_PATTERN, "severity": "error"},
    {"name": "order_id_unique", "field": "order_id", "type": "unique", "severity": "error"},
    {"name": "order_id_not_null", "field": "order_id", "type": "not_null", "severity": "critical"},
    {"name": "order_id_length", "field": "order_id", "type": "length", "min_length": 11, "max_length": 11, "severity": "error"},
    {"name": "customer_name_not_null", "field": "customer_name", "type": "not_null", "severity": "critical"},
    {"name": "customer_name_not_empty", "field": "customer_name", "type": "not_empty", "severity": "critical"},
    {"name": "customer_name_length", "field": "customer_name", "type": "length", "min_length": 2, "max_length": 100, "severity": "error"},
    {"name": "customer_name_characters", "field": "customer_name", "type": "regex", "pattern": r"^[a-zA-Z\s\-']+$", "severity": "warning"},
    {"name": "customer_name_test_data", "field": "customer_name", "type": "not_in", "case_sensitive": False, "severity": "warning",
     "values": ["test", "dummy", "sample", "example", "null", "none", "unknown"]},
    {"name": "product_not_null", "field": "product", "type": "not_null", "severity": "critical"},
    {"name": "product_not_empty", "field": "product", "type": "not_empty", "severity": "critical"},
    {"name": "product_length", "field": "product", "type": "length", "min_length": 2, "max_length": 200, "severity": "error"},
    {"name": "valid_products", "field": "product", "type": "in", "severity": "warning",
     "values": ["iPhone 15", "MacBook Pro", "iPad Air", "AirPods Pro", "Apple Watch", "Samsung Galaxy S24", "Nintendo Switch",
                "PlayStation 5", "Xbox Series X", "Kindle Paperwhite"]},
    {"name": "quantity_not_null", "field": "quantity", "type": "not_null", "severity": "critical"},
    {"name": "quantity_positive", "field": "quantity", "type": "range", "min_value": 1, "severity": "error"},
    {"name": "quantity_reasonable", "field": "quantity", "type": "range", "min_value": 1, "max_value": 1000, "severity": "warning"},
    {"name": "quantity_integer", "field": "quantity", "type": "integer", "severity": "error"},
    {"name": "price_not_null", "field": "price", "type": "not_null", "severity": "critical"},
    {"name": "price_positive", "field": "price", "type": "range", "min_value": 0.01, "severity": "error"},
    {"name": "price_reasonable", "field": "price", "type": "range", "min_value": 0.01, "max_value": 50000.0, "severity": "warning"},
    {"name": "price_decimal_places", "field": "price", "type": "decimal_places", "max_places": 2, "severity": "warning"},
    {"name": "order_date_not_null", "field": "order_date", "type": "not_null", "severity": "critical"},
    {"name": "order_date_valid", "field": "order_date", "type": "date", "severity": "error"},
    {"name": "order_date_not_future", "field": "order_date", "type": "date_range", "severity": "error"},
    {"name": "order_date_not_too_old", "field": "order_date", "type": "date_range", "max_age_days": 1825, "severity": "warning"},
    {"name": "order_date_business_hours", "field": "order_date", "type": "custom", "function": "validate_business_hours", "severity": "info"},
    {"name": "email_format", "field": "customer_email", "type": "regex", "pattern": V.EMAIL_PATTERN, "severity": "error"},
    {"name": "email_domain", "field": "customer_email", "type": "custom", "function": "validate_email_domain", "severity": "warning"},
    {"name": "discount_non_negative", "field": "discount", "type": "range", "min_value": 0, "severity": "error"},
    {"name": "discount_reasonable", "field": "discount", "type": "custom", "function": "validate_discount_vs_price", "severity": "error"},
    {"name": "total_calculation", "field": "total_amount", "type": "custom", "function": "validate_total_calculation", "tolerance": 0.01, "severity": "error"},
    {"name": "order_value_reasonable", "field": "total_amount", "type": "range", "min_value": 0.01, "max_value": 100000.0, "severity": "warning"},
    {"name": "source_consistency", "field": "source", "type": "custom", "function": "validate_source_consistency", "severity": "warning"},
    {"name": "suspicious_duplicates", "type": "field_combination", "fields": ["customer_name", "product", "order_date", "total_amount"], "severity": "warning"},
]
