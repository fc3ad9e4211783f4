"""Row and dataset validation.

Row rules are expressions that yield one error struct or null; all of them are evaluated in one
projection, so the whole check is a single narrow pass over the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import fixed_values as V
from ..functions import numeric as N
from ..functions import text as X
from ..functions.arrays import each_element
from ..functions.categorical import quality_level
from ..session import clock, materialize
from .cleaning import any_date, number, parsed, unparsed
from .dedup import duplicated_keys
from .quality import blank

ROW_SEVERITIES = ["critical", "high", "medium", "low"]


def error(kind: str, field: str, severity: str, message: str, value: Column | None = None) -> Column:
    shown = F.lit(None).cast("string") if value is None else value.cast("string")
    return F.struct(
        F.lit(kind).alias("type"), F.lit(field).alias("field"), F.lit(severity).alias("severity"),
        shown.alias("value"), F.lit(message).alias("message"),
    )


def first_error(field: str, *cases: tuple[Column, str, str, str]) -> Column:
    """The first case that holds: (condition, type, severity, message)."""
    out = None
    for condition, kind, severity, message in cases:
        hit = error(kind, field, severity, message, F.col(field))
        out = F.when(condition, hit) if out is None else out.when(condition, hit)
    return out


def order_rules(df: DataFrame, as_of: str, id_pattern: str = V.ORDER_ID_PATTERN, max_age_days: int = 1825) -> dict[str, Column]:
    """The rule of each order field that is present."""
    have = set(df.columns)

    def num(name: str) -> Column:
        return number(df, name)

    def required(name: str) -> tuple:
        return blank(F.col(name)), "required_field_error", "critical", f"{name} is required"

    def length(name: str) -> Column:
        return F.length(F.trim(F.col(name)))

    rules: dict[str, Column] = {}
    if "order_id" in have:
        rules["order_id"] = first_error(
            "order_id", required("order_id"),
            (~F.trim("order_id").rlike(id_pattern), "format_error", "medium", "order id does not follow the pattern"),
        )
    if "customer_name" in have:
        rules["customer_name"] = first_error(
            "customer_name", required("customer_name"),
            (length("customer_name") < 2, "validation_error", "medium", "customer name is too short"),
            (length("customer_name") > 100, "validation_error", "low", "customer name is too long"),
        )
    if "product" in have:
        rules["product"] = first_error(
            "product", required("product"),
            (length("product") < 2, "validation_error", "medium", "product name is too short"),
        )
    if "quantity" in have:
        q = num("quantity")
        rules["quantity"] = first_error(
            "quantity", (F.col("quantity").isNull(), "required_field_error", "critical", "quantity is required"),
            (q.isNull(), "data_type_error", "high", "quantity is not a number"),
            (q <= 0, "business_rule_error", "high", "quantity must be positive"),
            (q > 1000, "business_rule_error", "low", "quantity is unusually high"),
            (q != F.floor(q), "validation_error", "medium", "quantity should be a whole number"),
        )
    if "price" in have:
        p = num("price")
        rules["price"] = first_error(
            "price", (F.col("price").isNull(), "required_field_error", "critical", "price is required"),
            (p.isNull(), "data_type_error", "high", "price is not a number"),
            (p <= 0, "business_rule_error", "high", "price must be positive"),
            (p > 50000, "business_rule_error", "low", "price is unusually high"),
            (p < 0.01, "validation_error", "medium", "price is too low"),
        )
    if "order_date" in have:
        d = any_date(df, "order_date")
        rules["order_date"] = first_error(
            "order_date", required("order_date"),
            (d.isNull(), "data_type_error", "high", "order date is not a date"),
            (d > clock(as_of), "business_rule_error", "high", "order date is in the future"),
            (d < clock(as_of) - F.expr(f"interval {max_age_days} days"), "business_rule_error", "low", "order date is very old"),
        )
    if "customer_email" in have:
        rules["customer_email"] = first_error(
            "customer_email",
            (~blank(F.col("customer_email")) & ~X.is_valid_email(F.trim("customer_email")), "format_error", "medium", "email is not valid"),
        )
    if "discount" in have:
        x = num("discount")
        cases = [
            (F.col("discount").isNotNull() & x.isNull(), "data_type_error", "medium", "discount is not a number"),
            (x < 0, "business_rule_error", "high", "discount cannot be negative"),
        ]
        if "price" in have:
            cases.append((x > num("price"), "business_rule_error", "high", "discount cannot exceed price"))
        rules["discount"] = first_error("discount", *cases)
    if "total_amount" in have:
        t = num("total_amount")
        cases = [(F.col("total_amount").isNotNull() & t.isNull(), "data_type_error", "medium", "total is not a number")]
        if {"price", "quantity"} <= have:
            off = F.lit(0.0) if "discount" not in have else num("discount")
            # compared as decimals, so one cent is one cent; a missing discount yields no error
            apart = N.differ(t, num("price") * num("quantity") - off, 0.01)
            cases.append((apart, "calculation_error", "medium", "total does not match price, quantity and discount"))
        rules["total_amount"] = first_error("total_amount", *cases)
    return rules


def with_errors(df: DataFrame, rules: dict[str, Column], name: str = "errors") -> DataFrame:
    return df.withColumn(name, F.array_compact(F.array(*rules.values())))


NUMBERS, DATES = ["quantity", "price", "discount", "total_amount"], ["order_date"]


def order_errors(df: DataFrame, as_of: str, **options) -> DataFrame:
    rows = parsed(df, NUMBERS, DATES)
    return unparsed(with_errors(rows, order_rules(rows, as_of, **options)))


def at_least(severity: str) -> list[str]:
    return ROW_SEVERITIES[: ROW_SEVERITIES.index(severity) + 1]


def is_valid(min_severity: str = "low") -> Column:
    """No error of the severity or above."""
    return ~F.exists("errors", lambda e: e["severity"].isin(*at_least(min_severity)))


def quarantine_split(df: DataFrame, as_of: str, min_severity: str = "low") -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reasons); the checked rows are written once for both."""
    return split_checked(materialize(order_errors(df, as_of), "checked"), min_severity)


def split_checked(checked: DataFrame, min_severity: str = "low") -> tuple[DataFrame, DataFrame]:
    """The same for rows that already carry their `errors`."""
    ok = is_valid(min_severity)
    rejected = checked.filter(~ok).withColumn("reason", F.array_join(F.transform("errors", lambda e: e["message"]), "; "))
    return checked.filter(ok).drop("errors"), rejected.drop("errors")


def validate_orders(df: DataFrame, as_of: str, min_severity: str = "low", **options) -> DataFrame:
    """One row: valid and invalid rows, score, level, and errors by severity."""
    checked = order_errors(df, as_of, **options)

    def found(severity: str) -> Column:
        return F.coalesce(F.sum(F.size(F.filter("errors", lambda e: e["severity"] == severity))), F.lit(0))

    per_severity = [found(s).alias(f"{s}_errors") for s in ROW_SEVERITIES]
    counted = checked.agg(
        F.count(F.lit(1)).alias("total_records"), F.count_if(is_valid(min_severity)).alias("valid_records"), *per_severity
    )
    score = N.pct(F.col("valid_records"), F.col("total_records"))
    return counted.withColumns(
        {
            "invalid_records": F.col("total_records") - F.col("valid_records"),
            "quality_score": score,
            "quality_level": quality_level(score),
        }
    )


def validation_errors(df: DataFrame, as_of: str, keys: list[str]) -> DataFrame:
    """Long table of errors, one row each."""
    return each_element(order_errors(df, as_of), "errors", "e").select(*keys, "e.*")


def error_counts(errors: DataFrame) -> DataFrame:
    return errors.groupBy("type", "field", "severity").agg(F.count(F.lit(1)).alias("n"))


def schema_presence(df: DataFrame, required: list[str] = V.REQUIRED_FIELDS) -> DataFrame:
    """One row per missing required column, and one if there is no data."""
    spark = df.sparkSession
    missing = spark.createDataFrame([(c,) for c in required if c not in df.columns], "field string").select(
        F.lit("schema_error").alias("type"), "field", F.lit("critical").alias("severity")
    )
    empty = df.limit(1).agg(F.count(F.lit(1)).alias("n")).filter("n = 0")
    return missing.unionByName(empty.select(F.lit("schema_error").alias("type"), F.lit("data").alias("field"), F.lit("critical").alias("severity")))


def type_check(df: DataFrame, fields: tuple[str, ...] = ("quantity", "price", "discount")) -> DataFrame:
    """Values per numeric field that are missing or not a number."""
    names = [f for f in fields if f in df.columns]
    counted = df.agg(*[F.count_if(number(df, f).isNull()).alias(f) for f in names])
    return counted.unpivot([], names, "field", "affected_records").withColumn("severity", F.lit("high"))


def completeness_warnings(df: DataFrame, fields: list[str] = V.REQUIRED_FIELDS) -> DataFrame:
    names = [f for f in fields if f in df.columns]
    counted = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(f).isNull()).alias(f) for f in names])
    long = counted.unpivot(["total"], names, "field", "missing_count").filter("missing_count > 0")
    share = N.pct(F.col("missing_count"), F.col("total"))
    return long.select("field", "missing_count", share.alias("missing_percentage"), F.when(share > 10, "medium").otherwise("low").alias("severity"))


def frequent_names(df: DataFrame, column: str = "customer_name", share: float = 0.1) -> DataFrame:
    """Values on more than the given share of all rows."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counted.filter(F.col("n") > total * share)


def validation_verdict(df: DataFrame, as_of: str, min_score: float = 50.0, rules_must_pass: bool = False) -> DataFrame:
    """Schema complete and score high enough; optionally also no row error."""
    result = validate_orders(df, as_of)
    schema_ok = schema_presence(df).agg(F.count(F.lit(1)) == 0).scalar()
    passed = schema_ok & (F.col("quality_score") >= min_score)
    if rules_must_pass:
        passed = passed & (F.col("invalid_records") == 0)
    return result.select("total_records", "quality_score", schema_ok.alias("schema_valid"), passed.alias("passed"))


def business_limits(df: DataFrame, as_of: str) -> dict[str, Column]:
    """Tighter limits; missing values are skipped."""
    q, p = number(df, "quantity"), number(df, "price")
    d = any_date(df, "order_date")
    given = {c: ~blank(F.col(c)) for c in df.columns}
    name = F.length("customer_name")
    rules = {
        "order_id": first_error("order_id", (F.col("order_id").isNotNull() & ~F.col("order_id").rlike(V.ORDER_ID_PATTERN), "format_error", "high", "order id does not follow the pattern")),
        "customer_email": first_error("customer_email", (given["customer_email"] & ~X.is_valid_email(F.col("customer_email")), "format_error", "medium", "email is not valid")),
        "price": first_error(
            "price", (F.col("price").isNotNull() & p.isNull(), "data_type_error", "high", "price is not a number"),
            (p < 0.01, "business_rule_error", "high", "price is too low"), (p > 10000, "business_rule_error", "medium", "price is too high"),
        ),
        "quantity": first_error(
            "quantity", (F.col("quantity").isNotNull() & q.isNull(), "data_type_error", "high", "quantity is not a number"),
            (q < 1, "business_rule_error", "high", "quantity is too low"), (q > 100, "business_rule_error", "medium", "quantity is too high"),
        ),
        "customer_name": first_error(
            "customer_name", (given["customer_name"] & (name < 2), "business_rule_error", "medium", "customer name is too short"),
            (given["customer_name"] & (name > 100), "business_rule_error", "low", "customer name is too long"),
        ),
        "order_date": first_error(
            "order_date", (given["order_date"] & d.isNull(), "data_type_error", "high", "order date is not a date"),
            (d > clock(as_of), "business_rule_error", "high", "order date is in the future"),
            (d < clock(as_of) - F.expr("interval 1825 days"), "business_rule_error", "low", "order date is very old"),
        ),
    }
    if "status" in df.columns:
        rules["status"] = first_error(
            "status", (F.col("status").isNotNull() & ~F.lower("status").isin(*V.ORDER_STATUSES), "business_rule_error", "medium", "status is not known")
        )
    return rules


def business_errors(df: DataFrame, as_of: str) -> DataFrame:
    rows = parsed(df, NUMBERS, DATES)
    return unparsed(with_errors(rows, business_limits(rows, as_of)))


def validate_business_rules(df: DataFrame, as_of: str) -> DataFrame:
    """Errors per field and severity, with the duplicate-id and test-name findings as rows of their own."""
    found = each_element(business_errors(df, as_of), "errors", "e").select("e.*")
    counted = error_counts(found)
    dups = duplicated_keys(df.filter(F.col("order_id").isNotNull()), ["order_id"]).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"))
    tests = df.agg(F.count_if(X.is_test_name(F.col("customer_name"), V.TEST_NAME_WORDS)).alias("n"))

    def finding(one: DataFrame, kind: str, field: str, severity: str) -> DataFrame:
        return one.filter("n > 0").select(F.lit(kind).alias("type"), F.lit(field).alias("field"), F.lit(severity).alias("severity"), "n")

    extra = finding(dups, "duplicate_error", "order_id", "high").unionByName(
        finding(tests, "data_quality_warning", "customer_name", "medium")
    )
    return counted.unionByName(extra)


def validate_file_frame(df: DataFrame, required: list[str], min_rows: int = 1) -> DataFrame:
    """One row: size, missing cells, redundant rows, missing columns, columns more than half empty."""
    from .dedup import key_counts, redundant_rows

    total = F.count(F.lit(1))
    nulls = {c: F.count_if(F.col(c).isNull()) for c in df.columns}
    half_empty = reduce(lambda a, b: a + b, [F.when(n > total * 0.5, 1).otherwise(0) for n in nulls.values()])
    missing = [c for c in required if c not in df.columns]
    counted = df.agg(
        total.alias("total_rows"), F.lit(len(df.columns)).alias("total_columns"),
        reduce(lambda a, b: a + b, nulls.values()).alias("missing_values"), half_empty.alias("mostly_empty_columns"),
    )
    copies = key_counts(df, df.columns).agg(redundant_rows())
    return counted.withColumns(
        {
            "duplicate_rows": copies.scalar(),
            "missing_columns": F.lit(", ".join(sorted(missing))),
            "is_valid": (F.col("total_rows") >= min_rows) & F.lit(not missing),
        }
    )


def validate_nb6(df: DataFrame, threshold: float = 80.0) -> DataFrame:
    """Required fields filled, quantity and price positive numbers; passes at the threshold."""
    df = parsed(df, ["quantity", "price"])
    q, p = number(df, "quantity"), number(df, "price")
    filled = [~blank(F.col(c)) for c in ("order_id", "customer_name", "product", "quantity", "price")]
    ok = reduce(lambda a, b: a & b, [*filled, F.coalesce(q > 0, F.lit(False)), F.coalesce(p > 0, F.lit(False))])
    counted = df.agg(F.count(F.lit(1)).alias("total_records"), F.count_if(ok).alias("valid_records"))
    score = N.pct(F.col("valid_records"), F.col("total_records"))
    return counted.withColumns({"quality_score": score, "meets_threshold": score >= threshold})


def validity_flags(df: DataFrame) -> DataFrame:
    ok = F.coalesce(number(df, "price") > 0, F.lit(False)) & F.col("customer_email").isNotNull()
    return df.withColumns({"is_valid": ok, "validation_score": F.when(ok, 100).otherwise(0)})


def issue_scan(df: DataFrame, columns: list[str], key: str = "order_id", email: str = "customer_email") -> DataFrame:
    """Findings as (issue, field, count) rows: empty values, repeated ids, non-positive numbers, bad emails."""
    from .dedup import key_counts, redundant_rows

    q, p = number(df, "quantity"), number(df, "price")
    counts = {f"empty|{c}": F.count_if(F.col(c).isNull() | (F.col(c).cast("string") == "")) for c in columns}
    counts["non_positive|quantity"] = F.count_if(q <= 0)
    counts["non_positive|price"] = F.count_if(p <= 0)
    counts[f"invalid|{email}"] = F.count_if(~F.coalesce(X.is_valid_email(F.col(email)), F.lit(False)))
    one = df.agg(*[c.alias(n) for n, c in counts.items()])
    long = one.unpivot([], list(counts), "name", "n").select(
        F.split_part("name", F.lit("|"), F.lit(1)).alias("issue"), F.split_part("name", F.lit("|"), F.lit(2)).alias("field"), "n"
    )
    dups = key_counts(df, [key]).agg(redundant_rows().cast("bigint").alias("n")).select(F.lit("duplicate").alias("issue"), F.lit(key).alias("field"), "n")
    return long.unionByName(dups).filter("n > 0")
