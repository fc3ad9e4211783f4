from pyspark.sql import functions as F

from ordermill.operators import quality as P
from ordermill.operators import rules as R
from ordermill.operators import validation as W

AS_OF = "2024-02-01 00:00:00"


def errors(df):
    return {(r.field, r.type, r.severity) for r in W.validation_errors(df, AS_OF, ["order_id"]).collect()}


def test_clean_rows_score_full(sample_orders):
    r = W.validate_orders(sample_orders, AS_OF).first()
    assert (r.valid_records, r.quality_score, r.quality_level) == (3, 100.0, "excellent")
    assert {x.customer_name for x in W.frequent_names(sample_orders).collect()} == {"John Doe", "Jane Smith", "Bob Johnson"}
    assert W.validation_verdict(sample_orders, AS_OF).first().passed


def test_bad_rows(invalid_orders):
    assert errors(invalid_orders.limit(1)) == {
        ("order_id", "format_error", "medium"), ("customer_name", "required_field_error", "critical"), ("quantity", "business_rule_error", "high"),
        ("price", "business_rule_error", "high"), ("order_date", "business_rule_error", "high"), ("customer_email", "format_error", "medium"),
        ("discount", "business_rule_error", "high"), ("total_amount", "calculation_error", "medium"),
    }
    assert errors(invalid_orders.filter("order_id = 'ORD-2024-004'")) == {
        ("product", "required_field_error", "critical"), ("quantity", "business_rule_error", "low"), ("price", "business_rule_error", "high"),
        ("order_date", "business_rule_error", "low"), ("discount", "business_rule_error", "high"), ("total_amount", "calculation_error", "medium"),
    }
    assert W.validate_orders(invalid_orders, AS_OF).first().quality_score == 0


def test_mixed_types_are_tolerated(spark):
    rows = spark.createDataFrame([("ORD-2024-001", "1", "999.99"), ("ORD-2024-002", "two", "1999.99")], "order_id string, quantity string, price string")
    assert errors(rows) == {("quantity", "data_type_error", "high")}
    assert {r.field: r.affected_records for r in W.type_check(rows).collect()} == {"quantity": 1, "price": 0}


def test_completeness_and_presence(spark):
    rows = spark.createDataFrame([("a", "n"), ("b", None), ("c", "m")], "order_id string, customer_name string")
    w = W.completeness_warnings(rows).first()
    assert (w.field, w.missing_count, round(w.missing_percentage, 1), w.severity) == ("customer_name", 1, 33.3, "medium")
    assert {r.field for r in W.schema_presence(rows).collect()} == {"product", "quantity", "price", "order_date"}
    assert "data" in {r.field for r in W.schema_presence(rows.limit(0)).collect()}


def test_split_keeps_every_row(sample_orders, invalid_orders):
    good, bad = W.quarantine_split(sample_orders.union(invalid_orders), AS_OF)
    assert good.count() == 3 and bad.count() == 2 and bad.filter("reason = ''").count() == 0


def test_issue_scan(spark):
    rows = spark.createDataFrame(
        [("ORD-001", "john doe", 1, 999.99, "john@example.com"), ("", "JANE", -1, 1999.99, "invalid-email"), ("ORD-003", "", 2, -249.99, "b@example.com"), ("ORD-001", "Bob", 0, 599.99, "a@example.com")],
        "order_id string, customer_name string, quantity int, price double, customer_email string",
    )
    got = {(r.issue, r.field): r.n for r in W.issue_scan(rows, rows.columns).collect()}
    assert got == {("empty", "order_id"): 1, ("empty", "customer_name"): 1, ("duplicate", "order_id"): 1, ("non_positive", "quantity"): 2,
                   ("non_positive", "price"): 1, ("invalid", "customer_email"): 1}


def test_schema_roundtrip_and_custom(spark, sample_orders):
    spec = R.schema_from_dicts(R.schema_to_dicts(R.SCHEMAS["orders"]))
    assert spec == R.SCHEMAS["orders"]
    assert R.validate_schema(sample_orders, spec).collect() == []
    short = R.schema_from_dicts([{"name": "source", "allowed": ["store"]}, {"name": "gone", "required": True}])
    got = {(r.field, r.constraint_name): r.failing for r in R.validate_schema(sample_orders.select("source"), short).collect()}
    assert got == {("source", "allowed_values"): 2, ("gone", "missing_required_field"): 3}


def test_rules_skip_nulls(spark):
    rows = spark.createDataFrame([("a", 1.0), (None, None), ("a", 0.001)], "k string, price double")
    rules = [
        {"name": "u", "field": "k", "type": "unique", "severity": "error"}, {"name": "r", "field": "price", "type": "range", "min_value": 0.01, "severity": "error"},
        {"name": "n", "field": "k", "type": "not_null", "severity": "critical"}, {"name": "d", "field": "price", "type": "decimal_places", "max_places": 2, "severity": "warning"},
    ]
    result = R.rule_engine(rows, rules, AS_OF)
    assert {r.rule: r.failing for r in result.collect()} == {"u": 2, "r": 1, "n": 1, "d": 1}
    assert not R.rule_verdict(result, "permissive").first().passed


def test_quality_score_of_good_rows(sample_orders):
    r = P.dq_score(sample_orders, lambda rows: W.business_errors(rows, AS_OF)).first()
    assert (r.completeness, r.validity, r.consistency, r.accuracy, r.uniqueness, r.quality_level) == (100.0, 100.0, 100.0, 100.0, 100.0, "excellent")
    approx = {r.column_name: r.distinct_count for r in P.column_profile(sample_orders, ["order_id", "quantity"], approximate=True).collect()}
    assert approx == {"order_id": 3, "quantity": 2}


def test_constant_column_histogram(spark):
    from ordermill.operators.aggregates import equal_width_histogram

    rows = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert {r.bin: r.n for r in equal_width_histogram(rows, "v", 2).collect()} == {0: 2, 1: 0}
