import datetime as dt

import pytest
from pyspark.sql import functions as F

from ordermill.functions import categorical as C
from ordermill.functions import dates as D
from ordermill.functions import numeric as N
from ordermill.functions import text as X


@pytest.mark.parametrize(
    "make, pairs",
    [
        (X.title_case, {"john o'neil 3rd": "John O'Neil 3Rd", "ÉCOLE": "École", "a_b-c": "A_B-C", "": ""}),
        (X.clean_text, {"  a \t b\n": "a b", "nan": None}),
        (X.clean_person_name, {"  alice  johnson ": "Alice Johnson", "mike o'brien2": "Mike O'Brien", "emma-rose davis": "Emma-Rose Davis"}),
        (X.fix_titles, {"Dr Who": "Dr. Who", "Dr. Who": "Dr. Who", "Mrs X": "Mrs. X", "Drake": "Drake"}),
        (X.fix_brand_case, {"AIRPODS PRO": "AirPods Pro", "macbook pro": "MacBook Pro", "iphone 15": "iPhone 15", "xbox series x": "Xbox Series X"}),
        (X.canonical_product, {"PS5": "PlayStation 5", "s24": "Samsung Galaxy S24", "Other": "Other"}),
        (X.canonical_location, {"nyc": "New York", "CHICAGO IL": "Chicago", "san francisco": "San Francisco"}),
        (X.normalize_email, {" Jane@HOTMAIL.com ": "jane@outlook.com", "a b@googlemail.com": "ab@gmail.com", "bad": None}),
        (X.normalize_phone, {"(555) 345-6789": "+1-555-345-6789", "555.234.5678": "+1-555-234-5678", "12345": "12345"}),
        (X.normalize_phone_digits, {"555.234.5678": "+1-555-234-5678", "+1 555 567 8901": "+1-555-567-8901", "123": "123"}),
        (X.normalize_address, {"123 main st, ny": "123 Main Street, New York", "5 n oak blvd": "5 North Oak Boulevard"}),
        (X.normalize_order_id, {"ord2024001": "ORD-2024-001", "ORD_2024_002": "ORD-2024-002", "ORD 2024 003": "ORD-2024-003", "x": "X"}),
        (X.normalize_order_id_ext, {"ord-2024-002": "ORD-2024-002", "ORD_2024_003": "ORD-2024-003", "ORDER-2024-004": "ORD-2024-004", "2024-005": "ORD-2024-005", "ORD-24-008": "ORD-2024-008"}),
        (lambda c: X.truncate_text(c, 5), {"abcdef": "ab...", "abc": "abc"}),
        (X.case_style, {"abc": "lower", "ABC": "upper", "Abc Def": "title", "aBc": "other"}),
        (X.email_domain, {"a@b.com": "b.com", "none": "Unknown"}),
        (N.strip_currency, {"$999.99": 999.99, "1,999.99": 1999.99, "599.99 USD": 599.99, "abc": None}),
        (N.to_number, {"1.5": 1.5, "1e3": 1000.0, "1f": None, "": None}),
        (lambda c: D.iso_date(D.parse_date_multi(c)), {"01/16/2024": "2024-01-16", "17-01-2024": "2024-01-17", "2024/01/18": "2024-01-18", "19 Jan 2024": "2024-01-19", "21/01/24": "2024-01-21", "32/13/2024": None, "x": None}),
        (C.category_from_product, {"MacBook": "Books", "Xbox": "Gaming", "Watch": "Electronics"}),
        (C.category_by_first_key, {"new iphone": "Smartphones", "tv": "Other", None: "Unknown"}),
        (C.source_clean, {"WEB": "website", "shop": "store", "x": "x"}),
        (C.category_standard, {"smart home": "Smart_Home", "tech": "Electronics"}),
    ],
)
def test_text_functions(one, make, pairs):
    assert one(list(pairs), make) == list(pairs.values())


@pytest.mark.parametrize(
    "make, pairs",
    [
        (C.quality_level, {98.0: "excellent", 95.0: "excellent", 94.9: "good", 85.0: "good", 84.9: "fair", 55.0: "poor", 30.0: "critical"}),
        (C.order_size_category, {0.0: "Small", 100.0: "Small", 100.01: "Medium", 2000.0: "XLarge", 2000.5: "Enterprise", -1.0: None}),
        (C.order_size_compact, {0.0: None, 0.5: "XSmall"}),
        (C.segment_by_order, {199.0: "Budget", 200.0: "Standard", 1000.0: "VIP", None: "Unknown"}),
        (lambda c: N.safe_divide(F.lit(1.0), c), {0.0: 0.0, 2.0: 0.5}),
        (N.round_money, {0.125: 0.13, 1.005: 1.01, 2.0: 2.0}),
        (lambda c: N.clip(c, 0, 100).cast("double"), {-1.0: 0.0, 50.0: 50.0, 101.0: 100.0, None: None}),
    ],
)
def test_number_functions(one, make, pairs):
    assert one(list(pairs), make, "double") == list(pairs.values())


def test_dates(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 11, 30),), (dt.datetime(2024, 7, 6),), (None,)], "d timestamp_ntz")
    got = df.select(D.order_timing(F.col("d")), D.days_since(F.col("d"), "2024-12-01 12:00:00"), *D.calendar_flags(F.col("d")).values(), F.col("d").isNull()).collect()
    assert [tuple(r)[:5] for r in got] == [("Holiday Season", 1, True, True, False), ("Summer", 148, True, False, False), ("Regular", None, False, False, False)]


@pytest.mark.parametrize("make", [X.normalize_address, X.normalize_order_id, X.normalize_email, X.fix_brand_case, X.normalize_phone_digits])
def test_idempotent(one, make):
    values = ["  mc donald's 3rd ", "12 n main st, ny", "ord_2024_001", "A.b@GoogleMail.com", "MACBOOK air", "(555) 111-2222"]
    once = one(values, make)
    assert one(once, make) == once


def test_snake_case():
    assert [X.snake_case(c) for c in ("orderId", "Customer Name", "a--b", "XMLFile")] == ["order_id", "customer_name", "a_b", "x_m_l_file"]
