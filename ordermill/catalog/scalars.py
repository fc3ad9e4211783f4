"""Scalar functions over whole columns of the order views and the documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import categorical as C
from ..functions import dates as D
from ..functions import fixed_values as V
from ..functions import numeric as N
from ..functions import text as X
from ..session import ORDERS_AS_OF
from . import sqltext as S
from .bindings import LINE_ORDER, table
from .registry import query

_KEYS = {"orders_raw": LINE_ORDER, "orders_dirty": LINE_ORDER, "documents": ["doc_id"], "orders": ["o_orderkey"], "events": ["event_id"]}


def scalar(name: str, view: str, outputs: Callable[[], dict[str, Column]], sql: dict[str, str]) -> None:
    """Register a query of the view's keys and the named expressions."""
    keys = _KEYS[view]
    source = "{" + view + "}" if view.startswith("orders_") else view
    text = f"select {', '.join(keys)}, {', '.join(f'{e} as {n}' for n, e in sql.items())} from {source}"

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return table(spark, sf_dir, view).select(*keys, *[c.alias(n) for n, c in outputs().items()])

    query(name, text)(run)


def one(name: str, view: str, make: Callable[[], Column], sql: str) -> None:
    scalar(name, view, lambda: {"value": make()}, {"value": sql})


c = F.col

# --- text ---
one("clean_text", "documents", lambda: X.clean_text(c("text")), S.clean("text"))
one("title_case", "documents", lambda: X.title_case(c("text")), S.title("text"))
one("clean_person_name", "orders_dirty", lambda: X.clean_person_name(c("customer_name")), S.person("customer_name"))
one("fix_titles", "orders_dirty", lambda: X.fix_titles(X.title_case(c("customer_name"))),
    rf"regexp_replace({S.title('customer_name')}, '\b(Dr|Mr|Ms|Mrs)\b\.?', '\1.', 'g')")
_brand = S.title("product")
for _wrong, _right in V.BRAND_CASE.items():
    _brand = f"regexp_replace({_brand}, '{_wrong}', '{_right}', 'gi')"
one("fix_brand_case", "orders_dirty", lambda: X.fix_brand_case(c("product")), _brand)
one("canonical_product", "orders_dirty", lambda: X.canonical_product(c("product")), S.case_map("lower(product)", V.PRODUCT_ALIASES, "product"))
one("canonical_location", "orders_dirty", lambda: X.canonical_location(c("store_location")),
    S.title(S.case_map("lower(store_location)", V.LOCATION_ALIASES, "store_location")))
_bare = r"regexp_replace(lower(customer_email), '\s+', '', 'g')"
_folded = f"split_part({_bare}, '@', 1) || '@' || {S.case_map(f'''split_part({_bare}, '@', 2)''', V.EMAIL_DOMAIN_ALIASES, f'''split_part({_bare}, '@', 2)''')}"
one("normalize_email", "orders_dirty", lambda: X.normalize_email(c("customer_email")), f"case when {S.email_ok(_folded)} then {_folded} end")
one("is_valid_email", "orders_dirty", lambda: X.is_valid_email(c("customer_email")), S.email_ok("customer_email"))
_domain = "case when strpos(customer_email, '@') > 0 then split_part(customer_email, '@', 2) else 'Unknown' end"
scalar("email_domain", "orders_dirty", lambda: {"value": X.email_domain(c("customer_email"))}, {"value": _domain})
one("customer_type", "orders_dirty", lambda: X.customer_type(X.email_domain(c("customer_email"))),
    f"case when ({_domain}) = 'Unknown' then 'Unknown' when ({_domain}) in ({S.quoted(V.PERSONAL_DOMAINS)}) then 'Personal' else 'Business' end")
one("normalize_phone", "orders_dirty", lambda: X.normalize_phone(c("phone")),
    r"regexp_replace(regexp_replace(phone, '[^0-9+\-]', '', 'g'), '^\+?1?-?([0-9]{{3}})-?([0-9]{{3}})-?([0-9]{{4}})$', '+1-\1-\2-\3')".replace("{{", "{").replace("}}", "}"))
_digits = "regexp_replace(phone, '[^0-9]', '', 'g')"
_ten = f"case when length({_digits}) = 10 then {_digits} when length({_digits}) = 11 and {_digits} like '1%' then substr({_digits}, 2) end"
one("normalize_phone_digits", "orders_dirty", lambda: X.normalize_phone_digits(c("phone")),
    f"coalesce('+1-' || substr(({_ten}), 1, 3) || '-' || substr(({_ten}), 4, 3) || '-' || substr(({_ten}), 7, 4), phone)")
_words = f"regexp_extract_all({S.title('address')}, '([0-9A-Za-z_]+|[^0-9A-Za-z_]+)')"
one("normalize_address", "orders_dirty", lambda: X.normalize_address(c("address")),
    f"array_to_string(list_transform({_words}, lambda t: {S.case_map('lower(t)', V.ADDRESS_WORDS, 't')}), '')")
_up = "upper(trim(order_id))"
one("normalize_order_id", "orders_dirty", lambda: X.normalize_order_id(c("order_id")),
    rf"""case when regexp_full_match({_up}, '[A-Z]{{3}}\d{{7}}|[A-Z]{{3}}[-_]\d{{4}}[-_]\d{{3}}|[A-Z]{{3}}\s+\d{{4}}\s+\d{{3}}')
         then substr({_up}, 1, 3) || '-' || substr(regexp_replace({_up}, '[^0-9]', '', 'g'), 1, 4) || '-' || substr(regexp_replace({_up}, '[^0-9]', '', 'g'), 5, 3)
         else {_up} end""")
ID_EXT = r"""case when regexp_full_match(upper(legacy_id), 'ORD-\d\d-\d\d\d')
          then 'ORD-' || case when cast(substr(legacy_id, 5, 2) as int) < 50 then '20' else '19' end || substr(legacy_id, 5)
        when upper(legacy_id) like 'ORD-%' then upper(legacy_id)
        when upper(legacy_id) like 'ORD\_%' escape '\' then replace(upper(legacy_id), '_', '-')
        when upper(legacy_id) like 'ORDER-%' then replace(upper(legacy_id), 'ORDER-', 'ORD-')
        when regexp_full_match(legacy_id, '\d\d\d\d-\d\d\d') then 'ORD-' || legacy_id
        else upper(legacy_id) end"""
one("normalize_order_id_ext", "orders_dirty", lambda: X.normalize_order_id_ext(c("legacy_id")), ID_EXT)
scalar("name_features", "orders_dirty",
       lambda: {"name_length": X.name_length(c("customer_name")), "has_title": X.has_title(X.fix_titles(X.title_case(c("customer_name"))))},
       {"name_length": "length(customer_name)", "has_title": rf"coalesce(regexp_matches({S.title('customer_name')}, '\b(Dr|Mr|Ms|Mrs)\b'), false)"})
one("truncate_text", "documents", lambda: X.truncate_text(c("text"), 100), "case when length(text) <= 100 then text else substr(text, 1, 97) || '...' end")
_styles = {n: f"customer_name = {f('customer_name')}" for n, f in (("lower", lambda x: f"lower({x})"), ("upper", lambda x: f"upper({x})"), ("title", S.title))}
one("case_style", "orders_dirty", lambda: F.when(c("customer_name").isNotNull(), X.case_style(c("customer_name"))),
    "case when customer_name is null then null when lower(customer_name) = upper(customer_name) then 'other' "
    + " ".join(f"when {e} then '{n}'" for n, e in _styles.items()) + " else 'other' end")
one("is_test_name", "orders_dirty", lambda: X.is_test_name(c("customer_name")),
    "(" + " or ".join(f"lower(customer_name) like '%{w}%'" for w in V.TEST_NAME_WORDS_STRICT) + ")")
one("record_hash", "orders_dirty", lambda: X.record_hash(c("order_id"), c("customer_email"), c("product")),
    "substr(md5(coalesce(order_id, '') || coalesce(customer_email, '') || coalesce(product, '')), 1, 8)")
one("product_from_title", "documents", lambda: C.product_from_title(c("text")),
    "case " + " ".join(f"when {' or '.join(f'''lower(text) like '%{w}%' ''' for w in words)} then '{p}'" for words, p in V.TITLE_PRODUCTS)
    + f" else {S.pick_hash('text', V.TITLE_FALLBACK)} end")

# --- numbers ---
one("to_number", "orders_dirty", lambda: N.to_number(c("price")), S.number("price"))
one("strip_currency", "orders_dirty", lambda: N.strip_currency(c("price")), S.currency("price"))
one("round_money", "orders", lambda: N.round_money(c("o_totalprice") / 8), "cast(cast(cast(o_totalprice / 8 as decimal(18,4)) as decimal(18,2)) as double)")
one("round_money_large", "orders", lambda: N.round_money(c("o_totalprice") * 1e13), "o_totalprice * 1e13")
one("to_quantity", "orders_dirty", lambda: N.to_quantity(N.to_number(c("quantity"))), f"cast(round_even({S.number('quantity')}, 0) as bigint)")
one("to_quantity_large", "orders", lambda: N.to_quantity(c("o_totalprice") * 1e6), "cast(round_even(o_totalprice * 1e6, 0) as bigint)")
one("clip", "orders_raw", lambda: N.clip(c("price"), 0, 100).cast("double"), "cast(greatest(least(price, 100), 0) as double)")
one("safe_divide", "orders_raw", lambda: N.safe_divide(c("total_amount"), c("discount"), 0.0), "case when discount = 0 then 0.0 else total_amount / discount end")
one("decimal_places", "orders", lambda: N.has_decimal_places(c("o_totalprice") / 4, 2),
    "cast(o_totalprice / 4 as decimal(30,10)) = cast(cast(o_totalprice / 4 as decimal(30,10)) as decimal(30,2))")

# --- dates ---
one("parse_date", "orders_dirty", lambda: D.parse_date(c("order_date")), S.iso("order_date"))
one("parse_date_multi", "orders_dirty", lambda: D.parse_date_multi(c("order_date")), S.multi_date("order_date"))
one("iso_date", "orders_raw", lambda: D.iso_date(c("order_date")), "strftime(order_date, '%Y-%m-%d')")
scalar("date_parts", "orders_raw", lambda: D.date_parts(c("order_date")),
       {"order_year": "year(order_date)", "order_month": "month(order_date)", "order_day": "day(order_date)", "order_weekday": "dayname(order_date)",
        "order_week_of_year": "week(order_date)", "order_quarter": "quarter(order_date)"})
scalar("calendar_flags", "orders_raw", lambda: D.calendar_flags(c("order_date")),
       {"is_weekend": "isodow(order_date) >= 6", "is_month_end": "last_day(order_date) = cast(order_date as date)", "is_month_start": "day(order_date) = 1"})
one("days_since", "events", lambda: D.days_since(c("ts"), "2024-01-31 00:00:00"), f"cast(floor((epoch_us({S.EVENTS_AS_OF}) - epoch_us(ts)) / 86400000000) as int)")
TIMING = """case when month(order_date) in (6, 7, 8) then 'Summer' when month(order_date) in (11, 12) then 'Holiday Season'
    when isodow(order_date) >= 6 then 'Weekend' else 'Regular' end"""
one("order_timing", "orders_raw", lambda: D.order_timing(c("order_date")), TIMING)
_factor = S.case_map("month(order_date)", V.SEASONAL_FACTORS, "1.0")
SEASON_SQL = {
    "seasonal_factor": f"cast({_factor} as double)", "seasonally_adjusted_amount": f"total_amount / cast({_factor} as double)",
    "season": S.case_map("month(order_date)", V.SEASONS), "is_holiday_season": "coalesce(month(order_date) in (11, 12), false)",
    "is_summer_season": "coalesce(month(order_date) in (6, 7, 8), false)",
}
scalar("season_features", "orders_raw", lambda: D.season_features(F.month("order_date"), c("total_amount")), SEASON_SQL)
one("business_hours", "events", lambda: D.in_business_hours(c("ts")), "hour(ts) >= 8 and hour(ts) < 22")
one("date_format_style", "orders_dirty", lambda: D.date_format_style(c("order_date")),
    "case when strpos(order_date, '-') > 0 then 'dash_separated' when strpos(order_date, '/') > 0 then 'slash_separated' else 'other' end")

# --- categories ---
SIZE = "case when total_amount < 0 then null when total_amount <= 100 then 'Small' when total_amount <= 500 then 'Medium' when total_amount <= 1000 then 'Large' when total_amount <= 2000 then 'XLarge' when total_amount > 2000 then 'Enterprise' end"
SIZE_COMPACT = "case when total_amount <= 0 then null when total_amount <= 100 then 'XSmall' when total_amount <= 500 then 'Small' when total_amount <= 1000 then 'Medium' when total_amount <= 2000 then 'Large' when total_amount > 2000 then 'XLarge' end"
SIZE_FOUR = "case when total_amount <= 0 then null when total_amount <= 500 then 'Small' when total_amount <= 1000 then 'Medium' when total_amount <= 2000 then 'Large' when total_amount > 2000 then 'XLarge' end"
QTY = "case when quantity < 0 then null when quantity <= 1 then 'Single' when quantity <= 3 then 'Few' when quantity <= 5 then 'Several' when quantity <= 10 then 'Many' when quantity > 10 then 'Bulk' end"
VALUE = "case when total_amount is null then 'Unknown' when total_amount < 100 then 'Low' when total_amount < 500 then 'Medium' when total_amount < 1000 then 'High' else 'Premium' end"
SEG_ORDER = "case when total_amount is null then 'Unknown' when total_amount < 200 then 'Budget' when total_amount < 500 then 'Standard' when total_amount < 1000 then 'Premium' else 'VIP' end"
SEG_WIDE = "case when total_amount >= 1500 then 'VIP' when total_amount >= 800 then 'Premium' when total_amount >= 300 then 'Standard' else 'Budget' end"
one("cut_bins", "orders_raw", lambda: C.cut_bins(c("price"), [10, 50, 250, 1000], ["a", "b", "c"]),
    "case when price <= 10 then null when price <= 50 then 'a' when price <= 250 then 'b' when price <= 1000 then 'c' end")
one("order_size_category", "orders_raw", lambda: C.order_size_category(c("total_amount")), SIZE)
scalar("order_size_nb", "orders_raw", lambda: {"five": C.order_size_compact(c("total_amount")), "four": C.order_size_four(c("total_amount"))},
       {"five": SIZE_COMPACT, "four": SIZE_FOUR})
one("quantity_category", "orders_raw", lambda: C.quantity_category(c("quantity")), QTY)
one("order_value_category", "orders_raw", lambda: C.order_value_category(c("total_amount")), VALUE)
one("segment_by_order_nb5", "orders_raw", lambda: C.segment_by_order(c("total_amount")), SEG_ORDER)
one("segment_by_order_nb6", "orders_raw", lambda: C.segment_by_order_wide(c("total_amount")), SEG_WIDE)
_source = S.case_map("lower(source)", V.SOURCE_ALIASES_CLEAN, "lower(source)")
scalar("canonical_source", "orders_dirty",
       lambda: {"cleaned": C.known_source(C.source_clean(c("source"))), "standard": C.source_standard(c("source"))},
       {"cleaned": f"case when {_source} in ({S.quoted(V.VALID_SOURCES)}) then {_source} else 'unknown' end",
        "standard": S.case_map("lower(trim(source))", V.SOURCE_ALIASES_STANDARD, "lower(trim(source))")})
CATEGORY_CLEAN = S.title(S.case_map("lower(product_category)", V.CATEGORY_ALIASES_CLEAN, "lower(product_category)"))
CATEGORY_STANDARD = S.title(S.case_map("lower(trim(product_category))", V.CATEGORY_ALIASES_STANDARD, "lower(trim(product_category))"))
scalar("canonical_category", "orders_dirty",
       lambda: {"cleaned": C.category_clean(c("product_category")), "standard": C.category_standard(c("product_category"))},
       {"cleaned": CATEGORY_CLEAN, "standard": CATEGORY_STANDARD})
one("category_from_product", "orders_dirty", lambda: C.category_from_product(c("product")),
    "case when lower(product) like '%kindle%' or lower(product) like '%book%' then 'Books' "
    "when lower(product) like '%nintendo%' or lower(product) like '%playstation%' or lower(product) like '%xbox%' then 'Gaming' else 'Electronics' end")
one("canonical_segment", "orders_raw", lambda: C.canonical_segment(F.upper(C.segment_by_order(c("total_amount")))),
    S.case_map(f"lower({SEG_ORDER})", V.SEGMENT_ALIASES, f"lower({SEG_ORDER})"))
one("channel_type", "orders_raw", lambda: C.channel_type(c("source")), S.case_map("source", V.CHANNEL_TYPES, "'Other'"))
one("quality_level", "orders_raw", lambda: C.quality_level(c("quantity") * 2),
    "case when quantity * 2 >= 95 then 'excellent' when quantity * 2 >= 85 then 'good' when quantity * 2 >= 70 then 'fair' when quantity * 2 >= 50 then 'poor' else 'critical' end")
one("quality_grade", "orders_raw", lambda: C.quality_grade(c("quantity") * 2),
    "case when quantity * 2 >= 95 then 'A' when quantity * 2 >= 85 then 'B' when quantity * 2 >= 70 then 'C' when quantity * 2 >= 50 then 'D' else 'F' end")
one("risk_category_nb", "orders_raw",
    lambda: C.risk_category(c("total_amount"), F.lit(2001) - F.year("order_date"), X.customer_type(X.email_domain(c("customer_email")))),
    """case when points >= 3 then 'High' when points >= 1 then 'Medium' else 'Low' end""".replace(
        "points", f"(case when total_amount > 1000 then 2 else 0 end + case when 2001 - year(order_date) < 1 then 1 else 0 end - case when split_part(customer_email, '@', 2) not in ({S.quoted(V.PERSONAL_DOMAINS)}) then 1 else 0 end)"))
PRIORITY_POINTS = """(case when total_amount > 1000 then 3 when total_amount > 500 then 2 when total_amount is null then 0 else 1 end
   + case when total_amount >= 1000 then 3 when total_amount >= 500 then 2 when total_amount >= 200 then 1 else 0 end
   + case when {rating} >= 4.5 then 2 when {rating} >= 4.0 then 1 else 0 end)"""
_rating = S.case_map("product", {k: v[2] for k, v in V.PRODUCT_FACTS.items()})
_points = PRIORITY_POINTS.format(rating=_rating)
PRIORITY = f"case when {_points} >= 7 then 'Critical' when {_points} >= 5 then 'High' when {_points} >= 3 then 'Medium' else 'Low' end"
one("order_priority", "orders_raw",
    lambda: C.order_priority(c("total_amount"), C.segment_by_order(c("total_amount")), C.product_facts(c("product"))["product_avg_rating"]), PRIORITY)
