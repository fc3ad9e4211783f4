"""De-duplication, reads, joins and the composite order transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import categorical as C
from ..functions import fixed_values as V
from ..operators import aggregates as A
from ..operators import cleaning as K
from ..operators import dedup as D
from ..operators import enrich as E
from ..operators import joins as J
from ..operators import ranking as R
from ..operators import reads as Q
from ..operators import standardize as Z
from ..session import ORDERS_AS_OF
from . import sqltext as S
from .bindings import LINE_ORDER, table
from .registry import query
from .scalars import (CATEGORY_CLEAN, CATEGORY_STANDARD, ID_EXT, PRIORITY_POINTS, QTY, SEASON_SQL, SEG_ORDER, SEG_WIDE, SIZE, SIZE_COMPACT, TIMING,
                      VALUE)

RAW_COLUMNS = ["order_id", "customer_name", "product", "quantity", "price", "order_date"]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders_raw")


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders_dirty")


# --- de-duplication ---------------------------------------------------------------------------


def doubled(spark, sf):
    """Order lines of which every fifth is there twice, as a whole row."""
    rows = raw(spark, sf)
    return rows.unionByName(rows.filter(F.col("line_no") % 5 == 0))


_DOUBLED = "(select * from {orders_raw} union all select * from {orders_raw} where line_no % 5 = 0)"


@query("dedup_exact", f"select {S.KEYS}, order_id, customer_name, customer_email, product, source, store_location from {{orders_raw}}")
def dedup_exact(spark, sf):
    return D.dedup_exact(doubled(spark, sf)).select(*LINE_ORDER, "order_id", "customer_name", "customer_email", "product", "source", "store_location")


@query("dedup_by_key", f"select {S.KEYS}, order_id, customer_name, price from {{orders_dirty}} qualify {S.first_per('order_id')}")
def dedup_by_key(spark, sf):
    return D.dedup_by_key(dirty(spark, sf).select(*LINE_ORDER, "order_id", "customer_name", "price"), ["order_id"], LINE_ORDER)


@query("dedup_composite", f"""select {S.KEYS}, customer_name, product, order_date, price from {{orders_dirty}}
       qualify {S.first_per('customer_name, product, order_date, price')}""")
def dedup_composite(spark, sf):
    return D.dedup_composite(dirty(spark, sf).select(*LINE_ORDER, "customer_name", "product", "order_date", "price"), LINE_ORDER)


_DEDUPED = f"""(select * from (select * from {{orders_dirty}} qualify {S.first_per('order_id')})
   qualify {S.first_per('customer_name, product, order_date, price')})"""


@query("dedup_orders", f"select {S.KEYS}, order_id, customer_name, product, order_date, price from {_DEDUPED}")
def dedup_orders(spark, sf):
    return D.dedup_orders(dirty(spark, sf), LINE_ORDER).select(*LINE_ORDER, "order_id", "customer_name", "product", "order_date", "price")


@query("duplicate_keys_report", """with d as (select order_id, count(*) as n from {orders_dirty} group by 1 having count(*) > 1)
  select cast(coalesce(sum(n), 0) as bigint) as affected_records, count(*) as duplicate_keys,
    (select string_agg(order_id, ', ' order by order_id) from (select order_id from d where order_id is not null order by 1 limit 5)) as sample_ids from d""")
def duplicate_keys_report(spark, sf):
    return D.duplicate_keys_report(dirty(spark, sf), "order_id")


@query("duplicate_rows_count", f"""select (select count(*) from {{orders_raw}} where line_no % 5 = 0) as exact_duplicates,
   (select cast(sum(n - 1) as bigint) from (select count(*) as n from {_DOUBLED} where order_id is not null group by order_id)) as key_duplicates""")
def duplicate_rows_count(spark, sf):
    return D.duplicate_rows_count(doubled(spark, sf), "order_id")


@query("suspicious_duplicates", """select customer_name, product, order_date, total_amount, count(*) as n_rows from {orders_dirty}
   group by all having count(*) > 1""")
def suspicious_duplicates(spark, sf):
    return D.suspicious_duplicates(dirty(spark, sf))


@query("union_sources", f"""select {S.KEYS}, order_id, cast(null as varchar) as customer_email, store_location from {{orders_raw}} where source = 'store'
   union all select {S.KEYS}, order_id, customer_email, null from {{orders_raw}} where source <> 'store'""")
def union_sources(spark, sf):
    rows = raw(spark, sf)
    stores = rows.filter("source = 'store'").select(*LINE_ORDER, "order_id", "store_location")
    others = rows.filter("source <> 'store'").select(*LINE_ORDER, "order_id", "customer_email")
    return D.union_sources([stores, others])


# --- reads ------------------------------------------------------------------------------------


@query("get_orders", f"""select {S.KEYS}, order_id, source, store_location, total_amount, order_date from {{orders_raw}}
   where source in ('website', 'store') and store_location = 'Chicago' order by order_date desc, {S.KEYS} limit 100 offset 20""")
def get_orders(spark, sf):
    found = Q.get_orders(raw(spark, sf), {"source": ["website", "store"], "store_location": "Chicago"}, 100, 20, [F.desc("order_date"), *LINE_ORDER])
    return found.select(*LINE_ORDER, "order_id", "source", "store_location", "total_amount", "order_date")


@query("recent_rows", "select event_id, ts, event_type, value from events where ts >= timestamp '2024-01-30 00:00:00' - interval 24 hours")
def recent_rows(spark, sf):
    return Q.recent_rows(table(spark, sf, "events"), "ts", 24, "2024-01-30 00:00:00").select("event_id", "ts", "event_type", "value")


@query("top_runs", "select event_id, run_id, job_id, ts, status from {run_events} where job_id = 'J3' order by ts desc, event_id desc limit 50")
def top_runs(spark, sf):
    runs = Q.top_runs(table(spark, sf, "run_events"), 50, [F.desc("ts"), F.desc("event_id")], "J3")
    return runs.select("event_id", "run_id", "job_id", "ts", "status")


@query("top_values", "select product, count(*) as n from {orders_dirty} where product is not null group by 1 order by n desc, product limit 10")
def top_values(spark, sf):
    return Q.top_values(dirty(spark, sf), "product", 10)


@query("custom_sql", "select store_location, count(*) as n, max(quantity) as top_quantity from {orders_raw} where quantity >= 10 and source = 'phone' group by 1")
def custom_sql(spark, sf):
    text = "select store_location, count(*) as n, max(quantity) as top_quantity from {lines} where quantity >= :low and source = :source group by 1"
    return Q.custom_sql(spark, text, {"lines": raw(spark, sf)}, {"low": 10, "source": "phone"})


_BUCKET = "cast('0x' || substr(md5('7|' || {extra}cast(order_key as varchar) || '|' || line_no || '|' || part_key || '|' || supp_key || '|' || amount_key), 1, 15) as bigint) < {limit}"


@query("sample_rows", f"""select {S.KEYS}, 'random' as method from {{orders_raw}} where {_BUCKET.format(extra='', limit=115292150460684704)}
   union all select {S.KEYS}, 'stratified' from {{orders_raw}} where {_BUCKET.format(extra="source || '|' || ", limit=115292150460684704)}
   union all select {S.KEYS}, 'systematic' from (select *, row_number() over (order by {S.KEYS}) - 1 as p from {{orders_raw}}) where floor((p + 1) * 0.1e0) > floor(p * 0.1e0)""")
def sample_rows(spark, sf):
    rows = raw(spark, sf)
    picks = {
        "random": Q.sample_rows(rows, "random", LINE_ORDER, 0.1, 7),
        "stratified": Q.sample_rows(rows, "stratified", LINE_ORDER, 0.1, 7, strata="source"),
        "systematic": Q.sample_rows(rows.select(*LINE_ORDER), "systematic", LINE_ORDER, 0.1),
    }
    return D.union_sources([df.select(*LINE_ORDER, F.lit(name).alias("method")) for name, df in picks.items()])


@query("sample_fractions", f"""select {S.KEYS}, 'random 0.0005' as method from {{orders_raw}} where {_BUCKET.format(extra='', limit=576460752303423)}
   union all select {S.KEYS}, 'random 0.0015' from {{orders_raw}} where {_BUCKET.format(extra='', limit=1729382256910270)}
   union all select {S.KEYS}, 'systematic ' || f from (select *, row_number() over (order by {S.KEYS}) - 1 as p from {{orders_raw}}), (values (0.3e0, '0.3'), (0.4e0, '0.4'), (0.7e0, '0.7')) v(x, f)
     where floor((p + 1) * x) > floor(p * x)""")
def sample_fractions(spark, sf):
    rows = raw(spark, sf).select(*LINE_ORDER)
    picks = [("random", x) for x in (0.0005, 0.0015)] + [("systematic", x) for x in (0.3, 0.4, 0.7)]
    return D.union_sources([Q.sample_rows(rows, how, LINE_ORDER, x, 7).select(*LINE_ORDER, F.lit(f"{how} {x}").alias("method")) for how, x in picks])


@query("retain_complete", f"""select {S.KEYS}, order_id, customer_name, product, price from {{orders_dirty}}
   where order_id is not null and customer_name is not null and product is not null and price is not null""")
def retain_complete(spark, sf):
    return Q.retain_complete(dirty(spark, sf)).select(*LINE_ORDER, "order_id", "customer_name", "product", "price")


@query("update_where", f"""select {S.KEYS}, case when source = 'store' and store_location in ('Chicago', 'Dallas') then 'reviewed' else status end as status,
   case when source = 'store' and store_location in ('Chicago', 'Dallas') then 1.5e0 else discount end as discount from {{orders_raw}}""")
def update_where(spark, sf):
    out = Q.update_where(raw(spark, sf), {"status": "reviewed", "discount": 1.5}, {"source": "store", "store_location": ["Chicago", "Dallas"]})
    return out.select(*LINE_ORDER, "status", "discount")


@query("delete_where", f"select {S.KEYS}, source, status from {{orders_dirty}} where not coalesce(source = 'phone' and status = 'shipped', false)")
def delete_where(spark, sf):
    return Q.delete_where(dirty(spark, sf), {"source": "phone", "status": "shipped"}).select(*LINE_ORDER, "source", "status")


@query("retention_delete", """select alert_id, 'kept' as part from {alerts} where not coalesce(status = 'RESOLVED' and resolved_at < timestamp '2024-01-31 00:00:00' - interval 15 days, false)
   union all select alert_id, 'expired' from {alerts} where status = 'RESOLVED' and resolved_at < timestamp '2024-01-31 00:00:00' - interval 15 days""")
def retention_delete(spark, sf):
    kept, expired = Q.retention_split(table(spark, sf, "alerts"), "resolved_at", 15, "2024-01-31 00:00:00", F.col("status") == "RESOLVED")
    return kept.select("alert_id", F.lit("kept").alias("part")).unionByName(expired.select("alert_id", F.lit("expired").alias("part")))


@query("date_window_filter", f"""select {S.KEYS}, order_date from {{orders_dirty}} where coalesce({S.iso('order_date')} <= {S.AS_OF}
   and {S.iso('order_date')} >= {S.AS_OF} - interval 3650 days, true)""")
def date_window_filter(spark, sf):
    rows = dirty(spark, sf).select(*LINE_ORDER, "order_date").withColumn("parsed", K.D.parse_date(F.col("order_date")))
    return K.date_window_filter(rows, ORDERS_AS_OF, column="parsed").drop("parsed")


@query("fill_defaults", f"""select {S.KEYS}, coalesce(quantity, '1') as quantity, coalesce(discount, '0') as discount, coalesce(source, 'unknown') as source,
   coalesce(product_category, 'Electronics') as product_category, coalesce(status, 'pending') as status from {{orders_dirty}}""")
def fill_defaults(spark, sf):
    defaults = {"quantity": "1", "discount": "0", "source": "unknown", "product_category": "Electronics", "status": "pending"}
    return K.fill_defaults(dirty(spark, sf).select(*LINE_ORDER, *defaults), defaults)


@query("snake_case_columns", "select n_nationkey as nation_key, n_name as nation_name, n_regionkey as region_key_2 from nation")
def snake_case_columns(spark, sf):
    nation = table(spark, sf, "nation").toDF("NationKey", "nationName", "region-Key (2)")
    return Z.snake_case_columns(nation)


# --- joins and lookups ------------------------------------------------------------------------


@query("orders_with_customer_tier", """select tier, sum(cast(round(total_amount * 100) as bigint)) / 100.0 as revenue, count(*) as orders
   from {orders_raw} join {customers} using (customer_id) where tier is not null group by 1""")
def orders_with_customer_tier(spark, sf):
    return J.revenue_by_tier(raw(spark, sf), table(spark, sf, "customers"))


_SEGMENTS = f"""select customer_name, sum({S.cents('total_amount')}) / 100.0 as spent, count(*) as n, min(order_date) as first_order,
    max(order_date) as last_order, {S.mean_money('total_amount')} as avg_value from {{rows}} group by 1"""
_SEGMENT = "case when spent >= 5000 and n >= 10 then 'VIP' when spent >= 2000 and n >= 5 then 'Premium' when spent >= 500 and n >= 2 then 'Standard' else 'Budget' end"


@query("segment_back_join", f"""with s as ({_SEGMENTS.format(rows='{orders_raw}')}) select {S.KEYS}, {_SEGMENT} as customer_segment, spent as customer_ltv,
   case {_SEGMENT} when 'VIP' then 1 when 'Premium' then 2 when 'Standard' then 3 else 4 end as customer_priority from {{orders_raw}} join s using (customer_name)""")
def segment_back_join(spark, sf):
    return J.segment_back_join(raw(spark, sf)).select(*LINE_ORDER, "customer_segment", "customer_ltv", "customer_priority")


@query("segment_by_customer", f"with s as ({_SEGMENTS.format(rows='{orders_raw}')}) select customer_name, {_SEGMENT} as segment from s")
def segment_by_customer(spark, sf):
    totals = J.customer_totals(raw(spark, sf))
    return totals.select("customer_name", C.segment_by_customer(F.col("total_spent"), F.col("order_count")).alias("segment"))


@query("lookup_exact", f"""select {S.KEYS}, {S.case_map('product', {k: v[0] for k, v in V.PRODUCT_FACTS.items()}, "'Unknown'")} as product_brand,
   {S.case_map('product', {k: v[1] for k, v in V.PRODUCT_FACTS.items()})} as product_release_year,
   cast({S.case_map('product', {k: v[2] for k, v in V.PRODUCT_FACTS.items()})} as double) as product_avg_rating from {{orders_dirty}}""")
def lookup_exact(spark, sf):
    return dirty(spark, sf).select(*LINE_ORDER, *[c.alias(n) for n, c in C.product_facts(F.col("product")).items()])


def _last_match(i: int, default: str, c: str = "product") -> str:
    whens = " ".join(f"when lower({c}) like '%{p.lower()}%' then {S.lit(t[i])}" for p, t in reversed(V.PRODUCT_CATALOG.items()))
    return f"case {whens} else {default} end"


_TRAITS = f"""{_last_match(0, "'Unknown'")} as product_brand, {_last_match(1, "'Unknown'")} as product_subcategory,
   {_last_match(2, "'Unknown'")} as price_tier, {_last_match(3, '50')} as popularity_score"""


@query("lookup_contains_last", f"select {S.KEYS}, {_TRAITS} from {{orders_dirty}}")
def lookup_contains_last(spark, sf):
    return dirty(spark, sf).select(*LINE_ORDER, *[c.alias(n) for n, c in C.product_traits(F.col("product")).items()])


_FIRST_KEY = "case when product is null then 'Unknown' " + " ".join(
    f"when lower(product) like '%{k.lower()}%' then '{v}'" for k, v in V.PRODUCT_CATEGORY_KEYS.items()) + " else 'Other' end"


@query("lookup_contains_first", f"select {S.KEYS}, {_FIRST_KEY} as product_category from {{orders_dirty}}")
def lookup_contains_first(spark, sf):
    return dirty(spark, sf).select(*LINE_ORDER, C.category_by_first_key(F.col("product")).alias("product_category"))


@query("map_values", f"select {S.KEYS}, {S.case_map('source', V.SOURCE_CATEGORIES)} as source_category, {S.case_map('source', V.CHANNEL_TYPES, chr(39) + 'Other' + chr(39))} as channel from {{orders_dirty}}")
def map_values(spark, sf):
    mapped = J.map_values(dirty(spark, sf), "source", V.SOURCE_CATEGORIES, "source_category")
    return J.map_values(mapped, "source", V.CHANNEL_TYPES, "channel", "Other").select(*LINE_ORDER, "source_category", "channel")


@query("route_notifications", """select alert_id, severity, channel from {alerts}
   join (values ('log', 1), ('console', 2), ('slack', 3), ('email', 3), ('webhook', 4)) c(channel, threshold)
   on case severity when 'LOW' then 1 when 'MEDIUM' then 2 when 'HIGH' then 3 else 4 end >= threshold""")
def route_notifications(spark, sf):
    return J.route_notifications(table(spark, sf, "alerts").select("alert_id", "severity"))


@query("orphan_notifications", """with kept as (select alert_id from {alerts} where not coalesce(status = 'RESOLVED' and resolved_at < timestamp '2024-01-16 00:00:00', false))
   select event_id as notification_id, event_id as alert_id from events where event_id not in (select alert_id from kept)""")
def orphan_notifications(spark, sf):
    kept, _ = Q.retention_split(table(spark, sf, "alerts"), "resolved_at", 15, "2024-01-31 00:00:00", F.col("status") == "RESOLVED")
    sent = table(spark, sf, "events").select(F.col("event_id").alias("notification_id"), F.col("event_id").alias("alert_id"))
    return J.orphans(sent, kept, "alert_id")


# --- order-dependent --------------------------------------------------------------------------


@query("revenue_contribution_pct", f"select {S.KEYS}, round(total_amount / (select sum({S.cents('total_amount')}) / 100.0 from {{orders_raw}}) * 100, 2) as revenue_contribution_pct from {{orders_raw}}")
def revenue_contribution_pct(spark, sf):
    return E.revenue_contribution(raw(spark, sf)).select(*LINE_ORDER, "revenue_contribution_pct")


@query("sequential_record_id", f"select {S.KEYS}, order_id, row_number() over (order by {S.KEYS}) as record_id from {{orders_raw}}")
def sequential_record_id(spark, sf):
    return R.sequential_id(raw(spark, sf).select(*LINE_ORDER, "order_id"), LINE_ORDER)


@query("quantile_threshold", "select quantile_cont(total_amount, 0.95) as total_amount_q, cast(quantile_cont(cast(quantity as double), 0.95) as double) as quantity_q from {orders_raw}")
def quantile_threshold(spark, sf):
    rows = raw(spark, sf)
    return E.quantile_threshold(rows, "total_amount").withColumn("quantity_q", E.quantile_threshold(rows, "quantity").scalar())


# --- composite transforms ---------------------------------------------------------------------

_TYPED = f"""(select {S.KEYS}, order_id, {S.person('customer_name')} as customer_name, lower({S.clean('product')}) as lp, {S.clean('product')} as sp,
    {S.clean('store_location')} as sl, {S.clean('notes')} as notes, lower({S.clean('source')}) as src, product_category,
    {S.number('quantity')} as quantity, {S.number('price')} as price, {S.number('discount')} as discount, {S.number('total_amount')} as total_amount,
    {S.iso('order_date')} as order_date, case when {S.email_ok('lower(trim(customer_email))')} then lower(trim(customer_email)) end as customer_email
  from {{source}})"""
_KEPT = f"""(select {S.KEYS}, order_id, customer_name, {S.case_map('lp', V.PRODUCT_ALIASES, 'sp')} as product,
    {S.title(S.case_map('lower(sl)', V.LOCATION_ALIASES, 'sl'))} as store_location, notes,
    {S.case_map('src', V.SOURCE_ALIASES_CLEAN, 'src')} as source, coalesce(product_category, 'Electronics') as product_category,
    cast(round_even(coalesce(quantity, 1), 0) as bigint) as quantity, coalesce(quantity, 1) as q0, {S.money('price')} as price,
    {S.money('greatest(coalesce(discount, 0), 0)')} as discount, {S.money('total_amount')} as total_amount, order_date, customer_email
  from {_TYPED}
  where order_id is not null and customer_name is not null and sp is not null and price is not null
    and coalesce(quantity, 1) > 0 and price > 0 and total_amount >= 0
    and coalesce(order_date <= {S.AS_OF} and order_date >= {S.AS_OF} - interval 3650 days, true))"""


def clean_sql(source: str) -> str:
    """The cleaning of any dirty rows, as DuckDB SQL."""
    kept = _KEPT.replace("{source}", source)
    return f"""(select {S.KEYS}, order_id, customer_name, product, store_location, notes, customer_email, quantity, price, discount, total_amount, order_date,
      case when source in ({S.quoted(V.VALID_SOURCES)}) then source else 'unknown' end as source, {CATEGORY_CLEAN} as product_category,
      greatest(0.0, 100.0 - 5 * (case when customer_email is null then 1 else 0 end + case when store_location is null then 1 else 0 end
        + case when {CATEGORY_CLEAN} is null then 1 else 0 end + case when notes is null then 1 else 0 end + case when quantity > 10 then 1 else 0 end
        + case when price > 5000 then 1 else 0 end) - case when length(customer_name) < 5 then 10 else 0 end)::double as data_quality_score
    from {kept} k where not (quantity * price > 100000) and length(customer_name) >= 2
      and not regexp_matches(lower(customer_name), '{'|'.join(V.TEST_NAME_WORDS_STRICT)}'))"""


CLEANED_COLUMNS = ["order_id", "customer_name", "product", "store_location", "notes", "customer_email", "quantity", "price", "discount", "total_amount",
                   "order_date", "source", "product_category", "data_quality_score"]
CLEANED = clean_sql(_DEDUPED)


def cleaned(spark: SparkSession, sf: str, slices: int | None = None) -> DataFrame:
    orders = dirty(spark, sf).drop("seq", "legacy_id", "status", "phone", "address")
    return K.clean_orders(orders, ORDERS_AS_OF, LINE_ORDER, slices)


@query("clean_orders", f"select {S.KEYS}, {', '.join(CLEANED_COLUMNS)} from {CLEANED}")
def clean_orders(spark, sf):
    return cleaned(spark, sf).select(*LINE_ORDER, *CLEANED_COLUMNS)


@query("record_quality_score", f"select {S.KEYS}, data_quality_score from {clean_sql('{orders_dirty}')}")
def record_quality_score(spark, sf):
    rows = K.clean_rows(dirty(spark, sf), ORDERS_AS_OF)
    return rows.select(*LINE_ORDER, "data_quality_score")


@query("record_quality_nb6", f"""select {S.KEYS}, greatest(0, 100 - case when {S.blank('customer_email')} then 10 else 0 end - case when {S.blank('store_location')} then 10 else 0 end
   - case when length(customer_name) < 3 then 15 else 0 end - case when {S.number('total_amount')} > 5000 then 5 else 0 end) as score from {{orders_dirty}}""")
def record_quality_nb6(spark, sf):
    rows = dirty(spark, sf)
    typed = rows.withColumn("total_amount", K.number(rows, "total_amount"))
    return typed.select(*LINE_ORDER, K.record_quality_compact(typed).alias("score"))


_FILLED = " + ".join(f"case when {S.blank(f)} then 0 else 1 end" for f in ["order_id", "customer_name", "product", "quantity", "price"])


@query("record_completeness", f"""select *, case when score >= 95 then 'A' when score >= 85 then 'B' when score >= 70 then 'C' when score >= 50 then 'D' else 'F' end as grade
   from (select {S.KEYS}, ({_FILLED}) * 100.0e0 / 5 as score from {{orders_dirty}})""")
def record_completeness(spark, sf):
    rows = dirty(spark, sf)
    scored = rows.select(*LINE_ORDER, K.record_completeness(rows, ["order_id", "customer_name", "product", "quantity", "price"]).alias("score"))
    return scored.withColumn("grade", C.quality_grade(F.col("score")))


# the tutorial variants read columns under their own names
_NB_COLUMNS = ["order_id", "legacy_id", "customer_name", "customer_email", "product", "quantity", "price", "order_date", "status", "phone"]


def nb_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = dirty(spark, sf).select(*LINE_ORDER, *_NB_COLUMNS)
    return rows.drop("order_id").withColumnsRenamed({"legacy_id": "order_id", "product": "product_name", "phone": "phone_number"})


_NB_BRAND = S.title(S.squeeze("product"))
for _wrong, _right in V.BRAND_CASE.items():
    _NB_BRAND = f"regexp_replace({_NB_BRAND}, '{_wrong}', '{_right}', 'gi')"
_TEN_DIGITS = "regexp_replace(phone, '[^0-9]', '', 'g')"
_PHONE = f"""case when length({_TEN_DIGITS}) = 10 then '+1-' || substr({_TEN_DIGITS}, 1, 3) || '-' || substr({_TEN_DIGITS}, 4, 3) || '-' || substr({_TEN_DIGITS}, 7, 4)
    when length({_TEN_DIGITS}) = 11 and {_TEN_DIGITS} like '1%' then '+1-' || substr({_TEN_DIGITS}, 2, 3) || '-' || substr({_TEN_DIGITS}, 5, 3) || '-' || substr({_TEN_DIGITS}, 8, 4)
    else phone end"""
NB_CLEAN = rf"""(select {S.KEYS}, legacy_id as order_id, regexp_replace({S.title(S.squeeze('customer_name'))}, '\b(Dr|Mr|Ms|Mrs)\b\.?', '\1.', 'g') as customer_name,
    {_NB_BRAND} as product_name, coalesce(lower({S.squeeze('status')}), 'pending') as status, trim(lower(customer_email)) as customer_email,
    {S.currency('price')} as price, coalesce(cast(round_even({S.number('quantity')}, 0) as int), 1) as quantity, {S.multi_date('order_date')} as order_date,
    {_PHONE} as phone_number from {{orders_dirty}})"""


@query("clean_orders_nb", f"select * from {NB_CLEAN}")
def clean_orders_nb(spark, sf):
    return K.clean_orders_nb(nb_rows(spark, sf))


_CHANGED = ["customer_name", "product_name", "customer_email", "phone_number", "status"]


@query("clean_orders_nb_changes", f"with b as (select {S.KEYS}, customer_name as b1, product as b2, customer_email as b3, phone as b4, status as b5 from {{orders_dirty}}), a as {NB_CLEAN} "
       + " union all ".join(f"select '{f}' as field, count(*) filter (where {f} is distinct from b{i + 1}) as changed from a join b using ({S.KEYS})" for i, f in enumerate(_CHANGED)))
def clean_orders_nb_changes(spark, sf):
    before = nb_rows(spark, sf)
    return K.change_counts(before, K.clean_orders_nb(before), LINE_ORDER, _CHANGED)


_STD_BRAND = S.title(S.clean("product"))
for _wrong, _right in V.BRAND_CASE.items():
    _STD_BRAND = f"regexp_replace({_STD_BRAND}, '{_wrong}', '{_right}', 'gi')"
_SQUASHED = r"regexp_replace(lower(customer_email), '\s+', '', 'g')"
_HOST = f"split_part({_SQUASHED}, '@', 2)"
_MAIL = f"split_part({_SQUASHED}, '@', 1) || '@' || {S.case_map(_HOST, V.EMAIL_DOMAIN_ALIASES, _HOST)}"
_UP = "upper(trim(order_id))"
_ID_DIGITS = f"regexp_replace({_UP}, '[^0-9]', '', 'g')"
STANDARD_ID = rf"""case when regexp_full_match({_UP}, '[A-Z]{{3}}\d{{7}}|[A-Z]{{3}}[-_]\d{{4}}[-_]\d{{3}}|[A-Z]{{3}}\s+\d{{4}}\s+\d{{3}}')
    then substr({_UP}, 1, 3) || '-' || substr({_ID_DIGITS}, 1, 4) || '-' || substr({_ID_DIGITS}, 5, 3) else {_UP} end"""
def address_sql(text: str) -> str:
    runs = f"regexp_extract_all({S.title(text)}, '([0-9A-Za-z_]+|[^0-9A-Za-z_]+)')"
    return f"array_to_string(list_transform({runs}, lambda t: {S.case_map('lower(t)', V.ADDRESS_WORDS, 't')}), '')"


_ADDRESS = address_sql("trim(address)")
_PHONE_STD = r"regexp_replace(regexp_replace(phone, '[^0-9+\-]', '', 'g'), '^\+?1?-?([0-9]{3})-?([0-9]{3})-?([0-9]{4})$', '+1-\1-\2-\3')"


@query("standardize_orders", f"""select {S.KEYS}, {STANDARD_ID} as order_id, {S.title(S.clean('customer_name'))} as customer_name, {_STD_BRAND} as product,
    {address_sql(S.clean('store_location'))} as store_location, {S.title(S.clean('notes'))} as notes, case when {S.email_ok(_MAIL)} then {_MAIL} end as customer_email,
    {_PHONE_STD} as phone, {_ADDRESS} as address, {S.case_map('lower(trim(source))', V.SOURCE_ALIASES_STANDARD, 'lower(trim(source))')} as source,
    {CATEGORY_STANDARD} as product_category, strftime({S.iso('order_date')}, '%Y-%m-%d') as order_date, {S.money(S.currency('price'))} as price,
    {S.money(S.currency('discount'))} as discount, {S.money(S.currency('total_amount'))} as total_amount,
    cast(round_even({S.currency("quantity")}, 0) as bigint) as quantity from {{orders_dirty}}""")
def standardize_orders(spark, sf):
    rows = dirty(spark, sf).drop("seq", "legacy_id", "status")
    return Z.standardize_orders(rows, ORDERS_AS_OF).drop("standardized_at", "standardization_version")


_NB_DOMAIN = "case when strpos(customer_email, '@') > 0 then split_part(customer_email, '@', 2) else 'Unknown' end"
NB_STANDARD = f"""(select c.* replace ({ID_EXT.replace('legacy_id', 'order_id')} as order_id), {_FIRST_KEY.replace('product', 'product_name')} as product_category,
    {_NB_DOMAIN} as customer_domain, {S.money('price * quantity')} as total_amount,
    case when ({_NB_DOMAIN}) = 'Unknown' then 'Unknown' when ({_NB_DOMAIN}) in ({S.quoted(V.PERSONAL_DOMAINS)}) then 'Personal' else 'Business' end as customer_type
  from {NB_CLEAN} c)"""


@query("standardize_orders_nb", f"""select *, {VALUE} as order_value_category,
   substr(md5(coalesce(order_id, '') || coalesce(customer_email, '') || coalesce(product_name, '')), 1, 8) as record_hash from {NB_STANDARD}""")
def standardize_orders_nb(spark, sf):
    return Z.standardize_orders_nb(K.clean_orders_nb(nb_rows(spark, sf)))


@query("financials", f"""select {S.KEYS}, total_amount, total_amount / quantity as unit_price_after_discount,
   case when quantity * price = 0 then 0.0 else discount / (quantity * price) end * 100 as discount_percentage, total_amount * 0.30e0 as estimated_profit from {{orders_raw}}""")
def financials(spark, sf):
    rows = raw(spark, sf).drop("total_amount")
    return E.financials(rows).select(*LINE_ORDER, "total_amount", "unit_price_after_discount", "discount_percentage", "estimated_profit")


ENRICHED_SQL = {
    "unit_price_after_discount": "total_amount / quantity",
    "discount_percentage": "discount / (quantity * price) * 100",
    "estimated_profit": "total_amount * 0.30e0",
    "order_year": "year(order_date)", "order_month": "month(order_date)", "order_day": "day(order_date)", "order_weekday": "dayname(order_date)",
    "order_week_of_year": "week(order_date)", "order_quarter": "quarter(order_date)", "is_weekend": "coalesce(isodow(order_date) >= 6, false)",
    "is_month_end": "coalesce(last_day(order_date) = cast(order_date as date), false)", "is_month_start": "coalesce(day(order_date) = 1, false)",
    "days_since_order": f"cast(floor((epoch_us({S.AS_OF}) - epoch_us(order_date)) / 86400000000) as int)", "order_timing": TIMING,
    "order_size_category": SIZE, "quantity_category": QTY, "channel_type": S.case_map("source", V.CHANNEL_TYPES, "'Other'"),
    **SEASON_SQL,
}


def enriched_sql(source: str) -> str:
    derived = ", ".join(f"{e} as {n}" for n, e in ENRICHED_SQL.items())
    score = """least(100, 50 + case when total_amount > p_amount then 20 else 0 end + case when quantity > p_quantity then 15 else 0 end
       + case when customer_segment = 'Budget' then 10 else 0 end + case when is_weekend then 5 else 0 end + case when discount_percentage > 20 then 15 else 0 end)"""
    return f"""(with base as materialized (select * from {source}),
      seg as ({_SEGMENTS.format(rows='base')}),
      lim as (select quantile_cont(total_amount, 0.95) as p_amount, quantile_cont(cast(quantity as double), 0.95) as p_quantity,
                sum({S.cents('total_amount')}) / 100.0 as revenue from base),
      e as (select base.*, {_TRAITS}, {derived}, {_SEGMENT} as customer_segment, spent as customer_ltv,
              case {_SEGMENT} when 'VIP' then 1 when 'Premium' then 2 when 'Standard' then 3 else 4 end as customer_priority,
              round(total_amount / revenue * 100, 2) as revenue_contribution_pct, p_amount, p_quantity
            from base join seg using (customer_name) cross join lim)
      select e.* exclude (p_amount, p_quantity), {score} as risk_score,
        case when {score} <= 30 then 'Low' when {score} <= 60 then 'Medium' when {score} <= 80 then 'High' else 'Critical' end as risk_level from e)"""


@query("enrich_orders", f"select * from {enriched_sql(CLEANED)}")
def enrich_orders(spark, sf):
    rows = cleaned(spark, sf, slices=4).select(*LINE_ORDER, *CLEANED_COLUMNS)
    return E.enrich_orders(rows, ORDERS_AS_OF, written=True).drop("enriched_at", "enrichment_version")


_RISK_RAW = f"select {S.KEYS}, risk_score, risk_level from {enriched_sql('{orders_raw}')}"


@query("risk_score", _RISK_RAW)
def risk_score(spark, sf):
    return E.enrich_orders(raw(spark, sf), ORDERS_AS_OF).select(*LINE_ORDER, "risk_score", "risk_level")


_NB_RATING = S.case_map("product_name", {k: v[2] for k, v in V.PRODUCT_FACTS.items()})
_NB_YEAR = S.case_map("product_name", {k: v[1] for k, v in V.PRODUCT_FACTS.items()})
_NB_POINTS = PRIORITY_POINTS.format(rating=_NB_RATING)
_NB_FILLED = " + ".join(f"case when {f} is null or trim(cast({f} as varchar)) = '' then 0 else 1 end" for f in K.COMPLETENESS_FIELDS)
_NB_RISK = f"(case when total_amount > 1000 then 2 else 0 end + case when 2001 - {_NB_YEAR} < 1 then 1 else 0 end - case when customer_type = 'Business' then 1 else 0 end)"
NB_ENRICHED = f"""(select *, case when data_completeness_score >= 95 then 'A' when data_completeness_score >= 85 then 'B' when data_completeness_score >= 70 then 'C'
     when data_completeness_score >= 50 then 'D' else 'F' end as data_quality_grade from (
   select *, {S.case_map('product_name', {k: v[0] for k, v in V.PRODUCT_FACTS.items()}, "'Unknown'")} as product_brand, {_NB_YEAR} as product_release_year,
     cast({_NB_RATING} as double) as product_avg_rating, 2001 - {_NB_YEAR} as product_age_years, {SEG_ORDER} as customer_segment,
     length(customer_name) as customer_name_length, coalesce(regexp_matches(customer_name, '(Dr|Mr|Ms|Mrs)\\.'), false) as customer_has_title,
     cast({S.case_map('month(order_date)', V.SEASONAL_FACTORS_SIMPLE, '1.0')} as double) as seasonal_factor,
     cast(floor((epoch_us({S.AS_OF}) - epoch_us(order_date)) / 86400000000) as int) as days_since_order, total_amount * 0.30e0 as estimated_profit,
     ({_NB_FILLED}) * 100.0e0 / 5 as data_completeness_score, year(order_date) as order_year, month(order_date) as order_month, day(order_date) as order_day,
     dayname(order_date) as order_weekday, quarter(order_date) as order_quarter,
     case when {_NB_POINTS} >= 7 then 'Critical' when {_NB_POINTS} >= 5 then 'High' when {_NB_POINTS} >= 3 then 'Medium' else 'Low' end as order_priority,
     case when {_NB_RISK} >= 3 then 'High' when {_NB_RISK} >= 1 then 'Medium' else 'Low' end as risk_score
   from {NB_STANDARD}))"""


def nb_enriched(spark: SparkSession, sf: str) -> DataFrame:
    standard = Z.standardize_orders_nb(K.clean_orders_nb(nb_rows(spark, sf))).drop("order_value_category", "record_hash")
    return E.enrich_orders_nb(standard, ORDERS_AS_OF)


@query("enrich_orders_nb", f"select * from {NB_ENRICHED}")
def enrich_orders_nb(spark, sf):
    return nb_enriched(spark, sf)


_LABELS = ["customer_segment", "product_brand", "order_priority", "risk_score", "data_quality_grade"]


@query("enrichment_summary", f"with e as materialized (select * from {NB_ENRICHED}) select 'all' as dimension, 'all' as member, count(*) as n, avg(data_completeness_score) as avg_completeness from e union all "
       + " union all ".join(f"select '{c}', {c}, count(*), avg(data_completeness_score) from e where {c} is not null group by {c}" for c in _LABELS))
def enrichment_summary(spark, sf):
    return A.enrichment_summary(nb_enriched(spark, sf))


@query("transform_nb6", f"""select {S.KEYS}, order_id, customer_name, product, quantity, price, total_amount, {SIZE_COMPACT} as order_size, {SEG_WIDE} as customer_segment,
   greatest(0, 100 - case when {S.blank('customer_email')} then 10 else 0 end - case when {S.blank('store_location')} then 10 else 0 end
     - case when length(customer_name) < 3 then 15 else 0 end - case when total_amount > 5000 then 5 else 0 end) as quality_score
   from (select {S.KEYS}, order_id, customer_email, store_location, {S.title('trim(customer_name)')} as customer_name,
           {S.case_map('lower(product)', V.PRODUCT_ALIASES_SHORT, 'lower(product)')} as product, cast(trunc(coalesce({S.number('quantity')}, 1)) as int) as quantity,
           {S.money(S.number('price'))} as price, {S.money(f"cast(trunc(coalesce({S.number('quantity')}, 1)) as int) * {S.money(S.number('price'))}")} as total_amount
         from {{orders_dirty}}) where order_id is not null and customer_name is not null and product is not null""")
def transform_nb6(spark, sf):
    out = K.transform_nb6(dirty(spark, sf))
    return out.select(*LINE_ORDER, "order_id", "customer_name", "product", "quantity", "price", "total_amount", "order_size", "customer_segment", "quality_score")


@query("stamp_metadata", f"select {S.KEYS}, {S.AS_OF} as standardized_at, '1.0' as standardization_version from {{orders_raw}}")
def stamp_metadata(spark, sf):
    return K.stamp_metadata(raw(spark, sf).select(*LINE_ORDER), "standardized", ORDERS_AS_OF)


@query("segment_revenue", f"""with c as materialized (select * from {CLEANED}), s as ({_SEGMENTS.format(rows='c')})
   select {_SEGMENT} as customer_segment, cast(sum(n) as bigint) as orders, count(*) as customers, sum({S.cents('spent')}) / 100.0 as revenue,
     floor((2 * sum({S.cents('spent')}) + sum(n)) / (2.0 * sum(n))) / 100.0 as avg_order_value from s group by 1""")
def segment_revenue(spark, sf):
    """Flagship: cleaned orders, customers classed by what they spent, totals per class."""
    totals = J.customer_totals(cleaned(spark, sf).select("customer_name", "total_amount", "order_date"))
    segment = C.segment_by_customer(F.col("total_spent"), F.col("order_count"))
    spent, orders = F.sum("total_spent"), F.sum("order_count")
    return totals.groupBy(segment.alias("customer_segment")).agg(
        orders.alias("orders"), F.count(F.lit(1)).alias("customers"), spent.cast("double").alias("revenue"),
        (spent / orders).cast("decimal(18,2)").cast("double").alias("avg_order_value"),
    )
