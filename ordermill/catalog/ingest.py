"""Sources, sinks, upserts, streams and the whole run, over data landed from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..plans.order_flow import FlowConfig, run_pipeline
from ..session import ORDERS_AS_OF, materialize, shuffles_dropped
from ..session import fresh_path as fresh
from ..sources import files, incremental, mappings, sinks
from ..streaming import jobs
from . import sqltext as S
from .bindings import LINE_ORDER, table
from .metrics import _WALK
from .checks import ERRORS
from .orders import CLEANED, STANDARD_ID, _STD_BRAND, address_sql, clean_sql, dirty, enriched_sql, raw
from .registry import query
from .scalars import CATEGORY_STANDARD

TEXT_FIELDS = list(files.ORDER_TEXT_FIELDS)


# Landed text is many times as large as its tables, so it is packed. One task reads a packed file, so its rows are bounded.
PACKED = {"compression": "gzip", "maxRecordsPerFile": 1_000_000}


def landed_csv(spark: SparkSession, sf: str) -> str:
    path = fresh(spark, "landing-csv")
    with shuffles_dropped(spark):
        sinks.write_csv(dirty(spark, sf).select(*TEXT_FIELDS, *LINE_ORDER), path, **PACKED)
    return path


LANDED_SCHEMA = files.text_schema([*TEXT_FIELDS, *LINE_ORDER])
_TEXT = ", ".join(TEXT_FIELDS)
# an empty CSV field reads as null
_CSV_TEXT = ", ".join(f"nullif({c}, '') as {c}" for c in TEXT_FIELDS)
_LINE_TEXT = ", ".join(f"cast({c} as varchar) as {c}" for c in LINE_ORDER)


@query("read_csv_orders", f"select {_CSV_TEXT}, {_LINE_TEXT}, 'file_csv' as source_type, {S.AS_OF} as ingested_at from {{orders_dirty}}")
def read_csv_orders(spark, sf):
    rows = files.read_csv_orders(spark, landed_csv(spark, sf), ORDERS_AS_OF, schema=LANDED_SCHEMA)
    return rows.drop("_corrupt_record", "source_file")


@query("read_csv_typed", f"select {S.KEYS}, order_id, quantity, price, cast(order_date as date) as order_date from {{orders_raw}}")
def read_csv_typed(spark, sf):
    columns = [*LINE_ORDER, "order_id", "quantity", "price", F.to_date("order_date").alias("order_date")]
    path = fresh(spark, "typed-csv")
    sinks.write_csv(raw(spark, sf).select(*columns), path)
    keys = ", ".join(f"{k} bigint" for k in LINE_ORDER)
    return files.read_csv_typed(spark, path, f"{keys}, order_id string, quantity int, price double, order_date date, _corrupt_record string").drop("_corrupt_record")


def _envelopes(rows: DataFrame) -> DataFrame:
    """JSON documents of all four shapes, one line each."""
    order = F.struct(*TEXT_FIELDS, F.concat(F.lit("d"), F.col("seq") % 3).alias("device_type"),
                     F.struct(F.lit("M1").alias("model"), F.col("line_no").cast("string").alias("os_version")).alias("device_info"))
    many = F.array(order)
    head = [F.lit("2.1").alias("app_version"), F.lit("2001-12-30").alias("upload_time"), F.struct(F.lit("9").alias("version"), F.lit("ios").alias("platform")).alias("app_info")]
    kind = F.col("seq") % 4
    doc = (
        F.when(kind == 0, F.to_json(F.struct(many.alias("orders"), *head))).when(kind == 1, F.to_json(F.struct(many.alias("data"), *head)))
        .when(kind == 2, F.to_json(F.struct(many.alias("items"), *head))).otherwise(F.to_json(order))
    )
    return rows.select(doc.alias("value"))


LANDED_SLICES = 4


def landed_json(spark: SparkSession, sf: str) -> str:
    """The documents go by slices of the order key, so no more than a slice of their join is shuffled beside the files."""
    path, rows = fresh(spark, "landing-json"), dirty(spark, sf)
    part = F.pmod(F.xxhash64("order_key"), F.lit(LANDED_SLICES))
    with shuffles_dropped(spark):
        for i in range(LANDED_SLICES):
            _envelopes(rows.filter(part == i)).write.mode("append").options(**PACKED).text(path)
    return path


@query("read_json_orders", f"select {_TEXT}, 'd' || seq % 3 as device_type, case when seq % 4 < 3 then '2.1' end as app_version, case when seq % 4 < 3 then '2001-12-30' end as upload_time from {{orders_dirty}}")
def read_json_orders(spark, sf):
    return files.read_json_orders(spark, landed_json(spark, sf), ORDERS_AS_OF, multi_line=False).select(*TEXT_FIELDS, "device_type", "app_version", "upload_time")


@query("flatten_nested_orders", """select order_id, customer_name, 'M1' as device_model, cast(line_no as varchar) as device_os, case when seq % 4 < 3 then '9' end as app_version,
   case when seq % 4 < 3 then 'ios' end as app_platform, case when seq % 4 < 3 then '2001-12-30' end as upload_timestamp from {orders_dirty}""")
def flatten_nested_orders(spark, sf):
    flat = files.flatten_nested_orders(files.read_json_orders(spark, landed_json(spark, sf), ORDERS_AS_OF, multi_line=False))
    return flat.select("order_id", "customer_name", "device_model", "device_os", "app_version", "app_platform", "upload_timestamp")


@query("json_structure_profile", """select event_id, 'k' as key, 'int' as kind, cast(null as int) as length from events
   union all select event_id, unnest(['id', 'tags', 'who', 'name', 'value', 'ok', 'digits', 'open', 'yes']), unnest(['int', 'list', 'dict', 'str', 'float', 'bool', 'str', 'str', 'str']), unnest([null, cast(event_id % 4 as int), null, null, null, null, null, null, null]) from events""")
def json_structure_profile(spark, sf):
    events = table(spark, sf, "events")
    made = F.to_json(F.struct(F.col("event_id").alias("id"), F.array_repeat(F.lit("x"), (F.col("event_id") % 4).cast("int")).alias("tags"),
                              F.struct(F.col("user_id").alias("user")).alias("who"), F.col("event_type").alias("name"), (F.col("event_id") + 0.5).alias("value"), F.lit(True).alias("ok"),
                              F.col("event_id").cast("string").alias("digits"), F.lit("[x").alias("open"), F.lit("true").alias("yes")))
    documents = events.select("event_id", F.col("props").alias("value")).unionByName(events.select("event_id", made.alias("value")))
    return files.json_structure_profile(documents)


_MIXED_KEYS = "cast(order_key as varchar) as order_key, cast(line_no as varchar) as line_no"


@query("read_csv_layouts", f"""select {_MIXED_KEYS}, nullif(order_id, '') as order_id, nullif(product, '') as product, case when line_no % 3 = 2 then null else nullif(notes, '') end as notes,
   case when line_no % 3 = 2 then 'x' || order_key end as shelf from {{orders_dirty}}""")
def read_csv_layouts(spark, sf):
    """Three landed layouts: columns in order, in another order, and without some but with one more."""
    path, rows = fresh(spark, "layouts-csv"), dirty(spark, sf)
    parts = {
        0: [*TEXT_FIELDS, "order_key", "line_no"],
        1: ["line_no", *reversed(TEXT_FIELDS), "order_key"],
        2: ["product", F.concat(F.lit("x"), "order_key").alias("shelf"), "order_key", "order_id", "line_no"],
    }
    for i, columns in parts.items():
        sinks.write_csv(rows.filter(F.col("line_no") % 3 == i).select(*columns), f"{path}/{i}")
    read = files.read_csv_orders(spark, [f"{path}/{i}" for i in parts], ORDERS_AS_OF, schema=files.text_schema([*TEXT_FIELDS, "order_key", "line_no"]))
    return read.filter("_corrupt_record is null").select("order_key", "line_no", "order_id", "product", "notes", "shelf")


@query("read_many_files", "select order_id, product, source_type from (select order_id, product, 'file_csv' as source_type from {orders_dirty} union all select order_id, product, 'file_json' from {orders_dirty})")
def read_many_files(spark, sf):
    csv = files.read_many_files(spark, landed_csv(spark, sf), "csv", ORDERS_AS_OF)
    json = files.read_many_files(spark, landed_json(spark, sf), "json", ORDERS_AS_OF, multi_line=False)
    columns = ["order_id", "product", "source_type"]
    return csv.select(*columns).unionByName(json.select(*columns))


@query("ingest_file_summary", "select count(*) as records, count(*) filter (where event_id % 50 = 0) as bad_records, '2/2' as status from events")
def ingest_file_summary(spark, sf):
    """Lines with a field too many are corrupt records; the totals row is returned (file names vary)."""
    path = fresh(spark, "ragged")
    line = F.concat_ws(",", F.concat(F.lit("E"), "event_id"), "event_type", F.when(F.col("event_id") % 50 == 0, F.lit("too,many")).otherwise(F.lit("x")))
    table(spark, sf, "events").select(line.alias("value"), F.col("event_id").alias("k")).repartitionByRange(2, "k").select("value").write.text(path)
    rows = files.read_csv_orders(spark, path, ORDERS_AS_OF, schema=files.text_schema(["order_id", "product", "notes"]), header=False)
    return files.ingest_file_summary(materialize(rows, "ragged")).filter("source_file = '(all)'").drop("source_file")


@query("file_admission", """select reason, accepted, count(*) as files from (
   select case when k % 4 = 1 then 'too large' when k % 4 = 2 then 'unsupported type' end as reason, k % 4 in (0, 3) as accepted from (select distinct event_id % 40 as k from events)
   union all select 'missing', false) group by 1, 2""")
def file_admission(spark, sf):
    """Some files of each kind: small CSV and JSON, one beyond the limit, one of another type; and a path without files."""
    path = fresh(spark, "admission")
    kinds = table(spark, sf, "events").select((F.col("event_id") % 40).alias("k")).distinct()
    kind, landed = F.col("k") % 4, []
    for i, (fmt, text) in enumerate([("csv", F.lit("a")), ("csv", F.repeat(F.lit("b"), 3000)), ("text", F.lit("c")), ("json", F.lit("d"))]):
        rows = kinds.filter(kind == i)
        one = rows.repartitionByRange(rows.count(), "k").select(text.alias("value"))
        one.write.format(fmt).save(f"{path}/{i}")
        landed.append(f"{path}/{i}")
    judged = files.file_admission(spark, [*landed, f"{path}/none"], max_mb=0.002)
    return judged.groupBy("reason", "accepted").agg(F.count(F.lit(1)).alias("files"))


@query("incremental_extract", """select event_id, ts, value, 'by_time' as pull, 'events' as source_id, 'database' as source_type, 'lake' as connection_name from events where ts > timestamp '2024-01-20 00:00:00'
   union all select event_id, ts, value, 'first_time', 'events', 'database', 'lake' from events where ts > timestamp '2024-02-10 00:00:00' - interval 30 days
   union all select event_id, ts, value, 'by_id', 'events', 'database', 'lake' from events where event_id > 500
   union all (select event_id, ts, value, 'limited', 'events', 'database', 'lake' from events where event_id > 500 order by event_id limit 100)
   union all select event_id, ts, value, 'full', 'events', 'database', 'lake' from events""")
def incremental_extract(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "value")
    as_of = "2024-02-10 00:00:00"

    def pull(name: str, **options) -> DataFrame:
        got = incremental.incremental_extract(events, as_of=as_of, source_id="events", **options)
        return got.withColumn("pull", F.lit(name)).drop("extracted_at")

    parts = [
        pull("by_time", mode=incremental.TIMESTAMP, column="ts", last_value="2024-01-20 00:00:00"),
        pull("first_time", mode=incremental.TIMESTAMP, column="ts"),
        pull("by_id", mode=incremental.ID, column="event_id", last_value=500),
        pull("limited", mode=incremental.ID, column="event_id", last_value=500, limit=100),
        pull("full", mode=incremental.FULL, column=None),
    ]
    return mappings.union_sources(parts)


@query("next_watermark", "select strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') as last_value, 'ts' as source from events union all select cast(max(event_id) as varchar), 'id' from events")
def next_watermark(spark, sf):
    events = table(spark, sf, "events")
    by_time = incremental.next_watermark(events, incremental.TIMESTAMP, "ts").withColumn("source", F.lit("ts"))
    return by_time.unionByName(incremental.next_watermark(events, incremental.ID, "event_id").withColumn("source", F.lit("id")))


@query("partner_orders_map", f"""select order_id, customer_email, customer_name, product, 'Electronics' as product_category, quantity, price, 0.0e0 as discount, quantity * price as total_amount,
   cast(order_date as date) as order_date, 'Partner Store' as store_location, 'partner' as source, order_date as created_at, order_date as updated_at from {{orders_raw}} where order_date > timestamp '1999-01-01'""")
def partner_orders_map(spark, sf):
    feed = raw(spark, sf).select(
        F.col("order_id").alias("order_reference"), "customer_email", "customer_name", F.col("product").alias("product_sku"), "quantity",
        F.col("price").alias("unit_price"), F.col("order_date").alias("created_at"),
    )
    return mappings.partner_orders_map(feed, "1999-01-01 00:00:00")


@query("customers_extract_map", """select customer_id, 'N' || customer_id % 7 || ' ' || name as customer_name, tier || ', ' || nation || ', ' || 'ST' as address, nation as city, timestamp '2001-01-01' as updated_at
   from {customers} where customer_id % 2 = 0""")
def customers_extract_map(spark, sf):
    rows = table(spark, sf, "customers").select(
        "customer_id", F.concat(F.lit("N"), F.col("customer_id") % 7).alias("first_name"), F.col("name").alias("last_name"), F.col("tier").alias("address_line1"),
        F.col("nation").alias("city"), F.lit("ST").alias("state"),
        F.when(F.col("customer_id") % 2 == 0, F.lit("2001-01-01 00:00:00")).otherwise(F.lit("1999-01-01 00:00:00")).cast("timestamp_ntz").alias("updated_at"),
    )
    return mappings.customers_extract_map(rows, "2000-01-01 00:00:00").drop("state")


_PRODUCT = "case " + " ".join(f"when {' or '.join(f'''lower(text) like '%{w}%' ''' for w in words)} then '{p}'" for words, p in V.TITLE_PRODUCTS) + f" else {S.pick_hash('text', V.TITLE_FALLBACK)} end"


@query("api_orders_map", f"""select case when doc_id < 10000 then 'API-' || lpad(cast(doc_id as varchar), 4, '0') else 'API-' || doc_id end as order_id, 'Customer ' || (doc_id % 10 + 1) as customer_name,
   'customer' || (doc_id % 10 + 1) || '@example.com' as customer_email, {_PRODUCT} as product, 'Electronics' as product_category, 1 as quantity, cast(50 + (doc_id % 20) * 25.99 as double) as price,
   0.0e0 as discount, cast(50 + (doc_id % 20) * 25.99 as double) as total_amount, date '2001-12-31' as order_date, 'api' as source, doc_id as api_post_id, 'api_rest' as source_type from documents""")
def api_orders_map(spark, sf):
    posts = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), (F.col("doc_id") % 10 + 1).alias("userId"), F.col("text").alias("title"))
    return mappings.api_orders_map(posts, ORDERS_AS_OF)


@query("api_customers_map", """select 'CUST-' || case when customer_id < 100 then lpad(cast(customer_id as varchar), 3, '0') else cast(customer_id as varchar) end as customer_id, name,
   lower(replace(name, '#', '')) || '@example.com' as email, '' as phone, customer_id || ' Main' || case when customer_id % 3 = 0 then '' else ', ' || tier end || ', ' || nation as address,
   coalesce(case when customer_id % 2 = 0 then tier end, '') as company, '' as website, 'api_rest' as source_type from {customers}""")
def api_customers_map(spark, sf):
    users = table(spark, sf, "customers").select(
        F.col("customer_id").alias("id"), "name", F.concat(F.lower(F.replace("name", F.lit("#"), F.lit(""))), F.lit("@example.com")).alias("email"),
        F.lit(None).cast("string").alias("phone"), F.lit(None).cast("string").alias("website"),
        F.struct(F.concat(F.col("customer_id"), F.lit(" Main")).alias("street"), F.when(F.col("customer_id") % 3 == 0, "").otherwise(F.col("tier")).alias("suite"),
                 F.col("nation").alias("city"), F.lit(None).cast("string").alias("zipcode")).alias("address"),
        F.struct(F.when(F.col("customer_id") % 2 == 0, F.col("tier")).alias("name")).alias("company"),
    )
    return mappings.api_customers_map(users)


MAPPING = {
    "fields": [
        {"from": "id", "to": "order_id", "transform": "prefix", "params": {"prefix": "API-"}},
        {"from": "customer.name", "to": "customer_name", "transform": "clean_text"},
        {"from": "customer.email", "to": "customer_email"},
        {"from": "items[0].product_name", "to": "product", "transform": "truncate", "params": {"max_length": 6}},
        {"from": "items[0].unit_price", "to": "price", "transform": "to_decimal"},
        {"from": "items[0].quantity", "to": "quantity", "transform": "to_decimal"},
    ],
    "static": {"source": "api", "product_category": "Electronics"},
    "calculated": {"total_amount": "quantity * price", "label": "concat('Customer ', customer_name)"},
}


@query("field_mapping", f"""select {S.KEYS}, 'API-' || order_id as order_id, {S.clean('customer_name')} as customer_name, customer_email, substr(product, 1, 6) as product, {S.money(S.number('price'))} as price,
   {S.money(S.number('quantity'))} as quantity, 'api' as source, 'Electronics' as product_category, {S.money(S.number('quantity'))} * {S.money(S.number('price'))} as total_amount,
   'Customer ' || {S.clean('customer_name')} as label from {{orders_dirty}}""")
def field_mapping(spark, sf):
    item = F.struct(F.col("product").alias("product_name"), F.col("price").alias("unit_price"), "quantity")
    payload = F.to_json(F.struct(F.col("order_id").alias("id"), F.struct(F.col("customer_name").alias("name"), F.col("customer_email").alias("email")).alias("customer"), F.array(item).alias("items")))
    return mappings.field_mapping(dirty(spark, sf).select(*LINE_ORDER, payload.alias("payload")), MAPPING)


@query("calculated_fields", f"select {S.KEYS}, (quantity * price) - discount as net_amount, year(order_date) as order_year, month(order_date) as order_month, isodow(order_date) - 1 as order_weekday from {{orders_raw}}")
def calculated_fields(spark, sf):
    formulas = {"net_amount": "(quantity * price) - discount", "order_year": "YEAR(order_date)", "order_month": "MONTH(order_date)", "order_weekday": "WEEKDAY(order_date)"}
    return mappings.calculated_fields(raw(spark, sf), formulas).select(*LINE_ORDER, *formulas)


def _two_sources(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    rows = raw(spark, sf)
    shared = [*LINE_ORDER, "order_id", "customer_name"]
    return {
        "csv": rows.filter("source in ('store', 'phone')").select(*shared, "store_location"),
        "json": rows.filter("source not in ('store', 'phone')").select(*shared, "customer_email"),
    }


@query("align_and_union_sources", f"""select *, {S.AS_OF} as combined_at, row_number() over (order by source_type, {S.KEYS}) as record_id from (
   select {S.KEYS}, order_id, customer_name, store_location, null as customer_email, 'csv' as source_type from {{orders_raw}} where source in ('store', 'phone')
   union all select {S.KEYS}, order_id, customer_name, null, customer_email, 'json' from {{orders_raw}} where source not in ('store', 'phone'))""")
def align_and_union_sources(spark, sf):
    return mappings.align_and_union_sources(_two_sources(spark, sf), ["source_type", *LINE_ORDER], ORDERS_AS_OF)


@query("combine_sources_dedup", f"""select {S.KEYS}, order_id from (select {S.KEYS}, order_id, 0 as s from {{orders_raw}} where line_no >= 4 union all select {S.KEYS}, order_id, 1 from {{orders_raw}})
   qualify row_number() over (partition by order_id order by s, {S.KEYS}) = 1""")
def combine_sources_dedup(spark, sf):
    rows = raw(spark, sf).select(*LINE_ORDER, "order_id")
    return mappings.combine_sources_dedup([rows.filter("line_no >= 4"), rows], ["order_id"], LINE_ORDER)


# --- sinks ------------------------------------------------------------------------------------

_BASIC = [*LINE_ORDER, "order_id", "customer_name", "price", "quantity", "order_date"]
_BASIC_SQL = f"select {', '.join(_BASIC)} from {{orders_raw}}"


@query("write_csv", _BASIC_SQL)
def write_csv(spark, sf):
    path, rows = fresh(spark, "out-csv"), raw(spark, sf).select(*_BASIC)
    sinks.write_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


@query("write_json", _BASIC_SQL)
def write_json(spark, sf):
    path, rows = fresh(spark, "out-json"), raw(spark, sf).select(*_BASIC)
    sinks.write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query("write_parquet", f"select {', '.join(_BASIC)}, cast(year(order_date) as int) as order_year, cast(month(order_date) as int) as order_month from {{orders_raw}}")
def write_parquet(spark, sf):
    path = fresh(spark, "out-parquet")
    rows = raw(spark, sf).select(*_BASIC, F.year("order_date").alias("order_year"), F.month("order_date").alias("order_month"))
    sinks.write_parquet(rows, path, partition_by=["order_year", "order_month"])
    return spark.read.parquet(path)


@query("prepare_for_store", f"""select {S.KEYS}, nullif(source, 'nan') as source, coalesce(quantity, 0) as quantity, coalesce(price, 0.0) as price, cast(flag as int) as flag, strftime(order_date, '%Y-%m-%d %H:%M:%S') as order_date,
   '2001-12-31 00:00:00' as created_at, '2001-12-31 00:00:00' as updated_at, '2001-12-31 00:00:00' as processed_at from (select *, case when seq % 3 = 0 then 'nan' end as x, quantity > 10 as flag from (
     select {S.KEYS}, seq, order_date, case when seq % 5 = 0 then 'nan' else source end as source, case when seq % 7 = 0 then null else quantity end as quantity, case when seq % 11 = 0 then null else price end as price from {{orders_raw}}))""")
def prepare_for_store(spark, sf):
    s = F.col("seq")
    rows = raw(spark, sf).select(
        *LINE_ORDER, F.when(s % 5 == 0, "nan").otherwise(F.col("source")).alias("source"), F.when(s % 7 != 0, F.col("quantity")).alias("quantity"),
        F.when(s % 22 == 0, F.lit(float("inf"))).when(s % 11 == 0, F.lit(float("nan"))).otherwise(F.col("price")).alias("price"),
        F.when(s % 7 != 0, F.col("quantity") > 10).alias("flag"), "order_date",
    )
    return sinks.prepare_for_store(rows, ORDERS_AS_OF)


@query("project_to_table", f"select {S.KEYS}, order_id, source from {{orders_raw}}")
def project_to_table(spark, sf):
    return sinks.project_to_table(raw(spark, sf), ["id", *LINE_ORDER, "order_id", "source", "not_there"])


_DELTA = f"(select * from {{orders_raw}} where line_no >= 5 qualify row_number() over (partition by order_id order by order_key desc, line_no desc, part_key desc, supp_key desc, amount_key desc) = 1)"
_BASE = f"(select * from {{orders_raw}} where line_no < 5 qualify {S.first_per('order_id')})"


@query("upsert_orders", f"""with d as materialized {_DELTA} select order_id, price, status, cast(null as varchar) as notes from d
   union all select order_id, price, status, notes from {_BASE} where order_id not in (select order_id from d)""")
def upsert_orders(spark, sf):
    from ..operators.dedup import dedup_by_key
    from ..sources.bucketed import BucketedTable

    rows = raw(spark, sf)
    base = dedup_by_key(rows.filter("line_no < 5"), ["order_id"], LINE_ORDER).select("order_id", "price", "status", "notes")
    table = BucketedTable.create(base, fresh(spark, "orders-table"), ["order_id"], buckets=64)
    delta = rows.filter("line_no >= 5").select(*LINE_ORDER, "order_id", "price", "status")
    table.upsert(delta, [F.desc(c) for c in LINE_ORDER])
    return table.read()


# --- streams ----------------------------------------------------------------------------------


def finish(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def table_stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table as a stream; the glob admits one file as well as a folder of files."""
    return jobs.read_files(spark, f"{sf}/{name}.parquet*", "parquet", table(spark, sf, name).schema)


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    return table_stream(spark, sf, "events")


@query("stream_files", f"select {_CSV_TEXT}, {_LINE_TEXT} from {{orders_dirty}}")
def stream_files(spark, sf):
    dst, ckpt = fresh(spark, "stream-files"), fresh(spark, "ckpt")
    finish(jobs.stream_files(spark, landed_csv(spark, sf), dst, ckpt, schema=LANDED_SCHEMA))
    return spark.read.parquet(dst).drop("_corrupt_record", "source_file")


@query("stream_incremental", "select event_id, ts, value, event_id >= (select max(event_id) from events) / 2 as second_run from events")
def stream_incremental(spark, sf):
    """Two runs over a growing folder; the second picks up only the new files."""
    events = table(spark, sf, "events").select("event_id", "ts", "value")
    half = events.agg(F.max("event_id") / 2).scalar()
    late = F.col("event_id") >= half
    src, dst, ckpt = (fresh(spark, n) for n in ("growing", "stream-inc", "ckpt"))
    for second in (False, True):
        events.filter(late == F.lit(second)).write.mode("append").parquet(src)
        rows = jobs.read_files(spark, src, "parquet", events.schema).withColumn("second_run", F.lit(second))
        finish(jobs.stream_incremental(rows, dst, ckpt))
    return spark.read.parquet(dst)


@query("stream_dedup", "select distinct user_id, event_type from events")
def stream_dedup(spark, sf):
    dst, ckpt = fresh(spark, "stream-dedup"), fresh(spark, "ckpt")
    rows = _event_stream(spark, sf).select("user_id", "event_type", "ts")
    finish(jobs.stream_dedup(rows, dst, ckpt, ["user_id", "event_type"], "ts", "365 days"))
    return spark.read.parquet(dst).select("user_id", "event_type")


def _line_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Dirty order lines as a stream: line items stream in and meet the static orders table."""
    from . import bindings as B

    # the table is one file here, so the batch is spread over the cores
    lines = table_stream(spark, sf, "lineitem").repartition(spark.sparkContext.defaultParallelism)
    joined = spark.sql(B._expand(B.ORDERS_RAW, B._SPARK), lineitem=lines, orders=table(spark, sf, "orders"))
    return spark.sql(B._expand(B.ORDERS_DIRTY, B._SPARK), orders_raw=joined)


_BLOCKED = f"(select distinct {S.KEYS} from {ERRORS} where severity <> 'low')"
# cleaning the good rows drops a few more
_CLEAN_KEYS = f"(select {S.KEYS} from {clean_sql('{orders_dirty}')})"


@query("stream_clean_validate", f"""with b as materialized {_BLOCKED} select {S.KEYS}, 'bad' as part from b
   union all select {S.KEYS}, 'good' from {_CLEAN_KEYS} k where not exists (select 1 from b where b.order_key = k.order_key and b.line_no = k.line_no
     and b.part_key = k.part_key and b.supp_key = k.supp_key and b.amount_key = k.amount_key)""")
def stream_clean_validate(spark, sf):
    dst, ckpt = fresh(spark, "stream-clean"), fresh(spark, "ckpt")
    finish(jobs.stream_clean_validate(_line_stream(spark, sf), dst, ckpt, ORDERS_AS_OF, "medium"))
    good, bad = spark.read.parquet(f"{dst}/good"), spark.read.parquet(f"{dst}/bad")
    return good.select(*LINE_ORDER, F.lit("good").alias("part")).unionByName(bad.select(*LINE_ORDER, F.lit("bad").alias("part")))


@query("stream_upsert", """select user_id, ts, event_type, value from events
   qualify row_number() over (partition by user_id order by ts desc nulls last, event_id desc) = 1""")
def stream_upsert(spark, sf):
    """The table starts with the users of the first day; three runs replace by user what has landed since, oldest first.

    Events without a time come with the oldest: any with a time replaces them.
    """
    from ..sources.bucketed import BucketedTable

    dst, ckpt, src = (fresh(spark, n) for n in ("stream-upsert", "ckpt", "landed-events"))
    events = table(spark, sf, "events")
    first_day = events.filter("ts < timestamp_ntz'2024-01-02'").groupBy("user_id").agg(F.min_by(F.struct("ts", "event_type", "value"), "event_id").alias("e"))
    users = BucketedTable.create(first_day.select("user_id", "e.*"), dst, ["user_id"], buckets=64)
    part = F.when(F.col("ts") >= F.lit("2024-01-21").cast("timestamp_ntz"), 2).when(F.col("ts") >= F.lit("2024-01-11").cast("timestamp_ntz"), 1).otherwise(0)
    for run in range(3):
        events.filter(part == run).write.mode("append").parquet(src)
        finish(jobs.stream_upsert(jobs.read_files(spark, src, "parquet", events.schema), dst, ckpt, [F.desc("ts"), F.desc("event_id")]))
    return users.read()


@query("stream_hourly_rollup", """select event_type as name, date_trunc('hour', ts) as hour_start, count(*) as n, sum(cast(round(value * 100) as bigint)) / 100.0 as total, min(value) as min_value, max(value) as max_value,
   quantile_disc(value, 0.95) as p95_approx from events group by 1, 2 having date_trunc('hour', ts) + interval 1 hour <= (select max(ts) from events) - interval 10 minutes""")
def stream_hourly_rollup(spark, sf):
    """Hours the watermark has closed by the end of the data."""
    dst, ckpt = fresh(spark, "stream-hours"), fresh(spark, "ckpt")
    finish(jobs.stream_hourly_rollup(_event_stream(spark, sf).withColumnRenamed("event_type", "name"), dst, ckpt))
    return spark.read.parquet(dst)


STREAM_RULES = [{"rule": "big_value", "condition": "value > 50", "severity": "HIGH", "cooldown": 120}, {"rule": "error_event", "condition": "event_type = 'error'", "severity": "LOW", "cooldown": 300}]


@query("stream_alerts", f"""with recursive cand as materialized (select 'big_value' as rule, ts, event_id, 120 as cooldown_minutes from events where value > 50
   union all select 'error_event', ts, event_id, 300 from events where event_type = 'error'), {_WALK} select rule, ts, event_id as id from kept join cand using (rule, ts)""")
def stream_alerts(spark, sf):
    dst, ckpt = fresh(spark, "stream-alerts"), fresh(spark, "ckpt")
    finish(jobs.stream_alerts(_event_stream(spark, sf), dst, ckpt, STREAM_RULES, ["rule"], "event_id"))
    return spark.read.parquet(dst).select("rule", "ts", "id")


# --- the whole run ----------------------------------------------------------------------------

_HOST = "split_part(customer_email, '@', 2)"
_STD = f"""(select {S.KEYS}, {STANDARD_ID} as order_id, {S.title(S.clean('customer_name'))} as customer_name, {_STD_BRAND} as product, {address_sql(S.clean('store_location'))} as store_location,
    {S.title(S.clean('notes'))} as notes, split_part(customer_email, '@', 1) || '@' || {S.case_map(_HOST, V.EMAIL_DOMAIN_ALIASES, _HOST)} as customer_email, quantity, price, discount, total_amount, order_date,
    {S.case_map('source', V.SOURCE_ALIASES_STANDARD, 'source')} as source, {CATEGORY_STANDARD} as product_category, data_quality_score from {CLEANED})"""
STORED = ["order_id", "customer_name", "product", "store_location", "customer_email", "quantity", "price", "discount", "total_amount", "source", "product_category", "data_quality_score",
          "customer_segment", "customer_ltv", "order_timing", "order_size_category", "risk_score", "risk_level", "season", "channel_type", "revenue_contribution_pct"]


@query("run_pipeline", f"""select {S.KEYS}, {', '.join(STORED)} from {enriched_sql(_STD)}
   qualify row_number() over (partition by order_id order by order_key desc, line_no desc, part_key desc, supp_key desc, amount_key desc) = 1""")
def run_whole_flow(spark, sf):
    rows = dirty(spark, sf).drop("seq", "legacy_id", "status", "phone", "address")
    config = FlowConfig(ORDERS_AS_OF, LINE_ORDER, store_path=fresh(spark, "store"))
    return run_pipeline([rows], config).data.select(*LINE_ORDER, *STORED)
