"""Order, customer and metric tables as views over the given TPC-H-like tables.

Each view is one SQL text in the subset Spark and DuckDB share; the few functions that differ are
placeholders (`{us}` epoch microseconds, `{hour}` start of hour). Money is computed in whole cents.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import DataFrame, SparkSession

from ..session import fresh_path, tune

# total order of order lines; every order-sensitive operator breaks ties with it
LINE_ORDER = ["order_key", "line_no", "part_key", "supp_key", "amount_key"]

_SPARK = {
    "us": lambda c: f"unix_micros(cast({c} as timestamp))",
    "hour": lambda c: f"cast(date_trunc('hour', {c}) as timestamp_ntz)",
    "plus_minutes": lambda c, n: f"({c} + make_dt_interval(0, 0, cast({n} as int), 0))",
    "strpos": lambda c, s: f"instr({c}, {s})",
}
_DUCK = {
    "us": lambda c: f"epoch_us({c})",
    "hour": lambda c: f"date_trunc('hour', {c})",
    "plus_minutes": lambda c, n: f"({c} + to_minutes(cast({n} as bigint)))",
    "strpos": lambda c, s: f"instr({c}, {s})",
}

_LETTERS = "translate(cast({} as varchar(20)), '0123456789', 'abcdefghij')"
_CUST = _LETTERS.format("o.o_custkey")
_ALPHA = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BLOCK = "cast(floor(o.o_orderkey / 1000) as bigint)"
_PREFIX = " || ".join(f"substr('{_ALPHA}', cast(1 + cast(floor({_BLOCK} / {d}) as bigint) % 26 as int), 1)" for d in (676, 26, 1))
_YEAR = "cast(extract(year from o.o_orderdate) as varchar(4))"
_NNN = "lpad(cast(o.o_orderkey % 1000 as varchar(10)), 3, '0')"
_PRICE = "cast(floor(round(l.l_extendedprice * 100) / l.l_quantity / 10) as bigint)"
_DISC = "cast(round(l.l_discount * 100) as bigint) * 500"


def _pick(index: str, values: list[str]) -> str:
    whens = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"case {index} {whens} end"


_PRODUCTS = ["iPhone 15", "MacBook Pro", "AirPods Pro", "iPad Air", "Apple Watch", "Samsung Galaxy S24",
             "Nintendo Switch", "PlayStation 5", "Xbox Series X", "Kindle Paperwhite"]
_SPELLINGS = ["iphone15", "macbook-pro", "air pods pro", "IPAD AIR", "applewatch", "galaxy s24",
              "switch", "ps5", "xbox x", "Kindle"]
_CITIES = ["New York", "Los Angeles", "Chicago", "Houston", "Phoenix", "Dallas", "San Diego", "San Jose"]
_CITY_ALIASES = ["nyc", "la", "chicago il", "houston tx", "phoenix az", "dallas tx", "san diego ca", "san jose ca"]
_STREETS = ["n main st, ny", "oak ave, ca", "W Elm Blvd, TX", "park rd nw", "hill dr, apt 3rd"]

# one row per order line; all joins are total
ORDERS_RAW = f"""
select o.o_orderkey as order_key, l.l_linenumber as line_no, l.l_partkey as part_key, l.l_suppkey as supp_key,
  cast(round(l.l_extendedprice * 100) as bigint) * 64 + cast(l.l_quantity as bigint) as amount_key,
  o.o_orderkey * 7 + l.l_linenumber * 3 + l.l_partkey * 11 + l.l_suppkey * 13 as seq,
  {_PREFIX} || '-' || {_YEAR} || '-' || {_NNN} as order_id,
  o.o_custkey as customer_id,
  'Customer ' || upper(substr({_CUST}, 1, 1)) || substr({_CUST}, 2) as customer_name,
  {_CUST} || '@' || {_pick('o.o_custkey % 5', ['gmail.com', 'yahoo.com', 'outlook.com', 'company.com', 'example.com'])} as customer_email,
  {_pick('l.l_partkey % 10', _PRODUCTS)} as product,
  {_pick('l.l_partkey % 5', ['Electronics', 'Gaming', 'Books', 'Smart Home', 'Fitness'])} as product_category,
  cast(l.l_quantity as int) as quantity,
  {_PRICE} / 100.0e0 as price,
  {_DISC} / 100.0e0 as discount,
  (cast(l.l_quantity as int) * {_PRICE} - {_DISC}) / 100.0e0 as total_amount,
  o.o_orderdate as order_date,
  {_pick('o.o_orderkey % 5', ['website', 'mobile_app', 'store', 'phone', 'partner'])} as source,
  {_pick('l.l_suppkey % 8', _CITIES)} as store_location,
  {_pick('l.l_linenumber % 3', ['gift wrap', 'leave at door'])} as notes,
  {_pick('o.o_orderkey % 6', ['pending', 'processing', 'shipped', 'delivered', 'cancelled', 'returned'])} as status,
  '(555) ' || lpad(cast(o.o_custkey % 1000 as varchar(10)), 3, '0') || '.' || lpad(cast(o.o_custkey % 9973 as varchar(10)), 4, '0') as phone,
  cast(100 + o.o_custkey % 900 as varchar(10)) || ' ' || {_pick('o.o_custkey % 5', _STREETS)} as address
from {{lineitem}} l join {{orders}} o on l.l_orderkey = o.o_orderkey
"""

# the same rows as untyped text with defects chosen by `seq`
ORDERS_DIRTY = f"""
select order_key, line_no, part_key, supp_key, amount_key, seq,
  case when seq % 41 = 0 then cast(null as varchar(40))
       when seq % 7 = 1 then lower(order_id)
       when seq % 7 = 2 then replace(order_id, '-', '_')
       when seq % 7 = 3 then replace(order_id, '-', '')
       when seq % 7 = 4 then replace(order_id, '-', ' ')
       else order_id end as order_id,
  case when seq % 6 = 0 then replace('ORD' || substr(order_id, 4), '-', '_')
       when seq % 6 = 1 then 'order' || substr(order_id, 4)
       when seq % 6 = 2 then substr(order_id, 5)
       when seq % 6 = 3 then 'ord-' || substr(order_id, 7)
       when seq % 6 = 4 then 'ORD' || substr(order_id, 4)
       else order_id end as legacy_id,
  case when seq % 29 = 0 then cast(null as varchar(60))
       when seq % 31 = 0 then 'Test User ' || substr(customer_name, 10)
       when seq % 37 = 0 then ''
       when seq % 43 = 0 then 'X'
       when seq % 5 = 0 then '  ' || lower(customer_name) || ' '
       when seq % 5 = 1 then upper(customer_name)
       when seq % 5 = 2 then 'mr  ' || replace(customer_name, ' ', '   ')
       when seq % 5 = 3 then substr(customer_name, 10) || ' o''neil-3rd'
       else customer_name end as customer_name,
  case when seq % 19 = 0 then cast(null as varchar(60))
       when seq % 23 = 0 then 'not-an-email'
       when seq % 4 = 0 then upper(replace(customer_email, '@gmail.com', '@googlemail.com'))
       when seq % 4 = 1 then ' ' || replace(customer_email, '@outlook.com', '@hotmail.com') || ' '
       when seq % 4 = 2 then replace(customer_email, '@yahoo.com', '@ymail.com')
       else customer_email end as customer_email,
  case when seq % 47 = 0 then cast(null as varchar(40))
       when seq % 3 = 0 then {_pick('part_key % 10', _SPELLINGS)}
       when seq % 3 = 1 then upper(product)
       else product end as product,
  case when seq % 11 = 0 then cast(null as varchar(20))
       when seq % 3 = 0 then {_pick('part_key % 5', ['tech', 'game', 'reading', 'home', 'sport'])}
       else product_category end as product_category,
  case when seq % 53 = 0 then cast(null as varchar(20))
       when seq % 59 = 0 then '0'
       when seq % 61 = 0 then '-1'
       when seq % 67 = 0 then '5000'
       when seq % 71 = 0 then '2.5'
       when seq % 73 = 0 then 'two'
       else cast(quantity as varchar(20)) end as quantity,
  case when seq % 79 = 0 then cast(null as varchar(30))
       when seq % 83 = 0 then '-100'
       when seq % 89 = 0 then '60000.00'
       when seq % 8 = 0 then '$' || cast(cast(price as decimal(12,2)) as varchar(30))
       when seq % 8 = 1 then cast(cast(price as decimal(12,2)) as varchar(30)) || ' USD'
       when seq % 97 = 0 then 'n/a'
       else cast(cast(price as decimal(12,2)) as varchar(30)) end as price,
  case when seq % 13 = 0 then cast(null as varchar(30))
       when seq % 101 = 0 then '-5'
       else cast(cast(discount as decimal(12,2)) as varchar(30)) end as discount,
  case when seq % 103 = 0 then cast(null as varchar(30))
       when seq % 17 = 0 then cast(cast(total_amount + 7 as decimal(14,2)) as varchar(30))
       else cast(cast(total_amount as decimal(14,2)) as varchar(30)) end as total_amount,
  case when seq % 107 = 0 then cast(null as varchar(30))
       when seq % 109 = 0 then '2030-12-31'
       when seq % 113 = 0 then '1985-06-15'
       when seq % 127 = 0 then 'invalid-date'
       when seq % 9 = 0 then substr(iso, 6, 2) || '/' || substr(iso, 9, 2) || '/' || substr(iso, 1, 4)
       when seq % 9 = 1 then substr(iso, 9, 2) || '-' || substr(iso, 6, 2) || '-' || substr(iso, 1, 4)
       when seq % 9 = 2 then replace(iso, '-', '/')
       else iso end as order_date,
  case when seq % 15 = 0 then cast(null as varchar(20))
       when seq % 15 = 1 then 'Web'
       when seq % 15 = 2 then 'APP'
       when seq % 15 = 3 then 'shop'
       when seq % 15 = 4 then 'telephone'
       when seq % 15 = 5 then 'api'
       when seq % 15 = 6 then 'affiliate'
       else source end as source,
  case when seq % 14 = 0 then cast(null as varchar(40))
       when seq % 4 = 0 then {_pick('supp_key % 8', _CITY_ALIASES)}
       when seq % 4 = 1 then upper(store_location)
       else store_location end as store_location,
  notes,
  case when seq % 131 = 0 then cast(null as varchar(20)) when seq % 3 = 0 then upper(status) else status end as status,
  case when seq % 5 = 0 then phone
       when seq % 5 = 1 then translate(phone, '(). ', '')
       when seq % 5 = 2 then '+1 ' || translate(phone, '().', '   ')
       when seq % 5 = 3 then '12345'
       else replace(replace(phone, '(', ''), ') ', '-') end as phone,
  address
from (select r.*, cast(cast(order_date as date) as varchar(10)) as iso from {{orders_raw}} r) t
"""

CUSTOMERS = """
select c.c_custkey as customer_id, 'CUST-' || lpad(cast(c.c_custkey % 1000 as varchar(10)), 3, '0') as customer_code,
  c.c_name as name, c.c_mktsegment as tier, c.c_acctbal as acctbal, n.n_name as nation
from {customer} c join {nation} n on c.c_nationkey = n.n_nationkey
"""

# one metric reading per event
METRICS = """
select event_id as metric_id, event_type as name, value, ts, user_id,
  'P' || cast(user_id as varchar(20)) as pipeline_id,
  case event_id % 5 when 0 then 'ingestion' when 1 then 'validation' when 2 then 'transformation' when 3 then 'storage' end as stage,
  '{{"pipeline_id": "P' || cast(user_id as varchar(20)) || '", "host": "h' || cast(event_id % 7 as varchar(5)) || '"}}' as tags
from {events}
"""

# readings under the names the pipeline reports look for
RUN_METRICS = """
select metric_id, pipeline_id, ts, stage, tags,
  case name when 'click' then 'total_execution_time' when 'view' then 'throughput' when 'purchase' then 'records_processed'
            when 'signup' then 'stage_time' else 'execution_failed' end as metric_name,
  case name when 'click' then 'pipeline.execution_time'
            when 'view' then 'pipeline.stage.' || coalesce(stage, 'other') || '.execution_time'
            when 'purchase' then 'pipeline.data_quality.score'
            when 'signup' then 'pipeline.successes'
            else case when metric_id % 2 = 0 then 'pipeline.failures' else 'pipeline.errors' end end as long_name,
  value
from {metrics}
"""

# share of non-error events per pipeline and hour
QUALITY_METRICS = """
select pipeline_id, hour_start as ts, total_records, valid_records,
  valid_records * 100.0e0 / total_records as quality_score
from (select 'P' || cast(user_id as varchar(20)) as pipeline_id, {hour:ts} as hour_start,
        count(*) as total_records, count(case when event_type <> 'error' then 1 end) as valid_records
      from {events} group by 1, 2) q
"""

# one metrics record per pipeline and hour; a metric without readings is null
SNAPSHOTS = """
select 'P' || cast(user_id as varchar(20)) as pipeline_id, {hour:ts} as ts,
  max(case when event_type = 'click' then value * 10 end) as execution_time,
  min(case when event_type = 'view' then value end) as throughput,
  min(case when event_type = 'purchase' then value end) as data_quality_score,
  max(case when event_type = 'error' then value / 1000 end) as error_rate,
  max(case when event_type = 'signup' then value end) as cpu_usage,
  cast(null as double) as memory_usage, cast(null as double) as disk_usage,
  max(case when event_type = 'error' and value > 100 then 0 when event_type = 'error' then 1 end) as pipeline_success,
  count(*) as records_processed,
  count(case when event_type = 'error' then 1 end) as error_count,
  count(case when event_type <> 'error' then 1 end) * 100.0e0 / count(*) as success_rate
from {events} group by 1, 2
"""

ALERTS = """
select event_id as alert_id, 'rule_' || event_type as rule, 'P' || cast(user_id as varchar(20)) as pipeline_id, ts,
  case when value >= 150 then 'CRITICAL' when value >= 80 then 'HIGH' when value >= 30 then 'MEDIUM' else 'LOW' end as severity,
  case event_id % 3 when 0 then 'ACTIVE' when 1 then 'ACKNOWLEDGED' else 'RESOLVED' end as status,
  case when event_id % 3 = 2 then {plus_minutes:ts|event_id % 180} end as resolved_at,
  case when event_id % 3 = 1 then {plus_minutes:ts|event_id % 90} end as acknowledged_at,
  event_id % 4 = 0 as escalated
from {events}
"""

RUN_EVENTS = """
select event_id, 'RUN-' || cast(user_id as varchar(20)) || '-' || cast(cast(ts as date) as varchar(10)) as run_id,
  'J' || cast(user_id % 10 as varchar(5)) as job_id, ts,
  case event_type when 'purchase' then 'COMPLETED' when 'signup' then 'COMPLETED' when 'error' then 'FAILED' else 'PROCESSING' end as status,
  cast(floor(value) as bigint) as records_processed, value as execution_time
from {events}
"""

# started / completed log lines of a stage
STAGE_LOG = """
select event_id, 'RUN-' || cast(user_id as varchar(20)) || '-' || cast(cast(ts as date) as varchar(10)) as run_id,
  case event_id % 4 when 0 then 'ingestion' when 1 then 'validation' when 2 then 'transformation' else 'storage' end as stage,
  case when event_type in ('click', 'view') then 'stage_started' when event_type in ('purchase', 'signup') then 'stage_completed' else 'stage_error' end as event,
  ts, cast(floor(value * 10) as bigint) as records
from {events}
"""

_VIEWS = {
    "orders_raw": ORDERS_RAW, "orders_dirty": ORDERS_DIRTY, "customers": CUSTOMERS, "metrics": METRICS,
    "run_metrics": RUN_METRICS, "quality_metrics": QUALITY_METRICS, "snapshots": SNAPSHOTS, "alerts": ALERTS,
    "run_events": RUN_EVENTS, "stage_log": STAGE_LOG,
}


def _expand(sql: str, dialect: dict) -> str:
    """Fill `{function:arg|arg}` placeholders, leaving `{table}` ones."""
    return re.sub(r"\{(\w+):([^}]*)\}", lambda m: dialect[m[1]](*m[2].split("|")), sql)


def _tables_in(sql: str) -> list[str]:
    return sorted(set(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", sql)))


_LANDED: dict[tuple[str, str], str] = {}


def land(spark: SparkSession, sf_dir: str, name: str) -> None:
    """Write a view as a table that later queries of this driver read, so that a bench does not time it."""
    path = fresh_path(spark, f"landed-{name}")
    table(spark, sf_dir, name).write.parquet(path)
    _LANDED[sf_dir, name] = path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or a view over given tables."""
    if (sf_dir, name) in _LANDED:
        return spark.read.parquet(_LANDED[sf_dir, name])
    if name not in _VIEWS:
        return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    sql = _expand(_VIEWS[name], _SPARK)
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in _tables_in(sql)})


@functools.cache
def view_sql(name: str) -> str:
    """The view as DuckDB SQL over the given tables."""
    sql = _expand(_VIEWS[name], _DUCK)
    return sql.format(**{t: f"({view_sql(t)})" if t in _VIEWS else t for t in _tables_in(sql)})


def with_views(sql: str) -> str:
    """Prefix `sql` with CTEs for the views it names as `{view}`."""
    names = [n for n in _tables_in(sql) if n in _VIEWS]
    ctes = ", ".join(f"{n} as materialized ({view_sql(n)})" for n in names)
    body = sql
    for n in names:
        body = body.replace("{" + n + "}", n)
    if not ctes:
        return body
    stripped = body.lstrip()
    for start in ("with recursive ", "with "):
        if stripped.lower().startswith(start):
            return f"{start}{ctes}, {stripped[len(start):]}"
    return f"with {ctes} {stripped}"
