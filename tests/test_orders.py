from pyspark.sql import functions as F

from ordermill.operators import cleaning as K
from ordermill.operators import dedup as D
from ordermill.operators import enrich as E
from ordermill.operators import joins as J
from ordermill.operators import reads as Q
from ordermill.operators import standardize as Z
from ordermill.plans.order_flow import FlowConfig, run_pipeline
from ordermill.sources import mappings as M
from ordermill.sources import sinks

AS_OF = "2024-02-01 00:00:00"


def messy(spark):
    rows = [
        (1, "ORD-2024-001", "  john doe  ", "iphone 15", "1.0", "999.99", "2024-01-15", "web", "JOHN@EXAMPLE.COM", "0", "ny"),
        (2, "ORD-2024-001", "  john doe  ", "iphone 15", "1.0", "999.99", "2024-01-15", "web", "JOHN@EXAMPLE.COM", "0", "ny"),
        (3, "ORD-2024-002", "", "macbook pro", "-1", "-100", "2025-12-31", "app", "invalid-email", "50.0", "los angeles ca"),
        (4, "ORD-2024-003", "Jane Smith", "airpods pro", "2", "249.99", "2024-01-16", "retail", "jane@example.com", None, "chicago il"),
    ]
    return spark.createDataFrame(rows, "n int, order_id string, customer_name string, product string, quantity string, price string, order_date string, source string, customer_email string, discount string, store_location string")


def test_clean_orders(spark):
    got = K.clean_orders(messy(spark), AS_OF, ["n"]).orderBy("n").collect()
    assert [(r.customer_name, r.product, r.source, r.store_location, r.customer_email, r.quantity, r.discount) for r in got] == [
        ("John Doe", "iPhone 15", "website", "New York", "john@example.com", 1, 0.0),
        ("Jane Smith", "AirPods Pro", "store", "Chicago", "jane@example.com", 2, 0.0),
    ]


def test_dedup_keeps_first_whatever_the_partitioning(spark):
    rows = spark.createDataFrame([(i, i % 7 if i % 3 else None, i * 2) for i in range(500)], "n int, k int, v int")
    want = {}
    for i in range(500):
        want.setdefault(i % 7 if i % 3 else None, i)
    for parts in (1, 8):
        got = D.dedup_by_key(rows.repartition(parts), ["k"], ["n"]).collect()
        assert {r.k: r.n for r in got} == want


def test_duplicate_report(spark):
    rows = spark.createDataFrame([("001",), ("001",), ("002",)], "order_id string")
    assert tuple(D.duplicate_keys_report(rows, "order_id").first()) == (2, 1, "001")


def test_flow_runs_end_to_end(spark, tmp_path):
    rows = messy(spark).withColumn("total_amount", F.expr("try_cast(quantity as double) * try_cast(price as double)"))
    config = FlowConfig(AS_OF, ["n"], store_path=str(tmp_path / "store"), export_path=str(tmp_path / "out"))
    result = run_pipeline([rows], config)
    assert {s: m["records"] for s, m in result.stages.items() if "records" in m} == {"ingestion": 4, "cleaning": 2, "standardization": 2, "enrichment": 2}
    assert result.data.count() == 2 and spark.read.option("header", True).csv(str(tmp_path / "out" / "csv")).count() == 2
    assert result.passed_validation is True and result.stages["validation"]["quality_score"] == 75
    again = run_pipeline([rows.filter("n = 4").withColumn("price", F.lit("300.00"))], FlowConfig(AS_OF, ["n"], base_path=str(tmp_path / "store"), store_path=str(tmp_path / "store2")))
    assert {r.order_id: r.price for r in again.data.collect()} == {"ORD-2024-001": 999.99, "ORD-2024-003": 300.0}


def test_flow_stages_can_be_left_out(spark, sample_orders):
    config = FlowConfig(AS_OF, ["order_id"], validate=False, standardize=False, enrich=False)
    result = run_pipeline([sample_orders, sample_orders], config)
    assert set(result.stages) == {"ingestion", "cleaning"} and result.data.count() == 3


def test_standardize(spark):
    rows = spark.createDataFrame([("ord2024001", "$999.99", "jane@hotmail.com", "123 main st, ny"), (None, "1,999.99", None, None)], "order_id string, price string, customer_email string, address string")
    got = Z.standardize_orders(rows, AS_OF).collect()
    assert tuple(got[0])[:4] == ("ORD-2024-001", 999.99, "jane@outlook.com", "123 Main Street, New York") and got[1].price == 1999.99


def test_segments_and_risk(spark):
    big = [("A", 600.0, i) for i in range(10)]
    rows = spark.createDataFrame([*big, ("B", 50.0, 99), (None, 10.0, 100)], "customer_name string, total_amount double, n int")
    got = {r.n: (r.customer_segment, r.customer_priority) for r in J.segment_back_join(rows).collect()}
    assert got[0] == ("VIP", 1) and got[99] == ("Budget", 4) and got[100] == ("Budget", 4) and len(got) == 12


def test_enrich_fills_every_column(spark, sample_orders):
    out = E.enrich_orders(sample_orders, AS_OF)
    r = out.filter("order_id = 'ORD-2024-002'").first()
    assert (r.product_brand, r.order_size_category, r.season, r.channel_type, r.order_weekday) == ("Apple", "XLarge", "Winter", "Physical", "Tuesday")
    assert abs(r.discount_percentage - 100 / 1999.99 * 100) < 1e-9 and r.revenue_contribution_pct == 55.88 and r.risk_score == 80


def test_upsert_replaces_whole_rows(spark):
    base = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, note string")
    delta = spark.createDataFrame([("b", 3, 1), ("b", 4, 2), ("c", 5, 1)], "k string, v int, seq int")
    got = {tuple(r) for r in sinks.upsert(base, delta, ["k"], [F.desc("seq")]).collect()}
    assert got == {("a", 1, "x"), ("b", 4, None), ("c", 5, None)}


def test_store_types_and_projection(spark):
    rows = spark.createDataFrame([("nan", None, float("nan"), True), ("x", 1, float("inf"), None)], "s string, i int, f double, b boolean")
    got = sinks.prepare_for_store(rows, AS_OF).select("s", "i", "f", "b", "created_at").collect()
    assert [tuple(r) for r in got] == [(None, 0, 0.0, 1, AS_OF), ("x", 1, 0.0, None, AS_OF)]
    assert sinks.project_to_table(rows, ["id", "s", "zz"]).columns == ["s"]


def test_reads(spark, sample_orders):
    assert Q.get_orders(sample_orders, {"source": ["store", "website"]}, 1, 1, ["order_id"]).first().order_id == "ORD-2024-002"
    assert Q.delete_where(sample_orders, {"source": "store"}).count() == 2
    assert Q.update_where(sample_orders, {"source": "x"}, {"order_id": "ORD-2024-001"}).filter("source = 'x'").count() == 1
    hostile = "'; DROP TABLE orders; --"
    assert Q.custom_sql(spark, "select * from {t} where order_id = :id", {"t": sample_orders}, {"id": hostile}).count() == 0


def test_sources_combine(spark):
    a = spark.createDataFrame([("1", 1), ("2", 2)], "order_id string, n int")
    b = spark.createDataFrame([("2", 9, "e"), ("3", 3, "e")], "order_id string, n int, email string")
    got = {r.order_id: (r.n, r.email) for r in M.combine_sources_dedup([a, b], ["order_id"], ["n"]).collect()}
    assert got == {"1": (1, None), "2": (2, None), "3": (3, "e")}
    numbered = M.align_and_union_sources({"csv": a, "json": b}, ["source_type", "order_id"], AS_OF)
    assert sorted((r.record_id, r.source_type, r.order_id) for r in numbered.collect()) == [(1, "csv", "1"), (2, "csv", "2"), (3, "json", "2"), (4, "json", "3")]
