import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ordermill import session
from ordermill.catalog import ingest, orders
from ordermill.catalog.ingest import finish
from ordermill.operators import dedup as D
from ordermill.operators import enrich as E
from ordermill.session import fresh_path, materialize
from ordermill.sources import files, incremental
from ordermill.streaming import jobs

AS_OF = "2024-02-01 00:00:00"
SHORT = files.text_schema(["order_id", "customer_name", "product"])


def put(folder, name, text, encoding="utf-8"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding=encoding)
    return str(folder)


def test_csv_encoding_and_ragged_rows(spark, tmp_path):
    src = put(tmp_path / "c", "a.csv", "order_id,customer_name,product\nO1,José García,Café Special\n", "latin-1")
    got = files.read_csv_orders(spark, src, AS_OF, "ISO-8859-1", SHORT).collect()
    assert [(r.customer_name, r.product, r.source_file, r.source_type) for r in got] == [("José García", "Café Special", "a.csv", "file_csv")]
    src = put(tmp_path / "r", "b.csv", "order_id,customer_name,product\nO1,x\nO2,a,b,c\nO3,a,b\n")
    rows = {r.order_id: (r.product, r._corrupt_record) for r in files.read_csv_orders(spark, src, AS_OF, schema=SHORT).collect()}
    assert rows["O3"] == ("b", None) and rows["O2"][1] == "O2,a,b,c" and rows["O1"][0] is None


def test_json_shapes(spark, tmp_path):
    order = {"order_id": "O1", "customer_name": "A", "device_info": {"model": "M", "os_version": "17"}}
    shapes = {"orders.json": {"app_version": "2", "orders": [order]}, "data.json": {"data": [order]}, "items.json": {"items": [order]}, "array.json": [order], "single.json": order}
    for name, doc in shapes.items():
        put(tmp_path / "j", name, json.dumps(doc, indent=1))
    put(tmp_path / "j", "bad.json", "{ not json")
    put(tmp_path / "j", "empty.json", json.dumps({"orders": []}))
    src = str(tmp_path / "j")
    got = files.flatten_nested_orders(files.read_json_orders(spark, src, AS_OF)).collect()
    assert sorted(r.source_file for r in got) == sorted(shapes) and {(r.order_id, r.device_model) for r in got} == {("O1", "M")}
    assert {r.source_file: r.app_version for r in got}["orders.json"] == "2"
    assert sorted(r.source_file for r in files.read_many_files(spark, src, "json", AS_OF).collect()) == sorted(shapes)
    envelopes = files.read_json_envelopes(spark, src, AS_OF)
    assert sum(r._corrupt_record is not None for r in envelopes.select("_corrupt_record", "order_id").collect()) == 1


def test_structure_profile_and_admission(spark, tmp_path):
    src = put(tmp_path / "p", "a.json", json.dumps({"n": 1, "orders": [1, 2], "meta": {"x": 1}, "s": "t", "f": 1.5, "b": True, "z": None}))
    put(tmp_path / "p", "b.txt", "x")
    put(tmp_path / "p", "c.csv", "")
    docs = files.read_json_documents(spark, src + "/a.json")
    kinds = {r.key: (r.kind, r.length) for r in files.json_structure_profile(docs).collect()}
    assert kinds["orders"] == ("list", 2) and kinds["meta"][0] == "dict" and kinds["n"][0] == "int" and kinds["f"][0] == "float" and kinds["s"][0] == "str" and kinds["z"][0] == "null"
    verdict = {r.file: (r.accepted, r.reason) for r in files.file_admission(spark, src).collect()}
    assert verdict == {"a.json": (True, None), "b.txt": (False, "unsupported type"), "c.csv": (False, "empty")}
    assert [r.reason for r in files.file_admission(spark, src + "/none").collect()] == ["missing"]
    assert {r.file: r.md5 is not None for r in files.file_admission(spark, [src]).collect()} == {"a.json": True, "b.txt": False, "c.csv": False}
    texts = spark.createDataFrame([(1, '{"a": "123", "b": "[x", "c": "true", "d": "1.5", "e": 1.0, "f": 123456789012345678901234567890}'), (2, "no json"), (3, None)], "id int, value string")
    assert {r.key: r.kind for r in files.json_structure_profile(texts).collect()} == {"a": "str", "b": "str", "c": "str", "d": "str", "e": "float", "f": "int"}


def test_csv_by_header_names(spark, tmp_path):
    """The seven-column store file, a file in another order with columns of its own, latin-1 text and an empty file."""
    src = put(tmp_path / "h", "a.csv", "order_id,customer_name,product,quantity,price,order_date,store_location\nO1,Ann,Lamp,2,9.5,2024-01-01,Rome\n")
    put(tmp_path / "h", "b.csv", "created_at,price,order_id,notes\n2024,7,O2,hi\n")
    put(tmp_path / "h", "c.csv", "order_id,customer_name\nO3,José García\n", "latin-1")
    put(tmp_path / "h", "d.csv", "\ufefforder_id,customer_name\nO4,Zoë\n")
    put(tmp_path / "h", "e.csv", "")
    rows = files.read_csv_orders(spark, src, AS_OF)
    got = {r.order_id: r for r in rows.collect()}
    assert set(got) == {"O1", "O2", "O3", "O4"} and all(r._corrupt_record is None for r in got.values())
    assert (got["O1"].product, got["O1"].quantity, got["O1"].store_location, got["O1"].customer_email) == ("Lamp", "2", "Rome", None)
    assert (got["O2"].price, got["O2"].notes, got["O2"].created_at) == ("7", "hi", "2024") and got["O1"].created_at is None
    assert (got["O3"].customer_name, got["O4"].customer_name) == ("José García", "Zoë")
    told = {r.source_file: r.status for r in files.ingest_file_summary(materialize(rows), files.list_files(spark, src)).collect()}
    assert told == {"a.csv": "success", "b.csv": "success", "c.csv": "success", "d.csv": "success", "e.csv": "failed", "(all)": "4/5"}
    assert files.read_csv_orders(spark, src + "/none", AS_OF).count() == 0


def test_compressed_and_half_readable_files(spark, tmp_path):
    import gzip
    import random

    rnd = random.Random(1)
    lines = "order_id,customer_name,product\n" + "".join(f"O{i},n{rnd.random()},p\n" for i in range(20_000))
    src = put(tmp_path / "z", "a.csv", "order_id,customer_name,product\nA1,x,y\n")
    packed = gzip.compress(lines.encode())
    (tmp_path / "z" / "b.csv.gz").write_bytes(packed)
    rows = materialize(files.read_many_files(spark, src, "csv", AS_OF, schema=SHORT))
    assert rows.count() == 20_001 and rows.filter("order_id = 'O7' and product = 'p'").count() == 1
    (tmp_path / "z" / "c.csv.gz").write_bytes(packed[: len(packed) // 2])
    for read in (lambda: files.read_many_files(spark, src, "csv", AS_OF, schema=SHORT), lambda: files.read_csv_typed(spark, src, "order_id string, customer_name string")):
        with pytest.raises(Exception, match="(?i)end of (input|file)|EOF|FAILED_READ_FILE"):
            read().write.format("noop").mode("overwrite").save()
    some = materialize(files.read_many_files(spark, src, "csv", AS_OF, schema=SHORT, skip_unreadable=True))
    assert some.count() == 20_001
    told = {r.source_file: r.status for r in files.ingest_file_summary(some, files.list_files(spark, src)).collect()}
    assert told == {"a.csv": "success", "b.csv.gz": "success", "c.csv.gz": "failed", "(all)": "2/3"}
    assert files.read_many_files(spark, src + "/c*", "json", AS_OF, skip_unreadable=True).count() == 0


@pytest.fixture
def line_tables(spark, tmp_path):
    """A folder with 3000 order lines; their join is shuffled while the fixture is in use."""
    lines = spark.range(3000).select(
        F.expr("id div 3").alias("l_orderkey"), (F.col("id") % 50).alias("l_partkey"), (F.col("id") % 9).alias("l_suppkey"), (F.col("id") % 3 + 1).cast("int").alias("l_linenumber"),
        F.lit(2.0).alias("l_quantity"), (F.col("id") * 0.5 + 10).alias("l_extendedprice"), F.lit(0.05).alias("l_discount"))
    orders = spark.range(1000).select(F.col("id").alias("o_orderkey"), (F.col("id") % 70).alias("o_custkey"), F.expr("timestamp_ntz'2001-03-04 00:00:00'").alias("o_orderdate"))
    lines.write.parquet(f"{tmp_path}/sf/lineitem.parquet")
    orders.write.parquet(f"{tmp_path}/sf/orders.parquet")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    yield f"{tmp_path}/sf"
    spark.conf.set(threshold, before)


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (found.apply(i).getName() for i in range(found.size())) if f.startswith("shuffle_")}


def landed(spark, path):
    """Bytes on disk and of text, by what the files' names and contents say."""
    import gzip
    from pathlib import Path

    names = [f for _, f, _, _ in files.list_files(spark, path)]
    raw = [Path(f.removeprefix("file:")).read_bytes() for f in names]
    assert names and all(f.endswith(".gz") for f in names)
    return sum(map(len, raw)), sum(len(gzip.decompress(r)) for r in raw)


def test_landed_csv_and_json_are_packed_and_leave_no_shuffle(spark, line_tables, monkeypatch):
    """read_many_files: both landings take a fraction of their text on disk, in files of bounded rows, and give all rows back."""
    monkeypatch.setitem(ingest.PACKED, "maxRecordsPerFile", 200)
    before = shuffle_files(spark)
    paths = [ingest.landed_csv(spark, line_tables), ingest.landed_json(spark, line_tables)]
    assert not shuffle_files(spark) - before
    for path in paths:
        packed, text = landed(spark, path)
        assert packed * 3 < text and len(files.list_files(spark, path)) >= 15
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    kinds = ingest.read_many_files(spark, line_tables).groupBy("source_type").agg(F.count("*").alias("n"), F.count_distinct("product").alias("products")).collect()
    wanted = ingest.dirty(spark, line_tables).agg(F.count_distinct("product")).first()[0]
    assert {(r.source_type, r.n, r.products) for r in kinds} == {("file_csv", 3000, wanted), ("file_json", 3000, wanted)}


def test_json_lands_by_slices_of_the_orders(spark, line_tables, monkeypatch):
    """read_many_files: no more than a part of the rows is joined, and so shuffled, at once; the parts are all rows."""
    counts, plain = [], ingest._envelopes
    monkeypatch.setattr(ingest, "_envelopes", lambda rows: (counts.append(rows.count()), plain(rows))[1])
    path = ingest.landed_json(spark, line_tables)
    assert sum(counts) == 3000 and max(counts) < 1500
    assert spark.read.text(path).count() == 3000


def disk_of(spark, query, sf, names, monkeypatch):
    """The rows of a query, and bytes on disk against bytes of text of the one folder it lands in."""
    paths = []
    monkeypatch.setattr(ingest, "fresh", lambda s, name: (paths.append(fresh_path(s, name)), paths[-1])[1])
    before = shuffle_files(spark)
    rows = query(spark, sf)
    assert not shuffle_files(spark) - before and len(paths) == 1
    return sorted(map(str, rows.select(*names).collect())), *landed(spark, paths[0])


def test_read_json_orders_lands_packed_documents(spark, line_tables, monkeypatch):
    names = ["order_id", "customer_name", "quantity", "price", "notes", "app_version"]
    got, packed, text = disk_of(spark, ingest.read_json_orders, line_tables, names, monkeypatch)
    assert packed * 3 < text
    version = F.when(F.col("seq") % 4 < 3, "2.1").alias("app_version")
    assert got == sorted(map(str, ingest.dirty(spark, line_tables).select(*names[:-1], version).collect()))


def test_flatten_nested_orders_lands_packed_documents(spark, line_tables, monkeypatch):
    names = ["order_id", "customer_name", "device_model", "device_os", "app_version", "app_platform", "upload_timestamp"]
    got, packed, text = disk_of(spark, ingest.flatten_nested_orders, line_tables, names, monkeypatch)
    assert packed * 3 < text
    whole = F.col("seq") % 4 < 3
    lifted = [F.lit("M1").alias("device_model"), F.col("line_no").cast("string").alias("device_os"), F.when(whole, "9").alias("app_version"),
              F.when(whole, "ios").alias("app_platform"), F.when(whole, "2001-12-30").alias("upload_timestamp")]
    assert got == sorted(map(str, ingest.dirty(spark, line_tables).select(*names[:2], *lifted).collect()))


def test_enrich_orders_keeps_one_packed_copy_on_disk(spark, line_tables):
    """No shuffle and no stage but the cleaned rows is left before the last join, which carries no computed column; same rows as unsliced."""
    before, first = shuffle_files(spark), len(session._STAGES)
    rows = orders.enrich_orders(spark, line_tables)
    assert not shuffle_files(spark) - before
    left = {path: [f for _, f, size, _ in files.list_files(spark, path) if size] for path in session._STAGES[first:]}
    assert [path.rsplit("/", 1)[1].split("-")[0] for path, names in left.items() if names] == ["first"]
    joins = [x for x in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in x]
    below = rows._jdf.queryExecution().optimizedPlan().toString().split("Join LeftOuter")[-1]
    assert joins and "product_brand" not in below and "order_quarter" not in below
    plain = orders.cleaned(spark, line_tables).select(*orders.LINE_ORDER, *orders.CLEANED_COLUMNS)
    wanted = E.enrich_orders(plain, orders.ORDERS_AS_OF).drop("enriched_at", "enrichment_version")
    assert rows.columns == wanted.columns and rows.count() > 100
    assert sorted(map(str, rows.collect())) == sorted(map(str, wanted.collect()))


def test_dedup_in_slices_is_dedup_by_key(spark):
    keys = [None, "a", "b", "c", "d"]
    made = [(keys[i % 5], keys[i * 7 % 5], i % 3, i // 2) for i in range(200)] + [(f"k{i}", None, None, i) for i in range(50)] * 2
    rows = spark.createDataFrame(made, "k string, v string, w int, n int")
    order = ["n", "v", "w"]
    plain = D.dedup_by_key(D.dedup_by_key(rows, ["k", "w"], order), ["v", "w"], order).withColumn("twice", F.col("n") * 2)
    got = D.dedup_in_slices(rows, [["k", "w"], ["v", "w"]], order, 3, lambda d: d.withColumn("twice", F.col("n") * 2))
    assert got.schema == plain.schema and sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    none = D.dedup_in_slices(rows.limit(0), [["k"]], order, 2, lambda d: d)
    assert none.count() == 0 and none.columns == rows.columns


def test_enrich_of_no_orders(spark, sample_orders):
    assert E.enrich_orders(sample_orders.limit(0), AS_OF).count() == 0


def test_incremental_and_jdbc_text(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 20))], "id bigint, ts timestamp_ntz")
    first = incremental.incremental_extract(df, incremental.TIMESTAMP, "ts", AS_OF)
    assert [r.id for r in first.collect()] == [2]
    assert incremental.next_watermark(df, incremental.ID, "id").first()[0] == "2"
    assert incremental.next_watermark(df, incremental.FULL, "id").first()[0] is None
    options = incremental.jdbc_options("jdbc:x", "orders", incremental.ID, "id", 5, ["id"], ("id", "0", "9", 4))
    assert options["dbtable"] == "(select id from orders where id > 5) src" and options["numPartitions"] == "4"


def test_stream_reads_each_file_once(spark, tmp_path):
    src, dst, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    header = "order_id,customer_name,product\n"
    for i in (1, 2):
        put(src, f"f{i}.csv", header + f"O{i},n,p\n")
        finish(jobs.stream_files(spark, str(src), dst, ckpt, str(tmp_path / "archive"), SHORT))
        assert sorted(r.order_id for r in spark.read.parquet(dst).collect()) == [f"O{j}" for j in range(1, i + 1)]


def test_stream_cooldown_state_survives_a_restart(spark, tmp_path):
    src, dst, ckpt = str(tmp_path / "ev"), str(tmp_path / "al"), str(tmp_path / "ck")
    rules = [{"rule": "r", "condition": "v > 0", "severity": "HIGH", "cooldown": 5}]
    start = dt.datetime(2024, 1, 1)
    runs = [[0, 60, 299], [300, 301, 700, 1000]]
    for batch in runs:
        spark.createDataFrame([(s, start + dt.timedelta(seconds=s), 1) for s in batch], "id bigint, ts timestamp_ntz, v int").coalesce(1).write.mode("append").parquet(src)
        rows = jobs.read_files(spark, src, "parquet", spark.read.parquet(src).schema)
        finish(jobs.stream_alerts(rows, dst, ckpt, rules, ["rule"], "id"))
    assert sorted(r.id for r in spark.read.parquet(dst).collect()) == [0, 300, 700, 1000]


def test_stream_upsert_batches(spark, tmp_path):
    from ordermill.sources.bucketed import BucketedTable

    src, dst, ckpt = str(tmp_path / "d"), str(tmp_path / "t"), str(tmp_path / "ck")
    table = BucketedTable.create(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), dst, ["k"], buckets=4)
    for v in (2, 3):
        spark.createDataFrame([("b", v), (f"n{v}", v)], "k string, v int").coalesce(1).write.mode("append").parquet(src)
        rows = jobs.read_files(spark, src, "parquet", spark.read.parquet(src).schema)
        finish(jobs.stream_upsert(rows, dst, ckpt, [F.desc("v")]))
    assert {tuple(r) for r in table.read().collect()} == {("a", 1), ("b", 3), ("n2", 2), ("n3", 3)}
    assert table.versions() == [1, 2] and table.manifest().applied == {ckpt: 1}


SF = "/root/testdata/sf0.001"
CHECKED = ["segment_revenue", "dedup_orders", "validate_orders", "dq_score", "rule_engine", "hourly_rollup", "alert_summary", "business_kpis", "upsert_orders", "date_parts"]


@pytest.mark.parametrize("name", CHECKED)
def test_against_sql(spark, name):
    from oracle import compare, connect

    from __spark_entry__ import oracle_sql, queries

    diff = compare(queries()[name](spark, SF), connect(SF), oracle_sql()[name])
    assert diff == "" or diff.startswith("~"), diff


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
