from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ordermill.sources.bucketed import BucketedTable, VersionConflict


def files(path, part=None):
    return {str(f.relative_to(path)) for f in Path(path, "data").rglob("*.parquet") if part is None or part in f.parts}


@pytest.fixture
def table(spark, tmp_path):
    rows = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"), F.lit("old").alias("note"))
    return BucketedTable.create(rows, str(tmp_path / "t"), ["k"], buckets=100)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_one_bucket_of_a_hundred_rewrites_one_file_of_a_hundred(spark, table):
    before, old = files(table.path), table.manifest()
    assert len(before) == 100
    assert table.upsert(spark.createDataFrame([(7, -1)], "k int, v bigint"), [F.desc("v")]) == 1
    new = table.manifest()
    moved = {b for b in new.parts if new.parts[b] != old.parts[b]}
    assert len(moved) == 1 and len(files(table.path) - before) == 1
    assert table.read().count() == 5000
    assert table.read().filter("k = 7").collect() == [(7, -1, None)]
    assert table.read(0).filter("k = 7").collect() == [(7, 14, "old")]


def test_upsert_equals_a_plain_merge(spark, table):
    delta = spark.createDataFrame([(k, s, f"{k}-{s}") for k in (1, 3, 4999, 5000, 6000) for s in (1, 2)], "k bigint, v bigint, note string")
    want = {r["k"]: tuple(r) for r in table.read().collect()} | {k: (k, 2, f"{k}-2") for k in (1, 3, 4999, 5000, 6000)}
    table.upsert(delta.withColumn("extra", F.lit(1)), [F.desc("v")])
    assert rows_of(table.read()) == sorted(want.values(), key=str)
    assert rows_of(table.lookup(spark.createDataFrame([(1,), (6000,), (9999,)], "k int"))) == sorted([want[1], want[6000]], key=str)


def test_a_retried_batch_gives_the_same_version(spark, table):
    delta = spark.createDataFrame([(1, 100)], "k bigint, v bigint")
    assert table.upsert(delta, ["v"], source="s", batch=0) == 1
    assert table.upsert(delta.withColumn("v", F.lit(7)), ["v"], source="s", batch=0) == 1
    assert table.read().filter("k = 1").first()["v"] == 100
    assert table.upsert(delta, ["v"], source="other", batch=0) == 2
    assert table.upsert(delta.limit(0), ["v"], source="s", batch=1) == 3, "an empty batch is on record too"
    assert table.manifest().parts == table.manifest(2).parts


def test_a_write_that_was_not_committed_is_not_seen_and_goes(spark, table):
    table._write(table._dealt(table.read().withColumn("v", F.lit(0)), table.manifest()))
    assert len(files(table.path)) == 200 and table.read().filter("v = 0").count() == 1
    table.vacuum()
    assert len(files(table.path)) == 100 and table.read().count() == 5000


def test_two_writers_of_one_version(table):
    with pytest.raises(VersionConflict):
        table._commit(table.manifest())
    with pytest.raises(VersionConflict):
        BucketedTable.create(table.read(), table.path, ["k"])


def test_vacuum_keeps_what_the_last_versions_name(spark, table):
    for v in range(4):
        table.upsert(spark.createDataFrame([(7, v), (8 + v, v)], "k bigint, v bigint"), ["v"])
    want = [rows_of(table.read(v)) for v in (3, 4)]
    table.vacuum(keep=2)
    assert table.versions() == [3, 4] and [rows_of(table.read(v)) for v in (3, 4)] == want
    named = {(p, b) for v in (3, 4) for b, p in table.manifest(v).parts.items()}
    held = {(Path(f).parts[1], int(Path(f).parts[2].partition("=")[2])) for f in files(table.path)}
    assert held == named
    with pytest.raises(FileNotFoundError):
        table.read(0)


def test_null_keys_repeated_rows_and_an_empty_table(spark, tmp_path):
    schema = "a string, b int, v int"
    empty = BucketedTable.create(spark.createDataFrame([], schema), str(tmp_path / "e"), ["a", "b"], buckets=8)
    assert empty.read().schema.simpleString() == "struct<a:string,b:int,v:int>" and empty.read().count() == 0
    assert empty.upsert(spark.createDataFrame([], schema), ["v"]) == 0
    empty.upsert(spark.createDataFrame([("x", None, 1), ("x", 1, 1), (None, None, 5)], schema), ["v"])
    empty.upsert(spark.createDataFrame([("x", None, 2), ("x", 1, 2)], schema), ["v"])
    assert rows_of(empty.read()) == sorted([("x", None, 1), ("x", None, 2), ("x", 1, 2), (None, None, 5)], key=str)
    twice = BucketedTable.create(spark.createDataFrame([("x", 1, 1)] * 1000 + [("y", 1, 1)], schema), str(tmp_path / "r"), ["a", "b"], buckets=8)
    twice.upsert(spark.createDataFrame([("x", 1, 9)], schema), ["v"])
    assert rows_of(twice.read()) == [("x", 1, 9), ("y", 1, 1)]


def test_inexact_keys_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        BucketedTable.create(spark.createDataFrame([(1.0,)], "k double"), str(tmp_path / "x"), ["k"])
