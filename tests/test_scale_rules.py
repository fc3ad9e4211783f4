"""What must hold at any size: no caps, no silent nulls, ranges by rows, owned stages, one pass upserts."""

import os
import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ordermill import session
from ordermill.functions import numeric as N
from ordermill.operators import alerting, ranking, reads
from ordermill.operators.quality import column_profile
from ordermill.sources.sinks import upsert


def test_large_amounts_and_quantities_stay(one):
    assert one([99999999999999.0, 1e14, 1.2e20, 2.005, None], N.round_money, "double") == [99999999999999.0, 1e14, 1.2e20, 2.01, None]
    assert one([3e9, 2.5, None], N.to_quantity, "double") == [3_000_000_000, 2, None]
    got = one([1e14, 1e40, 5.0], lambda c: N.differ(c, F.lit(5.0), 0.01), "double")
    assert got == [True, True, False]


@pytest.mark.parametrize("fraction", [0.0005, 0.3, 0.4, 0.7])
def test_sampling_meets_any_fraction(spark, fraction):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    assert reads.sample_rows(df, "systematic", ["k"], fraction).count() == int(20_000 * fraction + 1e-9)
    assert abs(reads.sample_rows(df, "random", ["k"], fraction, 3).count() - 20_000 * fraction) < 4 * (20_000 * fraction) ** 0.5 + 2


def test_alert_conditions_are_resolved_by_the_analyzer(spark):
    df = spark.createDataFrame([(1, -5.0), (2, 4.0), (3, None)], "id int, value double")
    conditions = ["abs(value) > 3", "value is not null", "value between 1 and 20", "value is null", "value>3", "case when value < 0 then true end", "absent > 1"]
    rules = [{"rule": c, "condition": c, "severity": "LOW", "cooldown": 0} for c in conditions]
    got = [(r.rule, r.id) for r in alerting.evaluate_alert_rules(df, rules).collect()]
    want = {"abs(value) > 3": {1, 2}, "value is not null": {1, 2}, "value between 1 and 20": {2}, "value is null": {3}, "value>3": {2}, "case when value < 0 then true end": {1}}
    assert sorted(got) == sorted((c, i) for c, ids in want.items() for i in ids)
    assert alerting.evaluate_alert_rules(df, [{**r, "enabled": False} for r in rules]).count() == 0
    with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR"):
        alerting.evaluate_alert_rules(df, [{"rule": "x", "condition": "value >", "severity": "LOW", "cooldown": 0}])


def test_ranges_grow_with_the_rows_also_for_one_key(spark):
    df = spark.range(5000).select(F.lit("k").alias("key"), "id")
    chunks = ranking.range_chunks(df, ["key"], ["id"], chunk_rows=500).groupBy("chunk").count().collect()
    assert len(chunks) == 10 and max(r["count"] for r in chunks) < 1500


def test_stages_are_removed_by_their_owner(spark):
    with session.stages(spark):
        session.materialize(spark.range(3), "owned")
        path = session._STAGES[-1]
        assert os.path.exists(path.removeprefix("file:"))
    assert not os.path.exists(path.removeprefix("file:"))


def test_shared_folder_is_required():
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(unset)


def test_upsert_reads_each_side_once(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), (None, 5)], "k string, v int").write.parquet(f"{tmp_path}/base")
    spark.createDataFrame([("a", 10, 1), ("a", 11, 2), ("c", 12, 1), (None, 13, 1)], "k string, v int, at int").write.parquet(f"{tmp_path}/delta")
    base, delta = spark.read.parquet(f"{tmp_path}/base"), spark.read.parquet(f"{tmp_path}/delta")
    out = upsert(base, delta, ["k"], [F.desc("at")])
    assert sorted((r.k or "", r.v) for r in out.collect()) == [("", 4), ("", 5), ("", 13), ("a", 11), ("b", 2), ("b", 3), ("c", 12)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", plan.partition("Initial Plan")[0])) == 2


def test_profile_does_not_multiply_rows(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 1.0, None), ("b", -0.0, None), (None, 0.0, None)], "s string, d double, n int")
    profile = column_profile(df)
    assert {r.column_name: r.distinct_count for r in profile.collect()} == {"s": 2, "d": 2, "n": 0}
    assert "Expand" not in profile._jdf.queryExecution().executedPlan().toString()
