"""Positions, quantiles and cooldown against brute force, with one key owning most rows."""

import datetime as dt
import random
import statistics

import numpy as np
from pyspark.sql import functions as F

from ordermill.functions.cooldown import _last_emitted
from ordermill.operators import alerting as L
from ordermill.operators import ranking as R


def skewed(spark, n=1000):
    rng = random.Random(3)
    rows = [(i, None if i % 11 == 0 else "hot" if i % 3 else f"k{i % 5}", float(rng.randrange(40))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id int, k string, v double")


def test_positions(spark):
    rows, df = skewed(spark)
    want = {}
    for k in {r[1] for r in rows}:
        for p, r in enumerate(sorted((r for r in rows if r[1] == k), key=lambda r: (r[2], r[0]))):
            want[r[0]] = p
    for parts in ("1", "5"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = {r.id: r.position for r in R.position_in_group(df, ["k"], ["v", "id"]).collect()}
        assert got == want
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_quantiles(spark):
    rows, df = skewed(spark)
    got = {r.k: r for r in R.quantiles(df, ["k"], "v", {"med": ("linear", 0.5), "p95": ("rank", 0.95), "q": ("linear", 0.95)}).collect()}
    for k in {r[1] for r in rows}:
        values = sorted(r[2] for r in rows if r[1] == k)
        assert got[k].med == statistics.median(values)
        assert got[k].p95 == values[int(0.95 * len(values))]
        assert abs(got[k].q - np.quantile(values, 0.95)) < 1e-9


def test_runs_are_bounded_while_rows_grow(spark):
    for rows in (1_000, 100_000):
        df = spark.range(rows).select(F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("at"), "id", F.lit("hot").alias("k"))
        runs = R.sorted_runs(df, ["k"], ["at", "id"], run_rows=50, max_runs=8)
        assert runs.select("_run").distinct().count() == 8
        for keys in ([], ["k"]):
            placed = R.position_in_group(df, keys, ["at", "id"], run_rows=50, max_runs=8)
            ordered = [r.position for r in placed.orderBy("at", "id").select("position").collect()]
            assert ordered == list(range(rows))
    plan = R.position_in_group(df, [], ["at", "id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Window"), "the window is on the side of the offsets"
    assert "_shift" in plan and plan.count("Window ") == 1 and "Aggregate [_run" in plan


ODD = [0.0, -0.0, 5e-324, -5e-324, 1e-310, 2.0**-1000, 1.0, 1.0 + 2**-52, 2.0, 2.0 - 2**-52, 8.0, 1e308, -1e308, 2.0**1023, float("inf"), float("-inf"), float("nan"), 3.0, -3.0, 1e15 + 0.125]


def test_radix_code_never_falls(spark):
    rng = random.Random(1)
    values = ODD + [rng.uniform(-1, 1) * 10.0 ** rng.randint(-320, 307) for _ in range(3000)] + [2.0**e * s for e in range(-1074, 1024) for s in (1, -1)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", R.radix_code(F.col("v")).alias("c")).orderBy("v").collect()
    codes = [r.c for r in rows]
    assert codes == sorted(codes)


def test_quantiles_of_nearly_distinct_values_shuffle_no_rows(spark, monkeypatch):
    rng = random.Random(2)
    rows = [("all" if i % 3 else None, rng.gauss(0, 1) * 10.0 ** rng.randint(-5, 5)) for i in range(20_000)] + [("odd", v) for v in ODD[:15]]
    rows += [("huge", float(2**60 + i)) for i in range(0, 4096, 256)]
    df = spark.createDataFrame(rows, "k string, v double")
    wanted = {"lo": ("rank", 0.0), "med": ("linear", 0.5), "p99": ("rank", 0.99), "top": ("linear", 1.0)}
    got = {r.k: r for r in R.quantiles(df, ["k"], "v", wanted).collect()}
    for k in ("all", None, "odd", "huge"):
        v = sorted(x for g, x in rows if g == k)
        assert (got[k].lo, got[k].p99, got[k].top) == (v[0], v[int(0.99 * len(v))], v[-1])
        assert got[k].med == statistics.median(v)
    monkeypatch.setattr(R, "MAX_GROUPS", 2)  # many groups go by order, with the same results
    assert {r.k: r for r in R.quantiles(df, ["k"], "v", wanted).collect()} == got
    longs = spark.range(1000).select((F.col("id") + (1 << 61)).alias("v"))
    assert R.quantiles(longs, [], "v", {"m": ("rank", 0.5)}).first().m == (1 << 61) + 500
    none = longs.limit(0).withColumn("g", F.lit(1))
    assert R.quantiles(none, ["g"], "v", {"m": ("rank", 0.5)}).count() == 0
    assert R.quantiles(none, [], "v", {"m": ("rank", 0.5)}).first().m is None


def test_trend(spark):
    rows = [("up", i, float(i)) for i in range(9)] + [("flat", i, 1.0) for i in range(9)] + [("one", 0, 1.0)] + [("down", i, -2.0 * i) for i in range(9)]
    got = {r.k: r.trend for r in R.trend(spark.createDataFrame(rows, "k string, t int, v double"), ["k"], "v", ["t"]).collect()}
    assert got == {"up": "increasing", "flat": "stable", "one": "insufficient_data", "down": "decreasing"}


def greedy(ticks, gap):
    kept, last = [], None
    for t in sorted(ticks):
        if last is None or t - last >= gap:
            kept.append(t)
            last = t
    return kept


def test_last_emitted():
    rng = np.random.default_rng(1)
    for _ in range(50):
        ticks = np.unique(rng.integers(0, 500, 60))
        gap = int(rng.integers(1, 90))
        assert [int(ticks[i]) for i in _last_emitted(ticks, gap)] == [greedy(ticks[i:], gap)[-1] for i in range(len(ticks))]


def test_cooldown_equals_the_sequential_walk(spark):
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    rows = [(i, rng.choice(["hot"] * 8 + ["cold", None]), start + dt.timedelta(seconds=rng.randrange(200_000)), 7) for i in range(1500)]
    rows += [(9000 + i, "free", start, 0) for i in range(3)]
    df = spark.createDataFrame(rows, "id int, rule string, ts timestamp_ntz, cooldown_minutes int")
    got = L.cooldown_suppress(df, ["rule"], ["id"]).collect()
    for rule in ("hot", "cold", None):
        ticks = {(r[2] - start).total_seconds() for r in rows if r[1] == rule}
        assert sorted((r.ts - start).total_seconds() for r in got if r.rule == rule) == greedy(ticks, 420)
    assert sum(r.rule == "free" for r in got) == 3


def test_escalation_stops_when_closed(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, t, "MEDIUM", None, 30, 3), (2, t, "HIGH", t + dt.timedelta(minutes=40), 30, 3)]
    df = spark.createDataFrame(rows, "alert_id int, ts timestamp_ntz, severity string, resolved_at timestamp_ntz, escalation_minutes int, max_escalations int")
    got = sorted((r.alert_id, r.escalation_count, r.escalated_severity) for r in L.escalation_schedule(df, "2024-01-31 00:00:00").collect())
    assert got == [(1, 1, "HIGH"), (1, 2, "CRITICAL"), (1, 3, "CRITICAL"), (2, 1, "CRITICAL")]


def test_rules_on_missing_metrics_do_not_fire(spark):
    df = spark.createDataFrame([("p", None, 5.0)], "pipeline_id string, execution_time double, throughput double")
    assert [r.rule for r in L.evaluate_alert_rules(df).select("rule").collect()] == ["low_throughput"]
    text = L.message("t={throughput} e={execution_time}", {"throughput": F.col("throughput"), "execution_time": F.col("execution_time")})
    assert df.select(text).first()[0] == "t={throughput} e={execution_time} (missing: execution_time)"
