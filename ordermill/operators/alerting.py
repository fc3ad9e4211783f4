"""Alert rules, cooldown, escalation and lifecycle as table operators."""

from __future__ import annotations

import logging
from collections.abc import Callable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as V
from ..functions.arrays import each_element
from ..functions.cooldown import chain, emit, summarise
from ..functions.dates import micros
from ..session import clock
from .dedup import dedup_by_key
from .joins import DEFAULT_CHANNELS, route_notifications, severity_number
from .ranking import null_safe_join, range_chunks

MINUTE = 60_000_000

# FIXED VALUES: the default rules. A condition is SQL over the columns of a metrics record; a
# missing metric makes it null, so the rule does not fire.
DEFAULT_RULES = [
    {"rule": "pipeline_failure", "condition": "pipeline_success = 0", "severity": "CRITICAL", "cooldown": 5, "escalation": 15, "max_escalations": 3},
    {"rule": "high_execution_time", "condition": "execution_time > 300", "severity": "HIGH", "cooldown": 10, "escalation": 30, "max_escalations": 2},
    {"rule": "low_data_quality", "condition": "data_quality_score < 80", "severity": "HIGH", "cooldown": 5, "escalation": 20, "max_escalations": 2},
    {"rule": "low_throughput", "condition": "throughput < 10", "severity": "MEDIUM", "cooldown": 15, "escalation": 60, "max_escalations": 1},
    {"rule": "high_error_rate", "condition": "error_rate > 0.05", "severity": "HIGH", "cooldown": 5, "escalation": 20, "max_escalations": 2},
    {"rule": "system_resource_exhaustion",
     "condition": "coalesce(cpu_usage, 0) > 90 or coalesce(memory_usage, 0) > 90 or coalesce(disk_usage, 0) > 95",
     "severity": "CRITICAL", "cooldown": 2, "escalation": 10, "max_escalations": 3},
]

# FIXED VALUES: the configured threshold rules
CONFIG_RULES = [
    {"rule": "high_cpu_usage", "condition": "cpu_usage_percent > 85", "severity": "warning", "cooldown": 15},
    {"rule": "critical_cpu_usage", "condition": "cpu_usage_percent > 95", "severity": "critical", "cooldown": 5},
    {"rule": "high_memory_usage", "condition": "memory_usage_percent > 85", "severity": "warning", "cooldown": 15},
    {"rule": "low_disk_space", "condition": "disk_usage_percent > 85", "severity": "warning", "cooldown": 60},
    {"rule": "critical_disk_space", "condition": "disk_usage_percent > 95", "severity": "critical", "cooldown": 30},
    {"rule": "pipeline_failure", "condition": "pipeline_runs_failed > 0", "severity": "error", "cooldown": 0},
    {"rule": "high_pipeline_execution_time", "condition": "pipeline_execution_time_seconds > 3600", "severity": "warning", "cooldown": 30},
    {"rule": "low_pipeline_success_rate", "condition": "pipeline_success_rate < 90", "severity": "warning", "cooldown": 60},
    {"rule": "no_recent_pipeline_runs", "condition": "hours_since_last_pipeline_run > 25", "severity": "error", "cooldown": 60},
    {"rule": "low_data_quality", "condition": "data_quality_score < 80", "severity": "warning", "cooldown": 30},
    {"rule": "critical_data_quality", "condition": "data_quality_score < 50", "severity": "critical", "cooldown": 15},
    {"rule": "high_validation_errors", "condition": "validation_errors_total > 100", "severity": "warning", "cooldown": 30},
    {"rule": "stale_data", "condition": "data_freshness_hours > 25", "severity": "warning", "cooldown": 60},
    {"rule": "api_errors", "condition": "api_errors_total > 10", "severity": "warning", "cooldown": 15},
    {"rule": "api_rate_limit", "condition": "api_rate_limit_remaining < 10", "severity": "warning", "cooldown": 60},
    {"rule": "slow_api_response", "condition": "api_request_duration_seconds > 10", "severity": "warning", "cooldown": 30},
    {"rule": "high_error_rate", "condition": "error_rate > 5", "severity": "critical", "cooldown": 0},
    {"rule": "low_success_rate", "condition": "success_rate < 95", "severity": "warning", "cooldown": 0},
    {"rule": "processing_timeout", "condition": "processing_time > 3600", "severity": "warning", "cooldown": 0},
    {"rule": "data_quality_degradation", "condition": "data_quality_score < 80", "severity": "warning", "cooldown": 0},
]

# FIXED VALUES: the short rule list
SIMPLE_RULES = [
    {"rule": "too_many_errors", "condition": "error_count > 10", "severity": "error", "cooldown": 0},
    {"rule": "slow_run", "condition": "execution_time > 300", "severity": "warning", "cooldown": 0},
    {"rule": "low_success", "condition": "success_rate < 95", "severity": "warning", "cooldown": 0},
]


def message(template: str, values: dict[str, Column]) -> Column:
    """Fill `{name}` slots; a missing value shows the bare template with a note instead."""
    parts, missing, rest = [], [], template
    for name, value in values.items():
        head, found, rest = rest.partition("{" + name + "}")
        parts += [F.lit(head), value.cast("string")] if found else [F.lit(head)]
        missing.append(F.when(value.isNull(), F.lit(name)))
    filled = F.concat(*parts, F.lit(rest))
    note = F.concat(F.lit(template + " (missing: "), F.array_join(F.array_compact(F.array(*missing)), ", "), F.lit(")"))
    return F.coalesce(filled, note)


def condition(rule: dict) -> Column:
    """The rule's test: SQL text, or a Python function Column-wise or over a pandas frame (see `python_rule`)."""
    test = rule["condition"]
    return F.expr(test) if isinstance(test, str) else test()


def python_rule(fn: Callable[[pd.DataFrame], pd.Series], columns: list[str]) -> Callable[[], Column]:
    """Wrap a vectorised Python predicate over the named metric columns."""
    udf = F.pandas_udf(fn, T.BooleanType())
    return lambda: udf(F.struct(*columns))


def evaluate_alert_rules(records: DataFrame, rules: list[dict] = DEFAULT_RULES) -> DataFrame:
    """One row per metrics record and rule that fires.

    Rules with `enabled` false and rules on absent columns never fire; any other fault of a condition is raised.
    """
    usable = [r for r in rules if r.get("enabled", True) and _resolves(records, r)]
    if not usable:
        none = {"rule": "string", "severity": "string", "cooldown_minutes": "int", "escalation_minutes": "int", "max_escalations": "int"}
        return records.filter(F.lit(False)).select("*", *[F.lit(None).cast(t).alias(n) for n, t in none.items()])
    fired = [
        F.when(condition(r), F.struct(
            F.lit(r["rule"]).alias("rule"), F.lit(r["severity"]).alias("severity"), F.lit(r["cooldown"]).alias("cooldown_minutes"),
            F.lit(r.get("escalation", 0)).alias("escalation_minutes"), F.lit(r.get("max_escalations", 0)).alias("max_escalations"),
        ))
        for r in usable
    ]
    return each_element(records, F.array(*fired), "_a").select("*", "_a.*").drop("_a")


def _resolves(records: DataFrame, rule: dict) -> bool:
    """Whether the analyzer finds every column of the rule's condition."""
    told = logging.getLogger("SQLQueryContextLogger")
    level = told.level
    told.setLevel(logging.CRITICAL)  # a rule on an absent column is no error
    try:
        records.select(condition(rule))
    except AnalysisException as fault:
        if (fault.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            return False
        raise
    finally:
        told.setLevel(level)
    return True


# --- cooldown ---------------------------------------------------------------------------------
#
# "Emit only if the last emitted alert is at least the cooldown ago" is a sequential fold. It is
# run over equal time ranges of each key in parallel: a range is first summarised by where it
# leaves off for each way of entering it, the few summaries per key are chained, and then each
# range emits on its own. No task holds more than one range.


def cooldown_suppress(alerts: DataFrame, keys: list[str], order_by: list, ts: str = "ts", minutes: str = "cooldown_minutes") -> DataFrame:
    """Alerts kept when each key stays silent for its cooldown after every kept alert."""
    ticked = alerts.withColumn("tick", micros(F.col(ts)))
    waiting = dedup_by_key(ticked.filter(F.col(minutes) > 0), [*keys, "tick"], order_by)
    ids = [*keys, "gap"]
    candidates = waiting.select(*keys, (F.col(minutes).cast("bigint") * MINUTE).alias("gap"), "tick")
    chunks = range_chunks(candidates, ids, ["tick"])
    id_fields = [f for f in candidates.schema.fields if f.name in ids]
    base = T.StructType(sorted(id_fields, key=lambda f: ids.index(f.name)))

    def with_fields(*extra: tuple[str, T.DataType]) -> T.StructType:
        return T.StructType([*base.fields, *[T.StructField(n, t) for n, t in extra]])

    longs = T.ArrayType(T.LongType())
    summary = with_fields(("chunk", T.IntegerType()), ("enter", longs), ("leave", longs))
    entry = with_fields(("chunk", T.IntegerType()), ("ready", T.LongType()))
    steps = chunks.groupBy(*ids, "chunk").applyInPandas(summarise(ids), summary)
    ready = steps.groupBy(*ids).applyInPandas(chain(ids), entry)
    placed = null_safe_join(chunks, ready, [*ids, "chunk"])
    emitted = placed.groupBy(*ids, "chunk").applyInPandas(emit(ids), with_fields(("tick", T.LongType()))).drop("gap")
    kept = null_safe_join(waiting, emitted, [*keys, "tick"])
    always = ticked.filter(~F.coalesce(F.col(minutes) > 0, F.lit(False)))
    return kept.unionByName(always).drop("tick")


# --- escalation, lifecycle ---------------------------------------------------------------------


def escalation_schedule(alerts: DataFrame, as_of: str, ts: str = "ts") -> DataFrame:
    """Escalation rows of each alert while it is open: count, time and raised severity."""
    ends = [F.col(c) for c in ("resolved_at", "acknowledged_at") if c in alerts.columns]
    closed = F.least(*ends, clock(as_of)) if ends else clock(as_of)
    step = F.explode(F.sequence(F.lit(1), F.col("max_escalations")))
    steps = alerts.filter((F.col("escalation_minutes") > 0) & (F.col("max_escalations") > 0)).withColumn("escalation_count", step)
    minutes = F.col("escalation_minutes") * F.col("escalation_count")
    when = F.col(ts) + F.make_dt_interval(F.lit(0), F.lit(0), minutes)
    names = F.array(*[F.lit(s) for s in V.SEVERITY_LEVELS])
    level = F.least(severity_number(F.col("severity")) + F.col("escalation_count"), F.lit(4))
    due = steps.withColumn("escalated_at", when).filter(F.col("escalated_at") <= closed)
    return due.withColumn("escalated_severity", F.element_at(names, level))


def alert_flow(records: DataFrame, as_of: str, keys: list[str], order_by: list, rules: list[dict] = DEFAULT_RULES,
               channels: list[dict] = DEFAULT_CHANNELS) -> DataFrame:
    """Rules, cooldown, escalation, routing: one row per notification (escalation 0 is the alert itself)."""
    kept = cooldown_suppress(evaluate_alert_rules(records, rules), keys, order_by)
    raised = escalation_schedule(kept, as_of)
    first = kept.withColumns({"escalation_count": F.lit(0), "escalated_at": F.col("ts"), "escalated_severity": F.col("severity")})
    return route_notifications(first.unionByName(raised), channels, "escalated_severity")


def alert_lifecycle(log: DataFrame) -> DataFrame:
    """Current state per alert from its event log; the latest event wins."""
    state = F.max_by(F.struct("status", "ts"), F.struct("ts", "event_id")).alias("s")
    return log.groupBy("alert_id").agg(F.min("ts").alias("opened_at"), F.count(F.lit(1)).alias("events"), state).select(
        "alert_id", "opened_at", "events", F.col("s.status").alias("status"), F.col("s.ts").alias("changed_at"),
        (F.col("s.status") != "RESOLVED").alias("active"),
    )
