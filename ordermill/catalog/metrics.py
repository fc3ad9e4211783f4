"""Metric roll-ups, trends, alerts and health over the event tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..operators import aggregates as A
from ..operators import alerting as L
from ..operators import monitoring as M
from ..operators import ranking as R
from ..session import EVENTS_AS_OF
from . import sqltext as S
from .bindings import table
from .registry import query

_DAY = "ts >= timestamp '2024-01-30 00:00:00' - interval 24 hours"
DAY_END = "2024-01-30 00:00:00"


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Deviations depend on the order of the rows in their last bits."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def metrics(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "metrics")


@query("metric_summary", f"select name, {S.summary('value')} from {{metrics}} where {_DAY} group by 1")
def metric_summary(spark, sf):
    return rounded(A.metric_summary(metrics(spark, sf), DAY_END), "std_dev")


@query("hourly_rollup", f"select name, date_trunc('hour', ts) as hour_start, {S.summary('value')} from {{metrics}} group by 1, 2")
def hourly_rollup(spark, sf):
    return rounded(M.hourly_rollup(metrics(spark, sf)), "std_dev")


@query("nearest_rank_percentile", "select name, list_sort(list(value))[cast(floor(0.95 * count(*)) as bigint) + 1] as value_at from {metrics} group by 1")
def nearest_rank_percentile(spark, sf):
    return M.percentile_by_rank(metrics(spark, sf), ["name"], "value", 0.95)


@query("latest_gauge", "select name, arg_max(value, (ts, metric_id)) as last_value, sum(cast(round(value * 100) as bigint)) / 100.0 as counter, count(*) as n from {metrics} group by 1")
def latest_gauge(spark, sf):
    return M.latest_gauge(metrics(spark, sf))


@query("last_n_summary", """select name, count(*) as n, sum(cast(round(value * 100) as bigint)) / 100.0 as total, min(value) as min_value, max(value) as max_value,
   list_sort(list(value))[cast(floor(0.95 * count(*)) as bigint) + 1] as p95, list_sort(list(value))[cast(floor(0.99 * count(*)) as bigint) + 1] as p99
   from (select * from {metrics} qualify row_number() over (partition by name order by ts desc, metric_id desc) <= 1000) group by 1""")
def last_n_summary(spark, sf):
    return M.last_n_summary(metrics(spark, sf), 1000)


_TREND = "case when count(*) < 2 then 'insufficient_data' when coalesce(abs(corr(p, {v})), 0) < 0.1 or isnan(corr(p, {v})) then 'stable' when corr(p, {v}) > 0 then 'increasing' else 'decreasing' end"


def trend_sql(keys: str, value: str, order: str, source: str) -> str:
    return f"""(select {keys}, count(*) as n, sum(cast({value} as decimal(38,10)))::double / count({value}) as mean, round(coalesce(stddev_samp({value}), 0.0), 6) as std, min({value}) as min_value, max({value}) as max_value,
      {_TREND.replace('{v}', value)} as trend, median({value}) as median
    from (select *, row_number() over (partition by {keys} order by {order}) - 1 as p from {source} where {value} is not null) group by {keys})"""


@query("trend", f"select pipeline_id, trend from {trend_sql('pipeline_id', 'value', 'ts, metric_id', '{metrics}')}")
def trend(spark, sf):
    return R.trend(metrics(spark, sf), ["pipeline_id"], "value", ["ts", "metric_id"])


@query("performance_trends", f"select * from {trend_sql('metric_name, stage', 'value', 'ts, metric_id', '{run_metrics}')}")
def performance_trends(spark, sf):
    return rounded(M.performance_trends(table(spark, sf, "run_metrics"), ["metric_name", "stage"], "value", ["ts", "metric_id"]), "std")


def _trend_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    runs = table(spark, sf, "run_metrics")
    names = runs.filter(F.col("metric_name").isin(*M.TREND_METRICS)).withColumnRenamed("metric_name", "metric")
    scores = table(spark, sf, "quality_metrics").select(F.lit("quality_score").alias("metric"), F.col("quality_score").alias("value"), "ts", F.col("pipeline_id"))
    both = names.select("metric", "value", "ts", "pipeline_id").unionByName(scores)
    return (
        M.performance_trends(both, ["metric"], "value", ["ts", "pipeline_id", "value"]),
        M.performance_trends(runs.filter("stage is not null"), ["stage"], "value", ["ts", "metric_id"]),
    )


_BOTH = f"""(select metric_name as metric, value, ts, pipeline_id from {{run_metrics}} where metric_name in ({S.quoted(M.TREND_METRICS)})
   union all select 'quality_score', quality_score, ts, pipeline_id from {{quality_metrics}})"""


@query("recommendations", f"""with t as materialized (select * from {trend_sql('metric', 'value', 'ts, pipeline_id, value', _BOTH)}),
   s as materialized (select * from {trend_sql('stage', 'value', 'ts, metric_id', '(select * from {run_metrics} where stage is not null)')}),
   a as (select 'Performance' as category, 'High' as priority, 'runs take long' as issue from t where metric = 'total_execution_time' and mean > 300
     union all select 'Consistency', 'Medium', 'run times vary widely' from t where metric = 'total_execution_time' and std > mean * 0.5
     union all select 'Performance', 'High', 'runs get slower' from t where metric = 'total_execution_time' and trend = 'increasing'
     union all select 'Performance', 'Medium', 'few records a second' from t where metric = 'throughput' and mean < 20
     union all select 'Performance', 'High', 'fewer records a second over time' from t where metric = 'throughput' and trend = 'decreasing'
     union all select 'Data Quality', 'High', 'quality score is low' from t where metric = 'quality_score' and mean < 90
     union all select 'Data Quality', 'Critical', 'quality score falls' from t where metric = 'quality_score' and trend = 'decreasing'
     union all select 'Performance', 'Medium', 'stage ' || stage || ' is slow' from (select stage, mean from s order by mean desc, stage desc limit 1) where mean > 60
     union all select 'Performance', 'Medium', 'stage ' || stage || ' gets slower' from s where trend = 'increasing')
   select * from a union all select 'Optimization', 'Low', 'no finding' where not exists (select 1 from a)""")
def recommendations(spark, sf):
    return M.recommendations(*_trend_inputs(spark, sf))


@query("pipeline_report", f"""with m as (select *, tags::json ->> 'pipeline_id' as pipeline from {{run_metrics}} where {_DAY})
   select pipeline, count(*) filter (where long_name = 'pipeline.execution_time') as executions, {S.mean('value', "long_name = 'pipeline.execution_time'")} as avg_duration,
     min(value) filter (where long_name = 'pipeline.execution_time') as min_duration, max(value) filter (where long_name = 'pipeline.execution_time') as max_duration,
     count(*) filter (where long_name = 'pipeline.successes') as successes, count(*) filter (where long_name = 'pipeline.failures') as failures,
     coalesce(count(*) filter (where long_name = 'pipeline.successes') * 100.0e0 / nullif(count(*) filter (where long_name in ('pipeline.successes', 'pipeline.failures')), 0), 0.0) as success_rate,
     {S.mean('value', "long_name = 'pipeline.data_quality.score'")} as avg_quality, min(value) filter (where long_name = 'pipeline.data_quality.score') as min_quality,
     max(value) filter (where long_name = 'pipeline.data_quality.score') as max_quality,
     cast(floor(coalesce(sum(cast(round(value * 100) as bigint)) filter (where long_name = 'pipeline.errors'), 0) / 100) as bigint) as total_errors from m group by 1""")
def pipeline_report(spark, sf):
    return A.pipeline_report(table(spark, sf, "run_metrics"), DAY_END)


@query("stage_times", f"select split_part(long_name, '.', 3) as stage, {S.mean('value')} as avg_time, count(*) as executions from {{run_metrics}} where {_DAY} and long_name like 'pipeline.stage.%.execution_time' group by 1")
def stage_times(spark, sf):
    return A.pipeline_stage_times(table(spark, sf, "run_metrics"), DAY_END)


@query("stage_means", f"select stage, {S.mean('value')} as mean_value, count(*) as n from {{metrics}} where stage is not null group by 1")
def stage_means(spark, sf):
    return A.stage_means(metrics(spark, sf))


@query("stage_slowest", f"select stage, mean_time, mean_time > 60 as slow from (select stage, {S.mean('value')} as mean_time from {{metrics}} where stage is not null group by 1) order by mean_time desc, stage desc limit 1")
def stage_slowest(spark, sf):
    return M.stage_slowest(metrics(spark, sf))


_STATUS = "(select pipeline_id, bool_or(metric_name = 'execution_failed') as failed from {run_metrics} where " + _DAY + " group by 1)"


def _recent_runs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "run_metrics").filter(A.since("ts", 24, DAY_END))


@query("run_success_rate", f"select count(*) as pipelines, count(*) filter (where failed) as failed, count(*) filter (where not failed) * 100.0e0 / count(*) as success_rate from {_STATUS}")
def run_success_rate(spark, sf):
    return A.run_success_rate(_recent_runs(spark, sf))


@query("run_status", f"select pipeline_id, case when failed then 'FAILED' else 'SUCCESS' end as status from {_STATUS}")
def run_status(spark, sf):
    return A.pipeline_status(_recent_runs(spark, sf))


@query("execution_stats_24h", f"""select count(*) as executions, count(*) filter (where status = 'COMPLETED') as successful, count(*) filter (where status = 'FAILED') as failed,
   count(*) filter (where status = 'COMPLETED') * 100.0e0 / count(*) as success_rate from {{run_events}} where {_DAY}""")
def execution_stats_24h(spark, sf):
    return A.execution_stats(table(spark, sf, "run_events"), DAY_END)


@query("alert_summary", " union all ".join(f"select '{c}' as dimension, {c} as member, count(*) as alerts, count(*) filter (where escalated) as escalated from {{alerts}} where {_DAY} group by 2" for c in ("severity", "status", "rule"))
       + f" union all select 'all', 'all', count(*), count(*) filter (where escalated) from {{alerts}} where {_DAY}")
def alert_summary(spark, sf):
    return A.alert_summary(table(spark, sf, "alerts"), DAY_END)


@query("upsert_pipeline_runs", "select run_id, arg_max(event_id, (ts, event_id)) as event_id, arg_max(job_id, (ts, event_id)) as job_id, max(ts) as ts, arg_max(status, (ts, event_id)) as status, arg_max(records_processed, (ts, event_id)) as records_processed, arg_max(execution_time, (ts, event_id)) as execution_time from {run_events} group by 1")
def upsert_pipeline_runs(spark, sf):
    return M.upsert_runs(table(spark, sf, "run_events"))


@query("append_quality_metrics", """with r as (select run_id, max(ts) as ts, arg_max(status, (ts, event_id)) as status, arg_max(records_processed, (ts, event_id)) as n, arg_max(execution_time, (ts, event_id)) as t from {run_events} group by 1)
   select run_id, ts, 'data_quality_score' as metric_name, case status when 'COMPLETED' then 100.0e0 when 'FAILED' then 0.0e0 else 50.0e0 end as metric_value, 'percentage' as metric_type from r
   union all select run_id, ts, 'records_processed', n, 'count' from r union all select run_id, ts, 'execution_time_seconds', t, 'duration' from r""")
def append_quality_metrics(spark, sf):
    return M.run_quality_metrics(M.upsert_runs(table(spark, sf, "run_events")))


@query("stage_events", """select *, case when duration_seconds = 0 then 0.0 else records / duration_seconds end as throughput from (
   select run_id, stage, started_at, completed_at, records, (epoch_us(completed_at) - epoch_us(started_at)) / 1000000.0e0 as duration_seconds from (
     select run_id, stage, min(ts) filter (where event = 'stage_started') as started_at, max(ts) filter (where event = 'stage_completed') as completed_at,
       arg_max(records, (ts, event_id)) filter (where event = 'stage_completed') as records from {stage_log} group by 1, 2)
   where started_at is not null and completed_at >= started_at)""")
def stage_events(spark, sf):
    return M.stage_events(table(spark, sf, "stage_log"))


@query("throughput", "select pipeline_id, ts, case when execution_time = 0 then 0.0 else coalesce(records_processed / execution_time, 0.0) end as per_second, case when execution_time = 0 then 0.0 else coalesce(records_processed * 60.0e0 / execution_time, 0.0) end as per_minute from {snapshots}")
def throughput(spark, sf):
    n, t = F.col("records_processed"), F.col("execution_time")
    return table(spark, sf, "snapshots").select("pipeline_id", "ts", M.throughput(n, t).alias("per_second"), M.throughput(n, t, 60.0).alias("per_minute"))


@query("stage_report", """select stage, count(distinct run_id) as runs, cast(sum(records) as bigint) as records_in, cast(sum(records - records % 7) as bigint) as records_out,
   sum(records - records % 7) * 100.0e0 / sum(records) as retention_pct, count(*) filter (where event <> 'stage_error') * 100.0e0 / count(*) as success_rate, avg(100.0e0 - records % 7) as avg_quality from {stage_log} group by 1""")
def stage_report(spark, sf):
    lost = F.col("records") % 7
    log = table(spark, sf, "stage_log").select(
        "run_id", "stage", F.col("records").alias("records_in"), (F.col("records") - lost).alias("records_out"),
        (F.col("event") != "stage_error").alias("success"), (F.lit(100.0) - lost).alias("quality"),
    )
    return M.stage_report(log)


# --- alert rules ------------------------------------------------------------------------------


def fired_sql(rules: list[tuple], source: str = "{snapshots}") -> str:
    """(rule, condition, severity, cooldown, escalation, most escalations), as the rules must act on these columns."""
    parts = [
        f"select pipeline_id, ts, '{name}' as rule, '{severity}' as severity, {cooldown} as cooldown_minutes, {escalation} as escalation_minutes, {most} as max_escalations from {source} where {test}"
        for name, test, severity, cooldown, escalation, most in rules
    ]
    return "(" + " union all ".join(parts) + ")"


_DEFAULT = [
    ("pipeline_failure", "pipeline_success = 0", "CRITICAL", 5, 15, 3),
    ("high_execution_time", "execution_time > 300", "HIGH", 10, 30, 2),
    ("low_data_quality", "data_quality_score < 80", "HIGH", 5, 20, 2),
    ("low_throughput", "throughput < 10", "MEDIUM", 15, 60, 1),
    ("high_error_rate", "error_rate > 0.05", "HIGH", 5, 20, 2),
    ("system_resource_exhaustion", "coalesce(cpu_usage, 0) > 90 or coalesce(memory_usage, 0) > 90 or coalesce(disk_usage, 0) > 95", "CRITICAL", 2, 10, 3),
]
_CONFIGURED = [  # of the configured rules, those whose columns are there
    ("high_cpu_usage", "cpu_usage_percent > 85", "warning", 15, 0, 0),
    ("critical_cpu_usage", "cpu_usage_percent > 95", "critical", 5, 0, 0),
    ("pipeline_failure", "pipeline_runs_failed > 0", "error", 0, 0, 0),
    ("high_pipeline_execution_time", "pipeline_execution_time_seconds > 3600", "warning", 30, 0, 0),
    ("low_pipeline_success_rate", "pipeline_success_rate < 90", "warning", 60, 0, 0),
    ("low_data_quality", "data_quality_score < 80", "warning", 30, 0, 0),
    ("critical_data_quality", "data_quality_score < 50", "critical", 15, 0, 0),
    ("high_error_rate", "error_rate > 5", "critical", 0, 0, 0),
    ("low_success_rate", "success_rate < 95", "warning", 0, 0, 0),
    ("processing_timeout", "processing_time > 3600", "warning", 0, 0, 0),
    ("data_quality_degradation", "data_quality_score < 80", "warning", 0, 0, 0),
]
_SIMPLE = [
    ("too_many_errors", "error_count > 10", "error", 0, 0, 0),
    ("slow_run", "execution_time > 300", "warning", 0, 0, 0),
    ("low_success", "success_rate < 95", "warning", 0, 0, 0),
]
_FIRED = ["pipeline_id", "ts", "rule", "severity", "cooldown_minutes", "escalation_minutes", "max_escalations"]


@query("evaluate_alert_rules", f"select * from {fired_sql(_DEFAULT)}")
def evaluate_alert_rules(spark, sf):
    return L.evaluate_alert_rules(table(spark, sf, "snapshots")).select(*_FIRED)


_CONFIG_NAMES = {"cpu_usage": "cpu_usage_percent", "execution_time": "pipeline_execution_time_seconds", "error_count": "pipeline_runs_failed", "success_rate": "pipeline_success_rate"}
_CONFIG_SOURCE = "(select pipeline_id, ts, " + ", ".join(f"{a} as {b}" for a, b in _CONFIG_NAMES.items()) + ", data_quality_score, error_rate * 100 as error_rate, success_rate, execution_time as processing_time from {snapshots})"


@query("config_alert_rules", f"select * from {fired_sql(_CONFIGURED, _CONFIG_SOURCE)}")
def config_alert_rules(spark, sf):
    records = table(spark, sf, "snapshots").select(
        "pipeline_id", "ts", *[F.col(a).alias(b) for a, b in _CONFIG_NAMES.items()], "data_quality_score", (F.col("error_rate") * 100).alias("error_rate"),
        "success_rate", F.col("execution_time").alias("processing_time"),
    )
    return L.evaluate_alert_rules(records, L.CONFIG_RULES).select(*_FIRED)


@query("readme_alert_conditions", f"select * from {fired_sql(_SIMPLE)}")
def readme_alert_conditions(spark, sf):
    return L.evaluate_alert_rules(table(spark, sf, "snapshots"), L.SIMPLE_RULES).select(*_FIRED)


@query("custom_alert_rule", """select pipeline_id, ts, 'busy_and_slow' as rule, 'HIGH' as severity from {snapshots} where records_processed >= 2 and execution_time > 500
   union all select pipeline_id, ts, 'quality_dip', 'LOW' from {snapshots} where data_quality_score < 20
   union all select pipeline_id, ts, 'far_off', 'LOW' from {snapshots} where abs(data_quality_score - 50) > 40
   union all select pipeline_id, ts, 'middling', 'LOW' from {snapshots} where data_quality_score between 40 and 45
   union all select pipeline_id, ts, 'unmeasured', 'LOW' from {snapshots} where cpu_usage is null
   union all select pipeline_id, ts, 'by_case', 'LOW' from {snapshots} where case when error_count>5 then 1 else 0 end=1""")
def custom_alert_rule(spark, sf):
    def dip(frame: pd.DataFrame) -> pd.Series:
        return frame["data_quality_score"] < 20

    rules = [
        {"rule": "busy_and_slow", "condition": "records_processed >= 2 and execution_time > 500", "severity": "HIGH", "cooldown": 0},
        {"rule": "far_off", "condition": "abs(data_quality_score - 50) > 40", "severity": "LOW", "cooldown": 0},
        {"rule": "middling", "condition": "data_quality_score between 40 and 45", "severity": "LOW", "cooldown": 0},
        {"rule": "unmeasured", "condition": "cpu_usage is null", "severity": "LOW", "cooldown": 0},
        {"rule": "by_case", "condition": "case when error_count>5 then 1 else 0 end=1", "severity": "LOW", "cooldown": 0},
        {"rule": "absent", "condition": "no_such_column > 0", "severity": "LOW", "cooldown": 0},
        {"rule": "switched_off", "condition": "records_processed >= 0", "severity": "LOW", "cooldown": 0, "enabled": False},
        {"rule": "quality_dip", "condition": L.python_rule(dip, ["data_quality_score"]), "severity": "LOW", "cooldown": 0},
    ]
    return L.evaluate_alert_rules(table(spark, sf, "snapshots"), rules).select("pipeline_id", "ts", "rule", "severity")


# a recursive walk: the next kept alert is the first one at least the cooldown after the last kept one
_WALK = """kept(rule, ts, cooldown_minutes) as (
     select rule, min(ts), any_value(cooldown_minutes) from cand group by rule
     union all
     select k.rule, (select min(c.ts) from cand c where c.rule = k.rule and c.ts >= k.ts + to_minutes(k.cooldown_minutes)), k.cooldown_minutes
     from kept k where exists (select 1 from cand c where c.rule = k.rule and c.ts >= k.ts + to_minutes(k.cooldown_minutes)))"""


def _long_cooldown(fired: DataFrame) -> DataFrame:
    """Snapshots are hourly, so cooldowns of hours show the effect."""
    return fired.withColumn("cooldown_minutes", F.col("cooldown_minutes") * 60)


_CANDIDATES = f"select rule, ts, min(pipeline_id) as pipeline_id, any_value(severity) as severity, any_value(cooldown_minutes) * 60 as cooldown_minutes, any_value(escalation_minutes) as escalation_minutes, any_value(max_escalations) as max_escalations from {fired_sql(_DEFAULT)} group by 1, 2"


@query("cooldown_suppress", f"with recursive cand as materialized ({_CANDIDATES}), {_WALK} select cand.rule, cand.ts, cand.pipeline_id, cand.severity from kept join cand using (rule, ts)")
def cooldown_suppress(spark, sf):
    fired = _long_cooldown(L.evaluate_alert_rules(table(spark, sf, "snapshots")))
    return L.cooldown_suppress(fired, ["rule"], ["pipeline_id"]).select("rule", "ts", "pipeline_id", "severity")


_LEVELS = "case {s} when 'LOW' then 1 when 'MEDIUM' then 2 when 'HIGH' then 3 else 4 end"
_NAMES = "['LOW', 'MEDIUM', 'HIGH', 'CRITICAL']"
_ESCALATE = f"""select a.*, k as escalation_count, ts + to_minutes(escalation_minutes * k) as escalated_at, {_NAMES}[least({_LEVELS.replace('{s}', 'severity')} + k, 4)] as escalated_severity
   from {{rows}} a, (select cast(unnest([1, 2, 3]) as int) as k) s where k <= max_escalations and escalation_minutes > 0 and ts + to_minutes(escalation_minutes * k) <= {{closed}}"""


@query("escalation_schedule", "with a as (select alert_id, ts, severity, resolved_at, acknowledged_at, 30 as escalation_minutes, 3 as max_escalations from {alerts}) select alert_id, escalation_count, escalated_at, escalated_severity from ("
       + _ESCALATE.replace("{rows}", "a").replace("{closed}", f"least(coalesce(resolved_at, {S.EVENTS_AS_OF}), coalesce(acknowledged_at, {S.EVENTS_AS_OF}), {S.EVENTS_AS_OF})") + ")")
def escalation_schedule(spark, sf):
    rows = table(spark, sf, "alerts").withColumns({"escalation_minutes": F.lit(30), "max_escalations": F.lit(3)})
    return L.escalation_schedule(rows, EVENTS_AS_OF).select("alert_id", "escalation_count", "escalated_at", "escalated_severity")


@query("alert_pipeline", f"""with recursive cand as materialized (select * replace (cooldown_minutes / 60 as cooldown_minutes) from ({_CANDIDATES})), {_WALK.replace('to_minutes(k.cooldown_minutes)', 'to_minutes(cast(k.cooldown_minutes as bigint))')},
   a as (select cand.* from kept join cand using (rule, ts)),
   e as ({_ESCALATE.replace('{rows}', 'a').replace('{closed}', S.EVENTS_AS_OF)} union all select *, 0, ts, severity from a)
   select rule, ts, pipeline_id, escalation_count, escalated_at, escalated_severity, channel from e
   join (values ('log', 1), ('console', 2), ('slack', 3), ('email', 3), ('webhook', 4)) c(channel, threshold) on {_LEVELS.replace('{s}', 'escalated_severity')} >= threshold""")
def alert_pipeline(spark, sf):
    out = L.alert_flow(table(spark, sf, "snapshots"), EVENTS_AS_OF, ["rule"], ["pipeline_id"])
    return out.select("rule", "ts", "pipeline_id", "escalation_count", "escalated_at", "escalated_severity", "channel")


_ALERT_LOG = "(select event_id, event_id % 997 as alert_id, ts, case event_type when 'error' then 'ACTIVE' when 'click' then 'ACTIVE' when 'view' then 'ACKNOWLEDGED' else 'RESOLVED' end as status from events)"


@query("alert_lifecycle", f"select alert_id, min(ts) as opened_at, count(*) as events, arg_max(status, (ts, event_id)) as status, max(ts) as changed_at, arg_max(status, (ts, event_id)) <> 'RESOLVED' as active from {_ALERT_LOG} group by 1")
def alert_lifecycle(spark, sf):
    status = F.when(F.col("event_type").isin("error", "click"), "ACTIVE").when(F.col("event_type") == "view", "ACKNOWLEDGED").otherwise("RESOLVED")
    log = table(spark, sf, "events").select("event_id", (F.col("event_id") % 997).alias("alert_id"), "ts", status.alias("status"))
    return L.alert_lifecycle(log)


@query("alert_messages", """select pipeline_id, ts, coalesce('Pipeline ' || pipeline_id || ' had ' || error_count || ' errors at ' || cpu_usage || ' percent',
   'Pipeline {pipeline_id} had {error_count} errors at {cpu_usage} percent (missing: cpu_usage)') as message from {snapshots}""")
def alert_messages(spark, sf):
    rows = table(spark, sf, "snapshots")
    template = "Pipeline {pipeline_id} had {error_count} errors at {cpu_usage} percent"
    text = L.message(template, {c: F.col(c) for c in ("pipeline_id", "error_count", "cpu_usage")})
    return rows.select("pipeline_id", "ts", text.alias("message"))


@query("health_check", """with c as (select 'recent_executions' as check_name, case when count(*) = 0 then 'WARNING' else 'PASSED' end as status from {run_metrics} where ts >= timestamp '2024-01-30' - interval 24 hours and metric_name = 'total_execution_time'
   union all select 'data_quality', case when avg(quality_score) is null then 'WARNING' when avg(quality_score) < 80 then 'FAILED' when min(quality_score) < 70 then 'WARNING' else 'PASSED' end from {quality_metrics} where ts >= timestamp '2024-01-30' - interval 24 hours
   union all select 'alerts', case when count(*) = 0 then 'PASSED' when count(*) filter (where severity = 'CRITICAL') > 0 then 'FAILED' else 'WARNING' end from {alerts} where ts >= timestamp '2024-01-30' - interval 24 hours and status <> 'RESOLVED'
   union all select 'data_freshness', case when max(ts) is null or max(ts) < timestamp '2024-01-30' - interval 24 hours then 'FAILED' when max(ts) < timestamp '2024-01-30' - interval 12 hours then 'WARNING' else 'PASSED' end from {run_metrics} where metric_name = 'total_execution_time' and ts <= timestamp '2024-01-30')
   select *, (select case when bool_or(status = 'FAILED') then 'UNHEALTHY' when bool_or(status = 'WARNING') then 'WARNING' else 'HEALTHY' end from c) as overall_status from c""")
def health_check(spark, sf):
    return M.health_check(table(spark, sf, "run_metrics"), table(spark, sf, "quality_metrics"), table(spark, sf, "alerts"), DAY_END)


@query("dashboard_summary", f"""with m as (select count(distinct pipeline_id) as total_runs, {S.mean('value', "metric_name = 'total_execution_time'")} as avg_execution_time,
     sum(cast(round(value * 100) as bigint)) filter (where metric_name = 'records_processed') / 100.0 as total_records, {S.mean('value', "metric_name = 'throughput'")} as avg_throughput from {{run_metrics}} where {_DAY}),
   q as (select sum(cast(quality_score as decimal(38,10)))::double / count(*) as avg_quality, min(quality_score) as min_quality, max(quality_score) as max_quality from {{quality_metrics}} where {_DAY}),
   a as (select {', '.join(f"count(*) filter (where severity = '{s}') as {s.lower()}_alerts" for s in V.SEVERITY_LEVELS)} from {{alerts}} where {_DAY})
   select *, case when avg_throughput > 50 then 'excellent' when avg_throughput > 20 then 'good' else 'needs attention' end as throughput_insight,
     case when avg_quality >= 95 then 'excellent' when avg_quality >= 80 then 'good' else 'needs attention' end as quality_insight from m, q, a""")
def dashboard_summary(spark, sf):
    return M.dashboard_summary(table(spark, sf, "run_metrics"), table(spark, sf, "quality_metrics"), table(spark, sf, "alerts"), DAY_END)
