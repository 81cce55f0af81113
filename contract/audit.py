"""Monitoring of checks, runs, loads, lineage, alerts and access."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import quality as q
from tidemark.operators.runlog import RunLog
from tidemark.plans import audit as au
from tidemark.plans.star import silver_table
from tidemark.sources import entities, sinks

from . import logs
from .ctes import CTES, div, pct, rnd
from .history import _audit_sql
from .registry import query

DAY, NOW = "2024-01-30", "2024-01-30 12:00:00"        # check log
RUN_DAY, RUN_NOW = "2001-07-31", "2001-08-01 12:00:00"  # pipeline runs
LOAD_DAY, LOAD_NOW = "2001-11-01", "2001-11-02 12:00:00"  # loads and lineage

CTES["a_dims"] = f"SELECT *, CASE WHEN operation_type = 'EXPIRE' THEN valid_to ELSE valid_from END AS audit_timestamp FROM ({_audit_sql()})"


def since(column: str, day: str, days: int) -> str:
    return f"{column} >= TIMESTAMP '{day} 00:00:00' - INTERVAL {days} DAY"


def hours(column: str, now: str, n: int) -> str:
    return f"{column} >= TIMESTAMP '{now}' - INTERVAL {n} HOUR"


def n_if(column: str, value: str, name: str) -> str:
    return f"count(*) FILTER ({column} = '{value}') AS {name}"


def rate(a: str, b: str, digits: int = 2) -> str:
    return rnd(pct(a, b), digits)


PASSED = "count(*) FILTER (check_status = 'PASS')"
LOG = since("execution_timestamp", DAY, 7)


@query("aud_table_health", f"""
SELECT table_schema, table_name, CASE WHEN row_count > 0 THEN '✅ Has Data' ELSE '⚠️ Empty' END AS status, row_count, {rnd(div('bytes', '1048576'), 2)} AS size_mb
FROM a_catalog WHERE table_name LIKE '%AUDIT%' OR table_name LIKE '%QUALITY%' OR table_name LIKE '%LINEAGE%' OR table_name LIKE '%VALIDATION%'""")
def aud_table_health(spark, sf):
    return au.table_health(logs.catalog(spark, sf))


@query("aud_log_counts", """
SELECT 'AUDIT.DATA_QUALITY_CHECKS' AS table_name, count(*) AS row_count, count(*) FILTER (is_active) AS key_count FROM a_checks
UNION ALL SELECT 'AUDIT.DATA_QUALITY_LOG', count(*), count(*) FILTER (check_status = 'PASS') FROM a_log
UNION ALL SELECT 'AUDIT.PIPELINE_EXECUTION_LOG', count(*), count(*) FILTER (execution_status = 'SUCCESS') FROM a_runs
UNION ALL SELECT 'AUDIT.DATA_LINEAGE', count(*), count(DISTINCT source_table || '→' || target_table) FROM a_lineage""")
def aud_log_counts(spark, sf):
    return au.log_counts(logs.checks(spark, sf), logs.log(spark, sf), logs.runs(spark, sf), logs.lineage(spark, sf))


@query("aud_missing_entries", f"""
SELECT table_schema, table_name, row_count, 'Missing Bronze Audit' AS issue FROM a_catalog WHERE table_schema = 'BRONZE'
  AND table_name NOT IN (SELECT table_name FROM a_loads WHERE {since('load_timestamp', LOAD_DAY, 1)})
UNION ALL SELECT table_schema, table_name, row_count, 'Missing Silver Audit' FROM a_catalog WHERE table_schema = 'SILVER'
  AND table_name NOT IN (SELECT target_table FROM a_silver WHERE {since('transformation_timestamp', LOAD_DAY, 1)})""")
def aud_missing_entries(spark, sf):
    return au.missing_entries(logs.catalog(spark, sf), logs.loads(spark, sf), logs.silver(spark, sf), LOAD_DAY)


@query("aud_check_status", f"""
SELECT layer, severity, count(DISTINCT c.check_id) AS total_checks, {n_if('check_status', 'PASS', 'passed')}, {n_if('check_status', 'FAIL', 'failed')},
  {n_if('check_status', 'ERROR', 'errors')}, {rate(PASSED, 'count(*)')} AS pass_rate_pct
FROM a_checks c LEFT JOIN a_log l ON c.check_id = l.check_id AND {hours('execution_timestamp', NOW, 24)} WHERE is_active GROUP BY layer, severity""")
def aud_check_status(spark, sf):
    return au.check_status(logs.checks(spark, sf), logs.log(spark, sf), NOW)


@query("aud_failed_checks", f"""
SELECT execution_timestamp, layer, severity, check_name, check_description, check_status, actual_value, expected_value, error_message,
  date_sub('hour', execution_timestamp, TIMESTAMP '{NOW}') AS hours_since_failure, alert_sent
FROM a_log l JOIN a_checks c ON l.check_id = c.check_id WHERE check_status IN ('FAIL', 'ERROR') AND {LOG} AND is_active""", text="execution_timestamp")
def aud_failed_checks(spark, sf):
    return au.failed_checks(logs.checks(spark, sf), logs.log(spark, sf), DAY, NOW)


@query("aud_quality_trend", f"""
SELECT CAST(execution_timestamp AS DATE) AS check_date, layer, count(*) AS total_checks, {n_if('check_status', 'PASS', 'passed')}, {n_if('check_status', 'FAIL', 'failed')},
  {rate(PASSED, 'count(*)')} AS pass_rate_pct FROM a_log l JOIN a_checks c ON l.check_id = c.check_id
WHERE {since('execution_timestamp', DAY, 30)} GROUP BY ALL""", text="check_date")
def aud_quality_trend(spark, sf):
    return au.quality_trend(logs.checks(spark, sf), logs.log(spark, sf), DAY)


@query("aud_slow_checks", f"""
SELECT c.check_id, check_name, layer, count(*) AS execution_count, {rnd(div('sum(execution_time_seconds)', 'count(*)'), 2)} AS avg_execution_time,
  max(execution_time_seconds) AS max_execution_time, min(execution_time_seconds) AS min_execution_time
FROM a_log l JOIN a_checks c ON l.check_id = c.check_id WHERE {LOG} GROUP BY ALL HAVING avg(CAST(execution_time_seconds AS DOUBLE)) > 1
ORDER BY avg_execution_time DESC, c.check_id LIMIT 20""", "max_execution_time min_execution_time")
def aud_slow_checks(spark, sf):
    return au.slow_checks(logs.checks(spark, sf), logs.log(spark, sf), DAY)


@query("aud_score_by_dimension", f"""
SELECT dimension, count(*) AS total_checks, {n_if('check_status', 'PASS', 'passed')}, {n_if('check_status', 'FAIL', 'failed')}, {rate(PASSED, 'count(*)')} AS quality_score
FROM a_checks c JOIN a_log l ON c.check_id = l.check_id WHERE is_active AND {since('execution_timestamp', DAY, 1)} GROUP BY ALL""")
def aud_score_by_dimension(spark, sf):
    return au.score_by_dimension(logs.checks(spark, sf), logs.log(spark, sf), DAY)


@query("aud_latest_status", """
SELECT layer, dimension, severity, check_name, check_status, execution_timestamp,
  CASE check_status WHEN 'PASS' THEN '✅' WHEN 'FAIL' THEN '❌' ELSE '⚠️' END AS status_icon
FROM (SELECT *, row_number() OVER (PARTITION BY check_id ORDER BY execution_timestamp DESC, log_id DESC) AS rn FROM a_log) l
JOIN a_checks c ON l.check_id = c.check_id WHERE rn = 1""", text="execution_timestamp")
def aud_latest_status(spark, sf):
    return au.latest_status(logs.checks(spark, sf), logs.log(spark, sf))


FAILED = "count(*) FILTER (check_status = 'FAIL')"


@query("aud_most_failing", f"""
SELECT check_name, count(*) AS total_runs, {FAILED} AS failures, {rate(FAILED, 'count(*)', 1)} AS failure_rate
FROM a_log l JOIN a_checks c ON l.check_id = c.check_id WHERE {since('execution_timestamp', DAY, 30)} GROUP BY ALL HAVING {rate(FAILED, 'count(*)', 1)} > 20""")
def aud_most_failing(spark, sf):
    return au.most_failing(logs.checks(spark, sf), logs.log(spark, sf), DAY)


@query("aud_common_failures", f"""
SELECT check_name, count(*) AS failure_count FROM a_log l JOIN a_checks c ON l.check_id = c.check_id
WHERE check_status = 'FAIL' AND {since('execution_timestamp', DAY, 30)} GROUP BY ALL ORDER BY failure_count DESC, check_name LIMIT 10""")
def aud_common_failures(spark, sf):
    return au.common_failures(logs.checks(spark, sf), logs.log(spark, sf), DAY)


@query("aud_daily_score", f"SELECT {rate(PASSED, 'count(*)')} AS quality_score FROM a_log WHERE CAST(execution_timestamp AS DATE) = DATE '{DAY}'")
def aud_daily_score(spark, sf):
    return au.daily_score(logs.log(spark, sf), DAY)


@query("aud_weekly_report", f"""
SELECT layer, dimension, count(*) AS total_executions, {n_if('check_status', 'PASS', 'passed')}, {rate(PASSED, 'count(*)', 1)} AS pass_rate
FROM a_log l JOIN a_checks c ON l.check_id = c.check_id WHERE {LOG} GROUP BY ALL""")
def aud_weekly_report(spark, sf):
    return au.weekly_report(logs.checks(spark, sf), logs.log(spark, sf), DAY)


RUNS = since("execution_start", RUN_DAY, 7)
OK = "count(*) FILTER (execution_status = 'SUCCESS')"


@query("aud_pipeline_summary", f"""
SELECT CAST(execution_start AS DATE) AS execution_date, layer, count(*) AS total_runs, {OK} AS successful, {n_if('execution_status', 'FAILED', 'failed')},
  {n_if('execution_status', 'RUNNING', 'running')}, {rate(OK, 'count(*)')} AS success_rate_pct FROM a_runs WHERE {RUNS} GROUP BY ALL""", text="execution_date")
def aud_pipeline_summary(spark, sf):
    return au.pipeline_summary(logs.runs(spark, sf), RUN_DAY)


@query("aud_failed_runs", f"""
SELECT execution_id, pipeline_name, layer, environment, execution_start, execution_end,
  date_sub('minute', execution_start, coalesce(execution_end, TIMESTAMP '{RUN_NOW}')) AS duration_minutes, rows_processed, error_message, executed_by
FROM a_runs WHERE execution_status = 'FAILED' AND {RUNS}""", text="execution_start execution_end")
def aud_failed_runs(spark, sf):
    return au.failed_runs(logs.runs(spark, sf), RUN_DAY, RUN_NOW)


SECONDS = "date_sub('second', execution_start, execution_end)"


@query("aud_pipeline_perf", f"""
SELECT pipeline_name, layer, count(*) AS execution_count, {rnd(div(f'sum({SECONDS})', 'count(*)'), 2)} AS avg_duration_seconds, max({SECONDS}) AS max_duration_seconds,
  CAST(sum(rows_processed) AS BIGINT) AS total_rows_processed, {rnd(div('sum(rows_processed)', 'count(rows_processed)'), 0)} AS avg_rows_per_run
FROM a_runs WHERE execution_status = 'SUCCESS' AND execution_end IS NOT NULL AND {RUNS} GROUP BY ALL
ORDER BY avg_duration_seconds DESC, pipeline_name, layer LIMIT 20""")
def aud_pipeline_perf(spark, sf):
    return au.pipeline_perf(logs.runs(spark, sf), RUN_DAY)


@query("aud_long_running", f"""
SELECT execution_id, pipeline_name, layer, environment, execution_start, date_sub('minute', execution_start, TIMESTAMP '{RUN_NOW}') AS running_for_minutes,
  rows_processed, executed_by FROM a_runs WHERE execution_status = 'RUNNING' AND {hours("execution_start", RUN_NOW, 96)}""", text="execution_start")
def aud_long_running(spark, sf):
    return au.long_running(logs.runs(spark, sf), RUN_NOW, 96)


@query("aud_lineage_flow", f"""
SELECT source_layer, source_table, target_layer, target_table, transformation_name, load_type, count(*) AS load_count, max(load_timestamp) AS last_load,
  CAST(sum(source_record_count) AS BIGINT) AS total_source_records, CAST(sum(target_record_count) AS BIGINT) AS total_target_records,
  {rate('sum(target_record_count)', 'sum(source_record_count)')} AS data_flow_pct FROM a_lineage WHERE {since('load_timestamp', LOAD_DAY, 7)} GROUP BY ALL""", text="last_load")
def aud_lineage_flow(spark, sf):
    return au.lineage_flow(logs.lineage(spark, sf), LOAD_DAY)


_TO_SILVER = "source_layer = 'BRONZE' AND target_layer = 'SILVER'"


@query("aud_lineage_gaps", f"""
SELECT b.table_name AS bronze_table, b.load_timestamp AS bronze_load_time, 'Missing Silver lineage' AS issue,
  date_sub('hour', b.load_timestamp, TIMESTAMP '{LOAD_NOW}') AS hours_since_load
FROM a_loads b
WHERE {since('b.load_timestamp', LOAD_DAY, 1)} AND b.load_status = 'SUCCESS'
  AND NOT EXISTS (SELECT 1 FROM a_lineage l WHERE {_TO_SILVER} AND l.source_table = b.table_name AND l.load_timestamp >= b.load_timestamp)""",
       text="bronze_load_time")
def aud_lineage_gaps(spark, sf):
    return au.lineage_gaps(logs.loads(spark, sf), logs.lineage(spark, sf), LOAD_DAY, LOAD_NOW)


@query("aud_reconcile", f"""
SELECT table_name AS bronze_table, target_table AS silver_table, bronze_records, silver_records, abs(bronze_records - coalesce(silver_records, 0)) AS variance,
  match_pct, CASE WHEN match_pct >= 99 THEN '✅ Good' WHEN match_pct >= 95 THEN '⚠️ Check' ELSE '❌ Issue' END AS status
FROM (
  SELECT *, {rate('coalesce(silver_records, 0)', 'bronze_records')} AS match_pct
  FROM (SELECT table_name, CAST(sum(records_loaded) AS BIGINT) AS bronze_records FROM a_loads
        WHERE {since('load_timestamp', LOAD_DAY, 1)} AND load_status = 'SUCCESS' GROUP BY table_name) b
  LEFT JOIN (SELECT source_table, target_table, CAST(sum(target_record_count) AS BIGINT) AS silver_records FROM a_lineage
             WHERE {since('load_timestamp', LOAD_DAY, 1)} AND {_TO_SILVER} GROUP BY source_table, target_table) s ON b.table_name = s.source_table)""")
def aud_reconcile(spark, sf):
    return au.reconcile(logs.loads(spark, sf), logs.lineage(spark, sf), LOAD_DAY)


@query("aud_bronze_loads", f"""
SELECT CAST(load_timestamp AS DATE) AS load_date, table_name, load_type, load_status, records_extracted, records_loaded, records_rejected,
  {rate('records_loaded', 'records_extracted')} AS load_success_rate, execution_time_seconds FROM a_loads WHERE {since('load_timestamp', LOAD_DAY, 7)}""",
       "execution_time_seconds", "load_date")
def aud_bronze_loads(spark, sf):
    return au.bronze_loads(logs.loads(spark, sf), LOAD_DAY)


@query("aud_json_issues", f"""
SELECT table_name, json_path, validation_error, count(*) AS error_count, {n_if('resolution_status', 'OPEN', 'open_issues')}, max(validation_timestamp) AS last_occurrence
FROM a_json WHERE {since('validation_timestamp', DAY, 7)} GROUP BY ALL""", text="last_occurrence")
def aud_json_issues(spark, sf):
    return au.json_issues(logs.json_validation(spark, sf), DAY)


@query("aud_silver_scores", f"""
SELECT target_table, transformation_type, count(*) AS transformation_count, round(avg(data_quality_score), 4) AS avg_quality_score,
  CAST(sum(records_rejected) AS BIGINT) AS total_rejected, {rnd(div('sum(execution_time_seconds)', 'count(*)'), 2)} AS avg_execution_time,
  max(transformation_timestamp) AS last_transformation
FROM a_silver WHERE {since('transformation_timestamp', LOAD_DAY, 7)} AND transformation_status = 'SUCCESS' GROUP BY ALL""", text="last_transformation")
def aud_silver_scores(spark, sf):
    return au.silver_scores(logs.silver(spark, sf), LOAD_DAY)


@query("aud_silver_issues", f"""
SELECT table_name, issue_type, severity, count(*) AS issue_count, {n_if('resolution_status', 'OPEN', 'open_issues')},
  {n_if('resolution_status', 'RESOLVED', 'resolved_issues')}, max(issue_timestamp) AS last_occurrence FROM a_issues WHERE {since('issue_timestamp', DAY, 7)} GROUP BY ALL""",
       text="last_occurrence")
def aud_silver_issues(spark, sf):
    return au.silver_issues(logs.issues(spark, sf), DAY)


@query("aud_scd_trail", f"""
SELECT dimension_table, scd_type, operation_type, count(*) AS change_count, count(DISTINCT natural_key) AS unique_entities_changed, max(audit_timestamp) AS last_change
FROM a_dims WHERE {since('audit_timestamp', '2024-02-10', 7)} GROUP BY ALL""", text="last_change")
def aud_scd_trail(spark, sf):
    return au.scd_trail(logs.dimension_changes(spark, sf), "2024-02-10")


@query("aud_fact_loads", f"""
SELECT fact_table, load_date, load_type, load_status, source_record_count, target_record_count, records_inserted, records_updated, orphaned_records,
  execution_time_seconds FROM a_facts WHERE {since('load_timestamp', RUN_DAY, 7)}""", "execution_time_seconds", "load_date")
def aud_fact_loads(spark, sf):
    return au.fact_loads(logs.facts(spark, sf), RUN_DAY)


@query("aud_ri_violations", f"""
SELECT fact_table, dimension_table, foreign_key_column, orphaned_record_count, resolution_status, check_timestamp, resolution_action FROM a_ri
WHERE {since('check_timestamp', LOAD_DAY, 7)} AND orphaned_record_count > 0""", text="check_timestamp")
def aud_ri_violations(spark, sf):
    return au.ri_violations(logs.ri(spark, sf), LOAD_DAY)


@query("aud_exec_summary", f"""
SELECT '📊 Overall Data Quality Score' AS metric, format('{{:.1f}}', {rate(PASSED, 'count(*)', 1)}) || '%' AS value, count(*) AS checks_executed
FROM a_log WHERE {since('execution_timestamp', DAY, 1)}
UNION ALL SELECT '❌ Critical Failures (24h)', CAST(count(*) AS VARCHAR), NULL FROM a_log l JOIN a_checks c ON l.check_id = c.check_id
WHERE check_status = 'FAIL' AND severity = 'CRITICAL' AND {hours('execution_timestamp', NOW, 24)}
UNION ALL SELECT '✅ Pipeline Success Rate (7d)', format('{{:.1f}}', {rate(OK, 'count(*)', 1)}) || '%', count(*) FROM a_runs WHERE {RUNS}
UNION ALL SELECT '📈 Total Records Processed (7d)', format('{{:,}}', CAST(sum(rows_processed) AS BIGINT)), NULL FROM a_runs WHERE {RUNS} AND execution_status = 'SUCCESS'""")
def aud_exec_summary(spark, sf):
    return au.exec_summary(logs.checks(spark, sf), logs.log(spark, sf), logs.runs(spark, sf), DAY, NOW, RUN_DAY)


@query("aud_moving_avg", f"""
SELECT check_date, total_checks, passed, {rate('passed', 'total_checks')} AS pass_rate,
  round(avg(CAST(passed AS DOUBLE) / total_checks * 100) OVER (ORDER BY check_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS moving_avg_7d
FROM (SELECT CAST(execution_timestamp AS DATE) AS check_date, count(*) AS total_checks, {PASSED} AS passed FROM a_log
      WHERE {since('execution_timestamp', DAY, 30)} GROUP BY ALL)""", text="check_date")
def aud_moving_avg(spark, sf):
    return au.moving_avg(logs.log(spark, sf), DAY)


@query("aud_alert_summary", f"""
SELECT check_name, severity, alert_type, alert_count, last_alert_sent, date_sub('hour', last_alert_sent, TIMESTAMP '{NOW}') AS hours_since_last_alert
FROM a_alerts a JOIN a_checks c ON a.check_id = c.check_id WHERE a.is_active AND alert_count > 0""", text="last_alert_sent")
def aud_alert_summary(spark, sf):
    return au.alert_summary(logs.alerts(spark, sf), logs.checks(spark, sf), NOW)


_PROFILE_SUMMARY = f"""
SELECT schema_name, table_name, count(DISTINCT column_name) AS columns_profiled, round(avg(null_percentage), 4) AS avg_null_pct, max(profile_timestamp) AS last_profiled,
  date_diff('day', CAST(max(profile_timestamp) AS DATE), DATE '{DAY}') AS days_since_last_profile FROM a_profiles GROUP BY ALL"""


@query("aud_profile_summary", _PROFILE_SUMMARY, text="last_profiled")
def aud_profile_summary(spark, sf):
    return au.profile_summary(logs.profiles(spark, sf), DAY)


@query("aud_action_items", f"""
SELECT 'Critical' AS priority, 'Failed Quality Check' AS action_type, check_name AS description, execution_timestamp AS identified_at
FROM a_log l JOIN a_checks c ON l.check_id = c.check_id WHERE check_status = 'FAIL' AND severity = 'CRITICAL' AND {hours('execution_timestamp', NOW, 24)}
UNION ALL SELECT 'High', 'Pipeline Failure', pipeline_name, execution_start FROM a_runs WHERE execution_status = 'FAILED' AND {since('execution_start', RUN_DAY, 1)}
UNION ALL SELECT 'High', 'Referential Integrity Violation', fact_table || ' → ' || dimension_table, check_timestamp FROM a_ri
WHERE orphaned_record_count > 0 AND resolution_status = 'OPEN' AND {since('check_timestamp', LOAD_DAY, 1)}""", text="identified_at")
def aud_action_items(spark, sf):
    return au.action_items(logs.checks(spark, sf), logs.log(spark, sf), logs.runs(spark, sf), logs.ri(spark, sf), NOW, RUN_DAY, LOAD_DAY)


@query("aud_maintenance", f"""
SELECT 'Archive old audit logs' AS recommendation, 'AUDIT.DATA_QUALITY_LOG has ' || count(*) || ' records older than 90 days' AS details, 'Medium' AS priority
FROM a_log WHERE execution_timestamp < TIMESTAMP '2024-04-15 00:00:00' - INTERVAL 90 DAY HAVING count(*) > 0
UNION ALL SELECT 'Profile tables', schema_name || '.' || table_name || ' last profiled ' || days_since_last_profile || ' days ago', 'Low' FROM ({_PROFILE_SUMMARY}) WHERE days_since_last_profile > 30
UNION ALL SELECT 'Review inactive checks', count(*) || ' quality checks are marked inactive', 'Low' FROM a_checks WHERE NOT is_active HAVING count(*) > 0""")
def aud_maintenance(spark, sf):
    return au.maintenance(logs.checks(spark, sf), logs.log(spark, sf), logs.profiles(spark, sf), "2024-04-15", DAY)


@query("aud_ingest_history", f"""
SELECT CAST(error_timestamp AS DATE) AS run_date, count(DISTINCT error_timestamp) AS total_runs, {n_if('table_name', 'PIPELINE_SUCCESS', 'successful_runs')},
  {n_if('table_name', 'PIPELINE_FAILURE', 'failed_runs')}, {rate("count(*) FILTER (table_name = 'PIPELINE_SUCCESS')", 'count(*)')} AS success_rate
FROM a_ingest WHERE table_name IN ('PIPELINE_SUCCESS', 'PIPELINE_FAILURE') AND {since('error_timestamp', RUN_DAY, 30)} GROUP BY ALL""", text="run_date")
def aud_ingest_history(spark, sf):
    return au.ingest_history(logs.ingest(spark, sf), RUN_DAY)


@query("aud_ingest_ratio", f"""
SELECT CASE table_name WHEN 'PIPELINE_SUCCESS' THEN 'Success' WHEN 'PIPELINE_FAILURE' THEN 'Failure' ELSE 'Other' END AS status, count(*) AS count,
  min(error_timestamp) AS first_occurrence, max(error_timestamp) AS last_occurrence FROM a_ingest WHERE {since('error_timestamp', RUN_DAY, 7)} GROUP BY 1""",
       text="first_occurrence last_occurrence")
def aud_ingest_ratio(spark, sf):
    return au.ingest_ratio(logs.ingest(spark, sf), RUN_DAY)


@query("aud_env_comparison", f"""
SELECT environment, count(DISTINCT pipeline_name) AS total_pipelines, count(*) AS total_executions, {OK} AS successful_runs,
  {n_if('execution_status', 'FAILED', 'failed_runs')}, {rnd(div(f'sum({SECONDS})', f'count({SECONDS})'), 2)} AS avg_duration_seconds, max(execution_start) AS last_execution
FROM a_runs WHERE {hours('execution_start', RUN_NOW, 168)} GROUP BY ALL""", text="last_execution")
def aud_env_comparison(spark, sf):
    return au.env_comparison(logs.runs(spark, sf), RUN_NOW)


_DAYS = f"""SELECT pipeline_name, CAST(execution_start AS DATE) AS run_date, count(*) AS runs, {n_if('execution_status', 'FAILED', 'failures')},
  count(*) FILTER ({SECONDS} > 1800) AS long_runs, CAST(sum(rows_processed) AS BIGINT) AS row_total FROM a_runs WHERE {since('execution_start', RUN_DAY, 8)} GROUP BY ALL"""
_CHANGE = rate("(d.row_total - b.row_total)", "b.row_total")


@query("aud_run_conditions", f"""
SELECT d.*, {_CHANGE} AS row_variance_pct, failures > 0 AS failure_alert, long_runs > 0 AS duration_alert, coalesce(abs({_CHANGE}) > 20, FALSE) AS variance_alert
FROM ({_DAYS}) d LEFT JOIN (SELECT pipeline_name, run_date, row_total FROM ({_DAYS})) b ON d.pipeline_name = b.pipeline_name AND d.run_date = b.run_date + 1
WHERE d.run_date >= DATE '{RUN_DAY}' - 7""", text="run_date")
def aud_run_conditions(spark, sf):
    return au.run_conditions(logs.runs(spark, sf), RUN_DAY)


_ERR = rate("sum(records_rejected)", "sum(records_extracted)")


@query("aud_load_conditions", f"""
SELECT table_name, max(execution_time_seconds) AS max_seconds, max(load_timestamp) AS last_load, {_ERR} AS error_pct, max(execution_time_seconds) > 30 AS slow_alert,
  date_sub('hour', max(load_timestamp), TIMESTAMP '{LOAD_NOW}') > 48 AS stale_alert, {_ERR} > 5 AS error_alert
FROM a_loads WHERE {since('load_timestamp', LOAD_DAY, 7)} GROUP BY ALL""", "max_seconds", "last_load")
def aud_load_conditions(spark, sf):
    return au.load_conditions(logs.loads(spark, sf), LOAD_DAY, LOAD_NOW)


@query("aud_user_access", f"""
SELECT user_name, role_name, count(*) AS query_count, count(DISTINCT CAST(event_timestamp AS DATE)) AS active_days, max(event_timestamp) AS last_access,
  count(*) FILTER (NOT success) AS failed_attempts FROM a_access WHERE {hours('event_timestamp', NOW, 720)} GROUP BY ALL""", text="last_access")
def aud_user_access(spark, sf):
    return au.user_access(logs.access(spark, sf), NOW)


@query("aud_policy_violations", """
SELECT event_timestamp, user_name, role_name, object_name, action, error_message, query_id FROM a_access WHERE event_type = 'POLICY_VIOLATION'""", text="event_timestamp")
def aud_policy_violations(spark, sf):
    return au.policy_violations(logs.access(spark, sf))


# ---- alerts ----------------------------------------------------------------------------------------
_RUN_LENGTH = """
SELECT check_id, count(*) AS consecutive_failures, max(execution_timestamp) AS last_failure
FROM (SELECT *, max(CASE WHEN check_status <> 'FAIL' THEN execution_timestamp END) OVER (PARTITION BY check_id) AS last_ok FROM a_log)
WHERE check_status = 'FAIL' AND (last_ok IS NULL OR execution_timestamp > last_ok) GROUP BY check_id"""
_DECISIONS = f"""
SELECT c.check_id, check_name, severity, consecutive_failures, last_failure,
  CASE severity WHEN 'CRITICAL' THEN CASE WHEN consecutive_failures >= 1 THEN 'ALERT_NOW' ELSE 'WAIT' END
    WHEN 'HIGH' THEN CASE WHEN consecutive_failures >= 2 THEN 'ALERT_NOW' ELSE 'WAIT' END ELSE 'DAILY_SUMMARY' END AS decision
FROM ({_RUN_LENGTH}) r JOIN a_checks c ON r.check_id = c.check_id"""


@query("alert_decisions", _DECISIONS, text="last_failure")
def alert_decisions(spark, sf):
    return q.alert_decisions(logs.log(spark, sf), logs.checks(spark, sf))


@query("mark_alerted", f"""
SELECT log_id, check_id, execution_timestamp, check_status, alert_sent OR (execution_timestamp >= TIMESTAMP '2024-01-29 12:00:00'
  AND check_id IN (SELECT check_id FROM ({_DECISIONS}) WHERE decision = 'ALERT_NOW')) AS alert_sent FROM a_log""", text="execution_timestamp")
def mark_alerted(spark, sf):
    """The log with the last day's rows of alerting checks flagged."""
    log = logs.log(spark, sf)
    now = q.alert_decisions(log, logs.checks(spark, sf)).where("decision = 'ALERT_NOW'")
    return q.mark_alerted(log, now, NOW, hours=24).select("log_id", "check_id", "execution_timestamp", "check_status", "alert_sent")


# ---- writing the logs ------------------------------------------------------------------------------
@query("aud_lineage_write", """
SELECT 'BRONZE' AS source_layer, 'SALES' AS source_table, 'SILVER' AS target_layer, 'SALES' AS target_table, 'cleanse sales' AS transformation_name,
  TIMESTAMP '2024-02-05 00:00:00' AS load_timestamp, (SELECT count(*) FROM b_sales) AS source_record_count, (SELECT count(*) FROM s_sales) AS target_record_count, 'FULL' AS load_type""",
       text="load_timestamp")
def aud_lineage_write(spark, sf):
    """The lineage row of a load, written and read back."""
    t = sinks.VersionedTable(spark, session.scratch_path(spark, "lineage"))
    names = {"source_layer": "BRONZE", "source_table": "SALES", "target_layer": "SILVER", "target_table": "SALES", "transformation_name": "cleanse sales"}
    t.append(au.lineage_row(entities.sales(spark, sf), silver_table(spark, sf, "sales"), names, "FULL", "2024-02-05 00:00:00"))
    return t.read().select(*au.LINEAGE_COLUMNS)


@query("aud_run_log", """
SELECT 'load campaigns' AS pipeline_name, 'SUCCESS' AS execution_status, (SELECT count(*) FROM s_campaigns) AS rows_processed, FALSE AS has_error
UNION ALL SELECT 'load broken', 'FAILED', NULL, TRUE""")
def aud_run_log(spark, sf):
    """Two runs logged: one that succeeds and one that fails."""
    log = RunLog(spark, session.scratch_path(spark, "runs"))
    out = session.scratch_path(spark, "campaigns")

    def good():
        silver_table(spark, sf, "campaigns").write.parquet(out)
        return spark.read.parquet(out).count()

    def broken():
        raise ValueError("no such source")

    for name, work in (("load campaigns", good), ("load broken", broken)):
        log.run(name, "SILVER", "PROD", work, reraise=False)
    return log.latest().select("pipeline_name", "execution_status", "rows_processed", F.col("error_message").isNotNull().alias("has_error"))
