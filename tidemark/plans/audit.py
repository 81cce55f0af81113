"""Monitoring queries over the audit logs.

Every query filters its log on a literal time window first, so the scan
prunes by time; the check registry and other small sides are joined after the
window and reduced by key where possible. `as_of` is the day, `now` the
instant the report is made.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.expressions import day, elapsed, percent, rank_of, ratio, ts

LAYERS = ["BRONZE", "SILVER", "GOLD"]
SEVERITIES = ["CRITICAL", "HIGH", "MEDIUM"]


def recent(df: DataFrame, column: str, as_of, days: int) -> DataFrame:
    """Rows since `days` days before the day."""
    return df.where(F.col(column) >= F.date_sub(day(as_of), days).cast("timestamp_ntz"))


def recent_hours(df: DataFrame, column: str, now, hours: int) -> DataFrame:
    return df.where(F.col(column) >= ts(now) - F.make_dt_interval(F.lit(0), F.lit(hours)))


def _n(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def _is(value: str, column: str = "check_status") -> Column:
    return F.col(column) == value


def _rate(part: str, whole: str, digits: int = 2) -> Column:
    return F.round(percent(part, whole), digits)


def _status_counts(g, *extra: Column) -> DataFrame:
    return g.agg(F.count(F.lit(1)).alias("total_checks"), _n(_is("PASS"), "passed"), _n(_is("FAIL"), "failed"), *extra)


# ---- tables ----------------------------------------------------------------------------------------
def table_health(catalog: DataFrame) -> DataFrame:
    """Audit tables of the catalog frame with their size and whether they hold data."""
    name = F.col("table_name")
    audit = name.contains("AUDIT") | name.contains("QUALITY") | name.contains("LINEAGE") | name.contains("VALIDATION")
    return catalog.where(F.col("table_schema").isin("AUDIT", *LAYERS) & audit).select(
        "table_schema", "table_name", F.when(F.col("row_count") > 0, "✅ Has Data").otherwise("⚠️ Empty").alias("status"),
        "row_count", F.round(ratio("bytes", F.lit(1048576)), 2).alias("size_mb")).orderBy("table_schema", "table_name")


def log_counts(checks: DataFrame, log: DataFrame, runs: DataFrame, lineage: DataFrame) -> DataFrame:
    def row(df: DataFrame, name: str, value: Column) -> DataFrame:
        return df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"), value.alias("key_count"))
    return (row(checks, "AUDIT.DATA_QUALITY_CHECKS", F.count_if("is_active"))
            .unionByName(row(log, "AUDIT.DATA_QUALITY_LOG", F.count_if(_is("PASS"))))
            .unionByName(row(runs, "AUDIT.PIPELINE_EXECUTION_LOG", F.count_if(_is("SUCCESS", "execution_status"))))
            .unionByName(row(lineage, "AUDIT.DATA_LINEAGE", F.count_distinct("source_table", "target_table"))))


def missing_entries(catalog: DataFrame, loads: DataFrame, silver: DataFrame, as_of) -> DataFrame:
    """Tables without an audit row since yesterday."""
    def part(schema: str, audit: DataFrame, column: str, issue: str) -> DataFrame:
        seen = audit.select(F.col(column).alias("table_name")).distinct()
        return catalog.where(F.col("table_schema") == schema).join(seen, "table_name", "left_anti").select(
            "table_schema", "table_name", "row_count", F.lit(issue).alias("issue"))
    return part("BRONZE", recent(loads, "load_timestamp", as_of, 1), "table_name", "Missing Bronze Audit").unionByName(
        part("SILVER", recent(silver, "transformation_timestamp", as_of, 1), "target_table", "Missing Silver Audit"))


# ---- quality ---------------------------------------------------------------------------------------
def check_status(checks: DataFrame, log: DataFrame, now) -> DataFrame:
    """Status of the last 24 hours; never-run checks count in the denominator, as the report defines it.

    The log is reduced per check before it meets the registry.
    """
    per_check = recent_hours(log, "execution_timestamp", now, 24).groupBy("check_id").agg(
        F.count("*").alias("_rows"), _n(_is("PASS"), "_p"), _n(_is("FAIL"), "_f"), _n(_is("ERROR"), "_e"))
    g = checks.where("is_active").join(per_check, "check_id", "left").groupBy("layer", "severity").agg(
        F.count("*").alias("total_checks"), *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in
                                              (("_p", "passed"), ("_f", "failed"), ("_e", "errors"))],
        F.sum(F.coalesce("_rows", F.lit(1))).alias("_all"))
    return g.withColumn("pass_rate_pct", _rate("passed", "_all")).drop("_all").orderBy(
        rank_of("layer", LAYERS), rank_of("severity", SEVERITIES))


def failed_checks(checks: DataFrame, log: DataFrame, as_of, now, days: int = 7) -> DataFrame:
    bad = recent(log, "execution_timestamp", as_of, days).where(F.col("check_status").isin("FAIL", "ERROR"))
    j = bad.join(checks.where("is_active"), "check_id")
    return j.select(
        "execution_timestamp", "layer", "severity", "check_name", "check_description", "check_status", "actual_value", "expected_value",
        "error_message", elapsed("HOUR", "execution_timestamp", ts(now)).alias("hours_since_failure"), "alert_sent").orderBy(
        rank_of("severity", SEVERITIES), F.desc("execution_timestamp"))


def quality_trend(checks: DataFrame, log: DataFrame, as_of, days: int = 30) -> DataFrame:
    daily = recent(log, "execution_timestamp", as_of, days).groupBy(F.to_date("execution_timestamp").alias("check_date"), "check_id").agg(
        F.count("*").alias("n"), _n(_is("PASS"), "p"), _n(_is("FAIL"), "f"))
    g = daily.join(checks.select("check_id", "layer"), "check_id").groupBy("check_date", "layer").agg(
        F.sum("n").alias("total_checks"), F.sum("p").alias("passed"), F.sum("f").alias("failed"))
    return g.withColumn("pass_rate_pct", _rate("passed", "total_checks")).orderBy(F.desc("check_date"), "layer")


def slow_checks(checks: DataFrame, log: DataFrame, as_of, days: int = 7, seconds: float = 1, n: int = 20) -> DataFrame:
    per = recent(log, "execution_timestamp", as_of, days).where(F.col("execution_time_seconds").isNotNull()).groupBy("check_id").agg(
        F.count("*").alias("execution_count"), F.sum("execution_time_seconds").alias("_s"),
        F.round(F.max("execution_time_seconds"), 2).alias("max_execution_time"), F.round(F.min("execution_time_seconds"), 2).alias("min_execution_time"))
    per = per.withColumn("_avg", ratio("_s", "execution_count")).where(F.col("_avg") > seconds)
    return per.join(checks, "check_id").select(
        "check_id", "check_name", "layer", "execution_count", F.round("_avg", 2).alias("avg_execution_time"), "max_execution_time",
        "min_execution_time").orderBy(F.desc("avg_execution_time"), "check_id").limit(n)


def score_by_dimension(checks: DataFrame, log: DataFrame, as_of) -> DataFrame:
    per = recent(log, "execution_timestamp", as_of, 1).groupBy("check_id").agg(
        F.count("*").alias("n"), _n(_is("PASS"), "p"), _n(_is("FAIL"), "f"))
    g = per.join(checks.where("is_active"), "check_id").groupBy("dimension").agg(
        F.sum("n").alias("total_checks"), F.sum("p").alias("passed"), F.sum("f").alias("failed"))
    return g.withColumn("quality_score", _rate("passed", "total_checks")).orderBy(F.desc("quality_score"), "dimension")


def latest_status(checks: DataFrame, log: DataFrame) -> DataFrame:
    """The newest result of every check: max_by with map-side combine, ties to the larger log id."""
    last = log.groupBy("check_id").agg(F.max(F.struct("execution_timestamp", "log_id", "check_status")).alias("_l"))
    icon = F.when(F.col("check_status") == "PASS", "✅").when(F.col("check_status") == "FAIL", "❌").otherwise("⚠️")
    return last.select("check_id", F.col("_l.check_status").alias("check_status"), F.col("_l.execution_timestamp").alias("execution_timestamp")).join(
        checks, "check_id").select("layer", "dimension", "severity", "check_name", "check_status", "execution_timestamp", icon.alias("status_icon")).orderBy(
        rank_of("severity", SEVERITIES), "check_name")


def most_failing(checks: DataFrame, log: DataFrame, as_of, days: int = 30, rate: float = 20) -> DataFrame:
    per = recent(log, "execution_timestamp", as_of, days).groupBy("check_id").agg(F.count("*").alias("total_runs"), _n(_is("FAIL"), "failures"))
    per = per.withColumn("failure_rate", _rate("failures", "total_runs", 1)).where(F.col("failure_rate") > rate)
    return per.join(checks.select("check_id", "check_name"), "check_id").select("check_name", "total_runs", "failures", "failure_rate").orderBy(
        F.desc("failure_rate"), "check_name")


def common_failures(checks: DataFrame, log: DataFrame, as_of, days: int = 30, n: int = 10) -> DataFrame:
    per = recent(log, "execution_timestamp", as_of, days).where(_is("FAIL")).groupBy("check_id").agg(F.count("*").alias("failure_count"))
    return per.join(checks.select("check_id", "check_name"), "check_id").select("check_name", "failure_count").orderBy(
        F.desc("failure_count"), "check_name").limit(n)


def daily_score(log: DataFrame, as_of) -> DataFrame:
    d = log.where(F.to_date("execution_timestamp") == day(as_of)).agg(F.count("*").alias("n"), _n(_is("PASS"), "p"))
    return d.select(_rate("p", "n").alias("quality_score"))


def weekly_report(checks: DataFrame, log: DataFrame, as_of) -> DataFrame:
    per = recent(log, "execution_timestamp", as_of, 7).groupBy("check_id").agg(F.count("*").alias("n"), _n(_is("PASS"), "p"))
    g = per.join(checks, "check_id").groupBy("layer", "dimension").agg(F.sum("n").alias("total_executions"), F.sum("p").alias("passed"))
    return g.withColumn("pass_rate", _rate("passed", "total_executions", 1)).orderBy("layer", "dimension")


# ---- pipeline runs ---------------------------------------------------------------------------------
def _runs(status: str) -> Column:
    return _is(status, "execution_status")


def pipeline_summary(runs: DataFrame, as_of, days: int = 7) -> DataFrame:
    g = recent(runs, "execution_start", as_of, days).groupBy(F.to_date("execution_start").alias("execution_date"), "layer").agg(
        F.count("*").alias("total_runs"), _n(_runs("SUCCESS"), "successful"), _n(_runs("FAILED"), "failed"), _n(_runs("RUNNING"), "running"))
    return g.withColumn("success_rate_pct", _rate("successful", "total_runs")).orderBy(F.desc("execution_date"), "layer")


def failed_runs(runs: DataFrame, as_of, now, days: int = 7) -> DataFrame:
    return recent(runs, "execution_start", as_of, days).where(_runs("FAILED")).select(
        "execution_id", "pipeline_name", "layer", "environment", "execution_start", "execution_end",
        elapsed("MINUTE", "execution_start", F.coalesce("execution_end", ts(now))).alias("duration_minutes"),
        "rows_processed", "error_message", "executed_by").orderBy(F.desc("execution_start"), "execution_id")


def pipeline_perf(runs: DataFrame, as_of, days: int = 7, n: int = 20) -> DataFrame:
    seconds = elapsed("SECOND", "execution_start", "execution_end")
    g = recent(runs, "execution_start", as_of, days).where(_runs("SUCCESS") & F.col("execution_end").isNotNull()).groupBy("pipeline_name", "layer").agg(
        F.count("*").alias("execution_count"), F.round(ratio(F.sum(seconds), F.count("*")), 2).alias("avg_duration_seconds"),
        F.max(seconds).alias("max_duration_seconds"), F.sum("rows_processed").alias("total_rows_processed"),
        F.round(ratio(F.sum("rows_processed"), F.count("rows_processed")), 0).alias("avg_rows_per_run"))
    return g.orderBy(F.desc("avg_duration_seconds"), "pipeline_name", "layer").limit(n)


def long_running(runs: DataFrame, now, hours: int = 24) -> DataFrame:
    return recent_hours(runs, "execution_start", now, hours).where(_runs("RUNNING")).select(
        "execution_id", "pipeline_name", "layer", "environment", "execution_start",
        elapsed("MINUTE", "execution_start", ts(now)).alias("running_for_minutes"), "rows_processed", "executed_by").orderBy("execution_start", "execution_id")


# ---- lineage ---------------------------------------------------------------------------------------
def lineage_flow(lineage: DataFrame, as_of, days: int = 7) -> DataFrame:
    keys = ["source_layer", "source_table", "target_layer", "target_table", "transformation_name", "load_type"]
    g = recent(lineage, "load_timestamp", as_of, days).groupBy(*keys).agg(
        F.count("*").alias("load_count"), F.max("load_timestamp").alias("last_load"),
        F.sum("source_record_count").alias("total_source_records"), F.sum("target_record_count").alias("total_target_records"))
    return g.withColumn("data_flow_pct", _rate("total_target_records", "total_source_records")).orderBy("source_layer", "source_table", "target_layer")


def lineage_gaps(loads: DataFrame, lineage: DataFrame, as_of, now, days: int = 1) -> DataFrame:
    """Successful loads with no later downstream load.

    A load has a successor exactly when the newest successor of its table is
    not before it, so the range join becomes an equality join on a per-table
    maximum.
    """
    newest = lineage.where((F.col("source_layer") == "BRONZE") & (F.col("target_layer") == "SILVER")).groupBy("source_table").agg(
        F.max("load_timestamp").alias("_last"))
    b = recent(loads, "load_timestamp", as_of, days).where(_is("SUCCESS", "load_status"))
    j = b.join(newest, F.col("table_name") == F.col("source_table"), "left")
    return j.where(F.col("_last").isNull() | (F.col("_last") < F.col("load_timestamp"))).select(
        F.col("table_name").alias("bronze_table"), F.col("load_timestamp").alias("bronze_load_time"), F.lit("Missing Silver lineage").alias("issue"),
        elapsed("HOUR", "load_timestamp", ts(now)).alias("hours_since_load"))


def reconcile(loads: DataFrame, lineage: DataFrame, as_of, days: int = 1) -> DataFrame:
    b = recent(loads, "load_timestamp", as_of, days).where(_is("SUCCESS", "load_status")).groupBy("table_name").agg(F.sum("records_loaded").alias("bronze_records"))
    s = recent(lineage, "load_timestamp", as_of, days).where((F.col("source_layer") == "BRONZE") & (F.col("target_layer") == "SILVER")).groupBy(
        "source_table", "target_table").agg(F.sum("target_record_count").alias("silver_records"))
    seen = F.coalesce("silver_records", F.lit(0))
    j = b.join(s, F.col("table_name") == F.col("source_table"), "left").withColumn("match_pct", F.round(percent(seen, "bronze_records"), 2))
    status = F.when(F.col("match_pct") >= 99, "✅ Good").when(F.col("match_pct") >= 95, "⚠️ Check").otherwise("❌ Issue")
    return j.select(F.col("table_name").alias("bronze_table"), F.col("target_table").alias("silver_table"), "bronze_records", "silver_records",
                    F.abs(F.col("bronze_records") - seen).alias("variance"), "match_pct", status.alias("status")).orderBy(F.desc("variance"), "bronze_table")


# ---- layers ----------------------------------------------------------------------------------------
def bronze_loads(loads: DataFrame, as_of, days: int = 7) -> DataFrame:
    return recent(loads, "load_timestamp", as_of, days).select(
        F.to_date("load_timestamp").alias("load_date"), "table_name", "load_type", "load_status", "records_extracted", "records_loaded", "records_rejected",
        F.round(percent("records_loaded", "records_extracted"), 2).alias("load_success_rate"), "execution_time_seconds").orderBy(F.desc("load_date"), "table_name")


def json_issues(validation: DataFrame, as_of, days: int = 7) -> DataFrame:
    return recent(validation, "validation_timestamp", as_of, days).groupBy("table_name", "json_path", "validation_error").agg(
        F.count("*").alias("error_count"), _n(_is("OPEN", "resolution_status"), "open_issues"),
        F.max("validation_timestamp").alias("last_occurrence")).orderBy(F.desc("error_count"), "json_path")


def silver_scores(audit: DataFrame, as_of, days: int = 7) -> DataFrame:
    g = recent(audit, "transformation_timestamp", as_of, days).where(_is("SUCCESS", "transformation_status")).groupBy("target_table", "transformation_type").agg(
        F.count("*").alias("transformation_count"), F.round(F.avg("data_quality_score"), 4).alias("avg_quality_score"), F.sum("records_rejected").alias("total_rejected"),
        F.round(ratio(F.sum("execution_time_seconds"), F.count("*")), 2).alias("avg_execution_time"), F.max("transformation_timestamp").alias("last_transformation"))
    return g.orderBy("avg_quality_score", F.desc("total_rejected"), "target_table")


def silver_issues(issues: DataFrame, as_of, days: int = 7) -> DataFrame:
    return recent(issues, "issue_timestamp", as_of, days).groupBy("table_name", "issue_type", "severity").agg(
        F.count("*").alias("issue_count"), _n(_is("OPEN", "resolution_status"), "open_issues"), _n(_is("RESOLVED", "resolution_status"), "resolved_issues"),
        F.max("issue_timestamp").alias("last_occurrence")).orderBy(F.desc("issue_count"), "issue_type")


def scd_trail(audit: DataFrame, as_of, days: int = 7) -> DataFrame:
    return recent(audit, "audit_timestamp", as_of, days).groupBy("dimension_table", "scd_type", "operation_type").agg(
        F.count("*").alias("change_count"), F.count_distinct("natural_key").alias("unique_entities_changed"),
        F.max("audit_timestamp").alias("last_change")).orderBy(F.desc("change_count"), "operation_type")


def fact_loads(audit: DataFrame, as_of, days: int = 7) -> DataFrame:
    return recent(audit, "load_timestamp", as_of, days).select(
        "fact_table", "load_date", "load_type", "load_status", "source_record_count", "target_record_count", "records_inserted", "records_updated",
        "orphaned_records", "execution_time_seconds").orderBy(F.desc("load_date"), "fact_table")


def ri_violations(ri: DataFrame, as_of, days: int = 7) -> DataFrame:
    return recent(ri, "check_timestamp", as_of, days).where(F.col("orphaned_record_count") > 0).select(
        "fact_table", "dimension_table", "foreign_key_column", "orphaned_record_count", "resolution_status", "check_timestamp", "resolution_action").orderBy(
        F.desc("orphaned_record_count"), F.desc("check_timestamp"))


# ---- summaries -------------------------------------------------------------------------------------
def exec_summary(checks: DataFrame, log: DataFrame, runs: DataFrame, log_as_of, log_now, runs_as_of) -> DataFrame:
    """Four figures as text."""
    nothing = F.lit(None).cast("bigint")
    score = recent(log, "execution_timestamp", log_as_of, 1).agg(_n(_is("PASS"), "p"), F.count("*").alias("n")).select(
        F.lit("📊 Overall Data Quality Score").alias("metric"), F.concat(F.format_number(F.round(percent("p", "n"), 1), 1), F.lit("%")).alias("value"),
        F.col("n").alias("checks_executed"))
    critical = recent_hours(log, "execution_timestamp", log_now, 24).where(_is("FAIL")).join(
        checks.where("severity = 'CRITICAL'").select("check_id"), "check_id", "left_semi").agg(F.count("*").alias("n")).select(
        F.lit("❌ Critical Failures (24h)").alias("metric"), F.col("n").cast("string").alias("value"), nothing.alias("checks_executed"))
    week = recent(runs, "execution_start", runs_as_of, 7).agg(
        F.count("*").alias("n"), _n(_runs("SUCCESS"), "s"), F.sum(F.when(_runs("SUCCESS"), F.col("rows_processed"))).alias("r"))
    rate = week.select(F.lit("✅ Pipeline Success Rate (7d)").alias("metric"), F.concat(F.format_number(F.round(percent("s", "n"), 1), 1), F.lit("%")).alias("value"),
                       F.col("n").alias("checks_executed"))
    rows = week.select(F.lit("📈 Total Records Processed (7d)").alias("metric"), F.format_number("r", 0).alias("value"), nothing.alias("checks_executed"))
    return score.unionByName(critical).unionByName(rate).unionByName(rows)


def moving_avg(log: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Daily pass rate and its mean over seven days; the window runs over one row per day."""
    d = recent(log, "execution_timestamp", as_of, days).groupBy(F.to_date("execution_timestamp").alias("check_date")).agg(
        F.count("*").alias("total_checks"), _n(_is("PASS"), "passed"))
    exact = F.col("passed").cast("double") / F.col("total_checks") * 100
    w = W.orderBy("check_date").rowsBetween(-6, 0)
    return d.select("check_date", "total_checks", "passed", _rate("passed", "total_checks").alias("pass_rate"),
                    F.round(F.avg(exact).over(w), 4).alias("moving_avg_7d")).orderBy(F.desc("check_date"))


def alert_summary(alerts: DataFrame, checks: DataFrame, now) -> DataFrame:
    return alerts.where(F.col("is_active") & (F.col("alert_count") > 0)).join(checks.select("check_id", "check_name", "severity"), "check_id").select(
        "check_name", "severity", "alert_type", "alert_count", "last_alert_sent",
        elapsed("HOUR", "last_alert_sent", ts(now)).alias("hours_since_last_alert")).orderBy(F.desc("last_alert_sent"), "check_name")


def profile_summary(profiles: DataFrame, as_of) -> DataFrame:
    return profiles.groupBy("schema_name", "table_name").agg(
        F.count_distinct("column_name").alias("columns_profiled"), F.round(F.avg("null_percentage"), 4).alias("avg_null_pct"),
        F.max("profile_timestamp").alias("last_profiled")).withColumn(
        "days_since_last_profile", F.datediff(day(as_of), F.to_date("last_profiled"))).orderBy(F.desc("days_since_last_profile"), "table_name")


def action_items(checks: DataFrame, log: DataFrame, runs: DataFrame, ri: DataFrame, log_now, runs_as_of, ri_as_of) -> DataFrame:
    def items(df: DataFrame, priority: str, kind: str, text: Column, at: str) -> DataFrame:
        return df.select(F.lit(priority).alias("priority"), F.lit(kind).alias("action_type"), text.alias("description"), F.col(at).alias("identified_at"))
    failed = recent_hours(log, "execution_timestamp", log_now, 24).where(_is("FAIL")).join(
        checks.where("severity = 'CRITICAL'").select("check_id", "check_name"), "check_id")
    broken = recent(runs, "execution_start", runs_as_of, 1).where(_runs("FAILED"))
    open_ri = recent(ri, "check_timestamp", ri_as_of, 1).where((F.col("orphaned_record_count") > 0) & _is("OPEN", "resolution_status"))
    return (items(failed, "Critical", "Failed Quality Check", F.col("check_name"), "execution_timestamp")
            .unionByName(items(broken, "High", "Pipeline Failure", F.col("pipeline_name"), "execution_start"))
            .unionByName(items(open_ri, "High", "Referential Integrity Violation", F.concat_ws(" → ", "fact_table", "dimension_table"), "check_timestamp"))
            .orderBy("priority", F.desc("identified_at")))


def maintenance(checks: DataFrame, log: DataFrame, profiles: DataFrame, log_as_of, profiles_as_of, keep_days: int = 90, profile_days: int = 30) -> DataFrame:
    def advice(df: DataFrame, what: str, details: Column, priority: str) -> DataFrame:
        return df.select(F.lit(what).alias("recommendation"), details.alias("details"), F.lit(priority).alias("priority"))
    old = log.where(F.col("execution_timestamp") < F.date_sub(day(log_as_of), keep_days).cast("timestamp_ntz")).agg(F.count("*").alias("n")).where("n > 0")
    stale = profile_summary(profiles, profiles_as_of).where(F.col("days_since_last_profile") > profile_days)
    off = checks.where(~F.col("is_active")).agg(F.count("*").alias("n")).where("n > 0")
    text = "string"
    return (advice(old, "Archive old audit logs", F.concat(F.lit("AUDIT.DATA_QUALITY_LOG has "), F.col("n").cast(text), F.lit(f" records older than {keep_days} days")), "Medium")
            .unionByName(advice(stale, "Profile tables", F.concat(F.col("schema_name"), F.lit("."), F.col("table_name"), F.lit(" last profiled "),
                                                                  F.col("days_since_last_profile").cast(text), F.lit(" days ago")), "Low"))
            .unionByName(advice(off, "Review inactive checks", F.concat(F.col("n").cast(text), F.lit(" quality checks are marked inactive")), "Low")))


# ---- ingestion, environments, run conditions, access -----------------------------------------------
def ingest_history(log: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Success and failure rows of the ingestion log per day."""
    ok, bad = _is("PIPELINE_SUCCESS", "table_name"), _is("PIPELINE_FAILURE", "table_name")
    g = recent(log, "error_timestamp", as_of, days).where(ok | bad).groupBy(F.to_date("error_timestamp").alias("run_date")).agg(
        F.count_distinct("error_timestamp").alias("total_runs"), _n(ok, "successful_runs"), _n(bad, "failed_runs"), F.count("*").alias("_n"))
    return g.withColumn("success_rate", _rate("successful_runs", "_n")).drop("_n").orderBy(F.desc("run_date"))


def ingest_ratio(log: DataFrame, as_of, days: int = 7) -> DataFrame:
    status = F.when(_is("PIPELINE_SUCCESS", "table_name"), "Success").when(_is("PIPELINE_FAILURE", "table_name"), "Failure").otherwise("Other")
    return recent(log, "error_timestamp", as_of, days).groupBy(status.alias("status")).agg(
        F.count("*").alias("count"), F.min("error_timestamp").alias("first_occurrence"), F.max("error_timestamp").alias("last_occurrence")).orderBy("status")


def env_comparison(runs: DataFrame, now, days: int = 7) -> DataFrame:
    seconds = elapsed("SECOND", "execution_start", "execution_end")
    return recent_hours(runs, "execution_start", now, days * 24).groupBy("environment").agg(
        F.count_distinct("pipeline_name").alias("total_pipelines"), F.count("*").alias("total_executions"),
        _n(_runs("SUCCESS"), "successful_runs"), _n(_runs("FAILED"), "failed_runs"),
        F.round(ratio(F.sum(seconds), F.count(seconds)), 2).alias("avg_duration_seconds"), F.max("execution_start").alias("last_execution")).orderBy("environment")


def run_conditions(runs: DataFrame, as_of, variance_pct: int = 20, minutes: int = 30, days: int = 7) -> DataFrame:
    """Alerts per pipeline and day: failures, runs over the limit, rows off by more than the limit against the day before.

    The log is reduced to one row per pipeline and day; the day before is met
    by equality, so no ordered window over a pipeline is needed.
    """
    long = elapsed("SECOND", "execution_start", "execution_end") > minutes * 60
    d = recent(runs, "execution_start", as_of, days + 1).groupBy("pipeline_name", F.to_date("execution_start").alias("run_date")).agg(
        F.count("*").alias("runs"), _n(_runs("FAILED"), "failures"), _n(long, "long_runs"), F.sum("rows_processed").alias("row_total"))
    before = d.select("pipeline_name", F.date_add("run_date", 1).alias("run_date"), F.col("row_total").alias("rows_before"))
    j = d.join(before, ["pipeline_name", "run_date"], "left").where(F.col("run_date") >= F.date_sub(day(as_of), days))
    change = F.round(percent(F.col("row_total") - F.col("rows_before"), "rows_before"), 2)
    return j.withColumn("row_variance_pct", change).withColumns({
        "failure_alert": F.col("failures") > 0, "duration_alert": F.col("long_runs") > 0,
        "variance_alert": F.coalesce(F.abs("row_variance_pct") > variance_pct, F.lit(False))}).drop("rows_before")


def load_conditions(loads: DataFrame, as_of, now, seconds: int = 30, stale_hours: int = 48, error_pct: int = 5, days: int = 7) -> DataFrame:
    """Alerts per table: slow loads, old data, rejected rows."""
    g = recent(loads, "load_timestamp", as_of, days).groupBy("table_name").agg(
        F.max("execution_time_seconds").alias("max_seconds"), F.max("load_timestamp").alias("last_load"),
        F.sum("records_extracted").alias("_e"), F.sum("records_rejected").alias("_r"))
    return g.select("table_name", "max_seconds", "last_load", F.round(percent("_r", "_e"), 2).alias("error_pct")).withColumns({
        "slow_alert": F.col("max_seconds") > seconds, "stale_alert": elapsed("HOUR", "last_load", ts(now)) > stale_hours,
        "error_alert": F.col("error_pct") > error_pct})


def user_access(access: DataFrame, now, days: int = 30) -> DataFrame:
    return recent_hours(access, "event_timestamp", now, days * 24).groupBy("user_name", "role_name").agg(
        F.count("*").alias("query_count"), F.count_distinct(F.to_date("event_timestamp")).alias("active_days"),
        F.max("event_timestamp").alias("last_access"), F.count_if(~F.col("success")).alias("failed_attempts"))


def policy_violations(access: DataFrame) -> DataFrame:
    return access.where(_is("POLICY_VIOLATION", "event_type")).select(
        "event_timestamp", "user_name", "role_name", "object_name", "action", "error_message", "query_id").orderBy(F.desc("event_timestamp"), "query_id")


# ---- writing the logs ------------------------------------------------------------------------------
LINEAGE_COLUMNS = ["source_layer", "source_table", "target_layer", "target_table", "transformation_name", "load_timestamp",
                   "source_record_count", "target_record_count", "load_type"]


def lineage_row(source: DataFrame, target: DataFrame, names: Mapping[str, str], load_type: str, at) -> DataFrame:
    """One lineage row with the counts of both sides, computed where the data is."""
    n = target.agg(F.count("*")).scalar()
    return source.agg(F.count("*").alias("source_record_count")).select(
        *[F.lit(names[c]).alias(c) for c in ("source_layer", "source_table", "target_layer", "target_table", "transformation_name")],
        ts(at).alias("load_timestamp"), "source_record_count", n.alias("target_record_count"), F.lit(load_type).alias("load_type"))
