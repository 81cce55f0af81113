"""The quality engine, alerts, profiling, plan shapes and a part of the contract."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tests import check
from tidemark.operators import quality as q
from tidemark.plans import analytics as an, star as plans
from tidemark.plans.checks import CHECKS

SMALL = "/root/testdata/sf0.001"


def engine(spark):
    t = q.Tables({"t": lambda: spark.createDataFrame([(1, 5), (2, -1), (None, 3)], "k int, v int")})
    checks = [
        q.Check("N1", "nulls", "SILVER", "COMPLETENESS", "CRITICAL", "t", violates=lambda t: F.col("k").isNull()),
        q.Check("N2", "rows", "SILVER", "COMPLETENESS", "HIGH", "t", measure=lambda t: F.count("*"), expected=3, compare="ge"),
        q.Check("N3", "broken", "SILVER", "VALIDITY", "LOW", "t", violates=lambda t: F.col("missing") > 1),
        q.Check("N4", "off", "SILVER", "VALIDITY", "LOW", "t", violates=lambda t: F.lit(True), is_active=False)]
    return t, checks


def test_one_broken_check_does_not_hide_the_others(spark):
    t, checks = engine(spark)
    log = q.run_layer_checks(spark, t, checks, "SILVER", "r1", "2024-01-01 00:00:00")
    got = {r.check_id: (r.check_status, r.actual_value, r.variance) for r in log.collect()}
    assert got == {"N1": ("FAIL", 1.0, 1.0), "N2": ("PASS", 3.0, 0.0), "N3": ("ERROR", None, None)}
    registry = q.check_registry(spark, checks)
    summary = q.layer_summary(log, registry).first()
    assert (summary.executed, summary.passed, summary.failed, summary.errors) == (3, 1, 1, 1)
    with pytest.raises(q.CriticalCheckFailed, match="N1"):
        q.critical_gate(log, registry, "r1")
    q.critical_gate(log, registry, "another run")


def test_fused_checks_scan_a_table_once(spark):
    t, checks = engine(spark)
    plan = q.evaluate(t, checks[:2])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_registry_holds_fifty_checks():
    assert len(CHECKS) == 50 and len({c.check_id for c in CHECKS}) == 50
    assert {c.dimension for c in CHECKS} == {"COMPLETENESS", "ACCURACY", "CONSISTENCY", "TIMELINESS", "VALIDITY", "UNIQUENESS"}


def test_alert_run_length(spark):
    log = spark.createDataFrame(
        [(c, i, s) for c, marks in {"a": "FFPFFF", "b": "FFP", "c": "PF", "d": "F"}.items() for i, s in enumerate(marks)], "check_id string, i int, s string").select(
        "check_id", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, i)").alias("execution_timestamp"),
        F.when(F.col("s") == "F", "FAIL").otherwise("PASS").alias("check_status"), F.lit(False).alias("alert_sent"))
    registry = spark.createDataFrame([("a", "A", "HIGH"), ("b", "B", "CRITICAL"), ("c", "C", "HIGH"), ("d", "D", "LOW")], "check_id string, check_name string, severity string")
    got = {r.check_id: (r.consecutive_failures, r.decision) for r in q.alert_decisions(log, registry).collect()}
    assert got == {"a": (3, "ALERT_NOW"), "c": (1, "WAIT"), "d": (1, "DAILY_SUMMARY")}
    marked = q.mark_alerted(log, registry.where("check_id = 'a'"), "2024-01-01 05:00:00")
    assert sorted((r.check_id, r.execution_timestamp.hour) for r in marked.where("alert_sent").collect()) == [("a", 4), ("a", 5)]


def test_profile(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 3.0), ("y", None), (None, 5.0)], "s string, n double")
    for approximate in (False, True):
        got = {r.column_name: r for r in q.profile_columns(df, "T", approximate=approximate).collect()}
        assert (got["s"].distinct_count, got["s"].null_count, got["s"].null_percentage, got["s"].top_5_values) == (2, 1, 25.0, '["x","y"]')
        assert (got["n"].avg_value, got["n"].median_value, got["n"].std_dev, got["n"].min_value) == (3.0, 3.0, 2.0, "1.0")


def test_schema_check(spark):
    have = spark.sql("SELECT 1 AS id, 'a' AS name").schema
    want = spark.sql("SELECT 1 AS ID, 1 AS name, 1 AS more").schema
    assert q.schema_check(have, want) == [("name", "string instead of int"), ("more", "missing")]


# ---- plan shapes -----------------------------------------------------------------------------------
def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_windows_prune_months_and_push_filters(spark):
    star = plans.gold(spark, SMALL)
    plan = plan_of(an.daily_sales(star, "2001-08-01"))
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "revenue" in line)
    assert "month_key" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(order_date" in scan.split("PushedFilters: [")[1]


@pytest.mark.parametrize("build", [
    lambda s: an.top_campaigns_roas(s, "2024-01-31"), an.category_analysis, an.tier_patterns, lambda s: an.channel_mix(s, "2024-01-31"),
    lambda s: an.rfm(s, "2001-08-01"), an.monthly_yoy_by_month, lambda s: s.fact_sales])
def test_no_cross_products(spark, build):
    plan = plan_of(build(plans.gold(spark, SMALL)))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_dedupe_limits_before_the_exchange(spark):
    plan = plan_of(plans.silver_table(spark, SMALL, "sales"))
    after, before = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in after and "WindowGroupLimit" in before


def test_reports_read_only_their_columns(spark):
    plan = plan_of(an.channel_comparison(plans.gold(spark, SMALL)))
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "impressions" in line)
    assert "performance_id" not in scan and "conversion_rate" not in scan


# ---- contract --------------------------------------------------------------------------------------
KEYS = ["silver_customers", "fact_sales", "fact_campaign_daily", "detect_changes", "scd2_incremental", "scd3", "dimension_audit", "q_category_analysis",
        "q_top_campaigns_roas", "q_monthly_yoy", "q_campaign_pacing", "val_business_rules", "run_layer_checks", "aud_check_status", "aud_reconcile", "alert_decisions",
        "flatten_json", "incremental_stream_load", "row_policy", "profile_columns"]


@pytest.fixture(scope="module")
def con():
    return check.duck(SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_contract(spark, con, key):
    problem, n = check.compare(spark, con, SMALL, key, contract.queries()[key], contract.oracle_sql()[key])
    assert problem is None and n > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_check_sql():
    queries, oracle = contract.load_all()
    assert set(queries) == set(oracle)
