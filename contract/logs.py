"""Audit logs derived from the given tables, as Spark frames and as SQL building blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import scd
from tidemark.sources.entities import table

from . import quality, states
from .ctes import CTES

CTES["a_checks"] = """
SELECT 'C' || lpad(CAST(i AS VARCHAR), 2, '0') AS check_id, 'Check ' || i AS check_name, 'Rule number ' || i AS check_description,
  ['BRONZE', 'SILVER', 'GOLD'][i % 3 + 1] AS layer,
  ['COMPLETENESS', 'ACCURACY', 'CONSISTENCY', 'TIMELINESS', 'VALIDITY', 'UNIQUENESS'][i % 6 + 1] AS dimension,
  ['CRITICAL', 'HIGH', 'MEDIUM', 'LOW'][i % 4 + 1] AS severity, i % 10 <> 9 AS is_active
FROM (SELECT CAST(range AS INT) AS i FROM range(50))"""


def checks(spark, sf) -> DataFrame:
    return spark.range(50).selectExpr("cast(id as int) AS i").selectExpr(
        "concat('C', lpad(i, 2, '0')) AS check_id", "concat('Check ', i) AS check_name", "concat('Rule number ', i) AS check_description",
        "element_at(array('BRONZE', 'SILVER', 'GOLD'), i % 3 + 1) AS layer",
        "element_at(array('COMPLETENESS', 'ACCURACY', 'CONSISTENCY', 'TIMELINESS', 'VALIDITY', 'UNIQUENESS'), i % 6 + 1) AS dimension",
        "element_at(array('CRITICAL', 'HIGH', 'MEDIUM', 'LOW'), i % 4 + 1) AS severity", "i % 10 <> 9 AS is_active")


CTES["a_log"] = """
SELECT event_id AS log_id, 'C' || lpad(CAST(user_id % 50 AS VARCHAR), 2, '0') AS check_id, ts AS execution_timestamp,
  ['DEV', 'TEST', 'PROD'][CAST(user_id % 3 AS INT) + 1] AS environment,
  CASE event_type WHEN 'signup' THEN 'FAIL' WHEN 'error' THEN 'ERROR' ELSE 'PASS' END AS check_status,
  value AS actual_value, CAST(0 AS DOUBLE) AS expected_value, CAST(value AS DECIMAL(18,2)) AS execution_time_seconds,
  CASE WHEN event_type = 'error' THEN 'check failed to run: ' || props END AS error_message, FALSE AS alert_sent FROM events"""


def log(spark, sf) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "event_id AS log_id", "concat('C', lpad(user_id % 50, 2, '0')) AS check_id", "ts AS execution_timestamp",
        "element_at(array('DEV', 'TEST', 'PROD'), cast(user_id % 3 AS int) + 1) AS environment",
        "CASE event_type WHEN 'signup' THEN 'FAIL' WHEN 'error' THEN 'ERROR' ELSE 'PASS' END AS check_status",
        "value AS actual_value", "cast(0 AS double) AS expected_value", "cast(value AS decimal(18,2)) AS execution_time_seconds",
        "CASE WHEN event_type = 'error' THEN concat('check failed to run: ', props) END AS error_message", "false AS alert_sent")


CTES["a_runs"] = """
SELECT o_orderkey AS execution_id, 'P' || (o_custkey % 20) AS pipeline_name, ['BRONZE', 'SILVER', 'GOLD'][CAST(o_custkey % 3 AS INT) + 1] AS layer,
  ['DEV', 'TEST', 'PROD'][CAST(o_orderkey % 3 AS INT) + 1] AS environment, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT)) AS execution_start,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT)) + to_minutes(CAST(o_orderkey % 90 AS INT)) + to_seconds(CAST(o_orderkey % 60 AS INT)) END AS execution_end,
  CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS execution_status,
  CAST(floor(o_totalprice) AS BIGINT) AS rows_processed, CASE WHEN o_orderstatus = 'P' THEN 'stopped at priority ' || o_orderpriority END AS error_message,
  'svc' || (o_custkey % 4) AS executed_by FROM orders"""


def runs(spark, sf) -> DataFrame:
    start = "o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 AS int))"
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS execution_id", "concat('P', o_custkey % 20) AS pipeline_name",
        "element_at(array('BRONZE', 'SILVER', 'GOLD'), cast(o_custkey % 3 AS int) + 1) AS layer",
        "element_at(array('DEV', 'TEST', 'PROD'), cast(o_orderkey % 3 AS int) + 1) AS environment", f"{start} AS execution_start",
        f"CASE WHEN o_orderstatus <> 'O' THEN {start} + make_dt_interval(0, 0, cast(o_orderkey % 90 AS int), cast(o_orderkey % 60 AS int)) END AS execution_end",
        "CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS execution_status",
        "cast(floor(o_totalprice) AS bigint) AS rows_processed",
        "CASE WHEN o_orderstatus = 'P' THEN concat('stopped at priority ', o_orderpriority) END AS error_message", "concat('svc', o_custkey % 4) AS executed_by")


CTES["a_lineage"] = """
SELECT 'BRONZE' AS source_layer, 'BRONZE_T' || (l_suppkey % 6) AS source_table, 'SILVER' AS target_layer, 'SILVER_T' || (l_suppkey % 6) AS target_table,
  'cleanse_' || (l_suppkey % 6) AS transformation_name, CASE WHEN l_suppkey % 2 = 0 THEN 'INCREMENTAL' ELSE 'FULL' END AS load_type,
  l_shipdate + to_hours(CAST(l_suppkey % 24 AS INT)) AS load_timestamp, CAST(sum(l_quantity) AS BIGINT) AS source_record_count,
  CAST(coalesce(sum(l_quantity) FILTER (l_returnflag <> 'R'), 0) AS BIGINT) AS target_record_count FROM lineitem GROUP BY l_suppkey, l_shipdate"""


def lineage(spark, sf) -> DataFrame:
    g = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_shipdate").agg(
        F.sum("l_quantity").cast("bigint").alias("source_record_count"),
        F.coalesce(F.sum(F.when(F.col("l_returnflag") != "R", F.col("l_quantity"))), F.lit(0)).cast("bigint").alias("target_record_count"))
    return g.selectExpr(
        "'BRONZE' AS source_layer", "concat('BRONZE_T', l_suppkey % 6) AS source_table", "'SILVER' AS target_layer", "concat('SILVER_T', l_suppkey % 6) AS target_table",
        "concat('cleanse_', l_suppkey % 6) AS transformation_name", "CASE WHEN l_suppkey % 2 = 0 THEN 'INCREMENTAL' ELSE 'FULL' END AS load_type",
        "l_shipdate + make_dt_interval(0, cast(l_suppkey % 24 AS int)) AS load_timestamp", "source_record_count", "target_record_count")


CTES["a_loads"] = """
SELECT 'BRONZE_T' || (l_suppkey % 7) AS table_name, l_shipdate + to_hours(CAST(l_suppkey % 20 AS INT)) AS load_timestamp,
  CASE WHEN l_suppkey % 2 = 0 THEN 'INCREMENTAL' ELSE 'FULL' END AS load_type,
  CASE l_suppkey % 5 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'PARTIAL' ELSE 'SUCCESS' END AS load_status, CAST(sum(l_quantity) AS BIGINT) AS records_extracted,
  CAST(coalesce(sum(l_quantity) FILTER (l_returnflag <> 'R'), 0) AS BIGINT) AS records_loaded,
  CAST(coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'), 0) AS BIGINT) AS records_rejected, count(*) * 0.5 AS execution_time_seconds
FROM lineitem GROUP BY l_suppkey, l_shipdate"""


def loads(spark, sf) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    g = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_shipdate").agg(
        F.sum("l_quantity").cast("bigint").alias("records_extracted"),
        F.coalesce(F.sum(F.when(~returned, F.col("l_quantity"))), F.lit(0)).cast("bigint").alias("records_loaded"),
        F.coalesce(F.sum(F.when(returned, F.col("l_quantity"))), F.lit(0)).cast("bigint").alias("records_rejected"),
        (F.count(F.lit(1)) * F.lit("0.5").cast("decimal(2,1)")).alias("execution_time_seconds"))
    return g.selectExpr(
        "concat('BRONZE_T', l_suppkey % 7) AS table_name", "l_shipdate + make_dt_interval(0, cast(l_suppkey % 20 AS int)) AS load_timestamp",
        "CASE WHEN l_suppkey % 2 = 0 THEN 'INCREMENTAL' ELSE 'FULL' END AS load_type",
        "CASE l_suppkey % 5 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'PARTIAL' ELSE 'SUCCESS' END AS load_status",
        "records_extracted", "records_loaded", "records_rejected", "execution_time_seconds")


CTES["a_silver"] = """
SELECT 'SILVER_T' || (l_partkey % 6) AS target_table, ['FLATTEN', 'CLEANSE', 'ENRICH'][CAST(l_partkey % 6 % 3 AS INT) + 1] AS transformation_type,
  CASE WHEN l_partkey % 6 = 5 THEN 'FAILED' ELSE 'SUCCESS' END AS transformation_status, l_shipdate AS transformation_timestamp,
  CAST(100 - count(*) % 10 AS DOUBLE) AS data_quality_score, count(*) FILTER (l_returnflag = 'R') AS records_rejected, count(*) * 0.25 AS execution_time_seconds
FROM lineitem GROUP BY l_partkey % 6, l_shipdate"""


def silver(spark, sf) -> DataFrame:
    g = table(spark, sf, "lineitem").groupBy((F.col("l_partkey") % 6).cast("int").alias("k"), "l_shipdate").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("records_rejected"))
    return g.selectExpr(
        "concat('SILVER_T', k) AS target_table", "element_at(array('FLATTEN', 'CLEANSE', 'ENRICH'), k % 3 + 1) AS transformation_type",
        "CASE WHEN k = 5 THEN 'FAILED' ELSE 'SUCCESS' END AS transformation_status", "l_shipdate AS transformation_timestamp",
        "cast(100 - n % 10 AS double) AS data_quality_score", "records_rejected", "n * 0.25 AS execution_time_seconds")


CTES["a_facts"] = """
SELECT 'FACT_SALES' AS fact_table, o_orderdate + INTERVAL 2 HOUR AS load_timestamp, CAST(o_orderdate AS DATE) AS load_date, 'INCREMENTAL' AS load_type,
  CASE WHEN count(*) FILTER (o_orderstatus = 'P') > 3 THEN 'PARTIAL' ELSE 'SUCCESS' END AS load_status, count(*) AS source_record_count,
  count(*) FILTER (o_orderstatus <> 'P') AS target_record_count, count(*) FILTER (o_orderstatus = 'F') AS records_inserted,
  count(*) FILTER (o_orderstatus = 'O') AS records_updated, count(*) FILTER (o_orderstatus = 'P') AS orphaned_records, count(*) * 0.1 AS execution_time_seconds
FROM orders GROUP BY o_orderdate"""


def facts(spark, sf) -> DataFrame:
    s = F.col("o_orderstatus")
    g = table(spark, sf, "orders").groupBy("o_orderdate").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(s == "P").alias("p"), F.count_if(s == "F").alias("f"), F.count_if(s == "O").alias("o"))
    return g.selectExpr(
        "'FACT_SALES' AS fact_table", "o_orderdate + make_dt_interval(0, 2) AS load_timestamp", "cast(o_orderdate AS date) AS load_date", "'INCREMENTAL' AS load_type",
        "CASE WHEN p > 3 THEN 'PARTIAL' ELSE 'SUCCESS' END AS load_status", "n AS source_record_count", "n - p AS target_record_count", "f AS records_inserted",
        "o AS records_updated", "p AS orphaned_records", "n * 0.1 AS execution_time_seconds")


CTES["a_ri"] = """
SELECT 'FACT_SALES' AS fact_table, 'DIM_CAMPAIGN' AS dimension_table, 'campaign_key' AS foreign_key_column, l_shipdate + INTERVAL 3 HOUR AS check_timestamp,
  count(*) FILTER (l_linenumber = 7) AS orphaned_record_count, CASE WHEN day(l_shipdate) % 2 = 0 THEN 'OPEN' ELSE 'RESOLVED' END AS resolution_status,
  CASE WHEN day(l_shipdate) % 2 <> 0 THEN 'Reloaded' END AS resolution_action FROM lineitem GROUP BY l_shipdate"""


def ri(spark, sf) -> DataFrame:
    g = table(spark, sf, "lineitem").groupBy("l_shipdate").agg(F.count_if(F.col("l_linenumber") == 7).alias("orphaned_record_count"))
    return g.selectExpr(
        "'FACT_SALES' AS fact_table", "'DIM_CAMPAIGN' AS dimension_table", "'campaign_key' AS foreign_key_column",
        "l_shipdate + make_dt_interval(0, 3) AS check_timestamp", "orphaned_record_count",
        "CASE WHEN day(l_shipdate) % 2 = 0 THEN 'OPEN' ELSE 'RESOLVED' END AS resolution_status", "CASE WHEN day(l_shipdate) % 2 <> 0 THEN 'Reloaded' END AS resolution_action")


CTES["a_alerts"] = """
SELECT check_id, CASE WHEN max(environment) = 'TEST' THEN 'SLACK' ELSE 'EMAIL' END AS alert_type, count(*) AS alert_count,
  max(execution_timestamp) AS last_alert_sent, check_id NOT LIKE '%7' AS is_active FROM a_log WHERE check_status = 'FAIL' GROUP BY check_id"""


def alerts(spark, sf) -> DataFrame:
    return log(spark, sf).where("check_status = 'FAIL'").groupBy("check_id").agg(
        F.when(F.max("environment") == "TEST", "SLACK").otherwise("EMAIL").alias("alert_type"), F.count(F.lit(1)).alias("alert_count"),
        F.max("execution_timestamp").alias("last_alert_sent")).withColumn("is_active", ~F.col("check_id").like("%7"))


CTES["a_profiles"] = f"""
SELECT 'SILVER' AS schema_name, table_name, column_name, null_percentage,
  CASE table_name WHEN 'CUSTOMERS' THEN TIMESTAMP '2023-12-15 06:00:00' ELSE TIMESTAMP '2024-01-30 06:00:00' END AS profile_timestamp FROM ({quality.PROFILE_SQL})"""


def profiles(spark, sf) -> DataFrame:
    return quality.profiles(spark, sf).selectExpr(
        "'SILVER' AS schema_name", "table_name", "column_name", "null_percentage",
        "CASE table_name WHEN 'CUSTOMERS' THEN timestamp_ntz'2023-12-15 06:00:00' ELSE timestamp_ntz'2024-01-30 06:00:00' END AS profile_timestamp")


CTES["a_json"] = """
SELECT 'EVENTS' AS table_name, CASE WHEN event_type = 'error' THEN '$' ELSE '$.k' END AS json_path,
  CASE WHEN event_type = 'error' THEN 'malformed JSON' ELSE 'required path missing' END AS validation_error, ts AS validation_timestamp,
  CASE WHEN user_id % 2 = 0 THEN 'OPEN' ELSE 'RESOLVED' END AS resolution_status FROM events WHERE event_type IN ('error', 'signup')"""


def json_validation(spark, sf) -> DataFrame:
    return table(spark, sf, "events").where("event_type IN ('error', 'signup')").selectExpr(
        "'EVENTS' AS table_name", "CASE WHEN event_type = 'error' THEN '$' ELSE '$.k' END AS json_path",
        "CASE WHEN event_type = 'error' THEN 'malformed JSON' ELSE 'required path missing' END AS validation_error", "ts AS validation_timestamp",
        "CASE WHEN user_id % 2 = 0 THEN 'OPEN' ELSE 'RESOLVED' END AS resolution_status")


CTES["a_issues"] = f"""
SELECT * REPLACE (CASE WHEN severity = 'MEDIUM' THEN 'RESOLVED' ELSE 'OPEN' END AS resolution_status) FROM ({quality.ISSUES_SQL})"""


def issues(spark, sf) -> DataFrame:
    return quality.issues(spark, sf).withColumn("resolution_status", F.when(F.col("severity") == "MEDIUM", "RESOLVED").otherwise("OPEN"))


def dimension_changes(spark, sf) -> DataFrame:
    audit = scd.dimension_audit(states.customer_history(spark, sf), "customer_id", "customer_key", ["tier", "segment", "status", "lifetime_value"], "DIM_CUSTOMER")
    return audit.withColumn("audit_timestamp", F.when(F.col("operation_type") == "EXPIRE", F.col("valid_to")).otherwise(F.col("valid_from")))


CTES["a_access"] = """
SELECT ts AS event_timestamp, 'user' || user_id AS user_name, ['ANALYST', 'ENGINEER', 'BUSINESS_USER', 'AUDITOR'][CAST(user_id % 4 AS INT) + 1] AS role_name,
  CASE event_type WHEN 'error' THEN 'POLICY_VIOLATION' WHEN 'signup' THEN 'LOGIN' ELSE 'QUERY' END AS event_type, 'OBJECT_' || (user_id % 9) AS object_name,
  upper(event_type) AS action, event_type <> 'error' AS success, CASE WHEN event_type = 'error' THEN 'denied' END AS error_message, 'q' || event_id AS query_id FROM events"""


def access(spark, sf) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "ts AS event_timestamp", "concat('user', user_id) AS user_name",
        "element_at(array('ANALYST', 'ENGINEER', 'BUSINESS_USER', 'AUDITOR'), cast(user_id % 4 AS int) + 1) AS role_name",
        "CASE event_type WHEN 'error' THEN 'POLICY_VIOLATION' WHEN 'signup' THEN 'LOGIN' ELSE 'QUERY' END AS event_type",
        "concat('OBJECT_', user_id % 9) AS object_name", "upper(event_type) AS action", "event_type <> 'error' AS success",
        "CASE WHEN event_type = 'error' THEN 'denied' END AS error_message", "concat('q', event_id) AS query_id")


CTES["a_ingest"] = """
SELECT 'P' || (o_custkey % 20) AS pipeline_name, CASE o_orderstatus WHEN 'F' THEN 'PIPELINE_SUCCESS' WHEN 'P' THEN 'PIPELINE_FAILURE' ELSE 'orders' END AS table_name,
  o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT)) AS error_timestamp FROM orders"""


def ingest(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "concat('P', o_custkey % 20) AS pipeline_name",
        "CASE o_orderstatus WHEN 'F' THEN 'PIPELINE_SUCCESS' WHEN 'P' THEN 'PIPELINE_FAILURE' ELSE 'orders' END AS table_name",
        "o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 AS int)) AS error_timestamp")


CTES["a_catalog"] = """
SELECT 'BRONZE' AS table_schema, table_name, CAST(sum(records_loaded) AS BIGINT) AS row_count, CAST(sum(records_loaded) * 100 AS BIGINT) AS bytes FROM a_loads GROUP BY table_name
UNION ALL SELECT 'SILVER', target_table, CAST(sum(target_record_count) AS BIGINT), CAST(sum(target_record_count) * 120 AS BIGINT) FROM a_lineage GROUP BY target_table
UNION ALL SELECT 'AUDIT', 'DATA_QUALITY_LOG', count(*), count(*) * 200 FROM a_log
UNION ALL SELECT 'AUDIT', 'DATA_LINEAGE', count(*), count(*) * 150 FROM a_lineage
UNION ALL SELECT 'BRONZE', 'BRONZE_LOAD_AUDIT', count(*), count(*) * 150 FROM a_loads
UNION ALL SELECT 'GOLD', 'GOLD_VALIDATION', count(*) FILTER (orphaned_record_count < 0), 0 FROM a_ri"""


def catalog(spark, sf) -> DataFrame:
    def sized(df, schema, name, n, width):
        return df.agg(n.cast("bigint").alias("row_count")).select(F.lit(schema).alias("table_schema"), F.lit(name).alias("table_name"), "row_count",
                                                                  (F.col("row_count") * width).alias("bytes"))
    n = F.count(F.lit(1))
    bronze = loads(spark, sf).groupBy("table_name").agg(F.sum("records_loaded").alias("row_count")).select(
        F.lit("BRONZE").alias("table_schema"), "table_name", "row_count", (F.col("row_count") * 100).alias("bytes"))
    silver_t = lineage(spark, sf).groupBy(F.col("target_table").alias("table_name")).agg(F.sum("target_record_count").alias("row_count")).select(
        F.lit("SILVER").alias("table_schema"), "table_name", "row_count", (F.col("row_count") * 120).alias("bytes"))
    return (bronze.unionByName(silver_t).unionByName(sized(log(spark, sf), "AUDIT", "DATA_QUALITY_LOG", n, 200))
            .unionByName(sized(lineage(spark, sf), "AUDIT", "DATA_LINEAGE", n, 150)).unionByName(sized(loads(spark, sf), "BRONZE", "BRONZE_LOAD_AUDIT", n, 150))
            .unionByName(sized(ri(spark, sf), "GOLD", "GOLD_VALIDATION", F.count_if(F.col("orphaned_record_count") < 0), 0)))
