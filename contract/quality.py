"""The quality engine and its fifty checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import quality as q, sketches
from tidemark.operators.aggregates import exact_cuts
from tidemark.operators.check_states import CheckStates, Partitioned
from tidemark.plans import views
from tidemark.plans.checks import BY_ID, CHECKS
from tidemark.plans.star import gold, silver_table
from tidemark.sources import entities
from tidemark.sources.versions import VersionedTable

from . import states
from .ctes import div, pct, rnd
from .loads import _RAW, raw_events
from .registry import query

NOW = "2024-02-03 12:00:00"


def tables(spark, sf) -> q.Tables:
    """Every table the checks read, built on first use."""
    star = gold(spark, sf)
    plans = {f"bronze_{n}": (lambda n=n: entities.BRONZE[n](spark, sf)) for n in entities.BRONZE}
    plans |= {f"silver_{n}": (lambda n=n: silver_table(spark, sf, n)) for n in entities.BRONZE}
    plans |= {n: (lambda n=n: getattr(star, n)) for n in (
        "dim_date", "dim_campaign", "dim_customer", "dim_product", "dim_channel", "fact_performance", "fact_sales", "fact_campaign_daily")}
    plans |= {
        "bronze_campaigns_json": lambda: entities.campaigns(spark, sf).select(F.to_json(F.struct("*")).alias("raw_data")),
        "bronze_events_json": lambda: raw_events(spark, sf),
        "customer_geography": lambda: entities.table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("nation_key")),
        "geography": lambda: entities.table(spark, sf, "nation").select(F.col("n_nationkey").alias("nation_key")),
        "dim_customer_history": lambda: states.customer_history(spark, sf)}

    def all_views():
        return [star.v_campaign("2024-01-31"), star.v_customer, star.v_product, star.v_channel, star.v_calendar,
                views.sales(star.fact_sales), views.performance(star.fact_performance)]

    return q.Tables(plans, now=NOW, first_day="2020-01-01", last_day="2030-12-31", views=all_views)


_TS, _DAY = f"TIMESTAMP '{NOW}'", f"DATE '{NOW[:10]}'"


def cnt(table: str, where: str = "TRUE") -> str:
    return f"(SELECT count(*) FROM {table} WHERE {where})"


def rep(table: str, keys: str, where: str = "TRUE") -> str:
    return f"(SELECT count(*) FROM (SELECT 1 FROM {table} WHERE {where} GROUP BY {keys} HAVING count(*) > 1))"


def orphan(child: str, parent: str, column: str) -> str:
    return f"(SELECT count(*) FROM {child} c WHERE c.{column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{column} = c.{column}))"


def gaps(table: str, column: str) -> str:
    return f"(SELECT date_diff('day', min({column}), max({column})) + 1 - count(DISTINCT {column}) FROM {table})"


def months(table: str, day: str, value: str) -> str:
    return (f"(SELECT count(*) FROM (SELECT date_trunc('month', {day}) AS m, sum(v) AS a FROM (SELECT {day}, sum({value}) AS v FROM {table} GROUP BY 1) GROUP BY 1) x "
            f"FULL JOIN (SELECT date_trunc('month', {day}) AS m, sum({value}) AS b FROM {table} GROUP BY 1) y ON x.m = y.m WHERE a IS DISTINCT FROM b)")


_BRONZE = ["campaigns", "channels", "customers", "products", "performance", "sales"]
_newest = " UNION ALL ".join(f"SELECT '{n}' AS n, max(load_timestamp) AS t FROM b_{n}" for n in _BRONZE)
_tracked_same = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in (
    "customer_name", "email", "phone", "segment", "tier", "status", "lifetime_value"))

ACTUAL = {
    "B1": cnt("b_campaigns", f"CAST(load_timestamp AS DATE) = {_DAY}"),
    "B2": cnt("b_campaigns", "campaign_id IS NULL OR campaign_name IS NULL"),
    "B3": f"(SELECT count(*) FROM ({_newest}) WHERE n IN ('campaigns', 'customers', 'performance') AND date_sub('hour', t, {_TS}) > 24)",
    "B4": rep("b_sales", "ALL").replace("SELECT 1 FROM b_sales", "SELECT *, count(*) AS n FROM b_sales"),
    "B5": cnt("b_performance", "load_timestamp IS NULL"),
    "B6": cnt("b_campaigns", "start_date IS NULL OR end_date IS NULL"),
    "B7": cnt("b_campaigns", "budget IS NULL"),
    "B8": f"(SELECT count(*) FROM (SELECT {_RAW} AS raw_data FROM events) WHERE raw_data IS NOT NULL AND NOT json_valid(raw_data))",
    "B9": cnt("b_performance"), "B10": cnt("b_customers"), "B11": cnt("events"),
    "B12": cnt("b_sales", f"order_date > {_DAY}"),
    "B13": cnt("b_customers", "contains(customer_name, chr(65533)) OR contains(email, chr(65533))"),
    "B14": cnt("b_customers", "length(customer_name) > 255 OR length(email) > 255 OR length(phone) > 10"),
    "B15": f"(SELECT date_sub('hour', min(t), max(t)) FROM ({_newest}))",
    "S1": orphan("s_performance", "s_campaigns", "campaign_id"),
    "S2": cnt("s_performance", "clicks > impressions"),
    "S3": cnt("s_performance", "impressions > 0 AND abs(CAST(ctr AS DOUBLE) - 100.0 * clicks / impressions) > 0.01"),
    "S4": f"(SELECT {rnd(pct('(SELECT count(DISTINCT campaign_id) FROM s_campaigns)', 'count(DISTINCT campaign_id)'), 4)} FROM b_campaigns)",
    "S5": cnt("s_performance", "least(impressions, clicks, cost, conversions, revenue) < 0"),
    "S6": cnt("s_performance", "performance_date NOT BETWEEN DATE '2020-01-01' AND DATE '2030-12-31'"),
    "S7": cnt("s_customers", "customer_id IS NULL OR customer_name IS NULL OR email IS NULL"),
    "S8": cnt("s_customers", "email IS NOT NULL AND NOT email_valid"),
    "S9": "(SELECT count(*) FROM s_performance, (SELECT avg(CAST(cost AS DOUBLE)) AS m, stddev(CAST(cost AS DOUBLE)) AS d FROM s_performance) WHERE abs(cost - m) > 3 * d)",
    "S10": cnt("s_campaigns", "status NOT IN ('Active', 'Paused', 'Completed', 'Planned', 'Cancelled')"),
    "S11": rep("s_campaigns", "campaign_id"),
    "S12": cnt("s_performance", "cost > 0 AND abs(CAST(roas AS DOUBLE) - CAST(revenue AS DOUBLE) / CAST(cost AS DOUBLE)) > 0.01"),
    "S13": cnt("s_performance", "conversion_rate NOT BETWEEN 0 AND 100"),
    "S14": gaps("s_performance", "performance_date"),
    "S15": cnt("s_performance", f"source_load_timestamp NOT BETWEEN {_TS} - INTERVAL 7 DAY AND {_TS}"),
    "S16": "(SELECT count(*) FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation))",
    "S17": orphan("s_campaigns", "s_performance", "campaign_id"),
    "S18": cnt("s_performance", "revenue > 0 AND cost = 0"),
    "S19": months("s_performance", "performance_date", "revenue"),
    "S20": cnt("s_performance", "conversions > clicks"),
    "G1": " + ".join(orphan(f, d, k) for f, d, k in [
        ("f_performance", "d_campaign", "campaign_key"), ("f_performance", "d_channel", "channel_key"), ("f_performance", "d_date", "date_key"),
        ("f_sales", "d_customer", "customer_key"), ("f_sales", "d_product", "product_key"), ("f_sales", "d_campaign", "campaign_key"),
        ("f_sales", "d_date", "date_key")]),
    "G2": rep("d2_customer", "customer_id", "is_current"),
    "G3": "(SELECT greatest(abs((SELECT sum(impressions) FROM s_performance) - sum(impressions)), abs((SELECT sum(clicks) FROM s_performance) - sum(clicks))) FROM f_performance)",
    "G4": rep("f_performance", "campaign_key, channel_key, date_key"),
    "G5": "(SELECT count(*) FROM (SELECT valid_to, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS n FROM d2_customer) WHERE n < valid_to)",
    "G6": gaps("d_date", "full_date"),
    "G7": cnt("f_sales", "customer_key IS NULL OR product_key IS NULL OR date_key IS NULL"),
    "G8": "(SELECT abs(sum(total_cost) - (SELECT sum(cost) FROM f_performance)) FROM f_campaign_daily)",
    "G9": "(SELECT count(*) FROM (SELECT version_number, lag(version_number, 1, 0) OVER (PARTITION BY customer_id ORDER BY version_number) AS p FROM d2_customer) WHERE version_number <> p + 1)",
    "G10": rep("d_product", "product_id"),
    "G11": cnt("f_sales", "least(quantity, unit_price, discount_amount, tax_amount, line_total, revenue) < 0"),
    "G12": gaps("f_performance", "performance_date"),
    "G13": f"(SELECT count(*) FROM d2_customer a JOIN d2_customer b ON a.customer_id = b.customer_id AND a.version_number = b.version_number + 1 WHERE {_tracked_same})",
    "G14": months("f_sales", "order_date", "revenue"),
    "G15": " + ".join(f"(SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {v})" for v in (
        "v_campaign", "v_customer", "v_product", "v_channel", "d_date", "v_sales", "v_performance")),
}
_OPS = {"eq": "=", "ge": ">=", "le": "<="}


def check_statement(check_id: str) -> str:
    c = BY_ID[check_id]
    return (f"SELECT '{check_id}' AS check_id, actual_value, CAST({c.expected} AS DOUBLE) AS expected_value, "
            f"CASE WHEN actual_value {_OPS[c.compare]} {c.expected} THEN 'PASS' ELSE 'FAIL' END AS check_status "
            f"FROM (SELECT CAST({ACTUAL[check_id]} AS DOUBLE) AS actual_value)")


for _c in CHECKS:
    query(f"dq_{_c.check_id}", check_statement(_c.check_id))(
        lambda spark, sf, c=_c: q.evaluate(tables(spark, sf), [c]).select(*q.RESULT_COLUMNS))


@query("run_layer_checks", "\nUNION ALL ".join(check_statement(c.check_id) for c in CHECKS if c.layer == "SILVER"))
def run_layer_checks(spark, sf):
    """The silver layer: one scan of each table for all its row rules."""
    return q.run_layer_checks(spark, tables(spark, sf), CHECKS, "SILVER", "run-1", NOW).select(*q.RESULT_COLUMNS)


@query("run_layer_checks_by_partition", "\nUNION ALL ".join(check_statement(c.check_id) for c in CHECKS if c.layer == "SILVER"))
def run_layer_checks_by_partition(spark, sf):
    """The silver layer after two loads of the performance table by day: the second run scans what the second load brought."""
    table = VersionedTable(spark, session.scratch_path(spark, "silver-by-day"))
    rows = silver_table(spark, sf, "performance").withColumn("day_key", F.date_format("performance_date", "yyyyMMdd"))
    last = rows.agg(F.max("day_key")).scalar()

    def now():
        t = tables(spark, sf)
        return q.Tables({n: (lambda n=n: t[n]) for n in t} | {"silver_performance": lambda: table.read().drop("day_key")}, **t.parameters)

    counts, stored = CheckStates(spark, session.scratch_path(spark, "check-states")), {"silver_performance": Partitioned(table, "day_key")}
    mine = [c for c in CHECKS if c.table == "silver_performance" and c.violates]
    table.append(rows.where(F.col("day_key") < last), ["day_key"])
    counts.evaluate(now(), mine, stored)
    table.append(rows.where(F.col("day_key") == last), ["day_key"])
    return q.run_layer_checks(spark, now(), CHECKS, "SILVER", "run-2", NOW, by=lambda t, checks: counts.evaluate(t, checks, stored)).select(*q.RESULT_COLUMNS)


@query("run_check", check_statement("S2"))
def run_check(spark, sf):
    row = q.run_check(spark, tables(spark, sf), BY_ID["S2"])
    return spark.createDataFrame([row], q.LOG_SCHEMA).select(*q.RESULT_COLUMNS)


_GOLD = "\nUNION ALL ".join(check_statement(c.check_id) for c in CHECKS if c.layer == "GOLD")
_SEVERITY = ", ".join(f"('{c.check_id}', '{c.name}', '{c.severity}')" for c in CHECKS)


@query("check_registry", f"""
SELECT r.check_id, check_name, severity, check_status FROM (VALUES {_SEVERITY}) r(check_id, check_name, severity)
JOIN ({' UNION ALL '.join(check_statement(c.check_id) for c in CHECKS if c.layer == 'BRONZE')}) s ON r.check_id = s.check_id""")
def check_registry(spark, sf):
    """The registered bronze checks with their latest result."""
    log = q.run_layer_checks(spark, tables(spark, sf), CHECKS, "BRONZE", "run-1", NOW)
    return q.check_registry(spark, CHECKS).join(log.select("check_id", "check_status"), "check_id").select(
        "check_id", "check_name", "severity", "check_status")


@query("critical_gate", f"""
SELECT s.check_id, check_name FROM (VALUES {_SEVERITY}) r(check_id, check_name, severity)
JOIN ({' UNION ALL '.join(check_statement(c.check_id) for c in CHECKS if c.layer == 'SILVER')}) s ON r.check_id = s.check_id
WHERE severity = 'CRITICAL' AND check_status = 'FAIL'""")
def critical_gate(spark, sf):
    """The critical failures that stop a silver run."""
    log = q.run_layer_checks(spark, tables(spark, sf), CHECKS, "SILVER", "run-1", NOW)
    return q.critical_failures(log, q.check_registry(spark, CHECKS), "run-1").select("check_id", "check_name")


# ---- issues, integrity, profiles -------------------------------------------------------------------
RULES = [
    ("clicks > impressions", "clicks", "BUSINESS_RULE_VIOLATION", "clicks <= impressions", "<= impressions", "HIGH"),
    ("conversions > clicks", "conversions", "BUSINESS_RULE_VIOLATION", "conversions <= clicks", "<= clicks", "HIGH"),
    ("cost = 0", "cost", "MISSING_VALUE", "cost > 0", "> 0", "MEDIUM")]


def issues(spark, sf):
    return q.issue_rows(silver_table(spark, sf, "performance"), "SILVER_PERFORMANCE", "performance_id",
                        [(F.expr(cond), *rest) for cond, *rest in RULES], F.col("performance_date").cast("timestamp_ntz"))


ISSUES_SQL = " UNION ALL ".join(
    f"SELECT 'SILVER_PERFORMANCE' AS table_name, CAST(performance_date AS TIMESTAMP) AS issue_timestamp, performance_id AS record_identifier, '{kind}' AS issue_type, "
    f"'{col}' AS column_name, '{exp}' AS expected_value, CAST({col} AS VARCHAR) AS actual_value, '{rule}' AS rule_violated, '{sev}' AS severity, 'OPEN' AS resolution_status "
    f"FROM s_performance WHERE {cond}" for cond, col, kind, rule, exp, sev in RULES)


@query("dq_issue_rows", ISSUES_SQL, text="issue_timestamp")
def dq_issue_rows(spark, sf):
    return issues(spark, sf)


def _ri(fact: str, cte: str, column: str, dim: str, parent: str) -> str:
    lost = f"(SELECT {column} AS k FROM {cte} c WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{column} = c.{column}))"
    return (f"SELECT '{fact}' AS fact_table, '{dim}' AS dimension_table, '{column}' AS foreign_key_column, (SELECT count(*) FROM {lost}) AS orphaned_record_count, "
            f"(SELECT coalesce(string_agg(k, ',' ORDER BY k), '') FROM (SELECT DISTINCT k FROM {lost} ORDER BY k LIMIT 5)) AS sample_orphaned_keys")


@query("ri_log", " UNION ALL ".join([
    _ri("SALES", "s_sales", "campaign_id", "CAMPAIGNS", "c2_campaigns"), _ri("SALES", "s_sales", "customer_id", "CUSTOMERS", "c2_customers"),
    _ri("PERFORMANCE", "s_performance", "campaign_id", "CAMPAIGNS", "c2_campaigns"), _ri("SALES", "s_sales", "product_id", "PRODUCTS", "s_products")]))
def ri_log(spark, sf):
    s, p = silver_table(spark, sf, "sales"), silver_table(spark, sf, "performance")
    camp, cust = states.campaigns_after(spark, sf), states.customers_after(spark, sf)
    log = q.ri_log([("SALES", s, "campaign_id", "CAMPAIGNS", camp, "campaign_id"), ("SALES", s, "customer_id", "CUSTOMERS", cust, "customer_id"),
                    ("PERFORMANCE", p, "campaign_id", "CAMPAIGNS", camp, "campaign_id"),
                    ("SALES", s, "product_id", "PRODUCTS", silver_table(spark, sf, "products"), "product_id")], NOW)
    return log.select("fact_table", "dimension_table", "foreign_key_column", "orphaned_record_count",
                      F.array_join("sample_orphaned_keys", ",").alias("sample_orphaned_keys"))


_PROFILED = {"customers": ["tier", "segment", "email", "lifetime_value"], "products": ["category", "unit_price", "margin_percent"]}


def profile_statement(table: str, column: str, kind: str) -> str:
    num = kind != "string"
    n = f"CAST({column} AS DOUBLE)"
    return f"""
SELECT '{table.upper()}' AS table_name, '{column}' AS column_name, '{kind}' AS data_type, count(*) AS row_count, count(DISTINCT {column}) AS distinct_count,
  count(*) - count({column}) AS null_count, {rnd(pct(f'(count(*) - count({column}))', 'count(*)'), 2)} AS null_percentage,
  CAST(min({column}) AS VARCHAR) AS min_value, CAST(max({column}) AS VARCHAR) AS max_value, {f'round(avg({n}), 4)' if num else 'CAST(NULL AS DOUBLE)'} AS avg_value,
  {f'quantile_disc({n}, 0.5)' if num else 'CAST(NULL AS DOUBLE)'} AS median_value, {f'round(stddev({n}), 4)' if num else 'CAST(NULL AS DOUBLE)'} AS std_dev,
  (SELECT '[' || string_agg('"' || v || '"', ',' ORDER BY n DESC, v) || ']' FROM (SELECT CAST({column} AS VARCHAR) AS v, count(*) AS n FROM s_{table}
    WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 5)) AS top_5_values
FROM s_{table}"""


_KINDS = {"lifetime_value": "decimal(18,2)", "unit_price": "decimal(18,2)", "margin_percent": "decimal(18,4)"}
PROFILE_SQL = "\nUNION ALL ".join(profile_statement(t, c, _KINDS.get(c, "string")) for t, cs in _PROFILED.items() for c in cs)


def profiles(spark, sf):
    parts = [q.profile_columns(silver_table(spark, sf, t), t.upper(), cs) for t, cs in _PROFILED.items()]
    return parts[0].unionByName(parts[1])


@query("profile_columns", PROFILE_SQL)
def profile_columns(spark, sf):
    return profiles(spark, sf)


# ---- sketches by day ---------------------------------------------------------------------------------
_SKETCHED = {"revenue": True, "quantity": True, "customer_id": False, "campaign_id": False}
_SINCE, _UNTIL = "1994-01-01", "1996-12-31"


@query("profile_window", "\nUNION ALL ".join(f"""
SELECT 'SALES' AS table_name, '{c}' AS column_name, count(DISTINCT order_date) AS days, count(*) AS row_count, count(*) - count({c}) AS null_count,
  {f'min(CAST({c} AS DOUBLE))' if number else 'CAST(NULL AS DOUBLE)'} AS smallest, {f'max(CAST({c} AS DOUBLE))' if number else 'CAST(NULL AS DOUBLE)'} AS largest,
  TRUE AS distinct_within, TRUE AS median_within
FROM s_sales WHERE order_date BETWEEN DATE '{_SINCE}' AND DATE '{_UNTIL}'""" for c, number in _SKETCHED.items()))
def profile_window(spark, sf):
    """Three years of sales from one stored row a day and column: counts as they are, sketches within their error of the exact values."""
    sales = silver_table(spark, sf, "sales").select("order_date", *_SKETCHED)
    table = VersionedTable(spark, session.scratch_path(spark, "daily-sketches"))
    table.merge(sketches.daily_states(sales, "SALES", "order_date", list(_SKETCHED)), sketches.KEYS)
    merged = sketches.merged_profile(table.read(), _SINCE, _UNTIL)
    window = sales.where(F.col("order_date").between(_SINCE, _UNTIL))
    exact = window.agg(*[F.count_distinct(c).alias(c) for c in _SKETCHED]).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("_distinct")) for c in _SKETCHED])))
    numbers = [c for c, number in _SKETCHED.items() if number]
    around = exact_cuts(window, numbers, [(45, 100), (55, 100)])
    estimate = F.col("distinct_estimate")
    return merged.join(exact, "column_name").join(around, "column_name", "left").select(
        "table_name", "column_name", "days", "row_count", "null_count",
        *[F.when(F.col("column_name").isin(numbers), F.col(c).cast("double")).alias(n) for c, n in (("min_value", "smallest"), ("max_value", "largest"))],
        (F.abs(estimate - F.col("_distinct")) <= F.col("_distinct") * 4 * sketches.DISTINCT_ERROR + 1).alias("distinct_within"),
        F.coalesce(F.col("median_estimate").between(F.col("cuts")[0], F.col("cuts")[1]), F.lit(True)).alias("median_within"))
