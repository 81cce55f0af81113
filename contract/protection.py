"""Row policies and masks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.operators import protect as p, quality as q
from tidemark.plans.star import gold, silver_table
from tidemark.sources import entities, tables

from .ctes import CTES, rnd, div
from .registry import query

# Who may see which segment, from and until when, derived from the data: every customer of a segment
# contributes its last-but-one digit as user number, so all users and segments of the data occur.
CTES["a_mapping"] = """
SELECT DISTINCT 'user' || (c_custkey % 9) AS user_name, c_mktsegment AS allowed_segment, DATE '2024-01-01' AS effective_date,
  CASE WHEN c_custkey % 9 = 3 THEN DATE '2024-01-15' ELSE DATE '9999-12-31' END AS expiration_date
FROM customer WHERE (c_custkey % 9) % 5 = length(c_mktsegment) % 5"""


def mapping(spark, sf):
    return entities.table(spark, sf, "customer").where("(c_custkey % 9) % 5 = length(c_mktsegment) % 5").selectExpr(
        "concat('user', c_custkey % 9) AS user_name", "c_mktsegment AS allowed_segment", "date'2024-01-01' AS effective_date",
        "CASE WHEN c_custkey % 9 = 3 THEN date'2024-01-15' ELSE date'9999-12-31' END AS expiration_date").distinct()


def _allowed(user: str) -> str:
    return f"(SELECT allowed_segment FROM a_mapping WHERE user_name = '{user}' AND DATE '2024-01-31' BETWEEN effective_date AND expiration_date)"


USERS = ["user0", "user3", "user4"]


@query("row_policy", " UNION ALL ".join(
    [f"SELECT '{u}' AS reader, customer_id, segment FROM d_customer WHERE segment IN {_allowed(u)}" for u in USERS]
    + ["SELECT 'auditor', customer_id, segment FROM d_customer"]))
def row_policy(spark, sf):
    """Two mapped readers, one whose mapping expired, and an exempt role."""
    dim, m = gold(spark, sf).dim_customer, mapping(spark, sf)
    parts = [p.row_policy(dim, "segment", m, "allowed_segment", u, p.BUSINESS, "2024-01-31").select(F.lit(u).alias("reader"), "customer_id", "segment") for u in USERS]
    parts.append(p.row_policy(dim, "segment", m, "allowed_segment", "any", p.AUDITOR, "2024-01-31").select(F.lit("auditor").alias("reader"), "customer_id", "segment"))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@query("region_policy", """
SELECT 'US' AS reader, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey = 1
UNION ALL SELECT 'admin', c_custkey FROM customer""")
def region_policy(spark, sf):
    c = entities.table(spark, sf, "customer").join(entities.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    roles = {"US_ANALYST": 1, "EU_ANALYST": 3}
    seen = p.region_policy(c, "n_regionkey", "US_ANALYST", roles).select(F.lit("US").alias("reader"), "c_custkey")
    return seen.unionByName(p.region_policy(c, "n_regionkey", p.ADMIN, roles).select(F.lit("admin").alias("reader"), "c_custkey")).unionByName(
        p.region_policy(c, "n_regionkey", "UNKNOWN", roles).select(F.lit("unknown").alias("reader"), "c_custkey"))


# Grants by role and class (fixed values).
GRANTS = [("BUSINESS_USER", "PUBLIC", True), ("BUSINESS_USER", "INTERNAL", False), ("DATA_ANALYST", "PUBLIC", True), ("DATA_ANALYST", "INTERNAL", True),
          ("DATA_ANALYST", "CONFIDENTIAL", False), ("DATA_ENGINEER", "PUBLIC", True), ("DATA_ENGINEER", "INTERNAL", True),
          ("DATA_ENGINEER", "CONFIDENTIAL", True), ("AUDITOR", "PUBLIC", True), ("AUDITOR", "INTERNAL", True), ("AUDITOR", "CONFIDENTIAL", True),
          ("AUDITOR", "RESTRICTED", True)]
_ROLE = "CASE WHEN user_id % 4 = 0 THEN 'BUSINESS_USER' WHEN user_id % 4 = 1 THEN 'DATA_ANALYST' WHEN user_id % 4 = 2 THEN 'DATA_ENGINEER' ELSE 'AUDITOR' END"
_CLASS = "CASE event_type WHEN 'view' THEN 'PUBLIC' WHEN 'click' THEN 'INTERNAL' WHEN 'purchase' THEN 'CONFIDENTIAL' ELSE 'RESTRICTED' END"


@query("classification_access", f"""
SELECT event_id, r.role_name, r.data_classification, coalesce(can_access, FALSE) AS can_access
FROM (SELECT event_id, {_ROLE} AS role_name, {_CLASS} AS data_classification FROM events) r
LEFT JOIN (VALUES {', '.join(f"('{a}', '{b}', {c})" for a, b, c in GRANTS)}) g(role_name, data_classification, can_access)
ON r.role_name = g.role_name AND r.data_classification = g.data_classification""")
def classification_access(spark, sf):
    """Every event as an access request of its user's role to a class of data."""
    grants = spark.createDataFrame(GRANTS, "role_name string, data_classification string, can_access boolean")
    requests = entities.table(spark, sf, "events").selectExpr("event_id", f"{_ROLE} AS role_name", f"{_CLASS} AS data_classification")
    return p.classification_access(requests, grants)


def _per_role(df, key, value, mask, roles):
    out = None
    for r in roles:
        part = df.select(key, F.lit(r).alias("role_name"), mask(value, r).alias("shown"))
        out = part if out is None else out.unionByName(part)
    return out


def _mask_sql(table: str, key: str, shown: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT {key}, '{r}' AS role_name, {e} AS shown FROM {table}" for r, e in shown.items())


@query("mask_full", _mask_sql("s_customers", "customer_id", {p.ADMIN: "phone", p.ENGINEER: "'***MASKED***'", p.BUSINESS: "'***REDACTED***'"}))
def mask_full(spark, sf):
    return _per_role(silver_table(spark, sf, "customers"), "customer_id", "phone", p.mask_full, [p.ADMIN, p.ENGINEER, p.BUSINESS])


@query("mask_email", _mask_sql("s_customers", "customer_id", {
    p.ADMIN: "email", p.ANALYST: "'***@' || split_part(email, '@', 2)", p.BUSINESS: "'***@***.com'"}))
def mask_email(spark, sf):
    return _per_role(silver_table(spark, sf, "customers"), "customer_id", "email", p.mask_email, [p.ADMIN, p.ANALYST, p.BUSINESS])


@query("mask_email_prefix", _mask_sql("s_customers", "customer_id", {p.ENGINEER: "email", p.BUSINESS: "left(email, 3) || '***@***.com'"}))
def mask_email_prefix(spark, sf):
    return _per_role(silver_table(spark, sf, "customers"), "customer_id", "email", p.mask_email_prefix, [p.ENGINEER, p.BUSINESS])


@query("mask_hash", "SELECT sha256(customer_id) AS customer, count(*) AS lines, CAST(sum(revenue) AS DOUBLE) AS revenue FROM s_sales GROUP BY customer_id")
def mask_hash(spark, sf):
    """Sales per hidden customer: the digest still groups and joins."""
    s = silver_table(spark, sf, "sales").groupBy("customer_id").agg(F.count(F.lit(1)).alias("lines"), F.sum("revenue").alias("revenue"))
    return s.select(p.mask_hash("customer_id", p.BUSINESS).alias("customer"), "lines", "revenue")


_BAND = "CAST(CASE WHEN {0} < 1000 THEN 500 WHEN {0} < 10000 THEN 5000 WHEN {0} < 100000 THEN 50000 ELSE 100000 END AS DOUBLE)"


@query("mask_banded", _mask_sql("s_sales", "order_line_id", {
    p.ANALYST: "CAST(revenue AS DOUBLE)", p.BUSINESS: _BAND.format("revenue"), p.SCIENTIST: "CAST(NULL AS DOUBLE)"}))
def mask_banded(spark, sf):
    return _per_role(silver_table(spark, sf, "sales"), "order_line_id", "revenue", p.mask_banded, [p.ANALYST, p.BUSINESS, p.SCIENTIST])


@query("secured_view", f"""
SELECT segment, count(*) AS customers, {rnd(div('sum(shown)', 'count(*)'), 2)} AS avg_shown, count(DISTINCT shown_email) AS emails
FROM (SELECT segment, {_BAND.format('lifetime_value')} AS shown, '***@***.com' AS shown_email FROM d_customer WHERE segment IN {_allowed('user0')}) GROUP BY ALL""")
def secured_view(spark, sf):
    """A business user's aggregate over the protected customers: bands reach the average."""
    m = mapping(spark, sf)
    view = p.secured_view(gold(spark, sf).dim_customer, {"email": p.mask_email, "phone": p.mask_full, "lifetime_value": p.mask_banded}, p.BUSINESS,
                          lambda df: p.row_policy(df, "segment", m, "allowed_segment", "user0", p.BUSINESS, "2024-01-31"))
    return view.groupBy("segment").agg(F.count("*").alias("customers"), F.round(F.sum("lifetime_value") / F.count("*"), 2).alias("avg_shown"),
                                       F.count_distinct("email").alias("emails"))


# ---- schema and file gates -------------------------------------------------------------------------
@query("schema_check", """
SELECT 'orders' AS table_name, NULL AS column_name, 'ok' AS problem, (SELECT count(*) FROM orders) AS total_rows
UNION ALL SELECT 'lineitem', 'l_tax_code', 'missing', (SELECT count(*) FROM lineitem)
UNION ALL SELECT 'events', 'value', 'double instead of string', (SELECT count(*) FROM events)""")
def schema_check(spark, sf):
    """Schemas of three tables against expected ones: as it should be, with a column too few, with one of another type."""
    plans = {n: entities.table(spark, sf, n) for n in ("orders", "lineitem", "events")}
    expected = {
        "orders": plans["orders"].schema,
        "lineitem": T.StructType([*plans["lineitem"].schema.fields, T.StructField("l_tax_code", T.StringType())]),
        "events": T.StructType([T.StructField("value", T.StringType()) if f.name == "value" else f for f in plans["events"].schema.fields])}
    parts = []
    for name, df in plans.items():
        for column, problem in q.schema_check(df.schema, expected[name]) or [(None, "ok")]:
            parts.append(df.agg(F.count("*").alias("total_rows")).select(
                F.lit(name).alias("table_name"), F.lit(column).cast("string").alias("column_name"), F.lit(problem).alias("problem"), "total_rows"))
    return reduce(DataFrame.unionByName, parts)


_FILES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@query("file_checks", " UNION ALL ".join(
    f"SELECT '{n}.parquet' AS file_name, (SELECT count(*) FROM {n}) AS n_rows, true AS not_empty, true AS name_ok, true AS is_recent, true AS readable" for n in _FILES))
def file_checks(spark, sf):
    """Every file of the given folder as a landing file: rows, size, name, age since the start of 2024, readable footer."""
    checked = tables.file_checks(spark, sf, r"^([a-z]+|part-[0-9]+)\.parquet$", "2024-01-01", 1, "*.parquet")
    return checked.select("file_name", "n_rows", "not_empty", "name_ok", "is_recent", "readable")
