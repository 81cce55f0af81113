"""The six marketing entities derived from the given Parquet tables.

Every rule is a fixed arithmetic of the row itself, so the frames grow with
the tables and need no state. Money is cast to decimal(18,2) before any
multiplication.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_LOAD = "timestamp_ntz'2024-02-01 00:00:00' + make_dt_interval(cast({key} % 3 as int)) AS load_timestamp"
_MODIFIED = "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast({key} % 28 as int)) AS last_modified_timestamp"
_SOURCE = "'erp' AS source_system"


def padded(key: str, width: int) -> str:
    """A key as text of at least `width` digits; lpad alone would cut longer ones."""
    return f"lpad(cast({key} AS string), greatest({width}, length(cast({key} AS string))), '0')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        f"concat('CUST-', {padded('c_custkey', 8)}) AS customer_id",
        "CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE c_name END AS customer_name",
        "CASE WHEN c_custkey % 29 = 0 THEN NULL"
        " WHEN c_custkey % 17 = 0 THEN concat(' User', c_custkey, '.Example.com ')"
        " ELSE concat(' User', c_custkey, '@Example.com ') END AS email",
        "CASE WHEN c_custkey % 23 = 0 THEN '12' ELSE concat('+1-555-', lpad(c_custkey % 10000, 4, '0')) END AS phone",
        "c_mktsegment AS segment",
        "CASE WHEN c_custkey % 31 = 0 THEN NULL WHEN c_acctbal >= 7500 THEN 'Platinum'"
        " WHEN c_acctbal >= 5000 THEN 'Gold' WHEN c_acctbal >= 2000 THEN 'Silver' ELSE 'Bronze' END AS tier",
        "CASE WHEN c_custkey % 20 = 0 THEN 'Churned' WHEN c_custkey % 10 = 1 THEN 'Inactive' ELSE 'Active' END AS status",
        "cast(cast(c_acctbal AS decimal(18,2)) * 3 AS decimal(18,2)) AS lifetime_value",
        _SOURCE, _MODIFIED.format(key="c_custkey"), _LOAD.format(key="c_custkey"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced = table(spark, sf_dir, "part").selectExpr(
        "*",
        "cast(cast(p_retailprice AS decimal(18,2)) - 880 + p_partkey % 250 AS decimal(18,2)) AS unit_price",
        "cast(20 + p_partkey % 45 AS decimal(18,4)) AS margin_percent",
    ).withColumn("margin", F.expr("cast(round(unit_price * (20 + p_partkey % 45) * 0.01, 2) AS decimal(18,2))"))
    return priced.selectExpr(
        f"concat('PROD-', {padded('p_partkey', 6)}) AS product_id",
        "concat('sku-', p_partkey) AS sku",
        "p_name AS product_name", "p_type AS category",
        "CASE WHEN p_size % 13 = 0 THEN NULL ELSE concat('Size ', p_size) END AS subcategory",
        "p_brand AS brand", "unit_price",
        "cast(unit_price - margin AS decimal(18,2)) AS cost", "margin", "margin_percent",
        "CASE WHEN p_partkey % 20 = 7 THEN 'Discontinued' ELSE 'Active' END AS product_status",
        _SOURCE, _MODIFIED.format(key="p_partkey"), _LOAD.format(key="p_partkey"),
    )


CAMPAIGN_TYPES = ["Awareness", "Lead Generation", "Conversion", "Retention", "Brand", "Promotion"]
CHANNEL_TYPES = ["Email", "Paid Search", "Display", "Social", "Direct", "Organic Search", "Video", "Affiliate"]


def _pick(labels: list[str], index: str) -> str:
    listed = ", ".join(f"'{label}'" for label in labels)
    return f"element_at(array({listed}), cast({index} % {len(labels)} AS int) + 1)"


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        f"concat('CPG-', {padded('s_suppkey', 6)}) AS campaign_id",
        "CASE WHEN s_suppkey % 33 = 5 THEN NULL ELSE concat('Campaign ', s_suppkey) END AS campaign_name",
        f"{_pick(CAMPAIGN_TYPES, 's_suppkey')} AS campaign_type",
        "date_add(date'2023-11-01', cast(s_suppkey % 90 AS int)) AS start_date",
        "date_add(date'2023-11-01', cast(s_suppkey % 90 + 14 + s_suppkey % 77 AS int)) AS end_date",
        "cast(abs(cast(s_acctbal AS decimal(18,2))) * 10 AS decimal(18,2)) AS budget",
        "CASE WHEN s_suppkey % 11 = 0 THEN 'Paused' ELSE 'Active' END AS status",
        "CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE concat('Objective ', s_suppkey % 5) END AS objective",
        _SOURCE, _MODIFIED.format(key="s_suppkey"), _LOAD.format(key="s_suppkey"),
    )


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        f"concat('CH-', {padded('n_nationkey', 2)}) AS channel_id",
        "n_name AS channel_name",
        f"{_pick(CHANNEL_TYPES, 'n_nationkey')} AS channel_type",
        "CASE WHEN n_nationkey % 9 = 4 THEN NULL WHEN n_regionkey IN (0, 4) THEN 'Owned'"
        " WHEN n_regionkey = 1 THEN 'Earned' ELSE 'Paid' END AS category",
        "CASE WHEN n_regionkey = 0 THEN 'Fixed' WHEN n_regionkey = 1 THEN 'Free' ELSE 'CPC' END AS cost_structure",
        _SOURCE, _MODIFIED.format(key="n_nationkey"), _LOAD.format(key="n_nationkey"),
    )


def performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    campaign_count = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    keyed = table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("performance_date"),
        (F.col("user_id") % campaign_count).alias("campaign"),
        (F.col("user_id") % 25).alias("channel"),
        "event_type",
        F.col("value").cast("decimal(18,2)").alias("value"),
    )
    kind = F.col("event_type")
    daily = keyed.groupBy("performance_date", "campaign", "channel").agg(
        (F.count_if(kind == "view") * 100 + F.count(F.lit(1))).alias("impressions"),
        (F.count_if(kind == "click") * 20).alias("clicks"),
        F.coalesce(F.sum(F.when(kind.isin("click", "view"), F.col("value"))), F.lit(0)).cast("decimal(18,2)").alias("cost"),
        (F.count_if(kind == "purchase") * 5).alias("conversions"),
        (F.coalesce(F.sum(F.when(kind == "purchase", F.col("value"))), F.lit(0)) * 3).cast("decimal(18,2)").alias("revenue"),
    )
    return daily.selectExpr(
        "concat('PERF-', date_format(performance_date, 'yyyyMMdd'), '-', campaign, '-', channel) AS performance_id",
        f"concat('CPG-', {padded('campaign', 6)}) AS campaign_id",
        f"concat('CH-', {padded('channel', 2)}) AS channel_id",
        "performance_date", "impressions", "clicks", "cost", "conversions", "revenue",
        _SOURCE, "cast(performance_date AS timestamp_ntz) AS last_modified_timestamp", _LOAD.format(key="campaign"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"),
        F.col("l_orderkey") == F.col("o_orderkey"))
    priced = lines.selectExpr(
        "*",
        "cast(l_quantity AS int) AS quantity",
        "cast(l_extendedprice AS decimal(18,2)) AS gross",
    ).selectExpr(
        "*",
        "cast(cast(gross * 100 AS bigint) div quantity * 0.01 AS decimal(18,2)) AS unit_price",
        "cast(round(gross * cast(l_discount AS decimal(18,2)), 2) AS decimal(18,2)) AS discount_amount",
    ).withColumn("line_total", F.expr(
        "cast(quantity * unit_price - discount_amount + CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END AS decimal(18,2))")
    ).withColumn("tax_amount", F.expr(
        "cast(round(line_total * cast(l_tax AS decimal(18,2)), 2) AS decimal(18,2))"))
    return priced.selectExpr(
        f"concat('ORD-', {padded('l_orderkey', 10)}) AS order_id",
        f"concat('ORD-', {padded('l_orderkey', 10)}, '-', {padded('l_linenumber', 3)}) AS order_line_id",
        f"concat('CUST-', {padded('o_custkey', 8)}) AS customer_id",
        f"concat('PROD-', {padded('l_partkey', 6)}) AS product_id",
        f"CASE WHEN l_linenumber = 7 THEN NULL ELSE concat('CPG-', {padded('l_suppkey', 6)}) END AS campaign_id",
        "cast(o_orderdate AS date) AS order_date",
        "o_orderdate + make_dt_interval(0, cast(8 + l_orderkey % 14 AS int)) AS order_timestamp",
        "quantity", "unit_price", "discount_amount", "tax_amount", "line_total",
        "cast(line_total + tax_amount AS decimal(18,2)) AS revenue",
        _SOURCE, "l_shipdate AS last_modified_timestamp", _LOAD.format(key="l_orderkey"),
    )


BRONZE = {
    "campaigns": campaigns, "channels": channels, "customers": customers,
    "products": products, "performance": performance, "sales": sales,
}
NATURAL_KEYS = {
    "campaigns": ["campaign_id"], "channels": ["channel_id"], "customers": ["customer_id"],
    "products": ["product_id"], "performance": ["performance_id"], "sales": ["order_line_id"],
}
