"""Aggregate, window, ordering and scalar shapes on their own."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from tidemark.functions.expressions import date_key, elapsed, percent, ratio, rank_of, time_key
from tidemark.operators import aggregates as agg
from tidemark.plans import views
from tidemark.plans.star import gold, silver_table
from tidemark.sources import entities

from .ctes import div, pct, rnd
from .registry import query


@query("agg_basic", f"""
SELECT count(*) AS row_total, round(sum(revenue), 2) AS total, {rnd(div('sum(revenue)', 'count(*)'), 2)} AS average,
  min(revenue) AS smallest, max(revenue) AS largest FROM s_sales""", "total smallest largest")
def agg_basic(spark, sf):
    return agg.summary(silver_table(spark, sf, "sales"), "revenue")


@query("agg_distinct", """
SELECT count(DISTINCT campaign_id) AS distinct_campaign_id, count(DISTINCT channel_id) AS distinct_channel_id,
  count(DISTINCT campaign_id || '→' || channel_id) AS distinct_together FROM s_performance""")
def agg_distinct(spark, sf):
    return agg.distinct_counts(silver_table(spark, sf, "performance"), ["campaign_id", "channel_id"])


@query("agg_conditional", """
SELECT o_orderpriority, count(*) AS row_total, count(*) FILTER (o_orderstatus = 'F') AS finished, count(*) FILTER (o_totalprice > 250000) AS large
FROM orders GROUP BY ALL""")
def agg_conditional(spark, sf):
    return agg.conditional_counts(entities.table(spark, sf, "orders"), ["o_orderpriority"], {
        "finished": F.col("o_orderstatus") == "F", "large": F.col("o_totalprice") > 250000})


@query("agg_having", """
SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units FROM s_sales GROUP BY ALL HAVING sum(quantity) > 700""")
def agg_having(spark, sf):
    return silver_table(spark, sf, "sales").groupBy("product_id").agg(F.sum("quantity").alias("units")).where(F.col("units") > 700)


@query("agg_ratio_safe", f"""
SELECT campaign_id, channel_id, {rnd(div('sum(revenue)', 'sum(cost)'), 4)} AS roas FROM s_performance GROUP BY ALL""")
def agg_ratio_safe(spark, sf):
    return agg.safe_ratio(silver_table(spark, sf, "performance"), ["campaign_id", "channel_id"], "revenue", "cost", "roas")


def _dist(table: str, column: str) -> str:
    return (f"SELECT '{column}' AS metric_name, {column} AS value, count(*) AS count, "
            f"{rnd(pct('count(*)', 'sum(count(*)) OVER ()'), 2)} AS percentage FROM {table} GROUP BY {column}")


_DISTRIBUTIONS = [("b_campaigns", "campaigns", "status"), ("b_customers", "customers", "segment"), ("b_customers", "customers", "tier"),
                  ("b_products", "products", "category"), ("b_sales", "sales", "quantity")]


@query("distribution", " UNION ALL ".join(_dist(t, c).replace(f"{c} AS value", f"CAST({c} AS VARCHAR) AS value") for t, _, c in _DISTRIBUTIONS))
def distribution(spark, sf):
    out = None
    for _, entity, column in _DISTRIBUTIONS:
        d = agg.distribution(entities.BRONZE[entity](spark, sf), column, "value").select(
            F.lit(column).alias("metric_name"), F.col("value").cast("string").alias("value"), "count", "percentage")
        out = d if out is None else out.unionByName(d)
    return out


@query("group_by_ordinal", "SELECT l_returnflag, l_linestatus, count(*) AS row_total FROM lineitem GROUP BY 1, 2")
def group_by_ordinal(spark, sf):
    return spark.sql("SELECT l_returnflag, l_linestatus, count(*) AS row_total FROM {lines} GROUP BY 1, 2",
                     lines=entities.table(spark, sf, "lineitem"))


@query("win_rank_topn", """
SELECT product_category, product_name, revenue, position FROM (
  SELECT *, rank() OVER (PARTITION BY product_category ORDER BY revenue DESC) AS position
  FROM (SELECT product_category, product_name, sum(revenue) AS revenue FROM f_sales f JOIN v_product p ON f.product_key = p.dim_product_sk GROUP BY ALL))
WHERE position <= 3""", "revenue")
def win_rank_topn(spark, sf):
    star = gold(spark, sf)
    per_key = star.fact_sales.groupBy("product_key").agg(F.sum("revenue").alias("revenue"))
    g = per_key.join(star.v_product, F.col("product_key") == F.col("dim_product_sk")).groupBy(
        "product_category", "product_name").agg(F.sum("revenue").alias("revenue"))
    w = W.partitionBy("product_category").orderBy(F.desc("revenue"))
    return g.withColumn("position", F.rank().over(w)).where("position <= 3")


_MONTHS = "SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS orders FROM orders GROUP BY ALL"


def _months(spark, sf):
    o = entities.table(spark, sf, "orders")
    return o.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("orders"))


@query("win_lag", f"SELECT *, lag(orders, 12) OVER (ORDER BY year, month) AS orders_12_back FROM ({_MONTHS})")
def win_lag(spark, sf):
    return _months(spark, sf).withColumn("orders_12_back", F.lag("orders", 12).over(W.orderBy("year", "month")))


@query("win_share", f"""
SELECT year, month, orders, {rnd(pct('orders', 'sum(orders) OVER (PARTITION BY year)'), 2)} AS share_of_year,
  {rnd(pct('orders', 'sum(orders) OVER ()'), 2)} AS share_of_all FROM ({_MONTHS})""")
def win_share(spark, sf):
    m = _months(spark, sf)
    return m.withColumns({
        "share_of_year": F.round(percent("orders", F.sum("orders").over(W.partitionBy("year"))), 2),
        "share_of_all": F.round(percent("orders", F.sum("orders").over(W.partitionBy())), 2)})


@query("win_moving_avg", """
SELECT day, orders, round(avg(orders) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS moving_avg
FROM (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY ALL)""", text="day")
def win_moving_avg(spark, sf):
    daily = entities.table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    return agg.moving_average(daily, "day", "orders").withColumn("moving_avg", F.round("moving_avg", 6))


@query("sort_custom_order", """
SELECT tier, customers, row_number() OVER (ORDER BY CASE tier WHEN 'Platinum' THEN 1 WHEN 'Gold' THEN 2 WHEN 'Silver' THEN 3 WHEN 'Bronze' THEN 4 ELSE 5 END) AS position
FROM (SELECT tier, count(*) AS customers FROM s_customers GROUP BY ALL)""")
def sort_custom_order(spark, sf):
    g = silver_table(spark, sf, "customers").groupBy("tier").agg(F.count(F.lit(1)).alias("customers"))
    order = rank_of("tier", views.TIERS)
    return g.withColumn("position", F.row_number().over(W.orderBy(order))).orderBy("position")


@query("sort_limit_topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 25")
def sort_limit_topk(spark, sf):
    return entities.table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(25)


@query("union_all", """
SELECT 'sales' AS source, campaign_id, count(*) AS row_total FROM s_sales GROUP BY ALL
UNION ALL SELECT 'performance', campaign_id, count(*) FROM s_performance GROUP BY ALL""")
def union_all(spark, sf):
    parts = [silver_table(spark, sf, n).groupBy("campaign_id").agg(F.count(F.lit(1)).alias("row_total")).select(
        F.lit(n).alias("source"), "campaign_id", "row_total") for n in ("sales", "performance")]
    return parts[0].unionByName(parts[1])


@query("distinct", "SELECT DISTINCT customer_id, product_id FROM s_sales")
def distinct(spark, sf):
    return silver_table(spark, sf, "sales").select("customer_id", "product_id").distinct()


@query("exists_limit1", """
SELECT EXISTS (SELECT 1 FROM s_sales_all WHERE quantity > 49) AS any_large, EXISTS (SELECT 1 FROM s_sales_all WHERE quantity > 1000000) AS any_huge""")
def exists_limit1(spark, sf):
    """Existence probes stop at the first hit."""
    lines = entities.table(spark, sf, "lineitem")
    return spark.range(1).select(F.lit(agg.exists(lines.where("l_quantity > 49"))).alias("any_large"),
                                 F.lit(agg.exists(lines.where("l_quantity > 1000000"))).alias("any_huge"))


@query("sample_fraction", """
SELECT order_line_id, revenue FROM s_sales WHERE CAST('0x' || substr(md5(order_line_id), 1, 6) AS BIGINT) < 1677721""", "revenue")
def sample_fraction(spark, sf):
    """A tenth of the sales lines, the same ones in every run."""
    return agg.sample_by_hash(silver_table(spark, sf, "sales").select("order_line_id", "revenue"), ["order_line_id"], 0.1)


# ---- scalar functions ------------------------------------------------------------------------------
@query("scalar_string", """
SELECT customer_id, upper(customer_name) AS upper_name, lower(trim(email)) AS lower_email, substr(customer_id, 6) AS id_part,
  split_part(email, '@', 2) AS email_domain, left(phone, 3) AS phone_start, lpad(CAST(length(coalesce(customer_name, '')) AS VARCHAR), 4, '0') AS padded,
  customer_name ILIKE '%CUSTOMER%' AS name_like, sha256(customer_id) AS id_hash, customer_id || '/' || segment AS joined,
  (SELECT string_agg(DISTINCT segment, ', ' ORDER BY segment) FROM b_customers) AS all_segments
FROM b_customers""")
def scalar_string(spark, sf):
    c = entities.customers(spark, sf)
    segments = c.agg(F.array_join(F.array_sort(F.collect_set("segment")), ", ")).scalar()
    return c.select(
        "customer_id", F.upper("customer_name").alias("upper_name"), F.lower(F.trim("email")).alias("lower_email"),
        F.expr("substr(customer_id, 6)").alias("id_part"), F.split_part("email", F.lit("@"), F.lit(2)).alias("email_domain"),
        F.left("phone", F.lit(3)).alias("phone_start"),
        F.lpad(F.length(F.coalesce("customer_name", F.lit(""))).cast("string"), 4, "0").alias("padded"),
        F.col("customer_name").ilike("%CUSTOMER%").alias("name_like"), F.sha2("customer_id", 256).alias("id_hash"),
        F.concat("customer_id", F.lit("/"), "segment").alias("joined"), segments.alias("all_segments"))


@query("scalar_date", """
SELECT order_line_id, date_diff('day', order_date, DATE '2001-08-01') AS days_between, date_sub('hour', order_timestamp, TIMESTAMP '2001-08-01 00:00:00') AS hours_between,
  date_sub('minute', CAST(order_date AS TIMESTAMP), order_timestamp) AS minutes_between, CAST(order_date + INTERVAL 3 MONTH AS DATE) AS three_months_on,
  CAST(date_trunc('month', order_date) AS DATE) AS month_start, year(order_date) AS year, quarter(order_date) AS quarter, weekofyear(order_date) AS week,
  dayofyear(order_date) AS day_of_year, isodow(order_date) AS iso_day, monthname(order_date) AS month_name, dayname(order_date) AS day_name,
  CAST(strftime(order_date, '%Y%m%d') AS INT) AS date_key, CAST(strftime(order_timestamp, '%H%M%S') AS INT) AS time_key
FROM s_sales""", text="three_months_on month_start")
def scalar_date(spark, sf):
    s = silver_table(spark, sf, "sales")
    d = F.col("order_date")
    end = F.lit("2001-08-01 00:00:00").cast("timestamp_ntz")
    return s.select(
        "order_line_id", F.datediff(F.lit("2001-08-01").cast("date"), d).alias("days_between"),
        elapsed("HOUR", "order_timestamp", end).alias("hours_between"),
        elapsed("MINUTE", d.cast("timestamp_ntz"), "order_timestamp").alias("minutes_between"),
        F.add_months(d, 3).alias("three_months_on"), F.trunc(d, "month").alias("month_start"), F.year(d).alias("year"),
        F.quarter(d).alias("quarter"), F.weekofyear(d).alias("week"), F.dayofyear(d).alias("day_of_year"),
        (F.weekday(d) + 1).alias("iso_day"), F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "EEEE").alias("day_name"),
        date_key(d).alias("date_key"), time_key("order_timestamp").alias("time_key"))


@query("scalar_math", f"""
SELECT order_line_id, round(revenue, 1) AS rounded, abs(line_total - revenue) AS gap, quantity % 7 AS remainder,
  {rnd(div('revenue', 'NULLIF(quantity - 25, 0)'), 4)} AS per_unit FROM s_sales""", "rounded gap")
def scalar_math(spark, sf):
    return silver_table(spark, sf, "sales").select(
        "order_line_id", F.round("revenue", 1).alias("rounded"), F.abs(F.col("line_total") - F.col("revenue")).alias("gap"),
        (F.col("quantity") % 7).alias("remainder"), F.round(ratio("revenue", F.col("quantity") - 25), 4).alias("per_unit"))


@query("scalar_cast", """
SELECT customer_id, CAST(lifetime_value AS DOUBLE) AS as_double, CAST(substr(customer_id, 6) AS BIGINT) AS as_number, TRY_CAST(phone AS INT) AS maybe_number,
  TRY_CAST(tier AS DATE) AS maybe_date, CAST(CAST(load_timestamp AS DATE) AS VARCHAR) AS as_text, CAST(load_timestamp AS DATE) AS as_date FROM b_customers""",
       text="maybe_date as_date")
def scalar_cast(spark, sf):
    return entities.customers(spark, sf).select(
        "customer_id", F.col("lifetime_value").cast("double").alias("as_double"), F.expr("substr(customer_id, 6)").cast("bigint").alias("as_number"),
        F.col("phone").try_cast("int").alias("maybe_number"), F.col("tier").try_cast("date").alias("maybe_date"),
        F.to_date("load_timestamp").cast("string").alias("as_text"), F.to_date("load_timestamp").alias("as_date"))


@query("scalar_json", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, json_extract_string(props, '$.absent') AS absent FROM events")
def scalar_json(spark, sf):
    e = entities.table(spark, sf, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), F.get_json_object("props", "$.absent").alias("absent"))


@query("scalar_conditional", """
SELECT performance_id, CASE WHEN clicks > impressions THEN 'over' WHEN clicks = 0 THEN 'none' ELSE 'ok' END AS click_state,
  impressions BETWEEN 50 AND 150 AS mid_reach, NULLIF(clicks, 0) AS clicks_or_null, coalesce(NULLIF(conversions, 0), -1) AS conversions_or_minus,
  ['low', 'mid', 'high'][CAST(impressions % 3 AS INT) + 1] AS picked FROM s_performance""")
def scalar_conditional(spark, sf):
    p = silver_table(spark, sf, "performance")
    return p.select(
        "performance_id", F.when(F.col("clicks") > F.col("impressions"), "over").when(F.col("clicks") == 0, "none").otherwise("ok").alias("click_state"),
        F.col("impressions").between(50, 150).alias("mid_reach"), F.nullif("clicks", F.lit(0)).alias("clicks_or_null"),
        F.coalesce(F.nullif("conversions", F.lit(0)), F.lit(-1)).alias("conversions_or_minus"),
        F.element_at(F.array(F.lit("low"), F.lit("mid"), F.lit("high")), (F.col("impressions") % 3 + 1).cast("int")).alias("picked"))
