"""Named SQL building blocks of the check statements (DuckDB dialect).

b_* bronze entities, s_* cleansed, d_* dimensions, f_* facts, v_* views,
a_* audit logs. `rnd` rounds half up: Spark divides exact decimals, so the
double quotient is widened by a few units in its last place before rounding.
"""

from __future__ import annotations

RUN_TS = "2024-02-05 00:00:00"
RUN_TS2 = "2024-02-10 00:00:00"
CHANGE_TS = "2024-01-15 00:00:00"
OPEN_END = "9999-12-31 23:59:59"
AS_OF_SALES = "2001-08-01"
AS_OF = "2024-01-31"


def rnd(x: str, n: int) -> str:
    return f"round(({x}) * (1 + 1e-14), {n}) + 0.0"


def q4(x: str) -> str:
    """As a decimal with four digits."""
    return f"CAST({rnd(x, 4)} AS DECIMAL(18,4))"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def pct(a: str, b: str) -> str:
    return f"(100.0 * CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def div0(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) ELSE 0.0 END"


def pct0(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN 100.0 * CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) ELSE 0.0 END"


def load(key: str) -> str:
    return f"TIMESTAMP '2024-02-01 00:00:00' + to_days(CAST({key} % 3 AS INT)) AS load_timestamp"


def modified(key: str) -> str:
    return f"TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST({key} % 28 AS INT)) AS last_modified_timestamp"


def dense(ident: str) -> str:
    """Rank in the order of the surrogate keys."""
    return f"row_number() OVER (ORDER BY substr(md5({ident}), 1, 4), {ident})"


def padded(key: str, width: int) -> str:
    """At least `width` digits, never fewer than the key has."""
    return f"lpad({key}::VARCHAR, greatest({width}, length({key}::VARCHAR))::INTEGER, '0')"


TAIL = f"source_system, last_modified_timestamp, load_timestamp AS source_load_timestamp, TIMESTAMP '{RUN_TS}' AS load_timestamp"
MONEY = "DECIMAL(18,2)"

CTES: dict[str, str] = {}

CTES["b_customers"] = f"""
SELECT 'CUST-' || {padded('c_custkey', 8)} AS customer_id,
  CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE c_name END AS customer_name,
  CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN ' User' || c_custkey || '.Example.com '
       ELSE ' User' || c_custkey || '@Example.com ' END AS email,
  CASE WHEN c_custkey % 23 = 0 THEN '12' ELSE '+1-555-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') END AS phone,
  c_mktsegment AS segment,
  CASE WHEN c_custkey % 31 = 0 THEN NULL WHEN c_acctbal >= 7500 THEN 'Platinum' WHEN c_acctbal >= 5000 THEN 'Gold'
       WHEN c_acctbal >= 2000 THEN 'Silver' ELSE 'Bronze' END AS tier,
  CASE WHEN c_custkey % 20 = 0 THEN 'Churned' WHEN c_custkey % 10 = 1 THEN 'Inactive' ELSE 'Active' END AS status,
  CAST(CAST(c_acctbal AS {MONEY}) * 3 AS {MONEY}) AS lifetime_value,
  'erp' AS source_system, {modified('c_custkey')}, {load('c_custkey')}
FROM customer"""

CTES["b_products"] = f"""
SELECT *, CAST(unit_price - margin AS {MONEY}) AS cost FROM (
SELECT 'PROD-' || {padded('p_partkey', 6)} AS product_id, 'sku-' || p_partkey AS sku, p_name AS product_name,
  p_type AS category, CASE WHEN p_size % 13 = 0 THEN NULL ELSE 'Size ' || p_size END AS subcategory, p_brand AS brand,
  CAST(CAST(p_retailprice AS {MONEY}) - 880 + p_partkey % 250 AS {MONEY}) AS unit_price,
  CAST(20 + p_partkey % 45 AS DECIMAL(18,4)) AS margin_percent,
  CAST(round(CAST(CAST(p_retailprice AS {MONEY}) - 880 + p_partkey % 250 AS {MONEY})
       * CAST(20 + p_partkey % 45 AS DECIMAL(4,0)) * CAST(0.01 AS DECIMAL(3,2)), 2) AS {MONEY}) AS margin,
  CASE WHEN p_partkey % 20 = 7 THEN 'Discontinued' ELSE 'Active' END AS product_status,
  'erp' AS source_system, {modified('p_partkey')}, {load('p_partkey')}
FROM part)"""

CTES["b_campaigns"] = f"""
SELECT 'CPG-' || {padded('s_suppkey', 6)} AS campaign_id,
  CASE WHEN s_suppkey % 33 = 5 THEN NULL ELSE 'Campaign ' || s_suppkey END AS campaign_name,
  ['Awareness','Lead Generation','Conversion','Retention','Brand','Promotion'][CAST(s_suppkey % 6 AS INT) + 1] AS campaign_type,
  DATE '2023-11-01' + CAST(s_suppkey % 90 AS INT) AS start_date,
  DATE '2023-11-01' + CAST(s_suppkey % 90 + 14 + s_suppkey % 77 AS INT) AS end_date,
  CAST(abs(CAST(s_acctbal AS {MONEY})) * 10 AS {MONEY}) AS budget,
  CASE WHEN s_suppkey % 11 = 0 THEN 'Paused' ELSE 'Active' END AS status,
  CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 'Objective ' || (s_suppkey % 5) END AS objective,
  'erp' AS source_system, {modified('s_suppkey')}, {load('s_suppkey')}
FROM supplier"""

CTES["b_channels"] = f"""
SELECT 'CH-' || {padded('n_nationkey', 2)} AS channel_id, n_name AS channel_name,
  ['Email','Paid Search','Display','Social','Direct','Organic Search','Video','Affiliate'][n_nationkey % 8 + 1] AS channel_type,
  CASE WHEN n_nationkey % 9 = 4 THEN NULL WHEN n_regionkey IN (0, 4) THEN 'Owned' WHEN n_regionkey = 1 THEN 'Earned' ELSE 'Paid' END AS category,
  CASE WHEN n_regionkey = 0 THEN 'Fixed' WHEN n_regionkey = 1 THEN 'Free' ELSE 'CPC' END AS cost_structure,
  'erp' AS source_system, {modified('n_nationkey')}, {load('n_nationkey')}
FROM nation"""

CTES["b_performance"] = f"""
SELECT 'PERF-' || strftime(performance_date, '%Y%m%d') || '-' || campaign || '-' || channel AS performance_id,
  'CPG-' || {padded('campaign', 6)} AS campaign_id, 'CH-' || {padded('channel', 2)} AS channel_id,
  performance_date, impressions, clicks, cost, conversions, revenue,
  'erp' AS source_system, CAST(performance_date AS TIMESTAMP) AS last_modified_timestamp, {load('campaign')}
FROM (
  SELECT CAST(ts AS DATE) AS performance_date, user_id % (SELECT count(*) FROM supplier) AS campaign, user_id % 25 AS channel,
    CAST(100 * count(*) FILTER (event_type = 'view') + count(*) AS BIGINT) AS impressions,
    CAST(20 * count(*) FILTER (event_type = 'click') AS BIGINT) AS clicks,
    CAST(coalesce(sum(CAST(value AS {MONEY})) FILTER (event_type IN ('click', 'view')), 0) AS {MONEY}) AS cost,
    CAST(5 * count(*) FILTER (event_type = 'purchase') AS BIGINT) AS conversions,
    CAST(3 * coalesce(sum(CAST(value AS {MONEY})) FILTER (event_type = 'purchase'), 0) AS {MONEY}) AS revenue
  FROM events GROUP BY 1, 2, 3)"""

CTES["b_sales"] = f"""
SELECT 'ORD-' || {padded('l_orderkey', 10)} AS order_id,
  'ORD-' || {padded('l_orderkey', 10)} || '-' || {padded('l_linenumber', 3)} AS order_line_id,
  'CUST-' || {padded('o_custkey', 8)} AS customer_id, 'PROD-' || {padded('l_partkey', 6)} AS product_id,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE 'CPG-' || {padded('l_suppkey', 6)} END AS campaign_id,
  CAST(o_orderdate AS DATE) AS order_date, o_orderdate + to_hours(CAST(8 + l_orderkey % 14 AS INT)) AS order_timestamp,
  quantity, unit_price, discount_amount, tax_amount, line_total, CAST(line_total + tax_amount AS {MONEY}) AS revenue,
  'erp' AS source_system, l_shipdate AS last_modified_timestamp, {load('l_orderkey')}
FROM (SELECT *, CAST(round(line_total * CAST(l_tax AS {MONEY}), 2) AS {MONEY}) AS tax_amount
  FROM (SELECT *, CAST(quantity * unit_price - discount_amount + CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END AS {MONEY}) AS line_total
    FROM (SELECT *, CAST(CAST(CAST(l_extendedprice AS {MONEY}) * 100 AS BIGINT) // quantity * CAST(0.01 AS DECIMAL(3,2)) AS {MONEY}) AS unit_price,
        CAST(round(CAST(l_extendedprice AS {MONEY}) * CAST(l_discount AS {MONEY}), 2) AS {MONEY}) AS discount_amount
      FROM (SELECT *, CAST(l_quantity AS INT) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey))))"""

CTES["s_campaigns"] = f"""
SELECT upper(trim(campaign_id)) AS campaign_id, coalesce(campaign_name, 'Unknown Campaign') AS campaign_name,
  coalesce(campaign_type, 'Unknown') AS campaign_type, start_date, end_date, coalesce(budget, 0) AS budget,
  coalesce(status, 'Unknown') AS status, objective, date_diff('day', start_date, end_date) + 1 AS duration_days, {TAIL}
FROM b_campaigns"""

CTES["s_channels"] = f"""
SELECT upper(trim(channel_id)) AS channel_id, coalesce(channel_name, 'Unknown Channel') AS channel_name,
  coalesce(channel_type, 'Unknown') AS channel_type, coalesce(category, 'Uncategorized') AS category, cost_structure, {TAIL}
FROM b_channels"""

CTES["s_customers"] = f"""
SELECT upper(trim(customer_id)) AS customer_id, coalesce(customer_name, 'Unknown Customer') AS customer_name,
  lower(trim(email)) AS email, phone, coalesce(segment, 'Unknown') AS segment, coalesce(tier, 'Standard') AS tier,
  coalesce(status, 'Active') AS status, coalesce(lifetime_value, 0) AS lifetime_value,
  coalesce(regexp_matches(lower(trim(email)), '^[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}$'), FALSE) AS email_valid,
  coalesce(regexp_matches(phone, '^\\+?[0-9][0-9 ()-]{{6,}}$'), FALSE) AS phone_valid, {TAIL}
FROM b_customers"""

CTES["s_products"] = f"""
SELECT upper(trim(product_id)) AS product_id, upper(trim(sku)) AS sku, coalesce(product_name, 'Unknown Product') AS product_name,
  coalesce(category, 'Uncategorized') AS category, coalesce(subcategory, 'General') AS subcategory, coalesce(brand, 'Generic') AS brand,
  coalesce(unit_price, 0) AS unit_price, coalesce(cost, 0) AS cost, coalesce(margin, 0) AS margin,
  coalesce(margin_percent, 0) AS margin_percent, coalesce(product_status, 'Active') AS product_status, {TAIL}
FROM b_products"""

CTES["s_performance"] = f"""
SELECT upper(trim(performance_id)) AS performance_id, upper(trim(campaign_id)) AS campaign_id, upper(trim(channel_id)) AS channel_id,
  performance_date, impressions, clicks, cost, conversions, revenue,
  clicks <= impressions AS clicks_valid, least(clicks, impressions) AS clicks_capped, conversions <= clicks AS conversions_valid,
  {q4(pct0('clicks', 'impressions'))} AS ctr, {q4(div0('cost', 'clicks'))} AS cpc, {q4(div0('cost', 'conversions'))} AS cpa,
  {q4(pct0('conversions', 'clicks'))} AS conversion_rate, {q4(div0('revenue', 'cost'))} AS roas, {TAIL}
FROM b_performance"""

CTES["s_sales_all"] = f"""
SELECT upper(trim(order_id)) AS order_id, upper(trim(order_line_id)) AS order_line_id, upper(trim(customer_id)) AS customer_id,
  upper(trim(product_id)) AS product_id, upper(trim(campaign_id)) AS campaign_id, order_date, order_timestamp,
  quantity, unit_price, discount_amount, tax_amount, line_total, revenue,
  CAST(CASE WHEN abs(line_total - (quantity * unit_price - discount_amount)) > 0.01
       THEN quantity * unit_price - discount_amount ELSE line_total END AS {MONEY}) AS line_total_validated,
  {q4(pct0('discount_amount', '(quantity * unit_price)'))} AS discount_percent,
  {q4(pct0('discount_amount', '(quantity * unit_price)'))} > 50 AS discount_flag, {TAIL}
FROM b_sales"""

# newest row per order line; ties fall to the largest of the remaining columns
CTES["s_sales"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_line_id ORDER BY last_modified_timestamp DESC,
    order_id DESC, customer_id DESC, product_id DESC, campaign_id DESC NULLS LAST, order_date DESC, order_timestamp DESC,
    quantity DESC, unit_price DESC, discount_amount DESC, tax_amount DESC, line_total DESC, revenue DESC) AS rn
  FROM s_sales_all) WHERE rn = 1"""

CTES["d_date"] = f"""
SELECT CAST(strftime(full_date, '%Y%m%d') AS INT) AS date_key, full_date, year(full_date) AS year, quarter(full_date) AS quarter,
  'Q' || quarter(full_date) AS quarter_name, month(full_date) AS month, monthname(full_date) AS month_name,
  substr(monthname(full_date), 1, 3) AS month_short_name, weekofyear(full_date) AS week_of_year, dayofyear(full_date) AS day_of_year,
  day(full_date) AS day_of_month, isodow(full_date) AS day_of_week, dayname(full_date) AS day_name,
  substr(dayname(full_date), 1, 3) AS day_short_name, isodow(full_date) >= 6 AS is_weekend, FALSE AS is_holiday,
  CAST(NULL AS VARCHAR) AS holiday_name, year(full_date) AS fiscal_year, quarter(full_date) AS fiscal_quarter, month(full_date) AS fiscal_month
FROM (SELECT CAST(unnest(generate_series(
    date_trunc('year', least((SELECT min(o_orderdate) FROM orders), (SELECT min(ts) FROM events))),
    date_trunc('year', greatest((SELECT max(o_orderdate) FROM orders), (SELECT max(ts) FROM events))) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS full_date)"""

SCD2_TAIL = (f"TIMESTAMP '{RUN_TS}' AS valid_from, TIMESTAMP '{OPEN_END}' AS valid_to, TRUE AS is_current, 1 AS version_number, "
             f"TIMESTAMP '{RUN_TS}' AS created_timestamp, TIMESTAMP '{RUN_TS}' AS updated_timestamp")
CAMPAIGN_ATTRS = "campaign_name, campaign_type, status, objective, start_date, end_date, budget, duration_days"
CUSTOMER_ATTRS = "customer_name, email, phone, segment, tier, status, lifetime_value, email_valid, phone_valid"
PRODUCT_ATTRS = "sku, product_name, category, subcategory, brand, product_status, unit_price, cost, margin, margin_percent"

CTES["d_campaign"] = f"""
SELECT {dense('campaign_id')} AS campaign_key, campaign_id, {CAMPAIGN_ATTRS}, source_system, {SCD2_TAIL} FROM s_campaigns"""
CTES["d_customer"] = f"""
SELECT {dense('customer_id')} AS customer_key, customer_id, {CUSTOMER_ATTRS}, source_system, {SCD2_TAIL} FROM s_customers"""
CTES["d_product"] = f"""
SELECT {dense('product_id')} AS product_key, product_id, {PRODUCT_ATTRS}, source_system,
  TIMESTAMP '{RUN_TS}' AS created_timestamp, TIMESTAMP '{RUN_TS}' AS updated_timestamp FROM s_products"""
CTES["d_channel"] = f"""
SELECT {dense('channel_id')} AS channel_key, channel_id, channel_name, channel_type, category AS current_category,
  CAST(NULL AS VARCHAR) AS previous_category, CAST(NULL AS TIMESTAMP) AS category_changed_date, cost_structure, source_system,
  TIMESTAMP '{RUN_TS}' AS created_timestamp, TIMESTAMP '{RUN_TS}' AS updated_timestamp FROM s_channels"""

CTES["f_performance"] = f"""
SELECT performance_id, campaign_key, channel_key, date_key, performance_date, impressions, clicks, conversions, cost, revenue, ctr,
  {q4(div0('cost', 'clicks'))} AS cpc, {q4(div0('cost', 'conversions'))} AS cpa, roas,
  {q4(pct0('conversions', 'impressions'))} AS conversion_rate, TIMESTAMP '{RUN_TS}' AS load_timestamp, p.source_system
FROM s_performance p JOIN d_campaign c ON p.campaign_id = c.campaign_id AND c.is_current
JOIN d_channel h ON p.channel_id = h.channel_id
JOIN d_date ON CAST(strftime(performance_date, '%Y%m%d') AS INT) = date_key"""

CTES["f_sales"] = f"""
SELECT order_id, order_line_id, order_timestamp, order_date, customer_key, product_key, campaign_key, date_key,
  quantity, s.unit_price, discount_amount, tax_amount, line_total, revenue,
  {q4(pct0('discount_amount', 'line_total'))} AS discount_percent, TIMESTAMP '{RUN_TS}' AS load_timestamp, s.source_system
FROM s_sales s JOIN d_customer c ON s.customer_id = c.customer_id AND c.is_current
JOIN d_product p ON s.product_id = p.product_id
LEFT JOIN d_campaign g ON s.campaign_id = g.campaign_id AND g.is_current
JOIN d_date ON CAST(strftime(order_date, '%Y%m%d') AS INT) = date_key"""

CTES["f_campaign_daily"] = f"""
SELECT campaign_key, date_key, CAST(sum(impressions) AS BIGINT) AS total_impressions, CAST(sum(clicks) AS BIGINT) AS total_clicks,
  CAST(sum(conversions) AS BIGINT) AS total_conversions, sum(cost) AS total_cost, sum(revenue) AS total_revenue,
  {q4('CAST(sum(ctr) AS DOUBLE) / count(*)')} AS avg_ctr,
  {q4('avg(CASE WHEN clicks > 0 THEN CAST(cost AS DOUBLE) / clicks ELSE 0 END)')} AS avg_cpc,
  {q4(div0('sum(revenue)', 'sum(cost)'))} AS total_roas,
  {q4(pct0('sum(clicks)', 'sum(impressions)'))} AS total_ctr, {q4(div0('sum(cost)', 'sum(clicks)'))} AS total_cpc,
  count(DISTINCT channel_id) AS channel_count, TIMESTAMP '{RUN_TS}' AS load_timestamp
FROM s_performance p JOIN d_campaign c ON p.campaign_id = c.campaign_id AND c.is_current
JOIN d_date ON CAST(strftime(performance_date, '%Y%m%d') AS INT) = date_key
GROUP BY campaign_key, date_key"""

CTES["v_campaign"] = f"""
SELECT campaign_key AS dim_campaign_sk, campaign_id AS natural_key, campaign_name, campaign_type, start_date AS campaign_start_date,
  end_date AS campaign_end_date, budget AS campaign_budget, status AS campaign_status, objective AS campaign_objective,
  updated_timestamp AS effective_timestamp, date_diff('day', start_date, end_date) + 1 AS campaign_duration_days,
  CASE WHEN DATE '{AS_OF}' BETWEEN start_date AND end_date THEN 'Current' WHEN DATE '{AS_OF}' < start_date THEN 'Future'
       WHEN DATE '{AS_OF}' > end_date THEN 'Past' END AS campaign_period_status,
  CASE WHEN budget >= 100000 THEN 'High Budget' WHEN budget >= 50000 THEN 'Medium Budget' ELSE 'Low Budget' END AS budget_category
FROM d_campaign WHERE is_current"""
CTES["v_customer"] = """
SELECT customer_key AS dim_customer_sk, customer_id AS natural_key, customer_name, email AS customer_email, phone AS customer_phone,
  segment AS customer_segment, tier AS customer_tier, status AS customer_status, lifetime_value AS customer_lifetime_value,
  updated_timestamp AS effective_timestamp,
  CASE tier WHEN 'Platinum' THEN 1 WHEN 'Gold' THEN 2 WHEN 'Silver' THEN 3 WHEN 'Bronze' THEN 4 ELSE 5 END AS tier_rank,
  CASE WHEN lifetime_value >= 20000 THEN 'VIP' WHEN lifetime_value >= 10000 THEN 'Premium'
       WHEN lifetime_value >= 5000 THEN 'Standard' ELSE 'Basic' END AS value_category,
  status = 'Active' AS is_active_customer
FROM d_customer WHERE is_current"""
CTES["v_product"] = """
SELECT product_key AS dim_product_sk, product_id AS natural_key, sku AS product_sku, product_name, category AS product_category,
  subcategory AS product_subcategory, brand AS product_brand, unit_price AS product_price, cost AS product_cost,
  margin AS product_margin, margin_percent AS product_margin_percent, product_status, updated_timestamp AS effective_timestamp,
  CASE WHEN margin_percent >= 50 THEN 'High Margin' WHEN margin_percent >= 30 THEN 'Medium Margin' ELSE 'Low Margin' END AS margin_category,
  CASE WHEN unit_price >= 200 THEN 'Premium' WHEN unit_price >= 100 THEN 'Mid-Range' ELSE 'Budget' END AS price_tier
FROM d_product"""
CTES["v_channel"] = """
SELECT channel_key AS dim_channel_sk, channel_id AS natural_key, channel_name, channel_type, current_category AS channel_category,
  cost_structure, updated_timestamp AS effective_timestamp,
  CASE WHEN channel_type IN ('Paid Search', 'Display', 'Social') THEN 'Digital Paid'
       WHEN channel_type IN ('Email', 'Organic Search', 'Direct') THEN 'Digital Owned' ELSE 'Other' END AS channel_classification
FROM d_channel"""
CTES["v_sales"] = """
SELECT customer_key AS dim_customer_sk, product_key AS dim_product_sk, campaign_key AS dim_campaign_sk, date_key AS dim_date_sk,
  CAST(strftime(order_timestamp, '%H%M%S') AS INT) AS dim_time_sk, quantity, unit_price, discount_amount, tax_amount, line_total, revenue,
  order_id, order_line_id, order_timestamp AS transaction_timestamp
FROM f_sales"""
CTES["v_performance"] = """
SELECT campaign_key AS dim_campaign_sk, channel_key AS dim_channel_sk, date_key AS dim_date_sk, impressions, clicks, cost,
  conversions, revenue, ctr, cpc, roas, performance_id, performance_date
FROM f_performance"""

CTES["q_rfm_base"] = f"""
SELECT customer_id, date_diff('day', max(order_date), DATE '{AS_OF_SALES}') AS recency_days, count(DISTINCT order_id) AS frequency,
  sum(revenue) AS monetary
FROM f_sales f JOIN d_customer c ON f.customer_key = c.customer_key GROUP BY ALL"""

# ---- two states of the dimensions -------------------------------------------------------------------
FIRST_LOADS = "2024-02-02 00:00:00"
RUN_CAMPAIGN1, RUN_CAMPAIGN2 = "2023-11-01 00:00:00", CHANGE_TS

CTES["c1_customers"] = f"""
SELECT customer_id, {CUSTOMER_ATTRS}, source_system FROM s_customers WHERE source_load_timestamp <= TIMESTAMP '{FIRST_LOADS}'"""
CTES["c2_customers"] = f"""
SELECT customer_id, customer_name, email, phone, segment,
  CASE WHEN segment = 'MACHINERY' THEN CASE tier WHEN 'Standard' THEN 'Bronze' WHEN 'Bronze' THEN 'Silver' WHEN 'Silver' THEN 'Gold'
       ELSE 'Platinum' END ELSE tier END AS tier,
  status, lifetime_value, email_valid, phone_valid, source_system FROM s_customers WHERE status <> 'Churned'"""
CTES["c1_campaigns"] = f"""
SELECT campaign_id, {CAMPAIGN_ATTRS}, source_system FROM s_campaigns WHERE source_load_timestamp <= TIMESTAMP '{FIRST_LOADS}'"""
CTES["c2_campaigns"] = f"""
SELECT campaign_id, campaign_name, campaign_type, status, objective, start_date, end_date,
  CAST(CASE WHEN campaign_type = 'Conversion' THEN budget * 1.1 ELSE budget END AS {MONEY}) AS budget, duration_days, source_system
FROM s_campaigns WHERE status <> 'Paused'"""


def _versions(entity: str, attrs: str, run1: str, run2: str) -> None:
    key, ident, names = f"{entity}_key", f"{entity}_id", [a.strip() for a in attrs.split(",")]
    one, two, src = f"d1_{entity}", f"d2_{entity}", f"c2_{entity}s"
    same = " AND ".join(f"d.{a} IS NOT DISTINCT FROM s.{a}" for a in names)
    s_attrs = ", ".join(f"s.{a}" for a in names)
    d_attrs = ", ".join(f"d.{a}" for a in names)
    CTES[one] = f"""
SELECT {dense(ident)} AS {key}, {ident}, {attrs}, source_system, TIMESTAMP '{run1}' AS valid_from, TIMESTAMP '{OPEN_END}' AS valid_to,
  TRUE AS is_current, 1 AS version_number, TIMESTAMP '{run1}' AS created_timestamp, TIMESTAMP '{run1}' AS updated_timestamp
FROM c1_{entity}s"""
    CTES[two] = f"""
SELECT d.{key}, d.{ident}, {d_attrs}, d.source_system, d.valid_from,
  CASE WHEN s.{ident} IS NOT NULL AND NOT ({same}) THEN TIMESTAMP '{run2}' ELSE d.valid_to END AS valid_to,
  s.{ident} IS NULL OR ({same}) AS is_current, d.version_number, d.created_timestamp,
  CASE WHEN s.{ident} IS NOT NULL AND NOT ({same}) THEN TIMESTAMP '{run2}' ELSE d.updated_timestamp END AS updated_timestamp
FROM {one} d LEFT JOIN {src} s ON d.{ident} = s.{ident}
UNION ALL
SELECT (SELECT max({key}) FROM {one}) + row_number() OVER (ORDER BY substr(md5(s.{ident}), 1, 4), s.{ident}), s.{ident}, {s_attrs}, s.source_system,
  TIMESTAMP '{run2}', TIMESTAMP '{OPEN_END}', TRUE, coalesce(d.version_number, 0) + 1,
  coalesce(d.created_timestamp, TIMESTAMP '{run2}'), TIMESTAMP '{run2}'
FROM {src} s LEFT JOIN {one} d ON d.{ident} = s.{ident} WHERE d.{ident} IS NULL OR NOT ({same})"""


_versions("customer", CUSTOMER_ATTRS, RUN_TS, RUN_TS2)
_versions("campaign", CAMPAIGN_ATTRS, RUN_CAMPAIGN1, RUN_CAMPAIGN2)

CTES["c2_channels"] = """
SELECT channel_id, channel_name, channel_type, CASE WHEN cost_structure = 'CPC' THEN 'Partner' ELSE category END AS category,
  cost_structure, source_system FROM s_channels"""
CTES["d2_channel"] = f"""
SELECT channel_key, d.channel_id, s.channel_name, s.channel_type, s.category AS current_category,
  CASE WHEN s.category IS DISTINCT FROM d.current_category THEN d.current_category ELSE d.previous_category END AS previous_category,
  CASE WHEN s.category IS DISTINCT FROM d.current_category THEN TIMESTAMP '{RUN_TS2}' ELSE d.category_changed_date END AS category_changed_date,
  s.cost_structure, s.source_system, d.created_timestamp, TIMESTAMP '{RUN_TS2}' AS updated_timestamp
FROM d_channel d JOIN c2_channels s ON d.channel_id = s.channel_id"""
