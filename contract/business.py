"""The business queries."""

from __future__ import annotations

from tidemark.plans import analytics as an
from tidemark.plans.star import gold, silver_table, stored_silver

from .ctes import AS_OF, AS_OF_SALES, div, pct, rnd
from .registry import query

PERF = "f_performance f JOIN v_campaign c ON f.campaign_key = c.dim_campaign_sk"
PERF_CH = "f_performance f JOIN v_channel h ON f.channel_key = h.dim_channel_sk"
DAY = "JOIN d_date d ON f.date_key = d.date_key"
BIG = "CAST(sum({0}) AS BIGINT)"


def total(c: str) -> str:
    return f"CAST(sum({c}) AS BIGINT)"


ROAS = rnd(div("sum(f.revenue)", "sum(f.cost)"), 2)
CTR = rnd(pct("sum(clicks)", "sum(impressions)"), 2)


@query("q_top_campaigns_roas", f"""
SELECT campaign_name, campaign_type, channel_name, {total('impressions')} AS total_impressions, {total('clicks')} AS total_clicks,
  sum(cost) AS total_cost, sum(revenue) AS total_revenue, {ROAS} AS roas, {CTR} AS ctr_percent
FROM {PERF} JOIN v_channel h ON f.channel_key = h.dim_channel_sk {DAY}
WHERE full_date >= DATE '{AS_OF}' - 90 GROUP BY ALL HAVING sum(cost) >= 1000
ORDER BY roas DESC NULLS LAST, campaign_name, campaign_type, channel_name LIMIT 10""", "total_cost total_revenue")
def q_top_campaigns_roas(spark, sf):
    return an.top_campaigns_roas(gold(spark, sf), AS_OF)


@query("q_budget_vs_actual", f"""
SELECT campaign_name, campaign_budget, campaign_start_date, campaign_end_date, campaign_duration_days,
  date_diff('day', campaign_start_date, DATE '{AS_OF}') AS days_elapsed, spend AS actual_spend,
  {rnd(pct('spend', 'campaign_budget'), 2)} AS spend_percent, campaign_budget - spend AS remaining_budget,
  CASE WHEN spend > campaign_budget * 1.1 THEN '🔴 Over Budget'
       WHEN spend < campaign_budget * 0.5 AND campaign_period_status = 'Current' THEN '🟡 Under Pacing'
       WHEN campaign_period_status = 'Current' THEN '🟢 On Track' ELSE '⚪ Ended' END AS status
FROM (SELECT campaign_name, campaign_budget, campaign_start_date, campaign_end_date, campaign_duration_days, campaign_period_status,
        sum(cost) AS spend
      FROM v_campaign LEFT JOIN f_performance ON campaign_key = dim_campaign_sk
      WHERE campaign_period_status IN ('Current', 'Past') GROUP BY ALL)
ORDER BY actual_spend DESC NULLS LAST, campaign_name, campaign_start_date, campaign_budget LIMIT 20""",
       "campaign_budget actual_spend remaining_budget", "campaign_start_date campaign_end_date")
def q_budget_vs_actual(spark, sf):
    return an.budget_vs_actual(gold(spark, sf), AS_OF)


@query("q_weekly_trend", f"""
SELECT campaign_name, d.year, week_of_year AS week, month_name, count(DISTINCT f.date_key) AS days_active,
  {total('impressions')} AS weekly_impressions, {total('clicks')} AS weekly_clicks, sum(cost) AS weekly_cost,
  sum(revenue) AS weekly_revenue, {ROAS} AS weekly_roas
FROM {PERF} {DAY} WHERE full_date >= DATE '{AS_OF}' - 60 GROUP BY ALL""", "weekly_cost weekly_revenue")
def q_weekly_trend(spark, sf):
    return an.weekly_trend(gold(spark, sf), AS_OF)


@query("q_channel_comparison", f"""
SELECT channel_name, channel_type, channel_category, channel_classification, count(DISTINCT campaign_key) AS unique_campaigns,
  {total('impressions')} AS total_impressions, {total('clicks')} AS total_clicks, {CTR} AS avg_ctr, sum(cost) AS total_cost,
  {rnd(div('sum(cost)', 'sum(clicks)'), 2)} AS avg_cpc, sum(revenue) AS total_revenue, {ROAS} AS roas
FROM {PERF_CH} GROUP BY ALL""", "total_cost total_revenue")
def q_channel_comparison(spark, sf):
    return an.channel_comparison(gold(spark, sf))


@query("q_channel_mix", f"""
SELECT year, month, month_name, channel_name, spend AS monthly_spend,
  {rnd(pct('spend', 'sum(spend) OVER (PARTITION BY year, month)'), 2)} AS spend_share_percent
FROM (SELECT year, month, month_name, channel_name, sum(cost) AS spend FROM {PERF_CH} {DAY}
      WHERE full_date >= DATE '{AS_OF}' - INTERVAL 6 MONTH GROUP BY ALL)""", "monthly_spend")
def q_channel_mix(spark, sf):
    return an.channel_mix(gold(spark, sf), AS_OF)


_BEST = f"""
SELECT campaign_type, channel_name, campaign_count, total_cost, total_revenue, {rnd('ratio', 2)} AS roas, roas_rank
FROM (SELECT *, rank() OVER (PARTITION BY campaign_type ORDER BY ratio DESC NULLS LAST) AS roas_rank
  FROM (SELECT campaign_type, channel_name, count(DISTINCT f.campaign_key) AS campaign_count, sum(cost) AS total_cost,
          sum(revenue) AS total_revenue, {div('sum(revenue)', 'sum(cost)')} AS ratio
        FROM {PERF} JOIN v_channel h ON f.channel_key = h.dim_channel_sk GROUP BY ALL))
WHERE roas_rank <= 3"""


@query("q_best_channel_by_type", _BEST, "total_cost total_revenue")
def q_best_channel_by_type(spark, sf):
    return an.best_channel_by_type(gold(spark, sf), AS_OF)


_SEGMENTS = f"""
SELECT customer_segment, customer_tier, value_category, customer_count, {rnd(div('ltv', 'customer_count'), 2)} AS avg_ltv,
  ltv AS total_ltv, {rnd(pct('customer_count', 'sum(customer_count) OVER ()'), 2)} AS customer_percent,
  {rnd(pct('ltv', 'sum(ltv) OVER ()'), 2)} AS ltv_percent
FROM (SELECT customer_segment, customer_tier, value_category, count(*) AS customer_count, sum(customer_lifetime_value) AS ltv
      FROM v_customer WHERE is_active_customer GROUP BY ALL)"""


@query("q_customer_segments", _SEGMENTS, "total_ltv")
def q_customer_segments(spark, sf):
    return an.customer_segments(gold(spark, sf))


@query("q_top_customers", f"""
SELECT customer_name, customer_email, customer_segment, customer_tier, customer_lifetime_value,
  count(DISTINCT order_id) AS orders_12mo, {total('quantity')} AS units_purchased, sum(revenue) AS revenue_12mo,
  {rnd(div('sum(revenue)', 'count(*)'), 2)} AS avg_order_value
FROM f_sales f JOIN v_customer c ON f.customer_key = c.dim_customer_sk {DAY}
WHERE full_date >= DATE '{AS_OF_SALES}' - INTERVAL 12 MONTH GROUP BY ALL
ORDER BY revenue_12mo DESC, customer_email NULLS FIRST, customer_name LIMIT 20""", "customer_lifetime_value revenue_12mo")
def q_top_customers(spark, sf):
    return an.top_customers(gold(spark, sf), AS_OF_SALES)


@query("q_tier_patterns", f"""
SELECT customer_tier, tier_rank, count(DISTINCT dim_customer_sk) AS unique_customers, count(DISTINCT order_id) AS total_orders,
  {rnd(div('count(DISTINCT order_id)', 'count(DISTINCT dim_customer_sk)'), 2)} AS orders_per_customer,
  {rnd(div('sum(revenue)', 'count(*)'), 2)} AS avg_order_value, sum(revenue) AS total_revenue,
  {rnd(div('sum(revenue)', 'count(DISTINCT dim_customer_sk)'), 2)} AS revenue_per_customer
FROM f_sales f JOIN v_customer c ON f.customer_key = c.dim_customer_sk GROUP BY ALL""", "total_revenue")
def q_tier_patterns(spark, sf):
    return an.tier_patterns(gold(spark, sf))


PROD = "f_sales f JOIN v_product p ON f.product_key = p.dim_product_sk"


@query("q_top_products", f"""
SELECT product_name, product_category, product_brand, margin_category, price_tier, count(DISTINCT order_id) AS times_ordered,
  {total('quantity')} AS units_sold, {rnd(div('sum(unit_price)', 'count(*)'), 2)} AS avg_selling_price, sum(revenue) AS total_revenue,
  {rnd(div('sum(revenue)', 'sum(quantity)'), 2)} AS revenue_per_unit
FROM {PROD} GROUP BY ALL ORDER BY total_revenue DESC, product_name, product_category, product_brand LIMIT 20""", "total_revenue")
def q_top_products(spark, sf):
    return an.top_products(gold(spark, sf))


CATEGORY = f"""
SELECT product_category, unique_products, total_orders, units_sold, revenue AS total_revenue,
  {rnd(div('revenue', 'lines'), 2)} AS avg_order_line_value, {rnd(pct('revenue', 'sum(revenue) OVER ()'), 2)} AS revenue_percent
FROM (SELECT product_category, count(DISTINCT dim_product_sk) AS unique_products, count(DISTINCT order_id) AS total_orders,
        {total('quantity')} AS units_sold, sum(revenue) AS revenue, count(*) AS lines FROM {PROD} GROUP BY ALL)"""


@query("q_category_analysis", CATEGORY, "total_revenue")
def q_category_analysis(spark, sf):
    return an.category_analysis(gold(spark, sf))


@query("q_margin_vs_volume", f"""
SELECT product_name, margin_category, product_margin_percent, {total('quantity')} AS units_sold, sum(revenue) AS total_revenue,
  sum(revenue) - sum(quantity * product_cost) AS gross_profit,
  CASE WHEN product_margin_percent >= 40 AND sum(quantity) >= 100 THEN '🟢 Star Product'
       WHEN product_margin_percent >= 40 THEN '🟡 High Margin, Low Volume'
       WHEN sum(quantity) >= 100 THEN '🟠 Low Margin, High Volume' ELSE '⚪ Average' END AS product_classification
FROM {PROD} GROUP BY product_name, margin_category, product_margin_percent, product_cost HAVING sum(quantity) > 0
ORDER BY gross_profit DESC, product_name, product_margin_percent LIMIT 30""", "product_margin_percent total_revenue gross_profit")
def q_margin_vs_volume(spark, sf):
    return an.margin_vs_volume(gold(spark, sf))


@query("q_daily_sales", f"""
SELECT full_date, day_name, is_weekend, count(DISTINCT order_id) AS total_orders, count(*) AS total_line_items,
  {total('quantity')} AS units_sold, sum(revenue) AS daily_revenue, {rnd(div('sum(revenue)', 'count(*)'), 2)} AS avg_line_value,
  {rnd(div('sum(revenue)', 'count(DISTINCT order_id)'), 2)} AS avg_order_value
FROM f_sales f {DAY} WHERE full_date >= DATE '{AS_OF_SALES}' - 30 GROUP BY ALL""", "daily_revenue", "full_date")
def q_daily_sales(spark, sf):
    return an.daily_sales(gold(spark, sf), AS_OF_SALES)


_MONTHLY = f"""SELECT year, month, month_name, count(DISTINCT order_id) AS orders, sum(revenue) AS revenue FROM f_sales f {DAY} GROUP BY ALL"""


def _yoy(source: str) -> str:
    return f"""
SELECT year AS current_year, month, month_name, orders AS current_orders, revenue AS current_revenue, prior_year_orders,
  prior_year_revenue, orders - prior_year_orders AS orders_yoy_change, revenue - prior_year_revenue AS revenue_yoy_change,
  {rnd(pct('(revenue - prior_year_revenue)', 'prior_year_revenue'), 2)} AS revenue_yoy_growth_percent
FROM ({source})"""


@query("q_monthly_yoy", _yoy(f"""SELECT *, lag(orders, 12) OVER (ORDER BY year, month) AS prior_year_orders,
  lag(revenue, 12) OVER (ORDER BY year, month) AS prior_year_revenue FROM ({_MONTHLY})"""),
       "current_revenue prior_year_revenue revenue_yoy_change")
def q_monthly_yoy(spark, sf):
    return an.monthly_yoy(gold(spark, sf))


@query("q_monthly_yoy_by_month", _yoy(f"""SELECT a.*, b.orders AS prior_year_orders, b.revenue AS prior_year_revenue
  FROM ({_MONTHLY}) a LEFT JOIN ({_MONTHLY}) b ON a.year = b.year + 1 AND a.month = b.month"""),
       "current_revenue prior_year_revenue revenue_yoy_change")
def q_monthly_yoy_by_month(spark, sf):
    return an.monthly_yoy_by_month(gold(spark, sf))


_WEEKDAY = f"""
SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type, day_name, total_orders, revenue AS total_revenue,
  {rnd(div('revenue', 'lines'), 2)} AS avg_line_value, {rnd(pct('total_orders', 'sum(total_orders) OVER ()'), 2)} AS order_percent,
  {rnd(pct('revenue', 'sum(revenue) OVER ()'), 2)} AS revenue_percent
FROM (SELECT is_weekend, day_name, count(DISTINCT order_id) AS total_orders, sum(revenue) AS revenue, count(*) AS lines
      FROM f_sales f {DAY} WHERE full_date >= DATE '{AS_OF_SALES}' - 90 GROUP BY ALL)"""


@query("q_weekday_weekend", _WEEKDAY, "total_revenue")
def q_weekday_weekend(spark, sf):
    return an.weekday_weekend(gold(spark, sf), AS_OF_SALES)


@query("q_executive_summary", f"""
SELECT 'MARKETING PERFORMANCE' AS metric_category, {total('impressions')} AS total_impressions, {total('clicks')} AS total_clicks,
  {CTR} AS overall_ctr, CAST(sum(cost) AS DOUBLE) AS marketing_spend, {total('conversions')} AS total_conversions,
  {rnd(div('sum(cost)', 'sum(conversions)'), 2)} AS cost_per_conversion, CAST(sum(revenue) AS DOUBLE) AS marketing_revenue, {ROAS} AS roas
FROM f_performance f WHERE performance_date >= DATE '{AS_OF}' - 30
UNION ALL
SELECT 'SALES PERFORMANCE', count(DISTINCT order_id), count(*), NULL, NULL, NULL, NULL, CAST(sum(revenue) AS DOUBLE),
  {rnd(div('sum(revenue)', 'count(DISTINCT order_id)'), 2)}
FROM f_sales WHERE order_date >= DATE '{AS_OF}' - 30""")
def q_executive_summary(spark, sf):
    return an.executive_summary(gold(spark, sf), AS_OF)


def _top5(label: str, name: str, metric: str, source: str) -> str:
    return f"""SELECT * FROM (SELECT '{label}' AS category, {name} AS name, CAST({metric} AS DOUBLE) AS metric FROM {source}
  GROUP BY {name} ORDER BY metric DESC NULLS LAST, name LIMIT 5)"""


@query("q_top5_everything", "\nUNION ALL\n".join([
    _top5("Top 5 Campaigns by ROAS", "campaign_name", ROAS, PERF),
    _top5("Top 5 Channels by Revenue", "channel_name", "sum(revenue)", PERF_CH),
    _top5("Top 5 Products by Revenue", "product_name", "sum(revenue)", PROD),
    _top5("Top 5 Customers by Revenue", "customer_name", "sum(revenue)",
          "f_sales f JOIN v_customer c ON f.customer_key = c.dim_customer_sk")]))
def q_top5_everything(spark, sf):
    return an.top5_everything(gold(spark, sf), AS_OF)


@query("q_channel_roas_3m", f"""
SELECT channel_name, sum(cost) AS total_cost, sum(revenue) AS total_revenue, {ROAS} AS roas
FROM {PERF_CH} WHERE performance_date >= DATE '{AS_OF}' - INTERVAL 3 MONTH GROUP BY ALL""", "total_cost total_revenue")
def q_channel_roas_3m(spark, sf):
    return an.channel_roas(gold(spark, sf), AS_OF)


@query("q_tier_segment_ltv", f"""
SELECT tier, segment, count(*) AS customer_count, {rnd(div('sum(lifetime_value)', 'count(*)'), 2)} AS avg_ltv, sum(lifetime_value) AS total_ltv
FROM s_customers WHERE status = 'Active' GROUP BY ALL""", "total_ltv")
def q_tier_segment_ltv(spark, sf):
    return an.tier_segment_ltv(silver_table(spark, sf, "customers"))


@query("q_daily_sales_silver", f"""
SELECT order_date, count(DISTINCT order_id) AS total_orders, count(*) AS total_line_items, {total('quantity')} AS total_units,
  sum(revenue) AS total_revenue, {rnd(div('sum(revenue)', 'count(*)'), 2)} AS avg_line_value
FROM s_sales WHERE order_date >= DATE '{AS_OF_SALES}' - 30 GROUP BY ALL""", "total_revenue", "order_date")
def q_daily_sales_silver(spark, sf):
    return an.daily_sales_silver(stored_silver(spark, sf).silver("sales"), AS_OF_SALES)


@query("q_top_campaigns_silver", f"""
SELECT campaign_name, campaign_type, count(*) AS days_running, sum(cost) AS total_cost, sum(revenue) AS total_revenue, {ROAS} AS roas
FROM s_performance f JOIN s_campaigns c ON f.campaign_id = c.campaign_id GROUP BY ALL HAVING sum(cost) > 1000
ORDER BY roas DESC NULLS LAST, campaign_name, campaign_type LIMIT 10""", "total_cost total_revenue")
def q_top_campaigns_silver(spark, sf):
    return an.top_campaigns_silver(stored_silver(spark, sf).silver("performance"), stored_silver(spark, sf).silver("campaigns"))


@query("q_channels_silver", f"""
SELECT channel_name, channel_type, count(*) AS days_active, {total('impressions')} AS total_impressions, {total('clicks')} AS total_clicks,
  {CTR} AS ctr, sum(cost) AS total_cost, sum(revenue) AS total_revenue, {ROAS} AS roas
FROM s_performance f JOIN s_channels c ON f.channel_id = c.channel_id GROUP BY ALL""", "total_cost total_revenue")
def q_channels_silver(spark, sf):
    return an.channels_silver(stored_silver(spark, sf).silver("performance"), stored_silver(spark, sf).silver("channels"))


@query("q_customers_by_ltv", """
SELECT customer_id, customer_name, email, segment, tier, lifetime_value FROM s_customers
ORDER BY lifetime_value DESC, customer_id LIMIT 20""", "lifetime_value")
def q_customers_by_ltv(spark, sf):
    return an.customers_by_ltv(stored_silver(spark, sf).silver("customers"))


@query("q_campaigns_by_budget", """
SELECT campaign_id, campaign_name, campaign_type, status, budget, start_date, end_date,
  date_diff('day', start_date, end_date) AS duration_days FROM s_campaigns ORDER BY budget DESC, campaign_id LIMIT 10""",
       "budget", "start_date end_date")
def q_campaigns_by_budget(spark, sf):
    return an.campaigns_by_budget(stored_silver(spark, sf).silver("campaigns"))


@query("q_campaign_status", f"""
SELECT status, count(*) AS campaign_count, sum(budget) AS total_budget, {rnd(div('sum(budget)', 'count(*)'), 2)} AS avg_budget
FROM s_campaigns GROUP BY ALL""", "total_budget")
def q_campaign_status(spark, sf):
    return an.campaign_status(stored_silver(spark, sf).silver("campaigns"))


@query("q_products_by_margin", """
SELECT product_id, product_name, category, brand, unit_price, cost, margin, margin_percent FROM s_products
WHERE product_status = 'Active' ORDER BY margin_percent DESC, product_id LIMIT 10""", "unit_price cost margin margin_percent")
def q_products_by_margin(spark, sf):
    return an.products_by_margin(stored_silver(spark, sf).silver("products"))


@query("q_category_profit", f"""
SELECT category, count(*) AS product_count, {rnd(div('sum(unit_price)', 'count(*)'), 2)} AS avg_price,
  {rnd(div('sum(margin_percent)', 'count(*)'), 2)} AS avg_margin_pct
FROM s_products WHERE product_status = 'Active' GROUP BY ALL""")
def q_category_profit(spark, sf):
    return an.category_profit(stored_silver(spark, sf).silver("products"))


@query("q_top_selling_products", f"""
SELECT f.product_id, product_name, category, count(*) AS order_count, {total('quantity')} AS total_quantity, sum(revenue) AS total_revenue
FROM s_sales f JOIN s_products p ON f.product_id = p.product_id GROUP BY ALL ORDER BY total_revenue DESC, f.product_id LIMIT 10""",
       "total_revenue")
def q_top_selling_products(spark, sf):
    return an.top_selling_products(stored_silver(spark, sf).silver("sales"), stored_silver(spark, sf).silver("products"))


@query("q_silver_daily_volume", """
SELECT CAST(source_load_timestamp AS DATE) AS load_date, count(*) AS records_loaded FROM s_performance GROUP BY ALL
ORDER BY load_date DESC LIMIT 7""", text="load_date")
def q_silver_daily_volume(spark, sf):
    loaded = stored_silver(spark, sf).silver("performance").select("source_load_timestamp").withColumnRenamed(
        "source_load_timestamp", "load_timestamp")
    return an.silver_daily_volume(loaded)


def _score(value: str, up: bool) -> str:
    below = " + ".join(f"CAST({value} > c_{value}[{i}] AS INT)" for i in (1, 2, 3, 4))
    return f"{below} + 1" if up else f"5 - ({below})"


@query("q_rfm", f"""
SELECT customer_id, recency_days, frequency, monetary, r_score, f_score, m_score,
  CASE WHEN recency_days > 365 THEN 'Lost' WHEN recency_days >= 180 THEN 'At Risk'
       WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
       WHEN f_score >= 3 AND m_score >= 3 THEN 'Loyal' ELSE 'Regular' END AS rfm_segment
FROM (SELECT customer_id, recency_days, frequency, monetary, {_score('recency_days', False)} AS r_score,
        {_score('frequency', True)} AS f_score, {_score('monetary', True)} AS m_score
  FROM (SELECT *, (SELECT quantile_disc(recency_days, [0.2, 0.4, 0.6, 0.8]) FROM q_rfm_base) AS c_recency_days,
          (SELECT quantile_disc(frequency, [0.2, 0.4, 0.6, 0.8]) FROM q_rfm_base) AS c_frequency,
          (SELECT quantile_disc(monetary, [0.2, 0.4, 0.6, 0.8]) FROM q_rfm_base) AS c_monetary
        FROM q_rfm_base))""", "monetary")
def q_rfm(spark, sf):
    return an.rfm(gold(spark, sf), AS_OF_SALES)


@query("q_campaign_pacing", f"""
SELECT campaign_id, full_date, campaign_day, spend_to_date, revenue_to_date, budget_percent, target_percent, due_percent,
  CASE WHEN budget_percent >= 120 THEN 'Red' WHEN target_percent <= due_percent - 10 THEN 'Yellow' ELSE 'Green' END AS pacing_status
FROM (SELECT natural_key AS campaign_id, full_date, date_diff('day', campaign_start_date, full_date) + 1 AS campaign_day,
        spend_to_date, revenue_to_date, {rnd(pct('spend_to_date', 'campaign_budget'), 2)} AS budget_percent,
        {rnd(pct('revenue_to_date', '(campaign_budget * 3)'), 2)} AS target_percent,
        {rnd(pct("least(date_diff('day', campaign_start_date, full_date) + 1, campaign_duration_days)", 'campaign_duration_days'), 2)} AS due_percent
      FROM (SELECT campaign_key, date_key, sum(total_cost) OVER w AS spend_to_date, sum(total_revenue) OVER w AS revenue_to_date
            FROM f_campaign_daily WINDOW w AS (PARTITION BY campaign_key ORDER BY date_key ROWS UNBOUNDED PRECEDING)) f
      JOIN v_campaign ON campaign_key = dim_campaign_sk {DAY}
      WHERE date_diff('day', campaign_start_date, full_date) + 1 >= 1)""", "spend_to_date revenue_to_date", "full_date")
def q_campaign_pacing(spark, sf):
    return an.campaign_pacing(gold(spark, sf), AS_OF)
