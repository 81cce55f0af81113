"""Cleansing, dimensions, facts and views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import calendar as cal, silver
from tidemark.operators import facts
from tidemark.plans import star as plans, views
from tidemark.plans.star import Star, gold, silver_table
from tidemark.sources import entities

from .ctes import AS_OF, CTES, RUN_TS, div0, pct0, q4
from .registry import query

STAMPS = "last_modified_timestamp source_load_timestamp load_timestamp"

_SILVER = {
    "campaigns": ("s_campaigns", "budget", f"start_date end_date {STAMPS}"),
    "channels": ("s_channels", "", STAMPS),
    "customers": ("s_customers", "lifetime_value", STAMPS),
    "products": ("s_products", "unit_price cost margin margin_percent", STAMPS),
    "performance": ("s_performance", "cost revenue ctr cpc cpa conversion_rate roas", f"performance_date {STAMPS}"),
    "sales": ("s_sales", "unit_price discount_amount tax_amount line_total revenue line_total_validated discount_percent",
              f"order_date order_timestamp {STAMPS}"),
}
for _name, (_cte, _double, _text) in _SILVER.items():
    query(f"silver_{_name}", f"SELECT * FROM {_cte}", _double, _text)(
        lambda spark, sf, name=_name: silver_table(spark, sf, name))


@query("performance_thresholds", f"""
SELECT performance_id, impressions, clicks, clicks AS clicks_capped,
  CASE WHEN impressions > 50 THEN least(CAST({q4(pct0('clicks', 'impressions'))} AS DOUBLE), 25) ELSE 0 END AS ctr
FROM b_performance""", "ctr")
def performance_thresholds(spark, sf):
    """Click validation off, ctr from 51 impressions on, capped at 25 %."""
    out = silver.performance(entities.performance(spark, sf), RUN_TS, click_validation=False, min_impressions=50, max_ctr=25)
    return out.select("performance_id", "impressions", "clicks", "clicks_capped", "ctr")


@query("product_margin", f"""
SELECT product_id, unit_price, cost, unit_price - cost AS margin,
  {q4(pct0('(unit_price - cost)', 'unit_price'))} AS margin_percent FROM s_products""", "unit_price cost margin margin_percent")
def product_margin(spark, sf):
    return silver.product_margin(silver_table(spark, sf, "products"))


@query("dim_date", """
SELECT * FROM d_date WHERE year BETWEEN (SELECT year(min(o_orderdate)) FROM orders) AND (SELECT year(max(ts)) FROM events)""", text="full_date")
def dim_date(spark, sf):
    """Whole years from the first order to the last event."""
    first = entities.table(spark, sf, "orders").agg(F.trunc(F.to_date(F.min("o_orderdate")), "year")).scalar()
    last = entities.table(spark, sf, "events").agg(
        F.date_sub(F.add_months(F.trunc(F.to_date(F.max("ts")), "year"), 12), 1)).scalar()
    return cal.dim_date(spark, first, last)


SCD2_TEXT = "valid_from valid_to created_timestamp updated_timestamp"


@query("scd2_initial", "SELECT * FROM d_customer", "lifetime_value", SCD2_TEXT)
def scd2_initial(spark, sf):
    return Star(spark, sf).dim_customer


@query("dim_campaign", "SELECT * FROM d_campaign", "budget", f"start_date end_date {SCD2_TEXT}")
def dim_campaign(spark, sf):
    return Star(spark, sf).dim_campaign


@query("dim_product", "SELECT * FROM d_product", "unit_price cost margin margin_percent", "created_timestamp updated_timestamp")
def dim_product(spark, sf):
    return Star(spark, sf).dim_product


@query("dim_channel", "SELECT * FROM d_channel", text="category_changed_date created_timestamp updated_timestamp")
def dim_channel(spark, sf):
    return Star(spark, sf).dim_channel


@query("fact_performance", "SELECT * FROM f_performance", "cost revenue ctr cpc cpa roas conversion_rate",
       "performance_date load_timestamp")
def fact_performance(spark, sf):
    star = gold(spark, sf)
    return facts.fact_performance(star.silver("performance"), star.dim_campaign, star.dim_channel, star.dim_date, star.run_ts)


@query("fact_sales", "SELECT * FROM f_sales",
       "unit_price discount_amount tax_amount line_total revenue discount_percent",
       "order_timestamp order_date load_timestamp")
def fact_sales(spark, sf):
    return gold(spark, sf).fact_sales.drop("month_key")


@query("fact_campaign_daily", "SELECT * FROM f_campaign_daily",
       "total_cost total_revenue avg_ctr avg_cpc total_roas total_ctr total_cpc", "load_timestamp")
def fact_campaign_daily(spark, sf):
    star = gold(spark, sf)
    return facts.fact_campaign_daily(star.silver("performance"), star.dim_campaign, star.dim_date, star.run_ts)


@query("view_dim_campaign", "SELECT * FROM v_campaign", "campaign_budget",
       "campaign_start_date campaign_end_date effective_timestamp")
def view_dim_campaign(spark, sf):
    return gold(spark, sf).v_campaign(AS_OF)


@query("view_dim_customer", "SELECT * FROM v_customer", "customer_lifetime_value", "effective_timestamp")
def view_dim_customer(spark, sf):
    return gold(spark, sf).v_customer


@query("view_dim_product", "SELECT * FROM v_product",
       "product_price product_cost product_margin product_margin_percent", "effective_timestamp")
def view_dim_product(spark, sf):
    return gold(spark, sf).v_product


@query("view_dim_channel", "SELECT * FROM v_channel", text="effective_timestamp")
def view_dim_channel(spark, sf):
    return gold(spark, sf).v_channel


@query("view_fact_sales", "SELECT * FROM v_sales", "unit_price discount_amount tax_amount line_total revenue",
       "transaction_timestamp")
def view_fact_sales(spark, sf):
    return views.sales(gold(spark, sf).fact_sales)


@query("view_fact_performance", "SELECT * FROM v_performance", "cost revenue ctr cpc roas", "performance_date")
def view_fact_performance(spark, sf):
    return views.performance(gold(spark, sf).fact_performance)
