"""The semantic layer: star tables under the names the analytic queries use."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.expressions import day, rank_of, time_key
from ..operators.lookups import current

# Tiers in rank order, channel types of each class, lower bounds and labels of the bands.
TIERS = ["Platinum", "Gold", "Silver", "Bronze"]
PAID_TYPES = ["Paid Search", "Display", "Social"]
OWNED_TYPES = ["Email", "Organic Search", "Direct"]
BUDGET_BANDS, BUDGET_REST = [(100000, "High Budget"), (50000, "Medium Budget")], "Low Budget"
VALUE_BANDS, VALUE_REST = [(20000, "VIP"), (10000, "Premium"), (5000, "Standard")], "Basic"
MARGIN_BANDS, MARGIN_REST = [(50, "High Margin"), (30, "Medium Margin")], "Low Margin"
PRICE_BANDS, PRICE_REST = [(200, "Premium"), (100, "Mid-Range")], "Budget"


def banded(value: str, bands: list[tuple[float, str]], rest: str):
    """The label of the first band whose lower bound is reached."""
    expr = F.lit(rest)
    for bound, label in reversed(bands):
        expr = F.when(F.col(value) >= bound, label).otherwise(expr)
    return expr


def campaign(dim: DataFrame, as_of) -> DataFrame:
    today = day(as_of)
    status = (F.when(today.between(F.col("start_date"), F.col("end_date")), "Current")
              .when(today < F.col("start_date"), "Future").when(today > F.col("end_date"), "Past"))
    return current(dim).select(
        F.col("campaign_key").alias("dim_campaign_sk"), F.col("campaign_id").alias("natural_key"),
        "campaign_name", "campaign_type",
        F.col("start_date").alias("campaign_start_date"), F.col("end_date").alias("campaign_end_date"),
        F.col("budget").alias("campaign_budget"), F.col("status").alias("campaign_status"),
        F.col("objective").alias("campaign_objective"), F.col("updated_timestamp").alias("effective_timestamp"),
        (F.datediff("end_date", "start_date") + 1).alias("campaign_duration_days"),
        status.alias("campaign_period_status"),
        banded("budget", BUDGET_BANDS, BUDGET_REST).alias("budget_category"))


def customer(dim: DataFrame) -> DataFrame:
    return current(dim).select(
        F.col("customer_key").alias("dim_customer_sk"), F.col("customer_id").alias("natural_key"),
        "customer_name", F.col("email").alias("customer_email"), F.col("phone").alias("customer_phone"),
        F.col("segment").alias("customer_segment"), F.col("tier").alias("customer_tier"),
        F.col("status").alias("customer_status"), F.col("lifetime_value").alias("customer_lifetime_value"),
        F.col("updated_timestamp").alias("effective_timestamp"),
        rank_of("tier", TIERS).alias("tier_rank"),
        banded("lifetime_value", VALUE_BANDS, VALUE_REST).alias("value_category"),
        (F.col("status") == "Active").alias("is_active_customer"))


def product(dim: DataFrame) -> DataFrame:
    return dim.select(
        F.col("product_key").alias("dim_product_sk"), F.col("product_id").alias("natural_key"),
        F.col("sku").alias("product_sku"), "product_name", F.col("category").alias("product_category"),
        F.col("subcategory").alias("product_subcategory"), F.col("brand").alias("product_brand"),
        F.col("unit_price").alias("product_price"), F.col("cost").alias("product_cost"),
        F.col("margin").alias("product_margin"), F.col("margin_percent").alias("product_margin_percent"),
        "product_status", F.col("updated_timestamp").alias("effective_timestamp"),
        banded("margin_percent", MARGIN_BANDS, MARGIN_REST).alias("margin_category"),
        banded("unit_price", PRICE_BANDS, PRICE_REST).alias("price_tier"))


def channel(dim: DataFrame) -> DataFrame:
    kind = F.col("channel_type")
    return dim.select(
        F.col("channel_key").alias("dim_channel_sk"), F.col("channel_id").alias("natural_key"),
        "channel_name", "channel_type", F.col("current_category").alias("channel_category"), "cost_structure",
        F.col("updated_timestamp").alias("effective_timestamp"),
        F.when(kind.isin(PAID_TYPES), "Digital Paid").when(kind.isin(OWNED_TYPES), "Digital Owned")
        .otherwise("Other").alias("channel_classification"))


def calendar(dim: DataFrame) -> DataFrame:
    return dim.select(
        "date_key", "full_date", "year", "quarter", "month", "month_name", F.col("week_of_year").alias("week"),
        "day_of_week", "day_name", "day_of_month", "day_of_year", "is_weekend", "is_holiday",
        "fiscal_year", "fiscal_quarter", F.col("fiscal_month").alias("fiscal_period"))


def sales(fact: DataFrame) -> DataFrame:
    return fact.select(
        F.col("customer_key").alias("dim_customer_sk"), F.col("product_key").alias("dim_product_sk"),
        F.col("campaign_key").alias("dim_campaign_sk"), F.col("date_key").alias("dim_date_sk"),
        time_key("order_timestamp").alias("dim_time_sk"),
        "quantity", "unit_price", "discount_amount", "tax_amount", "line_total", "revenue",
        "order_id", "order_line_id", F.col("order_timestamp").alias("transaction_timestamp"))


def performance(fact: DataFrame) -> DataFrame:
    return fact.select(
        F.col("campaign_key").alias("dim_campaign_sk"), F.col("channel_key").alias("dim_channel_sk"),
        F.col("date_key").alias("dim_date_sk"),
        "impressions", "clicks", "cost", "conversions", "revenue", "ctr", "cpc", "roas",
        "performance_id", "performance_date")
