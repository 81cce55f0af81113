"""Fact tables: surrogate key lookups, ratios, the daily pre-aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.expressions import (MONEY, RATIO, average_ratio, percent, percent_or_zero, ratio, ratio_or_zero, ts)
from .lookups import current, join_calendar, lookup_inner, lookup_left, orphan_count


def fact_performance(silver: DataFrame, dim_campaign: DataFrame, dim_channel: DataFrame, dim_date: DataFrame,
                     run_ts) -> DataFrame:
    keyed = lookup_inner(silver, dim_campaign, "campaign_id", "campaign_key")
    keyed = lookup_inner(keyed, dim_channel, "channel_id", "channel_key")
    keyed = join_calendar(keyed, dim_date, "performance_date")
    return keyed.select(
        "performance_id", "campaign_key", "channel_key", "date_key", "performance_date",
        "impressions", "clicks", "conversions", "cost", "revenue", "ctr",
        ratio_or_zero("cost", "clicks").cast(RATIO).alias("cpc"),
        ratio_or_zero("cost", "conversions").cast(RATIO).alias("cpa"),
        "roas",
        percent_or_zero("conversions", "impressions").cast(RATIO).alias("conversion_rate"),
        ts(run_ts).alias("load_timestamp"), "source_system")


def fact_sales(silver: DataFrame, dim_customer: DataFrame, dim_product: DataFrame, dim_campaign: DataFrame,
               dim_date: DataFrame, run_ts) -> DataFrame:
    keyed = lookup_inner(silver, dim_customer, "customer_id", "customer_key")
    keyed = lookup_inner(keyed, dim_product, "product_id", "product_key")
    keyed = lookup_left(keyed, dim_campaign, "campaign_id", "campaign_key")
    keyed = join_calendar(keyed, dim_date, "order_date")
    return keyed.select(
        "order_id", "order_line_id", "order_timestamp", "order_date",
        "customer_key", "product_key", "campaign_key", "date_key",
        "quantity", "unit_price", "discount_amount", "tax_amount", "line_total", "revenue",
        percent_or_zero("discount_amount", "line_total").cast(RATIO).alias("discount_percent"),
        ts(run_ts).alias("load_timestamp"), "source_system")


def fact_campaign_daily(silver: DataFrame, dim_campaign: DataFrame, dim_date: DataFrame, run_ts) -> DataFrame:
    """Campaign by day, aggregated on the natural key first so that the lookups touch one row per group."""
    daily = silver.groupBy("campaign_id", "performance_date").agg(
        F.sum("impressions").alias("total_impressions"),
        F.sum("clicks").alias("total_clicks"),
        F.sum("conversions").alias("total_conversions"),
        F.sum("cost").cast(MONEY).alias("total_cost"),
        F.sum("revenue").cast(MONEY).alias("total_revenue"),
        ratio(F.sum("ctr"), F.count("ctr")).cast(RATIO).alias("avg_ctr"),
        average_ratio("cost", "clicks").cast(RATIO).alias("avg_cpc"),
        F.count_distinct("channel_id").alias("channel_count"))
    keyed = join_calendar(lookup_inner(daily, dim_campaign, "campaign_id", "campaign_key"), dim_date, "performance_date")
    return keyed.select(
        "campaign_key", "date_key", "total_impressions", "total_clicks", "total_conversions",
        "total_cost", "total_revenue", "avg_ctr", "avg_cpc",
        ratio_or_zero("total_revenue", "total_cost").cast(RATIO).alias("total_roas"),
        F.coalesce(percent("total_clicks", "total_impressions"), F.lit(0)).cast(RATIO).alias("total_ctr"),
        ratio_or_zero("total_cost", "total_clicks").cast(RATIO).alias("total_cpc"),
        "channel_count", ts(run_ts).alias("load_timestamp"))


def touched_days(silver: DataFrame, increment: DataFrame) -> DataFrame:
    """All silver rows of the (campaign, day) groups an increment touches: those days are computed again in full."""
    touched = increment.select("campaign_id", "performance_date").distinct()
    return silver.join(touched, ["campaign_id", "performance_date"], "left_semi")


def fact_orphans(silver: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Rows a fact load drops, one row per failing foreign key."""
    out = None
    for column, dim in dims.items():
        part = orphan_count(silver, current(dim), column, name="orphaned_record_count").select(
            F.lit(column).alias("foreign_key_column"), "orphaned_record_count")
        out = part if out is None else out.unionByName(part)
    return out
