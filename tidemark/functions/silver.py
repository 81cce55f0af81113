"""Cleansing of the six entities, bronze to silver, as single projections."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .expressions import (MONEY, RATIO, clean_email, clean_id, email_valid, fill, percent_or_zero, phone_valid,
                          ratio_or_zero, ts)


def _tail(run_ts) -> list[Column]:
    return [F.col("source_system"), F.col("last_modified_timestamp"),
            F.col("load_timestamp").alias("source_load_timestamp"), ts(run_ts).alias("load_timestamp")]


def campaigns(df: DataFrame, run_ts) -> DataFrame:
    return df.select(
        clean_id("campaign_id").alias("campaign_id"),
        fill("campaign_name", "Unknown Campaign").alias("campaign_name"),
        fill("campaign_type", "Unknown").alias("campaign_type"),
        "start_date", "end_date",
        fill("budget", 0).cast(MONEY).alias("budget"),
        fill("status", "Unknown").alias("status"),
        "objective",
        (F.datediff("end_date", "start_date") + 1).alias("duration_days"),
        *_tail(run_ts))


def channels(df: DataFrame, run_ts) -> DataFrame:
    return df.select(
        clean_id("channel_id").alias("channel_id"),
        fill("channel_name", "Unknown Channel").alias("channel_name"),
        fill("channel_type", "Unknown").alias("channel_type"),
        fill("category", "Uncategorized").alias("category"),
        "cost_structure",
        *_tail(run_ts))


def customers(df: DataFrame, run_ts) -> DataFrame:
    return df.select(
        clean_id("customer_id").alias("customer_id"),
        fill("customer_name", "Unknown Customer").alias("customer_name"),
        clean_email("email").alias("email"),
        "phone",
        fill("segment", "Unknown").alias("segment"),
        fill("tier", "Standard").alias("tier"),
        fill("status", "Active").alias("status"),
        fill("lifetime_value", 0).cast(MONEY).alias("lifetime_value"),
        email_valid("email").alias("email_valid"),
        phone_valid("phone").alias("phone_valid"),
        *_tail(run_ts))


def products(df: DataFrame, run_ts) -> DataFrame:
    return df.select(
        clean_id("product_id").alias("product_id"),
        clean_id("sku").alias("sku"),
        fill("product_name", "Unknown Product").alias("product_name"),
        fill("category", "Uncategorized").alias("category"),
        fill("subcategory", "General").alias("subcategory"),
        fill("brand", "Generic").alias("brand"),
        fill("unit_price", 0).cast(MONEY).alias("unit_price"),
        fill("cost", 0).cast(MONEY).alias("cost"),
        fill("margin", 0).cast(MONEY).alias("margin"),
        fill("margin_percent", 0).cast(RATIO).alias("margin_percent"),
        fill("product_status", "Active").alias("product_status"),
        *_tail(run_ts))


def performance(df: DataFrame, run_ts, *, click_validation: bool = True, min_impressions: int = 0,
                max_ctr=None) -> DataFrame:
    """`click_validation` caps clicks at impressions; ctr needs more than `min_impressions`; `max_ctr` caps it."""
    filled = df.select(
        clean_id("performance_id").alias("performance_id"),
        clean_id("campaign_id").alias("campaign_id"),
        clean_id("channel_id").alias("channel_id"),
        "performance_date",
        fill("impressions", 0).alias("impressions"),
        fill("clicks", 0).alias("clicks"),
        fill("cost", 0).cast(MONEY).alias("cost"),
        fill("conversions", 0).alias("conversions"),
        fill("revenue", 0).cast(MONEY).alias("revenue"),
        "source_system", "last_modified_timestamp", "load_timestamp")
    capped = F.least("clicks", "impressions") if click_validation else F.col("clicks")
    ctr = F.when(F.col("impressions") > min_impressions, percent_or_zero("clicks", "impressions")).otherwise(F.lit(0))
    if max_ctr is not None:
        ctr = F.least(ctr, F.lit(max_ctr))
    return filled.select(
        "performance_id", "campaign_id", "channel_id", "performance_date",
        "impressions", "clicks", "cost", "conversions", "revenue",
        (F.col("clicks") <= F.col("impressions")).alias("clicks_valid"),
        capped.alias("clicks_capped"),
        (F.col("conversions") <= F.col("clicks")).alias("conversions_valid"),
        ctr.cast(RATIO).alias("ctr"),
        ratio_or_zero("cost", "clicks").cast(RATIO).alias("cpc"),
        ratio_or_zero("cost", "conversions").cast(RATIO).alias("cpa"),
        percent_or_zero("conversions", "clicks").cast(RATIO).alias("conversion_rate"),
        ratio_or_zero("revenue", "cost").cast(RATIO).alias("roas"),
        *_tail(run_ts))


def sales(df: DataFrame, run_ts, *, tolerance="0.01", max_discount_percent=50) -> DataFrame:
    """Line totals off by more than `tolerance` are replaced by quantity * price - discount."""
    filled = df.select(
        *[clean_id(c).alias(c) for c in ("order_id", "order_line_id", "customer_id", "product_id", "campaign_id")],
        "order_date", "order_timestamp",
        fill("quantity", 0).alias("quantity"),
        *[fill(c, 0).cast(MONEY).alias(c)
          for c in ("unit_price", "discount_amount", "tax_amount", "line_total", "revenue")],
        "source_system", "last_modified_timestamp", "load_timestamp",
    ).withColumn("_gross", (F.col("quantity") * F.col("unit_price")).cast(MONEY))
    expected = F.col("_gross") - F.col("discount_amount")
    off = F.abs(F.col("line_total") - expected) > F.lit(tolerance).cast("decimal(18,4)")
    discount = percent_or_zero("discount_amount", "_gross").cast(RATIO)
    return filled.select(
        "order_id", "order_line_id", "customer_id", "product_id", "campaign_id", "order_date", "order_timestamp",
        "quantity", "unit_price", "discount_amount", "tax_amount", "line_total", "revenue",
        F.when(off, expected).otherwise(F.col("line_total")).cast(MONEY).alias("line_total_validated"),
        discount.alias("discount_percent"),
        (discount > max_discount_percent).alias("discount_flag"),
        *_tail(run_ts))


def product_margin(df: DataFrame) -> DataFrame:
    """Margin recomputed from price and cost."""
    gap = F.col("unit_price") - F.col("cost")
    return df.select("product_id", "unit_price", "cost", gap.cast(MONEY).alias("margin"),
                     percent_or_zero(gap, "unit_price").cast(RATIO).alias("margin_percent"))


SILVER: dict[str, Callable[..., DataFrame]] = {
    "campaigns": campaigns, "channels": channels, "customers": customers,
    "products": products, "performance": performance, "sales": sales,
}
