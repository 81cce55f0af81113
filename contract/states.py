"""Two states of the dimensions: what the first loads brought, and what the source says later."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import session
from tidemark.operators import scd
from tidemark.plans.star import CAMPAIGN_COLUMNS, CHANNEL_COLUMNS, CUSTOMER_COLUMNS, Star, silver_table

from .ctes import FIRST_LOADS, RUN_CAMPAIGN1, RUN_CAMPAIGN2, RUN_TS, RUN_TS2

NEXT_TIER = {"Standard": "Bronze", "Bronze": "Silver", "Silver": "Gold"}


def first(spark: SparkSession, sf: str, name: str, columns: list[str]) -> DataFrame:
    return silver_table(spark, sf, name).where(
        F.col("source_load_timestamp") <= F.lit(FIRST_LOADS).cast("timestamp_ntz")).select(*columns)


def customers_before(spark, sf) -> DataFrame:
    return first(spark, sf, "customers", CUSTOMER_COLUMNS)


def customers_after(spark, sf) -> DataFrame:
    """One segment moves up a tier; churned customers are gone."""
    up = F.lit("Platinum")
    for old, new in NEXT_TIER.items():
        up = F.when(F.col("tier") == old, new).otherwise(up)
    return silver_table(spark, sf, "customers").where(F.col("status") != "Churned").withColumn(
        "tier", F.when(F.col("segment") == "MACHINERY", up).otherwise(F.col("tier"))).select(*CUSTOMER_COLUMNS)


def campaigns_before(spark, sf) -> DataFrame:
    return first(spark, sf, "campaigns", CAMPAIGN_COLUMNS)


def campaigns_after(spark, sf) -> DataFrame:
    """One campaign type gets a tenth more budget; paused campaigns are gone."""
    raised = F.when(F.col("campaign_type") == "Conversion", F.col("budget") * F.lit("1.1").cast("decimal(2,1)")
                    ).otherwise(F.col("budget")).cast("decimal(18,2)")
    return silver_table(spark, sf, "campaigns").where(F.col("status") != "Paused").withColumn("budget", raised).select(*CAMPAIGN_COLUMNS)


def channels_after(spark, sf) -> DataFrame:
    return silver_table(spark, sf, "channels").withColumn(
        "category", F.when(F.col("cost_structure") == "CPC", "Partner").otherwise(F.col("category"))).select(*CHANNEL_COLUMNS)


def customer_v1(spark, sf) -> DataFrame:
    return scd.scd2_initial(customers_before(spark, sf), "customer_id", "customer_key", RUN_TS)


def customer_v2(spark, sf) -> DataFrame:
    return scd.scd2_incremental(customer_v1(spark, sf), customers_after(spark, sf), "customer_id", "customer_key", RUN_TS2)


def customer_history(spark, sf) -> DataFrame:
    """The customer dimension after both loads, as a written table."""
    return session.written_once(spark, f"dim_customer_history|{sf}", lambda: customer_v2(spark, sf))


def campaign_history(spark, sf) -> DataFrame:
    return session.written_once(spark, f"dim_campaign_history|{sf}", lambda: campaign_v2(spark, sf))


def campaign_v1(spark, sf) -> DataFrame:
    return scd.scd2_initial(campaigns_before(spark, sf), "campaign_id", "campaign_key", RUN_CAMPAIGN1)


def campaign_v2(spark, sf) -> DataFrame:
    return scd.scd2_incremental(campaign_v1(spark, sf), campaigns_after(spark, sf), "campaign_id", "campaign_key", RUN_CAMPAIGN2)


def channel_v2(spark, sf) -> DataFrame:
    return scd.scd3(Star(spark, sf).dim_channel, channels_after(spark, sf), "channel_id", "channel_key", "category", RUN_TS2)
