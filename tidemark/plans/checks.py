"""The fifty checks of the three layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.expressions import any_of, elapsed, percent, ratio, ts
from ..operators.changes import repeated_rows
from ..operators.lookups import orphan_count
from ..operators.neighbors import next_value
from ..operators.quality import Check, Tables
from ..operators.scd import dimension_audit

# Allowed states and tracked columns here, names, layers, categories and severities of the checks below.
ALLOWED_STATUS = ["Active", "Paused", "Completed", "Planned", "Cancelled"]
TRACKED = ["customer_name", "email", "phone", "segment", "tier", "status", "lifetime_value"]


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("actual"))


def _repeated(df: DataFrame, *keys: str) -> DataFrame:
    """Number of keys that occur more than once."""
    return _count(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))


def _now(t: Tables) -> Column:
    return ts(t.parameters["now"])


def _today(t: Tables) -> Column:
    return F.to_date(_now(t))


def _newest(t: Tables, *names: str) -> DataFrame:
    parts = [t[n].agg(F.max("load_timestamp").alias("newest")) for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _months_differ(df: DataFrame, date: str, value: str) -> DataFrame:
    """Months whose sum of daily sums differs from the sum of their rows."""
    month = F.trunc(date, "month").alias("_m")
    daily = df.groupBy(date).agg(F.sum(value).alias("_d"))
    rolled = daily.groupBy(month).agg(F.sum("_d").alias("_rolled"))
    direct = df.groupBy(month).agg(F.sum(value).alias("_direct"))
    return _count(rolled.join(direct, "_m", "full_outer").where(~F.col("_rolled").eqNullSafe(F.col("_direct"))))


def _missing_days(df: DataFrame, date: str) -> Column:
    return F.datediff(F.max(date), F.min(date)) + 1 - F.count_distinct(date)


def _outliers(t: Tables) -> Column:
    """Beyond three deviations; the two moments are one scalar subquery."""
    cost = F.col("cost").cast("double")
    m = t["silver_performance"].agg(F.struct(F.avg(cost).alias("mean"), F.stddev(cost).alias("dev"))).scalar()
    return F.abs(cost - m["mean"]) > 3 * m["dev"]


def _fact_orphans(t: Tables) -> DataFrame:
    links = [("fact_performance", "campaign_key", "dim_campaign"), ("fact_performance", "channel_key", "dim_channel"),
             ("fact_performance", "date_key", "dim_date"), ("fact_sales", "customer_key", "dim_customer"),
             ("fact_sales", "product_key", "dim_product"), ("fact_sales", "campaign_key", "dim_campaign"), ("fact_sales", "date_key", "dim_date")]
    parts = [orphan_count(t[f], t[d], k) for f, k, d in links]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.agg(F.sum("actual").alias("actual"))


def _reconcile(t: Tables) -> DataFrame:
    s = t["silver_performance"].agg(F.struct(F.sum("impressions").alias("i"), F.sum("clicks").alias("c"))).scalar()
    return t["fact_performance"].agg(F.sum("impressions").alias("i"), F.sum("clicks").alias("c")).select(
        F.greatest(F.abs(F.col("i") - s["i"]), F.abs(F.col("c") - s["c"])).alias("actual"))


def _silver_share(t: Tables) -> DataFrame:
    silver = t["silver_campaigns"].agg(F.count_distinct("campaign_id")).scalar()
    return t["bronze_campaigns"].agg(F.count_distinct("campaign_id").alias("b")).select(F.round(percent(silver, "b"), 4).alias("actual"))


def _unrecorded(t: Tables) -> DataFrame:
    """Later versions without an UPDATE row in the audit trail."""
    dim = t["dim_customer_history"]
    audit = dimension_audit(dim, "customer_id", "customer_key", TRACKED, "DIM_CUSTOMER").where("operation_type = 'UPDATE'")
    seen = audit.select(F.col("natural_key").alias("customer_id"), "version_number").distinct()
    return _count(dim.where("version_number > 1").join(seen, ["customer_id", "version_number"], "left_anti"))


def _overlaps(t: Tables) -> DataFrame:
    following = next_value(t["dim_customer_history"], ["customer_id"], "valid_from", "valid_from", "_next")
    return _count(following.where(F.col("_next") < F.col("valid_to")))


def _silent_views(t: Tables) -> DataFrame:
    """Views that give no row; every view is asked for one."""
    views = t.parameters["views"]
    silent = sum(1 for v in views() if v.isEmpty())
    return t["dim_date"].agg(F.lit(silent).alias("actual"))


def _json(path: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.try_parse_json("raw_data"), path, kind)


def _off(stored: str, num, den, condition: Column) -> Column:
    return condition & (F.abs(F.col(stored) - ratio(num, den) * (100 if stored == "ctr" else 1)) > 0.01)


def _text_broken(*columns: str) -> Column:
    return any_of([F.col(c).contains("�") | ~F.is_valid_utf8(F.col(c)) for c in columns])


def _too_long(limits: dict[str, int]) -> Column:
    return any_of([F.length(c) > n for c, n in limits.items()])


def _negative(*columns: str) -> Column:
    return any_of([F.col(c) < 0 for c in columns])


B, S, G = "BRONZE", "SILVER", "GOLD"

CHECKS: list[Check] = [
    Check("B1", "Bronze Campaign Row Count", B, "COMPLETENESS", "HIGH", "bronze_campaigns", expected=10, compare="ge",
          measure=lambda t: F.count_if(F.to_date("load_timestamp") == _today(t))),
    Check("B2", "Bronze JSON Required Fields", B, "COMPLETENESS", "CRITICAL", "bronze_campaigns_json",
          violates=lambda t: _json("$.campaign_id").isNull() | _json("$.campaign_name").isNull()),
    Check("B3", "Bronze Data Freshness", B, "TIMELINESS", "HIGH", frame=lambda t: _newest(
        t, "bronze_campaigns", "bronze_customers", "bronze_performance").agg(
        F.count_if(elapsed("HOUR", "newest", _now(t)) > 24).alias("actual"))),
    Check("B4", "Bronze No Duplicate Rows", B, "UNIQUENESS", "HIGH",
          frame=lambda t: _count(repeated_rows(t["bronze_sales"]))),
    Check("B5", "Bronze Load Timestamps Present", B, "COMPLETENESS", "HIGH", "bronze_performance",
          violates=lambda t: F.col("load_timestamp").isNull()),
    Check("B6", "Bronze Valid Date Formats", B, "VALIDITY", "MEDIUM", "bronze_campaigns_json",
          violates=lambda t: F.try_to_date(_json("$.start_date")).isNull() | F.try_to_date(_json("$.end_date")).isNull()),
    Check("B7", "Bronze Numeric Fields Castable", B, "VALIDITY", "MEDIUM", "bronze_campaigns_json",
          violates=lambda t: _json("$.budget").try_cast("decimal(18,2)").isNull()),
    Check("B8", "Bronze JSON Well Formed", B, "VALIDITY", "CRITICAL", "bronze_events_json",
          violates=lambda t: F.col("raw_data").isNotNull() & F.try_parse_json("raw_data").isNull()),
    Check("B9", "Bronze Performance Volume", B, "COMPLETENESS", "HIGH", "bronze_performance", expected=1000, compare="ge",
          measure=lambda t: F.count(F.lit(1))),
    Check("B10", "Bronze Customers Volume", B, "COMPLETENESS", "HIGH", "bronze_customers", expected=1000, compare="ge",
          measure=lambda t: F.count(F.lit(1))),
    Check("B11", "Bronze Interactions Volume", B, "COMPLETENESS", "HIGH", "bronze_events_json", expected=1000, compare="ge",
          measure=lambda t: F.count(F.lit(1))),
    Check("B12", "Bronze No Future Dates", B, "VALIDITY", "MEDIUM", "bronze_sales", violates=lambda t: F.col("order_date") > _today(t)),
    Check("B13", "Bronze Character Encoding", B, "VALIDITY", "LOW", "bronze_customers",
          violates=lambda t: _text_broken("customer_name", "email")),
    Check("B14", "Bronze Field Lengths", B, "VALIDITY", "LOW", "bronze_customers",
          violates=lambda t: _too_long({"customer_name": 255, "email": 255, "phone": 10})),
    Check("B15", "Bronze Load Consistency", B, "CONSISTENCY", "MEDIUM", expected=24, compare="le", frame=lambda t: _newest(
        t, "bronze_campaigns", "bronze_channels", "bronze_customers", "bronze_products", "bronze_performance", "bronze_sales").agg(
        elapsed("HOUR", F.min("newest"), F.max("newest")).alias("actual"))),

    Check("S1", "Silver RI - Performance to Campaigns", S, "CONSISTENCY", "CRITICAL",
          frame=lambda t: orphan_count(t["silver_performance"], t["silver_campaigns"], "campaign_id")),
    Check("S2", "Silver Business Logic - Clicks <= Impressions", S, "ACCURACY", "HIGH", "silver_performance",
          violates=lambda t: F.col("clicks") > F.col("impressions")),
    Check("S3", "Silver CTR Calculation", S, "ACCURACY", "MEDIUM", "silver_performance",
          violates=lambda t: _off("ctr", "clicks", "impressions", F.col("impressions") > 0)),
    Check("S4", "Silver Bronze Reconciliation", S, "CONSISTENCY", "HIGH", expected=95, compare="ge", frame=_silver_share),
    Check("S5", "Silver No Negative Metrics", S, "VALIDITY", "HIGH", "silver_performance",
          violates=lambda t: _negative("impressions", "clicks", "cost", "conversions", "revenue")),
    Check("S6", "Silver Date Range", S, "VALIDITY", "MEDIUM", "silver_performance", violates=lambda t: ~F.col("performance_date").between(
        F.lit(t.parameters["first_day"]).cast("date"), F.lit(t.parameters["last_day"]).cast("date"))),
    Check("S7", "Silver Required Fields", S, "COMPLETENESS", "CRITICAL", "silver_customers",
          violates=lambda t: any_of([F.col(c).isNull() for c in ("customer_id", "customer_name", "email")])),
    Check("S8", "Silver Email Format", S, "VALIDITY", "MEDIUM", "silver_customers",
          violates=lambda t: F.col("email").isNotNull() & ~F.col("email_valid")),
    Check("S9", "Silver Outliers", S, "ACCURACY", "LOW", "silver_performance", violates=_outliers),
    Check("S10", "Silver Status Values", S, "VALIDITY", "MEDIUM", "silver_campaigns",
          violates=lambda t: ~F.col("status").isin(ALLOWED_STATUS)),
    Check("S11", "Silver No Duplicates", S, "UNIQUENESS", "CRITICAL", frame=lambda t: _repeated(t["silver_campaigns"], "campaign_id")),
    Check("S12", "Silver ROAS Calculation", S, "ACCURACY", "MEDIUM", "silver_performance",
          violates=lambda t: _off("roas", "revenue", "cost", F.col("cost") > 0)),
    Check("S13", "Silver Conversion Rate Range", S, "VALIDITY", "MEDIUM", "silver_performance",
          violates=lambda t: ~F.col("conversion_rate").between(0, 100)),
    Check("S14", "Silver Time Series Completeness", S, "COMPLETENESS", "MEDIUM", "silver_performance",
          measure=lambda t: _missing_days(t["silver_performance"], "performance_date")),
    Check("S15", "Silver Load Timestamp Consistency", S, "TIMELINESS", "LOW", "silver_performance",
          violates=lambda t: ~F.col("source_load_timestamp").between(_now(t) - F.make_dt_interval(F.lit(7)), _now(t))),
    Check("S16", "Silver Geography Lookup", S, "CONSISTENCY", "MEDIUM",
          frame=lambda t: orphan_count(t["customer_geography"], t["geography"], "nation_key")),
    Check("S17", "Silver Channel Attribution", S, "COMPLETENESS", "MEDIUM",
          frame=lambda t: orphan_count(
              t["silver_campaigns"], t["silver_performance"].where(F.col("channel_id").isNotNull()), "campaign_id")),
    Check("S18", "Silver Cost-Revenue Relationship", S, "ACCURACY", "MEDIUM", "silver_performance",
          violates=lambda t: (F.col("revenue") > 0) & (F.col("cost") == 0)),
    Check("S19", "Silver Aggregate Totals Match", S, "CONSISTENCY", "MEDIUM",
          frame=lambda t: _months_differ(t["silver_performance"], "performance_date", "revenue")),
    Check("S20", "Silver Conversions <= Clicks", S, "ACCURACY", "HIGH", "silver_performance",
          violates=lambda t: F.col("conversions") > F.col("clicks")),

    Check("G1", "Gold RI - Fact to All Dimensions", G, "CONSISTENCY", "CRITICAL", frame=_fact_orphans),
    Check("G2", "Gold SCD One Current Version", G, "UNIQUENESS", "CRITICAL",
          frame=lambda t: _repeated(t["dim_customer_history"].where("is_current"), "customer_id")),
    Check("G3", "Gold Silver Reconciliation", G, "ACCURACY", "HIGH", expected=1, compare="le", frame=_reconcile),
    Check("G4", "Gold Fact Grain", G, "UNIQUENESS", "CRITICAL",
          frame=lambda t: _repeated(t["fact_performance"], "campaign_key", "channel_key", "date_key")),
    Check("G5", "Gold SCD No Overlap", G, "CONSISTENCY", "HIGH", frame=_overlaps),
    Check("G6", "Gold Date Dimension Complete", G, "COMPLETENESS", "HIGH", "dim_date",
          measure=lambda t: _missing_days(t["dim_date"], "full_date")),
    Check("G7", "Gold Surrogate Keys Present", G, "COMPLETENESS", "CRITICAL", "fact_sales",
          violates=lambda t: any_of([F.col(c).isNull() for c in ("customer_key", "product_key", "date_key")])),
    Check("G8", "Gold Additive Metrics", G, "CONSISTENCY", "MEDIUM", frame=lambda t: t["fact_campaign_daily"].agg(
        F.sum("total_cost").alias("d")).select(F.abs(F.col("d") - t["fact_performance"].agg(F.sum("cost")).scalar()).alias("actual"))),
    Check("G9", "Gold SCD Versions Sequential", G, "CONSISTENCY", "MEDIUM", frame=lambda t: _count(
        t["dim_customer_history"].groupBy("customer_id").agg(
            F.min("version_number").alias("a"), F.max("version_number").alias("z"), F.count(F.lit(1)).alias("n"),
            ).where("a <> 1 OR z <> n"))),
    Check("G10", "Gold Dimension No Duplicates", G, "UNIQUENESS", "CRITICAL", frame=lambda t: _repeated(t["dim_product"], "product_id")),
    Check("G11", "Gold Fact No Negative Metrics", G, "VALIDITY", "HIGH", "fact_sales",
          violates=lambda t: _negative("quantity", "unit_price", "discount_amount", "tax_amount", "line_total", "revenue")),
    Check("G12", "Gold Date Range Complete", G, "COMPLETENESS", "MEDIUM", "fact_performance",
          measure=lambda t: _missing_days(t["fact_performance"], "performance_date")),
    Check("G13", "Gold SCD History Audit", G, "CONSISTENCY", "MEDIUM", frame=_unrecorded),
    Check("G14", "Gold Fact Additive Test", G, "CONSISTENCY", "MEDIUM",
          frame=lambda t: _months_differ(t["fact_sales"], "order_date", "revenue")),
    Check("G15", "Gold Views Queryable", G, "COMPLETENESS", "HIGH", frame=_silent_views),
]
BY_ID = {c.check_id: c for c in CHECKS}
