"""The validation script: row counts, keys, duplicates, references, rules, ranges, summaries, scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.expressions import any_of, day, elapsed, mean2, percent, ratio, ts
from ..operators.lookups import orphan_count

PASS, FAIL = "✅ PASS", "❌ FAIL"


def verdict(ok: Column) -> Column:
    return F.when(ok, PASS).otherwise(FAIL)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: Mapping[str, tuple[DataFrame, int]]) -> DataFrame:
    return _union([df.agg(F.lit(name).alias("layer_table"), F.count(F.lit(1)).alias("row_count"), F.lit(n).alias("expected_min"),
                          verdict(F.count(F.lit(1)) >= n).alias("status")) for name, (df, n) in tables.items()])


def _counted(df: DataFrame, rules: Mapping[str, Column], value: str) -> DataFrame:
    """Rows hit by each rule, all rules of the table in one pass."""
    one = df.agg(F.array(*[F.struct(F.lit(n).alias("check_name"), F.count_if(c).alias(value)) for n, c in rules.items()]).alias("_r"))
    return one.select(F.inline("_r")).withColumn("status", verdict(F.col(value) == 0))


def null_keys(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    return _union([_counted(df, {f"{name} - NULL {key}": F.col(key).isNull()}, "null_count") for name, (df, key) in tables.items()])


def duplicates(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    return _union([df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.lit(f"{name} - Duplicates").alias("check_name"), F.count_if(F.col("_n") > 1).alias("duplicate_count"),
        verdict(F.count_if(F.col("_n") > 1) == 0).alias("status")) for name, (df, key) in tables.items()])


def missing_parents(links: Sequence[tuple[str, DataFrame, DataFrame, str]]) -> DataFrame:
    return _union([orphan_count(child, parent, column, name="orphan_count").select(
        F.lit(f"{name} - Orphaned {column}").alias("check_name"), "orphan_count",
        verdict(F.col("orphan_count") == 0).alias("status")) for name, child, parent, column in links])


def business_rules(t: Mapping[str, DataFrame]) -> DataFrame:
    """Eleven rules in one pass per table."""
    c = F.col
    return _union([
        _counted(t["campaigns"], {"Campaigns - Negative budget": c("budget") < 0,
                                  "Campaigns - Invalid date range": c("end_date") < c("start_date")}, "violation_count"),
        _counted(t["products"], {"Products - Non-positive unit_price": c("unit_price") <= 0, "Products - Non-positive cost": c("cost") <= 0,
                                 "Products - Negative margin": c("margin") < 0}, "violation_count"),
        _counted(t["sales"], {"Sales - Non-positive quantity": c("quantity") <= 0, "Sales - Invalid revenue calculation": F.abs(
            c("revenue") - (c("line_total") + c("tax_amount"))) > F.lit("0.01").cast("decimal(18,2)")}, "violation_count"),
        _counted(t["performance"], {"Performance - Clicks > Impressions": c("clicks") > c("impressions"),
                                    "Performance - Conversions > Clicks": c("conversions") > c("clicks"),
                                    "Performance - Negative cost": c("cost") < 0, "Performance - Negative revenue": c("revenue") < 0},
                 "violation_count")])


def date_ranges(ranges: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    return _union([df.agg(F.lit(name).alias("table_name"), F.min(first).alias("earliest"), F.max(last).alias("latest"),
                          F.datediff(F.max(last), F.min(first)).alias("total_days_covered")) for name, (df, first, last) in ranges.items()])


def summaries(t: Mapping[str, DataFrame]) -> DataFrame:
    """Five summaries as (category, metric, value)."""
    specs = {
        "Campaign Budget Summary": ("campaigns", {"total_campaigns": F.count(F.lit(1)), "total_budget": F.sum("budget"), "avg_budget": mean2("budget"),
                                                  "min_budget": F.min("budget"), "max_budget": F.max("budget")}),
        "Customer LTV Summary": ("customers", {"total_customers": F.count(F.lit(1)), "total_ltv": F.sum("lifetime_value"),
                                               "avg_ltv": mean2("lifetime_value"), "min_ltv": F.min("lifetime_value"), "max_ltv": F.max("lifetime_value")}),
        "Product Pricing Summary": ("products", {"total_products": F.count(F.lit(1)), "avg_price": mean2("unit_price"),
                                                 "avg_margin_pct": mean2("margin_percent"), "min_price": F.min("unit_price"), "max_price": F.max("unit_price")}),
        "Sales Revenue Summary": ("sales", {"total_orders": F.count(F.lit(1)), "total_revenue": F.sum("revenue"), "avg_order_value": mean2("revenue"),
                                            "min_order_value": F.min("revenue"), "max_order_value": F.max("revenue")}),
        "Performance Metrics Summary": ("performance", {
            "total_records": F.count(F.lit(1)), "total_impressions": F.sum("impressions"), "total_clicks": F.sum("clicks"), "total_cost": F.sum("cost"),
            "total_revenue": F.sum("revenue"), "overall_roas": F.round(ratio(F.sum("revenue"), F.sum("cost")), 2),
            "overall_ctr": F.round(percent(F.sum("clicks"), F.sum("impressions")), 2)}),
    }
    parts = []
    for category, (table, metrics) in specs.items():
        rows = F.array(*[F.struct(F.lit(n).alias("metric"), m.cast("double").alias("value")) for n, m in metrics.items()])
        parts.append(t[table].agg(rows.alias("_r")).select(F.lit(category).alias("metric_category"), F.inline("_r")))
    return _union(parts)


def price_below_cost(products: DataFrame) -> DataFrame:
    return _counted(products, {"Products - Price below cost": F.col("unit_price") < F.col("cost")}, "violation_count")


def freshness(tables: Mapping[str, tuple[DataFrame, str]], now: str, limit_hours: int = 48) -> DataFrame:
    parts = [df.agg(F.lit(name).alias("table_name"), F.max(column).cast("timestamp_ntz").alias("latest_timestamp")) for name, (df, column) in tables.items()]
    out = _union(parts).withColumn("hours_old", elapsed("HOUR", "latest_timestamp", ts(now)))
    return out.withColumn("status", verdict(F.col("hours_old") <= limit_hours))


def reconcile_counts(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Dimension rows against source rows."""
    parts = [dim.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("dim_count")).withColumn(
        "source_count", source.agg(F.count(F.lit(1))).scalar()) for name, (dim, source) in pairs.items()]
    return _union(parts).withColumn("variance", F.abs(F.col("dim_count") - F.col("source_count")))


def fact_totals(fact: DataFrame, date_key: int | Column) -> DataFrame:
    """Totals of one day."""
    return fact.where(F.col("date_key") == date_key).agg(
        F.sum("revenue").alias("total_revenue"), F.count_distinct("customer_key").alias("unique_customers"),
        F.count(F.lit(1)).alias("total_transactions"))


def scores(df: DataFrame, required: Sequence[str], valid: Column) -> DataFrame:
    """Completeness: filled required fields; accuracy: rows that pass."""
    filled = reduce(lambda a, b: a + b, [F.count(c) for c in required])
    return df.agg(
        F.round(percent(filled, F.count(F.lit(1)) * len(required)), 2).alias("completeness_pct"),
        F.round(percent(F.count_if(valid), F.count(F.lit(1))), 2).alias("accuracy_pct"))


def count_variance(daily: DataFrame, date: str, count: str, alert_pct: int = 20) -> DataFrame:
    """Change of a daily count against the day before; one row per day."""
    w = W.orderBy(date)
    out = daily.withColumn("previous_count", F.lag(count).over(w)).withColumn(
        "variance_pct", F.round(percent(F.col(count) - F.col("previous_count"), "previous_count"), 2))
    return out.withColumn("is_alert", F.coalesce(F.abs("variance_pct") > alert_pct, F.lit(False)))


def post_load(name: str, df: DataFrame, keys: Sequence[str], rule: Column, stamp: str, now: str) -> DataFrame:
    """After a load: null keys, broken rule, age, in one pass."""
    return df.agg(
        F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
        F.count_if(any_of([F.col(k).isNull() for k in keys])).alias("null_keys"), F.count_if(rule).alias("broken_rules"),
        F.max(stamp).alias("last_load"), elapsed("MINUTE", F.max(stamp), ts(now)).alias("minutes_ago"))


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    return _union([df.agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("row_count")) for name, df in layers.items()])


def yesterday_key(as_of: str) -> Column:
    d = F.date_sub(day(as_of), 1)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
