"""Business queries over the star.

Facts are reduced to their integer keys first (map-side combine absorbs hot
campaigns, customers and products), the names are joined afterwards, and date
windows are literal filters that prune months and row groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.expressions import day, mean2, percent, rank_of, ratio
from ..operators.aggregates import exact_cuts
from . import views
from .star import Star

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# Labels of the reports (fixed values).
OVER_BUDGET, UNDER_PACING, ON_TRACK, ENDED = "🔴 Over Budget", "🟡 Under Pacing", "🟢 On Track", "⚪ Ended"
STAR_PRODUCT, HIGH_MARGIN, HIGH_VOLUME, AVERAGE = (
    "🟢 Star Product", "🟡 High Margin, Low Volume", "🟠 Low Margin, High Volume", "⚪ Average")

MEASURES = ["impressions", "clicks", "cost", "conversions", "revenue"]


def since(fact: DataFrame, column: str, start: Column) -> DataFrame:
    """Rows from a day on; the month predicate prunes partition folders."""
    out = fact.where(F.col(column) >= start)
    if "month_key" in fact.columns:
        out = out.where(F.col("month_key") >= F.year(start) * 100 + F.month(start))
    return out


def days_back(as_of, n: int) -> Column:
    return F.date_sub(day(as_of), n)


def months_back(as_of, n: int) -> Column:
    return F.add_months(day(as_of), -n)


def _reduce(fact: DataFrame, *keys: str) -> DataFrame:
    return fact.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in MEASURES])


def round2(value) -> Column:
    return F.round(value, 2)


def _top(df: DataFrame, n: int | None, *order) -> DataFrame:
    out = df.orderBy(*order)
    return out.limit(n) if n else out


def top_campaigns_roas(star: Star, as_of, days: int = 90, min_spend: int = 1000, n: int = 10) -> DataFrame:
    f = _reduce(since(star.fact_performance, "performance_date", days_back(as_of, days)), "campaign_key", "channel_key")
    named = (f.join(star.v_campaign(as_of), F.col("campaign_key") == F.col("dim_campaign_sk"))
             .join(star.v_channel, F.col("channel_key") == F.col("dim_channel_sk")))
    out = named.groupBy("campaign_name", "campaign_type", "channel_name").agg(
        F.sum("impressions").alias("total_impressions"), F.sum("clicks").alias("total_clicks"),
        round2(F.sum("cost")).alias("total_cost"), round2(F.sum("revenue")).alias("total_revenue"),
        round2(ratio(F.sum("revenue"), F.sum("cost"))).alias("roas"),
        round2(percent(F.sum("clicks"), F.sum("impressions"))).alias("ctr_percent"))
    return _top(out.where(F.col("total_cost") >= min_spend), n, F.desc_nulls_last("roas"), "campaign_name",
                "campaign_type", "channel_name")


def budget_vs_actual(star: Star, as_of, n: int = 20) -> DataFrame:
    spend = star.fact_performance.groupBy("campaign_key").agg(F.sum("cost").alias("cost"))
    c = star.v_campaign(as_of).where(F.col("campaign_period_status").isin("Current", "Past"))
    g = c.join(spend, F.col("dim_campaign_sk") == F.col("campaign_key"), "left").groupBy(
        "campaign_name", "campaign_budget", "campaign_start_date", "campaign_end_date", "campaign_duration_days",
        "campaign_period_status").agg(F.sum("cost").alias("_spend"))
    now = F.col("campaign_period_status") == "Current"
    budget, spent = F.col("campaign_budget"), F.col("_spend")
    status = (F.when(spent > budget * F.lit(1.1).cast("decimal(3,1)"), OVER_BUDGET)
              .when((spent < budget * F.lit(0.5).cast("decimal(3,1)")) & now, UNDER_PACING)
              .when(now, ON_TRACK).otherwise(ENDED))
    out = g.select(
        "campaign_name", "campaign_budget", "campaign_start_date", "campaign_end_date", "campaign_duration_days",
        F.datediff(day(as_of), "campaign_start_date").alias("days_elapsed"),
        round2(spent).alias("actual_spend"), round2(percent(spent, budget)).alias("spend_percent"),
        round2(budget - spent).alias("remaining_budget"), status.alias("status"))
    return _top(out, n, F.desc_nulls_last("actual_spend"), "campaign_name", "campaign_start_date", "campaign_budget")


def weekly_trend(star: Star, as_of, days: int = 60) -> DataFrame:
    f = _reduce(since(star.fact_performance, "performance_date", days_back(as_of, days)), "campaign_key", "date_key")
    named = f.join(star.v_campaign(as_of), F.col("campaign_key") == F.col("dim_campaign_sk")).join(
        F.broadcast(star.v_calendar), "date_key")
    out = named.groupBy("campaign_name", "year", "week", "month_name").agg(
        F.count_distinct("date_key").alias("days_active"),
        F.sum("impressions").alias("weekly_impressions"), F.sum("clicks").alias("weekly_clicks"),
        round2(F.sum("cost")).alias("weekly_cost"), round2(F.sum("revenue")).alias("weekly_revenue"),
        round2(ratio(F.sum("revenue"), F.sum("cost"))).alias("weekly_roas"))
    return out.orderBy("campaign_name", "year", F.desc("week"), "month_name")


def channel_comparison(star: Star) -> DataFrame:
    f = _reduce(star.fact_performance, "channel_key", "campaign_key")
    named = f.join(star.v_channel, F.col("channel_key") == F.col("dim_channel_sk"))
    out = named.groupBy("channel_name", "channel_type", "channel_category", "channel_classification").agg(
        F.count_distinct("campaign_key").alias("unique_campaigns"),
        F.sum("impressions").alias("total_impressions"), F.sum("clicks").alias("total_clicks"),
        round2(percent(F.sum("clicks"), F.sum("impressions"))).alias("avg_ctr"),
        round2(F.sum("cost")).alias("total_cost"),
        round2(ratio(F.sum("cost"), F.sum("clicks"))).alias("avg_cpc"),
        round2(F.sum("revenue")).alias("total_revenue"),
        round2(ratio(F.sum("revenue"), F.sum("cost"))).alias("roas"))
    return out.orderBy(F.desc_nulls_last("roas"), "channel_name")


def channel_mix(star: Star, as_of, months: int = 6) -> DataFrame:
    f = _reduce(since(star.fact_performance, "performance_date", months_back(as_of, months)), "channel_key", "date_key")
    named = f.join(F.broadcast(star.v_calendar), "date_key").join(
        star.v_channel, F.col("channel_key") == F.col("dim_channel_sk"))
    out = named.groupBy("year", "month", "month_name", "channel_name").agg(F.sum("cost").alias("_spend"))
    month = W.partitionBy("year", "month")
    out = out.select("year", "month", "month_name", "channel_name", round2("_spend").alias("monthly_spend"),
                     round2(percent("_spend", F.sum("_spend").over(month))).alias("spend_share_percent"))
    return out.orderBy(F.desc("year"), F.desc("month"), F.desc("monthly_spend"), "channel_name")


def best_channel_by_type(star: Star, as_of, n: int = 3) -> DataFrame:
    f = _reduce(star.fact_performance, "channel_key", "campaign_key")
    named = f.join(star.v_channel, F.col("channel_key") == F.col("dim_channel_sk")).join(
        star.v_campaign(as_of), F.col("campaign_key") == F.col("dim_campaign_sk"))
    g = named.groupBy("campaign_type", "channel_name").agg(
        F.count_distinct("campaign_key").alias("campaign_count"),
        F.sum("cost").alias("_cost"), F.sum("revenue").alias("_revenue"))
    ranked = g.withColumn("_ratio", ratio("_revenue", "_cost")).withColumn(
        "roas_rank", F.rank().over(W.partitionBy("campaign_type").orderBy(F.desc_nulls_last("_ratio"))))
    return ranked.where(F.col("roas_rank") <= n).select(
        "campaign_type", "channel_name", "campaign_count", round2("_cost").alias("total_cost"),
        round2("_revenue").alias("total_revenue"), round2("_ratio").alias("roas"), "roas_rank",
    ).orderBy("campaign_type", "roas_rank", "channel_name")


def share(value: str) -> Column:
    """Percent of the total over all rows; used on aggregated rows only."""
    return percent(value, F.sum(value).over(W.partitionBy()))


def customer_segments(star: Star) -> DataFrame:
    g = star.v_customer.where("is_active_customer").groupBy("customer_segment", "customer_tier", "value_category").agg(
        F.count(F.lit(1)).alias("customer_count"), mean2("customer_lifetime_value").alias("avg_ltv"),
        round2(F.sum("customer_lifetime_value")).alias("total_ltv"))
    return g.withColumns({"customer_percent": round2(share("customer_count")), "ltv_percent": round2(share("total_ltv"))}
                         ).orderBy(F.desc("total_ltv"), "customer_segment", "customer_tier", "value_category")


def top_customers(star: Star, as_of, months: int = 12, n: int = 20) -> DataFrame:
    """An order belongs to one customer, so distinct orders per key add up when keys share all attributes."""
    per_key = since(star.fact_sales, "order_date", months_back(as_of, months)).groupBy("customer_key").agg(
        F.count_distinct("order_id").alias("orders"), F.sum("quantity").alias("units"),
        F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("lines"))
    named = per_key.join(star.v_customer, F.col("customer_key") == F.col("dim_customer_sk"))
    out = named.groupBy("customer_name", "customer_email", "customer_segment", "customer_tier",
                        "customer_lifetime_value").agg(
        F.sum("orders").alias("orders_12mo"), F.sum("units").alias("units_purchased"),
        round2(F.sum("revenue")).alias("revenue_12mo"),
        round2(ratio(F.sum("revenue"), F.sum("lines"))).alias("avg_order_value"))
    return _top(out, n, F.desc("revenue_12mo"), "customer_email", "customer_name")


def tier_patterns(star: Star) -> DataFrame:
    """Orders and customers are counted per customer first; an order has one customer, so counts add up by tier."""
    per_key = star.fact_sales.groupBy("customer_key").agg(
        F.count_distinct("order_id").alias("orders"), F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("lines"))
    g = per_key.join(star.v_customer, F.col("customer_key") == F.col("dim_customer_sk")).groupBy(
        "customer_tier", "tier_rank").agg(
        F.count(F.lit(1)).alias("unique_customers"), F.sum("orders").alias("total_orders"),
        F.sum("revenue").alias("_revenue"), F.sum("lines").alias("_lines"))
    return g.select(
        "customer_tier", "tier_rank", "unique_customers", "total_orders",
        round2(ratio("total_orders", "unique_customers")).alias("orders_per_customer"),
        round2(ratio("_revenue", "_lines")).alias("avg_order_value"),
        round2("_revenue").alias("total_revenue"),
        round2(ratio("_revenue", "unique_customers")).alias("revenue_per_customer")).orderBy("tier_rank")


def top_products(star: Star, n: int = 20) -> DataFrame:
    named = star.fact_sales.join(star.v_product, F.col("product_key") == F.col("dim_product_sk"))
    out = named.groupBy("product_name", "product_category", "product_brand", "margin_category", "price_tier").agg(
        F.count_distinct("order_id").alias("times_ordered"), F.sum("quantity").alias("units_sold"),
        mean2("unit_price").alias("avg_selling_price"), round2(F.sum("revenue")).alias("total_revenue"),
        round2(ratio(F.sum("revenue"), F.sum("quantity"))).alias("revenue_per_unit"))
    return _top(out, n, F.desc("total_revenue"), "product_name", "product_category", "product_brand")


def category_analysis(star: Star) -> DataFrame:
    named = star.fact_sales.join(star.v_product, F.col("product_key") == F.col("dim_product_sk"))
    g = named.groupBy("product_category").agg(
        F.count_distinct("dim_product_sk").alias("unique_products"),
        F.count_distinct("order_id").alias("total_orders"), F.sum("quantity").alias("units_sold"),
        round2(F.sum("revenue")).alias("total_revenue"), mean2("revenue").alias("avg_order_line_value"))
    return g.withColumn("revenue_percent", round2(share("total_revenue"))).orderBy(
        F.desc("total_revenue"), "product_category")


def margin_vs_volume(star: Star, n: int = 30) -> DataFrame:
    per_key = star.fact_sales.groupBy("product_key").agg(
        F.sum("quantity").alias("quantity"), F.sum("revenue").alias("revenue"))
    named = per_key.join(star.v_product, F.col("product_key") == F.col("dim_product_sk"))
    g = named.groupBy("product_name", "margin_category", "product_margin_percent", "product_cost").agg(
        F.sum("quantity").alias("units_sold"), F.sum("revenue").alias("_revenue"))
    rich, busy = F.col("product_margin_percent") >= 40, F.col("units_sold") >= 100
    out = g.where(F.col("units_sold") > 0).select(
        "product_name", "margin_category", "product_margin_percent", "units_sold",
        round2("_revenue").alias("total_revenue"),
        round2(F.col("_revenue") - F.col("units_sold") * F.col("product_cost")).alias("gross_profit"),
        F.when(rich & busy, STAR_PRODUCT).when(rich, HIGH_MARGIN).when(busy, HIGH_VOLUME).otherwise(AVERAGE)
        .alias("product_classification"))
    return _top(out, n, F.desc("gross_profit"), "product_name", "product_margin_percent")


def daily_sales(star: Star, as_of, days: int = 30) -> DataFrame:
    f = since(star.fact_sales, "order_date", days_back(as_of, days))
    g = f.groupBy("date_key").agg(
        F.count_distinct("order_id").alias("total_orders"), F.count(F.lit(1)).alias("total_line_items"),
        F.sum("quantity").alias("units_sold"), F.sum("revenue").alias("_revenue"))
    return g.join(F.broadcast(star.v_calendar), "date_key").select(
        "full_date", "day_name", "is_weekend", "total_orders", "total_line_items", "units_sold",
        round2("_revenue").alias("daily_revenue"), round2(ratio("_revenue", "total_line_items")).alias("avg_line_value"),
        round2(ratio("_revenue", "total_orders")).alias("avg_order_value")).orderBy(F.desc("full_date"))


def monthly_sales(star: Star) -> DataFrame:
    """An order has one date, so distinct orders per day add up by month."""
    per_day = star.fact_sales.groupBy("date_key").agg(
        F.count_distinct("order_id").alias("orders"), F.sum("revenue").alias("revenue"))
    return per_day.join(F.broadcast(star.v_calendar), "date_key").groupBy("year", "month", "month_name").agg(
        F.sum("orders").alias("orders"), round2(F.sum("revenue")).alias("revenue"))


def _yoy(out: DataFrame) -> DataFrame:
    return out.withColumns({
        "orders_yoy_change": F.col("current_orders") - F.col("prior_year_orders"),
        "revenue_yoy_change": round2(F.col("current_revenue") - F.col("prior_year_revenue")),
        "revenue_yoy_growth_percent": round2(percent(F.col("current_revenue") - F.col("prior_year_revenue"), "prior_year_revenue")),
    }).orderBy(F.desc("current_year"), F.desc("month"))


def monthly_yoy(star: Star) -> DataFrame:
    """Against the row 12 rows back; the window runs over one row per month."""
    w = W.orderBy("current_year", "month")
    m = monthly_sales(star).select(F.col("year").alias("current_year"), "month", "month_name",
                                   F.col("orders").alias("current_orders"), F.col("revenue").alias("current_revenue"))
    return _yoy(m.withColumns({"prior_year_orders": F.lag("current_orders", 12).over(w),
                               "prior_year_revenue": F.lag("current_revenue", 12).over(w)}))


def monthly_yoy_by_month(star: Star) -> DataFrame:
    """Against the same month of the year before, also when months are missing."""
    m = monthly_sales(star).select(F.col("year").alias("current_year"), "month", "month_name",
                                   F.col("orders").alias("current_orders"), F.col("revenue").alias("current_revenue"))
    prior = monthly_sales(star).select((F.col("year") + 1).alias("current_year"), "month",
                                       F.col("orders").alias("prior_year_orders"), F.col("revenue").alias("prior_year_revenue"))
    return _yoy(m.join(prior, ["current_year", "month"], "left"))


def weekday_weekend(star: Star, as_of, days: int = 90) -> DataFrame:
    per_day = since(star.fact_sales, "order_date", days_back(as_of, days)).groupBy("date_key").agg(
        F.count_distinct("order_id").alias("orders"), F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("lines"))
    g = per_day.join(F.broadcast(star.v_calendar), "date_key").groupBy("is_weekend", "day_name").agg(
        F.sum("orders").alias("total_orders"), round2(F.sum("revenue")).alias("total_revenue"),
        round2(ratio(F.sum("revenue"), F.sum("lines"))).alias("avg_line_value"))
    return g.select(
        F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("day_type"), "day_name", "total_orders",
        "total_revenue", "avg_line_value", round2(share("total_orders")).alias("order_percent"),
        round2(share("total_revenue")).alias("revenue_percent")).orderBy(rank_of("day_name", WEEKDAYS))


def executive_summary(star: Star, as_of, days: int = 30) -> DataFrame:
    """Two rows under the marketing headings; the sales row fills them by position."""
    m = since(star.fact_performance, "performance_date", days_back(as_of, days)).agg(
        *[F.sum(c).alias(c) for c in MEASURES]).select(
        F.lit("MARKETING PERFORMANCE").alias("metric_category"),
        F.col("impressions").alias("total_impressions"), F.col("clicks").alias("total_clicks"),
        round2(percent("clicks", "impressions")).alias("overall_ctr"), round2("cost").alias("marketing_spend"),
        F.col("conversions").alias("total_conversions"), round2(ratio("cost", "conversions")).alias("cost_per_conversion"),
        round2("revenue").alias("marketing_revenue"), round2(ratio("revenue", "cost")).alias("roas"))
    s = since(star.fact_sales, "order_date", days_back(as_of, days)).agg(
        F.count_distinct("order_id").alias("orders"), F.count(F.lit(1)).alias("lines"), F.sum("revenue").alias("revenue"))
    nothing = F.lit(None)
    s = s.select(
        F.lit("SALES PERFORMANCE").alias("metric_category"), F.col("orders").alias("total_impressions"),
        F.col("lines").alias("total_clicks"), nothing.cast("decimal(18,2)").alias("overall_ctr"),
        nothing.cast("decimal(18,2)").alias("marketing_spend"), nothing.cast("bigint").alias("total_conversions"),
        nothing.cast("decimal(18,2)").alias("cost_per_conversion"), round2("revenue").alias("marketing_revenue"),
        round2(ratio("revenue", "orders")).alias("roas"))
    return m.unionByName(s)


def _top_named(df: DataFrame, label: str, name: str, metric: Column, n: int) -> DataFrame:
    g = df.groupBy(name).agg(round2(metric).alias("metric"))
    return g.orderBy(F.desc_nulls_last("metric"), name).limit(n).select(
        F.lit(label).alias("category"), F.col(name).alias("name"), F.col("metric").cast("decimal(28,2)").alias("metric"))


def top5_everything(star: Star, as_of, n: int = 5) -> DataFrame:
    per_campaign = star.fact_performance.groupBy("campaign_key").agg(F.sum("revenue").alias("revenue"), F.sum("cost").alias("cost"))
    per_channel = star.fact_performance.groupBy("channel_key").agg(F.sum("revenue").alias("revenue"))
    per_product = star.fact_sales.groupBy("product_key").agg(F.sum("revenue").alias("revenue"))
    per_customer = star.fact_sales.groupBy("customer_key").agg(F.sum("revenue").alias("revenue"))
    revenue = F.sum("revenue")
    parts = [
        _top_named(per_campaign.join(star.v_campaign(as_of), F.col("campaign_key") == F.col("dim_campaign_sk")),
                   "Top 5 Campaigns by ROAS", "campaign_name", ratio(revenue, F.sum("cost")), n),
        _top_named(per_channel.join(star.v_channel, F.col("channel_key") == F.col("dim_channel_sk")),
                   "Top 5 Channels by Revenue", "channel_name", revenue, n),
        _top_named(per_product.join(star.v_product, F.col("product_key") == F.col("dim_product_sk")),
                   "Top 5 Products by Revenue", "product_name", revenue, n),
        _top_named(per_customer.join(star.v_customer, F.col("customer_key") == F.col("dim_customer_sk")),
                   "Top 5 Customers by Revenue", "customer_name", revenue, n)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("category", F.desc("metric"), "name")


def channel_roas(star: Star, as_of, months: int = 3) -> DataFrame:
    f = _reduce(since(star.fact_performance, "performance_date", months_back(as_of, months)), "channel_key")
    g = f.join(star.v_channel, F.col("channel_key") == F.col("dim_channel_sk")).groupBy("channel_name").agg(
        F.sum("cost").alias("total_cost"), F.sum("revenue").alias("total_revenue"),
        round2(ratio(F.sum("revenue"), F.sum("cost"))).alias("roas"))
    return g.orderBy(F.desc_nulls_last("roas"), "channel_name")


# ---- straight from the cleansed layer --------------------------------------------------------------

def tier_segment_ltv(customers: DataFrame) -> DataFrame:
    g = customers.where(F.col("status") == "Active").groupBy("tier", "segment").agg(
        F.count(F.lit(1)).alias("customer_count"), mean2("lifetime_value").alias("avg_ltv"),
        round2(F.sum("lifetime_value")).alias("total_ltv"))
    return g.orderBy(F.desc("avg_ltv"), "tier", "segment")


def daily_sales_silver(sales: DataFrame, as_of, days: int = 30) -> DataFrame:
    g = since(sales, "order_date", days_back(as_of, days)).groupBy("order_date").agg(
        F.count_distinct("order_id").alias("total_orders"), F.count(F.lit(1)).alias("total_line_items"),
        F.sum("quantity").alias("total_units"), round2(F.sum("revenue")).alias("total_revenue"),
        mean2("revenue").alias("avg_line_value"))
    return g.orderBy(F.desc("order_date"))


def top_campaigns_silver(performance: DataFrame, campaigns: DataFrame, min_spend: int = 1000, n: int = 10) -> DataFrame:
    f = performance.groupBy("campaign_id").agg(F.sum("cost").alias("cost"), F.sum("revenue").alias("revenue"),
                                               F.count(F.lit(1)).alias("days"))
    g = f.join(campaigns.select("campaign_id", "campaign_name", "campaign_type"), "campaign_id").groupBy(
        "campaign_name", "campaign_type").agg(
        F.sum("days").alias("days_running"), F.sum("cost").alias("total_cost"), F.sum("revenue").alias("total_revenue"),
        round2(ratio(F.sum("revenue"), F.sum("cost"))).alias("roas"))
    return _top(g.where(F.col("total_cost") > min_spend), n, F.desc_nulls_last("roas"), "campaign_name", "campaign_type")


def channels_silver(performance: DataFrame, channels: DataFrame) -> DataFrame:
    f = performance.groupBy("channel_id").agg(
        *[F.sum(c).alias(c) for c in ("impressions", "clicks", "cost", "revenue")], F.count(F.lit(1)).alias("days"))
    g = f.join(channels.select("channel_id", "channel_name", "channel_type"), "channel_id").groupBy(
        "channel_name", "channel_type").agg(
        F.sum("days").alias("days_active"), F.sum("impressions").alias("total_impressions"),
        F.sum("clicks").alias("total_clicks"), round2(percent(F.sum("clicks"), F.sum("impressions"))).alias("ctr"),
        round2(F.sum("cost")).alias("total_cost"), round2(F.sum("revenue")).alias("total_revenue"),
        round2(ratio(F.sum("revenue"), F.sum("cost"))).alias("roas"))
    return g.orderBy(F.desc_nulls_last("roas"), "channel_name")


def customers_by_ltv(customers: DataFrame, n: int = 20) -> DataFrame:
    return _top(customers.select("customer_id", "customer_name", "email", "segment", "tier", "lifetime_value"), n,
                F.desc("lifetime_value"), "customer_id")


def campaigns_by_budget(campaigns: DataFrame, n: int = 10) -> DataFrame:
    return _top(campaigns.select("campaign_id", "campaign_name", "campaign_type", "status", "budget", "start_date", "end_date",
                                 F.datediff("end_date", "start_date").alias("duration_days")), n,
                F.desc("budget"), "campaign_id")


def campaign_status(campaigns: DataFrame) -> DataFrame:
    return campaigns.groupBy("status").agg(
        F.count(F.lit(1)).alias("campaign_count"), F.sum("budget").alias("total_budget"),
        mean2("budget").alias("avg_budget")).orderBy(F.desc("campaign_count"), "status")


def products_by_margin(products: DataFrame, n: int = 10) -> DataFrame:
    cols = ["product_id", "product_name", "category", "brand", "unit_price", "cost", "margin", "margin_percent"]
    return _top(products.where(F.col("product_status") == "Active").select(*cols), n, F.desc("margin_percent"), "product_id")


def category_profit(products: DataFrame) -> DataFrame:
    return products.where(F.col("product_status") == "Active").groupBy("category").agg(
        F.count(F.lit(1)).alias("product_count"), mean2("unit_price").alias("avg_price"),
        mean2("margin_percent").alias("avg_margin_pct")).orderBy(F.desc("avg_margin_pct"), "category")


def top_selling_products(sales: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    f = sales.groupBy("product_id").agg(F.count(F.lit(1)).alias("order_count"), F.sum("quantity").alias("total_quantity"),
                                        round2(F.sum("revenue")).alias("total_revenue"))
    named = f.join(products.select("product_id", "product_name", "category"), "product_id")
    return _top(named.select("product_id", "product_name", "category", "order_count", "total_quantity", "total_revenue"),
                n, F.desc("total_revenue"), "product_id")


def silver_daily_volume(table: DataFrame, n: int = 7) -> DataFrame:
    """Rows loaded per day, newest days first."""
    return _top(table.groupBy(F.to_date("load_timestamp").alias("load_date")).agg(F.count(F.lit(1)).alias("records_loaded")),
                n, F.desc("load_date"))


# ---- segmentation and pacing -----------------------------------------------------------------------

def score_by_cuts(value: str, cuts: Column, ascending: bool = True) -> Column:
    """1..5 by four cut points held in an array."""
    below = F.size(F.filter(cuts, lambda c: c < F.col(value)))
    return below + 1 if ascending else 5 - below


def rfm(star: Star, as_of, at_risk_days: int = 180, lost_days: int = 365) -> DataFrame:
    """Recency, frequency and monetary scores (1-5) and a segment per customer.

    Scores come from the exact quintile cut points of the whole table, found
    from counts of values in ordered buckets, so no customer list is sorted in
    one task; equal values always get equal scores.
    """
    per_key = star.fact_sales.groupBy("customer_key").agg(
        F.max("order_date").alias("last_order"), F.count_distinct("order_id").alias("frequency"),
        F.sum("revenue").cast("decimal(18,2)").alias("monetary"))
    base = per_key.withColumn("recency_days", F.datediff(day(as_of), "last_order"))
    quintiles = exact_cuts(base, ["recency_days", "frequency", "monetary"], [(1, 5), (2, 5), (3, 5), (4, 5)])
    cuts = quintiles.agg(F.map_from_entries(F.collect_list(F.struct("column_name", "cuts")))).scalar()  # three rows
    scored = base.withColumn("_cuts", cuts).withColumns({
        "r_score": score_by_cuts("recency_days", F.col("_cuts")["recency_days"], ascending=False),
        "f_score": score_by_cuts("frequency", F.col("_cuts")["frequency"]),
        "m_score": score_by_cuts("monetary", F.col("_cuts")["monetary"])})
    r, f, m = F.col("recency_days"), F.col("f_score"), F.col("m_score")
    segment = (F.when(r > lost_days, "Lost").when(r >= at_risk_days, "At Risk")
               .when((F.col("r_score") >= 4) & (f >= 4) & (m >= 4), "Champions")
               .when((f >= 3) & (m >= 3), "Loyal").otherwise("Regular"))
    named = scored.join(star.v_customer.select("dim_customer_sk", "natural_key"),
                        F.col("customer_key") == F.col("dim_customer_sk"))
    return named.select(F.col("natural_key").alias("customer_id"), "recency_days", "frequency", "monetary",
                        "r_score", "f_score", "m_score", segment.alias("rfm_segment"))


def campaign_pacing(star: Star, as_of, target_ratio: float = 3.0) -> DataFrame:
    """Budget used and target reached per campaign and day.

    The target column is revenue of `target_ratio` times the budget, spread
    evenly over the campaign's days. Red: spend 20 % or more over budget.
    Yellow: revenue 10 % or more under the target due by that day.
    """
    c = star.v_campaign(as_of).select("dim_campaign_sk", "natural_key", "campaign_budget", "campaign_start_date", "campaign_duration_days")
    w = W.partitionBy("campaign_key").orderBy("date_key").rowsBetween(W.unboundedPreceding, 0)
    run = star.fact_campaign_daily.select(
        "campaign_key", "date_key",
        F.sum("total_cost").over(w).alias("spend_to_date"), F.sum("total_revenue").over(w).alias("revenue_to_date"))
    j = run.join(c, F.col("campaign_key") == F.col("dim_campaign_sk")).join(
        F.broadcast(star.v_calendar.select("date_key", "full_date")), "date_key")
    j = j.withColumn("campaign_day", F.datediff("full_date", "campaign_start_date") + 1).where(F.col("campaign_day") >= 1)
    due = F.least("campaign_day", "campaign_duration_days")
    target = F.col("campaign_budget") * F.lit(str(target_ratio)).cast("decimal(6,2)")
    j = j.withColumns({
        "budget_percent": round2(percent("spend_to_date", "campaign_budget")),
        "target_percent": round2(percent("revenue_to_date", target)),
        "due_percent": round2(percent(due, "campaign_duration_days"))})
    status = (F.when(F.col("budget_percent") >= 120, "Red")
              .when(F.col("target_percent") <= F.col("due_percent") - 10, "Yellow").otherwise("Green"))
    return j.select(F.col("natural_key").alias("campaign_id"), "full_date", "campaign_day", "spend_to_date", "revenue_to_date",
                    "budget_percent", "target_percent", "due_percent", status.alias("pacing_status"))
