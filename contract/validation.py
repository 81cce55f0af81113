"""The validation script."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import validation as v
from tidemark.plans.star import gold, silver_table
from tidemark.sources import entities

from .ctes import AS_OF_SALES, RUN_TS, div, pct, rnd
from .registry import query

NOW = "2024-02-03 12:00:00"
MINIMUM = {"channels": 20, "campaigns": 1000, "customers": 10000, "products": 1000, "sales": 100000, "performance": 50000}


def bronze(spark, sf):
    return {n: entities.BRONZE[n](spark, sf) for n in entities.BRONZE}


def _ok(test: str) -> str:
    return f"CASE WHEN {test} THEN '✅ PASS' ELSE '❌ FAIL' END AS status"


@query("val_row_counts", " UNION ALL ".join(
    f"SELECT 'Bronze - {t.title()}' AS layer_table, count(*) AS row_count, {n} AS expected_min, {_ok(f'count(*) >= {n}')} FROM b_{t}" for t, n in MINIMUM.items()))
def val_row_counts(spark, sf):
    b = bronze(spark, sf)
    return v.row_counts({f"Bronze - {t.title()}": (b[t], n) for t, n in MINIMUM.items()})


KEYS = {"Campaigns": "campaign_id", "Customers": "customer_id", "Products": "product_id", "Sales": "order_line_id", "Performance": "performance_id"}


@query("val_null_keys", " UNION ALL ".join(
    f"SELECT '{t} - NULL {k}' AS check_name, count(*) AS null_count, {_ok('count(*) = 0')} FROM b_{t.lower()} WHERE {k} IS NULL" for t, k in KEYS.items()))
def val_null_keys(spark, sf):
    b = bronze(spark, sf)
    return v.null_keys({t: (b[t.lower()], k) for t, k in KEYS.items()})


@query("val_duplicates", " UNION ALL ".join(
    f"SELECT '{t} - Duplicates' AS check_name, count(*) AS duplicate_count, {_ok('count(*) = 0')} FROM (SELECT {k} FROM b_{t.lower()} GROUP BY 1 HAVING count(*) > 1)"
    for t, k in KEYS.items()))
def val_duplicates(spark, sf):
    b = bronze(spark, sf)
    return v.duplicates({t: (b[t.lower()], k) for t, k in KEYS.items()})


LINKS = [("Sales", "sales", "customers", "customer_id"), ("Sales", "sales", "products", "product_id"), ("Sales", "sales", "campaigns", "campaign_id"),
         ("Performance", "performance", "campaigns", "campaign_id"), ("Performance", "performance", "channels", "channel_id")]


@query("val_orphans", " UNION ALL ".join(
    f"SELECT '{n} - Orphaned {k}' AS check_name, count(*) AS orphan_count, {_ok('count(*) = 0')} FROM b_{c} WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {k} FROM b_{p})"
    for n, c, p, k in LINKS))
def val_orphans(spark, sf):
    b = bronze(spark, sf)
    return v.missing_parents([(n, b[c], b[p], k) for n, c, p, k in LINKS])


RULES = [("Campaigns - Negative budget", "campaigns", "budget < 0"), ("Campaigns - Invalid date range", "campaigns", "end_date < start_date"),
         ("Products - Non-positive unit_price", "products", "unit_price <= 0"), ("Products - Non-positive cost", "products", "cost <= 0"),
         ("Products - Negative margin", "products", "margin < 0"), ("Sales - Non-positive quantity", "sales", "quantity <= 0"),
         ("Sales - Invalid revenue calculation", "sales", "abs(revenue - (line_total + tax_amount)) > 0.01"),
         ("Performance - Clicks > Impressions", "performance", "clicks > impressions"), ("Performance - Conversions > Clicks", "performance", "conversions > clicks"),
         ("Performance - Negative cost", "performance", "cost < 0"), ("Performance - Negative revenue", "performance", "revenue < 0")]


@query("val_business_rules", " UNION ALL ".join(
    f"SELECT '{n}' AS check_name, count(*) AS violation_count, {_ok('count(*) = 0')} FROM b_{t} WHERE {c}" for n, t, c in RULES))
def val_business_rules(spark, sf):
    return v.business_rules(bronze(spark, sf))


RANGES = {"Campaigns Date Range": ("campaigns", "start_date", "end_date"), "Sales Date Range": ("sales", "order_date", "order_date"),
          "Performance Date Range": ("performance", "performance_date", "performance_date")}


@query("val_date_ranges", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, min({a}) AS earliest, max({b}) AS latest, date_diff('day', min({a}), max({b})) AS total_days_covered FROM b_{t}"
    for n, (t, a, b) in RANGES.items()), text="earliest latest")
def val_date_ranges(spark, sf):
    b = bronze(spark, sf)
    return v.date_ranges({n: (b[t], x, y) for n, (t, x, y) in RANGES.items()})


def _avg(c: str) -> str:
    return rnd(div(f"sum({c})", "count(*)"), 2)


_SUMMARIES = {
    ("Campaign Budget Summary", "campaigns"): {"total_campaigns": "count(*)", "total_budget": "sum(budget)", "avg_budget": _avg("budget"),
                                               "min_budget": "min(budget)", "max_budget": "max(budget)"},
    ("Customer LTV Summary", "customers"): {"total_customers": "count(*)", "total_ltv": "sum(lifetime_value)", "avg_ltv": _avg("lifetime_value"),
                                            "min_ltv": "min(lifetime_value)", "max_ltv": "max(lifetime_value)"},
    ("Product Pricing Summary", "products"): {"total_products": "count(*)", "avg_price": _avg("unit_price"), "avg_margin_pct": _avg("margin_percent"),
                                              "min_price": "min(unit_price)", "max_price": "max(unit_price)"},
    ("Sales Revenue Summary", "sales"): {"total_orders": "count(*)", "total_revenue": "sum(revenue)", "avg_order_value": _avg("revenue"),
                                         "min_order_value": "min(revenue)", "max_order_value": "max(revenue)"},
    ("Performance Metrics Summary", "performance"): {
        "total_records": "count(*)", "total_impressions": "sum(impressions)", "total_clicks": "sum(clicks)", "total_cost": "sum(cost)",
        "total_revenue": "sum(revenue)", "overall_roas": rnd(div("sum(revenue)", "sum(cost)"), 2), "overall_ctr": rnd(pct("sum(clicks)", "sum(impressions)"), 2)}}


@query("val_summaries", " UNION ALL ".join(
    f"SELECT '{c}' AS metric_category, '{m}' AS metric, CAST({e} AS DOUBLE) AS value FROM b_{t}" for (c, t), ms in _SUMMARIES.items() for m, e in ms.items()))
def val_summaries(spark, sf):
    return v.summaries(bronze(spark, sf))


@query("val_price_ge_cost", f"SELECT 'Products - Price below cost' AS check_name, count(*) AS violation_count, {_ok('count(*) = 0')} FROM s_products WHERE unit_price < cost")
def val_price_ge_cost(spark, sf):
    return v.price_below_cost(silver_table(spark, sf, "products"))


@query("val_freshness_48h", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, max(last_modified_timestamp) AS latest_timestamp, date_sub('hour', max(last_modified_timestamp), TIMESTAMP '{NOW}') AS hours_old, "
    + _ok(f"date_sub('hour', max(last_modified_timestamp), TIMESTAMP '{NOW}') <= 48") + f" FROM s_{t}" for t in ("campaigns", "customers", "performance")),
       text="latest_timestamp")
def val_freshness_48h(spark, sf):
    return v.freshness({t: (silver_table(spark, sf, t), "last_modified_timestamp") for t in ("campaigns", "customers", "performance")}, NOW)


_PAIRS = {"campaign": "campaigns", "customer": "customers", "product": "products", "channel": "channels"}


@query("val_dim_reconcile", " UNION ALL ".join(
    f"SELECT 'dim_{d}' AS table_name, (SELECT count(*) FROM d_{d}) AS dim_count, (SELECT count(*) FROM b_{s}) AS source_count, "
    f"abs((SELECT count(*) FROM d_{d}) - (SELECT count(*) FROM b_{s})) AS variance" for d, s in _PAIRS.items()))
def val_dim_reconcile(spark, sf):
    star = gold(spark, sf)
    return v.reconcile_counts({f"dim_{d}": (getattr(star, f"dim_{d}"), entities.BRONZE[s](spark, sf)) for d, s in _PAIRS.items()})


@query("val_fact_totals", f"""
SELECT CAST(sum(revenue) AS DOUBLE) AS total_revenue, count(DISTINCT customer_key) AS unique_customers, count(*) AS total_transactions
FROM f_sales WHERE date_key = CAST(strftime(DATE '{AS_OF_SALES}' - 1, '%Y%m%d') AS INT)""")
def val_fact_totals(spark, sf):
    return v.fact_totals(gold(spark, sf).fact_sales, v.yesterday_key(AS_OF_SALES))


@query("val_scores", f"""
SELECT {rnd(pct('(count(customer_id) + count(customer_name) + count(email) + count(tier))', '(4 * count(*))'), 2)} AS completeness_pct,
  {rnd(pct("count(*) FILTER (coalesce(regexp_matches(lower(trim(email)), '^[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{2,}$'), FALSE))", 'count(*)'), 2)} AS accuracy_pct
FROM b_customers""")
def val_scores(spark, sf):
    from tidemark.functions.expressions import email_valid
    return v.scores(entities.customers(spark, sf), ["customer_id", "customer_name", "email", "tier"], email_valid("email"))


@query("val_count_variance", f"""
SELECT day, rows_loaded, previous_count, {rnd(pct('(rows_loaded - previous_count)', 'previous_count'), 2)} AS variance_pct,
  coalesce(abs({rnd(pct('(rows_loaded - previous_count)', 'previous_count'), 2)}) > 20, FALSE) AS is_alert
FROM (SELECT *, lag(rows_loaded) OVER (ORDER BY day) AS previous_count FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS rows_loaded FROM events GROUP BY 1))""", text="day")
def val_count_variance(spark, sf):
    daily = entities.table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("rows_loaded"))
    return v.count_variance(daily, "day", "rows_loaded")


_POST = {"PERFORMANCE": ("performance", ["performance_id", "campaign_id"], "clicks > impressions OR conversions > clicks"),
         "SALES": ("sales", ["order_line_id", "customer_id"], "quantity <= 0"), "CAMPAIGNS": ("campaigns", ["campaign_id"], "end_date < start_date")}


@query("val_post_load", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count, count(*) FILTER ({' OR '.join(k + ' IS NULL' for k in ks)}) AS null_keys, count(*) FILTER ({r}) AS broken_rules, "
    f"max(load_timestamp) AS last_load, date_sub('minute', max(load_timestamp), TIMESTAMP '2024-02-05 00:07:30') AS minutes_ago FROM s_{t}"
    for n, (t, ks, r) in _POST.items()), text="last_load")
def val_post_load(spark, sf):
    parts = [v.post_load(n, silver_table(spark, sf, t), ks, F.expr(r), "load_timestamp", "2024-02-05 00:07:30") for n, (t, ks, r) in _POST.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_LAYERS = {"Bronze Campaigns": "b_campaigns", "Silver Campaigns": "s_campaigns", "Gold Dim Campaign": "d_campaign",
           "Bronze Sales": "b_sales", "Silver Sales": "s_sales", "Gold Fact Sales": "f_sales"}


@query("val_layer_counts", " UNION ALL ".join(f"SELECT '{n}' AS layer, count(*) AS row_count FROM {t}" for n, t in _LAYERS.items()))
def val_layer_counts(spark, sf):
    star = gold(spark, sf)
    return v.layer_counts({
        "Bronze Campaigns": entities.campaigns(spark, sf), "Silver Campaigns": silver_table(spark, sf, "campaigns"), "Gold Dim Campaign": star.dim_campaign,
        "Bronze Sales": entities.sales(spark, sf), "Silver Sales": silver_table(spark, sf, "sales"), "Gold Fact Sales": star.fact_sales})
