"""Change detection, lookups, point in time, upsert, keys, slowly changing dimensions, retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import changes, keys, lookups, retention, scd, upsert as up
from tidemark.plans.star import CAMPAIGN_COLUMNS, CUSTOMER_COLUMNS, PRODUCT_COLUMNS, Star, gold, silver_table
from tidemark.sources.sinks import VersionedTable, load_dimension

from . import states
from .ctes import (CAMPAIGN_ATTRS, CHANGE_TS, CUSTOMER_ATTRS, FIRST_LOADS, PRODUCT_ATTRS, RUN_TS, RUN_TS2, dense)
from .registry import query

BALANCE = "load string, rows_read long, rows_loaded long, rows_collapsed long, rows_rejected long"
SCD2_TEXT = "valid_from valid_to created_timestamp updated_timestamp"


def _names(attrs: str) -> list[str]:
    return [a.strip() for a in attrs.split(",")]


_same = " AND ".join(f"m.{a} IS NOT DISTINCT FROM c.{a}" for a in _names(CAMPAIGN_ATTRS))


@query("detect_changes", f"""
SELECT coalesce(m.campaign_id, c.campaign_id) AS campaign_id,
  CASE WHEN c.campaign_id IS NULL THEN 'N' WHEN m.campaign_id IS NULL THEN 'D' WHEN {_same} THEN 'I' ELSE 'C' END AS change_type,
  {', '.join(f'm.{a} AS master_{a}, c.{a} AS compare_{a}' for a in _names(CAMPAIGN_ATTRS))}
FROM c2_campaigns m FULL JOIN c1_campaigns c ON m.campaign_id = c.campaign_id""", "master_budget compare_budget",
       "master_start_date master_end_date compare_start_date compare_end_date")
def detect_changes(spark, sf):
    attrs = _names(CAMPAIGN_ATTRS)
    cols = ["campaign_id", *attrs]
    return changes.detect_changes(states.campaigns_after(spark, sf).select(*cols), states.campaigns_before(spark, sf).select(*cols),
                                  ["campaign_id"], attrs)


_ORDER = """last_modified_timestamp DESC NULLS LAST, order_id DESC, customer_id DESC, product_id DESC, campaign_id DESC NULLS LAST,
  order_date DESC, order_timestamp DESC, quantity DESC, unit_price DESC, discount_amount DESC, tax_amount DESC, line_total DESC,
  revenue DESC, source_system DESC, load_timestamp DESC"""


@query("dedupe_latest", f"""
SELECT order_line_id, product_id, quantity, revenue, last_modified_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY order_line_id ORDER BY {_ORDER}) AS rn FROM b_sales) WHERE rn = 1""",
       "revenue", "last_modified_timestamp")
def dedupe_latest(spark, sf):
    from tidemark.sources import entities
    b = entities.sales(spark, sf)
    return changes.dedupe_latest(b, ["order_line_id"]).select(
        "order_line_id", "product_id", "quantity", "revenue", "last_modified_timestamp")


@query("win_row_number", """
SELECT customer_id, order_line_id AS first_line, order_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_timestamp, order_line_id) AS rn FROM s_sales) WHERE rn = 1""",
       text="order_timestamp")
def win_row_number(spark, sf):
    s = silver_table(spark, sf, "sales")
    first = s.groupBy("customer_id").agg(F.min(F.struct("order_timestamp", "order_line_id")).alias("f"))
    return first.select("customer_id", F.col("f.order_line_id").alias("first_line"), F.col("f.order_timestamp").alias("order_timestamp"))


# ---- lookups ---------------------------------------------------------------------------------------
@query("lookup_inner", """
SELECT performance_id, p.campaign_id, campaign_key FROM s_performance p JOIN d2_campaign d ON p.campaign_id = d.campaign_id AND is_current""")
def lookup_inner(spark, sf):
    p = silver_table(spark, sf, "performance").select("performance_id", "campaign_id")
    return lookups.lookup_inner(p, states.campaign_history(spark, sf), "campaign_id", "campaign_key")


@query("lookup_left_nullable", """
SELECT order_line_id, s.campaign_id, coalesce(campaign_key, -1) AS campaign_key FROM s_sales s
LEFT JOIN d2_campaign d ON s.campaign_id = d.campaign_id AND is_current""")
def lookup_left_nullable(spark, sf):
    s = silver_table(spark, sf, "sales").select("order_line_id", "campaign_id")
    return lookups.lookup_left(s, states.campaign_history(spark, sf), "campaign_id", "campaign_key", lookups.UNKNOWN_KEY)


@query("lookup_with_orphans", """
SELECT 'matched' AS part, count(*) AS row_total, CAST(sum(revenue) AS DOUBLE) AS revenue FROM s_sales WHERE campaign_id IN (SELECT campaign_id FROM c1_campaigns)
UNION ALL SELECT 'orphan', count(*), CAST(sum(revenue) AS DOUBLE) FROM s_sales
WHERE campaign_id IS NULL OR campaign_id NOT IN (SELECT campaign_id FROM c1_campaigns)""")
def lookup_with_orphans(spark, sf):
    """Facts split by whether their campaign was among the first loads: nothing is lost."""
    s = silver_table(spark, sf, "sales").select("order_line_id", "campaign_id", "revenue")
    parts = lookups.lookup_with_orphans(s, states.campaign_v1(spark, sf), "campaign_id", "campaign_key")
    named = [p.agg(F.lit(n).alias("part"), F.count(F.lit(1)).alias("row_total"), F.sum("revenue").alias("revenue"))
             for n, p in zip(("matched", "orphan"), parts)]
    return named[0].unionByName(named[1])


@query("date_key_join", """
SELECT order_line_id, date_key, is_weekend FROM s_sales JOIN d_date ON CAST(strftime(order_date, '%Y%m%d') AS INT) = date_key""")
def date_key_join(spark, sf):
    star = Star(spark, sf)
    keyed = lookups.join_calendar(silver_table(spark, sf, "sales").select("order_line_id", "order_date"), star.dim_date, "order_date")
    return keyed.join(F.broadcast(star.dim_date.select("date_key", "is_weekend")), "date_key").select(
        "order_line_id", "date_key", "is_weekend")


@query("asof_dimension", f"""
SELECT campaign_key, campaign_id, budget, version_number FROM d2_campaign
WHERE valid_from <= TIMESTAMP '2024-01-15 00:00:00' AND TIMESTAMP '2024-01-15 00:00:00' < valid_to""", "budget")
def asof_dimension(spark, sf):
    """The dimension at the very instant of the change: only the new versions."""
    return lookups.asof_dimension(states.campaign_history(spark, sf), CHANGE_TS).select("campaign_key", "campaign_id", "budget", "version_number")


@query("fact_asof_lookup", """
SELECT performance_id, campaign_key, version_number, d.budget FROM s_performance p JOIN d2_campaign d
ON p.campaign_id = d.campaign_id AND valid_from <= CAST(performance_date AS TIMESTAMP) AND CAST(performance_date AS TIMESTAMP) < valid_to""", "budget")
def fact_asof_lookup(spark, sf):
    p = silver_table(spark, sf, "performance").select("performance_id", "campaign_id", "performance_date")
    return lookups.fact_asof_lookup(p, states.campaign_history(spark, sf), "campaign_id", "performance_date", "campaign_key",
                                    ["version_number", "budget"]).select("performance_id", "campaign_key", "version_number", "budget")


@query("asof_merge", """
SELECT performance_id, campaign_key, version_number, d.budget FROM s_performance p JOIN d2_campaign d
ON p.campaign_id = d.campaign_id AND valid_from <= CAST(performance_date AS TIMESTAMP) AND CAST(performance_date AS TIMESTAMP) < valid_to""", "budget")
def asof_merge(spark, sf):
    """The same versions, found by merging rows and versions in order of time."""
    p = silver_table(spark, sf, "performance").select("performance_id", "campaign_id", "performance_date")
    return lookups.asof_merge(p, states.campaign_history(spark, sf), "campaign_id", "performance_date", "campaign_key",
                              ["version_number", "budget"]).select("performance_id", "campaign_key", "version_number", "budget")


@query("anti_orphans", """
SELECT order_line_id, campaign_id FROM s_sales WHERE campaign_id IS NOT NULL AND campaign_id NOT IN (SELECT campaign_id FROM c2_campaigns)""")
def anti_orphans(spark, sf):
    """Sales lines whose campaign is no longer in the source."""
    return lookups.orphans(silver_table(spark, sf, "sales").select("order_line_id", "campaign_id"),
                           states.campaigns_after(spark, sf), "campaign_id")


@query("semi_exists", """
SELECT customer_id, segment FROM s_customers c WHERE EXISTS (SELECT 1 FROM s_sales s WHERE s.customer_id = c.customer_id)""")
def semi_exists(spark, sf):
    return lookups.semi_exists(silver_table(spark, sf, "customers").select("customer_id", "segment"),
                               silver_table(spark, sf, "sales").select("customer_id"), ["customer_id"])


@query("self_version_history", """
SELECT customer_key, customer_id, tier, valid_from, valid_to, is_current, version_number FROM d2_customer
WHERE customer_id = (SELECT min(customer_id) FROM d2_customer WHERE version_number = 2)""", text="valid_from valid_to")
def self_version_history(spark, sf):
    dim = states.customer_history(spark, sf)
    changed = dim.where("version_number = 2").agg(F.min("customer_id")).scalar()
    return scd.version_history(dim, "customer_id", changed).select(
        "customer_key", "customer_id", "tier", "valid_from", "valid_to", "is_current", "version_number")


@query("join_generic", """
SELECT order_line_id, s.unit_price AS sold_at, p.unit_price AS list_price FROM s_sales s JOIN s_products p
ON s.product_id = p.product_id AND s.unit_price < p.unit_price""", "sold_at list_price")
def join_generic(spark, sf):
    s = silver_table(spark, sf, "sales").alias("s")
    p = silver_table(spark, sf, "products").alias("p")
    on = F.expr("s.product_id = p.product_id AND s.unit_price < p.unit_price")
    return lookups.join_generic(s, p, on).select(
        "order_line_id", F.col("s.unit_price").alias("sold_at"), F.col("p.unit_price").alias("list_price"))


@query("single_row_cross", """
SELECT (SELECT count(DISTINCT order_line_id) FROM b_sales) AS bronze_count, (SELECT count(*) FROM s_sales) AS silver_count""")
def single_row_cross(spark, sf):
    """Two one-row aggregates side by side, as scalar subqueries."""
    from tidemark.sources import entities
    lines = silver_table(spark, sf, "sales").agg(F.count(F.lit(1))).scalar()
    return entities.sales(spark, sf).agg(F.count_distinct("order_line_id").alias("bronze_count")).select(
        "bronze_count", lines.alias("silver_count"))


# ---- upsert and keys -------------------------------------------------------------------------------
@query("upsert", f"""
SELECT coalesce(t.customer_id, s.customer_id) AS customer_id, CASE WHEN t.customer_id IS NULL THEN s.customer_name ELSE t.customer_name END AS customer_name,
  coalesce(s.tier, t.tier) AS tier, coalesce(s.lifetime_value, t.lifetime_value) AS lifetime_value
FROM c1_customers t FULL JOIN c2_customers s ON t.customer_id = s.customer_id""", "lifetime_value")
def upsert(spark, sf):
    """Matched rows take tier and value, keep their name; others are inserted."""
    cols = ["customer_id", "customer_name", "tier", "lifetime_value"]
    return up.upsert(states.customers_before(spark, sf).select(*cols), states.customers_after(spark, sf).select(*cols),
                     ["customer_id"], update=["tier", "lifetime_value"])


@query("surrogate_key", f"SELECT {dense('order_line_id')} AS line_key, order_line_id FROM s_sales")
def surrogate_key(spark, sf):
    return keys.surrogate_key(silver_table(spark, sf, "sales").select("order_line_id"), ["order_line_id"], "line_key")


@query("scd1", f"""
SELECT d.product_key, s.product_id, {', '.join('s.' + a for a in _names(PRODUCT_ATTRS) if a != 'unit_price')},
  CAST(CASE WHEN s.category = 'SMALL' THEN s.unit_price + 5 ELSE s.unit_price END AS DOUBLE) AS unit_price, s.source_system,
  d.created_timestamp, TIMESTAMP '{RUN_TS2}' AS updated_timestamp
FROM s_products s JOIN (SELECT {dense('product_id')} AS product_key, product_id, TIMESTAMP '{RUN_TS}' AS created_timestamp
      FROM s_products WHERE source_load_timestamp <= TIMESTAMP '{FIRST_LOADS}') d ON s.product_id = d.product_id
UNION ALL
SELECT (SELECT count(*) FROM s_products WHERE source_load_timestamp <= TIMESTAMP '{FIRST_LOADS}') + {dense('s.product_id')}, s.product_id,
  {', '.join('s.' + a for a in _names(PRODUCT_ATTRS) if a != 'unit_price')},
  CAST(CASE WHEN s.category = 'SMALL' THEN s.unit_price + 5 ELSE s.unit_price END AS DOUBLE), s.source_system,
  TIMESTAMP '{RUN_TS2}', TIMESTAMP '{RUN_TS2}'
FROM s_products s WHERE source_load_timestamp > TIMESTAMP '{FIRST_LOADS}'""", "cost margin margin_percent",
       "created_timestamp updated_timestamp")
def scd1(spark, sf):
    """First loads, then all products with one category repriced."""
    base = scd.scd1(None, states.first(spark, sf, "products", PRODUCT_COLUMNS), "product_id", "product_key", RUN_TS)
    later = silver_table(spark, sf, "products").select(*PRODUCT_COLUMNS).withColumn(
        "unit_price", F.when(F.col("category") == "SMALL", F.col("unit_price") + 5).otherwise(F.col("unit_price")).cast("decimal(18,2)"))
    return scd.scd1(base, later, "product_id", "product_key", RUN_TS2)


@query("scd2_incremental", "SELECT * FROM d2_customer", "lifetime_value", SCD2_TEXT)
def scd2_incremental(spark, sf):
    return states.customer_v2(spark, sf)


@query("scd2_smart", "SELECT * FROM d2_campaign", "budget", f"start_date end_date {SCD2_TEXT}")
def scd2_smart(spark, sf):
    """Loads into a table that is empty at first: the initial branch, then the incremental one."""
    table = VersionedTable(spark, session.scratch_path(spark, "dim_campaign"))
    for source, ts in ((states.campaigns_before, "2023-11-01 00:00:00"), (states.campaigns_after, CHANGE_TS)):
        load_dimension(table, source(spark, sf), "campaign_id", lambda t, s: scd.scd2_load(t, s, "campaign_id", "campaign_key", ts), ts)
    return table.read()


@query("dimension_balance", f"""
SELECT '{CHANGE_TS}' AS load, count(*) AS rows_read, count(DISTINCT k) AS rows_loaded, count(k) - count(DISTINCT k) AS rows_collapsed,
  count(*) - count(k) AS rows_rejected, count(*) - count(k) AS kept_apart, count(DISTINCT k) AS in_dimension
FROM (SELECT CASE WHEN c_custkey % 3 <> 0 THEN c_custkey // 2 END AS k FROM customer)""")
def dimension_balance(spark, sf):
    """A dimension load with a null in a third of the keys and two rows for many others: what became of them."""
    from tidemark.sources.entities import table as given
    rows = given(spark, sf, "customer").select(F.when(F.col("c_custkey") % 3 != 0, F.expr("c_custkey div 2")).alias("customer_id"), "c_name", "c_mktsegment")
    table = VersionedTable(spark, session.scratch_path(spark, "dim_balance"))
    load_dimension(table, rows, "customer_id", lambda t, s: scd.scd2_load(t, s, "customer_id", "customer_key", CHANGE_TS), CHANGE_TS)
    [b] = table.balances()
    apart, inside = table.rejected().agg(F.count("*")).scalar(), table.read().agg(F.count("*")).scalar()
    return spark.createDataFrame([(b.load, b.read, b.loaded, b.collapsed, b.rejected)], BALANCE).withColumns({"kept_apart": apart, "in_dimension": inside})


@query("scd2_repair", "SELECT customer_key, customer_id, tier, valid_from, valid_to, is_current, version_number FROM d2_customer",
       text="valid_from valid_to")
def scd2_repair(spark, sf):
    """An append-only dimension whose old versions all stayed current, repaired."""
    broken = states.customer_history(spark, sf).select("customer_key", "customer_id", "tier", "valid_from", "version_number").withColumns({
        "valid_to": F.lit("9999-12-31 23:59:59").cast("timestamp_ntz"), "is_current": F.lit(True)})
    return scd.scd2_repair(broken, "customer_id").select(
        "customer_key", "customer_id", "tier", "valid_from", "valid_to", "is_current", "version_number")


@query("scd3", "SELECT * FROM d2_channel", text="category_changed_date created_timestamp updated_timestamp")
def scd3(spark, sf):
    return states.channel_v2(spark, sf)


@query("scd3_moved", "SELECT channel_id, channel_name, category_changed_date FROM d2_channel WHERE previous_category = 'Paid' AND current_category = 'Partner'",
       text="category_changed_date")
def scd3_moved(spark, sf):
    return scd.scd3_moved(states.channel_v2(spark, sf), "category", "Paid", "Partner").select(
        "channel_id", "channel_name", "category_changed_date")


_TRACK = ["tier", "segment", "status", "lifetime_value"]


def _audit_sql() -> str:
    base = "'DIM_CUSTOMER' AS dimension_table, 'TYPE_2' AS scd_type, {0}.customer_id AS natural_key, {0}.customer_key AS surrogate_key, {0}.version_number, {0}.valid_from, {0}.valid_to, {0}.is_current"
    parts = [
        f"SELECT {base.format('d')}, 'INSERT' AS operation_type, NULL AS attribute_changed, NULL AS old_value, NULL AS new_value FROM d2_customer d WHERE version_number = 1",
        f"SELECT {base.format('d')}, 'EXPIRE', NULL, NULL, NULL FROM d2_customer d WHERE NOT is_current"]
    parts += [f"SELECT {base.format('d')}, 'UPDATE', '{c}', CAST(p.{c} AS VARCHAR), CAST(d.{c} AS VARCHAR) FROM d2_customer d JOIN d2_customer p "
              f"ON d.customer_id = p.customer_id AND d.version_number = p.version_number + 1 WHERE d.{c} IS DISTINCT FROM p.{c}" for c in _TRACK]
    return "\nUNION ALL ".join(parts)


@query("dimension_audit", _audit_sql(), text="valid_from valid_to")
def dimension_audit(spark, sf):
    return scd.dimension_audit(states.customer_history(spark, sf), "customer_id", "customer_key", _TRACK, "DIM_CUSTOMER")


@query("q_tier_migration", """
SELECT from_tier, to_tier, count(*) AS customers FROM (
  SELECT lag(tier) OVER (PARTITION BY customer_id ORDER BY version_number) AS from_tier, tier AS to_tier FROM d2_customer)
WHERE from_tier IS NOT NULL AND from_tier <> to_tier GROUP BY ALL""")
def q_tier_migration(spark, sf):
    return scd.tier_moves(states.customer_history(spark, sf), "customer_id", "tier").groupBy("from_tier", "to_tier").agg(
        F.count(F.lit(1)).alias("customers"))


# ---- retention -------------------------------------------------------------------------------------
@query("archive_old", """
SELECT CASE WHEN ts < TIMESTAMP '2024-01-31' - INTERVAL 14 DAY THEN 'archive' ELSE 'keep' END AS part, event_id, event_type, ts FROM events""", text="ts")
def archive_old(spark, sf):
    """Events appended week by week, then archived by age: both sides as read back."""
    from tidemark.sources.entities import table
    events, t = table(spark, sf, "events"), VersionedTable(spark, session.scratch_path(spark, "events"))
    weeks = [None, "2024-01-08", "2024-01-15", "2024-01-22", None]
    for lo, hi in zip(weeks[:-1], weeks[1:]):
        after = F.col("ts") >= F.lit(lo).cast("timestamp_ntz") if lo else F.lit(True)
        t.append(events.where(after & (F.col("ts") < F.lit(hi).cast("timestamp_ntz")) if hi else after))
    retention.archive(t, "ts", 14, "2024-01-31")
    sides = [df.select(F.lit(n).alias("part"), "event_id", "event_type", "ts") for n, df in (("archive", t.archived()), ("keep", t.read()))]
    return sides[0].unionByName(sides[1])


def _retention(layer: str, days: int, table: str, column: str) -> str:
    cut = f"{column} < TIMESTAMP '2024-01-31' - INTERVAL {days} DAY"
    return f"SELECT '{layer}' AS layer, {days} AS retention_days, count(*) FILTER ({cut}) AS archive_rows, count(*) FILTER (NOT {cut}) AS keep_rows FROM {table}"


@query("retention_by_layer", " UNION ALL ".join([
    _retention("raw", 7, "events", "ts"), _retention("bronze", 14, "b_performance", "last_modified_timestamp"),
    _retention("silver", 30, "s_performance", "last_modified_timestamp")]))
def retention_by_layer(spark, sf):
    """Three tables, one merged by key, archived by the days of their layer; what both sides then hold."""
    from tidemark.sources import entities
    layers = {}
    for layer, rows, column in (("raw", entities.table(spark, sf, "events"), "ts"), ("bronze", entities.performance(spark, sf), "last_modified_timestamp"),
                                ("silver", silver_table(spark, sf, "performance"), "last_modified_timestamp")):
        t = VersionedTable(spark, session.scratch_path(spark, f"layer-{layer}"))
        t.merge(rows, ["performance_id"], column) if layer == "silver" else t.publish(rows)
        layers[layer] = t, column
    return retention.archive_layers(layers, "2024-01-31")
