"""Comparisons by digest trees, held against full comparisons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark import session
from tidemark.operators import digests as d
from tidemark.plans.star import CUSTOMER_COLUMNS, silver_table

from . import states
from .ctes import CAMPAIGN_ATTRS, FIRST_LOADS
from .history import _names, _same
from .registry import query

_CHANGES = ("master_budget compare_budget", "master_start_date master_end_date compare_start_date compare_end_date")


def _digested(spark, name: str, df, keys: list[str], n_leaves: int | None = None) -> d.DigestedTable:
    return d.DigestedTable.write(df, session.scratch_path(spark, f"digests-{name}"), keys, n_leaves)


def _pair(spark, name: str, master, compare, keys: list[str]) -> tuple[d.DigestedTable, d.DigestedTable]:
    """Both sides with the leaves that the master side asks for."""
    m = _digested(spark, f"{name}-master", master, keys)
    return m, _digested(spark, f"{name}-compare", compare, keys, m.n_leaves)


@query("detect_changes_by_digest", f"""
SELECT coalesce(m.campaign_id, c.campaign_id) AS campaign_id,
  CASE WHEN c.campaign_id IS NULL THEN 'N' WHEN m.campaign_id IS NULL THEN 'D' WHEN {_same} THEN 'I' ELSE 'C' END AS change_type,
  {', '.join(f'm.{a} AS master_{a}, c.{a} AS compare_{a}' for a in _names(CAMPAIGN_ATTRS))}
FROM c2_campaigns m FULL JOIN c1_campaigns c ON m.campaign_id = c.campaign_id""", *_CHANGES)
def detect_changes_by_digest(spark, sf):
    """The full comparison of two loads of the campaigns, from their digest trees and the leaves that differ."""
    cols = ["campaign_id", *_names(CAMPAIGN_ATTRS)]
    return d.changes_by_digest(*_pair(spark, "campaigns", states.campaigns_after(spark, sf).select(*cols),
                                      states.campaigns_before(spark, sf).select(*cols), ["campaign_id"]))


_SALES = ["order_line_id", "order_id", "customer_id", "product_id", "quantity", "unit_price", "revenue", "source_load_timestamp"]


def _reconciled(name: str, master: str, compare: str, key: str, columns: list[str]) -> str:
    same = " AND ".join(f"m.{c} IS NOT DISTINCT FROM c.{c}" for c in columns)
    return (f"SELECT '{name}' AS table_name, count(*) FILTER (c.{key} IS NULL) AS only_master, count(*) FILTER (m.{key} IS NULL) AS only_compare, "
            f"count(*) FILTER (m.{key} = c.{key} AND NOT ({same})) AS differing, count(*) FILTER (m.{key} = c.{key} AND {same}) AS same "
            f"FROM {master} m FULL JOIN {compare} c ON m.{key} = c.{key}")


@query("digest_reconcile", "\nUNION ALL ".join([
    _reconciled("customers", "c2_customers", "c1_customers", "customer_id", CUSTOMER_COLUMNS),
    _reconciled("sales", "s_sales", f"(SELECT * FROM s_sales WHERE source_load_timestamp <= TIMESTAMP '{FIRST_LOADS}')", "order_line_id", _SALES)]))
def digest_reconcile(spark, sf):
    """Rows that two states of customers and sales do not share, from digest trees; equal leaves are counted and not read."""
    sales = silver_table(spark, sf, "sales").select(*_SALES)
    pairs = {"customers": _pair(spark, "customers", states.customers_after(spark, sf), states.customers_before(spark, sf), ["customer_id"]),
             "sales": _pair(spark, "sales", sales, sales.where(F.col("source_load_timestamp") <= F.lit(FIRST_LOADS).cast("timestamp_ntz")), ["order_line_id"])}
    return reduce(DataFrame.unionByName, [d.reconcile(name, *pair) for name, pair in pairs.items()])
