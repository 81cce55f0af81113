"""The gold star schema: built once from bronze, written, then read by every query."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cached_property
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import session
from ..functions import calendar as cal, silver
from ..functions.expressions import clean_id
from ..operators import facts, scd
from ..operators.changes import dedupe_latest
from ..sources import entities, sinks
from . import views

RUN_TS = "2024-02-05 00:00:00"

CAMPAIGN_COLUMNS = ["campaign_id", "campaign_name", "campaign_type", "status", "objective", "start_date", "end_date",
                    "budget", "duration_days", "source_system"]
CUSTOMER_COLUMNS = ["customer_id", "customer_name", "email", "phone", "segment", "tier", "status", "lifetime_value",
                    "email_valid", "phone_valid", "source_system"]
PRODUCT_COLUMNS = ["product_id", "sku", "product_name", "category", "subcategory", "brand", "product_status",
                   "unit_price", "cost", "margin", "margin_percent", "source_system"]
CHANNEL_COLUMNS = ["channel_id", "channel_name", "channel_type", "category", "cost_structure", "source_system"]

# ties between rows of one order line fall to the largest of the other columns
_SALES_TIES = ["order_id", "customer_id", "product_id", "campaign_id", "order_date", "order_timestamp", "quantity",
               "unit_price", "discount_amount", "tax_amount", "line_total", "revenue"]


def silver_table(spark: SparkSession, sf_dir: str, name: str, run_ts: str = RUN_TS, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """One cleansed entity, one row per natural key.

    Duplicates go before the cleansing: only survivors get derived columns,
    and those columns do not travel through the exchange. `part` (k, n) takes
    of the sales the k-th of n parts of the keys, with all rows of each.
    """
    bronze = entities.BRONZE[name](spark, sf_dir)
    if name == "sales":
        keyed = bronze.withColumn("order_line_id", clean_id("order_line_id"))
        if part[1] > 1:
            keyed = keyed.where(F.pmod(F.xxhash64("order_line_id"), F.lit(part[1])) == part[0])
        bronze = dedupe_latest(keyed, ["order_line_id"], [F.col(c).desc_nulls_last() for c in _SALES_TIES])
    return silver.SILVER[name](bronze, run_ts)


def calendar_bounds(spark: SparkSession, sf_dir: str) -> tuple[Column, Column]:
    """Whole years around all days the facts can have, as scalar subqueries."""
    orders = entities.table(spark, sf_dir, "orders").agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi"))
    events = entities.table(spark, sf_dir, "events").agg(F.to_date(F.min("ts")).alias("lo"), F.to_date(F.max("ts")).alias("hi"))
    both = orders.unionByName(events)
    first = both.agg(F.trunc(F.min("lo"), "year")).scalar()
    last = both.agg(F.date_sub(F.add_months(F.trunc(F.max("hi"), "year"), 12), 1)).scalar()
    return first, last


_STORING = RLock()


@dataclass
class Star:
    """Lazy plans of the star over one source folder; a table in `written` is read from its (path, schema),
    one in `kept` is written to its folder, after those it reads, when it is first asked for."""

    spark: SparkSession
    sf_dir: str
    run_ts: str = RUN_TS
    written: dict[str, tuple[str, T.StructType]] = field(default_factory=dict)
    kept: dict[str, str] = field(default_factory=dict)

    def silver(self, name: str) -> DataFrame:
        return self._get(f"silver_{name}", lambda: silver_table(self.spark, self.sf_dir, name, self.run_ts))

    def _get(self, name: str, plan) -> DataFrame:
        if name in self.kept:
            with _STORING, session.shuffles_freed(self.spark):
                if name not in self.written:
                    self.written[name] = _store(self.parts(name, plan()), name, self.kept[name])
        if name in self.written:
            path, schema = self.written[name]
            return self.spark.read.schema(schema).parquet(path)
        return plan()

    def parts(self, name: str, whole: DataFrame) -> list[DataFrame]:
        """The rows of a table in parts to be written one after the other; `whole` has all of them."""
        if name == "silver_sales":
            n = session.slices_for(session.source_bytes(whole))
            return [silver_table(self.spark, self.sf_dir, "sales", self.run_ts, (k, n)) for k in range(n)]
        if name == "fact_sales" and "silver_sales" in self.written:
            return [self._sales_facts(sales) for sales in sinks.file_slices(self.spark, *self.written["silver_sales"])]
        return [whole]

    def _sales_facts(self, sales: DataFrame) -> DataFrame:
        return facts.fact_sales(sales, self.dim_customer, self.dim_product, self.dim_campaign, self.dim_date, self.run_ts)

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._get("dim_date", lambda: cal.dim_date(self.spark, *calendar_bounds(self.spark, self.sf_dir)))

    @cached_property
    def dim_campaign(self) -> DataFrame:
        return self._get("dim_campaign", lambda: scd.scd2_initial(
            self.silver("campaigns").select(*CAMPAIGN_COLUMNS), "campaign_id", "campaign_key", self.run_ts))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self._get("dim_customer", lambda: scd.scd2_initial(
            self.silver("customers").select(*CUSTOMER_COLUMNS), "customer_id", "customer_key", self.run_ts))

    @cached_property
    def dim_product(self) -> DataFrame:
        return self._get("dim_product", lambda: scd.scd1(
            None, self.silver("products").select(*PRODUCT_COLUMNS), "product_id", "product_key", self.run_ts))

    @cached_property
    def dim_channel(self) -> DataFrame:
        return self._get("dim_channel", lambda: scd.scd3(
            None, self.silver("channels").select(*CHANNEL_COLUMNS), "channel_id", "channel_key", "category", self.run_ts))

    @cached_property
    def fact_performance(self) -> DataFrame:
        return self._get("fact_performance", lambda: facts.fact_performance(
            self.silver("performance"), self.dim_campaign, self.dim_channel, self.dim_date, self.run_ts))

    @cached_property
    def fact_sales(self) -> DataFrame:
        return self._get("fact_sales", lambda: self._sales_facts(self.silver("sales")))

    @cached_property
    def fact_campaign_daily(self) -> DataFrame:
        return self._get("fact_campaign_daily", lambda: facts.fact_campaign_daily(
            self.silver("performance"), self.dim_campaign, self.dim_date, self.run_ts))

    def v_campaign(self, as_of) -> DataFrame:
        return views.campaign(self.dim_campaign, as_of)

    @property
    def v_customer(self) -> DataFrame:
        return views.customer(self.dim_customer)

    @property
    def v_product(self) -> DataFrame:
        return views.product(self.dim_product)

    @property
    def v_channel(self) -> DataFrame:
        return views.channel(self.dim_channel)

    @property
    def v_calendar(self) -> DataFrame:
        return views.calendar(self.dim_date)


def month_of(column: str):
    return (F.year(column) * 100 + F.month(column)).alias("month_key")


# table, partition column source, sort columns
SILVER: list[tuple[str, str | None, list[str]]] = [
    ("silver_sales", "order_date", ["order_date"]), ("silver_performance", "performance_date", ["performance_date"]), ("silver_campaigns", None, []),
    ("silver_channels", None, []), ("silver_customers", None, []), ("silver_products", None, [])]
DIMENSIONS: list[tuple[str, str | None, list[str]]] = [
    ("dim_date", None, []), ("dim_campaign", None, []), ("dim_customer", None, []), ("dim_product", None, []), ("dim_channel", None, [])]
FACTS: list[tuple[str, str | None, list[str]]] = [
    ("fact_sales", "order_date", ["date_key"]), ("fact_performance", "performance_date", ["date_key"]), ("fact_campaign_daily", None, [])]
_SHAPES = {name: (dated, sort_by) for name, dated, sort_by in (*SILVER, *DIMENSIONS, *FACTS)}


def materialise(spark: SparkSession, sf_dir: str, root: str, run_ts: str = RUN_TS, concurrency: int = 4) -> Star:
    """Write the star below `root`: silver, dimensions, and facts that look keys up in written tables.

    Tables of one stage are independent jobs from `concurrency` driver
    threads. Sales, performance and facts are partitioned by month and sorted
    by day: date filters prune folders, then row groups.
    """
    return _written(Star(spark, sf_dir, run_ts), {name: f"{root}/{name}" for name in _SHAPES}, concurrency)


def _store(parts: Sequence[DataFrame], name: str, path: str) -> tuple[str, T.StructType]:
    """Write one table of the star, part by part; where it is and its columns."""
    dated, sort_by = _SHAPES[name]
    for k, df in enumerate(parts):
        sinks.write_new(df.withColumn("month_key", month_of(dated)) if dated else df, path, ["month_key"] if dated else [], sort_by, more=k > 0)
    schema = parts[0].schema
    return path, T.StructType([*schema.fields, T.StructField("month_key", T.IntegerType())]) if dated else schema


def _written(star: Star, paths: Mapping[str, str], concurrency: int = 4) -> Star:
    """The star with all its tables written and read from there."""
    spark = star.spark

    def write(name: str) -> tuple[str, tuple[str, T.StructType]]:
        df = star.silver(name.removeprefix("silver_")) if name.startswith("silver_") else getattr(star, name)
        return name, _store(star.parts(name, df), name, paths[name])

    with session.shuffles_freed(spark):
        for stage in (SILVER, DIMENSIONS, FACTS):
            with ThreadPoolExecutor(max_workers=concurrency) as pool:
                done = dict(pool.map(write, [name for name, *_ in stage if name not in star.written]))
            star = Star(spark, star.sf_dir, star.run_ts, {**star.written, **done})
    return star


_STORED: dict[tuple[str, str], tuple[dict, dict]] = {}


def _kept(spark: SparkSession, sf_dir: str) -> tuple[dict, dict]:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        folders = {kind: session.scratch_path(spark, kind) for kind in ("silver", "gold")}
        _STORED[key] = {}, {name: f"{folders['silver' if name.startswith('silver_') else 'gold']}/{name}" for name in _SHAPES}
    return _STORED[key]


def stored_silver(spark: SparkSession, sf_dir: str) -> Star:
    """A source folder whose silver tables are written in the shared folder, each on first use by this application."""
    written, kept = _kept(spark, sf_dir)
    return Star(spark, sf_dir, RUN_TS, written, {name: path for name, path in kept.items() if name.startswith("silver_")})


def gold(spark: SparkSession, sf_dir: str) -> Star:
    """The star of a source folder, silver included, whose tables are written in the shared folder, each on first use by
    this application: a query stores what it reads, and no table that it does not."""
    return Star(spark, sf_dir, RUN_TS, *_kept(spark, sf_dir))


def store_all(star: Star) -> Star:
    """A kept star with all its tables written at once, several at a time."""
    star.written.update(_written(Star(star.spark, star.sf_dir, star.run_ts, star.written), star.kept).written)
    return star
