"""Sample entities of any volume for trials; every value is a hash of the row number, so a run repeats exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.expressions import MONEY

# Row counts of a full sample set (fixed values).
VOLUMES = {"channels": 20, "campaigns": 1000, "customers": 10000, "products": 1000, "sales": 100000, "performance": 50000}


def _h(salt: str, modulus: int) -> Column:
    return F.pmod(F.xxhash64(F.col("id"), F.lit(salt)), F.lit(modulus))


def _pick(salt: str, labels: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in labels]), (_h(salt, len(labels)) + 1).cast("int"))


def _ident(prefix: str, value: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(value.cast("string"), F.greatest(F.lit(width), F.length(value.cast("string"))), F.lit("0")))


def _money(salt: str, low: int, high: int) -> Column:
    return (F.lit(low) + _h(salt, (high - low) * 100) * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY)


def sample_tables(spark: SparkSession, scale: float = 1.0) -> dict[str, DataFrame]:
    n = {k: max(1, int(v * scale)) for k, v in VOLUMES.items()}
    stamp = [F.lit("sample").alias("source_system"),
             F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 28 as int))").alias("last_modified_timestamp"),
             F.expr("timestamp_ntz'2024-02-01 00:00:00'").alias("load_timestamp")]
    percent = _h("tier", 100)
    tier = (F.when(percent < 5, "Platinum").when(percent < 20, "Gold").when(percent < 50, "Silver").otherwise("Bronze"))
    start = F.date_add(F.lit("2023-11-01").cast("date"), _h("start", 90).cast("int"))
    out = {
        "channels": spark.range(n["channels"]).select(
            _ident("CH-", F.col("id"), 2).alias("channel_id"), F.concat(F.lit("Channel "), F.col("id")).alias("channel_name"),
            _pick("type", ["Email", "Paid Search", "Display", "Social"]).alias("channel_type"),
            _pick("cat", ["Owned", "Earned", "Paid"]).alias("category"),
            _pick("cost", ["CPC", "CPM", "Fixed"]).alias("cost_structure"), *stamp),
        "campaigns": spark.range(n["campaigns"]).select(
            _ident("CPG-", F.col("id"), 6).alias("campaign_id"), F.concat(F.lit("Campaign "), F.col("id")).alias("campaign_name"),
            _pick("type", ["Awareness", "Conversion", "Retention"]).alias("campaign_type"), start.alias("start_date"),
            F.date_add(start, (_h("len", 77) + 14).cast("int")).alias("end_date"), _money("budget", 5000, 200000).alias("budget"),
            _pick("status", ["Active", "Paused", "Completed"]).alias("status"),
            _pick("goal", ["Reach", "Leads", "Sales"]).alias("objective"), *stamp),
        "customers": spark.range(n["customers"]).select(
            _ident("CUST-", F.col("id"), 8).alias("customer_id"), F.concat(F.lit("Customer "), F.col("id")).alias("customer_name"),
            F.concat(F.lit("user"), F.col("id"), F.lit("@example.com")).alias("email"),
            F.concat(F.lit("+1-555-"), F.lpad((F.col("id") % 10000).cast("string"), 4, "0")).alias("phone"),
            _pick("seg", ["Enterprise", "SMB", "Consumer"]).alias("segment"), tier.alias("tier"),
            F.when(_h("status", 100) < 85, "Active").otherwise("Inactive").alias("status"),
            _money("ltv", 0, 30000).alias("lifetime_value"), *stamp),
    }
    priced = spark.range(n["products"]).withColumn("unit_price", _money("price", 10, 400)).withColumn(
        "margin_percent", (_h("margin", 45) + 20).cast("decimal(18,4)")).withColumn(
        "margin", F.round(F.col("unit_price") * F.col("margin_percent") / 100, 2).cast(MONEY))
    out["products"] = priced.select(
        _ident("PROD-", F.col("id"), 6).alias("product_id"), F.concat(F.lit("SKU-"), F.col("id")).alias("sku"),
        F.concat(F.lit("Product "), F.col("id")).alias("product_name"), _pick("cat", ["Home", "Garden", "Office"]).alias("category"),
        _pick("sub", ["Basic", "Plus"]).alias("subcategory"), _pick("brand", ["North", "South"]).alias("brand"),
        "unit_price", (F.col("unit_price") - F.col("margin")).cast(MONEY).alias("cost"), "margin", "margin_percent",
        F.lit("Active").alias("product_status"), *stamp)
    day = F.date_add(F.lit("2024-01-01").cast("date"), _h("day", 365).cast("int"))
    lines = spark.range(n["sales"]).withColumns({
        "order_date": day, "quantity": (_h("qty", 9) + 1).cast("int"), "unit_price": _money("price", 10, 400)})
    lines = lines.withColumn("discount_amount", F.when(_h("disc", 100) < 30, F.col("quantity") * F.col("unit_price") * F.lit("0.10").cast("decimal(3,2)")
                                                       ).otherwise(F.lit(0)).cast(MONEY))
    lines = lines.withColumn("line_total", (F.col("quantity") * F.col("unit_price") - F.col("discount_amount")).cast(MONEY))
    lines = lines.withColumn("tax_amount", F.round(F.col("line_total") * F.lit("0.08").cast("decimal(3,2)"), 2).cast(MONEY))
    out["sales"] = lines.select(
        _ident("ORD-", F.expr("id div 3"), 10).alias("order_id"), _ident("LINE-", F.col("id"), 12).alias("order_line_id"),
        _ident("CUST-", _h("cust", n["customers"]), 8).alias("customer_id"),
        _ident("PROD-", _h("prod", n["products"]), 6).alias("product_id"),
        F.when(_h("camp", 10) < 7, _ident("CPG-", _h("cpg", n["campaigns"]), 6)).alias("campaign_id"),
        "order_date", F.col("order_date").cast("timestamp_ntz").alias("order_timestamp"), "quantity", "unit_price",
        "discount_amount", "tax_amount", "line_total",
        (F.col("line_total") + F.col("tax_amount")).cast(MONEY).alias("revenue"), *stamp)
    seen = spark.range(n["performance"]).withColumns({
        "performance_date": day, "impressions": _h("imp", 50000) + 1000, "cost": _money("cost", 50, 5000)})
    seen = seen.withColumn("clicks", F.floor(F.col("impressions") * (_h("ctr", 400) + 100) / 10000))
    out["performance"] = seen.select(
        _ident("PERF-", F.col("id"), 10).alias("performance_id"), _ident("CPG-", _h("cpg", n["campaigns"]), 6).alias("campaign_id"),
        _ident("CH-", _h("ch", n["channels"]), 2).alias("channel_id"), "performance_date", "impressions", "clicks", "cost",
        F.floor(F.col("clicks") * (_h("conv", 900) + 100) / 10000).alias("conversions"),
        (F.col("cost") * (_h("roas", 450) + 150) / 100).cast(MONEY).alias("revenue"), *stamp)
    return out
