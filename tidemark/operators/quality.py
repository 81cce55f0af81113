"""Data quality engine: checks of one table share one pass, other checks are one-row plans."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from ..functions.expressions import ts
from .aggregates import exact_cuts

RESULT_COLUMNS = ["check_id", "actual_value", "expected_value", "check_status"]


class CriticalCheckFailed(RuntimeError):
    pass


@dataclass(frozen=True)
class Check:
    """One quality rule.

    Exactly one of `violates` (rows matching the condition are counted),
    `measure` (any aggregate) or `frame` (a one-row plan with the column
    actual) gives the actual value; `compare` relates it to `expected`.
    """

    check_id: str
    name: str
    layer: str
    dimension: str
    severity: str
    table: str | None = None
    violates: Callable[["Tables"], Column] | None = None
    measure: Callable[["Tables"], Column] | None = None
    frame: Callable[["Tables"], DataFrame] | None = None
    expected: float = 0.0
    compare: str = "eq"
    is_active: bool = True

    def status(self, actual: Column) -> Column:
        test = {"eq": actual == self.expected, "ge": actual >= self.expected, "le": actual <= self.expected}[self.compare]
        return F.when(test, "PASS").otherwise("FAIL")

    def aggregate(self, tables: "Tables") -> Column:
        value = F.count_if(self.violates(tables)) if self.violates else self.measure(tables)
        return value.cast("double")


class Tables(Mapping):
    """Named tables, built on first use."""

    def __init__(self, plans: Mapping[str, Callable[[], DataFrame]], **parameters):
        self._plans, self._seen, self.parameters = dict(plans), {}, parameters

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._seen:
            self._seen[name] = self._plans[name]()
        return self._seen[name]

    def __iter__(self):
        return iter(self._plans)

    def __len__(self):
        return len(self._plans)


REGISTRY_SCHEMA = T.StructType([
    T.StructField("check_id", T.StringType()), T.StructField("check_name", T.StringType()), T.StructField("layer", T.StringType()),
    T.StructField("dimension", T.StringType()), T.StructField("severity", T.StringType()), T.StructField("expected_value", T.DoubleType()),
    T.StructField("is_active", T.BooleanType())])


def check_registry(spark: SparkSession, checks: Sequence[Check]) -> DataFrame:
    return spark.createDataFrame(
        [(c.check_id, c.name, c.layer, c.dimension, c.severity, float(c.expected), c.is_active) for c in checks], REGISTRY_SCHEMA)


def _fused(tables: Tables, table: str, checks: Sequence[Check]) -> DataFrame:
    """All checks of one table in one aggregate, one row per check."""
    one = tables[table].agg(*[c.aggregate(tables).alias(c.check_id) for c in checks])
    rows = F.array(*[F.struct(
        F.lit(c.check_id).alias("check_id"), F.col(c.check_id).alias("actual_value"),
        F.lit(float(c.expected)).alias("expected_value"), c.status(F.col(c.check_id)).alias("check_status")) for c in checks])
    return one.select(F.inline(rows))


def _single(tables: Tables, check: Check) -> DataFrame:
    if check.frame is None:
        return _fused(tables, check.table, [check])
    actual = F.col("actual").cast("double")
    return check.frame(tables).select(
        F.lit(check.check_id).alias("check_id"), actual.alias("actual_value"),
        F.lit(float(check.expected)).alias("expected_value"), check.status(actual).alias("check_status"))


def evaluate(tables: Tables, checks: Sequence[Check]) -> DataFrame:
    """One lazy plan over many checks: each table is scanned once for all its row rules."""
    by_table: dict[str, list[Check]] = {}
    parts = []
    for c in checks:
        if c.frame is None:
            by_table.setdefault(c.table, []).append(c)
        else:
            parts.append(_single(tables, c))
    parts += [_fused(tables, table, group) for table, group in by_table.items()]
    return reduce(DataFrame.unionByName, parts)


LOG_SCHEMA = T.StructType([
    T.StructField("check_id", T.StringType()), T.StructField("actual_value", T.DoubleType()), T.StructField("expected_value", T.DoubleType()),
    T.StructField("check_status", T.StringType()), T.StructField("execution_time_seconds", T.DoubleType()),
    T.StructField("error_message", T.StringType())])


def run_check(spark: SparkSession, tables: Tables, check: Check) -> tuple:
    """Run one check now; a failing plan gives status ERROR with its message."""
    start = time.time()
    try:
        row = _single(tables, check).first()
        return (*row, time.time() - start, None)
    except Exception as e:
        return (check.check_id, None, float(check.expected), "ERROR", time.time() - start, str(e))


def run_layer_checks(spark: SparkSession, tables: Tables, checks: Sequence[Check], layer: str | None, run_id: str, run_ts: str,
                     environment: str = "PROD", by: Callable[[Tables, Sequence[Check]], DataFrame] = evaluate) -> DataFrame:
    """Run the active checks of a layer and return log rows.

    `by` gives the result rows of the checks, from the tables or from counts kept by partition. The fused plan is one job; only if it fails are the checks run one by one,
    so that one broken check does not hide the others. The results, one row
    per check, pass through the driver because they are the log of the run.
    """
    chosen = [c for c in checks if c.is_active and (layer is None or c.layer == layer)]
    start = time.time()
    try:
        rows = [tuple(r) for r in by(tables, chosen).select(*RESULT_COLUMNS).collect()]
        spent = (time.time() - start) / max(1, len(rows))
        results = [(*r, spent, None) for r in rows]
    except Exception:
        results = [run_check(spark, tables, c) for c in chosen]
    log = spark.createDataFrame(results, LOG_SCHEMA)
    return log.withColumns({
        "run_id": F.lit(run_id), "execution_timestamp": ts(run_ts), "environment": F.lit(environment),
        "variance": F.col("actual_value") - F.col("expected_value"), "alert_sent": F.lit(False)})


def layer_summary(log: DataFrame, registry: DataFrame) -> DataFrame:
    """Counts by run and layer."""
    return log.join(F.broadcast(registry.select("check_id", "layer", "severity")), "check_id").groupBy("run_id", "layer").agg(
        F.count(F.lit(1)).alias("executed"), F.count_if(F.col("check_status") == "PASS").alias("passed"),
        F.count_if(F.col("check_status") == "FAIL").alias("failed"), F.count_if(F.col("check_status") == "ERROR").alias("errors"))


def critical_failures(log: DataFrame, registry: DataFrame, run_id: str) -> DataFrame:
    critical = registry.where(F.col("severity") == "CRITICAL").select("check_id", F.col("check_name"))
    return log.where((F.col("run_id") == run_id) & (F.col("check_status") == "FAIL")).join(F.broadcast(critical), "check_id")


def critical_gate(log: DataFrame, registry: DataFrame, run_id: str) -> None:
    """Raise when a critical check of the run failed."""
    failed = critical_failures(log, registry, run_id).select("check_id").collect()
    if failed:
        raise CriticalCheckFailed(f"run {run_id}: " + ", ".join(sorted(r[0] for r in failed)))


# ---- alerts ----------------------------------------------------------------------------------------
def consecutive_failures(log: DataFrame) -> DataFrame:
    """Per check: failures since its last other result.

    Two aggregates by check with map-side combine; no ordered window, so one
    check with most of the log is no hot spot.
    """
    last_ok = log.where(F.col("check_status") != "FAIL").groupBy("check_id").agg(F.max("execution_timestamp").alias("_ok"))
    since = log.where(F.col("check_status") == "FAIL").join(last_ok, "check_id", "left").where(
        F.col("_ok").isNull() | (F.col("execution_timestamp") > F.col("_ok")))
    return since.groupBy("check_id").agg(
        F.count(F.lit(1)).alias("consecutive_failures"), F.max("execution_timestamp").alias("last_failure"))


# Failures in a row before an alert, by severity (fixed values).
ALERT_AFTER = {"CRITICAL": 1, "HIGH": 2}


def alert_decisions(log: DataFrame, registry: DataFrame, alert_after: Mapping[str, int] | None = None) -> DataFrame:
    """Which checks alert now; lower severities go to the daily summary."""
    limits = alert_after or ALERT_AFTER
    needed = F.lit(None).cast("int")
    for severity, n in limits.items():
        needed = F.when(F.col("severity") == severity, n).otherwise(needed)
    joined = consecutive_failures(log).join(registry.select("check_id", "check_name", "severity"), "check_id")
    decision = (F.when(needed.isNull(), "DAILY_SUMMARY").when(F.col("consecutive_failures") >= needed, "ALERT_NOW").otherwise("WAIT"))
    return joined.select("check_id", "check_name", "severity", "consecutive_failures", "last_failure", decision.alias("decision"))


def mark_alerted(log: DataFrame, alerted: DataFrame, now: str, hours: int = 1) -> DataFrame:
    """Set alert_sent on the recent unsent rows of the alerted checks."""
    recent = F.col("execution_timestamp") >= ts(now) - F.make_dt_interval(F.lit(0), F.lit(hours))
    flagged = log.join(alerted.select("check_id").distinct().withColumn("_alerted", F.lit(True)), "check_id", "left")
    return flagged.withColumn("alert_sent", F.col("alert_sent") | (F.coalesce("_alerted", F.lit(False)) & recent)).drop("_alerted")


# ---- issues, integrity, profiling ------------------------------------------------------------------
def issue_rows(df: DataFrame, table: str, record: str, rules: Sequence[tuple], stamp: Column) -> DataFrame:
    """One row per broken rule of every record; rules are (condition, column, type, rule, expected, severity)."""
    texts = [F.when(condition, F.struct(
        F.lit(kind).alias("issue_type"), F.lit(column).alias("column_name"), F.lit(expected).alias("expected_value"),
        F.col(column).cast("string").alias("actual_value"), F.lit(rule).alias("rule_violated"), F.lit(severity).alias("severity")))
        for condition, column, kind, rule, expected, severity in rules]
    broken = df.withColumn("_i", F.array_compact(F.array(*texts))).where(F.size("_i") > 0)
    return broken.select(F.lit(table).alias("table_name"), stamp.alias("issue_timestamp"),
                         F.col(record).alias("record_identifier"), F.inline("_i"), F.lit("OPEN").alias("resolution_status"))


def ri_log(links: Sequence[tuple[str, DataFrame, str, str, DataFrame, str]], run_ts) -> DataFrame:
    """Per foreign key: orphan rows and the five smallest orphan keys.

    Links are (fact name, fact, column, dimension name, dimension, key).
    Orphans are counted per key before anything is gathered, and the sample is
    a top-5, so neither grows with the number of orphans.
    """
    parts = []
    for fact_name, fact, column, dim_name, dim, key in links:
        keys = dim.select(F.col(key).alias(column))
        counts = fact.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
        lost = counts.join(keys, column, "left_anti")
        sample = lost.orderBy(column).limit(5).agg(F.array_sort(F.collect_list(F.col(column).cast("string")))).scalar()
        parts.append(lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphaned_record_count")).select(
            ts(run_ts).alias("check_timestamp"), F.lit(fact_name).alias("fact_table"), F.lit(dim_name).alias("dimension_table"),
            F.lit(column).alias("foreign_key_column"), "orphaned_record_count", sample.alias("sample_orphaned_keys"),
            F.lit("OPEN").alias("resolution_status")))
    return reduce(DataFrame.unionByName, parts)


def _frequent(column: str, n: int = 5) -> Column:
    """The most frequent values by sketch; nulls count as a value there and are left out."""
    found = F.call_function("approx_top_k", F.col(column).cast("string"), F.lit(n + 1))
    values = F.transform(F.filter(found, lambda s: s["item"].isNotNull()), lambda s: s["item"])
    return F.to_json(F.slice(values, 1, n))


def profile_columns(df: DataFrame, table: str, columns: Sequence[str] | None = None, accuracy: int = 10000,
                    approximate: bool = False) -> DataFrame:
    """Per column: rows, distinct, nulls, min, max, avg, median, deviation, five most frequent values.

    One pass gives the numeric measures of all columns but the median, which
    is exact and comes from counts of values. Another pass counts (column, value) pairs with
    map-side combine, which yields exact distinct counts and the top values
    without a distinct per column or a list of all values. `approximate`
    replaces both by sketches in the first.
    """
    columns = list(columns or df.columns)
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    nothing = F.lit(None).cast("double")
    stats = []
    for c in columns:
        n = F.col(c).cast("double")
        is_num = c in numeric
        stats.append(F.struct(
            F.lit(c).alias("column_name"), F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
            F.count(F.lit(1)).alias("row_count"), (F.count(F.lit(1)) - F.count(c)).alias("null_count"),
            *([F.approx_count_distinct(c).alias("distinct_count"),
               _frequent(c).alias("top_5_values")] if approximate else []),
            F.min(c).cast("string").alias("min_value"), F.max(c).cast("string").alias("max_value"),
            (F.avg(n) if is_num else nothing).alias("avg_value"),
            (F.percentile_approx(n, 0.5, accuracy) if is_num and approximate else nothing).alias("median_value"),
            (F.stddev(n) if is_num else nothing).alias("std_dev")))
    wide = df.agg(F.array(*stats).alias("_s")).select(F.inline("_s"))
    shaped = [
        F.lit(table).alias("table_name"), "column_name", "data_type", "row_count", F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"),
        "null_count", F.round(F.col("null_count") * 100.0 / F.col("row_count"), 2).alias("null_percentage"),
        "min_value", "max_value", F.round("avg_value", 4).alias("avg_value"), "median_value", F.round("std_dev", 4).alias("std_dev"), "top_5_values"]
    if approximate:
        return wide.select(*shaped)
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])).alias("_p"))
    counts = pairs.select("_p.*").where(F.col("v").isNotNull()).groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    distinct = counts.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_count"))
    w = W.partitionBy("column_name").orderBy(F.desc("n"), "v")
    top = counts.withColumn("_r", F.row_number().over(w)).where("_r <= 5").groupBy("column_name").agg(
        F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("_r", "v"))), lambda s: s["v"])).alias("top_5_values"))
    if numeric:
        medians = exact_cuts(df, numeric, [(1, 2)]).select("column_name", F.col("cuts")[0].alias("median_value"))
        wide = wide.drop("median_value").join(medians, "column_name", "left")
    return wide.join(distinct, "column_name", "left").join(top, "column_name", "left").select(*shaped)


def schema_check(actual: T.StructType, expected: T.StructType) -> list[tuple[str, str]]:
    """(column, problem) for every expected column that is missing or of another type."""
    have = {f.name.lower(): f.dataType for f in actual.fields}
    out = []
    for f in expected.fields:
        found = have.get(f.name.lower())
        if found is None:
            out.append((f.name, "missing"))
        elif found != f.dataType:
            out.append((f.name, f"{found.simpleString()} instead of {f.dataType.simpleString()}"))
    return out
