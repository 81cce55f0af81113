"""Scans, sinks, ingestion, inference, JSON, watermarks, cleansing steps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidemark import session
from tidemark.functions import calendar as cal, silver
from tidemark.functions.expressions import clean_email, clean_id, conditions, fill
from tidemark.operators import infer, ingest, watermark as wm
from tidemark.operators.lookups import current
from tidemark.plans.star import silver_table
from tidemark.sources import entities, json_rows, sinks, tables
from tidemark.streaming import files

from . import states
from .ctes import RUN_TS, RUN_TS2
from .registry import query

MARK = "2024-01-16 00:00:00"


@query("scan_table", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders", text="o_orderdate")
def scan_table(spark, sf):
    return tables.scan_table(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_orderdate", "o_totalprice"])


@query("load_parquet_by_name", "SELECT l_orderkey AS L_OrderKey, l_quantity AS L_Quantity, l_shipdate AS L_ShipDate, CAST(NULL AS VARCHAR) AS L_Comment FROM lineitem",
       "L_Quantity", "L_ShipDate")
def load_parquet_by_name(spark, sf):
    """Matched by name whatever the case; an absent column becomes null."""
    schema = T.StructType([
        T.StructField("L_OrderKey", T.LongType()), T.StructField("L_Quantity", T.DecimalType(18, 2)),
        T.StructField("L_ShipDate", T.TimestampNTZType()), T.StructField("L_Comment", T.StringType())])
    return tables.load_parquet_by_name(spark, sf, "lineitem*.parquet", schema)


@query("jdbc_read_table", "SELECT * FROM customer")
def jdbc_read_table(spark, sf):
    """The whole table, as a relational read returns it; files stand in for the database here."""
    return tables.scan_table(spark, f"{sf}/customer.parquet")


@query("jdbc_incremental_read", f"SELECT event_id, user_id, event_type, value FROM events WHERE ts > TIMESTAMP '{MARK}'")
def jdbc_incremental_read(spark, sf):
    return tables.incremental_read(entities.table(spark, sf, "events"), "ts", MARK).select("event_id", "user_id", "event_type", "value")


# ---- sinks -----------------------------------------------------------------------------------------
@query("write_append", """
SELECT order_line_id AS line_id, revenue AS amount FROM s_sales UNION ALL SELECT order_line_id, revenue FROM s_sales WHERE revenue > 50000""", "amount")
def write_append(spark, sf):
    """Two appends with renamed columns, read back."""
    path = session.scratch_path(spark, "append")
    s = silver_table(spark, sf, "sales").select("order_line_id", "revenue")
    mapping = {"order_line_id": "line_id", "revenue": "amount"}
    sinks.write_append(s, path, mapping)
    sinks.write_append(s.where("revenue > 50000"), path, mapping)
    return spark.read.parquet(path)


@query("write_full_refresh", "SELECT order_line_id, revenue + tax_amount AS revenue FROM s_sales", "revenue")
def write_full_refresh(spark, sf):
    """A table replaced by a computation over itself."""
    t = sinks.VersionedTable(spark, session.scratch_path(spark, "refresh"))
    t.publish(silver_table(spark, sf, "sales").select("order_line_id", "revenue", "tax_amount"))
    sinks.load(t, t.read().select("order_line_id", (F.col("revenue") + F.col("tax_amount")).alias("revenue")), "replace")
    return t.read()


def _since(column: str) -> str:
    return f"{column} > TIMESTAMP '2024-02-02 00:00:00'"


@query("load_modes", f"""
SELECT 'initial' AS load_mode, count(*) AS row_total FROM s_customers WHERE NOT {_since('source_load_timestamp')}
UNION ALL SELECT 'replace', count(*) FROM s_customers WHERE {_since('source_load_timestamp')}
UNION ALL SELECT 'truncate_insert', count(*) FROM s_customers WHERE {_since('source_load_timestamp')}
UNION ALL SELECT 'incremental_append', count(*) FROM s_customers
UNION ALL SELECT 'incremental_merge', count(*) FROM s_customers""")
def load_modes(spark, sf):
    """The first loads published, then the whole source loaded in each mode."""
    s = silver_table(spark, sf, "customers")
    first = s.where(F.col("source_load_timestamp") <= F.lit("2024-02-02").cast("timestamp_ntz"))
    rest = s.where(F.col("source_load_timestamp") > F.lit("2024-02-02").cast("timestamp_ntz"))
    counted = []
    for mode in sinks.MODES:
        t = sinks.VersionedTable(spark, session.scratch_path(spark, f"mode-{mode}"))
        sinks.load(t, first, "initial")
        if mode in ("replace", "truncate_insert"):
            sinks.load(t, rest, mode)
        elif mode != "initial":
            sinks.load(t, s, mode, keys=["customer_id"], watermark="source_load_timestamp")
        counted.append(t.read().agg(F.lit(mode).alias("load_mode"), F.count(F.lit(1)).alias("row_total")))
    out = counted[0]
    for c in counted[1:]:
        out = out.unionByName(c)
    return out


@query("create_if_not_exists", "SELECT c_custkey, c_name FROM customer")
def create_if_not_exists(spark, sf):
    """Created empty from the source schema on first use, then filled; the second call changes nothing."""
    t = sinks.VersionedTable(spark, session.scratch_path(spark, "created"))
    source = entities.table(spark, sf, "customer").select("c_custkey", "c_name")
    sinks.create_if_not_exists(t, source)
    t.append(source)
    sinks.create_if_not_exists(t, source)
    return t.read()


# ---- configuration and inference -------------------------------------------------------------------
KEYS = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "part": ["p_partkey"],
        "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"]}
TIMES = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}


def given(spark, sf):
    return {n: entities.table(spark, sf, n) for n in KEYS}


def _dups(name: str) -> str:
    return f"(SELECT count(*) FROM (SELECT 1 FROM {name} GROUP BY {', '.join(KEYS[name])} HAVING count(*) > 1))"


def _nulls(name: str) -> str:
    return f"(SELECT count(*) FROM {name} WHERE {' OR '.join(k + ' IS NULL' for k in KEYS[name])})"


def _config_sql() -> str:
    rows = []
    for n, k in KEYS.items():
        time = (f"CASE WHEN (SELECT count(*) = count({TIMES[n]}) AND count(*) > 0 FROM {n}) THEN '{TIMES[n]}' ELSE 'NO_TIMESTAMP_COLUMN' END"
                if n in TIMES else "'NO_TIMESTAMP_COLUMN'")
        rows.append(f"SELECT '{n}' AS table_name, {time} AS incremental_column, "
                    f"CASE WHEN {_dups(n)} = 0 AND {_nulls(n)} = 0 THEN '{', '.join(k)}' ELSE 'NO_PRIMARY_KEY' END AS primary_key")
    return "\nUNION ALL ".join(rows)


@query("infer_table_config", _config_sql())
def infer_table_config(spark, sf):
    """Change columns and keys found on the data, without being told which columns may be keys."""
    return infer.infer_table_config(spark, given(spark, sf))


@query("config_read", f"""
SELECT c.*, n.total_rows FROM ({_config_sql()}) c JOIN ({' UNION ALL '.join(f"SELECT '{n}' AS table_name, count(*) AS total_rows FROM {n}" for n in KEYS)}) n
ON c.table_name = n.table_name""")
def config_read(spark, sf):
    """The inferred grid written as CSV, read back, with the size of each table."""
    path = session.scratch_path(spark, "config")
    infer.infer_table_config(spark, given(spark, sf), KEYS).write.option("header", "true").csv(path)
    return tables.config_read(spark, path).join(infer.row_counts(given(spark, sf)), "table_name")


@query("config_validate", f"""
SELECT * FROM (
  SELECT table_name, 'incremental column not found' AS issue FROM ({_config_sql()}) WHERE incremental_column = 'NO_TIMESTAMP_COLUMN'
  UNION ALL SELECT table_name, 'key column not found' FROM ({_config_sql()}) WHERE primary_key = 'NO_PRIMARY_KEY')""")
def config_validate(spark, sf):
    """The inferred grid checked against the schemas: its sentinels are not columns."""
    g = given(spark, sf)
    issues = infer.config_validate(infer.infer_table_config(spark, g, KEYS), infer.column_metadata(spark, g))
    return issues.select("table_name", "issue")


@query("time_column_null_profile", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS total_rows, count({c}) AS non_null_rows, count(*) - count({c}) AS null_rows, "
    f"min({c}) AS oldest, max({c}) AS newest FROM {t}" for t, c in TIMES.items()), text="oldest newest")
def time_column_null_profile(spark, sf):
    return infer.time_column_null_profile(given(spark, sf))


@query("key_uniqueness", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, '{', '.join(k)}' AS key_columns, (SELECT count(*) FROM {n}) AS total_rows, {_dups(n)} AS duplicate_keys, "
    f"{_nulls(n)} AS null_rows, {_dups(n)} = 0 AND {_nulls(n)} = 0 AS is_key" for n, k in KEYS.items()))
def key_uniqueness(spark, sf):
    return infer.key_uniqueness(given(spark, sf), KEYS)


def _sized(names) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS total_rows FROM {n}" for n in names)


@query("find_time_columns", f"""
SELECT i.table_name, i.column_name, t.total_rows FROM ({_sized(KEYS)}) t JOIN information_schema.columns i ON i.table_name = t.table_name
WHERE i.data_type LIKE 'TIMESTAMP%' OR i.data_type = 'DATE'""")
def find_time_columns(spark, sf):
    g = given(spark, sf)
    return infer.find_time_columns(infer.column_metadata(spark, g)).select("table_name", "column_name").join(
        infer.row_counts(g), "table_name")


@query("primary_keys", f"SELECT table_name, primary_key FROM ({_config_sql()}) WHERE primary_key <> 'NO_PRIMARY_KEY'")
def primary_keys(spark, sf):
    return infer.primary_keys(infer.key_uniqueness(given(spark, sf), KEYS))


@query("tables_without_time_column", _sized(n for n in KEYS if n not in TIMES))
def tables_without_time_column(spark, sf):
    g = given(spark, sf)
    return infer.tables_without_time_column(infer.column_metadata(spark, g)).join(infer.row_counts(g), "table_name")


@query("time_column_patterns", f"""
SELECT i.column_name, count(*) AS table_count, string_agg(i.table_name, ', ' ORDER BY i.table_name) AS tables, CAST(sum(t.total_rows) AS BIGINT) AS total_rows
FROM ({_sized(KEYS)}) t JOIN information_schema.columns i ON i.table_name = t.table_name WHERE i.column_name IN ('ts', 'o_orderdate', 'l_shipdate') GROUP BY ALL""")
def time_column_patterns(spark, sf):
    g = given(spark, sf)
    meta = infer.column_metadata(spark, g)
    sizes = infer.find_time_columns(meta).join(infer.row_counts(g), "table_name").groupBy("column_name").agg(
        F.sum("total_rows").alias("total_rows"))
    return infer.time_column_patterns(meta, list(TIMES.values())).join(sizes, "column_name")


@query("composite_keys", f"""
SELECT 'lineitem' AS table_name, 'l_orderkey, l_linenumber' AS key_columns, 2 AS pk_column_count, (SELECT count(*) FROM lineitem) AS total_rows,
  {_dups('lineitem')} AS duplicate_keys""")
def composite_keys(spark, sf):
    return infer.composite_keys(infer.key_uniqueness(given(spark, sf), KEYS)).select(
        "table_name", "key_columns", "pk_column_count", "total_rows", "duplicate_keys")


@query("column_presence", f"""
SELECT table_name, CASE WHEN table_name = 'orders' THEN '✅ Has Column' ELSE '❌ MISSING' END AS status, total_rows FROM ({_sized(KEYS)})""")
def column_presence(spark, sf):
    g = given(spark, sf)
    return infer.column_presence(infer.column_metadata(spark, g), "o_orderdate").select("table_name", "status").join(
        infer.row_counts(g), "table_name")


# ---- ingestion -------------------------------------------------------------------------------------
def _ingested(spark, sf):
    """Orders and events up to a day, then in full; lineitem without a key; one table that does not exist."""
    root = session.scratch_path(spark, "ingest")
    configs = [ingest.TableConfig("orders", "o_orderdate", ("o_orderkey",)), ingest.TableConfig("events", "ts", ("event_id",)),
               ingest.TableConfig("lineitem", "l_shipdate"), ingest.TableConfig("missing_table", "updated_at", ("id",))]
    early = {"orders": "1999-01-01", "events": "2024-01-16", "lineitem": "1999-01-01"}

    def until(name):
        df = entities.table(spark, sf, name)
        return df.where(F.col(next(c.incremental_column for c in configs if c.table_name == name)) < F.lit(early[name]).cast("timestamp_ntz"))

    ingest.multi_table_ingest(spark, configs, lambda n: until(n) if n in early else entities.table(spark, sf, n), root, "run-1", RUN_TS)
    ingest.multi_table_ingest(spark, configs, lambda n: entities.table(spark, sf, n), root, "run-2", RUN_TS2, concurrency=4)
    ingest.multi_table_ingest(spark, configs, lambda n: entities.table(spark, sf, n), root, "run-3", RUN_TS2, concurrency=4)
    return root, configs


def _log_sql() -> str:
    early = {"orders": ("o_orderdate", "1999-01-01"), "events": ("ts", "2024-01-16"), "lineitem": ("l_shipdate", "1999-01-01")}
    rows = []
    for n, (c, cut) in early.items():
        rows.append(f"SELECT 'run-1' AS run_id, '{n}' AS table_name, 'SUCCESS' AS status, count(*) AS row_count_affected FROM {n} WHERE {c} < TIMESTAMP '{cut}'")
        rows.append(f"SELECT 'run-2', '{n}', 'SUCCESS', count(*) FROM {n} WHERE {c} >= TIMESTAMP '{cut}'")
        rows.append(f"SELECT 'run-3', '{n}', 'SUCCESS', 0")
    rows += [f"SELECT '{r}', 'missing_table', 'FAILED', 0" for r in ("run-1", "run-2", "run-3")]
    return "\nUNION ALL ".join(rows)


@query("multi_table_ingest", """
SELECT 'orders' AS table_name, CAST(o_orderkey AS VARCHAR) AS row_key, CAST(o_totalprice AS DOUBLE) AS amount FROM orders
UNION ALL SELECT 'events', CAST(event_id AS VARCHAR), value FROM events
UNION ALL SELECT 'lineitem', l_orderkey || '-' || l_linenumber, CAST(l_extendedprice AS DOUBLE) FROM lineitem""")
def multi_table_ingest(spark, sf):
    """What the tables hold after three runs: every source row once, with its key and a value."""
    root, _ = _ingested(spark, sf)
    t = {n: sinks.VersionedTable(spark, f"{root}/{n}").read() for n in ("orders", "events", "lineitem")}
    parts = [(t["orders"], F.col("o_orderkey").cast("string"), "o_totalprice"), (t["events"], F.col("event_id").cast("string"), "value"),
             (t["lineitem"], F.concat_ws("-", "l_orderkey", "l_linenumber"), "l_extendedprice")]
    out = [df.select(F.lit(n).alias("table_name"), key.alias("row_key"), F.col(v).cast("double").alias("amount"))
           for n, (df, key, v) in zip(t, parts)]
    return out[0].unionByName(out[1]).unionByName(out[2])


# ---- rows without a key ----------------------------------------------------------------------------
CUT = "1995-01-01 00:00:00"
_KEYLESS = "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey // 2 END AS order_id, o_custkey, o_orderdate, o_totalprice"


def _keyless(spark, sf):
    """Orders up to a day and then all of them, with a null in a third of the keys and some keys given twice: merged."""
    root = session.scratch_path(spark, "keyless")
    rows = entities.table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 3 != 0, F.expr("o_orderkey div 2")).alias("order_id"), "o_custkey", "o_orderdate", "o_totalprice")
    early = rows.where(F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz"))
    config = ingest.TableConfig("orders", "o_orderdate", ("order_id",))
    for run, source in (("run-1", early), ("run-2", rows), ("run-3", rows)):
        log = ingest.multi_table_ingest(spark, [config], lambda _: source, root, run, RUN_TS)
        if log.where("status <> 'SUCCESS'").count():
            raise AssertionError(log.first()["error_message"])
    return sinks.VersionedTable(spark, f"{root}/orders")


def _balanced(run: str, when: str) -> str:
    return (f"SELECT '{run}' AS load, count(*) AS rows_read, count(DISTINCT order_id) AS rows_loaded, count(order_id) - count(DISTINCT order_id) AS rows_collapsed, "
            f"count(*) - count(order_id) AS rows_rejected FROM (SELECT {_KEYLESS} FROM orders) WHERE {when}")


@query("load_balance", f"{_balanced('run-1', f'o_orderdate < TIMESTAMP {chr(39)}{CUT}{chr(39)}')} UNION ALL {_balanced('run-2', f'o_orderdate >= TIMESTAMP {chr(39)}{CUT}{chr(39)}')}")
def load_balance(spark, sf):
    """Rows read by each load, and what became of them: read = loaded + collapsed + rejected. A run without news has none."""
    balances = _keyless(spark, sf).balances()
    if any(b.read != b.loaded + b.collapsed + b.rejected for b in balances):
        raise AssertionError(balances)
    return spark.createDataFrame([(b.load, b.read, b.loaded, b.collapsed, b.rejected) for b in balances],
                                 "load string, rows_read long, rows_loaded long, rows_collapsed long, rows_rejected long")


@query("rejected_rows", f"""
SELECT 'rejected' AS part, order_id, o_custkey, CAST(o_totalprice AS DOUBLE) AS amount, 'null key: order_id' AS rejected_for,
  CASE WHEN o_orderdate < TIMESTAMP '{CUT}' THEN 'run-1' ELSE 'run-2' END AS rejected_by FROM (SELECT {_KEYLESS} FROM orders) WHERE order_id IS NULL
UNION ALL
SELECT 'loaded', order_id, NULL, CAST(o_totalprice AS DOUBLE), NULL, NULL FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY o_orderdate DESC, o_custkey DESC, o_totalprice DESC) AS place
  FROM (SELECT {_KEYLESS} FROM orders) WHERE order_id IS NOT NULL) WHERE place = 1""")
def rejected_rows(spark, sf):
    """Rows that two loads could not take, with reason and load, beside the merged rows: the newest of each key."""
    t = _keyless(spark, sf)
    rejected = t.rejected().select(F.lit("rejected").alias("part"), "order_id", "o_custkey", F.col("o_totalprice").cast("double").alias("amount"),
                                   "rejected_for", "rejected_by")
    latest = Window.partitionBy("order_id")
    none = F.lit(None).cast("string")
    loaded = t.read().select(F.lit("loaded").alias("part"), "order_id", F.lit(None).cast(rejected.schema["o_custkey"].dataType).alias("o_custkey"),
                             F.col("o_totalprice").cast("double").alias("amount"), none.alias("rejected_for"), none.alias("rejected_by"))
    if not loaded.withColumn("n", F.count("*").over(latest)).where("n > 1").isEmpty():
        raise AssertionError("a key was loaded twice")
    return rejected.unionByName(loaded)


@query("ingest_log", _log_sql())
def ingest_log(spark, sf):
    """The log of the three runs: the increment, then nothing new, and the failing table each time."""
    root, _ = _ingested(spark, sf)
    return ingest.read_log(spark, root).select("run_id", "table_name", "status", "row_count_affected")


# ---- JSON ------------------------------------------------------------------------------------------
_RAW = "CASE WHEN event_type = 'error' THEN substr(props, 1, length(props) - 2) WHEN event_type = 'signup' THEN '{\"other\": 1}' ELSE props END"


def raw_events(spark, sf):
    """Events with their JSON text; errors are cut short and signups lack the field."""
    return entities.table(spark, sf, "events").selectExpr("event_id", f"{_RAW} AS raw_data")


@query("flatten_json", """
SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k, event_type = 'error' AS is_malformed
FROM events""")
def flatten_json(spark, sf):
    return json_rows.flatten_json(raw_events(spark, sf), "raw_data", {"k": ("$.k", "bigint")}, keep=["event_id"]).drop("raw_data")


@query("json_validation_issues", f"""
SELECT 'EVENTS' AS table_name, CAST(event_id AS VARCHAR) AS record_identifier, CASE WHEN event_type = 'error' THEN '$' ELSE '$.k' END AS json_path,
  CASE WHEN event_type = 'error' THEN 'malformed JSON' ELSE 'required path missing' END AS validation_error, {_RAW} AS raw_data
FROM events WHERE event_type IN ('error', 'signup')""")
def json_validation_issues(spark, sf):
    return json_rows.json_validation_issues(raw_events(spark, sf), "raw_data", "event_id", ["$.k"], "EVENTS", RUN_TS).select(
        "table_name", "record_identifier", "json_path", "validation_error", "raw_data")


@query("flatten_json_entities", """
SELECT campaign_id, campaign_name, start_date, budget, status, FALSE AS is_malformed FROM b_campaigns""", "budget", "start_date")
def flatten_json_entities(spark, sf):
    """Campaign rows kept as one JSON column, typed again."""
    raw = entities.campaigns(spark, sf).select(F.to_json(F.struct("*")).alias("raw_data"))
    return json_rows.flatten_json(raw, "raw_data", {
        "campaign_id": ("$.campaign_id", "string"), "campaign_name": ("$.campaign_name", "string"), "start_date": ("$.start_date", "date"),
        "budget": ("$.budget", "decimal(18,2)"), "status": ("$.status", "string")}).drop("raw_data")


# ---- watermarks ------------------------------------------------------------------------------------
@query("watermark_filter", """
SELECT performance_id, load_timestamp FROM b_performance
WHERE load_timestamp > (SELECT max(source_load_timestamp) FROM s_customers WHERE source_load_timestamp <= TIMESTAMP '2024-02-02')""", text="load_timestamp")
def watermark_filter(spark, sf):
    """Rows after the newest source time the target has seen."""
    target = silver_table(spark, sf, "customers").where(F.col("source_load_timestamp") <= F.lit("2024-02-02").cast("timestamp_ntz"))
    mark = wm.high_water_mark(target, "source_load_timestamp")
    return wm.watermark_filter(entities.performance(spark, sf), "load_timestamp", mark).select("performance_id", "load_timestamp")


@query("hwm_lookup", """
SELECT coalesce(strftime(max(order_timestamp), '%Y-%m-%d %H:%M:%S'), '1990-01-01 00:00:00') AS high_water_mark FROM s_sales
UNION ALL SELECT coalesce(strftime(max(order_timestamp), '%Y-%m-%d %H:%M:%S'), '1990-01-01 00:00:00') FROM s_sales WHERE quantity < 0""")
def hwm_lookup(spark, sf):
    """The mark of the sales and, with the default, of an empty selection."""
    s = silver_table(spark, sf, "sales")
    return wm.hwm_lookup(s, "order_timestamp").unionByName(wm.hwm_lookup(s.where("quantity < 0"), "order_timestamp"))


_CHOSEN = "SELECT '{0}' AS override, event_id FROM events {1}"


@query("reload_window", " UNION ALL ".join([
    _CHOSEN.format("increment", f"WHERE ts > TIMESTAMP '{MARK}'"), _CHOSEN.format("full_reload", ""),
    _CHOSEN.format("lookback", f"WHERE ts > TIMESTAMP '{MARK}' - INTERVAL 3 DAY"),
    _CHOSEN.format("from_date", "WHERE ts > TIMESTAMP '2024-01-10'"),
    _CHOSEN.format("window", "WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'")]))
def reload_window(spark, sf):
    """The events each override chooses."""
    e = entities.table(spark, sf, "events")
    options = {"increment": {}, "full_reload": {"full_reload": True}, "lookback": {"lookback_days": 3},
               "from_date": {"from_date": "2024-01-10"}, "window": {"start_date": "2024-01-05", "end_date": "2024-01-12"}}
    parts = [wm.watermark_filter(e, "ts", MARK, **o).select(F.lit(n).alias("override"), "event_id") for n, o in options.items()]
    return reduce(DataFrame.unionByName, parts)


@query("watermark_gap", """
SELECT (SELECT max(ts) FROM events) AS source_max, (SELECT max(ts) FROM events WHERE event_type = 'purchase') AS target_max,
  date_sub('hour', (SELECT max(ts) FROM events WHERE event_type = 'purchase'), (SELECT max(ts) FROM events)) AS gap_hours""", text="source_max target_max")
def watermark_gap(spark, sf):
    e = entities.table(spark, sf, "events")
    return wm.watermark_gap(e, e.where("event_type = 'purchase'"), "ts")


_STATUS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, max({c}) AS last_loaded_timestamp, count(*) AS total_rows, CAST(max({c}) AS DATE) AS last_load_date, "
    f"date_diff('day', CAST(max({c}) AS DATE), DATE '2024-01-31') AS days_since_update FROM {t}" for t, c in TIMES.items())


@query("incremental_status", _STATUS, text="last_loaded_timestamp last_load_date")
def incremental_status(spark, sf):
    return wm.incremental_status({t: (entities.table(spark, sf, t), c) for t, c in TIMES.items()}, "2024-01-31")


@query("stale_tables", f"SELECT table_name, days_since_update FROM ({_STATUS}) WHERE days_since_update > 7")
def stale_tables(spark, sf):
    return wm.stale_tables(incremental_status(spark, sf)).select("table_name", "days_since_update")


# ---- cleansing steps -------------------------------------------------------------------------------
@query("standardize_ids", "SELECT upper(trim(sku)) AS sku, upper(trim(product_id)) AS product_id FROM b_products")
def standardize_ids(spark, sf):
    return entities.products(spark, sf).select(clean_id("sku").alias("sku"), clean_id("product_id").alias("product_id"))


@query("standardize_email", "SELECT customer_id, lower(trim(email)) AS email FROM b_customers")
def standardize_email(spark, sf):
    return entities.customers(spark, sf).select("customer_id", clean_email("email").alias("email"))


@query("default_fill", """
SELECT customer_id, coalesce(customer_name, 'Unknown Customer') AS customer_name, coalesce(tier, 'Standard') AS tier FROM b_customers""")
def default_fill(spark, sf):
    return entities.customers(spark, sf).select(
        "customer_id", fill("customer_name", "Unknown Customer").alias("customer_name"), fill("tier", "Standard").alias("tier"))


@query("add_load_metadata", f"""
SELECT order_line_id, coalesce(source_system, 'erp') AS source_system, TIMESTAMP '{RUN_TS2}' AS load_timestamp FROM b_sales""", text="load_timestamp")
def add_load_metadata(spark, sf):
    return entities.sales(spark, sf).select("order_line_id", fill("source_system", "erp").alias("source_system"),
                                            F.lit(RUN_TS2).cast("timestamp_ntz").alias("load_timestamp"))


# table, expected rows, validate (fixed values)
EXPECTED = [("campaigns", 1000, True), ("customers", 10000, True), ("channels", 20, False), ("performance", 50000, True),
            ("products", 1000, True), ("sales", 100000, True)]


@query("expected_rows_grid", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {n} AS expected_rows, count(*) AS actual_rows, CASE WHEN count(*) >= {n} THEN 'PASS' ELSE 'FAIL' END AS check_status FROM b_{t}"
    for t, n, on in EXPECTED if on))
def expected_rows_grid(spark, sf):
    grid = spark.createDataFrame(EXPECTED, "table_name string, expected_rows long, enable_validation boolean")
    counts = infer.row_counts({t: entities.BRONZE[t](spark, sf) for t, _, on in EXPECTED if on})
    return grid.where("enable_validation").join(counts, "table_name").select(
        "table_name", "expected_rows", F.col("total_rows").alias("actual_rows"),
        F.when(F.col("total_rows") >= F.col("expected_rows"), "PASS").otherwise("FAIL").alias("check_status"))


@query("rename_map", "SELECT campaign_id AS CAMPAIGN_KEY_TEXT, budget AS PLANNED_BUDGET FROM s_campaigns", "PLANNED_BUDGET")
def rename_map(spark, sf):
    return sinks.rename_map(silver_table(spark, sf, "campaigns"), {"campaign_id": "CAMPAIGN_KEY_TEXT", "budget": "PLANNED_BUDGET"})


@query("calculator", "SELECT order_line_id, revenue, tax_amount, revenue - tax_amount AS net, quantity >= 25 AS is_bulk FROM s_sales",
       "revenue tax_amount net")
def calculator(spark, sf):
    base = silver_table(spark, sf, "sales").select("order_line_id", "revenue", "tax_amount", "quantity")
    return sinks.calculator(base, {"net": "revenue - tax_amount", "is_bulk": "quantity >= 25"}).drop("quantity")


@query("filter_conditions", """
SELECT order_line_id, quantity, revenue FROM s_sales WHERE quantity >= 40 AND NOT (customer_id = 'CUST-00000001') AND campaign_id IS NOT NULL
""", "revenue")
def filter_conditions(spark, sf):
    predicate = conditions([("quantity", "Is", "Greater than or equal to", 40), ("customer_id", "Is not", "Equal to", "CUST-00000001"),
                            ("campaign_id", "Is not", "Null", None)], "And")
    return silver_table(spark, sf, "sales").where(predicate).select("order_line_id", "quantity", "revenue")


@query("filter_current", "SELECT customer_key, customer_id, version_number FROM d2_customer WHERE is_current")
def filter_current(spark, sf):
    return current(states.customer_history(spark, sf)).select("customer_key", "customer_id", "version_number")


@query("calendar_of_data", """
SELECT date_key, full_date, week_of_year, day_name, is_weekend FROM d_date
WHERE full_date BETWEEN (SELECT CAST(min(o_orderdate) AS DATE) FROM orders) AND (SELECT CAST(max(ts) AS DATE) FROM events)""", text="full_date")
def calendar_of_data(spark, sf):
    """A calendar from the first order to the last event."""
    start = entities.table(spark, sf, "orders").agg(F.to_date(F.min("o_orderdate"))).scalar()
    end = entities.table(spark, sf, "events").agg(F.to_date(F.max("ts"))).scalar()
    return cal.dim_date(spark, start, end).select("date_key", "full_date", "week_of_year", "day_name", "is_weekend")


# ---- incremental files -----------------------------------------------------------------------------
@query("incremental_stream_load", "SELECT customer_id, customer_name, tier, lifetime_value FROM s_customers", "lifetime_value")
def incremental_stream_load(spark, sf):
    """Three landing folders arrive one after the other; each file is taken once and merged."""
    root = session.scratch_path(spark, "stream")
    bronze = entities.customers(spark, sf)
    target = sinks.VersionedTable(spark, f"{root}/silver")
    for day in ("2024-02-01", "2024-02-02", "2024-02-03"):
        bronze.where(F.to_date("load_timestamp") == F.lit(day).cast("date")).write.mode("append").parquet(f"{root}/landing")
        files.incremental_stream_load(spark, f"{root}/landing", bronze.schema, target, ["customer_id"], f"{root}/checkpoint",
                                      cleanse=lambda df: silver.customers(df, RUN_TS))
    return target.read().select("customer_id", "customer_name", "tier", "lifetime_value")
