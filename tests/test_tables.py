"""Change detection, upsert, keys, dimensions, sinks, ingestion, streams."""

import random
from decimal import Decimal as D

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window as W, functions as F

from tidemark.operators import changes, facts, infer, ingest, keys, lookups, retention, scd, upsert as up, watermark as wm
from tidemark.operators.neighbors import next_value
from tidemark.operators.runlog import RunLog
from tidemark.plans import star as plans
from tidemark.sources import entities, json_rows, samples, sinks, tables
from tidemark.streaming.files import incremental_stream_load

KV = "k string, v int"


def test_detect_changes_null_safe(spark, rows):
    master = spark.createDataFrame([("a", 1), ("b", None), ("c", 3)], KV)
    current = spark.createDataFrame([("b", None), ("c", 4), ("d", 5)], KV)
    out = changes.detect_changes(master, current, ["k"], ["v"])
    assert rows(out, "k", "change_type", "master_v", "compare_v") == [("a", "N", 1, None), ("b", "I", None, None), ("c", "C", 3, 4), ("d", "D", None, 5)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 9), st.one_of(st.none(), st.integers(0, 2)), min_size=1), st.dictionaries(st.integers(0, 9), st.one_of(st.none(), st.integers(0, 2)), min_size=1))
def test_changes_and_upsert_agree_with_dictionaries(spark, a, b):
    left = spark.createDataFrame(list(a.items()), "k int, v int")
    right = spark.createDataFrame(list(b.items()), "k int, v int")
    kinds = dict(changes.detect_changes(left, right, ["k"], ["v"]).select("k", "change_type").collect())
    assert kinds == {k: "N" if k not in b else "D" if k not in a else "I" if a[k] == b[k] else "C" for k in {*a, *b}}
    merged = dict(tuple(r) for r in up.upsert(right, left, ["k"]).collect())
    assert merged == {**b, **a}


def test_dedupe_latest_ties(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("a", 2, "y"), ("b", None, "z")], "k string, t int, v string")
    assert rows(changes.dedupe_latest(df, ["k"], newest="t")) == [("a", 2, "y"), ("b", None, "z")]


def test_repeated_rows(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("a", None), ("b", 1)], KV)
    assert rows(changes.repeated_rows(df)) == [("a", 1, 2), ("a", None, 2)]


def test_upsert_columns_and_strict(spark, rows):
    target = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old")], "k string, v int, note string")
    source = spark.createDataFrame([("b", 20), ("c", 30)], KV)
    want = [("a", 1, "old"), ("b", 20, "old"), ("c", 30, None)]
    assert rows(up.upsert(target, source, ["k"])) == want
    twice = up.upsert(up.upsert(target, source, ["k"]), source, ["k"])
    assert rows(twice) == want
    doubled = source.unionByName(source)
    with pytest.raises(up.DuplicateSourceKeys):
        up.upsert(target, doubled, ["k"], strict=True)
    assert rows(up.replace_keys(target.drop("note"), source, ["k"])) == [("a", 1), ("b", 20), ("c", 30)]


def test_upsert_update_list_and_composite_key(spark, rows):
    schema = "a int, b int, v int, w int"
    target = spark.createDataFrame([(1, 1, 5, 5), (1, 2, 6, 6)], schema)
    source = spark.createDataFrame([(1, 2, 60, 60), (2, 1, 70, 70)], schema)
    assert rows(up.upsert(target, source, ["a", "b"], update=["v"])) == [(1, 1, 5, 5), (1, 2, 60, 6), (2, 1, 70, 70)]


def test_upsert_stale_repeated_and_keyless_rows(spark, rows):
    target = spark.createDataFrame([("a", 5, "kept"), ("b", 1, "old"), ("c", None, "old")], "k string, t int, v string")
    source = spark.createDataFrame([("a", 4, "stale"), ("b", 2, "x"), ("b", 3, "y"), ("c", 1, "z"), (None, 9, "n"), ("d", 1, "new")], "k string, t int, v string")
    assert rows(up.upsert(target, source, ["k"], newest="t")) == [("a", 5, "kept"), ("b", 3, "y"), ("c", 1, "z"), ("d", 1, "new")]
    assert rows(up.without_key(source, ["k"])) == [(None, 9, "n")]
    wider = up.upsert(target, source.withColumn("w", F.lit(1)), ["k"], newest="t")
    assert rows(wider, "k", "w") == [("a", None), ("b", 1), ("c", 1), ("d", 1)]
    again = up.upsert(target, source.where("k = 'b'"), ["k"])
    assert again.count() == 3  # one row of two with the same key


def test_scd2_two_source_rows_make_one_version(spark, rows):
    schema = "id string, v int, source_system string"
    first = scd.scd2_initial(spark.createDataFrame([("a", 1, "s"), ("a", 1, "s"), (None, 1, "s")], schema), "id", "sk", "2024-01-01 00:00:00")
    assert first.count() == 1
    second = scd.scd2_incremental(first, spark.createDataFrame([("a", 2, "s"), ("a", 3, "s"), (None, 4, "s")], schema), "id", "sk", "2024-02-01 00:00:00")
    assert rows(second, "v", "version_number", "is_current") == [(1, 1, False), (3, 2, True)]


def test_ids_keep_all_digits(spark, tmp_path):
    spark.createDataFrame([(12345678901, "n", "S", 1.0), (2, "n", "S", 1.0)], "c_custkey long, c_name string, c_mktsegment string, c_acctbal double"
                          ).write.parquet(str(tmp_path / "customer.parquet"))
    got = {r.customer_id for r in entities.customers(spark, str(tmp_path)).collect()}
    assert got == {"CUST-12345678901", "CUST-00000002"}


def test_calendar_covers_the_facts(spark, tmp_path):
    from tidemark.plans import star
    spark.sql("SELECT timestamp_ntz'1960-05-05 00:00:00' AS o_orderdate").write.parquet(str(tmp_path / "orders.parquet"))
    spark.sql("SELECT timestamp_ntz'2041-02-02 10:00:00' AS ts").write.parquet(str(tmp_path / "events.parquet"))
    days = star.Star(spark, str(tmp_path)).dim_date.agg(F.min("full_date"), F.max("full_date"), F.count("*")).first()
    assert (str(days[0]), str(days[1]), days[2]) == ("1960-01-01", "2041-12-31", 29951)


def test_two_writers_of_one_version(spark, tmp_path):
    first, second = (sinks.VersionedTable(spark, str(tmp_path / "t")) for _ in range(2))
    first.publish(spark.range(3))
    second.version = lambda: 0  # it saw the table before the first load
    with pytest.raises(FileExistsError):
        second.publish(spark.range(9))
    assert first.read().count() == 3
    first.append(spark.range(2).withColumn("more", F.lit("x")))
    assert first.version() == 2 and first.read().where("more = 'x'").count() == 2 and first.read(1).count() == 3


def test_merge_partitions_rewrites_only_touched(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "x", 1), (2, "x", 1), (3, "y", 1)], "k int, m string, v int").write.partitionBy("m").parquet(path)
    before = {f for f in spark.read.parquet(path).inputFiles() if "m=y" in f}
    sinks.merge_partitions(spark, path, spark.createDataFrame([(2, "x", 9), (4, "x", 9)], "k int, m string, v int"), ["k"], "m")
    assert rows(spark.read.parquet(path), "k", "v") == [(1, 1), (2, 9), (3, 1), (4, 9)]
    assert {f for f in spark.read.parquet(path).inputFiles() if "m=y" in f} == before


def test_surrogate_keys_are_dense_and_repeatable(spark):
    df = spark.range(500).select(F.concat(F.lit("id-"), "id").alias("nk"))
    one = {r.nk: r.key for r in keys.surrogate_key(df, ["nk"], "key", start=100).collect()}
    two = {r.nk: r.key for r in keys.surrogate_key(df.repartition(7), ["nk"], "key", start=100).collect()}
    assert sorted(one.values()) == list(range(101, 601)) and one == two


def test_next_value_equals_plain_window(spark, rows):
    rng = random.Random(1)
    data = [(rng.choice("ab"), i, f"2024-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d} 00:00:{i % 60:02d}") for i in range(200)]
    df = spark.createDataFrame(data, "k string, i int, t string").withColumn("t", F.col("t").cast("timestamp_ntz")).dropDuplicates(["k", "t"])
    plain = df.withColumn("n", F.lead("t").over(W.partitionBy("k").orderBy("t")))
    assert rows(next_value(df, ["k"], "t", "t", "n"), "k", "t", "n") == rows(plain, "k", "t", "n")


SCD = "id string, tier string, source_system string"


def versions(df):
    return sorted((r.id, r.version_number, r.tier, str(r.valid_from)[:10], str(r.valid_to)[:10], r.is_current) for r in df.collect())


def test_scd2_cycle(spark):
    day1 = spark.createDataFrame([("a", "Gold", "x"), ("b", None, "x")], SCD)
    day2 = spark.createDataFrame([("a", "Platinum", "x"), ("b", None, "x"), ("c", "Bronze", "x")], SCD)
    d1 = scd.scd2_load(None, day1, "id", "key", "2024-01-01 00:00:00")
    d2 = scd.scd2_load(d1, day2, "id", "key", "2024-01-02 00:00:00")
    assert versions(d2) == [
        ("a", 1, "Gold", "2024-01-01", "2024-01-02", False), ("a", 2, "Platinum", "2024-01-02", "9999-12-31", True),
        ("b", 1, None, "2024-01-01", "9999-12-31", True), ("c", 1, "Bronze", "2024-01-02", "9999-12-31", True)]
    assert sorted(r.key for r in d2.collect()) == [1, 2, 3, 4]
    # the same source again changes nothing
    assert versions(scd.scd2_incremental(d2, day2, "id", "key", "2024-01-03 00:00:00")) == versions(d2)
    # a deleted key stays open unless asked; created_timestamp survives new versions
    gone = spark.createDataFrame([("a", "Gold", "x")], SCD)
    kept = scd.scd2_incremental(d2, gone, "id", "key", "2024-01-04 00:00:00")
    assert {r.id for r in kept.where("is_current").collect()} == {"a", "b", "c"}
    closed = scd.scd2_incremental(d2, gone, "id", "key", "2024-01-04 00:00:00", close_deleted=True)
    assert {r.id for r in closed.where("is_current").collect()} == {"a"}
    assert {str(r.created_timestamp)[:10] for r in kept.where("id = 'a'").collect()} == {"2024-01-01"}
    # tracked columns only
    assert versions(scd.scd2_incremental(d2, gone, "id", "key", "2024-01-04 00:00:00", track=["source_system"])) == versions(d2)


def test_scd2_replay_equals_step_by_step(spark):
    rng = random.Random(5)
    state, log, dim = {}, [], None
    for step in range(1, 6):
        for k in "abcd":
            if rng.random() < 0.6:
                state[k] = rng.choice(["Gold", "Silver", None])
        at = f"2024-01-0{step} 00:00:00"
        source = spark.createDataFrame([(k, v, "x") for k, v in state.items()], SCD)
        log += [(k, v, at) for k, v in state.items()]
        dim = scd.scd2_load(dim, source, "id", "key", at)
        dim = spark.createDataFrame(dim.collect(), dim.schema)
    direct = scd.scd2_replay(spark.createDataFrame(log, "id string, tier string, at string").withColumn("at", F.col("at").cast("timestamp_ntz")), "id", "key", "at", ["tier"])
    assert versions(dim) == versions(direct)


def test_scd2_repair_gap_and_overlap(spark, rows):
    broken = spark.sql("""SELECT * FROM VALUES ('a', 1, timestamp_ntz'2024-01-01 00:00:00', timestamp_ntz'2024-01-05 00:00:00', true),
      ('a', 2, timestamp_ntz'2024-02-10 00:00:00', timestamp_ntz'9999-12-31 23:59:59', true), ('a', 3, timestamp_ntz'2024-02-20 00:00:00', timestamp_ntz'2024-02-21 00:00:00', true)
      AS t(id, version_number, valid_from, valid_to, is_current)""")
    fixed = scd.scd2_repair(broken, "id").orderBy("version_number").collect()
    assert [str(r.valid_to)[:10] for r in fixed] == ["2024-02-10", "2024-02-20", "9999-12-31"]
    assert [r.is_current for r in fixed] == [False, False, True]


def test_scd3_keeps_previous(spark):
    schema = "id string, category string"
    d = scd.scd3(None, spark.createDataFrame([("a", "Paid"), ("b", "Owned")], schema), "id", "key", "category", "2024-01-01 00:00:00")
    d = scd.scd3(d, spark.createDataFrame([("a", "Earned"), ("b", "Owned")], schema), "id", "key", "category", "2024-01-02 00:00:00")
    d = scd.scd3(d, spark.createDataFrame([("a", "Earned"), ("b", "Owned"), ("c", "Paid")], schema), "id", "key", "category", "2024-01-03 00:00:00")
    got = {r.id: (r.current_category, r.previous_category, str(r.category_changed_date)[:10], str(r.created_timestamp)[:10]) for r in d.collect()}
    assert got == {"a": ("Earned", "Paid", "2024-01-02", "2024-01-01"), "b": ("Owned", None, "None", "2024-01-01"), "c": ("Paid", None, "None", "2024-01-03")}
    assert [r.id for r in scd.scd3_moved(d, "category", "Paid", "Earned").collect()] == ["a"]


def test_asof_is_half_open(spark, rows):
    d1 = scd.scd2_initial(spark.createDataFrame([("a", "Gold", "x")], SCD), "id", "key", "2024-01-01 00:00:00")
    d2 = scd.scd2_incremental(d1, spark.createDataFrame([("a", "Silver", "x")], SCD), "id", "key", "2024-01-10 00:00:00")
    events = spark.sql("SELECT 'a' AS id, cast(t AS timestamp_ntz) AS at FROM VALUES ('2024-01-09 23:59:59'), ('2024-01-10 00:00:00'), ('2023-12-31 00:00:00') AS v(t)")
    assert [r.tier for r in lookups.fact_asof_lookup(events, d2, "id", "at", "key", ["tier"]).orderBy("at").collect()] == ["Gold", "Silver"]
    assert rows(lookups.asof_dimension(d2, "2024-01-10 00:00:00"), "tier") == [("Silver",)]


def test_lookups_lose_nothing(spark, rows):
    fact = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "i int, id string")
    dim = scd.scd2_initial(spark.createDataFrame([("a", "Gold", "x")], SCD), "id", "key", "2024-01-01 00:00:00")
    matched, lost = lookups.lookup_with_orphans(fact, dim, "id", "key")
    assert matched.count() + lost.count() == 3 and rows(lost, "i") == [(2,), (3,)]
    assert rows(lookups.lookup_left(fact, dim, "id", "key", lookups.UNKNOWN_KEY), "i", "key") == [(1, 1), (2, -1), (3, -1)]
    assert rows(lookups.orphans(fact, dim, "id"), "i") == [(2,)]
    assert lookups.orphan_count(fact, dim, "id").first()[0] == 1


def test_watermark_defaults_and_overrides(spark):
    df = spark.sql("SELECT cast(d AS timestamp_ntz) AS t FROM VALUES ('2024-01-01'), ('2024-01-02'), ('2024-01-03') AS v(d)")
    assert wm.high_water_mark(df.limit(0), "t") == wm.DEFAULT_WATERMARK
    mark = wm.high_water_mark(df, "t")
    assert wm.watermark_filter(df, "t", mark).count() == 0
    assert wm.watermark_filter(df, "t", mark, lookback_days=2).count() == 2 - 0
    assert wm.watermark_filter(df, "t", None).count() == 3
    assert wm.watermark_filter(df, "t", mark, full_reload=True).count() == 3
    assert wm.watermark_filter(df, "t", wm.target_mark(df.where("t < '2024-01-03'"), "t")).count() == 1


def test_load_modes(spark, rows, tmp_path):
    t = sinks.VersionedTable(spark, str(tmp_path / "t"))
    schema = "k string, v int, t int"
    first = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], schema)
    second = spark.createDataFrame([("b", 2, 2), ("c", 2, 2)], schema)
    assert sinks.create_if_not_exists(t, first) and not sinks.create_if_not_exists(t, first)
    sinks.load(t, first, "replace")
    with pytest.raises(ValueError):
        sinks.load(t, first, "initial")
    sinks.load(t, second, "incremental_merge", keys=["k"])
    assert rows(t.read(), "k", "v") == [("a", 1), ("b", 2), ("c", 2)]
    sinks.load(t, second, "incremental_append")
    assert t.read().count() == 5
    sinks.load(t, second.drop("t"), "truncate_insert")
    assert t.read().columns == ["k", "v", "t"] and t.read().count() == 2
    published = t.version()
    with pytest.raises(Exception):
        t.publish(second.select(F.raise_error(F.lit("broken")).alias("k")))
    assert t.version() == published and t.read().count() == 2


def test_ingest_cycle(spark, tmp_path):
    root = str(tmp_path / "lake")
    state = {"orders": [(1, "2024-01-01", 10), (2, "2024-01-02", 20)], "notes": [(1, "2024-01-01", 0)]}

    def read(name):
        df = spark.createDataFrame(state[name], "id int, at string, v int")
        return df.withColumn("at", F.col("at").cast("timestamp_ntz"))

    configs = [ingest.TableConfig("orders", "at", ("id",)), ingest.TableConfig("notes", "at"), ingest.TableConfig("absent", "at", ("id",))]

    def run(n):
        log = ingest.multi_table_ingest(spark, configs, read, root, f"r{n}", "2024-02-01 00:00:00", concurrency=2)
        return {r.table_name: (r.status, r.row_count_affected) for r in log.collect()}

    def table(name):
        return sorted((r.id, r.v) for r in sinks.VersionedTable(spark, f"{root}/{name}").read().collect())

    assert run(1) == {"orders": ("SUCCESS", 2), "notes": ("SUCCESS", 1), "absent": ("FAILED", 0)}
    assert run(2) == {"orders": ("SUCCESS", 0), "notes": ("SUCCESS", 0), "absent": ("FAILED", 0)}
    state["orders"] = [(1, "2024-01-03", 11), (2, "2024-01-02", 20), (3, "2024-01-03", 30)]
    state["notes"].append((2, "2024-01-05", 1))
    assert run(3)["orders"] == ("SUCCESS", 2)
    assert table("orders") == [(1, 11), (2, 20), (3, 30)] and table("notes") == [(1, 0), (2, 1)]
    assert ingest.WatermarkState(spark, f"{root}/_watermarks").get("orders").startswith("2024-01-03")
    assert ingest.read_log(spark, root).count() == 9


def test_stream_takes_each_file_once(spark, rows, tmp_path):
    landing, t = str(tmp_path / "in"), sinks.VersionedTable(spark, str(tmp_path / "out"))
    schema = "k string, v int, last_modified_timestamp timestamp_ntz"

    def arrive(data):
        spark.createDataFrame(data, "k string, v int").withColumn(
            "last_modified_timestamp", F.lit("2024-01-01").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(landing)

    def load():
        return incremental_stream_load(spark, landing, spark.createDataFrame([], schema).schema, t, ["k"], str(tmp_path / "cp"))

    arrive([("a", 1), ("b", 1)])
    load()
    arrive([("b", 2), ("c", 2)])
    version = load()
    assert rows(t.read(), "k", "v") == [("a", 1), ("b", 2), ("c", 2)]
    assert load() == version


def test_run_log(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "runs"))
    assert log.run("good", "SILVER", "DEV", lambda: 7) == 7
    with pytest.raises(ZeroDivisionError):
        log.run("bad", "SILVER", "DEV", lambda: 1 / 0)
    got = {r.pipeline_name: (r.execution_status, r.rows_processed) for r in log.latest().collect()}
    assert got == {"good": ("SUCCESS", 7), "bad": ("FAILED", None)}


def test_config_checks_and_inference(spark, rows):
    tables_ = {"a": spark.sql("SELECT 1 AS id, timestamp_ntz'2024-01-01 00:00:00' AS order_date, timestamp_ntz'2024-01-01 00:00:00' AS updated_at"),
               "b": spark.sql("SELECT * FROM VALUES (1, 'x'), (1, 'y') AS t(id, name)"),
               "c": spark.sql("SELECT 1 AS id, cast(null AS date) AS modified_date, date'2024-01-01' AS start_date")}
    got = rows(infer.infer_table_config(spark, tables_, {"a": ["id"], "b": ["id"], "c": ["id", "start_date"]}))
    assert got == [("a", "updated_at", "id"), ("b", infer.NO_TIME, infer.NO_KEY), ("c", "start_date", "id, start_date")]
    config = spark.createDataFrame([("a", "updated_at", "id"), ("a", "updated_at", "id"), ("b", "name", "id"), ("c", "nope", "id, zz"), ("d", "x", "y"), ("", "x", "y")],
                                   "table_name string, incremental_column string, primary_key string")
    issues = {(r.table_name, r.issue) for r in infer.config_validate(config, infer.column_metadata(spark, tables_)).collect()}
    assert issues == {("a", "table listed more than once"), ("b", "incremental column is not a date or timestamp"), ("c", "incremental column not found"),
                      ("c", "key column not found"), ("d", "table not found"), ("", "blank value")}


def test_jdbc_options():
    o = tables.jdbc_options("jdbc:x", "orders", schema="public", columns=["id", "v"], split_column="id", bounds=(1, 100), partitions=8)
    assert o["dbtable"] == "(SELECT id, v FROM public.orders) AS src" and o["numPartitions"] == "8" and o["upperBound"] == "100"
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "orders", split_column="id")


def test_parquet_by_name_aborts_on_bad_file(spark, tmp_path):
    path = tmp_path / "in"
    spark.sql("SELECT 1 AS ID, 'a' AS Name").write.parquet(str(path))
    schema = spark.sql("SELECT cast(1 AS bigint) AS id, 'a' AS name, cast(1 AS int) AS extra").schema
    assert [tuple(r) for r in tables.load_parquet_by_name(spark, str(path), "*.parquet", schema).collect()] == [(1, "a", None)]
    (path / "zz.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        tables.load_parquet_by_name(spark, str(path), "*.parquet", schema).collect()


def test_json_rows(spark, rows):
    df = spark.createDataFrame([(1, '{"a": 5, "b": "x"}'), (2, '{"a": "five"}'), (3, '{"a": 5'), (4, None)], "id int, raw string")
    flat = json_rows.flatten_json(df, "raw", {"a": ("$.a", "int"), "b": ("$.b", "string")}, ["id"])
    assert rows(flat, "id", "a", "b", "is_malformed") == [(1, 5, "x", False), (2, None, None, False), (3, None, None, True), (4, None, None, False)]
    issues = json_rows.json_validation_issues(df, "raw", "id", ["$.a", "$.b"], "T", "2024-01-01 00:00:00")
    assert rows(issues, "record_identifier", "json_path") == [("2", "$.b"), ("3", "$"), ("4", "$")]


def test_samples_keep_their_rules(spark):
    t = samples.sample_tables(spark, 0.05)
    assert {k: v.count() for k, v in t.items()} == {k: max(1, int(n * 0.05)) for k, n in samples.VOLUMES.items()}
    assert t["performance"].where("clicks > impressions OR conversions > clicks").count() == 0
    assert t["sales"].where("revenue <> line_total + tax_amount").count() == 0
    assert lookups.orphan_count(t["sales"], t["products"], "product_id").first()[0] == 0
    assert t["customers"].exceptAll(samples.sample_tables(spark, 0.05)["customers"]).count() == 0


def test_retention_split(spark):
    df = spark.sql("SELECT cast(d AS timestamp_ntz) AS t FROM VALUES ('2024-01-01'), ('2024-01-20'), (null) AS v(d)")
    old, kept = retention.split_by_age(df, "t", 14, "2024-01-20")
    assert (old.count(), kept.count()) == (1, 2)


def test_daily_fact_replaces_touched_days(spark, rows):
    silver = spark.sql("""SELECT *, timestamp_ntz'2024-01-01 00:00:00' AS load_timestamp FROM VALUES
      ('c1', 'h1', date'2024-01-01', 100L, 10L, 1L, cast(5 AS decimal(18,2)), cast(20 AS decimal(18,2)), cast(10 AS decimal(18,4))),
      ('c1', 'h2', date'2024-01-01', 300L, 0L, 0L, cast(0 AS decimal(18,2)), cast(0 AS decimal(18,2)), cast(0 AS decimal(18,4))),
      ('c1', 'h1', date'2024-01-02', 50L, 5L, 0L, cast(1 AS decimal(18,2)), cast(0 AS decimal(18,2)), cast(10 AS decimal(18,4)))
      AS t(campaign_id, channel_id, performance_date, impressions, clicks, conversions, cost, revenue, ctr)""")
    dim = spark.sql("SELECT 'c1' AS campaign_id, 7L AS campaign_key, true AS is_current")
    days = spark.sql("SELECT 20240101 AS date_key UNION ALL SELECT 20240102")
    late = silver.where("channel_id = 'h2'")
    touched = facts.touched_days(silver, late)
    assert touched.count() == 2
    daily = facts.fact_campaign_daily(touched, dim, days, "2024-02-01 00:00:00")
    r = daily.first()
    assert (r.total_impressions, r.avg_ctr, r.total_ctr, r.avg_cpc, r.total_cpc, r.channel_count) == (400, D("5.0000"), D("2.5000"), D("0.2500"), D("0.5000"), 2)
    before = facts.fact_campaign_daily(silver.where("channel_id = 'h1'"), dim, days, "2024-01-05 00:00:00")
    after = up.replace_keys(before, daily, ["campaign_key", "date_key"])
    assert rows(after, "date_key", "total_impressions") == [(20240101, 400), (20240102, 50)]


def test_star_reads_written_tables(spark, tmp_path):
    star = plans.materialise(spark, "/root/testdata/sf0.001", str(tmp_path / "gold"))
    lazy = plans.Star(spark, "/root/testdata/sf0.001")
    for name in ("fact_sales", "fact_performance", "fact_campaign_daily", "dim_customer"):
        written = getattr(star, name)
        assert written.drop("month_key").exceptAll(getattr(lazy, name)).count() == 0
        assert written.count() == getattr(lazy, name).count()
