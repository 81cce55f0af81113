"""Published tables: merges that write what changed, rejected rows, archives, batches, removal of superseded folders."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ingest, retention
from tidemark.operators.upsert import upsert
from tidemark.sources import tables
from tidemark.sources.sinks import VersionedTable, load_dimension
from tidemark.streaming import files

SCHEMA = "k long, t int, v string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def content(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def size(root):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))


def test_a_small_merge_writes_little(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    rows = spark.range(200_000).select("id", F.md5(F.col("id").cast("string")).alias("a"), F.xxhash64("id").alias("b"), F.lit(1).alias("t"))
    t.merge(rows, ["id"], "t", buckets=8)
    whole = size(tmp_path)
    changed = rows.where("id % 100 = 7").withColumns({"t": F.lit(2), "a": F.lit("new")})
    assert t.merge(changed, ["id"], "t", load="second").loaded == 2_000
    assert size(tmp_path) - whole <= whole / 10
    got = t.read()
    assert got.count() == 200_000 and got.where("a = 'new'").count() == 2_000
    assert got.columns == rows.columns
    before = size(tmp_path)
    t.compact({0, 1})  # only these buckets are written
    assert size(tmp_path) - before < whole / 2
    assert {b for p in t.manifest().of("delta") for b in p.buckets} == set(range(2, 8))
    assert t.read().where("a = 'new'").count() == 2_000 and t.read().count() == 200_000


@pytest.mark.parametrize("newest", ["t", None])
def test_merges_equal_upserts(spark, tmp_path, newest):
    r = random.Random(4)
    t = VersionedTable(spark, str(tmp_path / "t"), compact_at=0.6, most_deltas=3)
    want = None
    for turn in range(6):
        rows = [(r.randint(1, 40), r.choice([None, *range(9)]), f"{turn}-{k}") for k in range(r.choice([3, 12, 30]))]
        source = frame(spark, rows)
        want = upsert(want if want is not None else source.limit(0), source, ["k"], newest=newest)
        want = frame(spark, [tuple(x) for x in want.collect()])
        balance = t.merge(source, ["k"], newest, buckets=4)
        assert (balance.read, balance.loaded) == (len(rows), len({k for k, _, _ in rows}))
        assert content(t.read()) == content(want)
    assert len(t.balances()) == 6


def test_rows_without_a_key_are_kept_apart(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    first = t.merge(frame(spark, [(1, 1, "a"), (1, 2, "b"), (None, 1, "x"), (None, 1, "x"), (2, None, "c")]), ["k"], "t", load="one")
    assert (first.read, first.loaded, first.collapsed, first.rejected) == (5, 2, 1, 2)
    later = t.merge(frame(spark, [(None, 3, "y"), (2, 1, "d")]), ["k"], "t", load="two")
    assert (later.read, later.loaded, later.collapsed, later.rejected) == (2, 1, 0, 1)
    assert content(t.read()) == [(1, 2, "b"), (2, 1, "d")]
    assert content(t.rejected(), "v", "rejected_for", "rejected_by") == [("x", "null key: k", "one")] * 2 + [("y", "null key: k", "two")]
    nothing = t.merge(frame(spark, [(None, 4, "z")]), ["k"], "t")
    assert (nothing.loaded, nothing.rejected) == (0, 1) and t.read().count() == 2
    u = VersionedTable(spark, str(tmp_path / "u"))
    u.merge(frame(spark, [(1, None, "a"), (None, None, "b")]), ["k", "t"])
    assert u.read().count() == 0 and content(u.rejected(), "rejected_for") == [("null key: k, t",), ("null key: t",)]


def test_merge_columns_removals_and_whole_tables(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.publish(frame(spark, [(1, 1, "a"), (2, 1, "b"), (3, 1, "c")]))
    t.merge(frame(spark, [(2, "z"), (4, "d")], "k int, extra string"), ["k"])
    assert content(t.read(), "k", "t", "v", "extra") == [(1, 1, "a", None), (2, 1, "b", "z"), (3, 1, "c", None), (4, None, None, "d")]
    t.merge(frame(spark, [(5, 1, "e")]), ["k"], gone=frame(spark, [(1,), (5,), (9,)], "k long"))
    assert content(t.read(), "k") == [(2,), (3,), (4,), (5,)]
    t.compact()
    assert content(t.read(), "k") == [(2,), (3,), (4,), (5,)] and not t.manifest().of("delta")
    with pytest.raises(ValueError):
        t.merge(frame(spark, [(5, 1, "e")]), ["v"])
    t.append(frame(spark, [(5, 9, "twice")]))
    assert t.read().where("k = 5").count() == 2
    t.merge(frame(spark, [(6, 1, "f")]), ["k"])
    assert content(t.read(), "k") == [(2,), (3,), (4,), (5,), (5,), (6,)]
    t.merge(frame(spark, []), ["k"])
    assert t.read().count() == 6


def test_superseded_folders_go(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    for n in range(5):
        t.publish(frame(spark, [(n, n, "x")]))
    assert len([d for d in os.listdir(tmp_path / "t") if d.startswith("v")]) == 2
    assert content(t.read(), "k") == [(4,)] and content(t.read(4), "k") == [(3,)]


def test_archive_moves_whole_folders_and_splits_mixed_ones(spark, tmp_path, monkeypatch):
    t = VersionedTable(spark, str(tmp_path / "t"))
    days = frame(spark, [(k, f"2024-01-{k:02d} 10:00:00") for k in range(1, 31)], "k long, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    for lo, hi in ((1, 10), (11, 20), (21, 30)):
        t.append(days.where(F.col("k").between(lo, hi)))
    t.append(frame(spark, [(99, None)], "k long, at string").withColumn("at", F.col("at").cast("timestamp_ntz")))
    before, written = t.version(), size(tmp_path)

    def dies(*_):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_publish", dies)
        with pytest.raises(RuntimeError):
            retention.archive(t, "at", 15, "2024-01-31")
    assert t.version() == before and t.read().count() == 31 and t.archived() is None
    retention.archive(t, "at", 15, "2024-01-31")
    assert content(t.archived(), "k") == sorted(((k,) for k in range(1, 16)), key=repr)
    assert content(t.read(), "k") == sorted(((k,) for k in [*range(16, 31), 99]), key=repr)
    assert size(tmp_path) < 2 * written
    kinds = [p.kind for p in t.manifest().parts]
    assert kinds.count("archive") == 2 and kinds.count("rows") == 3
    version = t.version()
    retention.archive(t, "at", 15, "2024-01-31")  # nothing more to move
    assert t.version() == version
    t.publish(days.where("k > 20"))
    assert t.archived().count() == 15  # a new table keeps its archive


def test_archive_of_a_merged_table_elsewhere(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    rows = frame(spark, [(k, f"2024-01-{k:02d} 10:00:00") for k in range(1, 31)], "k long, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    t.merge(rows, ["k"], "at", buckets=4)
    t.merge(rows.where("k = 3").withColumn("at", F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")), ["k"], "at")
    retention.archive(t, "at", 15, "2024-01-31", elsewhere=str(tmp_path / "cold"))
    assert t.archived().count() == 14 and t.read().count() == 16 and t.archived().columns == ["k", "at"]
    assert size(tmp_path / "cold") > 0
    t.merge(rows.where("k = 1"), ["k"], "at")
    assert t.read().count() == 17


def test_a_repeated_batch_adds_nothing(spark, tmp_path, monkeypatch):
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    t = VersionedTable(spark, str(tmp_path / "out"))

    def arrive(*rows):
        frame(spark, list(rows)).coalesce(1).write.mode("append").parquet(landing)

    def load():
        return files.incremental_stream_load(spark, landing, frame(spark, []).schema, t, [], checkpoint)
    arrive((1, 1, "a"), (1, 1, "a"))
    load()
    append = VersionedTable.append

    def dies(self, *a, **b):
        append(self, *a, **b)
        raise RuntimeError("driver lost between publication and commit")
    arrive((2, 1, "b"))
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "append", dies)
        with pytest.raises(Exception):
            load()
    assert t.read().count() == 3  # published, but the stream does not know
    load()
    assert content(t.read(), "k") == [(1,), (1,), (2,)]
    arrive((3, 1, "c"))
    load()
    assert content(t.read(), "k") == [(1,), (1,), (2,), (3,)]


def test_rows_without_a_time_are_taken_when_they_come(spark, tmp_path):
    config, plain = ingest.TableConfig("t", "t", ("k",)), ingest.TableConfig("u", "t")
    keyed, appended = VersionedTable(spark, str(tmp_path / "t")), VersionedTable(spark, str(tmp_path / "u"))
    runs = [[(1, "2024-01-01", "a"), (2, None, "b"), (None, None, "n")],
            [(1, "2024-01-01", "a"), (2, None, "b"), (None, None, "n"), (3, None, "c"), (3, None, "c"), (1, None, "late")],
            [(1, "2024-01-01", "a"), (2, "2024-01-05", "b2"), (None, None, "n"), (3, None, "c"), (3, None, "c"), (1, None, "late")]]
    counts = []
    marks = {"t": None, "u": None}
    for rows in runs:
        source = frame(spark, rows, "k long, t string, v string").withColumn("t", F.col("t").cast("timestamp_ntz"))
        for target, c in ((keyed, config), (appended, plain)):
            _, n, marks[c.table_name] = ingest.ingest_table(spark, source, target, c, marks[c.table_name])
            counts.append(n)
    assert content(keyed.read(), "k", "v") == [(1, "a"), (2, "b2"), (3, "c")]
    assert keyed.rejected().count() == 1
    assert counts == [3, 3, 1, 3, 1, 1]
    assert content(appended.read(), "v") == sorted((v,) for v in ["a", "b", "n", "c", "c", "late", "b2"])


def test_dimension_loads_balance(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "d"))
    for load, rows in (("one", [("a", 1), ("a", 2), (None, 3)]), ("two", [("b", 1), (None, 4), (None, 5)])):
        load_dimension(t, frame(spark, rows, "id string, v int"), "id", lambda before, s: (
            s.dropna(subset=["id"]).dropDuplicates(["id"]) if before is None else upsert(before, s, ["id"])), load)
    assert [(b.read, b.loaded, b.collapsed, b.rejected) for b in t.balances()] == [(3, 1, 1, 1), (3, 1, 0, 2)]
    assert content(t.rejected(), "v", "rejected_by") == [(3, "one"), (4, "two"), (5, "two")] and t.read().count() == 2


def test_file_checks_name_the_broken_file(spark, tmp_path):
    frame(spark, [(1, 1, "a"), (2, 2, "b")]).repartition(2).write.parquet(str(tmp_path / "good"))
    frame(spark, []).coalesce(1).write.parquet(str(tmp_path / "none"))
    frame(spark, [(1, "x")], "other long, name string").coalesce(1).write.parquet(str(tmp_path / "mixed"))
    [other] = [f for f in os.listdir(tmp_path / "mixed") if f.endswith(".parquet")]
    whole = (tmp_path / "mixed" / other).read_bytes()
    (tmp_path / "mixed" / "part-9.parquet").write_bytes(whole[:-20])
    (tmp_path / "mixed" / "part-8.parquet").write_bytes(b"")
    (tmp_path / "mixed" / "odd name.parquet").write_bytes(whole)
    got = {(r.path.split("/")[-2], r.file_name): r for r in tables.file_checks(spark, str(tmp_path), r"^part-[-0-9a-z.]+\.parquet$", "2020-01-01", 1, "*.parquet").collect()}
    assert sum(r.n_rows for (d, _), r in got.items() if d == "good") == 2 and all(r.readable and r.name_ok for (d, _), r in got.items() if d == "good")
    [none] = [r for (d, _), r in got.items() if d == "none"]
    assert none.readable and none.n_rows == 0
    assert not got["mixed", "part-9.parquet"].readable and got["mixed", "part-9.parquet"].not_empty
    assert not got["mixed", "part-8.parquet"].readable and not got["mixed", "part-8.parquet"].not_empty
    odd = [r for (d, n), r in got.items() if d == "mixed" and "odd" in n]
    assert len(odd) == 1 and odd[0].readable and odd[0].n_rows == 1 and not odd[0].name_ok and odd[0].is_recent


def test_asof_merge_costs_rows_plus_versions(spark, tmp_path):
    from tidemark.operators import lookups
    many = 100_000
    versions = spark.range(many).select(F.lit("hot").alias("id"), F.col("id").alias("key"),
                                        F.timestamp_seconds(F.col("id") * 600).cast("timestamp_ntz").alias("valid_from"),
                                        F.timestamp_seconds(F.col("id") * 600 + 600).cast("timestamp_ntz").alias("valid_to"))
    events = spark.range(40_000).select(F.col("id").alias("event"), F.lit("hot").alias("id"),
                                        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(many * 600))).cast("timestamp_ntz").alias("at"))
    # a gap, a version of no length, and a key whose only version began long before
    rare = frame(spark, [("rare", -1, "1990-01-01 00:00:00", "9999-12-31 00:00:00")], "id string, key long, valid_from string, valid_to string")
    rare = rare.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("valid_from", "valid_to")})
    dim = versions.where("key % 100 <> 7").unionByName(rare)
    dim = dim.unionByName(versions.where("key = 50").withColumns({"key": F.lit(-5).cast("long"), "valid_to": F.col("valid_from")}))
    late = frame(spark, [(-1, "rare", "2024-05-05 00:00:00"), (-2, "none", "2024-05-05 00:00:00"), (-3, None, "2024-05-05 00:00:00"), (-4, "hot", None),
                         (-5, "rare", "1980-01-01 00:00:00")], "event long, id string, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    fact = events.unionByName(late)
    assert lookups.fact_asof_lookup(fact, dim, "id", "at", "key").columns == ["event", "id", "at", "key"]
    got = {r.event: r.key for r in lookups.fact_asof_lookup(fact, dim, "id", "at", "key").collect()}
    want = {r.event: r.k for r in events.select("event", F.expr(f"pmod(xxhash64(event), {many * 600}) div 600").alias("k")).collect() if r.k % 100 != 7}
    assert got == want | {-1: -1}
    plan = lookups.asof_merge(fact, dim, "id", "at", "key")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert len(joins) == 1 and "_b" in joins[0] and "valid" not in joins[0]  # only on key and bucket: rows never meet versions


def test_keys_are_found_on_the_data(spark):
    from tidemark.operators import infer
    rows = [(k // 4, k % 4, k % 3, "x", None if k == 5 else k, float(k)) for k in range(400)]
    df = frame(spark, rows, "order_id long, line int, part int, flag string, almost long, price double")
    assert infer.minimal_keys(df)[0] == ("order_id", "line")
    assert all("almost" not in s and "price" not in s for s in infer.minimal_keys(df))
    assert infer.minimal_keys(df.unionByName(df.limit(1))) == [] and infer.minimal_keys(df.limit(0)) == []
    assert infer.minimal_keys(df.withColumn("id", F.monotonically_increasing_id()))[0] == ("id",)
    given = {n: spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("lineitem", "nation")}
    assert "lineitem" not in infer.discover_keys(given)  # its lines repeat numbers
    given["lineitem"] = given["lineitem"].dropDuplicates(["l_orderkey", "l_linenumber"])
    assert infer.discover_keys(given) == {"lineitem": ["l_orderkey", "l_linenumber"], "nation": ["n_nationkey"]}


def test_reports_on_stored_silver_prune_months(spark):
    from tidemark.plans import analytics, star
    stored = star.stored_silver(spark, "/root/testdata/sf0.001")
    plan = analytics.daily_sales_silver(stored.silver("sales"), "2001-08-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_key" in plan and "Window" not in plan


def test_partitioned_folders_are_read_together(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.append(frame(spark, []), ["t"])                                   # no row, no file, but columns
    assert content(t.read()) == [] and t.read().columns == ["k", "v", "t"]
    t.append(frame(spark, [(1, 1, "a"), (2, 2, "b")]), ["t"])
    t.append(frame(spark, [(3, 1, "c")]), ["t"])
    t.append(frame(spark, [(4, 3, "d")]))
    assert content(t.read(), "k", "t", "v") == [(1, 1, "a"), (2, 2, "b"), (3, 1, "c"), (4, 3, "d")]
    t.archive(lambda df: df.withColumn("_old", F.col("t") == 1))
    assert content(t.read(), "k") == [(2,), (4,)] and content(t.archived(), "k", "t") == [(1, 1), (3, 1)]
