"""A query stores the tables it reads, no others, and leaves no shuffle files behind."""

import os

import pytest

import __spark_entry__ as contract
from tests import check
from tidemark import session
from tidemark.plans import star as plans
from tidemark.sources import sinks
from tidemark.sources.versions import VersionedTable

SF = "/root/testdata/sf0.001"


@pytest.fixture
def unread(tmp_path):
    """The given tables under a path that no query has read yet."""
    os.symlink(SF, tmp_path / "sf")
    return str(tmp_path / "sf")


@pytest.mark.parametrize("key, stored", [
    ("dq_G13", set()), ("dq_S20", set()), ("dq_G10", {"silver_products", "dim_product"})])
def test_a_check_stores_what_it_reads(spark, unread, key, stored):
    problem, n = check.compare(spark, check.duck(SF), unread, key, contract.queries()[key], contract.oracle_sql()[key])
    assert problem is None and n == 1
    assert set(plans.gold(spark, unread).written) == stored


def test_a_star_is_stored_as_a_whole(spark, unread):
    star = plans.store_all(plans.gold(spark, unread))
    assert set(star.written) == set(plans.gold(spark, unread).written) == set(star.kept)
    assert plans.gold(spark, unread).fact_sales.count() == plans.Star(spark, SF).fact_sales.count()


def test_shuffle_files_go_with_the_statement(spark):
    key = session.SHUFFLES_FREED
    before = spark.conf.get(key)
    with pytest.raises(ValueError), session.shuffles_freed(spark):
        assert spark.conf.get(key) == "true"
        raise ValueError
    assert spark.conf.get(key) == before


def test_sales_and_their_facts_are_written_in_parts(spark, unread, monkeypatch):
    monkeypatch.setattr(session, "SLICE_BYTES", 50_000)
    star = plans.gold(spark, unread)
    whole = plans.silver_table(spark, unread, "sales")
    parts = star.parts("silver_sales", whole)
    assert 1 < len(parts) <= session.MOST_SLICES
    keys = [{r[0] for r in p.select("order_line_id").collect()} for p in parts]
    assert sum(map(len, keys)) == len(set().union(*keys)) == whole.count()
    assert len(star.parts("fact_sales", star.silver("sales"))) > 1
    problem, n = check.compare(spark, check.duck(SF), unread, "fact_sales", contract.queries()["fact_sales"], contract.oracle_sql()["fact_sales"])
    assert problem is None and n > 0
    assert set(star.written) == {"silver_sales", "silver_customers", "silver_products", "silver_campaigns", "dim_customer", "dim_product",
                                 "dim_campaign", "dim_date", "fact_sales"}
    assert star.silver("sales").drop("month_key").exceptAll(whole).count() == 0


def test_file_parts_have_each_file_once(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).selectExpr("id", "cast(id % 7 AS int) AS m")
    df.repartition(3).write.partitionBy("m").parquet(path)
    for n in (1, 4, 50):
        parts = sinks.file_slices(spark, path, df.schema, n)
        files = [f for p in parts for f in p.inputFiles()]
        assert len(files) == len(set(files)) == 21 and (len(parts) > 1) == (n > 1)
        assert sorted(tuple(r) for p in parts for r in p.collect()) == sorted(tuple(r) for r in df.collect())
    empty = str(tmp_path / "none")
    df.limit(0).write.parquet(empty)
    assert [p.count() for p in sinks.file_slices(spark, empty, df.schema, 4)] == [0]


def test_a_refresh_goes_by_parts(spark, unread, monkeypatch):
    parts, merge = [], VersionedTable.merge
    monkeypatch.setattr(session, "SLICE_BYTES", 100_000)
    monkeypatch.setattr(VersionedTable, "merge", lambda self, source, *a, **b: parts.append(len(source) if isinstance(source, list) else 1) or merge(self, source, *a, **b))
    problem, n = check.compare(spark, check.duck(SF), unread, "incremental_refresh", contract.queries()["incremental_refresh"], contract.oracle_sql()["incremental_refresh"])
    assert problem is None and n > 0 and max(parts) > 1


def test_a_merge_in_parts_is_that_of_the_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "slices_for", lambda _: 3)
    rows = lambda *r: spark.createDataFrame(list(r), "k long, v string")
    tables = [VersionedTable(spark, str(tmp_path / n)) for n in ("whole", "parts")]
    loads = [([rows((1, "a"), (2, "b")), rows((3, "c"), (None, "x"))], None), ([rows((1, "d"), (4, "e")), rows((5, "f"))], rows((2, ""), (5, ""), (9, "")))]
    for parts, gone in loads:
        balances = [t.merge(source, ["k"], load="l", gone=gone, buckets=4) for t, source in zip(tables, (parts[0].unionByName(parts[1]), parts))]
        assert balances[0] == balances[1]
        found = [sorted(tuple(r) for r in t.read().select("k", "v").collect()) for t in tables]
        assert found[0] == found[1] and [t.rejected().count() for t in tables] == [1, 1]
    assert found[0] == [(1, "d"), (3, "c"), (4, "e"), (5, "f")]
    assert [t.version() for t in tables] == [tables[0].version()] * 2
