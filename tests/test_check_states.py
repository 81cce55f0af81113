"""Counts of row rules by partition: what a second run scans, and that its results are those of a whole scan."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as q
from tidemark.operators.check_states import CheckStates, Partitioned, is_row_rule
from tidemark.sources.versions import VersionedTable


def check(name, violates, **more):
    return q.Check(name, name, "SILVER", "VALIDITY", "HIGH", "t", violates=violates, **more)


CHECKS = [check("neg", lambda t: F.col("v") < 0), check("null", lambda t: F.col("v").isNull(), expected=1, compare="le"),
          check("late", lambda t: F.col("day") > F.lit(t.parameters["today"])),
          check("far", lambda t: F.col("v") > t["t"].agg(F.avg("v")).scalar()),
          q.Check("rows", "rows", "SILVER", "COMPLETENESS", "LOW", "t", measure=lambda t: F.count(F.lit(1)), expected=2, compare="ge")]
ROWS = [(1, 5, "a"), (-1, 6, "a"), (None, 7, "b"), (3, 8, "b c/d"), (-2, 9, None)]


@pytest.fixture
def made(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))

    def frame(rows):
        return spark.createDataFrame(rows, "v int, day int, m string")

    def tables(today=7):
        return q.Tables({"t": table.read}, today=today)

    return table, frame, tables, CheckStates(spark, str(tmp_path / "states")), {"t": Partitioned(table, "m")}


def test_results_are_those_of_a_whole_scan_and_new_partitions_only_are_read(spark, rows, made):
    table, frame, tables, states, stored = made
    table.append(frame(ROWS[:3]), ["m"])
    same = lambda t: rows(states.evaluate(t, CHECKS, stored)) == rows(q.evaluate(t, CHECKS))
    mine = [c for c in CHECKS if is_row_rule(tables(), c)]
    assert [c.check_id for c in mine] == ["neg", "null", "late"]       # no comparison with the whole table, no measure
    assert states.refresh(tables(), "t", stored["t"], mine) == {"a": 3, "b": 3}
    assert same(tables())
    assert states.refresh(tables(), "t", stored["t"], mine) == {}
    version = states.states.version()
    table.append(frame(ROWS[3:]), ["m"])                               # two new partitions, one of them null
    assert set(states.refresh(tables(), "t", stored["t"], mine).values()) == {3} and states.states.version() > version
    assert same(tables())
    table.append(frame([(-9, 9, "a")]), ["m"])                         # one partition has one more file
    assert states.refresh(tables(), "t", stored["t"], mine) == {"a": 3}
    assert same(tables())
    assert set(states.refresh(tables(8), "t", stored["t"], mine).values()) == {1}  # a rule with another day is counted again, others are not
    assert same(tables(8))


def test_only_files_of_the_partitions_are_opened(spark, rows, made, tmp_path):
    table, frame, tables, states, stored = made
    table.append(frame(ROWS), ["m"])
    one = stored["t"].rows(spark, ["a"])
    assert rows(one, "v") == [(-1,), (1,)]
    for path in (tmp_path / "t").rglob("m=b*/*.parquet"):              # a broken file of another partition is not seen
        path.write_bytes(b"PAR1 no parquet at all PAR1")
    assert rows(one.agg(F.sum("v"))) == [(0,)]


def test_partitions_that_go_and_tables_without_rows(spark, rows, made):
    table, frame, tables, states, stored = made
    table.append(frame(ROWS), ["m"])
    mine = CHECKS[:3]
    states.refresh(tables(), "t", stored["t"], mine)
    table.publish(frame(ROWS[:2]), ["m"])                              # the table anew, with one partition
    states.refresh(tables(), "t", stored["t"], mine)
    assert {r["part"] for r in states.states.read().collect()} == {"a"}
    assert rows(states.evaluate(tables(), mine, stored)) == rows(q.evaluate(tables(), mine))
    assert [r[1] for r in rows(states.results("nothing", mine))] == [0.0, 0.0, 0.0]


def test_the_log_is_that_of_a_whole_run(spark, rows, made):
    table, frame, tables, states, stored = made
    table.append(frame(ROWS), ["m"])
    logs = [q.run_layer_checks(spark, tables(), CHECKS, "SILVER", "r", "2024-01-01 00:00:00", by=by).select(*q.RESULT_COLUMNS)
            for by in (q.evaluate, lambda t, checks: states.evaluate(t, checks, stored))]
    assert rows(logs[0]) == rows(logs[1])


def test_merged_tables_are_refused(spark, made):
    table, frame, tables, states, stored = made
    table.merge(frame(ROWS), ["day"])
    with pytest.raises(ValueError):
        stored["t"].folders()
