"""Expressions, cleansing, calendar, masks on literal rows."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal, silver
from tidemark.functions import expressions as ex
from tidemark.operators import protect as p

STAMP = "source_system string, last_modified_timestamp timestamp_ntz, load_timestamp timestamp_ntz"


def test_ratio_is_null_on_zero_and_null(spark, rows):
    df = spark.createDataFrame([(D(1), D(3)), (D(1), D(0)), (D(1), None)], "a decimal(18,2), b decimal(18,2)")
    got = [r[0] for r in df.select(F.round(ex.ratio("a", "b"), 4)).collect()]
    assert got == [D("0.3333"), None, None]


def test_ratio_or_zero_and_percent(spark):
    df = spark.createDataFrame([(5, 0), (5, 8)], "a long, b long")
    assert [r[0] for r in df.select(ex.percent_or_zero("a", "b").cast("decimal(18,4)")).collect()] == [D("0.0000"), D("62.5000")]


def test_date_time_keys_and_whole_hours(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-03-05 00:59:00' AS a, timestamp_ntz'2024-03-05 01:01:07' AS b")
    r = df.select(ex.date_key("a"), ex.time_key("b"), ex.elapsed("HOUR", "a", "b"), ex.elapsed("MINUTE", "a", "b")).first()
    assert tuple(r) == (20240305, 10107, 0, 2)


def test_conditions_combine(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, s string")
    either = ex.conditions([("s", "Is", "Equal to", "a"), ("s", "Is", "Null", None)], "Or")
    both = ex.conditions([("n", "Is", "Greater than", 1), ("s", "Is not", "Null", None)], "And")
    assert rows(df.where(either), "n") == [(1,), (3,)]
    assert rows(df.where(both), "n") == [(2,)]


def test_contact_checks(spark):
    df = spark.createDataFrame([(" Ann@Example.com ", "+1-555-0001"), ("ann.example.com", "12"), (None, None)], "e string, p string")
    assert [tuple(r) for r in df.select(ex.email_valid("e"), ex.phone_valid("p")).collect()] == [(True, True), (False, False), (False, False)]


def test_silver_performance_guards(spark):
    df = spark.createDataFrame(
        [("p1", "c", "h", None, 0, 5, D(0), 0, D(10)), ("p2", "c", "h", None, 100, 150, D(50), 5, D(100)), ("p3", "c", "h", None, None, None, None, None, None)],
        "performance_id string, campaign_id string, channel_id string, performance_date date, impressions long, clicks long, cost decimal(18,2), "
        "conversions long, revenue decimal(18,2)").selectExpr("*", "'x' AS source_system", "timestamp_ntz'2024-01-01 00:00:00' AS last_modified_timestamp",
                                                              "timestamp_ntz'2024-01-01 00:00:00' AS load_timestamp")
    out = {r.performance_id: r for r in silver.performance(df, "2024-02-01 00:00:00").collect()}
    assert (out["P1"].ctr, out["P1"].roas, out["P1"].clicks_valid, out["P1"].clicks_capped) == (0, 0, False, 0)
    assert (out["P2"].ctr, out["P2"].cpc, out["P2"].cpa, out["P2"].roas) == (D("150.0000"), D("0.3333"), D("10.0000"), D("2.0000"))
    assert out["P2"].clicks_capped == 100 and out["P3"].impressions == 0 and out["P3"].cpa == 0
    off = silver.performance(df, "2024-02-01 00:00:00", click_validation=False, min_impressions=100, max_ctr=90)
    assert [r.clicks_capped for r in off.orderBy("performance_id").collect()][:2] == [5, 150]
    assert [r.ctr for r in off.orderBy("performance_id").collect()][1] == 0


def test_silver_sales_tolerance_and_flag(spark):
    df = spark.sql("""SELECT ' ord-1 ' AS order_id, ' l1' AS order_line_id, 'c' AS customer_id, 'p' AS product_id, cast(null AS string) AS campaign_id,
      date'2024-01-01' AS order_date, timestamp_ntz'2024-01-01 10:00:00' AS order_timestamp, 2 AS quantity, cast(10 AS decimal(18,2)) AS unit_price,
      cast(15 AS decimal(18,2)) AS discount_amount, cast(1 AS decimal(18,2)) AS tax_amount, cast(x AS decimal(18,2)) AS line_total, cast(7 AS decimal(18,2)) AS revenue,
      'x' AS source_system, timestamp_ntz'2024-01-01 00:00:00' AS last_modified_timestamp, timestamp_ntz'2024-01-01 00:00:00' AS load_timestamp
      FROM VALUES (5.00), (5.01), (6.00) AS t(x)""")
    got = [(r.order_id, r.order_line_id, r.line_total_validated, r.discount_percent, r.discount_flag)
           for r in silver.sales(df, "2024-02-01 00:00:00").orderBy("line_total").collect()]
    assert [g[2] for g in got] == [D("5.00"), D("5.01"), D("5.00")]
    assert got[0] == ("ORD-1", "L1", D("5.00"), D("75.0000"), True)


def test_silver_fills_and_duration(spark):
    df = spark.sql("""SELECT ' cpg-1 ' AS campaign_id, cast(null AS string) AS campaign_name, cast(null AS string) AS campaign_type, date'2024-01-01' AS start_date,
      date'2024-01-31' AS end_date, cast(null AS decimal(18,2)) AS budget, cast(null AS string) AS status, cast(null AS string) AS objective,
      'x' AS source_system, timestamp_ntz'2024-01-01 00:00:00' AS last_modified_timestamp, timestamp_ntz'2024-01-01 00:00:00' AS load_timestamp""")
    r = silver.campaigns(df, "2024-02-01 00:00:00").first()
    assert (r.campaign_id, r.campaign_name, r.campaign_type, r.budget, r.status, r.objective, r.duration_days) == (
        "CPG-1", "Unknown Campaign", "Unknown", 0, "Unknown", None, 31)


def test_default_calendar(spark):
    d = cal.dim_date(spark)
    assert d.count() == 4018 and d.select("date_key").distinct().count() == 4018
    r = d.where("date_key = 20240630").first()
    assert (r.month_name, r.day_name, r.month_short_name, r.day_short_name, r.day_of_week, r.is_weekend, r.quarter_name, r.week_of_year) == (
        "June", "Sunday", "Jun", "Sun", 7, True, "Q2", 26)
    assert d.where("date_key = 20210101").first().week_of_year == 53


@pytest.mark.parametrize("role,expected", [
    (p.BUSINESS, [500, 5000, 5000, 50000, 100000, 100000]), (p.SCIENTIST, [None] * 6)])
def test_bands(spark, role, expected):
    values = ["999.99", "1000", "9999.99", "10000", "100000", None]
    df = spark.createDataFrame([(i, D(v) if v else None) for i, v in enumerate(values)], "i int, v decimal(18,2)")
    assert [r[0] for r in df.orderBy("i").select(p.mask_banded("v", role)).collect()] == expected


def test_text_masks(spark):
    df = spark.createDataFrame([("ann@x.org",)], "e string")
    shown = df.select(p.mask_email("e", p.ADMIN), p.mask_email("e", p.ANALYST), p.mask_email("e", p.BUSINESS), p.mask_email_prefix("e", p.BUSINESS),
                      p.mask_full("e", p.ENGINEER), p.mask_full("e", p.BUSINESS), p.mask_hash("e", p.ANALYST)).first()
    assert tuple(shown) == ("ann@x.org", "***@x.org", "***@***.com", "ann***@***.com", "***MASKED***", "***REDACTED***", "ann@x.org")
    assert len(df.select(p.mask_hash("e", p.BUSINESS)).first()[0]) == 64


def test_row_policy(spark, rows):
    df = spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "id int, segment string")
    m = spark.sql("""SELECT * FROM VALUES ('u1', 'A', date'2024-01-01', date'9999-12-31'), ('u2', 'A', date'2024-01-01', date'2024-01-15')
                     AS t(user_name, allowed_segment, effective_date, expiration_date)""")

    def seen(user, role):
        return rows(p.row_policy(df, "segment", m, "allowed_segment", user, role, "2024-01-31"), "id")
    assert seen("u1", p.BUSINESS) == [(1,)]
    assert seen("u2", p.BUSINESS) == [] and seen("nobody", p.BUSINESS) == []
    assert seen("nobody", p.AUDITOR) == [(1,), (2,), (3,)]


def test_masks_reach_aggregates(spark):
    df = spark.createDataFrame([(D(1),), (D(20000),)], "v decimal(18,2)")
    view = p.secured_view(df, {"v": p.mask_banded}, p.BUSINESS)
    assert view.agg(F.sum("v")).first()[0] == 50500
