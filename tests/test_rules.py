"""Literal edge cases for the semantic rules (small in-memory frames)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from deskflow.functions import clean
from deskflow.functions.numeric import int_avg, pct2, pearson, round_even
from deskflow.functions.temporal import hours_crossed, minutes_crossed, parse_dayfirst, round_to_millis
from deskflow.functions.util import local_rows
from deskflow.operators.quality import status

TS = dt.datetime


def one(df):
    return [tuple(r) for r in df.collect()]


def test_boundaries_not_elapsed(spark):
    df = spark.createDataFrame(
        [(TS(2020, 1, 1, 0, 59, 30), TS(2020, 1, 1, 1, 1, 0)), (TS(2020, 1, 1, 10, 0, 59), TS(2020, 1, 1, 10, 1, 0)),
         (TS(2020, 12, 31, 23, 59, 0), TS(2021, 1, 1, 0, 0, 0))], "a timestamp_ntz, b timestamp_ntz")
    got = one(df.select(hours_crossed("a", "b"), minutes_crossed("a", "b")))
    assert got == [(1, 2), (0, 1), (1, 1)]


def test_int_avg_truncates_toward_zero(spark):
    df = spark.createDataFrame([("p", 1), ("p", 2), ("n", -1), ("n", -2), ("z", None)], "g string, x int")
    got = dict(one(df.groupBy("g").agg(int_avg("x"))))
    assert got == {"p": 1, "n": -1, "z": None}


@pytest.mark.parametrize("n,d,expected", [(1, 8, "12.50"), (1, 3, "33.33"), (2, 3, "66.67"), (1, 800, "0.13"),
                                           (3, 800, "0.38"), (0, 0, None)])
def test_decimal_percentage(spark, n, d, expected):
    got = spark.range(1).select(pct2(F.lit(n), F.lit(d))).first()[0]
    assert (None if got is None else str(got)) == expected


def test_round_half_even(spark):
    got = one(spark.createDataFrame([(0.125,), (0.375,)], "x double").select(round_even("x", 2)))
    assert got == [(0.12,), (0.38,)]


def test_pearson_guards(spark):
    const = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, y double")
    assert const.agg(pearson("x", "y")).first()[0] is None
    single = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    assert single.agg(pearson("x", "y")).first()[0] is None
    with_null = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0), (100.0, None)], "x double, y double")
    assert with_null.agg(pearson("x", "y")).first()[0] == pytest.approx(1.0)


def test_parse_never_raises(spark):
    df = spark.createDataFrame([("?",), ("",), ("n/a",), ("31/2/2016 10:00",), ("5/3/2016 7:05",)], "s string")
    got = [r[0] for r in df.select(parse_dayfirst("s")).collect()]
    assert got == [None, None, None, None, TS(2016, 3, 5, 7, 5)]
    nums = spark.createDataFrame([("1000.00",), ("n/a",), ("12.5",)], "s string")
    got = [r[0] for r in nums.select(F.col("s").try_cast("double").try_cast("decimal(5,2)")).collect()]
    assert got == [None, None, Decimal("12.50")]


def test_round_to_millis(spark):
    df = spark.createDataFrame([(TS(2020, 1, 1, 0, 0, 0, 123556),), (TS(2020, 1, 1, 0, 0, 0, 123400),),
                                (TS(2020, 1, 1, 0, 0, 59, 999600),)], "t timestamp_ntz")
    got = [r[0] for r in df.select(round_to_millis("t")).collect()]
    assert got == [TS(2020, 1, 1, 0, 0, 0, 124000), TS(2020, 1, 1, 0, 0, 0, 123000), TS(2020, 1, 1, 0, 1, 0)]


def test_null_tokens_and_truncate(spark):
    df = spark.createDataFrame([("NA",), ("",), ("nan",), ("None",), ("ok",)], "s string")
    assert [r[0] for r in df.select(clean.null_tokens("s")).collect()] == [None, None, None, None, "ok"]
    t = spark.createDataFrame([("abcd",), ("abcde",)], "s string")
    assert [r[0] for r in t.select(clean.truncate("s", 4)).collect()] == ["abcd", "abcd"]


def test_incident_priority_first_rule_wins(spark):
    df = spark.createDataFrame([("12", "low"), (None, "High"), ("3 - Moderate", None), ("4", None)], "c string, n string")
    got = [r[0] for r in df.select(clean.incident_priority_id("c", "n")).collect()]
    assert got == [1, 2, 3, 4]


def test_ticket_priority_rules(spark):
    df = spark.createDataFrame([(" critical ",), ("p2",), ("LOW",), (None,), ("high",)], "p string")
    assert [r[0] for r in df.select(clean.ticket_priority_id("p")).collect()] == [1, 2, 4, 3, 2]
    names = [r[0] for r in df.select(clean.ticket_priority_name("p")).collect()]
    assert names == ["Medium", "Medium", "Medium", "Medium", "Medium"]


def test_reassign_bins(spark):
    df = spark.createDataFrame([(-1,), (0,), (4,), (100,), (101,)], "x int")
    label, order = clean.reassign_bin("x")
    assert one(df.select(label, order)) == [(None, None), ("0", 0), ("4+", 4), ("4+", 4), (None, None)]


def test_validation_status_rule(spark):
    cases = [(0, 0, "PASS"), (1, 0, "FAIL"), (-1, 0, "FAIL"), (5, 5, "PASS"), (6, 5, "FAIL"), (None, 5, "FAIL"),
             (5, None, "FAIL")]
    dec = lambda x: None if x is None else Decimal(x)
    df = spark.createDataFrame([(dec(v), dec(t)) for v, t, _ in cases], "v decimal(20,4), t decimal(20,4)")
    assert [r[0] for r in df.select(status("v", "t")).collect()] == [c[2] for c in cases]


def test_state_cleaning(spark):
    df = spark.createDataFrame([(" New ",), ("-100",), ("nat",), ("7",), ("6",), (None,)], "s string")
    assert [r[0] for r in df.select(clean.clean_state("s")).collect()] == ["new", None, "new", "resolved", "closed", None]


def test_leading_int_has_no_digit_limit(spark):
    df = spark.createDataFrame([("000000000002 - Medium",), ("0000000000000000000007",), ("99999999999 - x",)], "s string")
    assert [r[0] for r in df.select(clean.leading_int("s")).collect()] == [2, 7, None]


def test_every_order_is_a_ticket(wh):
    assert wh.fact_ticket.count() == wh.raw("orders").count()
    assert wh.fact_ticket.join(wh.dim_client, "client_id", "left_anti").count() == 0


def test_leading_int(spark):
    df = spark.createDataFrame([("2 - Medium",), ("?",), (None,), ("x",)], "s string")
    assert [r[0] for r in df.select(clean.leading_int("s")).collect()] == [2, None, None, None]


def test_local_rows_broadcasts(spark):
    small = local_rows(spark, [(1, "a"), (2, "b")], "k int, v string")
    big = spark.range(1000).withColumnRenamed("id", "k")
    plan = big.join(small, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_time_arithmetic_ignores_session_zone(spark):
    from deskflow.functions.temporal import elapsed_hours, hour_start

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        # Wall-clock times across the spring-forward night in that zone.
        df = spark.createDataFrame([(TS(2024, 3, 10, 1, 30), TS(2024, 3, 10, 3, 30))], "a timestamp_ntz, b timestamp_ntz")
        got = df.select(elapsed_hours("a", "b"), hours_crossed("a", "b"), hour_start("b")).first()
        assert tuple(got) == (2, 2, TS(2024, 3, 10, 3, 0))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
