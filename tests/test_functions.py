from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import dates
from tidemark.functions import (cents_to_dollars, days_between, exact_avg, exact_sum, fiscal_quarter, null_if_zero,
                                safe_divide, strict_date, surrogate_key, text_flag, title_case)


def evaluate(spark, values, schema, *columns):
    return [tuple(row) for row in spark.createDataFrame(values, schema).select(*columns).collect()]


def test_title_case_starts_words_after_punctuation(spark):
    words = ["jean-luc PICARD", "MIDDLE EAST", "o'NEIL", "a_b#c", "x.y/z", "tab\tstop", "", None, "two  spaces", "é-à"]
    got = [r[0] for r in evaluate(spark, [(w,) for w in words], "s string", title_case(F.col("s")))]
    assert got == ["Jean-Luc Picard", "Middle East", "O'neil", "A_B#C", "X.Y/Z", "Tab\tStop", "", None,
                   "Two  Spaces", "É-À"]


def test_strict_date_keeps_full_dates_only(spark):
    texts = ["2024-01-05", "2024-1-5", "2024", "2024-02", "2024-02-30", "05.01.2024", "unknown", "", None]
    got = [r[0] for r in evaluate(spark, [(t,) for t in texts], "s string", strict_date(F.col("s"), T.StringType()))]
    assert got == [dt.date(2024, 1, 5), dt.date(2024, 1, 5)] + [None] * 7


def test_text_flag_spellings_and_error(spark):
    texts = ["true", "T", "yes", "1", "ON", "false", "f", "No", "0", "off", None]
    got = [r[0] for r in evaluate(spark, [(t,) for t in texts], "s string", text_flag(F.col("s")))]
    assert got == [True] * 5 + [False] * 5 + [None]
    with pytest.raises(PySparkException):
        evaluate(spark, [("maybe",)], "s string", text_flag(F.col("s")))


def test_fiscal_year_starts_in_february(spark):
    days = [dt.date(2024, 1, 15), dt.date(2024, 2, 1), dt.date(2024, 3, 31), dt.date(2024, 5, 1),
            dt.date(2024, 12, 31), None]
    got = [r[0] for r in evaluate(spark, [(d,) for d in days], "d date", fiscal_quarter(F.col("d")))]
    assert got == ["FY2023-Q4", "FY2024-Q1", "FY2024-Q1", "FY2024-Q2", "FY2024-Q4", None]


def test_safe_divide(spark):
    rows = [(1, 4), (1, 0), (1, None), (None, 4)]
    got = evaluate(spark, rows, "n int, d int", safe_divide(F.col("n"), F.col("d")),
                   safe_divide(F.col("n"), F.col("d"), -1))
    assert got == [(0.25, 0.25), (0.0, -1.0), (0.0, -1.0), (None, None)]


def test_cents_to_dollars(spark):
    got = evaluate(spark, [(1999,), (5,), (None,)], "c long", cents_to_dollars(F.col("c")),
                   cents_to_dollars(F.col("c"), 1))
    assert got == [(Decimal("19.99"), Decimal("20.0")), (Decimal("0.05"), Decimal("0.1")), (None, None)]


def test_null_if_zero_and_days_between(spark):
    assert evaluate(spark, [(0,), (3,)], "n int", null_if_zero(F.col("n"))) == [(None,), (3,)]
    days = [(dt.date(2024, 1, 1), dt.date(2024, 1, 31))]
    assert evaluate(spark, days, "a date, b date", days_between(F.col("a"), F.col("b"))) == [(30,)]


def test_surrogate_key_spells_out_missing_parts(spark):
    got = evaluate(spark, [("a", 1), ("a", None)], "k string, n int", surrogate_key("k"), surrogate_key("k", "n"))

    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    assert got == [(md5("a"), md5("a-1")), (md5("a"), md5("a-_dbt_utils_surrogate_key_null_"))]


def test_exact_sum_equals_decimal_sum(spark):
    edges = ["0.00", "-0.01", "9999999999.99", "-9999999999.99", "1048576.00", "10485.75", "0.29", "1.15", None]
    rows = [(i % 3, Decimal(e) if e else None) for i, e in enumerate(edges * 7)] + [(9, None)]
    df = spark.createDataFrame(rows, "g int, x decimal(12,2)")
    spread = spark.range(20000).selectExpr(
        "cast(id % 7 + 20 as int) g", "cast(hash(id) / 100 as decimal(12,2)) x")
    for frame in (df, spread):
        got = frame.groupBy("g").agg(exact_sum(F.col("x"), 2).alias("a"), F.sum("x").alias("b")).collect()
        assert got and all(r.a == r.b for r in got)
    fine = spark.range(20000).selectExpr("cast(id % 7 as int) g", "cast(hash(id) / 10000 as decimal(12,4)) x")
    assert all(r.a == r.b for r in fine.groupBy("g").agg(exact_sum(F.col("x"), 4).alias("a"),
                                                          F.sum("x").alias("b")).collect())


def test_exact_avg_rounds_ties_up(spark):
    df = spark.range(512).selectExpr("cast(if(id = 0, 1.01, 1.00) as decimal(10,6)) x")
    assert df.agg(exact_avg(F.col("x"), 6, 10)).first()[0] == Decimal("1.0000195313")
    assert df.where("false").agg(exact_avg(F.col("x"), 6, 10)).first()[0] is None


def test_title_case_keeps_control_characters(spark):
    got = [r[0] for r in evaluate(spark, [("a\x01 b",), ("x\x01y-z",)], "s string", title_case(F.col("s")))]
    assert got == ["A\x01 B", "X\x01y-Z"]


def test_strict_date_with_time_and_line_end(spark):
    texts = ["2024-01-05 10:00", "2024-01-05T10:00:30.5Z", "2024-01-05\n", "2024-01-05 10", "2024-01-05 x"]
    got = [r[0] for r in evaluate(spark, [(t,) for t in texts], "s string", strict_date(F.col("s"), T.StringType()))]
    assert [str(d) for d in got] == ["2024-01-05", "2024-01-05", "None", "None", "None"]


def test_exact_sum_refuses_more_digits_than_it_can_hold(spark):
    frame = spark.sql("SELECT cast('12345678901234567.89' AS decimal(20,2)) AS x")
    with pytest.raises(Exception, match="more than 15 digits"):
        frame.agg(exact_sum(F.col("x"), 2)).collect()


def test_plain_dates_skip_the_pattern_and_nothing_else_does(spark):
    texts = ["2024-01-05", "2024-13-45", "2024-01-1 ", "2024-01-1T", "2024-1 -01", "2024-0T-01", "+024-01-01", "-024-01-01",
             " 024-01-01", "2024-1-123", "20240-1-01", "2024-01-0\u0661", "abcd-ef-g1", "2024-01-05 10:00", "2024-1-5", "2024", "", None]
    value = F.col("t")
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        strict_date(value, T.StringType()).alias("now"),
        F.when(value.rlike(dates.DATE_PATTERN), value.try_cast("date")).alias("by_pattern"),
        F.coalesce(dates._plain(value), F.lit(False)).alias("plain"), "t").collect()
    assert [row.now for row in rows] == [row.by_pattern for row in rows]
    assert [row.t for row in rows if row.plain][0] == "2024-01-05" and sum(row.now is not None for row in rows) == 3
