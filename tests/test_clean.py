from __future__ import annotations

from datetime import date, datetime

import duckdb
from pyspark.sql import functions as F

from siltstone.checks.registry import ORACLES, QUERIES
from siltstone.functions import clean


def column(spark, values, kind, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", make(df).alias("o")).orderBy("i").collect()]


def test_clean_string(spark):
    got = column(spark, [" a ", "", "  ", "null", " N/A ", "na", "none", "Null", "\tx", None], "string",
                 lambda df: clean.clean_string(F.col("v")))
    assert got == ["a", None, None, None, None, None, "none", "Null", "\tx", None]


def test_text_to_long_strips(spark):
    got = column(spark, ["1,234", "u12", "12.5", "-5", "5-", "", None, "99999999999999999999"], "string",
                 lambda df: clean.to_long(df, "v"))
    assert got == [1234, 12, 125, -5, None, None, None, None]


def test_numbers_keep_their_value(spark):
    """A double is cast, so 12.0 is not read as 120 and 1.0E7 not as 107."""
    assert column(spark, [12.0, 12.5, 1.0e7, None], "double", lambda df: clean.to_long(df, "v")) == [
        12, 12, 10000000, None]
    assert column(spark, [1.0e7, 4.0e-4], "double", lambda df: clean.to_double(df, "v")) == [1.0e7, 4.0e-4]
    assert column(spark, [1.0e300], "double", lambda df: clean.to_long(df, "v")) == [None]


def test_int_overflow_is_null(spark):
    assert column(spark, ["3000000000", "7"], "string", lambda df: clean.to_int(df, "v")) == [None, 7]
    assert column(spark, [3000000000], "bigint", lambda df: clean.to_int(df, "v")) == [None]


def test_text_to_double(spark):
    assert column(spark, ["$9.99", "-1.5 USD", "1.2.3", "free"], "string",
                  lambda df: clean.to_double(df, "v")) == [9.99, -1.5, None, None]


def test_booleans(spark):
    words = ["TRUE", "1", "Yes", "false", "0", "NO", "t", "maybe", None]
    assert column(spark, words, "string", lambda df: clean.to_boolean(F.col("v"))) == [
        True, True, True, False, False, False, True, None, None]
    assert column(spark, words, "string", lambda df: clean.to_boolean(F.col("v"), strict=True)) == [
        True, True, True, False, False, False, None, None, None]
    assert column(spark, [True, False, None], "boolean", lambda df: clean.to_boolean(F.col("v"))) == [
        True, False, None]


def test_flags(spark):
    assert column(spark, ["1", "0", "true", "2", "x"], "string", lambda df: clean.flag_to_boolean(df, "v")) == [
        True, False, True, None, None]
    assert column(spark, [1, 0, 2], "int", lambda df: clean.flag_to_boolean(df, "v")) == [True, False, True]
    assert column(spark, [True, None], "boolean", lambda df: clean.flag_to_boolean(df, "v")) == [True, None]


def test_times(spark):
    day = datetime(2023, 11, 14, 22, 13, 20)
    assert column(spark, [1700000000, None, 10**17], "bigint", lambda df: clean.to_timestamp(df, "v")) == [
        day, None, None]
    assert column(spark, ["2023-11-14 22:13:20", "2023-11-14", "soon", ""], "string",
                  lambda df: clean.to_timestamp(df, "v")) == [day, datetime(2023, 11, 14), None, None]
    assert column(spark, ["1700000000", "1000", "soon", "2023-11-14"], "string",
                  lambda df: clean.to_timestamp(df, "v", text="epoch")) == [day, datetime(1970, 1, 1, 0, 16, 40), None, None]
    assert column(spark, ["1700000000", "x"], "string", lambda df: clean.epoch_to_timestamp(F.col("v"))) == [day, None]
    assert column(spark, ["2020-05-17", "2020-13-40", "soon"], "string", lambda df: clean.to_date(F.col("v"))) == [
        date(2020, 5, 17), None, None]


def test_html(spark):
    got = column(spark, ["<p>A&amp;B</p>\n<br/> c", "", "<p></p>", "a < b", None], "string",
                 lambda df: clean.clean_html(F.col("v")))
    assert got == ["A&amp;B c", "", "", "a < b", None]


def test_value_order_of_steps(spark):
    """Only spaces are trimmed, so an outer tab is left as a space."""
    assert column(spark, ["  Big\t RED ", "\tx"], "string", lambda df: clean.normalize_value(F.col("v"))) == [
        "big red", " x"]


def test_first_present(spark):
    df = spark.createDataFrame([(None, "b"), ("a", "b")], "x string, y string")
    assert [r.o for r in df.select(clean.first_present(df, ["gone", "x", "y"]).alias("o")).collect()] == ["b", "a"]
    assert [r.o for r in df.select(clean.first_present(df, ["gone"]).alias("o")).collect()] == [None, None]


def test_epochs_beyond_the_year_9999(spark):
    """Whatever a timestamp holds is a time; only what doesn't fit its microseconds is null."""
    got = column(spark, ["253402300800", "518400000000", "-69120000000", "9223372036855", "-9223372036855"], "string",
                 lambda df: F.date_format(clean.epoch_to_timestamp(F.col("v")), "y-MM-dd HH:mm:ss"))
    assert got == ["10000-01-01 00:00:00", "18397-06-11 00:00:00", "-221-09-04 00:00:00", None, None]


def test_clean_epoch_of_large_keys(spark, tmp_path):
    """The query equals its SQL where the keys lead to years of five digits."""
    file = str(tmp_path / "events.parquet")
    duckdb.sql("SELECT CAST(unnest([1, 9, 2932896, 2932897, 6000001]) AS BIGINT) AS event_id").write_parquet(file)
    want = duckdb.sql(ORACLES["clean_epoch"].replace("FROM events", f"FROM '{file}'")).fetchall()
    got = [tuple(r) for r in QUERIES["clean_epoch"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want) and dict(got)[2932897] == "10000-01-01 00:00:00"
