"""Hand-worked cases of lenient coercion."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from feedweave.functions import coerce as c
from feedweave.functions.keys import availability_rank, match_key, row_key
from feedweave.functions.paths import directory, extension, file_name, without_login


def one(spark, text, expression):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(expression(F.col("t")).alias("v")).first()["v"]


def test_trim_blanks(spark):
    assert one(spark, "\t a b\n\x0b\0", c.trim_blanks) == "a b"
    assert one(spark, None, c.trim_blanks) == ""


@pytest.mark.parametrize("text, expected", [
    ("12.7", 12), ("abc", 0), ("", 0), (None, 0), ("-4x", -4), (" +5 ", 5), ("1e3", 1),
    ("9999999999", 2147483647), ("-9999999999", -2147483648), ("9" * 400, 2147483647),
])
def test_lenient_int(spark, text, expected):
    assert one(spark, text, c.lenient_int) == expected


@pytest.mark.parametrize("text, expected", [
    ("12,5", 12.5), ("1.234,56", 1.234), ("7 EUR", 7.0), ("-3.", -3.0), ("1e2", 100.0), ("abc", 0.0), ("", 0.0), (".5", 0.5),
])
def test_lenient_float(spark, text, expected):
    assert one(spark, text, c.lenient_float) == expected


def test_decimal_comma_drops_thousands_points(spark):
    assert one(spark, "1.234,56", lambda t: c.lenient_float(t, decimal_comma=True)) == 1234.56
    assert one(spark, "1234.56", lambda t: c.lenient_float(t, decimal_comma=True)) == 1234.56


@pytest.mark.parametrize("text, expected", [
    ("05/03/14", date(2014, 3, 5)), ("05/03/2014", date(2014, 3, 5)), ("5/3/2014", date(2014, 3, 5)),
    ("05-03-2014", date(2014, 3, 5)), ("2014-03-05", date(2014, 3, 5)), ("2014-03-05 10:11:12", date(2014, 3, 5)),
    ("", date(1970, 1, 1)), ("junk", date(1970, 1, 1)), (None, date(1970, 1, 1)), ("2014", date(1970, 1, 1)),
    ("2014-13-01", date(1970, 1, 1)), ("31/02/2014", date(2014, 3, 3)), ("31/04/2014", date(2014, 5, 1)),
    ("32/01/2014", date(1970, 1, 1)),
])
def test_lenient_date(spark, text, expected):
    assert one(spark, text, c.lenient_date) == expected


def test_bad_date_may_be_null(spark):
    assert one(spark, "junk", lambda t: c.lenient_date(t, "null")) is None
    with pytest.raises(ValueError):
        c.lenient_date(F.lit("x"), "zero")


def test_round_money_and_clamp(spark):
    assert one(spark, "12.345", c.round_money) == Decimal("12.35")
    assert one(spark, "1e30", c.round_money) == Decimal("9999999999.99")
    assert one(spark, "3000000000", c.clamp_int) == 2147483647
    assert one(spark, None, c.clamp_int) is None and one(spark, None, c.round_money) is None


def test_cut_and_pound(spark):
    assert one(spark, "abcdef", lambda t: c.cut(t, 4)) == "abcd"
    assert one(spark, "££x£", c.strip_pound) == "£x£"


def test_null_to_zero(spark):
    for kind, expected in ((T.StringType(), ""), (T.IntegerType(), 0), (T.DecimalType(12, 2), Decimal("0.00")), (T.DateType(), None)):
        assert one(spark, None, lambda t, k=kind: c.null_to_zero(t.cast(k), k)) == expected


def test_keys(spark):
    df = spark.createDataFrame([(None, "x", 0), ("m", "x", 3), ("M ", None, None)], "m string, p string, a int")
    rows = df.select(row_key(F.col("m"), F.col("p")).alias("k"), availability_rank(F.col("a")).alias("r"), match_key(F.col("m"), "ci").alias("ci")).collect()
    assert [tuple(r) for r in rows] == [("x", 0, None), ("m|||x", 1, "m"), ("M ", 0, "m")]
    with pytest.raises(ValueError):
        match_key(F.col("m"), "other")


def test_paths(spark):
    assert one(spark, "/a/b/list.csv.gz", file_name) == "list.csv.gz"
    assert one(spark, "/a/b/list.csv.gz", extension) == "gz"
    assert one(spark, "/a/b/list", extension) == "list"
    assert one(spark, "/a/b/list.csv", directory) == "/a/b"
    assert one(spark, "list.csv", directory) == ""
    assert one(spark, "http://u:p@host/x?y=a@b", without_login) == "host/x?y=a@b"
    assert one(spark, "http://host/x@y", without_login) == "http://host/x@y"
