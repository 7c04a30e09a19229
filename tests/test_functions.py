import datetime as dt
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from txnflow.functions.bands import quantity_band
from txnflow.functions.keys import message_key, unit_hash
from txnflow.functions.numbers import clamp, parse_double, sigmoid
from txnflow.functions.text import blanks_to_null, is_cancelled, normalise_header, normalise_name, unquote_nan
from txnflow.functions.times import iso_text, parse_time


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, x {kind}")
    return [r.y for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_number_texts(spark):
    texts = ["12", " 12 ", "1e3", "1.5", "-2", "inf", "1.0d", "1.0f", "2D", "0x1p3", "1_000", "abc", "", None]
    expected = [12.0, 12.0, 1000.0, 1.5, -2.0, math.inf, None, None, None, None, None, None, None, None]
    assert column(spark, texts, "STRING", parse_double) == expected
    assert math.isnan(column(spark, ["NaN"], "STRING", parse_double)[0])


def test_bands_are_left_closed(spark):
    values = [0.5, 0.999, 1.0, 4.9, 5.0, 19.99, 20.0, 1e9, math.inf, math.nan, None]
    assert column(spark, values, "DOUBLE", quantity_band) == [
        "low", "low", "medium", "medium", "high", "high", "bulk", "bulk", "unknown", "unknown", "unknown",
    ]


def test_times(spark):
    formats = ("M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy")
    texts = ["2009-12-01 07:45:00", "2009-12-01T07:45:00", "12/1/2009 7:45", "01/02/2010 10:00", "1/2/2010", "bad", None]
    assert column(spark, texts, "STRING", lambda c: parse_time(c, formats)) == [
        dt.datetime(2009, 12, 1, 7, 45), dt.datetime(2009, 12, 1, 7, 45), dt.datetime(2009, 12, 1, 7, 45),
        dt.datetime(2010, 1, 2, 10), dt.datetime(2010, 1, 2), None, None,
    ]
    whole = column(spark, ["2009-12-01 07:45:00"], "STRING", lambda c: iso_text(c.cast("timestamp_ntz")))
    assert whole == ["2009-12-01T07:45:00"]


def test_cancelled(spark):
    texts = ["C123", "c123", "123C", None]
    assert column(spark, texts, "STRING", is_cancelled) == [True, True, False, False]
    assert column(spark, texts, "STRING", lambda c: is_cancelled(c, False)) == [False, True, False, False]


def test_missing_texts(spark):
    df = spark.createDataFrame([("NA", 1), ("", 2), (" NA ", 3), ("x", 4)], "a STRING, n INT")
    assert [r.a for r in blanks_to_null(df).orderBy("n").collect()] == [None, None, " NA ", "x"]
    assert column(spark, ["NaN", '"NaN"', "Nancy"], "STRING", unquote_nan) == [None, None, "Nancy"]


def test_header_names(spark):
    assert normalise_name("Customer ID") == "customer_id"
    df = spark.createDataFrame([(1, 2)], "`Stock-Code` INT, `InvoiceDate` INT")
    assert normalise_header(df).columns == ["stock_code", "invoicedate"]


def test_clamp_and_sigmoid(spark):
    assert column(spark, [-1.0, 0.5, 2.0], "DOUBLE", lambda c: clamp(c, 0.05, 0.95)) == [0.05, 0.5, 0.95]
    assert column(spark, [0.0, 1.3], "DOUBLE", sigmoid) == pytest.approx([0.5, 1 / (1 + math.exp(-1.3))])


def test_portable_hash_is_md5(spark):
    df = spark.createDataFrame([(7, "a")], "k INT, s STRING")
    digest = hashlib.md5(b"42|7|a").hexdigest()[:8]
    assert df.select(unit_hash(["k", "s"], 42, True)).first()[0] == int(digest, 16) / 2**32
    assert 0 <= df.select(unit_hash(["k", "s"], 42)).first()[0] < 1


def test_message_key(spark):
    df = spark.createDataFrame([("5",), ("",), (None,)], "customer_id STRING").coalesce(1)
    keys = [r[0] for r in df.select(message_key(df)).collect()]
    assert keys[0] == "5" and keys[1] != keys[2] and None not in keys
    assert df.drop("customer_id").select(message_key(df.drop("customer_id"))).count() == 3
