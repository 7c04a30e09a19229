import datetime as dt

from pyspark.sql import functions as F

from txnflow.config import Settings
from txnflow.operators import quality
from txnflow.operators.clean import clean
from txnflow.schema import CLEAN, RAW, RECORD, cast_present, conform, conformance_report

GOOD = ("1", "s", "d", "2", "12/1/2009 7:45", "1.50", "9", "UK")


def raw(spark, *changes):
    rows = []
    for change in changes:
        row = dict(zip(RAW.names, GOOD))
        row.update(change)
        rows.append(tuple(row[n] for n in RAW.names))
    return spark.createDataFrame(rows, RAW)


def test_features(spark):
    row = clean(raw(spark, {})).first()
    assert (row.quantity, row.price, row.total_amount) == (2.0, 1.5, 3.0)
    assert (row.month, row.day, row.hour) == (12, 1, 7)
    assert row.invoice_date == dt.datetime(2009, 12, 1, 7, 45)
    assert (row.quantity_category, row.high_value_customer, row.stock_code) == ("medium", 0, "s")
    assert clean(raw(spark, {})).schema.simpleString() == CLEAN.simpleString()


def test_dropped_lines(spark):
    bad = [
        {"invoice": "C1"}, {"invoice": "c1"}, {"customer_id": None},
        {"quantity": None}, {"quantity": "n/a"}, {"quantity": "NaN"}, {"quantity": "0"}, {"quantity": "-3"},
        {"price": None}, {"price": "x"}, {"price": "nan"}, {"price": "0.00"},
    ]
    assert clean(raw(spark, *bad)).count() == 0
    reasons = {r.reason: r.lines for r in quality.reject_reasons(raw(spark, {}, *bad)).collect()}
    assert reasons == {
        "kept": 1, "cancelled": 2, "missing_customer": 1, "missing_number": 2, "not_a_number": 4,
        "quantity_not_positive": 2, "price_not_positive": 1,
    }


def test_kept_lines(spark):
    rows = clean(raw(spark, {"invoice": None}, {"invoicedate": "bad"}, {"invoicedate": None}, {"quantity": "inf"}))
    found = rows.collect()
    assert len(found) == 4
    assert found[0].invoice is None
    assert [(r.month, r.day, r.hour, r.invoice_date) for r in found[1:3]] == [(0, 0, 0, None)] * 2
    assert found[3].quantity_category == "unknown"


def test_one_bad_date_leaves_the_others(spark):
    months = [r.month for r in clean(raw(spark, {}, {"invoicedate": "bad"}, {})).collect()]
    assert months == [12, 0, 12]


def test_literal_case(spark):
    literal = Settings(ignore_invoice_case=False)
    assert clean(raw(spark, {"invoice": "C1"}, {"invoice": "c1"}), literal).count() == 1


def test_missing_columns(spark):
    empty = clean(raw(spark, {}).drop("price"))
    assert empty.count() == 0 and empty.columns == CLEAN.names
    without = clean(raw(spark, {}).drop("invoicedate", "country", "customer_id", "invoice")).first()
    assert (without.month, without.country, without.customer_id) == (0, None, None)


def test_typed_input(spark):
    typed = raw(spark, {}, {"quantity": "0"}).withColumn("quantity", F.col("quantity").cast("int"))
    assert [r.quantity for r in clean(typed).collect()] == [2.0]


def test_parse_reports(spark):
    df = raw(spark, {}, {"quantity": None}, {"quantity": "x"}, {"quantity": "NaN"}, {"invoicedate": "bad"})
    by_name = {r.column_name: r for r in quality.numeric_parse_report(df).collect()}
    q = by_name["quantity"]
    assert (q.missing, q.unreadable, q.nan, q.good) == (1, 1, 1, 2)
    times = quality.time_parse_report(df).first()
    assert (times.missing, times.unreadable, times.good) == (0, 1, 4)


def test_conform(spark):
    df = spark.createDataFrame([("5", "x", "12.0")], "quantity STRING, price STRING, month STRING")
    row = conform(df, RECORD).first()
    assert (row.quantity, row.price, row.month, row.country) == (5.0, None, 12, None)
    cast = cast_present(df.withColumn("extra", F.lit(1)), RECORD)
    assert cast.columns == ["quantity", "price", "month", "extra"] and cast.first().month == 12
    report = {r.column_name: r for r in conformance_report(df, RECORD).collect()}
    assert (report["price"].present, report["price"].bad_count) == (True, 1)
    assert (report["country"].present, report["country"].null_count) == (False, 1)
