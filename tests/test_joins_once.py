"""Queries that read the lines several times stage them, so that the joins behind them run once."""

import pytest
from pyspark.sql import functions as F

from txnflow.operators.clean import clean
from txnflow.plans import queries
from txnflow.plans.sales import LINE_KEYS


def lines(spark, sf_dir):
    i = F.col("id")
    raw = spark.range(60).select(
        i.cast("string").alias("invoice"), F.lit("s").alias("stockcode"), F.lit("d").alias("description"),
        (i % 30 + 1).cast("string").alias("quantity"), F.lit("2010-06-01 07:45:00").alias("invoicedate"), F.lit("1.50").alias("price"),
        (i % 9).cast("string").alias("customer_id"), F.lit("UK").alias("country"), *[i.alias(k) for k in LINE_KEYS])
    return clean(raw, keep=LINE_KEYS)


@pytest.mark.parametrize("name", ["scaled_features", "message_rejects"])
def test_result_reads_staged_rows_only(spark, monkeypatch, name):
    monkeypatch.setattr(queries, "sales_lines", lines)
    found = queries.QUERIES[name](spark, "")
    assert "Range (0, 60" not in found._jdf.queryExecution().optimizedPlan().toString() and found.count() > 0


def test_record_files_are_written_from_staged_rows(spark, monkeypatch):
    labels, stage = [], queries.stage
    monkeypatch.setattr(queries, "sales_lines", lines)
    monkeypatch.setattr(queries, "stage", lambda df, label="stage": labels.append(label) or stage(df, label))
    assert queries.QUERIES["record_files"](spark, "").count() == 60 and labels == ["wire"]
