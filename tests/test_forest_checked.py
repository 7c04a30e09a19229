"""Forests on the first years: lines are written once and no later ones, and trees as columns need no function call for a row."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from txnflow.config import FOREST, FULL_FEATURES
from txnflow.operators.trees import with_forest_prediction
from txnflow.plans import queries, training
from txnflow.plans.sales import LINE_KEYS

START = dt.datetime(2001, 3, 1, 5)


@pytest.fixture
def tables(spark, tmp_path, monkeypatch):
    """Makes lines by days after START, null without time, and an order some days before; gives the labels of what is staged."""
    labels = []

    def make(days, order_before):
        at = lambda n: None if n is None else START + dt.timedelta(days=n)
        rows = [(at(n), float(i % 30 + 1), float(i % 7 + 1), ("medium", "high", "bulk")[i % 30 // 10], i) for i, n in enumerate(days)]
        lines = spark.createDataFrame(rows, "invoice_date TIMESTAMP_NTZ, quantity DOUBLE, price DOUBLE, quantity_category STRING, i BIGINT").select(
            "invoice_date", "quantity", "price", "quantity_category", (F.col("quantity") * F.col("price")).alias("total_amount"),
            *[F.lit(1).alias(c) for c in ("month", "day", "hour")], *[F.col("i").alias(k) for k in LINE_KEYS])
        spark.createDataFrame([(at(-order_before),)], "o_orderdate TIMESTAMP_NTZ").write.parquet(f"{tmp_path}/orders.parquet")
        monkeypatch.setattr(queries, "sales_lines", lambda spark, sf_dir: lines)
        for module in (queries, training):
            stage = module.stage
            monkeypatch.setattr(module, "stage", lambda df, label="stage", stage=stage: labels.append(label) or stage(df, label))
        return str(tmp_path), labels

    return make


@pytest.mark.parametrize("order_before,written", [(0, 1), (1, 1), (40, 2), (9000, 2)])
def test_lines_are_written_once_unless_the_first_orders_have_none(spark, tables, order_before, written):
    # Of each year 60 lines, its last at its very end; one more just after the third year, and lines without time.
    ends = [365 * k for k in range(1, 5)]
    days = [0, *[end - 6 * n for end in ends for n in range(60)], 1095 + 1 / 86_400, None, None]
    path, labels = tables(days, order_before)
    found = queries.QUERIES["train_forest_checked"](spark, path).collect()
    assert [(r.model, r.status, r.train_rows + r.test_rows) for r in found] == [
        (f"rf_model_window_{k}", "trained", n) for k, n in ((1, 61), (2, 121), (3, 181))]
    assert all(r.agrees for r in found) and labels == ["train-random_forest"] * written


def test_only_the_first_years_are_written(spark, tables):
    path, _ = tables([0, 100, 900, 1095, 1097, 3000], 0)
    rows, begin = queries._first_years(spark, path, 3)
    assert rows.count() == 4 and rows.select(begin).first()[0] == START
    assert not set(LINE_KEYS) & set(rows.columns)


def test_trees_as_columns(spark):
    n = F.col("id")
    rows = spark.range(3000).select(
        (n % 37).cast("double").alias("quantity"), (n % 11 / 4).alias("price"), (n % 37 * (n % 11) / 4).alias("total_amount"),
        (n % 12).cast("double").alias("month"), (n % 28).cast("double").alias("day"), (n % 24).cast("double").alias("hour"),
        F.when(n % 37 < 5, "medium").when((n % 37 < 20) | (n % 13 == 0), "high").otherwise("bulk").alias("quantity_category"),
        F.when(n % 5 == 0, "test").otherwise("train").alias("split"))
    model = training.fit(rows, FOREST, "m", measured=False).model
    odd = rows.unionByName(rows.withColumn("price", F.lit(float("nan")))).unionByName(rows.withColumn("quantity", F.lit(float("-inf"))))
    both = with_forest_prediction(model.transform(odd), model.stages[-1], FULL_FEATURES, "own")
    assert "lambda" not in both._jdf.queryExecution().optimizedPlan().toString()
    counted = both.agg(F.count(F.lit(1)), F.count_if(~F.col("own").eqNullSafe(F.col("prediction"))), F.count_distinct("own")).first()
    assert tuple(counted)[:2] == (9000, 0) and counted[2] > 1
