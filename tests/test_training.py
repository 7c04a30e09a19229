import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnflow.config import FOREST, LINEAR, LOGISTIC, Settings
from txnflow.plans import training
from txnflow.sources.registry import load_model, score_with_model


@pytest.fixture(scope="module")
def lines(spark):
    rng = random.Random(7)
    start = dt.datetime(2025, 5, 29, 14)
    rows = []
    for i in range(1500):
        q, p = float(rng.randint(1, 40)), round(rng.uniform(1, 20), 2)
        amount = 3.0 * q + 2.0 * p + rng.choice([5, 7])
        band = "medium" if q < 5 else "high" if q < 20 else "bulk"
        rows.append((i, start + dt.timedelta(seconds=i), q, p, amount, rng.randint(1, 12), rng.randint(1, 28),
                     rng.randint(0, 23), band, int(amount + rng.uniform(-20, 20) > 100), i // 500))
    return spark.createDataFrame(
        rows,
        "id INT, timestamp TIMESTAMP, quantity DOUBLE, price DOUBLE, total_amount DOUBLE, month INT, day INT, "
        "hour INT, quantity_category STRING, high_value_customer INT, batch_id BIGINT",
    ).repartition(4)


def test_linear_scenarios(spark, lines, tmp_path):
    results = training.train_incremental(lines, str(tmp_path), "timestamp", split_keys=["id"])
    assert [r.name for r in results] == ["linear_model_1", "linear_model_2", "linear_model_3"]
    assert [r.train_rows + r.test_rows for r in results] == [500, 1000, 1500]
    assert all(r.status == training.TRAINED and r.metrics["r2"] > 0.99 for r in results)
    scored = score_with_model(lines, load_model(str(tmp_path), "amount", 3))
    assert scored.columns == [*lines.columns, "prediction"]

    rows = lines.toPandas()
    train = training.with_split(lines, ["id"]).where("split = 'train'").toPandas()
    x = lambda df: np.column_stack([df[list(LINEAR.features)].to_numpy(float), np.ones(len(df))])
    weights, *_ = np.linalg.lstsq(x(train), train.total_amount.to_numpy(), rcond=None)
    expected = dict(zip(rows.id, x(rows) @ weights))
    found = {r.id: r.prediction for r in scored.collect()}
    assert max(abs(found[i] - expected[i]) for i in expected) < 1e-6


def test_forest_windows(lines, tmp_path):
    results = training.train_time_windows(lines, str(tmp_path), split_keys=["id"])
    assert [r.name for r in results] == [f"rf_model_window_{k}" for k in (1, 2, 3)]
    assert [r.train_rows + r.test_rows for r in results] == [301, 601, 901]
    assert all(r.metrics["accuracy"] > 0.9 and r.metrics["f1"] > 0.9 for r in results)


def test_forest_on_the_first_batch(lines):
    result = training.train_first_batch(lines)
    assert result.status == training.TRAINED and result.train_rows + result.test_rows == 500
    # The bound of the sample is met by a hash of the rows, so about.
    sampled = training.train_first_batch(lines, settings=Settings(max_fit_rows=300))
    assert sampled.status == training.TRAINED and 240 <= sampled.train_rows + sampled.test_rows <= 360


def test_scoring_keeps_every_row(spark, lines, tmp_path):
    training.train_time_windows(lines, str(tmp_path), split_keys=["id"])
    training.train_incremental(lines, str(tmp_path), "timestamp", split_keys=["id"])
    odd = lines.withColumn("price", F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(float("nan"))).otherwise(F.col("price")))
    for family in ("amount", "category"):
        scored = score_with_model(odd, load_model(str(tmp_path), family, 1), reason=True)
        rows = scored.collect()
        assert len(rows) == 1500
        assert all((r.prediction is None) == (r.prediction_error is not None) == (r.id % 3 == 1) for r in rows)
        if family == "category":
            known = {r.quantity_category for r in lines.select("quantity_category").distinct().collect()}
            assert {r.predicted_label for r in rows if r.id % 3 != 1} <= known and rows[0].quantity_category is not None


@pytest.mark.parametrize("cumulative,sizes", [(True, [500, 1000, 1500]), (False, [500, 500, 500])])
def test_logistic_batches(spark, lines, tmp_path, cumulative, sizes):
    results = training.train_batches(lines, str(tmp_path), cumulative, after_batch=4, split_keys=["id"])
    assert [r.name for r in results] == [f"logistic_model_batch_{k}" for k in (1, 2, 3)]
    assert [r.train_rows + r.test_rows for r in results] == sizes
    assert all(0.8 < r.metrics["area_under_roc"] <= 1 for r in results)
    assert load_model(str(tmp_path), "high_value", 2, 4) is not None
    table = training.results_frame(spark, results)
    assert table.where("metrics['area_under_roc'] > 0.8").count() == 3


def test_skips(lines):
    one_class = training.training_rows(lines.withColumn("high_value_customer", F.lit(0)), LOGISTIC)
    result = training.fit(one_class, LOGISTIC, "m")
    assert (result.status, result.reason) == (training.SKIPPED, "target has one class only")
    few = training.training_rows(lines.limit(9), FOREST)
    assert training.fit(few, FOREST, "m").reason == "fewer than 10 rows"
    none = training.training_rows(lines.where("false"), LINEAR)
    assert training.fit(none, LINEAR, "m").reason == "no rows"


def test_errors_surface(lines):
    with pytest.raises(ValueError, match="target column missing"):
        training.training_rows(lines.drop("total_amount"), LINEAR)
    strange = training.training_rows(lines.withColumn("high_value_customer", F.lit(2)), LOGISTIC)
    with pytest.raises(ValueError, match="other than 0 and 1"):
        training.fit(strange, LOGISTIC, "m")


def test_absent_and_null_features(lines):
    gaps = lines.drop("hour").withColumn("price", F.when(F.col("id") % 3 > 0, F.col("price")))
    rows = training.training_rows(gaps, LINEAR)
    assert rows.columns == ["total_amount", "quantity", "price", "month", "day", "split"]
    assert training.fit(rows, LINEAR, "m").status == training.TRAINED
