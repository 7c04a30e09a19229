"""What a training leaves out."""

from pyspark.sql import functions as F

from txnflow.plans import training


def test_fit_without_measures(spark):
    rows = spark.range(100).select(
        F.col("id").cast("double").alias("quantity"), (F.col("id") * 2).cast("double").alias("total_amount"),
        F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split"))
    result = training.fit(rows, training.LINEAR, "m", measured=False)
    assert (result.status, result.train_rows, result.test_rows, result.metrics) == ("trained", 80, 20, {})
