"""Passes over all values that serve several ranks."""

from fractions import Fraction

from pyspark.sql import functions as F

from txnflow.operators import quantiles


def test_ranks_share_the_passes_over_all_values(spark, monkeypatch):
    ranges = []
    narrow = quantiles._narrow
    monkeypatch.setattr(quantiles, "_narrow", lambda values, kind, span, ranks, accuracy: (
        ranges.append((span.rows, len(ranks))), narrow(values, kind, span, ranks, accuracy))[1])
    values = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"))
    cuts = quantiles.quantiles_disc(values, "v", [Fraction(1, 3), Fraction(2, 3)], small=10, accuracy=100)
    assert list(spark.range(1).select(*cuts).first()) == [333, 666]
    assert [n for rows, n in ranges if rows == 1000] == [2]
