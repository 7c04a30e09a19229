"""Feature scaling, label index and least squares, as MLlib stages with readable output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scale_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add ``scaled_<feature>``: each feature over its sample deviation, not centred."""
    assembled = VectorAssembler(
        inputCols=list(features), outputCol="_vector", handleInvalid="skip"
    ).transform(df)
    scaled = StandardScaler(inputCol="_vector", outputCol="_scaled").fit(assembled).transform(assembled)
    parts = vector_to_array("_scaled")
    return scaled.select(*df.columns, *[parts[i].alias(f"scaled_{f}") for i, f in enumerate(features)])


def label_index(df: DataFrame, column: str) -> DataFrame:
    """Add ``label``: 0 for the most frequent value, ties in text order, unknowns last."""
    indexer = StringIndexer(inputCol=column, outputCol="label", handleInvalid="keep")
    return indexer.fit(df).transform(df)


def least_squares_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope, intercept and R2 of y on one feature, in one aggregate."""
    return df.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    )
