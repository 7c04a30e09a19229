"""Known models: their names, kinds and saved pipelines."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Name stem and kind of each model family, versions 1 to 3 of each.
FAMILIES = {
    "amount": ("linear_model", "regression"),
    "category": ("rf_model_window", "classification"),
    "high_value": ("logistic_model_batch", "binary_classification"),
}
VERSIONS = (1, 2, 3)


def model_name(family: str, version: int) -> str:
    if family not in FAMILIES or version not in VERSIONS:
        raise ValueError(f"unknown model: {family} version {version}")
    return f"{FAMILIES[family][0]}_{version}"


MODEL_NAMES = tuple(model_name(family, v) for family in FAMILIES for v in VERSIONS)


def registry(spark: SparkSession) -> DataFrame:
    """One row per known model."""
    return spark.createDataFrame(
        [(model_name(f, v), kind, v) for f, (_, kind) in FAMILIES.items() for v in VERSIONS],
        "model STRING, type STRING, version INT",
    )


def model_path(model_dir: str, family: str, version: int, batch_id: int | None = None) -> str:
    """Folder of a saved model; retraining after a batch gets a folder of its own."""
    base = f"{model_dir.rstrip('/')}/{model_name(family, version)}"
    return base if batch_id is None else f"{base}/batch_id={batch_id}"


def load_model(model_dir: str, family: str, version: int, batch_id: int | None = None) -> PipelineModel:
    return PipelineModel.load(model_path(model_dir, family, version, batch_id))


def score_with_model(df: DataFrame, model: PipelineModel, reason: bool = False) -> DataFrame:
    """Score a batch or streaming frame: every row comes back, with ``prediction`` columns added.

    Missing features count as 0.0, as in training. A row with a feature that is not a number is answered with
    null predictions and, with ``reason``, a ``prediction_error``. Models of the quantity band also give it as text.
    """
    stages = list(model.stages)
    inputs = sorted({c for s in stages if isinstance(s, VectorAssembler) for c in s.getInputCols() if c in df.columns})
    own = [F.col(f"`{c}`") for c in df.columns]
    value = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in inputs}
    bad = F.lit(False)
    for column in value.values():
        bad = bad | F.isnan(column)
    # The features are replaced only inside; the columns of the frame are handed through as they were.
    ready = df.select(F.struct(*own).alias("_row"), bad.alias("_bad"), *[F.when(F.isnan(v), 0.0).otherwise(v).alias(c) for c, v in value.items()])
    labels = next((s.labels for s in stages if isinstance(s, StringIndexerModel)), None)
    scored = PipelineModel([s for s in stages if not isinstance(s, StringIndexerModel)]).transform(ready)
    wanted = [c for c in ("prediction", "probability") if c in scored.columns]
    answered = [F.when(~F.col("_bad"), F.col(c)).alias(c) for c in wanted]
    if labels:
        known = F.element_at(F.lit(list(labels)), F.col("prediction").cast("int") + 1)
        answered.append(F.when(~F.col("_bad") & (F.col("prediction") < len(labels)), known).alias("predicted_label"))
    if reason:
        answered.append(F.when(F.col("_bad"), F.lit("a feature is not a number")).alias("prediction_error"))
    return scored.select("_row.*", *answered)
