"""Training: prepare, split, fit, save, evaluate; and the three training schemes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.config import DEFAULTS, FOREST, LINEAR, LOGISTIC, Settings, TrainingScheme
from txnflow.operators.features import prepare, present, target_values
from txnflow.operators.label import high_value_customers, label_lines
from txnflow.operators.metrics import area_under_roc, multiclass_metrics, regression_metrics
from txnflow.operators.selection import (
    batch_ids, first_batch_minimal, first_folds, first_windows, with_fold, with_window,
)
from txnflow.operators.split import TEST, TRAIN, with_split
from txnflow.schema import RECORD
from txnflow.session import stage, temporary_stages
from txnflow.sources.catalog import list_batches
from txnflow.sources.files import read_batches, read_record_files
from txnflow.sources.ledger import first_copies, record_missing, recorded_customers, recorded_ids, recorded_lines, window_ids
from txnflow.sources.registry import VERSIONS, model_path

TRAINED, SKIPPED = "trained", "skipped"


@dataclass
class TrainResult:
    """Outcome of one training: the model when there is one, and what was measured."""

    name: str
    status: str
    reason: str | None = None
    model: PipelineModel | None = None
    train_rows: int = 0
    test_rows: int = 0
    metrics: dict[str, float | None] = field(default_factory=dict)


def pipeline_for(scheme: TrainingScheme, features: Sequence[str], seed: int = DEFAULTS.seed) -> Pipeline:
    """Stages of one model family on the given features."""
    if scheme.family == FOREST.family:
        return Pipeline(stages=[
            VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"),
            StringIndexer(inputCol=scheme.target, outputCol="label", handleInvalid="keep"),
            RandomForestClassifier(
                featuresCol="features", labelCol="label", numTrees=10, maxDepth=5, seed=seed
            ),
        ])
    estimator = LinearRegression if scheme.family == LINEAR.family else LogisticRegression
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="unscaled_features", handleInvalid="skip"),
        StandardScaler(inputCol="unscaled_features", outputCol="features"),
        estimator(featuresCol="features", labelCol=scheme.target),
    ])


def without_summaries(model: PipelineModel) -> PipelineModel:
    """The model without the training summaries of its stages: they hold the session, which can't be sent to tasks once it has observed metrics."""
    for fitted in model.stages:
        if getattr(fitted, "hasSummary", False):
            fitted._java_obj.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())
    return model


def evaluate(scheme: TrainingScheme, predictions: DataFrame) -> dict[str, float | None]:
    """RMSE and R2, accuracy and F1, or area under ROC, by family."""
    if scheme.family == LINEAR.family:
        row = regression_metrics(predictions, scheme.target).first()
        return {"rmse": row.rmse, "r2": row.r2}
    if scheme.family == FOREST.family:
        row = multiclass_metrics(predictions, "label").first()
        return {"accuracy": row.accuracy, "f1": row.f1}
    scored = predictions.select(
        scheme.target, vector_to_array("rawPrediction")[1].alias("raw")
    )
    return {"area_under_roc": area_under_roc(scored, scheme.target, "raw").first().area_under_roc}


def training_rows(df: DataFrame, scheme: TrainingScheme, settings: Settings = DEFAULTS,
                  split_keys: Sequence[str] | None = None, carry: Sequence[str] = (),
                  portable_split: bool = False) -> DataFrame:
    """Prepared and split rows, written once.

    Fitting reads its input many times. The staged table holds the target, the
    features and ``split``, so each pass is a narrow parquet scan.
    """
    split = with_split(df, split_keys, settings.train_fraction, settings.seed, portable_split)
    rows = prepare(split, scheme.target, scheme.features, ["split", *carry])
    return stage(rows, f"train-{scheme.family}")


def fit(rows: DataFrame, scheme: TrainingScheme, name: str, path: str | None = None,
        settings: Settings = DEFAULTS, measured: bool = True) -> TrainResult:
    """Fit on the train split of prepared rows, save, and evaluate on the test split unless ``measured`` is false.

    Too few rows, an empty train split or, for the binary target, a single class give a
    ``skipped`` result. Real failures are raised.
    """
    usable = present(rows, scheme.features)
    counted = {r["split"]: r["n"] for r in rows.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    result = TrainResult(name, SKIPPED, train_rows=counted.get(TRAIN, 0), test_rows=counted.get(TEST, 0))
    total = result.train_rows + result.test_rows
    if total == 0:
        result.reason = "no rows"
    elif scheme.family == FOREST.family and total < settings.minimum_rows:
        result.reason = f"fewer than {settings.minimum_rows} rows"
    elif result.train_rows == 0:
        result.reason = "train split is empty"
    if result.reason:
        return result

    train = rows.where(F.col("split") == TRAIN)
    if scheme.family == LOGISTIC.family:
        values = target_values(train, scheme.target).first()
        if not values.is_binary:
            raise ValueError(f"{scheme.target} has {values.other} values other than 0 and 1")
        if not values.zeros or not values.ones:
            result.reason = "target has one class only"
            return result

    result.model = without_summaries(pipeline_for(scheme, usable, settings.seed).fit(train))
    result.status = TRAINED
    if path:
        result.model.write().overwrite().save(path)
    if measured and result.test_rows:
        result.metrics = evaluate(scheme, result.model.transform(rows.where(F.col("split") == TEST)))
    return result


def results_frame(spark: SparkSession, results: Sequence[TrainResult]) -> DataFrame:
    """Results as a table, one row per model."""
    return spark.createDataFrame(
        [
            (r.name, r.status, r.reason, r.train_rows, r.test_rows,
             {k: v for k, v in r.metrics.items() if v is not None})
            for r in results
        ],
        "model STRING, status STRING, reason STRING, train_rows BIGINT, test_rows BIGINT, "
        "metrics MAP<STRING, DOUBLE>",
    )


def _path(model_dir: str | None, family: str, version: int, after_batch: int | None) -> str | None:
    return model_path(model_dir, family, version, after_batch) if model_dir else None


def train_incremental(lines: DataFrame, model_dir: str | None = None, time: str = "invoice_date",
                      settings: Settings = DEFAULTS, after_batch: int | None = None,
                      **options) -> list[TrainResult]:
    """Linear models on the first third, two thirds and all of the lines in time order."""
    rows = with_fold(training_rows(lines, LINEAR, settings, carry=[time], **options), time)
    return [
        fit(first_folds(rows, k), LINEAR, f"linear_model_{k}",
            _path(model_dir, "amount", k, after_batch), settings)
        for k in (1, 2, 3)
    ]


def train_files(spark: SparkSession, paths: Sequence[str], model_dir: str | None = None, settings: Settings = DEFAULTS,
                after_batch: int | None = None, multi_line: bool = True, **options) -> list[TrainResult]:
    """Linear models on the distinct rows of the first listed record file, the first two, and so on.

    A row that several files hold counts once, with the first of them; so all selections come out of one prepared table.
    """
    lines = read_record_files(spark, paths, multi_line=multi_line, number="fold")
    if lines is None:
        return []
    once = lines.groupBy(*RECORD.names).agg(F.min("fold").alias("fold"))
    rows = training_rows(once, LINEAR, settings, carry=["fold"], **options)
    return [
        fit(first_folds(rows, k), LINEAR, f"linear_model_{k}",
            _path(model_dir, "amount", k, after_batch) if k in VERSIONS else None, settings)
        for k in range(1, len(paths) + 1)
    ]


def train_time_windows(lines: DataFrame, model_dir: str | None = None, time: str = "timestamp",
                       settings: Settings = DEFAULTS, after_batch: int | None = None,
                       **options) -> list[TrainResult]:
    """Forests on the first 5, 10 and 15 minutes (by ``window_minutes``) of the lines."""
    # Only what the three windows hold is split and staged.
    wanted = first_windows(with_window(lines, time, settings.window_minutes), 3)
    rows = training_rows(wanted, FOREST, settings, carry=["window"], **options)
    return [
        fit(first_windows(rows, k), FOREST, f"rf_model_window_{k}",
            _path(model_dir, "category", k, after_batch), settings)
        for k in (1, 2, 3)
    ]


def train_first_batch(batches: DataFrame, model_dir: str | None = None, settings: Settings = DEFAULTS,
                      after_batch: int | None = None, **options) -> TrainResult:
    """Minimal mode: one forest on the first batch; of a larger one, on about ``max_fit_rows`` rows chosen by a hash."""
    first = first_batch_minimal(batches)
    share = min(1.0, settings.max_fit_rows / max(1, first.count()))
    chosen = F.pmod(F.xxhash64(*first.columns), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    rows = training_rows(first.where(chosen), FOREST, settings, **options)
    return fit(rows, FOREST, "rf_model_window_1", _path(model_dir, "category", 1, after_batch), settings)


def train_batches(batches: DataFrame, model_dir: str | None = None, cumulative: bool = True,
                  settings: Settings = DEFAULTS, after_batch: int | None = None,
                  ids: Sequence[int] | None = None, **options) -> list[TrainResult]:
    """Logistic models on the first one, two and three batches, or on each of them alone.

    ``ids`` in order, as a catalog of saved batches has them, saves looking for them in the rows.
    """
    ids = batch_ids(batches, 3) if ids is None else list(ids)[:3]
    chosen = batches.where(F.col("batch_id").isin(ids))
    rows = training_rows(chosen, LOGISTIC, settings, carry=["batch_id"], **options)
    return [
        fit(rows.where(F.col("batch_id").isin(ids[:k] if cumulative else ids[k - 1:k])), LOGISTIC,
            f"logistic_model_batch_{k}", _path(model_dir, "high_value", k, after_batch), settings)
        for k in range(1, len(ids) + 1)
    ]


def retrain(spark: SparkSession, batch_root: str, model_dir: str, batch_id: int | None = None,
            settings: Settings = DEFAULTS, schemes: Sequence[TrainingScheme] | None = None, ledger: str | None = None,
            minimal: bool = False, cumulative: bool = True) -> list[TrainResult]:
    """The models of the schemes (all nine) from the saved batches; a callback for each saved batch.

    Models of a run go to folders of their batch id, so a later run never overwrites
    models in use. Copies of a record count once, in their first batch. The customer label is
    computed from the batches themselves.

    With a ``ledger`` folder, new batches are entered there first. The label then comes from its spend tables, the time windows
    and the first batches open only the folders that can hold their rows, and nothing but the linear models, which learn from all lines, reads
    the whole history. ``minimal`` trains one forest on the first batch alone; ``cumulative=False`` takes each of the first batches alone.
    """
    if ledger is not None:
        record_missing(spark, batch_root, ledger, settings)
        ids = recorded_ids(spark, ledger)
    else:
        ids = [r.batch_id for r in list_batches(spark, batch_root).select("batch_id").orderBy("batch_id").collect()]

    with temporary_stages(spark):
        lines = None if ledger else stage(first_copies(read_batches(spark, batch_root, settings.batch_format)), "saved")
        customers = recorded_customers(spark, ledger) if ledger else high_value_customers(lines)

        def labelled(wanted: Sequence[int]) -> DataFrame:
            rows = recorded_lines(spark, batch_root, wanted, settings) if ledger else lines
            return label_lines(stage(rows, "wanted") if ledger else rows, customers)

        def forest() -> list[TrainResult]:
            if minimal:
                return [train_first_batch(labelled(ids[:1]), model_dir, settings, batch_id)] if ids else []
            wanted = window_ids(spark, ledger, 3 * settings.window_minutes) if ledger else ids
            return train_time_windows(labelled(wanted), model_dir, "timestamp", settings, batch_id)

        runs = {
            LINEAR: lambda: train_incremental(labelled(ids), model_dir, "timestamp", settings, batch_id),
            FOREST: forest,
            LOGISTIC: lambda: train_batches(
                labelled(ids[:3]), model_dir, cumulative, settings=settings, after_batch=batch_id, ids=ids[:3]
            ),
        }
        return [result for scheme in schemes or settings.schemes for result in runs[scheme]()]
