"""Model metrics as aggregates: one pass where the evaluators take one per metric."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnflow.operators.numbering import before_each_task, in_order


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Rows, RMSE and R2 in a single aggregate; R2 is null where the label is constant."""
    residual = F.col(label) - F.col(prediction)
    squared = F.sum(residual * residual)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sqrt(F.try_divide(squared, F.count(F.lit(1)))).alias("rmse"),
        (F.lit(1.0) - F.try_divide(squared, F.var_pop(label) * F.count(F.lit(1)))).alias("r2"),
    )


def confusion(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def multiclass_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Rows, accuracy and support-weighted F1 from the confusion counts."""
    zero, rows = F.lit(0).cast("bigint"), F.col("rows")
    hit = F.when(F.col("label") == F.col("predicted"), rows).otherwise(zero)
    as_label = F.struct(F.col("label").alias("class"), rows.alias("support"), hit.alias("hits"), zero.alias("calls"))
    as_call = F.struct(F.col("predicted").alias("class"), zero.alias("support"), zero.alias("hits"), rows.alias("calls"))
    per_class = (
        confusion(df, label, prediction)
        .select(F.inline(F.array(as_label, as_call)))
        .groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("hits").alias("hits"), F.sum("calls").alias("calls"))
    )
    f1 = F.lit(2.0) * F.col("hits") / (F.col("support") + F.col("calls"))
    return per_class.agg(
        F.sum("support").alias("rows"),
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        (F.sum(F.col("support") * f1) / F.sum("support")).alias("f1"),
    )


def area_under_roc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve, ties counted half, of a 0/1 label.

    Equal scores collapse first. Distinct scores are range-sorted, and the negatives
    below each one are a running total inside a task plus that of the tasks before,
    so no task sees more than its range. One class only gives null.
    """
    by_score = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
    )
    placed = in_order(by_score, ["score"], unique=True)
    starts = before_each_task(placed, _negatives_before=F.sum("negatives"))
    inside = Window.partitionBy("_task").orderBy("_position").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("negatives").over(inside), F.lit(0)) + F.col("_negatives_before")
    ranked = placed.join(F.broadcast(starts), "_task").withColumn("_below", below)
    positives = F.sum("positives").cast("double")
    negatives = F.sum("negatives").cast("double")
    wins = F.sum(F.col("positives") * (F.col("_below") + F.col("negatives") / F.lit(2.0)))
    return ranked.agg(
        F.sum("positives").alias("positives"),
        F.sum("negatives").alias("negatives"),
        F.try_divide(wins, positives * negatives).alias("area_under_roc"),
    )
