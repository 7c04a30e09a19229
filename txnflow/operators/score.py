"""Rule scores for amount, quantity category and high-value customer.

Each family and version is a row of fixed values; one expression per family reads
them. Scores are projections, so they run on batch and streaming frames alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.config import AMOUNT_FEATURES, FULL_FEATURES
from txnflow.functions.numbers import clamp, sigmoid
from txnflow.functions.times import iso_text
from txnflow.operators.requests import UNREADABLE, read_requests, request_error, status_of
from txnflow.schema import REQUEST
from txnflow.sources.registry import VERSIONS, model_name

# Fixed values of the rule scores: months, hours and categories here, the rule tables and the fields used below.
PEAK_MONTHS = (11, 12)
OFFICE_HOURS = (9, 17)
CATEGORIES = ("Low", "Medium", "High", "Bulk")


@dataclass(frozen=True)
class AmountRule:
    confidence: float
    noise: float
    peak_factor: float | None = None
    hour_factors: tuple[float, float] | None = None  # inside, outside office hours


@dataclass(frozen=True)
class CategoryRule:
    quantity_limits: tuple[float, float, float]
    amount_limits: tuple[float, float, float] | None
    own_probability: tuple[float, float, float, float]  # also the confidence
    other_probability: tuple[float, float, float, float]
    peak_factor: float | None = None
    hour_factors: tuple[float, float] | None = None


@dataclass(frozen=True)
class HighValueRule:
    confidence: float
    threshold: float
    amount_scale: float
    quantity_weight: float | None = None
    peak_bonus: float | None = None
    hour_bonus: float | None = None


# Fixed values of the rules.
AMOUNT_RULES = {
    1: AmountRule(0.85, 0.10),
    2: AmountRule(0.91, 0.08, peak_factor=1.2),
    3: AmountRule(0.95, 0.05, peak_factor=1.3, hour_factors=(1.1, 0.9)),
}
CATEGORY_RULES = {
    1: CategoryRule((1, 5, 20), None, (0.75, 0.80, 0.85, 0.90), (0.2, 0.3, 0.3, 0.2)),
    2: CategoryRule((1, 5, 20), (10, 50, 200), (0.82, 0.87, 0.90, 0.93), (0.15, 0.25, 0.35, 0.25)),
    3: CategoryRule((1.2, 6, 24), (12, 60, 240), (0.89, 0.92, 0.95, 0.97), (0.1, 0.2, 0.4, 0.3),
                    peak_factor=1.2, hour_factors=(1.1, 0.9)),
}
HIGH_VALUE_RULES = {
    1: HighValueRule(0.78, 50.0, 100.0),
    2: HighValueRule(0.85, 0.5, 75.0, quantity_weight=0.1),
    3: HighValueRule(0.92, 0.45, 60.0, quantity_weight=0.15, peak_bonus=0.3, hour_bonus=0.2),
}

REQUIRED = {"amount": AMOUNT_FEATURES, "category": FULL_FEATURES, "high_value": FULL_FEATURES}

# The fields that versions 1 to 3 of a family compute with, in the order they are read.
USED = {
    "amount": (("quantity", "price"), ("quantity", "price", "month"), ("quantity", "price", "month", "hour")),
    "category": (("quantity",), ("quantity", "total_amount"), ("quantity", "total_amount", "month", "hour")),
    "high_value": (("total_amount",), ("total_amount", "quantity"), ("total_amount", "quantity", "month", "hour")),
}


def _in_peak(yes: float, no: float) -> Column:
    return F.when(F.col("month").isin(*PEAK_MONTHS), F.lit(yes)).otherwise(F.lit(no))


def _in_office_hours(yes: float, no: float) -> Column:
    return F.when(F.col("hour").between(*OFFICE_HOURS), F.lit(yes)).otherwise(F.lit(no))


def missing_field(df: DataFrame, fields: tuple[str, ...]) -> Column:
    """Text naming the first required field that is null or absent, else null."""
    return F.coalesce(*[
        F.when(F.col(f).isNull(), F.lit(f"Missing field: {f}")) if f in df.columns
        else F.lit(f"Missing field: {f}")
        for f in fields
    ], F.lit(None).cast("string"))


def validate(df: DataFrame, family: str) -> DataFrame:
    """Add ``error``; valid rows have a null there."""
    return df.withColumn("error", missing_field(df, REQUIRED[family]))


# Each family gives the helper columns it needs, step by step, and its answer columns.
# A helper is a column of its own so that nothing is computed twice.
_Steps = list[dict[str, Column]]


def _amount(rule: AmountRule, noise_seed: int | None) -> tuple[_Steps, dict[str, Column]]:
    value, helpers, details = F.col("quantity") * F.col("price"), {}, {}
    if rule.peak_factor is not None:
        helpers["_peak"] = _in_peak(rule.peak_factor, 1.0)
        value = value * F.col("_peak")
        details["seasonal_adjustment"] = F.col("_peak")
    if rule.hour_factors is not None:
        helpers["_hours"] = _in_office_hours(*rule.hour_factors)
        value = value * F.col("_hours")
        details["hourly_adjustment"] = F.col("_hours")
    if noise_seed is not None:
        value = value * (F.lit(1.0) + F.randn(noise_seed) * F.lit(rule.noise))
    return [helpers], {"prediction": F.round(value, 2), "confidence": F.lit(rule.confidence), **details}


def _category(rule: CategoryRule) -> tuple[_Steps, dict[str, Column]]:
    factors, quantity, details = {}, F.col("quantity"), {}
    if rule.peak_factor is not None and rule.hour_factors is not None:
        factors = {"_peak": _in_peak(rule.peak_factor, 1.0), "_hours": _in_office_hours(*rule.hour_factors)}
        quantity = quantity * F.col("_peak") * F.col("_hours")
        details["temporal_adjustments"] = F.struct(
            F.col("_peak").alias("seasonal_boost"), F.col("_hours").alias("time_boost"),
            F.round("_quantity", 2).alias("adjusted_quantity"),
        )
    elif rule.amount_limits is not None:
        details["amount_threshold_used"] = F.lit(True)

    place = F  # position of the lowest category whose limits hold, else the last one
    for i, limit in enumerate(rule.quantity_limits):
        fits = F.col("_quantity") <= F.lit(float(limit))
        if rule.amount_limits is not None:
            fits = fits & (F.col("total_amount") < F.lit(float(rule.amount_limits[i])))
        place = place.when(fits, F.lit(i))
    steps = [factors, {"_quantity": quantity}, {"_place": place.otherwise(F.lit(len(CATEGORIES) - 1))}]

    def at_place(values) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col("_place"))

    probabilities = F.struct(*[
        F.when(F.col("_place") == i, F.lit(own)).otherwise(F.lit(other)).alias(name)
        for i, (name, own, other) in enumerate(zip(CATEGORIES, rule.own_probability, rule.other_probability))
    ])
    return steps, {
        "predicted_category": at_place(CATEGORIES),
        "confidence": at_place(rule.own_probability),
        "probabilities": probabilities,
        **details,
    }


def _high_value(rule: HighValueRule) -> tuple[_Steps, dict[str, Column]]:
    amount = F.col("total_amount")
    if rule.quantity_weight is None:
        return [], {
            "is_high_value_customer": amount > F.lit(rule.threshold),
            "probability": F.round(clamp(amount / F.lit(rule.amount_scale), 0.05, 0.95), 3),
            "confidence": F.lit(rule.confidence),
            "threshold_used": F.lit(rule.threshold),
        }
    parts = {
        "base_score": amount / F.lit(rule.amount_scale),
        "quantity_bonus": F.col("quantity") * F.lit(rule.quantity_weight),
    }
    if rule.peak_bonus is not None:
        parts["seasonal_bonus"] = _in_peak(rule.peak_bonus, 0.0)
    if rule.hour_bonus is not None:
        parts["time_bonus"] = _in_office_hours(rule.hour_bonus, 0.0)
    total = reduce(add, [F.col(f"_{name}") for name in parts])
    steps = [
        {f"_{name}": part for name, part in parts.items()},
        {"_final_score": total},
        {"_probability": sigmoid(F.col("_final_score"))},
    ]
    whole = {"seasonal_bonus", "time_bonus"}
    components = F.struct(*[
        (F.col(f"_{name}") if name in whole else F.round(f"_{name}", 3)).alias(name)
        for name in [*parts, "final_score"]
    ])
    return steps, {
        "is_high_value_customer": F.col("_probability") > F.lit(rule.threshold),
        "probability": F.round("_probability", 3),
        "confidence": F.lit(rule.confidence),
        "score_components": components,
        "threshold": F.lit(rule.threshold),
    }


def _rule(family: str, version: int, noise_seed: int | None) -> tuple[_Steps, dict[str, Column]]:
    if family == "amount":
        return _amount(AMOUNT_RULES[version], noise_seed)
    if family == "category":
        return _category(CATEGORY_RULES[version])
    return _high_value(HIGH_VALUE_RULES[version])


def _answers(family: str, version: int, noise_seed: int | None = None) -> tuple[_Steps, dict[str, Column]]:
    """Helper columns, and the whole answer: model, predictions, features used and model version."""
    name = model_name(family, version)
    steps, answers = _rule(family, version, noise_seed)
    return steps, {
        "model": F.lit(name), **answers,
        "features_used": F.array(*[F.lit(f) for f in REQUIRED[family]]),
        "model_version": F.lit(version),
    }


def _refuse_clash(df: DataFrame, names: set[str]) -> None:
    clash = sorted(names & set(df.columns))
    if clash:
        raise ValueError(f"input already has score columns: {', '.join(clash)}")


def _with_error(df: DataFrame, family: str) -> DataFrame:
    absent = {f: F.lit(None).cast(REQUEST[f].dataType) for f in REQUIRED[family] if f not in df.columns}
    return df.withColumns({**absent, "error": missing_field(df, REQUIRED[family])})


def score(df: DataFrame, family: str, version: int, noise_seed: int | None = None) -> DataFrame:
    """Score every row: model, answers, confidence, features used and model version.

    Rows with a missing field get an ``error`` that names it, and null answers.
    ``noise_seed`` turns on the random factor of the amount rules, off by default.
    """
    steps, answers = _answers(family, version, noise_seed)
    _refuse_clash(df, {"error", *answers})
    work = _with_error(df, family)
    for step in steps:
        work = work.withColumns(step) if step else work
    valid = F.col("error").isNull()
    return work.select(
        *df.columns, "error", *[F.when(valid, answer).alias(a) for a, answer in answers.items()]
    )


def score_json(requests: DataFrame, family: str, version: int, column: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Score JSON request texts: ``request``, the JSON answer as ``response``, its ``status``, and the columns of ``keep``.

    Status 200 comes with the answer, 400 with the first absent field as ``error``, 500 with the first value that can't be read of those the
    rule computes with, or for text that is no JSON.
    """
    steps, answers = _answers(family, version)
    read = read_requests(requests, column, keep)
    work = read.select(*keep, "request", request_error(REQUIRED[family], USED[family][version - 1]).alias("error"), *REQUEST.names)
    for step in steps:
        work = work.withColumns(step) if step else work
    valid = F.col("error").isNull()
    body = F.struct("error", *[F.when(valid, answer).alias(a) for a, answer in answers.items()])
    return work.select(*keep, "request", F.to_json(body).alias("response"), status_of(F.col("error")).alias("status"))


def _amount_envelopes(work: DataFrame, errors: dict[int, Column]) -> DataFrame:
    """Adds ``v1`` to ``v3``: the whole amount answers, null where that version has an error."""
    for v in VERSIONS:
        steps, answers = _answers("amount", v)
        inner = work.withColumns(steps[0]) if steps[0] else work
        envelope = F.struct(*[answer.alias(a) for a, answer in answers.items()])
        work = inner.withColumn(f"v{v}", F.when(errors[v].isNull(), envelope)).drop(*steps[0])
    return work


def compare_answers(df: DataFrame) -> DataFrame:
    """The three whole amount answers side by side as structs ``v1`` to ``v3``, with the shared ``error``."""
    names = [f"v{v}" for v in VERSIONS]
    _refuse_clash(df, {"error", *names})
    work = _amount_envelopes(_with_error(df, "amount"), dict.fromkeys(VERSIONS, F.col("error")))
    return work.select(*df.columns, "error", *names)


def compare_json(requests: DataFrame, column: str = "value", at: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """JSON requests answered by all amount rules: ``request``, ``response``, ``status``, and the columns of ``keep``.

    The response holds ``total_amount_predictions`` with the answer of each version that gave one, ``comparison_timestamp``
    (``at``, by default now) and the request as ``input_data``. A request that is no JSON is answered by its error.
    """
    read = read_requests(requests, column, keep, parse_all=True)
    errors = {v: F.col(f"_error_{v}") for v in VERSIONS}
    work = read.select(*keep, "request", "readable", "parsed", *REQUEST.names, *[
        request_error(AMOUNT_FEATURES, USED["amount"][v - 1]).alias(f"_error_{v}") for v in VERSIONS])
    readable = F.col("readable")
    error = F.when(~readable, F.lit(UNREADABLE))
    time = iso_text(F.current_timestamp() if at is None else at, micros=True)
    body = F.struct(
        error.alias("error"),
        F.when(readable, F.struct(*[f"v{v}" for v in VERSIONS])).alias("total_amount_predictions"),
        F.when(readable, time).alias("comparison_timestamp"), F.col("parsed").alias("input_data"))
    return _amount_envelopes(work, errors).select(
        *keep, "request", F.to_json(body).alias("response"), status_of(error).alias("status"))


def compare_amount(df: DataFrame) -> DataFrame:
    """The three amount scores side by side, with the shared ``error``."""
    work = _with_error(df, "amount")
    valid = F.col("error").isNull()
    for v in VERSIONS:
        steps, answers = _amount(AMOUNT_RULES[v], None)
        inner = work.withColumns(steps[0]) if steps[0] else work
        work = inner.withColumn(f"v{v}", F.when(valid, answers["prediction"])).drop(*steps[0])
    return work.select(*df.columns, "error", *[f"v{v}" for v in VERSIONS])


def compare_amount_long(df: DataFrame) -> DataFrame:
    """One row per input and version."""
    wide = compare_amount(df)
    return wide.unpivot([*df.columns, "error"], [f"v{v}" for v in VERSIONS], "version", "prediction")
