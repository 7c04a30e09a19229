"""Sales-transaction pipeline on Spark: clean, batch, select, train and score."""

from txnflow.config import DEFAULTS, Settings
from txnflow.operators.clean import clean
from txnflow.operators.score import compare_amount, compare_answers, compare_json, score, score_json, validate
from txnflow.session import build_session, drop_staged, stage

__all__ = [
    "DEFAULTS", "Settings", "build_session", "clean", "compare_amount", "compare_answers", "compare_json", "drop_staged",
    "score", "score_json", "stage", "validate",
]
