"""Pipeline settings: one frozen value object instead of module globals."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TrainingScheme:
    """How the training sets of one model family are cut from the data."""

    family: str
    scheme: str
    target: str
    features: tuple[str, ...]


CALENDAR = ("month", "day", "hour")
AMOUNT_FEATURES = ("quantity", "price", *CALENDAR)
FULL_FEATURES = ("quantity", "price", "total_amount", *CALENDAR)

LINEAR = TrainingScheme("linear_regression", "incremental", "total_amount", AMOUNT_FEATURES)
FOREST = TrainingScheme("random_forest", "time_window", "quantity_category", FULL_FEATURES)
LOGISTIC = TrainingScheme("logistic_regression", "fixed_size", "high_value_customer", FULL_FEATURES)


@dataclass(frozen=True)
class Settings:
    """Defaults of the pipeline; every job takes them as an argument."""

    bootstrap_servers: str = "localhost:9092"
    topic: str = "retail_data_stream"
    batch_size: int = 1000
    batch_seconds: int = 60
    batch_format: str = "csv"
    raw_encoding: str = "ISO-8859-1"
    window_minutes: int = 5
    # Rows that the minimal training mode fits on, about; a bound on the sample of a fit only.
    max_fit_rows: int = 1_000_000
    # Messages that one trigger takes at most; ``cut_batches`` cuts batches of ``batch_size`` from them.
    max_trigger_rows: int = 1_000_000
    train_fraction: float = 0.8
    seed: int = 42
    minimum_rows: int = 10
    high_value_quantile: float = 0.8
    ignore_invoice_case: bool = True
    # Tried in turn for every row, after the ISO form.
    time_formats: tuple[str, ...] = ("M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy")
    schemes: tuple[TrainingScheme, ...] = field(default=(LINEAR, FOREST, LOGISTIC))

    def scheme_for(self, family: str) -> TrainingScheme:
        for scheme in self.schemes:
            if scheme.family == family:
                return scheme
        raise ValueError(f"unknown model family: {family}")


DEFAULTS = Settings()
