"""Quantity bands of the training label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Left-closed upper edges and labels, lowest band first.
QUANTITY_BANDS = ((1.0, "low"), (5.0, "medium"), (20.0, "high"), (float("inf"), "bulk"))
UNKNOWN_BAND = "unknown"


def quantity_band(quantity: Column) -> Column:
    """Band of a quantity; null, NaN and +infinity have none and give ``unknown``."""
    band = F.when(quantity.isNull() | F.isnan(quantity), UNKNOWN_BAND)
    for edge, label in QUANTITY_BANDS:
        band = band.when(quantity < F.lit(edge), label)
    return band.otherwise(UNKNOWN_BAND)
