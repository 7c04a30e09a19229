"""Header names, missing-value text and invoice tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cell texts that the pandas CSV reader takes as missing.
MISSING_TEXT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def normalise_name(name: str) -> str:
    """Lower case; blanks and hyphens become underscores."""
    return name.lower().replace(" ", "_").replace("-", "_")


def normalise_header(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalise_name(c) for c in df.columns])


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Null out every missing-value text in the string columns of ``df``."""
    return df.select(*[
        F.when(~F.col(f"`{f.name}`").isin(*MISSING_TEXT), F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def unquote_nan(text: Column) -> Column:
    """A bare JSON ``NaN`` read into a string field arrives as text, quotes included."""
    return F.when(~text.isin("NaN", '"NaN"'), text)


def is_cancelled(invoice: Column, ignore_case: bool = True) -> Column:
    """Cancelled invoices start with the letter c; a null invoice is not cancelled."""
    text = F.lower(invoice) if ignore_case else invoice
    return F.coalesce(F.startswith(text, F.lit("c")), F.lit(False))
