"""Lenient time parsing and ISO text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
FILE_STAMP = "yyyyMMdd_HHmmss"


def parse_time(text: Column, formats: Sequence[str]) -> Column:
    """Business time without zone: the ISO form first, then each format, else null."""
    return F.coalesce(
        text.try_cast("timestamp_ntz"),
        *[F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz") for fmt in formats],
    )


def calendar_part(part: Column) -> Column:
    """Calendar fields fall back to 0 row by row when the time is missing."""
    return F.coalesce(part, F.lit(0))


def iso_text(time: Column, micros: bool = False) -> Column:
    return F.date_format(time, ISO_MICROS if micros else ISO_SECONDS)
