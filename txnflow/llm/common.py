"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: the ASCII space and the controls 9 to 13.
ASCII_SPACE = r"[\x20\x09-\x0D]+"

#: Text held by one slice of an Arrow batch: bounds the memory of a Python worker when texts are long.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], text_column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that none holds much more than ``most`` bytes of text; rows stay whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = max(1, int(batch.num_rows * most / max(1, batch.column(text_column).nbytes)))
        start = 0
        while start < batch.num_rows:
            part = batch.slice(start, rows)
            yield part
            start += rows


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once: executors don't see the folder it was imported from."""
    context, root = spark.sparkContext, Path(__file__).parents[1]
    if f"{root.name}.zip" in map(os.path.basename, context.listFiles):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{root.name}.zip")
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(root.rglob("*.py")):
            file.write(source, source.relative_to(root.parent))
    context.addPyFile(archive)
