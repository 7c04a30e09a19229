"""CSV sources: raw sales files and saved record files."""

from __future__ import annotations

import csv
import logging
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnflow.config import DEFAULTS, Settings
from txnflow.functions.text import blanks_to_null, normalise_header
from txnflow.schema import RECORD, conform

log = logging.getLogger(__name__)

# Fields with commas, quotes or line breaks are quoted, and a quote inside them is doubled. All
# readers and writers of this package share these options.
CSV = {"header": "true", "quote": '"', "escape": '"'}

#: Both layouts of saved batches, a folder ``batch_id=<n>`` or a file (or folder of parts) ``batch_<n>_<time>.csv``, at the end of a path only.
#: One pattern for both, since it is looked for in the path of every row.
_NAMED_END = r"_\d{8}_\d{6}\.csv(?:/[^/]+)?$"
BATCH_PATH = rf"(?:/batch_id=(?=\d+/)|[/=]batch_(?=\d+{_NAMED_END}))(\d+)(?:/[^/]+$|{_NAMED_END})"


def batch_id_of(path: str | Column) -> Column:
    """The batch a file belongs to, by its path; null for other files."""
    return F.nullif(F.regexp_extract(path, BATCH_PATH, 1), F.lit("")).try_cast("bigint")


def among(number: Column, ids: Iterable[int]) -> Column:
    """Whether a number is one of ``ids``. Stretches of neighbours are told by their ends, so that thousands of ids make a short expression."""
    ordered = sorted(set(ids))
    starts = [n for place, n in enumerate(ordered) if not place or ordered[place - 1] != n - 1]
    ends = [n for place, n in enumerate(ordered) if place + 1 == len(ordered) or ordered[place + 1] != n + 1]
    if len(starts) > 100:
        return number.isin(ordered)
    return reduce(or_, [number.between(start, end) for start, end in zip(starts, ends, strict=True)], F.lit(False))


def _text_schema(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _header(spark: SparkSession, paths: list[str], encoding: str) -> T.StructType:
    """Column names in file order; without inference this reads one line."""
    return _text_schema(
        spark.read.options(**CSV).option("encoding", encoding).csv(paths[0]).columns
    )


def read_raw(spark: SparkSession, path: str, settings: Settings = DEFAULTS, multi_line: bool = True) -> DataFrame:
    """Raw sales CSV, every column text, header names normalised, missing texts null.

    ``enforceSchema=false`` makes a file whose header differs fail instead of
    being bound by position. Fields may hold line breaks; a file is then read by one task, so
    a very large file known to have none is better read with ``multi_line=False``, in parts.
    """
    schema = _header(spark, [path], settings.raw_encoding)
    raw = (
        spark.read.schema(schema)
        .options(**CSV)
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
        .option("encoding", settings.raw_encoding)
        .csv(path)
    )
    return blanks_to_null(normalise_header(raw))


def read_raw_stream(spark: SparkSession, path: str, columns: Iterable[str],
                    settings: Settings = DEFAULTS, files_per_trigger: int | None = None,
                    multi_line: bool = True) -> DataFrame:
    """The streaming form of :func:`read_raw`; header names must be given up front."""
    reader = (
        spark.readStream.schema(_text_schema(columns))
        .options(**CSV)
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
        .option("encoding", settings.raw_encoding)
    )
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return blanks_to_null(normalise_header(reader.csv(path)))


def existing_paths(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """The paths that exist; each missing one is logged and left out."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    configuration = spark._jsc.hadoopConfiguration()
    found = []
    for path in paths:
        candidate = hadoop_path(path)
        if candidate.getFileSystem(configuration).exists(candidate):
            found.append(path)
        else:
            log.warning("data file %s not found, skipped", path)
    return found


def first_lines(spark: SparkSession, paths: Iterable[str], encoding: str = "UTF-8") -> dict[str, str]:
    """The first line of each file, or of the first part of each folder, read by the driver alone: no job for a few bytes."""
    jvm, configuration, lines = spark._jvm, spark._jsc.hadoopConfiguration(), {}
    for path in paths:
        file = jvm.org.apache.hadoop.fs.Path(path)
        system = file.getFileSystem(configuration)
        if system.getFileStatus(file).isDirectory():
            parts = sorted(p.getPath().toString() for p in system.listStatus(file)
                           if p.isFile() and p.getLen() and not p.getPath().getName().startswith(("_", ".")))
            if not parts:
                continue
            file = jvm.org.apache.hadoop.fs.Path(parts[0])
        stream = system.open(file)
        try:
            lines[path] = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, encoding)).readLine() or ""
        finally:
            stream.close()
    return lines


def read_record_files(spark: SparkSession, paths: Iterable[str], schema: T.StructType = RECORD, multi_line: bool = True,
                      number: str | None = None) -> DataFrame | None:
    """Saved record files as one table of ``schema``; None when no path exists.

    Files that share a header are read in one scan. Each distinct header is a scan
    of its own, joined by name after conformance, so column order never matters. Headers are read without a job.
    ``number`` names a column that tells which of ``paths``, from 1 on, a row is from. ``multi_line=False``
    lets a large file be read in parts.
    """
    paths = list(paths)
    found = existing_paths(spark, paths)
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path, line in first_lines(spark, found).items():
        by_header.setdefault(tuple(next(csv.reader([line.removeprefix("\ufeff")]), [])), []).append(path)
    tables = []
    for names, group in by_header.items():
        # With a number wanted, each path is a scan of its own: the files are listed by name, so they are few.
        for part in [[path] for path in group] if number else [group]:
            text = (
                spark.read.schema(_text_schema(names)).options(**CSV).option("multiLine", multi_line)
                .option("enforceSchema", False).option("ignoreMissingFiles", True).csv(part)
            )
            tables.append(conform(text, schema, keep=[F.lit(paths.index(part[0]) + 1).alias(number)] if number else ()))
    if not tables:
        return None
    combined = tables[0]
    for table in tables[1:]:
        combined = combined.unionByName(table)
    return combined


def batch_files(spark: SparkSession, root: str) -> DataFrame:
    """``path, batch_id, modificationTime, length`` of the files of all saved batches, either layout. No file is opened."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        .select("path", "modificationTime", "length").withColumn("batch_id", batch_id_of("path"))
    )
    return listed.where(F.col("batch_id").isNotNull())


def read_batches(spark: SparkSession, root: str, fmt: str = "csv", schema: T.StructType = RECORD, ids: Sequence[int] | None = None,
                 multi_line: bool = True) -> DataFrame:
    """Saved batches under ``root`` with their ``batch_id``: all, or those of ``ids``, whose files alone are opened.

    Batches are folders ``batch_id=<n>/`` or, as CSV, single files ``batch_<n>_<time>.csv``; both may lie side by side.
    ``multi_line=False`` lets a large file be read in parts.
    """
    if fmt != "csv":
        stored = spark.read.option("ignoreMissingFiles", True).format(fmt).load(root)
        saved = conform(stored, schema, keep=[F.col("batch_id").try_cast("bigint").alias("batch_id")])
        return saved if ids is None else saved.where(among(F.col("batch_id"), ids))
    paths = [root]
    if ids is not None:
        paths = [r.path for r in batch_files(spark, root).where(among(F.col("batch_id"), ids)).select("path").collect()]
        if not paths:
            return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())]))
    # The id comes from the path of the file, so folders give no partition column.
    text = (
        spark.read.schema(_text_schema(schema.names)).options(**CSV).option("recursiveFileLookup", True)
        .option("multiLine", multi_line).option("enforceSchema", False).option("ignoreMissingFiles", True).csv(paths)
        # A generator gives the id as a column: the filter on it stays above, so every path is looked at once a row.
        .select(*schema.names, F.explode(F.array(batch_id_of("_metadata.file_path"))).alias("batch_id"))
    )
    return conform(text.where(F.col("batch_id").isNotNull()), schema, keep=["batch_id"])
