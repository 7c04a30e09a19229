"""Raw stream to clean records, and records to saved batches with optional retraining."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from txnflow.config import DEFAULTS, Settings
from txnflow.operators.clean import clean
from txnflow.session import delete_paths, state_on_disk
from txnflow.sources.files import CSV
from txnflow.sources.messages import to_record, to_wire

PROGRESS = "batch_id bigint, rows bigint, amount double, first_sale timestamp_ntz, last_sale timestamp_ntz"


def measures() -> dict[str, Column]:
    """What is observed of a batch while it is written."""
    return {
        "rows": F.count(F.lit(1)), "amount": F.sum("total_amount"), "first_sale": F.min("invoice_date"), "last_sale": F.max("invoice_date"),
    }


OnBatch = Callable[[SparkSession, int], None]


def clean_stream(raw: DataFrame, settings: Settings = DEFAULTS,
                 keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Records from a raw stream: the batch cleaning, unchanged, plus the publish time."""
    return to_record(clean(raw, settings, keep), keep=keep)


def trigger_of(drain: bool, settings: Settings) -> dict[str, object]:
    if drain:
        return {"availableNow": True}
    return {"processingTime": f"{settings.batch_seconds} seconds"}


def write_table(stream: DataFrame, path: str, checkpoint: str, drain: bool = True,
                settings: Settings = DEFAULTS, large_state: bool = False) -> StreamingQuery:
    """Append a stream to a parquet table with Spark's exactly-once file sink.

    State is kept in the executors' memory, or on their disks if ``large_state``; a checkpoint that is there goes on with what it began with.
    """
    writer = (
        stream.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_of(drain, settings))
    )
    with state_on_disk(stream.sparkSession) if large_state else nullcontext():
        return writer.start()


def save_batches(records: DataFrame, root: str, checkpoint: str, on_batch: OnBatch | None = None,
                 every: int = 1, drain: bool = False, settings: Settings = DEFAULTS,
                 progress_path: str | None = None) -> StreamingQuery:
    """Save each micro-batch under ``batch_id=<n>/`` and call ``on_batch`` after every n-th.

    The id is Spark's own batch id from the checkpoint, and the folder is overwritten
    as a whole: a batch replayed after a failure replaces itself, so nothing is
    lost or doubled. ``drain`` processes what is there and stops, without ``on_batch``;
    otherwise the query runs on, one trigger per ``batch_seconds``. On Kafka the source
    options decide the rows per batch, on files ``files_per_trigger``; ``cut_batches`` saves batches
    of a fixed size.

    What a batch holds is observed while it is written, in the same pass, and saved
    under ``progress_path`` if given; see :func:`read_progress`. An empty batch leaves no folder.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"batch-{batch_id}")
        observed = batch.observe(seen, *[column.alias(name) for name, column in measures().items()])
        rows = to_wire(observed) if settings.batch_format == "csv" else observed
        folder = f"{root.rstrip('/')}/batch_id={batch_id}"
        (
            rows.write.mode("overwrite").format(settings.batch_format)
            .options(**(CSV if settings.batch_format == "csv" else {}))
            .save(folder)
        )
        found = seen.get
        if not found["rows"]:
            delete_paths(batch.sparkSession, [folder])
            return
        if progress_path:
            row = [(batch_id, *[found[name] for name in measures()])]
            batch.sparkSession.createDataFrame(row, PROGRESS).coalesce(1).write.mode("overwrite").parquet(
                f"{progress_path.rstrip('/')}/saved_batch={batch_id}")
        if on_batch and not drain and (batch_id + 1) % every == 0:
            on_batch(batch.sparkSession, batch_id)

    return (
        records.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_of(drain, settings)).start()
    )


def read_progress(spark: SparkSession, progress_path: str) -> DataFrame:
    """What was observed of each saved batch, and the running row total in order of batches."""
    saved = spark.read.schema(PROGRESS).parquet(progress_path).drop("saved_batch")
    # One row a batch.
    return saved.withColumn("total_rows", F.sum("rows").over(Window.orderBy("batch_id")))


def progress(query: StreamingQuery) -> list[dict[str, object]]:
    """Rows and duration of the recent micro-batches, and the running row total."""
    total, steps = 0, []
    for step in query.recentProgress:
        total += step["numInputRows"]
        steps.append({
            "batch_id": step["batchId"],
            "rows": step["numInputRows"],
            "total_rows": total,
            "duration_ms": step["durationMs"].get("triggerExecution"),
        })
    return steps
