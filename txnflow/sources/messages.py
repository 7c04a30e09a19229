"""Keyed JSON messages: encode, decode, and the Kafka options around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.config import DEFAULTS, Settings
from txnflow.functions.keys import message_key
from txnflow.functions.text import unquote_nan
from txnflow.functions.times import iso_text
from txnflow.schema import RECORD, WIRE, conform


def to_record(clean: DataFrame, published_at: Column | None = None,
              keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """The 15-field record: absent text columns are '', absent numbers 0."""
    published = F.current_timestamp() if published_at is None else published_at
    fields = []
    for f in RECORD.fields:
        if f.name == "timestamp":
            value = published
        elif f.name in clean.columns:
            value = F.col(f.name)
        elif f.name == "quantity_category":
            value = F.lit("unknown")
        elif f.dataType.typeName() == "string":
            value = F.lit("")
        elif f.name == "invoice_date":
            value = F.lit(None)
        else:
            value = F.lit(0)
        fields.append(value.cast(f.dataType).alias(f.name))
    return clean.select(*fields, *keep)


def to_wire(records: DataFrame, keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Records with both times as ISO text, as JSON and CSV carry them."""
    return records.select(*[
        iso_text(F.col(f.name), micros=f.name == "timestamp").alias(f.name)
        if f.name in ("invoice_date", "timestamp") else F.col(f.name)
        for f in RECORD.fields
    ], *keep)


def encode_messages(records: DataFrame) -> DataFrame:
    """One ``key``/``value`` text row per record."""
    wire = to_wire(records)
    # The null times and texts stay in the JSON so that all 15 fields are present.
    value = F.to_json(F.struct(*wire.columns), {"ignoreNullFields": "false"})
    return wire.select(message_key(wire).alias("key"), value.alias("value"))


# Every field as text: a number that was sent as text is read like any other.
_TEXT_WIRE = ", ".join(f"`{f.name}` string" for f in WIRE.fields)
# The fields as they are sent as a rule, and the whole message if it isn't like that.
_SENT_WIRE = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in WIRE.fields) + ", `_broken` string"


def decode_messages(messages: DataFrame) -> DataFrame:
    """Records from ``value`` (text or bytes); what is skipped is in :func:`rejected_messages`.

    Messages that hold every number as a finite number are read as such. The others are read once more, every field as text.
    """
    value = F.col("value").cast("string")
    key = F.col("key") if "key" in messages.columns else F.lit(None)
    # A generator gives the fields as columns: filters on them stay above it, so every
    # message is parsed once.
    sent = F.inline(F.array(F.from_json(value, _SENT_WIRE, {"columnNameOfCorruptRecord": "_broken"})))
    wire = messages.select(key.cast("string").alias("message_key"), value.alias("_value"), sent)
    numbers = [f.name for f in WIRE.fields if f.dataType.typeName() != "string"]
    plain = F.col("_broken").isNull()
    for name in numbers:
        plain = plain & F.coalesce(F.abs(F.col(name).cast("double")) < F.lit(float("inf")), F.lit(False))
    judged = wire.withColumn("_plain", plain)
    read = judged.withColumn("_text", F.when(~F.col("_plain"), F.from_json("_value", _TEXT_WIRE)))
    some_field = F.coalesce(*[F.col(f"_text.{f.name}") for f in WIRE.fields])
    as_text = conform(read.where(F.col("_plain") | some_field.isNotNull()).select(
        "message_key", "_plain", F.struct(*[F.col(name) for name in numbers]).alias("_sent"), *[
            F.col(f"_text.{f.name}").alias(f.name) if f.name in numbers
            else unquote_nan(F.when(F.col("_plain"), F.col(f.name)).otherwise(F.col(f"_text.{f.name}"))).alias(f.name)
            for f in WIRE.fields]), RECORD, keep=["message_key", "_plain", "_sent"])
    return as_text.select(*[
        F.when(F.col("_plain"), F.col(f"_sent.{f.name}")).otherwise(F.col(f.name)).alias(f.name) if f.name in numbers else F.col(f.name)
        for f in RECORD.fields], "message_key")


def rejected_messages(messages: DataFrame) -> DataFrame:
    """``key``, ``value`` and ``reason`` of the messages that :func:`decode_messages` skips."""
    value = F.col("value").cast("string")
    key = F.col("key").cast("string") if "key" in messages.columns else F.lit(None).cast("string")
    read = messages.select(key.alias("key"), value.alias("value"), F.from_json(
        value, f"{_TEXT_WIRE}, `_broken` string", {"columnNameOfCorruptRecord": "_broken"}).alias("read"))
    some_field = F.coalesce(*[F.col(f"read.{f.name}") for f in WIRE.fields])
    reason = F.when(F.coalesce(F.trim("value"), F.lit("")) == "", "empty").when(
        F.col("read._broken").isNotNull(), "malformed").otherwise("no known field")
    return read.where(some_field.isNull()).select("key", "value", reason.alias("reason"))


def kafka_sink_options(settings: Settings = DEFAULTS) -> dict[str, str]:
    """Options for ``write.format("kafka")``: all acknowledgements, three retries."""
    return {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "topic": settings.topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.linger.ms": "20",
        "kafka.batch.size": str(32 * 1024),
    }


def kafka_source_options(settings: Settings = DEFAULTS) -> dict[str, str]:
    """Options for ``readStream.format("kafka")`` with the count-or-time batch rule.

    A trigger waits for ``batch_size`` new messages, or ``batch_seconds`` at most, and takes up to
    ``max_trigger_rows``, so that a topic that ran ahead can be caught up on; ``cut_batches`` cuts
    batches of ``batch_size`` from them.
    """
    return {
        "kafka.bootstrap.servers": settings.bootstrap_servers,
        "subscribe": settings.topic,
        "startingOffsets": "earliest",
        "minOffsetsPerTrigger": str(settings.batch_size),
        "maxOffsetsPerTrigger": str(max(settings.batch_size, settings.max_trigger_rows)),
        "maxTriggerDelay": f"{settings.batch_seconds}s",
    }


def read_kafka(spark: SparkSession, settings: Settings = DEFAULTS) -> DataFrame:
    """Records from the topic; needs the Kafka connector on the class path."""
    return decode_messages(
        spark.readStream.format("kafka").options(**kafka_source_options(settings)).load()
    )


def write_kafka(records: DataFrame, settings: Settings = DEFAULTS, checkpoint: str | None = None):
    """Publish a batch at once, or start a query for a stream."""
    messages = encode_messages(records)
    options = kafka_sink_options(settings)
    if not records.isStreaming:
        return messages.write.format("kafka").options(**options).save()
    if not checkpoint:
        raise ValueError("a streaming publish needs a checkpoint folder")
    return (
        messages.writeStream.format("kafka").options(**options)
        .option("checkpointLocation", checkpoint).start()
    )


def write_message_files(records: DataFrame, path: str) -> None:
    """File form of the topic: one JSON message per line, compressed, readable as a stream."""
    encode_messages(records).select("key", "value").write.mode("append").json(path, compression="lz4")


def read_message_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of records from :func:`write_message_files` output."""
    reader = spark.readStream.schema("key STRING, value STRING")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return decode_messages(reader.json(path))
