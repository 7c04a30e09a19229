"""Registered queries: one per operator or job, over the whole order tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import wraps

from pyspark.errors import StreamingQueryException
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnflow.config import AMOUNT_FEATURES, FULL_FEATURES, Settings
from txnflow.functions.text import normalise_header
from txnflow.operators import quality
from txnflow.operators.clean import clean
from txnflow.operators.features import drop_null_target, fill_features, keep_present, prepare, target_values, with_time
from txnflow.operators.label import high_value_customers, label_lines
from txnflow.operators.metrics import area_under_roc, multiclass_metrics, regression_metrics
from txnflow.operators.numbering import with_batch_id
from txnflow.operators.score import compare_amount, compare_amount_long, compare_json, score, score_json, validate
from txnflow.operators.selection import (
    first_batch_minimal, first_batches, first_minutes, first_sorted_batches, first_windows, with_fold, with_window,
)
from txnflow.operators.sets import distinct_rows, union_all, union_distinct
from txnflow.operators.split import TEST, count_by_split, with_split
from txnflow.operators.trees import logistic_chance, with_forest_prediction
from txnflow.operators.standard import label_index, least_squares_line, scale_features
from txnflow.plans import oracles, training
from txnflow.plans.oracles import half_up, sql
from txnflow.plans.sales import LINE_KEYS, TABLES, line_stream, raw_from, sales_lines, sales_raw, table
from txnflow.schema import CLEAN, RECORD, REQUEST, cast_present, conform, conformance_report
from txnflow.session import keep_compiled, stage, staging_path, temporary_stages
from txnflow.sources.catalog import (
    batch_file_name, batch_gaps, batch_status, catalog_summary, list_batches, parse_batch_names,
)
from txnflow.sources.files import CSV, read_batches, read_raw, read_record_files
from txnflow.sources.messages import (
    decode_messages, encode_messages, read_message_files, rejected_messages, to_record, to_wire, write_message_files,
)
from txnflow.sources.ledger import record_batches, recorded_customers
from txnflow.sources.registry import load_model, registry, score_with_model
from txnflow.streaming.cutting import drain_batches
from txnflow.streaming.ingest import clean_stream, read_progress, save_batches, write_table
from txnflow.streaming.windows import window_totals

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PUBLISHED = [f.name for f in RECORD.fields if f.name != "timestamp"]
YEAR_MINUTES = 365 * 24 * 60


def rows_as(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def revenue() -> Column:
    return F.round(F.sum("total_amount"), 4).alias("revenue")


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            keep_compiled(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if oracle:
            ORACLES[function.__name__] = oracle
        return function

    return register


def narrow_lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Some columns of the lines, written once: for what reads them several times, so that the joins behind them run once."""
    return stage(sales_lines(spark, sf_dir).select(*columns), "lines")


def split_lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The keys, some columns and the split of the lines, written once: training and scoring both read this table."""
    return stage(with_split(sales_lines(spark, sf_dir).select(*LINE_KEYS, *columns), LINE_KEYS, portable=True), "lines")


# Cleaning

@query(sql("SELECT * FROM sales_lines", "sales_lines"))
def clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_lines(spark, sf_dir)


@query(sql("""SELECT quantity_category, count(*) AS lines, round(sum(total_amount), 4) AS revenue
              FROM sales_lines GROUP BY quantity_category""", "sales_lines"))
def category_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_lines(spark, sf_dir).groupBy("quantity_category").agg(rows_as("lines"), revenue())


@query(sql("""SELECT month, day, hour, count(*) AS lines, round(sum(total_amount), 4) AS revenue
              FROM sales_lines GROUP BY month, day, hour""", "sales_lines"))
def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_lines(spark, sf_dir).groupBy("month", "day", "hour").agg(rows_as("lines"), revenue())


@query(sql("""
    SELECT CASE WHEN lower(invoice) LIKE 'c%' THEN 'cancelled'
                WHEN customer_id IS NULL THEN 'missing_customer'
                WHEN quantity IS NULL OR price IS NULL THEN 'missing_number'
                WHEN TRY_CAST(quantity AS DOUBLE) IS NULL OR TRY_CAST(price AS DOUBLE) IS NULL THEN 'not_a_number'
                WHEN TRY_CAST(quantity AS DOUBLE) <= 0 THEN 'quantity_not_positive'
                WHEN TRY_CAST(price AS DOUBLE) <= 0 THEN 'price_not_positive'
                ELSE 'kept' END AS reason, count(*) AS lines
    FROM sales_raw GROUP BY 1""", "sales_raw"))
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reject_reasons(sales_raw(spark, sf_dir))


@query(sql("\nUNION ALL\n".join(f"""
    SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS missing,
           count(*) FILTER ({c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL) AS unreadable,
           count(*) FILTER (coalesce(isnan(TRY_CAST({c} AS DOUBLE)), FALSE)) AS nan,
           count(*) FILTER (TRY_CAST({c} AS DOUBLE) IS NOT NULL) AS good
    FROM sales_raw""" for c in ("quantity", "price")), "sales_raw"))
def numeric_parse_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.numeric_parse_report(sales_raw(spark, sf_dir))


@query(sql("""
    SELECT count(*) FILTER (invoicedate IS NULL) AS missing,
           count(*) FILTER (invoicedate IS NOT NULL AND TRY_CAST(invoicedate AS TIMESTAMP) IS NULL) AS unreadable,
           count(*) FILTER (TRY_CAST(invoicedate AS TIMESTAMP) IS NOT NULL) AS good
    FROM sales_raw""", "sales_raw"))
def time_parse_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.time_parse_report(sales_raw(spark, sf_dir))


@query(sql("""
    SELECT 'customer_id' AS column_name, TRUE AS present, count(*) FILTER (customer_id IS NULL) AS null_count,
           CAST(0 AS BIGINT) AS bad_count FROM sales_raw
    UNION ALL
    SELECT 'quantity', TRUE, count(*) FILTER (quantity IS NULL),
           count(*) FILTER (quantity IS NOT NULL AND TRY_CAST(quantity AS DOUBLE) IS NULL) FROM sales_raw
    UNION ALL
    SELECT 'price', TRUE, count(*) FILTER (price IS NULL),
           count(*) FILTER (price IS NOT NULL AND TRY_CAST(price AS DOUBLE) IS NULL) FROM sales_raw
    UNION ALL
    SELECT 'invoicedate', TRUE, count(*) FILTER (invoicedate IS NULL),
           count(*) FILTER (invoicedate IS NOT NULL AND TRY_CAST(invoicedate AS TIMESTAMP) IS NULL) FROM sales_raw
    UNION ALL
    SELECT 'total_amount', FALSE, count(*), CAST(0 AS BIGINT) FROM sales_raw""", "sales_raw"), )
def schema_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType([
        T.StructField("customer_id", T.StringType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("invoicedate", T.TimestampNTZType()),
        T.StructField("total_amount", T.DoubleType()),
    ])
    return conformance_report(sales_raw(spark, sf_dir), schema)


@query(sql("""
    SELECT count(*) FILTER (lower(invoice) LIKE 'c%') AS any_case, count(*) FILTER (invoice LIKE 'c%') AS lower_case_only,
           count(*) AS lines FROM sales_raw""", "sales_raw"))
def cancelled_by_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.cancelled_by_mode(sales_raw(spark, sf_dir))


@query(sql("""
    SELECT invoice, stockcode AS stock_code, quantity, price, customer_id, country FROM sales_raw""", "sales_raw"))
def header_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_header(sales_raw(spark, sf_dir).select(
        F.col("invoice").alias("Invoice"), F.col("stockcode").alias("Stock-Code"),
        F.col("quantity").alias("QUANTITY"), F.col("price").alias("Price"),
        F.col("customer_id").alias("Customer ID"), F.col("country").alias("Country"),
    ))


# Records, files and messages

_PUBLISHED_SQL = "SELECT " + ", ".join(PUBLISHED) + " FROM sales_lines"


@query(sql("SELECT " + ", ".join(PUBLISHED).replace("description", "'' AS description").replace(
    "country", "'' AS country") + " FROM sales_lines", "sales_lines"))
def record_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_record(sales_lines(spark, sf_dir).drop("description", "country")).select(*PUBLISHED)


@query(sql(_PUBLISHED_SQL.replace("SELECT", "SELECT customer_id AS message_key,"), "sales_lines"))
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = encode_messages(to_record(sales_lines(spark, sf_dir)))
    return decode_messages(messages).select("message_key", *PUBLISHED)


@query(sql("""SELECT outcome, count(*) AS messages FROM (
    SELECT CASE CAST(CAST(customer_id AS DOUBLE) AS BIGINT) % 10 WHEN 0 THEN 'malformed' WHEN 1 THEN 'empty' WHEN 2 THEN 'no known field'
                ELSE 'decoded' END AS outcome FROM sales_lines) GROUP BY outcome""", "sales_lines"))
def message_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which some are cut off, empty or of another kind, and some send numbers as text: how many of each."""
    kind = F.col("key").cast("double").cast("bigint") % 10
    whole = F.col("value")
    messages = encode_messages(to_record(sales_lines(spark, sf_dir))).withColumn(
        "value", F.when(kind == 0, F.substring(whole, 1, 9)).when(kind == 1, " ").when(kind == 2, '{"other": 1}')
        .when(kind == 3, F.regexp_replace(whole, r'"quantity":([^,}]+)', '"quantity":"$1"')).otherwise(whole))
    # Staged, since both what is decoded and what is rejected read them.
    messages = stage(messages, "messages")
    decoded = decode_messages(messages).where("quantity IS NOT NULL").select(F.lit("decoded").alias("outcome"))
    return decoded.unionByName(rejected_messages(messages).select(F.col("reason").alias("outcome"))).groupBy("outcome").agg(rows_as("messages"))


@query(sql("SELECT " + ", ".join(CLEAN.names) + " FROM sales_lines", "sales_lines"))
def raw_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text written as a CSV file with its original header style, then read and cleaned."""
    path = staging_path(spark, "raw-csv")
    raw = sales_raw(spark, sf_dir).drop(*LINE_KEYS)
    headed = raw.withColumnsRenamed({
        "invoice": "Invoice", "stockcode": "StockCode", "description": "Description", "quantity": "Quantity",
        "invoicedate": "InvoiceDate", "price": "Price", "customer_id": "Customer ID", "country": "Country",
    })
    headed.write.options(**CSV).option("encoding", "ISO-8859-1").csv(path)
    return clean(read_raw(spark, path))


# Commas, quotes, a quote at the start of a word and a line break in every description.
_ODD_TEXT = ('a "', '", b\n"', '" c')


@query(sql("SELECT " + ", ".join(
    "'a \"' || description || '\", b' || chr(10) || '\"' || stock_code || '\" c' AS description" if n == "description" else n
    for n in CLEAN.names) + " FROM sales_lines", "sales_lines"))
def raw_csv_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text with quotes, commas and line breaks, written as plain text lines with doubled quotes, then read and cleaned."""
    path = staging_path(spark, "quoted-csv")
    names = {
        "invoice": "Invoice", "stockcode": "StockCode", "description": "Description", "quantity": "Quantity",
        "invoicedate": "InvoiceDate", "price": "Price", "customer_id": "Customer ID", "country": "Country",
    }
    before, between, behind = _ODD_TEXT
    raw = sales_raw(spark, sf_dir)
    raw = raw.withColumn("description", F.concat(F.lit(before), "description", F.lit(between), "stockcode", F.lit(behind)))
    quoted = [F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in names]
    # As many files as there are stretches of 50,000 order numbers, so that a file, which one task reads, doesn't grow with the data.
    files = int(spark.read.parquet(f"{sf_dir}/orders.parquet").agg(F.max("o_orderkey")).first()[0] // 50_000) + 1
    body = raw.select((F.col("l_orderkey") % files).alias("file"), F.lit(1).alias("place"), F.concat_ws(",", *quoted).alias("value"))
    # A header for each file; where two of them share a task, the second is a line that cleaning rejects.
    head = spark.range(files).select(F.col("id").alias("file"), F.lit(0).alias("place"), F.lit(",".join(names.values())).alias("value"))
    head.unionByName(body).repartition(files, "file").sortWithinPartitions("place").select("value").write.text(path)
    return clean(read_raw(spark, path))


@query(sql(f"""SELECT {', '.join(PUBLISHED)} FROM (
               SELECT * FROM sales_lines WHERE month <= 6 UNION ALL SELECT * FROM sales_lines WHERE month > 6)""",
           "sales_lines"))
def record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two saved files with different column order and a missing third, read as one table."""
    root = staging_path(spark, "records")
    wire = stage(to_wire(to_record(sales_lines(spark, sf_dir))), "wire")
    first, second, absent = (f"{root}/part{n}" for n in (1, 2, 3))
    wire.where("month <= 6").write.options(**CSV).csv(first)
    wire.where("month > 6").select(*reversed(wire.columns)).write.options(**CSV).csv(second)
    return read_record_files(spark, [first, second, absent]).select(*PUBLISHED)


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the lines with a publish time of their own each, in the order of the keys, and the keys."""
    micros = (F.lit(1_748_476_800_000_000) + F.col("l_orderkey") * 1_000_000 + F.col("l_linenumber") * 100_000 + F.col("l_suppkey") % 100_000)
    return to_record(sales_lines(spark, sf_dir), published_at=F.timestamp_micros(micros), keep=LINE_KEYS)


@query(sql("SELECT batch_id, count(*) AS lines, round(sum(total_amount), 4) AS revenue FROM batched GROUP BY batch_id", "batched"))
def named_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches saved under names with id and time, found and told apart by these names, and read."""
    root = staging_path(spark, "named")
    batched = with_batch_id(_published(spark, sf_dir), order_by=LINE_KEYS, unique=True)
    saved_at = F.lit("2025-05-29").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("batch_id").cast("int"))
    to_wire(batched, keep=["batch_id"]).withColumn("file_name", batch_file_name(F.col("batch_id"), saved_at)).drop("batch_id").write.options(
        **CSV).partitionBy("file_name").csv(root)
    return read_batches(spark, root, multi_line=False).groupBy("batch_id").agg(rows_as("lines"), revenue())


@query(sql("SELECT batch_id, count(*) AS lines FROM batched WHERE batch_id IN (1, 3, 10) GROUP BY batch_id", "batched"))
def batches_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some of the saved batches, whose files alone are opened."""
    root = staging_path(spark, "some-batches")
    batched = with_batch_id(_published(spark, sf_dir), order_by=LINE_KEYS, unique=True)
    to_wire(batched, keep=["batch_id"]).write.options(**CSV).partitionBy("batch_id").csv(root)
    return read_batches(spark, root, ids=[1, 3, 10], multi_line=False).groupBy("batch_id").agg(rows_as("lines"))


# Training rows

_NUMERIC = T.StructType([T.StructField("quantity", T.DoubleType()), T.StructField("price", T.DoubleType())])


@query(sql(f"""SELECT {oracles.KEYS}, coalesce(TRY_CAST(quantity AS DOUBLE), 0) AS quantity,
                      coalesce(TRY_CAST(price AS DOUBLE), 0) AS price FROM sales_raw""", "sales_raw"))
def feature_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cast_present(sales_raw(spark, sf_dir), _NUMERIC).select(*LINE_KEYS, "quantity", "price")
    return fill_features(rows, AMOUNT_FEATURES)


@query(sql(f"SELECT {oracles.KEYS}, TRY_CAST(quantity AS DOUBLE) AS quantity, TRY_CAST(price AS DOUBLE) AS price "
           "FROM sales_raw", "sales_raw"))
def feature_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cast_present(sales_raw(spark, sf_dir), _NUMERIC)
    return keep_present(rows, [*LINE_KEYS, *FULL_FEATURES], required=["quantity"])


@query(sql(f"SELECT {oracles.KEYS}, TRY_CAST(quantity AS DOUBLE) AS quantity FROM sales_raw "
           "WHERE TRY_CAST(quantity AS DOUBLE) IS NOT NULL", "sales_raw"))
def target_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cast_present(sales_raw(spark, sf_dir), _NUMERIC)
    return drop_null_target(rows, "quantity").select(*LINE_KEYS, "quantity")


@query(sql(f"SELECT {oracles.KEYS}, TRY_CAST(invoicedate AS TIMESTAMP) AS timestamp_col FROM sales_raw", "sales_raw"))
def time_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = with_time(sales_raw(spark, sf_dir), "invoicedate")
    return timed.select(*LINE_KEYS, F.col("timestamp_col").cast("timestamp_ntz").alias("timestamp_col"))


@query(sql("""SELECT count(*) FILTER (high_value_customer = 0) AS zeros, count(*) FILTER (high_value_customer = 1) AS ones,
                     CAST(0 AS BIGINT) AS other, count(*) FILTER (high_value_customer IS NULL) AS nulls, TRUE AS is_binary
              FROM labelled""", "labelled"))
def binary_target_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_values(_labelled(spark, sf_dir, "customer_id", "total_amount"), "high_value_customer")


@query(sql("SELECT split, count(*) AS lines FROM split_rows GROUP BY split", "split_rows"))
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_split(with_split(sales_lines(spark, sf_dir), LINE_KEYS, portable=True))


_RECORD_SQL = "SELECT invoice, stock_code, quantity, price, customer_id FROM sales_lines"


@query(sql(f"{_RECORD_SQL} WHERE month <= 8 UNION {_RECORD_SQL} WHERE month >= 5", "sales_lines"))
def union_distinct_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = sales_lines(spark, sf_dir)
    columns = ["invoice", "stock_code", "quantity", "price", "customer_id"]
    return union_distinct([
        lines.where("month <= 8").select(*columns), lines.where("month >= 5").select(*columns),
    ])


@query(sql(f"SELECT part, count(*) AS lines FROM (SELECT 1 AS part FROM sales_lines WHERE month <= 8 "
           "UNION ALL SELECT 2 FROM sales_lines WHERE month >= 5) GROUP BY part", "sales_lines"))
def union_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = sales_lines(spark, sf_dir)
    return union_all([
        lines.where("month <= 8").select(F.lit(1).alias("part")),
        lines.where("month >= 5").select(F.lit(2).alias("part")),
    ]).groupBy("part").agg(rows_as("lines"))


# Selections

def _batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_batch_id(sales_lines(spark, sf_dir), order_by=LINE_KEYS, unique=True)


def _first_batches(spark: SparkSession, sf_dir: str, k: int, *columns: str) -> DataFrame:
    """The first ``k`` batches, staged: each task keeps its least rows, and nothing is sorted as a whole."""
    lines = sales_lines(spark, sf_dir).select(*LINE_KEYS, *columns)
    return stage(first_sorted_batches(lines, k, Settings().batch_size, LINE_KEYS), "first-batches")


def _batch_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.col("batch_id") * 60 + F.max(F.col("l_partkey") + F.col("l_suppkey")) % 50
    saved = _batched(spark, sf_dir).groupBy("batch_id").agg(
        (F.lit("2025-05-29").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)).alias("saved_at")
    )
    return saved.select(batch_file_name(F.col("batch_id"), F.col("saved_at")).alias("value"))


@query(sql(f"SELECT {oracles.KEYS}, batch_id FROM batched", "batched"))
def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batched(spark, sf_dir).select(*LINE_KEYS, "batch_id")


@query(sql("SELECT batch_id, saved_at, file_name FROM catalog", "catalog"))
def batch_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_batch_names(_batch_names(spark, sf_dir))


@query(sql("""SELECT batch_id, saved_at, file_name,
                     date_diff('second', lag(saved_at) OVER (ORDER BY batch_id), saved_at) * 1e0 AS gap_seconds
              FROM catalog""", "catalog"))
def batch_gap_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_gaps(parse_batch_names(_batch_names(spark, sf_dir)), span=16)


@query(sql("""SELECT count(*) AS gaps, round(avg(gap), 6) AS mean_gap, max(gap) AS widest FROM (
              SELECT date_diff('second', lag(saved_at) OVER (ORDER BY batch_id), saved_at) * 1e0 AS gap FROM catalog) WHERE gap IS NOT NULL""", "catalog"))
def batch_gap_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number, mean and greatest of the gaps between batches, with the spans of ids as they are by default."""
    gaps = batch_gaps(parse_batch_names(_batch_names(spark, sf_dir))).where("gap_seconds IS NOT NULL")
    return gaps.agg(rows_as("gaps"), F.round(F.avg("gap_seconds"), 6).alias("mean_gap"), F.max("gap_seconds").alias("widest"))


@query(sql("""SELECT count(*) AS total_batches, min_by(file_name, batch_id) AS first_batch,
                     max_by(file_name, (saved_at, batch_id)) AS latest_batch FROM catalog""", "catalog"))
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog_summary(parse_batch_names(_batch_names(spark, sf_dir)))


@query(sql("""SELECT count(*) AS total_batches, max_by(file_name, (saved_at, batch_id)) AS latest_batch,
                     'batches' AS batch_directory, CAST(9 AS INT) AS models FROM catalog""", "catalog"))
def batch_status_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = batch_status(parse_batch_names(_batch_names(spark, sf_dir)), "batches")
    return status.select("total_batches", "latest_batch", "batch_directory", F.size("models_available").alias("models"))


@query(sql("""SELECT batch_id, count(*) AS lines, round(sum(total_amount), 4) AS revenue
              FROM batched WHERE batch_id < 3 GROUP BY batch_id""", "batched"))
def batches_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_batches(_first_batches(spark, sf_dir, 3, "total_amount"), 3).groupBy("batch_id").agg(rows_as("lines"), revenue())


@query(sql(f"SELECT {oracles.KEYS}, batch_id FROM batched WHERE batch_id = 2", "batched"))
def batches_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_batches(_first_batches(spark, sf_dir, 3), 3, cumulative=False).select(*LINE_KEYS, "batch_id")


@query(sql(f"SELECT {oracles.KEYS}, batch_id FROM batched WHERE batch_id = 0", "batched"))
def batch_minimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_batch_minimal(_first_batches(spark, sf_dir, 1)).select(*LINE_KEYS, "batch_id")


@query(sql(f"SELECT {oracles.KEYS}, fold FROM folded", "folded"))
def fold_thirds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_fold(narrow_lines(spark, sf_dir, *LINE_KEYS, "invoice_date"), "invoice_date").select(*LINE_KEYS, "fold")


@query(sql("\nUNION ALL\n".join(
    f"SELECT CAST({k} AS INT) AS folds, count(*) AS lines, round(sum(total_amount), 4) AS revenue "
    f"FROM folded WHERE fold <= {k}" for k in (1, 2, 3)), "folded"))
def folds_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three nested selections out of one scan: fold f counts for every k >= f."""
    folded = with_fold(narrow_lines(spark, sf_dir, "invoice_date", "total_amount"), "invoice_date")
    per_fold = folded.groupBy("fold").agg(rows_as("n"), F.sum("total_amount").alias("amount"))
    nested = per_fold.withColumn("folds", F.explode(F.sequence(F.col("fold"), F.lit(3))))
    return nested.groupBy("folds").agg(F.sum("n").alias("lines"), F.round(F.sum("amount"), 4).alias("revenue"))


@query(sql("\nUNION ALL\n".join(f"""
    SELECT CAST({k} AS INT) AS windows, count(*) AS lines, round(sum(total_amount), 4) AS revenue
    FROM sales_lines WHERE invoice_date <= (SELECT min(invoice_date) FROM sales_lines)
                                           + to_minutes(CAST({k * YEAR_MINUTES} AS BIGINT))""" for k in (1, 2, 3)),
           "sales_lines"))
def window_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three nested selections out of one scan: window w counts for every k >= w."""
    tagged = with_window(narrow_lines(spark, sf_dir, "invoice_date", "total_amount"), "invoice_date", YEAR_MINUTES)
    per_window = first_windows(tagged, 3).groupBy("window").agg(rows_as("n"), F.sum("total_amount").alias("amount"))
    nested = per_window.withColumn("windows", F.explode(F.sequence(F.col("window"), F.lit(3))))
    return nested.groupBy("windows").agg(F.sum("n").alias("lines"), F.round(F.sum("amount"), 4).alias("revenue"))


@query(sql(f"""SELECT {oracles.KEYS} FROM sales_lines WHERE invoice_date <=
               (SELECT min(invoice_date) FROM sales_lines) + to_minutes(CAST({2 * YEAR_MINUTES} AS BIGINT))""",
           "sales_lines"))
def window_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = narrow_lines(spark, sf_dir, *LINE_KEYS, "invoice_date")
    return first_minutes(lines, "invoice_date", 2, YEAR_MINUTES).select(*LINE_KEYS)


# Label

def _labelled(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Labelled lines of some columns, which include the customer and the amount; the lines are staged, as the label reads them too."""
    lines = narrow_lines(spark, sf_dir, *columns)
    return label_lines(lines, high_value_customers(lines))


@query(sql("SELECT customer_id, round(spend, 4) AS spend, lines, high_value_customer FROM customers", "customers"))
def high_value_customer_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = high_value_customers(sales_lines(spark, sf_dir))
    return customers.withColumn("spend", F.round("spend", 4))


@query(sql(f"SELECT {oracles.KEYS}, customer_id, high_value_customer FROM labelled", "labelled"))
def high_value_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir, *LINE_KEYS, "customer_id", "total_amount").select(*LINE_KEYS, "customer_id", "high_value_customer")


@query(sql("SELECT customer_id, round(spend, 4) AS spend, lines, high_value_customer FROM customers", "customers"))
def incremental_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches entered in a ledger in two steps, the second overlapping copies of the first; the label comes from the ledger alone."""
    root, ledger = staging_path(spark, "ledger-batches"), staging_path(spark, "ledger")
    settings = Settings(batch_format="parquet", batch_size=5000)
    batched = with_batch_id(_published(spark, sf_dir), settings.batch_size, order_by=LINE_KEYS, unique=True)
    # The first fifty of every five thousand are delivered again with the next batch.
    again = batched.where(F.col("l_orderkey") % 100 == 0).withColumn("batch_id", F.col("batch_id") + 1)
    saved = batched.unionByName(again).select(*RECORD.names, "batch_id")
    saved.write.partitionBy("batch_id").parquet(root)
    ids = sorted(r.batch_id for r in list_batches(spark, root).select("batch_id").collect())
    for part in (ids[:len(ids) // 2], ids[len(ids) // 2:]):
        record_batches(spark, root, ledger, part, settings)
    return recorded_customers(spark, ledger).withColumn("spend", F.round("spend", 4))


# Features and metrics

@query(sql(f"""SELECT {oracles.KEYS}, {', '.join(
    f'round({f} / (SELECT stddev_samp({f}) FROM sales_lines), 6) AS scaled_{f}' for f in AMOUNT_FEATURES)}
    FROM sales_lines""", "sales_lines"))
def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = scale_features(narrow_lines(spark, sf_dir, *LINE_KEYS, *AMOUNT_FEATURES), AMOUNT_FEATURES)
    return scaled.select(*LINE_KEYS, *[F.round(f"scaled_{f}", 6).alias(f"scaled_{f}") for f in AMOUNT_FEATURES])


@query(sql("""SELECT quantity_category, lines, (row_number() OVER (ORDER BY lines DESC, quantity_category) - 1) * 1e0 AS label
              FROM (SELECT quantity_category, count(*) AS lines FROM sales_lines GROUP BY 1)""", "sales_lines"))
def label_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexed = label_index(sales_lines(spark, sf_dir), "quantity_category")
    return indexed.groupBy("quantity_category", "label").agg(rows_as("lines"))


@query(sql("""SELECT round(regr_slope(total_amount, quantity), 6) AS slope,
                     round(regr_intercept(total_amount, quantity), 6) AS intercept,
                     round(regr_r2(total_amount, quantity), 8) AS r2 FROM sales_lines""", "sales_lines"))
def ols_quantity_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = least_squares_line(sales_lines(spark, sf_dir), "quantity", "total_amount")
    return line.select(
        F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"), F.round("r2", 8).alias("r2")
    )


@query(sql(f"""
    SELECT count(*) AS rows, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
           round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2
    FROM (SELECT total_amount AS y, {half_up('quantity * price * (CASE WHEN month IN (11, 12) THEN 1.3e0 ELSE 1.0e0 END)'
                                             ' * (CASE WHEN hour BETWEEN 9 AND 17 THEN 1.1e0 ELSE 0.9e0 END)', 2)} AS p
          FROM sales_lines)""", "sales_lines"))
def metrics_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(sales_lines(spark, sf_dir), "amount", 3)
    measured = regression_metrics(scored, "total_amount")
    return measured.select("rows", F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"))


@query(sql("""
    , c AS (SELECT quantity_category AS y,
                   CASE WHEN quantity <= 1 AND total_amount < 10 THEN 'low'
                        WHEN quantity <= 5 AND total_amount < 50 THEN 'medium'
                        WHEN quantity <= 20 AND total_amount < 200 THEN 'high' ELSE 'bulk' END AS p FROM sales_lines),
    f AS (SELECT k, (SELECT count(*) FROM c WHERE y = k) AS support, (SELECT count(*) FROM c WHERE p = k) AS calls,
                 (SELECT count(*) FROM c WHERE y = k AND p = k) AS hits
          FROM (SELECT DISTINCT y AS k FROM c UNION SELECT DISTINCT p FROM c))
    SELECT CAST(sum(support) AS BIGINT) AS rows, round(sum(hits) / sum(support), 8) AS accuracy,
           round(sum(support * 2e0 * hits / (support + calls)) / sum(support), 8) AS f1 FROM f""", "sales_lines"))
def metrics_multiclass(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(sales_lines(spark, sf_dir), "category", 2)
    called = scored.withColumn("called", F.lower("predicted_category"))
    measured = multiclass_metrics(called, "quantity_category", "called")
    return measured.select("rows", F.round("accuracy", 8).alias("accuracy"), F.round("f1", 8).alias("f1"))


@query(sql("""
    , s AS (SELECT total_amount AS score, count(*) FILTER (high_value_customer = 1) AS p, count(*) FILTER (high_value_customer = 0) AS n
            FROM labelled GROUP BY 1),
    r AS (SELECT *, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
    SELECT CAST(sum(p) AS BIGINT) AS positives, CAST(sum(n) AS BIGINT) AS negatives,
           round(sum(p * (below + n / 2e0)) / (sum(p) * 1e0 * sum(n)), 8) AS area_under_roc FROM r""", "labelled"))
def metrics_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = area_under_roc(_labelled(spark, sf_dir, "customer_id", "total_amount"), "high_value_customer", "total_amount")
    return measured.withColumn("area_under_roc", F.round("area_under_roc", 8))


# Rule scores

def _flat(scored: DataFrame) -> DataFrame:
    """Line keys and every answer field, nested parts as columns of their own."""
    columns = []
    for f in scored.schema.fields:
        if isinstance(f.dataType, T.StructType):
            columns += [F.col(f"{f.name}.{part}").alias(part.lower()) for part in f.dataType.names]
        elif isinstance(f.dataType, T.ArrayType):
            columns.append(F.concat_ws(",", f.name).alias(f.name))
        elif f.name not in REQUEST.names:
            columns.append(F.col(f.name))
    return scored.select(*columns)


def _register_scores() -> None:
    makers = {
        "amount": oracles.score_amount, "category": oracles.score_category, "high_value": oracles.score_high_value,
    }
    for family, make in makers.items():
        for version in (1, 2, 3):
            def run(spark: SparkSession, sf_dir: str, family=family, version=version) -> DataFrame:
                requests = sales_lines(spark, sf_dir).select(*LINE_KEYS, *REQUEST.names)
                return _flat(score(requests, family, version))

            run.__name__ = f"score_{family}_v{version}"
            query(make(version))(run)


_register_scores()

_V2 = "quantity * price * (CASE WHEN month IN (11, 12) THEN 1.2e0 ELSE 1.0e0 END)"
_V3 = ("quantity * price * (CASE WHEN month IN (11, 12) THEN 1.3e0 ELSE 1.0e0 END)"
       " * (CASE WHEN hour BETWEEN 9 AND 17 THEN 1.1e0 ELSE 0.9e0 END)")
_COMPARED = (f"SELECT {oracles.KEYS}, CAST(NULL AS VARCHAR) AS error, {half_up('quantity * price', 2)} AS v1, "
             f"{half_up(_V2, 2)} AS v2, {half_up(_V3, 2)} AS v3 FROM sales_lines")


@query(sql(_COMPARED, "sales_lines"))
def compare_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = compare_amount(sales_lines(spark, sf_dir))
    return compared.select(*LINE_KEYS, "error", "v1", "v2", "v3")


@query(sql("\nUNION ALL\n".join(
    f"SELECT {oracles.KEYS}, error, 'v{v}' AS version, v{v} AS prediction FROM ({_COMPARED})" for v in (1, 2, 3)),
           "sales_lines"))
def compare_amounts_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = sales_lines(spark, sf_dir).select(*LINE_KEYS, *AMOUNT_FEATURES)
    return compare_amount_long(requests).select(*LINE_KEYS, "error", "version", "prediction")


@query(sql("""
    SELECT error, count(*) AS requests FROM (
      SELECT CASE WHEN TRY_CAST(quantity AS DOUBLE) IS NULL THEN 'Missing field: quantity'
                  WHEN TRY_CAST(price AS DOUBLE) IS NULL THEN 'Missing field: price'
                  WHEN TRY_CAST(invoicedate AS TIMESTAMP) IS NULL THEN 'Missing field: month' END AS error
      FROM sales_raw) GROUP BY error""", "sales_raw"))
def validate_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = cast_present(sales_raw(spark, sf_dir), _NUMERIC)
    time = F.col("invoicedate").try_cast("timestamp_ntz")
    requests = raw.withColumns({"month": F.month(time), "day": F.dayofmonth(time), "hour": F.hour(time)})
    return validate(requests, "amount").groupBy("error").agg(rows_as("requests"))


@query(sql(f"""SELECT 'linear_model_3' AS model, 0.95e0 AS confidence, CAST(3 AS INT) AS model_version,
                      {half_up(_V3, 2)} AS prediction FROM sales_lines""", "sales_lines"))
def score_json_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as JSON requests, answered in JSON, and the answers read back."""
    lines = sales_lines(spark, sf_dir)
    requests = lines.select(F.to_json(F.struct(*AMOUNT_FEATURES)).alias("value"))
    answers = score_json(requests, "amount", 3)
    parsed = F.from_json("response", "model STRING, confidence DOUBLE, model_version INT, prediction DOUBLE")
    return answers.select(parsed.alias("r")).select("r.*")


def _json_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines as JSON requests, dirt and all; at noon the hour is sent as a word."""
    time = F.col("invoicedate").try_cast("timestamp_ntz")
    hour = F.when((F.col("l_orderkey") % 24 == 12) & time.isNotNull(), "noon").otherwise(F.hour(time).cast("string"))
    body = F.struct("quantity", "price", F.month(time).alias("month"), F.dayofmonth(time).alias("day"), hour.alias("hour"))
    return sales_raw(spark, sf_dir).select(*LINE_KEYS, F.to_json(body).alias("value"))


@query(oracles.request_errors())
def request_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status and error of every request for each version: absent fields, and values that can't be read where the version reads them."""
    requests = stage(_json_requests(spark, sf_dir), "requests")
    answers = [score_json(requests, "amount", v).select(
        F.lit(v).alias("version"), "status", F.get_json_object("response", "$.error").alias("error")) for v in (1, 2, 3)]
    return union_all(answers).groupBy("version", "status", "error").agg(rows_as("requests"))


@query(oracles.compare_requests())
def compare_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests answered by all amount rules at once, and the JSON answers read back."""
    answers = compare_json(_json_requests(spark, sf_dir), keep=LINE_KEYS)
    envelope = "struct<model: string, prediction: double, confidence: double>"
    parts = ", ".join(f"v{v}: {envelope}" for v in (1, 2, 3))
    read = F.from_json("response", f"total_amount_predictions struct<{parts}>, input_data struct<quantity: string, price: string>")
    found = answers.select(*LINE_KEYS, "status", read.alias("r"))
    return found.select(
        *LINE_KEYS, "status", F.col("r.input_data.quantity").alias("input_quantity"), F.col("r.input_data.price").alias("input_price"),
        *[F.col(f"r.total_amount_predictions.v{v}.{part}").alias(name)
          for v in (1, 2, 3) for part, name in (("prediction", f"v{v}"), ("model", f"model_{v}"), ("confidence", f"confidence_{v}"))])


@query(sql(f"""
    SELECT m.model, m.type, CAST(m.version AS INT) AS version, count(l.l_orderkey) AS answered
    FROM (VALUES {", ".join(f"('{stem}_{v}', '{kind}', {v}, {low})" for stem, kind, low in (
        ('linear_model', 'regression', 0), ('rf_model_window', 'classification', 10), ('logistic_model_batch', 'binary_classification', 20))
        for v in (1, 2, 3))}) m(model, type, version, floor_amount)
    LEFT JOIN sales_lines l ON l.total_amount > m.floor_amount GROUP BY 1, 2, 3""", "sales_lines"))
def registry_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The known models, and the lines that each has answered: amounts for all, categories above 10, customers above 20."""
    lines = narrow_lines(spark, sf_dir, *REQUEST.names)
    answers = union_all([
        score(lines.where(F.col("total_amount") > low), family, v).select("model")
        for family, low in (("amount", 0), ("category", 10), ("high_value", 20)) for v in (1, 2, 3)])
    counts = answers.groupBy("model").agg(rows_as("answered"))
    return registry(spark).join(counts, "model", "left").select("model", "type", "version", F.coalesce("answered", F.lit(0)).alias("answered"))


@query(sql("""
    SELECT 'customer_id' AS absent, count(*) AS lines FROM sales_raw
    WHERE coalesce(substr(lower(invoice), 1, 1), '') <> 'c' AND TRY_CAST(quantity AS DOUBLE) > 0 AND TRY_CAST(price AS DOUBLE) > 0
    UNION ALL SELECT 'invoice', count(*) FROM sales_raw
    WHERE customer_id IS NOT NULL AND TRY_CAST(quantity AS DOUBLE) > 0 AND TRY_CAST(price AS DOUBLE) > 0
    UNION ALL SELECT 'invoicedate', count(*) FROM sales_lines
    UNION ALL SELECT 'price', 0 UNION ALL SELECT 'quantity', 0""", "sales_lines"))
def absent_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid lines of the raw table without one of its columns: none without quantity or price, one rule fewer without the others."""
    names = ["invoice", "quantity", "invoicedate", "price", "customer_id"]
    raw = stage(sales_raw(spark, sf_dir).select(*names), "raw")
    counted = [clean(raw.drop(name)).agg(rows_as("lines")).select(F.lit(name).alias("absent"), "lines") for name in names]
    return union_all(counted)


@query(sql("SELECT count(*) AS lines, count(*) AS published, count(*) AS since_start FROM sales_lines", "sales_lines"))
def publish_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that carry a publish time, and one that lies between the start of the job and now."""
    start = F.lit(datetime.now(timezone.utc))
    records = stage(to_record(sales_lines(spark, sf_dir)).select("timestamp"), "records")
    fits = F.col("timestamp").between(start, F.current_timestamp())
    return records.agg(rows_as("lines"), F.count("timestamp").alias("published"), F.count_if(fits).alias("since_start"))


# Training

_TRAINING = {"split_keys": LINE_KEYS, "portable_split": True}


def _results(spark: SparkSession, results: list[training.TrainResult], metrics: dict[str, int]) -> DataFrame:
    table_of = training.results_frame(spark, results)
    return table_of.select(
        "model", "status", "train_rows", "test_rows",
        *[F.round(F.col("metrics")[name], digits).alias(name) for name, digits in metrics.items()],
    )


@query(oracles.train_linear())
def train_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = training.train_incremental(sales_lines(spark, sf_dir), **_TRAINING)
    return _results(spark, results, {"rmse": 4, "r2": 6})


@query()
def train_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = Settings(window_minutes=YEAR_MINUTES)
    results = training.train_time_windows(
        sales_lines(spark, sf_dir), time="invoice_date", settings=settings, **_TRAINING
    )
    return _results(spark, results, {"accuracy": 4, "f1": 4})


@query()
def train_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _results(spark, training.train_batches(_labelled_batches(spark, sf_dir), ids=[0, 1, 2], **_TRAINING), {"area_under_roc": 4})


def _labelled_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three batches, and the label of all customers."""
    lines = narrow_lines(spark, sf_dir, *LINE_KEYS, "customer_id", *FULL_FEATURES)
    batches = stage(first_sorted_batches(lines, 3, Settings().batch_size, LINE_KEYS), "first-batches")
    return label_lines(batches, high_value_customers(lines))


def _first_years(spark: SparkSession, sf_dir: str, years: int) -> tuple[DataFrame, Column]:
    """Training rows of a forest that hold all lines of the first years, and the time of the earliest line; written once, without the later lines.

    Lines have the day of their order, so years counted from a day after the first order end late enough if an order of that day has a valid line.
    If none has, lines may be missing, and the rows are written again up to the right end; where there was no line at all, without an end.
    """
    lines = sales_lines(spark, sf_dir).select(*LINE_KEYS, *FULL_FEATURES, "quantity_category", "invoice_date")
    first, span = F.min("invoice_date"), F.make_dt_interval(mins=F.lit(years * YEAR_MINUTES))

    def known(time: str | None) -> Column:
        return F.lit(time).cast("timestamp_ntz")

    def rows_until(end: Column | None) -> DataFrame:
        wanted = lines if end is None else lines.where(F.col("invoice_date") <= end)
        return training.training_rows(wanted, training.FOREST, carry=["invoice_date"], **_TRAINING)

    first_order = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").cast("string")).first()[0]
    end = known(first_order) + F.make_dt_interval(F.lit(1)) + span
    rows = rows_until(end)
    begin, whole = rows.agg(first.cast("string"), first + span <= end).first()
    if not whole:
        rows = rows_until(None if begin is None else known(begin) + span)
        begin = rows.agg(first.cast("string")).first()[0]
    return rows, known(begin)


@query(oracles.train_forest(YEAR_MINUTES))
def train_forest_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forests on time windows: rows on both sides, whether the trees written as a column give the model's own prediction
    for every row, and whether they are right at least as often as the most frequent band."""
    rows, begin = _first_years(spark, sf_dir, 3)
    checked = []
    for k in (1, 2, 3):
        chosen = first_minutes(rows, "invoice_date", k, YEAR_MINUTES, begin)
        result = training.fit(chosen, training.FOREST, f"rf_model_window_{k}", measured=False)
        both = with_forest_prediction(result.model.transform(chosen), result.model.stages[-1], FULL_FEATURES, "own")
        # One pass answers for all rows whether both agree, and for the test rows how often the model and how often each band is right.
        bands = both.groupBy("split", "quantity_category").agg(
            rows_as("n"), F.count_if(F.col("label") == F.col("prediction")).alias("hits"),
            F.count_if(~F.col("own").eqNullSafe(F.col("prediction"))).alias("apart")).collect()
        tested = [r for r in bands if r.split == TEST]
        checked.append((result.name, result.status, result.train_rows, result.test_rows,
                        sum(r.apart for r in bands) == 0, sum(r.hits for r in tested) >= max(r.n for r in tested)))
    return spark.createDataFrame(checked, "model string, status string, train_rows bigint, test_rows bigint, agrees boolean, beats_majority boolean")


@query(oracles.train_logistic())
def train_logistic_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic models on the first batches: at the optimum the mean chance is the share of the label, and the mean product of each feature
    with the chance is that with the label."""
    rows = training.training_rows(_labelled_batches(spark, sf_dir), training.LOGISTIC, carry=["batch_id"], **_TRAINING)
    target, checked = training.LOGISTIC.target, []
    for k in (1, 2, 3):
        chosen = rows.where(F.col("batch_id") < k)
        result = training.fit(chosen, training.LOGISTIC, f"logistic_model_batch_{k}")
        scored = result.model.transform(chosen.where("split = 'train'"))
        apart = vector_to_array("probability")[1] - F.col(target)
        found = scored.agg(
            F.avg(target).alias("mean"), F.avg(apart).alias("apart"),
            *[(F.avg(apart * F.col(f)) / F.stddev_samp(f)).alias(f) for f in FULL_FEATURES]).first()
        checked.append((result.name, result.status, result.train_rows, result.test_rows, round(found["mean"], 8), abs(found["apart"]) < 1e-3,
                        all(found[f] is None or abs(found[f]) < 1e-3 for f in FULL_FEATURES)))
    return spark.createDataFrame(checked, "model string, status string, train_rows bigint, test_rows bigint, label_mean double, "
                                          "mean_fits boolean, products_fit boolean")


@query(oracles.train_linear("file_rows"))
def train_linear_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three saved record files that overlap: linear models on the first, the first two and all, each record once."""
    root = staging_path(spark, "records")
    wire = stage(to_wire(to_record(sales_lines(spark, sf_dir), published_at=F.lit("2025-05-29").cast("timestamp"))), "wire")
    paths = [f"{root}/part{n}" for n in (1, 2, 3)]
    for path, some in zip(paths, ("month <= 4", "month BETWEEN 3 AND 8", "month >= 8"), strict=True):
        wire.where(some).write.options(**CSV).csv(path)
    results = training.train_files(spark, paths, multi_line=False, split_keys=["invoice", "stock_code"], portable_split=True)
    return _results(spark, results, {"rmse": 4, "r2": 6})


@query(oracles.model_score())
def model_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A linear model trained on all lines, saved, loaded again and applied to every line."""
    lines, model_dir = split_lines(spark, sf_dir, *AMOUNT_FEATURES, "total_amount"), staging_path(spark, "models")
    rows = prepare(lines, training.LINEAR.target, training.LINEAR.features, ["split"])
    training.fit(rows, training.LINEAR, "linear_model_3", training.model_path(model_dir, "amount", 3), measured=False)
    scored = score_with_model(lines, load_model(model_dir, "amount", 3))
    return scored.select(*LINE_KEYS, F.round("prediction", 1).alias("prediction"))


@query(sql(f"SELECT {oracles.KEYS}, TRUE AS answered, TRUE AS agrees, TRUE AS known_label FROM sales_lines", "sales_lines"))
def model_score_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest trained on all lines, saved, loaded again and applied to every line; its trees, written as a column, say the same."""
    lines, model_dir = split_lines(spark, sf_dir, *FULL_FEATURES, "quantity_category"), staging_path(spark, "models")
    rows = prepare(lines, training.FOREST.target, training.FOREST.features, ["split"])
    training.fit(rows, training.FOREST, "rf_model_window_3", training.model_path(model_dir, "category", 3), measured=False)
    model = load_model(model_dir, "category", 3)
    labels = F.lit(list(next(s.labels for s in model.stages if isinstance(s, StringIndexerModel))))
    scored = with_forest_prediction(score_with_model(lines, model), model.stages[-1], FULL_FEATURES, "own")
    return scored.select(
        *LINE_KEYS, F.col("prediction").isNotNull().alias("answered"), F.col("own").eqNullSafe(F.col("prediction")).alias("agrees"),
        F.array_contains(labels, F.col("predicted_label")).alias("known_label"))


@query(sql(f"SELECT {oracles.KEYS}, TRUE AS answered, TRUE AS agrees FROM sales_lines", "sales_lines"))
def model_score_high_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A logistic model trained on all labelled lines, saved, loaded again and applied to every line; its formula, written as a column,
    says the same."""
    lines, model_dir = narrow_lines(spark, sf_dir, *LINE_KEYS, "customer_id", *FULL_FEATURES), staging_path(spark, "models")
    labelled = label_lines(lines, high_value_customers(lines))
    rows = training.training_rows(labelled, training.LOGISTIC, **_TRAINING)
    training.fit(rows, training.LOGISTIC, "logistic_model_batch_3", training.model_path(model_dir, "high_value", 3))
    model = load_model(model_dir, "high_value", 3)
    scored = score_with_model(lines, model).withColumn("own", logistic_chance(model, FULL_FEATURES))
    chance = vector_to_array("probability")[1]
    return scored.select(
        *LINE_KEYS, F.col("prediction").isNotNull().alias("answered"),
        ((F.abs(chance - F.col("own")) < 1e-9) & (F.col("prediction") == (chance > 0.5).cast("double"))).alias("agrees"))


_SKIPS = """
    , firsts AS (SELECT split FROM split_rows WHERE l_orderkey = (SELECT min(l_orderkey) FROM sales_lines))
    SELECT 'none' AS model, 'skipped' AS status, 'no rows' AS reason, 0 AS train_rows, 0 AS test_rows
    UNION ALL SELECT 'few', 'skipped', 'fewer than 10 rows', count(*) FILTER (split = 'train'), count(*) FILTER (split = 'test') FROM firsts
    UNION ALL SELECT 'untrained', 'skipped', 'train split is empty', 0, count(*) FROM split_rows WHERE split = 'test'
    UNION ALL SELECT 'one_class', 'skipped', 'target has one class only', count(*) FILTER (split = 'train'), count(*) FILTER (split = 'test')
    FROM split_rows"""


@query(sql(_SKIPS, "split_rows"))
def training_skips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trainings that are skipped, with the reason: no rows, too few, none to train on, a target of one class."""
    lines = narrow_lines(spark, sf_dir, *LINE_KEYS, *FULL_FEATURES, "quantity_category", "high_value_customer")
    rows = training.training_rows(lines, training.FOREST, carry=["l_orderkey"], **_TRAINING)
    # Before customers are labelled, the target is 0 everywhere.
    unlabelled = training.training_rows(lines, training.LOGISTIC, **_TRAINING)
    first_order = rows.agg(F.min("l_orderkey")).first()[0]
    results = [
        training.fit(rows.where(F.lit(False)), training.FOREST, "none"),
        training.fit(rows.where(F.col("l_orderkey") == first_order), training.FOREST, "few"),
        training.fit(rows.where("split = 'test'"), training.FOREST, "untrained"),
        training.fit(unlabelled, training.LOGISTIC, "one_class"),
    ]
    return training.results_frame(spark, results).select("model", "status", "reason", "train_rows", "test_rows")


@query(sql(f"""
    SELECT 'rf_model_window_1' AS model, 'trained' AS status, TRUE AS within_bound, TRUE AS near_bound
    FROM (SELECT count(*) AS n FROM sales_lines) WHERE n > 0""", "sales_lines"))
def minimal_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimal mode on a first batch that is larger than its bound: all lines as one batch, a quarter of them fitted."""
    lines = narrow_lines(spark, sf_dir, *LINE_KEYS, *FULL_FEATURES, "quantity_category")
    total = lines.count()
    bound = total // 4
    batch = lines.withColumn("batch_id", F.lit(0).cast("bigint"))
    result = training.train_first_batch(batch, settings=Settings(max_fit_rows=bound), **_TRAINING)
    taken, slack = result.train_rows + result.test_rows, 6 * bound ** 0.5
    return spark.createDataFrame(
        [(result.name, result.status, taken <= bound + slack, taken >= bound - slack)],
        "model string, status string, within_bound boolean, near_bound boolean")


_RETRAINED = """
    , t AS (SELECT l_orderkey * 1000000 + l_linenumber * 100000 + l_suppkey % 100000 AS micros FROM sales_lines)
    """ + "\nUNION ALL\n".join(
    f"""SELECT 'rf_model_window_{k}' AS model, 'trained' AS status, count(*) AS rows FROM t
        WHERE micros <= (SELECT min(micros) FROM t) + {k} * 300000000
    UNION ALL SELECT 'logistic_model_batch_{k}', 'trained', count(*) FROM batched WHERE batch_id < {k}""" for k in (1, 2, 3))


@query(sql(_RETRAINED, "batched"))
def retrain_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forests and logistic models trained anew from saved batches and their ledger: the lines that each was given."""
    root, ledger, models = (staging_path(spark, n) for n in ("retrain-batches", "retrain-ledger", "retrain-models"))
    settings = Settings(batch_format="parquet")
    batched = with_batch_id(_published(spark, sf_dir), settings.batch_size, order_by=LINE_KEYS, unique=True)
    batched.select(*RECORD.names, "batch_id").write.partitionBy("batch_id").parquet(root)
    results = training.retrain(spark, root, models, settings=settings, schemes=[training.FOREST, training.LOGISTIC], ledger=ledger)
    return training.results_frame(spark, results).select("model", "status", (F.col("train_rows") + F.col("test_rows")).alias("rows"))


# Streams

@query(sql(f"SELECT {', '.join(PUBLISHED)}, {oracles.KEYS} FROM sales_lines", "sales_lines"))
def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line table read as a stream, joined and cleaned on the way to a parquet table."""
    records = clean_stream(raw_from(line_stream(spark, sf_dir), spark, sf_dir), keep=LINE_KEYS)
    out, checkpoint = staging_path(spark, "stream-clean"), staging_path(spark, "checkpoint")
    write_table(records, out, checkpoint).awaitTermination()
    return spark.read.schema(records.schema).parquet(out).select(*PUBLISHED, *LINE_KEYS)


@query(sql(f"SELECT {', '.join(PUBLISHED)}, {oracles.KEYS} FROM sales_lines", "sales_lines"))
def stream_clean_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line table arriving in files, a third of a half in each micro-batch, joined and cleaned on the way; stopped half-way and gone on with."""
    arrived, out, checkpoint = (staging_path(spark, n) for n in ("arrived-lines", "stream-steps", "checkpoint"))
    lines = spark.read.schema(TABLES["lineitem"]).parquet(f"{sf_dir}/lineitem.parquet")
    # Three micro-batches a half, in files of some three million lines at most, so that no task holds a share of all lines.
    files = 3 * (lines.count() // 18_000_000 + 1)
    for part in range(2):
        # The second half arrives when the first run has ended.
        lines.where(F.pmod(F.xxhash64("l_orderkey"), F.lit(2)) == part).repartition(files).write.mode("append").parquet(arrived)
        stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", files // 3).parquet(arrived)
        records = clean_stream(raw_from(stream, spark, sf_dir), keep=LINE_KEYS)
        write_table(records, out, checkpoint).awaitTermination()
    return spark.read.schema(records.schema).parquet(out).select(*PUBLISHED, *LINE_KEYS)


@query(sql(_PUBLISHED_SQL, "sales_lines"))
def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages read as a stream, saved as CSV batches, and read back."""
    topic, root, checkpoint = (staging_path(spark, n) for n in ("topic", "batches", "checkpoint"))
    write_message_files(to_record(sales_lines(spark, sf_dir)), topic)
    records = read_message_files(spark, topic, files_per_trigger=64).select(*RECORD.names)
    save_batches(records, root, checkpoint, drain=True).awaitTermination()
    return read_batches(spark, root).select(*PUBLISHED)


@query(sql("SELECT count(*) AS lines, round(sum(total_amount), 4) AS revenue FROM sales_lines", "sales_lines"))
def stream_batch_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved batches found by their folders; the rows of the listed ones add up to the input."""
    topic, root, checkpoint = (staging_path(spark, n) for n in ("topic", "batches", "checkpoint"))
    write_message_files(to_record(sales_lines(spark, sf_dir)), topic)
    records = read_message_files(spark, topic).select(*RECORD.names)
    save_batches(records, root, checkpoint, drain=True, settings=Settings(batch_format="parquet")).awaitTermination()
    listed = list_batches(spark, root).select("batch_id")
    saved = read_batches(spark, root, "parquet").join(listed, "batch_id", "left_semi")
    return saved.agg(rows_as("lines"), revenue())


def _micro_batches(spark: SparkSession, path: str, files: int) -> int:
    """Files of a micro-batch: ``files``, or a quarter of all if that is more, so that the number of micro-batches, each of which is
    begun, committed and given its own state, doesn't grow with the data, and all cores have a part of each."""
    return max(files, -(-len(spark.read.text(path).inputFiles()) // 4))


def _topic(spark: SparkSession, sf_dir: str, copies: int = 1) -> str:
    topic = staging_path(spark, "topic")
    lines = sales_lines(spark, sf_dir).select(*CLEAN.names)
    with temporary_stages(spark):
        # Each delivery has its own publish time, but the joins run once for all of them.
        records = to_record(stage(lines, "lines") if copies > 1 else lines)
        for _ in range(copies):
            write_message_files(records, topic)
    return topic


@query(sql("SELECT batch_id, count(*) AS rows FROM batched GROUP BY batch_id", "batched"))
def stream_batch_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages cut into batches of a thousand rows over several micro-batches; the last batch holds what is left over."""
    root, checkpoint, state = (staging_path(spark, n) for n in ("cut-batches", "checkpoint", "state"))
    settings = Settings(batch_format="parquet")
    topic = _topic(spark, sf_dir)
    records = read_message_files(spark, topic, files_per_trigger=_micro_batches(spark, topic, 3)).select(*RECORD.names)
    drain_batches(records, root, checkpoint, state, settings)
    return read_batches(spark, root, "parquet").groupBy("batch_id").agg(rows_as("rows"))


@query(sql("""SELECT count(*) AS rows, round(sum(total_amount), 4) AS amount, min(invoice_date) AS first_sale, max(invoice_date) AS last_sale
              FROM sales_lines""", "sales_lines"))
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was observed of each batch while it was saved, over all batches."""
    root, checkpoint, seen = (staging_path(spark, n) for n in ("seen-batches", "checkpoint", "progress"))
    topic = _topic(spark, sf_dir)
    records = read_message_files(spark, topic, files_per_trigger=_micro_batches(spark, topic, 3)).select(*RECORD.names)
    save_batches(records, root, checkpoint, drain=True, settings=Settings(batch_format="parquet"), progress_path=seen).awaitTermination()
    return read_progress(spark, seen).agg(
        F.max("total_rows").alias("rows"), F.round(F.sum("amount"), 4).alias("amount"), F.min("first_sale").alias("first_sale"), F.max("last_sale").alias("last_sale"))


@query(sql(f"SELECT DISTINCT {', '.join(PUBLISHED)} FROM sales_lines", "sales_lines"))
def stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that were delivered twice, each kept once whatever its publish time."""
    out, checkpoint = staging_path(spark, "stream-distinct"), staging_path(spark, "checkpoint")
    topic = _topic(spark, sf_dir, copies=2)
    records = read_message_files(spark, topic, files_per_trigger=_micro_batches(spark, topic, 6)).select(*RECORD.names)
    once = distinct_rows(records, ignoring=["timestamp"], watermark="1 day")
    # The state has a row for each message of the last day: more than memory holds.
    write_table(once, out, checkpoint, large_state=True).awaitTermination()
    return spark.read.schema(once.schema).parquet(out).select(*PUBLISHED)


@query(sql(_PUBLISHED_SQL, "sales_lines"))
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream whose second batch fails after it was saved, and that goes on from its checkpoint: each message is there once."""
    root, checkpoint = staging_path(spark, "replayed"), staging_path(spark, "checkpoint")
    settings = Settings(batch_format="parquet", batch_seconds=0)
    topic = _topic(spark, sf_dir)
    records = read_message_files(spark, topic, files_per_trigger=_micro_batches(spark, topic, 2)).select(*RECORD.names)

    def fail(_: SparkSession, batch_id: int) -> None:
        if batch_id == 1:
            raise RuntimeError("the second batch fails")

    failed = save_batches(records, root, checkpoint, fail, settings=settings)
    try:
        while failed.isActive and failed.status["isDataAvailable"] | failed.status["isTriggerActive"] | (failed.lastProgress is None):
            failed.awaitTermination(1)
    except StreamingQueryException as error:
        if "the second batch fails" not in str(error):
            raise
    failed.stop()
    save_batches(records, root, checkpoint, drain=True, settings=settings).awaitTermination()
    return read_batches(spark, root, "parquet").select(*PUBLISHED)


_WINDOW_SQL = """
    SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS rows, round(sum(value), 4) AS amount FROM events
    GROUP BY 1, 2 HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY"""


@query(_WINDOW_SQL)
def stream_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in hourly windows of a stream that arrives in five parts; windows are final two days after their end."""
    arrived, out, checkpoint = (staging_path(spark, n) for n in ("events", "windows", "checkpoint"))
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("ts", "event_type", "value")
    ends = events.agg(F.min("ts").alias("begin"), F.max("ts").alias("end")).first()
    step = (ends.end - ends.begin) / 5
    for part in range(5):
        # The parts arrive one after the other, as a stream's files do.
        after, until = ends.begin + part * step, ends.begin + (part + 1) * step
        some = (F.col("ts") >= F.lit(after)) & ((F.col("ts") < F.lit(until)) if part < 4 else F.lit(True))
        events.where(some).coalesce(1).write.mode("append").parquet(arrived)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(arrived)
    totals = window_totals(stream, "ts", "value", "2 days", 60, ["event_type"])
    write_table(totals, out, checkpoint).awaitTermination()
    found = spark.read.schema(totals.schema).parquet(out)
    return found.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "rows", F.round("amount", 4).alias("amount"))
