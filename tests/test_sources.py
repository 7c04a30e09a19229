import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from txnflow.config import Settings
from txnflow.operators.clean import clean
from txnflow.schema import RAW, RECORD
from txnflow.session import keep_compiled
from txnflow.sources.catalog import (
    batch_gaps, batch_status, catalog_summary, list_batches, parse_batch_names, read_manifest,
)
from txnflow.sources.files import batch_id_of, existing_paths, read_batches, read_raw, read_record_files
from txnflow.sources.messages import (
    decode_messages, encode_messages, kafka_sink_options, kafka_source_options, to_record, write_kafka,
)
from txnflow.sources.registry import MODEL_NAMES, model_name, model_path, registry


def record(spark, **changes):
    row = dict(
        invoice="1", stockcode="s", description="d", quantity="2", invoicedate="12/1/2009 7:45",
        price="1.50", customer_id="9", country="UK",
    )
    row.update(changes)
    return to_record(clean(spark.createDataFrame([tuple(row[n] for n in RAW.names)], RAW)))


def test_raw_csv(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_bytes(
        "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
        "1,s,Café,3,12/1/2009 7:45,2.5,7,UK\n2,s,,3,12/1/2009 7:45,2.5,NA,UK\n".encode("latin-1")
    )
    raw = read_raw(spark, str(path))
    assert raw.columns == RAW.names and {f.dataType.typeName() for f in raw.schema} == {"string"}
    first, second = raw.orderBy("invoice").collect()
    assert first.description == "Café"
    assert (second.description, second.customer_id) == (None, None)
    assert clean(raw).count() == 1


def test_differing_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a\n2,1\n")
    with pytest.raises(Exception, match="header"):
        read_raw(spark, str(tmp_path)).collect()


def test_record_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("quantity,price,timestamp\n1,2.0,2025-05-29T14:21:37.123456\n")
    (tmp_path / "b.csv").write_text("price,quantity\nx,3\n")
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv", "none.csv")]
    assert existing_paths(spark, paths) == paths[:2]
    rows = read_record_files(spark, paths).orderBy("quantity").collect()
    assert [(r.quantity, r.price) for r in rows] == [(1.0, 2.0), (3.0, None)]
    assert rows[0].timestamp.microsecond == 123456
    assert read_record_files(spark, paths[2:]) is None


def test_message_round_trip(spark):
    messages = encode_messages(record(spark))
    sent = messages.first()
    body = json.loads(sent.value)
    assert sent.key == "9" and list(body) == RECORD.names
    assert (body["invoice_date"], body["quantity"]) == ("2009-12-01T07:45:00", 2.0)
    back = decode_messages(messages.select(F.col("key").cast("binary"), F.col("value").cast("binary"))).first()
    assert back.message_key == "9" and back.total_amount == 3.0
    assert back.invoice_date == dt.datetime(2009, 12, 1, 7, 45)
    assert json.loads(encode_messages(record(spark, invoicedate="bad")).first().value)["invoice_date"] is None


def test_bad_messages_are_skipped(spark):
    values = [None, "", "{oops", "null", '{"invoice": "1", "description": NaN, "quantity": 2.0}']
    rows = decode_messages(spark.createDataFrame([(v,) for v in values], "value STRING")).collect()
    assert [(r.invoice, r.description, r.quantity) for r in rows] == [("1", None, 2.0)]


def test_record_defaults(spark):
    row = to_record(spark.createDataFrame([("1",)], "invoice STRING")).first()
    assert (row.country, row.quantity, row.month, row.quantity_category) == ("", 0.0, 0, "unknown")
    assert row.invoice_date is None and row.timestamp is not None


def test_kafka_options(spark):
    settings = Settings(batch_size=50, batch_seconds=5)
    source = kafka_source_options(settings)
    assert source["startingOffsets"] == "earliest" and source["maxTriggerDelay"] == "5s"
    assert source["minOffsetsPerTrigger"] == "50" and source["maxOffsetsPerTrigger"] == "1000000"
    sink = kafka_sink_options(settings)
    assert (sink["topic"], sink["kafka.acks"], sink["kafka.retries"]) == ("retail_data_stream", "all", "3")
    with pytest.raises(Exception, match="kafka"):
        write_kafka(record(spark))


def names(spark, ids):
    start = dt.datetime(2025, 5, 29, 14, 0)
    texts = [f"batch_{i}_{start + dt.timedelta(seconds=60 * i + i % 7):%Y%m%d_%H%M%S}.csv" for i in ids]
    return spark.createDataFrame([(t,) for t in [*texts, "notes.txt"]], "value STRING")


def test_catalog_in_numeric_order(spark, tmp_path):
    catalog = parse_batch_names(names(spark, [100, 0, 10, 2, 1]))
    assert [r.batch_id for r in catalog.orderBy("batch_id").collect()] == [0, 1, 2, 10, 100]
    summary = catalog_summary(catalog).first()
    assert summary.total_batches == 5
    assert summary.first_batch.startswith("batch_0_") and summary.latest_batch.startswith("batch_100_")
    status = batch_status(catalog, "/data").first()
    assert status.models_available == list(MODEL_NAMES) and status.batch_directory == "/data"
    (tmp_path / "list.txt").write_text("batch_3_20250529_142137.csv\nother\n")
    row = read_manifest(spark, str(tmp_path / "list.txt")).first()
    assert (row.batch_id, row.saved_at) == (3, dt.datetime(2025, 5, 29, 14, 21, 37))


@pytest.mark.parametrize("span", [1, 3, 1000])
def test_gaps_equal_a_plain_lag(spark, span):
    ids = [0, 1, 2, 3, 7, 8, 20, 21, 22, 40]
    found = batch_gaps(parse_batch_names(names(spark, ids)), span).orderBy("batch_id").collect()
    at = {i: 60 * i + i % 7 for i in ids}
    assert [r.gap_seconds for r in found] == [None] + [float(at[b] - at[a]) for a, b in zip(ids, ids[1:])]


def test_listing_both_layouts(spark, tmp_path):
    (tmp_path / "batch_12_20250529_142137.csv").write_text("invoice\n1\n")
    (tmp_path / "batch_id=3").mkdir()
    (tmp_path / "batch_id=3" / "part-0.csv").write_text("invoice\n1\n")
    rows = list_batches(spark, str(tmp_path)).orderBy("batch_id").collect()
    assert [(r.batch_id, r.files) for r in rows] == [(3, 1), (12, 1)]
    assert rows[1].file_name == "batch_12_20250529_142137.csv"


def test_named_batches(spark, tmp_path):
    header = ",".join(RECORD.names)
    for i in (0, 10):
        (tmp_path / f"batch_{i}_20250529_142137.csv").write_text(
            f"{header}\n{i},s,d,1.0,2009-12-01T07:45:00,2.0,9,UK,2.0,12,1,7,low,0,2025-05-29T14:21:37\n"
        )
    rows = read_batches(spark, str(tmp_path)).orderBy("batch_id").collect()
    assert [(r.batch_id, r.invoice, r.total_amount) for r in rows] == [(0, "0", 2.0), (10, "10", 2.0)]


def test_batches_of_both_layouts_by_id(spark, tmp_path):
    header, row = ",".join(RECORD.names), "{},s,d,1.0,2009-12-01T07:45:00,2.0,9,UK,2.0,12,1,7,low,0,2025-05-29T14:21:37\n"
    root = tmp_path / "batch_3" / "saved"
    root.mkdir(parents=True)
    (root / "batch_7_20250529_142137.csv").write_text(header + "\n" + row.format(7))
    (root / "batch_id=12").mkdir()
    (root / "batch_id=12" / "part-0.csv").write_text(header + "\n" + row.format(12))
    (root / "notes.csv").write_text(header + "\n" + row.format(99))
    # A file that isn't wanted isn't opened: its header would be an error.
    (root / "batch_8_20250529_142137.csv").write_text("other\n1\n")
    assert [(r.batch_id, r.invoice) for r in read_batches(spark, str(root), ids=[7, 12, 40]).orderBy("batch_id").collect()] == [(7, "7"), (12, "12")]
    assert read_batches(spark, str(root), ids=[40]).collect() == [] and read_batches(spark, str(root), ids=[40]).columns[-1] == "batch_id"
    assert sorted(r.batch_id for r in list_batches(spark, str(root)).collect()) == [7, 8, 12]


def test_folders_of_many_batches_are_listed_in_few_tasks(spark, tmp_path):
    header, row = ",".join(RECORD.names), "{},s,d,1.0,2009-12-01T07:45:00,2.0,9,UK,2.0,12,1,7,low,0,2025-05-29T14:21:37\n"
    for i in range(100):
        folder = tmp_path / f"batch_id={i}"
        folder.mkdir()
        (folder / "part-0.csv").write_text(header + "\n" + row.format(i))
    keep_compiled(spark)
    spark.sparkContext.setJobGroup("listing-test", "listing")
    try:
        saved = read_batches(spark, str(tmp_path), multi_line=False)
        tracker = spark.sparkContext.statusTracker()
        stages = [stage for job in tracker.getJobIdsForGroup("listing-test") for stage in tracker.getJobInfo(job).stageIds]
        tasks = [info.numTasks for info in map(tracker.getStageInfo, stages) if info]
    finally:
        for name in ("spark.jobGroup.id", "spark.job.description"):
            spark.sparkContext.setLocalProperty(name, None)
    assert tasks and max(tasks) <= 64
    assert [(r.batch_id, r.invoice) for r in saved.orderBy("batch_id").collect()] == [(i, str(i)) for i in range(100)]


def test_a_path_is_looked_at_once_for_its_batch(spark, tmp_path):
    (tmp_path / "batch_1_20250529_142137.csv").write_text(",".join(RECORD.names) + "\n")
    plan = read_batches(spark, str(tmp_path)).where("batch_id > 0")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") == 1
    paths = ["/a/batch_id=3/p", "/a/batch_id=3", "/a/batch_7_20250529_142137.csv", "/a/f=batch_8_20250529_142137.csv/p", "/batch_7_20250529_142137.csv/batch_id=3/p",
             "/batch_3/p", "/a/batch_7_20250529_142137.csvx", "/a/batch_id=x/p", "/a/batch_7_20250529_142137.csv/p/q", "/a/xbatch_id=4/p"]
    found = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i INT, p STRING").select("i", batch_id_of("p").alias("b")).orderBy("i").collect()
    assert [r.b for r in found] == [3, None, 7, 8, 3, None, None, None, None, None]


def test_many_record_files_and_their_headers(spark, tmp_path):
    names = list(RECORD.names)
    for i in range(60):
        order = names[i % 3:] + names[:i % 3]
        (tmp_path / f"r{i}.csv").write_text(",".join(order) + "\n" + ",".join(str(i) if n == "invoice" else "" for n in order) + "\n")
    paths = [str(tmp_path / f"r{i}.csv") for i in range(60)]
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    table = read_record_files(spark, [*paths, str(tmp_path / "none.csv")])
    # Headers are read without a job, and files with one header are one scan.
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == len(before)
    assert sorted(int(r.invoice) for r in table.collect()) == list(range(60))
    numbered = read_record_files(spark, [str(tmp_path / "none.csv"), paths[5]], number="fold")
    assert [(r.invoice, r.fold) for r in numbered.collect()] == [("5", 2)]


def test_registry(spark):
    assert registry(spark).count() == 9
    assert model_name("category", 2) == "rf_model_window_2"
    assert model_path("/m", "amount", 1, 7) == "/m/linear_model_1/batch_id=7"
    with pytest.raises(ValueError):
        model_name("amount", 4)


def test_quoted_fields_are_read_as_written(spark, tmp_path):
    """Doubled quotes, commas and line breaks, as pandas writes them."""
    import pandas as pd

    texts = ['A "B", C', "two\nlines", 'SIGN "X"', "plain", "back\\slash"]
    frame = pd.DataFrame({
        "Invoice": [str(i) for i in range(5)], "StockCode": "s", "Description": texts, "Quantity": 1,
        "InvoiceDate": "2020-01-02 03:04:05", "Price": 2.5, "Customer ID": "7", "Country": "X",
    })
    frame.to_csv(tmp_path / "raw.csv", index=False, encoding="ISO-8859-1")
    rows = clean(read_raw(spark, str(tmp_path / "raw.csv"))).select("invoice", "description").collect()
    assert {r.invoice: r.description for r in rows} == {str(i): text for i, text in enumerate(texts)}


def test_odd_messages_are_read_as_text(spark):
    whole = '{"invoice":"1","quantity":4.0,"price":2.5,"total_amount":10.0,"month":4,"day":5,"hour":6,"high_value_customer":0}'
    values = [whole, whole.replace("4.0", '"4.0"'), whole.replace("4.0", "NaN"), whole.replace('"month":4', '"month":4.0'),
              whole.replace('"quantity":4.0', '"quantity":4.0,"quantity":"x"'), whole[:30], "", '{"other": 1}', "[1]", '{"invoice":"NaN"}']
    frame = spark.createDataFrame(list(enumerate(values)), "key int, value string")
    decoded = decode_messages(frame)
    found = {int(r.message_key): (r.invoice, str(r.quantity), r.month) for r in decoded.collect()}
    assert {k: found[k] for k in range(5)} == {0: ("1", "4.0", 4), 1: ("1", "4.0", 4), 2: ("1", found[2][1], 4), 3: ("1", "4.0", 4), 4: ("1", "None", 4)}
    assert not {6, 7, 8} & set(found) and found[9] == (None, "None", None)
    # A message that sends its numbers as numbers is read as such.
    assert "StructField(quantity,DoubleType" in decoded._jdf.queryExecution().optimizedPlan().toString()
