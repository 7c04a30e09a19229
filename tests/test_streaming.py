import threading
import time

import pytest
from pyspark.sql import functions as F

from txnflow.config import FOREST, LOGISTIC, Settings
from txnflow.operators.label import high_value_customers
from txnflow.plans import queries
from txnflow.plans.queries import _micro_batches
from txnflow.plans.training import TRAINED, retrain
from txnflow.session import stage, temporary_stages
from txnflow.operators.clean import clean
from txnflow.operators.score import score
from txnflow.operators.sets import distinct_rows
from txnflow.schema import RAW, RECORD
from txnflow.sources.catalog import list_batches
from txnflow.sources.files import read_batches, read_raw, read_raw_stream
from txnflow.sources.messages import read_message_files, to_record, write_message_files
from txnflow.sources.ledger import record_batches, record_missing, recorded_customers, recorded_ids, window_ids
from txnflow.streaming.cutting import BatchCutter, drain_batches
from txnflow.streaming.ingest import clean_stream, progress, read_progress, save_batches, write_table
from txnflow.streaming.windows import window_totals

SECONDS = 60


def raw_rows(spark, n=200):
    i = F.col("id")
    return spark.range(0, n, 1, 4).select(
        F.when(i % 10 == 0, F.concat(F.lit("C"), i)).otherwise(i.cast("string")).alias("invoice"),
        F.lit("s").alias("stockcode"), F.lit("d").alias("description"),
        (i % 30).cast("string").alias("quantity"), F.lit("12/1/2009 7:45").alias("invoicedate"),
        F.lit("1.50").alias("price"), (i % 9).cast("string").alias("customer_id"), F.lit("UK").alias("country"),
    )


def rows_of(df):
    return sorted(map(str, df.drop("timestamp", "batch_id").collect()))


def records(spark, tmp_path, **options):
    write_message_files(to_record(clean(raw_rows(spark))), str(tmp_path / "topic"))
    return read_message_files(spark, str(tmp_path / "topic"), **options).select(*RECORD.names)


def test_stream_equals_batch(spark, tmp_path):
    source = str(tmp_path / "raw")
    raw_rows(spark).write.option("header", True).csv(source)
    stream = clean_stream(read_raw_stream(spark, source, RAW.names, files_per_trigger=1))
    query = write_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert query.awaitTermination(SECONDS)
    assert rows_of(spark.read.parquet(str(tmp_path / "out"))) == rows_of(clean(read_raw(spark, source)))
    steps = progress(query)
    assert len(steps) >= 4 and steps[-1]["total_rows"] == 200


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_batches_are_saved_once(spark, tmp_path, fmt):
    settings, root, checkpoint = Settings(batch_format=fmt), str(tmp_path / "b"), str(tmp_path / "cp")
    stream = records(spark, tmp_path, files_per_trigger=1)
    expected = rows_of(clean(raw_rows(spark)))
    for _ in range(2):  # the second run finds nothing new
        assert save_batches(stream, root, checkpoint, drain=True, settings=settings).awaitTermination(SECONDS)
        saved = read_batches(spark, root, fmt)
        assert rows_of(saved) == expected
    assert sorted(r.batch_id for r in list_batches(spark, root).collect()) == [0, 1, 2, 3]
    assert saved.where("timestamp IS NULL").count() == 0


def test_failed_batch_is_replayed_not_doubled(spark, tmp_path):
    root, checkpoint, seen = str(tmp_path / "b"), str(tmp_path / "cp"), []
    stream = records(spark, tmp_path, files_per_trigger=1)

    def fails_once(session, batch_id):
        seen.append(batch_id)
        if len(seen) == 2:
            raise RuntimeError("training failed")

    settings = Settings(batch_seconds=0)
    query = save_batches(stream, root, checkpoint, fails_once, settings=settings)
    with pytest.raises(Exception, match="training failed"):
        query.awaitTermination(SECONDS)
    query = save_batches(stream, root, checkpoint, fails_once, settings=settings)
    query.processAllAvailable()
    query.stop()
    assert seen == [0, 1, 1, 2, 3]
    assert rows_of(read_batches(spark, root)) == rows_of(clean(raw_rows(spark)))


def test_callback_every_second_batch_and_not_while_draining(spark, tmp_path):
    stream = records(spark, tmp_path, files_per_trigger=1)
    seen = []
    query = save_batches(stream, str(tmp_path / "b"), str(tmp_path / "cp"), lambda s, b: seen.append(b),
                         every=2, settings=Settings(batch_seconds=0))
    query.processAllAvailable()
    query.stop()
    assert seen == [1, 3]
    drained = save_batches(stream, str(tmp_path / "b2"), str(tmp_path / "cp2"), lambda s, b: seen.append(b), drain=True)
    assert drained.awaitTermination(SECONDS) and seen == [1, 3]


def test_scores_and_duplicates_on_a_stream(spark, tmp_path):
    stream = records(spark, tmp_path)
    scored = score(stream, "amount", 1)
    assert scored.isStreaming
    with pytest.raises(ValueError, match="watermark"):
        distinct_rows(stream)
    unique = distinct_rows(stream.select("invoice", "timestamp"), ignoring=["timestamp"], watermark="1 hour")
    assert write_table(unique, str(tmp_path / "u"), str(tmp_path / "cpu")).awaitTermination(SECONDS)
    found = spark.read.parquet(str(tmp_path / "u"))
    assert found.count() == clean(raw_rows(spark)).select("invoice").distinct().count()


def test_retrain_after_a_batch(spark, tmp_path):
    rows = raw_rows(spark, 400).withColumn("price", (F.col("quantity") + F.length("invoice") * 2).cast("string"))
    write_message_files(to_record(clean(rows)), str(tmp_path / "topic"))
    stream = read_message_files(spark, str(tmp_path / "topic"), files_per_trigger=1).select(*RECORD.names)
    root, models, runs = str(tmp_path / "b"), str(tmp_path / "m"), []
    settings = Settings(batch_seconds=0)
    query = save_batches(stream, root, str(tmp_path / "cp"), settings=settings, every=4,
                         on_batch=lambda s, b: runs.append(retrain(s, root, models, b, settings)))
    query.processAllAvailable()
    query.stop()
    assert len(runs) == 1 and [r.name for r in runs[0]] == [
        *[f"linear_model_{k}" for k in (1, 2, 3)], *[f"rf_model_window_{k}" for k in (1, 2, 3)],
        *[f"logistic_model_batch_{k}" for k in (1, 2, 3)],
    ]
    assert all(r.status == TRAINED for r in runs[0][:6])
    assert (tmp_path / "m" / "linear_model_3" / "batch_id=3").is_dir()


def wire_rows(spark, n, first=0):
    rows = spark.range(first, first + n, 1, 2).select(
        F.col("id").cast("string").alias("invoice"), F.lit(1.0).alias("total_amount"), F.lit("2020-01-01").cast("timestamp_ntz").alias("invoice_date"))
    return to_record(rows)


def sizes(spark, root):
    return {r.batch_id: r["count"] for r in read_batches(spark, root, "parquet").groupBy("batch_id").count().collect()}


def test_cut_batches_by_count_and_time(spark, tmp_path):
    now, closed = [1000.0], []
    settings = Settings(batch_format="parquet", batch_size=10, batch_seconds=60)
    make = lambda: BatchCutter(spark, str(tmp_path / "b"), str(tmp_path / "s"), settings, lambda s, b: closed.append(b), lambda: now[0])
    make().cut(wire_rows(spark, 25), 0)
    assert sizes(spark, str(tmp_path / "b")) == {0: 10, 1: 10} and closed == [0, 1]
    now[0] += 30
    make().cut(wire_rows(spark, 3, 25), 1)  # neither full nor old enough
    assert sizes(spark, str(tmp_path / "b")) == {0: 10, 1: 10}
    now[0] += 30
    make().cut(wire_rows(spark, 4, 28), 2)  # a minute after the oldest row that waits: 8 + 4 rows
    assert sizes(spark, str(tmp_path / "b")) == {0: 10, 1: 10, 2: 10, 3: 2}
    make().cut(wire_rows(spark, 0), 3)
    make().cut(wire_rows(spark, 7, 32), 4)
    make().close(4, wire_rows(spark, 0))
    make().close(4, wire_rows(spark, 0))
    assert sizes(spark, str(tmp_path / "b")) == {0: 10, 1: 10, 2: 10, 3: 2, 4: 7} and closed == [0, 1, 2, 3, 4]
    make().cut(wire_rows(spark, 10, 39), 5)
    saved = read_batches(spark, str(tmp_path / "b"), "parquet")
    assert sorted(int(r.invoice) for r in saved.collect()) == list(range(49)) and saved.select("batch_id").distinct().count() == 6


def test_a_replayed_cut_writes_the_same_batches(spark, tmp_path):
    settings = Settings(batch_format="parquet", batch_size=10, batch_seconds=10**9)
    cutter = BatchCutter(spark, str(tmp_path / "b"), str(tmp_path / "s"), settings)
    cutter.cut(wire_rows(spark, 17), 0)
    before = cutter._remember

    def fails(*args):
        raise RuntimeError("lost driver")

    cutter._remember = fails
    with pytest.raises(RuntimeError, match="lost driver"):
        cutter.cut(wire_rows(spark, 18, 17), 1)  # the batches are written, the state is not
    cutter._remember = before
    cutter.cut(wire_rows(spark, 18, 17), 1)
    assert sizes(spark, str(tmp_path / "b")) == {0: 10, 1: 10, 2: 10}
    cutter.close(1, wire_rows(spark, 0))
    rows = read_batches(spark, str(tmp_path / "b"), "parquet").collect()
    assert sorted(int(r.invoice) for r in rows) == list(range(35))


def test_stream_of_batches_cut_and_closed(spark, tmp_path):
    settings = Settings(batch_format="parquet", batch_size=50, batch_seconds=10**9)
    root, checkpoint, state = (str(tmp_path / n) for n in ("b", "cp", "s"))
    total = clean(raw_rows(spark)).count()
    stream = records(spark, tmp_path, files_per_trigger=1)
    assert drain_batches(stream, root, checkpoint, state, settings) == -(-total // 50)
    assert sorted(sizes(spark, root).values()) == sorted([50] * (total // 50) + [total % 50] * (total % 50 > 0))
    # Nothing new: nothing is written, and the last batch is not closed again.
    assert drain_batches(stream, root, checkpoint, state, settings) == -(-total // 50)
    assert rows_of(read_batches(spark, root, "parquet")) == rows_of(clean(raw_rows(spark)))


def test_progress_is_observed_and_empty_batches_leave_nothing(spark, tmp_path):
    root, seen = str(tmp_path / "b"), str(tmp_path / "seen")
    stream = records(spark, tmp_path, files_per_trigger=1)
    assert save_batches(stream, root, str(tmp_path / "cp"), drain=True, progress_path=seen).awaitTermination(SECONDS)
    rows = read_progress(spark, seen).orderBy("batch_id").collect()
    expected = clean(raw_rows(spark))
    assert rows[-1].total_rows == expected.count() == sum(r.rows for r in rows)
    assert round(sum(r.amount for r in rows), 6) == round(expected.agg(F.sum("total_amount")).first()[0], 6)
    none = stream.where("invoice = 'none such'")
    assert save_batches(none, str(tmp_path / "b0"), str(tmp_path / "cp0"), drain=True).awaitTermination(SECONDS)
    assert list_batches(spark, str(tmp_path)).where("batch_id IS NULL").count() == 0 and not list((tmp_path / "b0").glob("batch_id=*"))


def test_salt_of_stream_duplicates_is_in_the_record(spark, tmp_path):
    stream = records(spark, tmp_path)
    once = distinct_rows(stream, ignoring=["timestamp"], watermark="1 day", salts=4)
    plan = once._jdf.queryExecution().analyzed().toString()
    assert "xxhash64(timestamp" in plan and "SPARK_PARTITION_ID" not in plan.upper()


def test_window_totals_on_a_batch(spark):
    rows = spark.createDataFrame([("2020-01-01 00:01:00", 1.0), ("2020-01-01 00:04:59", 2.0), ("2020-01-01 00:05:00", 4.0)], "at string, v double")
    found = window_totals(rows.withColumn("at", F.col("at").cast("timestamp_ntz")), "at", "v", "1 hour", 5).orderBy("window_start").collect()
    assert [(r.rows, r.amount) for r in found] == [(2, 3.0), (1, 4.0)]


def test_retrain_by_ledger_opens_only_what_it_needs(spark, tmp_path):
    root, ledger = str(tmp_path / "b"), str(tmp_path / "l")
    settings = Settings(batch_format="parquet", window_minutes=1)
    base = to_record(clean(raw_rows(spark, 600)), published_at=F.timestamp_seconds(F.lit(1_700_000_000) + F.regexp_extract("invoice", r"\d+", 0).cast("int")))
    saved = base.withColumn("batch_id", F.expr("CAST(regexp_extract(invoice, '[0-9]+', 0) AS BIGINT) div 60"))
    again = saved.where("batch_id = 4").withColumn("batch_id", F.lit(5).cast("bigint"))
    saved.unionByName(again).write.partitionBy("batch_id").parquet(root)
    record_batches(spark, root, ledger, [0, 1, 2, 3], settings)
    assert record_missing(spark, root, ledger, settings) == [4, 5, 6, 7, 8, 9] and record_missing(spark, root, ledger, settings) == []
    record_batches(spark, root, ledger, [4, 5], settings)  # once more changes nothing
    whole = {r.customer_id: (round(r.spend, 4), r.lines, r.high_value_customer) for r in high_value_customers(base).collect()}
    assert {r.customer_id: (round(r.spend, 4), r.lines, r.high_value_customer) for r in recorded_customers(spark, ledger).collect()} == whole
    assert window_ids(spark, ledger, 3 * settings.window_minutes) == [0, 1, 2, 3]
    # Saved batches that are not wanted may even be gone.
    for number in range(5, 10):
        for file in (tmp_path / "b" / f"batch_id={number}").iterdir():
            file.unlink()
    results = retrain(spark, root, str(tmp_path / "m"), 9, settings, [FOREST, LOGISTIC], ledger)
    assert [r.name for r in results][:3] == [f"rf_model_window_{k}" for k in (1, 2, 3)] and results[0].status == TRAINED
    assert results[2].train_rows + results[2].test_rows == base.where("timestamp <= timestamp_seconds(1700000001 + 180)").count()
    one = retrain(spark, root, str(tmp_path / "m"), None, settings, [FOREST], ledger, minimal=True)
    assert [r.train_rows + r.test_rows for r in one] == [saved.where("batch_id = 0").count()]


def test_jobs_side_by_side_keep_their_stages(spark):
    outer = []

    def job():
        with temporary_stages(spark):
            outer.append(stage(spark.range(3), "theirs"))
            done.wait(60)
            outer.append(outer[0].count())

    done, started = threading.Event(), threading.Thread(target=job)
    with temporary_stages(spark) as scope:
        started.start()
        while not outer:
            time.sleep(0.05)
        mine, kept = stage(spark.range(2), "mine"), scope.result(spark.range(4), "kept")
        assert mine.count() == 2
        scope.release("mine")
        assert not [p for p in scope.paths if "mine" in p]
    done.set()
    started.join(60)
    assert outer[1] == 3 and kept.count() == 4


def test_ledger_files_do_not_grow_with_batches_and_one_is_replaced(spark, tmp_path):
    root, ledger, settings = str(tmp_path / "b"), str(tmp_path / "l"), Settings(batch_format="parquet")

    def save(ids, amount):
        rows = spark.range(0, 1, 1, 1).select(F.explode(F.lit([int(n) for n in ids])).alias("batch_id")).withColumn("customer_id", F.explode(F.lit(["a", "b"])))
        saved = to_record(rows.withColumns({"total_amount": F.lit(amount), "invoice": F.col("batch_id").cast("string")}), keep=["batch_id"])
        saved.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(root)

    save([*range(40), 1000], 1.0)
    record_batches(spark, root, ledger, list(range(40)), settings)
    record_batches(spark, root, ledger, [1000], settings)
    files = {kind: len(list((tmp_path / "l" / kind).rglob("*.parquet"))) for kind in ("spend", "ranges")}
    assert files == {"spend": 2, "ranges": 2}
    save([7], 5.0)
    record_batches(spark, root, ledger, [7], settings)
    found = {r.customer_id: (r.spend, r.lines) for r in recorded_customers(spark, ledger).collect()}
    assert found == {"a": (45.0, 41), "b": (45.0, 41)}
    assert recorded_ids(spark, ledger) == [*range(40), 1000]


def test_state_of_stream_duplicates_is_a_digest_that_tells_rows_apart(spark, tmp_path):
    schema = "a string, b string, at timestamp_ntz, timestamp timestamp"
    rows = [(a, b, at, "2020-01-01 00:00:00") for at in ("2020-01-01 00:00:00.000001", "2020-01-01 00:00:00.000002")
            for a, b in (("x", None), (None, "x"), ("x", ""), ("", "x"), ("null", "x"), ('x","c1":"', None))]
    frame = spark.createDataFrame(rows * 2, "a string, b string, at string, timestamp string").select(
        "a", "b", F.col("at").cast("timestamp_ntz"), F.col("timestamp").cast("timestamp"))
    frame.write.parquet(str(tmp_path / "in"))
    once = distinct_rows(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), ignoring=["timestamp"], watermark="1 day")
    assert once.columns == ["a", "b", "at", "timestamp"]
    assert "DeduplicateWithinWatermark [_digest" in once._jdf.queryExecution().analyzed().toString()
    assert write_table(once, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(SECONDS)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)


def test_micro_batches_do_not_grow_in_number(spark, tmp_path):
    spark.range(0, 40, 1, 40).selectExpr("string(id) AS value").write.text(str(tmp_path / "many"))
    spark.range(0, 4, 1, 4).selectExpr("string(id) AS value").write.text(str(tmp_path / "few"))
    assert _micro_batches(spark, str(tmp_path / "many"), 3) == 10 and _micro_batches(spark, str(tmp_path / "few"), 3) == 3


def test_large_state_is_on_disk_and_goes_on_after_a_restart(spark, tmp_path):
    provider = "spark.sql.streaming.stateStore.providerClass"
    before, out, checkpoint = spark.conf.get(provider), str(tmp_path / "out"), str(tmp_path / "cp")
    rows = spark.range(0, 300, 1, 3).select(F.nullif(F.col("id") % 100, F.lit(7)).alias("a"), F.timestamp_seconds(F.col("id")).alias("timestamp"))
    for _ in range(2):  # the second run gets all of the first once more, and one row that is new
        rows.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = write_table(distinct_rows(stream, ignoring=["timestamp"], watermark="1 day"), out, checkpoint, large_state=True)
        assert spark.conf.get(provider) == before
        assert query.awaitTermination(SECONDS)
        rows = rows.unionByName(spark.createDataFrame([(1000, None)], "a long, timestamp timestamp").withColumn("timestamp", F.timestamp_seconds(F.lit(400))))
    assert sorted((r.a is None, r.a or 0) for r in spark.read.parquet(out).collect()) == [*[(False, n) for n in range(100) if n != 7], (False, 1000), (True, 0)]
    assert all("RocksDBStateStoreProvider" in (tmp_path / "cp" / "offsets" / str(n)).read_text() for n in range(3))
    assert list((tmp_path / "cp" / "state").rglob("*.changelog"))


def test_messages_delivered_twice_are_joined_once(spark, tmp_path, monkeypatch):
    once = clean(raw_rows(spark)).withColumn("invoice", F.expr("uuid()"))
    monkeypatch.setattr(queries, "sales_lines", lambda *_: once)
    topic = queries._topic(spark, str(tmp_path), copies=2)
    sent = spark.read.schema("key string, value string").json(topic).select(F.from_json("value", "invoice string, timestamp string").alias("v")).select("v.*")
    found = sent.groupBy("invoice").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("timestamp").alias("times")).collect()
    assert len(found) == once.count() and {(r.n, r.times) for r in found} == {(2, 2)}
