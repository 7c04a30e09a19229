import datetime as dt
import random
from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings as hypothesis_settings, strategies as st
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator,
)
from pyspark.sql import functions as F

from txnflow.operators.features import (
    fill_features, keep_present, prepare, target_values, with_time,
)
from txnflow.operators.label import customer_spend, high_value_customers, label_lines
from txnflow.operators.metrics import area_under_roc, multiclass_metrics, regression_metrics
from txnflow.operators.numbering import in_order, with_batch_id, with_row_index
from txnflow.operators.quantiles import quantile_cont, quantiles_disc
from txnflow.operators.selection import (
    batch_ids, first_batch_minimal, first_batches, first_folds, first_minutes, first_windows, with_fold, with_window,
)
from txnflow.operators.sets import distinct_rows, union_all, union_distinct
from txnflow.operators.split import count_by_split, with_split
from txnflow.operators.standard import label_index, least_squares_line, scale_features
from txnflow.session import stage


def numbers(spark, values, kind="DOUBLE"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


# Numbering

@pytest.mark.parametrize("unique", [True, False])
def test_row_index_is_dense_and_ordered(spark, unique):
    values = random.Random(1).sample(range(100_000), 5000)
    df = numbers(spark, values, "INT").repartition(7)
    found = {r.x: r.row_index for r in with_row_index(df, ["x"], unique).collect()}
    assert found == {x: i for i, x in enumerate(sorted(values))}


def test_row_index_with_a_hot_key(spark):
    rows = [(1, i % 4) for i in range(2000)] + [(i, 0) for i in range(2, 3000)]
    df = spark.createDataFrame(rows, "k INT, v INT").repartition(5)
    found = with_row_index(df, ["k"]).collect()
    assert sorted(r.row_index for r in found) == list(range(len(rows)))
    assert [r.k for r in sorted(found, key=lambda r: r.row_index)] == sorted(k for k, _ in rows)


def test_copies_of_one_row_are_spread(spark):
    df = spark.range(20_000).select(F.lit(7).alias("k")).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = in_order(df, ["k"]).groupBy("_task").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < 20_000


def test_batches_have_exact_size(spark):
    df = numbers(spark, range(1234), "INT").repartition(3)
    sizes = Counter(r.batch_id for r in with_batch_id(df, 100, ["x"], unique=True).collect())
    assert sizes == {**{i: 100 for i in range(12)}, 12: 34}


def test_arrival_order(spark):
    df = spark.range(0, 1000, 1, 4)
    assert with_batch_id(df, 10).where("batch_id <> floor(id / 10)").count() == 0


def test_empty_input(spark):
    assert with_batch_id(numbers(spark, []), 10, ["x"]).count() == 0


# Quantiles

def disc(values, f):
    ordered = sorted(values)
    return ordered[max(1, -(-f.numerator * len(ordered) // f.denominator)) - 1]


@hypothesis_settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.one_of(st.just(3.5), st.floats(-1e6, 1e6)), min_size=1, max_size=60),
    st.sampled_from([Fraction(1, 3), Fraction(2, 3), Fraction(1, 100), Fraction(1)]),
)
def test_disc_equals_sorting(spark, values, fraction):
    df = numbers(spark, values)
    for small in (1_000_000, 3):
        cut = quantiles_disc(df, "x", [fraction], small=small, accuracy=20)[0]
        assert df.select(cut.alias("c")).first().c == disc(values, fraction)


def test_narrowing_with_a_hot_value(spark):
    values = [5.0] * 700 + [random.Random(2).uniform(0, 10) for _ in range(1400)]
    df = numbers(spark, values)
    for f in (Fraction(1, 10), Fraction(1, 3), Fraction(1, 2), Fraction(9, 10)):
        cut = quantiles_disc(df, "x", [f], small=5, accuracy=50)[0]
        assert df.select(cut.alias("c")).first().c == disc(values, f)


def test_cont_equals_percentile(spark):
    values = [random.Random(3).gauss(0, 100) for _ in range(999)]
    df = numbers(spark, values)
    exact = df.select(F.percentile("x", 0.8)).first()[0]
    assert quantile_cont(df, "x", 0.8) == pytest.approx(exact, rel=1e-12)
    assert quantile_cont(df, "x", 0.8, small=10, accuracy=50) == pytest.approx(exact, rel=1e-12)
    assert quantile_cont(df.where("false"), "x", 0.8) is None


# Selections

def lines_in_time(spark, n=300):
    start = dt.datetime(2025, 1, 1)
    rows = [(i, start + dt.timedelta(seconds=7 * i)) for i in range(n)] + [(n, None)]
    return spark.createDataFrame(rows, "i INT, t TIMESTAMP_NTZ")


def test_folds_nest(spark):
    folded = with_fold(lines_in_time(spark), "t").cache()
    sizes = {r.fold: r["count"] for r in folded.groupBy("fold").count().collect()}
    assert sizes == {1: 100, 2: 100, 3: 101}
    kept = [{r.i for r in first_folds(folded, k).collect()} for k in (1, 2, 3)]
    assert kept[0] < kept[1] < kept[2] and len(kept[2]) == 301
    assert with_fold(lines_in_time(spark, 0), "t").first().fold == 3


def test_first_minutes_includes_the_end(spark):
    rows = [(0, dt.datetime(2025, 1, 1)), (1, dt.datetime(2025, 1, 1, 0, 5)), (2, dt.datetime(2025, 1, 1, 0, 5, 1))]
    df = spark.createDataFrame(rows, "i INT, t TIMESTAMP")
    assert [r.i for r in first_minutes(df, "t").orderBy("i").collect()] == [0, 1]
    assert first_minutes(df, "t", windows=2).count() == 3
    windows = with_window(df.union(spark.createDataFrame([(3, None)], df.schema)), "t")
    assert [r.window for r in windows.orderBy("i").collect()] == [1, 1, 2, None]
    assert first_windows(windows, 1).count() == 2 and first_windows(windows, 3).count() == 3


def test_batch_selection(spark):
    df = spark.createDataFrame([(i, b) for i, b in enumerate([10, 2, 2, 100, 7])], "i INT, batch_id BIGINT")
    assert batch_ids(df, 3) == [2, 7, 10]
    assert first_batches(df, 2).count() == 3
    assert [r.batch_id for r in first_batches(df, 2, cumulative=False).collect()] == [7]
    assert first_batch_minimal(df).count() == 2
    assert [r.batch_id for r in first_batches(df, 1, ids=[100]).collect()] == [100]
    with pytest.raises(ValueError, match="only 4"):
        first_batches(df, 5)


# Split, sets, features

def test_split_ignores_partitioning(spark):
    df = spark.range(5000).withColumn("s", F.col("id").cast("string"))
    for portable in (False, True):
        a = {r.id for r in with_split(df, ["id"], portable=portable).where("split = 'train'").collect()}
        b = {r.id for r in with_split(df.repartition(3), ["id"], portable=portable).where("split = 'train'").collect()}
        assert a == b and 0.77 < len(a) / 5000 < 0.83
        other = with_split(df, ["id"], seed=1, portable=portable)
        assert {r.id for r in other.where("split = 'train'").collect()} != a
    counts = {r.split: r.lines for r in count_by_split(with_split(df)).collect()}
    assert sum(counts.values()) == 5000 and set(counts) == {"train", "test"}


def test_unions(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "n INT, s STRING")
    b = spark.createDataFrame([("x", 1), ("z", 3)], "s STRING, n INT")
    assert union_all([a, b]).count() == 5
    assert sorted((r.n, r.s) for r in union_distinct([a, b]).collect()) == [(1, "x"), (2, "y"), (3, "z")]
    assert distinct_rows(a.withColumn("at", F.monotonically_increasing_id()), ignoring=["at"]).count() == 2
    with pytest.raises(Exception):
        union_all([a, b.withColumnRenamed("n", "m")]).count()
    with pytest.raises(ValueError):
        union_all([])


def test_feature_preparation(spark):
    df = spark.createDataFrame([(None, 1, 2.0), (3.0, None, None)], "q DOUBLE, m INT, t DOUBLE")
    rows = prepare(df, "t", ["q", "m", "absent"]).collect()
    assert [(r.t, r.q, r.m) for r in rows] == [(2.0, 0.0, 1.0)]
    assert fill_features(df.where("q IS NULL"), ["q"]).first().q == 0.0
    assert keep_present(df, ["q", "z"]).columns == ["q"]
    for call in (lambda: prepare(df, "z", ["q"]), lambda: prepare(df, "t", ["z"]), lambda: keep_present(df, ["q"], ["z"])):
        with pytest.raises(ValueError):
            call()


def test_target_values(spark):
    row = target_values(numbers(spark, [0, 1, 1, 2, None], "INT"), "x").first()
    assert (row.zeros, row.ones, row.other, row.nulls, row.is_binary) == (1, 2, 1, 1, False)


def test_time_column(spark):
    df = spark.createDataFrame([("2025-05-29T14:21:37",), ("bad",)], "timestamp STRING")
    times = [r.timestamp_col for r in with_time(df).collect()]
    assert times[0] is not None and times[1] is None
    assert with_time(df.drop("timestamp").withColumn("a", F.lit(1))).where("timestamp_col IS NULL").count() == 0


# Label

def sales(spark, hot=0):
    rng = random.Random(5)
    rows = [(str(rng.randrange(200)), rng.uniform(1, 100), 0) for _ in range(2000)]
    rows += [("hot", 1.0, 0)] * hot
    return spark.createDataFrame(rows, "customer_id STRING, total_amount DOUBLE, high_value_customer INT")


@pytest.mark.parametrize("hot,share", [(0, 10_000), (0, 5), (1500, 5)])
def test_label_on_every_line(spark, hot, share, monkeypatch):
    # A share of 5 with 200 customers takes the ways of large customer tables.
    monkeypatch.setattr("txnflow.operators.label.HOT_SHARE", share)
    lines = sales(spark, hot)
    spend = {r.customer_id: r.spend for r in customer_spend(lines).collect()}
    customers = high_value_customers(lines)
    cut = sorted(spend.values())
    position = 0.8 * (len(cut) - 1)
    limit = cut[int(position)] + (cut[int(position) + 1] - cut[int(position)]) * (position % 1)
    labelled = label_lines(lines, customers)
    assert labelled.columns == lines.columns
    rows = labelled.collect()
    assert len(rows) == 2000 + hot
    assert all(r.high_value_customer == int(spend[r.customer_id] > limit) for r in rows)


def test_fixed_threshold_and_unknown_customers(spark):
    customers = high_value_customers(sales(spark), threshold=0.0)
    assert customers.where("high_value_customer = 0").count() == 0
    extra = spark.createDataFrame([("nobody", 1.0)], "customer_id STRING, total_amount DOUBLE")
    assert label_lines(extra, customers).first().high_value_customer == 0


# Metrics

def test_metrics_equal_the_evaluators(spark):
    rng = random.Random(4)
    rows = [(rng.choice([0.0, 1.0, 2.0]), rng.choice([0.0, 1.0, 3.0]), rng.random()) for _ in range(500)]
    df = spark.createDataFrame(rows, "label DOUBLE, prediction DOUBLE, score DOUBLE")
    mine = regression_metrics(df, "label").first()
    for name in ("rmse", "r2"):
        assert mine[name] == pytest.approx(RegressionEvaluator(labelCol="label", metricName=name).evaluate(df))
    mine = multiclass_metrics(df, "label").first()
    for name in ("accuracy", "f1"):
        theirs = MulticlassClassificationEvaluator(labelCol="label", metricName=name).evaluate(df)
        assert mine[name] == pytest.approx(theirs)


def test_area_under_roc(spark):
    rng = random.Random(6)
    rows = [(rng.randrange(2), round(rng.random(), 2)) for _ in range(400)] + [(1, 0.5)] * 200
    df = spark.createDataFrame(rows, "y INT, s DOUBLE").repartition(5)
    wins = sum((a > b) + (a == b) / 2 for ya, a in rows if ya for yb, b in rows if not yb)
    pairs = sum(y for y, _ in rows) * sum(1 - y for y, _ in rows)
    found = area_under_roc(df, "y", "s").first().area_under_roc
    assert found == pytest.approx(wins / pairs, rel=1e-12)
    theirs = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="s", numBins=0).evaluate(df)
    assert found == pytest.approx(theirs)
    assert area_under_roc(df.where("y = 1"), "y", "s").first().area_under_roc is None


def test_standard_stages(spark):
    df = spark.createDataFrame([(1.0, 2.0, "b"), (2.0, 4.0, "a"), (4.0, 8.0, "a")], "x DOUBLE, y DOUBLE, c STRING")
    deviation = df.select(F.stddev_samp("x")).first()[0]
    assert scale_features(df, ["x", "y"]).first().scaled_x == pytest.approx(1.0 / deviation)
    assert {(r.c, r.label) for r in label_index(df, "c").collect()} == {("a", 0.0), ("b", 1.0)}
    line = least_squares_line(df, "x", "y").first()
    assert (line.slope, line.r2) == pytest.approx((2.0, 1.0))


# Session helpers

def test_stage_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "n INT, s STRING")
    staged = stage(df)
    assert staged.schema == df.schema and sorted(staged.collect()) == sorted(df.collect())


def test_a_constant_target_has_no_r2(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y DOUBLE, prediction DOUBLE")
    row = regression_metrics(df, "y").first()
    assert row.rmse == pytest.approx(0.5 ** 0.5) and row.r2 is None
    assert regression_metrics(df.where("false"), "y").first().rmse is None


def test_lines_without_a_customer_are_labelled_zero(spark):
    rows = [("a", 10.0, 0), (None, 500.0, 0), (None, 700.0, 0), ("b", 1.0, 0)]
    lines = spark.createDataFrame(rows, "customer_id STRING, total_amount DOUBLE, high_value_customer INT")
    customers = high_value_customers(lines)
    assert customers.count() == 2
    got = sorted((r.customer_id or "", r.high_value_customer) for r in label_lines(lines, customers).collect())
    assert got == [("", 0), ("", 0), ("a", 1), ("b", 0)]
