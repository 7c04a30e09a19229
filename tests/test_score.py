import json

import pytest
from pyspark.sql import functions as F

from txnflow.operators.requests import read_requests
from txnflow.operators.score import (
    compare_amount, compare_amount_long, compare_answers, compare_json, score, score_json, validate,
)
from txnflow.plans import queries
from txnflow.schema import REQUEST

AMOUNT = (5.0, 15.50, None, 12, 15, 14)
CATEGORY = (8.0, 12.75, 102.0, 11, 20, 15)
HIGH_VALUE = (3.0, 25.0, 75.0, 12, 10, 16)


def request(spark, *rows):
    return spark.createDataFrame(list(rows), REQUEST)


def test_amount_examples(spark):
    rows = [score(request(spark, AMOUNT), "amount", v).first() for v in (1, 2, 3)]
    assert [r.prediction for r in rows] == [77.5, 93.0, 110.83]
    assert [r.confidence for r in rows] == [0.85, 0.91, 0.95]
    assert [r.model for r in rows] == ["linear_model_1", "linear_model_2", "linear_model_3"]
    assert (rows[2].seasonal_adjustment, rows[2].hourly_adjustment, rows[2].model_version) == (1.3, 1.1, 3)
    assert rows[0].features_used == ["quantity", "price", "month", "day", "hour"]


def test_amount_off_season(spark):
    row = score(request(spark, (2.0, 10.0, None, 6, 1, 18)), "amount", 3).first()
    assert (row.prediction, row.seasonal_adjustment, row.hourly_adjustment) == (18.0, 1.0, 0.9)


def test_category_examples(spark):
    rows = [score(request(spark, CATEGORY), "category", v).first() for v in (1, 2, 3)]
    assert [(r.predicted_category, r.confidence) for r in rows] == [("High", 0.85), ("High", 0.90), ("High", 0.95)]
    assert rows[2].temporal_adjustments.adjusted_quantity == 10.56
    assert rows[1].amount_threshold_used is True
    assert rows[0].probabilities.asDict() == {"Low": 0.2, "Medium": 0.3, "High": 0.85, "Bulk": 0.2}


@pytest.mark.parametrize("version,quantity,amount,expected", [
    (1, 1.0, 999.0, "Low"), (1, 5.0, 0.0, "Medium"), (1, 20.0, 0.0, "High"), (1, 20.1, 0.0, "Bulk"),
    (2, 1.0, 9.99, "Low"), (2, 1.0, 10.0, "Medium"), (2, 5.0, 50.0, "High"), (2, 20.0, 200.0, "Bulk"),
    (3, 1.0, 11.0, "Low"), (3, 1.0, 12.0, "Medium"), (3, 24.0, 239.0, "High"), (3, 30.0, 1.0, "Bulk"),
])
def test_category_edges(spark, version, quantity, amount, expected):
    row = score(request(spark, (quantity, 1.0, amount, 6, 1, 20)), "category", version).first()
    assert row.predicted_category == expected


def test_high_value_examples(spark):
    rows = [score(request(spark, HIGH_VALUE), "high_value", v).first() for v in (1, 2, 3)]
    assert [r.is_high_value_customer for r in rows] == [True, True, True]
    assert [r.probability for r in rows] == [0.75, 0.786, 0.9]
    assert rows[1].score_components.asDict() == {"base_score": 1.0, "quantity_bonus": 0.3, "final_score": 1.3}
    assert rows[2].score_components.final_score == 2.2
    assert (rows[0].threshold_used, rows[2].threshold) == (50.0, 0.45)


def test_high_value_clamps(spark):
    rows = score(request(spark, (1.0, 1.0, 50.0, 1, 1, 1), (1.0, 1.0, 1.0, 1, 1, 1), (1.0, 1.0, 500.0, 1, 1, 1)),
                 "high_value", 1).collect()
    assert [(r.is_high_value_customer, r.probability) for r in rows] == [(False, 0.5), (False, 0.05), (True, 0.95)]


def test_missing_fields_are_named_in_order(spark):
    rows = score(request(spark, (None, None, 1.0, 1, 1, 1), (1.0, 1.0, None, 1, 1, 1)), "category", 2).collect()
    assert [r.error for r in rows] == ["Missing field: quantity", "Missing field: total_amount"]
    assert rows[0].predicted_category is None and rows[0].model is None
    without = request(spark, AMOUNT).drop("hour")
    assert score(without, "amount", 1).first().error == "Missing field: hour"
    assert validate(request(spark, AMOUNT), "amount").first().error is None


def test_noise_is_seeded_and_off_by_default(spark):
    requests = request(spark, *[AMOUNT] * 200)
    plain = {r.prediction for r in score(requests, "amount", 1).collect()}
    first, again = ([r.prediction for r in score(requests, "amount", 1, noise_seed=3).collect()] for _ in range(2))
    assert plain == {77.5} and first == again and len(set(first)) > 100
    assert abs(sum(first) / 200 - 77.5) < 3


def test_comparison(spark):
    row = compare_amount(request(spark, AMOUNT)).first()
    assert (row.v1, row.v2, row.v3, row.error) == (77.5, 93.0, 110.83, None)
    bad = compare_amount_long(request(spark, (None, 1.0, 1.0, 1, 1, 1))).collect()
    assert {(r.version, r.prediction, r.error) for r in bad} == {
        (v, None, "Missing field: quantity") for v in ("v1", "v2", "v3")
    }


def test_json_requests(spark):
    body = {"quantity": 5, "price": "15.50", "month": 12, "day": 15, "hour": 14}
    df = spark.createDataFrame([(json.dumps(body),), ('{"quantity": 5}',)], "value STRING")
    answers = [json.loads(r.response) for r in score_json(df, "amount", 3).collect()]
    assert answers[0]["prediction"] == 110.83 and answers[0]["model"] == "linear_model_3"
    assert answers[1] == {"error": "Missing field: price"}


def test_bad_calls(spark):
    with pytest.raises(ValueError):
        score(request(spark, AMOUNT), "amount", 4)
    with pytest.raises(ValueError, match="already"):
        score(request(spark, AMOUNT).withColumn("prediction", F.lit(1)), "amount", 1)


BODY = {"quantity": 5, "price": "15.50", "month": 12, "day": 15, "hour": 14}


@pytest.mark.parametrize("changes,version,status,error", [
    ({"price": "cheap"}, 1, 500, "could not convert string to float: 'cheap'"),
    ({"price": "it's"}, 1, 500, 'could not convert string to float: "it\'s"'),
    ({"quantity": None}, 1, 500, "float() argument must be a string or a real number, not 'NoneType'"),
    ({"quantity": [5]}, 1, 500, "float() argument must be a string or a real number, not 'list'"),
    ({"month": "12.5"}, 2, 500, "invalid literal for int() with base 10: '12.5'"),
    ({"hour": {}}, 3, 500, "int() argument must be a string, a bytes-like object or a real number, not 'dict'"),
    # What a version does not compute with may hold anything.
    ({"month": "12.5", "hour": None, "day": "x"}, 1, 200, None),
    ({"hour": "noon"}, 2, 200, None),
    ({"month": 12.9, "quantity": True}, 3, 200, None),
    ({"price": " 1e1 ", "month": " 12 "}, 3, 200, None),
])
def test_values_that_cannot_be_read(spark, changes, version, status, error):
    df = spark.createDataFrame([(json.dumps({**BODY, **changes}),)], "value STRING")
    row = score_json(df, "amount", version).first()
    answer = json.loads(row.response)
    assert (row.status, answer.get("error")) == (status, error)
    assert (error is None) == ("prediction" in answer)


def test_requests_that_are_no_objects(spark):
    texts = ["", "{", "[1]", "7", "null", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id INT, value STRING")
    found = {r.id: (r.status, json.loads(r.response)["error"]) for r in score_json(df, "amount", 1, keep=["id"]).collect()}
    broken, missing = (500, "unreadable request"), (400, "Missing field: quantity")
    assert found == {0: broken, 1: broken, 2: missing, 3: missing, 4: missing, 5: broken}


def test_whole_answers_of_the_comparison(spark):
    row = compare_answers(request(spark, AMOUNT, (None, 1.0, 1.0, 1, 1, 1))).collect()
    assert row[0].v3.asDict() == {
        "model": "linear_model_3", "prediction": 110.83, "confidence": 0.95, "seasonal_adjustment": 1.3, "hourly_adjustment": 1.1,
        "features_used": ["quantity", "price", "month", "day", "hour"], "model_version": 3}
    assert (row[0].v1.confidence, row[0].v2.prediction, row[0].error) == (0.85, 93.0, None)
    assert (row[1].v1, row[1].v2, row[1].v3, row[1].error) == (None, None, None, "Missing field: quantity")
    with pytest.raises(ValueError, match="already"):
        compare_answers(request(spark, AMOUNT).withColumn("v1", F.lit(1)))


def test_comparison_of_json_requests(spark):
    bodies = [BODY, {**BODY, "hour": "noon"}, {"price": 1}]
    df = spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(bodies)] + [(3, "{")], "id INT, value STRING")
    at = F.lit("2025-05-29 01:02:03").cast("timestamp")
    found = {r.id: (r.status, json.loads(r.response)) for r in compare_json(df, at=at, keep=["id"]).collect()}
    whole = found[0][1]
    assert list(whole) == ["total_amount_predictions", "comparison_timestamp", "input_data"]
    assert [whole["total_amount_predictions"][f"v{v}"]["prediction"] for v in (1, 2, 3)] == [77.5, 93.0, 110.83]
    assert whole["comparison_timestamp"].startswith("2025-05-29T01:02:03") and whole["input_data"] == BODY
    assert sorted(found[1][1]["total_amount_predictions"]) == ["v1", "v2"]
    assert found[2][1]["total_amount_predictions"] == {} and found[2][0] == 200
    assert found[3] == (500, {"error": "unreadable request"})


def test_fields_of_a_request_are_looked_up_once(spark):
    """Type and text of a field are columns, not repeated in every expression that asks for them."""
    df = spark.createDataFrame([('{"quantity": 1}',)], "value STRING")
    for answers in (score_json(df, "amount", 3), compare_json(df)):
        plan = answers._jdf.queryExecution().optimizedPlan().toString()
        assert 0 < plan.count("schemaOfVariant(") <= 5


def test_plain_numbers_of_a_request_are_read_without_its_variant(spark):
    plain = '{"quantity":5.0,"price":15.5,"month":12,"day":15,"hour":14}'
    texts = [plain, plain.replace("12", '"12"'), plain.replace("5.0", "-0.0"), plain[:-1] + ',"hour":9}', plain + "x", plain.replace("15.5", "1e999")]
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, value STRING")
    kinds = {r.id: (r._kind_quantity, r._text_quantity, r.quantity) for r in read_requests(df, keep=["id"]).collect()}
    assert kinds[0] == ("NUMBER", None, 5.0)
    assert [kinds[i][2] for i in range(1, 6)] == [5.0, 0.0, None, 5.0, 5.0] and str(kinds[2][2]) == "0.0"
    order = spark.createDataFrame([('{"price":1.5,"quantity":2}',), ('{"quantity":2,"price":1.5}',), ('{"quantity":2,}',), ('{"quantity":2 }',), ("{}",)], "value STRING")
    assert [(r.readable, r._text_quantity, r.quantity) for r in read_requests(order).collect()] == [
        (True, "2", 2.0), (True, None, 2.0), (False, None, None), (True, "2", 2.0), (True, None, None)]
    found = {r.id: (r.status, json.loads(r.response).get("prediction")) for r in score_json(df, "amount", 3, keep=["id"]).collect()}
    assert found == {0: (200, 110.83), 1: (200, 110.83), 2: (200, 0.0), 3: (500, None), 4: (200, 110.83), 5: (200, "Infinity")}


def test_queries_keep_generated_code_compiled_in_any_session(spark):
    def probe(session, sf_dir):
        return session.range(1)

    limit = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(limit, "65535")
    try:
        queries.query()(probe)
        assert queries.QUERIES["probe"](spark, "").count() == 1 and spark.conf.get(limit) == "8000"
    finally:
        queries.QUERIES.pop("probe")
        spark.conf.set(limit, "8000")
