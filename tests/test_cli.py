import json

import pytest

from txnflow.__main__ import main, parser


def test_pipeline_from_raw_file_to_status(spark, tmp_path, capsys):
    header = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
    lines = [f"{i},s,d,{i % 30 + 1},12/1/2009 7:45,{i % 7 + 1}.5,{i % 9},UK\n" for i in range(120)]
    (tmp_path / "raw.csv").write_text(header + "".join(lines))
    at = lambda name: str(tmp_path / name)
    main(["publish", at("raw.csv"), "--topic-dir", at("topic")])
    main(["ingest", at("batches"), at("cp"), "--topic-dir", at("topic"), "--drain"])
    main(["train", at("batches"), at("models"), "--models", "linear"])
    assert (tmp_path / "models" / "linear_model_3").is_dir()
    capsys.readouterr()
    main(["status", at("batches")])
    assert "batch_0_" in capsys.readouterr().out


def test_score_requests(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"quantity": 5, "price": 15.5, "month": 12, "day": 15, "hour": 14}\n')
    main(["score", str(tmp_path / "in.json"), str(tmp_path / "out"), "--family", "amount", "--version", "2"])
    answer = json.loads(spark.read.json(str(tmp_path / "out")).first().response)
    assert (answer["prediction"], answer["seasonal_adjustment"]) == (93.0, 1.2)


def test_compare_requests(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"quantity": 5, "price": 15.5, "month": 12, "day": 15, "hour": "noon"}\n')
    main(["compare", str(tmp_path / "in.json"), str(tmp_path / "out")])
    row = spark.read.json(str(tmp_path / "out")).first()
    answer = json.loads(row.response)
    assert row.status == 200 and answer["input_data"]["hour"] == "noon"
    assert {v: a["prediction"] for v, a in answer["total_amount_predictions"].items()} == {"v1": 77.5, "v2": 93.0}


def test_unknown_arguments():
    with pytest.raises(SystemExit):
        parser().parse_args(["score", "a", "b", "--family", "amount", "--version", "9"])
