"""Command line: ``python -m txnflow <job> ...``, or the same file under spark-submit."""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession

from txnflow.config import DEFAULTS, FOREST, LINEAR, LOGISTIC, Settings
from txnflow.operators.clean import clean
from txnflow.operators.score import REQUIRED, compare_json, score_json
from txnflow.plans.training import results_frame, retrain
from txnflow.schema import RECORD
from txnflow.session import build_session
from txnflow.sources.catalog import batch_status, list_batches
from txnflow.sources.files import read_raw
from txnflow.sources.messages import (
    read_kafka, read_message_files, to_record, write_kafka, write_message_files,
)
from txnflow.sources.registry import VERSIONS
from txnflow.streaming.cutting import cut_batches, drain_batches
from txnflow.streaming.ingest import save_batches

SCHEMES = {"linear": LINEAR, "forest": FOREST, "logistic": LOGISTIC}


def _publish(spark: SparkSession, args: argparse.Namespace, settings: Settings) -> None:
    records = to_record(clean(read_raw(spark, args.raw, settings), settings))
    if args.topic_dir:
        write_message_files(records, args.topic_dir)
    else:
        write_kafka(records, settings)


def _ingest(spark: SparkSession, args: argparse.Namespace, settings: Settings) -> None:
    source = read_message_files(spark, args.topic_dir) if args.topic_dir else read_kafka(spark, settings)

    def train(session: SparkSession, batch_id: int) -> None:
        retrain(session, args.batch_dir, args.model_dir, batch_id, settings, ledger=args.ledger_dir)

    if args.state_dir:
        on_batch = train if args.model_dir and not args.drain else None
        if args.drain:
            drain_batches(source.select(*RECORD.names), args.batch_dir, args.checkpoint_dir, args.state_dir, settings)
        else:
            cut_batches(source.select(*RECORD.names), args.batch_dir, args.checkpoint_dir, args.state_dir, False, settings, on_batch).awaitTermination()
        return

    save_batches(
        source.select(*RECORD.names), args.batch_dir, args.checkpoint_dir, train if args.model_dir else None,
        args.every, args.drain, settings,
    ).awaitTermination()


def _train(spark: SparkSession, args: argparse.Namespace, settings: Settings) -> None:
    schemes = [SCHEMES[name] for name in args.models]
    results = retrain(spark, args.batch_dir, args.model_dir, None, settings, schemes, args.ledger_dir, args.minimal, not args.single_batches)
    results_frame(spark, results).show(truncate=False)


def _score(spark: SparkSession, args: argparse.Namespace, settings: Settings) -> None:
    score_json(spark.read.text(args.requests), args.family, args.version).write.json(args.out)


def _compare(spark: SparkSession, args: argparse.Namespace, settings: Settings) -> None:
    compare_json(spark.read.text(args.requests)).write.json(args.out)


def _status(spark: SparkSession, args: argparse.Namespace, settings: Settings) -> None:
    batch_status(list_batches(spark, args.batch_dir), args.batch_dir).show(truncate=False)


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="txnflow", description="Sales-transaction pipeline on Spark.")
    root.add_argument("--batch-format", default=DEFAULTS.batch_format, choices=["csv", "parquet"])
    jobs = root.add_subparsers(required=True)

    def job(name, run, text, *positional):
        sub = jobs.add_parser(name, help=text)
        sub.set_defaults(run=run)
        for argument in positional:
            sub.add_argument(argument)
        return sub

    publish = job("publish", _publish, "clean a raw CSV and publish it to Kafka or to message files", "raw")
    publish.add_argument("--topic-dir")
    ingest = job("ingest", _ingest, "save messages as batches, optionally retraining", "batch_dir", "checkpoint_dir")
    ingest.add_argument("--topic-dir")
    ingest.add_argument("--model-dir")
    ingest.add_argument("--every", type=int, default=1)
    ingest.add_argument("--drain", action="store_true")
    ingest.add_argument("--state-dir", help="cut batches of a fixed number of rows; what is left over is kept here")
    ingest.add_argument("--ledger-dir", help="keep what retraining needs of each batch here")
    train = job("train", _train, "train models on the saved batches", "batch_dir", "model_dir")
    train.add_argument("--models", nargs="+", choices=list(SCHEMES), default=list(SCHEMES))
    train.add_argument("--ledger-dir")
    train.add_argument("--minimal", action="store_true", help="one forest, on the first batch alone")
    train.add_argument("--single-batches", action="store_true", help="a logistic model on each of the first batches alone")
    train.add_argument("--window-minutes", type=int, default=DEFAULTS.window_minutes)
    answer = job("score", _score, "answer JSON requests, one per line", "requests", "out")
    answer.add_argument("--family", choices=list(REQUIRED), required=True)
    answer.add_argument("--version", type=int, choices=VERSIONS, required=True)
    job("compare", _compare, "answer JSON requests, one per line, by all amount rules at once", "requests", "out")
    job("status", _status, "describe the saved batches", "batch_dir")
    return root


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    settings = replace(
        DEFAULTS, batch_format=args.batch_format,
        window_minutes=getattr(args, "window_minutes", DEFAULTS.window_minutes),
    )
    args.run(build_session(), args, settings)


if __name__ == "__main__":
    main()
