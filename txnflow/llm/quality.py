"""Quality classifier by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are documents labelled good; everything else is unlabelled web text, bad and good mixed. With the share of good
text among it, the class prior, the risk on bad text is what unlabelled text has beyond the part that positives explain;
where this estimate falls below zero, the model has begun to fit noise and the step goes back (non-negative risk).

* Features of a text are computed once from the whole text and staged as ``len(FEATURES)`` small numbers a document: rates of
  character classes and of their transitions, of each ASCII mark, and how much words and lines repeat. Labels, language, source
  and id are not among them.
* The model is fitted on at most about ``sample_rows`` positives and as many unlabelled documents, chosen by a hash: the
  documented bound of the sample. Only labels of the training fold are read, and only positive ones.
* The class prior is estimated over all documents: classifiers of positives against unlabelled text, one for each half of the
  documents and fitted on the other half, order them; of any upper part of that order, unlabelled text holds at least the prior
  times what positives hold, so the least ratio bounds the prior. The histograms are grouped aggregations of ``BINS`` rows.

Defined results: null and empty texts have zero features and a score like others; rows that repeat an id are scored one by one;
documents with a null id are not held out and never positives; without any positive label every score is the given ``default``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.llm.common import ship_package, slices, text_or_empty
from txnflow.session import stage

BINS = 1000

CLASSES = ("lower", "upper", "digit", "blank", "break", "sentence", "mark", "other")
MARKS = [c for c in map(chr, range(33, 127)) if not c.isalnum()]
FEATURES = (*[f"{a}-{b}" for a in CLASSES for b in CLASSES], *MARKS,
            "length", "distinct words", "most frequent word", "word length", "distinct lines", "line length")


def _byte_classes() -> np.ndarray:
    table = np.full(256, CLASSES.index("other"), np.uint8)
    for code in range(128):
        c = chr(code)
        kind = ("lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "break" if c == "\n"
                else "blank" if c.isspace() else "sentence" if c in ".,;:'?!" else "mark" if c in MARKS else "other")
        table[code] = CLASSES.index(kind)
    return table


def features(texts: pa.Array) -> np.ndarray:
    """A row of features for each text; rates enter as square roots, so that rare marks count too."""
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    n, size = len(texts), np.diff(ends)
    owner = np.repeat(np.arange(n), size)
    kind = _byte_classes()[data].astype(np.int64)
    inside = owner[:-1] == owner[1:]
    pairs = np.bincount((owner[:-1] * 64 + kind[:-1] * 8 + kind[1:])[inside], minlength=64 * n).reshape(n, 64)
    lut = np.full(256, -1, np.int64)
    lut[[ord(c) for c in MARKS]] = np.arange(len(MARKS))
    mark = lut[data]
    found = mark >= 0
    marks = np.bincount(owner[found] * len(MARKS) + mark[found], minlength=len(MARKS) * n).reshape(n, len(MARKS))
    rates = np.sqrt(np.concatenate([pairs, marks], axis=1) / np.maximum(size, 1)[:, None])
    rest = np.zeros((n, 6))
    for i, text in enumerate(texts.to_numpy(zero_copy_only=False)):
        words, lines = text.split(), [x for x in text.split("\n") if x]
        if words:
            distinct = dict.fromkeys(words, 0)
            for word in words:
                distinct[word] += 1
            rest[i] = (np.log1p(len(words)), len(distinct) / len(words) ** 0.9, max(distinct.values()) / len(words),
                       np.log(len(text) / len(words)), len(set(lines)) / len(lines), np.log(len(text) / len(lines)))
    return np.concatenate([rates, rest], axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


class LinearModel:
    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        self.mean, self.scale, self.weights = mean, scale, np.zeros(len(mean) + 1)

    def ready(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.clip((x - self.mean) / self.scale, -8, 8), np.ones((len(x), 1))], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.ready(x) @ self.weights)


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05, decay: float = 1e-4) -> LinearModel:
    """Least non-negative risk with the logistic loss, by Adam over the whole sample."""
    model = LinearModel(unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-3)
    p, u = model.ready(positive), model.ready(unlabelled)

    def gradient(w: np.ndarray) -> np.ndarray:
        at_p, at_u = sigmoid(p @ w), sigmoid(u @ w)
        good = p.T @ (at_p - 1) / len(p)
        bad_p, bad_u = p.T @ at_p / len(p), u.T @ at_u / len(u)
        # Logistic loss of the answer "bad": -log(1 - s).
        risk = -np.log1p(-np.minimum(at_u, 1 - 1e-9)).mean() + prior * np.log1p(-np.minimum(at_p, 1 - 1e-9)).mean()
        return prior * good + (bad_u - prior * bad_p) if risk >= 0 else prior * bad_p - bad_u

    descend(model, gradient, steps, rate, decay)
    return model


def contrast(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 200, rate: float = 0.05, decay: float = 1e-2) -> LinearModel:
    """Plain discrimination of positives from unlabelled text: orders texts by how likely they are good."""
    model = LinearModel(unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-3)
    p, u = model.ready(positive), model.ready(unlabelled)
    descend(model, lambda w: p.T @ (sigmoid(p @ w) - 1) / len(p) + u.T @ sigmoid(u @ w) / len(u), steps, rate, decay)
    return model


def descend(model: LinearModel, gradient, steps: int, rate: float, decay: float) -> None:
    w = model.weights
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        g = gradient(w) + decay * np.r_[w[:-1], 0]
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)


def least_ratio(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.9) -> float:
    """Class prior from two histograms over the same bins: the least share ratio of upper parts that hold ``least`` of the positives."""
    p, u = positive[::-1].cumsum() / positive.sum(), unlabelled[::-1].cumsum() / unlabelled.sum()
    ratio = (u / np.maximum(p, 1e-12))[p >= least]
    return float(np.clip(ratio.min(), 0.05, 0.99))


def held_out(id_column: str = "doc_id") -> Column:
    """The fold whose labels are never read: checksum of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def pu_scores(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, default: float = 0.5, id_column: str = "doc_id",
              text_column: str = "text") -> DataFrame:
    """``doc_id, held_out, score`` of every row. ``labels``: ``doc_id``, ``quality``."""
    spark = docs.sparkSession
    ship_package(spark)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            x = features(batch.column(1)).astype(np.float32)
            rows = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), rows], names=["doc_id", "x"])

    plain = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), text_or_empty(text_column).alias("text"))
    described = stage(plain.mapInArrow(describe, "doc_id bigint, x array<float>"), "features").withColumn("held_out", held_out())
    good = labels.where("quality = 1").select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    trusted = stage(described.where(~F.col("held_out")).join(good, "doc_id", "left_semi"), "positives")

    def sample(rows: DataFrame, n: int) -> np.ndarray:
        share = min(1.0, sample_rows / max(1, n))
        chosen = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select("x")
        return np.array([x for x in chosen.toPandas()["x"]], dtype=np.float64).reshape(-1, len(FEATURES))

    unlabelled = described.where(~F.col("held_out"))
    n_good, n_all = trusted.count(), unlabelled.count()
    positive = sample(trusted, n_good)
    if not len(positive):
        return described.select("doc_id", "held_out", F.lit(default).alias("score"))
    others = sample(unlabelled, n_all)
    if not len(others):
        others = positive

    def scored(rows: DataFrame, model: LinearModel) -> DataFrame:
        shared = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = batch.column(2).flatten().to_numpy().astype(np.float64).reshape(batch.num_rows, -1)
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shared.value.score(x))],
                                                     names=["doc_id", "held_out", "score"])

        return rows.select("doc_id", "held_out", "x").mapInArrow(run, "doc_id bigint, held_out boolean, score double")

    def histogram(rows: DataFrame, model: LinearModel) -> np.ndarray:
        bins = scored(rows, model).groupBy(F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        counts = np.zeros(BINS)
        for row in bins.collect():
            counts[row["bin"]] = row["n"]
        return counts

    half = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(2))
    seen_good, seen_all = np.zeros(BINS), np.zeros(BINS)
    for side in (0, 1):
        fitted_on = half == 1 - side
        order = contrast(or_else(sample(trusted.where(fitted_on), n_good), positive), or_else(sample(unlabelled.where(fitted_on), n_all), others))
        seen_good += histogram(trusted.where(half == side), order)
        seen_all += histogram(described.where(F.coalesce(half, F.lit(0)) == side), order)
    return scored(described, fit(positive, others, least_ratio(seen_good, seen_all)))


def or_else(rows: np.ndarray, instead: np.ndarray) -> np.ndarray:
    return rows if len(rows) else instead
