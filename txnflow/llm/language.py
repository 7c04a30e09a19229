"""Language identification by Bayesian evidence fusion.

Four sources of evidence speak about the language l of a page or document and are taken to be independent given l:

* text: character trigrams (bytes of the lower-cased letters), log-likelihoods of a smoothed multinomial for each
  language, averaged over the trigrams of the whole text and weighed like ``text_weight`` trigrams at most, since neighbouring
  trigrams are not independent;
* the declared language, P(declared | l), and the address suffix, P(suffix | l), from counts over all rows, smoothed;
* the host, whose prior P(l | host) is smoothed towards that of its domain, and that towards the whole corpus.

All counts over hosts, domains, declarations and suffixes are grouped aggregations of what text alone says, over every row.
The trigram counts come from labelled texts, about ``language_rows`` of each language, all if it has fewer, chosen by a hash of the text: the documented bound
of the sample the classifier is fitted on. Every declared language takes part, however rare; one whose sampled texts have no letters is left out, and rows of it are named by
the others or rejected. What is broadcast is one column of ``BUCKETS`` numbers of 4 bytes for each language; more than ``MOST_LANGUAGES`` are an error, not cut.
A row's own vote is taken off the counts of its host and domain before they speak about it.

Only trigrams seen in training tell languages apart. A text whose trigrams, the unseen ones at the floor that all languages share, are too unlikely in
its best language is in none of them. The level lies between that of the uniform distribution over buckets and what labelled texts that were held out of training
reach, the nearer to the latter the more of them there are, and never nearer than a third of the way. Its ``lang``, ``text_lang`` and ``probability`` are null, and it counts nowhere.

A row is accepted if the posterior of its best language reaches ``accept`` and its text has letters and is in one of the languages.

Defined results: null evidence says nothing; a row without letters in its text is not identified by it, gets what the other evidence
says as ``lang``, and is not accepted; ties go to the language that is first in the alphabet; repeated rows get equal
results; an empty table, or no labelled text at all, gives null languages.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.llm.common import ship_package, slices, text_or_empty
from txnflow.session import stage

BUCKETS = 1 << 16

#: Bytes of text that a task works on at once: trigrams need some forty bytes for each of them.
SLICE = 1 << 20

#: Broadcast tables stay below 128 MB.
MOST_LANGUAGES = 512

#: Of the sampled texts one in ``HELD_OUT`` is not trained on, of languages with ``HELD_OUT`` squared or more. They give the level of a language, ``SPREADS`` standard
#: deviations, and ``MARGIN`` at least, below their mean, and not above ``WAY`` of the way from the uniform level to it, since codes, licences and words of a second language
#: in a text lower its mean; ``ENOUGH`` of them weigh as much as the uniform level. ``SHORT``: what a text of one trigram may lie below the level, less by the root of their number.
HELD_OUT, ENOUGH, SPREADS, MARGIN, WAY, SHORT = 8, 2, 6.0, 0.5, 1 / 3, 6.0

EVIDENCE = ("text", "declared", "suffix", "host")


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the letter trigrams of all texts, and the text each belongs to. Non-letters are word breaks."""
    lowered = pc.utf8_lower(texts.cast(pa.large_string()))
    values = np.frombuffer(lowered.buffers()[2] or b"", np.uint8)
    ends = np.frombuffer(lowered.buffers()[1], np.int64)[lowered.offset:lowered.offset + len(lowered) + 1]
    b = values[ends[0]:ends[-1]].astype(np.uint32)
    letter = ((b >= 97) & (b <= 122)) | (b >= 128)
    b = np.where(letter, b, 32)
    if len(b) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(ends))
    # A break may begin or end a trigram, not be its middle, and trigrams stay inside one text.
    good = letter[1:-1] & (owner[:-2] == owner[2:])
    code = (b[:-2] * np.uint32(961) + b[1:-1]) * np.uint32(961) + b[2:]
    code = (code * np.uint32(2654435761)) >> np.uint32(16)
    return code[good].astype(np.int64), owner[:-2][good]


@dataclass(frozen=True)
class TextModel:
    languages: tuple[str, ...]
    #: log-likelihood of each trigram bucket, a row a bucket
    table: np.ndarray
    #: buckets seen in training, the log-likelihood of others, and the least mean of a text in each language
    known: np.ndarray | None = None
    floor: float = 0.0
    least: np.ndarray | None = None

    def means(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Mean log-likelihood of the known trigrams of each text in each language, and of all, and the numbers of all and of the known."""
        code, owner = trigrams(texts)
        n = np.bincount(owner, minlength=len(texts))
        seen = self.known[code]
        code, owner = code[seen], owner[seen]
        hits = np.bincount(owner, minlength=len(texts))
        sums = np.stack([np.bincount(owner, weights=column[code], minlength=len(texts)) for column in self.table.T], axis=1)
        whole = (sums + ((n - hits) * self.floor)[:, None]) / np.maximum(n, 1)[:, None]
        return sums / np.maximum(hits, 1)[:, None], whole, n, hits

    def in_none(self, whole: np.ndarray, best: np.ndarray, n: np.ndarray, hits: np.ndarray) -> np.ndarray:
        """Texts with letters that are in none of the languages. Means of few trigrams vary more."""
        low = whole[np.arange(len(n)), best] < self.least[best] - SHORT / np.sqrt(np.maximum(n, 1))
        return (n > 0) & (low | (hits == 0))


def fit_text_model(labelled: DataFrame, language_rows: int = 5_000, smoothing: float = 0.5) -> TextModel:
    """Trigram counts by ``lang`` over a sample of the rows (``text``, ``lang``), about ``language_rows`` of each language."""
    spark = labelled.sparkSession
    ship_package(spark)
    labelled = labelled.select(text_or_empty("text").alias("text"), F.col("lang").cast("string").alias("lang")).where("lang <> ''")
    per_lang = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(per_lang) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} declared languages: map them to codes first")
    languages = [row["lang"] for row in per_lang]
    if not languages:
        return TextModel((), np.zeros((BUCKETS, 0)))
    # One row a language.
    shares = spark.createDataFrame(
        [(row["lang"], int(min(1.0, language_rows / row["n"]) * (1 << 30)) + 1, row["n"] >= HELD_OUT * HELD_OUT) for row in per_lang],
        "of_lang string, below bigint, tested boolean")
    chosen = labelled.join(F.broadcast(shares), F.col("lang") == F.col("of_lang")).where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.col("below"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), BUCKETS), np.int64)
        for batch in slices(batches, 0, SLICE):
            code, owner = trigrams(batch.column(0))
            lang = np.searchsorted(languages, batch.column(1).to_numpy(zero_copy_only=False).astype(str))
            counts += np.bincount(lang[owner] * BUCKETS + code, minlength=counts.size).reshape(counts.shape)
        lang, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(bucket), pa.array(counts[lang, bucket])], names=["lang", "bucket", "n"])

    held_out = F.col("tested") & (F.pmod(F.shiftrightunsigned(F.xxhash64("text"), 32), F.lit(HELD_OUT)) == 0)
    rows = chosen.where(~held_out).select("text", "lang").mapInArrow(count, "lang bigint, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((BUCKETS, len(languages)))
    # One row a language and bucket at most.
    found = rows.toPandas()
    counts[found["bucket"], found["lang"]] = found["n"]
    trained = counts.sum(axis=0) > 0
    languages, counts = [name for name, good in zip(languages, trained, strict=True) if good], counts[:, trained]
    if not languages:
        return TextModel((), np.zeros((BUCKETS, 0)))
    known = counts.sum(axis=1) > 0
    # Counts as of equally many trigrams in each language, so that an unseen one is as unlikely in all.
    most = counts.sum(axis=0).max()
    likely = (counts * (most / counts.sum(axis=0)) + smoothing) / (most + smoothing * BUCKETS)
    floor = float(np.log(smoothing / (most + smoothing * BUCKETS)))
    model = TextModel(tuple(languages), np.log(likely).astype(np.float32), known, floor, np.full(len(languages), -np.log(BUCKETS)))
    shared = spark.sparkContext.broadcast(model)

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0, SLICE):
            _, whole, n, _ = shared.value.means(batch.column(0))
            lang = np.searchsorted(languages, batch.column(1).to_numpy(zero_copy_only=False).astype(str))
            value = whole[np.arange(len(n)), lang]
            yield pa.RecordBatch.from_arrays([pa.array(lang[n > 0]), pa.array(value[n > 0])], names=["lang", "value"])

    level = chosen.where(held_out & F.col("lang").isin(languages)).select("text", "lang").mapInArrow(reached, "lang bigint, value double").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("spread")).collect()
    for row in level:
        uniform, weight = model.least[row["lang"]], row["n"] / (row["n"] + ENOUGH)
        reach = min(row["mean"] - max(MARGIN, SPREADS * row["spread"]), uniform + WAY * max(0.0, row["mean"] - uniform))
        model.least[row["lang"]] += weight * (reach - uniform)
    return model


#: Addresses that are registered below a country's own general suffix.
COUNTRY_SUFFIX = r"\.(ac|co|com|edu|gob|gov|ne|net|or|org)\.[a-z]{2}$"


def domain_of(host: str | Column) -> Column:
    """The last two labels of a host, or three if these are like ``co.uk``; a host of one label is its own domain."""
    host = F.col(host) if isinstance(host, str) else host
    return F.when(host.rlike(COUNTRY_SUFFIX), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def _logs(counts: Column, total: Column, languages: int, strength: float, prior: Column | None = None) -> Column:
    """Smoothed log-shares of an array of counts by language."""
    if prior is None:
        return F.transform(counts, lambda n: F.log((n + strength / languages) / (total + strength)))
    return F.transform(F.arrays_zip(counts.alias("n"), prior.alias("p")),
                       lambda x: F.log((x["n"] + strength * F.exp(x["p"])) / (total + strength)))


def identify(rows: DataFrame, keys: Sequence[str], model: TextModel, text_weight: float = 40.0, accept: float = 0.5,
             host_strength: float = 10.0) -> DataFrame:
    """``keys`` of every row with ``lang``, ``probability``, ``text_lang``, ``trigrams`` and ``accepted``.

    ``rows`` has the columns of ``EVIDENCE``; keys must have other names.
    """
    spark = rows.sparkSession
    ship_package(spark)
    names, n_langs = model.languages, len(model.languages)
    if clash := {k.lower() for k in keys} & {*EVIDENCE, "text_log", "text_best", "trigrams", "in_none", "domain", "n"}:
        raise ValueError(f"keys must have other names: {sorted(clash)}")
    keep = [*keys, "declared", "suffix", "host"]
    plain = rows.select(*keys, *[F.nullif(F.lower(F.col(c).cast("string")), F.lit("")).alias(c) for c in keep[len(keys):]],
                        text_or_empty("text").alias("text"))
    if not n_langs:
        return plain.select(*keys, F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"),
                            F.lit(None).cast("string").alias("text_lang"), F.lit(0).cast("bigint").alias("trigrams"), F.lit(False).alias("accepted"))
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, len(keep), SLICE):
            mean, whole, n, hits = shared.value.means(batch.column(len(keep)))
            weighed = mean * np.minimum(hits, text_weight)[:, None]
            log = weighed - weighed.max(axis=1, keepdims=True)
            flat = pa.array(log.ravel())
            logs = pa.ListArray.from_arrays(np.arange(0, flat.__len__() + 1, n_langs, dtype=np.int32), flat)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], logs, pa.array(log.argmax(axis=1)), pa.array(n, pa.int64()),
                 pa.array(shared.value.in_none(whole, log.argmax(axis=1), n, hits))],
                names=[*keep, "text_log", "text_best", "trigrams", "in_none"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields[:-1])
    scored = stage(plain.mapInArrow(score, f"{kinds}, text_log array<double>, text_best bigint, trigrams bigint, in_none boolean"), "evidence")

    # What text alone says, counted by language; rows without letters say nothing.
    said = scored.where("trigrams > 0 AND NOT in_none")
    by_lang = [F.count(F.when(F.col("text_best") == i, 1)).cast("double").alias(f"n{i}") for i in range(n_langs)]
    as_array = F.array(*[F.col(f"n{i}") for i in range(n_langs)])

    def counts(*by: str) -> DataFrame:
        return said.where(" AND ".join(f"{c} IS NOT NULL" for c in by)).groupBy(*by).agg(*by_lang).select(*by, as_array.alias("n"))

    whole = said.agg(*by_lang).collect()[0]
    everywhere = F.lit([float(np.log((whole[i] + 1 / n_langs) / (sum(whole) + 1))) for i in range(n_langs)])
    in_lang = F.lit([float(np.log(x + 1.0)) for x in whole])

    # Host within domain within corpus: two grouped aggregations and a join between their results.
    hosts = stage(counts("host"), "hosts").withColumn("domain", domain_of("host"))
    domains = hosts.groupBy("domain").agg(*[F.sum(F.element_at("n", i + 1)).alias(f"n{i}") for i in range(n_langs)]).select("domain", as_array.alias("n"))
    hosts = hosts.join(domains.withColumnRenamed("n", "domain_n"), "domain").select("host", F.col("n").alias("host_n"), "domain_n")

    # P(value | l) for declarations and suffixes: the share of the rows of l that carry the value.
    def channel(name: str) -> DataFrame:
        seen = F.transform(F.arrays_zip(F.col("n").alias("n"), in_lang.alias("w")), lambda x: F.log(x["n"] + 0.5) - x["w"])
        return counts(name).select(name, seen.alias(f"{name}_log"))

    fused = scored
    for name, table in (("host", hosts), ("declared", channel("declared")), ("suffix", channel("suffix"))):
        # Null keys match nothing; a key that many rows share is split by adaptive execution.
        fused = fused.join(table, name, "left")
    nothing = F.lit([0.0] * n_langs)
    # Without the row's own vote.
    vote = F.transform(F.lit(list(range(n_langs))), lambda i: F.when(~F.col("in_none") & (F.col("trigrams") > 0) & (i == F.col("text_best")), 1.0).otherwise(0.0))
    for name in ("host_n", "domain_n"):
        fused = fused.withColumn(name, F.zip_with(name, vote, lambda n, own: n - own))
    fused = fused.withColumn("domain_log", _logs(F.col("domain_n"), F.aggregate("domain_n", F.lit(0.0), lambda a, x: a + x), n_langs, host_strength, everywhere))
    fused = fused.withColumn("host_log", _logs(F.col("host_n"), F.aggregate("host_n", F.lit(0.0), lambda a, x: a + x), n_langs, host_strength, F.col("domain_log")))
    parts = F.arrays_zip(
        F.col("text_log").alias("t"), F.coalesce("host_log", everywhere).alias("h"),
        F.coalesce("declared_log", nothing).alias("d"), F.coalesce("suffix_log", nothing).alias("s"))
    # A column of its own for each step, so that none is evaluated twice.
    fused = fused.withColumn("joint", F.transform(parts, lambda x: x["t"] + x["h"] + x["d"] + x["s"]))
    fused = fused.withColumn("top", F.array_max("joint"))
    fused = fused.withColumn("mass", F.aggregate("joint", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top"))))
    lang = F.element_at(F.lit(list(names)), F.array_position("joint", F.col("top")).cast("int"))
    return fused.select(
        *keys, F.when(~F.col("in_none"), lang).alias("lang"), F.when(~F.col("in_none"), 1 / F.col("mass")).alias("probability"),
        F.when((F.col("trigrams") > 0) & ~F.col("in_none"), F.element_at(F.lit(list(names)), (F.col("text_best") + 1).cast("int"))).alias("text_lang"),
        "trigrams", ((F.col("trigrams") > 0) & ~F.col("in_none") & (1 / F.col("mass") >= accept)).alias("accepted"),
    )


#: The language attribute of the html element, as pages declare it.
DECLARED = r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-zA-Z]{2,3})"


def page_evidence(url_column: str = "url", html_column: str = "html") -> dict[str, Column]:
    """Evidence columns of raw pages: text without markup, declared language, address suffix, host."""
    from txnflow.llm.url_filter import host_of

    html = text_or_empty(html_column)
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>|&[a-zA-Z#0-9]+;", " ")
    host = host_of(url_column)
    return {"text": text, "declared": F.regexp_extract(html, DECLARED, 1), "suffix": F.substring_index(host, ".", -1), "host": host}


def document_evidence() -> dict[str, Column]:
    """Documents declare their language in ``lang``; the source stands for the host, and there is no address."""
    return {"text": F.col("text"), "declared": F.col("lang"), "suffix": F.lit(None).cast("string"), "host": F.col("source").cast("string")}
