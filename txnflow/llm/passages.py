"""Substring deduplication by hashing of lines, paragraphs and passages.

A text is cut into units, each is normalised (case, white space and the outer marks of words don't count) and hashed, and the digests are
grouped over all documents. Of equal units the one that ranks first stays: the smallest document id, then the place in the text.

* **Lines and paragraphs.** Each later copy of a line, or of a paragraph of several lines, is removed if it has ``line_words`` words or more: shorter
  ones recur by chance, like "Read more". 128-bit digests.
* **Passages.** What is pasted into a line begins and ends anywhere, and a text may have no lines at all. So a text is also cut at words chosen by
  their neighbourhood alone: the least hash of every ``window`` neighbouring runs of ``GRAM`` words marks a cut, and a unit reaches from one cut to the end of the run of words at the next. Equal passages have
  the same cuts inside, and the window is such that every passage of ``min_words`` words holds a whole unit. Units that also stand at an earlier
  place are repeats, neighbouring repeats form a passage, and both its ends are then moved outwards word by word, as far as the words
  equal those around the first place of the unit at that end. Passages of ``min_words`` words or more are removed. 64-bit digests.

How the data move:

1. ``units``: one pass over the texts gives a row for each different unit of a document, of three whole numbers. It is staged.
2. Digests are counted, in a narrow aggregation of the digest alone, then the units of those met several times are joined to the count. A line that is in
   a third of all documents sends one row a task to the count, and the join is split by adaptive execution.
3. The ends of passages, a few for each document that repeats something, ask for the words around the first place of their unit: a second
   pass over the documents that ask or are asked, and an equality join on the digest.
4. Spans are cut from the texts by a join with the documents.

Staged tables are deleted as soon as the last reader is done.

Defined results: null and empty texts have no units and stay as they are; null ids rank last, in an order of their texts; rows that share an id are one document, what they
repeat of each other stays; rows that repeat id and text keep the same; offsets count characters of the original text; an empty table gives an empty
result. The ends of a passage are compared with the first place of the unit there and with earlier places in the same text: if a passage is
put together from several documents, up to ``window + GRAM`` words at an end may stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.llm.common import ship_package, slices, text_or_empty
from txnflow.llm.runs import mixed
from txnflow.llm.words import split_words
from txnflow.session import stage, temporary_stages

MARKS = ".,;:!?\"'()[]|*#-"

#: Words that choose a cut.
GRAM = 8

#: Kinds of units; their numbers within a text are below 1 << NUMBER_BITS.
PASSAGE, LINE, PARAGRAPH, NUMBER_BITS = 0, 1, 2, 29

REMOVED = "array<struct<start:int,stop:int>>"

LARGEST = (1 << 63) - 1

#: Factors of the two digests of a stretch of words, odd, and their inverses.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
INVERSES = tuple(pow(f, -1, 1 << 64) for f in FACTORS)

LEFT, RIGHT = 0, 1


def window_for(min_words: int) -> int:
    """So many neighbouring grams choose a cut that a passage of ``min_words`` words holds two cuts at least."""
    if min_words < GRAM + 3:
        raise ValueError(f"passages of {GRAM + 3} words or more are found")
    return (min_words - GRAM + 1) // 2


def word_hashes(values: pa.Array) -> np.ndarray:
    """64-bit hashes of words, equal for words that differ in case and outer marks only; each different word is hashed once."""
    coded = values.dictionary_encode()
    plain = pc.utf8_lower(coded.dictionary)
    bare = pc.utf8_trim(plain, characters=MARKS)
    bare = pc.if_else(pc.equal(pc.binary_length(bare), 0), plain, bare)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((digest(word) for word in bare.cast(pa.large_binary()).to_pylist()), np.uint64, len(bare))
    return hashes[coded.indices.to_numpy(zero_copy_only=False)]


def powers(n: int, factor: int) -> np.ndarray:
    out = np.full(n + 1, factor, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@dataclass(frozen=True)
class Cut:
    """The units of the texts of one slice, in order: the text, number, first and last end of the words, and digest of each."""

    text: np.ndarray
    number: np.ndarray
    first: np.ndarray
    end: np.ndarray
    digest: np.ndarray
    digest2: np.ndarray | None = None


class Sliced:
    """Words and units of the texts of one slice."""

    def __init__(self, texts: pa.Array, min_words: int, line_words: int, blocks: bool = True):
        self.words = split_words(texts)
        self.hashes = word_hashes(self.words.values)
        self.ends = self.words.of_text()
        #: sums of the words before each place, weighed by powers of a factor, and the inverse powers: a digest of any stretch is a difference
        self.prefix = [np.r_[np.uint64(0), np.cumsum(self.hashes * powers(len(self.hashes), f)[:len(self.hashes)], dtype=np.uint64)] for f in FACTORS]
        self.back = [powers(len(self.hashes), f) for f in INVERSES]
        self.passages = self._passages(window_for(min_words))
        if blocks:
            self.lines, self.paragraphs = self._blocks(line_words)

    def digest(self, first: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        """Of the words from ``first`` to ``end``, wherever they stand."""
        prefix = self.prefix[which]
        return mixed((prefix[end] - prefix[first]) * self.back[which][first] + (end - first).astype(np.uint64))

    def _numbered(self, text: np.ndarray, first: np.ndarray, end: np.ndarray, both: bool) -> Cut:
        number = np.arange(len(text)) - np.searchsorted(text, text)
        return Cut(text, number, first, end, self.digest(first, end), self.digest(first, end, 1) if both else None)

    def _passages(self, window: int) -> Cut:
        text, n = self.words.text, len(self.hashes)
        whole = n - GRAM + 1 - window + 1
        if whole < 1:
            none = np.empty(0, np.int64)
            return self._numbered(none, none, none, False)
        at = np.arange(n - GRAM + 1)
        grams = self.digest(at, at + GRAM)
        least = np.lib.stride_tricks.sliding_window_view(grams, window).argmin(axis=1) + np.arange(whole)
        # A window that reaches into the next text chooses nothing.
        least = least[text[:whole] == text[np.arange(whole) + window + GRAM - 2]]
        cuts = least[np.r_[True, np.diff(least) > 0][:len(least)]]
        first, following = cuts[:-1], cuts[1:]
        good = text[first] == text[following]
        return self._numbered(text[first[good]], first[good], following[good] + GRAM, False)

    def breaks(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words that begin lines, and whether they begin paragraphs too."""
        breaks = np.r_[0, np.cumsum(self.words.data == 10)][self.words.start] if len(self.words.start) else np.empty(0, np.int64)
        other = np.r_[True, np.diff(self.words.text) != 0][:len(breaks)]
        apart = np.r_[0, np.diff(breaks)][:len(breaks)]
        line = np.flatnonzero(other | (apart > 0))
        return line, (other | (apart > 1))[line]

    def _blocks(self, line_words: int) -> tuple[Cut, Cut]:
        text = self.words.text
        line, opens = self.breaks()
        end = np.r_[line[1:], len(text)][:len(line)]
        lines = self._numbered(text[line], line, end, True)
        lead = np.flatnonzero(opens)
        count = np.diff(np.r_[lead, len(line)])
        paragraphs = self._numbered(text[line[lead]], line[lead], np.r_[line[lead][1:], len(text)][:len(lead)], True)

        def some(cut: Cut, good: np.ndarray) -> Cut:
            return Cut(cut.text[good], cut.number[good], cut.first[good], cut.end[good], cut.digest[good], cut.digest2[good])

        return some(lines, lines.end - lines.first >= line_words), some(paragraphs, (count > 1) & (paragraphs.end - paragraphs.first >= line_words))

    def first_in_text(self, cut: Cut) -> np.ndarray:
        """For each unit, the place in ``cut`` of the first equal one of its text."""
        keys = (cut.text, cut.digest) if cut.digest2 is None else (cut.text, cut.digest, cut.digest2)
        order = np.lexsort((np.arange(len(cut.text)), *reversed(keys)))
        new = np.ones(len(order), bool)
        if len(order) > 1:
            new[1:] = np.logical_or.reduce([np.diff(key[order]) != 0 for key in keys])
        out = np.empty(len(order), np.int64)
        out[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
        return out

    def around(self, word: int, side: int, text: int, reach: int) -> np.ndarray:
        """Hashes of up to ``reach`` words of a text that stand before a word, nearest first, or from it on."""
        if side == LEFT:
            return self.hashes[max(self.ends[text], word - reach):word][::-1]
        return self.hashes[word:min(self.ends[text + 1], word + reach)]

    def line_span(self, first: int, end: int, text: int) -> tuple[int, int]:
        """Bytes of the whole lines of these words, with the line break behind them."""
        data, offsets = self.words.data, self.words.offsets
        start, stop = int(self.words.start[first]), int(self.words.stop[end - 1])
        while start > offsets[text] and data[start - 1] != 10:
            start -= 1
        while stop < offsets[text + 1] and data[stop] != 10:
            stop += 1
        return start, min(stop + 1, int(offsets[text + 1]))


def agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """So many first words are equal."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def own_of(kind: int | np.ndarray, number: np.ndarray, tag: np.ndarray) -> np.ndarray:
    """A tag of the text, the kind of a unit and its number in one whole number."""
    return (tag.astype(np.int64) << 32) | (np.int64(kind) << NUMBER_BITS) | number


UNITS = "doc_id bigint, own bigint, h bigint, h2 bigint"


def unit_digests(docs: DataFrame, min_words: int, line_words: int) -> DataFrame:
    """A row for the first of equal units of each document, and one without a digest where a document repeats itself.

    ``h2`` is null for units of passages. ``docs`` has ``doc_id``, ``text`` and ``tag``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            cut = Sliced(batch.column(1), min_words, line_words)
            tag = batch.column(2).to_numpy()
            again = np.zeros(batch.num_rows, bool)
            for kind, units in ((PASSAGE, cut.passages), (LINE, cut.lines), (PARAGRAPH, cut.paragraphs)):
                new = cut.first_in_text(units) == np.arange(len(units.text))
                again[units.text[~new]] = True
                text = units.text[new]
                second = pa.nulls(len(text), pa.int64()) if units.digest2 is None else pa.array(units.digest2[new].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(text)), pa.array(own_of(kind, units.number[new], tag[text])), pa.array(units.digest[new].view(np.int64)), second],
                    names=["doc_id", "own", "h", "h2"])
            text = np.flatnonzero(again)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(text)), pa.array(own_of(PASSAGE, np.zeros(len(text), np.int64), tag[text])),
                 pa.nulls(len(text), pa.int64()), pa.nulls(len(text), pa.int64())], names=["doc_id", "own", "h", "h2"])

    return docs.mapInArrow(run, UNITS)


def _key(id_column: str, text_column: str) -> dict[str, Column]:
    """Rank and text of a row, and a tag that tells texts of one id apart. Null ids rank last, in an order of their texts."""
    text = text_or_empty(text_column)
    last = F.lit(LARGEST) - F.shiftrightunsigned(F.xxhash64(text), 2)
    return {"doc_id": F.coalesce(F.col(id_column).cast("bigint"), last), "text": text, "tag": F.shiftrightunsigned(F.xxhash64(text), 33)}


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(*[column.alias(name) for name, column in _key(id_column, text_column).items()])


def _tag() -> Column:
    return F.shiftrightunsigned("own", 32)


def _kind() -> Column:
    return F.shiftrightunsigned("own", NUMBER_BITS).bitwiseAND(F.lit(3))


def _number() -> Column:
    return F.col("own").bitwiseAND(F.lit((1 << NUMBER_BITS) - 1)).cast("int")


def _met(units: DataFrame, keys: list[str]) -> DataFrame:
    """``doc_id, own, h, again`` of the units met in several documents; ``again``: not in the one that ranks first."""
    counted = units.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select(*keys)
    # Staged, so that the join deals out both of its sides itself and a unit that very many documents share can be split.
    several = stage(counted, "several")
    shared = stage(units.join(several, keys).select("doc_id", "own", *keys), "shared")
    first = shared.groupBy(*keys).agg(F.min("doc_id").alias("first"))
    found = stage(shared.join(stage(first, "first"), keys).select("doc_id", "own", "h", (F.col("doc_id") > F.col("first")).alias("again")), "met")
    return found


CONTEXTS = "doc_id bigint, tag bigint, unit int, side int, h bigint, asks boolean, words array<bigint>"


def _contexts(docs: DataFrame, min_words: int, line_words: int) -> DataFrame:
    """The words at the asked ends: outside of the units, nearest first. ``docs`` has ``asked``, structs of unit, side, digest and whether it asks."""
    reach = window_for(min_words) + GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            cut = Sliced(batch.column(1), min_words, line_words, blocks=False)
            begin = np.searchsorted(cut.passages.text, np.arange(batch.num_rows + 1))
            row, words = [], []
            asked = batch.column(3).flatten()
            owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column(3)).to_numpy(zero_copy_only=False))
            unit, side = asked.field("unit").to_numpy(), asked.field("side").to_numpy()
            at = begin[owner] + unit
            for text, u, s in zip(owner.tolist(), at.tolist(), side.tolist(), strict=True):
                row.append(text)
                words.append(cut.around(int(cut.passages.first[u] if s == LEFT else cut.passages.end[u]), s, text, reach))
            ends = np.r_[0, np.cumsum([len(w) for w in words])].astype(np.int32)
            flat = np.concatenate(words).view(np.int64) if words else np.empty(0, np.int64)
            at = pa.array(np.array(row, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(2).take(at), asked.field("unit"), asked.field("side"), asked.field("h"), asked.field("asks"),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=[c.split()[0] for c in CONTEXTS.split(", ")])

    return docs.mapInArrow(run, CONTEXTS)


def _extensions(docs: DataFrame, met: DataFrame, min_words: int, line_words: int) -> DataFrame:
    """``doc_id, tag, unit, side, words``: by so many words the passage that begins or ends with a unit of a document reaches further."""
    again = met.where("again").groupBy("doc_id", _tag().alias("tag")).agg(
        F.sort_array(F.collect_list(F.struct(_number().alias("unit"), F.col("h").alias("h")))).alias("units"))
    numbers = F.col("units.unit")
    ends = F.transform("units", lambda u: F.struct(u["unit"].alias("unit"), u["h"].alias("h")))

    def lonely(side: int) -> Column:
        """The units without a neighbour on a side."""
        shifted = F.concat(F.array(F.lit(-9)), numbers) if side == LEFT else F.concat(F.slice(numbers, F.lit(2), F.size(numbers)), F.array(F.lit(-9)))
        paired = F.filter(F.arrays_zip(ends.alias("u"), shifted.alias("next")),
                          lambda x: x["u"]["unit"] + F.lit(1 if side == RIGHT else -1) != x["next"])
        return F.transform(paired, lambda x: F.struct(x["u"]["unit"].alias("unit"), F.lit(side).alias("side"), x["u"]["h"].alias("h")))

    asking = stage(again.select("doc_id", "tag", F.explode(F.concat(lonely(LEFT), lonely(RIGHT))).alias("e")).select("doc_id", "tag", "e.*"), "asking")
    wanted = asking.select("h", "side").distinct()
    sources = met.where(~F.col("again")).select("doc_id", _tag().alias("tag"), _number().alias("unit"), "h").join(wanted, "h")
    both = asking.select("doc_id", "tag", "unit", "side", "h", F.lit(True).alias("asks")).unionByName(
        sources.select("doc_id", "tag", "unit", "side", "h", F.lit(False).alias("asks")))
    asked = stage(both.groupBy(F.col("doc_id").alias("ask_id"), F.col("tag").alias("ask_tag")).agg(
        F.collect_list(F.struct("unit", "side", "h", "asks")).alias("asked")), "asked")
    near = docs.join(asked, (F.col("doc_id") == F.col("ask_id")) & (F.col("tag") == F.col("ask_tag"))).select("doc_id", "text", "tag", "asked")
    around = stage(_contexts(near, min_words, line_words), "contexts")
    # Rows of one id and text ask and answer alike, so any of them will do.
    place = around.where(~F.col("asks")).groupBy("h", "side").agg(F.max("words").alias("there"))
    pairs = around.where("asks").join(stage(place, "places"), ["h", "side"])
    differ = F.array_position(F.zip_with("words", "there", lambda a, b: ~a.eqNullSafe(b)), True)
    shorter = F.least(F.size("words"), F.size("there"))
    same = F.when(differ > 0, F.least(differ.cast("int") - 1, shorter)).otherwise(shorter)
    return stage(pairs.select("doc_id", "tag", "unit", "side", same.alias("words")).where("words > 0"), "extensions")


def repeated_units(docs: DataFrame, min_words: int = 30, line_words: int = 5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row for each document that repeats something: ``rank_id``, ``rank_tag``, ``units``, ``lines``, ``paragraphs`` and ``further``.

    They hold the numbers of the units, lines and paragraphs that another document has before, and in ``further``, three numbers each, the unit, side
    and words by which a passage reaches beyond its units. All may be empty: the document repeats itself then.
    """
    spark = docs.sparkSession
    ship_package(spark)
    docs = _keyed(docs, id_column, text_column)
    with temporary_stages(spark) as scope:
        units = stage(unit_digests(docs, min_words, line_words), "units")
        met = _met(units.where("h2 IS NULL AND h IS NOT NULL"), ["h"])
        blocks = _met(units.where("h2 IS NOT NULL"), ["h", "h2"])
        alone = stage(units.where("h IS NULL").select("doc_id", "own", F.lit(None).cast("bigint").alias("h"), F.lit(False).alias("again")), "alone")
        scope.release("units", "several", "shared", "first")
        further = _extensions(docs, met, min_words, line_words)
        none = F.lit(None).cast("array<int>")
        rows = met.where("again").unionByName(blocks.where("again")).unionByName(alone).select(
            "doc_id", _tag().alias("tag"), _kind().alias("kind"), F.when(F.col("again"), _number()).alias("number"), none.alias("further"))
        rows = rows.unionByName(further.select("doc_id", "tag", F.lit(-1).cast("bigint").alias("kind"), F.lit(None).cast("int").alias("number"),
                                               F.array("unit", "side", "words").alias("further")))
        of_kind = [F.collect_set(F.when(F.col("kind") == kind, F.col("number"))).alias(name)
                   for kind, name in ((PASSAGE, "units"), (LINE, "lines"), (PARAGRAPH, "paragraphs"))]
        found = rows.groupBy(F.col("doc_id").alias("rank_id"), F.col("tag").alias("rank_tag")).agg(
            *of_kind, F.flatten(F.collect_set("further")).alias("further"))
        return scope.result(found, "repeats")


@dataclass(frozen=True)
class Repeats:
    """What a text repeats of other documents, by numbers of units; ``further``: words by unit and side."""

    units: set[int]
    lines: set[int]
    paragraphs: set[int]
    further: dict[tuple[int, int], int]


def _spans(cut: Sliced, text: int, repeats: Repeats, min_words: int, begin: list[np.ndarray], earliest: list[np.ndarray]) -> list[tuple[int, int]]:
    """Bytes to remove from one text of a slice, in order."""
    spans = []
    passages, reach = cut.passages, window_for(min_words) + GRAM
    low, high = int(begin[PASSAGE][text]), int(begin[PASSAGE][text + 1])
    first_of = earliest[PASSAGE][low:high].tolist()
    repeated = [u for u, first in enumerate(first_of, start=low) if first != u or u - low in repeats.units]
    # Later copies of a unit that another document has before are repeats too, by being later in the text.
    known = set(repeated)
    base = int(cut.ends[text])
    covered = np.zeros(int(cut.ends[text + 1]) - base + 1, np.int64)
    for u in repeated:
        first = first_of[u - low]
        at = [int(passages.first[u]), int(passages.end[u])]
        for side, step in ((LEFT, -1), (RIGHT, 1)):
            if u + step in known:
                continue
            if first != u:
                there = int(passages.first[first] if side == LEFT else passages.end[first])
                more = agreeing(cut.around(at[side], side, text, reach), cut.around(there, side, text, reach))
            else:
                more = repeats.further.get((u - low, side), 0)
            at[side] += step * more
        covered[at[LEFT] - base] += 1
        covered[at[RIGHT] - base] -= 1
    edge = np.flatnonzero(np.diff(np.r_[False, np.cumsum(covered) > 0])) + base
    for start, stop in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        if stop - start >= min_words:
            spans.append((int(cut.words.start[start]), int(cut.words.stop[stop - 1])))
    for kind, units, again in ((LINE, cut.lines, repeats.lines), (PARAGRAPH, cut.paragraphs, repeats.paragraphs)):
        for u in range(int(begin[kind][text]), int(begin[kind][text + 1])):
            if earliest[kind][u] != u or int(units.number[u]) in again:
                spans.append(cut.line_span(int(units.first[u]), int(units.end[u]), text))
    return merged(spans)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that overlap or touch as one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def cut_texts(texts: pa.Array, repeats: list[Repeats], min_words: int, line_words: int) -> list[tuple[str, list[tuple[int, int]]]]:
    """What is left of each text, and the removed spans in characters."""
    cut = Sliced(texts, min_words, line_words)
    kinds = (cut.passages, cut.lines, cut.paragraphs)
    begin = [np.searchsorted(units.text, np.arange(len(texts) + 1)) for units in kinds]
    earliest = [cut.first_in_text(units) for units in kinds]
    characters = np.r_[0, np.cumsum((cut.words.data & 0xC0) != 0x80)]
    data, out = cut.words.data.tobytes(), []
    for text, own in enumerate(repeats):
        low, high = int(cut.words.offsets[text]), int(cut.words.offsets[text + 1])
        spans = _spans(cut, text, own, min_words, begin, earliest)
        kept, at = [], low
        for start, stop in spans:
            kept.append(data[at:start])
            at = stop
        kept.append(data[at:high])
        out.append((b"".join(kept).decode("utf-8", "replace"), [(int(characters[a] - characters[low]), int(characters[b] - characters[low])) for a, b in spans]))
    return out


def remove_repeats(docs: DataFrame, min_words: int = 30, line_words: int = 5, id_column: str = "doc_id", text_column: str = "text",
                   removed_column: str = "removed") -> DataFrame:
    """``docs`` with repeated lines, paragraphs and passages cut from the text, and ``removed_column``: their offsets in the original text.

    A text that loses nothing stays as it is, null included. A column that has the name of ``removed_column`` is replaced.
    """
    columns = [c for c in docs.columns if c.lower() != removed_column.lower()]
    repeats = repeated_units(docs, min_words, line_words, id_column, text_column)
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    rows = docs.select(row, *[column.alias(f"own_{name}") for name, column in _key(id_column, text_column).items()])
    joined = rows.join(repeats, (F.col("own_doc_id") == F.col("rank_id")) & (F.col("own_tag") == F.col("rank_tag")), "left")
    found = F.col("rank_id").isNotNull()

    @F.pandas_udf(f"text string, removed {REMOVED}")
    def clean(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for texts, *numbers in batches:
            out: list[tuple] = [(None, [])] * len(texts)
            here = np.flatnonzero(texts.notna().to_numpy())
            owned = [Repeats(*(set(x[i].tolist()) for x in numbers[:3]), {(a, b): c for a, b, c in numbers[3][i].reshape(-1, 3).tolist()}) for i in here]
            batch = pa.RecordBatch.from_arrays([pa.array(texts.to_numpy()[here], pa.string())], names=["text"])
            at = 0
            for part in slices(iter([batch]), 0):
                for text, spans in cut_texts(part.column(0), owned[at:at + part.num_rows], min_words, line_words):
                    out[here[at]] = (text, [{"start": a, "stop": b} for a, b in spans])
                    at += 1
            yield pd.DataFrame(out, columns=["text", "removed"])

    # Texts without repeats aren't sent to Python.
    cleaned = joined.select("row", clean(F.when(found, F.col("own_text")), "units", "lines", "paragraphs", "further").alias("clean"))

    def column(name: str) -> Column:
        own = F.col(f"row.`{name}`")
        return F.when(F.size("clean.removed") > 0, F.col("clean.text")).otherwise(own).alias(name) if name == text_column else own.alias(name)

    return cleaned.select(*[column(c) for c in columns], F.col("clean.removed").alias(removed_column))
