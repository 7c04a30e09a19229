"""Periodic runs of words, by string synchronising sets.

A run is a stretch of consecutive words with smallest period q, of at least two periods, that no neighbouring word extends. All runs
of a text are found, whatever their period:

* **Small periods**, up to four words, by comparing each word with the one q places on.
* **Synchronising sets.** For each dyadic scale t (2, 4, 8, ...) the periods from 3 t - 1 to 6 t - 2 are found. A place is in the set of the scale if the least
  hash of the blocks of t words that begin at it and at the t places behind it is that of the first or of the last of them; blocks that
  lie in a region with a period of t / 3 or less take no part. So membership depends on the 2 t words from the place on alone, and the two
  copies of a repetition have the same places. Places with equal context, not further apart than the largest period of the
  scale, propose their distance as a period. As contexts are not highly periodic, equal ones are more than t / 3 apart, and a place has
  18 partners at most.
* **Highly periodic regions** have no places. They are the runs of smaller periods, which have been found before. Where two such
  regions of one period and with the same root touch or overlap, the omitted periods are the shifts that carry one root onto the other.

Each proposed period is extended to both sides as far as words agree, which gives the run, by binary descent over hashes of all blocks of
2, 4, 8, ... words. Words are compared as dictionary numbers of their slice, blocks by 64-bit hashes of these.

All texts of a slice are worked on at once, with a word of its own between any two, longest first, so that the
texts still long enough for a scale are a prefix of the arrays. A text is never cut: the memory of a worker is about 300 bytes a word
of the slice, or of the longest text if that is longer.

Defined results: null and empty texts have no words and no runs, and the empty text is what is left of them; rows that repeat give repeated results; an empty
table gives an empty result; of two periods with the same stretch the smaller counts, and runs are listed by start, then period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.llm.common import ship_package, slices, text_or_empty
from txnflow.llm.words import split_words

#: Largest period found by plain comparison: below the least of scale 2.
SMALL = 4

#: Text that is searched at once.
RUN_BYTES = 1 << 20

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"

FAR = np.uint64(0xFFFFFFFFFFFFFFFF)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Blocks:
    """Hashes of all blocks of 1, 2, 4, ... words of ``values``; ``ends[k]``: so many words can begin a block of level k."""

    def __init__(self, values: np.ndarray, reach: list[int]):
        self.level = [mixed(values.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))]
        for k, end in enumerate(reach[1:], start=1):
            below, half = self.level[-1][:end], 1 << (k - 1)
            if len(below) <= half:
                break
            self.level.append(mixed(below[:-half] * np.uint64(0xC2B2AE3D27D4EB4F) + mixed(below[half:] + np.uint64(k))))

    def agree(self, k: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the blocks of level k at ``a`` and at ``b``, further on, are equal."""
        names = self.level[k]
        good = (a >= 0) & (b < len(names))
        out = np.zeros(len(a), bool)
        out[good] = names[a[good]] == names[b[good]]
        return out

    def extend(self, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last end of the words around ``at`` that equal the word ``period`` places on."""
        left, right = at.copy(), at.copy()
        for k in reversed(range(len(self.level))):
            right += self.agree(k, right, right + period) << k
            left -= self.agree(k, left - (1 << k), left - (1 << k) + period) << k
        return left, right


def sliding_least(values: np.ndarray, log: int) -> np.ndarray:
    """Least of each 2**log + 1 neighbours."""
    least = values
    for k in range(log):
        half = 1 << k
        least = np.minimum(least[:-half], least[half:])
    return np.minimum(least[:-1], least[1:])


class Found:
    """Runs found so far, each stretch with its smallest period."""

    def __init__(self):
        self.start, self.stop, self.period = (np.empty(0, np.int64) for _ in range(3))

    def add(self, start: np.ndarray, stop: np.ndarray, period: np.ndarray) -> None:
        start, stop, period = (np.concatenate(x) for x in ((self.start, start), (self.stop, stop), (self.period, period)))
        order = np.lexsort((period, stop, start))
        start, stop, period = start[order], stop[order], period[order]
        first = np.r_[True, (np.diff(start) != 0) | (np.diff(stop) != 0)][:len(start)]
        self.start, self.stop, self.period = start[first], stop[first], period[first]

    def extended(self, blocks: Blocks, at: np.ndarray, period: np.ndarray) -> None:
        """Add the runs of these periods around places ``at``."""
        left, right = blocks.extend(at, period)
        good = right - left >= period
        self.add(left[good], (right + period)[good], period[good])


def small_periods(values: np.ndarray, found: Found) -> None:
    """Runs of three periods at least, for periods up to ``SMALL``."""
    for q in range(1, SMALL + 1):
        same = values[:-q] == values[q:]
        edge = np.flatnonzero(np.diff(np.r_[False, same, False]))
        start, stop = edge[::2], edge[1::2]
        long = stop - start >= 2 * q
        found.add(start[long], stop[long] + q, np.full(long.sum(), q))


def places(blocks: Blocks, log: int, end: int, found: Found) -> np.ndarray:
    """The synchronising set of scale 2**log among the first ``end`` words."""
    scale = 1 << log
    names = blocks.level[log][:max(0, end - scale + 1)]
    hashed = mixed(names ^ np.uint64(0x5851F42D4C957F2D))
    periodic = np.zeros(len(hashed) + 1, np.int64)
    deep = (3 * found.period <= scale) & (found.stop - found.start >= scale) & (found.start < len(hashed))
    np.add.at(periodic, found.start[deep], 1)
    np.add.at(periodic, np.minimum(found.stop[deep] - scale + 1, len(hashed)), -1)
    hashed[np.cumsum(periodic[:-1]) > 0] = FAR
    if len(hashed) <= scale:
        return np.empty(0, np.int64)
    least = sliding_least(hashed, log)
    return np.flatnonzero((least != FAR) & ((least == hashed[:-scale]) | (least == hashed[scale:])))


def proposed(blocks: Blocks, log: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods from pairs with equal context, at distances of this scale."""
    scale = 1 << log
    at = at[at < len(blocks.level[log + 1])] if log + 1 < len(blocks.level) else at[:0]
    context = blocks.level[log + 1][at] if len(at) else np.empty(0, np.uint64)
    order = np.argsort(context, kind="stable")
    context, at = context[order], at[order]
    first, period, step = [], [], 1
    while step < len(at):
        apart = at[step:] - at[:-step]
        near = (context[step:] == context[:-step]) & (apart <= 6 * scale - 2)
        if not near.any():
            break
        good = near & (apart >= 3 * scale - 1)
        first.append(at[:-step][good])
        period.append(apart[good])
        step += 1
    none = [np.empty(0, np.int64)]
    return np.concatenate(first or none), np.concatenate(period or none)


def omitted(values: np.ndarray, found: Found) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods from touching regions of one small period with the same root."""
    long = found.stop - found.start >= 8 * found.period
    start, stop, period = found.start[long], found.stop[long], found.period[long]
    order = np.lexsort((start, period))
    start, stop, period = start[order], stop[order], period[order]
    meet = np.flatnonzero((period[1:] == period[:-1]) & (start[1:] <= stop[:-1]))
    first, shifts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i in meet:
        p, a, b, c, d = period[i], start[i], stop[i], start[i + 1], stop[i + 1]
        root = values[b - p:b]
        window = np.lib.stride_tricks.sliding_window_view(values[c:c + 2 * p - 1], p)
        same = np.flatnonzero((window == root).all(axis=1))
        if len(same):
            least = (c + same[0] - b) % p or p
            q = np.arange(least, min(b - a, d - c) + 1, p)
            first.append(np.maximum(a, c - q))
            shifts.append(q)
    return np.concatenate(first), np.concatenate(shifts)


def find_runs(numbers: np.ndarray, ends: np.ndarray, least: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of all runs of ``least`` words or more, by text, start and period.

    ``numbers`` are the words of all texts, text i being ``ends[i]`` to ``ends[i + 1]``.
    """
    sizes = np.diff(ends)
    by_size = np.argsort(-sizes, kind="stable")
    sizes = sizes[by_size]
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    total = int(sizes.sum() + len(sizes))
    # A word of its own behind each text: no repetition reaches across.
    values = np.empty(total, np.int64)
    inside = np.ones(total, bool)
    inside[begin + sizes] = False
    values[~inside] = -1 - np.arange(len(sizes))
    values[inside] = numbers[np.repeat(ends[:-1][by_size] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(numbers))]

    def reach(words: int) -> int:
        """End of the texts with so many words."""
        n = int(np.searchsorted(-sizes, -words, side="right"))
        return int(begin[n - 1] + sizes[n - 1] + 1) if n else 0

    longest = int(sizes[0]) if len(sizes) else 0
    blocks = Blocks(values, [reach(1 << k) for k in range(max(1, longest.bit_length()))])
    found = Found()
    small_periods(values, found)
    log = 1
    while 2 * (3 * (1 << log) - 1) <= longest:
        at = places(blocks, log, reach(2 * (3 * (1 << log) - 1)), found)
        found.extended(blocks, *proposed(blocks, log, at))
        log += 1
    found.extended(blocks, *omitted(values, found))
    length = found.stop - found.start
    good = (length >= least) & (length >= 2 * found.period)
    row = np.searchsorted(begin, found.start[good], side="right") - 1
    text, start, length, period = by_size[row], found.start[good] - begin[row], length[good], found.period[good]
    order = np.lexsort((period, start, text))
    return text[order], start[order], length[order], period[order]


def periodic_runs(docs: DataFrame, least: int = 12, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, runs, collapsed`` for every row: its runs of ``least`` words or more, and its words, joined by one space,
    without those that lie in a run behind the first period of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, RUN_BYTES):
            words = split_words(batch.column(1))
            ends = words.of_text()
            numbers = words.values.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            text, start, length, period = find_runs(numbers, ends, least)
            listed = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], names=["start", "length", "period"])
            runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)), listed)
            dropped = np.zeros(len(numbers) + 1, np.int64)
            np.add.at(dropped, ends[text] + start + period, 1)
            np.add.at(dropped, ends[text] + start + length, -1)
            kept = np.cumsum(dropped[:-1]) == 0
            left = pa.LargeListArray.from_arrays(pa.array(np.r_[0, np.cumsum(kept)][ends]), words.values.filter(pa.array(kept)))
            joined = pc.binary_join(left, pa.scalar(" ", pa.large_string())).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), runs, joined], names=["doc_id", "runs", "collapsed"])

    ship_package(docs.sparkSession)
    docs = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), text_or_empty(text_column).alias("text"))
    return docs.mapInArrow(run, f"doc_id bigint, runs {RUNS}, collapsed string")
