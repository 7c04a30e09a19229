"""Best-two-fit packing of token pieces into sequences.

A bin is filled greedily, each time with the longest unpacked piece that still fits. Then its smallest piece is replaced by the
two unpacked pieces that fill the gap left without it more tightly, as long as two such pieces exist.

The bins are planned on the histogram of piece lengths, which has at most ``capacity`` rows whatever the data: a planned bin is a
set of lengths and is repeated as often as all its lengths last, so the plan is short too. The pieces themselves are numbered
within their length by a distributed sort, and each finds its sequence and offset from its number by a
binary search in the plan. No task sees all pieces, and a length that a third of them share is spread like any other.

Defined results: a null or empty text has the end token alone; a document longer than the capacity is cut into full pieces and a last
one that may be shorter; repeated rows are packed like other rows; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.llm.bpe import ENCODE_BYTES, byte_pairs
from txnflow.llm.common import ship_package, slices, text_or_empty
from txnflow.operators.numbering import with_row_index

#: Pieces of one length are numbered below 2**NUMBER_BITS.
NUMBER_BITS = 46

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def token_pieces(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """The ids of each text with ``end_id`` behind them, cut into pieces: place, length and checksum of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(path)
        for batch in slices(batches, 1, ENCODE_BYTES):
            flat, ends = pairs.encode_array(batch.column(1))
            closed = np.insert(flat, ends[1:], end_id).astype("<u4")
            ends = ends + np.arange(len(ends))
            lengths = np.diff(ends)
            count = -(-lengths // capacity)
            doc = np.repeat(np.arange(len(lengths)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * capacity
            length = np.minimum(capacity, lengths[doc] - start)
            begin = ends[doc] + start
            checks = [zlib.crc32(closed[a:b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(checks, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
        pairs.forget()

    ship_package(docs.sparkSession)
    docs = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), text_or_empty(text_column).alias("text"))
    return docs.mapInArrow(run, PIECES)


def _fill(left: np.ndarray, capacity: int) -> Counter:
    """One bin from the counts ``left`` by length, which are not changed."""
    left = left.copy()
    used: Counter = Counter()
    gap = capacity
    while gap:
        fitting = np.flatnonzero(left[:gap + 1])
        if not len(fitting):
            break
        length = int(fitting[-1])
        n = min(int(left[length]), gap // length)
        left[length] -= n
        used[length] += n
        gap -= n * length
    while gap and used:
        smallest = min(used)
        room = gap + smallest
        # largest[x]: the longest unpacked length of x at most; of two equal pieces both must be there.
        lengths = np.flatnonzero(left[:room])
        if not len(lengths):
            break
        largest = np.zeros(room + 1, np.int64)
        largest[lengths] = lengths
        largest = np.maximum.accumulate(largest)
        partner = largest[room - lengths]
        alone = (partner == lengths) & (left[lengths] < 2)
        partner[alone] = largest[np.maximum(partner[alone] - 1, 0)]
        total = np.where(partner > 0, lengths + partner, 0)
        best = int(np.argmax(total))
        if total[best] <= smallest:
            break
        first, second = int(lengths[best]), int(partner[best])
        used[smallest] -= 1
        used += Counter()
        left[smallest] += 1
        for length in (first, second):
            used[length] += 1
            left[length] -= 1
        gap = room - first - second
    return used


def plan_bins(counts: Mapping[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(repetitions, pieces of each length) of all bins, so that every counted piece has its place."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit {capacity}")
        left[length] = n
    plan = []
    while left.any():
        used = _fill(left, capacity)
        times = min(int(left[length]) // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= n * times
        plan.append((times, dict(sorted(used.items(), reverse=True))))
    return plan


def _runs(plan: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """A row for each bin form and length: key of the first number, pieces a bin, first sequence, offset; ordered by key."""
    rows, taken, sequence = [], Counter(), 0
    for times, used in plan:
        offset = 0
        for length, n in used.items():
            rows.append(((length << NUMBER_BITS) + taken[length], n, sequence, offset))
            taken[length] += n * times
            offset += n * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` (with ``length``) and their ``sequence_id`` and ``offset``."""
    columns = pieces.columns
    numbered = with_row_index(pieces, ("length", *[c for c in ("doc_id", "piece") if c in columns]))
    counts = {row["length"]: row["n"] for row in numbered.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    before = np.zeros(capacity + 2, np.int64)
    for length, n in counts.items():
        before[length + 1] = n
    before = np.cumsum(before)
    table = pieces.sparkSession.sparkContext.broadcast((_runs(plan_bins(counts, capacity)), before))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, first = table.value
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column(columns.index("length")).to_numpy()
            number = batch.column(len(columns)).to_numpy() - first[length]
            run = runs[np.searchsorted(runs[:, 0], (length << NUMBER_BITS) + number, side="right") - 1]
            number = number - (run[:, 0] & ((1 << NUMBER_BITS) - 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(run[:, 2] + number // run[:, 1]), pa.array(run[:, 3] + number % run[:, 1] * length)],
                names=[*columns, "sequence_id", "offset"])

    ship_package(pieces.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return numbered.mapInArrow(run, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    return pack(token_pieces(docs, path, capacity, end_id), capacity)
