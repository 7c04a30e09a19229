from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from txnflow.llm.bpe import BytePairs, encode_texts  # noqa: E402
from txnflow.llm.packing import pack, pack_documents, plan_bins, token_pieces  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY, OWN = Tokenizer.from_file(PATH), BytePairs(PATH)


def check(texts):
    flat, ends = OWN.encode_array(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        want = LIBRARY.encode(text, add_special_tokens=False).ids
        own = flat[ends[i]:ends[i + 1]]
        assert own.tolist() == want == OWN.encode([text])[0].tolist(), text
        assert OWN.decode(own) == LIBRARY.decode(want, skip_special_tokens=False)


def test_encoding_equals_the_library():
    letters = "abcdeéñ'sStTll 12\n\t.,!#́ ​Σσİßﬁ😀日\x1c\x85\xa0"
    draw = random.Random(3)
    check(["", " ", "a" * 3000, "ab" * 2000 + "!" * 500, "<|endoftext|>don't<|startoftext|><|endoftext|>", "<|EndOfText|>",
           *["".join(draw.choices(letters, k=draw.randrange(50))) + draw.choice(["", "<|endoftext|>"]) + "I'll" for _ in range(500)]])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=4))
def test_encoding_equals_the_library_on_any_text(texts):
    check([text.encode("utf-8", "replace").decode() for text in texts])


def test_encode_documents(odd_docs, no_docs):
    rows = encode_texts(odd_docs, PATH).collect()
    want = sorted((str(r.doc_id), LIBRARY.encode(r.text or "", add_special_tokens=False).ids) for r in odd_docs.collect())
    assert sorted((str(r.doc_id), r.ids) for r in rows) == want
    assert encode_texts(no_docs, PATH).collect() == []


def full_bins(rows, capacity):
    """Lengths by bin; offsets must have no gaps."""
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return {k: sorted(x for _, x in own) for k, own in bins.items()}


def test_plan_places_every_piece():
    draw = random.Random(1)
    for capacity in (10, 50, 97):
        counts = {length: draw.randrange(1, 40) for length in draw.sample(range(1, capacity + 1), capacity // 2)}
        placed = defaultdict(int)
        plan = plan_bins(counts, capacity)
        for times, used in plan:
            assert sum(n * length for length, n in used.items()) <= capacity
            for length, n in used.items():
                placed[length] += n * times
        assert placed == counts
        gaps = []  # first fit, longest first
        for length in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
            at = next((i for i, gap in enumerate(gaps) if gap >= length), None)
            if at is None:
                gaps.append(capacity - length)
            else:
                gaps[at] -= length
        assert sum(times for times, _ in plan) <= 1.01 * len(gaps) + 1


def test_two_pieces_replace_the_smallest():
    # Greedy fills 6 + 3 and leaves 1; 2 + 2 fits the gap of 4 exactly.
    assert plan_bins({6: 1, 3: 1, 2: 2}, 10)[0] == (1, {6: 1, 2: 2})


def test_a_piece_that_does_not_fit_is_refused():
    with pytest.raises(ValueError):
        plan_bins({11: 1}, 10)


def test_pieces_and_packing(odd_docs, no_docs):
    rows = pack_documents(odd_docs, PATH, capacity=64).collect()
    full_bins(rows, 64)
    want = []
    for r in odd_docs.collect():
        ids = np.array([*LIBRARY.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(str(r.doc_id), i, 64 * i, len(ids[64 * i:64 * i + 64]), zlib.crc32(ids[64 * i:64 * i + 64].tobytes()))
                 for i in range(-(-len(ids) // 64))]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    assert pack_documents(no_docs, PATH).collect() == []
    assert token_pieces(no_docs, PATH).collect() == []


def test_one_length_in_most_rows(spark):
    pieces = spark.range(500).selectExpr("id AS doc_id", "CAST(CASE WHEN id % 3 = 0 THEN id % 40 + 1 ELSE 7 END AS bigint) AS length")
    bins = full_bins(pack(pieces, 64).collect(), 64)
    assert sum(map(len, bins.values())) == 500
    assert sorted(bins) == list(range(len(bins)))
