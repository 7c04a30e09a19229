from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from txnflow.llm import exact_dedup
from txnflow.llm.exact_dedup import exact_groups, keep_first
from txnflow.llm.shards import Feistel, shard_rows


def brute_groups(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", text or "") for _, text in rows]
    least = {}
    for (doc, _), text in zip(rows, norm, strict=True):
        known = [x for x in (least.get(text), doc) if x is not None]
        least[text] = min(known) if known else None
    size, out, seen = Counter(norm), [], set()
    for (doc, _), text in zip(rows, norm, strict=True):
        kept = doc == least[text] and (doc, text) not in seen
        seen.add((doc, text))
        out.append((doc, least[text], size[text], kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def test_groups_equal_brute_force(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted(map(tuple, exact_groups(odd_docs).collect()), key=str) == brute_groups(rows)


def test_colliding_hashes_keep_texts_apart(odd_docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "content_hash", lambda text: F.lit(b"same"))
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted(map(tuple, exact_groups(odd_docs).collect()), key=str) == brute_groups(rows)


def test_keep_first_keeps_columns_and_one_row_a_text(odd_docs, no_docs):
    kept = keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    texts = Counter(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in rows)
    assert max(texts.values()) == 1 and len(rows) == 7
    assert {r.doc_id for r in rows} == {1, 3, 5, 6, 7, 8, 9}
    assert keep_first(no_docs).collect() == [] and exact_groups(no_docs).collect() == []


def test_permutation_is_one_to_one_and_invertible():
    for n in (1, 2, 3, 10, 97, 1000, 4097):
        p = Feistel(n, 5)
        places = [p.place(x) for x in range(n)]
        assert sorted(places) == list(range(n))
        assert [p.row_of(x) for x in places] == list(range(n))


def test_columns_equal_arithmetic(spark):
    for n in (1, 5, 1000):
        p = Feistel(n, 3)
        got = p.with_place(spark.range(n).withColumnRenamed("id", "row_index")).collect()
        assert {r.row_index: r.place for r in got} == {x: p.place(x) for x in range(n)}


def test_shards_are_even_and_complete(odd_docs, no_docs):
    rows = shard_rows(odd_docs, 4).collect()
    assert len(rows) == odd_docs.count()
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for shard in sizes:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sizes[shard]))
    want = sorted((len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in odd_docs.collect())
    assert sorted((r.size, r.text_crc32) for r in rows) == want
    place = Feistel(len(rows))
    assert all(place.row_at(r.shard, r.slot, 4) == r.row_index for r in rows)
    assert shard_rows(no_docs).collect() == []
