from __future__ import annotations

import random

import pytest

import corpus_pipeline
from test_near_passages import fingerprint
from txnflow.llm.oracles import ORACLES
from txnflow.llm.queries import QUERIES
from txnflow.session import stage

SMALL = "/root/testdata/sf0.001"


def test_stages_on_planted_documents(spark, make_docs):
    draw = random.Random(8)
    word = lambda: "".join(draw.choice(["the", "and", "ing", "ha", "on", "er"]) for _ in range(3))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + ". "
    passage = "".join(sentence(15) for _ in range(5))
    clean = [(i, "".join(sentence(12) for _ in range(12)), "en", f"s{i % 3}") for i in range(30)]
    # A copy with one other word whose fingerprint is linked to the original's.
    words = clean[0][1].split()
    copies = (" ".join([*words[:i], "other", *words[i + 1:]]) for i in range(len(words)))
    near = next(c for c in copies if 0 < (fingerprint(c) ^ fingerprint(clean[0][1])).bit_count() <= 3)
    rows = clean + [(100, clean[1][1], "en", "s1"), (101, near, "en", "s2"), (102, "## 12 !!", "en", "s1"), (103, None, None, None), (104, "", "en", "s1")]
    rows += [(200 + i, "".join(sentence(12) for _ in range(8)) + passage + sentence(10), "en", "s2") for i in range(4)]
    docs, kept = make_docs(rows), {}
    for name, function in corpus_pipeline.STAGES[:-1]:
        before = docs.columns
        docs = stage(function(spark, docs, SMALL), name)
        assert docs.columns == before
        kept[name] = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert set(kept["language_id"]) == {r[0] for r in rows} - {102, 103, 104}
    assert set(kept["exact_dedup"]) == set(kept["language_id"]) - {100}
    assert set(kept["simhash_near_dedup"]) == set(kept["exact_dedup"]) - {101}
    assert set(kept["passage_dedup"]) == set(kept["simhash_near_dedup"])
    assert [i for i in range(200, 204) if passage.strip() in kept["passage_dedup"][i]] == [200]
    assert all(kept["passage_dedup"][r[0]] == r[1] for r in clean)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id for r in packed} == set(kept["passage_dedup"])


def test_stages_on_odd_and_empty_tables(spark, odd_docs, no_docs):
    for frame in (odd_docs, no_docs):
        docs = frame
        for name, function in corpus_pipeline.STAGES:
            docs = stage(function(spark, docs, SMALL), name)
        assert (docs.count() > 0) == (frame is odd_docs)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    want = con.execute(ORACLES[name])
    columns = sorted(d[0] for d in want.description)
    places = [[d[0] for d in want.description].index(c) for c in columns]
    expected = sorted((tuple(row[i] for i in places) for row in want.fetchall()), key=str)
    got = QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == columns
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str) == expected
