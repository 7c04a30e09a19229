from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from txnflow.llm.language import document_evidence, fit_text_model, identify, page_evidence
from txnflow.llm.permutation import InvertedFiles, orders, permutation_neighbours
from txnflow.llm.quality import FEATURES, features, least_ratio, pu_scores
from txnflow.llm.url_filter import build_trie, longest, url_filter


def brute_neighbours(rows, k):
    good = [(i, np.array(v, float)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 8]
    good = list({(i, v.tobytes()): (i, v / np.abs(v).max()) for i, v in good}.values())
    out = []
    for q, v in good:
        if q % 5 == 0:
            near = sorted((-(v @ w) / np.sqrt((v @ v) * (w @ w)), i) for i, w in good if i != q)[:k]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(near, 1)]
    return sorted(out)


def test_neighbours_with_odd_rows(spark):
    draw = np.random.default_rng(0)
    rows = [(i, draw.normal(size=8).tolist()) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(30)] + [rows[7], rows[7]]
    rows += [(300, None), (305, [0.0] * 8), (310, [1.0, None] + [0.0] * 6), (315, [float("nan")] + [1.0] * 7),
             (320, [float("inf")] + [1.0] * 7), (None, [1.0] * 8), (325, [1.0, 2.0]), (330, [1e200] + [0.0] * 7)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<double>, vec string, class_id int")
    got = permutation_neighbours(frame, F.col("id") % 5 == 0, block_rows=64, query_rows=16, share=1.0).collect()
    want = brute_neighbours(rows, 5)
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(got, key=lambda r: (r.query_id, r["rank"]))] == [w[:3] for w in want]
    assert np.allclose([r.score for r in sorted(got, key=lambda r: (r.query_id, r["rank"]))], [w[3] for w in want], atol=1e-12)
    assert permutation_neighbours(frame.limit(0), F.col("id") % 5 == 0).collect() == []


def test_recall_when_only_a_part_is_reranked(spark):
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(10, 32))
    vectors = centres[draw.integers(0, 10, 3000)] + draw.normal(size=(3000, 32))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    got = permutation_neighbours(frame, F.col("id") % 100 == 0).collect()
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hit = 0
    for q in range(0, 3000, 100):
        score = unit @ unit[q]
        score[q] = -9
        hit += len({*np.argsort(-score)[:5].tolist()} & {r.vec_id for r in got if r.query_id == q})
    assert hit / 150 >= 0.9


def test_footrule_counts_missing_pivots_as_last():
    ranked = np.array([[0, 1], [1, 0], [2, 3]])
    assert InvertedFiles(ranked, 4).footrule(np.array([[0, 1], [3, 2]])).tolist() == [[0, 2, 3], [3, 3, 2]]
    assert orders(np.array([[1.0, 0.1]]), np.eye(2), 2).tolist() == [[0, 1]]


def test_footrule_over_the_files_that_a_query_reads():
    draw = np.random.default_rng(5)
    whole = np.array([draw.permutation(12) for _ in range(40)])
    for prefix, reads in ((12, 12), (12, 3), (7, 3), (7, 7)):
        rows, asked = whole[:30, :prefix], whole[30:, :reads]
        place = lambda row, pivot: list(row).index(pivot) if pivot in row else prefix
        want = [[sum(abs(place(row, pivot) - at) for at, pivot in enumerate(query)) for row in rows] for query in asked]
        assert InvertedFiles(rows, 12).footrule(asked).tolist() == want


RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def brute_rule(host, path, rules):
    fits = []
    for verdict, rule in rules:
        name, slash, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + rest):
            fits.append(((name.count(".") + 1, len(slash + rest), verdict == "block"), rule, verdict))
    return max(fits, default=(None, None, "allow"))[1:]


def test_trie_equals_brute_force():
    rules = [*RULES, ("allow", "a.b.net"), ("block", "a.b.net/x"), ("allow", "a.b.net/x/y"), ("block", "com/e"), ("allow", "com/e"), ("block", "com/x/")]
    root = build_trie(rules)
    for host in ("", "net", "a.net", "xnet", "example.net", "q.example.net", "a.b.net", "c.a.b.net", "example.com", "org", "com", "net."):
        for path in ("", "/", "/en", "/en/", "/en/1", "/e", "/english", "/de/", "/fr/x/", "/x", "/x/", "/x/y", "/xy", "//x/"):
            found = longest(root, host, path)
            assert ((found[2], found[1]) if found else (None, "allow")) == brute_rule(host, path, rules), (host, path)


def test_url_parts_and_several_tries(spark):
    urls = ["http://A.Example.NET/en/1?x", "https://example.net", "https://example.net#a/en/", None, "no scheme", "x://://y/z", "", "http://a.net?/q",
            "http://b.org/fr/", "http://user@b.org:80/fr/", "http://É.net/"]
    frame = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate([*urls, urls[0]])], "page_id int, url string, host string, rule string")
    for most in (100, 1):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter(frame, RULES, max_rules=most).collect()}
        assert got[0] == got[11] == ("a.example.net", "/en/1", "example.net/en/", "allow")
        assert got[1] == ("example.net", "", None, "allow") and got[2] == ("example.net", "", None, "allow")
        assert got[3] == got[4] == got[6] == ("", "", None, "allow")
        assert got[5] == (":", "//y/z", None, "allow") and got[7] == ("a.net", "", None, "allow")
        assert got[8][2:] == ("org/fr/", "allow") and got[9] == ("user@b.org:80", "/fr/", None, "allow")
        assert got[10] == ("É.net", "/", "net/", "block")
    assert url_filter(frame.limit(0), RULES).collect() == []
    with pytest.raises(ValueError):
        build_trie([("maybe", "net/")])


EN, DE = "the cat and the dog went to the house with", "der hund und die katze gehen in das haus mit"


def test_languages_and_odd_rows(spark, make_docs, odd_docs, no_docs):
    draw = np.random.default_rng(2)
    rows = [(i, " ".join(draw.permutation(text.split())), lang, f"{lang}.host.org") for i, (text, lang) in enumerate([(EN, "en"), (DE, "de")] * 40)]
    model = fit_text_model(make_docs(rows))
    assert model.languages == ("de", "en")
    asked = [(1000, EN, None, None), (1001, DE, "en", "x"), (1002, "", "de", "de.host.org"), (1003, None, None, None), (1004, "12 34 !!", None, "en.host.org"),
             (None, DE, None, None), (1005, DE, "de", "de.host.org"), (1005, DE, "de", "de.host.org")]
    frame = make_docs(rows + asked).select("doc_id", *[c.alias(n) for n, c in document_evidence().items()])
    found = identify(frame, ("doc_id",), model).collect()
    got = {r.doc_id: r for r in found}
    assert len(found) == len(rows) + len(asked)
    assert all(got[r[0]].lang == r[2] and got[r[0]].accepted for r in rows)
    assert got[1000].lang == "en" and got[1001].lang == "de" and got[None].lang == "de"
    # Without letters the other evidence speaks, but the row is not accepted.
    assert got[1002].lang == "de" and not got[1002].accepted and got[1004].lang == "en" and not got[1003].accepted
    assert identify(odd_docs.select("doc_id", *[c.alias(n) for n, c in document_evidence().items()]), ("doc_id",), model).count() == odd_docs.count()
    assert fit_text_model(no_docs).languages == ()
    empty = no_docs.select("doc_id", *[c.alias(n) for n, c in document_evidence().items()])
    assert identify(empty, ("doc_id",), model).collect() == []
    assert identify(frame, ("doc_id",), fit_text_model(no_docs)).where("lang IS NULL AND NOT accepted").count() == len(found)


def test_many_languages_one_of_them_rare(make_docs):
    draw = np.random.default_rng(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows, number = [], 0
    for i in range(60):
        syllables = ["".join(draw.choice(list(letters), 3)) for _ in range(12)]
        for _ in range(3 if i == 59 else 25):
            words = ["".join(draw.choice(syllables, 2)) for _ in range(40)]
            rows.append((number := number + 1, " ".join(words), f"l{i:02d}", "s"))
    docs = make_docs(rows)
    model = fit_text_model(docs, language_rows=20)
    assert model.languages == tuple(f"l{i:02d}" for i in range(60))
    # By text alone.
    frame = docs.select("doc_id", F.col("text"), *[F.lit(None).cast("string").alias(c) for c in ("declared", "suffix", "host")])
    got = {r.doc_id: r.text_lang for r in identify(frame, ("doc_id",), model).collect()}
    assert np.mean([got[r[0]] == r[2] for r in rows]) > 0.98 and [got[r[0]] for r in rows[-3:]] == ["l59"] * 3


def test_texts_in_no_known_language_are_rejected(spark, make_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = ["Все люди рождаются свободными и равными в своем достоинстве и правах " * 3, "人人生而自由 在尊严和权利上一律平等 他们赋有理性和良心 " * 3,
           "xkqz wvbj qqxz zzkv jwqx vbkz xxqj kzvw qjxv zkwb " * 3,
           "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw, są oni obdarzeni rozumem i sumieniem",
           "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti, essi sono dotati di ragione e di coscienza",
           "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren, zij zijn begiftigd met verstand en geweten"]
    odd = [(-1 - i, text, lang, "s") for i, text in enumerate(odd) for lang in (None, "en")]
    # Codes and licences do not take a text out of its language.
    english, german = (docs.where((F.col("lang") == lang) & (F.length("text") > 200)).orderBy("doc_id").first()["text"] for lang in ("en", "de"))
    noted = [(-101, english[:60] + " token = \"2abc3ff2ca8fb1e4c565a0eb63815530a948bdde\"", "en", "s"),
             (-102, german[:30] + "\nLicensed under the Apache License, Version 2.0.", "de", "s"), (-103, english[:200].replace(" ", "### "), "en", "s"),
             (-104, english[:150] + " " + german[:150], "en", "s")]
    both = docs.unionByName(make_docs(odd + noted).select(docs.columns))
    found = identify(both.select("doc_id", *[c.alias(n) for n, c in document_evidence().items()]), ("doc_id",), fit_text_model(docs))
    rejected = [r for r in found.where("NOT accepted").collect()]
    assert sorted(r.doc_id for r in rejected if r.doc_id < 0) == sorted(r[0] for r in odd)
    assert all(r.lang is None for r in rejected if r.doc_id < 0)
    assert len(rejected) - len(odd) <= 0.001 * docs.count()


def test_page_evidence(spark):
    pages = spark.createDataFrame([(1, "https://a.b.example.de/x", '<html lang="de-AT"><script>var x = "the"</script><p>Hund &amp; Katze</p>'), (2, None, None)],
                                  "page_id bigint, url string, html string")
    rows = {r.page_id: r for r in pages.select("page_id", *[c.alias(n) for n, c in page_evidence().items()]).collect()}
    assert rows[1].declared == "de" and rows[1].suffix == "de" and rows[1].host == "a.b.example.de"
    assert rows[1].text.split() == ["Hund", "Katze"] and rows[2].text == "" and rows[2].host == ""


def test_quality_learns_from_positives_only(spark, make_docs, odd_docs, no_docs):
    draw = np.random.default_rng(3)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "tu") for b in ("ren", "sal", "tor", "vin")]
    rows, labels = [], []
    for i in range(600):
        good = i % 5 != 0
        text = " ".join(draw.choice(words, 60))
        rows.append((i, (text.capitalize() + ".") if good else text.upper().replace(" ", "!! ")))
        labels.append((i, int(good)))
    rows += [(None, "a b c"), (700, None), (701, ""), (1, "A repeated id.")]
    given = spark.createDataFrame(labels, "doc_id bigint, quality int")
    got = pu_scores(make_docs(rows), given).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    truth = dict(labels)
    for r in got:
        if r.doc_id in truth and r.doc_id != 1:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    right = [(r.score >= 0.7) == bool(truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert np.mean(right) >= 0.95
    # Negative labels and labels of the held-out fold change nothing.
    other = given.where((F.col("quality") == 1) & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2))
    again = {(r.doc_id, round(r.score, 9)) for r in pu_scores(make_docs(rows), other).collect()}
    assert again == {(r.doc_id, round(r.score, 9)) for r in got}
    assert pu_scores(no_docs, given).collect() == []
    assert {r.score for r in pu_scores(odd_docs, given.limit(0)).collect()} == {0.5}


def test_features_of_slices_and_prior():
    texts = pa.array(["", "Ab #1.\nAb", "é"])
    x = features(texts)
    assert x.shape == (3, len(FEATURES)) and not x[0].any()
    assert np.allclose(features(texts.slice(1)), x[1:])
    good, seen = np.zeros(10), np.zeros(10)
    good[9], seen[9], seen[0] = 50, 80, 20
    assert least_ratio(good, seen) == pytest.approx(0.8)
