from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from txnflow.llm import queries
from txnflow.llm.html_text import extract_text, main_text
from txnflow.llm.runs import find_runs, periodic_runs
from txnflow.llm.whitening import leading_eigen, whiten

SMALL = "/root/testdata/sf0.001"


# -- periodic runs -----------------------------------------------------------------------------------------------------


def brute_runs(words, least=12):
    """All runs as (start, length, period), by every period and place."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - s >= q and i - s + q >= least:
                found.setdefault((s, i - s + q), q)
            i += 1
    return sorted((s, length, q) for (s, length), q in found.items())


def collapsed(words, runs):
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def of_texts(texts):
    ends = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    flat = np.array([x for t in texts for x in t], np.int64)
    out = [[] for _ in texts]
    for i, *run in zip(*map(np.ndarray.tolist, find_runs(flat, ends)), strict=True):
        out[i].append(tuple(run))
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1), max_size=90) | st.lists(st.integers(0, 3), max_size=90), max_size=4))
def test_runs_of_any_words(texts):
    assert of_texts(texts) == [brute_runs(t) for t in texts]


def test_runs_of_texts_that_repeat_themselves():
    draw = random.Random(6)
    texts = []
    for _ in range(250):
        root = [draw.randrange(draw.choice([1, 2, 9])) for _ in range(draw.randrange(1, 60))]
        text = (root * 12)[:draw.randrange(200)]
        for _ in range(draw.randrange(3)):
            if text:
                text[draw.randrange(len(text))] = draw.randrange(3)
        texts.append(text)
        # Two regions of one small period that meet out of step: their squares have no synchronising places.
        small = [draw.randrange(2) for _ in range(draw.randrange(1, 5))]
        texts.append((small * 30)[:draw.randrange(70)] + (small * 30)[:draw.randrange(70)] + (small * 9)[1:])
    fibonacci, before = [0, 1], [0]
    while len(fibonacci) < 300:
        fibonacci, before = fibonacci + before, fibonacci
    texts.append(fibonacci[:300])
    assert of_texts(texts) == [brute_runs(t) for t in texts]


def test_long_periods():
    draw = np.random.default_rng(3)
    text = [*range(50), *np.tile(draw.integers(0, 10**6, 4000), 3)[:9500].tolist(), *range(70)]
    assert of_texts([text, [1] * 5000]) == [[(50, 9500, 4000)], [(0, 5000, 1)]]


def test_runs_of_odd_and_empty_tables(odd_docs, no_docs):
    got = periodic_runs(odd_docs).collect()
    want = []
    for row in odd_docs.collect():
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", row.text or "") if w]
        # The long text repeats a root of 997 words and has no other run.
        runs = brute_runs(words) if len(words) < 1000 else [(0, 60_000, 997)]
        want.append((row.doc_id, runs, collapsed(words, runs)))
    assert sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=str) == sorted(want, key=str)
    assert periodic_runs(no_docs).collect() == []


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def test_runs_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in queries.op11_synchronised_runs(spark, SMALL).collect()}
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for doc_id, text in rows:
        words = planted(doc_id, [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w])
        if len(words) > 1500:
            continue  # brute force over every period takes the square of the words
        runs = brute_runs(words)
        row = got[doc_id]
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (best[1] * 1000 // best[2] if runs else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()


# -- main text of pages ------------------------------------------------------------------------------------------------

PROSE = "This paragraph has some length, commas, and stops. It goes on, as articles do; really."


def page(body):
    return f"<!DOCTYPE html><html><head><title>Title, not text.</title><style>p{{}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize(("body", "want"), [
    (f"<div id=sidebar><p>{PROSE}</p></div><div class=post><h1>Head</h1><p>{PROSE}</p><p>Short.</p></div><div id='footer'>Foot, too.</div>",
     ["Head", PROSE, "Short."]),
    (f"<main><h1>Head</h1><p>{PROSE}</p><section class='comments'><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p></section></main>", ["Head", PROSE]),
    (f"<article><p>{PROSE}</p></article><article class=comment><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p></article>", [PROSE]),
    (f"<div class='has-sidebar with-comments'><article><p>{PROSE}</p></article></div>", [PROSE]),
    (f"<h1>Head</h1><p>{PROSE}</p><p>Short.</p><p>{PROSE}</p><div class='cookie-notice'>We use cookies, as all do.</div>", ["Head", PROSE, "Short.", PROSE]),
    (f"<article><p>{PROSE}</p><form><label>Mail, please</label><textarea>x</textarea></form><aside>{PROSE}</aside><ul><li>one</li><li>two</li></ul></article>",
     [PROSE, "one", "two"]),
    (f"<article><header><h2>Sub</h2><p>by me</p></header><p>{PROSE}</p><ul><li><a href=x>More of it</a></li><li><a href=y>And more</a></li></ul></article>",
     ["Sub", PROSE]),
    ("<div class=ad>Buy, buy, buy now. It is cheap.</div><article><p>Hi.</p></article>", ["Hi."]),
    ("<article><p>a&nbsp;b\n <b>c</b>d &#39;x&#x27; &copy; &amp;lt; 1 < 2<br>e</article>", ["a b cd 'x' © &lt; 1 < 2 e"]),
    (f"<article><p><b>one.<br><p>{PROSE}</p><p hidden>{PROSE}</p><p style='display:none'>{PROSE}</p><script>var t='</p>';</script></article>", ["one.", PROSE]),
])
def test_main_text_of_pages(body, want):
    assert main_text(page(body)) == "\n".join(want)


def test_main_text_of_broken_pages():
    assert main_text("") == "" and main_text("<p></p> \n") == "" and main_text("<script>x</script>") == ""
    assert main_text("just text &amp; more < 5") == "just text & more < 5"
    assert main_text("<p>a<p>b<!-- never closed") == "a\nb"
    assert main_text("<div>" * 20_000 + "deep" + "</p>" * 20_000) == "deep"
    assert main_text('<a title="' * 20_000) == ""


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='ad'>", "</div>", "<table><tr><td>", "</table>", "<ul><li>", "</ul>", "<a href='>'>", "</a>", "text, and. ",
                                 "&amp;", "<", ">", "\"", "<!--", "-->", "<article>", "</article>", "<script>", "</script>", "<h1>", "</h1>", "é 日本 "]), max_size=30))
def test_any_markup_gives_some_text(parts):
    text = main_text("".join(parts))
    assert "\n\n" not in text and text == text.strip() and not re.search(r"[^\S\n]{2}|\t", text)


def test_pages_of_odd_and_empty_tables(spark):
    schema = "page_id bigint, url string, html string, text string, id int"
    rows = [(1, "http://a.b/", page(f"<article><p>{PROSE}</p></article>"), "t", 1), (1, "http://a.b/", page(f"<article><p>{PROSE}</p></article>"), "t", 1),
            (None, None, None, None, None), (2, "u", "", None, 1), (3, "u", page(f"<p>{'long words, '* 200_000}</p>"), "", 1)]
    got = {(r.page_id, r.url): r.text for r in extract_text(spark.createDataFrame(rows, schema)).collect()}
    assert got[(1, "http://a.b/")] == PROSE and got[(None, None)] == "" and got[(2, "u")] == "" and len(got[(3, "u")]) == 12 * 200_000 - 1
    assert extract_text(spark.createDataFrame(rows, schema)).count() == 5
    assert extract_text(spark.createDataFrame([], schema)).collect() == []


def test_pages_query_keeps_whole_articles(spark):
    from html import unescape

    rows = {r.page_id: r for r in queries.op12_tag_path_text(spark, SMALL).collect()}
    for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(unescape(re.sub(r"</?b>", "", part.replace("<br>", " "))).split()) for part in re.split(r"</?(?:p|h1)>", article)]
        want = "\n".join(part for part in parts if part)
        assert (rows[r.page_id].text, rows[r.page_id].url, rows[r.page_id].n_chars) == (want, r.url, len(want))


# -- whitening ---------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("values", [
    np.linspace(100, 1, 40), np.ones(40), np.r_[np.full(20, 5.0), np.full(20, 5.0 + 1e-8)], 10.0 ** -np.arange(12), np.array([3.0]), np.array([2.0, 2.0]), np.zeros(5)])
def test_eigenvalues_and_vectors(values):
    draw = np.random.default_rng(1)
    basis, _ = np.linalg.qr(draw.standard_normal((len(values), len(values))))
    matrix = basis @ np.diag(values) @ basis.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = leading_eigen(matrix, 16)
    want = np.linalg.eigvalsh(matrix)[::-1][:16]
    size = max(values.max(), 1e-300)
    assert np.abs(found - want).max() <= 1e-13 * size
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * found).max() <= 1e-13 * size


def check_whitening(rows, vectors, components=16):
    """``rows`` against plain numpy; ``vectors`` are (id, list) of those that take part."""
    x = {i: np.floor(64 * np.asarray(v, np.float64)).astype(np.int64) + 1_000_000 for i, v in vectors}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    covariance = centred.T @ centred / n
    e, u = np.linalg.eigh(covariance)
    e, u = e[::-1], u[:, ::-1]
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert set(by) == set(x)
    k = max(max(c) for c in by.values())
    assert k == min(components, int((e > 1e-10 * e[0]).sum()))
    errors = {r.identity_error for r in rows}
    assert len(errors) == 1 and 0 <= errors.pop() < 1e-4
    for c in range(1, k + 1):
        want = {i: (v - sums / n) @ u[:, c - 1] / np.sqrt(e[c - 1]) for i, v in x.items()}
        some = max(want, key=lambda i: abs(want[i]))
        sign = np.sign(want[some] * by[some][c].whitened)
        for i in x:
            assert abs(by[i][c].whitened - sign * want[i]) < 1e-8
            assert by[i][c].n == n and abs(by[i][c].explained - e[c - 1] / np.trace(covariance)) <= 1e-9
            assert by[i][c].deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[i], sums, strict=True))


def test_whitening_equals_numpy(spark):
    got = queries.op13_whitening(spark, SMALL).collect()
    check_whitening(got, [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()])


def test_whitening_of_odd_and_empty_tables(spark):
    schema = "vec_id bigint, embedding array<float>, x int, c string, n int"
    draw = np.random.default_rng(4)
    good = [(i, [float(v) for v in draw.standard_normal(5).astype(np.float32)]) for i in range(60)]
    good += [(100 + i, good[0][1]) for i in range(40)]
    odd = [(200, None), (201, [1.0, None, 1.0, 1.0, 1.0]), (202, [float("nan")] * 5), (203, [float("inf")] * 5), (204, []), (205, [1.0]), (206, [1e30] * 5)]
    frame = lambda rows: spark.createDataFrame([(i, v, 1, "c", 2) for i, v in rows], schema)
    check_whitening(whiten(frame(good + odd), components=16).collect(), good)
    check_whitening(whiten(frame(good), components=2).collect(), good, components=2)
    # Rows that repeat, null ids, too few vectors, and a dimension that never varies.
    assert whiten(frame([*good, good[0], (None, good[1][1])]), components=2).count() == 2 * 102
    assert whiten(frame([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == [] and whiten(frame(odd[:4])).collect() == [] and whiten(frame([])).collect() == []
    flat = [(i, [float(i), 3.0]) for i in range(9)]
    check_whitening(whiten(frame(flat)).collect(), flat)
