"""Fusion of language evidence, risk of the quality model and packing, each worked out again in plain Python."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnflow.llm import quality
from txnflow.llm.language import document_evidence, fit_text_model, identify
from txnflow.llm.packing import plan_bins

SF = "/root/testdata/sf0.01"


# Languages

EN, DE = "the cat and the dog went", "der hund und die katze gehen"


def letter_triples(text):
    """Each letter with its neighbours, breaks as blanks, but for the first and last character of the text."""
    plain = "".join(c if c.isalpha() else " " for c in text.lower())
    return [plain[i - 1:i + 2] for i in range(1, len(plain) - 1) if plain[i] != " "]


def fused_by_hand(rows, buckets=1 << 16, smoothing=0.5, weight=40.0, strength=10.0):
    """Best language and its probability for rows of (id, text, declared, suffix, host)."""
    langs = ["de", "en"]
    counts = {l: Counter() for l in langs}
    for _, text, declared, *_ in rows:
        if declared in counts:
            counts[declared].update(letter_triples(text))
    total = {l: sum(counts[l].values()) for l in langs}
    most = max(total.values())
    chance = {l: lambda t, l=l: math.log((counts[l][t] * most / total[l] + smoothing) / (most + smoothing * buckets)) for l in langs}
    known = set(counts["de"]) | set(counts["en"])

    texts, best = {}, {}
    for i, text, *_ in rows:
        triples = [t for t in letter_triples(text) if t in known]
        share = min(len(triples), weight) / max(1, len(triples))
        texts[i] = {l: share * sum(chance[l](t) for t in triples) for l in langs}
        best[i] = max(langs, key=lambda l: (texts[i][l], -langs.index(l))) if triples else None

    def votes(key):
        found = defaultdict(Counter)
        for row in rows:
            if best[row[0]] and key(row) is not None:
                found[key(row)][best[row[0]]] += 1
        return found

    def domain(host):
        return host and ".".join(host.split(".")[-2:])

    whole = Counter(b for b in best.values() if b)
    prior = {l: (whole[l] + 1 / len(langs)) / (whole.total() + 1) for l in langs}
    declared, suffix, hosts, domains = votes(lambda r: r[2]), votes(lambda r: r[3]), votes(lambda r: r[4]), votes(lambda r: domain(r[4]))
    found = {}
    for i, _, said, end, host in rows:
        own = Counter([best[i]] if best[i] else [])
        joint = {}
        for l in langs:
            p = prior[l]
            if host in hosts:
                for seen in (domains[domain(host)], hosts[host]):
                    p = (seen[l] - own[l] + strength * p) / (seen.total() - own.total() + strength)
            joint[l] = texts[i][l] + math.log(p)
            for value, channel in ((said, declared), (end, suffix)):
                if value in channel:
                    joint[l] += math.log(channel[value][l] + 0.5) - math.log(whole[l] + 1)
        top = max(langs, key=lambda l: (joint[l], -langs.index(l)))
        found[i] = (top, 1 / sum(math.exp(v - joint[top]) for v in joint.values()))
    return found


def test_fusion_by_hand(spark):
    draw = random.Random(4)
    rows = []
    for i in range(90):
        lang = ("en", "de")[i % 2]
        words = (EN if lang == "en" else DE).split()
        draw.shuffle(words)
        # Now and then a few words only, no text, no declaration, or the wrong one.
        text = " ".join(words[:draw.choice([6, 6, 6, 1, 0])])
        declared = draw.choice([lang, lang, None, "fr-x", "en"])
        host = draw.choice([f"{lang}.alpha.org", "mixed.beta.net", f"{lang}.beta.net", None])
        rows.append((i, text, declared, draw.choice([lang, "org", None]), host))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, declared string, suffix string, host string")
    # The text model learns from rows that are declared as one of the two.
    model = fit_text_model(frame.where("declared IN ('de', 'en')").select("text", F.col("declared").alias("lang")))
    want = fused_by_hand(rows)
    found = identify(frame, ("doc_id",), model).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.lang == want[r.doc_id][0], (rows[r.doc_id], r, want[r.doc_id])
        assert r.probability == pytest.approx(want[r.doc_id][1], rel=1e-4)


def test_languages_of_documents_that_were_not_learnt_from(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2
    model = fit_text_model(docs.where(fold == 0))
    other = docs.where(fold == 1)
    # By text alone, and with what the source says; the declaration is the answer and is kept out.
    evidence = {name: F.lit(None).cast("string") if name == "declared" else c for name, c in document_evidence().items()}
    found = identify(other.select("doc_id", *[c.alias(n) for n, c in evidence.items()]), ("doc_id",), model)
    measured = found.join(other.select("doc_id", F.col("lang").alias("truth")), "doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("lang") == F.col("truth")).alias("fused"),
        F.count_if(F.col("text_lang") == F.col("truth")).alias("by_text"), F.count_if("accepted").alias("accepted")).first()
    assert measured.n > 100
    assert min(measured.fused, measured.by_text) >= 0.97 * measured.n and measured.accepted >= 0.99 * measured.n


# Quality

def risks(w, p, u, prior):
    """Risk of positives as good, and what unlabelled text has beyond positives as bad, with the logistic loss."""
    good = np.log1p(np.exp(-(p @ w))).mean()
    bad = np.log1p(np.exp(u @ w)).mean() - prior * np.log1p(np.exp(p @ w)).mean()
    return prior * good, bad


def test_gradient_by_finite_differences(monkeypatch):
    draw = np.random.default_rng(8)
    positive, unlabelled = draw.normal(1, 1, (40, 3)), draw.normal(0, 2, (60, 3))
    caught = []
    monkeypatch.setattr(quality, "descend", lambda model, gradient, *rest: caught.append(gradient))
    for prior in (0.3, 0.9):
        quality.fit(positive, unlabelled, prior)
        mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-3
        p, u = (np.c_[np.clip((x - mean) / scale, -8, 8), np.ones(len(x))] for x in (positive, unlabelled))
        signs = set()
        for _ in range(60):
            w = draw.normal(0, 2, 4)
            bad = risks(w, p, u, prior)[1]
            signs.add(bad >= 0)
            # Below zero the model has begun to fit noise: the step goes back up that risk.
            risk = (lambda v: sum(risks(v, p, u, prior))) if bad >= 0 else (lambda v: -risks(v, p, u, prior)[1])
            slopes = [(risk(w + step) - risk(w - step)) / 2e-6 for step in np.eye(4) * 1e-6]
            assert np.allclose(caught[-1](w), slopes, atol=1e-6)
        assert prior == 0.3 or signs == {True, False}


# Packing

def naive_bins(lengths, capacity):
    """Piece by piece: the longest that fits, then the smallest gives way to the two that fill its gap best."""
    left, bins = sorted(lengths), []
    while left:
        own = []
        while fitting := [x for x in left if x <= capacity - sum(own)]:
            own.append(fitting[-1])
            left.remove(fitting[-1])
        while sum(own) < capacity:
            smallest = min(own)
            room = capacity - sum(own) + smallest
            pairs = [(a + b, -a) for i, a in enumerate(left) for b in left[i + 1:] if smallest < a + b <= room]
            if not pairs:
                break
            total, first = max(pairs)
            own.remove(smallest)
            for x in (-first, total + first):
                own.append(x)
                left.remove(x)
            left = sorted([*left, smallest])
        bins.append(tuple(sorted(own)))
    return Counter(bins)


@pytest.mark.parametrize("capacity", [7, 12, 30, 64])
def test_bins_piece_by_piece(capacity):
    draw = random.Random(capacity)
    for _ in range(40):
        lengths = [draw.randint(1, capacity) if draw.random() < 0.7 else draw.randint(1, 3) for _ in range(draw.randint(0, 60))]
        planned = Counter()
        for times, used in plan_bins(Counter(lengths), capacity):
            planned[tuple(sorted(x for x, n in used.items() for _ in range(n)))] += times
        assert planned == naive_bins(lengths, capacity)
