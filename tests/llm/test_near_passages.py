from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from txnflow.llm.components import components
from txnflow.llm.passages import remove_repeats
from txnflow.llm.simhash import LOWER, keep_one, links, near_duplicates


def fingerprint(text, k=3):
    words = (text or "").encode().translate(LOWER).split()
    runs = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    values = [xxhash.xxh64_intdigest(x, 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def least_reachable(values, edges):
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {v: find(v) for v in values}


def brute(rows):
    prints = [fingerprint(text) for _, text in rows]
    found = least_reachable(range(len(rows)), [
        (i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3])
    least = defaultdict(list)
    for i, root in found.items():
        least[root].append(rows[i][0])
    known = {root: min((x for x in ids if x is not None), default=None) for root, ids in least.items()}
    return sorted(((rows[i][0], f"{prints[i]:016x}", known[found[i]]) for i in range(len(rows))), key=str)


def texts_with_near_copies(n=60):
    draw = random.Random(5)
    out = []
    for i in range(n):
        words = [f"w{draw.randrange(4000)}" for _ in range(draw.choice([3, 40, 300]))]
        out.append((10 * i + 5, " ".join(words)))
        for j in range(draw.randrange(4)):
            copy = list(words)
            copy[draw.randrange(len(copy))] = f"new{j}"
            out.append((10 * i + 6 + j, " ".join(copy)))
    return out


def test_contract_equals_brute_force(make_docs, odd_docs, no_docs):
    rows = texts_with_near_copies()
    got = near_duplicates(make_docs(rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted(map(tuple, near_duplicates(odd_docs).collect()), key=str) == brute(rows)
    assert near_duplicates(no_docs).collect() == []


@pytest.mark.parametrize("crowded", [2000, 3])
def test_links_are_all_close_pairs(spark, crowded):
    draw = np.random.default_rng(2)
    base = draw.integers(0, 1 << 63, 6, dtype=np.uint64)
    near = [b ^ np.bitwise_or.reduce(np.uint64(1) << draw.integers(0, 64, draw.integers(1, 5)).astype(np.uint64)) for b in base for _ in range(40)]
    values = np.unique(np.concatenate([base, np.array(near, np.uint64)])).view(np.int64)
    frame = spark.createDataFrame([(0, int(v)) for v in values], "view int, fp bigint")
    got = [(r.a, r.b) for r in links(frame, crowded=crowded).collect()]
    want = {(int(a), int(b)) for a in values for b in values if a < b and (int(a) ^ int(b) & (1 << 64) - 1).bit_count() <= 64
            and bin((int(a) ^ int(b)) & (1 << 64) - 1).count("1") <= 3}
    assert len(got) == len(set(got)) and set(got) == want


def test_components_of_chains_and_stars(spark):
    draw = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 540)] + [(draw.randrange(1000, 1080), draw.randrange(1000, 1080)) for _ in range(60)]
    draw.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    touched = {x for e in edges for x in e if e[0] != e[1]}
    want = least_reachable(touched, [e for e in edges if e[0] != e[1]])
    assert got == want
    assert components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


def test_keep_one_keeps_the_first_of_each_group(make_docs, odd_docs, no_docs):
    rows = texts_with_near_copies()
    least = {i: root for i, _, root in brute(rows)}
    kept = keep_one(make_docs(rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, root in least.items() if i == root)
    assert len(set(least.values())) < len(rows)
    # Ties of ids, nulls and repeated rows: one row of each text that is first, with all its columns.
    odd = [(r.doc_id, r.text or "") for r in odd_docs.collect()]
    roots = {}
    for (i, text), (_, print_, root) in zip(sorted(odd, key=str), sorted(brute(odd), key=str), strict=True):
        roots.setdefault(root, []).append((i, text, print_))
    left = keep_one(odd_docs)
    assert left.columns == odd_docs.columns
    assert {r.doc_id for r in left.collect()} == set(roots)
    assert keep_one(no_docs).collect() == []


MARKS = ".,;:!?\"'()[]|*#-"


def plain(text):
    """Words and their places, in lower case without outer marks."""
    words = [(m.start(), m.end()) for m in re.finditer(r"[^ \t-\r]+", text)]
    return words, [text[a:b].lower().strip(MARKS) or text[a:b].lower() for a, b in words]


def brute_spans(rows, min_words=30, line_words=5):
    """Spans to remove from each text, from all windows of ``min_words`` words, all lines and all paragraphs that stand at an earlier place."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    seen, found = set(), {}
    for i in order:
        text = rows[i][1] or ""
        places, words = plain(text)
        covered = [False] * len(words)
        for j in range(len(words) - min_words + 1):
            window = tuple(words[j:j + min_words])
            if window in seen:
                covered[j:j + min_words] = [True] * min_words
            seen.add(window)
        spans = []
        for j, word in enumerate(places):
            if covered[j]:
                if j and covered[j - 1]:
                    spans[-1] = (spans[-1][0], word[1])
                else:
                    spans.append(word)
        # Lines that hold words, and blocks of them between lines that hold none.
        at, block = 0, []
        for line in [*text.splitlines(keepends=True), None]:
            own = plain(line)[1] if line is not None else []
            if own:
                block.append((at, at + len(line), own))
            elif block:
                whole = [w for _, _, ws in block for w in ws]
                units = [(a, b, ("line", *ws)) for a, b, ws in block]
                units += [(block[0][0], block[-1][1], ("paragraph", *whole))] if len(block) > 1 else []
                for a, b, key in units:
                    if len(key) > line_words:
                        if key in seen:
                            spans.append((a, b))
                        seen.add(key)
                block = []
            at += len(line or "")
        merged = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        found[i] = merged
    return [found[i] for i in range(len(rows))]


def without(text, spans):
    for a, b in reversed(spans):
        text = text[:a] + text[b:]
    return text


def check_passages(make_docs, rows, **options):
    got = sorted(remove_repeats(make_docs(rows), **options).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    spans = brute_spans(rows, **options)
    want = sorted(((i, without(text, s) if s else text, s) for (i, text), s in zip(rows, spans, strict=True)), key=lambda r: (r[0] is None, r[0]))
    for row, expected in zip(got, want, strict=True):
        assert (row.doc_id, row.text, [(x.start, x.stop) for x in row.removed]) == expected
    return {r.doc_id: r for r in got}


@pytest.mark.parametrize("min_words", [12, 30, 50])
def test_passages_equal_brute_force(make_docs, min_words):
    draw = random.Random(min_words)
    some = lambda n: [f"w{draw.randrange(10**6)}" for _ in range(n)]
    sources = [some(draw.randrange(min_words - 3, 3 * min_words)) for _ in range(6)]
    rows = []
    for i in range(25):
        words = some(draw.randrange(60))
        for _ in range(draw.randrange(4)):
            words += draw.choice(sources) + some(draw.randrange(1, 90))
        marked = [w.upper() if draw.random() < 0.1 else w + draw.choice(["", "", "", ".", ",", "\n", " ", "!\n\n", "\u00e9"[:0]]) for w in words]
        rows.append((7 * i, " ".join(marked)))
    rows += [(500, None), (501, ""), (None, rows[3][1]), (502, rows[4][1]), (503, "word " * 200), (504, "word " * 200 + " ".join(some(40)))]
    found = check_passages(make_docs, rows, min_words=min_words)
    assert sum(bool(r.removed) for r in found.values()) > 8


def test_passages_are_cut_but_for_their_first_place(make_docs):
    draw = random.Random(7)
    sentence = lambda n: " ".join(f"w{draw.randrange(9999)}" for _ in range(n)).capitalize() + ". "
    passage = "".join(sentence(12) for _ in range(5))
    line = " ".join(f"l{i}" for i in range(60))
    rows = [(i, "".join(sentence(15) for _ in range(6))) for i in range(8)]
    rows += [(10 + i, sentence(20) + passage + sentence(9) + "\n" + line + "\n" + sentence(5)) for i in range(5)]
    rows += [(20, sentence(4) + "Yes. No.\n"), (21, "Yes. No.\n" + sentence(7)), (22, None), (23, ""), (None, passage + sentence(3))]
    got = check_passages(make_docs, rows)
    assert passage.strip() in got[10].text and line in got[10].text
    for i in (11, 12, 13, 14, None):
        assert passage.strip() not in got[i].text and got[i].text
    assert got[21].removed == [] and got[22].text is None


def test_passages_are_cut_wherever_they_begin(make_docs):
    draw = random.Random(21)
    some = lambda n: [f"w{draw.randrange(10**6)}" for _ in range(n)]
    # Without sentence marks, and with long sentences at both ends that run on into other text.
    bare, short, ends = some(50), some(49), some(70)
    ends = [f"{word}." if i in (28, 40) else word for i, word in enumerate(ends)]
    rows, want = [], {}
    for i in range(6):
        before, between, after = some(draw.randrange(3, 90)), some(30), some(40)
        rows.append((i, " ".join([*before, *bare, *between, *ends, *after, *short, *some(4)])))
        want[i] = [w for w in rows[i][1].split() if i == 0 or w not in {*bare, *ends}]
    got = {r.doc_id: r.text.split() for r in remove_repeats(make_docs(rows), min_words=50).collect()}
    assert got == want
    check_passages(make_docs, rows, min_words=50)


def test_later_copies_of_lines_and_paragraphs_go(make_docs):
    licence, verse = "This work is licensed under the GNU General Public License.", "one rose\ntwo roses\nthree red roses"
    rows = [(i, f"Text {i} of its own.\n{licence}\nRead more\nAll that number {i} says.\n\n{verse}\n\nEnd {i}.") for i in range(4)]
    got = {i: r.text for i, r in check_passages(make_docs, rows).items()}
    assert got[0] == rows[0][1]
    for i in range(1, 4):
        assert got[i] == f"Text {i} of its own.\nRead more\nAll that number {i} says.\n\n\nEnd {i}."


def test_odd_documents_and_columns(odd_docs, no_docs):
    rows = remove_repeats(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert [r for r in rows if r.doc_id == 3][0].text is None
    assert remove_repeats(no_docs).collect() == []
    assert remove_repeats(odd_docs).where(F.col("row") == "r").count() == len(rows)
    # Rows of one id are one document; a column of the result's name is replaced, others stay.
    own = remove_repeats(odd_docs, removed_column="cut")
    assert [r.removed for r in own.collect()] == [1] * len(rows) and "cut" in own.columns
