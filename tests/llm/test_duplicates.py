"""Line dedup, n-gram Jaccard join and decontamination against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import time

import numpy as np
import pytest

from daygrid.llm import line_dedup, minhash_join, positional_index
from daygrid.llm.components import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def within_one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] or (len(a) < len(b) and a[i:] == b[i + 1 :]) or a == b


def test_one_edit_equals_the_definition():
    rng = random.Random(5)
    for _ in range(3000):
        a, b = ("".join(rng.choice("abé") for _ in range(rng.randint(0, 5))) for _ in range(2))
        assert line_dedup.within_one_edit(a, b) == within_one_edit(a, b), (a, b)


def kept_lines(rows, least):
    """The rule of the operator, pair by pair."""
    lines = []
    for doc, text in dict.fromkeys(rows):
        for no, line in enumerate((text or "").split("\n") if text is not None else []):
            lines.append(((doc is not None, doc or 0), no, line, line.strip(" ")))
    out = {}
    for at, no, line, bare in lines:
        gone = len(bare) >= least and any(
            (o, k) < (at, no) and len(other) >= least and within_one_edit(bare, other) for o, k, _, other in lines
        )
        out.setdefault(at, []).append((line, gone))
    return out


def edited(rng, line):
    k = rng.randrange(len(line))
    return rng.choice([line[:k] + line[k + 1 :], line[:k] + "é" + line[k:], line[:k] + "Z" + line[k + 1 :], line])


def test_line_dedup_equals_all_pairs(documents):
    rng = random.Random(3)
    base = ["".join(rng.choice("abc de") for _ in range(rng.randint(8, 14))) + "x" for _ in range(12)]
    rows = []
    for doc in range(40):
        text = "\n".join(edited(rng, rng.choice(base)) if rng.random() < 0.8 else rng.choice(["", "short", " pad  "]) for _ in range(rng.randint(0, 7)))
        rows.append((doc, text))
    rows += [(100, None), (101, ""), (102, "\n\n"), (102, "\n\n"), (None, base[0] + "\n" + base[1])]
    found = line_dedup.dedup_lines(documents(rows), min_chars=8).collect()
    want = kept_lines(rows, 8)
    assert len(found) == len(rows)
    for r in found:
        lines = want.get((r.doc_id is not None, r.doc_id or 0), [])
        assert r.n_lines == len(lines) and r.n_removed == sum(g for _, g in lines), r
        assert r.text == (None if r.doc_id == 100 else "\n".join(x for x, gone in lines if not gone))


def test_line_dedup_of_long_lines_and_a_very_common_one(documents):
    long = "word " * 20_000
    rows = [(k, "the very common line of this corpus\nown line of document number " + "x" * k) for k in range(60)]
    rows += [(90, long + "a"), (91, long + "b"), (92, "c" + long)]
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(documents(rows)).collect()}
    # Own lines differ by one letter from the one before, and are long enough from the third on.
    assert got == {0: 0, 1: 1, 2: 1} | {k: 2 for k in range(3, 60)} | {90: 0, 91: 1, 92: 0}


def test_line_dedup_of_a_document_of_many_lines(documents):
    rng = random.Random(8)
    lines = ["".join(rng.choices("abcdefghij ", k=40)) + "." for _ in range(100_000)]
    lines += ["the same line in a document of very many lines"] * 20_000
    began = time.time()
    (row,) = line_dedup.dedup_lines(documents([(1, "\n".join(lines))])).collect()
    assert (row.n_lines, row.n_removed) == (120_000, 19_999) and row.text == "\n".join(lines[:100_001])
    assert time.time() - began < 90


def test_line_dedup_of_nothing(documents):
    assert line_dedup.dedup_lines(documents([])).count() == 0


def grams(text, n=5):
    words = [w for w in re.split(r"[ \t-\r]+", (text or "").translate(LOW)) if w]
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def classes_by_pairs(rows, threshold=0.8):
    sets = [grams(t) for _, t in rows]
    links = {i: set() for i in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and both >= threshold * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                links[i].add(j)
                links[j].add(i)
    out = {}
    for i, (doc, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (doc, min(rows[j][0] for j in seen), len(links[i]))
    return sorted(out.values())


def near_copies(rng, n_docs):
    vocabulary = [f"w{k}" for k in range(400)]
    shared = " ".join(rng.choice(vocabulary) for _ in range(60))
    rows = []
    for doc in range(n_docs):
        if rows and rng.random() < 0.6:
            words = rng.choice(rows)[1].split()
            for _ in range(rng.choice([0, 1, 1, 2, 6])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((doc, " ".join(words)))
        else:
            own = " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 80, 150])))
            rows.append((doc, own + (" " + shared if rng.random() < 0.3 else "")))
    return rows


@pytest.mark.parametrize("block", [3, 256])
def test_jaccard_classes_equal_all_pairs(documents, block):
    rng = random.Random(block)
    rows = near_copies(rng, 90)
    rows += [(200, rows[0][1].upper()), (201, "one Two"), (202, "one two"), (203, "two one"), (204, "long " * 5000), (205, "long " * 5001)]
    found = minhash_join.jaccard_classes(documents(rows), recall=0.99999, block=block)
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in found.collect())
    assert got == classes_by_pairs(rows)


def test_jaccard_without_words_ids_or_rows(documents):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a b c d e f"), (4, "a b c d e f"), (None, "a b c d e f"), (None, "other words")]
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in minhash_join.jaccard_classes(documents(rows)).collect()), key=repr)
    assert got == sorted([(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 2), (4, 4, 2), (None, 4, 2), (None, None, 0)], key=repr)
    assert minhash_join.jaccard_classes(documents([])).count() == 0


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.998), (0.8, 0.9), (0.6, 0.99)):
        bands = minhash_join.banding(threshold, recall, 6)
        assert 1 - (1 - threshold**6) ** bands >= recall > 1 - (1 - threshold**6) ** (bands - 1)


def test_roots_of_marked_pairs_equal_roots_of_listed_ones():
    rng = np.random.default_rng(6)
    for share in (0.0, 0.02, 0.1, 0.9):
        for left, right in ((np.arange(30), np.arange(30)), (np.arange(17), np.arange(17, 30)), (np.arange(30), np.arange(0))):
            close = rng.random((len(left), len(right))) < share
            i, j = np.nonzero(close)
            assert (minhash_join._dense_roots(30, left, right, close) == minhash_join._roots(30, left[i], right[j])).all()


def test_spanning_reaches_what_all_pairs_reach():
    rng = np.random.default_rng(7)
    middles = rng.integers(0, 256, (6, 40), dtype=np.uint8)
    signed = middles[rng.integers(6, size=120)]
    noise = rng.random(signed.shape) < rng.choice([0.05, 0.2, 0.35], 120)[:, None]
    signed = np.where(noise, rng.integers(0, 256, signed.shape, dtype=np.uint8), signed)
    for left, right in ((np.arange(120), np.arange(120)), (np.arange(50), np.arange(50, 120)), (np.arange(0), np.arange(9))):
        alike = (signed[left][:, None] == signed[right][None]).mean(axis=2)
        i, j = np.nonzero((alike - 1 / 256) / (1 - 1 / 256) >= 0.65)
        want = minhash_join._roots(120, left[i], right[j])
        got = minhash_join.spanning(signed, left, right, 0.65)
        assert len(set(zip(want.tolist(), got.tolist(), strict=True))) == len(set(want.tolist())) == len(set(got.tolist()))


def test_overlaps_equal_sets():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200))).astype(np.uint64) for _ in range(9)]
    got = minhash_join.overlaps(sets, np.arange(9), np.arange(9))
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) or i == j for i in range(9) for j in range(9))


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 201), (201, 200), (7, 7)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "u int, v int")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)} | {200: 200, 201: 200}


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contaminated(rows, items, width=10):
    windows = {}
    for item, text in items:
        words = WORD.findall((text or "").translate(LOW))
        for s in range(max(1, len(words) - width + 1)) if words else ():
            windows.setdefault(tuple(words[s : s + width]), set()).update([] if item is None else [str(item)])
    out = []
    for doc, text in rows:
        words = WORD.findall((text or "").translate(LOW))
        hit, found = set(), set()
        for size in {len(w) for w in windows}:
            for s in range(len(words) - size + 1):
                got = windows.get(tuple(words[s : s + size]))
                if got is not None:
                    hit |= set(range(s, s + size))
                    found |= got
        out.append((doc, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def test_decontamination_equals_a_scan(spark, documents):
    rng = random.Random(6)
    vocabulary = ["the", "of", "a", "Élan", "née", "x1", "y2"] + [f"t{k}" for k in range(30)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.choice([4, 10, 14, 30]))) for k in range(25)]
    items += [(30, None), (31, "..."), (32, "One"), (33, items[0][1]), (34, "the the the the the the the the the the the the"), (None, "odd words here")]
    rows = []
    for doc in range(60):
        parts = [text(rng.randint(0, 25))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            words = (rng.choice(items)[1] or "").split()
            a = rng.randrange(max(1, len(words)))
            parts += [" ".join(words[a : a + rng.choice([9, 10, 12, 40])]).upper().replace("É", "É"), text(3)]
        rows.append((doc, rng.choice([" ", ", ", "\n"]).join(parts)))
    rows += [(70, None), (71, ""), (72, "the " * 30_000), (72, "the " * 30_000), (72, "one"), (None, items[3][1])]
    benchmark = spark.createDataFrame([(*i, "w") for i in items], "item_id bigint, text string, word string")
    found = positional_index.digest(positional_index.decontaminate(documents(rows), benchmark))
    assert sorted(map(tuple, found.collect()), key=repr) == contaminated(rows, items)


def test_decontamination_of_empty_tables(spark, documents):
    benchmark = spark.createDataFrame([], "item_id bigint, text string")
    found = positional_index.decontaminate(documents([(1, "some words")]), benchmark).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in found] == [(2, 0, False)]
    one = spark.createDataFrame([(1, "some words")], "item_id bigint, text string")
    assert positional_index.decontaminate(documents([]), one).count() == 0


def test_proximity_in_any_order(spark, documents):
    rows = [(1, "b x a y c"), (2, "a b x x x x x x x x c"), (3, "a c"), (4, "c b a"), (5, "b a z c b")]
    windows = positional_index.test_windows(spark.createDataFrame([(1, "a b c")], "item_id bigint, text string"))
    postings = positional_index.index(documents(rows), windows)
    ranked = positional_index.ranked_terms(postings, windows)
    got = {r.doc_id for r in positional_index.proximity_matches(postings, ranked, 4).collect()}
    assert got == {1, 4, 5}
    assert {r.doc_id for r in positional_index.phrase_matches(postings, ranked).collect()} == set()
