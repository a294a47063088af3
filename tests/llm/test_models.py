"""Learned operators: held-out accuracy, exact distributions, and texts at the edges."""

from __future__ import annotations

import collections
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from daygrid.llm import html_blocks, katz, mil_quality, ppm_language
from daygrid.llm.common import bucket_of, table

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.01"


def crc(doc, n):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % n


# ---- quality ---------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    documents, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    found = mil_quality.digest(mil_quality.scored(documents, mil_quality.train(documents, labels)))
    rows = found.join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in rows)
    assert len(rows) > 50 and right / len(rows) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_quality_does_not_learn_from_the_held_out_fold(spark, documents):
    docs = documents([(k, f"words {k}") for k in range(40)])
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(40) if crc(k, 4) == 2], "doc_id bigint, quality int, toxic int")
    assert mil_quality.train(docs, labels) is None


def test_quality_at_the_edges(spark, documents):
    rows = [(k, ("good words here " if k % 2 else "$$$ %%% !! ") * (1 + k % 7)) for k in range(80)]
    rows += [(90, None), (91, ""), (92, " \n "), (93, "word " * 30_000), (94, "good words here"), (94, "good words here"), (None, "x")]
    labels = spark.createDataFrame(
        [(k, k % 2, 0, 1) for k in range(60)] + [(1, 0, 0, 1), (2, None, 0, 1), (None, 1, 0, 1), (3, 7, 0, 1)],
        "doc_id bigint, quality int, toxic int, h int",
    )
    docs = documents(rows)
    model = mil_quality.train(docs, labels)
    found = mil_quality.scored(docs, model).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    by_id = collections.defaultdict(list)
    for r in found:
        by_id[r.doc_id].append(r.score)
    assert by_id[94][0] == by_id[94][1] and by_id[90] == by_id[91]
    assert min(by_id[k][0] for k in range(61, 80, 2)) > 0.7 > max(by_id[k][0] for k in range(60, 80, 2))
    kept = mil_quality.accepted(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= set(range(61, 80, 2))
    assert mil_quality.scored(documents([]), model).count() == 0
    assert {r.score for r in mil_quality.scored(docs, None).collect()} == {0.5}


def test_passages_that_reach_the_driver_are_bounded(spark, documents, monkeypatch):
    rows = [(k, ("good words here " if k % 2 else "$$$ %%% !! ") * (1 + 900 * (k % 3 == 0))) for k in range(60)]
    rows += [(1, "another text of a labelled id " * 500)] * 40
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(60)], "doc_id bigint, quality int, toxic int")
    seen = []
    fit = mil_quality.fit
    monkeypatch.setattr(mil_quality, "fit", lambda x, bags, y: (seen.append((x, bags, y)), fit(x, bags, y))[1])
    model = mil_quality.train(documents(rows), labels, passages=100)
    whole = mil_quality.train(documents(rows), labels)
    (x, bags, y), (every, all_bags, _) = seen
    assert len(y) == len(all_bags) - 1 == len({k for k in range(60) if crc(k, 4) != 2})
    assert 60 < len(x) <= 100 and np.diff(bags).min() == 1 and len(every) > 500
    # What is drawn is what the whole texts hold, and enough to tell the two kinds apart.
    assert {r.tobytes() for r in x} <= {r.tobytes() for r in every}
    for m in (model, whole):
        scores = {r.doc_id: r.score for r in mil_quality.scored(documents(rows[:60]), m).collect()}
        assert min(scores[k] for k in range(3, 60, 2)) > max(scores[k] for k in range(0, 60, 2))


@pytest.mark.parametrize("counts, bound, want", [([1, 5, 9], 100, 9), ([1, 5, 9], 11, 5), ([1, 5, 9], 3, 1), ([4, 4], 7, 3), ([7], 1, 1)])
def test_the_largest_equal_share(counts, bound, want):
    assert mil_quality.each_up_to(np.array(counts), bound) == want


def test_attention_finds_one_spoilt_passage():
    rng = np.random.default_rng(0)
    bags, y = [], []
    for k in range(300):
        x = rng.normal(size=(rng.integers(1, 9), 6)).astype(np.float32)
        if k % 2:
            x[rng.integers(len(x)), 2] = 6
        bags.append(x)
        y.append(1 - k % 2)
    at = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    model = mil_quality.fit(np.concatenate(bags), at, np.array(y, dtype=np.float32))
    assert ((model.score(np.concatenate(bags), at) > 0.5) == np.array(y)).mean() > 0.95


# ---- Katz ------------------------------------------------------------------


def tokens(text):
    return [w for w in re.split(r"[ \t-\r]+", (text or "").translate(LOW)) if w] + ["\0"]


def by_hand(rows):
    """The model of the docstring with dictionaries."""
    texts = [tokens(t) for _, t in rows]
    train = [crc(d, 10) != 0 for d, _ in rows]
    one, two = collections.Counter(), collections.Counter()
    for t, learn in zip(texts, train, strict=True):
        if learn:
            one.update(t)
            two.update(zip(["\0", *t], t, strict=False))
    total, types, k = sum(one.values()), len(one), katz.K
    of = lambda c: [0, *(sum(x == r for x in c.values()) for r in range(1, k + 2))]
    d1, d2 = katz.good_turing(of(one), total), katz.good_turing(of(two), total)
    paid = lambda d, c: d[min(c, k + 1)] * c
    mass = sum(paid(d1, c) for c in one.values())
    whole = total if mass < total - 1e-9 else total + 1
    p1 = lambda w: paid(d1, one[w]) / whole if w in one else 1 - mass / whole
    after = collections.defaultdict(dict)
    for (h, w), c in two.items():
        after[h][w] = c
    state = {}
    for h, words in after.items():
        c, m = sum(words.values()), sum(paid(d2, x) for x in words.values())
        size = c if m < c - 1e-9 else c + 1
        state[h] = (size, (1 - m / size) / (1 - sum(p1(w) for w in words)))

    def p2(h, w):
        if h not in state:
            return p1(w)
        size, left = state[h]
        return paid(d2, after[h][w]) / size if w in after[h] else left * p1(w)

    for h in list(state)[:5]:
        assert math.isclose(sum(p2(h, w) for w in one) + p2(h, "never seen"), 1, abs_tol=1e-9)
    out = []
    for (doc, _), t in zip(rows, texts, strict=True):
        base = sum(math.log10((one[w] + 0.1) / (total + 0.1 * (types + 1))) for w in t)
        score = sum(math.log10(p2(h, w)) for h, w in zip(["\0", *t], t, strict=False))
        out.append((doc, crc(doc, 10) == 0, len(t), sum(w in one for w in t), total, round(base, 6), round(score, 6)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [200, 1 << 20])
def test_katz_equals_dictionaries(documents, size):
    rng = random.Random(size)
    words = ["the", "of", "The"] * 6 + [f"w{int(rng.paretovariate(0.6))}" for _ in range(300)]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for k in range(150)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "the " * 20_000), (204, rows[0][1]), (204, rows[0][1]), (None, "of the the")]
    docs = documents(rows)
    held_out = bucket_of(F.col("doc_id"), katz.FOLDS) == katz.HELD_OUT
    model = katz.fit(docs, ~held_out, chunk=size, bucket=500, word_bucket=200)
    got = [
        (r.doc_id, crc(r.doc_id, 10) == 0, r.n_tokens, r.n_known, model.words.total, round(r.base_score, 6), round(r.score, 6))
        for r in katz.scores(model).collect()
    ]
    assert sorted(got, key=repr) == by_hand(rows)


def test_katz_without_documents_or_training(documents):
    assert katz.scored(documents([])).count() == 0
    held = [k for k in range(60) if crc(k, 10) == 0]
    found = katz.scored(documents([(k, "some words") for k in held])).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found} == {(3, 0, 0, 0.0, 0.0)}


def test_good_turing_falls_back():
    assert (katz.good_turing([0, 100, 40, 20, 12, 8, 6], 1000)[1:6] < 1).all()
    for uneven in ([0, 5, 9, 1, 0, 3, 2], [0, 1, 50, 1, 50, 1, 50], [0, 0, 0, 0, 0, 0, 0]):
        found = katz.good_turing(uneven, 100)
        assert (found > 0).all() and (found <= 1).all()


def test_packed_numbers_come_back():
    for kind in (np.uint32, np.uint64):
        values = np.random.default_rng(2).integers(0, 1 << 31, 1000).astype(kind)
        assert np.array_equal(katz.unpacked(katz.packed(values), kind), values)
        assert len(katz.unpacked(katz.packed(values[:0]), kind)) == 0


# ---- language --------------------------------------------------------------


def test_languages_of_held_out_documents(spark):
    documents = table(spark, SF, "documents")
    found = ppm_language.digest(ppm_language.predicted(documents, ppm_language.learn(documents)))
    rows = found.join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def ppm_by_hand(counts, text):
    """Code length of a text, byte by byte, from counts of contexts."""
    data, bits = b"\n" * ppm_language.ORDER + text, 0.0
    for i in range(ppm_language.ORDER, len(data)):
        for order in range(ppm_language.ORDER, -2, -1):
            if order < 0:
                bits += 8
                break
            seen = counts.get(data[i - order : i])
            if seen:
                total, distinct = sum(seen.values()), len(seen)
                if data[i] in seen:
                    bits -= math.log2(seen[data[i]] / (total + distinct))
                    break
                bits -= math.log2(distinct / (total + distinct))
    return bits


@pytest.mark.parametrize("pairs", [ppm_language.MOST_PAIRS, 0])
def test_code_lengths_equal_recursion(pairs, monkeypatch):
    monkeypatch.setattr(ppm_language, "MOST_PAIRS", pairs)
    rng = random.Random(1)
    texts = {x: "".join(rng.choice(alphabet) for _ in range(400)).encode() for x, alphabet in (("a", "abc é"), ("b", "abd x"))}
    windows, counts = {}, {}
    for lang, text in texts.items():
        raw, at = np.frombuffer(text, np.uint8), np.array([0, len(text)])
        windows[lang] = np.unique(ppm_language.windows(raw, at), return_counts=True)
        seen = counts[lang] = {}
        data = b"\n" * ppm_language.ORDER + text
        for i in range(ppm_language.ORDER, len(data)):
            for order in range(ppm_language.ORDER + 1):
                seen.setdefault(data[i - order : i], collections.Counter())[data[i]] += 1
    scorer = ppm_language.Scorer(ppm_language.grow(windows))
    samples = [b"abc", b"", b"xyz \xff\x00", b"bad cab", texts["b"][:50]]
    raw = np.frombuffer(b"".join(samples), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(s) for s in samples])])
    want = [[ppm_by_hand(counts[lang], s) for lang in "ab"] for s in samples]
    assert np.allclose(scorer.bits(raw, at), want, rtol=1e-5)


def test_language_at_the_edges(documents):
    rows = [(k, "the cat and the dog", "en") for k in range(30)] + [(k, "der Hund und die Katze", "de") for k in range(30, 60)]
    edge = [(70, None), (71, ""), (72, "123 ...\n"), (73, "the " * 20_000), (74, "DER HUND", None), (74, "DER HUND", None), (None, "und die")]
    docs = documents(rows + edge, lang=None)
    trees = ppm_language.learn(docs)
    got = sorted(((r.doc_id, r.lang_pred) for r in ppm_language.predicted(docs, trees).collect() if r.doc_id is None or r.doc_id >= 70), key=repr)
    assert got == sorted([(70, "und"), (71, "und"), (72, "und"), (73, "en"), (74, "de"), (74, "de"), (None, "de")], key=repr)
    assert ppm_language.learn(documents([])) is None
    assert [r.lang_pred for r in ppm_language.predicted(documents([(1, "words")]), None).collect()] == ["und"]


# ---- html ------------------------------------------------------------------


def article(page):
    """The paragraphs of the given pages' one template."""
    import html

    inner = re.search(r"<article>(.*)</article>", page, re.S).group(1).replace("<br>", " ")
    blocks = (" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n\n".join(b for b in blocks if b)


def test_pages_give_their_articles(spark):
    pages = table(spark, SF, "pages")
    weights = html_blocks.train(pages)
    found = html_blocks.main_text(pages, weights).join(pages.select("page_id", "html"), "page_id").collect()
    assert len(found) == pages.count()
    assert all(r.text == article(r.html) and r.n_chars == len(r.text) for r in found)
    other = [
        '<html><body><div class="navbar"><a href="/">Home</a> <a href="/x">News</a></div><div class="post-body entry">'
        "<h2>A title of words</h2><p>First paragraph with enough words, and a second sentence.</p><p>Another &amp; last one.</p></div>"
        '<div class="sidebar"><ul><li><a href="/a">Related one</a></li></ul></div><div id="comments"><p>Nice text, I like it.</p></div>'
        '<form><label>Your mail</label></form><div class="cookie-notice">We use cookies.</div></body></html>'
    ]
    rows = spark.createDataFrame([(1, "u", other[0], "x")], "page_id bigint, url string, html string, text string")
    assert html_blocks.main_text(rows, weights).first().text == (
        "A title of words\n\nFirst paragraph with enough words, and a second sentence.\n\nAnother & last one."
    )
    edge = [(1, None, None), (2, "u", ""), (3, "u", "<p>"), (4, "u", "<script>a<b</script>"), (4, "u", "<script>a<b</script>"),
            (None, "u", "<div " + "x" * 50_000), (6, "u", "<article><p>" + "long words " * 30_000)]
    found = html_blocks.main_text(spark.createDataFrame(edge, "page_id bigint, url string, html string"), weights).collect()
    assert len(found) == len(edge) and all(r.n_chars == len(r.text) for r in found)
    assert {r.text for r in found if r.page_id in (1, 2, 3, 4)} == {""}
    assert html_blocks.main_text(rows.limit(0), weights).count() == 0 and html_blocks.train(rows.limit(0)) is None


#: What the parts around an article say on pages without telling markup; none of it is among the phrases of training.
SAID = {
    "menu": ["World", "Opinion", "Culture", "Weather", "Contact us", "Our team", "Next", "Older posts", "Search", "Sign in"],
    "notice": ["This website uses cookies to give you the best experience", "Your privacy matters to us, manage cookies", "Subscribe now for unlimited access to all articles", "Sign up for our weekly newsletter"],
    "advert": ["Save 50% on your first order today", "Advertisement - buy one, get one free", "Sponsored: the best deals this week"],
    "aside": ["Related stories", "Most popular", "More news", "Latest posts"],
    "comments": ["Thanks for this great post!", "I agree, very helpful article", "Reply", "I think you are right about this"],
    "footer": ["Copyright 2024, all rights reserved", "Privacy policy and terms of service", "Legal notice"],
}


def test_words_alone_tell_the_parts(spark):
    """Pages of a template that training does not make, where neither names nor elements tell a part."""
    import html

    given = table(spark, "/root/testdata/sf0.01", "pages")
    weights = html_blocks.train(given)
    rng, right, n = random.Random(4), 0, 0
    pages = [r.html for r in given.orderBy("page_id").collect()]
    for _ in range(100):
        text = article(rng.choice(pages)).split("\n\n")[:8]
        wrap = lambda t: rng.choice(["<div><span>%s</span></div>", "<p>%s</p>", "<div><p>%s</p></div>", "<center>%s</center>"]) % html.escape(t)
        around = [[wrap(rng.choice(SAID[k])) for k in kinds if rng.random() < 0.7] for kinds in (("menu", "menu", "notice", "advert"), ("aside", "comments", "comments", "footer"))]
        parts = [(t, False) for t in around[0]] + [(f"<p>{html.escape(t)}</p>", True) for t in text] + [(t, False) for t in around[1]]
        found = list(html_blocks.blocks("<html><body><div>" + "".join(t for t, _ in parts) + "</div></body></html>"))
        p = html_blocks.labelled(weights, found)
        assert len(found) == len(parts)
        right += sum((q > 0.5) == main for q, (_, main) in zip(p, parts, strict=True))
        n += len(parts)
    assert right / n >= 0.95


@pytest.mark.parametrize(
    "page, n",
    [("<a " * 350_000, 1), ('<a " > ' * 150_000, None), ('<a "x" ' * 150_000 + ">", None), ("<div><p>x" * 100_000, 100_000),
     ("<div>x" * 50_000 + "</div>y" * 50_000, 100_000), ("<svg>x" * 150_000, 1), ("<script/>x<style/>" * 50_000, 1), ("<p title='" * 100_000, None)],
)
def test_cutting_takes_time_in_proportion(page, n):
    began = time.time()
    found = sum(1 for _ in html_blocks.blocks(page))
    assert time.time() - began < 10 and n in (None, found)


def test_long_pages_are_labelled_in_steps(monkeypatch):
    rng = np.random.default_rng(2)
    w = {f"{k}{side}": rng.normal(size=shape).astype(np.float32) for side in "fr" for k, shape in (("X", (html_blocks.WIDTH, 64)), ("H", (16, 64)), ("b", 64), ("v", 16))}
    w["d"] = np.float32(0.1)
    page = list(html_blocks.blocks("".join(f"<div class='c{k % 5}'><p>word{k} and {'more ' * (k % 7)}</p></div>" for k in range(60))))
    whole = html_blocks.probabilities(w, *html_blocks._padded([html_blocks.vectors(page)]))[:, 0]
    monkeypatch.setattr(html_blocks, "STEPS", 7)
    assert np.allclose(html_blocks.labelled(w, page), whole, atol=1e-5)


def test_words_are_hashed_and_paths_are_inherited():
    (one,), (two,) = (list(html_blocks.blocks(f"<main class='a b'><div id=c><p>{t}")) for t in ("alpha omega", "gamma delta"))
    x, y = html_blocks.vectors([one])[0], html_blocks.vectors([two])[0]
    words = slice(html_blocks.PATHS, html_blocks.PATHS + html_blocks.WORDS)
    assert (x[words] > 0).sum() == 2 and (x[words] != y[words]).any() and (x[: html_blocks.PATHS] == y[: html_blocks.PATHS]).all()
    path = one[0].path()
    assert path == ("<main>", "a", "b", "<div>", "c", "<p>")
    want = np.zeros(html_blocks.PATHS, dtype=np.float32)
    for near, name in enumerate(reversed(path)):
        want[zlib.crc32(name.encode()) % html_blocks.PATHS] += 0.9**near
    assert np.allclose(x[: html_blocks.PATHS], want)


def test_blocks_of_odd_markup():
    page = "a<b>b</b><br>c<p>one &lt;two&gt;&nbsp; three<p>four<!-- x <p> --><li>five<li>six<script>var t='</p>'</script>seven<td>8<div/>nine"
    assert [t for _, t, _ in html_blocks.blocks(page)] == ["ab c", "one <two> three", "four", "five", "six seven", "8", "nine"]


@pytest.mark.parametrize(
    "tag",
    ['<svg width="1"/>', '<svg d="a>b" />', "<svg/>", "<math />", '<iframe src="x" />', "<video src=x>", "<button>", "<svg-icon></svg-icon>", '<script src="x"/>', "<iframe src=x/>", "<select disabled/>", "</video>", "<object><svg></object></svg>", "<svg>no<svg>no</svg>no</svg>", '<script src="x" />no</script>', "<button><p>no</button>", "<script>'<svg>'</script>"],
)
def test_elements_without_an_end_hide_nothing_behind_them(tag):
    texts = lambda page: [t for _, t, _ in html_blocks.blocks(page)]
    assert texts(f"<p>one</p>{tag}<p>two</p><p>three</p>") == ["one", "two", "three"]
    later = "<svg>no</svg><video>no</video><script>no</script><button>no</button><iframe></iframe>"
    assert texts(f"<p>one</p>{tag}<p>two</p>{tag}<p>three</p>{later}<p>four</p>") == ["one", "two", "three", "four"]
    assert texts("<p>one</p><script>var a = 1 <p>two</p>") == ["one"]


def test_gradients_of_the_labeller():
    rng = np.random.default_rng(3)
    pages = [(rng.normal(size=(n, html_blocks.WIDTH)).astype(np.float32), (rng.random(n) < 0.5).astype(np.float32)) for n in (3, 5, 2)]
    # Each label is that of the block before: only a recurrent reader can learn it.
    pages = [(x, np.append(0, x[:-1, 0] > 0).astype(np.float32)) for x, _ in pages * 30]
    w = html_blocks.fit(list(pages), epochs=120)
    x, real = html_blocks._padded([p[0] for p in pages])
    p = html_blocks.probabilities(w, x, real)
    right = sum(((p[: len(y), i] > 0.5) == y).sum() for i, (_, y) in enumerate(pages))
    assert right / sum(len(y) for _, y in pages) > 0.95
