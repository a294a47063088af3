"""Token alignment, clusters and the projection forest against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import random

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from support import DATA

from daygrid.llm import projection_forest, token_alignment, vantage_clusters
from daygrid.llm.common import table

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


# ---- alignment -------------------------------------------------------------


@pytest.fixture(scope="module")
def encoder():
    return token_alignment.Encoder(A, B)


def whole_ids(encoder, text):
    """Ids of the libraries, and the byte offsets at which the tokens end."""
    if not text:
        return [], [], [], []
    a = encoder.a.tokenizer.encode(" " + text, add_special_tokens=False).ids
    b = encoder.b.model.encode(text)
    x, y = [encoder.a.bytes[i] for i in a], [encoder.b.bytes[i] for i in b]
    if b"".join(x) != (" " + text).encode() or b"".join(y) != (" " + text).encode():
        return [], [], [], []
    return a, b, np.cumsum([len(t) for t in x]).tolist(), np.cumsum([len(t) for t in y]).tolist()


def paired(ends_a, ends_b):
    """Links by all pairs of byte ranges, and the common ends."""
    ranges = [list(zip([0, *e], e, strict=False)) for e in (ends_a, ends_b)]
    links = [(i, j) for i, (p, q) in enumerate(ranges[0]) for j, (r, s) in enumerate(ranges[1]) if p < s and r < q]
    return links, sorted(set(ends_a) & set(ends_b))


def brute_digest(encoder, rows):
    docs, counts = [], collections.Counter()
    for doc, text in rows:
        a, b, ends_a, ends_b = whole_ids(encoder, text)
        links, cuts = paired(ends_a, ends_b)
        docs.append((doc, a, b, ends_a, ends_b, links, cuts))
        counts.update((a[i], b[j]) for i, j in links)
    most = collections.Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for doc, a, b, ends_a, ends_b, links, cuts in docs:
        groups = []
        for low, high in zip([0, *cuts], cuts, strict=False):
            sides = (",".join(str(t) for t, e in zip(ids, ends, strict=True) if low < e <= high) for ids, ends in ((a, ends_a), (b, ends_b)))
            groups.append("|".join(sides))
        n = [counts[a[i], b[j]] for i, j in links]
        best = sum(counts[a[i], b[j]] == most[b[j]] for i, j in links)
        text = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((doc, len(a), len(b), len(cuts), len(links), best, sum(n), text))
    return sorted(out, key=repr)


ODD = [
    None, "", " ", "\n", "a  b", " a", "a ", "tail\n", "\nfirst line", "one\n\ntwo three", "x \n y", "a  b c", "tab\there too",
    "<s> <|endoftext|> </s> plain", "a▁b is not exact", "日本語 текст naïve café", "\x00\x1c\x85 ​", "\U0001f469‍\U0001f469 \U0001f600!",
    "x" * 5000, "é" * 2000, "word " * 900 + "end",
]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(), st.text(alphabet=st.sampled_from(" \n\t  ▁a'sZ1,.é日\x1c"), max_size=30)), min_size=1, max_size=3))
def test_remembered_ids_equal_both_libraries(encoder, texts):
    ids, counts = encoder.encode(texts)
    got = [np.split(flat, np.cumsum(n)[:-1]) for flat, n in zip(ids, counts, strict=True)]
    for k, text in enumerate(texts):
        want = whole_ids(encoder, text)
        assert (got[0][k].tolist(), got[1][k].tolist()) == tuple(want[:2])


def lengths():
    return st.lists(st.integers(1, 6), min_size=1, max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(lengths(), lengths()), min_size=1, max_size=6), st.integers(2, 9))
def test_lockstep_equals_all_pairs(pairs, lane):
    kept = token_alignment.LANE
    token_alignment.LANE = lane
    try:
        ends_a, ends_b, starts, want, cuts, upto = [], [], [], [], [], 0
        for x, y in pairs:
            # Both cover the same bytes.
            x, y = np.cumsum(x), np.cumsum(y)
            x, y = (np.append(e[e < min(x[-1], y[-1])], min(x[-1], y[-1])) for e in (x, y))
            links, common = paired(x.tolist(), y.tolist())
            want += [(len(ends_a) + i, len(ends_b) + j) for i, j in links]
            cuts += [upto + c for c in common]
            starts.append((len(ends_a), len(ends_b)))
            ends_a += (upto + x).tolist()
            ends_b += (upto + y).tolist()
            upto += int(x[-1])
        args = [np.array(v) for v in (ends_a, ends_b, [s[0] for s in starts], [s[1] for s in starts])]
        link_a, link_b, cut_a, cut_b = token_alignment.merged(*args)
    finally:
        token_alignment.LANE = kept
    assert sorted(zip(link_a.tolist(), link_b.tolist(), strict=True)) == want
    assert args[0][cut_a].tolist() == cuts and args[1][cut_b].tolist() == cuts


def test_long_documents_take_several_lanes(encoder):
    x = token_alignment.Alignment(encoder, ["some words of a longer text, " * 3000, "short"])
    first, _ = token_alignment.lanes(x.end_a, x.end_b, x.first_a, x.first_b)
    assert np.diff(np.append(first, len(x.a))).max() < 2 * token_alignment.LANE and len(first) > 50


@pytest.mark.parametrize("chunk", [1 << 21, 300])
def test_alignment_equals_brute_force(documents, encoder, chunk):
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice(["the", "cat", "internationally", "zqxj", "of,", "don't"]) for _ in range(k % 40))) for k in range(80)]
    rows += list(enumerate(ODD, 100)) + [(3, rows[3][1]), (None, "no id here"), (None, None), (300, "again and again"), (300, "again and again")]
    found = token_alignment.digest(documents(rows), A, B, chunk)
    assert found.columns == token_alignment.NAMES
    assert sorted(map(tuple, found.collect()), key=repr) == brute_digest(encoder, rows)
    assert token_alignment.digest(documents([]), A, B).count() == 0


def test_alignment_of_the_given_documents(spark, encoder):
    docs = table(spark, DATA, "documents").where("length(text) < 1500").limit(60).select("doc_id", "text").collect()
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert sorted(map(tuple, token_alignment.digest(df, A, B).collect()), key=repr) == brute_digest(encoder, [tuple(r) for r in docs])


def test_links_and_cuts_by_position(documents, encoder):
    rows = list(enumerate(ODD))
    for r in token_alignment.aligned(documents(rows), A, B).collect():
        a, b, ends_a, ends_b = whole_ids(encoder, rows[r.doc_id][1])
        links, cuts = paired(ends_a, ends_b) if len(a) < 3000 else ([], [])
        assert (r.a_ids, r.b_ids) == (a, b)
        if links or not a:
            assert list(zip(r.link_a, r.link_b, strict=True)) == links
            assert [ends_a[n - 1] for n in r.cut_a] == [ends_b[n - 1] for n in r.cut_b] == cuts


# ---- clusters --------------------------------------------------------------


def brute_clusters(rows, k, dim, scale, rounds):
    """As the docstring says, in plain Python."""
    usable = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted(usable, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in named[:k]]

    def assigned():
        return [min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), n) for n, c in enumerate(centroids)) for _, v in usable]

    for _ in range(rounds):
        own = assigned()
        for n in range(len(centroids)):
            of = [v for (_, v), (_, c) in zip(usable, own, strict=True) if c == n]
            if of:
                centroids[n] = [sum(x) // len(of) for x in zip(*of, strict=True)]
    final = assigned()
    sums = collections.Counter()
    for d, c in final:
        sums[c] += d
    hashed = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    out = [(i, c, d, sums[c], sum(sums.values()), hashed[c]) for (i, _), (d, c) in zip(usable, final, strict=True)]
    return sorted(out, key=repr)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 90), st.integers(1, 6), st.sampled_from([2, 50, 1 << 26]))
def test_tree_finds_the_nearest_and_the_smaller_of_ties(seed, k, dim, most):
    rng = np.random.default_rng(seed)
    centroids, vectors = rng.integers(-most, most + 1, (k, dim)), rng.integers(-most, most + 1, (60, dim))
    centroids[rng.integers(k)] = centroids[0]
    away = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
    number, best = vantage_clusters.VantageTree(centroids, leaf=3).nearest(vectors)
    assert (number == away.argmin(axis=1)).all() and (best == away.min(axis=1)).all()


def test_tree_leaves_nodes_out(monkeypatch):
    rng = np.random.default_rng(2)
    centroids = (rng.integers(0, 40, (256, 1)) * 1000 + rng.integers(0, 9, (256, 8))).astype(np.int64)
    seen = []
    plain = vantage_clusters.squared
    tree = vantage_clusters.VantageTree(centroids)
    monkeypatch.setattr(vantage_clusters, "squared", lambda v, c: (seen.append(len(v)), plain(v, c))[1])
    tree.nearest(centroids)
    assert sum(seen) < 256 * 256 / 3


CLASH = "label int, cluster int, distance bigint, v string, score double, rank int, a int, ids string"


def with_clashes(spark, rows, element="float"):
    schema = f"vec_id bigint, embedding array<{element}>, {CLASH}"
    return spark.createDataFrame([(*r, 1, 2, 3, "v", 0.5, 6, 7, "i") for r in rows], schema)


@pytest.mark.parametrize("k", [5, 40])
def test_clusters_equal_plain_python(spark, k):
    rng = np.random.default_rng(k)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(size=4) * 2)]) for i in range(150)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[3][1]), (None, [0.0] * 4)]
    rows += [(500 + i, [0.25, 0.25, 0.25, 0.25]) for i in range(60)]
    bad = [(900, None), (901, [1.0, None, 1.0, 1.0]), (902, [float("nan")] * 4), (903, [float("inf")] * 4), (904, [1.0]), (905, [])]
    found = vantage_clusters.digest(*vantage_clusters.clustered(with_clashes(spark, rows + bad), k=k, dim=4, scale=8, rounds=2))
    assert sorted(map(tuple, found.collect()), key=repr) == brute_clusters(rows + bad, k, 4, 8, 2)


def test_clusters_of_few_or_no_vectors(spark):
    few = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [-5.0, 2.5])]
    found = vantage_clusters.digest(*vantage_clusters.clustered(with_clashes(spark, few), k=16, dim=2))
    assert sorted(map(tuple, found.collect()), key=repr) == brute_clusters(few, 16, 2, 64, 3)
    none, centroids = vantage_clusters.clustered(with_clashes(spark, [(1, None)]))
    assert vantage_clusters.digest(none, centroids).count() == 0
    with pytest.raises(ValueError, match="centroids"):
        vantage_clusters.clustered(with_clashes(spark, few), k=1 << 20)


def test_clusters_equal_their_sql(spark):
    from compare import differences, engine

    found = vantage_clusters.digest(*vantage_clusters.clustered(table(spark, DATA, "embeddings")))
    assert differences(found, engine(DATA), vantage_clusters.ORACLE) is None


# ---- forest ----------------------------------------------------------------


def brute_nearest(rows, every, k):
    usable = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for at, (q, a) in enumerate(usable):
        if q % every == 0:
            scores = [(-float((a * b).sum()), i) for other, (i, b) in enumerate(usable) if other != at and len(b) == len(a)]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def test_forest_with_an_endless_reach_equals_all_pairs(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(size=6) * rng.choice([0.1, 3]))]) for i in range(300)]
    rows += [(400 + i, rows[0][1]) for i in range(40)] + [(10, rows[10][1]), (10, rows[10][1]), (20, rows[5][1])]
    rows += [(500, [1.0, 2.0]), (550, [0.5, -1.0]), (560, [-0.0, 1.0]), (570, [0.0, 1.0])]
    bad = [(700, None), (710, [1.0, None] * 3), (720, [float("nan")] * 6), (730, [float("inf")] * 6), (740, [0.0] * 6), (750, []), (None, [1.0] * 6)]
    found = projection_forest.nearest(with_clashes(spark, rows + bad), every=10, k=5, leaf=20, reach=1e9)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect())
    assert got == brute_nearest(rows + bad, 10, 5)
    assert projection_forest.nearest(with_clashes(spark, [])).count() == 0
    alone = projection_forest.nearest(with_clashes(spark, [(20, [1.0, 2.0])]))
    assert alone.count() == 0


def test_blocks_of_large_leaves(spark, monkeypatch):
    monkeypatch.setattr(projection_forest, "BLOCK", 16)
    monkeypatch.setattr(projection_forest, "ASKED", 4)
    rng = np.random.default_rng(6)
    rows = [(int(i), rng.normal(size=4).tolist()) for i in range(200)]
    found = projection_forest.nearest(with_clashes(spark, rows, "double"), every=5, k=7, leaf=50, reach=1e9)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == brute_nearest(rows, 5, 7)


@pytest.mark.parametrize("lengths", [False, True])
def test_recall_of_the_forest(spark, lengths):
    """Points without any structure, the worst case, in small leaves; and with lengths that differ."""
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(3000, 24))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    if lengths:
        vectors *= rng.uniform(0.5, 1.5, (3000, 1))
    vectors[:900] = vectors[0] + rng.normal(size=(900, 24)) * 0.02
    rows = [(i, v) for i, v in enumerate(vectors.tolist())]
    found = projection_forest.nearest(with_clashes(spark, rows, "double"), leaf=100).collect()
    want = brute_nearest(rows, 20, 20)
    hits = {(r.query_id, r.vec_id) for r in found} & {(q, i) for q, _, i, _ in want}
    assert len(found) == len(want) and len(hits) >= 0.9 * len(want)
    exact = {(q, i): s for q, _, i, s in brute_nearest(rows, 20, 3000)}
    assert all(abs(r.score - exact[r.query_id, r.vec_id]) < 1e-12 for r in found)


def test_queries_among_close_points_visit_few_leaves():
    rng = np.random.default_rng(9)
    middles = rng.normal(size=(64, 32))
    vectors = middles[rng.integers(64, size=20_000)] + rng.normal(size=(20_000, 32)) * 0.01
    forest = projection_forest.Forest(vectors[:4000], 6, 4, projection_forest.REACH, float(np.linalg.norm(vectors, axis=1).max()))
    directions = forest.directions(vectors[:200])
    kth = np.full(200, 1 - 1e-3)
    visits = [len(v) for v in forest.further(directions, kth)]
    assert np.mean(visits) < 0.1 * 4 * 64


def test_exact_sql_is_what_the_forest_approaches(spark):
    db = duckdb.connect()
    db.execute(f"create view embeddings as select * from '{DATA}/embeddings.parquet'")
    want = {(q, v) for q, _, v, _ in db.execute(projection_forest.EXACT).fetchall()}
    found = {(r.query_id, r.vec_id) for r in projection_forest.nearest(table(spark, DATA, "embeddings"), leaf=60).collect()}
    assert len(found & want) >= 0.9 * len(want) == 0.9 * len(found)
