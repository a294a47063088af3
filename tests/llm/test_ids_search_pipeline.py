"""Token ids, transducer, KD-trees against brute force; the stages and the pipeline on a small fixture."""

from __future__ import annotations

import base64
import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from daygrid.llm import bpe_transducer, kdtree_topk, repair_ids
from daygrid.llm.common import table

MULTI, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")
ODD = ["", None, " ", "\n\n  x", "naïve café 12345 !!", "日本語 текст", "a" * 3000, "​\x00\x1c\x85", "I'll they've 's", "👩‍👩‍👧 \U0001f600"]


@pytest.fixture(scope="module")
def encoder():
    return bpe_transducer.Encoder(MULTI, P.PATTERN)


@pytest.fixture(scope="module")
def ids_encoder():
    return repair_ids.Encoder(JSON, P.PATTERN)


@pytest.fixture(scope="module")
def reference():
    with open(MULTI, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


SPACED = st.text(alphabet=st.sampled_from(" \n\t\u00a0\u2003a'sZ1,.é日\x1c"), max_size=30)


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.text(), SPACED))
def test_transducer_equals_the_library(encoder, reference, text):
    assert encoder.encode(text) == reference.encode_ordinary(text)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(st.text(), SPACED), min_size=1, max_size=3))
def test_remembered_ids_equal_the_library(ids_encoder, texts):
    want = [[*ids_encoder.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert [f.tolist() for f in ids_encoder.encode(texts)] == want


def test_runs_of_mixed_white_space_equal_the_libraries(encoder, reference, ids_encoder):
    runs = ["".join(r) for n in (1, 2, 3, 4, 5) for r in itertools.product(" \u00a0\t\n", repeat=n)]
    texts = ["a \u00a0 \u00a0 b", "Menu \u00a0 \u00a0 \u00a0 Home", *(f"one{r}two 3{r}" for r in runs), *(r + "x" for r in runs)]
    want = [[*ids_encoder.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert [f.tolist() for f in ids_encoder.encode(texts)] == want
    assert [encoder.encode(t) for t in texts] == [reference.encode_ordinary(t) for t in texts]


def test_transducer_with_few_states(reference):
    small = bpe_transducer.Encoder(MULTI, P.PATTERN)
    small.transducer.most_states = 20
    rng = random.Random(4)
    tokens = list(small.transducer.ranks)
    for _ in range(400):
        piece = b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 4)))
        merged = [small.transducer.ranks[p] for p in small.transducer.merged(piece)]
        assert small.transducer.encode_piece(piece) == ([small.transducer.ranks[piece]] if piece in small.transducer.ranks else merged)
    assert len(small.transducer.states) < 200


def test_streamed_text_is_whole(encoder):
    for text in ODD:
        ids = encoder.encode(text or "")
        parts = list(bpe_transducer.decoded(ids, encoder.transducer.bytes_of))
        assert "".join(parts) == (text or "") and len(parts) == len(ids) + 1
    stream = bpe_transducer.Utf8Stream()
    data = "é日😀".encode() + b"\xff\xe6\x97"
    assert "".join(stream.feed(bytes([b])) for b in data) + stream.finish() == data.decode("utf-8", "replace")


@pytest.mark.parametrize("portion", [1, 3, 1024])
def test_query_hashes_the_streamed_text(encoder, monkeypatch, portion):
    monkeypatch.setattr(bpe_transducer, "PORTION", portion)
    fed = []
    feed = bpe_transducer.Utf8Stream.feed
    monkeypatch.setattr(bpe_transducer.Utf8Stream, "feed", lambda self, data: fed.append(data) or feed(self, data))
    texts = [t or "" for t in ODD]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    (found,) = bpe_transducer._mapper(MULTI, P.PATTERN)(iter([batch]))
    assert found.column("decoded_sha256").to_pylist() == [hashlib.sha256(t.encode()).hexdigest() for t in texts]
    assert b"".join(fed) == "".join(texts).encode() and len(fed) >= sum(t != "" for t in texts)
    for data in (b"\xff\xe6\x97", b"\xe6\x97\x41\xf0\x9f\x98", "é日😀".encode() + b"\x80"):
        bytes_of = [bytes([b]) for b in range(256)]
        assert bpe_transducer.decoded_hash(list(data), bytes_of) == hashlib.sha256(data).hexdigest()


def test_encoded_table(documents, reference):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(1, "same"), (1, "same"), (None, "null id")]
    found = bpe_transducer.encoded(documents(rows), MULTI, P.PATTERN, with_ids=True).collect()
    want = []
    for doc, text in rows:
        ids = reference.encode_ordinary(text or "")
        joined = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((doc, len(ids), joined, hashlib.sha256((text or "").encode()).hexdigest(), ids))
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    assert bpe_transducer.encoded(documents([]), MULTI, P.PATTERN).count() == 0


def _made_up(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices("abdeghilmnorstuäé", k=rng.randint(4, 11))) for _ in range(n)]


def _want(encoder, texts):
    return [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]


def test_new_stretches_go_to_the_library_joined_and_once(monkeypatch):
    encoder = repair_ids.Encoder(JSON, P.PATTERN)
    sent = []
    encode = encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda texts: sent.extend(texts) or encode(texts))
    texts = [" ".join(_made_up(2000, k)) for k in range(3)]
    assert [f.tolist() for f in encoder.encode(texts)] == _want(encoder, texts)
    assert len(sent) < 60
    sent.clear()
    marked = [text.replace("n ", "n, ").replace("e ", "e\n") for text in texts]
    assert [f.tolist() for f in encoder.encode(marked)] == _want(encoder, marked)
    assert sum(map(len, sent)) < sum(map(len, texts)) / 3  # stretches with another mark behind them are known


def test_clashing_hashes_and_forgotten_stretches_change_no_ids(monkeypatch):
    special = "<|endoftext|>"
    texts = [" ".join(_made_up(300, 1)), f"a {special} b", "b", special, "", "x" * 400 + " y", "<|endof", "text|> a", *map(str, ODD)]
    encoder = repair_ids.Encoder(JSON, P.PATTERN)
    monkeypatch.setattr(repair_ids, "mixed", lambda x: x % np.uint64(5))
    for _ in range(2):
        assert [f.tolist() for f in encoder.encode(texts)] == _want(encoder, texts)
    monkeypatch.undo()
    monkeypatch.setattr(repair_ids, "MOST_PIECES", 10)
    encoder = repair_ids.Encoder(JSON, P.PATTERN)
    for _ in range(3):
        assert [f.tolist() for f in encoder.encode(texts)] == _want(encoder, texts)
    assert encoder.words.n < 1000


def test_a_pattern_that_spans_stretches_is_refused():
    with pytest.raises(ValueError, match="pattern"):
        repair_ids.Encoder(JSON, r"\S+|\s+")


def test_repair_counts_all_pairs_only_when_the_share_falls(monkeypatch):
    rng = np.random.default_rng(3)
    words = [rng.integers(10, 400, rng.integers(2, 9)) for _ in range(3000)]
    docs = [np.concatenate([words[k] for k in rng.zipf(1.3, 400) % 3000] + [np.array([2])]) for _ in range(100)]
    ids, starts = np.concatenate(docs).astype(np.uint32), np.cumsum([0, *map(len, docs)])
    counted = []
    sort = np.sort
    monkeypatch.setattr(np, "sort", lambda x: counted.append(len(x)) or sort(x))
    data = repair_ids.compress(ids, starts)
    monkeypatch.undo()
    shard = repair_ids.Shard(data)
    found, first = shard.documents()
    assert np.array_equal(found, ids) and np.array_equal(first, starts)
    assert sum(counted) < 6 * len(ids)
    # No pair within a document is left that pays for its rule.
    pairs = {}
    for a, b in itertools.pairwise(shard.first):
        for pair in itertools.pairwise(shard.symbols[a:b].tolist()):
            pairs[pair] = pairs.get(pair, 0) + 1
    pays = repair_ids.RULE // 2 + 1
    assert all(n < pays for (a, b), n in pairs.items() if a != b)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 6), min_size=1, max_size=80), min_size=1, max_size=12))
def test_shard_round_trip_and_random_access(docs):
    ids = np.concatenate([np.array(d, dtype=np.uint32) for d in docs])
    starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    shard = repair_ids.Shard(repair_ids.compress(ids, starts, frequent=50))
    found, at = shard.documents()
    assert found.tolist() == ids.tolist() and at.tolist() == starts.tolist()
    for k, d in enumerate(docs):
        assert shard.document(k).tolist() == d
        a, b = sorted((len(d) // 3, len(d) - len(d) // 4))
        assert shard.ids(k, a, b).tolist() == d[a:b] and shard.ids(k, 0, len(d)).tolist() == d


def test_shards_shrink_repeated_ids():
    ids = np.tile(np.arange(50, dtype=np.uint32), 400)
    shard = repair_ids.Shard(repair_ids.compress(ids, np.array([0, len(ids)])))
    assert len(shard.symbols) < len(ids) / 20 and shard.documents()[0].tolist() == ids.tolist()


def test_rare_repeats_get_rules():
    rng = np.random.default_rng(1)
    passages = rng.integers(0, 50_000, (150, 60), dtype=np.uint32)
    docs = [passages[k] for k in rng.permutation(np.repeat(np.arange(150), 20))]
    starts = np.arange(len(docs) + 1) * 60
    for offset in (0, 20_000):  # with 16-bit and with 32-bit symbols
        ids = np.concatenate(docs) + np.uint32(offset)
        shard = repair_ids.Shard(repair_ids.compress(ids, starts))
        assert len(shard.symbols) < len(ids) / 10 and shard.documents()[0].tolist() == ids.tolist()
    # More rules than 16-bit symbols: copies of long documents.
    docs = rng.integers(0, 60_000, (1, 12_000), dtype=np.uint32).repeat(8, axis=0)
    shard = repair_ids.Shard(repair_ids.compress(docs.reshape(-1), np.arange(9) * 12_000))
    assert len(shard.symbols) == 8 and shard.documents()[0].tolist() == docs.reshape(-1).tolist()


def test_ids_of_a_table(spark, documents, tmp_path):
    rows = [(k * 7 % 41, f"text {k} " * (k % 9)) for k in range(41)] + list(enumerate(ODD, 100))
    rows += [(5, "again"), (5, "again"), (200, "x<|endoftext|>y"), (201, "word " * 30_000), (None, "first")]
    folder = str(tmp_path / "ids")
    repair_ids.write_ids(documents(rows), JSON, P.PATTERN, folder, shard=500)
    shards = spark.read.parquet(folder)
    found = repair_ids.read_ids(shards).collect()
    tokenizer = Tokenizer.from_file(JSON)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want, start = [], 0
    for doc, text in ordered:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == want and shards.count() > 1
    assert repair_ids.round_trip(documents([]), JSON, P.PATTERN).count() == 0


# ---- search ----------------------------------------------------------------


def best(rows, every, k):
    """Every row against every other row of its length."""
    out = []
    vectors = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows]
    for at, (q, a) in enumerate(vectors):
        if q % every == 0:
            scores = [(-sum(x * y for x, y in zip(a, b, strict=True)), i) for n, (i, b) in enumerate(vectors) if n != at and len(b) == len(a)]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("shard, asked", [(1 << 13, 2048), (40, 3), (7, 2048)])
def test_top_k_equals_all_pairs(spark, shard, asked, monkeypatch):
    monkeypatch.setattr(kdtree_topk, "ASKED", asked)
    rng = np.random.default_rng(shard)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(size=6) * rng.choice([0.1, 3]))]) for i in range(300)]
    rows += [(400 + i, rows[0][1]) for i in range(30)] + [(500, [1.0, 2.0]), (550, [0.5, -1.0]), (600, []), (610, [])]
    # Repeated rows, and one id with several vectors.
    rows += [rows[0], (10, rows[0][1]), (10, rows[5][1]), (410, rows[0][1]), (410, rows[0][1])]
    bad = [(700, None), (750, [1.0, None] * 3), (800, [float("nan")] * 6), (850, [float("inf")] * 6), (None, [1.0] * 6)]
    schema = "vec_id bigint, embedding array<float>, label int, rank int, score bigint"
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in [*rows, *bad]], schema)
    found = kdtree_topk.top_k(df, every=10, shard=shard)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == best(rows, 10, 5)
    assert kdtree_topk.top_k(df.limit(0)).count() == 0


def test_queries_among_close_vectors_meet_few_cells():
    rng = np.random.default_rng(3)
    middles = rng.integers(-2000, 2000, (32, 8))
    vectors = middles[rng.integers(32, size=4000)] + rng.integers(-9, 9, (4000, 8))
    cells = kdtree_topk.Cells(vectors[:1000], 5)
    of = cells.of(vectors)
    assert len(set(of.tolist())) > 16
    numbers = np.unique(of)
    boxes = {8: (numbers, np.array([vectors[of == n].min(axis=0) for n in numbers]), np.array([vectors[of == n].max(axis=0) for n in numbers]))}
    sent = type("Sent", (), {"value": boxes})
    scores = vectors[:50] @ vectors.T
    kth = np.sort(scores, axis=1)[:, -6].astype(float)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([8] * 50, pa.int32()), pa.array(list(vectors[:50]), pa.list_(pa.int64())), pa.array(of[:50]), pa.array(kth)], names=["dim", "v", "home", "kth"]
    )
    visits = sum(b.num_rows for b in kdtree_topk._visiting(sent, 0, 99)(iter([batch])))
    assert visits < 50 * len(numbers) / 4
    # No cell that holds a better vector is left out.
    met = {(i, c) for b in kdtree_topk._visiting(sent, 0, 99)(iter([batch])) for i, c in zip(b.column("kth").to_pylist(), b.column("cell").to_pylist(), strict=True)}
    for i in range(50):
        for j in np.flatnonzero(scores[i] >= kth[i]):
            assert of[j] == of[i] or (kth[i], of[j]) in met


@pytest.mark.parametrize("largest", [100, 1 << 18, (1 << 31) - 1])
def test_search_of_a_shard_equals_all_pairs(largest, monkeypatch):
    # Single, double precision and Python's integers; blocks and rounds of every size.
    monkeypatch.setattr(kdtree_topk, "BLOCK", 7)
    monkeypatch.setattr(kdtree_topk, "TOGETHER", 40)
    rng = np.random.default_rng(largest)
    vectors = np.unique(rng.integers(-largest, largest, (400, 3)) // [1, 1, largest], axis=0)
    vectors = np.concatenate([vectors, vectors[:50] * [1, 1, 0]]) if largest == 100 else vectors
    order, *tree = kdtree_topk.build(vectors, leaf=9)
    vectors = vectors[order]
    ids = [sorted(rng.choice(5000, rng.integers(1, 7)).tolist()) for _ in vectors]
    place = rng.integers(-1, len(vectors), 60)
    queries = np.where(place[:, None] < 0, rng.integers(-largest, largest, (60, 3)), vectors[place])
    own = np.array([ids[p][0] if p >= 0 else 1 for p in place])
    exact = [[sum(int(x) * int(y) for x, y in zip(q, v, strict=True)) for v in vectors] for q in queries]
    bound = np.array([-np.inf if n % 3 else float(sorted(scores)[-9]) for n, scores in enumerate(exact)])
    want = []
    for n, scores in enumerate(exact):
        rows = [(-score, one) for j, score in enumerate(scores) if score >= bound[n] for one in (ids[j][1:] if j == place[n] else ids[j])]
        want += [(n, -score, one) for score, one in sorted(rows)[:5]]
    flat, starts = np.array([i for some in ids for i in some]), np.cumsum([0, *map(len, ids)])
    found = kdtree_topk.search(queries, (own, place), bound, (flat, starts), vectors, tree, 5)
    assert [tuple(map(int, row)) for row in zip(*found, strict=True)] == want


def test_many_cells_are_visited_in_small_batches():
    rng = np.random.default_rng(4)
    low = rng.integers(-500, 500, (4096, 64))
    boxes = {64: (np.arange(4096), low, low + 100)}
    sent = type("Sent", (), {"value": boxes})
    v = pa.array(list(rng.integers(-500, 500, (300, 64))), pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([pa.array([64] * 300, pa.int32()), v, pa.array([7] * 300), pa.array([float("-inf")] * 300)], names=["dim", "v", "home", "kth"])
    n = 0
    for some in kdtree_topk._visiting(sent, 0, 4096)(iter([batch])):
        assert some.num_rows * 64 <= 1 << 20
        n += some.num_rows
    assert n == 300 * 4095


def test_top_k_with_few_large_shards(spark, monkeypatch):
    # Shards grow when there are FEW cells, up to NUMBERS components; a query is sent to few cells, its vector as bytes.
    monkeypatch.setattr(kdtree_topk, "FEW", 4)
    rng = np.random.default_rng(9)
    rows = [(int(i), [float(x) for x in rng.normal(size=3) * rng.choice([0.1, 1000, 1e6])]) for i in range(260)]
    rows += [(300 + i, rows[0][1]) for i in range(9)] + [(400 + i, [float(i % 7)]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    points = kdtree_topk.distinct_vectors(kdtree_topk.named_vectors(kdtree_topk.integer_vectors(df)), 5)
    cells = kdtree_topk.split(points, 5)
    assert {dim: own.depth for dim, own in cells.items()} == {1: 1, 3: 2}
    for numbers in (1 << 23, 90):
        monkeypatch.setattr(kdtree_topk, "NUMBERS", numbers)
        found = kdtree_topk.top_k(df, every=10, shard=5)
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == best(rows, 10, 5)


def test_vectors_packed_in_several_widths():
    vectors = [np.array([[1, -32767], [5, 7]]), np.array([[1 << 15, -3]]), np.array([[1 << 40, 2], [-(1 << 31) - 1, 0]])]
    packed = [kdtree_topk._packed(v) for v in vectors]
    assert [p.dtype.itemsize for p in packed] == [2, 4, 8]
    table = pa.table({"v": pa.array([row.tobytes() for p in packed for row in p], pa.binary())})
    assert (kdtree_topk._matrix(table, 2) == np.concatenate(vectors)).all()
    assert (kdtree_topk._matrix(table.slice(1, 1), 2) == vectors[0][1:]).all()
    assert kdtree_topk._matrix(pa.table({"v": pa.array([b"", b""])}), 0).shape == (2, 0)


def test_boxes_prune():
    rng = np.random.default_rng(5)
    vectors = rng.integers(-500, 500, (4000, 3))
    order, nodes, low, high = kdtree_topk.build(vectors, leaf=16)
    assert sorted(order.tolist()) == list(range(4000))
    leaves = [(a, b) for a, b, left in nodes if left < 0]
    assert sum(b - a for a, b in leaves) == 4000 and max(b - a for a, b in leaves) <= 16
    for (a, b, _), lo, hi in zip(nodes, low, high, strict=True):
        assert (vectors[order[a:b]].min(axis=0) == lo).all() and (vectors[order[a:b]].max(axis=0) == hi).all()


# ---- pipeline --------------------------------------------------------------


@pytest.fixture(scope="module")
def corpus(spark, documents, tmp_path_factory):
    rng = random.Random(12)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe") for b in ("ra", "sto", "ti", "vel", "zum", "en", "or")]
    line = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(8, 25))).capitalize() + "."
    items = [(k, " ".join(rng.choice(words) for _ in range(20))) for k in range(5)]
    common = line()
    rows, labels = [], []
    for k in range(120):
        text = "\n".join(line() for _ in range(rng.randint(2, 6)))
        if k % 6 == 0:
            text = " ".join(w.upper() + rng.choice(["!!", "$$$", "%%%"]) for w in text.split())
        elif k % 10 == 1:
            text += "\n" + common
        elif k % 10 == 2 and k > 10:
            near = rows[k - 10][1].split(" ")
            near[len(near) // 2] += "x"
            text = " ".join(near) + " tail"
        elif k % 10 == 3:
            text += "\n" + items[k % 5][1]
        rows.append((k, text))
        labels.append((k, int(k % 6 != 0), 0))
    rows += [(200, None), (201, ""), (202, rows[1][1]), (203, rows[1][1]), (None, line())]
    folder = str(tmp_path_factory.mktemp("corpus"))
    documents(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows, items, common


def test_stages_take_effect(spark, corpus, tmp_path, reference):
    from test_duplicates import contaminated, grams, kept_lines

    folder, rows, items, common = corpus
    docs = table(spark, folder, "documents")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "token_ids":
            assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        seen[name] = (before.collect(), docs.collect())

    before, after = seen["quality"]
    assert {r.doc_id for r in before if r.doc_id is not None and r.doc_id < 120 and r.doc_id % 6} <= {r.doc_id for r in after}
    assert not any(r.doc_id % 6 == 0 for r in after if r.doc_id is not None and r.doc_id < 120)

    before, after = seen["line_dedup"]
    want = kept_lines([(r.doc_id, r.text) for r in before], 30)
    got = {r.doc_id: r.text for r in after}
    for r in before:
        lines = want.get((r.doc_id is not None, r.doc_id or 0), [])
        if lines and all(gone for _, gone in lines):
            assert r.doc_id not in got
        elif lines:
            assert got[r.doc_id] == "\n".join(x for x, gone in lines if not gone)
    assert sum(common in (r.text or "") for r in after) == 1

    before, after = seen["near_duplicates"]
    assert len({r.doc_id for r in after}) == len(after) < len(before) + 1
    sets = [grams(r.text) for r in after]
    for i, a in enumerate(sets):
        for b in sets[:i]:
            assert not a or len(a & b) < 0.8 * len(a | b)

    before, after = seen["decontamination"]
    dirty = {r[0] for r in contaminated([(r.doc_id, r.text) for r in before], items) if r[-1]}
    assert dirty and {r.doc_id for r in after} == {r.doc_id for r in before} - dirty

    before, after = seen["token_ids"]
    want = {r.doc_id: reference.encode_ordinary(r.text or "") for r in before}
    assert {r.doc_id: r.ids for r in after} == want


def test_rows_without_words_all_stay(spark, documents, tmp_path):
    rows = [(1, ""), (1, ""), (None, None), (None, None), (2, " \n "), (2, " \n "), (3, "one two three four five six")] * 2
    out = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, documents(rows), str(tmp_path))
    want = [r for r in rows if r[0] != 3] + [rows[6]]
    assert sorted(map(repr, ((r.doc_id, r.text) for r in out.collect()))) == sorted(map(repr, want))


def test_run_gives_the_last_stage(spark, corpus):
    found = corpus_pipeline.run(spark, corpus[0])
    assert 0 < found.count() < 120 and "ids" in found.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontamination", "token_ids"]


def test_stages_on_empty_tables(spark, documents, tmp_path):
    folder = str(tmp_path)
    documents([]).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
