"""Exact inner-product top-k search in KD-trees, one for each shard of the vectors.

Equal vectors are one point with its smallest ids. A top tree, fitted on the driver on at most ``SAMPLE`` points of each
length, splits at medians of the widest dimension into cells: of about ``SHARD`` points until there are ``FEW`` cells, then
of more, up to ``NUMBERS`` components, then more cells again, up to ``MOST_CELLS``. Every point is in its cell, and a cell
beyond ``NUMBERS`` is dealt into shards by hash. A shard's own tree halves its points at the median of the widest
dimension, down to leaves of ``LEAF``; each node keeps its tight bounding box. No vector of a box can score above
sum(max(q * low, q * high)). Best first means leaves in the order of this bound; a query ends when it falls below its kth
score. The queries of a shard go together, in rounds of ``GROWTH`` times as many leaves, so that the scores of a leaf are
one product of matrices.

A query first searches its own cell. The kth score found goes with it from round to round: cells are visited in the order
of their boxes' bounds, ``WIDER`` times as many a round, as long as the bound reaches the kth score. So a query among
close vectors meets few cells, and a box is left out only if its bound proves it useless: the result is exact. Where
nothing can be left out, a query is sent to each shard once, and a tree once a round for each ``ASKED`` queries. Vectors
travel as bytes, as narrow as they allow. The boxes of all cells are broadcast: 2 * MOST_CELLS * dim numbers at most for
each length.

Defined results: vectors that are null or hold null or non-finite components, and rows without an id, take no part;
repeated rows are rows of their own, each with a list of its own; a query meets all rows of its own length but itself;
ties go to the smaller id; with fewer than k candidates all are returned; an empty table gives no rows; other columns
are ignored. Components beyond 2**31 after scaling are outside the contract.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrid.llm.common import asked_rows, distinct_vectors, named_vectors, stored, text_bytes

K = 5
SCALE = 256
EVERY = 50
#: Points of a shard while cells are few, of a leaf, and queries of a group at most.
SHARD, LEAF, ASKED = 8192, 256, 1 << 18
#: Components of a shard's points at most; a group's queries have twice as many, a sample half.
NUMBERS = 1 << 23
SAMPLE, FEW, MOST_CELLS = 32_768, 64, 4096
GROWTH, FIRST, WIDER = 4, 4, 8
ROWS, BLOCK, TOGETHER = 1024, 4096, 1 << 20
QUERY = ["query_id", "qa", "qb"]


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and v: floor(256 * x) of each usable vector, one row for each row."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(F.coalesce(usable, F.lit(False)))
    v = F.transform(x, lambda c: F.floor(c * SCALE).cast("long")).alias("v")
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), v)


def build(vectors: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of the vectors, and each node's (first, last, left child or -1; the right one follows), low and high."""
    order = np.arange(len(vectors))
    nodes, low, high = [[0, len(vectors), -1]], [], []
    at = 0
    while at < len(nodes):
        first, last, _ = nodes[at]
        own = vectors[order[first:last]]
        low.append(own.min(axis=0).astype(np.int64))
        high.append(own.max(axis=0).astype(np.int64))
        if last - first > leaf and own.shape[1]:
            wide = int(np.argmax(high[-1] - low[-1]))
            middle = (last - first) // 2
            part = np.argpartition(own[:, wide], middle)
            order[first:last] = order[first:last][part]
            nodes[at][2] = len(nodes)
            nodes += [[first, first + middle, -1], [first + middle, last, -1]]
        at += 1
    return order, np.array(nodes, dtype=np.int64), np.array(low, dtype=np.int64), np.array(high, dtype=np.int64)


def _kind(*arrays: np.ndarray) -> type:
    """Doubles where all inner products are exact in them, else Python's integers."""
    most = [max(1, int(a.max(initial=0)), -int(a.min(initial=0))) for a in arrays]
    return float if max(1, arrays[0].shape[1]) * most[0] * most[1] < 2**53 else object


def _score_kind(queries: np.ndarray, vectors: np.ndarray) -> type:
    """Single precision too, where lengths show that all parts of an inner product are exact in it."""
    kind = _kind(queries, vectors)
    if kind is object or not queries.size or not vectors.size:
        return kind
    length = [max(np.einsum("ij,ij->i", x, x).max() for x in (a[i : i + BLOCK].astype(float) for i in range(0, len(a), BLOCK))) for a in (queries, vectors)]
    return np.float32 if math.sqrt(length[0]) * math.sqrt(length[1]) < 2**24 - 1 else float


def _bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """What no vector of a box can score above, for each query and box."""
    kind = _kind(queries, np.concatenate([low, high]))
    q = queries.astype(kind)
    return np.maximum(q, 0) @ high.astype(kind).T + np.minimum(q, 0) @ low.astype(kind).T


def _best(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Query, score and id of the k best of each query, in order, and their places from 0."""
    query, score, one = (np.concatenate(x) for x in zip(*found, strict=True))
    less = -score
    keys = [(less & 0xFFFFFFFF).astype(np.int64), (less >> 32).astype(np.int64)] if less.dtype == object else [less]
    order = np.lexsort((one, *keys, query))
    query, score, one = query[order], score[order], one[order]
    place = np.arange(len(query)) - np.searchsorted(query, query)
    few = place < k
    return query[few], score[few], one[few], place[few]


def search(
    queries: np.ndarray, own: tuple[np.ndarray, np.ndarray], bound: np.ndarray, ids: tuple[np.ndarray, np.ndarray], vectors: np.ndarray, tree: tuple, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query (its place), score and id of the k best of a tree for each query, as far as they reach ``bound``.

    ``own`` are the queries' ids, each left out once, and which points are their vectors (-1: none of these). ``ids`` are
    the ids of all points, one point after the other, and where each point's begin.
    """
    nodes, low, high = tree
    leaves = np.flatnonzero(nodes[:, 2] < 0)
    low, high, leaves = low[leaves], high[leaves], nodes[leaves]
    kind = _score_kind(queries, vectors)
    v = vectors.astype(kind)
    some = [_search_block(queries[i : i + BLOCK], [x[i : i + BLOCK] for x in own], bound[i : i + BLOCK], ids, v, (leaves, low, high), k) for i in range(0, len(queries), BLOCK)]
    query, score, one = (np.concatenate(x) for x in zip(*some, strict=True))
    return query + np.repeat(np.arange(0, len(queries), BLOCK), [len(x[0]) for x in some]), score, one


def _search_block(queries, own, bound, ids, v, boxes, k):
    leaves, low, high = boxes
    flat, starts = ids
    most = _bounds(queries, low, high)
    place = np.argsort(np.argsort(-most, axis=1, kind="stable"), axis=1)
    q, kth = queries.astype(v.dtype), np.array(bound, dtype=object if v.dtype == object else float)
    held = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=v.dtype), np.zeros(0, dtype=np.int64))]
    waiting = 0

    def taken() -> None:
        nonlocal held, waiting
        *best, at = _best(held, k)
        held, waiting = [tuple(best)], 0
        last = at == k - 1
        kth[best[0][last]] = np.maximum(kth[best[0][last]], best[1][last].astype(kth.dtype))

    before, many = 0, 1
    while before < len(leaves):
        now = (place >= before) & (place < before + many) & (most >= kth[:, None])
        for leaf in np.flatnonzero(now.any(axis=0)):
            first, last, _ = leaves[leaf]
            rows = np.flatnonzero(now[:, leaf] & (most[:, leaf] >= kth))
            size = max(1, TOGETHER // (last - first))
            for asked in (rows[i : i + size] for i in range(0, len(rows), size)):
                scores = q[asked] @ v[first:last].T
                reach = kth[asked].astype(v.dtype)
                pairs = np.flatnonzero(scores >= reach[:, None])
                if len(pairs) > 2 * (k + 1) * len(asked) and v.dtype != object:
                    # One of the best k + 1 points may be the query's own row alone.
                    reach = np.maximum(reach, np.partition(scores, -k - 1, axis=1)[:, -k - 1])
                    pairs = np.flatnonzero(scores >= reach[:, None])
                if len(pairs):
                    at, point = np.divmod(pairs, last - first)
                    held.append(_rows(asked[at], scores[at, point], point + first, own, flat, starts))
                    waiting += len(held[-1][0])
                    if waiting > TOGETHER:
                        taken()
        taken()
        before, many = before + many, many * GROWTH
    return held[0]


def _rows(query, score, point, own, flat, starts):
    """Query, score and id of each row of some queries' points, without the queries' own rows."""
    n = starts[point + 1] - starts[point]
    which = np.repeat(np.arange(len(point)), n)
    one = flat[np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + starts[point][which]]
    mine = np.flatnonzero((own[1][query] == point)[which] & (one == own[0][query][which]))
    mine = mine[np.unique(query[which[mine]], return_index=True)[1]]
    left = np.delete(np.arange(len(which)), mine)
    return query[which[left]], score[which[left]], one[left]


class Cells:
    """The top tree over vectors of one length: all splits of a level, node i with the children 2i + 1 and 2i + 2."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        inner = (1 << depth) - 1
        self.axis, self.cut = np.zeros(inner, dtype=np.int64), np.zeros(inner, dtype=np.int64)
        parts = [sample]
        for node in range(inner):
            own = parts[node]
            if len(own):
                self.axis[node] = int(np.argmax(own.max(axis=0).astype(np.int64) - own.min(axis=0)))
                self.cut[node] = int(np.median(own[:, self.axis[node]]))
            left = own[:, self.axis[node]] <= self.cut[node] if len(own) else np.zeros(0, dtype=bool)
            parts += [own[left], own[~left]]

    def of(self, vectors: np.ndarray) -> np.ndarray:
        node = np.zeros(len(vectors), dtype=np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (vectors[np.arange(len(vectors)), self.axis[node]] > self.cut[node])
        return (node - ((1 << self.depth) - 1)).astype(np.int32)


def _packed(vectors: np.ndarray) -> np.ndarray:
    """The same numbers as narrow as they allow."""
    most = max(int(vectors.max(initial=0)), -int(vectors.min(initial=0)))
    return np.ascontiguousarray(vectors, dtype=np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.int64)


def _numbers(cell: bytes, rows: int, dim: int) -> np.ndarray:
    """The matrix whose packed bytes these are."""
    width = len(cell) // (rows * dim) if rows * dim else 8
    return np.frombuffer(cell, dtype=f"i{width}").reshape(rows, dim)


def _matrix(table: pa.Table | pa.RecordBatch, dim: int) -> np.ndarray:
    """The vectors of a column of lists or of packed bytes."""
    column = table.column("v")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if pa.types.is_list(column.type):
        return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(table.num_rows, dim)
    raw, offsets = text_bytes(column)
    width = np.diff(offsets) // max(1, dim)
    parts = {int(w): np.flatnonzero(width == w) for w in np.unique(width)} if dim else {}
    if len(parts) == 1:
        return _numbers(raw.tobytes(), table.num_rows, dim)
    out = np.zeros((table.num_rows, dim), dtype=f"i{max(parts, default=2)}")
    for w, rows in parts.items():
        out[rows] = raw[offsets[rows][:, None] + np.arange(w * dim)].view(f"i{w}")
    return out


def _most(shard: int, dim: int) -> int:
    return max(shard, NUMBERS // max(1, dim))


def split(points: DataFrame, shard: int) -> dict[int, Cells]:
    """A top tree for each length of vectors."""
    out = {}
    for row in points.groupBy("dim").agg(F.count("*").alias("n")).collect():
        dim, n = row["dim"], row["n"]
        few = min(math.log2(FEW), math.ceil(math.log2(n / shard)))
        depth = 0 if not dim else int(min(math.log2(MOST_CELLS), max(0, few, math.ceil(math.log2(n / _most(shard, dim))))))
        own = np.zeros((0, dim), dtype=np.int64)
        if depth:
            size = min(SAMPLE, max(1, NUMBERS // 2 // dim))
            # Of a table of many points those with the least hashes, about twice as many as are taken, are put in order.
            least = min(2**63 - 1, 2**65 * size // n - 2**63)
            some = points.where((F.col("dim") == dim) & (F.col("a") <= least))
            own = _matrix(some.orderBy("a", "b").limit(size).select("v").toArrow(), dim)
        out[dim] = Cells(own, depth)
    return out


def _by_dim(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            own = batch if (dims == dim).all() else batch.filter(pa.array(dims == dim))
            for a in range(0, own.num_rows, ROWS):
                yield dim, own.slice(a, ROWS)


def _celled(cells):
    """Rows with ``cell``, their vectors packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, some in _by_dim(batches):
            vectors = _matrix(some, dim)
            packed = _packed(vectors)
            width = packed.itemsize * dim
            offsets = pa.py_buffer(np.arange(0, (len(packed) + 1) * width, width, dtype=np.int32) if width else np.zeros(len(packed) + 1, dtype=np.int32))
            v = pa.Array.from_buffers(pa.binary(), len(packed), [None, offsets, pa.py_buffer(packed.tobytes())])
            columns = [v if c == "v" else some.column(c) for c in some.schema.names]
            cell = pa.array(cells.value[dim].of(vectors), pa.int32())
            yield pa.RecordBatch.from_arrays([*columns, cell], names=[*some.schema.names, "cell"])

    return run


_HELD = ["a", "b", "ids", "starts", "vectors", "nodes", "low", "high"]
TREE = f"dim int, cell int, shard int, {', '.join(f'{c} binary' for c in _HELD)}"


def _plant(table: pa.Table) -> pa.Table:
    dim = table.column("dim")[0].as_py()
    vectors = _matrix(table, dim)
    order, nodes, low, high = build(vectors)
    a, b = (table.column(c).to_numpy()[order] for c in ("a", "b"))
    ids = table.column("ids").combine_chunks().take(pa.array(order))
    starts = np.cumsum([0, *pc.list_value_length(ids).to_numpy()], dtype=np.int64)
    flat = ids.flatten().to_numpy().astype(np.int64)
    key = [pa.array([table.column(c)[0].as_py()], pa.int32()) for c in ("dim", "cell", "shard")]
    held = [a, b, flat, starts, _packed(vectors[order]), nodes, _packed(low), _packed(high)]
    return pa.table([*key, *(pa.array([x.tobytes()], pa.binary()) for x in held)], names=["dim", "cell", "shard", *_HELD])


FOUND = "query_id bigint, qa bigint, qb bigint, vec_id bigint, score bigint"
_FOUND = pa.schema([(c, pa.int64()) for c in ("query_id", "qa", "qb", "vec_id", "score")])


def _searcher(k: int):
    def run(trees: pa.Table, queries: pa.Table) -> pa.Table:
        if not trees.num_rows or not queries.num_rows:
            return _FOUND.empty_table()
        dim = queries.column("dim")[0].as_py()
        held = {c: trees.column(c)[0].as_py() for c in _HELD}
        a, b, ids, starts = (np.frombuffer(held[c], dtype=np.int64) for c in ("a", "b", "ids", "starts"))
        nodes = np.frombuffer(held["nodes"], dtype=np.int64).reshape(-1, 3)
        low, high = (_numbers(held[c], len(nodes), dim) for c in ("low", "high"))
        asked = [queries.column(c).to_numpy() for c in QUERY]
        near = np.flatnonzero(np.isin(a, asked[1]))
        place = {(a[j], b[j]): j for j in near}
        own = np.array([place.get(key, -1) for key in zip(asked[1], asked[2], strict=True)], dtype=np.int64)
        bound = queries.column("kth").to_numpy()
        query, score, one = search(_matrix(queries, dim), (asked[0], own), bound, (ids, starts), _numbers(held["vectors"], len(a), dim), (nodes, low, high), k)
        return pa.table([*(pa.array(x[query]) for x in asked), pa.array(one), pa.array(score.astype(np.int64))], schema=_FOUND)

    return run


def _boxes(trees: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each length: numbers of the cells that hold points, and their boxes."""

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                dim = row.column("dim")[0].as_py()
                nodes = len(row.column("nodes")[0].as_py()) // 24
                low, high = (_numbers(row.column(c)[0].as_py(), nodes, dim)[0].astype(np.int64) for c in ("low", "high"))
                key = [pa.array([row.column(c)[0].as_py()] * dim, pa.int32()) for c in ("dim", "cell")]
                yield pa.RecordBatch.from_arrays([*key, pa.array(np.arange(dim, dtype=np.int32)), pa.array(low), pa.array(high)], names=["dim", "cell", "axis", "low", "high"])

    each = trees.select("dim", "cell", "nodes", "low", "high").mapInArrow(roots, "dim int, cell int, axis int, low bigint, high bigint")
    box = each.groupBy("dim", "cell", "axis").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    out = {}
    rows = box.orderBy("dim", "cell", "axis").toPandas()
    for dim, own in rows.groupby("dim"):
        low, high = (own[c].to_numpy().reshape(-1, dim) for c in ("low", "high"))
        out[int(dim)] = (own["cell"].to_numpy()[::dim], low, high)
    return out


def _visiting(boxes, before: int, after: int):
    """Queries with ``cell``, those from place ``before`` to ``after`` in the order of the cells' bounds that reach the kth score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, some in _by_dim(batches):
            if dim not in boxes.value:
                continue
            numbers, low, high = boxes.value[dim]
            most = _bounds(_matrix(some, dim), low, high)
            home, kth = some.column("home").to_numpy(), some.column("kth").to_numpy()
            order = np.argsort(-most, axis=1, kind="stable")
            away = numbers[order] != home[:, None]
            place = np.cumsum(away, axis=1) - 1
            rows, at = np.nonzero(away & (place >= before) & (place < after) & (np.take_along_axis(most, order, axis=1) >= kth[:, None]))
            cells = numbers[order[rows, at]]
            size = max(1, TOGETHER // max(1, dim))
            for i in range(0, len(rows), size):
                taken = some.take(pa.array(rows[i : i + size], pa.int64()))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(cells[i : i + size], pa.int32())], names=[*some.schema.names, "cell"])

    return run


def _met(trees: DataFrame, shards: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Queries (with ``cell``) in all shards of their cells."""
    key = ["dim", "cell", "shard", "part"]
    asked = queries.groupBy("dim", "cell").agg(F.count("*").alias("n_asked"))
    most = F.least(F.lit(ASKED), F.greatest(F.lit(1), F.floor(F.lit(2 * NUMBERS) / F.greatest(F.lit(1), "dim"))))
    sizes = shards.join(asked, ["dim", "cell"]).withColumn("parts", F.ceil(F.col("n_asked") / most).cast("int"))
    sizes = sizes.select("dim", "cell", "shards", "parts")

    def numbers(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    # Trees of cells that no query visits stay where they are.
    left = trees.join(sizes, ["dim", "cell"]).withColumn("part", numbers("parts")).drop("shards", "parts")
    part = F.pmod(F.xxhash64(*QUERY), F.col("parts")).cast("int")
    right = queries.join(sizes, ["dim", "cell"]).withColumn("part", part).withColumn("shard", numbers("shards"))
    right = right.select(*key, *QUERY, "kth", "v")
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_searcher(k), FOUND)


def top_k(embeddings: DataFrame, every: int = EVERY, k: int = K, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by ``every``."""
    spark = embeddings.sparkSession
    rows = stored(named_vectors(integer_vectors(embeddings)), "vectors")
    points = stored(distinct_vectors(rows, k), "points")
    cells = spark.sparkContext.broadcast(split(points, shard))
    celled = points.mapInArrow(_celled(cells), "a bigint, b bigint, dim int, ids array<bigint>, v binary, cell int")
    celled = stored(celled, "cells")
    most = F.greatest(F.lit(shard), F.floor(F.lit(NUMBERS) / F.greatest(F.lit(1), "dim")))
    shards = celled.groupBy("dim", "cell").agg(F.count("*").alias("n")).select("dim", "cell", F.ceil(F.col("n") / most).cast("int").alias("shards"))
    dealt = celled.join(shards, ["dim", "cell"]).withColumn("shard", F.pmod(F.xxhash64("a", "b"), F.col("shards")).cast("int"))
    trees = stored(dealt.drop("shards").groupBy("dim", "cell", "shard").applyInArrow(_plant, TREE), "trees", maxRecordsPerFile=4)

    schema = "query_id bigint, qa bigint, qb bigint, copies bigint, dim int, v binary"
    asked = asked_rows(rows, every).mapInArrow(_celled(cells), f"{schema}, cell int").withColumnRenamed("cell", "home")
    asked = stored(asked, "queries")
    best = Window.partitionBy(*QUERY).orderBy(F.desc("score"), "vec_id")
    no_bound = F.lit(float("-inf"))

    def kept(found: DataFrame) -> DataFrame:
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        return stored(ranked.select(*QUERY, "rank", "vec_id", "score"), "best")

    first = asked.withColumn("cell", F.col("home")).withColumn("kth", no_bound)
    held = kept(_met(trees, shards, first, k))
    boxes = _boxes(trees)
    most = max((len(numbers) for numbers, _, _ in boxes.values()), default=0) - 1
    sent = spark.sparkContext.broadcast(boxes)
    before, many = 0, FIRST
    while before < most:
        kth = held.where(F.col("rank") == k).select(*QUERY, F.col("score").cast("double").alias("kth"))
        state = asked.join(kth, QUERY, "left").withColumn("kth", F.coalesce("kth", no_bound))
        visits = state.mapInArrow(_visiting(sent, before, before + many), f"{schema}, home int, kth double, cell int")
        visits = stored(visits, "visits")
        if not visits.isEmpty():
            held = kept(held.drop("rank").unionByName(_met(trees, shards, visits, k)))
        before, many = before + many, many * WIDER
    out = held.join(asked.select(*QUERY, "copies"), QUERY)
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    return out.select("query_id", "rank", "vec_id", "score")


ORACLE = f"""
with v as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * cast(x as double))) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.r, q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
  from v q join v c on q.r <> c.r and len(q.v) = len(c.v) where q.vec_id % {EVERY} = 0)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by r order by score desc, vec_id) as rank from s) t where rank <= {K}
"""
