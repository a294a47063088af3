"""Approximate nearest neighbours by largest inner product: a forest of random-projection trees, exact reranking.

Equal vectors are one point with its smallest ids (``k`` + 1 of them: a list of ``k`` that leaves one row out never needs
more, so nothing is lost). A point is placed on a sphere: its vector over the largest length of all, and one more
coordinate that makes up the rest; a query is its direction. The distance of the two then falls as their inner product
rises, whatever the lengths.

Index. ``TREES`` trees of one depth split the points by projections on the difference of two points, at the median. They
are fitted on the driver on a sample of at most ``SAMPLE`` points of each length, taken by the least hash; every point is
indexed, in one leaf of each tree. Depth grows with the number of points, to leaves of about ``LEAF``, up to ``DEEPEST``,
so the forest that is broadcast has at most TREES * 2**DEEPEST * (dim + 2) doubles for each length.

Search. A query first meets the points in its own leaf of each tree; the kth best score found there bounds how far
better ones can lie. Then one priority queue holds open nodes of all trees, least bound first: the squares of the margins by
which the query lies beyond the splits on the path. Leaves are visited until the least bound is beyond the reach,
``REACH`` * (kth squared distance) * depth / (dim + 1): a neighbour lies that far beyond ``depth`` splits at most, on average. So
queries among close points visit few leaves, and queries without close neighbours visit many. In a visited leaf all
scores are computed and those that reach the kth are kept; scores are exact doubles on the original vectors.

A leaf's points are dealt into blocks of about ``BLOCK`` by hash, its queries into blocks of about ``ASKED``; each pair
of blocks is one group, so a leaf with many points is spread over tasks. Vectors of different lengths never meet.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows without an id, take no
part; repeated rows are rows of their own, each with a list of its own; only the query's own row is left out; ties go to
the smaller id; with fewer than k candidates all are returned; an empty table gives no rows; other columns are ignored.
The number of different lengths in a table is taken to be small: each has a forest.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrid.llm.common import asked_rows, distinct_vectors, named_vectors, stored

K, EVERY = 20, 20
TREES, LEAF, DEEPEST, SAMPLE = 4, 1024, 12, 32_768
REACH = 0.15
BLOCK, ASKED = 16_384, 4096
ROWS = 1024
FOUND = "query_id bigint, qa bigint, qb bigint, copies bigint, a bigint, b bigint, ids array<bigint>, score double"

_LONGS = ["query_id", "qa", "qb", "copies", "a", "b"]
_FOUND = pa.schema([*((c, pa.int64()) for c in _LONGS), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, v (doubles) and a, b, two hashes that name the vector."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    some = F.exists(x, lambda c: c != 0)
    rows = embeddings.where(F.col("vec_id").isNotNull()).where(F.coalesce(finite & some, F.lit(False)))
    # 0.0 + x: negative zeros are zeros.
    v = F.transform(x, lambda c: F.lit(0.0) + c).alias("v")
    return named_vectors(rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), v))


def with_size(rows: DataFrame) -> DataFrame:
    """``rows`` with ``size``, the length of the vector ``v``."""
    largest = F.array_max(F.transform("v", F.abs))
    scaled = F.aggregate("v", F.lit(0.0), lambda s, c: s + (c / largest) * (c / largest))
    return rows.withColumn("size", largest * F.sqrt(scaled))


class Forest:
    """Trees of one depth over unit vectors of ``dim + 1`` coordinates; node i has the children 2i + 1 and 2i + 2."""

    def __init__(self, sample: np.ndarray, depth: int, trees: int, reach: float, longest: float, seed: int = 17):
        self.depth, self.trees, self.reach, self.longest = depth, trees, reach, longest
        inner, self.width = (1 << depth) - 1, sample.shape[1] + 1
        self.normals, self.cuts = np.zeros((trees, inner, self.width)), np.zeros((trees, inner))
        placed = self.placed(sample)
        draw = np.random.default_rng(seed)
        for tree in range(trees):
            parts = [np.arange(len(placed))]
            for node in range(inner):
                own = parts[node]
                normal = np.zeros(self.width)
                if len(own) > 1:
                    first, second = draw.choice(len(own), 2, replace=False)
                    normal = placed[own[first]] - placed[own[second]]
                if np.linalg.norm(normal) < 1e-9:
                    normal = draw.standard_normal(self.width)
                normal /= np.linalg.norm(normal)
                side = placed[own] @ normal
                cut = float(np.median(side)) if len(own) else 0.0
                self.normals[tree, node], self.cuts[tree, node] = normal, cut
                parts += [own[side <= cut], own[side > cut]]

    def placed(self, vectors: np.ndarray) -> np.ndarray:
        inside = vectors / self.longest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (inside * inside).sum(axis=1)))
        return np.concatenate([inside, rest[:, None]], axis=1)

    def directions(self, queries: np.ndarray) -> np.ndarray:
        scaled = queries / np.abs(queries).max(axis=1, keepdims=True)
        scaled /= np.linalg.norm(scaled, axis=1, keepdims=True)
        return np.concatenate([scaled, np.zeros((len(queries), 1))], axis=1)

    def leaves(self, placed: np.ndarray) -> np.ndarray:
        """Each row's leaf (0 to 2**depth - 1) in each tree."""
        out = np.zeros((len(placed), self.trees), dtype=np.int32)
        for tree in range(self.trees):
            node = np.zeros(len(placed), dtype=np.int64)
            for _ in range(self.depth):
                margin = np.einsum("ij,ij->i", placed, self.normals[tree, node]) - self.cuts[tree, node]
                node = 2 * node + 1 + (margin > 0)
            out[:, tree] = node - ((1 << self.depth) - 1)
        return out

    def further(self, placed: np.ndarray, kth: np.ndarray) -> Iterator[list[tuple[int, int]]]:
        """For each query the (tree, leaf) that it visits beside its own leaves.

        ``kth`` is the cosine, on the sphere, of the kth best found so far, or -inf. One queue holds the open nodes of
        all trees; it ends when the least bound is beyond the reach.
        """
        inner = (1 << self.depth) - 1
        margins = np.einsum("ij,tnj->itn", placed, self.normals) - self.cuts
        reach = self.reach * np.maximum(0.0, 2.0 - 2.0 * kth) * self.depth / self.width
        for row, limit in zip(margins, reach.tolist(), strict=True):
            row, out = row.tolist(), []
            queue = [(0.0, tree, 0) for tree in range(self.trees)]
            while queue and queue[0][0] <= limit:
                bound, tree, node = heapq.heappop(queue)
                if node >= inner:
                    if bound > 0.0:
                        out.append((tree, node - inner))
                    continue
                margin = row[tree][node]
                near, beyond = 2 * node + 1 + (margin > 0), bound + margin * margin
                heapq.heappush(queue, (bound, tree, near))
                if beyond <= limit:
                    heapq.heappush(queue, (max(beyond, 5e-324), tree, 4 * node + 3 - near))
            yield out


def _matrix(table: pa.Table | pa.RecordBatch, dim: int) -> np.ndarray:
    column = table.column("v")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def grown(points: DataFrame, trees: int, leaf: int, reach: float, sample: int = SAMPLE) -> dict[int, Forest]:
    """A forest for each length of vectors."""
    out = {}
    stats = points.groupBy("dim").agg(F.count("*").alias("n"), F.max("size").alias("longest")).collect()
    for row in stats:
        depth = max(0, min(DEEPEST, round(math.log2(row["n"] / leaf))))
        own = np.zeros((0, row["dim"]))
        if depth:
            taken = points.where(F.col("dim") == row["dim"]).orderBy("a", "b").limit(sample).select("v").toArrow()
            own = _matrix(taken, row["dim"])
        out[row["dim"]] = Forest(own, depth, trees, reach, row["longest"])
    return out


def _lists(values: list[list], kind: pa.DataType) -> pa.Array:
    return pa.array(values, pa.list_(kind))


def _by_dim(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            own = batch if (dims == dim).all() else batch.filter(pa.array(dims == dim))
            for a in range(0, own.num_rows, ROWS):
                yield dim, own.slice(a, ROWS)


def _routing(forests, asked: bool):
    """Rows with ``leaf``, their leaf in each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, some in _by_dim(batches):
            forest, vectors = forests.value[dim], _matrix(some, dim)
            placed = forest.directions(vectors) if asked else forest.placed(vectors)
            leaves = _lists(list(forest.leaves(placed)), pa.int32())
            yield pa.RecordBatch.from_arrays([*some.columns, leaves], names=[*some.schema.names, "leaves"])

    return run


def _visiting(forests):
    """Rows with ``visits``, the further (tree, leaf) of each query as tree * 2**DEEPEST + leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, batch in _by_dim(batches):
            forest = forests.value[dim]
            step = max(1, (1 << 21) >> (forest.depth + 2))
            for a in range(0, batch.num_rows, step):
                some = batch.slice(a, step)
                vectors = _matrix(some, dim)
                kth = some.column("kth").to_numpy(zero_copy_only=False) / (some.column("size").to_numpy() * forest.longest)
                found = forest.further(forest.directions(vectors), kth)
                visits = _lists([[tree << DEEPEST | leaf for tree, leaf in f] for f in found], pa.int32())
                yield pa.RecordBatch.from_arrays([*some.columns, visits], names=[*some.schema.names, "visits"])

    return run


def scored(points: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """For each query its best points of a leaf, as far as they reach ``kth``: all that can be among the k best."""
    if not points.num_rows or not queries.num_rows:
        # By hash, a block can be empty.
        return _FOUND.empty_table()
    dim = queries.column("dim")[0].as_py()
    q, v = _matrix(queries, dim), _matrix(points, dim)
    kth = queries.column("kth").to_numpy()
    a, b = points.column("a").to_numpy(), points.column("b").to_numpy()
    ids = points.column("ids").to_pylist()
    qa, qb, own = (queries.column(c).to_numpy() for c in ("qa", "qb", "query_id"))
    size = queries.column("size").to_numpy() * points.column("size").to_numpy().max(initial=0.0)
    rows, at, score, kept = [], [], [], []
    step = max(1, (1 << 22) // max(1, len(v)))
    for first in range(0, len(q), step):
        rough = q[first : first + step] @ v.T
        for i, line in enumerate(rough, first):
            # A product of matrices may round otherwise than the sum that counts.
            slack = 1e-12 * size[i]
            least = kth[i]
            if len(line) > k + 1:
                least = max(least, np.partition(line, len(line) - k - 1)[len(line) - k - 1])
            near = np.flatnonzero(line >= least - slack)
            exact = (v[near] * q[i]).sum(axis=1)
            for j, s in zip(near.tolist(), exact.tolist(), strict=True):
                left = ids[j]
                if a[j] == qa[i] and b[j] == qb[i]:
                    left = list(left)
                    if own[i] in left:
                        left.remove(own[i])
                if left:
                    rows.append(i)
                    at.append(j)
                    score.append(s)
                    kept.append(left[:k])
    who, which = pa.array(rows, pa.int64()), pa.array(at, pa.int64())
    columns = [queries.column(c).take(who) for c in ("query_id", "qa", "qb", "copies")]
    columns += [points.column(c).take(which) for c in ("a", "b")]
    columns += [pa.array(kept, pa.list_(pa.int64())), pa.array(score, pa.float64())]
    return pa.table(columns, schema=_FOUND)


def _met(points: DataFrame, queries: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """Queries (with ``place``) against the points of those leaves, block by block."""
    key = ["dim", "place", "block", "part"]
    asked = queries.groupBy("dim", "place").agg(F.count("*").alias("n_asked"))
    # One row for each leaf that is visited.
    sizes = blocks.join(asked, ["dim", "place"]).select(
        "dim", "place", "blocks", F.ceil(F.col("n_asked") / ASKED).cast("int").alias("parts")
    )

    def dealt(n: str) -> Column:
        return F.sequence(F.lit(0), F.col(n) - 1)

    def own(n: str, *names: str) -> Column:
        return F.pmod(F.xxhash64(*names), F.col(n)).cast("int")

    left = points.join(sizes, ["dim", "place"]).withColumn("block", own("blocks", "a", "b"))
    left = left.withColumn("part", F.explode(dealt("parts"))).select(*key, "a", "b", "size", "ids", "v")
    right = queries.join(sizes, ["dim", "place"]).withColumn("part", own("parts", "qa", "qb", "query_id"))
    right = right.withColumn("block", F.explode(dealt("blocks")))
    right = right.select(*key, "query_id", "qa", "qb", "copies", "size", "kth", "v")

    def meet(points: pa.Table, queries: pa.Table) -> pa.Table:
        return scored(points, queries, k)

    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, FOUND)


def nearest(
    embeddings: DataFrame,
    every: int = EVERY,
    k: int = K,
    trees: int = TREES,
    leaf: int = LEAF,
    reach: float = REACH,
) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by ``every``."""
    spark = embeddings.sparkSession
    rows = usable(embeddings)
    points = stored(with_size(distinct_vectors(rows, k)).select("a", "b", "dim", "size", "ids", "v"), "points")
    forests = spark.sparkContext.broadcast(grown(points, trees, leaf, reach))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema)
    routed = points.mapInArrow(_routing(forests, False), f"{schema}, leaves array<int>")
    place = F.posexplode("leaves").alias("tree", "leaf")
    number = F.shiftleft("tree", DEEPEST).bitwiseOR(F.col("leaf")).alias("place")
    names = ["a", "b", "dim", "size", "ids", "v"]
    placed = stored(routed.select(*names, place).select(*names, number), "leaves")
    blocks = placed.groupBy("dim", "place").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))

    asked = with_size(asked_rows(rows, every)).select("query_id", "qa", "qb", "copies", "dim", "size", "v")
    no_bound = F.lit(float("-inf")).alias("kth")
    asked = stored(asked.select("*", no_bound), "queries")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asked.schema)
    homes = asked.mapInArrow(_routing(forests, True), f"{schema}, leaves array<int>")
    first = homes.select(*asked.columns, place).select(*asked.columns, number)
    query = ["query_id", "qa", "qb"]
    seen = stored(_met(placed, first, blocks, k), "home-leaves")

    falling = Window.partitionBy(*query).orderBy(F.desc("score"), "a", "b").rowsBetween(Window.unboundedPreceding, 0)
    distinct = seen.dropDuplicates([*query, "a", "b"])
    upto = distinct.withColumn("n", F.sum(F.size("ids")).over(falling)).where(F.col("n") >= k)
    bounds = upto.groupBy(*query).agg(F.max("score").alias("kth"))
    bounded = asked.drop("kth").join(bounds, query, "left").withColumn("kth", F.coalesce("kth", no_bound))
    again = bounded.select(*asked.columns).mapInArrow(_visiting(forests), f"{schema}, visits array<int>")
    again = stored(again.select(*asked.columns, F.explode("visits").alias("place")), "visits")
    rest = _met(placed, again, blocks, k)

    found = seen.unionByName(rest).dropDuplicates([*query, "a", "b"])
    each = found.select(*query, "copies", "score", F.explode("ids").alias("vec_id"))
    best = Window.partitionBy(*query).orderBy(F.desc("score"), "vec_id")
    ranked = each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    out = ranked.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    return out.select("query_id", "rank", "vec_id", "score")


#: All candidates: what the forest approaches. The registered query has no SQL, as it may miss some.
EXACT = f"""
with s as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings
  where vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0)
select query_id, cast(rank as integer) as rank, vec_id, score from (
  select q.r, q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v) as score,
    row_number() over (partition by q.r order by list_dot_product(q.v, c.v) desc, c.vec_id) as rank
  from s q join s c on q.r <> c.r and len(q.v) = len(c.v) where q.vec_id % {EVERY} = 0) t where rank <= {K}
"""
