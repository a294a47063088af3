"""Centroid clustering of integer vectors; each round searches a vantage-point tree over the centroids.

Vectors of ``DIM`` components become floor(``SCALE`` * x). The first centroids are the ``K`` vectors with the smallest
sha256 of ``1:<vec_id>``. Each of ``ROUNDS`` rounds builds the tree anew on the driver, broadcasts it, assigns every
vector to its nearest centroid and moves the centroids to the floored means; vectors are then assigned once more.

A node of the tree holds a vantage centroid and, of both children, the range of distances to it; a leaf holds up to
``LEAF`` centroids. Each vector has a queue of open nodes and takes the one with the least bound until that bound is
beyond its best distance; the comparison is inclusive, so a centroid at the same distance with a smaller number is
found. Bounds are doubles with a margin far above their rounding; distances are exact integers. A batch's vectors step
together in numpy, each with its own queue.

Bounds: the driver and each task hold the centroids and their sums, ``K * DIM`` numbers; ``K`` is a parameter, refused
beyond ``MOST`` centroids. A task adds up its own vectors by cluster before the shuffle, so a cluster with most of all
vectors costs no more than another.

Defined results: vectors that are null, of another length, or hold null or non-finite components take no part; repeated
rows are vectors of their own; a null id is clustered but never starts a centroid before one with an id; vectors of one
hash go in the order of their components; fewer than ``K`` vectors give as many centroids; an empty table gives no rows;
other columns are ignored. Scaled components beyond 2**27 stop the job, since distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.common import stored

K, DIM, SCALE, ROUNDS = 16, 64, 64, 3
LEAF = 4
MOST = 1 << 16
LARGEST = 1 << 27
#: Vectors that step together.
BATCH = 4096
_FAR = np.iinfo(np.int64).max


def integer_vectors(embeddings: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """vec_id and v: floor(scale * x) of each usable vector."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = embeddings.where(F.size("embedding") == dim).where(F.coalesce(usable, F.lit(False)))
    large = F.raise_error(F.lit(f"a component beyond {LARGEST} after scaling")).cast("bigint")
    v = F.transform(x, lambda c: F.when(F.abs(c * scale) > LARGEST, large).otherwise(F.floor(c * scale).cast("bigint")))
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v"))


def first_centroids(vectors: DataFrame, k: int = K) -> np.ndarray:
    """The vectors with the smallest hashes of their ids, in that order."""
    named = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(named.alias("named"), "v").orderBy(F.asc_nulls_last("named"), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64)


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    apart = vectors - centroid
    return np.einsum("ij,ij->i", apart, apart)


class VantageTree:
    """Nodes in one list: (vantage, near child, far child) inside, (-1, members) at a leaf; ranges for each child."""

    def __init__(self, centroids: np.ndarray, leaf: int = LEAF):
        self.centroids = centroids
        self.vantage: list[int] = []
        self.children: list[tuple[int, int]] = []
        self.members: list[np.ndarray] = []
        self.low: list[float] = []
        self.high: list[float] = []
        waiting = [(np.arange(len(centroids)), 0.0, np.inf, -1)]
        while waiting:
            own, low, high, parent = waiting.pop()
            number = len(self.vantage)
            if parent >= 0:
                self.children[parent] = (*self.children[parent], number)
            self.low.append(low)
            self.high.append(high)
            self.children.append(())
            if len(own) <= leaf:
                self.vantage.append(-1)
                self.members.append(own)
                continue
            # The vantage point is the member furthest from the mean: distances to it differ most.
            middle = centroids[own].astype(float).mean(axis=0)
            at = int(np.argmax(((centroids[own] - middle) ** 2).sum(axis=1)))
            vantage, rest = int(own[at]), np.delete(own, at)
            away = np.sqrt(squared(centroids[rest], centroids[vantage]).astype(float))
            order = np.argsort(away, kind="stable")
            rest, away = rest[order], away[order]
            self.vantage.append(vantage)
            self.members.append(np.array([vantage]))
            half = (len(rest) + 1) // 2
            for part in (slice(0, half), slice(half, None)):
                if len(rest[part]):
                    waiting.append((rest[part], float(away[part][0]), float(away[part][-1]), number))

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector the number of its nearest centroid, the smaller one of a tie, and the squared distance."""
        n = len(vectors)
        best, number = np.full(n, _FAR, dtype=np.int64), np.full(n, len(self.centroids), dtype=np.int64)
        bound = np.full((n, len(self.vantage)), np.inf)
        bound[:, 0] = 0.0
        active = np.arange(n)
        while len(active):
            taken = np.argmin(bound[active], axis=1)
            least = bound[active, taken]
            # Inclusive: a node whose bound equals the best distance may hold a tie. inf - inf is not asked.
            open_ = np.isfinite(least) & (least * (1 - 1e-9) - 1e-9 <= np.sqrt(best[active].astype(float)))
            active, taken, least = active[open_], taken[open_], least[open_]
            bound[active, taken] = np.inf
            for node in np.unique(taken):
                here = taken == node
                rows, own = active[here], vectors[active[here]]
                for member in self.members[node]:
                    away = squared(own, self.centroids[member])
                    closer = (away < best[rows]) | ((away == best[rows]) & (member < number[rows]))
                    best[rows[closer]], number[rows[closer]] = away[closer], member
                if self.vantage[node] >= 0:
                    away = np.sqrt(away.astype(float))
                    for child in self.children[node]:
                        ring = np.maximum(away - self.high[child], self.low[child] - away)
                        bound[rows, child] = np.maximum(least[here], ring)
        return number, best


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _summing(tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = tree.value.centroids
        sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), dtype=np.int64)
        for batch in batches:
            for a in range(0, batch.num_rows, BATCH):
                vectors = _matrix(batch.slice(a, BATCH), centroids.shape[1])
                number, _ = tree.value.nearest(vectors)
                np.add.at(sums, number, vectors)
                counts += np.bincount(number, minlength=len(counts))
        held = np.flatnonzero(counts)
        columns = [pa.array(held.astype(np.int32)), pa.array(counts[held]), pa.array(list(sums[held]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", "total"])

    return run


def _assigning(tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BATCH):
                some = batch.slice(a, BATCH)
                number, best = tree.value.nearest(_matrix(some, tree.value.centroids.shape[1]))
                columns = [some.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(best)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return run


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floored means of the vectors nearest to each centroid; one without vectors stays."""
    tree = vectors.sparkSession.sparkContext.broadcast(VantageTree(centroids))
    parts = vectors.mapInArrow(_summing(tree), "cluster int, n bigint, total array<bigint>")
    each = parts.select("cluster", "n", F.posexplode("total").alias("at", "x"))
    summed = each.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    out = centroids.copy()
    for row in summed.collect():
        out[row["cluster"], row["at"]] = int(row["x"]) // row["n"]
    tree.unpersist()
    return out


def clustered(
    embeddings: DataFrame, k: int = K, dim: int = DIM, scale: int = SCALE, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster and distance (squared) of each vector, and the final centroids."""
    if k > MOST:
        raise ValueError(f"{k} centroids; the trees are broadcast for {MOST} at most")
    spark = embeddings.sparkSession
    vectors = stored(integer_vectors(embeddings, dim, scale), "vectors")
    centroids = first_centroids(vectors, k)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), centroids
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    tree = spark.sparkContext.broadcast(VantageTree(centroids))
    assigned = vectors.mapInArrow(_assigning(tree), "vec_id bigint, cluster int, distance bigint")
    return stored(assigned, "assigned"), centroids


def digest(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The registered query's columns: each cluster's and the whole inertia, and a hash of its final centroid."""
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    whole = sum(int(r["s"]) for r in sums)
    hashed = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(r["cluster"], int(r["s"]), whole, hashed[r["cluster"]]) for r in sums]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    clusters = assigned.sparkSession.createDataFrame(rows, schema)
    # At most one row for each centroid.
    return assigned.join(F.broadcast(clusters), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _round_sql(n: int) -> str:
    """Tables a<n> (nearest centroid of each row among c<n>) and c<n + 1> (the centroids moved)."""
    return f"""
a{n} as materialized (
  select r, min(struct_pack(d := list_sum(list_transform(list_zip(s.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c := c.c)) as a
  from s, c{n} c group by r),
m{n} as (
  select a.a.c as c, pos, sum(x) as x, count(*) as n
  from (select r, unnest(v) as x, generate_subscripts(v, 1) as pos from s) u join a{n} a on u.r = a.r group by 1, 2),
c{n + 1} as materialized (
  select c.c, coalesce(f.v, c.v) as v from c{n} c left join (
    select c, list(cast((x - ((x % n) + n) % n) // n as bigint) order by pos) as v from m{n} group by c) f on c.c = f.c)"""


ORACLE = f"""
with s as materialized (
  select row_number() over () as r, vec_id,
    list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as v
  from embeddings where len(embedding) = {DIM} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c0 as materialized (
  select row_number() over (order by h nulls last, v) - 1 as c, v
  from (select sha256('1:' || vec_id) as h, v from s order by h nulls last, v limit {K}) t),
{",".join(_round_sql(n) for n in range(ROUNDS + 1))},
t as (select a.c as c, sum(a.d) as d from a{ROUNDS} group by 1)
select s.vec_id, cast(a.a.c as integer) as cluster, cast(a.a.d as bigint) as distance,
  cast(t.d as bigint) as cluster_inertia, cast((select sum(d) from t) as bigint) as inertia,
  sha256(array_to_string(c.v, ',')) as centroid_sha256
from s join a{ROUNDS} a on s.r = a.r join t on t.c = a.a.c join c{ROUNDS} c on c.c = a.a.c
"""
