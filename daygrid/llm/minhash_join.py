"""N-gram Jaccard join by MinHash banding.

A text is the set of its n-grams of ``N`` words (lower-cased A-Z, split at ASCII white space); a text with fewer words
is one n-gram of them all. Documents with the same set are copies of one text; texts are joined, not documents.

1. Each text gets ``bands * rows`` min-hashes, one byte of each; ``banding`` picks the fewest bands that find a pair at
   the threshold with the target probability. Texts are shuffled on the bytes of each band.
2. Within a band's bucket, bytes of all min-hashes estimate each pair's similarity. Pairs far below the threshold are
   left out; of the others a spanning forest is kept, so a bucket of any size gives fewer rows than it has members.
3. The forests' components are the candidates. All pairs of a component are verified on full n-gram sets, and give
   exact numbers of links and the edges of the classes.

Buckets and components beyond ``BLOCK`` members are cut into blocks, and each two blocks meet in a task of their own.
The only loss is a link that shares no band with its component; ``recall`` bounds it.

Defined results: null, empty and white-space texts have no n-grams, no links and their own id as class; a class is named
by its least doc_id; rows with equal ids count as documents of their own; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.common import mixed, pieces, small_side, stored, text_bytes, words_of
from daygrid.llm.components import components

N = 5
THRESHOLD = 0.8
RECALL = 0.998
ROWS = 6
#: Members of a block. A class of m texts sends each of them to m / BLOCK pairs of blocks.
BLOCK = 1024
#: Pairs whose estimate lies this far below the threshold are no candidates: over four standard deviations at 0.8.
MARGIN = 0.15
BROADCAST_ROWS = 500_000
#: Columns of an incidence block when n-gram sets are compared.
COLUMNS = 4096


def banding(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> int:
    """The fewest bands of ``rows`` min-hashes that hold a pair at the threshold with probability ``recall``."""
    return int(np.ceil(np.log1p(-recall) / np.log1p(-(threshold**rows))))


def ngram_sets(raw: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its distinct n-grams."""
    words, first = words_of(raw, offsets)
    step = np.uint64(0x9DDFEA08EB382D69)
    grams = np.zeros(max(0, len(words) - n + 1), dtype=np.uint64)
    for j in range(n):
        grams = grams * step + words[j : j + len(grams)]
    grams = mixed(grams)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= n:
            yield np.unique(grams[a : b - n + 1])
        elif b > a:
            whole = int(b - a)
            for w in words[a:b].tolist():
                whole = (whole * int(step) + w) % (1 << 64)
            yield mixed(np.array([whole], dtype=np.uint64))
        else:
            yield grams[:0]


def _signer(n: int, hashes: int):
    draw = np.random.Generator(np.random.PCG64(20_011))
    factors = draw.integers(0, 1 << 32, hashes, dtype=np.uint32) | np.uint32(1)
    masks = draw.integers(0, 1 << 32, hashes, dtype=np.uint32)

    def signature(grams: np.ndarray) -> np.ndarray:
        low = np.full(hashes, 0xFFFFFFFF, dtype=np.uint32)
        for a in range(0, len(grams), 2048):
            part = (grams[a : a + 2048] >> np.uint64(32)).astype(np.uint32)
            np.minimum(low, ((part[:, None] ^ masks) * factors).min(axis=0), out=low)
        return low.astype(np.uint8)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            for lo, hi in pieces(offsets):
                at = offsets[lo : hi + 1]
                ids, signed = [], []
                for grams in ngram_sets(raw[at[0] : at[-1]], at - at[0], n):
                    if len(grams):
                        pair = np.array([grams.sum(dtype=np.uint64), mixed(grams ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)])
                        ids.append(pair.tobytes())
                        signed.append(signature(grams).tobytes())
                    else:
                        ids.append(None)
                        signed.append(None)
                part = batch.slice(lo, hi - lo)
                columns = [part.column("doc_id"), part.column("th"), pa.array(ids, pa.binary()), pa.array(signed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "th", "id", "sig"])

    return sign


def _set_maker(n: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            for lo, hi in pieces(offsets):
                at = offsets[lo : hi + 1]
                found = [g.tobytes() for g in ngram_sets(raw[at[0] : at[-1]], at - at[0], n)]
                ids = batch.column("id").slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([ids, pa.array(found, pa.binary())], names=["id", "grams"])

    return sets


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each member's component under the pairs (a, b)."""
    root = np.arange(n)
    if not len(a):
        return root
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if np.array_equal(root, before):
            return root


def _dense_roots(n: int, left: np.ndarray, right: np.ndarray, close: np.ndarray) -> np.ndarray:
    """As ``_roots``, for the pairs that ``close`` marks; no list of pairs is made, of which a block of copies has a million."""
    root = np.arange(n)
    while True:
        new = root.copy()
        new[left] = np.minimum(new[left], np.where(close, root[right][None, :], n).min(axis=1, initial=n))
        new[right] = np.minimum(new[right], np.where(close, new[left][:, None], n).min(axis=0, initial=n))
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys in a stream that is sorted by them."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        now = pa.concat_tables([rest, now]).combine_chunks() if rest is not None else now
        changes = np.zeros(now.num_rows, dtype=bool)
        for key in keys:
            values = now.column(key).to_numpy(zero_copy_only=False)
            changes[1:] |= values[1:] != values[:-1]
        cuts = [0, *np.flatnonzero(changes)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield now.slice(a, b - a)
        rest = now.slice(cuts[-1])
    if rest is not None:
        yield rest


def _sides(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Members of the two blocks that meet; one and the same if a block meets itself."""
    mine = group.column("mine").to_numpy()
    p, q = group.column("p")[0].as_py(), group.column("q")[0].as_py()
    return np.flatnonzero(mine == p), np.flatnonzero(mine == q)


def spanning(signed: np.ndarray, left: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    """A first member for each member, the same one throughout a component of the pairs (left, right) estimated at ``least``.

    Breadth first: members that are reached are compared with those not yet reached only, so a bucket of near copies
    costs about one comparison a member.
    """
    root = np.arange(len(signed))
    waiting = {0: np.zeros(len(signed), dtype=bool), 1: np.zeros(len(signed), dtype=bool)}
    waiting[0][left] = True
    waiting[1][right] = True
    one_side = np.array_equal(left, right)
    if one_side:
        waiting[1] = waiting[0]
    for seed in left.tolist():
        if not waiting[0][seed]:
            continue
        waiting[0][seed] = False
        reached, many = [(0, np.array([seed]))], 1
        while reached:
            side, nodes = reached.pop()
            some, later = nodes[:many], nodes[many:]
            if len(later):
                reached.append((side, later))
            other = 0 if one_side else 1 - side
            rest = np.flatnonzero(waiting[other])
            if not len(rest):
                continue
            alike = (signed[some][:, None, :] == signed[rest][None, :, :]).mean(axis=2)
            new = rest[((alike - 1 / 256) / (1 - 1 / 256) >= least).any(axis=0)]
            if len(new):
                waiting[other][new] = False
                root[new] = seed
                reached.append((other, new))
            many = 32
    return root


def _estimator(least: float):
    def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["band", "p", "q"]):
            if group.num_rows < 2:
                continue
            ids = np.array(group.column("id").to_pylist(), dtype=object)
            signed = np.frombuffer(b"".join(group.column("sig").to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
            root = spanning(signed, *_sides(group), least)
            linked = np.flatnonzero(root != np.arange(len(ids)))
            if len(linked):
                columns = [pa.array(ids[linked], pa.binary()), pa.array(ids[root[linked]], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["u", "v"])

    return forests


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of each left set with each right set."""
    member = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    grams, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times[column] > 1
    member, column = member[common], (np.cumsum(times > 1) - 1)[column[common]]
    order = np.argsort(column, kind="stable")
    member, column = member[order], column[order]
    total = np.zeros((len(left), len(right)), dtype=np.float64)
    width = int((times > 1).sum())
    for a in range(0, width, COLUMNS):
        lo, hi = np.searchsorted(column, [a, a + COLUMNS])
        block = np.zeros((len(sets), min(COLUMNS, width - a)), dtype=np.float32)
        block[member[lo:hi], column[lo:hi] - a] = 1
        total += block[left] @ block[right].T
    return total


def _verifier(threshold: float):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["root", "p", "q"]):
            ids = np.array(group.column("id").to_pylist(), dtype=object)
            sets = [np.frombuffer(g, dtype=np.uint64) for g in group.column("grams").to_pylist()]
            copies = group.column("copies").to_numpy()
            left, right = _sides(group)
            sizes = np.array([len(s) for s in sets], dtype=np.float64)
            both = overlaps(sets, left, right)
            close = both + 1e-9 >= threshold * (sizes[left][:, None] + sizes[right][None, :] - both)
            close &= left[:, None] != right[None, :]
            linked = np.zeros(len(ids), dtype=np.int64)
            linked[left] += (close * copies[right][None, :]).sum(axis=1)
            if not np.array_equal(left, right):
                linked[right] += (close * copies[left][:, None]).sum(axis=0)
            root = _dense_roots(len(ids), left, right, close)
            at = np.flatnonzero(linked)
            if len(at):
                columns = [pa.array(ids[at], pa.binary()), pa.array(linked[at]), pa.array(ids[root[at]], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "links", "root"])

    return links


def in_blocks(members: DataFrame, key: str, block: int) -> DataFrame:
    """Members (id, ``key``) of groups of two and more, once for each two blocks that meet: mine, p and q are added."""
    sizes = members.groupBy(key).agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / block)
    return (
        members.join(sizes, key)
        .withColumn("mine", F.pmod(F.xxhash64("id"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
        .select("id", key, "mine", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"))
    )


def _met(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def jaccard_classes(
    documents: DataFrame,
    n: int = N,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    rows: int = ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """For each document doc_id, th (hash of its text), class_id, n_links (other documents at the threshold or above).

    ``class_key`` tells classes apart also where ids are null or occur twice; it is null for texts without n-grams.
    """
    bands = banding(threshold, recall, rows)
    kind = documents.schema["doc_id"].dataType.simpleString()
    texts = documents.select("doc_id", F.xxhash64("text").alias("th"), "text")
    signed = texts.mapInArrow(_signer(n, bands * rows), f"doc_id {kind}, th bigint, id binary, sig binary")
    signed = stored(signed, "signatures")
    distinct = stored(
        signed.where("id is not null")
        .groupBy("id")
        .agg(
            F.min(F.struct("doc_id", "th")).alias("example"),
            F.min("doc_id").alias("least_id"),
            F.count("*").alias("copies"),
            F.any_value("sig").alias("sig"),
        ),
        "distinct-sets",
    )

    band_keys = [F.concat(F.lit(bytes([b])), F.substring("sig", b * rows + 1, rows)) for b in range(bands)]
    members = distinct.select("id", F.explode(F.array(*band_keys)).alias("band"))
    met = in_blocks(members, "band", block).join(distinct.select("id", "sig"), "id")
    forests = _met(met, ["band", "p", "q"]).mapInArrow(_estimator(threshold - MARGIN), "u binary, v binary")
    candidates = components(forests)

    inside = in_blocks(candidates, "root", block)
    example = distinct.join(candidates.select("id"), "id").select("id", "example.doc_id", "example.th")
    example = small_side(stored(example, "candidate-texts"), BROADCAST_ROWS).alias("e")
    t = texts.distinct().alias("t")
    on = F.col("t.doc_id").eqNullSafe(F.col("e.doc_id")) & F.col("t.th").eqNullSafe(F.col("e.th"))
    sets = t.join(example, on).select("e.id", "t.text").mapInArrow(_set_maker(n), "id binary, grams binary")
    whole = inside.join(distinct.select("id", "copies"), "id").join(sets, "id")
    links = stored(
        _met(whole, ["root", "p", "q"]).mapInArrow(_verifier(threshold), "id binary, links bigint, root binary"), "links"
    )

    classes = components(links.select(F.col("id").alias("u"), F.col("root").alias("v")))
    named = classes.join(distinct.select("id", "least_id"), "id")
    names = named.groupBy("root").agg(F.min("least_id").alias("class_id"))
    counts = links.groupBy("id").agg(F.sum("links").alias("links"))
    linked = named.join(names, "root").join(counts, "id").select("id", "root", "class_id", "links")
    per_set = distinct.join(linked, "id", "left").select(
        "id",
        F.when(F.col("links").isNull(), F.col("least_id")).otherwise(F.col("class_id")).alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "id").alias("class_key"),
    )
    return signed.join(per_set, "id", "left").select(
        "doc_id",
        "th",
        F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        "class_key",
    )


ORACLE = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
g as (
  select distinct doc_id, array_to_string(w[s:s + 4], ' ') as gram
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as s from d where len(w) > 0) t),
n as (select doc_id, count(*) as n from g group by doc_id),
links as (
  select a, b from (select x.doc_id as a, y.doc_id as b, count(*) as shared
    from g x join g y on x.gram = y.gram and x.doc_id <> y.doc_id group by 1, 2) t
  join n na on na.doc_id = a join n nb on nb.doc_id = b where 5 * shared >= 4 * (na.n + nb.n - shared)),
reach as (select a, b from links union select reach.a, links.b from reach join links on reach.b = links.a)
select doc_id, least(doc_id, coalesce((select min(b) from reach where a = doc_id), doc_id)) as class_id,
  (select count(*) from links where a = doc_id) as n_links
from documents
"""
