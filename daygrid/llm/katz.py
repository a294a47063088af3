"""Katz back-off scores: Good-Turing discounted counts, back-off weights that make each distribution sum to one.

Tokens are words (A-Z lowered, split at ASCII white space) and one end for each text; the end also stands before its
first word. With d the Good-Turing ratio of counts up to ``K``, c counts of the training texts and P1(w) = d c(w) / N,

    P(w | h) = d c(h w) / c(h)     if h w was seen,
               a(h) P1(w)          otherwise,

where a(h) = (1 - what the seen words take) / (1 - their P1) makes the sum one, the word never seen included: it has the
mass that discounting freed. A history whose words are all too frequent for a discount counts one token more.

Where the work lies: texts become chunks of about ``CHUNK`` bytes, each with a list of its distinct words and the places
of its tokens in that list. Chunks send their words to buckets of hashes, which add the counts up; words get ids by
falling count, so a word's count follows from its id and the short list of counts. Then chunks send their distinct word
pairs to buckets of histories, which add up, keep the counts as the model's table, and answer each chunk with the counts
of its pairs. A bucket holds all pairs of a history; pairs of the few histories above a bucket's share are spread by both
words. Messages are arrays, compressed, so what is shuffled is a few bytes for each distinct pair of a chunk. Tables lie
in the shared folder by kind.

Words are told apart by 64-bit hashes. Defined results: null and empty texts are one end; without training texts both
scores are 0 a token; repeated rows count each time; equal ids are documents of their own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrid.llm.common import bucket_of, mixed, pieces, shared_folder, stored, text_bytes, words_of

FOLDS, HELD_OUT = 10, 0
K = 5
CHUNK = 6 << 20
#: Distinct words of chunks for each bucket of words.
WORD_BUCKET = 1_000_000
#: Tokens for each bucket of word pairs.
BUCKET = 2_000_000
END = np.uint64(0xE5D0_F7E8_71D0_0001)


def packed(values: np.ndarray) -> bytes:
    """Compressed, the bytes of equal weight side by side."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind)


def _ratios(n: np.ndarray) -> np.ndarray | None:
    """Katz's ratios of counts 1..K from how many things have count 1..K+1, if they are ratios at all."""
    if not (n > 0).all():
        return None
    r = np.arange(1, K + 1)
    common = (K + 1) * n[K] / n[0]
    if common >= 1:
        return None
    out = ((r + 1) * n[1:] / (r * n[:-1]) - common) / (1 - common)
    return out if ((out > 0) & (out <= 1)).all() else None


def good_turing(of_count: list[int], total: int) -> np.ndarray:
    """Discount ratios of counts 0..K+1 (the last stands for all above K), from how many things have count 0..K+1.

    If the counts of counts are too uneven for that, a line through their logarithms takes their place; if that fails
    too, every low count gives up the same share.
    """
    n = np.array(of_count[1:], dtype=np.float64)
    out = np.ones(K + 2)
    found = _ratios(n)
    if found is None and (n > 0).all():
        slope, height = np.polyfit(np.log(np.arange(1, K + 2)), np.log(n), 1)
        found = _ratios(np.exp(height + slope * np.log(np.arange(1, K + 2))))
    out[1 : K + 1] = found if found is not None else total / (total + n[0] + 1) if total else 1
    return out


@dataclass
class Words:
    """Counts by word id (``first``: the first id of each count), and what follows from them."""

    first: np.ndarray
    count: np.ndarray
    total: int
    types: int
    discount: np.ndarray
    whole: float
    unseen: float

    @classmethod
    def of(cls, counts: list[tuple[int, int]]) -> Words:
        """From (count, number of words), the largest count first."""
        count = np.array([c for c, _ in counts], dtype=np.int64)
        n = np.array([x for _, x in counts], dtype=np.int64)
        total = int((count * n).sum())
        discount = good_turing([0, *(int(n[count == r].sum()) for r in range(1, K + 2))], total)
        mass = float((discount[np.minimum(count, K + 1)] * count * n).sum())
        whole = float(total) if mass < total - 1e-9 else total + 1.0
        return cls(np.cumsum(n) - n, count, total, int(n.sum()), discount, whole, 1 - mass / whole)

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """Count of each id; an id of -1 was never seen."""
        if not len(self.count):
            return np.zeros(len(ids), dtype=np.int64)
        return np.where(ids < 0, 0, self.count[np.searchsorted(self.first, ids, side="right") - 1])

    def probability(self, ids: np.ndarray) -> np.ndarray:
        c = self.counts(ids)
        return np.where(c == 0, self.unseen, self.discount[np.minimum(c, K + 1)] * c / self.whole)

    def frequent(self, most: float) -> int:
        """How many words (the first ids) count more than ``most``."""
        above = np.flatnonzero(self.count > most)
        return int(self.first[above[-1] + 1]) if len(above) and above[-1] + 1 < len(self.first) else self.types * bool(len(above))


def _free_memory() -> None:
    pa.default_memory_pool().release_unused()


def _binary(values: list[bytes | None]) -> pa.Array:
    return pa.array(values, pa.binary())


def _chunker(size: int):
    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, taken = TaskContext.get().partitionId(), 0, [], 0

        def out() -> pa.RecordBatch:
            docs = pa.concat_arrays([h[0] for h in held])
            train = np.concatenate([h[1] for h in held])
            lengths = np.concatenate([h[2] for h in held])
            hashes, tokens, n = np.unique(np.concatenate([h[3] for h in held]), return_inverse=True, return_counts=True)
            in_train = np.bincount(tokens[np.repeat(train, lengths)], minlength=len(hashes))
            # Places go by falling count, which packs better than the order of hashes.
            place = np.empty(len(hashes), dtype=np.uint32)
            place[np.argsort(-n, kind="stable")] = np.arange(len(hashes), dtype=np.uint32)
            cells = [train.tobytes(), packed(lengths.astype(np.int64)), hashes.tobytes(), packed(in_train.astype(np.uint32)), packed(place), packed(place[tokens])]
            values = [
                pa.array([(part << 32) + number]),
                pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
                pa.array([len(hashes)]),
                *(_binary([c]) for c in cells),
            ]
            return pa.RecordBatch.from_arrays(values, names=["chunk", "docs", "n_types", "train", "lengths", "hashes", "n", "place", "tokens"])

        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
            for lo, hi in pieces(offsets):
                at = offsets[lo : hi + 1]
                words, first = words_of(raw[at[0] : at[-1]], at - at[0])
                tokens = np.insert(words, first[1:], END)
                held.append((batch.column("doc_id").slice(lo, hi - lo), train[lo:hi], np.diff(first) + 1, tokens))
                taken += int(at[-1] - at[0]) + hi - lo
                if taken >= size:
                    yield out()
                    number, held, taken = number + 1, [], 0
        if held:
            yield out()
        _free_memory()

    return chunk


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """One chunk at a time, as they are large."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def _parts(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Runs of equal buckets: bucket, first, last."""
    if not len(bucket):
        return
    found, first = np.unique(bucket, return_index=True)
    yield from zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(bucket)], strict=True)


def _words_sender(n: int):
    """A chunk's words by bucket; buckets are ranges of hashes, so their order is that of the hashes."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                hashes, counts = np.frombuffer(row["hashes"], dtype=np.uint64), unpacked(row["n"], np.uint32)
                bucket = ((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
                out = [(b, hashes[i:j].tobytes(), packed(counts[i:j])) for b, i, j in _parts(bucket)]
                columns = [pa.array([int(x[0]) for x in out], pa.int32()), pa.array([row["chunk"]] * len(out), pa.int64())]
                columns += [_binary([x[1] for x in out]), _binary([x[2] for x in out])]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "chunk", "hashes", "n"])

    return send


WORDS = "kind string, bucket int, chunk bigint, a binary, b binary, c array<bigint>, words array<bigint>"


def _words_counter(group: pa.Table) -> pa.Table:
    """The bucket's words and counts, how many words have which count, and where each chunk's words are among them."""
    hashes = [np.frombuffer(x, dtype=np.uint64) for x in group.column("hashes").to_pylist()]
    found, at = np.unique(np.concatenate(hashes), return_inverse=True)
    n = np.concatenate([unpacked(x, np.uint32) for x in group.column("n").to_pylist()])
    total = np.bincount(at, weights=n, minlength=len(found)).astype(np.int64)
    c, words = np.unique(total[total > 0], return_counts=True)
    cuts = np.cumsum([0, *map(len, hashes)])
    rows = [("words", None, found.tobytes(), packed(total), None, None), ("sizes", None, None, None, c.tolist(), words.tolist())]
    for chunk, i, j in zip(group.column("chunk").to_pylist(), cuts[:-1], cuts[1:], strict=True):
        rows.append(("places", chunk, None, packed(at[i:j].astype(np.uint32)), None, None))
    kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    cells = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
    bucket = pa.array([group.column("bucket")[0].as_py()] * len(rows), pa.int32())
    _free_memory()
    return pa.table([cells[0], bucket, *cells[1:]], names=["kind", "bucket", "chunk", "a", "b", "c", "words"])


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with a count, one row each."""
    for batch in batches:
        for row in _rows(batch):
            hashes, c = np.frombuffer(row["a"], dtype=np.int64), unpacked(row["b"], np.int64)
            at = np.flatnonzero(c)
            columns = [pa.array(hashes[at]), pa.array(c[at]), pa.array(np.full(len(at), row["bucket"], dtype=np.int32)), pa.array(at.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["hash", "c", "bucket", "at"])


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, done = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        columns = [*batch.columns, pa.array(np.full(n, part, dtype=np.int32)), pa.array(np.arange(done, done + n))]
        yield pa.RecordBatch.from_arrays(columns, names=["hash", "c", "bucket", "at", "part", "rank"])
        done += n


def _ids_teller(ids: pa.Table, asked: pa.Table) -> pa.Table:
    """A bucket's word ids, for each chunk that asked, in the order of its hashes."""
    places = [unpacked(x, np.uint32) for x in asked.column("b").to_pylist()]
    known = np.full(1 + max((int(p.max(initial=0)) for p in places), default=0), -1, dtype=np.int64)
    known = np.append(known, np.full(max(0, 1 + int(max(ids.column("at").to_numpy(), default=-1)) - len(known)), -1))
    known[ids.column("at").to_numpy()] = ids.column("id").to_numpy()
    columns = [asked.column("chunk"), asked.column("bucket"), _binary([packed(known[p]) for p in places])]
    return pa.table(columns, names=["chunk", "bucket", "ids"])


@dataclass
class Buckets:
    """Where a word pair is counted. Ids go by count, so histories spread evenly by remainder."""

    n: int
    spread: int

    def of(self, keys: np.ndarray) -> np.ndarray:
        left = keys >> np.uint64(32)
        return (np.where(left < np.uint64(self.spread), mixed(keys), left) % np.uint64(self.n)).astype(np.int64)


class Tokens:
    """A chunk's tokens: ids of words and histories, and its distinct known pairs in the order of their buckets."""

    def __init__(self, row: dict, buckets: Buckets):
        by_hash = [unpacked(x["ids"], np.int64) for x in sorted(row["ids"], key=lambda x: x["bucket"])]
        place = unpacked(row["place"], np.uint32)
        ids = np.empty(len(place), dtype=np.int64)
        ids[place] = np.concatenate(by_hash)
        self.lengths = unpacked(row["lengths"], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.w = ids[unpacked(row["tokens"], np.uint32)]
        self.h = np.empty_like(self.w)
        self.h[1:] = self.w[:-1]
        self.h[self.starts] = self.w[self.starts + self.lengths - 1]  # a text's last token is the end token
        self.train = np.repeat(np.frombuffer(row["train"], dtype=bool), self.lengths)
        self.known = (self.w >= 0) & (self.h >= 0)
        pairs = (self.h[self.known].astype(np.uint64) << np.uint64(32)) | self.w[self.known].astype(np.uint64)
        self.keys, self.at = np.unique(pairs, return_inverse=True)
        self.bucket = buckets.of(self.keys)
        self.order = np.argsort(self.bucket, kind="stable")
        #: Histories in texts that were not learned from: only there a pair may be new.
        wanted = np.unique(self.h[~self.train])
        wanted = wanted[wanted >= 0]
        self.wanted = wanted[np.argsort(wanted % buckets.n, kind="stable")]
        self.wanted_bucket = self.wanted % buckets.n


def _sender(buckets: Buckets):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                t = Tokens(row, buckets)
                n = np.bincount(t.at[t.train[t.known]], minlength=len(t.keys)).astype(np.uint32)
                keys = {b: t.order[i:j] for b, i, j in _parts(t.bucket[t.order])}
                wanted = {b: t.wanted[i:j] for b, i, j in _parts(t.wanted_bucket)}
                none = np.zeros(0, dtype=np.int64)
                out = [
                    (b, packed(t.keys[keys.get(b, none)]), packed(n[keys.get(b, none)]), packed(wanted.get(b, none)))
                    for b in sorted({*keys, *wanted})
                ]
                columns = [pa.array([x[0] for x in out], pa.int32()), pa.array([row["chunk"]] * len(out), pa.int64())]
                columns += [_binary([x[k] for x in out]) for k in (1, 2, 3)]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "chunk", "keys", "n", "wanted"])
            _free_memory()

    return send


COUNTED = "kind string, bucket int, chunk bigint, a binary, b binary, c binary, of_count array<bigint>"
#: Mark on an answer: none of the history's words has a count low enough for a discount.
WHOLE = np.uint32(1 << 31)


def _counter(words: Words, buckets: Buckets):
    def count(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        chunks = group.column("chunk").to_pylist()
        keys = [unpacked(x, np.uint64) for x in group.column("keys").to_pylist()]
        pairs, at = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.concatenate([unpacked(x, np.uint32) for x in group.column("n").to_pylist()])
        total = np.bincount(at, weights=n, minlength=len(pairs)).astype(np.int64)

        seen = total > 0
        left, of_left = np.unique(pairs >> np.uint64(32), return_inverse=True)
        low = np.minimum(total, K + 1)
        stats = np.zeros((K + 1, len(left)), dtype=np.int64)
        for r in range(1, K + 1):
            stats[r - 1] = np.bincount(of_left[low == r], minlength=len(left))
        stats[K] = np.bincount(of_left, weights=np.where(low > K, total, 0), minlength=len(left))
        taken = np.where(seen, words.probability((pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)), 0.0)
        taken = np.bincount(of_left, weights=taken, minlength=len(left))
        whole = (stats[:K].sum(axis=0) == 0) & (left >= np.uint64(buckets.spread))

        answer = total.astype(np.uint32) | np.where(whole[of_left], WHOLE, np.uint32(0))
        cuts = np.cumsum([0, *map(len, keys)])
        rows = [("answer", c, None, packed(answer[at[i:j]]), None, None) for c, i, j in zip(chunks, cuts[:-1], cuts[1:], strict=True)]
        rows += [("wanted", c, x, None, None, None) for c, x in zip(chunks, group.column("wanted").to_pylist(), strict=True)]
        sizes = np.bincount(np.minimum(total[seen], K + 2), minlength=K + 3).tolist()
        rows.append(("model", None, packed(pairs[seen]), packed(total[seen].astype(np.uint32)), None, sizes))
        rows.append(("history", None, packed(left), packed(stats.reshape(-1)), taken.tobytes(), None))
        kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        cells = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
        _free_memory()
        names = ["kind", "bucket", "chunk", "a", "b", "c", "of_count"]
        return pa.table([cells[0], pa.array([bucket] * len(rows), pa.int32()), *cells[1:]], names=names)

    return count


def _histories(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in _rows(batch):
            left = unpacked(row["a"], np.uint64).astype(np.int64)
            stats = unpacked(row["b"], np.int64).reshape(K + 1, -1)
            taken = np.frombuffer(row["c"], dtype=np.float64)
            columns = [pa.array(left), *(pa.array(np.ascontiguousarray(x)) for x in stats), pa.array(taken)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", *(f"s{j}" for j in range(K + 1)), "taken"])


def _weights_teller(known: pa.Table, asked: pa.Table) -> pa.Table:
    """Back-off weights of the histories that chunks asked for, in their order; 1 for one without pairs."""
    order = np.argsort(known.column("id").to_numpy())
    ids, weights = known.column("id").to_numpy()[order], known.column("log_left").to_numpy()[order]
    out = []
    for x in asked.column("a").to_pylist():
        wanted = unpacked(x, np.int64)
        at = np.minimum(np.searchsorted(ids, wanted), max(0, len(ids) - 1))
        found = np.zeros(len(wanted)) if not len(ids) else np.where(ids[at] == wanted, weights[at], 0.0)
        out.append(found.astype(np.float64).tobytes())
    return pa.table([asked.column("chunk"), asked.column("bucket"), _binary(out)], names=["chunk", "bucket", "weights"])


def _scorer(words: Words, discount: np.ndarray, buckets: Buckets, spread_whole: np.ndarray):
    """``spread_whole``: ids of spread histories without any low count."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("docs")
            for k, row in enumerate(_rows(batch.drop_columns(["docs"]))):
                t = Tokens(row, buckets)
                seen = np.zeros(len(t.keys), dtype=np.uint32)
                answers = [unpacked(x["b"], np.uint32) for x in sorted(row["answers"] or [], key=lambda x: x["bucket"])]
                if answers:
                    seen[t.order] = np.concatenate(answers)
                together, whole = np.zeros(len(t.w), dtype=np.int64), np.isin(t.h, spread_whole)
                together[t.known] = (seen & ~WHOLE)[t.at]
                whole[t.known] |= (seen & WHOLE)[t.at] > 0

                weights = [np.frombuffer(x["weights"], dtype=np.float64) for x in sorted(row["weights"] or [], key=lambda x: x["bucket"])]
                weights = np.concatenate(weights) if weights else np.zeros(0)
                order = np.argsort(t.wanted)
                left = np.zeros(len(t.w))
                new = (together == 0) & (t.h >= 0)
                left[new] = weights[order][np.searchsorted(t.wanted[order], t.h[new])]

                one = np.log10(words.probability(t.w))
                with np.errstate(divide="ignore", invalid="ignore"):
                    two = np.log10(discount[np.minimum(together, K + 1)] * together) - np.log10(words.counts(t.h) + whole)
                token = np.where(together > 0, two, left + one)
                c = words.counts(t.w)
                base = np.log10((c + 0.1) / (words.total + 0.1 * (words.types + 1)))
                sums = [np.add.reduceat(x, t.starts) for x in ((c > 0).astype(np.int64), base, token)]
                values = [lists[k].values, pa.array(t.lengths), *map(pa.array, sums)]
                yield pa.RecordBatch.from_arrays(values, names=["doc_id", "n_tokens", "n_known", "base_score", "score"])
            _free_memory()

    return score


@dataclass
class Model:
    """``vocabulary``: hash, id, c; ``counted``: the tables of pairs by kind; ``histories``: id, log_left, whole."""

    chunks: DataFrame
    ids: DataFrame
    vocabulary: DataFrame
    words: Words
    buckets: Buckets
    discount: np.ndarray
    counted: DataFrame
    histories: DataFrame


def _by_kind(df: DataFrame, schema: str, name: str) -> DataFrame:
    folder = shared_folder(df.sparkSession, name)
    df.write.partitionBy("kind").parquet(folder)
    return df.sparkSession.read.schema(schema).parquet(folder)


def _per_chunk(messages: DataFrame, name: str) -> DataFrame:
    return messages.groupBy("chunk").agg(F.collect_list(F.struct("bucket", name)).alias(name))


def fit(
    documents: DataFrame, train: Column, chunk: int = CHUNK, bucket: int = BUCKET, word_bucket: int = WORD_BUCKET
) -> Model:
    """Learn from the rows for which ``train`` is true; chunks hold all rows."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"chunk bigint, docs array<{kind}>, n_types bigint, train binary, lengths binary, hashes binary, n binary, place binary, tokens binary"
    chunks = stored(documents.select("doc_id", "text", train.alias("train")).mapInArrow(_chunker(chunk), schema), "chunks")

    types = chunks.agg(F.coalesce(F.sum("n_types"), F.lit(0)).alias("n")).first()["n"]
    asked = chunks.select("chunk", "hashes", "n").mapInArrow(
        _words_sender(max(4, -(-types // word_bucket))), "bucket int, chunk bigint, hashes binary, n binary"
    )
    of_words = _by_kind(asked.groupBy("bucket").applyInArrow(_words_counter, WORDS), WORDS, "words")
    # At most sqrt(2 N) different counts sum up to N.
    sizes = of_words.where("kind = 'sizes'").select(F.explode(F.arrays_zip("c", "words")).alias("z"))
    by_count = sizes.groupBy("z.c").agg(F.sum("z.words").alias("n")).collect()
    words = Words.of(sorted(((r.c, r.n) for r in by_count), reverse=True))

    listed = of_words.where("kind = 'words'").select("bucket", "a", "b").mapInArrow(_listed, "hash bigint, c bigint, bucket int, at int")
    ordered = listed.repartitionByRange(F.desc("c"), "hash").sortWithinPartitions(F.desc("c"), "hash")
    numbered = stored(ordered.mapInArrow(_numbered, "hash bigint, c bigint, bucket int, at int, part int, rank bigint"), "ranks")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = numbered.groupBy("part").agg(F.count("*").alias("n"))  # a row for each task
    offsets = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    vocabulary = numbered.join(F.broadcast(offsets), "part").withColumn("id", F.col("offset") + F.col("rank"))

    places = of_words.where("kind = 'places'").select("bucket", "chunk", "b")
    told = vocabulary.select("bucket", "at", "id").groupBy("bucket").cogroup(places.groupBy("bucket"))
    told = told.applyInArrow(_ids_teller, "chunk bigint, bucket int, ids binary")
    ids = stored(_per_chunk(told, "ids"), "chunk-ids")

    n = max(4, -(-words.total // bucket))
    buckets = Buckets(n, words.frequent(words.total / n / 2))
    sent = chunks.select("chunk", "train", "lengths", "place", "tokens").join(ids, "chunk")
    sent = sent.mapInArrow(_sender(buckets), "bucket int, chunk bigint, keys binary, n binary, wanted binary")
    counted = _by_kind(sent.groupBy("bucket").applyInArrow(_counter(words, buckets), COUNTED), COUNTED, "word-pairs")

    of_count = counted.where("kind = 'model'").select(F.posexplode("of_count").alias("r", "n")).groupBy("r").agg(F.sum("n").alias("n"))
    of_count = {r.r: r.n for r in of_count.collect()}
    discount = good_turing([0, *(of_count.get(r, 0) for r in range(1, K + 2))], words.total)

    stats = [f"s{j}" for j in range(K + 1)]
    rows = counted.where("kind = 'history'").select("a", "b", "c")
    rows = rows.mapInArrow(_histories, "id bigint, " + ", ".join(f"{s} bigint" for s in stats) + ", taken double")
    summed = rows.groupBy("id").agg(*(F.sum(s).alias(s) for s in (*stats, "taken")))
    low = [(F.col(f"s{r - 1}") * r, float(discount[r])) for r in range(1, K + 1)]
    count = sum((x for x, _ in low), F.col(f"s{K}"))
    mass = sum((x * d for x, d in low), F.col(f"s{K}").cast("double"))
    whole = sum((x for x, _ in low), F.lit(0)) == 0
    left = 1 - mass / F.when(whole, count + 1).otherwise(count)
    histories = summed.where(count > 0).select("id", F.log10(left / (1 - F.col("taken"))).alias("log_left"), whole.alias("whole"))
    return Model(chunks, ids, vocabulary.select("hash", "id", "c"), words, buckets, discount, counted, histories)


def scores(model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of each document of the model's chunks."""
    buckets = model.buckets
    # The few histories that are spread over buckets: at most two for each bucket.
    spread = model.histories.where((F.col("id") < buckets.spread) & F.col("whole")).select("id").collect()
    spread_whole = np.array([r.id for r in spread], dtype=np.int64)
    known = model.histories.select((F.col("id") % buckets.n).cast("int").alias("bucket"), "id", "log_left")
    wanted = model.counted.where("kind = 'wanted'").select("bucket", "chunk", "a")
    weights = known.groupBy("bucket").cogroup(wanted.groupBy("bucket"))
    weights = weights.applyInArrow(_weights_teller, "chunk bigint, bucket int, weights binary")
    answers = _per_chunk(model.counted.where("kind = 'answer'"), "b").withColumnRenamed("b", "answers")
    rows = model.chunks.select("chunk", "docs", "train", "lengths", "place", "tokens").join(model.ids, "chunk")
    rows = rows.join(_per_chunk(weights, "weights"), "chunk", "left").join(answers, "chunk", "left")
    kind = model.chunks.schema["docs"].dataType.elementType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double"
    return rows.mapInArrow(_scorer(model.words, model.discount, buckets, spread_whole), schema)


def scored(documents: DataFrame) -> DataFrame:
    """The registered query's columns."""
    held_out = bucket_of(F.col("doc_id"), FOLDS) == HELD_OUT
    model = fit(documents, ~held_out)
    found = scores(model)
    return found.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.words.total).cast("long").alias("train_tokens"), "base_score", "score"
    )
