"""Alignment of two tokenizers' ids of the same text, by lockstep merging in numpy.

A is a byte-level BPE of the tokenizers library, B a sentencepiece model with byte fallback that puts a space before the
text; A gets that space too, so both cover the bytes of space + text. A document whose tokens do not join to these
bytes, in A or in B, has no tokens, as a null or empty one.

All documents of a batch advance together: the state is one pair of pointers for each lane, to its next token of A and
of B. A step emits a link between the two tokens, which overlap, and moves the pointer whose token ends first; if both
end together it emits a cut and moves both. Finished lanes leave the state. A document is one lane; a long one enters as
several, begun behind offsets where both end (found by binary search), so a batch takes about as many steps as the
longest lane has links.

Ids are remembered for each stretch of a text between lone spaces and line breaks: no match of A's pattern and no piece
of B holds one of them but as its first character (checked for B's pieces; without that, nothing is cut). Stretches that
do not join to their bytes, and texts with other white space at their ends, go to the libraries whole.

Link counts. Each task emits chunks of documents with their distinct id pairs, counted; chunks are written once. Pairs are
summed over all chunks by Spark, joined with the largest count of their B id, and sent back to the chunks that hold
them. A pair that is everywhere is one row for each chunk, and summed before the shuffle.

Defined results: null and empty texts have zeros and no groups; repeated rows are documents of their own; an empty table
gives no rows; other columns are ignored. A chunk holds ``CHUNK`` characters, or one document that is longer.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daygrid.llm.common import kept, stored, stretches_and_lines

CHUNK = 1 << 21
#: Tokens of A in a lane, about, and how far behind that a common end is looked for.
LANE, LOOK = 256, 64
#: Stretches that a worker remembers, ids that they may have, and stretches that are learned together.
MOST, MOST_IDS, NEW = 400_000, 4_000_000, 1000


def _lengths(entries: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, entries), dtype=np.int64, count=len(entries))


def byte_alphabet() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class SideA:
    """Byte-level BPE: ids, and each id's bytes."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_alphabet()
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.bytes = [b""] * self.tokenizer.get_vocab_size()
        for entry, i in self.tokenizer.get_vocab().items():
            self.bytes[i] = entry.encode() if entry in added else bytes(letters[c] for c in entry)
        self.lengths = _lengths(self.bytes)

    def encode(self, parts: list[str]) -> list[list[int]]:
        """Ids of each part, which begins with its space or line break."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]


class SideB:
    """sentencepiece: ids, and each id's bytes."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.lengths = _lengths(self.bytes)
        self.space = self.model.piece_to_id("▁")
        # A piece with a space behind its first letter, or a line break in it, would cross a cut.
        self.cuts = not any(" " in p.lstrip("▁").replace("▁", " ") or "\n" in p for p in pieces)

    def encode(self, parts: list[str]) -> list[list[int]]:
        """As ``SideA``: the model adds the space; the one before a line break is taken off again."""
        out = self.model.encode([p[1:] if p[0] == " " else p for p in parts], num_threads=1)
        return [ids[1:] if p[0] != " " and ids[:1] == [self.space] else ids for p, ids in zip(parts, out, strict=True)]


class _Lists:
    """Lists of ids by number, their values in one array."""

    def __init__(self):
        self.values = np.zeros(1 << 16, dtype=np.uint32)
        self.ends = np.zeros(1 << 14, dtype=np.int64)
        self.n = 0

    def add(self, values: np.ndarray, counts: np.ndarray) -> None:
        used = int(self.ends[self.n - 1]) if self.n else 0
        if used + len(values) > len(self.values):
            self.values = np.concatenate([self.values, np.zeros(used + len(values), dtype=np.uint32)])
        if self.n + len(counts) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros(self.n + len(counts), dtype=np.int64)])
        self.values[used : used + len(values)] = values
        self.ends[self.n : self.n + len(counts)] = used + np.cumsum(counts)
        self.n += len(counts)

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists' values in a row, and how many each has."""
        last = self.ends[numbers]
        first = np.where(numbers > 0, self.ends[numbers - 1], 0)
        counts = last - first
        upto = np.cumsum(counts)
        place = np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(first - (upto - counts), counts)
        return self.values[place], counts


class Encoder:
    """Ids of whole texts in A and B, or none where they do not join to space + text."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = SideA(path_a), SideB(path_b)
        #: Decimal ids with the separator behind them: of A "," or at a cut "|", then of B "," or ";".
        sides = ((len(self.a.bytes), b"|"), (len(self.b.bytes), b";"))
        self.written = [b"%d%s" % (i, end) for n, at_cut in sides for i in range(n) for end in (b",", at_cut)]
        self._forget()

    def _forget(self) -> None:
        #: Numbers of the stretches that are remembered; number 0 is no ids at all.
        self.number: dict[str, int] = {}
        self.lists = (_Lists(), _Lists())
        for held in self.lists:
            held.add(np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64))
        #: Stretches whose ids do not join to their bytes.
        self.inexact: set[str] = set()

    def stretches(self, text: str) -> list[str] | None:
        """Parts without the space before them, a line break kept; None if the text is to stay whole."""
        return stretches_and_lines(text) if self.b.cuts else None

    def _add(self, parts: list[str]) -> np.ndarray:
        """Number the ids of parts, each with its space or line break; which of them join to their bytes (the others have none)."""
        raw = [p.encode() for p in parts]
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        right = np.ones(len(parts), dtype=bool)
        found = []
        for side in (self.a, self.b):
            ids = side.encode(parts)
            counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            flat = np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(counts.sum()))
            right &= self._joins(side, flat, np.repeat(np.arange(len(parts)), counts), raw, sizes)
            found.append((flat, counts))
        for held, (flat, counts) in zip(self.lists, found, strict=True):
            held.add(flat[np.repeat(right, counts)], np.where(right, counts, 0))
        return right

    @staticmethod
    def _joins(side: SideA | SideB, flat: np.ndarray, owner: np.ndarray, raw: list[bytes], sizes: np.ndarray) -> np.ndarray:
        joined = np.bincount(owner, weights=side.lengths[flat], minlength=len(raw))
        if (joined == sizes).all() and b"".join([side.bytes[i] for i in flat.tolist()]) == b"".join(raw):
            return np.ones(len(raw), dtype=bool)
        cuts = np.searchsorted(owner, np.arange(len(raw) + 1)).tolist()
        ids = flat.tolist()
        parts = (b"".join([side.bytes[i] for i in ids[x:y]]) for x, y in zip(cuts[:-1], cuts[1:], strict=True))
        return np.fromiter((p == r for p, r in zip(parts, raw, strict=True)), dtype=bool, count=len(raw))

    def _add_joined(self, parts: list[str]) -> bool:
        """As ``_add``, with one call to each library for all parts together; False, and nothing added, if some do not join.

        Parts begin where nothing crosses, so the ids of the joined text are those of the parts in a row.
        """
        whole = "".join(parts)
        raw = whole.encode()
        ends = np.cumsum(np.fromiter((len(p) if whole.isascii() else len(p.encode()) for p in parts), dtype=np.int64, count=len(parts)))
        found = []
        for side in (self.a, self.b):
            flat = np.array(side.encode([whole])[0], dtype=np.uint32)
            upto = np.cumsum(side.lengths[flat])
            at = np.searchsorted(upto, ends)
            if not len(flat) or upto[-1] != len(raw) or (upto[at] != ends).any() or b"".join([side.bytes[i] for i in flat.tolist()]) != raw:
                return False
            found.append((flat, np.diff(np.append(-1, at))))
        for held, (flat, counts) in zip(self.lists, found, strict=True):
            held.add(flat, counts)
        return True

    def _learn(self, new: list[str]) -> None:
        # Parts with a space come first, so that a joined text begins with one.
        new.sort(key=lambda p: p[:1] == "\n")
        for a in range(0, len(new), NEW):
            some = new[a : a + NEW]
            parts = [p if p[:1] == "\n" else " " + p for p in some]
            first = self.lists[0].n
            right = None if self._add_joined(parts) else self._add(parts)
            if right is None:
                self.number.update(zip(some, range(first, first + len(some)), strict=True))
            else:
                self.number.update((p, first + k) for k, p in enumerate(some) if right[k])
                self.inexact.update(p for k, p in enumerate(some) if not right[k])

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """All ids in a row, and how many each text has: both for A and B."""
        if len(self.number) + len(self.inexact) > MOST or self.lists[0].ends[self.lists[0].n - 1] > MOST_IDS:
            self._forget()
        split = [self.stretches(t) for t in texts]
        self._learn(list(set().union(*(s for s in split if s)) - self.number.keys() - self.inexact))
        number, numbers, sizes = self.number.__getitem__, [], []
        for text, parts in zip(texts, split, strict=True):
            if parts and (not self.inexact or self.inexact.isdisjoint(parts)):
                numbers += map(number, parts)
                sizes.append(len(parts))
                continue
            numbers.append(self.lists[0].n if text else 0)
            sizes.append(1)
            if text:
                self._add([" " + text])
        numbers = np.array(numbers, dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        found = [held.take(numbers) for held in self.lists]
        return [flat for flat, _ in found], [np.add.reduceat(counts, starts) if len(starts) else counts for _, counts in found]


def lanes(end_a: np.ndarray, end_b: np.ndarray, starts_a: np.ndarray, starts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First tokens of all lanes in A and B, ascending: those of the documents, and more within long ones."""
    sizes = np.diff(np.append(starts_a, len(end_a)))
    wide = np.repeat(starts_a, sizes // LANE)
    nth = np.arange(len(wide)) - np.repeat(np.cumsum(sizes // LANE) - sizes // LANE, sizes // LANE) + 1
    near = (wide + nth * LANE)[:, None] + np.arange(LOOK)
    inside = near < len(end_a)
    ends = end_a[np.minimum(near, len(end_a) - 1)]
    other = np.searchsorted(end_b, ends)
    common = inside & (end_b[np.minimum(other, len(end_b) - 1)] == ends)
    row = np.flatnonzero(common.any(axis=1))
    column = common[row].argmax(axis=1)
    a = np.concatenate([starts_a, near[row, column] + 1])
    b = np.concatenate([starts_b, other[row, column] + 1])
    a, first = np.unique(a, return_index=True)
    inside = a < len(end_a)
    return a[inside], b[first][inside]


def merged(
    end_a: np.ndarray, end_b: np.ndarray, starts_a: np.ndarray, starts_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (tokens of A and of B, in the order of the steps), and which tokens of A and of B end at a cut.

    ``end_a`` and ``end_b`` are the byte offsets at which the tokens of all documents end, documents in a row.
    """
    cut_a, cut_b = np.zeros(len(end_a), dtype=bool), np.zeros(len(end_b), dtype=bool)
    if not len(end_a):
        none = np.zeros(0, dtype=np.int64)
        return none, none, cut_a, cut_b
    i, j = lanes(end_a, end_b, starts_a, starts_b)
    last = np.append(i[1:], len(end_a))
    links_a, links_b = [], []
    while len(i):
        links_a.append(i)
        links_b.append(j)
        a, b = end_a[i], end_b[j]
        move_a, move_b = a <= b, b <= a
        both = move_a & move_b
        cut_a[i[both]] = True
        cut_b[j[both]] = True
        i, j = i + move_a, j + move_b
        going = i < last
        if not going.all():
            i, j, last = i[going], j[going], last[going]
    return np.concatenate(links_a), np.concatenate(links_b), cut_a, cut_b


class Alignment:
    """Documents of a batch, aligned: ids, where each document begins, links, and cuts."""

    def __init__(self, encoder: Encoder, texts: list[str]):
        self.encoder = encoder
        (self.a, self.b), (self.n_a, self.n_b) = encoder.encode(texts)
        self.first_a, self.first_b = (np.cumsum(n) - n for n in (self.n_a, self.n_b))
        some = self.n_a > 0
        self.end_a, self.end_b = np.cumsum(encoder.a.lengths[self.a]), np.cumsum(encoder.b.lengths[self.b])
        self.link_a, self.link_b, self.cut_a, self.cut_b = merged(
            self.end_a, self.end_b, self.first_a[some], self.first_b[some]
        )
        self.owner = np.repeat(np.arange(len(texts)), self.n_a)
        self.n_groups = np.bincount(self.owner[self.cut_a], minlength=len(texts))
        self.n_links = np.bincount(self.owner[self.link_a], minlength=len(texts))

    def groups(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each document; empty without tokens."""
        written = self.encoder.written
        upto_a, upto_b = np.flatnonzero(self.cut_a) + 1, np.flatnonzero(self.cut_b) + 1
        in_a, in_b = (np.diff(np.append(0, u)) for u in (upto_a, upto_b))
        place_a = np.arange(len(self.a)) + np.repeat(upto_b - in_b, in_a)
        place_b = np.arange(len(self.b)) + np.repeat(upto_a, in_b)
        code = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        code[place_a] = 2 * self.a.astype(np.int64) + self.cut_a
        code[place_b] = 2 * (len(self.encoder.a.bytes) + self.b.astype(np.int64)) + self.cut_b
        parts = list(map(written.__getitem__, code.tolist()))
        bounds = np.cumsum(np.append(0, self.n_a + self.n_b)).tolist()
        return [b"".join(parts[x:y])[:-1] for x, y in zip(bounds[:-1], bounds[1:], strict=True)]


def _encoder(path_a: str, path_b: str) -> Encoder:
    return kept("align:" + json.dumps([path_a, path_b]), lambda: Encoder(path_a, path_b))


def _texts(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts (null: empty) of about ``chunk`` characters at a time."""
    ids, texts, size = [], [], 0
    for batch in batches:
        column = pc.fill_null(batch.column("text"), "")
        upto = np.cumsum(pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            before = int(upto[first - 1]) if first else 0
            last = min(batch.num_rows, int(np.searchsorted(upto, before + chunk - size, side="left")) + 1)
            ids.append(batch.column("doc_id").slice(first, last - first))
            texts += column.slice(first, last - first).to_pylist()
            size += int(upto[last - 1]) - before
            first = last
            if size >= chunk:
                yield pa.concat_arrays(ids), texts
                ids, texts, size = [], [], 0
    if texts:
        yield pa.concat_arrays(ids), texts


def _split(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """One list for each document."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(values, kind))


def aligned(documents: DataFrame, path_a: str, path_b: str, chunk: int = CHUNK) -> DataFrame:
    """doc_id, a_ids, b_ids, links (positions of the two tokens) and cuts (tokens of A and of B up to each cut)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path_a, path_b)
        for ids, texts in _texts(batches, chunk):
            x = Alignment(encoder, texts)
            order = np.lexsort((x.link_b, x.link_a))
            link_a, link_b = x.link_a[order], x.link_b[order]
            cut_a, cut_b = np.flatnonzero(x.cut_a), np.flatnonzero(x.cut_b)
            owner = x.owner[link_a]
            links = [link_a - x.first_a[owner], link_b - x.first_b[owner]]
            owner = x.owner[cut_a]
            cuts = [cut_a + 1 - x.first_a[owner], cut_b + 1 - x.first_b[owner]]
            columns = [ids, _split(x.a, x.n_a, pa.int32()), _split(x.b, x.n_b, pa.int32())]
            columns += [_split(v, n, pa.int32()) for v, n in zip([*links, *cuts], [x.n_links] * 2 + [x.n_groups] * 2, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "a_ids", "b_ids", "link_a", "link_b", "cut_a", "cut_b"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    arrays = ", ".join(f"{c} array<int>" for c in ("a_ids", "b_ids", "link_a", "link_b", "cut_a", "cut_b"))
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {arrays}")


TALLIED = (
    "chunk bigint, doc_ids array<{kind}>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
    "groups array<string>, a array<int>, b array<int>, n array<bigint>, runs binary, docs binary, times binary"
)


def tallied(documents: DataFrame, path_a: str, path_b: str, chunk: int = CHUNK) -> DataFrame:
    """One row for each chunk: its documents' figures, its distinct id pairs (a, b) with n links, ascending.

    ``runs`` says how many documents hold each pair, ``docs`` which, and ``times`` how often (uint32 each).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path_a, path_b)
        width = np.uint64(len(encoder.a.bytes))
        part, number = TaskContext.get().partitionId(), 0
        for ids, texts in _texts(batches, chunk):
            x = Alignment(encoder, texts)
            bits = np.uint64(max(1, len(texts)).bit_length())
            pair = x.b[x.link_b].astype(np.uint64) * width + x.a[x.link_a]
            entry, times = np.unique(pair << bits | x.owner[x.link_a].astype(np.uint64), return_counts=True)
            pair, docs = entry >> bits, entry & ((np.uint64(1) << bits) - np.uint64(1))
            first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, dtype=np.int64)
            n = np.add.reduceat(times, first) if len(first) else times
            runs = np.diff(np.append(first, len(pair)))
            groups = [hashlib.sha256(g).hexdigest() if g else "" for g in x.groups()]
            row = {
                "chunk": [part << 32 | number],
                "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                **{c: [getattr(x, c)] for c in ("n_a", "n_b", "n_groups", "n_links")},
                "groups": [groups],
                "a": [(pair[first] % width).astype(np.int32)],
                "b": [(pair[first] // width).astype(np.int32)],
                "n": [n],
                **{c: [v.astype("<u4").tobytes()] for c, v in (("runs", runs), ("docs", docs), ("times", times))},
            }
            kinds = {"chunk": pa.int64(), "groups": pa.list_(pa.string()), "a": pa.list_(pa.int32()), "b": pa.list_(pa.int32())}
            kinds |= {c: pa.list_(pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n")}
            columns = [v if isinstance(v, pa.Array) else pa.array(v, kinds.get(c, pa.binary())) for c, v in row.items()]
            yield pa.RecordBatch.from_arrays(columns, names=list(row))
            number += 1

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, TALLIED.format(kind=kind))


def _weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            runs, docs, times = (np.frombuffer(row.column(c)[0].as_buffer(), dtype="<u4") for c in ("runs", "docs", "times"))
            ids = row.column("doc_ids").flatten()
            found = row.column("found")[0].values
            size = len(ids)
            if len(runs):
                total, best = (np.repeat(found.field(c).to_numpy(zero_copy_only=False), runs) for c in ("total", "best"))
            else:
                total, best = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
            times = times.astype(np.int64)
            # Sums of doubles are exact up to 2**53; beyond that integers are added one by one.
            weigh = np.bincount if not len(total) or float(total.max()) * float(times.sum()) < 2**53 else _exact_sums
            columns = [ids, *(row.column(c).flatten() for c in ("n_a", "n_b", "n_groups", "n_links"))]
            columns.append(pa.array(np.bincount(docs, weights=times * best, minlength=size).astype(np.int64)))
            columns.append(pa.array(weigh(docs, weights=times * total, minlength=size).astype(np.int64)))
            columns.append(row.column("groups").flatten())
            yield pa.RecordBatch.from_arrays(columns, names=NAMES)


def _exact_sums(docs: np.ndarray, weights: np.ndarray, minlength: int) -> np.ndarray:
    out = np.zeros(minlength, dtype=np.int64)
    np.add.at(out, docs, weights)
    return out


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def pair_counts(chunks: DataFrame) -> DataFrame:
    """a, b, total (links of the pair in all documents) and best (no pair of b has more)."""
    pairs = chunks.select(F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select("p.*")
    totals = pairs.groupBy("b", "a").agg(F.sum("n").alias("total"))
    most = totals.groupBy("b").agg(F.max("total").alias("most"))
    return totals.join(most, "b").select("a", "b", "total", (F.col("total") == F.col("most")).alias("best"))


def digest(documents: DataFrame, path_a: str, path_b: str, chunk: int = CHUNK) -> DataFrame:
    """The registered query's columns."""
    chunks = stored(tallied(documents, path_a, path_b, chunk), "aligned")
    counts = stored(pair_counts(chunks), "id-pairs")
    asked = chunks.select("chunk", F.posexplode(F.arrays_zip("a", "b")).alias("at", "p")).select("chunk", "at", "p.*")
    answers = asked.join(counts, ["a", "b"]).groupBy("chunk")
    answers = answers.agg(F.array_sort(F.collect_list(F.struct("at", "total", "best"))).alias("found"))
    figures = chunks.drop("a", "b", "n").join(answers, "chunk", "left")
    nothing = F.array().cast("array<struct<at:int,total:bigint,best:boolean>>")
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in NAMES[1:-1]) + ", groups_sha256 string"
    return figures.withColumn("found", F.coalesce("found", nothing)).mapInArrow(_weighed, schema)
