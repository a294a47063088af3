"""Token ids of all documents in one order, written in shards that Re-Pair has compressed.

Documents go by ascending doc_id (ties by text, nulls first) into shards of about ``SHARD`` ids. In a shard, Re-Pair
replaces pairs of neighbours by new symbols, round after round: each round takes the pairs that occur at least
``1 / FREQUENT`` of the shard's symbols, and replaces them from left to right; the share falls when no pair is that
frequent. Only pairs with a symbol of the last round can have become frequent, so the next round counts those alone; all
are counted anew when the share falls, and at the end. Pairs never span two documents. It ends when no pair saves more
bytes than its rule takes. If 16-bit symbols
run out first, 32-bit ones are tried too, and the shorter result is kept. A shard's bytes are

    magic, counts of rules, symbols and documents, the first new symbol    (4 bytes, 4 x uint64)
    rules: two symbols each                                                (uint32)
    expansion lengths of the rules                                         (uint32)
    first symbol of each document, and the end                             (uint64)
    symbols                                                                (uint16 if all fit, else uint32)

so any id of any document is found from the lengths alone, without expanding what stands before it. Shards are rows of a
Parquet table in the shared folder: part, number in the part, ids before it in the part, doc_ids and the bytes.

Defined results: null and empty texts have the end id alone; repeated rows are documents of their own; an empty table
gives no shards; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daygrid.llm.common import kept, mixed, pieces, powers, shared_folder, text_bytes

END = 2
SHARD = 1 << 20
FREQUENT = 1000
#: Bytes of a rule and its expansion length.
RULE = 12
MAGIC = b"RPID"
#: Stretches that a worker remembers, their bytes, the bytes of the longest, and the sets of two they are looked up in.
MOST_PIECES, MOST_BYTES, LONGEST_PIECE, SET_BITS = 1_500_000, 24 << 20, 48, 21
SETS = 1 << SET_BITS
#: New stretches in a text for the library.
JOINED = 256
ROWS = 512
_HEAD = "<4s4Q"

_WHITE, _MARK, _LETTER = (np.zeros(256, dtype=bool) for _ in range(3))
_WHITE[[*range(9, 14), *range(28, 33)]] = True
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: White space beyond ASCII by its first byte in UTF-8: the bytes behind it.
_WIDE_WHITE: dict[int, list[bytes]] = {}
for _c in map(chr, range(128, 0x10000)):
    if _c.isspace():
        _WIDE_WHITE.setdefault(_c.encode()[0], []).append(_c.encode()[1:])


def _white(raw: np.ndarray) -> np.ndarray:
    """Which bytes belong to white space, in ASCII and beyond."""
    white = _WHITE[raw]
    for lead, after in _WIDE_WHITE.items():
        at = np.flatnonzero(raw == lead)
        for rest in after:
            found = at[at + len(rest) < len(raw)]
            for k, byte in enumerate(rest, 1):
                found = found[raw[found + k] == byte]
            for k in range(len(rest) + 1):
                white[found + k] = True
    return white


def stretch_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where stretches begin: at texts, lone spaces and line breaks, and ASCII marks behind ASCII letters.

    A space or line break is lone if the bytes beside it are of the same text and no white space.
    """
    white = _white(raw)
    begins = (raw == 32) | (raw == 10)
    begins[1:] &= ~white[:-1]
    begins[:-1] &= ~white[1:]
    begins[1:] |= _MARK[raw[1:]] & _LETTER[raw[:-1]]
    filled = offsets[1:] > offsets[:-1]
    last = offsets[1:][filled] - 1
    begins[last[_MARK[raw[last]] == 0]] = False
    begins[offsets[:-1][filled]] = True
    return np.flatnonzero(begins)


def _runs(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions of runs of ``size`` from ``at`` on, one run after the other."""
    return np.repeat(at - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


class _Pool:
    """Runs of numbers, one after the other; each has a number."""

    def __init__(self, kind: type):
        self.data, self.at, self.n = np.zeros(1 << 16, dtype=kind), np.zeros(1 << 12, dtype=np.int64), 0

    def add(self, data: np.ndarray, sizes: np.ndarray) -> None:
        n, end = self.n, int(self.at[self.n])
        if end + len(data) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(max(len(data), len(self.data) // 2), dtype=self.data.dtype)])
        if n + len(sizes) >= len(self.at):
            self.at = np.concatenate([self.at, np.zeros(max(len(sizes), len(self.at) // 2), dtype=np.int64)])
        self.data[end : end + len(data)] = data
        self.at[n + 1 : n + 1 + len(sizes)] = end + np.cumsum(sizes)
        self.n = n + len(sizes)

    def sizes(self, numbers: np.ndarray) -> np.ndarray:
        return self.at[numbers + 1] - self.at[numbers]


class Encoder:
    """The tokenizer library's ids, remembered for each stretch of text (``stretch_starts``).

    The pattern, which is the tokenizer's own, must part a text wherever a stretch begins, whatever stands around it:
    its matches hold a space or a line break only as their first character or within white space, and no mark behind a
    letter. New stretches go to the library joined. Stretches are looked up by hash in sets of two places, and their
    bytes compared, so a clash costs time only. Texts that hold a special token's text are one stretch.
    """

    def __init__(self, path: str, pattern: str):
        if regex.findall(pattern, "it's a, b\nc") != ["it", "'s", " a", ",", " b", "\n", "c"]:
            raise ValueError("the pattern does not part texts where stretches begin")
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content.encode() for t in added.values()]
        vocabulary = self.tokenizer.get_vocab()
        #: Bytes of each id; the library writes a byte as one letter.
        self.bytes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, k in vocabulary.items():
            self.bytes[k] = len(token)
        self.power = self.inverse = np.ones(1, dtype=np.uint64)
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros((SETS, 2), dtype=np.uint64)
        self.numbers = np.zeros((SETS, 2), dtype=np.int32)
        self.words, self.ids = _Pool(np.uint8), _Pool(np.uint32)
        # Number 0 is the end of a document.
        self.words.add(np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64))
        self.ids.add(np.array([END], dtype=np.uint32), np.ones(1, dtype=np.int64))

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.power):
            self.power = powers(n)
            self.inverse = np.full(n, pow(int(self.power[1]), -1, 1 << 64) if n > 1 else 1, dtype=np.uint64)
            self.inverse[0] = 1
            self.inverse = np.cumprod(self.inverse, dtype=np.uint64)
        return self.power, self.inverse

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, dtype=np.uint32) for f in found]

    def _joined(self, parts: list[bytes]) -> Iterator[np.ndarray]:
        """Ids of each of some stretches that may stand behind one another."""
        groups = [parts[a : a + JOINED] for a in range(0, len(parts), JOINED)]
        whole = [b"".join(group) for group in groups]
        for group, data, ids in zip(groups, whole, self._encode([data.decode() for data in whole]), strict=True):
            upto = np.cumsum(self.bytes[ids])
            ends = np.cumsum([len(part) for part in group])
            cut = np.searchsorted(upto, ends, side="right")
            if len(ids) and np.array_equal(upto[cut - 1], ends) and not any(s in data for s in self.special):
                yield from np.split(ids, cut[:-1])
            else:
                yield from self._encode([part.decode() for part in group])

    def _learn(self, raw: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """New numbers of stretches."""
        data = raw.tobytes()
        parts = [data[a:b] for a, b in zip(at.tolist(), (at + size).tolist(), strict=True)]
        ends = at + size - 1
        white = _white(raw)
        plain = ((raw[at] == 32) | (raw[at] == 10)) & (size > 1) & ~white[np.minimum(at + 1, ends)] & ~white[ends]
        ids = dict(zip(np.flatnonzero(plain).tolist(), self._joined([p for p, k in zip(parts, plain.tolist(), strict=True) if k]), strict=True))
        odd = np.flatnonzero(~plain).tolist()
        ids.update(zip(odd, self._encode([parts[k].decode() for k in odd]), strict=True))
        found = [ids[k] for k in range(len(parts))]
        first = self.words.n
        self.words.add(raw[_runs(at, size)], size)
        self.ids.add(np.concatenate(found), np.array([len(f) for f in found], dtype=np.int64))
        return np.arange(first, self.words.n)

    def _same(self, raw: np.ndarray, at: np.ndarray, size: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Which stretches have the bytes of the remembered ones."""
        same = self.words.sizes(numbers) == size
        known = np.flatnonzero(same)
        if len(known):
            n = size[known]
            equal = raw[_runs(at[known], n)] == self.words.data[_runs(self.words.at[numbers[known]], n)]
            same[known] = np.logical_and.reduceat(equal, np.cumsum(n) - n)
        return same

    def _numbers(self, raw: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, int]:
        """Numbers of stretches, and how many numbers are to be remembered."""
        power, inverse = self._powers(len(raw))
        upto = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[: len(raw)])])
        keys = mixed((upto[at + size] - upto[at]) * inverse[at])
        sets = (keys >> np.uint64(64 - SET_BITS)).astype(np.int64)
        own, places = self.keys[sets], self.numbers[sets]
        numbers = np.where(own[:, 0] == keys, places[:, 0], np.where(own[:, 1] == keys, places[:, 1], 0)).astype(np.int64)
        new = np.flatnonzero(~self._same(raw, at, size, numbers))
        keep = self.words.n
        if len(new):
            _, first, back = np.unique(keys[new], return_index=True, return_inverse=True)
            # The long ones come last, to be forgotten.
            order = np.argsort(size[new[first]] > LONGEST_PIECE, kind="stable")
            keep += int((size[new[first]] <= LONGEST_PIECE).sum())
            one = new[first[order]]
            learned = self._learn(raw, at[one], size[one])
            place = np.empty(len(order), dtype=np.int64)
            place[order] = learned
            numbers[new] = place[back]
            short = learned < keep
            sets = sets[one[short]]
            self.keys[sets, 1], self.numbers[sets, 1] = self.keys[sets, 0], self.numbers[sets, 0]
            self.keys[sets, 0], self.numbers[sets, 0] = keys[one[short]], learned[short]
            clash = new[~self._same(raw, at[new], size[new], numbers[new])]
            if len(clash):
                numbers[clash] = self._learn(raw, at[clash], size[clash])
        return numbers, keep

    def encode_bytes(self, raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each of the texts that begin at ``offsets`` (and the end) of the bytes, the end id behind them."""
        if self.words.n > MOST_PIECES or self.words.at[self.words.n] > MOST_BYTES:
            self._forget()
        at = stretch_starts(raw, offsets) if len(raw) else np.zeros(0, dtype=np.int64)
        at = at[~self._inside_special(raw, offsets, at)]
        size = np.diff(np.append(at, len(raw)))
        numbers, keep = self._numbers(raw, at, size) if len(at) else (np.zeros(0, dtype=np.int64), self.words.n)
        # A document's end stands behind its stretches.
        behind = np.searchsorted(at, offsets[1:])
        numbers = np.insert(numbers, behind, 0)
        size = self.ids.sizes(numbers)
        out = self.ids.data[_runs(self.ids.at[numbers], size)]
        ends = np.cumsum(size)[behind + np.arange(len(behind))]
        self.words.n = self.ids.n = keep
        return np.split(out, ends[:-1])

    def _inside_special(self, raw: np.ndarray, offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Which stretches are not the first of a text that holds a special token's text."""
        inside = np.zeros(len(at), dtype=bool)
        data = raw.tobytes()
        for special in self.special:
            found = data.find(special)
            while found >= 0:
                k = int(np.searchsorted(offsets, found, side="right")) - 1
                if found + len(special) <= offsets[k + 1]:
                    inside |= (at > offsets[k]) & (at < offsets[k + 1])
                found = data.find(special, found + 1)
        return inside

    def encode_column(self, column: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text of an Arrow column (null: empty), the end id behind them."""
        raw, offsets = text_bytes(column)
        for a, b in pieces(offsets):
            yield from self.encode_bytes(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, the end id behind them."""
        return list(self.encode_column(pa.array(texts, pa.string())))


def _symbol_kind(n: int) -> str:
    """The numbers that hold ``n`` different symbols."""
    return "<u2" if n <= 1 << 16 else "<u4"


def _alternate(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of positions in ascending order, those that remain if each taken one forbids the next position, and which."""
    first = np.ones(len(at), dtype=bool)
    first[1:] = np.diff(at) != 1
    index = np.arange(len(at))
    free = (index - np.maximum.accumulate(np.where(first, index, 0))) % 2 == 0
    return at[free], free


def compress(ids: np.ndarray, starts: np.ndarray, frequent: int = FREQUENT) -> bytes:
    """Documents that begin at ``starts`` (and the end) as the bytes of a shard."""
    base = int(ids.max(initial=0)) + 1
    if base > 60_000:
        return _compressed(ids, starts, frequent, base, True)[0]
    narrow, full = _compressed(ids, starts, frequent, base, False)
    return min(narrow, _compressed(ids, starts, frequent, base, True)[0], key=len) if full else narrow


def _compressed(ids: np.ndarray, starts: np.ndarray, frequent: int, base: int, wide: bool) -> tuple[bytes, bool]:
    """The bytes, and whether symbols ran out."""
    pair_kind, bits = (np.uint64, 32) if wide else (np.uint32, 16)
    symbols = ids.astype(pair_kind)
    ends = np.zeros(len(ids), dtype=bool)
    ends[starts[1:] - 1] = True
    rules = np.zeros((0, 2), dtype=np.int64)
    lengths = np.ones(base, dtype=np.int64)
    pays = RULE // (4 if wide else 2) + 1
    # Positions of the pairs that hold a symbol of the last round; None: of all pairs. Other pairs got no more frequent.
    near = None
    while len(symbols) > 1 and len(lengths) < 1 << bits:
        if near is None:
            pair = (symbols[:-1] << pair_kind(bits)) | symbols[1:]
            inner = np.sort(pair[~ends[:-1]])
        else:
            near = near[~ends[near]]
            pair = (symbols[near] << pair_kind(bits)) | symbols[near + 1]
            inner = np.sort(pair)
        cut = np.flatnonzero(np.append(True, inner[1:] != inner[:-1])) if len(inner) else np.zeros(0, dtype=np.int64)
        n = np.diff(np.append(cut, len(inner)))
        least = max(pays, len(symbols) // frequent)
        chosen = inner[cut[n >= least]][: (1 << bits) - len(lengths)]
        at = rule = np.zeros(0, dtype=np.int64)
        if len(chosen):
            if near is None:
                # Few positions pass the marks, and only those are looked up.
                marks = np.zeros(1 << 16, dtype=bool)
                slot = (pair * pair_kind(0x9E3779B1)) >> pair_kind(2 * bits - 16)
                marks[(chosen * pair_kind(0x9E3779B1)) >> pair_kind(2 * bits - 16)] = True
                at = np.flatnonzero(marks[slot] & ~ends[:-1])
                pair = pair[at]
            else:
                at = near
            rule = np.minimum(np.searchsorted(chosen, pair), len(chosen) - 1)
            hit = chosen[rule] == pair
            at, free = _alternate(at[hit])
            rule = rule[hit][free]
            worth = np.bincount(rule, minlength=len(chosen)) >= pays
            at, rule = at[worth[rule]], (np.cumsum(worth) - 1)[rule[worth[rule]]]
        if not len(at):
            if near is None and least == pays:
                break
            if least > pays:
                frequent *= 4
            near = None
            continue
        left, right = (chosen[worth] >> pair_kind(bits)).astype(np.int64), (chosen[worth] & pair_kind((1 << bits) - 1)).astype(np.int64)
        symbols[at] = (len(lengths) + rule).astype(pair_kind)
        rules = np.concatenate([rules, np.stack([left, right], axis=1)])
        lengths = np.concatenate([lengths, lengths[left] + lengths[right]])
        ends[at] = ends[at + 1]
        keep = np.ones(len(symbols), dtype=bool)
        keep[at + 1] = False
        symbols, ends = symbols[keep], ends[keep]
        at = at - np.arange(len(at))
        beside = np.zeros(len(symbols) + 1, dtype=bool)
        beside[at] = beside[at - 1] = True
        near = np.flatnonzero(beside[: len(symbols) - 1])
    all_rules, all_lengths = rules, lengths[base:]
    first = np.append(0, np.flatnonzero(ends) + 1).astype(np.uint64)
    head = struct.pack(_HEAD, MAGIC, len(all_rules), len(symbols), len(starts) - 1, base)
    data = b"".join([head, all_rules.astype("<u4").tobytes(), all_lengths.astype("<u4").tobytes(), first.astype("<u8").tobytes(), symbols.astype(_symbol_kind(len(lengths))).tobytes()])
    return data, len(lengths) >= 1 << bits


class Shard:
    """Random access to the ids of a shard's bytes."""

    def __init__(self, data: bytes):
        magic, n_rules, n_symbols, self.n_docs, self.base = struct.unpack_from(_HEAD, data)
        if magic != MAGIC:
            raise ValueError("these bytes are no shard")
        at = struct.calcsize(_HEAD)

        def part(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype=kind, count=n, offset=at)
            at += out.nbytes
            return out

        self.rules = part("<u4", 2 * n_rules).reshape(-1, 2)
        self.lengths = part("<u4", n_rules).astype(np.int64)
        self.first = part("<u8", self.n_docs + 1).astype(np.int64)
        self.symbols = part(_symbol_kind(self.base + n_rules), n_symbols)
        self._flat()

    def _flat(self) -> None:
        """All expansions in one array, from the rules' own symbols on, all of them a step deeper each time."""
        self.start = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)
        flat = self.rules.ravel()
        while (rule := flat >= self.base).any():
            sizes = 1 + rule.astype(np.int64)
            at = (np.cumsum(sizes) - sizes)[rule]
            parts = self.rules[flat[rule] - self.base]
            flat = np.repeat(flat, sizes)
            flat[at], flat[at + 1] = parts[:, 0], parts[:, 1]
        self.flat = flat

    def sizes(self, symbols: np.ndarray) -> np.ndarray:
        new = symbols >= self.base
        out = np.ones(len(symbols), dtype=np.int64)
        out[new] = self.lengths[symbols[new].astype(np.int64) - self.base]
        return out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        sizes = self.sizes(symbols)
        out = np.repeat(symbols, sizes).astype(np.uint32)
        new = out >= self.base
        place = np.arange(len(out)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[new] = self.flat[self.start[out[new].astype(np.int64) - self.base] + place[new]]
        return out

    def document(self, k: int) -> np.ndarray:
        return self.expand(self.symbols[self.first[k] : self.first[k + 1]])

    def ids(self, k: int, a: int, b: int) -> np.ndarray:
        """Ids a to b of a document, from the symbols that cover them."""
        own = self.symbols[self.first[k] : self.first[k + 1]]
        ends = np.cumsum(self.sizes(own))
        lo, hi = np.searchsorted(ends, a, side="right"), np.searchsorted(ends, b, side="left") + 1
        skipped = int(ends[lo - 1]) if lo else 0
        return self.expand(own[lo:hi])[a - skipped : b - skipped]

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each document begins (and the end)."""
        upto = np.concatenate([[0], np.cumsum(self.sizes(self.symbols))])
        return self.expand(self.symbols), upto[self.first]


def _writer(path: str, pattern: str, shard: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(f"ids:{path}:{pattern}", lambda: Encoder(path, pattern))
        part, number, before = TaskContext.get().partitionId(), 0, 0
        held, owners, size = [], [], 0

        def out() -> pa.RecordBatch:
            ids = np.concatenate(held)
            starts = np.concatenate([[0], np.cumsum([len(h) for h in held])])
            names = pa.chunked_array(owners).combine_chunks()
            names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
            docs = pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names)
            values = [[part], [number], [before], [len(ids)]]
            columns = [pa.array(v, t) for v, t in zip(values, [pa.int32(), pa.int32(), pa.int64(), pa.int64()], strict=True)]
            return pa.RecordBatch.from_arrays([*columns, docs, pa.array([compress(ids, starts)], pa.binary())], names=["part", "number", "before", "n_ids", "doc_ids", "data"])

        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                some = batch.slice(a, ROWS)
                for k, ids in enumerate(encoder.encode_column(some.column("text"))):
                    held.append(ids)
                    owners.append(some.column("doc_id").slice(k, 1))
                    size += len(ids)
                    if size >= shard:
                        yield out()
                        number, before = number + 1, before + size
                        held, owners, size = [], [], 0
        if held:
            yield out()

    return write


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            ids, starts = Shard(row.column("data")[0].as_py()).documents()
            docs = row.column("doc_ids").flatten()
            crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts[:-1], starts[1:], strict=True)]
            before = row.column("before")[0].as_py()
            part = pa.array([row.column("part")[0].as_py()] * len(docs), pa.int32())
            columns = [part, docs, pa.array(before + starts[:-1]), pa.array(np.diff(starts)), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "before", "n_tokens", "ids_crc32"])


def write_ids(documents: DataFrame, path: str, pattern: str, folder: str, shard: int = SHARD) -> None:
    """Write the shards of all documents to ``folder``."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    ordered = documents.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    schema = f"part int, number int, before bigint, n_ids bigint, doc_ids array<{kind}>, data binary"
    ordered.mapInArrow(_writer(path, pattern, shard), schema).write.parquet(folder)


def read_ids(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document of the shards."""
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()
    read = shards.mapInArrow(_reader, f"part int, doc_id {kind}, before bigint, n_tokens bigint, ids_crc32 bigint")
    # One row for each part, that is for each task of the writer.
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    start = (F.col("offset") + F.col("before")).alias("start")
    return read.join(F.broadcast(offsets), "part").select("doc_id", start, "n_tokens", "ids_crc32")


def round_trip(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    folder = shared_folder(documents.sparkSession, "token-ids")
    write_ids(documents, path, pattern, folder)
    return read_ids(documents.sparkSession.read.parquet(folder))
