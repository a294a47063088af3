"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder.

A token sequence is the BPE result of its bytes exactly if each two neighbours are the BPE result of theirs. So the
merges act as a nondeterministic transducer that guesses tokens byte by byte and allows only such neighbours. It is
determinised on demand: a state is the set of live guesses (place in the token trie, last token, tokens not yet sent),
and a step sends the tokens that all guesses share. Guesses die within the length of the longest token, so lookahead is
bounded. States and steps are made when first met and dropped together beyond ``MOST_STATES``.

Each match of the pattern is encoded by itself; one that is a token as a whole is that token. The decoder maps ids to
bytes and gives text as soon as characters are whole, with U+FFFD for bytes that are no UTF-8.

Defined results: null and empty texts have no tokens; any text comes back byte for byte; rows are mapped one by one, so
repeated rows, ties and extra columns have no effect.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from daygrid.llm.common import kept, stretches_and_lines

MOST_STATES = 500_000
#: Stretches whose ids a worker remembers, and the longest of them in characters.
MOST_PIECES, LONGEST_PIECE = 500_000, 48
#: Texts taken from Arrow at a time.
ROWS = 256
#: Ids that the streaming decoder takes at a time.
PORTION = 1024


class Transducer:
    def __init__(self, ranks: dict[bytes, int], most_states: int = MOST_STATES):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.most_states = most_states
        self.next_node: dict[int, int] = {}
        self.token_at: dict[int, int] = {}
        #: The two tokens whose merge makes a token; None for a single byte.
        self.made_of: dict[int, tuple[int, int] | None] = {}
        self.neighbours: dict[tuple[int, int], bool] = {}
        nodes = 1
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                at = node << 8 | byte
                node = self.next_node.get(at, 0)
                if not node:
                    node = self.next_node[at] = nodes
                    nodes += 1
            halves = self._halves(token)
            if halves is not None or len(token) == 1:
                self.token_at[node] = rank
                self.made_of[rank] = halves
        self._forget()

    def merged(self, piece: bytes, until: int = 1) -> list[bytes]:
        """The merges applied one by one, lowest rank first, to ``until`` parts: what defines the result."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > until:
            found = [(self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            rank, i = min(found)
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _halves(self, token: bytes) -> tuple[int, int] | None:
        """What the last merge of a token joins, if the merges make it at all."""
        parts = self.merged(token, 2)
        return (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None

    def _may_follow(self, left: int, right: int) -> bool:
        """Whether the merges of both tokens' bytes end with these two tokens.

        The two sides of the seam are undone, the later merge first. The seam would have been closed if they join with a
        lower rank than the merge that swallowed one of them.
        """
        pair = (left, right)
        known = self.neighbours.get(pair)
        if known is not None:
            return known
        if len(self.neighbours) > self.most_states:
            self.neighbours.clear()
        bytes_of, made_of, joined = self.bytes_of, self.made_of, self.ranks.get
        never = 1 << 60
        # A seam merge beats the swallowing of its left side at equal rank only if it stands further left, so never.
        before, strict = never, True
        open_seam = True
        while True:
            rank = joined(bytes_of[left] + bytes_of[right], never)
            if rank < before or (rank == before != never and not strict):
                open_seam = False
                break
            a, b = made_of[left], made_of[right]
            if a is None and b is None:
                break
            if b is None or (a is not None and left > right):
                before, strict, left = left, True, a[1]
            else:
                before, strict, right = right, False, b[0]
        self.neighbours[pair] = open_seam
        return open_seam

    def _forget(self) -> None:
        start = ((0, -1, ()),)
        self.states = [start]
        self.number = {start: 0}
        self.steps: dict[int, tuple[int, tuple[int, ...]]] = {}

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        live, whole, next_node, token_at = [], [], self.next_node.get, self.token_at.get
        for node, last, waiting in self.states[state]:
            child = next_node(node << 8 | byte)
            if child is not None:
                live.append((child, last, waiting))
                token = token_at(child)
                if token is not None:
                    whole.append((last, token, waiting))
        # The bytes so far have one result, so exactly one of the tokens that end here is right; they stand in order of
        # their beginnings, and long ones are likelier.
        for last, token, waiting in whole:
            if last < 0 or self._may_follow(last, token):
                live.append((0, token, (*waiting, token)))
                break
        sent = live[0][2]
        if sent:
            shared = 0
            shortest = min([len(w) for _, _, w in live])
            while shared < shortest and all([w[shared] == sent[shared] for _, _, w in live]):
                shared += 1
            sent = sent[:shared]
            if shared:
                live = [(node, last, waiting[shared:]) for node, last, waiting in live]
        after = tuple(live)
        number = self.number.get(after)
        if number is None:
            number = self.number[after] = len(self.states)
            self.states.append(after)
        self.steps[state << 8 | byte] = (number, sent)
        return number, sent

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > self.most_states:
            self._forget()
        state, out, steps = 0, [], self.steps
        for byte in piece:
            found = steps.get(state << 8 | byte)
            state, sent = found if found is not None else self._step(state, byte)
            if sent:
                out.extend(sent)
        out.extend(next(waiting for node, _, waiting in self.states[state] if node == 0))
        return out


class Utf8Stream:
    """Text from bytes that come in any portions; keeps the start of a character until the rest comes.

    ``errors`` says what bytes that are no UTF-8 give, as in ``bytes.decode``.
    """

    def __init__(self, errors: str = "replace") -> None:
        self.rest = b""
        self.errors = errors

    def feed(self, data: bytes) -> str:
        data = self.rest + data
        keep = self._open_bytes(data)
        self.rest = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", self.errors)

    def finish(self) -> str:
        data, self.rest = self.rest, b""
        return data.decode("utf-8", self.errors)

    @staticmethod
    def _open_bytes(data: bytes) -> int:
        """How many bytes at the end begin a character that may still become whole."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC2:
                wanted = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4 if byte < 0xF5 else 0
                return back if wanted > back else 0
            if byte < 0x80 or byte > 0xBF:
                return 0
        return 0


def decoded(ids: Iterable[int], bytes_of: dict[int, bytes]) -> Iterator[str]:
    """Text as it becomes whole, id by id."""
    stream = Utf8Stream()
    for i in ids:
        yield stream.feed(bytes_of[i])
    yield stream.finish()


def decoded_hash(ids: list[int], bytes_of: list[bytes]) -> str:
    """sha256 of the streamed text, ``PORTION`` ids at a time; bytes that are no UTF-8 count as they are."""
    errors = "surrogateescape"
    stream, out = Utf8Stream(errors), hashlib.sha256()
    for a in range(0, len(ids), PORTION):
        out.update(stream.feed(b"".join(map(bytes_of.__getitem__, ids[a : a + PORTION]))).encode("utf-8", errors))
    out.update(stream.finish().encode("utf-8", errors))
    return out.hexdigest()


def read_ranks(path: str) -> dict[bytes, int]:
    """Lines of a base64 token and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


Piece = tuple[tuple[int, ...], str]


class Encoder:
    """Pattern, transducer and the stretches of text met before.

    Stretches between lone spaces are looked up whole, so the pattern runs on new ones only. It must be of the kind that
    ``common.stretches_and_lines`` names.
    """

    def __init__(self, path: str, pattern: str, most_pieces: int = MOST_PIECES, most_states: int = MOST_STATES):
        self.transducer = Transducer(read_ranks(path), most_states)
        self.most_pieces = most_pieces
        self.find = regex.compile(pattern).findall
        #: Ids, and the same as text with commas, of a stretch with a space before it.
        self.known: dict[str, Piece] = {}
        #: The same of matches without a space before them.
        self.bare: dict[str, Piece] = {}

    def _match(self, piece: str) -> Piece:
        # A match that begins with a space is a stretch of its own elsewhere; the others are few, marks above all.
        store, key = (self.known, piece[1:]) if piece[0] == " " and len(piece) > 1 else (self.bare, piece)
        found = store.get(key)
        if found is None:
            ids = tuple(self.transducer.encode_piece(piece.encode()))
            found = (ids, ",".join(map(str, ids)))
            if len(key) <= LONGEST_PIECE:
                store[key] = found
        return found

    def _stretch(self, part: str) -> Piece:
        found = [self._match(piece) for piece in self.find(part if part[:1] == "\n" else " " + part)]
        whole = found[0] if len(found) == 1 else (tuple(chain.from_iterable([f[0] for f in found])), ",".join([f[1] for f in found]))
        if len(part) <= LONGEST_PIECE:
            self.known[part] = whole
        return whole

    def pieces(self, text: str) -> list[Piece]:
        if len(self.known) > self.most_pieces:
            # The older half goes.
            for part in list(islice(self.known, self.most_pieces // 2)):
                del self.known[part]
        if len(self.bare) > self.most_pieces // 8:
            self.bare.clear()
        parts = stretches_and_lines(text)
        if parts is None:
            # White space at an end; what stands before the first lone space has none before it.
            return [self._match(piece) for piece in self.find(text)]
        known, new = self.known.get, self._stretch
        out = [self._match(piece) for piece in self.find(parts[0])]
        out += [known(part) or new(part) for part in parts[1:]]
        return out

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable([ids for ids, _ in self.pieces(text)]))


def _mapper(path: str, pattern: str, with_ids: bool = False, sizes: tuple[int, int] = (MOST_PIECES, MOST_STATES), keep: bool = True):
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = lambda: Encoder(path, pattern, *sizes)
        encoder = kept(f"bpe:{path}:{pattern}:{sizes}", make) if keep else make()
        ranks = encoder.transducer.ranks
        bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            bytes_of[rank] = token
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                counts, ids_hash, text_hash, all_ids = [], [], [], []
                for text in pc.fill_null(part.column("text"), "").to_pylist():
                    found = encoder.pieces(text)
                    ids = list(chain.from_iterable([f[0] for f in found]))
                    counts.append(len(ids))
                    ids_hash.append(hashlib.sha256(",".join([f[1] for f in found]).encode()).hexdigest())
                    text_hash.append(decoded_hash(ids, bytes_of))
                    if with_ids:
                        all_ids.append(np.array(ids, dtype=np.int32))
                rest = part.drop_columns(["text"])
                columns = [*rest.columns, pa.array(counts, pa.int64()), pa.array(ids_hash), pa.array(text_hash)]
                names_out = [*rest.schema.names, "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.array(all_ids, pa.list_(pa.int32())))
                    names_out.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names_out)

    def map_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # No cycles are made here, and a collection would walk all kept states. Later steps in this worker collect again.
        collects = gc.isenabled()
        gc.disable()
        try:
            yield from mapped(batches)
        finally:
            if collects:
                gc.enable()

    return map_batches


def encoded(
    documents: DataFrame,
    path: str,
    pattern: str,
    with_ids: bool = False,
    sizes: tuple[int, int] = (MOST_PIECES, MOST_STATES),
    keep: bool = True,
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids of each document.

    ``path`` is a rank file that each worker can read. A worker remembers up to ``sizes`` stretches and states; with
    ``keep`` from task to task, which saves time and holds their memory while other steps run.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return documents.select("doc_id", "text").mapInArrow(_mapper(path, pattern, with_ids, sizes, keep), schema)
