"""Quality classifier: gated attention over passages, learned from document labels alone (multiple-instance learning).

A document is a bag of passages of ``PASSAGE`` words over its whole text. Each passage is encoded from counts of byte
classes, their transitions and hashed words: h = tanh(x W + b). Gated attention gives it the weight
softmax(w . (tanh(h V) * sigmoid(h U))) among the document's passages, and the document's score is
sigmoid(c . sum(weight h) + d). So one spoilt passage of a long document can carry the decision.

The model is fitted with numpy on the driver, on at most ``SAMPLE`` labelled documents, those with the least id hashes, and
at most ``PASSAGES`` of their passages (about 94 MB). If they have more, each document gives as many as it has up to the
largest number that keeps the bound, drawn by hash over its whole text. Scoring is a narrow map over all documents and
all their passages. Inputs of a score are the text's bytes only.

Defined results: null and empty texts are one passage without words; labels other than 0 and 1 and ids with both labels
are not learned from; of several texts with one labelled id the one with the least hash is; without any labels all
scores are 0.5; repeated rows get equal scores; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.common import bucket_of, mixed, pieces, stored, text_bytes, word_starts, words_of

PASSAGE = 64
#: Most labelled documents that the model learns from.
SAMPLE = 4000
#: Most passages of theirs; at least SAMPLE, so that each document gives one.
PASSAGES = 65_536
ACCEPT = 0.7
#: Remainder of crc32(doc_id) modulo FOLDS that is never learned from.
FOLDS, HELD_OUT = 4, 2
HIDDEN, GATE, EPOCHS, RATE, DECAY = 24, 12, 150, 0.02, 1e-4
WORD_BUCKETS = 64

#: Byte classes, one text each; all other bytes below 128 are one class, bytes from 128 another.
CLASSES = [
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "0123456789",
    " \t",
    "\n\r",
    ".",
    ",;:",
    "!",
    "?",
    "|",
    "$%&#@*^~+=",
    "'\"`",
    "()[]{}<>",
    "-_/\\",
]
N_CLASSES = len(CLASSES) + 2
WIDTH = N_CLASSES * N_CLASSES + WORD_BUCKETS + 3


def _class_table() -> np.ndarray:
    out = np.full(256, len(CLASSES), dtype=np.int64)
    out[128:] = len(CLASSES) + 1
    for k, chars in enumerate(CLASSES):
        out[list(chars.encode())] = k
    return out


_CLASS = _class_table()


def encode(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passage vectors of some texts, and each text's first passage (and the end of the last)."""
    words, first = words_of(raw, offsets)
    per_text = np.maximum(1, -(-np.diff(first) // PASSAGE))
    bags = np.concatenate([[0], np.cumsum(per_text)])
    n = int(bags[-1])
    text_of_word = np.repeat(np.arange(len(per_text)), np.diff(first))
    of_word = bags[text_of_word] + (np.arange(len(words)) - first[text_of_word]) // PASSAGE
    out = np.zeros((n, WIDTH), dtype=np.float32)
    if len(raw):
        _, starts = word_starts(raw, offsets)
        text_of_byte = np.repeat(np.arange(len(per_text)), np.diff(offsets))
        word_of_byte = np.searchsorted(starts, np.arange(len(raw)), side="right") - 1 if len(starts) < 2 else None
        if word_of_byte is None:
            word_of_byte = np.repeat(np.arange(-1, len(starts)), np.diff(np.concatenate([[0], starts, [len(raw)]])))
        of_byte = bags[text_of_byte].copy()
        known = (word_of_byte >= first[text_of_byte]) & (word_of_byte < first[text_of_byte + 1])
        of_byte[known] = of_word[word_of_byte[known]]
        kind = _CLASS[raw]
        step = kind[:-1] * N_CLASSES + kind[1:]
        same = of_byte[:-1] == of_byte[1:]
        square = N_CLASSES * N_CLASSES
        counts = np.bincount((of_byte[:-1] * square + step)[same], minlength=n * square).reshape(n, square)
        out[:, :square] = np.sqrt(counts / np.maximum(1, counts.sum(axis=1, keepdims=True)))
        total = np.maximum(1, np.bincount(of_word, minlength=n))
        bucket = (words >> np.uint64(58)).astype(np.int64)
        hashed = np.bincount(of_word * WORD_BUCKETS + bucket, minlength=n * WORD_BUCKETS).reshape(n, WORD_BUCKETS)
        out[:, square : square + WORD_BUCKETS] = np.sqrt(hashed / total[:, None])
        again = np.zeros(len(words), dtype=np.float64)
        again[1:] = words[1:] == words[:-1]
        out[:, -3] = np.bincount(of_word, weights=again, minlength=n) / total
        out[:, -2] = np.log1p(np.bincount(of_byte, minlength=n) / total)
        out[:, -1] = np.bincount(of_word, minlength=n) / PASSAGE
    return out, bags


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def score(self, x: np.ndarray, bags: np.ndarray) -> np.ndarray:
        return forward(self.weights, (x - self.mean) * self.scale, bags)["p"]


def forward(w: dict[str, np.ndarray], x: np.ndarray, bags: np.ndarray) -> dict[str, np.ndarray]:
    h = np.tanh(x @ w["W"] + w["b"])
    t, s = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    logits = (t * s) @ w["w"]
    starts, sizes = bags[:-1], np.diff(bags)
    top = np.repeat(np.maximum.reduceat(logits, starts), sizes)
    raised = np.exp(logits - top)
    a = raised / np.repeat(np.add.reduceat(raised, starts), sizes)
    z = np.add.reduceat(a[:, None] * h, starts)
    return {"h": h, "t": t, "s": s, "a": a, "z": z, "p": _sigmoid(z @ w["c"] + w["d"])}


def fit(x: np.ndarray, bags: np.ndarray, y: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Whole-batch Adam on the mean log loss."""
    mean = x.mean(axis=0)
    scale = 1 / (x.std(axis=0) + 0.05)
    x = (x - mean) * scale
    draw = np.random.Generator(np.random.PCG64(7))
    shapes = {"W": (x.shape[1], HIDDEN), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,)}
    w = {k: (draw.standard_normal(v) / np.sqrt(v[0])).astype(np.float32) for k, v in shapes.items()}
    share = np.clip(y.mean(), 0.01, 0.99)
    w |= {"b": np.zeros(HIDDEN, dtype=np.float32), "d": np.float32(np.log(share / (1 - share)))}
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    sizes = np.diff(bags)
    for epoch in range(1, epochs + 1):
        f = forward(w, x, bags)
        error = (f["p"] - y) / len(y)
        g = {"c": f["z"].T @ error, "d": error.sum()}
        dz = np.repeat(error[:, None] * w["c"], sizes, axis=0)
        da = (dz * f["h"]).sum(axis=1)
        inner = np.repeat(np.add.reduceat(f["a"] * da, bags[:-1]), sizes)
        dlogits = f["a"] * (da - inner)
        g["w"] = (f["t"] * f["s"]).T @ dlogits
        gate = dlogits[:, None] * w["w"]
        dt, ds = gate * f["s"] * (1 - f["t"] ** 2), gate * f["t"] * f["s"] * (1 - f["s"])
        g["V"], g["U"] = f["h"].T @ dt, f["h"].T @ ds
        dh = (f["a"][:, None] * dz + dt @ w["V"].T + ds @ w["U"].T) * (1 - f["h"] ** 2)
        g["W"], g["b"] = x.T @ dh, dh.sum(axis=0)
        for k in w:
            grad = g[k] + DECAY * w[k]
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.999 * second[k] + 0.001 * grad**2
            move = RATE * (first[k] / (1 - 0.9**epoch)) / (np.sqrt(second[k] / (1 - 0.999**epoch)) + 1e-8)
            w[k] = (w[k] - move).astype(np.float32)
    return Model(mean, scale, w)


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        raw, offsets = text_bytes(batch.column("text"))
        for lo, hi in pieces(offsets):
            at = offsets[lo : hi + 1]
            yield (batch.slice(lo, hi - lo), *encode(raw[at[0] : at[-1]], at - at[0]))


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, _, bags in _encoded(batches):
        yield pa.RecordBatch.from_arrays([pa.array(np.diff(bags))], names=["n"])


def _encoder(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x, bags in _encoded(batches):
            found = []
            for h, a, b in zip(part.column("h").to_pylist(), bags[:-1].tolist(), bags[1:].tolist(), strict=True):
                drawn = np.arange(a, b)
                if b - a > most:
                    order = mixed(np.arange(b - a, dtype=np.uint64) + np.uint64(h % (1 << 63)))
                    drawn = a + np.sort(np.argsort(order)[:most])
                found.append(x[drawn].tobytes())
            columns = [part.column("h"), part.column("quality"), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["h", "quality", "x"])

    return run


def each_up_to(counts: np.ndarray, bound: int) -> int:
    """The largest number of passages of a document with which all give ``bound`` or fewer; at least one."""
    low, high = 1, max(1, int(counts.max(initial=1)))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if np.minimum(counts, middle).sum() <= bound else (low, middle - 1)
    return low


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, passages: int = PASSAGES) -> Model | None:
    one = (
        labels.where(F.col("quality").isin(0, 1) & (bucket_of(F.col("doc_id"), FOLDS) != HELD_OUT))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .where("quality = other")
    )
    h = F.xxhash64("doc_id").alias("h")
    chosen = one.select("doc_id", h, F.col("quality").cast("int")).orderBy("h", "doc_id").limit(sample)
    # At most ``sample`` rows on the one side, and then on the other.
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "h", "quality")
    texts = stored(texts.agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("h", "quality", "text"), "labelled")
    counts = np.array([r.n for r in texts.mapInArrow(_counter, "n bigint").collect()], dtype=np.int64)
    if not len(counts):
        return None
    rows = texts.mapInArrow(_encoder(each_up_to(counts, passages)), "h bigint, quality int, x binary").collect()
    rows.sort(key=lambda r: (r.h, bytes(r.x)))
    bags = [np.frombuffer(r.x, dtype=np.float32).reshape(-1, WIDTH) for r in rows]
    ends = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    return fit(np.concatenate(bags), ends, np.array([r.quality for r in rows], dtype=np.float32))


def _scorer(model: Model | None):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            for lo, hi in pieces(offsets):
                at = offsets[lo : hi + 1]
                x, bags = encode(raw[at[0] : at[-1]], at - at[0])
                p = np.full(hi - lo, 0.5) if model is None else model.score(x, bags)
                part = batch.slice(lo, hi - lo).drop_columns(["text"])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p.astype(np.float64))], names=[*part.schema.names, "score"])

    return score


def scored(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, th (hash of the text) and score of each document."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    texts = documents.select("doc_id", F.xxhash64("text").alias("th"), "text")
    return texts.mapInArrow(_scorer(model), f"doc_id {kind}, th bigint, score double")


def accepted(documents: DataFrame, model: Model | None) -> DataFrame:
    """The documents with a score of ``ACCEPT`` or more, all columns as they are."""
    columns = documents.columns
    with_copy = documents.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)), "text")
    types = [f"c{i} {documents.schema[c].dataType.simpleString()}" for i, c in enumerate(columns)]
    kept = with_copy.mapInArrow(_scorer(model), ", ".join([*types, "score double"])).where(F.col("score") >= ACCEPT)
    return kept.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(columns)))


def digest(found: DataFrame) -> DataFrame:
    held_out = bucket_of(F.col("doc_id"), FOLDS) == HELD_OUT
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
