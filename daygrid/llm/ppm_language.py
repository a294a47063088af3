"""Language identification by prediction with partial matching.

Each language has a tree of byte contexts up to ``ORDER`` bytes, counted over a sample of its texts and then frozen. A
byte's code length in the longest context seen is -log2(count / (total + distinct)) if it was seen there; otherwise the
escape, -log2(distinct / (total + distinct)), and its code length in the context one byte shorter, down to 8 bits. A text
gets the language that codes all its bytes in the fewest bits; the score is that language's share of the likelihood.

Texts are lower-cased first. Statistics come from about ``SAMPLE`` documents of each language, chosen by the hash of
their ids: that bounds what reaches the driver. Scoring is a narrow map over whole texts. Ties go to the language that
sorts first. Defined results: null texts and texts without a letter are ``und`` with score 0, as are all texts if nothing
could be learned; documents without a language are not learned from; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.common import bucket_of, pieces, text_bytes

ORDER = 3
#: Documents to learn from for each language, about.
SAMPLE = 1500
FOLDS, HELD_OUT = 5, 0
#: Most byte pairs for which places in the table are looked up directly.
MOST_PAIRS = 4096


def windows(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte a number of the ORDER bytes before it and itself; line ends stand before a text."""
    first = np.zeros(len(raw), dtype=np.int64)
    first[offsets[:-1][np.diff(offsets) > 0]] = 1
    since = np.arange(len(raw)) - np.maximum.accumulate(np.where(first == 1, np.arange(len(raw)), 0))
    out = raw.astype(np.uint32)
    for back in range(1, ORDER + 1):
        before = np.full(len(raw), 10, dtype=np.uint32)
        before[back:] = raw[:-back]
        before[since < back] = 10
        out |= before << np.uint32(8 * back)
    return out


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for lang in sorted(set(langs)):
            own = batch.filter(pa.array(langs == lang))
            raw, offsets = text_bytes(own.column("text"))
            for lo, hi in pieces(offsets):
                at = offsets[lo : hi + 1]
                found, n = np.unique(windows(raw[at[0] : at[-1]], at - at[0]), return_counts=True)
                columns = [pa.array([lang] * len(found)), pa.array(found.astype(np.int64)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "window", "n"])


@dataclass
class Trees:
    """For each order: windows seen by any language with their code lengths, contexts with their escape lengths."""

    languages: list[str]
    keys: list[np.ndarray]
    lengths: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    def code_lengths(self, found: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Bits of each window's last byte, a column for each language."""
        if order < 0:
            return np.full((len(found), len(self.languages)), 8.0)
        keys = self.keys[order]
        at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
        known = keys[at] == found
        out = np.empty((len(found), len(self.languages)))
        out[known] = self.lengths[order][at[known]]
        if not known.all():
            out[~known] = self._escaped(found[~known], order)
        return out

    def _escaped(self, found: np.ndarray, order: int) -> np.ndarray:
        contexts = self.contexts[order]
        context = found >> np.uint32(8)
        at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
        out = np.where((contexts[at] == context)[:, None], self.escapes[order][at], 0.0)
        shorter = found & np.uint32((1 << (8 * order)) - 1) if order else found
        return out + self.code_lengths(shorter, order - 1)


def grow(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Trees:
    """Trees from each language's windows of the highest order and their counts."""
    trees = Trees(sorted(counts), [], [], [], [])
    n_langs = len(trees.languages)
    for order in range(ORDER + 1):
        mask = np.uint32((1 << (8 * (order + 1))) - 1) if order < 3 else np.uint32(0xFFFFFFFF)
        own = []
        for lang in trees.languages:
            found, n = counts[lang]
            keys, at = np.unique(found & mask, return_inverse=True)
            own.append((keys, np.bincount(at, weights=n)))
        keys = np.unique(np.concatenate([k for k, _ in own]))
        contexts, place = np.unique(keys >> np.uint32(8), return_inverse=True)
        lengths, escapes = np.zeros((len(keys), n_langs)), np.zeros((len(contexts), n_langs))
        seen_in = []
        for k, (some, n) in enumerate(own):
            at = np.searchsorted(keys, some)
            total = np.bincount(place[at], weights=n, minlength=len(contexts))
            distinct = np.bincount(place[at], minlength=len(contexts))
            met = distinct > 0
            escapes[met, k] = -np.log2(distinct[met] / (total + distinct)[met])
            lengths[at, k] = -np.log2(n / (total + distinct)[place[at]])
            seen = np.zeros(len(keys), dtype=bool)
            seen[at] = True
            seen_in.append(seen)
        trees.contexts.append(contexts)
        trees.escapes.append(escapes)
        below = trees._escaped(keys, order)
        for k, seen in enumerate(seen_in):
            lengths[~seen, k] = below[~seen, k]
        trees.keys.append(keys)
        trees.lengths.append(lengths)
    return trees


class Scorer:
    """Sums of code lengths, with a direct table from byte pairs to the places of windows."""

    def __init__(self, trees: Trees):
        self.trees = trees
        keys = trees.keys[ORDER]
        pairs = np.unique(np.concatenate([keys >> np.uint32(16), keys & np.uint32(0xFFFF)]))
        self.place = None
        if len(pairs) <= MOST_PAIRS:
            self.pair = np.full(1 << 16, len(pairs), dtype=np.int64)
            self.pair[pairs] = np.arange(len(pairs))
            self.width = len(pairs) + 1
            self.place = np.full(self.width * self.width, -1, dtype=np.int32)
            self.place[self.pair[keys >> np.uint32(16)] * self.width + self.pair[keys & np.uint32(0xFFFF)]] = np.arange(len(keys))
            self.lengths = trees.lengths[ORDER].astype(np.float32)

    def bits(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For each text the bits of all its bytes in each language."""
        found = windows(raw, offsets)
        if self.place is None:
            each = self.trees.code_lengths(found)
        else:
            at = self.place[self.pair[found >> np.uint32(16)] * self.width + self.pair[found & np.uint32(0xFFFF)]]
            each = self.lengths[at]
            new = np.flatnonzero(at < 0)
            if len(new):
                distinct, back = np.unique(found[new], return_inverse=True)
                each[new] = self.trees.code_lengths(distinct)[back]
        out = np.zeros((len(offsets) - 1, len(self.trees.languages)))
        full = np.flatnonzero(np.diff(offsets) > 0)
        if len(full):
            out[full] = np.add.reduceat(each, offsets[full], axis=0, dtype=np.float64)
        return out


def learn(documents: DataFrame, sample: int = SAMPLE) -> Trees | None:
    own = documents.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (bucket_of(F.col("doc_id"), FOLDS) != HELD_OUT)
    )
    sizes = own.groupBy("lang").agg(F.count("*").alias("docs"))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000 < sample / F.col("docs")
    texts = own.join(F.broadcast(sizes), "lang").where(drawn).select("lang", F.lower("text").alias("text"))
    counted = texts.mapInArrow(_counter, "lang string, window bigint, n bigint")
    rows = counted.groupBy("lang", "window").agg(F.sum("n").alias("n")).toArrow()
    if not rows.num_rows:
        return None
    langs = np.array(rows.column("lang").to_pylist(), dtype=object)
    found, n = rows.column("window").to_numpy().astype(np.uint32), rows.column("n").to_numpy()
    order = np.argsort(found, kind="stable")
    langs, found, n = langs[order], found[order], n[order]
    return grow({lang: (found[langs == lang], n[langs == lang]) for lang in set(langs)})


def _predictor(shared):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Trees(*shared.value))
        names = np.array([*scorer.trees.languages, "und"], dtype=object)
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            for lo, hi in pieces(offsets):
                at = offsets[lo : hi + 1]
                bits = scorer.bits(raw[at[0] : at[-1]], at - at[0])
                part = batch.slice(lo, hi - lo)
                letters = part.column("letters").to_numpy(zero_copy_only=False).astype(bool)
                best = np.argmin(bits, axis=1)
                share = 1 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
                said = names[np.where(letters, best, len(names) - 1)]
                columns = [part.column("doc_id"), pa.array(said, pa.string()), pa.array(np.where(letters, share, 0.0))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    return predict


def predicted(documents: DataFrame, trees: Trees | None) -> DataFrame:
    """doc_id, lang_pred and score of each document."""
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    rows = documents.select("doc_id", F.lower("text").alias("text"), letters)
    if trees is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    kind = documents.schema["doc_id"].dataType.simpleString()
    parts = (trees.languages, trees.keys, trees.lengths, trees.contexts, trees.escapes)
    shared = documents.sparkSession.sparkContext.broadcast(parts)
    return rows.mapInArrow(_predictor(shared), f"doc_id {kind}, lang_pred string, score double")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", (bucket_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
