"""What the operators of this package share: tables, written intermediate results, texts as byte arrays."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daygrid.durable import new_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Bytes of text that numpy code takes at a time; a longer document is taken alone.
CHUNK = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one the session names in ``spark.checkpoint.dir``; an error if it names none.

    It goes when the ``durable.scope`` around the caller ends; without one it stays.
    """
    return new_folder(spark, name)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, name: str, **options: object) -> DataFrame:
    """Write ``df`` as a Parquet table, with the writer's ``options``, in the shared folder and read it back: lineage ends there."""
    folder = shared_folder(df.sparkSession, name)
    df.write.options(**options).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def bucket_of(doc_id: Column, n: int) -> Column:
    """crc32 of the id's text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def named_vectors(rows: DataFrame) -> DataFrame:
    """vec_id and v with a and b, two hashes that name the vector."""
    return rows.select("vec_id", F.xxhash64("v").alias("a"), F.xxhash64(F.lit(1), F.col("v")).alias("b"), "v")


def distinct_vectors(named: DataFrame, k: int) -> DataFrame:
    """a, b, dim, ids and v of each distinct vector; ``ids`` are the ``k`` + 1 smallest, repeated ones as often as they occur.

    A list of the best ``k`` rows that leaves one row out never needs more of equal rows.
    """
    # Spark limits each task's rows of a key before the shuffle, so a vector that most rows hold is no large group.
    order = Window.partitionBy("a", "b").orderBy("vec_id")
    few = named.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    one = few.groupBy("a", "b").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.any_value("v").alias("v"))
    return one.select("a", "b", F.size("v").alias("dim"), "ids", "v")


def asked_rows(named: DataFrame, every: int) -> DataFrame:
    """query_id, qa, qb, copies, dim and v of the rows whose id is divisible by ``every``; repeated rows once, with their number."""
    asked = named.where(F.col("vec_id") % every == 0).groupBy("vec_id", "a", "b")
    asked = asked.agg(F.count("*").alias("copies"), F.any_value("v").alias("v"))
    return asked.select(
        F.col("vec_id").alias("query_id"), F.col("a").alias("qa"), F.col("b").alias("qb"), "copies", F.size("v").alias("dim"), "v"
    )


def small_side(df: DataFrame, most: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most`` rows; otherwise Spark shuffles it."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def kept(name: str, make: Callable[[], object]) -> object:
    """One object for each worker process, kept from task to task."""
    store = sys.modules.setdefault("_daygrid_kept", types.ModuleType("_daygrid_kept"))
    if not hasattr(store, name):
        setattr(store, name, make())
    return getattr(store, name)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of an Arrow column in one array, and where each text begins (null: empty)."""
    column = pc.fill_null(column, "") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``most`` bytes each."""
    first = 0
    n = len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        yield first, last
        first = last


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _FACTOR, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_starts(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes belong to words (runs without ASCII white space, within a text), and where the words begin."""
    inside = ~_SPACE[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(raw)]
    begins[cuts] = inside[cuts]
    return inside, np.flatnonzero(begins)


def words_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of some texts, A-Z lowered, and each text's first word (and the end of the last)."""
    inside, starts = word_starts(raw, offsets)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    place = np.arange(len(raw))
    place -= np.repeat(np.append(0, starts), np.diff(np.concatenate([[0], starts, [len(raw)]])))
    place[~inside] = 0
    values = (_LOWER[raw].astype(np.uint64) + np.uint64(1)) * powers(int(place.max()) + 1)[place]
    values[~inside] = 0
    return mixed(np.add.reduceat(values, starts)), np.searchsorted(starts, offsets)


_LEAD = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: White space that is not one space or line break between words, in ASCII and beyond.
_TWO = ("  ", "\n\n", " \n", "\n ")
_OTHER = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
_NO_PLAIN_SPACE = re.compile(r"[^\S \n]")


def stretches_and_lines(text: str) -> list[str] | None:
    """Parts of a text at its lone spaces and line breaks (no white space beside them).

    A part that begins with a line break keeps it, the others lack their space. None for a text with white space at an
    end, which is to stay whole. For patterns whose matches hold a space or a line break only as their first character
    or within white space: a part then splits alone as it does in the text, as a run of white space is never cut.
    """
    if not text or text[0].isspace() or text[-1].isspace():
        return None
    if any(two in text for two in _TWO) or (any(c in text for c in _OTHER) if text.isascii() else _NO_PLAIN_SPACE.search(text)):
        return [p if p[0] == "\n" else p[p[0] == " " :] for p in _LEAD.split(text)]
    return text.replace("\n", " \n").split(" ")
