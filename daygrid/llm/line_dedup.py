"""Line dedup over all documents: a line goes if an earlier line is equal or within one edit.

The one-edit search is a deletion-neighbourhood join: every line emits, as hashed keys, its text with each character
deleted, and its own text. Two lines that differ in one character share the key of deleting it at the same place; a line
and the same line with one character more share the shorter one's own text. A key's group gives each member the earliest
partner, whose edit distance is then verified on the texts. Groups stay small at any scale: equal lines are one member,
and different lines with one deletion in common differ in that character alone.

Only lines that can have a partner emit variants. Of two lines within one edit, either the first or the second half of
the shorter one is equal in both, so lines none of whose half keys is shared are left out without loss.

Order is (doc_id, hash of the text, line number), nulls first. A line takes part if it has ``min_chars`` characters or
more after trimming spaces; shorter ones are never removed. Whether a line goes depends on all lines of the input, also
on those that go themselves. Defined results: null text stays null, empty text has one short line; wholly repeated rows
count as one document and each gets the same result; an empty table gives an empty table; other columns are untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrid.llm.common import free_name, mixed, small_side, stored

MIN_CHARS = 30
BROADCAST_ROWS = 500_000
#: Rows of variants in one Arrow batch, about.
BATCH = 100_000
PLACE = ["doc_id", "th", "line_no"]
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


def text_hash() -> Column:
    return F.xxhash64("text").alias("th")


def _half_keys(line: Column, n: Column) -> Column:
    """Hashes of the first and second half for pairs whose shorter line has n or n - 1 characters."""
    keys = []
    for shorter in (n, n - 1):
        half = (shorter / 2).cast("int")
        keys.append(F.xxhash64(F.lit("first"), shorter, F.substring(line, F.lit(1), half)))
        keys.append(F.xxhash64(F.lit("second"), shorter, F.substring(line, n - (shorter - half) + 1, shorter - half)))
    return F.array(*keys)


def split_once(text: str) -> Column:
    """The column ``lines``: an array that is made once for a document, however often an expression above looks into it."""
    return F.explode(F.array(F.split(text, "\n"))).alias("lines")


def lines_of(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Lines that take part: a, b (two hashes that name the line), doc_id, th, line_no, halves."""
    # The hash is taken below the explosion: beside it, the whole text would be hashed for each of its lines.
    texts = documents.select("doc_id", text_hash(), "text")
    split = texts.select("doc_id", "th", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    line = F.trim("line")
    return (
        split.select(*PLACE, line.alias("line"), F.char_length(line).alias("n"))
        .where(F.col("n") >= min_chars)
        .select(
            F.xxhash64("line").alias("a"),
            F.xxhash64(F.lit(1), F.col("line")).alias("b"),
            *PLACE,
            _half_keys(F.col("line"), F.col("n")).alias("halves"),
        )
    )


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, at, doc_id, th, line_no) for each deletion; ``at`` is -1 for the line's own text."""
    step, back = np.uint64(_STEP), np.uint64(_BACK)

    def marked(hashes: np.ndarray, length: int) -> np.ndarray:
        return mixed(hashes + np.uint64(length * 0xD6E8FEB86659FD93 % (1 << 64)))

    def keys_of(line: str) -> np.ndarray:
        points = np.frombuffer(line.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
        n = len(points)
        steps = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, step)]), dtype=np.uint64)
        upto = np.concatenate([[np.uint64(0)], np.cumsum(points * steps, dtype=np.uint64)])
        without = upto[:-1] + (upto[-1] - upto[1:]) * back
        return np.append(marked(without, n - 1), marked(upto[-1:], n))

    for batch in batches:
        keys, rows, places, size = [], [], [], 0

        def out() -> pa.RecordBatch:
            taken = batch.select(PLACE).take(pa.array(np.concatenate(rows)))
            key, at = np.concatenate(keys).view(np.int64), np.concatenate(places)
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(at), *taken.columns], names=["key", "at", *PLACE])

        for row, line in enumerate(batch.column("line").to_pylist()):
            found = keys_of(line)
            keys.append(found)
            rows.append(np.full(len(found), row))
            places.append(np.append(np.arange(len(found) - 1), -1).astype(np.int32))
            size += len(found)
            if size >= BATCH:
                yield out()
                keys, rows, places, size = [], [], [], 0
        if size:
            yield out()


def within_one_edit(a: str, b: str) -> bool:
    """Whether at most one character is changed, added or missing; in time of the length."""
    x, y = (np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32) for t in sorted((a, b), key=len))
    if len(y) - len(x) > 1:
        return False
    apart = np.flatnonzero(x != y[: len(x)])
    if not len(apart):
        return True
    first = int(apart[0])
    return np.array_equal(x[first + 1 :], y[first + 1 :]) if len(x) == len(y) else np.array_equal(x[first:], y[first + 1 :])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("mine").to_pylist(), batch.column("other").to_pylist(), strict=True)
        yield batch.filter(pa.array([within_one_edit(a, b) for a, b in pairs], pa.bool_())).select(PLACE)


def _place(alias: str = "") -> Column:
    return F.struct(*(F.col(alias + c) for c in PLACE))


def _equal(left: str, right: str, names: list[str]) -> Column:
    out = F.lit(True)
    for name in names:
        out = out & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return out


def near_lines(documents: DataFrame, first: DataFrame) -> DataFrame:
    """Places of the first occurrence of the lines that have an earlier line one edit away."""
    halves = first.select("a", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.min("a").alias("lo"), F.max("a").alias("hi")).where("lo < hi").select("half")
    able = halves.join(small_side(shared, BROADCAST_ROWS), "half", "left_semi").select("a").distinct()
    places = first.join(small_side(able, BROADCAST_ROWS), "a", "left_semi").select("place.*")
    # At most as many numbers as the document has lines.
    by_document = places.groupBy(*PLACE[:2]).agg(F.collect_list("line_no").alias("numbers"))
    by_document = small_side(stored(by_document, "places"), BROADCAST_ROWS)
    texts = documents.select("doc_id", text_hash(), "text").distinct()
    found = texts.alias("t").join(by_document.alias("p"), _equal("t", "p", PLACE[:2])).select("p.*", split_once("t.text"))
    line = F.transform("numbers", lambda at: F.struct(at.alias("line_no"), F.trim(F.get("lines", at)).alias("line")))
    able = stored(found.select(*PLACE[:2], F.explode(line).alias("l")).select(*PLACE[:2], "l.*"), "lines-with-halves")
    kinds = {f.name: f.dataType.simpleString() for f in able.schema if f.name in PLACE}
    schema = ", ".join(["key bigint", "at int", *(f"{name} {kind}" for name, kind in kinds.items())])
    keyed = able.mapInArrow(_variants, schema)

    own, deleted = F.col("at") < 0, F.col("at") >= 0
    by_key, by_place = Window.partitionBy("key"), Window.partitionBy("key", "at")
    changed = F.when(deleted, F.min(_place()).over(by_place))
    longer = F.when(own, F.min(F.when(deleted, _place())).over(by_key))
    shorter = F.when(deleted, F.min(F.when(own, _place())).over(by_key))
    partner = F.array_min(F.array_compact(F.array(changed, longer, shorter)))
    pairs = (
        keyed.select(*PLACE, partner.alias("partner"))
        .where(F.col("partner") < _place())
        .groupBy(*PLACE)
        .agg(F.min("partner").alias("partner"))
    )
    mine, other = able.alias("m"), able.select(_place().alias("place"), "line").alias("o")
    texts = pairs.alias("p").join(mine, _equal("p", "m", PLACE))
    claimed = texts.join(other, F.col("p.partner").eqNullSafe(F.col("o.place")))
    claimed = claimed.select(*(F.col(f"p.{c}") for c in PLACE), F.col("m.line").alias("mine"), F.col("o.line").alias("other"))
    return claimed.mapInArrow(_verified, ", ".join(f"{name} {kind}" for name, kind in kinds.items()))


def removed_lines(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, th, removed (numbers of lines to remove), of documents that lose a line."""
    lines = stored(lines_of(documents, min_chars), "lines")
    first = stored(
        lines.groupBy("a", "b").agg(
            F.min(_place()).alias("place"), F.max(_place()).alias("last"), F.any_value("halves").alias("halves")
        ),
        "first-lines",
    )
    near = near_lines(documents, first).select(_place().alias("place"), F.lit(True).alias("near"))
    touched = first.alias("f").join(near.alias("n"), F.col("f.place").eqNullSafe(F.col("n.place")), "left")
    again = F.col("f.place") < F.col("f.last")
    touched = touched.where(again | F.col("n.near")).select("f.a", "f.b", "f.place", F.coalesce("n.near", F.lit(False)).alias("near"))
    gone = lines.join(touched, ["a", "b"]).where(F.col("near") | (F.col("place") < _place()))
    return gone.groupBy("doc_id", "th").agg(F.collect_set("line_no").alias("removed"))


def dedup_lines(
    documents: DataFrame, min_chars: int = MIN_CHARS, counts: tuple[str, str] = ("n_lines", "n_removed")
) -> DataFrame:
    """``documents`` with the kept lines as ``text``, and two columns more (long), named by ``counts``.

    Columns of the input with those names are replaced.
    """
    removed = removed_lines(documents, min_chars).alias("r")
    documents = documents.drop(*counts)
    th = free_name(documents, "th")
    d = documents.select("*", F.xxhash64("text").alias(th)).alias("d")
    on = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & F.col(f"d.{th}").eqNullSafe(F.col("r.th"))
    lines, gone = free_name(documents, "lines"), free_name(documents, "removed")
    joined = d.join(removed, on, "left").select("d.*", F.col("r.removed").alias(gone), split_once("d.text").alias(lines))
    numbers = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = F.transform(F.array_except(numbers, gone), lambda at: F.get(lines, at))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    same = [F.col(f"`{c}`") if c != "text" else text.alias("text") for c in documents.columns]
    return joined.select(
        *same,
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias(counts[0]),
        F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).cast("long").alias(counts[1]),
    )


def digest(found: DataFrame) -> DataFrame:
    """The registered query's columns; a null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return found.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.char_length(text).cast("long").alias("kept_chars"),
        F.sha2(text.cast("binary"), 256).alias("kept_sha256"),
    )


#: Pairs within one edit share the first or second half of the shorter line, here as text.
ORACLE = f"""
with raw as (select doc_id, text, unnest(string_split(text, chr(10))) as line,
    generate_subscripts(string_split(text, chr(10)), 1) as line_no from documents),
l as (select doc_id, line_no, trim(line, ' ') as line, length(trim(line, ' ')) as n from raw),
f as (select line, n, min(struct_pack(d := doc_id, i := line_no)) as place from l where n >= {MIN_CHARS} group by line, n),
k as (
  select line, place, unnest([
    'f' || n || left(line, n // 2), 's' || n || right(line, n - n // 2),
    'f' || (n - 1) || left(line, (n - 1) // 2), 's' || (n - 1) || right(line, (n - 1) - (n - 1) // 2)]) as half from f),
near as (
  select distinct x.line from k x join k y on x.half = y.half and x.line <> y.line and y.place < x.place
  where levenshtein(x.line, y.line) <= 1),
j as (
  select l.*, f.place is not null and (near.line is not null or f.place < struct_pack(d := doc_id, i := line_no)) as gone
  from l left join f on l.line = f.line left join near on l.line = near.line),
r as (select raw.doc_id, raw.line_no, raw.line, j.gone from raw join j on raw.doc_id = j.doc_id and raw.line_no = j.line_no),
kept as (
  select doc_id, count(*) as n_lines, count(*) filter (gone) as n_removed,
    coalesce(string_agg(line, chr(10) order by line_no) filter (not gone), '') as text from r group by doc_id)
select d.doc_id, cast(coalesce(k.n_lines, 0) as bigint) as n_lines, cast(coalesce(k.n_removed, 0) as bigint) as n_removed,
  cast(length(coalesce(k.text, '')) as bigint) as kept_chars, sha256(coalesce(k.text, '')) as kept_sha256
from documents d left join kept k on d.doc_id = k.doc_id
"""
