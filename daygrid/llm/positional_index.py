"""Benchmark decontamination with a distributed positional inverted index.

The index holds, for each term of the test set, its postings in the training texts: (term, document, position). A test
window (``width`` consecutive words of an item; all words of a shorter item) occurs at position p of a document if each
of its terms has a posting at p plus the term's offset. The lists are intersected from the rarest term on: the rarest
term's list gives candidates, the second-rarest list prunes them, and what is left meets the other lists.

Terms are lower-cased (A-Z only) runs of ASCII letters, digits and non-ASCII characters. Terms and texts are told apart
by 64-bit hashes. Defined results: a null or wordless text has no words and no hits; a null or wordless item no windows;
repeated rows of a document each get the same result; an item without an id hits but is not counted; equal ids with different texts are different documents; null ids
are kept; an empty test set hits nothing. Other columns of the inputs are ignored. All steps are DataFrame operations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrid.llm.common import lower_ascii, small_side, stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WIDTH = 10
#: Rows of a table small enough for a broadcast (a few dozen bytes each); larger ones are shuffled.
BROADCAST_ROWS = 500_000

#: Stands behind the last word of each text, so its position is the number of words. No word holds this character.
END = "\x00"
DOC = ["doc_id", "th"]


def words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    out = F.lit(True)
    for name in names:
        out = out & left[name].eqNullSafe(right[name])
    return out


@dataclass
class Windows:
    """``terms``: wid, size, offset, term; ``items``: wid, item_id."""

    terms: DataFrame
    items: DataFrame


def test_windows(benchmark: DataFrame, width: int = WIDTH) -> Windows:
    """All windows of all items; equal windows of different items are one window."""
    listed = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - F.lit(width), F.lit(0)))
    cut = (
        listed.where(F.size("w") > 0)
        .select("item_id", "w", F.explode(starts).alias("s"))
        .select("item_id", F.slice("w", F.col("s") + 1, F.lit(width)).alias("w"))
        .withColumn("wid", F.xxhash64(F.array_join("w", " ")))
        .distinct()
    )
    cut = stored(cut, "test-windows")
    terms = (
        cut.dropDuplicates(["wid"])
        .select("wid", F.size("w").alias("size"), F.posexplode("w").alias("offset", "word"))
        .withColumn("term", F.xxhash64("word"))
    )
    return Windows(terms, cut.select("wid", "item_id"))


def index(documents: DataFrame, windows: Windows) -> DataFrame:
    """Postings (term, doc_id, th, pos) of the test terms, written as a table; ``th`` is the text's hash.

    The end mark of each text is a term too.
    """
    end = documents.sparkSession.range(1).select(F.lit(END).alias("word"), F.xxhash64(F.lit(END)).alias("term"))
    vocabulary = windows.terms.select("word", "term").distinct().union(end)
    marked = F.array_append(words(F.col("text")), F.lit(END))
    # The hash is taken below the explosion: beside it, the whole text would be hashed for each of its words.
    texts = documents.select("doc_id", F.xxhash64("text").alias("th"), "text")
    listed = texts.select(*DOC, F.posexplode(marked).alias("pos", "word"))
    return stored(listed.join(small_side(vocabulary, BROADCAST_ROWS), "word").select("term", *DOC, "pos"), "postings")


def ranked_terms(postings: DataFrame, windows: Windows) -> DataFrame:
    """``windows.terms`` with ``place`` 1 for a window's rarest term, 2 for the next...

    Windows with a term that has no postings are left out.
    """
    lists = postings.groupBy("term").agg(F.count("*").alias("n"))
    counted = windows.terms.join(lists, "term", "left")
    by_window = Window.partitionBy("wid")
    order = by_window.orderBy("n", "offset")
    return stored(
        counted.withColumn("known", F.count("n").over(by_window))
        .where(F.col("known") == F.col("size"))
        .select("wid", "size", "offset", "term", F.row_number().over(order).alias("place")),
        "ranked-terms",
    )


def phrase_matches(postings: DataFrame, ranked: DataFrame) -> DataFrame:
    """Exact occurrences: doc_id, th, wid, start, size."""

    def listed(place: int) -> DataFrame:
        return ranked.where(F.col("place") == place).select("wid", "size", "offset", "term")

    at = (F.col("pos") - F.col("offset")).alias("start")
    first = postings.join(small_side(listed(1), BROADCAST_ROWS), "term").select(*DOC, "wid", "size", at).where("start >= 0")
    second = small_side(listed(2), BROADCAST_ROWS)
    next_list = postings.join(second, "term").select(*DOC, "wid", at).where("start >= 0").alias("n")
    first = first.distinct().alias("f")
    again = [*DOC, "wid", "start"]
    pairs = first.where("size > 1").alias("f").join(next_list, _same(F_(first, "f"), F_(next_list, "n"), again), "left_semi")
    found = stored(pairs.union(first.where("size = 1")), "candidates")

    short = found.where("size <= 2")
    wanted = (
        found.where("size > 2")
        .join(small_side(ranked.where("place > 2").select("wid", "offset", "term"), BROADCAST_ROWS), "wid")
        .select(*again, "size", "term", (F.col("start") + F.col("offset")).alias("pos"))
    )
    inside = small_side(found.where("size > 2").select(*DOC).distinct(), BROADCAST_ROWS)
    lists = postings.alias("p").join(inside.alias("i"), _same(F_(postings, "p"), F_(inside, "i"), DOC), "left_semi").distinct()
    here = [*DOC, "term", "pos"]
    hits = wanted.alias("w").join(lists.alias("l"), _same(F_(wanted, "w"), F_(lists, "l"), here), "left_semi")
    whole = hits.groupBy(*again, "size").agg(F.count("*").alias("n")).where(F.col("n") == F.col("size") - 2)
    return short.select(*again, "size").unionByName(whole.select(*again, "size"))


class F_:
    """Columns of an aliased side of a join."""

    def __init__(self, df: DataFrame, alias: str):
        self.alias = alias

    def __getitem__(self, name: str) -> Column:
        return F.col(f"{self.alias}.{name}")


def proximity_matches(postings: DataFrame, ranked: DataFrame, span: int) -> DataFrame:
    """Documents with all distinct terms of a window within ``span`` words of its rarest one, in any order.

    Returns doc_id, th, wid and pos, the place of the rarest term.
    """
    terms = ranked.groupBy("wid", "term").agg(F.min("place").alias("place"))
    needed = terms.groupBy("wid").agg(F.count("*").alias("needed"))
    anchors = postings.join(ranked.where("place = 1").select("wid", "term"), "term").select(*DOC, "wid", "pos").distinct()
    wanted = anchors.join(terms.select("wid", "term"), "wid").alias("w")
    near = _same(F_(wanted, "w"), F_(postings, "p"), [*DOC, "term"]) & (F.abs(F.col("p.pos") - F.col("w.pos")) <= span)
    seen = wanted.join(postings.alias("p"), near).select("w.*").distinct()
    counted = seen.groupBy(*DOC, "wid", "pos").agg(F.count("*").alias("n")).join(needed, "wid")
    return counted.where("n = needed").select(*DOC, "wid", "pos")


def decontaminate(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """For each row of ``documents``: doc_id, th (hash of its text), n_words, n_hit, n_items, item_ids, contaminated.

    ``item_ids`` are sorted as strings.
    """
    windows = test_windows(benchmark, width)
    postings = index(documents, windows)
    matches = stored(phrase_matches(postings, ranked_terms(postings, windows)), "matches")

    lengths = (
        postings.where(F.col("term") == F.xxhash64(F.lit(END))).groupBy(*DOC).agg(F.max("pos").cast("long").alias("n_words"))
    )
    # Words covered by the union of the windows: each adds what lies behind the end of those before it.
    spans = matches.select(*DOC, "start", (F.col("start") + F.col("size")).alias("stop")).groupBy(*DOC, "start").agg(
        F.max("stop").alias("stop")
    )
    before = Window.partitionBy(*DOC).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    covered = spans.withColumn("done", F.coalesce(F.max("stop").over(before), F.lit(0)))
    adds = F.greatest(F.col("stop") - F.greatest("start", "done"), F.lit(0))
    hit = covered.groupBy(*DOC).agg(F.sum(adds).alias("n_hit"))
    in_items = (
        matches.select(*DOC, "wid").distinct().join(small_side(windows.items, BROADCAST_ROWS), "wid").select(*DOC, "item_id")
    ).distinct()
    items = in_items.groupBy(*DOC).agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"))

    d = documents.select("doc_id", F.xxhash64("text").alias("th")).alias("d")
    joined = d
    for name, side in (("n", lengths), ("h", hit), ("i", items)):
        joined = joined.join(side.alias(name), _same(F_(d, "d"), F_(side, name), DOC), "left")
    return joined.select(
        "d.doc_id",
        "d.th",
        "n.n_words",
        F.coalesce("h.n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("i.item_ids", F.array())).cast("long").alias("n_items"),
        F.coalesce("i.item_ids", F.array().cast("array<string>")).alias("item_ids"),
        (F.coalesce("h.n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def digest(found: DataFrame) -> DataFrame:
    """The registered query's columns."""
    joined = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", joined, "contaminated")


ORACLE = rf"""
with d as (
  select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as w
  from documents),
i as (
  select cast(item_id as varchar) as item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as w
  from benchmark),
iw as (
  select distinct item_id, array_to_string(w[s:least(s + {WIDTH - 1}, len(w))], ' ') as p, least(len(w), {WIDTH}) as size
  from (select item_id, w, unnest(range(1, greatest(len(w) - {WIDTH}, 0) + 2)) as s from i where len(w) > 0) t),
sizes as (select distinct size from iw),
dw as (
  select r, s, size, array_to_string(w[s:s + size - 1], ' ') as p
  from (select r, w, size, unnest(range(1, len(w) - size + 2)) as s from d, sizes where len(w) >= size) t),
m as (select r, s, dw.size, item_id from dw join iw using (p, size)),
h as (select r, count(distinct q) as n_hit from (select r, unnest(range(s, s + size)) as q from m) t group by r),
n as (
  select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct r, item_id from m) t group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from d left join h using (r) left join n using (r)
"""
