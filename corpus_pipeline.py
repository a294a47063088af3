"""Documents made ready for training: quality, line dedup, near duplicates, decontamination, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the one before has kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.durable import ensure_local_folder, remove, scope
from daygrid.llm import bpe_transducer, line_dedup, mil_quality, minhash_join, positional_index
from daygrid.llm.common import free_name, shared_folder, stored, table


def _kept(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id and text hash (``th``) are among the chosen."""
    th = free_name(docs, "th")
    d = docs.select(*(F.col(f"`{c}`") for c in docs.columns), F.xxhash64("text").alias(th)).alias("d")
    on = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & F.col(f"d.{th}").eqNullSafe(F.col("c.th"))
    return d.join(chosen.select("doc_id", "th").distinct().alias("c"), on, "left_semi")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; all of them if there are no labels to learn from."""
    ensure_local_folder(spark)
    model = mil_quality.train(docs, table(spark, sf_dir, "labels"))
    return docs if model is None else mil_quality.accepted(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line repeats; one that has lost all its lines goes."""
    ensure_local_folder(spark)
    n_lines, n_removed = free_name(docs, "n_lines"), free_name(docs, "n_removed")
    found = line_dedup.dedup_lines(docs, counts=(n_lines, n_removed))
    emptied = (F.col(n_removed) > 0) & (F.col(n_removed) >= F.col(n_lines))
    kept = found.where(~emptied)
    size = F.when(F.col(n_removed) > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.select(*(size.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class the document with the least id, of its copies one row; documents without words all stay."""
    ensure_local_folder(spark)
    classes = stored(minhash_join.jaccard_classes(docs), "classes")
    grouped = classes.where("class_key is not null").groupBy("class_key")
    heads = grouped.agg(F.min(F.struct("doc_id", "th")).alias("head")).select("head.*")
    apart = classes.where("class_key is null").select("doc_id", "th")
    th = free_name(docs, "th")
    one = _kept(docs, heads).dropDuplicates(["doc_id", th])
    return one.unionByName(_kept(docs, apart)).drop(th)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    ensure_local_folder(spark)
    found = positional_index.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _kept(docs, found.where(~F.col("contaminated"))).drop(free_name(docs, "th"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, hashes of ids and decoded bytes, and the ids."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_transducer.encoded(docs, path, public_tokenizers.PATTERN, True, sizes=(150_000, 120_000), keep=False)


STAGES = [
    ("quality", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("token_ids", token_ids),
]

#: The classifier and the tokenizer are not expressible in SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage wrote on the way goes when its result is written, and that when the next one's is."""
    ensure_local_folder(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        folder = shared_folder(spark, name)
        with scope(spark):
            found = stage(spark, docs, sf_dir)
            found.write.parquet(folder)
        docs = spark.read.schema(found.schema).parquet(folder)
        if before:
            remove(spark, before)
        before = folder
    return STAGES[-1][1](spark, docs, sf_dir)
