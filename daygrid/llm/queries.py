"""Registered queries of this package and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from daygrid.durable import ensure_local_folder, settled
from daygrid.llm import (
    bpe_transducer,
    html_blocks,
    katz,
    kdtree_topk,
    line_dedup,
    mil_quality,
    minhash_join,
    positional_index,
    ppm_language,
    projection_forest,
    repair_ids,
    token_alignment,
    vantage_clusters,
)
from daygrid.llm.common import table


def op1_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = mil_quality.train(documents, table(spark, sf_dir, "labels"))
    return mil_quality.digest(mil_quality.scored(documents, model))


def op2_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return repair_ids.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op3_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.scored(table(spark, sf_dir, "documents"))


def op4_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_blocks.main_text(pages, html_blocks.train(pages))


def op5_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return ppm_language.digest(ppm_language.predicted(documents, ppm_language.learn(documents)))


def op6_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = positional_index.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return positional_index.digest(found)


def op7_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_transducer.encoded(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op8_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.jaccard_classes(table(spark, sf_dir, "documents")).drop("th", "class_key")


def op9_kdtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree_topk.top_k(table(spark, sf_dir, "embeddings"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.dedup_lines(table(spark, sf_dir, "documents")))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.digest(table(spark, sf_dir, "documents"), *paths)


def op12_vantage_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage_clusters.digest(*vantage_clusters.clustered(table(spark, sf_dir, "embeddings")))


def op13_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_forest.nearest(table(spark, sf_dir, "embeddings"))


def _registered(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_local_folder(spark)
        return settled(spark, lambda: query(spark, sf_dir))

    return run


QUERIES = {
    f.__name__: _registered(f)
    for f in (
        op1_mil_quality,
        op2_repair_ids,
        op3_katz,
        op4_html_blocks,
        op5_ppm_language,
        op6_positional_index,
        op7_bpe_transducer,
        op8_minhash_join,
        op9_kdtree_topk,
        op10_line_dedup,
        op11_token_alignment,
        op12_vantage_clusters,
        op13_projection_forest,
    )
}

ORACLES = {
    "op6_positional_index": positional_index.ORACLE,
    "op8_minhash_join": minhash_join.ORACLE,
    "op9_kdtree_topk": kdtree_topk.ORACLE,
    "op10_line_dedup": line_dedup.ORACLE,
    "op12_vantage_clusters": vantage_clusters.ORACLE,
}
