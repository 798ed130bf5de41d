"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from visitline.llm import chat, html_text, imatch, jaccard, langid, merkle, mixing, multi_index, negatives, packing, topk, toxicity, warc
from visitline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _on(name: str, run: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: run(table(spark, sf_dir, name))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_planted(table(spark, sf_dir, "conversations"))
    return chat.read_back(chat.format_conversations(rows))


QUERIES: dict[str, Query] = {
    "op1_topk_search": _on("embeddings", topk.search_report),
    "op2_ngram_jaccard_join": _on("documents", jaccard.near_classes),
    "op3_toxicity": op3_toxicity,
    "op4_html_extraction": _on("pages", html_text.page_texts),
    "op5_chat_formatting": op5_chat_formatting,
    "op6_warc": _on("pages", warc.round_trip),
    "op7_best_fit_packing": _on("documents", packing.packed_documents),
    "op8_mix_sources": _on("documents", mixing.mix_report),
    "op9_language_id": _on("documents", langid.predictions),
    "op10_imatch_fingerprints": _on("documents", imatch.fingerprints),
    "op11_merkle_manifest": _on("documents", merkle.sized_report),
    "op12_hard_negatives": _on("embeddings", negatives.negatives_report),
    "op13_embedding_near_dedup": _on("embeddings", multi_index.near_vectors),
}

#: Operators 2, 3, 4, 7, 9 and 10 can't be expressed in SQL: tests/llm compares them with brute force, round trips or held-out accuracy.
ORACLE_SQL: dict[str, str] = {
    "op1_topk_search": topk.TOPK_SQL,
    "op5_chat_formatting": chat.CHAT_SQL,
    "op6_warc": warc.WARC_SQL,
    "op8_mix_sources": mixing.MIX_SQL.format(documents="documents"),
    "op11_merkle_manifest": merkle.MERKLE_SQL,
    "op12_hard_negatives": negatives.NEGATIVES_SQL,
    "op13_embedding_near_dedup": multi_index.NEAR_SQL,
}
