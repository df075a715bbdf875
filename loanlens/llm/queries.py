"""Queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from loanlens.llm import (hard_negatives, language_id, lattice_dedup, lexical_search, line_align, minhash_dedup, mixing,
                          packing, pu_quality, quality_rules, token_files, topk_search, toxicity)
from loanlens.llm.storage import read_table, ship_package


def _table(spark, sf_dir, name):
    ship_package(spark)
    return read_table(spark, sf_dir, name)


def op1_token_files(spark, sf_dir):
    return token_files.token_digest(spark, _table(spark, sf_dir, "documents"))


def op2_minhash_dedup(spark, sf_dir):
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_mixing(spark, sf_dir):
    return mixing.mixing_digest(spark, _table(spark, sf_dir, "documents"))


def op4_line_align(spark, sf_dir):
    return line_align.line_dedup_digest(_table(spark, sf_dir, "documents"))


def op5_pu_quality(spark, sf_dir):
    return pu_quality.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_packing(spark, sf_dir):
    return packing.packing_digest(spark, _table(spark, sf_dir, "documents"))


def op7_lattice_dedup(spark, sf_dir):
    return lattice_dedup.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark, sf_dir):
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return language_id.identify_languages(docs, language_id.fit_language_model(docs))


def op10_topk_search(spark, sf_dir):
    return topk_search.top_k_digest(_table(spark, sf_dir, "embeddings"))


def op11_hard_negatives(spark, sf_dir):
    return hard_negatives.hard_negative_digest(_table(spark, sf_dir, "embeddings"))


def op12_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules_digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_lexical_search(spark, sf_dir):
    return lexical_search.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_token_files, op2_minhash_dedup, op3_mixing, op4_line_align, op5_pu_quality, op6_packing, op7_lattice_dedup,
    op8_toxicity, op9_language_id, op10_topk_search, op11_hard_negatives, op12_quality_rules,
    op13_lexical_search)}
ORACLE: dict[str, str] = {"op3_mixing": mixing.ORACLE_SQL, "op10_topk_search": topk_search.ORACLE_SQL,
                          "op11_hard_negatives": hard_negatives.ORACLE_SQL,
                          "op13_lexical_search": lexical_search.ORACLE_SQL}
