"""The registered queries: each applies one operator to its whole intended table."""

from __future__ import annotations

from . import byte_bpe, decontamination, embedding_dedup, html_extraction, language_id, lm_scoring, merkle, ngram_join, packing, periodic_runs, secrets, toxicity, url_filter
from .common import table


def op1_language_id(spark, sf_dir):
    return language_id.report(table(spark, sf_dir, "documents"))


def op2_lm_scoring(spark, sf_dir):
    return lm_scoring.report(table(spark, sf_dir, "documents"))


def op3_secrets(spark, sf_dir):
    return secrets.report(table(spark, sf_dir, "documents"))


def op4_ngram_join(spark, sf_dir):
    return ngram_join.report(table(spark, sf_dir, "documents"))


def op5_decontamination(spark, sf_dir):
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_embedding_dedup(spark, sf_dir):
    return embedding_dedup.report(table(spark, sf_dir, "embeddings"))


def op7_toxicity(spark, sf_dir):
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_url_filter(spark, sf_dir):
    return url_filter.report(table(spark, sf_dir, "pages"))


def op9_html_extraction(spark, sf_dir):
    return html_extraction.report(table(spark, sf_dir, "pages"))


def op10_packing(spark, sf_dir):
    return packing.report(table(spark, sf_dir, "documents"))


def op11_byte_bpe(spark, sf_dir):
    return byte_bpe.report(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark, sf_dir):
    return periodic_runs.report(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark, sf_dir):
    return merkle.report(table(spark, sf_dir, "documents"))


LLM_QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_lm_scoring,
        op3_secrets,
        op4_ngram_join,
        op5_decontamination,
        op6_embedding_dedup,
        op7_toxicity,
        op8_url_filter,
        op9_html_extraction,
        op10_packing,
        op11_byte_bpe,
        op12_periodic_runs,
        op13_merkle_manifest,
    )
}
