"""Corpus pipeline: toxicity, near-duplicate join, decontamination, secret scan, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all
but the last return the columns of ``documents``.  A stage's result is written as Parquet
in the shared checkpoint folder and read again as the next stage's input."""

from __future__ import annotations

from logmetrics.llm import decontamination, ngram_join, packing, secrets, toxicity
from logmetrics.llm.common import store, table


def drop_toxic(spark, docs, sf_dir):
    """Documents that score as toxic go."""
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def drop_similar(spark, docs, sf_dir):
    """One document of each group of similar ones stays: that with the least id."""
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark, docs, sf_dir):
    """Documents that hold a passage of the benchmark go."""
    return decontamination.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark, docs, sf_dir):
    """Every document stays; its secrets are replaced by a mark."""
    return secrets.redact(docs)


def pack(spark, docs, sf_dir):
    """What is left becomes sequences: one row per piece, as op10 returns."""
    return packing.report(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_similar),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack),
]

#: Learned scores, signatures and a tokenizer: no SQL; tested against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = store(docs, "stage")
    return docs
