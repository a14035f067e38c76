"""Corpus pipeline: five stages over ``documents``, each one of the
training-data operators. A stage gets the rows its predecessor kept and
returns them with its decisions applied; ``run`` writes every stage's result
to the shared folder and reads it back as the next one's input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import anchor_pii, bpe_fst, decontaminate, quality_llr, simhash_ring
from ledgerline.llm.common import materialise, table
from ledgerline.llm.queries import BYTE_BPE, BYTE_BPE_PATTERN


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and the log-likelihood ratio."""
    ratio = quality_llr.fit(docs, table(spark, sf_dir, "labels"))
    return quality_llr.keep(docs, ratio)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of every near-duplicate group."""
    return simhash_ring.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in the text replaced."""
    return anchor_pii.redact(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document: doc_id, n_tokens, digests of ids and of the
    decoded text, and the ids themselves (little-endian unsigned 32-bit)."""
    return bpe_fst.encode_documents(docs, BYTE_BPE, BYTE_BPE_PATTERN, ["doc_id"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("byte-level BPE", byte_bpe),
]

#: XXH64 shingles, the BPE transducer and the hashed log ratio are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {}
