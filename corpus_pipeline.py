"""The corpus pipeline: quality, near duplicates, decontamination, personal data, mixing.

``run(spark, sf_dir)`` sends all of ``documents`` through ``STAGES``. Every stage is written as Parquet to the shared
folder and read again as the next one's documents, so a lost executor costs one stage at most and no plan grows.

All stages keep extra columns, take null ids as ids and null texts as texts without words, read texts of any length whole,
and give no rows for no documents; repeated rows share their fate, but for the near duplicates, of which one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkweave.llm import decontaminate, mixing, ngram_join, pii, quality_rff
from sparkweave.sources.files import stored
from sparkweave.sources.tables import Tables


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality classifier rejects; null and empty texts are judged as empty ones."""
    return quality_rff.keep_good(docs, Tables(spark, sf_dir).labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (five words, 0.8): the one with the smallest id; texts without words stay."""
    return ngram_join.one_per_component(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain benchmark passages, by the contract's rule; texts without words stay."""
    return decontaminate.decontaminate(docs, Tables(spark, sf_dir).benchmark)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces identifiers and revealing terms in the texts; no document goes, null texts stay null."""
    return pii.sanitise(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, numbered in ``copy``."""
    return mixing.mix_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mix", mix),
]

#: Fitted scores and Newton steps have no SQL form. Tests hold the rows of every stage, by id, against a plain version
#: (of the rule, where the decision follows from a fitted score or a planned number of copies).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed corpus."""
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
