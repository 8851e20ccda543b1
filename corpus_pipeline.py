"""The corpus pipeline: from all documents to packed training sequences, each stage one operator on what the last kept.

Defined cases, for every stage: a null ``doc_id`` or text is a row like any (a null text counts as empty and stays null);
equal rows are one document where one of a group stays, and rows of their own elsewhere; texts of any length are worked on
whole; all stages but the last return the columns of ``documents`` as they came, whatever their names; without documents, or
without labels or benchmark items, a stage returns what is left to return.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablekeep.llm import decontaminate, packing, quality, secrets, simhash
from tablekeep.llm.common import table
from tablekeep.llm.queries import BYTE_BPE
from tablekeep.session import Workspace


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Without labels nothing can be learned: the prior alone decides for all."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), Workspace(spark))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one of the smallest ``doc_id`` (null last; ties: by the text's
    digest; of equal rows, one). Empty texts are copies of each other."""
    return simhash.one_of_each(docs, Workspace(spark))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go, with all rows of their id and text. An empty benchmark takes none."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), Workspace(spark))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are taken out of the texts; all documents stay, and ``n_chars`` follows the new text."""
    return secrets.redact(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their ids and their places in sequences of 2048 tokens; an empty text is its closing id alone."""
    return packing.pack(docs, BYTE_BPE, Workspace(spark))


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("packing", sequence_packing),
]

# The classifier, the hashes and the tokenizer are beyond SQL; tests/llm holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``. Each result is written to the shared folder and read again by the next stage."""
    ws = Workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        path = ws.path(f"stage_{number}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
