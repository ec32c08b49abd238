"""Training-corpus pipeline: rules, near copies, benchmark passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before kept. All but the last return the columns of docs; the last returns the
packed pieces. docs must read the same rows each time, as a table does: run()
writes every stage's result to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bunchflow.llm.decontamination import decontaminated
from bunchflow.llm.jaccard import deduplicated
from bunchflow.llm.packing import packed, pieces
from bunchflow.llm.quality import accepted
from bunchflow.llm.secrets import redacted
from bunchflow.llm.tasks import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return accepted(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, Jaccard 0.8 or more."""
    return deduplicated(docs, k=5, num=80, den=100)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of the benchmark that they hold."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret replaced by its kind."""
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of at most 1024 tokens."""
    return packed(pieces(docs))[0]


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_passages),
    ("secret scans", secret_scans),
    ("best-fit packing", packing),
]

#: Near copies, learned automata and token ids have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
