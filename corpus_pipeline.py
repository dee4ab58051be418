"""The corpus pipeline: from raw documents to token files, one operator per stage."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dockflow.llm.common import discard, read_table, stored
from dockflow.llm.contamination import decontaminated
from dockflow.llm.mixing import mixed_documents
from dockflow.llm.quality import select_quality
from dockflow.llm.similar import keep_one_similar
from dockflow.llm.tokens import encoded


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely good than poor or toxic stay."""
    return select_quality(docs, read_table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity of 0.8 or more) stays."""
    return keep_one_similar(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target weight takes it."""
    return mixed_documents(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as shards and read back."""
    return encoded(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("tokens", tokens_stage),
]

# Models, latent spaces and balanced samples have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; each one's result is written and read again as the next one's input."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir), name)
        discard([before])
    result = STAGES[-1][1](spark, docs, sf_dir)  # reads the shards that it has written, not the documents
    discard([docs])
    return result
