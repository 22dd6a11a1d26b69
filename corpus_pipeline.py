"""From raw documents to packed training sequences, one operator after the other.

Each stage takes the documents its predecessor kept and returns them filtered or cut; the
last one returns the packed pieces. ``run`` writes every stage to the shared folder and
reads it back, so a lost executor costs one stage at most.

Nulls, empty texts, repeated rows and further columns are treated as the stages' operators
say; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rarespark.llm import decontaminate, packing, simhash_dedup, substring_dedup, toxicity
from rarespark.session import cut_lineage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.remove_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id."""
    return simhash_dedup.one_per_class(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut from the text; ``n_chars`` follows."""
    return substring_dedup.remove_duplicate_spans(docs, length_col="n_chars")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with the sequence and the offset where each lies."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: The classifier and the tokenizer can't be written in SQL; the stages have tests instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
