"""Exact histogram of encoded lengths, and what it says for every context limit.

Documents are counted by length; all answers come from sums over the histogram, which has
one row per distinct length. The running sums are taken in two steps, inside buckets of
lengths and over the buckets' totals, so no task holds the whole histogram.

Nulls: a null text counts as empty, of length 0. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rarespark.llm import tokens
from rarespark.llm import words as W
from rarespark.session import cut_lineage

BUCKET = 256


def _lengths(path: str | None):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.word_ids(path or tokens.vocabulary()).encode  # found where the task runs
        for batch in batches:
            data, bounds = W.utf8_buffer(batch.column(1))
            sizes = [len(encode(data[a:b].tobytes())) // 4 for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["doc_id", "tokens"])

    return rows


def token_lengths(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, tokens)`` per row."""
    W.bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _lengths(vocabulary), "doc_id bigint, tokens bigint"
    )


def length_histogram(lengths: DataFrame) -> DataFrame:
    """``(tokens, n_docs)``, one row per distinct length."""
    return lengths.groupBy("tokens").agg(F.count("*").alias("n_docs"))


def limit_report(histogram: DataFrame) -> DataFrame:
    """Answers for each context limit at which something changes, the distinct lengths.

    ``n_longer`` documents exceed the limit; ``truncated_tokens`` are left if each is cut
    to it; ``total_tokens`` are there in all; ``quantile`` is the share of documents within
    it. A limit L between two of them, ``limit <= L``, leaves
    ``truncated_tokens + (L - limit) * n_longer``.
    """
    rows = cut_lineage(histogram.withColumn("bucket", F.floor(F.col("tokens") / BUCKET)), "histogram")
    totals = rows.groupBy("bucket").agg(F.sum("n_docs").alias("docs"), F.sum(F.col("n_docs") * F.col("tokens")).alias("weight"))
    above = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    totals = totals.select(
        "bucket",
        F.coalesce(F.sum("docs").over(above), F.lit(0)).alias("docs_above"),
        F.sum("docs").over(everything).alias("all_docs"),
        F.sum("weight").over(everything).alias("all_tokens"),
        F.coalesce(F.sum("weight").over(above), F.lit(0)).alias("weight_above"),
    )
    later = Window.partitionBy("bucket").orderBy(F.desc("tokens")).rowsBetween(Window.unboundedPreceding, -1)
    longer = F.coalesce(F.sum("n_docs").over(later), F.lit(0)) + F.col("docs_above")
    weight = F.coalesce(F.sum(F.col("n_docs") * F.col("tokens")).over(later), F.lit(0)) + F.col("weight_above")
    found = rows.join(totals, "bucket").select("tokens", "n_docs", longer.alias("n_longer"), weight.alias("weight_longer"), "all_docs", "all_tokens")
    return found.select(
        F.col("tokens").alias("context_limit"),
        "n_docs",
        "n_longer",
        F.col("all_tokens").alias("total_tokens"),
        (F.col("all_tokens") - F.col("weight_longer") + F.col("n_longer") * F.col("tokens")).alias("truncated_tokens"),
        (1 - F.col("n_longer") / F.col("all_docs")).alias("quantile"),
    )


def quantile(report: DataFrame, share: float) -> DataFrame:
    """Least limit that holds at least ``share`` of the documents."""
    return report.where(F.col("quantile") >= share).agg(F.min("context_limit").alias("context_limit"))


def truncated_total(report: DataFrame, limit: int) -> DataFrame:
    """Tokens left if every document is cut to ``limit``, from the report alone."""
    below = report.where(F.col("context_limit") <= limit).agg(F.max_by(F.struct("context_limit", "truncated_tokens", "n_longer"), "context_limit").alias("r"))
    first = report.agg(F.sum("n_docs").alias("docs"))
    return below.join(F.broadcast(first)).select(
        F.coalesce(F.col("r.truncated_tokens") + (limit - F.col("r.context_limit")) * F.col("r.n_longer"), F.col("docs") * limit).alias("tokens")
    )
