"""Benchmark decontamination: containment search by size-partitioned MinHash sketches.

An item matches a document that holds at least ``threshold`` of the item's distinct word
shingles, wherever they stand; an item with fewer words than a shingle has one, all of them,
and matches where its words stand in a row. Items are partitioned by their number of shingles;
for each class a sketch of k shingles is kept, with k from the class's upper size: of any k
shingles at least one must be in a document that matches, whichever are missing. So a document
that shares no sketch value with an item is left out without a doubt, whatever its length,
and each candidate pair is verified by the item's exact shingles. Any k will do, so the sketch
takes those that fewest documents hold, and of these the least by hash (a MinHash): what many
questions and documents have in common makes no candidates.

The documents' shingles don't move, but for those that an item has too: a bitmap drops the
others. Only candidates' texts are shuffled, each with the list of its items.

Nulls: a null text counts as empty, and empty texts match nothing. Rows without id are searched
as well.
Rows that repeat an id are told apart by their text. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rarespark.llm import words as W
from rarespark.session import cut_lineage

SHINGLE = 5
THRESHOLD = 0.8
#: Items whose shingles a worker keeps.
KEPT_ITEMS = 10_000


def _grams(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every run of ``size`` words."""
    grams = W.gram_hash(words, size)
    at = np.arange(len(grams))
    row = np.searchsorted(first, at, "right") - 1
    inside = at + size <= first[row + 1] if len(at) else at.astype(bool)
    return row[inside], W.mix(grams[inside] + np.uint64(size))


def _distinct_rows(batch: pa.RecordBatch, start: int, row: np.ndarray, grams: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((grams, row))
    row, grams = row[order], grams[order]
    new = np.append(True, (row[1:] != row[:-1]) | (grams[1:] != grams[:-1]))
    at = pa.array(row[new] + start)
    return pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), W.signed(grams[new])], ["id", "key", "gram"])


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct shingle hashes of each item, and their words."""
    for batch in batches:
        data, bounds = W.utf8_buffer(batch.column(2))
        words, first = W.hashed_words(W.LOWERED[data], bounds)
        counts = np.minimum(np.diff(first), SHINGLE)
        for size in range(1, SHINGLE + 1):
            row, grams = _grams(words, first, size)
            mine = counts[row] == size
            if mine.any():
                found = _distinct_rows(batch, 0, row[mine], grams[mine])
                yield found.append_column("words", pa.array(np.full(found.num_rows, size, np.int32)))


def _document_rows(bitmap: np.ndarray, sizes: list[int]):
    """Distinct hashes of each document's runs of words of the given sizes that are in the bitmap."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = W.utf8_buffer(batch.column(2))
            for a, b in W.row_slices(bounds):
                words, first = W.hashed_words(W.LOWERED[data[bounds[a] : bounds[b]]], bounds[a : b + 1] - bounds[a])
                for size in sizes:
                    row, grams = _grams(words, first, size)
                    kept = W.in_bitmap(bitmap, grams)
                    if kept.any():
                        yield _distinct_rows(batch, a, row[kept], grams[kept])

    return rows


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    return df.select(F.col(id_col).cast("bigint").alias("id"), W.text_key(text).alias("key"), text.alias("text"))


def item_sketches(grams: DataFrame, held: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(gram, item_id, item_key)``: the sketch of each item of ``grams (id, key, gram)``, its k
    shingles that fewest documents hold; ``held (gram, docs)`` counts them.

    Sizes between two powers of two share a k, ``u - ceil(threshold * u) + 1`` for the upper
    size u of the class.
    """
    item = Window.partitionBy("id", "key")
    rarest = item.orderBy(F.coalesce("docs", F.lit(0)), "gram")
    ranked = grams.join(held, "gram", "left").select(
        "id", "key", "gram", F.count("*").over(item).alias("size"), F.row_number().over(rarest).alias("rank")
    )
    upper = F.pow(F.lit(2), F.floor(F.log2("size")) + 1) - 1
    k = upper - F.ceil(upper * F.lit(threshold) - 1e-9) + 1
    return ranked.where(F.col("rank") <= k).select("gram", F.col("id").alias("item_id"), F.col("key").alias("item_key"))


def _candidates(bitmap: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.filter(pa.array(W.in_bitmap(bitmap, batch.column(1).to_numpy())))
            if found.num_rows:
                yield found

    return rows


def _item_shingles(text: str) -> set[bytes]:
    words = text.encode().lower().split()
    n = max(1, len(words) - SHINGLE + 1)
    return {b" ".join(words[i : i + SHINGLE]) for i in range(n)} if words else set()


MATCHES = "doc_id bigint, doc_key bigint, item_id bigint, item_key bigint, n_shingles bigint, n_shared bigint"


def _verify(threshold: float):
    """Items that a document does hold, of those it is a candidate for."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles: dict[str, set[bytes]] = {}
        for batch in batches:
            at, found = [], []
            for k in range(batch.num_rows):
                joined = b" " + b" ".join((batch.column(2)[k].as_py() or "").encode().lower().split()) + b" "
                for asked in batch.column(3)[k].as_py():
                    text = asked["item_text"] or ""
                    if text not in shingles:
                        if len(shingles) >= KEPT_ITEMS:
                            shingles.clear()
                        shingles[text] = _item_shingles(text)
                    own = shingles[text]
                    n = sum(b" " + s + b" " in joined for s in own)
                    if own and n >= math.ceil(threshold * len(own) - 1e-9):
                        at.append(k)
                        found.append((asked["item_id"], asked["item_key"], len(own), n))
            if found:
                columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
                rows_ = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows_), batch.column(1).take(rows_), *columns],
                    ["doc_id", "doc_key", "item_id", "item_key", "n_shingles", "n_shared"],
                )

    return rows


def contained_items(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, doc_key, item_id, item_key, n_shingles, n_shared)``: every document and
    item whose containment reaches the threshold; the keys tell repeated ids apart."""
    W.bounded_batches(docs.sparkSession)
    texts, questions = _texts(docs, id_col, text_col), _texts(items, item_col, text_col).dropDuplicates(["id", "key"])
    grams = cut_lineage(questions.mapInArrow(_item_rows, "id bigint, key bigint, gram bigint, words int"), "item-shingles")
    sizes = sorted(r[0] for r in grams.select("words").distinct().collect())  # from 1 to SHINGLE
    probes = texts.mapInArrow(_document_rows(W.bitmap_of(grams, "gram"), sizes), "id bigint, key bigint, gram bigint")
    # what the bitmap lets through by chance goes as well
    probes = probes.join(grams.select("gram").distinct(), "gram", "left_semi")
    # A row that repeats id and text would only repeat its pairs.
    probes = cut_lineage(probes, "probes")
    held = probes.groupBy("gram").agg(F.count("*").alias("docs"))
    sketches = item_sketches(grams, held, threshold)
    pairs = cut_lineage(probes.join(sketches, "gram").select("id", "key", "item_id", "item_key").distinct(), "pairs")
    named = questions.select(F.col("id").alias("q_id"), F.col("key").alias("q_key"), F.col("text").alias("item_text"))
    asked = pairs.join(named, F.col("item_id").eqNullSafe(F.col("q_id")) & (F.col("item_key") == F.col("q_key")))
    asked = asked.groupBy("id", "key").agg(F.collect_list(F.struct("item_id", "item_key", "item_text")).alias("asked"))
    found = texts.mapInArrow(_candidates(W.bitmap_of(pairs, "key")), texts.schema).select(
        F.col("id").alias("doc_id"), F.col("key").alias("doc_key"), F.col("text").alias("doc_text")
    )
    joined = asked.join(
        found.dropDuplicates(["doc_id", "doc_key"]), F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("doc_key"))
    )
    return joined.select("doc_id", "doc_key", "doc_text", "asked").mapInArrow(_verify(threshold), MATCHES)


def containment_pairs(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, item_id, n_shingles, n_shared)`` of every match."""
    return contained_items(docs, items, threshold).select("doc_id", "item_id", "n_shingles", "n_shared")


def remove_contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without those that hold a benchmark item; all columns and other texts stay."""
    names = docs.columns
    found = contained_items(docs, items, threshold, id_col, text_col=text_col)
    gone = found.select(F.col("doc_id").alias("__id"), F.col("doc_key").alias("__key"))
    match = F.col(id_col).cast("bigint").eqNullSafe(F.col("__id")) & (W.text_key(F.col(text_col)) == F.col("__key"))
    return docs.join(gone, match, "left_anti").select(*names)
