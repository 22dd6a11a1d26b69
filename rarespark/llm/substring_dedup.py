"""Removal of word sequences that an earlier document already has, by relative parsing.

The reference of a document is every document with a smaller id. Its blocks are parts of a
phrase index spread over the cluster by hash. A phrase is the longest run of 13-word
windows that share one anchor, the least 5-word hash inside the window. Equal windows have
equal anchors wherever they stand, so each document falls into the same phrases as its
reference wherever their words agree. A document is parsed greedily: its phrases, the
longest factors, are looked up in all blocks first. Where a phrase is not in the reference
but its anchor is (the boundaries of long factors) each window of the phrase is checked on
its own. So no window is lost, and none of the text of the reference is moved.

Documents are read three times and shuffled once; the index rows (one per five words) are
shuffled once. Anchors that many documents share are aggregated before the shuffle, and
later joins put their rows beside one index row, in splits where a key is hot.

Nulls: a null text has no words. A row without id keeps all its words and is nobody's
reference. Rows that repeat an id are judged each by its own text, against smaller ids only.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, StringType, StructType

from rarespark.llm import words as W
from rarespark.session import cut_lineage

WINDOW = 13
ANCHOR = 5
REACH = WINDOW - ANCHOR + 1


def _phrases(words: np.ndarray, first: np.ndarray):
    """Anchor hash, phrase hash, row, first and last window of each phrase, in row order."""
    n = len(words) - WINDOW + 1
    if n <= 0:
        return None
    grams = W.gram_hash(words, ANCHOR)
    least = grams[:n].copy()
    for k in range(1, REACH):
        np.minimum(least, grams[k : k + n], out=least)
    at = np.zeros(n, np.int64)
    for k in range(REACH - 1, -1, -1):
        at[grams[k : k + n] == least] = k
    at += np.arange(n)
    row = np.searchsorted(first, np.arange(n), "right") - 1
    valid = np.arange(n) + WINDOW <= first[row + 1]
    begins = valid.copy()
    begins[1:] &= (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    starts = np.flatnonzero(begins)
    if not len(starts):
        return None
    closes = valid.copy()
    closes[:-1] &= begins[1:] | ~valid[1:]
    ends = np.flatnonzero(closes)
    return least[starts], W.sequence_hash(words, starts, ends + WINDOW), row[starts], starts, ends


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy()
        data, bounds = W.utf8_buffer(batch.column(1))
        for a, b in W.row_slices(bounds):
            words, first = W.hashed_words(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
            found = _phrases(words, first)
            if found is not None:
                anchor, phrase, row, _, _ = found
                yield pa.RecordBatch.from_arrays(
                    [W.signed(anchor), W.signed(phrase), pa.array(ids[a:b][row])], ["anchor", "phrase", "id"]
                )


def _suspect_rows(shared: np.ndarray, contested: np.ndarray):
    """Phrases whose anchor may be shared; with the hash of each window if it may be contested."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            keys = batch.column(1).to_numpy()
            data, bounds = W.utf8_buffer(batch.column(2))
            for a, b in W.row_slices(bounds):
                words, first = W.hashed_words(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                found = _phrases(words, first)
                if found is None:
                    continue
                kept = np.flatnonzero(W.in_bitmap(shared, found[0]))
                if not len(kept):
                    continue
                anchor, phrase, row, starts, ends = (x[kept] for x in found)
                open_ = W.in_bitmap(contested, anchor)
                sizes = np.where(open_, ends - starts + 1, 0)
                offsets = np.zeros(len(kept) + 1, np.int64)
                np.cumsum(sizes, out=offsets[1:])
                begin = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
                windows = W.sequence_hash(words, begin, begin + WINDOW)
                local = starts - first[row]
                yield pa.RecordBatch.from_arrays(
                    [
                        W.signed(anchor),
                        W.signed(phrase),
                        pa.array(ids[a:b][row]),
                        pa.array(keys[a:b][row]),
                        pa.array(local.astype(np.int32)),
                        pa.array((ends - starts + 1).astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), W.signed(windows)),
                    ],
                    ["anchor", "phrase", "id", "key", "start", "size", "windows"],
                )

    return rows


def duplicate_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, key, spans)``: for each text with duplicates, its removed ranges of words
    ``(start, end)``, unordered and overlapping; ``key`` is ``text_key`` of the text."""
    spark = docs.sparkSession
    W.bounded_batches(spark)
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("id"), W.text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text")
    ).where("id is not null")

    index = texts.select("id", "text").mapInArrow(_index_rows, "anchor bigint, phrase bigint, id bigint")
    anchors = (
        index.groupBy("anchor")
        .agg(
            F.min("id").alias("earliest"),
            F.max("id").alias("latest"),
            F.min("phrase").alias("phrase"),
            F.max("phrase").alias("other"),
        )
        .where("earliest < latest")
        .select("anchor", "earliest", (F.col("phrase") != F.col("other")).alias("contested"))
    )
    anchors = cut_lineage(anchors, "anchors")
    shared = W.bitmap_of(anchors, "anchor")
    contested = W.bitmap_of(anchors.where("contested"), "anchor")

    suspects = texts.mapInArrow(
        _suspect_rows(shared, contested),
        "anchor bigint, phrase bigint, id bigint, key bigint, start int, size int, windows array<bigint>",
    )
    # The earliest holder of an anchor has nothing to remove there, but holds phrases.
    known = suspects.join(anchors, "anchor").where("contested or id > earliest")
    known = cut_lineage(
        known.select(
            "contested", "anchor", "phrase", "id", "key", "start", "size", F.expr("if(contested, windows, null)").alias("windows")
        ),
        "phrases",
    )
    whole = F.struct(F.col("start"), (F.col("start") + F.col("size") + WINDOW - 1).alias("end")).alias("span")
    plain = known.where("not contested").select("id", "key", whole)

    open_ = known.where("contested")
    holders = cut_lineage(open_.groupBy("anchor", "phrase").agg(F.min("id").alias("holder")), "holders")
    judged = open_.join(holders, ["anchor", "phrase"])
    long_factors = judged.where("holder < id").select("id", "key", whole)
    boundary = judged.where("holder = id").select("anchor", "id", "key", "start", F.posexplode("windows").alias("step", "window"))
    boundary = cut_lineage(boundary.select("anchor", "window", "id", "key", (F.col("start") + F.col("step")).alias("start")), "boundary")
    first_window = cut_lineage(
        boundary.groupBy("anchor", "window").agg(F.min("id").alias("holder"), F.max("id").alias("latest")).where("holder < latest").drop("latest"),
        "windows",
    )
    short_factors = (
        boundary.join(first_window, ["anchor", "window"])
        .where("holder < id")
        .select("id", "key", F.struct(F.col("start"), (F.col("start") + WINDOW).alias("end")).alias("span"))
    )
    spans = plain.unionByName(long_factors).unionByName(short_factors)
    return spans.groupBy("id", "key").agg(F.collect_list("span").alias("spans"))


def _covered(n_words: int, spans) -> np.ndarray:
    """True for each word that a span covers."""
    change = np.zeros(n_words + 1, np.int64)
    if spans is not None and len(spans):
        np.add.at(change, spans.field(0).to_numpy(), 1)
        np.add.at(change, spans.field(1).to_numpy(), -1)
    return np.cumsum(change[:-1]) > 0


def _with_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with the column ``__spans``."""
    spans = duplicate_spans(docs, id_col, text_col).select(
        F.col("id").alias("__id"), F.col("key").alias("__key"), F.col("spans").alias("__spans")
    )
    key = (F.col(id_col).cast("bigint") == F.col("__id")) & (W.text_key(F.col(text_col)) == F.col("__key"))
    return docs.join(spans, key, "left").drop("__id", "__key")


def _row_cuts(texts: pa.Array, spans: pa.Array):
    """Bytes, word ranges and covered words of each row."""
    data, bounds = W.utf8_buffer(texts)
    for row in range(len(texts)):
        own = data[bounds[row] : bounds[row + 1]]
        starts, ends, _ = W.word_spans(own, np.array([0, len(own)]))
        yield own, starts, ends, _covered(len(starts), spans[row].values if spans[row].is_valid else None)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, removed, digest = [], [], []
        for own, _, _, covered in _row_cuts(batch.column(1), batch.column(2)):
            kept = own.tobytes().split()
            if covered.any():
                kept = [kept[i] for i in np.flatnonzero(~covered)]
            total.append(len(covered))
            removed.append(int(covered.sum()))
            digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: words, removed words, and the digest of the kept ones joined by a space."""
    found = _with_spans(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text")
    return found.select("doc_id", "text", "__spans").mapInArrow(
        _digests, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    )


def _cut_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("__text"))
        spans = batch.column(batch.schema.get_field_index("__spans"))
        out, changed = [], []
        for row, (own, starts, _, covered) in enumerate(_row_cuts(texts, spans)):
            changed.append(bool(covered.any()))
            if not changed[-1]:
                out.append(texts[row].as_py())
                continue
            # Each word goes with the white space behind it.
            edges = np.append(starts, len(own))
            keep = np.ones(len(own), dtype=bool)
            for i in np.flatnonzero(covered):
                keep[edges[i] : edges[i + 1]] = False
            out.append(own[keep].tobytes().decode("utf-8").rstrip("\t\n\v\f\r "))
        columns = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n not in ("__text", "__spans")]
        names = [n for n in batch.schema.names if n not in ("__text", "__spans")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.string()), pa.array(changed)], [*names, "__cut", "__changed"])


def remove_duplicate_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None
) -> DataFrame:
    """``docs`` with the duplicate words cut from the text; other texts stay as they are.

    All columns are kept; ``length_col``, if it is there, gets the code points of a cut
    text. A document whose words are all duplicates stays with an empty text.
    """
    names = docs.columns
    found = _with_spans(docs, id_col, text_col).withColumnRenamed(text_col, "__text")
    rest = [n for n in names if n != text_col]
    schema = StructType([docs.schema[n] for n in rest]).add("__cut", StringType()).add("__changed", BooleanType())
    cut = found.select(*rest, "__text", "__spans").mapInArrow(_cut_text, schema).withColumnRenamed("__cut", text_col)
    if length_col in rest:
        length = F.when(F.col("__changed"), F.length(text_col)).otherwise(F.col(length_col))
        cut = cut.withColumn(length_col, length.cast(docs.schema[length_col].dataType))
    return cut.select(*names)
