"""Toxicity scores from a linear classifier over character n-grams.

Texts become sets of hashed 3- to 5-grams of lower-cased characters. From labelled texts
each n-gram gets its naive Bayes log-count ratio; the n-grams whose ratio says something
are the features, each scaled by its ratio, of a logistic regression fitted with Spark ML.
Scoring sums the weights of the features a whole text contains.

The model learns from at most ``SAMPLE`` labelled rows, those with the least hash of their
id, so the fit takes the same memory at any size; the rows whose ``crc32`` of the id leaves
0 modulo ``FOLDS`` are never learned from. A model is a table of ``BUCKETS`` weights.

Nulls: a null text counts as empty and gets the score of a text without features. Labels
that are null or belong to no document are not learned from; without positive and negative
rows every score is the share of positives, or 0. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, functions as F

from rarespark.llm import words as W
from rarespark.session import cut_lineage

SIZES = (3, 4, 5)
BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
SAMPLE = 12_000
FOLDS = 5
LEAST_TEXTS = 4
LEAST_RATIO = 1.0
FEATURES = 1 << 14
SMOOTHING = 1.0
PENALTY = 0.001
ROUNDS = 60


@dataclass
class Model:
    weights: np.ndarray
    intercept: float


def _characters(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case (basic Latin and Latin-1), and the row of each."""
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4").astype(np.uint64)
    upper = ((codes >= 65) & (codes <= 90)) | ((codes >= 192) & (codes <= 222) & (codes != 215))
    codes[upper] += np.uint64(32)
    begun = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=begun[1:])
    return codes, np.repeat(np.arange(len(bounds) - 1, dtype=np.int64), np.diff(begun[bounds]))


def _features(data: np.ndarray, bounds: np.ndarray, active: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of the distinct n-grams of each row, those in ``active`` only."""
    codes, row = _characters(data, bounds)
    found = []
    for size in SIZES:
        n = len(codes) - size + 1
        if n <= 0:
            continue
        bucket = (W.gram_hash(codes + np.uint64(size << 32), size) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        inside = row[size - 1 :] == row[:n]
        if active is not None:
            inside &= active[bucket]
        at = np.flatnonzero(inside)
        found.append((row[at] << BUCKET_BITS) | bucket[at])
    both = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return both >> BUCKET_BITS, both & (BUCKETS - 1)


def _slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, bounds = W.utf8_buffer(column)
    for a, b in W.row_slices(bounds):
        yield a, b, data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of either label that hold each bucket, summed over the task's rows."""
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        labels = batch.column(0).to_numpy()
        for a, b, data, bounds in _slices(batch.column(1)):
            row, bucket = _features(data, bounds, None)
            for label in (0, 1):
                counts[label] += np.bincount(bucket[labels[a:b][row] == label], minlength=BUCKETS)
    held = np.flatnonzero(counts.sum(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[0, held]), pa.array(counts[1, held])], ["bucket", "neg", "pos"])


def _feature_rows(active: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(0)
            for a, b, data, bounds in _slices(batch.column(1)):
                row, bucket = _features(data, bounds, active)
                offsets = np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32)
                terms = pa.ListArray.from_arrays(pa.array(offsets), pa.array(bucket).cast(pa.string()))
                yield pa.RecordBatch.from_arrays([labels.slice(a, b - a), terms], ["label", "terms"])

    return rows


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``(label, text)`` of at most ``sample`` labelled rows outside the held-out fold."""
    known = labels.select(F.col(id_col).cast("bigint").alias("id"), F.col("toxic").cast("int").alias("label"))
    known = known.where("id is not null and label in (0, 1)").where(~is_held_out(F.col("id")))
    chosen = known.orderBy(F.xxhash64("id"), "id", "label").limit(sample)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text")).dropna(subset=["doc"])
    return texts.join(F.broadcast(chosen), F.col("doc") == F.col("id")).select("label", "text")


def fit(rows: DataFrame) -> Model:
    """Classifier from ``rows (label, text)``."""
    W.bounded_batches(rows.sparkSession)
    rows = cut_lineage(rows.repartition(8), "labelled")
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_pos, n_neg = totals.get(1, 0), totals.get(0, 0)
    weights = np.zeros(BUCKETS)
    if not n_pos or not n_neg:
        return Model(weights, 40.0 if n_pos else -40.0)
    counted = rows.mapInArrow(_count_rows, "bucket bigint, neg bigint, pos bigint")
    counts = counted.groupBy("bucket").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")).toArrow()  # BUCKETS rows at most
    bucket, neg, pos = (counts[c].to_numpy() for c in ("bucket", "neg", "pos"))
    ratio = np.log((pos + SMOOTHING) / (n_pos + 2 * SMOOTHING)) - np.log((neg + SMOOTHING) / (n_neg + 2 * SMOOTHING))
    telling = np.flatnonzero((np.abs(ratio) >= LEAST_RATIO) & (pos + neg >= LEAST_TEXTS))
    # Of more features than the limit, those with the largest ratio over its standard error.
    strength = np.abs(ratio[telling]) / np.sqrt(1 / (pos[telling] + SMOOTHING) + 1 / (neg[telling] + SMOOTHING))
    telling = telling[np.lexsort((bucket[telling], -strength))[:FEATURES]]
    telling = telling[np.argsort(bucket[telling])]
    if not len(telling):
        return Model(weights, float(np.log(n_pos / n_neg)))
    active = np.zeros(BUCKETS, dtype=bool)
    active[bucket[telling]] = True
    terms = cut_lineage(rows.mapInArrow(_feature_rows(active), "label int, terms array<string>"), "features")
    names = [str(b) for b in bucket[telling]]
    counter = CountVectorizerModel.from_vocabulary(names, inputCol="terms", outputCol="present", binary=True)
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(ratio[telling]), inputCol="present", outputCol="scaled")
    learner = LogisticRegression(
        featuresCol="scaled", labelCol="label", regParam=PENALTY, elasticNetParam=0.0, standardization=False, maxIter=ROUNDS
    )
    fitted = learner.fit(scaled.transform(counter.transform(terms)).select("label", "scaled"))
    weights[bucket[telling]] = fitted.coefficients.toArray() * ratio[telling]
    return Model(weights, float(fitted.intercept))


def _margins(column: pa.Array, model: Model, active: np.ndarray) -> np.ndarray:
    """Log-odds of each text."""
    margin = np.full(len(column), model.intercept)
    for a, b, data, bounds in _slices(column):
        row, bucket = _features(data, bounds, active)
        margin[a:b] += np.bincount(row, weights=model.weights[bucket], minlength=b - a)
    return margin


def _score_rows(model: Model):
    active = model.weights != 0

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = _margins(batch.column(1), model, active)
            score = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(score)], ["doc_id", "key", "score"])

    return rows


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, key, score)`` of every row; ``key`` tells texts under one id apart."""
    W.bounded_batches(docs.sparkSession)
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), W.text_key(F.col(text_col)).alias("key")
    )
    return texts.mapInArrow(_score_rows(model), "doc_id bigint, key bigint, score double")


def score_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: whether it was held out, its score and the predicted label."""
    found = scores(docs, fit(training_rows(docs, labels)))
    held_out = F.coalesce(is_held_out(F.col("doc_id")), F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def remove_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without those scored at or above the threshold; all columns stay."""
    model = fit(training_rows(docs, labels, id_col, text_col))
    active = model.weights != 0
    most = np.log(threshold / (1 - threshold))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_margins(batch.column(batch.schema.get_field_index(text_col)), model, active) < most))

    return docs.mapInArrow(kept, docs.schema)
