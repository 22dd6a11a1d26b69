"""Best-fit decreasing packing of tokenized documents into fixed-length sequences.

Only documents longer than a sequence are cut. The packing depends on the lengths alone,
and there are at most ``capacity`` of them: Spark counts the pieces by length, and the
driver runs best-fit decreasing over these counts, many equal pieces at a time. A segment
tree over the remaining capacities finds the tightest open bin that still has room. The
result is a short list of placements (ranks of a length -> bins), whose size does not
depend on the number of documents; Spark then ranks the pieces of each length and joins
them with it. A hot length is ranked in buckets, each with its offset.

Nulls: a null text counts as empty: one piece with the closing id alone. Rows that repeat
an id are packed each on its own. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rarespark.llm import tokens
from rarespark.llm import words as W
from rarespark.session import cut_lineage

CAPACITY = 2048
CLOSING_ID = b"\0\0\0\0"
#: Pieces of one length are ranked in buckets, one for so many rows of the table.
BUCKET_ROWS = 1_000_000
BUCKETS = 64


class OpenBins:
    """Segment tree over remaining capacities: finds the least one that is large enough."""

    def __init__(self, capacity: int):
        self.base = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.base)

    def set(self, room: int, is_open: bool) -> None:
        at = room + self.base
        self.open[at] = is_open
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]

    def tightest(self, length: int) -> int | None:
        """Least open room of at least ``length``."""
        at = length + self.base
        if self.open[at]:
            return length
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.base:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.base
            at //= 2
        return None


def best_fit_decreasing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Placements ``(length, first_rank, end_rank, first_bin, per_bin, offset)``.

    Pieces with ranks ``first_rank <= r < end_rank`` of a length go to the bins from
    ``first_bin`` on, ``per_bin`` to a bin, from ``offset`` inside it. Bins of equal room
    are kept as ranges of numbers, so equal pieces are placed together, exactly as one by
    one: after a piece the same bin is the tightest one as long as the next one fits.
    """
    tree = OpenBins(capacity)
    ranges: dict[int, list[tuple[int, int]]] = {}
    placements, bins = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            ranges.setdefault(room, []).append((first, n))
            tree.set(room, True)

    for length in sorted(counts, reverse=True):
        rank, end = 0, counts[length]
        while rank < end:
            room = tree.tightest(length)
            if room is None:
                room, first, n = capacity, bins, -(-(end - rank) // (capacity // length))
                bins += n
            else:
                first, n = ranges[room].pop()
                if not ranges[room]:
                    tree.set(room, False)
            per_bin = room // length
            whole = min(n, (end - rank) // per_bin)
            if whole:
                placements.append((length, rank, rank + whole * per_bin, first, per_bin, capacity - room))
                put(room - per_bin * length, first, whole)
                rank += whole * per_bin
            some = end - rank
            if whole < n and some < per_bin:
                if some:
                    placements.append((length, rank, end, first + whole, some, capacity - room))
                    put(room - some * length, first + whole, 1)
                    rank = end
                    whole += 1
                put(room, first + whole, n - whole)
    return placements


def _pieces(path: str | None, capacity: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.word_ids(path or tokens.vocabulary()).encode  # found where the task runs
        for batch in batches:
            data, bounds = W.utf8_buffer(batch.column(1))
            row, piece, start, length, crc = [], [], [], [], []
            for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                ids = encode(data[a:b].tobytes()) + CLOSING_ID
                for p, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    row.append(k)
                    piece.append(p)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return rows


def token_pieces(
    docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: the pieces of each document's ids."""
    W.bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _pieces(vocabulary, capacity), "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    rows = cut_lineage(pieces, "pieces")
    # The buckets only split the work; equal rows may swap places, which changes nothing.
    buckets = max(BUCKETS, -(-rows.count() // BUCKET_ROWS))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = cut_lineage(rows.groupBy("length", "bucket").agg(F.count("*").alias("n")), "sizes")
    # The driver gets one row per length, at most ``capacity`` of them.
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    placements = best_fit_decreasing(counts, capacity)
    place_table = spark.createDataFrame(
        placements, "size bigint, first_rank bigint, end_rank bigint, first_bin bigint, per_bin bigint, base bigint"
    )
    along = Window.partitionBy("length").orderBy("bucket")
    before = sizes.select("length", "bucket", (F.sum("n").over(along) - F.col("n")).alias("before"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = rows.withColumn("in_bucket", F.row_number().over(order) - 1).join(before, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("in_bucket") + F.col("before"))
    placed = ranked.join(
        F.broadcast(place_table),
        (F.col("length") == F.col("size")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank")),
    )
    within = F.col("rank") - F.col("first_rank")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first_bin") + F.floor(within / F.col("per_bin"))).cast("bigint").alias("sequence_id"),
        (F.col("base") + within % F.col("per_bin") * F.col("length")).cast("bigint").alias("offset"),
    )


def pack_documents(
    docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of all documents with the sequence and the offset where each lies."""
    return pack_pieces(token_pieces(docs, vocabulary, capacity, id_col, text_col), capacity)
