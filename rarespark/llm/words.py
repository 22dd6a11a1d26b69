"""Words, word sequences and their hashes, computed on Arrow text buffers.

A word is a run of bytes other than ``\\x20`` and ``\\x09-\\x0D``. A whole column is hashed
with array arithmetic, a quarter of a megabyte at a time, so memory follows the longest text and
not the batch. Hashes are 64-bit; they depend on the words alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SLICE_BYTES = 1 << 18
BATCH_BYTES = 8 << 20
#: Bits of a bitmap for each key, and the least and most of them: 64 MB in a worker.
KEY_BITS = 6
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 29

# Odd multipliers of the rolling hashes and the finaliser's constants.
BYTE_STEP = 0x9E3779B97F4A7C15
WORD_STEP = 0xC2B2AE3D27D4EB4F
MIX_1 = np.uint64(0xFF51AFD7ED558CCD)
MIX_2 = np.uint64(0xC4CEB9FE1A85EC53)
MIX_SHIFT = np.uint64(33)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches are cut by bytes too, so long texts don't fill a worker's memory."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key, str(2**31 - 1))) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def utf8_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes, and the offsets of its rows in them. Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def row_slices(bounds: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows with at most ``limit`` bytes; a longer row stands alone."""
    row, rows = 0, len(bounds) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + limit, "right")) - 1)
        yield row, end
        row = end


def _powers(step: int):
    table = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
    steps = {"up": np.uint64(step), "down": np.uint64(pow(step, -1, 1 << 64))}

    def get(kind: str, n: int) -> np.ndarray:
        if len(table[kind]) < n:
            size = 1 << (n - 1).bit_length()
            grown = np.full(size, steps[kind], np.uint64)
            grown[0] = 1
            table[kind] = np.multiply.accumulate(grown)
        return table[kind][:n]

    return get


_byte_power, _word_power = _powers(BYTE_STEP), _powers(WORD_STEP)


def signed(x: np.ndarray) -> pa.Array:
    """Unsigned hashes as Spark's longs."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> MIX_SHIFT)) * MIX_1
    x = (x ^ (x >> MIX_SHIFT)) * MIX_2
    return x ^ (x >> MIX_SHIFT)


def _range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, power) -> np.ndarray:
    """Hash of ``values[s:e]`` for each range, from one running sum."""
    n = len(values)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * power("up", n), out=total[1:])
    found = (total[ends] - total[starts]) * power("down", n + 1)[starts]
    return mix(found + (ends - starts).astype(np.uint64) * MIX_1)


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte ranges ``starts, ends`` of all words, and each row's first word (one more at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    inside = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte range; the running sums cover a slice at a time."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE_BYTES, "right")))
        a, b = starts[i], ends[j - 1]
        values = data[a:b].astype(np.uint64) + np.uint64(1)
        out[i:j] = _range_hash(values, starts[i:j] - a, ends[i:j] - a, _byte_power)
        i = j
    return out


def hashed_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and each row's first word."""
    starts, ends, first = word_spans(data, bounds)
    return hash_spans(data, starts, ends), first


def gram_hash(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``words[i:i+size]`` for each i that has so many words."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(WORD_STEP) + words[k : k + n]
    return mix(out)


def sequence_hash(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``words[s:e]`` for ranges of any length."""
    return _range_hash(words, starts, ends, _word_power)


def bitmap_of(keys: DataFrame, key: str, bits: int | None = None) -> np.ndarray:
    """Bitmap of a long column of a written table, of ``KEY_BITS`` for each row.

    It only spares a later join rows that can't match; beyond ``MOST_BITS`` it fills up and
    spares fewer. Spark ORs the bits; at most ``bits / 64`` words reach the driver.
    """
    if bits is None:
        bits = min(max(LEAST_BITS, 1 << (KEY_BITS * keys.count()).bit_length()), MOST_BITS)
    low = F.col(key).bitwiseAND(F.lit(bits - 1))
    found = (
        keys.where(F.col(key).isNotNull())
        .select(F.shiftright(low, 6).alias("word"), F.expr(f"shiftleft(1L, cast(({key} & 63) as int))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    words = np.zeros(bits // 64, np.int64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy()
    return words.view(np.uint64)


def in_bitmap(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    low = keys.astype(np.uint64) & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[low >> np.uint64(6)] >> (low & np.uint64(63)) & np.uint64(1)).astype(bool)


def text_key(text: Column) -> Column:
    """Tells rows apart that share an id but not a text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))
