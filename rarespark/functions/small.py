"""Broadcasts guarded by a check of their size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

SMALL_BYTES = 8 << 20
TEXT_BYTES = 256


def row_bytes(kind: DataType) -> int:
    """About the bytes of a value in memory; texts and arrays count as ``TEXT_BYTES``."""
    if isinstance(kind, StructType):
        return 16 + sum(row_bytes(f.dataType) for f in kind.fields)
    return TEXT_BYTES if isinstance(kind, (StringType, BinaryType, ArrayType, MapType)) else 8


def fetch_if_small(df: DataFrame, limit: int = SMALL_BYTES) -> tuple[DataFrame, bool]:
    """Local copy of ``df`` and True if it has at most about ``limit`` bytes, else ``df`` and False.

    One bounded fetch measures the table, for tables of a few rows per bucket or column.
    """
    rows = limit // row_bytes(df.schema)
    found = df.limit(rows + 1).collect()
    if len(found) > rows:
        return df, False
    return df.sparkSession.createDataFrame(found, df.schema), True


def hint(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def broadcast_if_small(df: DataFrame, limit: int = SMALL_BYTES) -> DataFrame:
    """``df`` as a broadcast table if it is small. Beyond the limit it comes back
    unhinted, and the join that uses it shuffles both sides."""
    return hint(*fetch_if_small(df, limit))
