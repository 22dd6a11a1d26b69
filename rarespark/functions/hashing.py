"""Seeded draws that any SQL engine can repeat.

A draw depends on the row id alone, so a lost task recomputes the same rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F

# Knuth's multiplicative constant, the hash range, the fold of wide ids
# and the step between seeds.
MULTIPLIER = 2654435761
SPACE = 4294967296
ID_FOLD = 2147483648
SEED_STEP = 668265263


def seed_shift(seed: int) -> int:
    return (seed * SEED_STEP) % SPACE


def spread(row_id: Column, seed: int = 0) -> Column:
    """Integer in [0, 2**32) from a 64-bit id. Ids wider than 31 bits are folded
    first, so the product never overflows."""
    wide = F.floor(row_id / F.lit(float(ID_FOLD))).cast("bigint")
    low = F.pmod(row_id.cast("bigint"), F.lit(ID_FOLD))
    folded = F.pmod(low + F.pmod(wide, F.lit(ID_FOLD)) * F.lit(31), F.lit(ID_FOLD))
    return F.pmod(folded * F.lit(MULTIPLIER) + F.lit(seed_shift(seed)), F.lit(SPACE))


def uniform(*parts: Column) -> Column:
    """Uniform double in [0, 1) from any key columns."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) / F.lit(float(1 << 30))


# The steps of the published splitmix64 generator.
GOLDEN, MIX_A, MIX_B = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def draws(key: np.ndarray, seed: int, turn: int) -> np.ndarray:
    """Uniform numbers in [0, 1) from 64-bit row keys, the same in any task."""
    x = key.view(np.uint64) + np.uint64(GOLDEN * (seed * 1_000_003 + turn) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)
