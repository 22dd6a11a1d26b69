"""Isotonic regression of any number of scores, for many groups at once.

Pool-adjacent-violators is run where the scores lie: inside ranges of the score first, then
over the blocks that the ranges still disagree on. A block is settled as soon as all blocks
to its left are lower and all to its right are higher: nothing can be pooled across it. The
map is a table of blocks; neither scores nor blocks come to the driver, unless the map is
small enough to be sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rarespark.functions.ranks import BROADCAST_BYTES, bucket_count, bucketed, cut_points, join_on_values
from rarespark.functions.small import broadcast_if_small
from rarespark.session import cut_lineage, stage_bytes

#: Open blocks that one task merges; more are merged in groups of neighbouring ranges first.
OPEN_BLOCKS = 1_000_000
FAN_IN = 8


@dataclass(frozen=True)
class IsotonicMap:
    """Blocks ``(by..., part, lo, hi, fit)``; constant from ``lo`` to ``hi``, linear between
    blocks, constant beyond the first and the last. ``cuts`` bound the parts."""

    blocks: DataFrame
    by: tuple[str, ...]
    cuts: tuple[float, ...]


def pooled(total: Sequence[int], weight: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """Blocks of pool-adjacent-violators: end positions, sums and weights.

    Means are compared as whole numbers, so the blocks are exact.
    """
    ends: list[int] = []
    sums: list[int] = []
    weights: list[int] = []
    for k, (s, w) in enumerate(zip(total, weight, strict=True), 1):
        while sums and sums[-1] * w >= s * weights[-1]:
            s += sums.pop()
            w += weights.pop()
            ends.pop()
        ends.append(k)
        sums.append(s)
        weights.append(w)
    return ends, sums, weights


def _pool_group(by: Sequence[str]):
    """Blocks of one group's rows ``(by..., part, lo, hi, s, w)``."""

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by("lo")
        ends, sums, weights = pooled(table["s"].to_pylist(), table["w"].to_pylist())
        first, last = pa.array([0, *ends[:-1]]), pa.array([e - 1 for e in ends])
        columns = [table[c].take(first) for c in (*by, "part", "lo")] + [table["hi"].take(last)]
        return pa.table([*columns, pa.array(sums, pa.int64()), pa.array(weights, pa.int64())], [*by, "part", "lo", "hi", "s", "w"])

    return merge


def _pool(blocks: DataFrame, by: Sequence[str]) -> DataFrame:
    return blocks.groupBy(*by, "part").applyInArrow(_pool_group(by), blocks.schema)


def _marked_open(blocks: DataFrame, by: Sequence[str]) -> DataFrame:
    """``blocks`` with ``open``: whether another part may still pool them.

    A part's blocks rise, so its first is its least and its last its greatest.
    """
    mean = F.col("s") / F.col("w")
    ends = blocks.groupBy(*by, "part").agg(F.min(mean).alias("least"), F.max(mean).alias("most"))
    along = Window.partitionBy(*(by or [F.lit(0)])).orderBy("part")  # one row per part
    ends = ends.select(
        *by,
        "part",
        F.max("most").over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("left_most"),
        F.min("least").over(along.rowsBetween(1, Window.unboundedFollowing)).alias("right_least"),
    )
    both = blocks.join(broadcast_if_small(ends), [*by, "part"])
    is_open = F.coalesce(mean <= F.col("left_most"), F.lit(False)) | F.coalesce(mean >= F.col("right_least"), F.lit(False))
    return both.withColumn("open", is_open).drop("left_most", "right_least")


def isotonic_fit(scored: DataFrame, score: str = "proba", by: Sequence[str] = (), target: str = "y") -> IsotonicMap:
    """Monotone map from score to positive share per group ``by``; rows without a score don't count."""
    by = list(by)
    rows = scored.where(F.col(score).isNotNull())
    knots = rows.groupBy(*by, F.col(score).cast("double").alias("lo")).agg(
        F.sum(F.col(target).cast("bigint")).alias("s"), F.count("*").alias("w")
    )
    knots = cut_lineage(knots, "knots")
    cuts = cut_points(knots, "lo", bucket_count(knots))
    names = [*by, "part", "lo", "hi", "s", "w"]
    parts = bucketed(knots, "lo", cuts, "part").withColumn("part", F.col("part").cast("int")).withColumn("hi", F.col("lo"))
    blocks = cut_lineage(_marked_open(cut_lineage(_pool(parts.select(*names), by), "blocks"), by), "blocks")
    settled = [blocks.where("not open").select(*names)]
    width = 1
    while True:
        left = blocks.where("open").select(*names)
        count = left.count()
        if not count:
            break
        # a merged group takes the number of its first range, which only orders the groups
        width = width * FAN_IN if count > OPEN_BLOCKS and width < len(cuts) + 1 else 0
        group = F.floor(F.col("part") / width).cast("int") if width else F.lit(0)
        merged = cut_lineage(_pool(left.withColumn("part", group), by), "blocks")
        if not width:
            settled.append(merged)
            break
        blocks = cut_lineage(_marked_open(merged, by), "blocks")
        blocks = blocks.withColumn("part", F.col("part") * width)
        settled.append(blocks.where("not open").select(*names))
    table = settled[0]
    for more in settled[1:]:
        table = table.unionByName(more)
    placed = bucketed(table.drop("part"), "lo", cuts, "part").withColumn("part", F.col("part").cast("int"))
    found = placed.select(*by, "part", "lo", "hi", (F.col("s") / F.col("w")).alias("fit"))
    return IsotonicMap(cut_lineage(found, "isotonic"), tuple(by), tuple(cuts))


def _interpolated(x: Column, before: Column, after: Column) -> Column:
    """Value at ``x`` between two blocks; ``before`` is the last that starts at ``x`` or lower."""
    share = (x - before["hi"]) / (after["lo"] - before["hi"])
    between = before["fit"] + (after["fit"] - before["fit"]) * share
    return (
        F.when(before.isNull(), after["fit"])
        .when((x <= before["hi"]) | after.isNull(), before["fit"])
        .otherwise(between)
    )


def _apply_small(scored: DataFrame, model: IsotonicMap, score: str, out: str) -> DataFrame:
    """The map's knots go to every task."""
    knots: dict[tuple, list] = {}
    for r in model.blocks.orderBy(*model.by, "lo").collect():
        held = knots.setdefault(tuple(r[c] for c in model.by), ([], []))
        for x in dict.fromkeys((r["lo"], r["hi"])):
            held[0].append(x)
            held[1].append(r["fit"])
    tables = {k: (np.array(x), np.array(y)) for k, (x, y) in knots.items()}

    @F.pandas_udf("double")
    def fitted(x, *keys):
        import pandas as pd

        found = np.full(len(x), np.nan)
        own = pd.DataFrame(dict(enumerate(keys))) if keys else None
        groups = own.groupby(list(own), dropna=False).indices if keys else {(): np.arange(len(x))}
        for key, at in groups.items():
            table = tables.get(key if isinstance(key, tuple) else (key,))
            if table is not None:
                found[at] = np.interp(x.to_numpy()[at], *table)
        return pd.Series(found).where(x.notna())

    return scored.withColumn(out, fitted(F.col(score).cast("double"), *[F.col(c) for c in model.by]))


def _apply_large(scored: DataFrame, model: IsotonicMap, score: str, out: str) -> DataFrame:
    """Distinct scores are placed between the blocks inside each part; the blocks next to a
    part come with a table of one row per part."""
    by = list(model.by)
    asked = scored.where(F.col(score).isNotNull()).groupBy(*by, F.col(score).cast("double").alias("_x")).agg(F.count("*").alias("n"))
    asked = bucketed(asked, "_x", model.cuts, "part").withColumn("part", F.col("part").cast("int"))
    block = F.struct("lo", "hi", "fit")
    blocks = model.blocks.select(*by, "part", F.col("lo").alias("_x"), block.alias("block"), F.lit(None).cast("bigint").alias("n"))
    events = blocks.unionByName(asked.withColumn("block", F.lit(None).cast(blocks.schema["block"].dataType)))
    inside = Window.partitionBy(*by, "part").orderBy("_x", F.col("n").isNotNull())
    upto, after = (inside.rowsBetween(Window.unboundedPreceding, 0), inside.rowsBetween(1, Window.unboundedFollowing))
    near = events.select(
        *by,
        "part",
        "_x",
        "n",
        F.last("block", ignorenulls=True).over(upto).alias("before"),
        F.first("block", ignorenulls=True).over(after).alias("after"),
    ).where("n is not null")
    ends = events.groupBy(*by, "part").agg(F.max("block").alias("last"), F.min("block").alias("first"))
    along = Window.partitionBy(*(by or [F.lit(0)])).orderBy("part")  # one row per part
    around = ends.select(
        *by,
        "part",
        F.max("last").over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("_left"),
        F.min("first").over(along.rowsBetween(1, Window.unboundedFollowing)).alias("_right"),
    )
    joined = near.join(broadcast_if_small(around), [*by, "part"])
    fit = _interpolated(F.col("_x"), F.coalesce("before", "_left"), F.coalesce("after", "_right"))
    table = joined.select(*by, "_x", "n", fit.alias(out))
    with_x = scored.withColumn("_x", F.col(score).cast("double"))
    found = join_on_values(with_x.where("_x is not null"), table, [*by, "_x"]).select(*scored.columns, out)
    return found.unionByName(scored.where(F.col(score).isNull()).withColumn(out, F.lit(None).cast("double")))


def isotonic_apply(scored: DataFrame, model: IsotonicMap, score: str = "proba", out: str = "calibrated") -> DataFrame:
    """``scored`` with the map's value; null without a score, or in a group without a map."""
    if stage_bytes(model.blocks) <= BROADCAST_BYTES:
        return _apply_small(scored, model, score, out)
    return _apply_large(scored, model, score, out)
