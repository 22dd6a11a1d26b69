"""Running sums, ranks, row numbers and exact quantiles without a one-task sort.

A window with no partition sends every row to one task. Here rows are first cut into
buckets of about equal size along the sort key. Bucket totals are tiny, so their
running sum costs nothing; the rest is a window inside each bucket.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rarespark.functions.hashing import SPACE, spread
from rarespark.functions.small import broadcast_if_small, fetch_if_small, hint
from rarespark.session import cut_lineage, stage_bytes

HOT_SHARE = 1000
#: Counts of buckets that a task holds before it adds them up.
HELD_COUNTS = 1_000_000
#: Size on disk up to which a table of keys is broadcast; in memory it may be ten times that.
BROADCAST_BYTES = 4 << 20


def bucket_count(df: DataFrame) -> int:
    """Buckets that keep every shuffle task busy a few times over."""
    return max(64, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def cut_points(df: DataFrame, key: str, buckets: int) -> list[float]:
    """Approximate quantiles of ``key``: bounds of buckets of about equal size."""
    probs = [i / buckets for i in range(1, buckets)]
    return sorted(set(df.approxQuantile(key, probs, 1.0 / (4 * buckets))))


def splits_of(cuts: Sequence[float]) -> list[float]:
    inner = [c for c in cuts if math.isfinite(c)] or [0.0]
    return [-math.inf, *inner, math.inf]


def bucketed(df: DataFrame, key: str, cuts: Sequence[float], out: str = "_bucket") -> DataFrame:
    return Bucketizer(splits=splits_of(cuts), inputCol=key, outputCol=out).transform(df)


def _running(by: Sequence[str], order: Column):
    return Window.partitionBy(*(by or [F.lit(0)])).orderBy(order)


def running_totals(
    df: DataFrame,
    key: str,
    values: dict[str, str],
    by: Sequence[str] = (),
    descending: bool = False,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Add inclusive running sums along ``key``, which is unique within ``by``.

    ``values`` maps a new column name to the column summed; the whole group's sum is
    added as ``<name>_all``. It comes with the bucket offsets, so no join on ``by``
    alone, whose groups may be huge, is needed.
    """
    by = list(by)
    cuts = cut_points(df, key, bucket_count(df)) if cuts is None else cuts
    cut = bucketed(df, key, cuts)
    direction = F.desc if descending else F.asc
    before = _running(by, direction("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*(by or [F.lit(0)]))
    totals = cut.groupBy(*by, "_bucket").agg(
        *[F.sum(src).alias(f"_t_{out}") for out, src in values.items()]
    )
    offsets = totals.select(
        *by,
        "_bucket",
        *[F.coalesce(F.sum(f"_t_{o}").over(before), F.lit(0)).alias(f"_o_{o}") for o in values],
        *[F.sum(f"_t_{o}").over(whole).alias(f"{o}_all") for o in values],
    )
    here = (
        Window.partitionBy(*by, "_bucket")
        .orderBy(direction(key))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    joined = cut.join(offsets, [*by, "_bucket"])
    for out, src in values.items():
        joined = joined.withColumn(out, F.sum(src).over(here) + F.col(f"_o_{out}"))
    return joined.drop("_bucket", *[f"_o_{o}" for o in values])


def average_ranks(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct value: its count ``n`` and ``rank``, ties averaged."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    counts = cut_lineage(counts, "values")
    summed = running_totals(counts, value, {"_upto": "n"}, by)
    return summed.select(
        *by, value, "n", (F.col("_upto") - (F.col("n") - 1) / F.lit(2.0)).alias("rank")
    )


def join_on_values(rows: DataFrame, table: DataFrame, keys: Sequence[str], n: str = "n") -> DataFrame:
    """Inner join rows to a table of their distinct keys, which counts rows in ``n``.

    A small table is broadcast whole. In a larger one a few keys may own most rows: keys
    above 1/HOT_SHARE of all rows number at most HOT_SHARE, so those are broadcast, and
    every other key is small enough to shuffle.
    """
    keys = list(keys)
    extra = [c for c in table.columns if c not in keys]
    table = cut_lineage(table, "keys")
    if stage_bytes(table) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table), keys).select(*rows.columns, *extra)
    total = table.agg(F.sum(n)).first()[0]
    is_hot = F.col(n) * HOT_SHARE > total
    hot = F.broadcast(table.where(is_hot).withColumn("_seen", F.lit(True)))
    marked = rows.join(hot, keys, "left")
    done = marked.where("_seen").select(*rows.columns, *extra)
    rest = marked.where("_seen is null").select(*rows.columns).join(table.where(~is_hot), keys)
    return done.unionByName(rest.select(*rows.columns, *extra))


def _hash_buckets(df: DataFrame, id_col: str, seed: int, buckets: int) -> DataFrame:
    hashed = df.withColumn("_h", spread(F.col(id_col), seed))
    return hashed.withColumn("_bucket", F.floor(F.col("_h") / F.lit(SPACE / buckets)).cast("int"))


def shuffled_row_number(
    df: DataFrame,
    id_col: str,
    seed: int,
    by: Sequence[str] = (),
    out: str = "rn",
    quota: DataFrame | None = None,
) -> DataFrame:
    """Number rows 1, 2, ... within ``by`` in seeded hash order.

    With ``quota`` (columns ``by`` and ``quota``) only the first ``quota`` rows of each
    group are kept, and later hash buckets are dropped before any row is sorted.
    """
    by = list(by)
    hashed = _hash_buckets(df, id_col, seed, bucket_count(df))
    counts = hashed.groupBy(*by, "_bucket").agg(F.count("*").alias("_c"))
    before = _running(by, F.col("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *by, "_bucket", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off")
    )
    if quota is not None:
        offsets = (
            offsets.join(quota, by) if by else offsets.withColumn("quota", quota.scalar())
        ).where("_off < quota")
    here = Window.partitionBy(*by, "_bucket").orderBy("_h", id_col)
    numbered = hashed.join(broadcast_if_small(offsets), [*by, "_bucket"]).withColumn(
        out, F.row_number().over(here) + F.col("_off")
    )
    if quota is not None:
        numbered = numbered.where(F.col(out) <= F.col("quota")).drop("quota")
    return numbered.drop("_h", "_bucket", "_off")


def unpivoted(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form ``(keep..., feature, value)``."""
    return df.unpivot(list(keep), list(columns), "feature", "value")


def row_sample(df: DataFrame, total: int, rows: int) -> DataFrame:
    """About ``rows`` of ``total`` rows, for bounds that need not be exact."""
    return df if total <= rows else df.sample(rows / total, seed=17)


def _fields(ddl: str) -> list[T.StructField]:
    return T.StructType.fromDDL(ddl).fields


def _count_cells(batches, by: Sequence[str], cuts: Sequence[np.ndarray]):
    """Rows per (by, column, bucket), added up over the batches of a task as far as ``HELD_COUNTS``
    counts: those of one batch may be more than its rows."""
    import pyarrow as pa

    group = [*by, "feature", "_bucket"]
    held, size = [], 0

    def merged() -> pa.Table:
        table = pa.concat_tables(held).group_by(group).aggregate([("_c", "sum")])
        return table.select([*group, "_c_sum"]).rename_columns([*group, "_c"])

    for batch in batches:
        for i, cut in enumerate(cuts):
            column = batch.column(len(by) + i)
            here = column.is_valid()
            bucket = np.searchsorted(cut, column.filter(here).to_numpy(), side="right")
            if not len(bucket):
                continue
            table = pa.table(
                [batch.column(j).filter(here) for j in range(len(by))] + [pa.array(bucket.astype("int32"))],
                names=[*by, "_bucket"],
            )
            counts = table.group_by([*by, "_bucket"]).aggregate([([], "count_all")])
            feature = pa.array(np.full(len(counts), i, dtype="int32"))
            columns = [counts.column(k) for k in by]
            columns += [feature, counts.column("_bucket"), counts.column("count_all")]
            held.append(pa.table(columns, names=[*group, "_c"]))
            size += len(counts)
        if size > HELD_COUNTS:
            held = [merged()]
            size = len(held[0])
            if size > HELD_COUNTS // 2:
                yield from held[0].combine_chunks().to_batches()
                held, size = [], 0
    if held:
        yield from merged().combine_chunks().to_batches()


def _pick_cells(batches, by: Sequence[str], cuts: Sequence[np.ndarray], keep: set | None):
    """Cells whose (column, bucket) is wanted; all cells if ``keep`` is None."""
    import pyarrow as pa

    wanted = [
        np.array([keep is None or (i, b) in keep for b in range(len(cut) + 1)]) for i, cut in enumerate(cuts)
    ]
    for batch in batches:
        for i, cut in enumerate(cuts):
            column = batch.column(len(by) + i)
            if not wanted[i].any() or column.null_count == len(column):
                continue
            values = column.to_numpy(zero_copy_only=False)
            bucket = np.searchsorted(cut, values, side="right")
            mine = wanted[i][bucket] & column.is_valid().to_numpy(zero_copy_only=False)
            rows = pa.array(np.flatnonzero(mine))
            if len(rows):
                columns = [batch.column(j).take(rows) for j in range(len(by))]
                columns += [
                    pa.array(np.full(len(rows), i, dtype="int32")),
                    pa.array(bucket[mine].astype("int32")),
                    pa.array(values[mine]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*by, "feature", "_bucket", "value"])


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    pools: Column | None = None,
) -> DataFrame:
    """Exact interpolated quantiles per column: ``(by..., feature, prob, quantile)``.

    With ``pools``, an array made of the columns ``by``, a row counts in every pool it names, and
    ``pool`` stands in place of ``by``. Rows are still read once: only counts are spread.

    Missing values are ignored. Rows are counted in buckets first. Only buckets that hold
    a wanted rank are then grouped by value, so about ``len(probs) / buckets`` of the data
    is shuffled and no task holds a whole column.
    """
    by, columns = list(by), list(columns)
    total = df.count()
    buckets = bucket_count(df)
    probes = F.expr(f"array({', '.join(f'{i / buckets!r}d' for i in range(1, buckets))})")
    # the cuts decide how even the buckets are, not the result: near quantiles of a sample serve
    part = row_sample(df.select(*columns), total, 150 * buckets)
    near = [F.percentile_approx(F.col(c).cast("double"), probes, 10 * buckets).alias(c) for c in columns]
    found = part.agg(*near).first()
    cuts = [np.unique(np.array(found[c] or [], float)) for c in columns]
    cells = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    keys = [f for f in cells.schema.fields if f.name in by]

    def pooled(rows: DataFrame) -> DataFrame:
        if pools is None:
            return rows
        return rows.withColumn("pool", F.explode(pools)).drop(*by)

    group = [*by, "feature"] if pools is None else ["pool", "feature"]
    parts = cells.mapInArrow(
        lambda batches: _count_cells(batches, by, cuts),
        T.StructType([*keys, *_fields("feature int, _bucket int, _c bigint")]),
    )
    counts = pooled(parts).groupBy(*group, "_bucket").agg(F.sum("_c").alias("_c"))
    whole = Window.partitionBy(*group)
    upto = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    spans = counts.withColumn("_hi", F.sum("_c").over(upto)).withColumn("_n", F.sum("_c").over(whole))
    asked = spans.withColumn(
        "prob", F.explode(F.array(*[F.lit(float(p)) for p in probs]))
    ).withColumn("_pos", (F.col("_n") - 1) * F.col("prob"))
    wanted = (
        asked.withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor("_pos"), F.ceil("_pos")))))
        .withColumn("_off", F.col("_hi") - F.col("_c"))
        .where("_rank >= _off and _rank < _hi")
        .select(*group, "_bucket", "prob", "_pos", "_rank", "_off")
    )
    wanted, small = fetch_if_small(wanted)
    keep = {(r["feature"], r["_bucket"]) for r in wanted.collect()} if small else None
    long = cells.mapInArrow(
        lambda batches: _pick_cells(batches, by, cuts, keep),
        T.StructType([*keys, *_fields("feature int, _bucket int, value double")]),
    )
    chosen = hint(wanted.select(*group, "_bucket").distinct(), small)
    values = pooled(long).join(chosen, [*group, "_bucket"])
    values = values.groupBy(*group, "_bucket", "value").agg(F.count("*").alias("_c"))
    inside = (
        Window.partitionBy(*group, "_bucket")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = values.withColumn("_to", F.sum("_c").over(inside))
    hits = placed.join(hint(wanted, small), [*group, "_bucket"]).where(
        "_rank - _off < _to and _rank - _off >= _to - _c"
    )
    ends = hits.groupBy(*group, "prob").agg(
        F.min("value").alias("_lo"), F.max("value").alias("_up"), F.max("_pos").alias("_pos")
    )
    names = F.array(*[F.lit(c) for c in columns])
    return ends.select(
        *group[:-1],
        F.get(names, F.col("feature")).alias("feature"),
        "prob",
        (F.col("_lo") + (F.col("_up") - F.col("_lo")) * (F.col("_pos") - F.floor("_pos"))).alias(
            "quantile"
        ),
    )
