"""Rank correlation, variance inflation and feature pruning.

Only feature-by-feature results reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, Window, functions as F

from rarespark.functions.ranks import bucket_count, join_on_values, splits_of
from rarespark.session import cut_lineage

HIGH_RHO = 0.9
HIGH_VIF = 5.0
CELLS_PER_BLOCK = 4_000_000
#: Ranks of gap rows that one pass over the rows takes along, in bytes.
SIDE_BYTES = 32 << 20


def _rank_products(batches, columns: int, masks: list[int], means: dict[int, float]) -> Iterator:
    """Sum products of centred ranks over one partition, in blocks of bounded size.

    ``masks[j]`` is the rank context column ``j`` imposes on its partners.
    """
    import pyarrow as pa

    wide = max(masks) + 1
    centre = np.array([means.get(c, 0.0) for c in range(columns * wide)])
    block = max(1, CELLS_PER_BLOCK // (columns * max(columns, wide)))
    cross = np.zeros((columns, columns))
    own = np.zeros((columns, columns))
    seen = False
    for batch in batches:
        cells = batch.column(0)
        starts = cells.offsets.to_numpy()
        flat = cells.values
        ctx, rank = flat.field("ctx").to_numpy(), flat.field("rank").to_numpy()
        for lo in range(0, len(cells), block):
            hi = min(lo + block, len(cells))
            part = slice(starts[lo], starts[hi])
            row = np.repeat(np.arange(hi - lo), np.diff(starts[lo : hi + 1]))
            ranks = np.zeros((hi - lo, columns * wide))
            ranks[row, ctx[part]] = rank[part] - centre[ctx[part]]
            ranks = ranks.reshape(hi - lo, columns, wide)
            if wide == 1:
                flat_ranks = ranks[:, :, 0]
                cross += flat_ranks.T @ flat_ranks
                own += (flat_ranks**2).sum(axis=0)[:, None]
            else:
                for j, m in enumerate(masks):
                    if m:  # among columns with the same gaps, the full context
                        ranks[:, j, m] = ranks[:, j, 0]
                facing = ranks[:, :, masks]
                cross += (facing * facing.transpose(0, 2, 1)).sum(axis=0)
                own += (facing**2).sum(axis=0)
            seen = True
    if seen:
        i, j = np.divmod(np.arange(columns * columns), columns)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype("int32")), pa.array(j.astype("int32")), pa.array(cross.ravel()), pa.array(own.ravel())],
            names=["i", "j", "g", "v"],
        )


def gap_marks(df: DataFrame, columns: Sequence[str], id_col: str = "row_id") -> tuple[list[str | None], dict[str, int], int]:
    """Per column, the first column with gaps in the same rows (None without gaps); the number
    of gaps per column; the number of rows.

    Columns whose gap count and hash of gap rows agree are compared row by row.
    """
    missing = {c: F.col(c).isNull() for c in columns}
    marks = df.agg(
        F.count("*").alias("_rows"),
        *[
            F.struct(
                F.count(F.when(m, 1)).alias("n"), F.bit_xor(F.when(m, F.xxhash64(id_col))).alias("h")
            ).alias(c)
            for c, m in missing.items()
        ],
    ).first()
    first: dict[tuple, str] = {}
    twin = {c: first.setdefault(tuple(marks[c]), c) for c in columns if marks[c]["n"]}
    doubt = [c for c, t in twin.items() if c != t]
    if doubt:
        differs = df.agg(
            *[F.max((missing[c] != missing[twin[c]]).cast("int")).alias(c) for c in doubt]
        ).first()
        twin.update({c: c for c in doubt if differs[c]})
    return [twin.get(c) for c in columns], {c: marks[c]["n"] for c in columns}, marks["_rows"]


def gap_patterns(df: DataFrame, columns: Sequence[str], id_col: str = "row_id") -> list[str | None]:
    """Per column, the first column with gaps in the same rows; None without gaps."""
    return gap_marks(df, columns, id_col)[0]


def _value_ranks(long: DataFrame, wide: int) -> tuple[DataFrame, dict[int, float]]:
    """Average ranks ``(i, value, n, ranks)`` of each column's distinct values in every gap
    context, and the mean rank of each (column, context).

    One count per value and context; ranks are running sums of the counts, inside buckets
    of the column's own values and over the buckets' totals.
    """
    counts = long.groupBy("i", "bucket", "value").agg(
        *[F.count(F.when(F.col("seen")[m], 1)).alias(f"n{m}") for m in range(wide)]
    )
    counts = cut_lineage(counts, "values")
    totals = counts.groupBy("i", "bucket").agg(*[F.sum(f"n{m}").alias(f"t{m}") for m in range(wide)])
    before = Window.partitionBy("i").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "i", "bucket", *[F.coalesce(F.sum(f"t{m}").over(before), F.lit(0)).alias(f"o{m}") for m in range(wide)]
    )
    sizes = totals.groupBy("i").agg(*[F.sum(f"t{m}").alias(f"t{m}") for m in range(wide)]).collect()
    means = {r["i"] * wide + m: (r[f"t{m}"] + 1) / 2 for r in sizes for m in range(wide)}
    inside = Window.partitionBy("i", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranks = [F.sum(f"n{m}").over(inside) + F.col(f"o{m}") - (F.col(f"n{m}") - 1) / F.lit(2.0) for m in range(wide)]
    ranked = counts.join(offsets, ["i", "bucket"]).select("i", "value", F.col("n0").alias("n"), F.array(*ranks).alias("ranks"))
    return ranked, means


def _cells(df: DataFrame, columns: Sequence[str], gappy: Sequence[str], id_col: str) -> DataFrame:
    """``(id, seen, i, value, bucket)`` of every present cell; ``seen`` tells the gap contexts.
    Buckets follow each column's own quantiles, so no column ends up in one task."""
    values, marks = ([f"{mark}{i}" for i in range(len(columns))] for mark in ("_v", "_b"))
    base = df.select(
        F.col(id_col).alias("id"),
        F.array(F.lit(True), *[F.col(c).isNotNull() for c in gappy]).alias("seen"),
        *[F.col(c).cast("double").alias(v) for c, v in zip(columns, values, strict=True)],
    )
    buckets = bucket_count(df)
    cuts = base.approxQuantile(values, [k / buckets for k in range(1, buckets)], 1.0 / (4 * buckets))
    cut = Bucketizer(
        inputCols=values, outputCols=marks, splitsArray=[splits_of(sorted(set(c))) for c in cuts], handleInvalid="keep"
    ).transform(base)
    cells = [
        F.struct(F.lit(i).alias("i"), F.col(v).alias("value"), F.col(m).alias("bucket"))
        for i, (v, m) in enumerate(zip(values, marks, strict=True))
    ]
    return (
        cut.select("id", "seen", F.explode(F.array(*cells)).alias("c"))
        .select("id", "seen", "c.i", "c.value", "c.bucket")
        .where("value is not null")
    )


def rank_rows(df: DataFrame, columns: Sequence[str], id_col: str = "row_id") -> DataFrame:
    """``cells (i, rank)`` of each row: a column's average rank among all its present values.
    Every cell is moved with one rank, whatever the gaps."""
    long = _cells(df, columns, [], id_col)
    ranks, _ = _value_ranks(long, 1)
    ranked = join_on_values(long.select("id", "i", "value"), ranks, ["i", "value"])
    cell = F.struct("i", F.get("ranks", F.lit(0)).alias("rank"))
    return cut_lineage(ranked.groupBy("id").agg(F.collect_list(cell).alias("cells")).select("cells"), "ranks")


@dataclass(frozen=True)
class GapRanks:
    """Ranks of column ``i`` in the rows that a gap pattern takes away, sorted; or in the rows
    that it leaves, for the patterns of ``kept``, where those are fewer."""

    kept: frozenset[int]
    ranks: dict[tuple[int, int], np.ndarray]

    def corrected(self, x: np.ndarray, i: int, pattern: int) -> np.ndarray:
        """Ranks ``x`` of column ``i`` over the rows that the pattern leaves: a rank falls by the
        rows taken away below it, and by half of those level with it."""
        side = self.ranks[i, pattern]
        level = (np.searchsorted(side, x, "left") + np.searchsorted(side, x, "right")) / 2.0
        return level + 0.5 if pattern in self.kept else x - level


def _rank_matrix(batch, columns: int) -> np.ndarray:
    """Rows by columns; gaps are NaN."""
    cells = batch.column(0)
    flat, lengths = cells.flatten(), np.diff(cells.offsets.to_numpy())
    x = np.full((len(cells), columns), np.nan)
    x[np.repeat(np.arange(len(cells)), lengths), flat.field("i").to_numpy()] = flat.field("rank").to_numpy()
    return x


def _gap_ranks(rows: DataFrame, columns: int, asked: dict[int, list[int]], kept: frozenset[int]) -> GapRanks:
    """Ranks of the columns ``asked[pattern]`` in each pattern's gap rows; a pattern is known by
    its first column. The caller has checked their size."""

    def held(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x = _rank_matrix(batch, columns)
            for pattern, wanted in asked.items():
                part = x[np.isnan(x[:, pattern]) != (pattern in kept)]
                for i in wanted:
                    ranks = part[:, i][~np.isnan(part[:, i])]
                    if len(ranks):
                        keys = [pa.array(np.full(len(ranks), v, np.int32)) for v in (i, pattern)]
                        yield pa.RecordBatch.from_arrays([*keys, pa.array(ranks)], names=["i", "pattern", "rank"])

    found = rows.mapInArrow(held, "i int, pattern int, rank double").toArrow()
    i, pattern, rank = (found[c].to_numpy() for c in ("i", "pattern", "rank"))
    order = np.lexsort((rank, pattern, i))
    key = (i.astype(np.int64) * columns + pattern)[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    table = {(c, p): np.zeros(0) for p, wanted in asked.items() for c in wanted}
    ends = np.append(first[1:], len(key))[: len(first)]
    table |= {divmod(int(key[lo]), columns): rank[order[lo:hi]] for lo, hi in zip(first, ends, strict=True)}
    return GapRanks(kept, table)


def _pair_sums(batches, pairs: Sequence[tuple[int, int]], patterns: Sequence[int], centre: float, gaps: GapRanks) -> Iterator:
    """Per pair: rows with both, and summed products of their corrected ranks less ``centre``,
    over one partition. ``pairs`` come by their first column; pattern -1 has no gaps."""
    import pyarrow as pa

    total = np.zeros((len(pairs), 4))
    full = sorted({c for pair in pairs for c in pair if patterns[c] < 0})
    plain = [k for k, (i, j) in enumerate(pairs) if patterns[i] < 0 and patterns[j] < 0]
    at = {c: k for k, c in enumerate(full)}
    for batch in batches:
        x = _rank_matrix(batch, len(patterns))
        if plain:
            y = x[:, full] - centre
            products = y.T @ y
            for k in plain:
                i, j = (at[c] for c in pairs[k])
                total[k] += (len(y), products[i, j], products[i, i], products[j, j])
        done: dict[int, np.ndarray] = {}
        last = -1
        for k, (i, j) in enumerate(pairs):
            if patterns[i] < 0 and patterns[j] < 0:
                continue
            if i != last:
                done, last = {-1: x[:, i]}, i
            if patterns[j] not in done:
                done[patterns[j]] = gaps.corrected(x[:, i], i, patterns[j])
            a = done[patterns[j]]
            b = x[:, j] if patterns[i] < 0 else gaps.corrected(x[:, j], j, patterns[i])
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = a[both] - centre, b[both] - centre
            total[k] += (len(a), a @ b, a @ a, b @ b)
    columns = [np.array(side, np.int32) for side in zip(*pairs, strict=True)] + list(total.T.copy())
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["i", "j", "m", "ab", "aa", "bb"])


def _blocks(columns: Sequence[int], partners: Sequence[int], size, limit: int) -> list[tuple[list[int], list[int]]] | None:
    """Columns against partners in blocks whose gap ranks stay within ``limit``; None if those
    of a single pair don't."""

    def cost(left: Sequence[int], right: Sequence[int]) -> int:
        return sum(size(i, j) for i in left for j in right) + sum(size(j, i) for i in left for j in right)

    if cost(columns, partners) <= limit:
        return [(list(columns), list(partners))]
    if len(columns) == 1 and len(partners) == 1:
        return None
    long, short = (columns, partners) if len(columns) >= len(partners) else (partners, columns)
    halves = [long[: len(long) // 2], long[len(long) // 2 :]]
    out = []
    for half in halves:
        found = _blocks(half, partners, size, limit) if long is columns else _blocks(columns, half, size, limit)
        if found is None:
            return None
        out += found
    return out


def _correlations(df: DataFrame, columns: list[str], against: list[int], id_col: str) -> DataFrame | None:
    """Rank correlation of every column with the columns ``against``: ``(i, j, rho)``, each
    pair once. None if the gap rows of a pair are too many to be sent to all tasks."""
    p = len(columns)
    names, missing, n = gap_marks(df, columns, id_col)
    patterns = [columns.index(t) if t else -1 for t in names]
    gaps = {pattern: missing[columns[pattern]] for pattern in patterns if pattern >= 0}
    kept = frozenset(pattern for pattern, count in gaps.items() if 2 * count > n)

    def size(i: int, j: int) -> int:
        pattern = patterns[j]
        return 0 if pattern < 0 else 8 * min(gaps[pattern], n - gaps[pattern])

    blocks = _blocks(range(p), against, size, SIDE_BYTES)
    if blocks is None:
        return None
    rows = rank_rows(df, columns, id_col)
    centre, parts, seen = (n + 1) / 2.0, [], set()
    for left, right in blocks:
        pairs = sorted({(min(i, j), max(i, j)) for i in left for j in right} - seen)
        seen.update(pairs)
        if not pairs:
            continue
        asked: dict[int, set[int]] = {}
        for i, j in pairs:
            for column, partner in ((i, j), (j, i)):
                if patterns[partner] >= 0:
                    asked.setdefault(patterns[partner], set()).add(column)
        side = _gap_ranks(rows, p, {k: sorted(v) for k, v in asked.items()}, kept) if asked else GapRanks(kept, {})
        held = df.sparkSession.sparkContext.broadcast(side)
        parts.append(
            rows.mapInArrow(
                lambda batches, pairs=pairs, held=held: _pair_sums(batches, pairs, patterns, centre, held.value),
                "i int, j int, m double, ab double, aa double, bb double",
            )
            .groupBy("i", "j")
            .agg(*[F.sum(c).alias(c) for c in ("m", "ab", "aa", "bb")])
        )
    sums = cut_lineage(reduce(DataFrame.unionByName, parts), "products")
    # corrected ranks of m rows always sum to m (m + 1) / 2
    shift = F.col("m") * ((F.col("m") + 1) / 2 - centre) * ((F.col("m") + 1) / 2 - centre)
    left, right = F.col("aa") - shift, F.col("bb") - shift
    varies = (left > F.col("aa") * 1e-13) & (right > F.col("bb") * 1e-13)
    return sums.select("i", "j", F.when(varies, (F.col("ab") - shift) / (F.sqrt(left) * F.sqrt(right))).alias("rho"))


def spearman_matrix(df: DataFrame, columns: Sequence[str], id_col: str = "row_id") -> DataFrame:
    """Rank correlation of every pair over the rows where both are present.

    A cell is moved with its rank among all rows of its column. Over the rows that a partner
    leaves, ranks fall by the gap rows below: these are few, so their sorted ranks go to all
    tasks and are searched there, as many columns at a time as ``SIDE_BYTES`` allows.
    """
    columns = list(columns)
    found = _correlations(df, columns, list(range(len(columns))), id_col)
    if found is None:
        return _matrix_by_contexts(df, columns, gap_patterns(df, columns, id_col), id_col)
    names = F.array(*[F.lit(c) for c in columns])
    both = found.unionByName(found.where("i <> j").select(F.col("j").alias("i"), F.col("i").alias("j"), "rho"))
    return both.select(F.get(names, F.col("i")).alias("feature_a"), F.get(names, F.col("j")).alias("feature_b"), "rho")


def spearman_with(df: DataFrame, columns: Sequence[str], target: str = "y", id_col: str = "row_id") -> DataFrame:
    """Rank correlation of each column with ``target``: the target's column of the matrix,
    from one product per column."""
    names = [*[c for c in columns if c != target], target]
    last = len(names) - 1
    found = _correlations(df, names, [last], id_col)
    if found is None:
        return _matrix_by_contexts(df, names, gap_patterns(df, names, id_col), id_col).where(F.col("feature_b") == target)
    label = F.array(*[F.lit(c) for c in names])
    return found.select(F.get(label, F.col("i")).alias("feature_a"), F.lit(target).alias("feature_b"), "rho")


def _matrix_by_contexts(df: DataFrame, columns: Sequence[str], patterns: Sequence[str | None], id_col: str) -> DataFrame:
    """Every cell is moved with its rank in each gap context: for tables so long that the gap
    rows of two columns are too many to be sent to all tasks."""
    p = len(columns)
    gappy = list(dict.fromkeys(t for t in patterns if t))
    masks = [gappy.index(t) + 1 if t else 0 for t in patterns]
    wide = len(gappy) + 1
    long = _cells(df, columns, gappy, id_col)
    ranks, means = _value_ranks(long, wide)
    ranked = join_on_values(long.select("id", "seen", "i", "value"), ranks, ["i", "value"])
    contexts = F.filter(F.sequence(F.lit(0), F.lit(wide - 1)), lambda m: F.get("seen", m))
    own = F.transform(
        contexts, lambda m: F.struct((F.col("i") * wide + m).alias("ctx"), F.get("ranks", m).alias("rank"))
    )
    rows = ranked.select("id", own.alias("own")).groupBy("id").agg(F.flatten(F.collect_list("own")).alias("cells")).select("cells")
    sums = rows.mapInArrow(
        lambda batches: _rank_products(batches, p, masks, means), "i int, j int, g double, v double"
    )
    names = F.array(*[F.lit(c) for c in columns])
    total = sums.groupBy("i", "j").agg(F.sum("g").alias("g"), F.sum("v").alias("v"))
    total = cut_lineage(total, "products")
    back = total.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("v").alias("v2"))
    rho = F.col("g") / F.nullif(F.sqrt("v") * F.sqrt("v2"), F.lit(0.0))
    return total.join(back, ["i", "j"]).select(
        F.get(names, F.col("i")).alias("feature_a"), F.get(names, F.col("j")).alias("feature_b"), rho.alias("rho")
    )


def _position(names: Sequence[str], col: str):
    return F.array_position(F.array(*[F.lit(n) for n in names]), F.col(col))


def lower_triangle(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Entries on and below the diagonal, in the order of ``columns``."""
    return matrix.where(_position(columns, "feature_a") >= _position(columns, "feature_b"))


def top_correlated_features(matrix: DataFrame, top: int = 20) -> tuple[DataFrame, DataFrame]:
    """Features by total absolute correlation, and the matrix among the top ones."""
    sums = matrix.groupBy("feature_a").agg(F.sum(F.abs("rho")).alias("total"))
    best = sums.orderBy(F.desc("total"), "feature_a").limit(top).withColumnRenamed("feature_a", "feature")
    sub = matrix.join(best, matrix.feature_a == best.feature, "left_semi")
    other = best.select(F.col("feature").alias("other"))
    return best, sub.join(other, sub.feature_b == other.other, "left_semi")


def target_correlation(matrix: DataFrame, target: str = "y") -> DataFrame:
    rows = matrix.where((F.col("feature_b") == target) & (F.col("feature_a") != target))
    return rows.select(F.col("feature_a").alias("feature"), "rho", F.abs("rho").alias("strength")).orderBy(
        F.desc("strength"), "feature"
    )


def correlated_pairs(matrix: DataFrame, columns: Sequence[str], limit: float = HIGH_RHO) -> DataFrame:
    upper = _position(columns, "feature_a") < _position(columns, "feature_b")
    pairs = matrix.where(upper & (F.abs("rho") > limit))
    return pairs.select("feature_a", "feature_b", F.abs("rho").alias("strength")).orderBy(
        F.desc("strength"), "feature_a", "feature_b"
    )


def drop_from_pairs(pairs: DataFrame, target_rho: DataFrame) -> DataFrame:
    """From each pair, drop the feature less correlated with the target."""
    a = target_rho.select(F.col("feature").alias("feature_a"), F.col("strength").alias("sa"))
    b = target_rho.select(F.col("feature").alias("feature_b"), F.col("strength").alias("sb"))
    keep_a = F.col("sa") >= F.col("sb")
    return pairs.join(a, "feature_a").join(b, "feature_b").select(
        "feature_a",
        "feature_b",
        F.when(keep_a, F.col("feature_a")).otherwise(F.col("feature_b")).alias("keep"),
        F.when(keep_a, F.col("feature_b")).otherwise(F.col("feature_a")).alias("drop"),
    )


def pearson_matrix(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Correlation of complete columns, summed on the cluster; p by p on the driver."""
    vec = VectorAssembler(inputCols=list(columns), outputCol="_v").transform(df).select("_v")
    return Correlation.corr(vec, "_v").first()[0].toArray()


def inflation(corr: np.ndarray) -> np.ndarray:
    """Variance inflation of each column from the correlation matrix: the diagonal of its
    inverse. Infinite where a column is a combination of others."""
    if np.linalg.cond(corr) < 1e10:
        return np.diag(np.linalg.inv(corr)).copy()
    out = np.empty(len(corr))
    for j in range(len(corr)):
        rest = np.delete(np.arange(len(corr)), j)
        r = corr[rest, j]
        explained = r @ np.linalg.pinv(corr[np.ix_(rest, rest)], hermitian=True) @ r if len(rest) else 0.0
        left = 1.0 - explained
        out[j] = 1.0 / left if left > 1e-10 else np.inf
    return out


def vif(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, vif)`` on imputed rows."""
    columns = list(columns)
    values = inflation(pearson_matrix(df, columns))
    return df.sparkSession.createDataFrame(
        [(c, float(v)) for c, v in zip(columns, values)], "feature string, vif double"
    )


def vif_summary(table: DataFrame, limit: float = HIGH_VIF, top: int = 10) -> tuple[DataFrame, DataFrame]:
    high = table.agg(F.count(F.when(F.col("vif") > limit, 1)).alias("features_high"))
    return high, table.orderBy(F.desc("vif"), "feature").limit(top)


def prune_by_vif(df: DataFrame, columns: Sequence[str], limit: float = HIGH_VIF) -> DataFrame:
    """Drop the most inflated column until all are below ``limit``: ``(step, feature, vif)``.

    The data are read once; the loop runs on the p by p matrix.
    """
    left = list(columns)
    corr = pearson_matrix(df, left)
    steps: list[tuple[int, str, float]] = []
    while len(left) > 1:
        values = inflation(corr)
        worst = int(np.argmax(values))
        if values[worst] < limit:
            break
        steps.append((len(steps) + 1, left.pop(worst), float(values[worst])))
        corr = np.delete(np.delete(corr, worst, 0), worst, 1)
    return df.sparkSession.createDataFrame(steps, "step int, feature string, vif double")
