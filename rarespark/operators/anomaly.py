"""Forest proximity, landmark embedding, isolation forest and outlier reports."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from rarespark.functions.hashing import draws
from rarespark.functions.ranks import exact_quantiles
from rarespark.operators.folds import simple_sample
from rarespark.session import cut_lineage

LANDMARKS = 64
MAX_LANDMARKS = 10_000
#: Starts of the landmarks' layout, and steps of each minimisation.
EMBED_STARTS = 4
EMBED_STEPS = 200
ISO_TREES = 100
ISO_ROWS = 256
CONTAMINATION = 0.05
BLOCK_CELLS = 4_000_000
PLACE_CELLS = 32_000


def _landmark_arrays(landmarks: DataFrame, id_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and leaf vectors of the landmarks, whose number is checked."""
    rows = landmarks.select(id_col, "leaves").orderBy(id_col).limit(MAX_LANDMARKS + 1).collect()
    if len(rows) > MAX_LANDMARKS:
        raise ValueError(f"more than {MAX_LANDMARKS} landmarks; draw a sample first")
    return np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows])


def _shared(leaves: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Number of trees in which each row meets each landmark."""
    out = np.zeros((len(leaves), len(landmarks)), dtype=np.int32)
    for t in range(landmarks.shape[1]):
        out += leaves[:, t, None] == landmarks[None, :, t]
    return out


def _leaf_matrix(column) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def proximity_to_landmarks(
    leaves: DataFrame, landmarks: DataFrame, id_col: str = "row_id", absent: bool = False
) -> DataFrame:
    """Share of trees in which a row and a landmark fall into the same leaf.

    ``(id_a, id_b, prox)`` for every row and every landmark it meets, or every landmark
    if ``absent``. Rows are never joined with each other: the landmark table has a
    checked size, so the work is linear in the rows and needs no shuffle.
    """
    import pyarrow as pa

    ids, marks = _landmark_arrays(landmarks, id_col)
    trees = marks.shape[1] if len(ids) else 1

    def meet(batches):
        step = max(1, BLOCK_CELLS // max(1, len(ids)))
        for batch in batches:
            own, matrix = batch.column(0).to_numpy(), _leaf_matrix(batch.column(1)) if batch.num_rows else None
            for lo in range(0, batch.num_rows, step):
                hits = _shared(matrix[lo : lo + step], marks)
                i, j = np.nonzero(hits + 1 if absent else hits)
                prox = np.where(own[lo + i] == ids[j], 1.0, hits[i, j] / trees)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[lo + i]), pa.array(ids[j]), pa.array(prox)], names=["id_a", "id_b", "prox"]
                )

    return leaves.select(F.col(id_col).cast("bigint"), "leaves").mapInArrow(
        meet, "id_a bigint, id_b bigint, prox double"
    )


def proximity(sample: DataFrame, id_col: str = "row_id") -> DataFrame:
    """All pairs ``id_a < id_b`` of a bounded sample that share a leaf."""
    return proximity_to_landmarks(sample, sample, id_col).where("id_a < id_b")


def dissimilarity(pairs: DataFrame) -> DataFrame:
    return pairs.select("id_a", "id_b", (F.lit(1.0) - F.coalesce("prox", F.lit(0.0))).alias("dissimilarity"))


def dissimilarity_histogram(sample: DataFrame, id_col: str = "row_id") -> DataFrame:
    """``(dissimilarity, pairs)`` over all pairs of a sample of checked size, those that
    share no leaf included. Pairs are counted where they are compared, never written."""
    import pyarrow as pa

    ids, marks = _landmark_arrays(sample, id_col)
    trees = marks.shape[1] if len(ids) else 1

    def count(batches):
        total = np.zeros(trees + 1, np.int64)
        step = max(1, BLOCK_CELLS // max(1, len(ids)))
        for batch in batches:
            if not batch.num_rows:
                continue
            own, matrix = batch.column(0).to_numpy(), _leaf_matrix(batch.column(1))
            for lo in range(0, batch.num_rows, step):
                hits = _shared(matrix[lo : lo + step], marks)
                total += np.bincount(hits[own[lo : lo + step, None] < ids[None, :]], minlength=trees + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(trees + 1)), pa.array(total)], names=["shared", "pairs"])

    parts = sample.select(F.col(id_col).cast("bigint"), "leaves").mapInArrow(count, "shared bigint, pairs bigint")
    counts = parts.groupBy("shared").agg(F.sum("pairs").alias("pairs")).where("pairs > 0")
    return counts.select((F.lit(1.0) - F.col("shared") / trees).alias("dissimilarity"), "pairs")


def _classical(d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classical scaling of a distance matrix to two axes: the layout, and the projection that
    places another point from its squared distances."""
    d2 = d**2
    centre = np.eye(len(d)) - 1.0 / len(d)
    values, vectors = np.linalg.eigh(-0.5 * centre @ d2 @ centre)
    top = np.argsort(values)[::-1][:2]
    root = np.sqrt(np.maximum(values[top], 1e-12))
    vec = vectors[:, top] * np.sign(vectors[np.abs(vectors[:, top]).argmax(axis=0), top])
    xy, project = vec * root, vec / root
    if xy.shape[1] < 2:  # a single landmark
        xy, project = np.pad(xy, ((0, 0), (0, 1))), np.pad(project, ((0, 0), (0, 1)))
    return xy, project


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances in the plane, an axis at a time."""
    total = a[:, 0, None] - b[:, 0]
    total *= total
    other = a[:, 1, None] - b[:, 1]
    other *= other
    total += other
    return np.sqrt(total, out=total)


def _ratio(wanted: np.ndarray, near: np.ndarray) -> np.ndarray:
    return np.divide(wanted, near, out=np.zeros_like(near), where=near > 1e-12)


def majorise(d: np.ndarray, start: np.ndarray, steps: int = EMBED_STEPS) -> tuple[np.ndarray, float]:
    """Layout of least stress near ``start`` by Guttman's transform (de Leeuw, 1977), which never
    raises the stress, and that stress."""
    xy, old = start, np.inf
    whole = max(float((d**2).sum()), 1e-300)
    near = _distances(xy, xy)
    stress = float(((near - d) ** 2).sum())
    for _ in range(steps):
        if old - stress <= 1e-9 * whole:
            break
        ratio = _ratio(d, near)
        xy = (ratio.sum(axis=1)[:, None] * xy - ratio @ xy) / len(d)
        near = _distances(xy, xy)
        old, stress = stress, float(((near - d) ** 2).sum())
    return xy, float(np.sqrt(stress / whole))


def scale_landmarks(d: np.ndarray, starts: int = EMBED_STARTS, steps: int = EMBED_STEPS, seed: int = 42) -> np.ndarray:
    """Best layout of several starts, classical scaling first, turned to its principal axes."""
    first, _ = _classical(d)
    rng = np.random.default_rng(seed)
    found = [majorise(d, first, steps)]
    found += [majorise(d, rng.normal(size=first.shape) * max(d.mean(), 1e-6), steps) for _ in range(starts - 1)]
    xy = min(found, key=lambda layout: layout[1])[0]
    xy = xy - xy.mean(axis=0)
    _, _, axes = np.linalg.svd(xy, full_matrices=False)
    xy = xy @ axes.T if axes.shape == (2, 2) else xy
    return xy * np.where(xy[np.abs(xy).argmax(axis=0), range(2)] < 0, -1.0, 1.0)


def place_rows(far: np.ndarray, marks: np.ndarray, start: np.ndarray, steps: int = EMBED_STEPS) -> np.ndarray:
    """Point of least stress to fixed landmarks for each row of distances ``far``, by the same
    majorisation, one row independent of the others. Rows that have come to rest are left."""
    xy, live, centre = start.copy(), np.arange(len(far)), marks.mean(axis=0)
    here, wanted = start, far
    for _ in range(steps):
        if not len(live):
            break
        ratio = _ratio(wanted, _distances(here, marks))
        new = centre + (ratio.sum(axis=1)[:, None] * here - ratio @ marks) / len(marks)
        xy[live] = new
        moved = np.abs(new - here).max(axis=1) > 1e-7
        here = new
        if not moved.all():
            live, here, wanted = live[moved], new[moved], wanted[moved]
    return xy


def proximity_embed_2d(
    leaves: DataFrame,
    landmarks: int = LANDMARKS,
    id_col: str = "row_id",
    seed: int = 42,
    starts: int = EMBED_STARTS,
    steps: int = EMBED_STEPS,
) -> DataFrame:
    """Layout of 1 - proximity by least stress to landmarks: ``(id, x1, x2)``.

    The landmarks are laid out by classical scaling (de Silva and Tenenbaum, 2004), then by
    stress majorisation from that and other starts; ``steps=0`` keeps classical scaling. Every
    other row is placed by its own small minimisation from its distances to them.
    """
    import pyarrow as pa

    marks_df = simple_sample(leaves, landmarks, id_col, seed)
    ids, marks = _landmark_arrays(marks_df, id_col)
    if not len(ids):
        return leaves.select(F.col(id_col).cast("bigint"), F.lit(0.0).alias("x1"), F.lit(0.0).alias("x2"))
    trees = marks.shape[1]
    d = 1.0 - _shared(marks, marks) / trees
    first, project = _classical(d)
    mean = (d**2).mean(axis=0)
    final = scale_landmarks(d, starts, steps, seed) if steps else first
    # the turn and mirroring that takes the first layout closest to the final one
    u, _, v = np.linalg.svd((first - first.mean(axis=0)).T @ (final - final.mean(axis=0)))
    turn = u @ v if steps else np.eye(2)

    def place(batches):
        # blocks that stay in a core's cache through all the steps
        step = max(1, PLACE_CELLS // len(ids))
        for batch in batches:
            if not batch.num_rows:
                continue
            own, matrix = batch.column(0).to_numpy(), _leaf_matrix(batch.column(1))
            for lo in range(0, batch.num_rows, step):
                far = 1.0 - _shared(matrix[lo : lo + step], marks) / trees
                xy = -0.5 * (far**2 - mean) @ project @ turn
                if steps:
                    xy = place_rows(far, final, xy, steps)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[lo : lo + step]), pa.array(xy[:, 0]), pa.array(xy[:, 1])],
                    names=[id_col, "x1", "x2"],
                )

    return leaves.select(F.col(id_col).cast("bigint"), "leaves").mapInArrow(
        place, f"{id_col} bigint, x1 double, x2 double"
    )


def embedding_stress(embedded: DataFrame, leaves: DataFrame, landmarks: DataFrame, id_col: str = "row_id") -> DataFrame:
    """Normalised stress between embedded and true distances to the landmarks.

    Each row meets its place once; the landmarks and their places, whose number is checked, go to
    all tasks, which add up their rows' squares.
    """
    import pyarrow as pa

    ids, marks = _landmark_arrays(landmarks, id_col)
    trees = marks.shape[1] if len(ids) else 1
    places = embedded.join(F.broadcast(landmarks.select(id_col)), id_col).select(id_col, "x1", "x2").collect()
    # a landmark counts once for each of its places
    pairs = [(j, r["x1"], r["x2"]) for r in places for j in np.flatnonzero(ids == r[id_col])]
    at, where = np.array([p[0] for p in pairs], np.int64), np.array([p[1:] for p in pairs], float).reshape(-1, 2)

    def squares(batches):
        gap = whole = 0.0
        step = max(1, BLOCK_CELLS // max(1, len(at), len(ids)))
        for batch in batches if len(at) else ():
            if not batch.num_rows:
                continue
            own, matrix = batch.column(0).to_numpy(), _leaf_matrix(batch.column(1))
            xy = np.column_stack([batch.column(k).to_numpy() for k in (2, 3)])
            for lo in range(0, batch.num_rows, step):
                part = slice(lo, lo + step)
                far = np.where(own[part, None] == ids, 0.0, 1.0 - _shared(matrix[part], marks) / trees)[:, at]
                gap += float(((_distances(xy[part], where) - far) ** 2).sum())
                whole += float((far**2).sum())
        yield pa.RecordBatch.from_arrays([pa.array([gap]), pa.array([whole])], names=["gap", "whole"])

    rows = leaves.select(F.col(id_col).cast("bigint").alias(id_col), "leaves").join(embedded.select(id_col, "x1", "x2"), id_col)
    sums = rows.mapInArrow(squares, "gap double, whole double")
    return sums.agg(F.sqrt(F.sum("gap") / F.nullif(F.sum("whole"), F.lit(0.0))).alias("stress"))


# --- isolation forest ----------------------------------------------------------------

NODE_SCHEMA = "tree int, node int, feature int, threshold double, size int, depth int"


def _grow_isolation_tree(tree: int, x: np.ndarray, seed: int):
    """Random splits of one sample until single rows or the depth limit."""
    import pandas as pd

    rng = np.random.default_rng([seed, tree])
    limit = int(np.ceil(np.log2(max(len(x), 2))))
    out, work = [], [(1, np.arange(len(x)), 0)]
    while work:
        node, rows, depth = work.pop()
        part = x[rows]
        spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(rows) > 1 else []
        if depth >= limit or len(spread) == 0:
            out.append((tree, node, -1, 0.0, len(rows), depth))
            continue
        f = int(rng.choice(spread))
        at = rng.uniform(part[:, f].min(), part[:, f].max())
        left = part[:, f] < at
        out.append((tree, node, f, at, len(rows), depth))
        work += [(2 * node, rows[left], depth + 1), (2 * node + 1, rows[~left], depth + 1)]
    return pd.DataFrame(out, columns=["tree", "node", "feature", "threshold", "size", "depth"])


def _mean_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, dtype=float)
    harmonic = np.log(np.maximum(n - 1, 1)) + 0.5772156649015329
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def trees_drawn(key: np.ndarray, share: float, trees: int, seed: int):
    """Per tree, the rows that join it: each with probability ``share``, by its key alone.

    A row skips a geometric number of trees at a time, so rows that join none cost one draw.
    """
    found: list[list[np.ndarray]] = [[] for _ in range(trees)]
    rows, at, turn = np.arange(len(key)), np.full(len(key), -1, np.int64), 0
    while len(rows):
        u = 1.0 - draws(key[rows], seed, turn)
        skip = np.floor(np.log(u) / np.log1p(-share)) if share < 1.0 else np.zeros(len(rows))
        at = at + 1 + np.minimum(skip, trees).astype(np.int64)
        rows, at = rows[at < trees], at[at < trees]
        order = np.argsort(at, kind="stable")
        for tree, part in zip(*_split_by(at[order], rows[order]), strict=True):
            found[tree].append(part)
        turn += 1
    for tree, parts in enumerate(found):
        yield tree_rows(parts), tree


def _split_by(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Values by equal neighbouring keys."""
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first].tolist(), np.split(values, first[1:]) if len(first) else []


def tree_rows(parts: list[np.ndarray]) -> np.ndarray:
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.int64)


def isolation_forest_fit(
    df: DataFrame, columns: Sequence[str], trees: int = ISO_TREES, rows: int = ISO_ROWS, id_col: str = "row_id", seed: int = 42
) -> DataFrame:
    """Tree table of an isolation forest (Liu, Ting and Zhou, 2008).

    Each tree has its own sample, drawn where the rows are: a row joins the few trees
    whose draw it wins, so about twice ``trees * rows`` rows are shuffled in all.
    """
    columns = list(columns)
    share = min(1.0, 2.0 * rows / max(1, df.count()))
    keyed = df.select(id_col, F.array(*[F.col(c).cast("double") for c in columns]).alias("x"), F.xxhash64(id_col).alias("_key"))
    id_kind = keyed.schema[id_col].dataType.simpleString()

    def drawn(batches):
        import pyarrow as pa

        for batch in batches:
            key = batch.column(2).to_numpy()
            for at, tree in trees_drawn(key, share, trees, seed):
                if len(at):
                    own, u = pa.array(at), draws(key[at], seed + 1, tree)
                    marks = [pa.array(np.full(len(at), tree, np.int32)), pa.array(u)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(1).take(own), *marks], names=[id_col, "x", "tree", "u"])

    joined = keyed.mapInArrow(drawn, f"{id_col} {id_kind}, x array<double>, tree int, u double")

    def build(key, pdf):
        sample = pdf.sort_values(["u", id_col]).head(rows)
        return _grow_isolation_tree(int(key[0]), np.stack(sample["x"].to_numpy()), seed)

    return cut_lineage(joined.groupBy("tree").applyInPandas(build, NODE_SCHEMA), "isolation")


def isolation_score(df: DataFrame, forest: DataFrame, columns: Sequence[str], out: str = "anomaly") -> DataFrame:
    """Anomaly score in (0, 1); the tree table has at most trees x 2 x sample rows."""
    nodes = forest.toPandas()
    tables = []
    for _, part in nodes.groupby("tree"):
        feature = dict(zip(part["node"], zip(part["feature"], part["threshold"], part["size"], part["depth"])))
        order = {n: i for i, n in enumerate(sorted(feature))}
        f = np.array([feature[n][0] for n in sorted(feature)])
        cut = np.array([feature[n][1] for n in sorted(feature)])
        left = np.array([order.get(2 * n, i) for n, i in order.items()])
        right = np.array([order.get(2 * n + 1, i) for n, i in order.items()])
        size = np.array([feature[n][2] for n in sorted(feature)])
        depth = np.array([feature[n][3] for n in sorted(feature)])
        tables.append((f, cut, left, right, depth + _mean_path(size), int(depth.max()), int(size.max())))
    usual = float(np.mean([_mean_path(t[6]) for t in tables]))

    @F.pandas_udf("double")
    def score(*series):
        import pandas as pd

        x = np.column_stack(series)
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for f, cut, left, right, path, deep, _ in tables:
            at = np.zeros(len(x), dtype=int)
            for _step in range(deep):
                side = f[at]
                go = np.where(x[rows, np.maximum(side, 0)] < cut[at], left[at], right[at])
                at = np.where(side >= 0, go, at)
            total += path[at]
        return pd.Series(2.0 ** (-(total / len(tables)) / usual))

    return df.withColumn(out, score(*[F.col(c).cast("double") for c in columns]))


def flag_outliers(scored: DataFrame, contamination: float = CONTAMINATION, score: str = "anomaly") -> DataFrame:
    """Mark rows above the exact ``1 - contamination`` quantile of the score."""
    cut = exact_quantiles(scored, [score], [1.0 - contamination]).first()["quantile"]
    return scored.withColumn("is_outlier", F.col(score) > F.lit(cut))


def isolation_forest(
    df: DataFrame, columns: Sequence[str], contamination: float = CONTAMINATION, trees: int = ISO_TREES, seed: int = 42
) -> DataFrame:
    forest = isolation_forest_fit(df, columns, trees=trees, seed=seed)
    return flag_outliers(cut_lineage(isolation_score(df, forest, columns), "anomaly"), contamination)


# --- outlier reports -----------------------------------------------------------------


def uncertainty(scored: DataFrame, score: str = "proba") -> DataFrame:
    p = F.col(score)
    return scored.withColumns(
        {
            "uncertainty": F.abs(p - 0.5),
            "misclassified": ((p >= 0.5).cast("int") != F.col("y")),
        }
    )


def outlier_vs_inlier(rows: DataFrame, score: str = "proba") -> DataFrame:
    return (
        uncertainty(rows, score)
        .groupBy("is_outlier")
        .agg(
            F.count("*").alias("rows"),
            F.avg("uncertainty").alias("mean_uncertainty"),
            F.avg(score).alias("mean_proba"),
            F.avg(F.col("misclassified").cast("double")).alias("error_rate"),
        )
    )


def z_shift(rows: DataFrame, features: Sequence[str], flag: str = "is_outlier", top: int = 10) -> DataFrame:
    """Shift of the outliers' median from the overall median, in sample deviations."""
    half = F.col("quantile")
    every = exact_quantiles(rows, features, [0.5]).select("feature", half.alias("median_all"))
    out = exact_quantiles(rows.where(F.col(flag)), features, [0.5]).select("feature", half.alias("median_out"))
    wide = rows.agg(*[F.stddev_samp(c).alias(c) for c in features])
    spread = wide.unpivot([], list(features), "feature", "std")
    shift = F.abs((F.col("median_out") - F.col("median_all")) / (F.col("std") + 1e-8))
    joined = every.join(out, "feature").join(spread, "feature").select("feature", shift.alias("z_shift"))
    return joined.orderBy(F.desc("z_shift"), "feature").limit(top)
