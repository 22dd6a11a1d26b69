"""Regularised histogram boosting with a pluggable objective, for many fits at once.

Features are binned once. Every level is one pass over the rows for all fits together, such
as the folds and trials of a search: tasks sum gradients per (fit, node, feature, bin), and
the driver gets the sums, whose size follows the trees and not the rows. Of two children only
the smaller is summed; its sibling is what the parent has left. Split gain and leaf weight
follow the published XGBoost paper (Chen and Guestrin, KDD 2016). The trees are a table; rows
never leave the cluster.
"""

from __future__ import annotations

import json
import math
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rarespark.functions import losses
from rarespark.functions.hashing import draws
from rarespark.session import bounded_batches, cut_lineage, drop_stage, stage_bytes

MIN_GAIN = 1e-6
#: Fits that share passes; a row carries a margin for each.
FITS_AT_ONCE = 64
#: Rounds after which margins are written anew: each, if several fits share the work. Until then
#: every pass walks the trees since.
REWRITE_EVERY = 3
MANY_FITS = 3
#: Bytes of a level's histograms that the driver holds; more are summed in several passes.
HISTOGRAM_BYTES = 128 << 20
#: Bytes of the tasks' sums that are added up on the driver; more are added up by Spark.
PARTIAL_BYTES = 64 << 20
TASK_BYTES = 32 << 20
#: Bytes of rows, and of one fit's histograms of a level, up to which every fit grows in a task alone.
ALONE_BYTES = 32 << 20
#: Nodes whose splits are sought together.
NODES_AT_ONCE = 256
CELLS = 1024
SPLIT = 32
REFINEMENTS = 5
TREE_SCHEMA = (
    "tree int, node int, feature string, threshold double, value double, cover double, gain double"
)


@dataclass(frozen=True)
class BoostParams:
    rounds: int = 300
    depth: int = 6
    eta: float = 0.3
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    subsample: float = 1.0
    colsample: float = 1.0
    min_child_weight: float = 1.0
    bins: int = 256
    base_margin: float = 0.0
    seed: int = 42


@dataclass
class Tree:
    """Heap-numbered nodes: root 1, children 2i and 2i + 1; feature -1 marks a leaf."""

    depth: int
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    value: np.ndarray = field(init=False)
    cover: np.ndarray = field(init=False)
    gain: np.ndarray = field(init=False)

    def __post_init__(self):
        size = 2 ** (self.depth + 1)
        self.feature = np.full(size, -1)
        self.cut = np.zeros(size)
        self.value = np.zeros(size)
        self.cover = np.zeros(size)
        self.gain = np.zeros(size)


@dataclass
class BoostedModel:
    features: list[str]
    trees: list[Tree]
    base_margin: float = 0.0
    round_losses: list[float] = field(default_factory=list)

    def margin(self, *columns: Column) -> Column:
        """Margin of imputed feature columns, in Arrow batches."""
        trees, base = self.trees, self.base_margin

        @F.pandas_udf("double")
        def margin(*series):
            import pandas as pd

            return pd.Series(tree_margins(trees, np.column_stack(series)) + base)

        return margin(*(columns or [F.col(c) for c in self.features]))

    def transform(self, df: DataFrame, out: str = "proba") -> DataFrame:
        return df.withColumn("margin", self.margin()).withColumn(out, losses.sigmoid(F.col("margin")))

    def table(self, spark: SparkSession) -> DataFrame:
        """``TREE_SCHEMA`` rows; a leaf has no feature."""
        rows = []
        for t, tree in enumerate(self.trees):
            live = [1]
            while live:
                i = live.pop()
                f = int(tree.feature[i])
                rows.append(
                    (
                        t,
                        i,
                        self.features[f] if f >= 0 else None,
                        float(tree.cut[i]) if f >= 0 else None,
                        float(tree.value[i]),
                        float(tree.cover[i]),
                        float(tree.gain[i]),
                    )
                )
                if f >= 0:
                    live += [2 * i, 2 * i + 1]
        return spark.createDataFrame(rows, TREE_SCHEMA)

    @staticmethod
    def from_table(table: DataFrame, features: Sequence[str], base_margin: float = 0.0) -> BoostedModel:
        """Read back a tree table; its size is bounded by rounds and depth."""
        names = {c: i for i, c in enumerate(features)}
        rows = table.collect()
        count = max((r["tree"] for r in rows), default=-1) + 1
        depth = max((int(math.log2(r["node"])) for r in rows), default=0)
        trees = [Tree(depth) for _ in range(count)]
        for r in rows:
            tree, i = trees[r["tree"]], r["node"]
            if r["feature"] is not None:
                tree.feature[i], tree.cut[i] = names[r["feature"]], r["threshold"]
            tree.value[i], tree.cover[i], tree.gain[i] = r["value"], r["cover"], r["gain"]
        return BoostedModel(list(features), trees, base_margin)


@dataclass
class BoostedPack:
    """What scoring needs later: the trees, the medians that fill gaps, the parameters and
    the strategy they were found with."""

    model: BoostedModel
    medians: dict[str, float]
    params: BoostParams
    strategy: str

    def transform(self, df: DataFrame, out: str = "proba") -> DataFrame:
        """Scores of raw rows."""
        filled = df.withColumns({c: F.coalesce(F.col(c), F.lit(m)) for c, m in self.medians.items()})
        return self.model.transform(filled, out)

    def save(self, spark: SparkSession, path: str) -> None:
        """Trees as Parquet, the rest as one line of JSON."""
        self.model.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        rest = {
            "features": self.model.features,
            "base_margin": self.model.base_margin,
            "medians": self.medians,
            "params": asdict(self.params),
            "strategy": self.strategy,
        }
        spark.createDataFrame([(json.dumps(rest),)], "line string").coalesce(1).write.mode("overwrite").text(f"{path}/pack")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedPack:
        rest = json.loads(spark.read.text(f"{path}/pack").first()[0])
        model = BoostedModel.from_table(spark.read.schema(TREE_SCHEMA).parquet(f"{path}/trees"), rest["features"], rest["base_margin"])
        return BoostedPack(model, rest["medians"], BoostParams(**rest["params"]), rest["strategy"])


def tree_margins(trees: Sequence[Tree], x: np.ndarray) -> np.ndarray:
    total = np.zeros(len(x))
    at = np.arange(len(x))
    for tree in trees:
        node = np.ones(len(x), dtype=np.int64)
        for _ in range(tree.depth):
            f = tree.feature[node]
            down = 2 * node + (x[at, np.maximum(f, 0)] >= tree.cut[node])
            node = np.where(f >= 0, down, node)
        total += tree.value[node]
    return total


def _count_cells(batches, cells: Sequence[np.ndarray]):
    """Rows, least and greatest value of one partition per (feature, cell)."""
    import pyarrow as pa

    sums = [(np.zeros(len(c) + 1, np.int64), np.full(len(c) + 1, np.inf), np.full(len(c) + 1, -np.inf)) for c in cells]
    for batch in batches:
        for j, (n, least, most) in enumerate(sums):
            values = batch.column(j).drop_null().to_numpy(zero_copy_only=False)
            at = np.searchsorted(cells[j], values, side="right")
            n += np.bincount(at, minlength=len(n))
            np.minimum.at(least, at, values)
            np.maximum.at(most, at, values)
    for j, (n, least, most) in enumerate(sums):
        held = np.flatnonzero(n)
        columns = [np.full(len(held), j, "int32"), held.astype("int32"), n[held], least[held], most[held]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["feature", "cell", "n", "least", "most"])


def value_cells(df: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Per feature ``(n, least, most)`` of fine cells of its values, in order.

    All rows are counted, in cells of equal width; cells that hold more than half a bin
    are split and counted again. Counts, least and greatest values are the same however
    the rows are partitioned. Only cells reach the driver.
    """
    cells_df = df.select(*[F.col(c).cast("double").alias(c) for c in features])
    row = cells_df.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in features]).first()
    bounds = []
    for c in features:
        lo, hi = row[c]["lo"], row[c]["hi"]
        bounds.append(np.unique(np.linspace(lo, hi, CELLS + 1)[1:-1]) if lo is not None and lo < hi else np.zeros(0))
    for _ in range(REFINEMENTS):
        parts = cells_df.mapInArrow(
            lambda batches, bounds=bounds: _count_cells(batches, bounds),
            "feature int, cell int, n bigint, least double, most double",
        )
        found = (
            parts.groupBy("feature", "cell")
            .agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
            .toArrow()
            .sort_by([("feature", "ascending"), ("cell", "ascending")])
        )
        feature = found["feature"].to_numpy()
        counted = np.stack([found[c].to_numpy().astype(float) for c in ("n", "least", "most")], axis=1)
        counted = [counted[feature == j] for j in range(len(features))]
        finer = []
        for own, old in zip(counted, bounds, strict=True):
            heavy = own[(own[:, 0] > own[:, 0].sum() / (2 * bins)) & (own[:, 1] < own[:, 2])]
            more = [np.linspace(lo, hi, SPLIT + 1)[:-1] for _, lo, hi in heavy]
            finer.append(np.unique(np.concatenate([old, *more])))
        if all(len(a) == len(b) for a, b in zip(finer, bounds, strict=True)):
            break
        bounds = finer
    return counted


def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Inner bin bounds per feature, ``bins - 1`` at most, from all rows: every value of a
    feature with few of them, else values that cut the rows into about equal parts."""
    edges = []
    for cells in value_cells(df, features, bins):
        n, least = cells[:, 0], cells[:, 1]
        if len(cells) > bins:
            share = np.floor((np.cumsum(n) - n) * bins / n.sum())
            least = least[np.append(False, share[1:] > share[:-1])]
        else:
            least = least[1:]
        edges.append([float(v) for v in least])
    return edges


@dataclass(frozen=True)
class Fit:
    """One model of a batch: its parameters and objective, and the fold whose rows it never sees."""

    params: BoostParams = BoostParams()
    objective: losses.Objective = field(default_factory=losses.logistic)
    fold: int | None = None


@dataclass
class _Growing:
    """A fit under way: finished trees, those not yet in the stored margins, and the open one."""

    at: int
    fit: Fit
    fills: np.ndarray
    rng: np.random.Generator
    trees: list[Tree] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)
    stored: int = 0
    used: np.ndarray | None = None
    sums: dict[int, np.ndarray] = field(default_factory=dict)
    round_losses: list[float] = field(default_factory=list)
    done: bool = False


@dataclass(frozen=True)
class _Task:
    """What a pass needs to know of a fit; sent to the tasks."""

    at: int
    fit: Fit
    fills: np.ndarray
    pending: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]
    round: int = 0
    level: int = 0
    feature: np.ndarray | None = None
    cut: np.ndarray | None = None
    used: np.ndarray | None = None
    build: tuple[int, ...] = ()


#: A row of the state table holds a block of rows: each column's values one after the other.
STATE = "n int, key binary, y binary, fold binary, bins binary, margins binary"
#: Bytes of a block; a pass works on one at a time.
BLOCK_BYTES = 8 << 20
BATCH_BYTES = 8 << 20
#: Writers look at a row group's size after 100 rows, here of megabytes each, and count it
#: compressed; a reader holds a row group whole. Those of the state table are of two blocks.
STATE_FILES = {
    "parquet.block.row.count.limit": "2",
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "1",
    "parquet.enable.dictionary": "false",
}


def _bins_of(column, edges: np.ndarray) -> np.ndarray:
    """Bin of each value, -1 where there is none."""
    values = column.to_numpy(zero_copy_only=False).astype(np.float64)
    return np.where(np.isnan(values), -1, np.searchsorted(edges, values, side="right")).astype(np.int16)


def _lists(values: np.ndarray):
    import pyarrow as pa

    rows, width = values.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values).ravel()))


def _start(df: DataFrame, features, edges, margins: Sequence[float], id_col: str, target: str, fold_col: str | None) -> DataFrame:
    """State table: bins by feature and margins by fit, in blocks of rows that are spread evenly."""
    cuts = [np.array(e) for e in edges]
    most = max(1, BLOCK_BYTES // (20 + 2 * len(cuts) + 8 * len(margins)))

    def rows(batches) -> Iterator:
        for batch in batches:
            for lo in range(0, batch.num_rows, most):
                part = batch.slice(lo, most)
                key, y, fold = (part.column(j).to_numpy(zero_copy_only=False) for j in range(3))
                # a row without fold or label is in no fold, and has no label
                fold = np.nan_to_num(fold.astype(np.float64), nan=-2.0).astype(np.int32)
                bins = np.stack([_bins_of(part.column(3 + j), cut) for j, cut in enumerate(cuts)])
                yield _block(key, y.astype(np.float64), fold, bins, np.repeat(np.array(margins, float)[:, None], len(key), axis=1))

    fold = F.lit(-1) if fold_col is None else F.col(fold_col).cast("int")
    keyed = df.select(
        F.xxhash64(id_col).alias("key"), F.col(target).cast("double").alias("y"), fold.alias("fold"), *[F.col(c).cast("double") for c in features]
    )
    bounded_batches(df.sparkSession, BATCH_BYTES)
    return cut_lineage(keyed.repartition("key").mapInArrow(rows, STATE), "boost", options=STATE_FILES)


def _block(key, y, fold, bins, margins):
    """One row of the state table. ``bins`` and ``margins`` have a line per feature and fit."""
    import pyarrow as pa

    cells = [pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in (key, y, fold, bins, margins)]
    return pa.RecordBatch.from_arrays([pa.array([len(key)], pa.int32()), *cells], names=[c.split()[0] for c in STATE.split(", ")])


class _Rows:
    """A block of the state table, with each fold's view of it."""

    def __init__(self, n: int, key: bytes, y: bytes, fold: bytes, bins: bytes, margins: bytes):
        self.key = np.frombuffer(key, np.int64)
        self.y = np.frombuffer(y, np.float64)
        self.fold = np.frombuffer(fold, np.int32)
        self.bins = np.frombuffer(bins, np.int16).reshape(-1, n)
        self.margins = np.frombuffer(margins, np.float64).reshape(-1, n)
        self._gaps = bool((self.bins < 0).any())
        self._filled: dict[bytes, np.ndarray] = {}
        self._drawn: dict[tuple[int, int], np.ndarray] = {}
        self._inside: dict[tuple, np.ndarray] = {}

    def filled(self, fills: np.ndarray) -> np.ndarray:
        """Bins with gaps in the bins of the fills, feature by feature."""
        name = fills.tobytes() if self._gaps else b""
        if name not in self._filled:
            self._filled[name] = np.where(self.bins < 0, fills[:, None], self.bins) if self._gaps else self.bins
        return self._filled[name]

    def seen(self, task: _Task) -> np.ndarray:
        """Rows that a fit's round sees; fits of one fold and draw share them."""
        p = task.fit.params
        name = (task.fit.fold, p.subsample, p.seed if p.subsample < 1.0 else 0)
        if name not in self._inside:
            mine = np.ones(len(self.key), bool) if task.fit.fold is None else self.fold != task.fit.fold
            if p.subsample < 1.0:
                if (p.seed, task.round) not in self._drawn:
                    self._drawn[p.seed, task.round] = draws(self.key, p.seed, task.round)
                mine = mine & (self._drawn[p.seed, task.round] < p.subsample)
            self._inside[name] = np.flatnonzero(mine)
        return self._inside[name]

    def forget(self) -> None:
        """The draws of a round, once it is over."""
        self._drawn.clear()
        self._inside.clear()

    def margin(self, task: _Task, rows: np.ndarray | None = None) -> np.ndarray:
        """Margins, of some rows or all, with the trees that are not stored yet."""
        stored, bins = self.margins[task.at], self.filled(task.fills)
        total = stored.copy() if rows is None else stored[rows]
        for feature, cut, value, depth in task.pending:
            total += value[_stand(bins, feature, cut, depth, rows)]
        return total


def _blocks(batches) -> Iterator[_Rows]:
    for batch in batches:
        for k in range(batch.num_rows):
            n, *cells = (column[k] for column in batch.columns)
            yield _Rows(n.as_py(), *(c.as_buffer() for c in cells))


def _stand(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, steps: int, rows: np.ndarray | None = None) -> np.ndarray:
    """Node of each row, or of some of them, after ``steps`` levels. ``bins`` has a line per feature."""
    n = bins.shape[1]
    at = np.arange(n) if rows is None else rows
    node = np.ones(len(at), np.int64)
    if not steps:
        return node
    # a leaf leads to itself, whatever the bin
    leaf, places = feature < 0, np.arange(len(feature))
    low, line, limit = np.where(leaf, places, 2 * places), np.where(leaf, 0, feature) * n, np.where(leaf, 1 << 15, cut).astype(np.int32)
    flat = bins.reshape(-1)
    for _ in range(steps):
        node = low[node] + (flat[line[node] + at] > limit[node])
    return node


def _partial_sums(batches, tasks: Sequence[_Task], bins: int) -> Iterator:
    """Gradient sums of one partition: a row per (fit, node), with an array of all bins of all
    features."""
    import pyarrow as pa

    sums = {t.at: np.zeros((2, len(t.used), len(t.build) * bins)) for t in tasks}
    slots = {t.at: np.full(2 ** (t.level + 1), -1) for t in tasks}
    for t in tasks:
        slots[t.at][list(t.build)] = np.arange(len(t.build)) * bins
    seen = False
    for rows in _blocks(batches):
        seen = True
        for t in tasks:
            filled, mine = rows.filled(t.fills), rows.seen(t)
            base = slots[t.at][_stand(filled, t.feature, t.cut, t.level, mine)]
            if t.level:
                own = np.flatnonzero(base >= 0)
                mine, base = mine[own], base[own]
            g, h = t.fit.objective.arrays(rows.margin(t, mine), rows.y[mine])
            cells = len(t.build) * bins
            for j, f in enumerate(t.used):
                cell = base + filled[f][mine]
                for weights, table in ((g, sums[t.at][0, j]), (h, sums[t.at][1, j])):
                    if cells <= 2 * len(cell):
                        table += np.bincount(cell, weights, cells)
                    else:  # many nodes, few rows: a sum over all cells would cost more than the rows
                        np.add.at(table, cell, weights)
    for t in tasks if seen else ():
        table = sums[t.at].reshape(2, len(t.used), len(t.build), bins).transpose(0, 2, 1, 3)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(t.build), t.at, np.int32)),
                pa.array(np.array(t.build, np.int32)),
                _lists(table.transpose(1, 0, 2, 3).reshape(len(t.build), -1)),
            ],
            names=["fit", "node", "sums"],
        )


def _add_up(batches) -> Iterator:
    """Sums of equal (fit, node) in one partition."""
    import pyarrow as pa

    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for fit, node, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            values = sums.values.to_numpy()
            held = total.get((fit, node))
            total[fit, node] = values.copy() if held is None else held + values
    for (fit, node), values in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([fit], pa.int32()), pa.array([node], pa.int32()), _lists(values[None, :])], names=["fit", "node", "sums"]
        )


def _sent(df: DataFrame, tasks: Sequence[_Task]):
    """``tasks`` for all workers; objectives may be functions made on the spot."""
    return df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(list(tasks)))


def _received(held) -> list[_Task]:
    return pickle.loads(held.value)


def _tasks_of(state: DataFrame) -> int:
    """About the number of tasks that read a state table."""
    return max(state.sparkSession.sparkContext.defaultParallelism, stage_bytes(state) // TASK_BYTES)


def _histograms(state: DataFrame, tasks: Sequence[_Task], bins: int) -> dict[tuple[int, int], np.ndarray]:
    """One pass: sums ``(2, features, bins)`` per fit and node."""
    schema = "fit int, node int, sums array<double>"
    held = _sent(state, tasks)
    parts = state.mapInArrow(lambda batches: _partial_sums(batches, _received(held), bins), schema)
    size = sum(16 * len(t.build) * len(t.used) * bins for t in tasks)
    if size * _tasks_of(state) > PARTIAL_BYTES:
        parts = parts.repartition("fit", "node").mapInArrow(_add_up, schema)
    used = {t.at: len(t.used) for t in tasks}
    out: dict[tuple[int, int], np.ndarray] = {}
    found = parts.toArrow()
    for fit, node, sums in zip(found["fit"].to_pylist(), found["node"].to_pylist(), found["sums"], strict=True):
        table = sums.values.to_numpy().reshape(2, used[fit], bins)
        out[fit, node] = out[fit, node] + table if (fit, node) in out else table.copy()
    held.unpersist()
    return out


def best_splits(sums: np.ndarray, params: BoostParams) -> tuple[np.ndarray, ...]:
    """Of ``(2, node, feature, bin)`` sums, per node: gain, feature (by place) and bin of the best
    split, the sums on its left, and all sums. Ties go to the first feature, then the lowest bin."""
    nodes, used, bins = sums.shape[1:]
    total, left = sums[:, :, 0].sum(axis=2), np.cumsum(sums, axis=3)

    def part(g, h):
        return np.maximum(np.abs(g) - params.reg_alpha, 0.0) ** 2 / (h + params.reg_lambda + 1e-12)

    # an empty bin cuts as the one before it does
    cell = np.flatnonzero((sums[0] != 0) | (sums[1] != 0))
    node = cell // (used * bins)
    gl, hl = (side.ravel()[cell] for side in left)
    gt, ht = total[:, node]
    gr, hr = gt - gl, ht - hl
    gain = 0.5 * (part(gl, hl) + part(gr, hr) - part(total[0], total[1])[node])
    least = params.min_child_weight
    fits = (hl >= least) & (hr >= least) & (hr > 1e-12 * ht)
    rated = np.full(nodes * used * bins, -1.0)
    rated[cell] = np.where(fits, np.round(gain, 9), -1.0)
    rated = rated.reshape(nodes, -1)
    place, at = rated.argmax(axis=1), np.arange(nodes)
    f, b = np.divmod(place, bins)
    return rated[at, place], f, b, left[:, at, f, b], total


def _leaf(g, h, params: BoostParams):
    top = np.copysign(np.maximum(np.abs(g) - params.reg_alpha, 0.0), g)
    return -params.eta * top / (h + params.reg_lambda + 1e-12)


def _task(x: _Growing, **more) -> _Task:
    pending = [(t.feature, c, t.value, t.depth) for t, c in zip(x.trees[x.stored :], x.cuts[x.stored :], strict=True)]
    return _Task(x.at, x.fit, x.fills, pending, **more)


def _grow(state: DataFrame, growing: Sequence[_Growing], edges: Sequence[Sequence[float]], turn: int) -> None:
    """One tree more for every fit; a pass per level, shared by all."""
    bins = max((len(e) for e in edges), default=0) + 1
    opened: dict[int, tuple[Tree, np.ndarray]] = {}
    split: dict[int, list[int]] = {}
    for x in growing:
        p = x.fit.params
        x.used = _asked(x, len(edges))
        opened[x.at] = Tree(p.depth), np.zeros(2 ** (p.depth + 1), np.int64)
        split[x.at] = [0]  # as if the root were somebody's child
        x.sums = {}
    level, active = 0, list(growing)
    while active:
        node_bytes = {x.at: 16 * len(x.used) * bins for x in active}
        keep = sum(2 * len(split[x.at]) * node_bytes[x.at] for x in active) <= HISTOGRAM_BYTES
        work: list[tuple[_Growing, tuple[int, ...]]] = []
        for x in active:
            tree = opened[x.at][0]
            children = [(1,)] if level == 0 else [(2 * i, 2 * i + 1) for i in split[x.at]]
            if keep and x.sums:  # the sibling of the smaller child is what its parent has left
                children = [(min(pair, key=lambda c: tree.cover[c]),) for pair in children]
            work.append((x, tuple(sorted(c for pair in children for c in pair))))
        grown: dict[int, list[int]] = {x.at: [] for x in active}
        for portion in _portions(work, node_bytes, HISTOGRAM_BYTES):
            tasks = []
            for x, build in portion:
                tree, cut = opened[x.at]
                tasks.append(_task(x, round=turn, level=level, feature=tree.feature, cut=cut, used=x.used, build=build))
            found = _histograms(state, tasks, bins)
            for x, build in portion:
                empty = np.zeros((2, len(x.used), bins))
                own = {i: found.get((x.at, i), empty) for i in build}
                if keep and x.sums:
                    own |= {i ^ 1: x.sums[i // 2] - h for i, h in own.items()}
                x.sums = own if keep else {}
                nodes = np.array(sorted(own))
                sums = np.stack([own[i] for i in nodes.tolist()], axis=1)
                grown[x.at] += _split_nodes(*opened[x.at], nodes, sums, x.fit.params, x.used, edges).tolist()
        level += 1
        split = {at: sorted(nodes) for at, nodes in grown.items()}
        active = [x for x in active if split[x.at] and level < x.fit.params.depth]
    for x in growing:
        tree, cut = opened[x.at]
        x.trees.append(tree)
        x.cuts.append(cut)
        x.sums = {}


def _portions(work: list[tuple[_Growing, tuple[int, ...]]], node_bytes: dict[int, int], limit: int) -> Iterator:
    """``work`` in passes whose histograms stay within ``limit``; at least one node each."""
    held, size = [], 0
    for x, build in work:
        most = max(1, limit // node_bytes[x.at])
        for k in range(0, len(build), most):
            part = build[k : k + most]
            if held and size + len(part) * node_bytes[x.at] > limit:
                yield held
                held, size = [], 0
            held.append((x, part))
            size += len(part) * node_bytes[x.at]
    if held:
        yield held


def _split_nodes(tree: Tree, cut: np.ndarray, nodes: np.ndarray, sums: np.ndarray, params: BoostParams, used: np.ndarray, edges) -> np.ndarray:
    """Split the nodes that gain by it; returns them. ``sums`` are ``(2, node, feature, bin)``."""
    out = []
    for lo in range(0, len(nodes), NODES_AT_ONCE):
        part = nodes[lo : lo + NODES_AT_ONCE]
        gain, f, b, left, whole = best_splits(sums[:, lo : lo + NODES_AT_ONCE], params)
        if part[0] == 1:
            tree.value[1], tree.cover[1] = _leaf(*whole[:, 0], params), whole[1, 0]
        won = np.flatnonzero(gain > MIN_GAIN)
        part, f, b, left = part[won], used[f[won]], b[won], left[:, won]
        tree.feature[part], cut[part], tree.gain[part] = f, b, gain[won]
        tree.cut[part] = [edges[i][j] for i, j in zip(f, b, strict=True)]
        for child, (g, h) in ((2 * part, left), (2 * part + 1, whole[:, won] - left)):
            tree.value[child], tree.cover[child] = _leaf(g, h, params), h
        out.append(part)
    return np.concatenate(out) if out else nodes


def _asked(x: _Growing, features: int) -> np.ndarray:
    """Features that the fit's next tree may ask."""
    share, every = x.fit.params.colsample, np.arange(features)
    return every if share >= 1.0 else np.sort(x.rng.choice(every, max(1, int(round(share * features))), replace=False))


def _stored(state: DataFrame, growing: Sequence[_Growing]) -> DataFrame:
    """State with all finished trees in its margins."""
    held = _sent(state, [_task(x) for x in growing])

    def rows(batches) -> Iterator:
        tasks = _received(held)
        for view in _blocks(batches):
            margins = view.margins.copy()
            for t in tasks:
                margins[t.at] = view.margin(t)
            yield _block(view.key, view.y, view.fold, view.bins, margins)

    return cut_lineage(state.mapInArrow(rows, STATE), "boost", options=STATE_FILES)


def log_loss(margin: Column, y: Column) -> Column:
    """Logistic loss of a margin, without overflow."""
    return F.greatest(margin, F.lit(0.0)) - margin * y + F.log1p(F.exp(-F.abs(margin)))


def _mean_losses(watch: DataFrame, growing: Sequence[_Growing]) -> dict[int, float]:
    """Mean logistic loss of the watched rows per fit."""
    held = _sent(watch, [_task(x) for x in growing])

    def rows(batches) -> Iterator:
        import pyarrow as pa

        tasks = _received(held)
        for view in _blocks(batches):
            found = []
            for t in tasks:
                m = view.margin(t)
                found.append(float((np.logaddexp(0.0, m) - m * view.y).sum()))
            at = [t.at for t in tasks]
            columns = [pa.array(at, pa.int32()), pa.array(found), pa.array([len(view.key)] * len(at), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["fit", "loss", "n"])

    sums = watch.mapInArrow(rows, "fit int, loss double, n bigint").groupBy("fit").agg(F.sum("loss").alias("loss"), F.sum("n").alias("n"))
    return {r["fit"]: r["loss"] / r["n"] for r in sums.collect()}


def _begun(fits: Sequence[Fit], features, edges, fills) -> list[_Growing]:
    growing = []
    for k, fit in enumerate(fits):
        own = (fills or {}).get(fit.fold, {})
        bins = [np.searchsorted(e, own[c], side="right") if c in own else 0 for c, e in zip(features, edges, strict=True)]
        growing.append(_Growing(k, fit, np.array(bins, np.int16), np.random.default_rng(fit.params.seed)))
    return growing


def _fit_batch(
    train: DataFrame, features, edges, fits, id_col, target, fold_col, fills, valid, patience, keep: bool = True
) -> tuple[list[BoostedModel], DataFrame, list[_Growing]]:
    """Models of one batch, and the state of the train rows with all their margins. Unless they are
    to ``keep``, trees go once the margins have them: a search makes more than a driver holds."""
    margins = [f.params.base_margin for f in fits]
    state = _start(train, features, edges, margins, id_col, target, fold_col)
    watch = None if valid is None else _start(valid, features, edges, margins, id_col, target, None)
    growing = _begun(fits, features, edges, fills)
    every = 1 if len(fits) >= MANY_FITS else REWRITE_EVERY
    turn = 0
    while active := [x for x in growing if not x.done]:
        _grow(state, active, edges, turn)
        turn += 1
        if watch is not None:
            for at, loss in _mean_losses(watch, active).items():
                growing[at].round_losses.append(loss)
        for x in active:
            stale = x.round_losses and turn - 1 - int(np.argmin(x.round_losses)) >= patience
            x.done = bool(stale) or turn >= x.fit.params.rounds
        if turn % every == 0 and any(not x.done for x in growing):
            old, state = state, _stored(state, growing)
            drop_stage(old)
            if watch is not None:
                old, watch = watch, _stored(watch, growing)
                drop_stage(old)
            for x in growing:
                if not keep:
                    x.trees, x.cuts = [], []
                x.stored = len(x.trees)
    models = []
    for x in growing:
        best = int(np.argmin(x.round_losses)) + 1 if x.round_losses else len(x.trees)
        models.append(BoostedModel(list(features), x.trees[:best], x.fit.params.base_margin, x.round_losses))
    return models, state, growing


def boosted_fits(
    train: DataFrame,
    features: Sequence[str],
    fits: Sequence[Fit],
    id_col: str = "row_id",
    target: str = "y",
    fold_col: str | None = None,
    fills: dict[int | None, dict[str, float]] | None = None,
    valid: DataFrame | None = None,
    patience: int = 20,
) -> list[BoostedModel]:
    """Models of all ``fits``, in passes that they share: the rounds times the depth of the
    longest, for ``FITS_AT_ONCE`` of them at a time.

    A fit with a fold leaves its rows out. ``fills`` has the values that fill a fold's gaps.
    Bin bounds come from all train rows, without their labels. Margins live in the row table,
    which is rewritten to the shared folder so that lost tasks can restart.

    With ``valid`` rows a fit stops ``patience`` rounds after their mean logistic loss last
    fell, and its model keeps the trees up to the best round; the losses are in ``round_losses``.
    """
    edges = {}
    out: list[BoostedModel] = []
    for k in range(0, len(fits), FITS_AT_ONCE):
        part = list(fits[k : k + FITS_AT_ONCE])
        bins = max(f.params.bins for f in part)
        if bins not in edges:
            edges[bins] = bin_edges(train, features, bins)
        models, state, _ = _fit_batch(train, features, edges[bins], part, id_col, target, fold_col, fills, valid, patience)
        drop_stage(state)
        out += models
    return out


COUNTS = ("tp", "fp", "fn", "tn")


def _judged(margin: np.ndarray, y: np.ndarray, cut: float) -> tuple[int, ...]:
    """``COUNTS`` of held-out rows."""
    hit, one = margin >= cut, y == 1
    return int((hit & one).sum()), int((hit & ~one).sum()), int((~hit & one).sum()), int((~hit & ~one).sum())


def _counted(found: list[tuple]):
    """Arrow batch of (fit, fold, counts)."""
    import pyarrow as pa

    columns = [pa.array(np.array(c, np.int64)) for c in zip(*found, strict=True)]
    return pa.RecordBatch.from_arrays([columns[0].cast("int32"), columns[1].cast("int32"), *columns[2:]], names=["fit", "fold", *COUNTS])


def _whole_rows(train: DataFrame, features, edges, id_col: str, target: str, fold_col: str):
    """All rows, binned, for every task, if they fit one; else None. Their order does not depend on
    the partitions."""
    if not 0 < train.count() * (20 + 2 * len(features)) <= ALONE_BYTES:
        return None
    state = _start(train, features, edges, [], id_col, target, fold_col)
    blocks = list(_blocks(state.toArrow().to_batches()))
    drop_stage(state)
    cells = [np.concatenate([getattr(b, c) for b in blocks], axis=-1) for c in ("key", "y", "fold", "bins")]
    order = np.lexsort((cells[2], cells[1], *cells[3], cells[0]))
    return train.sparkSession.sparkContext.broadcast([np.ascontiguousarray(c[..., order]) for c in cells])


def _bin_sums(bins: np.ndarray, used: np.ndarray, rows: np.ndarray, slot: np.ndarray, g: np.ndarray, h: np.ndarray, slots: int, width: int) -> np.ndarray:
    """Sums ``(2, slot, feature, bin)`` over some rows."""
    out, base = np.zeros((2, slots, len(used), width)), slot * width
    for j, f in enumerate(used):
        cell = base + bins[f][rows]
        for side, weights in zip(out, (g, h), strict=True):
            side[:, j] = np.bincount(cell, weights, slots * width).reshape(slots, width)
    return out


def _grow_alone(view: _Rows, x: _Growing, margin: np.ndarray, edges, turn: int) -> None:
    """As ``_grow``, for one fit that has all rows at hand: they keep their node from level to level,
    and those of finished nodes are left behind. ``margin`` follows."""
    p, width = x.fit.params, max((len(e) for e in edges), default=0) + 1
    used, bins = _asked(x, len(edges)), view.filled(x.fills)
    tree, cut = Tree(p.depth), np.zeros(2 ** (p.depth + 1), np.int64)
    rows = view.seen(_task(x, round=turn))
    rest = np.ones(len(margin), bool)
    rest[rows] = False
    g, h = x.fit.objective.arrays(margin[rows], view.y[rows])
    node, flat, n = np.ones(len(rows), np.int64), bins.reshape(-1), len(margin)
    build, parents, held = np.array([1]), np.zeros(0, np.int64), np.zeros(0)
    for level in range(p.depth):
        slots = np.full(2 ** (level + 1), -1)
        slots[build] = np.arange(len(build))
        slot = slots[node]
        own = np.flatnonzero(slot >= 0)
        sums = _bin_sums(bins, used, rows[own], slot[own], g[own], h[own], len(build), width)
        nodes = build
        if level:  # the sibling of the smaller child is what its parent has left
            nodes, sums = np.concatenate([build, build ^ 1]), np.concatenate([sums, held - sums], axis=1)
            order = np.argsort(nodes)
            nodes, sums = nodes[order], sums[:, order]
        parents = _split_nodes(tree, cut, nodes, sums, p, used, edges)
        f = tree.feature[node]
        live = np.flatnonzero(f >= 0)
        if len(live) < len(node):
            done = np.flatnonzero(f < 0)
            margin[rows[done]] += tree.value[node[done]]
            rows, node, g, h, f = rows[live], node[live], g[live], h[live], f[live]
        if not len(parents):
            break
        node = 2 * node + (flat[f * n + rows] > cut[node])
        held = sums[:, np.searchsorted(nodes, parents)]
        build = 2 * parents + (tree.cover[2 * parents + 1] < tree.cover[2 * parents])
    margin[rows] += tree.value[node]
    rest = np.flatnonzero(rest)
    margin[rest] += tree.value[_stand(bins, tree.feature, cut, p.depth, rest)]


def _counts_alone(spark: SparkSession, rows, growing: Sequence[_Growing], edges, cut: float, first: int) -> DataFrame:
    """Held-out counts of fits that grow in a task each, those of most work first."""
    ordered = sorted(growing, key=lambda x: -x.fit.params.rounds * x.fit.params.depth)
    held = spark.sparkContext.broadcast([cloudpickle.dumps(x) for x in ordered])

    def grow(batches) -> Iterator:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                x = pickle.loads(held.value[k])
                key, y, fold, bins = rows.value
                view = _Rows(len(key), key, y, fold, bins, b"")
                margin = np.full(len(key), x.fit.params.base_margin)
                for turn in range(x.fit.params.rounds):
                    view.forget()
                    _grow_alone(view, x, margin, edges, turn)
                mine = np.flatnonzero(fold == x.fit.fold)
                yield _counted([(first + x.at, x.fit.fold, *_judged(margin[mine], y[mine], cut))])

    schema = "fit int, fold int, " + ", ".join(f"{c} bigint" for c in COUNTS)
    return spark.range(0, len(ordered), 1, len(ordered)).mapInArrow(grow, schema)


def out_of_fold_counts(
    train: DataFrame,
    features: Sequence[str],
    fits: Sequence[Fit],
    fold_col: str = "fold",
    id_col: str = "row_id",
    target: str = "y",
    fills: dict[int | None, dict[str, float]] | None = None,
    threshold: float = 0.5,
    edges: dict[int, list] | None = None,
    whole: dict | None = None,
) -> DataFrame:
    """``(fit, fold, tp, fp, fn, tn)`` of each fit over the rows of the fold it left out. The
    margins of those rows grow along with the trees, so nothing is scored again.

    Where all rows fit a task, each fit grows in one; else they share passes. ``edges`` keeps bin
    bounds by their number from call to call, and ``whole`` the rows for all tasks."""
    cut = math.log(threshold / (1.0 - threshold))
    edges, whole = {} if edges is None else edges, {} if whole is None else whole
    parts = []
    for k in range(0, len(fits), FITS_AT_ONCE):
        part = list(fits[k : k + FITS_AT_ONCE])
        bins = max(f.params.bins for f in part)
        if bins not in edges:
            edges[bins] = bin_edges(train, features, bins)
        level = 16 * len(features) * bins * 2 ** max(f.params.depth for f in part)
        if bins not in whole and level <= ALONE_BYTES:
            whole[bins] = _whole_rows(train, features, edges[bins], id_col, target, fold_col)
        state = None
        if level <= ALONE_BYTES and whole[bins] is not None:
            growing = _begun(part, features, edges[bins], fills)
            counts = _counts_alone(train.sparkSession, whole[bins], growing, edges[bins], cut, k)
        else:
            _, state, growing = _fit_batch(train, features, edges[bins], part, id_col, target, fold_col, fills, None, 0, keep=False)
            held = _sent(train, [_task(x) for x in growing])

            def rows(batches, held=held, first=k) -> Iterator:
                tasks = _received(held)
                for view in _blocks(batches):
                    found = []
                    for t in tasks:
                        mine = np.flatnonzero(view.fold == t.fit.fold)
                        found.append((first + t.at, t.fit.fold, *_judged(view.margin(t, mine), view.y[mine], cut)))
                    yield _counted(found)

            counts = state.mapInArrow(rows, "fit int, fold int, tp bigint, fp bigint, fn bigint, tn bigint")
        parts.append(cut_lineage(counts.groupBy("fit", "fold").agg(*[F.sum(c).alias(c) for c in COUNTS]), "counts"))
        if state is not None:
            drop_stage(state)
    table = parts[0]
    for more in parts[1:]:
        table = table.unionByName(more)
    return table


def boosted_trees_fit(
    train: DataFrame,
    features: Sequence[str],
    params: BoostParams = BoostParams(),
    objective: losses.Objective | None = None,
    id_col: str = "row_id",
    target: str = "y",
    valid: DataFrame | None = None,
    patience: int = 20,
) -> BoostedModel:
    """``boosted_fits`` of one model, on imputed rows."""
    fit = Fit(params, objective or losses.logistic())
    return boosted_fits(train, features, [fit], id_col, target, valid=valid, patience=patience)[0]
