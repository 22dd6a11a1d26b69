"""SimHash near-duplicates: fingerprints linked at a few differing bits.

Fingerprints are embedded as bit counts of 2-bit segments. The Manhattan distance of two
such vectors is at most the number of differing bits, so a grid range-join over the
vectors finds every link: of 4 differing bits at most 1 lies in the lower half or at most
2 lie in the upper half. A vector is put into its own grid cell and those next to it, so
that two vectors in range meet in a cell; there the fingerprints themselves are compared.

Only distinct fingerprints are joined. Inside a cell links are contracted to one star per
group, so no pairs are emitted; a cell with many fingerprints is split into blocks, and
pairs of blocks are dealt out as separate groups.

Nulls: a null text counts as empty; empty texts have fingerprint zero and are linked like
any other. Rows without id belong to the component of their fingerprint, whose id is the
smallest one present (null if there is none). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from rarespark.llm import words as W
from rarespark.llm.components import components
from rarespark.session import cut_lineage

SHINGLE = 4
DISTANCE = 4
SEED = 42
BLOCK = 4096
CHUNK = 1 << 16
SHORT_RUN = 32
COUNT_BUCKETS = 1 << 16

HALF = np.uint64(0xFFFFFFFF)
ODD = np.uint64(0x5555555555555555)
ONE = np.uint64(1)
LOWER_TAG = np.uint64(1 << 32)


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """SimHash of a text: each bit that is set in over half the hashes of its word shingles."""
    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    n = max(1, len(found) - size + 1)
    starts = np.zeros(n, np.int64)
    starts[1:] = ends[: n - 1] + 1
    lasts = ends[-n:]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for a in range(0, n, CHUNK):
        pairs = zip(starts[a : a + CHUNK].tolist(), lasts[a : a + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(joined[s:e], SEED) for s, e in pairs], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(size: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = W.utf8_buffer(batch.column(1))
            raw = data.tobytes()
            out = [fingerprint(raw[a:b], size) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(np.array(out, np.uint64).view(np.int64))], ["doc_id", "key", "fp"]
            )

    return rows


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """``(doc_id, key, fp)``: the fingerprint's bits as a long; ``key`` tells texts apart."""
    W.bounded_batches(docs.sparkSession)
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), W.text_key(F.col(text_col)).alias("key")
    )
    return texts.mapInArrow(_fingerprints(size), "doc_id bigint, key bigint, fp bigint")


def _moves(cells: np.ndarray, at: np.ndarray):
    """Own cell and the cells one step away, with the row of each. A cell holds a bit count
    in every 2 of its lower 32 bits."""
    yield cells, at
    for k in range(0, 32, 2):
        step = ONE << np.uint64(k)
        here = cells >> np.uint64(k) & np.uint64(3)
        up, down = here < 2, here > 0
        yield cells[up] + step, at[up]
        yield cells[down] - step, at[down]


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grid cells of each fingerprint; those of different kinds never share a cell.

    Upper half, range 2: both sides visit their neighbours and meet half-way. Lower half,
    range 1: of two neighbouring vectors one has an odd sum, and only that one visits.
    """
    for batch in batches:
        fps = batch.column(0).to_numpy().view(np.uint64)
        nodes = batch.column(1).to_numpy()
        kind = batch.column(2).to_numpy().astype(np.uint64) << np.uint64(33)
        counts = (fps & ODD) + (fps >> ONE & ODD)
        upper, lower = (counts >> np.uint64(32)) | kind, (counts & HALF) | LOWER_TAG | kind
        odd = np.bitwise_count(fps & HALF) % 2 == 1
        every = np.arange(len(fps))
        parts = [*_moves(upper, every), *_moves(lower[odd], every[odd]), (lower[~odd], every[~odd])]
        for cell, at in parts:
            yield pa.RecordBatch.from_arrays([W.signed(cell), W.signed(fps[at]), pa.array(nodes[at])], ["cell", "fp", "node"])


def _differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints of one word, or of several in a row."""
    bits = np.bitwise_count(x ^ y)
    return bits if bits.ndim == 1 else bits.sum(axis=1)


def _stars(fps: np.ndarray, nodes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(node, root)`` of one cell: each group of linked fingerprints as a star."""
    left, members, roots = np.arange(len(fps)), [], []
    while len(left) > 1:
        root, left, queue = left[0], left[1:], [left[0]]
        while queue and len(left):
            near = _differing(fps[left], fps[queue.pop()]) <= distance
            if near.any():
                reached = left[near]
                left = left[~near]
                members.append(nodes[reached])
                roots.append(np.full(len(reached), nodes[root]))
                queue.extend(reached)
    if not members:
        return nodes[:0], nodes[:0]
    return np.concatenate(members), np.concatenate(roots)


def _group_links(group: np.ndarray, fps: np.ndarray, nodes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside the runs of equal ``group``. Short runs are compared side by side."""
    edges = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(edges, len(group)))
    a, b = [nodes[:0]], [nodes[:0]]
    for at in np.flatnonzero(sizes > SHORT_RUN):
        run = slice(edges[at], edges[at] + sizes[at])
        x, y = _stars(fps[run], nodes[run], distance)
        a.append(x)
        b.append(y)
    short = np.repeat(sizes <= SHORT_RUN, sizes)
    group, fps, nodes = group[short], fps[short], nodes[short]
    for step in range(1, SHORT_RUN):
        same = np.flatnonzero(group[step:] == group[:-step])
        if not len(same):
            break
        near = same[_differing(fps[same], fps[same + step]) <= distance]
        a.append(nodes[near + step])
        b.append(nodes[near])
    return np.concatenate(a), np.concatenate(b)


def _contracted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a batch as one star per group, so a batch never emits more links than nodes."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[u], label[v])
        after = label.copy()
        np.minimum.at(after, u, least)
        np.minimum.at(after, v, least)
        after = after[after]
        if (after == label).all():
            break
        label = after
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _links(distance: int):
    """Rows ``(group, fingerprint words, node)`` come sorted by group; a group that a batch
    cuts waits for the next one."""

    def emit(*rows):
        a, b = _group_links(*rows, distance)
        if len(a):
            a, b = _contracted(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, fps, nodes = np.zeros(0, np.int64), None, np.zeros(0, np.int64)
        for batch in batches:
            words = [c.to_numpy().view(np.uint64) for c in batch.columns[1:-1]]
            own = words[0] if len(words) == 1 else np.stack(words, axis=1)
            group = np.concatenate([group, batch.column(0).to_numpy()])
            fps = own if fps is None else np.concatenate([fps, own])
            nodes = np.concatenate([nodes, batch.columns[-1].to_numpy()])
            cut = int(np.searchsorted(group, group[-1])) if len(group) else 0
            yield from emit(group[:cut], fps[:cut], nodes[:cut])
            group, fps, nodes = group[cut:], fps[cut:], nodes[cut:]
        if fps is not None:
            yield from emit(group, fps, nodes)

    return rows


def _hot_cells(cells: DataFrame) -> DataFrame | None:
    """``(cell, count)`` of the cells with more than ``BLOCK`` rows, or None.

    Rows are counted by a hash of their cell first, so that a task sends few counts; only
    the cells behind large counts are counted one by one.
    """
    bucket = F.pmod(F.xxhash64("cell"), F.lit(COUNT_BUCKETS))
    large = cells.groupBy(bucket.alias("bucket")).count().where(F.col("count") > BLOCK).select("bucket")
    large = cut_lineage(large, "large")  # COUNT_BUCKETS rows at most
    if large.isEmpty():
        return None
    some = cells.withColumn("bucket", bucket).join(F.broadcast(large), "bucket", "left_semi")
    hot = cut_lineage(some.groupBy("cell").count().where(F.col("count") > BLOCK), "hot")
    return None if hot.isEmpty() else hot


def _groups(cells: DataFrame) -> DataFrame:
    """Rows ``(cell, fingerprint words, node)`` by ``grp``: cells as groups; a hot cell as
    pairs of its blocks."""
    hot = _hot_cells(cells)
    rest = cells.columns[1:]
    if hot is None:
        return cells.select(F.col("cell").alias("grp"), *rest)
    split = cells.join(hot, "cell", "left")
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    pairs = split.where("count is not null").select(
        "cell", *rest, own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    )
    dealt = pairs.select(F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")).alias("grp"), *rest)
    return split.where("count is null").select(F.col("cell").alias("grp"), *rest).unionByName(dealt)


def links(fps: DataFrame) -> DataFrame:
    """``(a, b)``: links between nodes of ``fps (fp, node, kind)`` that connect exactly
    those with fingerprints of one kind at most ``DISTANCE`` bits apart, directly or
    through others."""
    # A fingerprint makes some 40 rows: the short table is spread over all tasks first.
    tasks = 2 * int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = fps.select("fp", "node", "kind").repartition(tasks).mapInArrow(_cells, "cell bigint, fp bigint, node bigint")
    return _groups(cells).repartition("grp").sortWithinPartitions("grp").mapInArrow(_links(DISTANCE), "a bigint, b bigint")


def _ranked(doc_id: str = "doc_id", key: str = "key"):
    """Order of the rows of a component: smallest id first, rows without id last."""
    return F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"), F.col(key).alias("key"))


def _classes(rows: DataFrame) -> DataFrame:
    """``(doc_id, key, node, first)`` from ``rows (doc_id, key, node)``, whose nodes are
    fingerprints; ``first`` is the first row of the component."""
    distinct = cut_lineage(rows.groupBy("node").agg(F.min(_ranked()).alias("first")), "distinct")
    each = distinct.select("node", F.lit(0).alias("kind"), F.col("node").alias("fp"))
    roots = components(links(each)).withColumnRenamed("node", "linked")
    rooted = cut_lineage(
        distinct.join(roots, F.col("node") == F.col("linked"), "left").select("node", "first", F.coalesce("root", "node").alias("root")),
        "rooted",
    )
    least = cut_lineage(rooted.groupBy("root").agg(F.min("first").alias("first")), "least")
    named = cut_lineage(rooted.select("node", "root").join(least, "root").drop("root"), "named")
    return rows.select("doc_id", "key", "node").join(named, "node").select("doc_id", "key", "node", "first")


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its fingerprint in hexadecimal and the smallest id it is linked to."""
    rows = fingerprints(docs, id_col, text_col).select("doc_id", "key", F.col("fp").alias("node"))
    found = _classes(cut_lineage(rows, "fingerprints"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), F.col("first.id").alias("component_id")
    )


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with all columns, that are the first of their component: that with the
    smallest id; rows without id rank last. Rows that repeat an id and text are kept once."""
    names = docs.columns
    rows = fingerprints(docs, id_col, text_col).select("doc_id", "key", F.col("fp").alias("node"))
    found = cut_lineage(_classes(cut_lineage(rows, "fingerprints")), "classes")
    gone = found.where(_ranked() != F.col("first")).select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"))
    match = F.col(id_col).cast("bigint").eqNullSafe(F.col("__id")) & (W.text_key(F.col(text_col)) == F.col("__key"))
    kept = docs.join(gone, match, "left_anti").select(*names)
    repeated = found.groupBy("doc_id", "key").count().where("count > 1")
    return kept if repeated.isEmpty() else kept.dropDuplicates([id_col, text_col])
