from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from llm_cases import edge_rows

from rarespark.llm import simhash_dedup as S
from rarespark.llm.components import components


def fingerprint(text):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(rows):
    """Brute force: components of all rows, by the smallest id in them."""
    fps = [fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4 and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    out = []
    for k, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[k] and rows[j][0] is not None]
        out.append((doc_id, f"{fps[k]:016x}", min(ids) if ids else None))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in S.near_duplicate_classes(df).collect()), key=repr)


def near_copies(seed):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(400)}" for _ in range(300)] for _ in range(8)]
    rows = []
    for i in range(120):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10_000)}"
        rows.append((1000 - i, " ".join(w)))
    return rows


def test_edge_cases(edge):
    assert found(edge) == classes([r[:2] for r in edge_rows()])


def test_empty_table(empty):
    assert found(empty) == []
    assert S.one_per_class(empty).collect() == []


@pytest.mark.parametrize("block", [4096, 4])
def test_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK", block)
    rows = near_copies(1)
    want = classes(rows)
    assert 8 < len({r[2] for r in want}) < 100
    assert found(spark.createDataFrame(rows, "doc_id bigint, text string")) == want


def test_cells_lose_no_link():
    """Every pair in range meets in a cell, also at the ends of the counts."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(4)
    for _ in range(150):
        a = rng.choice([0, 2**64 - 1, rng.getrandbits(64)])
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 4)):
            b ^= 1 << bit
        batch = pa.RecordBatch.from_arrays(
            [pa.array(np.array([a, b], np.uint64).view(np.int64)), pa.array([1, 2]), pa.array([0, 0])], ["fp", "node", "kind"]
        )
        cells = {1: set(), 2: set()}
        for out in S._cells(iter([batch])):
            for cell, node in zip(out.column(0).to_pylist(), out.column(2).to_pylist()):
                cells[node].add(cell)
        assert cells[1] & cells[2]


def test_one_of_each_class_stays(spark, edge):
    """The stage's rule is the bit distance alone: row 8 has a word more at both ends, and stays."""
    kept = S.one_per_class(edge)
    assert kept.schema == edge.schema
    got = sorted((r.doc_id, (r.text or "")[:5]) for r in kept.collect())
    assert got == [(1, "one t"), (2, ""), (5, "w0x0 "), (6, "ÀÉ ﬁn"), (8, "x one"), (9, "anoth"), (9, "short")]
    assert {i for i, _ in got} == {r[2] for r in classes([r[:2] for r in edge_rows()])}
    twice = edge.where("doc_id in (8, 9)")
    assert S.one_per_class(twice).count() == 3


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(100, 100 + i) for i in range(1, 80)]
    loops = [(300, 300), (301, 302), (302, 301), (301, 302)]
    links = spark.createDataFrame(chain + star + loops, "a bigint, b bigint")
    got = {r.node: r.root for r in components(links).collect()}
    want = {i: 1 for i in range(1, 61)} | {i: 100 for i in range(100, 180)} | {301: 301, 302: 301}
    assert got == want


def test_stage_keeps_the_first_of_each_class(spark):
    rows = near_copies(6) + [(5000 + i, f"text of its own {i} {i * 7} {i * 13}") for i in range(20)]
    kept = S.one_per_class(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r[2] for r in classes(rows)})


LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def test_brute_force_over_the_given_table(spark):
    """All pairs of fingerprints of a whole table, compared bit by bit."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    ids = sorted(texts)
    fps = np.array([S.fingerprint(texts[i].translate(LOWER)) for i in ids], np.uint64)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, fp in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(fps[:k] ^ fp) <= 4):
            a, b = find(ids[k]), find(ids[j])
            root[max(a, b)] = min(a, b)
    want = sorted((i, f"{fp:016x}", find(i)) for i, fp in zip(ids, fps.tolist(), strict=True))
    assert len({r[2] for r in want}) < len(want)
    assert found(docs) == sorted(want, key=repr)
    assert sorted(r.doc_id for r in S.one_per_class(docs).collect()) == sorted({r[2] for r in want})
