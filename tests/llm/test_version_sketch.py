from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from llm_cases import edge_rows, random_docs

from rarespark.llm import version_sketch as V
from rarespark.llm.words import text_key


def likeness(a, b):
    a, b = (set(V.paragraph_digests(t).tolist()) for t in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    """``rows`` in order: each beside its successor, the last beside the first."""
    out = []
    for k, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), likeness(text, edited), likeness(text, after)))
    return sorted(out, key=repr)


def found(df):
    columns = ["doc_id", "n_chars", "edited_sha256", "near_edited", "near_next"]
    return sorted((tuple(r) for r in V.compare_with_next(df).select(columns).collect()), key=repr)


def in_order(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    keys = [r.k for r in df.select(text_key(df.text).alias("k")).collect()]
    ranked = sorted(zip(rows, keys), key=lambda x: (x[0][0] is None, x[0][0] or 0, x[1]))
    return df, [r for r, _ in ranked]


@pytest.mark.parametrize("rows", [random_docs(3), [r[:2] for r in edge_rows()], [(7, "One. Two. Three.")], [(None, "a b"), (None, "c d e f")]])
def test_against_brute_force(spark, rows):
    df, ordered = in_order(spark, rows)
    assert found(df.repartition(5)) == expected(ordered)


def test_equal_texts_have_equal_fingerprints(spark):
    rows = [(i, "Same text. With two sentences." if i % 2 else f"Other {i}.") for i in range(10)]
    got = V.compare_with_next(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len({r.fingerprint for r in got if r.doc_id % 2}) == 1
    assert len({r.fingerprint for r in got}) == 6


def test_empty_table(empty):
    assert V.compare_with_next(empty).collect() == []


def test_peeling_recovers_the_digests():
    rng = random.Random(1)
    for common, a, b in [(0, 0, 0), (1000, 0, 1), (10, 3, 4), (0, 500, 0), (200, 300, 250)]:
        every = np.array([rng.getrandbits(64) for _ in range(common + a + b)], np.uint64)
        x, y = V.Fingerprint(""), V.Fingerprint("")
        x.digests, y.digests = every[: common + a], np.concatenate([every[:common], every[common + a :]])
        only_x, only_y = V.differing(x, y)
        assert set(only_x.tolist()) == set(every[common : common + a].tolist())
        assert set(only_y.tolist()) == set(every[common + a :].tolist())


def test_a_small_table_fails_and_says_so():
    digests = np.arange(1, 200, dtype=np.uint64)
    small = V.Sketch(V.BASE_CELLS, 0)
    small.add(digests, np.ones(len(digests), np.uint64))
    assert small.minus(V.Sketch(V.BASE_CELLS, 0)).peel() is None
