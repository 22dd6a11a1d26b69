from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import edge_rows

from rarespark.llm import toxicity as T


def labelled(n=600, seed=5):
    rng = random.Random(seed)
    calm = ["river", "stone", "Cloud", "garden", "été", "music", "window", "paper", "light", "table"]
    bad = ["grolk", "grolken", "VEXIT", "vexitos", "smurgle"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(calm) for _ in range(rng.randint(3, 60))]
        toxic = int(rng.random() < 0.25)
        for _ in range(toxic * 2):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        docs.append((i, " ".join(words), "en", 1))
        if i % 3:
            labels.append((i, 1, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = labelled()
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, label string, score int"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_held_out_rows_are_told_apart(tables):
    docs, labels = tables
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = T.score_report(docs, labels).collect()
    assert len(rows) == 600
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    right = [r.predicted == truth[r.doc_id] for r in held if r.doc_id in truth]
    assert len(right) > 50 and sum(right) / len(right) > 0.97


def test_held_out_labels_are_not_read(tables, spark):
    docs, labels = tables
    turned = labels.withColumn("toxic", T.F.when(T.is_held_out(T.F.col("doc_id")), 1 - T.F.col("toxic")).otherwise(T.F.col("toxic")))
    a, b = (T.fit(T.training_rows(docs, x)) for x in (labels, turned))
    assert a.intercept == b.intercept and (a.weights == b.weights).all()


def test_stage_keeps_clean_rows(tables):
    docs, labels = tables
    model = T.fit(T.training_rows(docs, labels))
    scores = {(r.doc_id): r.score for r in T.scores(docs, model).collect()}
    kept = T.remove_toxic(docs, labels)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {i for i, s in scores.items() if s < 0.5}


def test_edge_cases(tables, edge, empty, spark):
    docs, labels = tables
    model = T.fit(T.training_rows(docs, labels))
    got = T.scores(edge, model).collect()
    assert len(got) == len(edge_rows())
    blank = 1 / (1 + math.exp(-model.intercept))
    assert sum(abs(r.score - blank) < 1e-12 for r in got) >= 4
    assert T.score_report(empty, labels).collect() == []
    assert T.remove_toxic(empty, labels).collect() == []
    nothing = labels.where("false")
    assert {r.predicted for r in T.score_report(edge, nothing).collect()} == {0}
    rows = spark.createDataFrame([(1, None), (None, 1), (999_999, 1)], "doc_id bigint, toxic int")
    assert {r.predicted for r in T.score_report(edge, rows).collect()} <= {0, 1}


def test_sample_is_bounded(tables):
    docs, labels = tables
    assert T.training_rows(docs, labels, sample=50).count() == 50


def test_features_are_the_distinct_ngrams_of_each_row():
    texts = ["Éa bÉa", "", "ab", "abc", "😀😀😀"]
    data = "".join(texts).encode()
    bounds = np.cumsum([0, *(len(t.encode()) for t in texts)])
    row, bucket = T._features(np.frombuffer(data, np.uint8), bounds, None)
    want = [len({t[i : i + n] for n in T.SIZES for i in range(len(t) - n + 1)}) for t in texts]
    assert np.bincount(row, minlength=5).tolist() == want
    alone = [T._features(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]), None)[1].tolist() for t in texts]
    assert [bucket[row == k].tolist() for k in range(5)] == alone


def plain_buckets(text):
    """Buckets of a text's distinct n-grams, one n-gram at a time."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" or ("À" <= c <= "Þ" and c != "×") else c for c in text or "")
    out, top = set(), 2**64
    for size in T.SIZES:
        for i in range(len(low) - size + 1):
            h = 0
            for c in low[i : i + size]:
                h = (h * T.W.WORD_STEP + ord(c) + (size << 32)) % top
            for step in (int(T.W.MIX_1), int(T.W.MIX_2)):
                h = (h ^ (h >> 33)) * step % top
            out.add((h ^ (h >> 33)) >> (64 - T.BUCKET_BITS))
    return out


def test_ratios_and_scores_match_plain_counting(spark):
    """Log-count ratios counted plainly; scores are sums of plain weights over a text's n-grams;
    the weights are where the penalised logistic loss has no slope."""
    docs, labels = labelled(240, 3)
    text = {d[0]: d[1] for d in docs}
    rows = [(y, text[i]) for i, _, y in labels]
    model = T.fit(spark.createDataFrame(rows, "label int, text string"))
    held = [(y, plain_buckets(t)) for y, t in rows]
    n = [sum(y == k for y, _ in held) for k in (0, 1)]
    count = [Counter(b for y, own in held if y == k for b in own) for k in (0, 1)]
    ratio = {b: math.log((count[1][b] + 1) / (n[1] + 2)) - math.log((count[0][b] + 1) / (n[0] + 2)) for b in count[0] | count[1]}
    telling = sorted(b for b, r in ratio.items() if abs(r) >= T.LEAST_RATIO and count[0][b] + count[1][b] >= T.LEAST_TEXTS)
    assert 20 < len(telling) <= T.FEATURES and set(np.flatnonzero(model.weights)) <= set(telling)
    x = np.array([[ratio[b] if b in own else 0.0 for b in telling] for _, own in held])
    y = np.array([y for y, _ in held])
    coefficients = np.array([model.weights[b] / ratio[b] for b in telling])
    gap = 1 / (1 + np.exp(-(x @ coefficients + model.intercept))) - y
    assert abs(gap.mean()) < 1e-3 and np.abs(x.T @ gap / len(y) + T.PENALTY * coefficients).max() < 2e-3
    got = {r.doc_id: r.score for r in T.scores(spark.createDataFrame([d[:2] for d in docs] + [(-1, None)], "doc_id bigint, text string"), model).collect()}
    for i, t in [*text.items(), (-1, None)]:
        margin = model.intercept + sum(model.weights[b] for b in plain_buckets(t))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-12)
