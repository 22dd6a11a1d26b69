from __future__ import annotations

import hashlib
import re

import pytest
from llm_cases import edge_rows, random_docs

from rarespark.llm import substring_dedup as S


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def covered(rows):
    """Brute force: per row, the flags of removed words."""
    first = {}
    for doc_id, text in rows:
        w = words(text)
        if doc_id is not None:
            for i in range(len(w) - 12):
                g = tuple(w[i : i + 13])
                first[g] = min(first.get(g, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        w = words(text)
        gone = [False] * len(w)
        if doc_id is not None:
            for i in range(len(w) - 12):
                if first[tuple(w[i : i + 13])] < doc_id:
                    gone[i : i + 13] = [True] * 13
        out.append((doc_id, w, gone))
    return out


def expected(rows):
    out = []
    for doc_id, w, gone in covered(rows):
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def report(df):
    return sorted((tuple(r) for r in S.dedup_report(df).collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed):
    rows = random_docs(seed)
    found = report(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sum(r[2] for r in found) > 100
    assert found == expected(rows)


def test_edge_cases(spark, edge):
    assert report(edge) == expected([r[:2] for r in edge_rows()])


def test_empty_table(empty):
    assert report(empty) == []


def test_cut_texts_keep_columns_and_other_texts(spark, edge):
    cut = S.remove_duplicate_spans(edge, length_col="n_chars")
    assert cut.schema == edge.schema
    by_text = {}
    for (_, w, gone), row in zip(covered([r[:2] for r in edge_rows()]), edge_rows()):
        by_text.setdefault(row[0], []).append((row[1] if not any(gone) else None, [x for x, g in zip(w, gone) if not g]))
    found = cut.collect()
    assert len(found) == len(edge_rows())
    for r in found:
        assert any((whole is not None and whole == r.text) or words(r.text) == kept for whole, kept in by_text[r.doc_id])
        assert r.text is None or r.n_chars == len(r.text)


def test_partitions_do_not_matter(spark):
    rows = random_docs(9)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert report(df.repartition(1)) == report(df.repartition(13))


def test_passage_shared_by_many(spark):
    """A hot passage and a hot line: all but the first holder lose them."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"u{i} v{i} w{i} {passage} x{i} y{i}") for i in range(400)]
    found = report(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert found == expected(rows)
    assert sum(r[2] == 60 for r in found) == 399
