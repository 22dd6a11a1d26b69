from __future__ import annotations

import re

import pytest
from llm_cases import edge_rows, random_docs

from rarespark.llm import decontaminate as D


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, size=5):
    w = words(text)
    return {" ".join(w[i : i + size]) for i in range(len(w) - size + 1)}


def expected(docs, items):
    out = set()
    for doc_id, text in docs:
        for item_id, question in items:
            size = min(5, len(words(question)))
            asked = shingles(question, size) if size else set()
            shared = len(shingles(text, size) & asked) if size else 0
            if asked and shared * 5 >= len(asked) * 4:
                out.add((doc_id, item_id, len(asked), shared))
    return sorted(out, key=repr)


def found(docs, items):
    return sorted({tuple(r) for r in D.containment_pairs(docs, items).collect()}, key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_random_texts(spark, seed):
    docs = random_docs(seed)
    items = [(i, t) for i, t in random_docs(seed)[::3]] + [(900 + i, " ".join(t.split()[5:40])) for i, t in docs if len(t.split()) > 30]
    want = expected(docs, items)
    assert len(want) > 50
    assert found(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")) == want


def test_scattered_and_partial_items(spark):
    item = [f"q{i}" for i in range(29)]
    cut = [item[:9], item[9:18], item[18:]]
    docs = [
        (1, " ".join(f"z{i}" for i in range(20_000)) + " " + " ".join(item).upper() + " end"),
        (2, " ".join(item[:24])),
        (3, " ".join(item[:23])),
        (4, " filler ".join(" ".join(c) for c in cut)),
        (5, " ".join(item[:16] + ["x"] + item[12:])),
    ]
    items = [(7, " ".join(item)), (8, "tiny item"), (9, None), (10, "")]
    docs += [(6, "Tiny  item"), (11, "a longer text with a tiny item inside it"), (12, "a tiny and an item")]
    got = found(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert got == expected(docs, items)
    assert {(r[0], r[1]) for r in got} == {(1, 7), (2, 7), (5, 7), (6, 8), (11, 8)}


def test_edge_cases(spark, edge, empty):
    items = [(1, "ten eleven twelve thirteen fourteen"), (1, "short"), (None, "naïve text\x1cwith 😀 signs, and"), (4, None)]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    docs = [r[:2] for r in edge_rows()]
    assert found(edge, table) == expected(docs, items)
    assert found(empty, table) == []
    assert found(edge, table.where("false")) == []
    kept = D.remove_contaminated(edge, table)
    assert kept.schema == edge.schema
    gone = {r[:1] for r in expected(docs, items)}
    left = [d for d in docs if not expected([d], items)]
    assert gone
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(left, key=repr)


def test_item_held_by_many_documents(spark):
    """A hot item: one pair per document."""
    item = " ".join(f"q{i}" for i in range(20))
    docs = [(i, f"a{i} b{i} {item} c{i}") for i in range(500)]
    got = found(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(1, item)], "item_id bigint, text string"))
    assert got == sorted(((i, 1, 16, 16) for i in range(500)), key=repr)


def test_items_of_each_length(spark):
    """Items of one word and more inside longer documents, and across no border of documents."""
    item = ["alpha", "beta", "gamma", "delta", "eps", "zeta"]
    items = [(n, " ".join(item[:n])) for n in range(1, 7)]
    docs = [(10 + n, "before " + " ".join(item[:n]) + " after it all") for n in range(1, 7)]
    docs += [(30, "beta gamma delta"), (31, "alpha gamma beta"), (32, "beta"), (33, "x alpha")]
    got = found(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert got == expected(docs, items)
    assert (14, 4, 1, 1) in got and (13, 4, 1, 1) not in got


def test_a_common_stem_makes_no_candidates(spark):
    """All items and documents share a stem: the sketches take the words that tell items apart."""
    stem = "which of the following statements about the"
    docs = [(i, f"{stem} " + " ".join(f"d{i}x{k}" for k in range(30))) for i in range(200)]
    items = [(i, f"{stem} " + " ".join(f"q{i}x{k}" for k in range(20))) for i in range(50)]
    docs += [(1000 + i, "start " + t + " end") for i, t in items[:5]]
    made = D._texts(spark.createDataFrame(items, "item_id bigint, text string"), "item_id", "text").mapInArrow(D._item_rows, "id bigint, key bigint, gram bigint, words int")
    held = spark.createDataFrame(
        [(r.gram, 200) for r in made.groupBy("gram").count().where("count > 1").collect()], "gram bigint, docs bigint"
    )
    sketches = D.item_sketches(made, held)
    assert held.count() == 3 and sketches.join(held, "gram").count() == 0
    got = found(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert got == expected(docs, items) and len(got) == 5
