"""Registered queries, and the pipeline as a whole."""

from __future__ import annotations

import pytest
from oracle_check import compare, connect

import corpus_pipeline
from rarespark.llm import queries
from rarespark.session import cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_twin(spark, sf, name):
    assert compare(queries.QUERIES[name](spark, sf), connect(sf), queries.ORACLES[name]) == ""


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, len(numbers) + 1))


def test_registered():
    import __spark_entry__ as entry

    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, sf), name)
        out.append((name, docs))
    return out


def test_stages_keep_columns_and_rows(stages):
    tables = [df for _, df in stages]
    ids = [{r.doc_id for r in df.select("doc_id").collect()} for df in tables]
    for df in tables[:-1]:
        assert df.columns == COLUMNS and df.count() == df.select("doc_id").distinct().count()
    assert ids[1] < ids[0] and ids[2] < ids[1] and ids[3] == ids[2] and ids[4] <= ids[3] and ids[5] == ids[4]


def test_toxic_words_go(spark, sf, stages):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    gone = labels.join(stages[1][1], "doc_id", "left_anti")
    assert gone.where("toxic = 1").count() >= 0.7 * labels.where("toxic = 1").count()
    assert gone.where("toxic = 0").count() <= 0.02 * labels.where("toxic = 0").count()


def test_exact_copies_go_and_passages_are_cut(stages):
    kept = stages[2][1]
    assert kept.select("text").distinct().count() == kept.count()
    before = {r.doc_id: r.text for r in kept.collect()}
    after = {r.doc_id: r for r in stages[3][1].collect()}
    cut = [i for i, r in after.items() if r.text != before[i]]
    assert cut
    for i, r in after.items():
        assert r.n_chars == len(r.text)
        found = iter(before[i].split())
        assert all(w in found for w in r.text.split())


def test_run_returns_the_last_stage(spark, sf, stages):
    got = sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, sf).collect())
    assert got == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in stages[-1][1].collect())


def test_empty_documents(spark, sf, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
