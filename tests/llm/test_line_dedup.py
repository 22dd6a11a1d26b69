from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from llm_cases import SCHEMA, edge_rows, random_docs

from rarespark.llm import line_dedup as ld

LOWERED = str.maketrans(ld.UPPER, ld.LOWER)


def brute(rows, min_docs, min_chars=1, keep_first=False):
    """Kept lines of each ``(id, text)``."""
    docs = sorted({(i, t or "") for i, t in rows}, key=lambda d: (d[0] is not None, d[0] or 0, d[1]))
    key = lambda line: line.strip(ld.SPACES).translate(LOWERED)
    where = defaultdict(set)
    for d in docs:
        for line in d[1].split("\n"):
            if len(key(line)) >= min_chars:
                where[key(line)].add(d)
    common = {k for k, held in where.items() if len(held) >= min_docs}
    out, left = {}, Counter()
    for d in docs:
        lines = d[1].split("\n")
        out[d] = (len(lines), [x for x in lines if key(x) not in common])
        left.update(k for k in map(key, lines) if k in common)
    return out, left


def lines_docs(seed, n=90):
    rng = random.Random(seed)
    pool = ["Menu", " menu\t", "MENU", "É", "é", "all rights reserved", "", "  ", "x" * 50, "\r", "next\x0b", "a b"]
    rows = []
    for i in range(n):
        lines = [rng.choice(pool) if rng.random() < 0.6 else f"own {i} {k}" for k in range(rng.choice([0, 1, 3, 70, 200]))]
        rows.append((i, "\n".join(lines)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1, 7, "x", "y", "z", 1) for i, t in rows], SCHEMA)


def check(spark, rows, min_docs=ld.MIN_DOCS):
    want, _ = brute(rows, min_docs)
    found = ld.line_report(frame(spark, rows).repartition(5), min_docs).collect()
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in found), key=repr)
    expected = []
    for i, t in rows:
        n, kept = want[(i, t or "")]
        expected.append((i, n, n - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    assert got == sorted(expected, key=repr)
    return found


@pytest.mark.parametrize("seed", range(3))
def test_brute_force(spark, seed):
    assert any(r.n_dropped for r in check(spark, lines_docs(seed)))


def test_texts_of_shared_passages(spark):
    check(spark, random_docs(5), 2)


def test_edges(spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    rows += [(100 + k, "Same line\n" + "own\n" * k + "same LINE ") for k in range(12)]
    rows += [(None, "same line"), (None, "same line"), (300, "\n".join(["same line", "keep"] * 40_000))]
    check(spark, rows)


def test_copies_count_once(spark):
    rows = [(1, "hello")] * 15 + [(2, "hello\nworld")]
    found = check(spark, rows, 3)
    assert len(found) == 16 and not any(r.n_dropped for r in found)


def test_hot_ranges_are_cut(spark, monkeypatch):
    monkeypatch.setattr(ld, "PIECE_ROWS", 4)
    rows = lines_docs(11)
    pieces = ld._piece(ld.keyed_lines(frame(spark, rows))).select("pieces", "piece").distinct().collect()
    assert max(r.pieces for r in pieces) > 8 and len(pieces) > 20
    check(spark, rows)
    monkeypatch.setattr(ld, "BROADCAST_BYTES", 0)
    check(spark, rows)


@pytest.mark.parametrize("piece_rows", [4, 1024])
def test_keep_first(spark, monkeypatch, piece_rows):
    monkeypatch.setattr(ld, "PIECE_ROWS", piece_rows)
    rows = lines_docs(2)
    found = ld.remove_repeated_lines(frame(spark, rows), 2, keep_first=True)
    assert found.columns == frame(spark, rows).columns
    want, common = brute(rows, 2)
    seen, expected = set(), {}
    for i, t in rows:
        kept = []
        for line in t.split("\n"):
            k = line.strip(ld.SPACES).translate(LOWERED)
            if k not in common or k not in seen:
                kept.append(line)
            seen.add(k)
        expected[i] = "\n".join(kept)
    assert {r.doc_id: r.text for r in found.collect()} == expected


def test_bitmaps_leave_out_full_words(spark):
    rows = [(i, "\n".join([f"{i} {k}" for k in range(640)] + ["shared"])) for i in range(10)]
    found = ld.line_bitmaps(frame(spark, rows)).collect()
    assert len(found) == 10
    assert all([(w.word, w.bits) for w in r.keep] == [(10, ~1)] for r in found)


def test_short_keys_and_empty_table(spark, empty):
    rows = [(i, "ab\nabc") for i in range(4)]
    texts = {r.text for r in ld.remove_repeated_lines(frame(spark, rows), 4, min_chars=3).collect()}
    assert texts == {"ab"}
    assert ld.line_report(empty).collect() == []


def test_no_python_in_the_plan(edge):
    plan = ld.line_report(edge)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "MapIn"))
