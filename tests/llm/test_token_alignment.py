from __future__ import annotations

import hashlib
import json
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from llm_cases import SCHEMA, edge_rows
from tokenizers import Tokenizer

from rarespark.llm import token_alignment as ta
from rarespark.llm.tokens import vocabulary


@pytest.fixture(scope="module")
def plain():
    """Whole texts encoded in one go, with each token's bytes."""
    a = Tokenizer.from_file(vocabulary(ta.BYTE_VOCABULARY))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=vocabulary(ta.PIECE_VOCABULARY))
    letters = {c: k for k, c in ta.byte_letters().items()}

    def encode(text):
        if not text:
            return [], []
        left = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
            return [], []
        return left, right

    return encode


def plain_groups(left, right):
    ends = []
    for side in (left, right):
        at, held = 0, []
        for _, x in side:
            at += len(x)
            held.append(at)
        ends.append(held)
    both = set(ends[0]) & set(ends[1])
    groups, a, b = [], [], []
    i = j = 0
    for end in sorted(both):
        while i < len(left) and ends[0][i] <= end:
            a.append(left[i][0])
            i += 1
        while j < len(right) and ends[1][j] <= end:
            b.append(right[j][0])
            j += 1
        groups.append((a, b))
        a, b = [], []
    return groups


def brute(rows, encode):
    docs = []
    for doc_id, text in rows:
        left, right = encode(text)
        groups = plain_groups(left, right)
        links = Counter((a, b) for g in groups for a in g[0] for b in g[1])
        docs.append((doc_id, len(left), len(right), groups, links))
    held = Counter(pair for d in docs for pair in d[4])
    best = {}
    for (a, _), n in held.items():
        best[a] = max(best.get(a, 0), n)
    out = []
    for doc_id, n_a, n_b, groups, links in docs:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        n_best = sum(n for (a, b), n in links.items() if held[a, b] == best[a])
        total = sum(n * held[p] for p, n in links.items())
        out.append((doc_id, n_a, n_b, len(groups), sum(links.values()), n_best, total, digest))
    return sorted(out, key=repr)


def check(df, rows, encode, **more):
    assert sorted(map(tuple, ta.alignment_report(df, **more).collect()), key=repr) == brute(rows, encode)


TEXTS = [
    " ",
    "  two  spaces ",
    "a\x1c b\x85 c\xa0 d　 e  f​ g﻿ h\x00 i",
    "tab\t then\n \n line\r\n  x \t",
    "<|endoftext|> <s> </s> <unk> <0x41> ▁ low",
    "日本語のテキスト 中文 한국어 😀👍🏽 é ﬁ ½ İ",
    "don't we'll I'm 'S it's 123,456.78 $$$ ... --- ===",
    "a▁b",
    "x" * 500 + " " + "ab" * 400 + "12" * 300,
    "é" * 300,
    "\n" * 50 + "end",
    "ends with a space ",
]


def random_text(rng):
    pool = "abcDE  \n\t,.'12éß日語😀\xa0 \x1c▁ﷺ"
    return "".join(rng.choice(pool) for _ in range(rng.choice([1, 5, 30, 200])))


def test_ids_are_the_tokenizers(plain):
    rng = random.Random(4)
    encode = ta.codes().encode
    for text in TEXTS + [random_text(rng) for _ in range(400)]:
        got = [(x & 0xFFFF).tolist() for x in encode(text)]
        assert got == [[i for i, _ in side] for side in plain(text)], text


def test_every_code_point(plain):
    """The faster encoder cuts and merges as the vocabulary's own library does."""
    fast = ta.codes().sides[0]
    slow = Tokenizer.from_file(vocabulary(ta.BYTE_VOCABULARY))
    slow.encode_special_tokens = True
    points = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    for at in range(0, len(points), 500):
        text = "".join(f"x{c}y {c} 1{c}{c}2'{c}s\n{c} .{c} " for c in points[at : at + 500])
        assert fast.encode(text) == slow.encode(" " + text, add_special_tokens=False).ids


def test_other_vocabularies_go_through_their_library(tmp_path):
    spec = json.loads(Path(vocabulary(ta.BYTE_VOCABULARY)).read_text())
    spec["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    path = tmp_path / "v.json"
    path.write_text(json.dumps(spec))
    other = Tokenizer.from_file(str(path))
    text = "one two, three"
    found = ta.ByteTokens(str(path)).encode(text)
    assert found == other.encode(" " + text, add_special_tokens=False).ids


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 128])
@pytest.mark.parametrize("seed", range(12))
def test_common_ends(seed, piece):
    rng = np.random.default_rng(seed)
    top = int(rng.integers(1, 400))
    a, b = (np.sort(rng.choice(top, int(rng.integers(0, top + 1)), replace=False)) for _ in range(2))
    i, j = ta.common_ends(a, b, piece)
    both = np.intersect1d(a, b)
    assert a[i].tolist() == both.tolist() == b[j].tolist()


def test_diagonals_cut_equal_work():
    a, b = np.arange(0, 3000, 3), np.arange(0, 3000, 2)
    at = np.arange(0, 2501, 100)
    cut = ta.diagonal_cuts(a, b, at)
    merged = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
    assert cut.tolist() == [sum(side == 0 for _, side in merged[:k]) for k in at.tolist()]


def test_given_table(spark, sf, plain):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    check(df.repartition(3), [(r.doc_id, r.text) for r in df.collect()], plain)


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(8)
    rows = [(r[0], r[1]) for r in edge_rows()] + [(100 + k, t) for k, t in enumerate(TEXTS)]
    rows += [(200 + k, random_text(rng)) for k in range(40)]
    df = spark.createDataFrame([(i, t, "en", "s", 1, 7, "x", "y", "z", 1) for i, t in rows], SCHEMA)
    return rows, df


def test_edges(odd, plain):
    check(odd[1], odd[0], plain)


@pytest.mark.parametrize("head", [0, 1, 50])
def test_rare_pairs_are_joined(odd, plain, head):
    check(odd[1], odd[0], plain, head_pairs=head)


def test_wide_groups_and_slices(plain, monkeypatch):
    """Groups counted by their distinct ids, and texts dealt over several slices."""
    rng = random.Random(1)
    texts = TEXTS + [random_text(rng) for _ in range(20)]
    encode = ta.codes().encode
    coded = [encode(t) for t in texts]
    want = [x.tolist() for x in ta.linked_pairs(ta.align(coded))]
    monkeypatch.setattr(ta, "WIDE", 1)
    assert [x.tolist() for x in ta.linked_pairs(ta.align(coded))] == want


def test_groups_as_tables(odd, plain, monkeypatch):
    monkeypatch.setattr(ta, "SLICE_TOKENS", 50)
    found = ta.aligned_groups(odd[1]).collect()
    want = [(i, plain_groups(*plain(t))) for i, t in odd[0]]
    got = []
    for r in found:
        groups, i, j = [], 0, 0
        for n_a, n_b in zip(r.a_sizes, r.b_sizes, strict=True):
            groups.append((r.a_ids[i : i + n_a], r.b_ids[j : j + n_b]))
            i, j = i + n_a, j + n_b
        assert (i, j) == (len(r.a_ids), len(r.b_ids))
        got.append((r.doc_id, groups))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_empty_table(empty):
    assert ta.alignment_report(empty).collect() == []
    assert ta.alignment_report(empty, head_pairs=0).collect() == []
