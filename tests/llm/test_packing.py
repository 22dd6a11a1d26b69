from __future__ import annotations

import os
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_cases import edge_rows
from tokenizers import Tokenizer

from rarespark.llm import packing, token_histogram, tokens


@pytest.fixture(scope="module")
def encode():
    tokenizer = Tokenizer.from_file(tokens.vocabulary())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


TEXTS = [
    "café café x\x1cy　z it's don't. 'S. x̂, Ab́cD",
    "<|endoftext|> <|endoftext|>, a<|endoftext|>. <|startoftext|>",
    "İx. Σας ΟΔΟΣ. ŉa ǰ ẞß ªº µ × ÷ ½ 123. ﬁ 你好。 😀. $$$ *** a$$$ 1,2;3",
    "",
    " \n\t",
    "word " * 5000,
]


def test_ids_are_the_tokenizers(encode):
    ids = tokens.WordIds(tokens.vocabulary())
    for text in TEXTS:
        assert np.frombuffer(ids.encode(text.encode()), "<u4").tolist() == encode(text)


def test_every_code_point():
    """Each character before punctuation, behind a letter, and inside a word."""
    tokenizer = Tokenizer.from_file(tokens.vocabulary())
    ids = tokens.WordIds(tokens.vocabulary())
    points = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF and not chr(c).isspace()]
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    for at in range(0, len(points), 100_000):
        words = [w for c in points[at : at + 100_000] for w in (f"{c}.", f"a{c},", f"a{c}.b")]
        want = [e.ids for e in tokenizer.encode_batch(words, add_special_tokens=False)]
        wrong = [w for w, x in zip(words, want, strict=True) if np.frombuffer(ids.encode(w.encode()), "<u4").tolist() != x]
        assert wrong == []


def test_forgetting_words_changes_nothing(encode, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 3)
    monkeypatch.setattr(tokens, "KEPT_STEMS", 2)
    ids = tokens.WordIds(tokens.vocabulary())
    text = "one two, three. one four five two Two six"
    assert np.frombuffer(ids.encode(text.encode()), "<u4").tolist() == encode(text)


def one_by_one(counts, capacity):
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fitting = [r for r in rooms if r >= length]
            room = min(fitting, default=capacity)
            if fitting:
                rooms.remove(room)
            rooms.append(room - length)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(60))
def test_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 8, 16, 30, 64])
    counts = {rng.randint(1, capacity): rng.randint(1, 40) for _ in range(rng.randint(1, 12))}
    ranks, bins = defaultdict(list), defaultdict(list)
    for length, a, b, first, per_bin, base in packing.best_fit_decreasing(counts, capacity):
        for r in range(a, b):
            ranks[length].append(r)
            bins[first + (r - a) // per_bin].append((base + (r - a) % per_bin * length, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    rooms = []
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        rooms.append(capacity - at)
    assert sorted(rooms) == one_by_one(counts, capacity)


def test_packs_edge_cases(edge, encode):
    found = packing.pack_documents(edge).collect()
    want = []
    for doc_id, text, *_ in edge_rows():
        ids = encode(text) + [0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], "<u4")
            want.append((doc_id, piece, at, len(part), zlib.crc32(part.tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    held = defaultdict(list)
    for r in found:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    counts = defaultdict(int)
    for w in want:
        counts[w[3]] += 1
    assert len(held) == len(one_by_one(counts, 2048))


def test_empty_table(empty):
    assert packing.pack_documents(empty).collect() == []
    lengths = token_histogram.token_lengths(empty)
    assert token_histogram.limit_report(token_histogram.length_histogram(lengths)).collect() == []


def test_histogram_answers_every_limit(spark, edge, encode):
    sizes = [len(encode(r[1])) for r in edge_rows()]
    report = token_histogram.limit_report(token_histogram.length_histogram(token_histogram.token_lengths(edge)))
    found = report.collect()
    assert sorted(r.context_limit for r in found) == sorted(set(sizes))
    for r in found:
        limit = r.context_limit
        assert (r.n_docs, r.n_longer) == (sizes.count(limit), sum(s > limit for s in sizes))
        assert (r.total_tokens, r.truncated_tokens) == (sum(sizes), sum(min(s, limit) for s in sizes))
    for limit in (0, 1, 5, 17, 2048, 10**6):
        assert token_histogram.truncated_total(report, limit).first().tokens == sum(min(s, limit) for s in sizes)
    for share in (0.1, 0.5, 0.9, 1.0):
        want = min(x for x in sizes if sum(s <= x for s in sizes) >= share * len(sizes))
        assert token_histogram.quantile(report, share).first().context_limit == want


def test_frequent_words_outlive_a_full_store(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 50)
    monkeypatch.setattr(tokens, "KEPT_STEMS", 50)
    ids = tokens.WordIds(tokens.vocabulary())
    asked = []
    plain = ids._ids
    ids._ids = lambda stem: asked.append(stem) or plain(stem)
    for k in range(40):
        ids.encode(" ".join(["often", *(f"w{k}x{j}" for j in range(10))]).encode())
    assert asked.count(b"often") == 1 and len(ids) <= 50 and len(ids.older_words) <= 50 and len(ids.stems) <= 50
