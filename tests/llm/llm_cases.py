from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key int, id string, node string, first string, label int"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))


def edge_rows():
    """Nulls, empty and white texts, a long one, ties, repeated rows and repeated ids."""
    texts = [
        (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
        (2, None),
        (3, ""),
        (4, " \t\n "),
        (5, LONG),
        (6, "ÀÉ ﬁne naïve text\x1cwith 😀 signs, and\r\nlines."),
        (7, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
        (8, "x one two three four five six seven eight nine ten eleven twelve thirteen fourteen y"),
        (8, "x one two three four five six seven eight nine ten eleven twelve thirteen fourteen y"),
        (9, "short"),
        (9, "another text under the same id one two three four five six seven eight nine ten eleven twelve thirteen"),
        (None, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
        (10, LONG),
        (11, "short"),
        (None, None),
    ]
    return [(i, t, "en", "src", len(t or ""), 7, "x", "y", "z", 1) for i, t in texts]


def random_docs(seed: int, n: int = 60):
    """Texts over a small vocabulary, with copied and changed passages."""
    rng = random.Random(seed)
    words = ["a", "b", "c", "D", "é"]
    docs: list[list[str]] = []
    for _ in range(n):
        own = [rng.choice(words) for _ in range(rng.choice([0, 3, 12, 13, 14, 40, 90]))]
        if docs and rng.random() < 0.6:
            other = rng.choice(docs)
            if other:
                at = rng.randrange(len(other))
                piece = other[at : at + rng.randint(5, 60)]
                put = rng.randint(0, len(own))
                own[put:put] = piece
        docs.append(own)
    joins = [" ", "\n", "\t", "  "]
    return [(i * 3 + 1, "".join(w + rng.choice(joins) for w in d)) for i, d in enumerate(docs)]
