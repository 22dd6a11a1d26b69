"""Alignment of two tokenizations of the same texts, and how often their tokens meet.

Tokenizer A is byte-level, tokenizer B one of pieces with byte fallback. Both cover the bytes
of a space and the text; offsets where a token of A and one of B both end cut them into
groups. An A and a B token of one group are linked.

*Merging.* The ends of A and of B are two rising lists. All documents of a slice stand behind
one another, and the merge of the two lists is cut into pieces of equal work: a binary search
on each diagonal finds how many ends of A and of B lie before it. The pieces are merged side
by side and emit the offsets that they find in both lists; where an offset's two ends fall
into neighbouring pieces the border is stitched afterwards. A long document is many pieces,
a hundred short ones are one.

*Encoding.* A text whose tokens on either side don't spell the space and the text has no
tokens. Ids must be below 65 536.

*Counting.* Each document yields its distinct linked id pairs with their number of links.
Spark counts documents per pair. The pairs that most documents hold, at most ``HEAD_PAIRS``
of them, are sent to all workers, which add up a document's counts where it lies; its rarer
pairs, if any are left, are joined by the pair, none of which is hot.

Nulls: a null or empty text has no tokens; its figures are zero and its digest is empty. Rows
that repeat an id, or a whole document, are documents of their own. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rarespark.llm import words as W
from rarespark.llm.tokens import byte_letters, vocabulary
from rarespark.session import cut_lineage

BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"
SLICE_TOKENS = 400_000
PIECE = 128
#: Groups with more links are counted by their distinct ids.
WIDE = 4096
HEAD_PAIRS = 1 << 20

# Fixed value: the sign that stands for a space in pieces.
SPACE_SIGN = "▁"
#: A token's id is in the low 16 bits of a code, its number of bytes in the high ones.
ID_BITS = 16


class ByteTokens:
    """Ids and bytes of a byte-level vocabulary; its special tokens' strings are plain text.

    Where the vocabulary's merges are in the order of their ids and words are cut by the usual
    pattern, tiktoken gives the same ids in a fifth of the time.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        back = {letter: byte for byte, letter in letters.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        vocab = spec["model"]["vocab"]
        top = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.bytes = [b""] * top
        for entry, i in vocab.items():
            if all(c in back for c in entry):
                self.bytes[i] = bytes(map(back.__getitem__, entry))
        splitter = {k: (spec["pre_tokenizer"] or {}).get(k) for k in ("type", "add_prefix_space", "use_regex")}
        plain = splitter == {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True} and not spec["normalizer"]
        if plain and all(vocab[x + y] == len(letters) + k for k, (x, y) in enumerate(merges)):
            import tiktoken
            from public_tokenizers import PATTERN

            ranks = {self.bytes[i]: i for i in range(len(letters) + len(merges))}
            self._ids = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            self._ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> list[int]:
        """Ids of a space and ``text``."""
        return self._ids(" " + text)


class PieceTokens:
    """Ids and bytes of a vocabulary of pieces, which adds the space itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.bytes = [self._spelled(i) for i in range(self.model.get_piece_size())]

    def _spelled(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace(SPACE_SIGN, " ").encode()

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


NO_TOKENS = (np.zeros(0, np.uint32), np.zeros(0, np.uint32))


class Codes:
    """Tokens of texts on both sides, as arrays of codes."""

    def __init__(self, sides: tuple[ByteTokens, PieceTokens]):
        self.sides = sides
        self.codes = [np.array([i | len(x) << ID_BITS for i, x in enumerate(side.bytes)], np.uint32) for side in sides]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Codes of a text; empty where the tokens of either side don't spell a space and the text."""
        if not text:
            return NO_TOKENS
        whole, found = b" " + text.encode(), []
        for side, code in zip(self.sides, self.codes, strict=True):
            ids = side.encode(text)
            if b"".join(map(side.bytes.__getitem__, ids)) != whole:
                return NO_TOKENS
            found.append(code[ids])
        return tuple(found)


_codes: dict[tuple, Codes] = {}


def codes(byte_path: str | None = None, piece_path: str | None = None) -> Codes:
    """The worker's encoder; the paths are found where the task runs."""
    paths = (byte_path or vocabulary(BYTE_VOCABULARY), piece_path or vocabulary(PIECE_VOCABULARY))
    if paths not in _codes:
        _codes[paths] = Codes((ByteTokens(paths[0]), PieceTokens(paths[1])))
    return _codes[paths]


def diagonal_cuts(a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of the first ``at`` elements of the merge of ``a`` and ``b`` are of ``a``;
    of equal elements that of ``a`` comes first."""
    low, high = np.maximum(0, at - len(b)), np.minimum(at, len(a))
    while (open_ := low < high).any():
        i = ((low + high) // 2)[open_]
        before = a[i] <= b[at[open_] - i - 1]
        low[open_] = np.where(before, i + 1, low[open_])
        high[open_] = np.where(before, high[open_], i)
    return low


def common_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """``(i, j)`` with ``a[i] == b[j]``, rising, for two strictly rising arrays."""
    total = len(a) + len(b)
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.append(np.arange(0, total, piece), total)
    a_cut = diagonal_cuts(a, b, at)
    b_cut = at - a_cut
    partner = np.full(len(b), -1, np.int64)
    i, j = a_cut[:-1].copy(), b_cut[:-1].copy()
    a_end, b_end = a_cut[1:], b_cut[1:]
    fresh = np.zeros(len(i), bool)  # whether the element before is an a of this piece
    last_a, last_b = len(a) - 1, len(b) - 1
    for _ in range(piece):
        x, y = a[np.minimum(i, last_a)], b[np.minimum(j, last_b)]
        take_a = (i < a_end) & ((j >= b_end) | (x <= y))
        take_b = ~take_a & (j < b_end)
        met = take_b & fresh & (a[np.maximum(i - 1, 0)] == y)
        partner[j[met]] = i[met] - 1
        fresh |= take_a
        i += take_a
        j += take_b
    # A border may part the two ends of an offset: the last of a before it, the first of b behind.
    border = (a_cut[1:-1] > 0) & (b_cut[1:-1] < len(b))
    i, j = a_cut[1:-1][border] - 1, b_cut[1:-1][border]
    split = a[i] == b[j]
    partner[j[split]] = i[split]
    j = np.flatnonzero(partner >= 0)
    return partner[j], j


@dataclass
class Aligned:
    """Tokens of some texts, one behind the other, and their groups.

    ``a`` and ``b`` are ids; group ``g`` holds ``a[a_ends[g-1]:a_ends[g]]`` and so on, text
    ``t`` the groups up to ``groups[t]``, exclusive.
    """

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    groups: np.ndarray
    a_docs: np.ndarray
    b_docs: np.ndarray

    def starts(self, ends: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums over each text's groups."""
        upto = np.concatenate([[0], np.cumsum(values)])
        return np.diff(upto[self.groups], prepend=0)


def align(coded: list[tuple[np.ndarray, np.ndarray]]) -> Aligned:
    """Groups of texts given by their codes."""
    a, b = (np.concatenate([x[side] for x in coded]) for side in (0, 1))
    a_docs, b_docs = (np.cumsum([len(x[side]) for x in coded]) for side in (0, 1))
    i, j = common_ends(np.cumsum(a >> ID_BITS, dtype=np.int64), np.cumsum(b >> ID_BITS, dtype=np.int64))
    low = np.uint32((1 << ID_BITS) - 1)
    # A text's tokens of both sides end together, so the groups before its end are its own and earlier ones'.
    return Aligned(a & low, b & low, i + 1, j + 1, np.searchsorted(i + 1, a_docs, "right"), a_docs, b_docs)


def _runs(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, rising, with their times added up."""
    if not len(keys):
        return keys, times
    order = np.argsort(keys)
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(times, first)


def linked_pairs(x: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, pair, times)``: the distinct id pairs of each text, ``a << 16 | b``, and how
    many links have them."""
    a_from, b_from = x.starts(x.a_ends), x.starts(x.b_ends)
    n_a, n_b = x.a_ends - a_from, x.b_ends - b_from
    text = np.searchsorted(x.groups, np.arange(len(x.a_ends)), "right")
    links = n_a * n_b
    narrow = np.flatnonzero(links <= WIDE)
    of = np.repeat(narrow, links[narrow])
    upto = np.cumsum(links[narrow])
    nth = np.arange(len(of)) - np.repeat(upto - links[narrow], links[narrow])
    up = nth // n_b[of]
    a, b = x.a[a_from[of] + up], x.b[b_from[of] + nth - up * n_b[of]]
    keys = [text[of] << 32 | a.astype(np.int64) << ID_BITS | b]
    times = [np.ones(len(of), np.int64)]
    for g in np.flatnonzero(links > WIDE):
        a, in_a = np.unique(x.a[a_from[g] : x.a_ends[g]], return_counts=True)
        b, in_b = np.unique(x.b[b_from[g] : x.b_ends[g]], return_counts=True)
        keys.append((text[g] << 32 | a.astype(np.int64)[:, None] << ID_BITS | b[None, :]).ravel())
        times.append(np.outer(in_a, in_b).ravel())
    found, held = _runs(np.concatenate(keys), np.concatenate(times))
    return found >> 32, found & 0xFFFFFFFF, held


def _digit_table() -> np.ndarray:
    """Decimal digits of all 16-bit numbers, left over places zero."""
    table = np.zeros((1 << ID_BITS, 5), np.uint8)
    numbers = np.arange(1 << ID_BITS)
    for place in range(5):
        digit = numbers // 10 ** (4 - place) % 10 + ord("0")
        table[:, place] = np.where(numbers >= 10 ** (4 - place), digit, 0)
    table[0, 4] = ord("0")
    return table


DIGITS = _digit_table()


def group_strings(x: Aligned) -> list[bytes]:
    """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
    a_from, b_from = x.starts(x.a_ends), x.starts(x.b_ends)
    n_a, n_b = x.a_ends - a_from, x.b_ends - b_from
    out = np.zeros((len(x.a) + len(x.b), 6), np.uint8)
    a_at = np.arange(len(x.a)) + np.repeat(b_from, n_a)
    b_at = np.arange(len(x.b)) + np.repeat(x.a_ends, n_b)
    out[a_at, :5], out[b_at, :5] = DIGITS[x.a], DIGITS[x.b]
    out[:, 5] = ord(",")
    out[x.a_ends - 1 + b_from, 5] = ord("|")
    group_end = x.a_ends + x.b_ends - 1
    out[group_end, 5] = ord(";")
    text_end = (x.a_docs + x.b_docs)[np.diff(x.groups, prepend=0) > 0] - 1
    out[text_end, 5] = 0
    used = out != 0
    data = out[used].tobytes()
    upto = np.concatenate([[0], np.cumsum(used.sum(axis=1))])[np.concatenate([[0], x.a_docs + x.b_docs])].tolist()
    return [data[s:e] for s, e in zip(upto[:-1], upto[1:], strict=True)]


def _slices(column: pa.Array, encode) -> Iterator[tuple[int, int, Aligned]]:
    """Rows of a batch, as many at a time as make up a slice."""
    held, tokens, start = [], 0, 0
    for row, text in enumerate(column):
        held.append(encode(text.as_py() or ""))
        tokens += sum(map(len, held[-1]))
        if tokens >= SLICE_TOKENS:
            yield start, row + 1, align(held)
            held, tokens, start = [], 0, row + 1
    if held:
        yield start, len(column), align(held)


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind))


def aligned_groups(
    docs: DataFrame,
    byte_path: str | None = None,
    piece_path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, a_ids, b_ids, a_sizes, b_sizes)``: the tokens of each text and the number of
    them in each of its groups."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codes(byte_path, piece_path).encode
        for batch in batches:
            for start, end, x in _slices(batch.column(1), encode):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        _lists(x.a, x.a_docs, pa.int32()),
                        _lists(x.b, x.b_docs, pa.int32()),
                        _lists(x.a_ends - x.starts(x.a_ends), x.groups, pa.int32()),
                        _lists(x.b_ends - x.starts(x.b_ends), x.groups, pa.int32()),
                    ],
                    ["doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes"],
                )

    return _named(docs, id_col, text_col).mapInArrow(
        rows, "doc_id bigint, a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>"
    )


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    W.bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))


def document_links(
    docs: DataFrame,
    byte_path: str | None = None,
    piece_path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Each document's figures, the digest of its groups, and its distinct linked id pairs
    (``a << 16 | b`` in 32 bits) with the number of links of each."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codes(byte_path, piece_path).encode
        for batch in batches:
            for start, end, x in _slices(batch.column(1), encode):
                text, pair, times = linked_pairs(x)
                upto = np.searchsorted(text, np.arange(end - start), "right")
                links = (x.a_ends - x.starts(x.a_ends)) * (x.b_ends - x.starts(x.b_ends))
                digests = [hashlib.sha256(s).hexdigest() if s else "" for s in group_strings(x)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        pa.array(np.diff(x.a_docs, prepend=0)),
                        pa.array(np.diff(x.b_docs, prepend=0)),
                        pa.array(np.diff(x.groups, prepend=0)),
                        pa.array(x.per_text(links)),
                        pa.array(digests, pa.string()),
                        _lists(pair.astype(np.uint32).view(np.int32), upto, pa.int32()),
                        _lists(times, upto, pa.int64()),
                    ],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
                )

    return _named(docs, id_col, text_col).mapInArrow(
        rows,
        "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<int>, times array<bigint>",
    )


def pair_counts(links: DataFrame) -> DataFrame:
    """``(pair, n, best)``: how many documents hold each linked id pair, and whether that is
    the most of any pair of its A id."""
    counts = cut_lineage(links.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pairs")
    a = F.shiftrightunsigned("pair", ID_BITS)
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    # One row per id of A, 65 536 at most.
    held = counts.join(F.broadcast(most), a == F.col("a"))
    return cut_lineage(held.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "counts")


def _head(counts: DataFrame, most: int) -> int:
    """Least power of two such that at most ``most`` pairs have that count or more; 1 if all
    pairs are so few."""
    steps = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("step")).agg(F.count("*").alias("pairs")).collect()
    held, least = 0, max((r["step"] for r in steps), default=-1) + 1
    for r in sorted(steps, key=lambda r: -r["step"]):
        held += r["pairs"]
        if held > most:
            break
        least = r["step"]
    else:
        least = 0
    return 1 << least


def _add_up(head, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace a document's pairs by sums over those in the head, and list the others."""
    keys, n, best = head.value
    for batch in batches:
        pairs, times = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
        ends = pairs.offsets.to_numpy()
        pair, link = (c.values.to_numpy()[ends[0] : ends[-1]] for c in (pairs, times))
        ends = ends - ends[0]
        at = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
        known = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
        sums = []
        for value in (n, best):
            upto = np.zeros(len(pair) + 1, np.int64)
            if len(keys):
                np.cumsum(np.where(known, value[at] * link, 0), out=upto[1:])
            sums.append(pa.array(np.diff(upto[ends])))
        left = np.concatenate([[0], np.cumsum(~known)])[ends[1:]]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-2], *sums, _lists(pair[~known], left, pa.int32()), _lists(link[~known], left, pa.int64())],
            [*batch.schema.names[:-2], "count_sum", "n_best", "pairs", "times"],
        )


def count_links(links: DataFrame, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """``links`` with ``count_sum``, the pair counts added over all links, and ``n_best``, the
    links whose count is their A id's highest."""
    W.bounded_batches(links.sparkSession)
    figures = [c for c in links.columns if c not in ("pairs", "times")]
    stage = cut_lineage(links.withColumn("row", F.monotonically_increasing_id()).select("row", *figures, "pairs", "times"), "links")
    counts = pair_counts(stage)
    least = _head(counts, head_pairs)
    found = counts.where(F.col("n") >= least).toArrow().sort_by("pair")
    head = links.sparkSession.sparkContext.broadcast(
        tuple(found.column(c).to_numpy().astype(kind) for c, kind in (("pair", np.int32), ("n", np.int64), ("best", np.int64)))
    )
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stage.schema.fields[:-2])
    summed = stage.mapInArrow(
        lambda batches: _add_up(head, batches), f"{kinds}, count_sum bigint, n_best bigint, pairs array<int>, times array<bigint>"
    )
    if least == 1:  # every pair is in the head
        return summed.select(*figures, "count_sum", "n_best")
    summed = cut_lineage(summed, "summed")
    rest = summed.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.pairs", "x.times")
    rare = rest.join(counts.where(F.col("n") < least), rest["pairs"] == counts["pair"])
    more = rare.groupBy("row").agg(
        F.sum(F.col("times") * F.col("n")).alias("more_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best")
    )
    joined = summed.drop("pairs", "times").join(more, "row", "left")
    return joined.select(
        *figures,
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
    )


def alignment_report(docs: DataFrame, head_pairs: int = HEAD_PAIRS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Figures of every document: tokens, groups, links, how usual the links are, and the
    digest of the groups."""
    counted = count_links(document_links(docs, id_col=id_col, text_col=text_col), head_pairs)
    return counted.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
