"""Lines that many documents share, as compressed keep bitmaps of each document.

Everything is DataFrame functions. The texts are read once for the lines' keys and once to
apply the bitmaps; in between only hashes, document keys and positions move:

1. Every line's key, its hash, and the line's document and position are written as a narrow
   table.
2. Keys are spread over ranges of the hash and sorted by document and position inside each.
   The first row of a key in a document counts that document, the first row of all is the
   key's first occurrence. The hash is even, so its ranges are too, but for keys that many
   lines share: rows are counted in ``RANGES`` equal ranges of the hash, and a range with
   more than its share is cut into pieces by document. Counts of its pieces are added up.
3. The positions to drop are turned into bitmaps, 64 lines to a word. Words that keep all
   their lines are left out.

A line's key is the line without white space (``\\x20``, ``\\x09-\\x0D``) at both ends and with
A-Z in lower case. Keys are told apart by 96 bits of hashes.

Nulls: a null text counts as empty, which is one empty line. Empty keys are never dropped.
Rows with the same id (null ids too) and the same text are one document stated twice: it
counts once, and each row comes back; rows with one id and other texts are documents of
their own. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rarespark.functions.ranks import BROADCAST_BYTES
from rarespark.llm.words import text_key
from rarespark.session import cut_lineage, stage_bytes

MIN_CHARS = 1
MIN_DOCS = 10
#: Equal ranges of the hash whose rows are counted, and the rows from which one may be cut.
RANGES = 1 << 16
PIECE_ROWS = 1024
#: A range is cut if it has more than so many times the mean. So at most one in so many is.
HOT = 4

# Fixed value: the white space that a key loses at its ends.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_lines(text: Column) -> Column:
    """Array of a text's lines."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    ascii_only = F.octet_length(line) == F.char_length(line)
    return F.btrim(F.when(ascii_only, F.lower(line)).otherwise(F.translate(line, UPPER, LOWER)), F.lit(SPACES))


def keyed_lines(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(hash, check, doc_id, doc_key, pos)`` of every line whose key is long enough."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    lines = named.select("doc_id", text_key(F.col("text")).alias("doc_key"), F.posexplode(text_lines(F.col("text"))).alias("pos", "line"))
    keys = lines.select("doc_id", "doc_key", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= max(min_chars, 1))
    return keys.select(F.xxhash64("key").alias("hash"), F.hash("key").alias("check"), "doc_id", "doc_key", "pos")


def _piece(lines: DataFrame) -> DataFrame:
    """``lines`` with ``pieces`` (0: the range is whole) and ``piece``, that of its document."""
    at = F.shiftright("hash", 64 - (RANGES.bit_length() - 1))
    counts = lines.groupBy(at.alias("at")).agg(F.count("*").alias("rows"))
    share = F.greatest(F.sum("rows").over(Window.partitionBy()) * HOT / RANGES, F.lit(float(PIECE_ROWS)))
    # At most RANGES / HOT rows whatever the table's size, so the broadcast is bounded.
    hot = counts.select("at", F.ceil(F.col("rows") / share).cast("int").alias("pieces")).where("pieces > 1")
    marked = lines.withColumn("at", at).join(F.broadcast(hot), "at", "left").drop("at")
    marked = marked.withColumn("pieces", F.coalesce("pieces", F.lit(0)))
    return marked.withColumn("piece", F.when(F.col("pieces") > 0, F.pmod("doc_key", "pieces")).otherwise(0).cast("int"))


def repeated_lines(lines: DataFrame, min_docs: int = MIN_DOCS, keep_first: bool = False) -> DataFrame:
    """``(doc_id, doc_key, pos)`` of the lines to drop: those whose key stands in at least
    ``min_docs`` documents, but for the first occurrence with ``keep_first``."""
    key = ["hash", "check"]
    group = Window.partitionBy(*key, "piece")
    in_order = group.orderBy("doc_id", "doc_key", "pos")
    dealt = _piece(lines).repartitionByRange("hash", "piece")
    streamed = dealt.withColumn("nth", F.row_number().over(in_order))
    streamed = streamed.withColumn("nth_doc", F.dense_rank().over(group.orderBy("doc_id", "doc_key")))
    streamed = streamed.withColumn("docs", F.max("nth_doc").over(group)).drop("nth_doc", "piece")
    place = ["doc_id", "doc_key", "pos"]
    found = cut_lineage(streamed.where((F.col("docs") >= min_docs) | (F.col("pieces") > 0)), "repeated")
    whole = found.where((F.col("pieces") == 0) & (F.lit(not keep_first) | (F.col("nth") > 1)))
    parts = found.where("pieces > 0")
    firsts = parts.where("nth = 1").groupBy(*key).agg(F.sum("docs").alias("all_docs"), F.min(F.struct(*place)).alias("first"))
    totals = cut_lineage(firsts.where(F.col("all_docs") >= min_docs), "totals")
    if stage_bytes(totals) <= BROADCAST_BYTES:  # else a join whose hot keys Spark splits
        totals = F.broadcast(totals)
    cut = parts.join(totals, key).where(F.lit(not keep_first) | (F.struct(*place) != F.col("first")))
    return whole.select(*place).unionByName(cut.select(*place))


def keep_bitmaps(dropped: DataFrame) -> DataFrame:
    """``(doc_id, doc_key, keep)`` of documents that lose lines: ``keep`` has ``(word, bits)``
    for each 64 lines of which some go, in order; a set bit keeps its line."""
    bit = F.expr("shiftleft(1L, pos % 64)")
    doc = ["doc_id", "doc_key"]
    words = (
        dropped.repartition(*doc)
        .groupBy(*doc, F.expr("pos div 64").cast("int").alias("word"))
        .agg(F.bitwise_not(F.bit_or(bit)).alias("bits"))
    )
    return words.groupBy(*doc).agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("keep"))


def line_bitmaps(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    keep_first: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Keep bitmaps of ``docs``; documents that keep all their lines have none."""
    lines = cut_lineage(keyed_lines(docs, min_chars, id_col, text_col), "lines")
    return keep_bitmaps(repeated_lines(lines, min_docs, keep_first))


def dropped_lines(keep: Column) -> Column:
    """Number of lines that a bitmap drops."""
    return F.coalesce(F.aggregate(keep, F.lit(0).cast("bigint"), lambda n, w: n + 64 - F.bit_count(w["bits"])), F.lit(0).cast("bigint"))


def kept_text(text: Column, keep: Column) -> Column:
    """The text's kept lines; null texts without a bitmap stay null."""
    gap = lambda held, w: F.array_repeat(F.lit(-1).cast("bigint"), w["word"] - F.size(held))
    words = F.aggregate(keep, F.array().cast("array<bigint>"), lambda held, w: F.concat(held, gap(held, w), F.array(w["bits"])))
    # One struct is made of both, so that the words are built once per text and not per line.
    held = F.struct(text_lines(text).alias("lines"), words.alias("words"))

    def kept(x: Column) -> Column:
        word = lambda i: F.coalesce(F.get(x["words"], F.floor(i / 64).cast("int")), F.lit(-1))
        bit = lambda i: F.call_function("shiftright", word(i), i % 64).bitwiseAND(F.lit(1))
        return F.array_join(F.filter(x["lines"], lambda line, i: bit(i) == 1), "\n")

    return F.when(keep.isNull(), text).otherwise(F.element_at(F.transform(F.array(held), kept), 1))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``keep``, each document's bitmap or null."""
    table = bitmaps.select(F.col("doc_id").alias("_id"), F.col("doc_key").alias("_key"), "keep")
    same = F.col(id_col).eqNullSafe(F.col("_id")) & (text_key(F.col(text_col)) == F.col("_key"))
    return docs.join(table, same, "left").drop("_id", "_key")


def remove_repeated_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    keep_first: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` without the repeated lines; all columns stay."""
    columns = [F.col(c) for c in docs.columns]
    narrow = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"), F.struct(*columns).alias("_row"))
    bitmaps = line_bitmaps(narrow, min_docs, min_chars, keep_first, "_doc", "_text")
    held = apply_bitmaps(narrow, bitmaps, "_doc", "_text")
    text = kept_text(F.col("_text"), F.col("keep"))
    return held.select(*[text.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns])


def line_report(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_sha256)`` of every row."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    held = apply_bitmaps(named, line_bitmaps(named, min_docs, min_chars))
    text = F.coalesce(kept_text(F.col("text"), F.col("keep")), F.lit(""))
    return held.select(
        "doc_id",
        F.size(text_lines(F.col("text"))).cast("bigint").alias("n_lines"),
        dropped_lines(F.col("keep")).alias("n_dropped"),
        F.sha2(text.cast("binary"), 256).alias("kept_sha256"),
    )
