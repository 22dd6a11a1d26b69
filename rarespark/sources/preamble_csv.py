"""CSV files whose first lines are free text, and the clean-up of their cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MAX_PREAMBLE = 30
TARGET = "class"
# Texts that count as missing, and the label texts.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null", "na",
]
LABELS = {"pos": 1, "neg": 0}


def _first_header(spark: SparkSession, path: str, target: str, max_lines: int) -> str:
    """Header line of one of the files, which tells the columns; reads the head of one file."""
    files = sorted(spark.read.text(path).inputFiles())
    if not files:
        raise ValueError(f"no files in {path}")
    for row in spark.read.text(files[0]).head(max_lines):
        if row[0].strip().startswith(target + ","):
            return row[0].strip()
    raise ValueError(f"no header {target + ',...'!r} in the first {max_lines} lines of {files[0]}")


def _body_lines(header: str, target: str, max_lines: int):
    """Lines below each file's header.

    A task gets the lines of a file's split together and in order, so the first split's
    header is found and left behind in the same pass that reads the lines: nothing is
    compared between scans, and no line can fall between them. A file without the header,
    or with another one, stops the job.
    """

    def rows(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        here, seen, found = None, 0, True

        def closed():
            if not found:
                raise ValueError(f"no header {target + ',...'!r} in the first {max_lines} lines of {here[0]}, or of its first split")

        for batch in batches:
            lines, files, blocks = (batch.column(i) for i in range(3))
            at = 0
            while at < batch.num_rows:
                place = (files[at].as_py(), blocks[at].as_py())
                if place != here:
                    closed()
                    here, seen, found = place, 0, place[1] > 0
                while not found and at < batch.num_rows and (files[at].as_py(), blocks[at].as_py()) == here:
                    line = lines[at].as_py().strip()
                    at += 1
                    seen += 1
                    if line.startswith(target + ","):
                        if line != header:
                            raise ValueError(f"headers differ between files: {line[:80]!r} in {here[0]}")
                        found = True
                    elif seen >= max_lines:
                        closed()
                if not found or at >= batch.num_rows:
                    continue
                rest = pc.and_(pc.equal(files.slice(at), here[0]), pc.equal(blocks.slice(at), here[1]))
                other = pc.index(rest, False).as_py()
                end = batch.num_rows if other < 0 else at + other
                part = pc.utf8_trim_whitespace(lines.slice(at, end - at))
                kept = pc.not_equal(part, "")
                yield pa.RecordBatch.from_arrays([files.slice(at, end - at).filter(kept), part.filter(kept)], ["file", "line"])
                at = end
        closed()

    return rows


def _parsed(spark: SparkSession, path: str, target: str, max_lines: int) -> tuple[DataFrame, list[str]]:
    """``(file, line, r, more)``: the fields of each line below its header, as text; ``more``
    is true for a line with more fields than the header."""
    header = _first_header(spark, path, target, max_lines)
    names = [n.strip() for n in header.split(",")]
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path"), F.col("_metadata.file_block_start"))
    body = lines.mapInArrow(_body_lines(header, target, max_lines), "file string, line string")
    schema = ", ".join(f"`{n}` string" for n in [*names, "_more"])
    parsed = body.select("file", "line", F.from_csv("line", schema, {"mode": "PERMISSIVE"}).alias("r"))
    return parsed.withColumn("more", F.col("r._more").isNotNull()), names


def read_preamble_csv(
    spark: SparkSession, path: str, target: str = TARGET, max_lines: int = MAX_PREAMBLE
) -> tuple[DataFrame, DataFrame]:
    """All-text rows below each file's header, and long lines ``(file, line)``.

    One pass over the files. A short line keeps its fields and has gaps behind them. A
    line with more fields than the header is no row; it is in the second table.
    """
    parsed, _ = _parsed(spark, path, target, max_lines)
    return parsed.where("not more").select("r.*").drop("_more"), parsed.where("more").select("file", "line")


def _or_stop(ok: Column, *message: Column) -> Column:
    """Condition that stops the job, with a message, where it does not hold."""
    return F.when(ok, F.lit(True)).otherwise(F.raise_error(F.concat(*message)).cast("boolean"))


def na_to_null(df: DataFrame, columns: Sequence[str], tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    return df.withColumns(
        {c: F.when(~F.trim(F.col(c)).isin(list(tokens)), F.col(c)) for c in columns}
    )


def number(c: Column) -> Column:
    """Double, or NULL for anything unreadable and for NaN."""
    value = c.try_cast("double")
    return F.when(~F.isnan(value), value)


def numeric_coerce(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: number(F.col(c)) for c in columns})


def unknown_labels(df: DataFrame, target: str = TARGET, labels: dict[str, int] = LABELS) -> DataFrame:
    """Label texts outside the known set; a missing label counts as unknown."""
    known = F.coalesce(F.col(target).isin(list(labels)), F.lit(False))
    return df.where(~known).groupBy(target).agg(F.count("*").alias("rows"))


def label_encode(
    df: DataFrame, target: str = TARGET, out: str = "y", labels: dict[str, int] = LABELS, check: bool = True
) -> DataFrame:
    """Integer labels. With ``check`` a text outside the known set, or a missing one, stops
    the job that reads it; else it becomes NULL."""
    if check:
        known = F.coalesce(F.col(target).isin(list(labels)), F.lit(False))
        df = df.where(_or_stop(known, F.lit(f"unknown label in {target!r}: "), F.coalesce(F.col(target), F.lit("<missing>"))))
    code = F.lit(None).cast("int")
    for text, value in labels.items():
        code = F.when(F.col(target) == text, F.lit(value)).otherwise(code)
    return df.withColumn(out, code)


def load_file(
    spark: SparkSession, path: str, target: str = TARGET, check: bool = True, max_lines: int = MAX_PREAMBLE
) -> DataFrame:
    """Typed rows of one split: integer label, double features, NULL for missing.

    Short lines have gaps; a line that is too long stops the job.
    """
    parsed, names = _parsed(spark, path, target, max_lines)
    fits = _or_stop(~F.col("more"), F.lit("too many fields in "), F.col("file"), F.lit(": "), F.substring("line", 1, 80))
    rows = parsed.where(fits).select("r.*").drop("_more")
    features = [c for c in names if c != target]
    encoded = label_encode(rows, target, target, check=check)
    return numeric_coerce(na_to_null(encoded, features), features)


def load_split_pair(spark: SparkSession, train: str, test: str, target: str = TARGET) -> DataFrame:
    """Both splits in one table with a ``split`` column; widths must agree."""
    left, right = load_file(spark, train, target), load_file(spark, test, target)
    if set(left.columns) != set(right.columns):
        raise ValueError(f"columns differ: {sorted(set(left.columns) ^ set(right.columns))}")
    return left.withColumn("split", F.lit("train")).unionByName(
        right.withColumn("split", F.lit("test"))
    )


def split_features_target(df: DataFrame, target: str = TARGET, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Features without the target, and the integer target; ``keep`` goes with both."""
    return df.drop(target), df.select(*keep, F.col(target).cast("int").alias(target))
