"""Data-quality rules; each result is a table ``(rule, ok, detail)`` or one summary row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rarespark.session import cut_lineage

# Widest allowed positive rates.
MAX_POSITIVE_RATE = 0.05
MAX_TEST_RATE = 0.1


def _rule(name: str, ok: Column, detail: Column) -> Column:
    return F.struct(F.lit(name).alias("rule"), ok.alias("ok"), detail.cast("string").alias("detail"))


def _rules(row: DataFrame, *rules: Column) -> DataFrame:
    return row.select(F.explode(F.array(*rules)).alias("_r")).select("_r.*")


def schema_rules(train: DataFrame, test: DataFrame, target: str = "y", width: int = 171, id_col: str = "row_id") -> DataFrame:
    """Target present, declared width, same width on both sides, and no row of either side
    without any feature. The first three read schemas only."""
    a, b = len(train.columns), len(test.columns)
    features = [c for c in train.columns if c not in (target, id_col) and c in test.columns]

    def blank(df: DataFrame) -> DataFrame:
        return df.select(F.when(F.coalesce(*[F.col(c).cast("string") for c in features]).isNull(), 1).alias("_blank"))

    row = blank(train).unionByName(blank(test)).agg(F.count("_blank").alias("blank"), F.count("*").alias("n"))
    return _rules(
        row,
        _rule("target_present", F.lit(target in train.columns), F.lit(target)),
        _rule("same_width", F.lit(a == b), F.lit(f"train={a} test={b}")),
        _rule("expected_width", F.lit(a == width), F.lit(f"width={a} expected={width}")),
        _rule("rows_filled", F.col("blank") == 0, F.format_string("blank=%d of %d", "blank", "n")),
    )


def label_domain_rule(df: DataFrame, target: str = "y") -> DataFrame:
    """The target takes exactly the values 0 and 1."""
    y = F.col(target)
    row = df.agg(
        F.max(F.coalesce((y == 0).cast("int"), F.lit(0))).alias("zero"),
        F.max(F.coalesce((y == 1).cast("int"), F.lit(0))).alias("one"),
        F.count(F.when(y.isNull() | ~y.isin(0, 1), 1)).alias("other"),
    )
    ok = (F.col("zero") == 1) & (F.col("one") == 1) & (F.col("other") == 0)
    return _rules(row, _rule("label_domain", ok, F.format_string("other=%d", "other")))


def imbalance_rule(df: DataFrame, target: str = "y", limit: float = MAX_POSITIVE_RATE) -> DataFrame:
    row = df.agg(F.sum(target).alias("pos"), F.count("*").alias("n"))
    rate = F.col("pos") / F.col("n")
    return row.select(
        F.lit("imbalance").alias("rule"),
        (rate < limit).alias("ok"),
        rate.alias("positive_rate"),
        ((F.col("n") - F.col("pos")) / F.nullif(F.col("pos"), F.lit(0))).alias("neg_per_pos"),
    )


def load_summary(df: DataFrame, features: Sequence[str], target: str = "y", by: Sequence[str] = ("split",)) -> DataFrame:
    missing = sum((F.col(c).isNull().cast("bigint") for c in features), F.lit(0).cast("bigint"))
    return df.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.sum(target).cast("bigint").alias("positives"),
        F.avg(target).alias("positive_rate"),
        F.sum(missing).alias("missing_cells"),
    )


def split_leak_check(train: DataFrame, test: DataFrame, target: str = "y", limit: float = MAX_TEST_RATE) -> DataFrame:
    """Labels complete, train larger than test, test not resampled."""
    both = train.select(F.lit(0).alias("_t"), target).unionByName(test.select(F.lit(1).alias("_t"), target))
    row = both.agg(
        F.count(F.when(F.col("_t") == 0, 1)).alias("n_train"),
        F.count(F.when(F.col("_t") == 1, 1)).alias("n_test"),
        F.count(target).alias("labelled"),
        F.avg(F.when(F.col("_t") == 1, F.col(target))).alias("rate"),
    )
    return _rules(
        row,
        _rule("labels_complete", F.col("labelled") == F.col("n_train") + F.col("n_test"), F.col("labelled")),
        _rule("train_larger", F.col("n_train") > F.col("n_test"), F.format_string("%d vs %d", "n_train", "n_test")),
        _rule("test_not_resampled", F.col("rate") < limit, F.round(F.col("rate"), 6)),
    )


def row_overlap(train: DataFrame, test: DataFrame, features: Sequence[str], id_col: str = "row_id") -> DataFrame:
    """Test rows whose features all occur in one train row; NULL equals NULL.

    Both sides are first reduced to their distinct feature tuples, so a tuple shared by
    many rows is compared once. The shared tuples are written before the test rows are
    joined to them, so that the join can split a tuple that very many test rows have.
    """

    def same(a: str, b: str) -> Column:
        parts = [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in features]
        return reduce(lambda x, y: x & y, parts)

    seen, asked = train.select(*features).distinct(), test.select(*features).distinct()
    shared = cut_lineage(asked.alias("a").join(seen.alias("b"), same("a", "b"), "left_semi"), "tuples")
    return test.alias("a").join(shared.alias("b"), same("a", "b"), "left_semi").select(id_col)
