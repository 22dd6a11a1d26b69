from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rarespark.functions import ranks
from rarespark.operators import correlation, folds


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one value; some are missing."""
    rng = np.random.default_rng(1)
    n = 3000
    v = np.where(rng.random(n) < 0.34, 0.0, rng.normal(size=n))
    w = np.where(rng.random(n) < 0.2, np.nan, rng.integers(0, 5, n).astype(float))
    pdf = pd.DataFrame({"row_id": np.arange(n), "v": v, "w": w, "g": rng.integers(0, 2, n), "c": 3.0})
    df = spark.createDataFrame(pdf).withColumn("w", F.when(~F.isnan("w"), F.col("w")))
    return df, pdf


@pytest.mark.parametrize("parts", [1, 8])
def test_exact_quantiles(hot, parts):
    df, pdf = hot
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    rows = ranks.exact_quantiles(df.repartition(parts), ["v", "w", "c"], probs).collect()
    got = {(r["feature"], r["prob"]): r["quantile"] for r in rows}
    assert len(got) == len(probs) * 3
    for c in ("v", "w", "c"):
        for p in probs:
            assert got[c, p] == pytest.approx(pdf[c].quantile(p), abs=1e-12)


def test_quantiles_by_group_and_empty_column(spark, hot):
    df, pdf = hot
    df = df.withColumn("none", F.lit(None).cast("double"))
    rows = ranks.exact_quantiles(df, ["v", "none"], [0.5], ["g"]).collect()
    got = {r["g"]: r["quantile"] for r in rows}
    assert {r["feature"] for r in rows} == {"v"}
    for g, part in pdf.groupby("g"):
        assert got[g] == pytest.approx(part["v"].median())


def test_quantiles_beyond_the_broadcast_limit(hot, monkeypatch):
    from rarespark.functions import small

    monkeypatch.setattr(ranks, "fetch_if_small", lambda df: small.fetch_if_small(df, 0))
    df, pdf = hot
    got = ranks.exact_quantiles(df, ["v"], [0.5]).first()["quantile"]
    assert got == pytest.approx(pdf["v"].median())


def test_average_ranks(hot):
    df, pdf = hot
    got = {r["v"]: r["rank"] for r in ranks.average_ranks(df, "v").collect()}
    want = dict(zip(pdf["v"], pdf["v"].rank()))
    assert got == pytest.approx(want)


def test_join_on_hot_values(hot, monkeypatch):
    df, pdf = hot
    monkeypatch.setattr(ranks, "BROADCAST_BYTES", 0)
    table = ranks.average_ranks(df, "v")
    out = ranks.join_on_values(df.select("row_id", "v"), table, ["v"])
    assert out.count() == len(pdf)
    got = out.toPandas().sort_values("row_id")["rank"].to_numpy()
    assert got == pytest.approx(pdf["v"].rank().to_numpy())


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    df = spark.range(500).select(F.col("id").cast("double").alias("k"), (F.col("id") % 2).alias("g"), F.lit(2).alias("x"))
    out = ranks.running_totals(df, "k", {"s": "x"}, ["g"], descending).toPandas()
    for _, part in out.groupby("g"):
        part = part.sort_values("k", ascending=not descending)
        assert part["s"].tolist() == list(range(2, 2 * len(part) + 1, 2))


def test_row_numbers_do_not_depend_on_partitions(hot):
    df, pdf = hot
    one = ranks.shuffled_row_number(df.repartition(1), "row_id", 5, ["g"]).select("row_id", "rn").toPandas()
    two = ranks.shuffled_row_number(df.repartition(7), "row_id", 5, ["g"]).select("row_id", "rn").toPandas()
    assert one.sort_values("row_id")["rn"].tolist() == two.sort_values("row_id")["rn"].tolist()
    for g, part in one.merge(pdf, on="row_id").groupby("g"):
        assert sorted(part["rn"]) == list(range(1, len(part) + 1))


def test_wide_ids_do_not_overflow(spark):
    df = spark.range(2000).select((F.col("id") * F.lit(8589934592 + 1)).alias("row_id"), (F.col("id") % 2).alias("y"))
    out = folds.stratified_folds(df, 5)
    sizes = [r["count"] for r in out.groupBy("y", "fold").count().collect()]
    assert sizes == [200] * 10


def test_samples_are_exact(hot):
    df, pdf = hot
    df = df.withColumn("y", (F.col("row_id") % 50 == 0).cast("int"))
    out = folds.stratified_sample(df, 500).groupBy("y").count().collect()
    assert {r["y"]: r["count"] for r in out} == {1: 10, 0: 490}
    assert folds.simple_sample(df, 700).count() == 700
    assert folds.simple_sample(df, 10_000).count() == len(pdf)
    by = folds.simple_sample(df, 100, by=["g"]).groupBy("g").count().collect()
    assert [r["count"] for r in by] == [100, 100]


def test_spearman_matches_pandas(hot):
    df, pdf = hot
    cols = ["v", "w", "row_id", "g", "u", "u2"]
    rng = np.random.default_rng(2)
    u = np.where(rng.random(len(pdf)) < 0.3, np.nan, pdf["v"] + rng.normal(size=len(pdf)))
    pdf = pdf.assign(u=u, u2=-(u**2))  # u2 has the gaps of u
    extra = df.sparkSession.createDataFrame(pdf[["row_id", "u", "u2"]])
    df = df.join(extra, "row_id").withColumn("key", F.col("row_id"))
    for c in ("u", "u2"):
        df = df.withColumn(c, F.when(~F.isnan(c), F.col(c)))
    assert correlation.gap_patterns(df, cols) == [None, "w", None, None, "u", "u"]
    got = {(r["feature_a"], r["feature_b"]): r["rho"] for r in correlation.spearman_matrix(df, cols, "key").collect()}
    want = pdf[cols].corr(method="spearman")
    assert len(got) == 36
    for a in cols:
        for b in cols:
            assert got[a, b] == pytest.approx(want.loc[a, b], abs=1e-9), (a, b)


def gappy_table(spark, rows, columns, seed=1, share=0.15):
    """Wide rows in which every column has gaps of its own, one most of its values, one all of
    another's gaps, one no value but one."""
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 30, (rows, columns)).astype(float) + rng.random((rows, columns)) * (np.arange(columns) % 2)
    x[rng.random(x.shape) < share] = np.nan
    x[:, 0] = rng.random(rows)
    x[rng.random(rows) < 0.8, 1] = np.nan
    x[:, 2] = np.where(np.isnan(x[:, 3]), np.nan, -x[:, 0])
    x[:, 4] = np.where(np.isnan(x[:, 4]), np.nan, 7.0)
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(columns)])
    df = spark.createDataFrame(pdf.assign(row_id=np.arange(rows)))
    return df.select("row_id", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in pdf.columns]), pdf


def agrees(found, want):
    got = {(r["feature_a"], r["feature_b"]): r["rho"] for r in found.collect()}
    for (a, b), rho in got.items():
        if np.isnan(want.loc[a, b]):
            assert rho is None, (a, b)
        else:
            assert rho == pytest.approx(want.loc[a, b], abs=1e-9), (a, b)
    return len(got)


@pytest.mark.parametrize("side", [correlation.SIDE_BYTES, 20_000, 0])
def test_spearman_with_many_gap_patterns(spark, monkeypatch, side):
    """All columns in one pass, in blocks of columns, and beyond the limit of a pair."""
    monkeypatch.setattr(correlation, "SIDE_BYTES", side)
    df, pdf = gappy_table(spark, 700, 9)
    want = pdf.corr(method="spearman")
    assert agrees(correlation.spearman_matrix(df.repartition(3), list(pdf.columns)), want) == 81
    one = correlation.spearman_with(df, list(pdf.columns[:-1]), "c8")
    assert agrees(one, want) == 9


def test_moved_bytes_do_not_follow_the_patterns(spark):
    """Rows hold one rank per present cell, whether 2 or 40 gap patterns are there."""
    sizes = []
    for patterns in (2, 40):
        rng = np.random.default_rng(5)
        x = rng.random((400, 40))
        gaps = rng.random((400, patterns)) < 0.1
        x[gaps[:, np.arange(40) % patterns]] = np.nan
        pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(40)])
        df = spark.createDataFrame(pdf.assign(row_id=np.arange(400)))
        df = df.select("row_id", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in pdf.columns])
        rows = correlation.rank_rows(df, list(pdf.columns))
        assert rows.schema.simpleString() == "struct<cells:array<struct<i:int,rank:double>>>"
        sizes.append(rows.agg(F.sum(F.size("cells"))).first()[0])
        agrees(correlation.spearman_matrix(df, list(pdf.columns)), pdf.corr(method="spearman"))
    assert sizes[1] == pytest.approx(sizes[0], rel=0.05)


def test_quantiles_of_pools_read_rows_once(hot):
    """Each pool of groups has the quantiles of its rows, and a row's cells are counted once."""
    df, pdf = hot
    df = df.withColumn("k", (F.col("row_id") % 3).cast("int"))
    others = F.filter(F.array(*[F.lit(i) for i in range(3)]), lambda i: i != F.col("k"))
    got = {(r["pool"], r["feature"]): r["quantile"] for r in ranks.exact_quantiles(df, ["v", "w"], [0.5], ["k"], others).collect()}
    assert len(got) == 6
    for (k, c), found in got.items():
        assert found == pytest.approx(pdf[pdf["row_id"] % 3 != k][c].median(), abs=1e-12)


@pytest.mark.parametrize("most", [10, 100_000])
def test_counts_of_a_task_are_added_up(most, monkeypatch):
    """Counts that fit are put out once a task, whatever the batches; beyond it in parts."""
    monkeypatch.setattr(ranks, "HELD_COUNTS", most)
    rng = np.random.default_rng(4)
    batches = [pa.RecordBatch.from_pydict({"g": rng.integers(0, 2, 50), "v": rng.normal(size=50)}) for _ in range(20)]
    out = pa.Table.from_batches(ranks._count_cells(iter(batches), ["g"], [np.linspace(-2, 2, 9)])).to_pandas()
    whole = pa.Table.from_batches(batches).to_pandas()
    assert out["_c"].sum() == len(whole)
    want = whole.groupby(["g", np.searchsorted(np.linspace(-2, 2, 9), whole["v"], side="right")]).size()
    assert out.groupby(["g", "_bucket"])["_c"].sum().tolist() == want.tolist()
    assert most == 10 or len(out) == len(want)


def test_cuts_of_many_buckets_are_cheap(spark):
    """Cuts of a wide sample took a core 7 s, as every probe walked all values again."""
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        df = spark.range(120_000, numPartitions=8).select(*[(F.col("id") * (7919 + i) % 120_011).cast("double").alias(f"c{i}") for i in range(6)])
        plan = []
        first = type(df).first
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(type(df), "first", lambda self: plan.append(self._jdf.queryExecution().toString()) or first(self))
            got = {r["feature"]: r["quantile"] for r in ranks.exact_quantiles(df, df.columns, [0.5]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert "percentile(" not in plan[0]
    pdf = df.toPandas()
    assert got == {c: pdf[c].median() for c in df.columns}
