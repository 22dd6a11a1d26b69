"""The search's row table, its fits, and its trials."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from oracle_check import compare, connect
from stump_sql import STUMP_SPACE, STUMP_SQL

from rarespark.functions import losses
from rarespark.operators import boosting, search
from rarespark.plans import model_queries
from rarespark.plans.model_queries import STUMP
from rarespark.plans.registry import QUERIES, r6


def test_row_groups_of_the_state_hold_few_blocks(spark):
    """A reader holds a row group whole: it must not grow with the fits that share the rows."""
    rows = spark.range(200_000).select(F.col("id").alias("row_id"), (F.col("id") % 2).alias("y"), (F.col("id") % 7).cast("double").alias("a"))
    state = boosting._start(rows, ["a"], [[1.0, 2.0]], [0.0] * 64, "row_id", "y", None)
    parts = [pq.ParquetFile(f).metadata for f in Path(state.stage_path.removeprefix("file://")).glob("*.parquet")]
    groups = [m.row_group(k) for m in parts for k in range(m.num_row_groups)]
    assert sum(g.total_byte_size for g in groups) > 200_000 * 64 * 8
    assert max(g.total_byte_size for g in groups) <= 2 * boosting.BLOCK_BYTES


@pytest.fixture(scope="module")
def odd_rows(spark):
    """Rows with gaps, twice the same id, a null id and a null fold."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(900):
        a, b, c = rng.normal(), float(rng.integers(0, 6)), rng.random()
        y = int(a + 0.4 * b + rng.normal() > 1.5)
        rows.append((i if i else None, y, a if i % 7 else None, b, c if i % 11 else None, i % 3 if i != 5 else None))
    return spark.createDataFrame(rows + rows[:40], "row_id bigint, y int, a double, b double, c double, fold int")


FILLS = {0: {"a": 0.1, "c": 0.4}, 1: {"a": -0.2, "c": 0.5}, 2: {"a": 0.0, "c": 0.6}}


def counted(rows, fits):
    table = boosting.out_of_fold_counts(rows, ["a", "b", "c"], fits, fills=FILLS)
    return sorted(tuple(r) for r in table.collect())


def test_fits_in_a_task_match_shared_passes(spark, odd_rows, monkeypatch):
    fits = []
    for depth, share, objective in ((1, 1.0, losses.focal()), (4, 0.7, losses.logistic(3.0)), (7, 0.9, losses.logistic())):
        params = boosting.BoostParams(rounds=6, depth=depth, subsample=share, colsample=share, bins=32, reg_alpha=0.1, min_child_weight=0.5)
        fits += [boosting.Fit(params, objective, fold) for fold in FILLS]
    alone = counted(odd_rows, fits)
    assert len(alone) == 9 and len({a[2:] for a in alone}) > 3
    assert counted(odd_rows.repartition(5), fits) == alone
    for limit in (0, 2 * (940 * 26)):  # rows that don't fit, levels that don't fit
        monkeypatch.setattr(boosting, "ALONE_BYTES", limit)
        assert counted(odd_rows, fits) == alone


def test_splits_of_many_nodes_at_once():
    """Each node's best split is that of trying its cuts one by one."""
    rng = np.random.default_rng(2)
    bins, slot = rng.integers(0, 9, (3, 200)).astype(np.int16), rng.integers(0, 30, 200)
    g, h = rng.normal(size=200), rng.random(200)
    sums = boosting._bin_sums(bins, np.arange(3), np.arange(200), slot, g, h, 30, 9)
    params = boosting.BoostParams(reg_alpha=0.2, min_child_weight=0.3)
    gain, f, b, left, total = boosting.best_splits(sums, params)
    for k in range(30):
        best = (-1.0, 0, 0)
        gt, ht = sums[:, k, 0].sum(axis=1)
        for i in range(3):
            for j in range(9):
                gl, hl = sums[:, k, i, : j + 1].sum(axis=1)
                if hl >= 0.3 and ht - hl >= 0.3 and ht - hl > 1e-12 * ht:
                    part = [max(abs(g) - 0.2, 0) ** 2 / (h + 1.0) for g, h in ((gl, hl), (gt - gl, ht - hl), (gt, ht))]
                    rated = round(0.5 * (part[0] + part[1] - part[2]), 9)
                    if rated > best[0] + 1e-8:
                        best = (rated, i, j)
        assert (gain[k], f[k], b[k]) == (pytest.approx(best[0], abs=2e-9), *best[1:])
        assert total[:, k] == pytest.approx([gt, ht])
        if best[0] > 0:
            assert left[:, k] == pytest.approx(sums[:, k, f[k], : b[k] + 1].sum(axis=1))


@pytest.mark.parametrize("name", ["hyperparam_search", "hyperparam_trials"])
def test_searches_run_the_survey_space(spark, sf, monkeypatch, name):
    """Rounds, depths and shares are those of the survey, for every trial and fold."""
    ran = []

    def values(train, features, specs, medians, **kept):
        ran.extend((p, len(medians)) for p, _ in specs)
        return spark.createDataFrame([(i, len(medians), 0.0) for i in range(len(specs))], "spec int, folds int, mcc double")

    monkeypatch.setattr(search, "boosted_cv_values", values)
    log = QUERIES[name](spark, sf).collect()
    assert len(log) == len(ran) == 2 * search.TRIALS and {n for _, n in ran} == {5}
    for name, least, most in (("rounds", 100, 500), ("depth", 3, 10), ("subsample", 0.6, 1.0), ("colsample", 0.6, 1.0)):
        found = [getattr(p, name) for p, _ in ran]
        assert least <= min(found) < least + (most - least) / 5 and most - (most - least) / 5 < max(found) <= most


def test_trials_of_stumps_match_sql(spark, sf, tmp_path):
    out = search.hyperparam_trials(model_queries._stump_rows(spark, sf), STUMP, str(tmp_path / "log"), space=STUMP_SPACE)
    rounded = {k: F.round(k, 6) for k, (lo, _) in STUMP_SPACE.items() if not isinstance(lo, int)}
    assert compare(out.withColumns(rounded).withColumn("value", r6("value")), connect(sf), STUMP_SQL) == ""
