"""Training, search, proximity, outlier and attribution queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rarespark.functions import losses
from rarespark.operators import (
    anomaly,
    boosting,
    calibration,
    explain,
    folds,
    forest,
    linear,
    neighbors,
    prep,
    search,
    training,
)
from rarespark.plans.fixtures import (
    FEATURES,
    FOLDS,
    N_TREES,
    leaf_vectors,
    phi,
    scored_long,
    sensor_split,
    sensor_table,
    trial_log,
    vectors,
)
from rarespark.plans.registry import SCORED_LONG, SENSOR, TRAIN, VECTORS, hash_sql, long_sql, query, r6
from rarespark.plans.tree_sql import FEW_VALUES, one_tree_sql, shap_sql
from rarespark.session import cut_lineage, scratch_path
from rarespark.sources import tables

SMALL_CHUNK = 16  # several cells at the tested sizes
#: Depth and bins of the survey; fewer rounds, as each is a pass per level.
BOOSTED = boosting.BoostParams(rounds=20, depth=6, bins=256, eta=0.3)
FOREST = {"trees": 20, "depth": 6}


def _filled_split(spark, sf):
    train, test = sensor_split(spark, sf)
    medians = prep.fit_medians(train, FEATURES)
    return prep.median_impute(train, medians, FEATURES), prep.median_impute(test, medians, FEATURES)


def _folded(spark, sf, k=3):
    return cut_lineage(folds.stratified_folds(sensor_table(spark, sf), k), "folds")


# --- neighbours ----------------------------------------------------------------------


KNN_SQL = f"""with {VECTORS}, m as (select * from vectors where y = 1),
d as (select a.row_id, b.row_id nbr, sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding),
 lambda p: (p[1]::double - p[2]::double) * (p[1]::double - p[2]::double)))) distance
 from m a join m b on a.row_id <> b.row_id),
r as (select *, row_number() over (partition by row_id order by distance, nbr) rk from d)
select row_id, nbr, cast(rk as int) as "rank", round(distance, 6) distance from r where rk <= 5"""


@query("knn_topk", KNN_SQL)
def knn_topk(spark, sf):
    minority = vectors(spark, sf).where("y = 1")
    return neighbors.knn_topk(minority, chunk_rows=SMALL_CHUNK).select("row_id", "nbr", "rank", r6("distance"))


@query("knn_two_levels", KNN_SQL)
def knn_two_levels(spark, sf):
    """The same neighbours through cells of two levels, as tables of many rows need them."""
    minority = vectors(spark, sf).where("y = 1")
    near = neighbors.knn_topk(minority, chunk_rows=SMALL_CHUNK, pivots=2)
    return near.select("row_id", "nbr", "rank", r6("distance"))


SMOTE_SQL = f"""with {VECTORS}, m as (select * from vectors where y = 1),
d as (select a.row_id, b.row_id nbr, sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding),
 lambda p: (p[1]::double - p[2]::double) * (p[1]::double - p[2]::double)))) distance
 from m a join m b on a.row_id <> b.row_id),
nn as (select row_id, nbr, row_number() over (partition by row_id order by distance, nbr) rk from d),
c as (select sum(y)::bigint n1, (count(*) - sum(y))::bigint n0 from vectors),
q as (select row_id, row_number() over (order by {hash_sql('row_id', 42)}, row_id) rn from m),
g as (select row_id, unnest(range(1, (n0 - n1) // n1 + (case when rn <= (n0 - n1) % n1 then 2 else 1 end))) copy from q, c),
p as (select row_id, copy,
 cast(floor({hash_sql('(row_id * 7919 + copy * 104729)', 42)} / 4294967296.0::double * 5) as bigint) + 1 as pick,
 {hash_sql('(row_id * 6101 + copy * 90001)', 43)} / 4294967296.0::double as u from g)"""


@query("smote", f"""{SMOTE_SQL} select p.row_id, cast(copy as int) as copy, 1 as y, nbr as base_nbr, round(u, 6) as u
from p join nn on nn.row_id = p.row_id and nn.rk = p.pick
union all select row_id, 0, y, null, null from vectors""")
def smote(spark, sf):
    out = neighbors.smote(vectors(spark, sf), chunk_rows=SMALL_CHUNK)
    return out.select("row_id", "copy", "y", "base_nbr", F.round("u", 6).alias("u"))


@query("smote_balance", f"""with {VECTORS}, c as (select y, count(*) n from vectors group by y)
select y, cast((select max(n) from c) as bigint) as "rows", cast((select max(n) from c) - n as bigint) made from c""")
def smote_balance(spark, sf):
    out = neighbors.smote(vectors(spark, sf))
    return out.groupBy("y").agg(F.count("*").alias("rows"), F.count(F.when(F.col("copy") > 0, 1)).alias("made"))


@query("imbalance_compare")
def imbalance_compare(spark, sf):
    return training.imbalance_compare(_folded(spark, sf, FOLDS), FEATURES)


# --- linear and forest ---------------------------------------------------------------


@query("elastic_net_fit")
def elastic_net_fit(spark, sf):
    train, _ = sensor_split(spark, sf)
    model = training.fit_elastic_net(train, FEATURES, 0.1, 0.5)
    fit = model.stages[-1]
    rows = [(c, float(v)) for c, v in zip(FEATURES, fit.coefficients)] + [("intercept", float(fit.intercept))]
    return spark.createDataFrame(rows, "feature string, coefficient double")


@query("grid_search")
def grid_search(spark, sf):
    """All 25 points over five folds."""
    return training.grid_search(_folded(spark, sf, 5), FEATURES)


@query("best_refit")
def best_refit(spark, sf):
    """Test scores of the best grid point, fitted again on all train rows."""
    rows = _folded(spark, sf, 5)
    train, test = rows.where("row_id % 5 <> 0"), rows.where("row_id % 5 = 0")
    grid = training.grid_search(train, FEATURES)
    return training.score_models({"Elastic Net": training.refit_best(train, FEATURES, grid)}, test)


@query("random_forest_fit")
def random_forest_fit(spark, sf):
    train, test = sensor_split(spark, sf)
    model = training.fit_random_forest(train, FEATURES, **FOREST)
    return training.score_models({"Random Forest": model}, test)


@query("score_models")
def score_models(spark, sf):
    train, test = sensor_split(spark, sf)
    models = {
        "Elastic Net": training.fit_elastic_net(train, FEATURES, 0.1, 0.5, 100),
        "Random Forest": training.fit_random_forest(train, FEATURES, **FOREST),
    }
    rated = training.score_models(models, test)
    filled, filled_test = _filled_split(spark, sf)
    boosted = boosting.boosted_trees_fit(filled, FEATURES, BOOSTED)
    last = boosted.transform(filled_test).select("row_id", "y", F.lit("Boosted").alias("model"), "proba")
    return rated.unionByName(last)


@query("model_persist", f"""with {TRAIN} select 'Elastic Net' model, cast(count(*) as bigint) as "rows", 0.0::double max_change
from test""")
def model_persist(spark, sf):
    """Change of the scores after saving and loading the model."""
    train, test = sensor_split(spark, sf)
    path = scratch_path(spark, "model")
    model = training.fit_elastic_net(train, FEATURES, 0.1, 0.5, 100)
    tables.save_model(model, path)
    before = training.score_models({"Elastic Net": model}, test).withColumnRenamed("proba", "was")
    after = training.score_models({"Elastic Net": tables.load_model(path)}, test)
    both = after.join(before, ["row_id", "model"])
    return both.groupBy("model").agg(
        F.count("*").alias("rows"), F.max(F.abs(F.col("proba") - F.col("was"))).alias("max_change")
    )


@query("boosted_pack", f"""with {TRAIN} select 'weighted' strategy, cast(count(*) as bigint) as "rows", 0.0::double max_change
from test""")
def boosted_pack(spark, sf):
    """Change of a boosted model's scores of raw rows after saving and loading it with its medians."""
    train, test = sensor_split(spark, sf)
    medians = prep.fit_medians(train, FEATURES)
    model = boosting.boosted_trees_fit(prep.median_impute(train, medians, FEATURES), FEATURES, BOOSTED)
    path = scratch_path(spark, "pack")
    boosting.BoostedPack(model, medians, BOOSTED, "weighted").save(spark, path)
    pack = boosting.BoostedPack.load(spark, path)
    before = model.transform(prep.median_impute(test, medians, FEATURES)).select("row_id", F.col("proba").alias("was"))
    both = pack.transform(test).join(before, "row_id")
    change = F.max(F.abs(F.col("proba") - F.col("was"))).alias("max_change")
    return both.agg(F.lit(pack.strategy).alias("strategy"), F.count("*").alias("rows"), change)


@query("cv_model_scores")
def cv_model_scores(spark, sf):
    fits = {
        "Elastic Net": lambda r, m: training.fit_elastic_net(r, FEATURES, 0.1, 0.5, 100, medians=m),
        "Random Forest": lambda r, m: training.fit_random_forest(r, FEATURES, **FOREST, medians=m),
    }
    # a linear fit keeps a third of a forest's bytes, and its many short jobs leave cores idle
    at_once = {"Elastic Net": 3, "Random Forest": 2}
    return training.cv_comparison(_folded(spark, sf), fits, features=FEATURES, parallelism=at_once).drop("seconds")


def _linear_rated(train, rows):
    """Five folds' models over ``train``: scores of each fold's own rows, and of ``rows``."""
    points = [linear.Point(0.1, 0.5, f) for f in range(FOLDS)]
    models = linear.linear_fits(train, FEATURES, points, "fold")
    own = linear.out_of_fold_scores(train, models, keep=["row_id"]).select("row_id", "y", "fold", "proba")
    both = own.withColumn("is_tune", F.lit(True)).unionByName(linear.scores_by_fold(rows, models).withColumn("is_tune", F.lit(False)))
    return cut_lineage(both, "rated")


@query("cv_calibration")
def cv_calibration(spark, sf):
    """Elastic net: the models and the maps of all folds are fitted together."""
    rows = _folded(spark, sf, FOLDS)
    train, test = rows.where("row_id % 5 <> 0"), rows.where("row_id % 5 = 0")
    return calibration.calibrate_across_folds(_linear_rated(train, test), "sigmoid")


@query("calibrate_across_folds")
def calibrate_across_folds(spark, sf):
    """A linear model and a forest whose test error asks for calibration, each across folds."""
    rows = _folded(spark, sf, FOLDS)
    train, test = rows.where("row_id % 5 <> 0"), rows.where("row_id % 5 = 0")
    net = linear.linear_fits(train, FEATURES, [linear.Point(0.1, 0.5)])[0]
    forest = training.fit_random_forest(train, FEATURES, **FOREST)

    def of_forest(fit_rows, both):
        model = training.fit_random_forest(fit_rows, FEATURES, **FOREST)
        return cut_lineage(training.positive_score(model.transform(both)).select("row_id", "y", "is_tune", "proba"), "cal")

    cross_net = calibration.cross_of(lambda: _linear_rated(train, rows))
    cross_forest = calibration.cross_of(lambda: calibration.rated_by_fold(train, rows, of_forest, FOLDS))

    parts = []
    for name, score, cross in (
        ("Elastic Net", net.transform, cross_net),
        ("Random Forest", lambda df: training.positive_score(forest.transform(df)), cross_forest),
    ):
        tune, held = (cut_lineage(score(df).select("row_id", "y", "proba"), "scored") for df in (train, test))
        _, out, done = calibration.calibrate_if_needed(tune, held, name, cross=cross, limit=0.0)
        parts.append(out.select("row_id", "y", F.lit(name).alias("model"), "proba", "calibrated", F.lit(done).alias("done")))
    return parts[0].unionByName(parts[1])


# --- boosting ------------------------------------------------------------------------

LOGIT = "margins as (select row_id, model, y, ln((proba*0.98::double + 0.01::double)/(1 - (proba*0.98::double + 0.01::double))) m from scored_long), ps as (select *, 1/(1+exp(-m)) p from margins)"


def _margins(spark, sf):
    p = F.col("proba") * 0.98 + 0.01
    return scored_long(spark, sf).select("row_id", "model", "y", F.log(p / (1 - p)).alias("m"))


@query("focal_loss_grad", f"""with {SCORED_LONG}, {LOGIT}, c as (select *, greatest(least(p, 1 - 1e-7::double), 1e-7::double) q from ps),
w as (select *, case when y=1 then 0.25::double else 0.75::double end * power(1 - case when y=1 then q else 1-q end, 2) w from c)
select row_id, model, round(w*(q-y), 6)+0.0 grad, round(greatest(w*q*(1-q), 1e-6::double), 6) hess from w""")
def focal_loss_grad(spark, sf):
    g, h = losses.focal()(F.col("m"), F.col("y"))
    return _margins(spark, sf).select("row_id", "model", r6(g, "grad"), r6(h, "hess"))


@query("logistic_grad", f"""with {SCORED_LONG}, {LOGIT}
select row_id, model, round(case when y=1 then 37 else 1 end*(p-y), 6)+0.0 grad,
round(case when y=1 then 37 else 1 end*p*(1-p), 6) hess from ps""")
def logistic_grad(spark, sf):
    g, h = losses.logistic(37)(F.col("m"), F.col("y"))
    return _margins(spark, sf).select("row_id", "model", r6(g, "grad"), r6(h, "hess"))


@query("boosted_trees_fit")
def boosted_trees_fit(spark, sf):
    train, _ = _filled_split(spark, sf)
    weight = prep.pos_weight(train).first()["ratio"]
    return boosting.boosted_trees_fit(train, FEATURES, BOOSTED, losses.logistic(weight)).table(spark)


STUMP = ["f_lines", "f_disc", "f_tax"]


@query("boosted_stump", f"""with {SENSOR}, {', '.join(f"m_{f} as (select median({f}) v from sensor)" for f in STUMP)},
x as ({' union all '.join(f"select '{f}' feature, {i} pos, case when f_qty > 150 then 1 else 0 end y, coalesce({f}, (select v from m_{f})) v from sensor" for i, f in enumerate(STUMP))}),
c as (select feature, pos, v, sum(0.5::double - y) g, count(*)*0.25::double h from x group by 1, 2, 3),
w as (select feature, pos, v, sum(g) over w - g gl, sum(h) over w - h hl,
 sum(g) over (partition by feature) gt, sum(h) over (partition by feature) ht
 from c window w as (partition by feature order by v)),
k as (select *, round(0.5::double*(gl*gl/(hl+1) + (gt-gl)*(gt-gl)/(ht-hl+1) - gt*gt/(ht+1)), 6) gain from w
 where hl >= 20 and ht - hl >= 20)
select feature, v threshold, gain, round(-0.3::double*gl/(hl+1), 6) left_value,
round(-0.3::double*(gt-gl)/(ht-hl+1), 6) right_value from k order by k.gain desc, pos, v limit 1""")
def boosted_stump(spark, sf):
    """First split on low-cardinality features, where every value is a bin."""
    rows = sensor_table(spark, sf).withColumn("y", F.when(F.col("f_qty") > 150, 1).otherwise(0))
    rows = prep.median_impute(rows, prep.fit_medians(rows, STUMP), STUMP)
    params = boosting.BoostParams(rounds=1, depth=1, bins=1024, min_child_weight=20.0)
    nodes = boosting.boosted_trees_fit(rows, STUMP, params).table(spark)
    return nodes.agg(
        F.max("feature").alias("feature"),
        F.max("threshold").alias("threshold"),
        r6(F.max("gain"), "gain"),
        r6(F.max(F.when(F.col("node") == 2, F.col("value"))), "left_value"),
        r6(F.max(F.when(F.col("node") == 3, F.col("value"))), "right_value"),
    )


@query("boosted_trees_focal")
def boosted_trees_focal(spark, sf):
    train, test = _filled_split(spark, sf)
    params = boosting.BoostParams(rounds=20, depth=6, min_child_weight=0.0)
    model = boosting.boosted_trees_fit(train, FEATURES, params, losses.focal())
    return model.transform(test).select("row_id", "y", "margin", "proba")


@query("boosted_cv_mcc")
def boosted_cv_mcc(spark, sf):
    return search.boosted_cv_mcc(_folded(spark, sf, 5), FEATURES, BOOSTED, losses.logistic(10))


def _stump_rows(spark, sf):
    rows = sensor_table(spark, sf).withColumn("y", F.when(F.col("f_qty") > 150, 1).otherwise(0))
    return rows.withColumn("fold", (F.col("row_id") % 5).cast("int"))


@query("hyperparam_trials")
def hyperparam_trials(spark, sf):
    """All trials of both strategies over five folds of few-valued features, in the survey's space."""
    out = search.hyperparam_trials(_stump_rows(spark, sf), STUMP, scratch_path(spark, "trials"))
    rounded = {k: F.round(k, 6) for k, (lo, _) in search.SPACE.items() if not isinstance(lo, int)}
    return out.withColumns(rounded).withColumn("value", r6("value"))


@query("hyperparam_search")
def hyperparam_search(spark, sf):
    """All trials of both strategies over five folds of the whole table, in the survey's space."""
    return search.hyperparam_trials(_folded(spark, sf, 5), FEATURES, scratch_path(spark, "trials"))


TRIAL = f"""tl as (select cast(floor(c_custkey/100) as bigint) experiment,
case when cast(floor(c_custkey/50) as bigint) % 2 = 0 then 'weighted' else 'focal' end study,
cast(c_custkey % 50 as int) trial, ({hash_sql('c_custkey', 5)}) % 1000/1000.0::double as value,
cast(3 + ({hash_sql('c_custkey', 6)}) % 8 as int) max_depth,
0.01::double + ({hash_sql('c_custkey', 7)}) % 290/1000.0::double learning_rate from customer)"""
RUN = ["experiment", "study"]


@query("trial_history", f"""with {TRIAL} select experiment, study, trial, value,
max(value) over (partition by experiment, study order by trial) best from tl""")
def trial_history(spark, sf):
    return search.trial_history(trial_log(spark, sf), RUN)


@query("trial_slice", f"""with {TRIAL} select experiment, study, trial, value, 'max_depth' param, cast(max_depth as double) setting from tl
union all select experiment, study, trial, value, 'learning_rate', learning_rate from tl""")
def trial_slice(spark, sf):
    return search.trial_slice(trial_log(spark, sf), by=RUN)


@query("strategy_select", f"""with {TRIAL}, b as (select experiment, study, max(value) as value from tl group by 1, 2),
r as (select *, row_number() over (partition by experiment order by value desc, study desc) rn from b)
select experiment, study, value from r where rn = 1""")
def strategy_select(spark, sf):
    return search.strategy_select(trial_log(spark, sf), by=["experiment"])


@query("early_stopping", f"""with {TRIAL}, g as (select experiment, study, trial, value loss,
case when value < coalesce(min(value) over (partition by experiment, study order by trial rows between unbounded preceding and 1 preceding), 2)
 then trial end gain from tl),
s as (select *, max(gain) over (partition by experiment, study order by trial) lastg from g),
st as (select experiment, study, min(case when trial - lastg >= 8 then trial end) stop, max(trial) fin from s group by 1, 2)
select s.experiment, s.study, max(s.trial) best_round, min(loss) best_loss, max(coalesce(stop, fin)) stop_round
from s join st on s.experiment = st.experiment and s.study = st.study
where gain is not null and s.trial <= coalesce(stop, fin) group by 1, 2""")
def early_stopping(spark, sf):
    rounds = trial_log(spark, sf).select(*RUN, F.col("trial").alias("round"), F.col("value").alias("loss"))
    return search.early_stopping(rounds, 8, RUN)


# --- proximity and outliers ----------------------------------------------------------

_LEAF_SQL = ", ".join(f"row_id*{2 * t + 3} % 97 % 7" for t in range(N_TREES))
PROX = f"""lv as (select o_orderkey row_id, [{_LEAF_SQL.replace('row_id', 'o_orderkey')}] leaves from orders),
marks as (select * from lv order by {hash_sql(seed=42)}, row_id limit 16),
tr as (select row_id, unnest(leaves) leaf, generate_subscripts(leaves, 1) tree from lv),
mt as (select row_id, unnest(leaves) leaf, generate_subscripts(leaves, 1) tree from marks),
prox as (select a.row_id id_a, b.row_id id_b, count(*)/{N_TREES}::double prox from tr a join mt b
 on a.tree = b.tree and a.leaf = b.leaf group by 1, 2)"""


def _marks(leaves):
    return folds.simple_sample(leaves, 16)


@query("proximity", f"with {PROX} select id_a, id_b, round(prox, 6) prox from prox")
def proximity(spark, sf):
    leaves = leaf_vectors(spark, sf)
    return anomaly.proximity_to_landmarks(leaves, _marks(leaves)).select("id_a", "id_b", r6("prox"))


@query("dissimilarity", f"""with {PROX} select l.row_id id_a, m.row_id id_b, round(1 - coalesce(prox, 0), 6) dissimilarity
from lv l cross join marks m left join prox p on p.id_a = l.row_id and p.id_b = m.row_id""")
def dissimilarity(spark, sf):
    leaves = leaf_vectors(spark, sf)
    pairs = anomaly.proximity_to_landmarks(leaves, _marks(leaves), absent=True)
    return anomaly.dissimilarity(pairs).select("id_a", "id_b", r6("dissimilarity"))


def _forest_leaves(spark, sf):
    rows = sensor_table(spark, sf)
    model = training.fit_random_forest(rows, FEATURES, **FOREST)
    return rows, model, cut_lineage(training.forest_leaves(model, rows), "leaves")


@query("forest_leaves")
def forest_leaves(spark, sf):
    return training.leaf_table(_forest_leaves(spark, sf)[2])


@query("forest_leaf_counts", f"""with {SENSOR} select cast(t as int) tree, cast(count(*) as bigint) as "rows",
true as numbered from sensor cross join range(0, {FOREST['trees']}) r(t) group by t""")
def forest_leaf_counts(spark, sf):
    """Every row stands in one leaf of every tree."""
    leaves = training.leaf_table(_forest_leaves(spark, sf)[2])
    return leaves.groupBy("tree").agg(
        F.count("*").alias("rows"), (F.min("leaf") >= 0).alias("numbered")
    )


#: Levels of the tree that SQL follows; the survey's forest has no limit.
LEVELS = 5


@query("forest_one_tree", f"""with {one_tree_sql(LEVELS)} select row_id, y, cast(zeros as bigint) zeros, cast(ones as bigint) ones,
round(proba, 6) proba from g{LEVELS} g join leaf l on g.node = l.node""")
def forest_one_tree(spark, sf):
    """The leaf of every row in a tree of all rows and features: its class counts and share."""
    rows = _few_values(spark, sf)
    params = forest.ForestParams(trees=1, max_depth=LEVELS, max_features=3, bins=1024, bootstrap=False)
    model = forest.forest_fit(rows, FEW_VALUES, params)
    ends = model.transform(rows, leaves="leaves").withColumn("node", F.col("leaves")[0])
    return ends.join(model.nodes.select("node", "zeros", "ones"), "node").select("row_id", "y", "zeros", "ones", r6("proba"))


@query("forest_to_purity")
def forest_to_purity(spark, sf):
    """The survey's forest: 500 trees without depth limit, five rows a leaf. Scores of the test rows."""
    train, test = _filled_split(spark, sf)
    return forest.forest_fit(train, FEATURES).transform(test).select("row_id", "y", "proba")


SAMPLE_PAIRS = 1000


@query("proximity_sample", f"""with o as (select o_orderkey row_id from orders),
s as (select row_id from o order by {hash_sql('row_id', folds.SEED)}, row_id limit {SAMPLE_PAIRS}),
p as (select {' + '.join(f'(((a.row_id*{2 * t + 3}) % 97 % 7) = ((b.row_id*{2 * t + 3}) % 97 % 7))::int' for t in range(N_TREES))} as shared
from s a join s b on a.row_id < b.row_id)
select round(1 - shared/{float(N_TREES)}::double, 6) dissimilarity, cast(count(*) as bigint) pairs from p group by shared""")
def proximity_sample(spark, sf):
    """How far the pairs of a sample are from each other, pairs without a common leaf included."""
    sample = folds.simple_sample(leaf_vectors(spark, sf), SAMPLE_PAIRS)
    return anomaly.dissimilarity_histogram(sample).select(r6("dissimilarity"), "pairs")


@query("proximity_embed_2d")
def proximity_embed_2d(spark, sf):
    return anomaly.proximity_embed_2d(_forest_leaves(spark, sf)[2])


@query("embedding_stress")
def embedding_stress(spark, sf):
    """Stress of the layout to its landmarks over all rows: classical scaling, and refined."""
    leaves = _forest_leaves(spark, sf)[2]
    marks = folds.simple_sample(leaves, anomaly.LANDMARKS)
    parts = []
    for name, steps in (("classical", 0), ("refined", anomaly.EMBED_STEPS)):
        layout = cut_lineage(anomaly.proximity_embed_2d(leaves, steps=steps), "embedding")
        parts.append(anomaly.embedding_stress(layout, leaves, marks).withColumn("layout", F.lit(name)))
    return parts[0].unionByName(parts[1])


@query("isolation_forest")
def isolation_forest(spark, sf):
    rows, model, leaves = _forest_leaves(spark, sf)
    embedded = cut_lineage(anomaly.proximity_embed_2d(leaves), "embedding")
    flagged = anomaly.isolation_forest(embedded, ["x1", "x2"])
    rated = training.score_models({"Random Forest": model}, rows).drop("model")
    return anomaly.uncertainty(flagged.join(rated, "row_id"))


@query("uncertainty", f"""with {SCORED_LONG} select row_id, model, round(abs(proba - 0.5), 6) uncertainty,
(case when proba >= 0.5 then 1 else 0 end) <> y as misclassified from scored_long""")
def uncertainty(spark, sf):
    out = anomaly.uncertainty(scored_long(spark, sf))
    return out.select("row_id", "model", r6("uncertainty"), "misclassified")


@query("outlier_vs_inlier", f"""with {SCORED_LONG} select row_id % 20 = 7 as is_outlier, cast(count(*) as bigint) as "rows",
round(avg(abs(proba-0.5)), 6) mean_uncertainty, round(avg(proba), 6) mean_proba,
round(avg(case when (case when proba >= 0.5 then 1 else 0 end) <> y then 1.0 else 0.0 end), 6) error_rate
from scored_long group by 1""")
def outlier_vs_inlier(spark, sf):
    rows = scored_long(spark, sf).withColumn("is_outlier", F.col("row_id") % 20 == 7)
    out = anomaly.outlier_vs_inlier(rows)
    return out.select("is_outlier", "rows", r6("mean_uncertainty"), r6("mean_proba"), r6("error_rate"))


@query("z_shift", f"""with {SENSOR}, {long_sql()}, s as (select feature, median(value) ma,
median(case when row_id % 20 = 7 then value end) mo, stddev_samp(value) sd from lng group by feature)
select feature, round(abs((mo - ma)/(sd + 1e-8)), 6) z_shift from s order by 2 desc, feature limit 10""")
def z_shift(spark, sf):
    rows = sensor_table(spark, sf).withColumn("is_outlier", F.col("row_id") % 20 == 7)
    return anomaly.z_shift(rows, FEATURES).withColumn("z_shift", r6("z_shift"))


# --- attributions --------------------------------------------------------------------

PHI = f"""{SENSOR}, {long_sql()}, mean as (select feature, avg(value) mv from lng group by feature),
phi as (select l.row_id, l.y, cast(l.row_id % 5 as int) fold, l.feature, l.value - mv as phi, l.value as val
from lng l join mean m on l.feature = m.feature),
imp as (select feature, avg(abs(phi)) mean_abs from phi group by feature)"""


@query("tree_shap")
def tree_shap(spark, sf):
    train, test = _filled_split(spark, sf)
    model = boosting.boosted_trees_fit(train, FEATURES, BOOSTED)
    return explain.tree_shap(model, folds.simple_sample(test))


@query("tree_shap_sums", f"""with {TRAIN} select row_id, 0.0::double gap from test""")
def tree_shap_sums(spark, sf):
    """Attributions and base against the margin, row by row."""
    train, test = _filled_split(spark, sf)
    model = boosting.boosted_trees_fit(train, FEATURES, BOOSTED)
    total = explain.tree_shap(model, test).groupBy("row_id").agg(F.sum("phi").alias("phi"))
    gap = F.col("phi") + explain.expected_margin(model) - F.col("margin")
    return model.transform(test).join(total, "row_id").select("row_id", r6(gap, "gap"))


TWO_LEVELS = boosting.BoostParams(rounds=1, depth=2, bins=1024, min_child_weight=20.0)


def _two_level_phi(spark, sf):
    """Attributions of all rows on a fitted tree of two levels, which SQL can grow too; to 9
    digits, so that ties are ties."""
    rows = _few_values(spark, sf)
    model = boosting.boosted_trees_fit(rows, FEW_VALUES, TWO_LEVELS)
    phi_rows = explain.tree_shap(model, rows)
    return model, rows, phi_rows.withColumn("phi", F.round("phi", 9) + F.lit(0.0))


def _labelled(spark, sf):
    hit = (F.col("f_qty") > 150) | (F.col("f_disc") > 0.09)
    return sensor_table(spark, sf).withColumn("y", F.when(hit, 1).otherwise(0))


def _few_values(spark, sf):
    rows = _labelled(spark, sf)
    return prep.median_impute(rows, prep.fit_medians(rows, FEW_VALUES), FEW_VALUES)


SHAP = shap_sql()


@query("tree_shap_rows", f"with {SHAP} select row_id, y, feature, value, round(phi, 6)+0.0 phi from phi")
def tree_shap_rows(spark, sf):
    """Attributions of every row, feature by feature."""
    return _two_level_phi(spark, sf)[2].select("row_id", "y", "feature", "value", r6("phi"))


@query("boosted_pack_scores", f"""with {SHAP} select row_id, round(e, 6)+0.0 margin, round(1/(1 + exp(-e)), 6) proba
from known where mask = 7""")
def boosted_pack_scores(spark, sf):
    """Raw rows, gaps included, scored by a pack that was written and read back."""
    rows = _labelled(spark, sf)
    medians = prep.fit_medians(rows, FEW_VALUES)
    model = boosting.boosted_trees_fit(prep.median_impute(rows, medians, FEW_VALUES), FEW_VALUES, TWO_LEVELS)
    path = scratch_path(spark, "pack")
    boosting.BoostedPack(model, medians, TWO_LEVELS, "plain").save(spark, path)
    return boosting.BoostedPack.load(spark, path).transform(rows).select("row_id", r6("margin"), r6("proba"))


@query("shap_importance_fitted", f"""with {SHAP} select feature, round(avg(abs(phi)), 6) mean_abs from phi group by feature""")
def shap_importance_fitted(spark, sf):
    """Importances from the attributions of a fitted model."""
    return explain.shap_importance(_two_level_phi(spark, sf)[2]).select("feature", r6("mean_abs"))


@query("shap_stability_fitted", f"""with {SHAP}, m as (select feature, avg(abs(phi)) m from phi group by feature),
f as (select feature, row_id % 5 fold, avg(abs(phi)) m from phi group by all),
d as (select feature, stddev_pop(m) sd from f group by feature)
select m.feature, round(m.m, 6) mean_abs, round(sd, 6) std_across_folds, sd < (select median(m) from m) as stable
from m join d on m.feature = d.feature""")
def shap_stability_fitted(spark, sf):
    """Spread over folds of the importances of a fitted model."""
    phi_rows = cut_lineage(_two_level_phi(spark, sf)[2].withColumn("fold", F.col("row_id") % FOLDS), "phi")
    return explain.shap_stability(phi_rows).select("feature", r6("mean_abs"), r6("std_across_folds"), "stable")


@query("shap_waterfall_fitted", f"""with {SHAP}, m as (select row_id, any_value(y) y, any_value(e) + sum(phi) margin from phi, base group by row_id),
x as (select min(row_id) row_id from m where y = 1 or margin >= 0 group by y, margin >= 0),
r as (select p.row_id, feature, phi, row_number() over (partition by p.row_id order by abs(phi) desc, feature) step from phi p semi join x on p.row_id = x.row_id),
t as (select row_id, least(step, 3) step, case when min(step) <= 2 then min(feature) else 'other' end feature, sum(phi) phi from r group by 1, 2)
select row_id, cast(step as int) step, feature, round(phi, 6)+0.0 phi,
round(e + sum(phi) over (partition by row_id order by step), 6)+0.0 margin from t, base""")
def shap_waterfall_fitted(spark, sf):
    """The way from the mean margin to that of the first row of each kind of outcome."""
    model, rows, phi_rows = _two_level_phi(spark, sf)
    examples = explain.confusion_examples(model.transform(rows))
    out = explain.shap_waterfall(phi_rows, examples, base=explain.expected_margin(model), top=2)
    return out.select("row_id", "step", "feature", r6("phi"), r6("margin"))


@query("shap_importance", f"with {PHI} select feature, round(mean_abs, 4) mean_abs from imp order by imp.mean_abs desc, feature limit 10")
def shap_importance(spark, sf):
    return explain.shap_importance(phi(spark, sf)).select("feature", F.round("mean_abs", 4).alias("mean_abs"))


@query("shap_summary_points", f"""with {PHI} select row_id, feature, round(phi, 4)+0.0 phi, val as value from phi
where feature in (select feature from imp order by mean_abs desc, feature limit 3)""")
def shap_summary_points(spark, sf):
    rows = cut_lineage(phi(spark, sf), "phi")
    return explain.shap_summary_points(rows, 3).select(
        "row_id", "feature", (F.round("phi", 4) + 0.0).alias("phi"), "value"
    )


@query("shap_dependence", f"""with {PHI} select row_id, feature, val as value, round(phi, 4)+0.0 phi from phi
where feature in (select feature from imp order by mean_abs desc, feature limit 5)""")
def shap_dependence(spark, sf):
    rows = cut_lineage(phi(spark, sf), "phi")
    return explain.shap_dependence(rows).select(
        "row_id", "feature", "value", (F.round("phi", 4) + 0.0).alias("phi")
    )


EXAMPLES = """ex as (select case when y=1 and proba >= 0.5 then 'TP' when y=0 and proba >= 0.5 then 'FP'
when y=1 then 'FN' end kind, min(row_id) row_id from scored_long where model='A' and (y=1 or proba >= 0.5) group by 1)"""


def _examples(spark, sf):
    return explain.confusion_examples(scored_long(spark, sf).where("model = 'A'"))


@query("confusion_examples", f"with {SCORED_LONG}, {EXAMPLES} select kind, row_id from ex")
def confusion_examples(spark, sf):
    return _examples(spark, sf)


@query("shap_waterfall", f"""with {SCORED_LONG}, {EXAMPLES}, {PHI},
r as (select p.row_id, p.feature, p.phi, row_number() over (partition by p.row_id order by abs(p.phi) desc, p.feature) rn
from phi p where p.row_id in (select row_id from ex)),
s as (select row_id, least(rn, 4) step, case when min(rn) <= 3 then min(feature) else 'other' end feature, sum(phi) phi
from r group by 1, 2)
select row_id, cast(step as int) step, feature, round(phi, 4)+0.0 phi,
round(sum(phi) over (partition by row_id order by step) + 0.25, 4)+0.0 margin from s""")
def shap_waterfall(spark, sf):
    out = explain.shap_waterfall(phi(spark, sf), _examples(spark, sf), base=0.25, top=3)
    return out.select(
        "row_id", "step", "feature", (F.round("phi", 4) + 0.0).alias("phi"), (F.round("margin", 4) + 0.0).alias("margin")
    )


@query("shap_stability", f"""with {PHI}, fm as (select feature, fold, avg(abs(phi)) m from phi group by 1, 2),
sp as (select feature, stddev_pop(m) sd from fm group by 1)
select i.feature, round(mean_abs, 4) mean_abs, round(sd, 4) std_across_folds,
sd < (select median(mean_abs) from imp) as stable from imp i join sp on i.feature = sp.feature""")
def shap_stability(spark, sf):
    out = explain.shap_stability(cut_lineage(phi(spark, sf), "phi"))
    return out.select(
        "feature", F.round("mean_abs", 4).alias("mean_abs"), F.round("std_across_folds", 4).alias("std_across_folds"), "stable"
    )
