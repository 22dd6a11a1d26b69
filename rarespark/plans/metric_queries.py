"""Threshold, metric, curve and comparison queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rarespark.operators import curves, metrics
from rarespark.operators.metrics import COARSE_GRID, SWEEP_GRID
from rarespark.plans.fixtures import scored_long, sensor
from rarespark.plans.registry import (
    RATES,
    SCORED_LONG,
    SENSOR,
    confusion_sql,
    grid_sql,
    query,
    r6,
    r6_all,
)

RATE_NAMES = ["precision", "recall", "f1_binary", "f1_macro", "mcc"]

ROUNDED = """round("precision", 6) "precision", round(recall, 6) recall, round(f1_binary, 6) f1_binary,
round(f1_macro, 6) f1_macro, round(mcc, 6)+0.0 mcc"""


def at_half(spark, sf):
    return metrics.apply_threshold(scored_long(spark, sf), 0.5)


PRED = SCORED_LONG + ", pred as (select *, case when proba >= 0.5 then 1 else 0 end pred from scored_long)"
CONF = PRED + f", conf as ({confusion_sql('pred', 'model')}), rate as (select *, {RATES} from conf)"
SWEPT = (
    SCORED_LONG
    + ", "
    + grid_sql(SWEEP_GRID)
    + f""", cells as (select model, split, threshold, y, case when proba >= threshold then 1 else 0 end pred
from scored_long cross join grid), conf as ({confusion_sql('cells', 'model, split, threshold')}),
rate as (select *, {RATES} from conf)"""
)
SWEPT_ALL = (
    SCORED_LONG
    + ", "
    + grid_sql(SWEEP_GRID)
    + f""", cells as (select model, threshold, y, case when proba >= threshold then 1 else 0 end pred
from scored_long cross join grid), conf as ({confusion_sql('cells', 'model, threshold')}),
rate as (select *, {RATES} from conf)"""
)
AP = """steps as (select {by}, proba, cast(sum(y) as double) pos, cast(count(*) as double) n from {src} group by {by}, proba),
run as (select *, sum(pos) over (partition by {by} order by proba desc) tp,
 sum(n) over (partition by {by} order by proba desc) m, sum(pos) over (partition by {by}) p_all,
 sum(n) over (partition by {by}) n_all from steps),
ap as (select {by}, sum(pos/p_all * tp/m) auprc from run group by {by})"""


@query("apply_threshold", f"with {PRED} select row_id, model, pred from pred")
def apply_threshold(spark, sf):
    return at_half(spark, sf).select("row_id", "model", "pred")


@query("classification_metrics", f"with {CONF} select model, tp, fp, fn, tn, {ROUNDED} from rate")
def classification_metrics(spark, sf):
    out = metrics.classification_metrics(at_half(spark, sf), ["model"])
    return out.select("model", "tp", "fp", "fn", "tn", *r6_all(RATE_NAMES))


@query("ida_cost", f"with {CONF} select model, fp, fn, cost from rate")
def ida_cost(spark, sf):
    return metrics.total_cost(at_half(spark, sf), ["model"])


@query("naive_baseline_cost", f"with {SENSOR} select cast(sum(y) as bigint) fn, cast(500*sum(y) as bigint) as cost from sensor")
def naive_baseline_cost(spark, sf):
    return metrics.naive_baseline_cost(sensor(spark, sf))


for _metric, _expr in (("mcc", "mcc"), ("f1", "f1_macro"), ("cost", "-cast(cost as double)")):

    @query(
        f"threshold_sweep_{_metric}",
        f"with {SWEPT_ALL} select model, round(threshold, 6) threshold, round({_expr}, 6)+0.0 score from rate",
    )
    def threshold_sweep(spark, sf, metric=_metric):
        out = metrics.threshold_sweep(scored_long(spark, sf), metric, by=["model"])
        return out.select("model", r6("threshold"), r6("score"))

    @query(
        f"optimal_threshold_{_metric}",
        f"""with {SWEPT_ALL}, s as (select model, threshold, {_expr} score from rate),
o as (select *, row_number() over (partition by model order by score desc, threshold) r from s)
select model, round(threshold, 6) threshold, round(score, 6)+0.0 score from o where r = 1""",
    )
    def optimal_threshold(spark, sf, metric=_metric):
        sweep = metrics.threshold_sweep(scored_long(spark, sf), metric, by=["model"])
        return metrics.optimal_threshold(sweep, ["model"]).select("model", r6("threshold"), r6("score"))


@query("mcc_cost_grid", f"""with {SCORED_LONG}, {grid_sql(COARSE_GRID)},
cells as (select model, threshold, y, case when proba >= threshold then 1 else 0 end pred from scored_long cross join grid),
conf as ({confusion_sql('cells', 'model, threshold')}), rate as (select *, {RATES} from conf)
select model, round(threshold, 6) threshold, round(mcc, 6)+0.0 mcc, cost,
row_number() over (partition by model order by mcc desc, threshold) = 1 as best_mcc,
row_number() over (partition by model order by cost, threshold) = 1 as best_cost from rate""")
def mcc_cost_grid(spark, sf):
    out = metrics.mcc_cost_grid(scored_long(spark, sf), by=["model"])
    return out.select("model", r6("threshold"), r6("mcc"), "cost", "best_mcc", "best_cost")


CHOSEN = """o as (select *, row_number() over (partition by model order by mcc desc, threshold) r from rate where split='train'),
chosen as (select model, threshold from o where r = 1),
judged as (select s.model, s.split, c.threshold, s.y, case when s.proba >= c.threshold then 1 else 0 end pred
from scored_long s join chosen c on s.model = c.model)"""


@query("tune_on_train_eval_on_test", f"""with {SWEPT}, {CHOSEN}, t as (select * from judged where split='test'),
c2 as ({confusion_sql('t', 'model, threshold')}), r2 as (select *, {RATES} from c2)
select model, round(threshold, 6) threshold, tp, fp, fn, tn, {ROUNDED}, cost from r2""")
def tune_on_train_eval_on_test(spark, sf):
    rows = scored_long(spark, sf)
    out = metrics.tune_then_evaluate(rows.where("split = 'train'"), rows.where("split = 'test'"))
    return out.select("model", r6("threshold"), "tp", "fp", "fn", "tn", *r6_all(RATE_NAMES), "cost")


@query("train_test_comparison", f"""with {SWEPT}, {CHOSEN}, c2 as ({confusion_sql('judged', 'model, split')}),
r2 as (select *, {RATES} from c2)
select model, round(max(case when split='train' then f1_macro end), 6) train_f1_macro,
round(max(case when split='train' then mcc end), 6)+0.0 train_mcc,
max(case when split='train' then cost end) train_cost,
round(max(case when split='test' then f1_macro end), 6) test_f1_macro,
round(max(case when split='test' then mcc end), 6)+0.0 test_mcc,
max(case when split='test' then cost end) test_cost from r2 group by model""")
def train_test_comparison(spark, sf):
    out = metrics.train_test_comparison(scored_long(spark, sf))
    return out.select(
        "model",
        *[
            F.col(f"{s}_{m}") if m == "cost" else r6(f"{s}_{m}")
            for s in ("train", "test")
            for m in ("f1_macro", "mcc", "cost")
        ],
    )


@query("best_model", f"""with {CONF} select model, round(mcc, 6)+0.0 mcc from rate order by rate.mcc desc, model limit 1""")
def best_model(spark, sf):
    rows = metrics.classification_metrics(at_half(spark, sf), ["model"])
    return metrics.best_model(rows).select("model", r6("mcc"))


CV = (
    SCORED_LONG
    + ", pred as (select *, case when proba >= 0.5 then 1 else 0 end pred from scored_long)"
    + f", conf as ({confusion_sql('pred', 'model, fold')}), rate as (select *, {RATES} from conf), "
    + AP.format(by="model, fold", src="scored_long")
    + """, cv as (select r.model, round(avg(f1_macro), 6) f1_macro_mean, round(stddev_pop(f1_macro), 6) f1_macro_std,
round(avg(auprc), 6) auprc_mean, round(stddev_pop(auprc), 6) auprc_std,
round(avg(mcc), 6)+0.0 mcc_mean, round(stddev_pop(mcc), 6) mcc_std
from rate r join ap on r.model = ap.model and r.fold = ap.fold group by r.model)"""
)
CV_COLS = [f"{m}_{s}" for m in ("f1_macro", "auprc", "mcc") for s in ("mean", "std")]


def _cv(spark, sf):
    rows = at_half(spark, sf)
    ap = curves.average_precision(rows, ["model", "fold"])
    return metrics.cv_summary(rows, ap).select("model", *[r6(c) for c in CV_COLS])


@query("cv_summary", f"with {CV} select * from cv")
def cv_summary(spark, sf):
    return _cv(spark, sf)


@query("cv_comparison_table", f"""with {CV}, u as (select * from cv
union all select 'boosted ' || model, null, null, null, null, mcc_mean, 0.0 from cv where model = 'A'
union all select 'unscored ' || model, null, null, null, null, null, null from cv where model = 'B')
select * from u where mcc_mean is not null""")
def cv_comparison_table(spark, sf):
    cv = _cv(spark, sf)
    boosted = cv.where("model = 'A'").select(
        F.concat(F.lit("boosted "), "model").alias("model"), "mcc_mean", F.lit(0.0).alias("mcc_std")
    )
    unscored = cv.where("model = 'B'").select(F.concat(F.lit("unscored "), "model").alias("model"))
    _, chart = metrics.cv_comparison_table([cv, boosted, unscored])
    return chart


@query("metrics_report", f"""with {CONF}, l as (select model, printf('%.4f', f1_macro) f1_macro, printf('%.4f', mcc) mcc,
printf('%.4f', "precision") "precision", printf('%.4f', recall) recall,
printf('%,d', cost) as cost,
printf('TP=%d | FP=%d | FN=%d | TN=%d', tp, fp, fn, tn) as counts from rate)
unpivot l on f1_macro, mcc, "precision", recall, cost, counts into name item value text""")
def metrics_report(spark, sf):
    return metrics.metrics_report(metrics.classification_metrics(at_half(spark, sf), ["model"]))


@query("model_barplot_data", f"""with {CONF}, {AP.format(by='model', src='scored_long')},
j as (select r.model, round(f1_macro, 6) f1_macro, round(auprc, 6) auprc, round(mcc, 6)+0.0 mcc
from rate r join ap on r.model = ap.model)
unpivot j on f1_macro, auprc, mcc into name metric value value""")
def model_barplot_data(spark, sf):
    from rarespark.operators import report

    rows = at_half(spark, sf)
    table = metrics.classification_metrics(rows, ["model"]).join(curves.average_precision(rows, ["model"]), "model")
    return report.model_barplot_data(table).select("model", "metric", r6("value"))


BY_MODEL = AP.format(by="model", src="scored_long")


@query("average_precision", f"with {SCORED_LONG}, {BY_MODEL} select model, round(auprc, 6) auprc from ap")
def average_precision(spark, sf):
    return curves.average_precision(scored_long(spark, sf), ["model"]).select("model", r6("auprc"))


@query("pr_curve", f"""with {SCORED_LONG}, {BY_MODEL} select model, proba as threshold, round(tp/m, 6) "precision",
round(tp/p_all, 6) recall, round(p_all/n_all, 6) baseline from run
union all select model, null, 1.0::double, 0.0::double, round(max(p_all)/max(n_all), 6) from run group by model""")
def pr_curve(spark, sf):
    out = curves.pr_curve(scored_long(spark, sf), ["model"])
    return out.select("model", "threshold", r6("precision"), r6("recall"), r6("baseline"))


@query("roc_curve", f"""with {SCORED_LONG}, {BY_MODEL} select model, proba as threshold,
round((m-tp)/(n_all-p_all), 6) fpr, round(tp/p_all, 6) tpr from run
union all select model, 'inf'::double, 0.0::double, 0.0::double from run group by model""")
def roc_curve(spark, sf):
    return curves.roc_curve(scored_long(spark, sf), ["model"]).select("model", "threshold", r6("fpr"), r6("tpr"))


@query("roc_auc", f"""with {SCORED_LONG}, rk as (select model, y,
rank() over (partition by model order by proba) + (count(*) over (partition by model, proba) - 1)/2.0::double rk from scored_long),
s as (select model, sum(case when y=1 then rk end) sr, cast(sum(y) as double) np, cast(count(*)-sum(y) as double) nn
from rk group by model) select model, round((sr - np*(np+1)/2)/(np*nn), 6) auc from s""")
def roc_auc(spark, sf):
    return curves.roc_auc(scored_long(spark, sf), ["model"]).select("model", r6("auc"))
