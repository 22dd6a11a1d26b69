"""Calibration queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rarespark.operators import calibration, metrics
from rarespark.plans.fixtures import scored, scored_long
from rarespark.plans.metric_queries import CHOSEN, RATE_NAMES, ROUNDED, SWEPT
from rarespark.plans.registry import RATES, SCORED, SCORED_LONG, confusion_sql, query, r6, r6_all

EDGES = "edges as (select i, (i-1)*0.1::double lo, case when i=10 then 1.0::double else i*0.1::double end hi from range(1, 11) t(i))"
ECE = """ece as (select model, sum(gap)/max(n) ece from (
select s.model, e.i, abs(sum(case when e.i is not null then y - proba end)) gap,
 (select count(*) from {src} z where z.model = s.model)::double n
from {src} s left join edges e on s.proba > e.lo and s.proba <= e.hi group by s.model, e.i) group by model)"""


@query("ece", f"""with {SCORED_LONG}, {EDGES}, {ECE.format(src='scored_long')} select model, round(ece, 6) ece from ece""")
def ece(spark, sf):
    return calibration.ece(scored_long(spark, sf), by=["model"]).select("model", r6("ece"))


@query("reliability_curve", f"""with {SCORED_LONG}, {EDGES} select model, cast(coalesce(e.i, 1) as int) bin,
cast(count(*) as bigint) as "rows", round(avg(proba), 6) mean_score, round(avg(y), 6) positive_share
from scored_long s left join edges e on s.proba > e.lo and s.proba <= e.hi group by 1, 2""")
def reliability_curve(spark, sf):
    out = calibration.reliability_curve(scored_long(spark, sf), by=["model"])
    return out.select("model", "bin", "rows", r6("mean_score"), r6("positive_share"))


@query("score_histogram", f"""with {SCORED_LONG}, {EDGES} select model, cast(e.i - 1 as int) bin, cast(count(*) as bigint) as "rows"
from scored_long s join edges e on s.proba >= e.lo and (s.proba < e.hi or (e.i = 10 and s.proba <= 1)) group by 1, 2""")
def score_histogram(spark, sf):
    return calibration.score_histogram(scored_long(spark, sf), by=["model"])


# Isotonic fit on the 100 integer scores: max over starts of min over ends of the mean.
ISO = """knots as (select k, cast(sum(y) as double) s, cast(count(*) as double) n from {src} group by k),
cum as (select k, sum(s) over (order by k) cs, sum(n) over (order by k) cn, s, n from knots),
v as (select a.k ka, b.k kb, (b.cs - a.cs + a.s)/(b.cn - a.cn + a.n) v from cum a join cum b on a.k <= b.k),
lows as (select ka, x.k k, min(v) m from v join knots x on v.ka <= x.k and v.kb >= x.k group by ka, x.k),
iso as (select k, max(m) fit from lows group by k)"""


# Isotonic fit on any number of scores: slopes of the greatest convex minorant of the summed
# labels, one vertex a step.
MINORANT = """kn as (select {x} as x, sum(y)::double s, count(*)::double n from {src} group by 1),
cum as (select row_number() over (order by x) k, x, sum(s) over (order by x) cs, sum(n) over (order by x) cn from kn),
hull as (select 0::bigint k, 0.0::double cs, 0.0::double cn, 0.0::double fit union all
select v.k, v.cs, v.cn, v.fit from (select arg_min(struct_pack(k := c.k, cs := c.cs, cn := c.cn, fit := (c.cs - h.cs)/(c.cn - h.cn)),
 ((c.cs - h.cs)/(c.cn - h.cn), -c.k)) v from hull h join cum c on c.k > h.k group by h.k)),
fitted as (select c.x, b.fit from cum c asof join (select * from hull where k > 0) b on c.k <= b.k)"""


@query("isotonic_fit", f"""with recursive {SCORED}, {MINORANT.format(x='p_a', src='scored')}
select row_id, p_a, round(fit, 6) calibrated from scored s join fitted f on s.p_a = f.x""")
def isotonic_fit(spark, sf):
    rows = scored(spark, sf)
    found = calibration.isotonic_apply(rows, calibration.isotonic_fit(rows, "p_a"), "p_a")
    return found.select("row_id", "p_a", r6("calibrated"))


@query("recalibrated_threshold", f"""with {SCORED}, tr as (select * from scored where row_id % 5 <> 0),
{ISO.format(src='tr')}, cal as (select s.row_id, s.y, s.k/100.0::double proba, fit as calibrated
from scored s join iso i on s.k = i.k),
grid(threshold) as (values {', '.join(f'({t!r}::double)' for t in metrics.SWEEP_GRID)}),
cells as (select threshold, y, case when calibrated >= threshold then 1 else 0 end pred from cal cross join grid where row_id % 5 <> 0),
conf as ({confusion_sql('cells', 'threshold')}), rate as (select *, {RATES} from conf),
best as (select threshold from rate order by round(mcc, 12) desc, threshold limit 1),
te as (select c.*, b.threshold, case when calibrated >= b.threshold then 1 else 0 end pred from cal c, best b where row_id % 5 = 0),
c2 as ({confusion_sql('te', 'threshold')}), r2 as (select *, {RATES} from c2), {EDGES},
long as (select 'b' model, y, proba from te union all select 'a', y, calibrated from te), {ECE.format(src='long')}
select round(threshold, 6) threshold, tp, fp, fn, tn, {ROUNDED}, cost,
round((select ece from ece where model='b'), 6) ece_before, round((select ece from ece where model='a'), 6) ece_after from r2""")
def recalibrated_threshold(spark, sf):
    rows = scored(spark, sf).withColumn("proba", F.col("k") / F.lit(100.0))
    tune, test = rows.where("row_id % 5 <> 0"), rows.where("row_id % 5 = 0")
    apply = calibration.calibrator(tune, "isotonic")
    out = calibration.recalibrated_threshold(apply(tune), apply(test))
    return out.select(
        r6("threshold"), "tp", "fp", "fn", "tn", *r6_all(RATE_NAMES), "cost", r6("ece_before"), r6("ece_after")
    )


# Linear between the knots of ISO, constant beyond them: (model, row_id, p, fit).
INTERPOLATED = """xs as (select x.k, (select max(i.k) from iso i where i.k <= x.k) lo, (select min(i.k) from iso i where i.k >= x.k) hi
 from (select distinct k from bt) x),
fx as (select xs.k, case when lo is null then h.fit when hi is null or lo = hi then l.fit
 else l.fit + (h.fit - l.fit) * (xs.k - lo) / (hi - lo) end fit
 from xs left join iso l on l.k = xs.lo left join iso h on h.k = xs.hi)"""


def _calibrated_sql(model: str) -> str:
    return f"""(with tr as (select cast(round(proba*100) as int) k, y from cents where split='train' and model='{model}'),
bt as (select row_id, proba, cast(round(proba*100) as int) k from cents where split='test' and model='{model}'),
{ISO.format(src='tr')}, {INTERPOLATED}, tst as (select * from cents where split='test' and model='{model}'), {EDGES}, {ECE.format(src='tst')}
select '{model}' model, row_id, proba, round(case when (select ece from ece) <= 0.05 then proba else fit end, 6) calibrated
from bt join fx on bt.k = fx.k)"""


@query("calibrate_if_needed", f"""with {SCORED_LONG}, cents as (select row_id, model, y, split, floor(proba*100)/100 proba from scored_long)
select * from {_calibrated_sql('A')} union all select * from {_calibrated_sql('B')}""")
def calibrate_if_needed(spark, sf):
    """Both models, as boosted ones: a map of the train scores if the test error asks for it."""
    rows = scored_long(spark, sf).withColumn("proba", F.floor(F.col("proba") * 100) / 100)
    parts = []
    for model in ("A", "B"):
        own = rows.where(F.col("model") == model)
        _, test, _ = calibration.calibrate_if_needed(own.where("split = 'train'"), own.where("split = 'test'"), model)
        parts.append(test.select("model", "row_id", "proba", r6("calibrated")))
    return parts[0].unionByName(parts[1])


# Platt's map by Newton steps over the scores pooled with their smoothed targets.
PLATT = """n as (select sum(y)::double np, (count(*) - sum(y))::double nn from {src}),
q as (select list(struct_pack(x := proba, t := case when y=1 then (np+1)/(np+2) else 1/(nn+2) end, w := w)) as e
 from (select proba, y, count(*)::double w from {src} group by 1, 2), n),
newton as (select 0 as it, 0.0::double a, 0.0::double b union all
select it + 1, a - (h22*g1 - h12*g2)/(h11*h22 - h12*h12), b - (h11*g2 - h12*g1)/(h11*h22 - h12*h12) from (
select it, a, b,
 list_sum(list_transform(z, lambda r: r.w*(r.p - r.t)*r.x)) g1, list_sum(list_transform(z, lambda r: r.w*(r.p - r.t))) g2,
 list_sum(list_transform(z, lambda r: r.w*r.p*(1 - r.p)*r.x*r.x)) h11, list_sum(list_transform(z, lambda r: r.w*r.p*(1 - r.p)*r.x)) h12,
 list_sum(list_transform(z, lambda r: r.w*r.p*(1 - r.p))) h22 from (
select it, a, b, list_transform(e, lambda r: struct_pack(x := r.x, t := r.t, w := r.w, p := 1/(1 + exp(-(a*r.x + b))))) z
from newton, q where it < 40))),
ab as (select a, b from newton where it = 40)"""


def _platt_sql(model: str) -> str:
    return f"""(with recursive src as (select * from scored_long where model = '{model}'), {PLATT.format(src='src')}
select model, row_id, proba, round(1/(1 + exp(-(a*proba + b))), 8) calibrated from src, ab)"""


@query("platt_fit", f"with {SCORED_LONG} select * from {_platt_sql('A')} union all select * from {_platt_sql('B')}")
def platt_fit(spark, sf):
    rows = scored_long(spark, sf)
    parts = []
    for model in ("A", "B"):
        own = rows.where(F.col("model") == model)
        out = calibration.calibrator(own, "sigmoid")(own)
        parts.append(out.select("model", "row_id", "proba", F.round("calibrated", 8).alias("calibrated")))
    return parts[0].unionByName(parts[1])


# Scores cut to whole per cents, so that the best model's map has at most 101 knots.
CENT = SWEPT.replace("scored_long as (select row_id, model, y, proba,", "scored_long as (select row_id, model, y, floor(proba*100)/100 proba,")


@query("final_comparison", f"""with {CENT}, {CHOSEN}, t as (select * from judged where split='test'),
c2 as ({confusion_sql('t', 'model, threshold')}), r2 as (select *, {RATES} from c2),
tst as (select * from scored_long where split='test'), {EDGES}, {ECE.format(src='tst')},
co as (select *, row_number() over (partition by model order by cost, threshold) r from rate where split='train'),
jt as (select * from judged where split='train'), c3 as ({confusion_sql('jt', 'model, threshold')}), r3 as (select *, {RATES} from c3),
b as (select model from r3 order by r3.mcc desc, model limit 1),
tr as (select cast(round(proba*100) as int) k, y from scored_long where split='train' and model in (select model from b)),
{ISO.format(src='tr')},
bt as (select cast(round(proba*100) as int) k, y from tst where model in (select model from b)),
xs as (select x.k, (select max(i.k) from iso i where i.k <= x.k) lo, (select min(i.k) from iso i where i.k >= x.k) hi
 from (select distinct k from bt) x),
fx as (select xs.k, case when lo is null then h.fit when hi is null or lo = hi then l.fit
 else l.fit + (h.fit - l.fit) * (xs.k - lo) / (hi - lo) end fit
 from xs left join iso l on l.k = xs.lo left join iso h on h.k = xs.hi),
cal as (select 'c' model, y, fit proba from bt join fx on bt.k = fx.k), {ECE.replace('ece as', 'ece2 as').format(src='cal')}
select r2.model, round(r2.threshold, 6) threshold, r2.tp, r2.fp, r2.fn, r2.tn, round(r2.mcc, 6)+0.0 mcc, r2.cost,
round(e.ece, 6) ece_before, case when r2.model in (select model from b) then (select round(ece, 6) from ece2) end ece_after,
round(co.threshold, 6) cost_threshold
from r2 left join ece e on r2.model = e.model left join co on co.model = r2.model and co.r = 1""")
def final_comparison(spark, sf):
    rows = scored_long(spark, sf).withColumn("proba", F.floor(F.col("proba") * 100) / 100)
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    table = metrics.tune_then_evaluate(train, test)
    # the best model and the cost threshold come from train rows, as every threshold does
    best = metrics.best_model(metrics.tune_then_evaluate(train, train)).first()["model"]
    apply = calibration.calibrator(train.where(F.col("model") == best), "isotonic")
    after = calibration.ece(apply(test.where(F.col("model") == best)), by=["model"], score="calibrated")
    cost = metrics.optimal_threshold(metrics.threshold_sweep(train, "cost", by=["model"]), ["model"])
    out = calibration.final_comparison(
        table,
        calibration.ece(test, by=["model"]),
        after.withColumnRenamed("ece", "ece_after"),
        cost.select("model", F.col("threshold").alias("cost_threshold")),
    )
    return out.select(
        "model", r6("threshold"), "tp", "fp", "fn", "tn", r6("mcc"), "cost", r6("ece_before"), r6("ece_after"),
        r6("cost_threshold"),
    )
