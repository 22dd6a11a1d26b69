"""Profiling, correlation, preparation and sampling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rarespark.operators import correlation, curves, folds, metrics, prep, profile, report
from rarespark.plans.fixtures import FEATURES, scored_long, sensor, sensor_split, sensor_table
from rarespark.plans.registry import RATES, SCORED_LONG, SENSOR, TRAIN, confusion_sql, hash_sql, long_sql, query, r6, sweep_sql
from rarespark.session import scratch_path
from rarespark.sources import tables

LONG = SENSOR + ", " + long_sql()
ALL = "(select count(*) from sensor)"


@query("class_distribution", f"""with {SENSOR} select y, cast(count(*) as bigint) as "rows",
round(count(*)*100.0::double/{ALL}, 6) pct from sensor group by y""")
def class_distribution(spark, sf):
    return profile.class_distribution(sensor(spark, sf)).withColumn("pct", r6("pct"))


MISSING = f"""{LONG}, names(feature) as (values {', '.join(f"('{f}')" for f in FEATURES)}),
ms as (select n.feature, (1 - (select count(*) from lng l where l.feature = n.feature)::double/{ALL})*100 missing_pct from names n)"""


@query("missing_profile", f"""with {MISSING} select feature, round(missing_pct, 6) missing_pct from ms
where missing_pct > 0 order by ms.missing_pct desc, feature limit 30""")
def missing_profile(spark, sf):
    return profile.missing_profile(sensor(spark, sf), FEATURES).withColumn("missing_pct", r6("missing_pct"))


@query("missing_summary", f"""with {MISSING} select round(avg(missing_pct), 6) mean_missing_pct,
cast(count(case when missing_pct > 50 then 1 end) as bigint) features_high from ms""")
def missing_summary(spark, sf):
    return profile.missing_summary(sensor(spark, sf), FEATURES).withColumn("mean_missing_pct", r6("mean_missing_pct"))


STATS = """round(avg(value), 4) as mean, round(stddev_samp(value), 4) std, min(value) as "min",
round(median(value), 6) as "median", max(value) as "max" """
STAT_COLS = [("mean", 4), ("std", 4), ("min", None), ("median", 6), ("max", None)]


def _stats():
    return [F.col(c) if d is None else F.round(c, d).alias(c) for c, d in STAT_COLS]


@query("describe_features", f"with {LONG} select feature, {STATS} from lng group by feature")
def describe_features(spark, sf):
    return profile.describe_features(sensor_table(spark, sf), FEATURES).select("feature", *_stats())


@query("describe_by_class", f"with {LONG} select y, feature, {STATS} from lng group by y, feature")
def describe_by_class(spark, sf):
    return profile.describe_features(sensor_table(spark, sf), FEATURES, ["y"]).select("y", "feature", *_stats())


@query("iqr_outliers", f"""with {LONG}, q as (select feature, quantile_cont(value, 0.25) q1, quantile_cont(value, 0.75) q3
from lng group by feature), b as (select feature, q1 - 1.5::double*(q3-q1) lo, q3 + 1.5::double*(q3-q1) hi from q)
select l.feature, round(min(lo), 6) low, round(min(hi), 6) high,
cast(count(case when value < lo or value > hi then 1 end) as bigint) outliers, cast(count(*) as bigint) present,
round(count(case when value < lo or value > hi then 1 end)*100.0::double/count(*), 6) outlier_pct
from lng l join b on l.feature = b.feature group by l.feature""")
def iqr_outliers(spark, sf):
    out = profile.iqr_outliers(sensor_table(spark, sf), FEATURES)
    return out.select("feature", r6("low"), r6("high"), "outliers", "present", r6("outlier_pct"))


@query("distribution_by_class", f"""with {LONG} select feature, y, min(value) as "min",
round(quantile_cont(value, 0.25), 6) q1, round(quantile_cont(value, 0.5), 6) as "median",
round(quantile_cont(value, 0.75), 6) q3, max(value) as "max" from lng group by feature, y""")
def distribution_by_class(spark, sf):
    out = profile.class_quantiles(sensor_table(spark, sf), FEATURES)
    return out.select("feature", "y", "min", r6("q1"), r6("median"), r6("q3"), "max")


@query("density_by_class", f"""with {LONG}, b as (select feature, min(value) lo, max(value) hi,
case when max(value) = min(value) then 1.0::double else (max(value)-min(value))/20 end w from lng group by feature),
c as (select l.feature, l.y, cast(least(floor((value-lo)/w), 19) as int) bin, min(w) w, count(*) n
from lng l join b on l.feature = b.feature group by 1, 2, 3)
select feature, y, bin, cast(n as bigint) as "rows",
round(n/(sum(n) over (partition by feature, y)*w), 6) density from c""")
def density_by_class(spark, sf):
    return profile.class_density(sensor_table(spark, sf), FEATURES).withColumn("density", r6("density"))


# Ranks restricted to the rows where both features are present, pair by pair.
_NAMES = [*FEATURES, "y"]


def _pair_sql(a: str, b: str) -> str:
    ra, rb = (
        f"(rank() over (order by {c}) + (count(*) over (partition by {c}) - 1)/2.0::double)" for c in (a, b)
    )
    return (
        f"select '{a}' feature_a, '{b}' feature_b, corr(ra, rb) rho from "
        f"(select {ra} ra, {rb} rb from sensor where {a} is not null and {b} is not null)"
    )


def spearman_sql(names) -> str:
    pairs = [_pair_sql(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    return (
        f"{SENSOR}, up as ({' union all '.join(pairs)}), names(f) as (values "
        + ", ".join(f"('{n}')" for n in names)
        + """), matrix as (select feature_a, feature_b, rho from up union all select feature_b, feature_a, rho from up
union all select f, f, 1.0::double from names)"""
    )


SPEARMAN = spearman_sql(FEATURES)
SPEARMAN_Y = spearman_sql(_NAMES)
INDEX = "list_position([" + ", ".join(f"'{f}'" for f in FEATURES) + "], {})"


@query("spearman_matrix", f"with {SPEARMAN} select feature_a, feature_b, round(rho, 6)+0.0 rho from matrix")
def spearman_matrix(spark, sf):
    return correlation.spearman_matrix(sensor_table(spark, sf), FEATURES).withColumn("rho", r6("rho"))


@query("lower_triangle", f"""with {SPEARMAN} select feature_a, feature_b, round(rho, 6)+0.0 rho from matrix
where {INDEX.format('feature_a')} >= {INDEX.format('feature_b')}""")
def lower_triangle(spark, sf):
    matrix = correlation.spearman_matrix(sensor_table(spark, sf), FEATURES)
    return correlation.lower_triangle(matrix, FEATURES).withColumn("rho", r6("rho"))


@query("top_correlated_features", f"""with {SPEARMAN}, s as (select feature_a, sum(abs(rho)) total from matrix group by 1
order by total desc, feature_a limit 3) select feature_a, feature_b, round(rho, 6)+0.0 rho from matrix
where feature_a in (select feature_a from s) and feature_b in (select feature_a from s)""")
def top_correlated_features(spark, sf):
    _, sub = correlation.top_correlated_features(correlation.spearman_matrix(sensor_table(spark, sf), FEATURES), 3)
    return sub.withColumn("rho", r6("rho"))


@query("target_correlation", f"""with {SPEARMAN_Y} select feature_a as feature, round(rho, 6)+0.0 rho,
round(abs(rho), 6) strength from matrix where feature_b = 'y' and feature_a <> 'y'""")
def target_correlation(spark, sf):
    own = correlation.spearman_with(sensor_table(spark, sf), FEATURES)
    return correlation.target_correlation(own).select("feature", r6("rho"), r6("strength"))


@query("correlated_pairs", f"""with {SPEARMAN} select feature_a, feature_b, round(abs(rho), 6) strength from matrix
where {INDEX.format('feature_a')} < {INDEX.format('feature_b')} and abs(rho) > 0.5""")
def correlated_pairs(spark, sf):
    matrix = correlation.spearman_matrix(sensor_table(spark, sf), FEATURES)
    return correlation.correlated_pairs(matrix, FEATURES, 0.5).withColumn("strength", r6("strength"))


@query("feature_prune_pairs", f"""with {SPEARMAN_Y}, t as (select feature_a f, abs(rho) s from matrix where feature_b = 'y')
select feature_a, feature_b, case when ta.s >= tb.s then feature_a else feature_b end as keep,
case when ta.s >= tb.s then feature_b else feature_a end as "drop"
from matrix join t ta on feature_a = ta.f join t tb on feature_b = tb.f
where {INDEX.format('feature_a')} < {INDEX.format('feature_b')} and feature_b <> 'y' and abs(rho) > 0.5""")
def feature_prune_pairs(spark, sf):
    matrix = correlation.spearman_matrix(sensor_table(spark, sf), _NAMES)
    pairs = correlation.correlated_pairs(matrix.where("feature_a <> 'y' and feature_b <> 'y'"), FEATURES, 0.5)
    return correlation.drop_from_pairs(pairs, correlation.target_correlation(matrix))


@query("class_mean_delta", f"""with {SPEARMAN_Y}, top as (select feature_a f from matrix where feature_b = 'y' and feature_a <> 'y'
order by abs(rho) desc, feature_a limit 5), {long_sql()}
select feature, round(avg(case when y=0 then value end), 6) mean_neg, round(avg(case when y=1 then value end), 6) mean_pos,
round(avg(case when y=1 then value end) - avg(case when y=0 then value end), 6) delta
from lng where feature in (select f from top) group by feature""")
def class_mean_delta(spark, sf):
    rows = sensor_table(spark, sf)
    own = correlation.spearman_with(rows, FEATURES)
    top = [r["feature"] for r in correlation.target_correlation(own).limit(5).collect()]
    out = profile.class_mean_delta(rows, top)
    return out.select("feature", *[F.round(c, 6).alias(c) for c in ("mean_neg", "mean_pos", "delta")])


def _imputed(spark, sf):
    rows = sensor_table(spark, sf)
    return prep.median_impute(rows, prep.fit_medians(rows, FEATURES), FEATURES)


N = len(FEATURES)
_IMP = ", ".join(f"coalesce({f}, (select median({f}) from sensor)) {f}" for f in FEATURES)
_CORR = ", ".join("1.0::double" if a == b else f"corr({a}, {b})" for a in FEATURES for b in FEATURES)
CORR = f"{SENSOR}, imp as (select {_IMP} from sensor), cm as (select [{_CORR}] as m from imp)"
NAMES = "[" + ", ".join(f"'{f}'" for f in FEATURES) + "]"
VIF = f"""{CORR}, {sweep_sql('cm', 'ci', N)},
vifs as (select {NAMES}[j] feature, inv[(j - 1) * {N} + j] vif from ci, range(1, {N + 1}) r(j))"""


@query("vif", f"with recursive {VIF} select feature, round(vif, 4) vif from vifs")
def vif(spark, sf):
    return correlation.vif(_imputed(spark, sf), FEATURES).withColumn("vif", F.round("vif", 4))


@query("vif_pair", f"""with {SENSOR}, two as (select coalesce(f_qty, (select median(f_qty) from sensor)) a,
coalesce(f_lines, (select median(f_lines) from sensor)) b from sensor),
v as (select round(1/(1 - corr(a, b)*corr(a, b)), 6) vif from two)
select 'f_qty' as feature, vif from v union all select 'f_lines', vif from v""")
def vif_pair(spark, sf):
    return correlation.vif(_imputed(spark, sf), ["f_qty", "f_lines"]).withColumn("vif", r6("vif"))


@query("vif_summary", f"""with recursive {VIF} select feature, round(vif, 4) vif,
(select cast(count(*) as bigint) from vifs where vif > 5) features_high from vifs order by vifs.vif desc, feature limit 10""")
def vif_summary(spark, sf):
    high, top = correlation.vif_summary(correlation.vif(_imputed(spark, sf), FEATURES))
    return top.withColumn("features_high", high.scalar()).withColumn("vif", F.round("vif", 4))


PRUNE_LIMIT = 1.05


def _prune_sql() -> str:
    """Each step inverts the matrix, finds the most inflated column and cuts its ties."""
    parts, source = [CORR], "cm"
    for step in range(1, N):
        parts.append(sweep_sql(source, f"c{step}", N))
        parts.append(
            f"w{step} as (select j, inv[(j - 1) * {N} + j] vif from c{step}, range(1, {N + 1}) r(j) "
            f"where inv[(j - 1) * {N} + j] >= {PRUNE_LIMIT} order by vif desc, j limit 1)"
        )
        cut = f"case when (t - 1) // {N} = (t - 1) % {N} then 1.0::double when (t - 1) // {N} + 1 = w or (t - 1) % {N} + 1 = w then 0 else m[t] end"
        parts.append(
            f"m{step} as (select list_transform(range(1, {N * N + 1}), lambda t: {cut}) as m "
            f"from {source}, (select coalesce(max(j), 0) w from w{step}))"
        )
        source = f"m{step}"
    steps = " union all ".join(f"select {s} as step, {NAMES}[j] feature, round(vif, 4) vif from w{s}" for s in range(1, N))
    return f"with recursive {', '.join(parts)} {steps}"


@query("feature_prune_vif", _prune_sql())
def feature_prune_vif(spark, sf):
    return correlation.prune_by_vif(_imputed(spark, sf), FEATURES, PRUNE_LIMIT).withColumn("vif", F.round("vif", 4))


def _axis_sql(matrix: str, out: str) -> str:
    """First principal axis by power iteration, signed by its largest loading."""
    times = f"list_transform(range(1, {N + 1}), lambda i: list_sum(list_transform(range(1, {N + 1}), lambda j: m[(i - 1) * {N} + j] * v[j])))"
    return f"""{out}_p as (select 0 as it, [{', '.join(f'{1 + k / 7}::double' for k in range(N))}] as v union all
select it + 1, list_transform(w, lambda x: x / sqrt(list_sum(list_transform(w, lambda y: y * y)))) from (
select it, {times} as w from {out}_p, {matrix} where it < 3000)),
{out}_u as (select v, list_sum(list_transform(range(1, {N + 1}), lambda i: v[i] * ({times})[i])) as lam
from {out}_p, {matrix} where it = 3000),
{out} as (select list_transform(v, lambda x: x * sign(v[list_position(list_transform(v, lambda z: round(abs(z), 9)),
list_max(list_transform(v, lambda z: round(abs(z), 9))))])) as v, lam from {out}_u)"""


_STD = ", ".join(f"avg({f}) a_{f}, stddev_pop({f}) s_{f}" for f in FEATURES)
_DOT = [" + ".join(f"({f} - a_{f}) / s_{f} * {x}.v[{i + 1}]" for i, f in enumerate(FEATURES)) for x in ("e1", "e2")]


@query("project_2d", f"""with recursive {CORR.replace('imp as (select ', 'imp as (select row_id, y, ')}, {_axis_sql('cm', 'e1')},
cm2 as (select list_transform(range(1, {N * N + 1}), lambda t: m[t] - lam * v[(t - 1) // {N} + 1] * v[(t - 1) % {N} + 1]) as m from cm, e1),
{_axis_sql('cm2', 'e2')}, st as (select {_STD} from imp)
select row_id, y, round({_DOT[0]}, 4) + 0.0 x1, round({_DOT[1]}, 4) + 0.0 x2 from imp, st, e1, e2""")
def project_2d(spark, sf):
    rows = sensor_table(spark, sf)
    out = profile.project_2d(prep.Prepare(inputCols=FEATURES).fit(rows).transform(rows))
    return out.select("row_id", "y", (F.round("x1", 4) + 0.0).alias("x1"), (F.round("x2", 4) + 0.0).alias("x2"))


# --- preparation -------------------------------------------------------------------

_MED = ", ".join(f"(select median({f}) from train) m_{f}" for f in FEATURES)
_FILL = ", ".join(f"coalesce({f}, m_{f}) {f}" for f in FEATURES)
FILLED = f"{TRAIN}, med as (select {_MED}), filled as (select row_id, y, {_FILL} from sensor, med)"
_SC = ", ".join(f"avg({f}) a_{f}, stddev_pop({f}) s_{f}" for f in FEATURES)
_Z = ", ".join(f"round(({f} - a_{f})/s_{f}, 6)+0.0 {f}" for f in FEATURES)
SCALED = f"{FILLED}, sc as (select {_SC} from filled where row_id % 5 <> 0), z as (select row_id, y, {_Z} from filled, sc)"


@query("median_impute", f"with {FILLED} select * from filled where row_id % 5 = 0")
def median_impute(spark, sf):
    train, test = sensor_split(spark, sf)
    return prep.median_impute(test, prep.fit_medians(train, FEATURES), FEATURES)


@query("standard_scale", f"""with {SENSOR}, sc as (select {_SC} from sensor),
z as (select row_id, y, {_Z} from sensor, sc) select * from z""")
def standard_scale(spark, sf):
    rows = sensor_table(spark, sf)
    out = prep.standard_scale(rows, prep.fit_scale(rows, FEATURES))
    return out.select("row_id", "y", *[r6(c) for c in FEATURES])


@query("prep_chain", f"with {SCALED} select * from z where row_id % 5 = 0")
def prep_chain(spark, sf):
    train, test = sensor_split(spark, sf)
    model = prep.Prepare(inputCols=FEATURES).fit(train)
    return model.values(test).select("row_id", "y", *[r6(c) for c in FEATURES])


@query("pos_weight", f"""with {SENSOR}, r as (select (count(*)-sum(y))::double/sum(y) ratio from sensor)
select round(ratio, 6) ratio, '10,30,' || cast(cast(round(ratio) as int) as varchar) || ',77' candidates from r""")
def pos_weight(spark, sf):
    out = prep.pos_weight(sensor(spark, sf))
    return out.select(r6("ratio"), F.concat_ws(",", F.col("candidates").cast("array<string>")).alias("candidates"))


@query("balanced_class_weight", f"""with {SENSOR}, c as (select y, count(*) n from sensor group by y)
select s.row_id, s.y, round({ALL}/(2.0::double*c.n), 6) weight from sensor s join c on s.y = c.y""")
def balanced_class_weight(spark, sf):
    return prep.balanced_class_weight(sensor(spark, sf)).select("row_id", "y", r6("weight"))


FOLDED = f"""{SENSOR}, folded as (select *, cast((row_number() over (partition by y order by {hash_sql(seed=42)}, row_id) - 1) % 5 as int) fold
from sensor)"""


@query("stratified_folds", f"with {FOLDED} select row_id, y, fold from folded")
def stratified_folds(spark, sf):
    return folds.stratified_folds(sensor(spark, sf)).select("row_id", "y", "fold")


@query("fold_train_val", f"""with {FOLDED} select row_id, y, 'val' part from folded where fold = 2
union all select row_id, y, 'train' from folded where fold <> 2""")
def fold_train_val(spark, sf):
    train, val = folds.fold_train_val(folds.stratified_folds(sensor(spark, sf)), 2)
    both = val.withColumn("part", F.lit("val")).unionByName(train.withColumn("part", F.lit("train")))
    return both.select("row_id", "y", "part")


@query("stratified_sample", f"""with {SENSOR}, n as (select sum(y) p, count(*) n from sensor),
q as (select least(p, greatest(1, cast(floor(5000*p/n) as bigint))) qp from n),
r as (select *, row_number() over (partition by y order by {hash_sql(seed=42)}, row_id) rn from sensor)
select row_id, y from r, q where rn <= case when y = 1 then qp else 5000 - qp end""")
def stratified_sample(spark, sf):
    return folds.stratified_sample(sensor(spark, sf)).select("row_id", "y")


@query("simple_sample", f"""with {SENSOR} select row_id, y from sensor order by {hash_sql(seed=42)}, row_id limit 5000""")
def simple_sample(spark, sf):
    return folds.simple_sample(sensor(spark, sf)).select("row_id", "y")


@query("run_summary", f"""with {TRAIN}, m as (select {', '.join(f'avg(({f} is null)::int) m_{f}' for f in FEATURES)} from train)
select (select cast(count(*) as bigint) from train) train_rows, (select cast(count(*) as bigint) from test) test_rows, 7 as "columns",
(select cast(sum(y) as bigint) from train) n_pos, (select cast(sum(1-y) as bigint) from train) n_neg,
(select round(avg(y)*100, 2) from train) pos_pct,
(select round(sum(1-y)::double/sum(y), 1) from train) scale_pos_weight,
round(({' + '.join(f'm_{f}' for f in FEATURES)})/6*100, 2) mean_missing_pct,
{' + '.join(f'(m_{f} > 0.5)::int' for f in FEATURES)} features_with_missing_gt50pct from m""")
def run_summary(spark, sf):
    return report.run_summary(*sensor_split(spark, sf), FEATURES)


_TRAIN_VIF = VIF.replace("imp as (select ", "train as (select * from sensor where row_id % 5 <> 0), imp as (select ", 1).replace(
    "from sensor)", "from train)"
)


@query("run_summary_json", f"""with recursive {_TRAIN_VIF}, {SCORED_LONG},
pred as (select model, y, case when proba >= 0.5 then 1 else 0 end pred from scored_long), c2 as ({confusion_sql('pred', 'model')}),
r2 as (select *, {RATES} from c2)
select (select count(*) from train) train_rows, (select sum(y)::bigint from train) n_pos,
(select cast(count(*) as bigint) from vifs where vif > 5) features_high_vif, model, round(f1_macro, 6) f1_macro, round(mcc, 6) + 0.0 mcc from r2""")
def run_summary_json(spark, sf):
    """The whole summary written as JSON and read back, one row per model."""
    train, test = sensor_split(spark, sf)
    filled = prep.median_impute(train, prep.fit_medians(train, FEATURES), FEATURES)
    scores = scored_long(spark, sf)
    judged = metrics.classification_metrics(metrics.apply_threshold(scores, 0.5), ["model"])
    models = judged.join(curves.average_precision(scores, ["model"]), "model")
    out = report.full_summary(report.run_summary(train, test, FEATURES), correlation.vif(filled, FEATURES), models)
    path = scratch_path(spark, "summary")
    tables.export_json(out, path)
    back = spark.read.schema(out.schema).json(path).withColumn("m", F.explode("model_metrics"))
    return back.select("train_rows", "n_pos", "features_high_vif", "m.model", r6("m.f1_macro", "f1_macro"), r6("m.mcc", "mcc"))
