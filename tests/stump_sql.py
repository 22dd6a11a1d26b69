"""SQL twin of a trial search at one round of depth 1, where SQL can follow."""

from __future__ import annotations

from rarespark.operators import search
from rarespark.plans.model_queries import STUMP
from rarespark.plans.registry import RATES, SENSOR

STUMP_SPACE = {**search.SPACE, "max_depth": (1, 1), "n_estimators": (1, 1), "subsample": (1.0, 1.0), "colsample_bytree": (1.0, 1.0)}


def _setting_sql(name: str, lo, hi) -> str:
    u = f"(('0x' || substr(sha256('42|' || study || '|' || trial || '|{name}'), 1, 13))::bigint / 4503599627370496.0::double)"
    if isinstance(lo, int):
        return f"cast({lo} + floor({u} * {hi - lo + 1}) as int) \"{name}\""
    if name in ("learning_rate", "lambda", "alpha"):
        return f"{lo}::double * pow({hi / lo!r}::double, {u}) \"{name}\""
    return f"{lo}::double + {u} * {hi - lo!r}::double \"{name}\""


def _stump_cells(f: str, place: int) -> str:
    """Rows per fold left out, value and label; gaps have the bin of the others' median."""
    return f"""select o, '{f}' feature, {place} pos, coalesce(s.{f}, (select max(z.{f}) from sensor z where z.{f} <= m.m)) v,
s.row_id % 5 = o as held, case when f_qty > 150 then 1 else 0 end y from sensor s
cross join (select o, median(case when row_id % 5 <> o then {f} end) m from sensor, range(0, 5) r(o) group by o) m"""


STUMP_SQL = f"""with t as (select study, trial from (values ('weighted'), ('focal')) v(study), range(0, {search.TRIALS}) r(trial)), {SENSOR},
c as (select [10, 30, cast(round((count(*) - sum(y))::double / sum(y)) as int), 77] as w
 from (select case when f_qty > 150 then 1 else 0 end y from sensor)),
p as (select study, cast(trial as int) trial, {', '.join(_setting_sql(k, lo, hi) for k, (lo, hi) in STUMP_SPACE.items())},
case when study = 'weighted' then w[cast(floor(('0x' || substr(sha256('42|' || study || '|' || trial || '|scale_pos_weight'), 1, 13))::bigint
 / 4503599627370496.0::double * 4) as int) + 1]::double else 1.0::double end scale_pos_weight from t, c),
x as ({' union all '.join(_stump_cells(f, i) for i, f in enumerate(STUMP))}),
n as (select o, feature, pos, v, count(*) filter (not held and y = 0) n0, count(*) filter (not held and y = 1) n1,
 count(*) filter (held and y = 0) h0, count(*) filter (held and y = 1) h1 from x group by 1, 2, 3, 4),
k as (select study, trial, "lambda" lam, alpha, n.*,
 n0 * case when study = 'focal' then 0.75*0.25*0.5::double else 0.5::double end
 - n1 * case when study = 'focal' then 0.25*0.25*0.5::double else scale_pos_weight*0.5 end g,
 n0 * case when study = 'focal' then 0.75*0.25*0.25::double else 0.25::double end
 + n1 * case when study = 'focal' then 0.25*0.25*0.25::double else scale_pos_weight*0.25 end h from n, p),
w as (select *, sum(g) over u gl, sum(h) over u hl, sum(g) over f gt, sum(h) over f ht from k
 window u as (partition by study, trial, o, feature order by v), f as (partition by study, trial, o, feature)),
q as (select *, round(0.5::double*(pow(greatest(abs(gl) - alpha, 0), 2)/(hl + lam) + pow(greatest(abs(gt - gl) - alpha, 0), 2)/(ht - hl + lam)
 - pow(greatest(abs(gt) - alpha, 0), 2)/(ht + lam)), 9) gain from w where hl >= 1 and ht - hl >= 1),
s as (select study, trial, o, arg_min(struct_pack(feature := feature, v := v, l := (gl <= alpha)::int, r := (gt - gl <= alpha)::int),
 (-gain, pos, v)) best from q where gain > 1e-6 group by 1, 2, 3),
j as (select s.study, s.trial, s.o, case when n.v <= best.v then best.l else best.r end hit, h0, h1 from s join n on n.o = s.o and n.feature = best.feature),
cf as (select study, trial, o, sum(h1) filter (hit = 1) tp, sum(h0) filter (hit = 1) fp, sum(h1) filter (hit = 0) fn, sum(h0) filter (hit = 0) tn
 from j group by 1, 2, 3),
r as (select study, trial, o, {RATES} from (select study, trial, o, coalesce(tp, 0) tp, coalesce(fp, 0) fp, coalesce(fn, 0) fn, coalesce(tn, 0) tn from cf))
select p.study, p.trial, max_depth, n_estimators, {', '.join(f'round(p."{k}", 6) "{k}"' for k, (lo, _) in STUMP_SPACE.items() if not isinstance(lo, int))},
scale_pos_weight, round(coalesce((select sum(mcc) from r where r.study = p.study and r.trial = p.trial), 0) / 5, 6) + 0.0 as value from p"""
