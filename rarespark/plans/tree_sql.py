"""SQL twins of greedy trees, grown level by level with every value a bin."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from rarespark.plans.registry import SENSOR

#: Features with few values, so that each value is a bin.
FEW_VALUES = ["f_lines", "f_disc", "f_tax"]


def filled_sql(a: str, b: str, features: Sequence[str] = tuple(FEW_VALUES)) -> str:
    """``filled``: ids, the label, features with their gaps filled, and the two columns summed."""
    fills = ", ".join(f"coalesce({f}, (select median({f}) from sensor)) {f}" for f in features)
    return f"""{SENSOR}, labelled as (select *, case when f_qty > 150 or f_disc > 0.09::double then 1 else 0 end hit from sensor),
filled as (select row_id, hit y, {fills}, {a} a, {b} b from labelled)"""


def grow_sql(
    levels: int, score: Callable[[str, str], str], allowed: str, scale: float, features: Sequence[str] = tuple(FEW_VALUES)
) -> str:
    """Tables ``g0`` to ``g<levels>``: the rows of ``filled`` with their ``node``, the root 1 and the
    children of i 2i and 2i + 1; ``s0`` on: the ``best`` split of each node that gains by one.

    ``score`` rates the sums ``a`` and ``b`` of one side. ``allowed`` speaks of the left sums
    ``la`` and ``lb`` and the right ones ``ra`` and ``rb``.
    """
    parts = ["g0 as (select *, 1 as node from filled)"]
    picked = "case s.best.feature " + " ".join(f"when '{f}' then g.{f}" for f in features) + " end"
    for k in range(levels):
        cells = " union all ".join(
            f"select node, '{f}' feature, {i} pos, {f} v, a, b from g{k} where node >= {2**k}" for i, f in enumerate(features)
        )
        parts += [
            f"c{k} as (select node, feature, pos, v, sum(a) a, sum(b) b from ({cells}) group by 1, 2, 3, 4)",
            f"""u{k} as (select node, feature, pos, v, sum(a) over w - a la, sum(b) over w - b lb, sum(a) over p ta, sum(b) over p tb
from c{k} window w as (partition by node, feature order by v), p as (partition by node, feature))""",
            f"w{k} as (select *, ta - la ra, tb - lb rb from u{k} where la + lb > 0)",
            f"""k{k} as (select *, round({scale}::double * ({score('la', 'lb')} + {score('ra', 'rb')} - {score('ta', 'tb')}), 9) gain
from w{k} where {allowed})""",
            f"""s{k} as (select node, arg_min(struct_pack(feature := feature, v := v), (-gain, pos, v)) best
from k{k} where gain > 1e-6 group by node)""",
            f"""g{k + 1} as (select g.* replace (case when s.node is null then g.node
else 2 * g.node + ({picked} >= s.best.v)::int end as node) from g{k} g left join s{k} s on g.node = s.node)""",
        ]
    return ",\n".join(parts)


def gini_sql(a: str, b: str) -> str:
    """Weighted sum of squared class shares of one side, the classes balanced."""
    x, y = f"({a}*(select w0 from cw))", f"({b}*(select w1 from cw))"
    return f"(({x}*{x} + {y}*{y})/({x} + {y}))"


def one_tree_sql(levels: int, min_leaf: int = 5) -> str:
    """``leaf``: node, class counts and probability of one balanced Gini tree of all rows."""
    grown = grow_sql(levels, gini_sql, f"la + lb >= {min_leaf} and ra + rb >= {min_leaf}", 1.0)
    return f"""{filled_sql('(1 - hit)::double', 'hit::double')},
cw as (select count(*)/(2*sum(a)) w0, count(*)/(2*sum(b)) w1 from filled), {grown},
leaf as (select node, sum(a) zeros, sum(b) ones, sum(b)*any_value(w1)/(sum(a)*any_value(w0) + sum(b)*any_value(w1)) proba
from g{levels}, cw group by node)"""


def _expectation(side: str, features: Sequence[str]) -> str:
    """One question of a path: its answer if the feature is in the subset, else its cover share."""
    known = " ".join(f"when '{f}' then (s.mask & {1 << i}) <> 0" for i, f in enumerate(features))
    value = " ".join(f"when '{f}' then r.{f}" for f in features)
    return f"""case when f{side} is null then 1.0::double when case f{side} {known} end
then ((case f{side} {value} end >= v{side})::int = d{side})::int::double else share{side} end"""


def shap_sql(eta: float = 0.3, reg_lambda: float = 1.0, features: Sequence[str] = tuple(FEW_VALUES)) -> str:
    """``phi``: Shapley values of each row on one tree of two levels, by their definition over all
    subsets of three features. ``base`` has the cover-weighted mean."""
    grown = grow_sql(2, lambda a, b: f"{a}*{a}/({b}+{reg_lambda})", "lb >= 20 and rb >= 20", 0.5, features)
    gains = " union all ".join(
        f"""select row_id, y, '{f}' feature, {f} as value, sum(case when (mask & {1 << i}) = 0 then -e else e end *
case bit_count((mask & {7 - (1 << i)})::int) when 1 then 1.0::double/6 else 1.0::double/3 end) phi from known group by all"""
        for i, f in enumerate(features)
    )
    return f"""{filled_sql('0.5::double - hit', '0.25::double', features)}, {grown},
leaf as (select node, sum(a) g, sum(b) h from g2 group by node),
cover as (select n, sum(h) h from leaf, (select unnest([1, 2, 3]) n) where node = n or node // 2 = n or node // 4 = n group by n),
path as (select l.node, {-eta}::double * g / (l.h + {reg_lambda}) val,
 case when l.node > 1 then r.best.feature end f1, r.best.v v1, case when l.node > 3 then (l.node // 2) % 2 else l.node % 2 end d1,
 case when l.node > 3 then c.h else l.h end / t.h share1,
 q.best.feature f2, q.best.v v2, l.node % 2 d2, l.h / c.h share2
 from leaf l join cover t on t.n = 1 left join s0 r on true left join s1 q on l.node > 3 and q.node = l.node // 2
 left join cover c on l.node > 3 and c.n = l.node // 2),
known as (select r.row_id, r.y, {', '.join('r.' + f for f in features)}, s.mask, sum(val * {_expectation('1', features)} * {_expectation('2', features)}) e
 from filled r, (select unnest(range(0, 8)) mask) s, path group by all),
phi as (select * replace (round(phi, 9) + 0.0 as phi) from ({gains})), base as (select distinct e from known where mask = 0)"""
