"""Registration of queries and their SQL twins."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def r6(c: str | Column, name: str | None = None) -> Column:
    """Round to 6 digits and turn -0.0 into 0.0."""
    col = F.col(c) if isinstance(c, str) else c
    return (F.round(col, 6) + F.lit(0.0)).alias(name or c)


def r6_all(names: list[str]) -> list[Column]:
    return [r6(n) for n in names]


# --- SQL fragments of the derived tables -------------------------------------------

SENSOR = """sensor as (
select o.o_orderkey row_id,
       case when o.o_orderpriority='1-URGENT' and o.o_orderstatus='F' and o.o_totalprice>300000
            then 1 else 0 end y,
       o.o_totalprice f_total, l.f_qty, l.f_price, l.f_disc, l.f_tax, l.f_lines
from orders o left join (
  select l_orderkey,
         cast(sum(cast(l_quantity as decimal(18,2))) as double) f_qty,
         max(l_extendedprice) f_price, max(l_discount) f_disc,
         min(case when l_tax>0 then l_tax end) f_tax,
         cast(count(*) as double) f_lines
  from lineitem group by l_orderkey) l on o.o_orderkey=l.l_orderkey)"""

TRAIN = SENSOR + """, train as (select * from sensor where row_id % 5 <> 0),
test as (select * from sensor where row_id % 5 = 0)"""

_LONG = " union all ".join(
    f"select row_id, y, '{f}' feature, {f} as value from {{src}} where {f} is not null"
    for f in ("f_total", "f_qty", "f_price", "f_disc", "f_tax", "f_lines")
)


def long_sql(src: str = "sensor", name: str = "lng") -> str:
    return f"{name} as ({_LONG.format(src=src)})"


def hash_sql(id_col: str = "row_id", seed: int = 0) -> str:
    from rarespark.functions.hashing import seed_shift

    return f"(({id_col} % 2147483648) * 2654435761 + {seed_shift(seed)}) % 4294967296"


SCORED = """scored as (
select event_id row_id, case when event_type='purchase' then 1 else 0 end y,
       round(value/500,4) p_a, cast(regexp_extract(props,'[0-9]+',0) as int) k from events)"""

SCORED_LONG = SCORED + f""", sl as (
select row_id, 'A' model, y, p_a proba from scored
union all select row_id, 'B' model, y, k/cast(100 as double) proba from scored),
scored_long as (select row_id, model, y, proba,
  case when row_id % 5 = 0 then 'test' else 'train' end split,
  cast(floor(({hash_sql('row_id', 3)}) / 65536) as bigint) % 5 as fold from sl)"""

VECTORS = """vectors as (
select vec_id row_id, embedding, case when label=0 then 1 else 0 end y from embeddings)"""

RATES = """case when tp+fp=0 then 0.0::double else tp::double/(tp+fp) end as "precision",
case when tp+fn=0 then 0.0::double else tp::double/(tp+fn) end as recall,
case when 2*tp+fp+fn=0 then 0.0::double else 2*tp::double/(2*tp+fp+fn) end as f1_binary,
(case when 2*tp+fp+fn=0 then 0.0::double else 2*tp::double/(2*tp+fp+fn) end
 + case when 2*tn+fp+fn=0 then 0.0::double else 2*tn::double/(2*tn+fp+fn) end)
 / greatest((case when tp+fp+fn>0 then 1 else 0 end + case when tn+fp+fn>0 then 1 else 0 end), 1) as f1_macro,
case when (tp+fp)=0 or (tp+fn)=0 or (tn+fp)=0 or (tn+fn)=0 then 0.0::double
 else (tp::double*tn - fp::double*fn)
  / (sqrt(tp+fp)*sqrt(tp+fn)*sqrt(tn+fp)*sqrt(tn+fn)) end as mcc,
cast(10*fp+500*fn as bigint) as cost"""


def confusion_sql(src: str, by: str = "", pred: str = "pred") -> str:
    keys = f"{by}, " if by else ""
    group = f" group by {by}" if by else ""
    return f"""select {keys}cast(count(case when y=1 and {pred}=1 then 1 end) as bigint) tp,
cast(count(case when y=0 and {pred}=1 then 1 end) as bigint) fp,
cast(count(case when y=1 and {pred}=0 then 1 end) as bigint) fn,
cast(count(case when y=0 and {pred}=0 then 1 end) as bigint) tn from {src}{group}"""


def grid_sql(grid: list[float], name: str = "grid") -> str:
    values = ", ".join(f"({t!r}::double)" for t in grid)
    return f"{name}(threshold) as (values {values})"


def sweep_sql(matrix: str, out: str, size: int) -> str:
    """Recursive tables that invert a symmetric matrix, a list of size x size numbers, by
    sweeping every column: ``out`` has one row with the list ``inv``."""
    n = size
    cell = (
        f"case when i = k + 1 and j = k + 1 then -1 / p when i = k + 1 or j = k + 1 then a[t] / p "
        f"else a[t] - a[(i - 1) * {n} + k + 1] * a[k * {n} + j] / p end"
    )
    for name, value in (("i", f"((t - 1) // {n} + 1)"), ("j", f"((t - 1) % {n} + 1)"), ("p", f"a[k * {n} + k + 1]")):
        cell = re.sub(rf"\b{name}\b", value, cell)
    return f"""{out}_s as (select 0 as k, m as a from {matrix} union all
select k + 1, list_transform(range(1, {n * n + 1}), lambda t: {cell}) from {out}_s where k < {n}),
{out} as (select list_transform(a, lambda x: -x) as inv from {out}_s where k = {n})"""
