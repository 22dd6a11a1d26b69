"""Sources, sinks and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rarespark.operators import quality
from rarespark.plans.fixtures import FEATURES, is_test, scored, sensor, sensor_split
from rarespark.plans.registry import SCORED, SENSOR, TRAIN, query, r6
from rarespark.session import scratch_path
from rarespark.sources import preamble_csv, tables

PREAMBLE = [f"This file is free text, line {i}, with commas, and more" for i in range(20)]
COLUMNS = ["row_id", *FEATURES]


def raw_csv(spark, rows, name="raw", short=None):
    """Write rows as preamble files with label texts, and return the folder. ``short``
    tells how many fields are left out at a line's end."""
    path = scratch_path(spark, name)
    text = rows.select(F.when(F.col("y") == 1, "pos").otherwise("neg").alias("class"), *COLUMNS)
    if short is not None:
        text = text.withColumn("_short", short)
    tables.write_preamble_csv(text, path, PREAMBLE, short="_short" if short is not None else None)
    return path


SENSOR_CSV = f"with {SENSOR} select y as class, cast(row_id as double) row_id, f_total, f_qty, f_price, f_disc, f_tax, f_lines from sensor"


FEATURE_NAMES = "f_total, f_qty, f_price, f_disc, f_tax, f_lines"


@query("preamble_csv_read", f"""with {SENSOR} select case when y=1 then 'pos' else 'neg' end as class,
cast(row_id as varchar) row_id, cast(f_qty is null as boolean) qty_missing,
cast(f_tax is null as boolean) tax_missing, {FEATURE_NAMES} from sensor""")
def preamble_csv_read(spark, sf):
    rows, _ = preamble_csv.read_preamble_csv(spark, raw_csv(spark, sensor(spark, sf)))
    return rows.select(
        "class",
        "row_id",
        (F.col("f_qty") == "na").alias("qty_missing"),
        (F.col("f_tax") == "na").alias("tax_missing"),
        *[F.col(c).try_cast("double").alias(c) for c in FEATURES],
    )


# Missing-value texts for the clean-up queries, chosen by row id.
TEXTS = """(case row_id % 7 when 0 then 'na' when 1 then 'NaN' when 2 then '' when 3 then 'null'
when 4 then 'bad' else cast(k as varchar) end)"""


def _texts(spark, sf):
    return scored(spark, sf).select("row_id", F.expr(TEXTS.replace("varchar", "string")).alias("cell"))


@query("na_to_null", f"""with {SCORED} select row_id,
case when row_id % 7 in (0,1,2,3) then null else {TEXTS} end as cell from scored""")
def na_to_null(spark, sf):
    return preamble_csv.na_to_null(_texts(spark, sf), ["cell"])


@query("numeric_coerce", f"""with {SCORED} select row_id,
case when row_id % 7 <= 4 then null else cast(k as double) end as cell from scored""")
def numeric_coerce(spark, sf):
    return preamble_csv.numeric_coerce(_texts(spark, sf), ["cell"])


@query("label_encode", """select o_orderkey row_id, o_orderstatus as "class",
case o_orderstatus when 'F' then 1 when 'O' then 0 end as y from orders""")
def label_encode(spark, sf):
    rows = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_orderkey").alias("row_id"), F.col("o_orderstatus").alias("class")
    )
    return preamble_csv.label_encode(rows, labels={"F": 1, "O": 0}, check=False)


@query("unknown_labels", """select o_orderstatus as "class", cast(count(*) as bigint) as "rows" from orders
where o_orderstatus not in ('F','O') group by o_orderstatus""")
def unknown_labels(spark, sf):
    rows = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderstatus").alias("class"))
    return preamble_csv.unknown_labels(rows, labels={"F": 1, "O": 0})


@query("load_split_pair", f"""with {SENSOR} select y as class, cast(row_id as double) row_id,
f_total, f_qty, f_price, f_disc, case when row_id % 7 > 0 then f_tax end f_tax,
case when row_id % 7 > 1 then f_lines end f_lines,
case when row_id % 5 = 0 then 'test' else 'train' end as split from sensor""")
def load_split_pair(spark, sf):
    """Some lines are short: their last fields are not there and become gaps."""
    short = F.when(F.col("row_id") % 7 > 1, 0).otherwise(2 - F.col("row_id") % 7).cast("int")
    train, test = sensor_split(spark, sf)
    return preamble_csv.load_split_pair(
        spark, raw_csv(spark, train, "train", short), raw_csv(spark, test, "test", short)
    )


@query("split_features_target", f"""with {SENSOR} select row_id, f_total, f_qty, f_price, f_disc, f_tax, f_lines,
y as label from sensor""")
def split_features_target(spark, sf):
    x, y = preamble_csv.split_features_target(sensor(spark, sf), "y", ["row_id"])
    return x.join(y.withColumnRenamed("y", "label"), "row_id")


@query("encoded_export", f"""with {SENSOR} select *, case when row_id % 5 = 0 then 'test' else 'train' end
as split from sensor""")
def encoded_export(spark, sf):
    rows = sensor(spark, sf).withColumn("split", F.when(is_test(), "test").otherwise("train"))
    path = scratch_path(spark, "encoded")
    tables.export_encoded(rows, path, "csv")
    return spark.read.schema(rows.schema).option("header", True).csv(path)


@query("result_table_export", f"""with {SENSOR}, c as (select y, count(*) n, sum(case when f_tax is null then 1 else 0 end) m
from sensor group by y) select y, cast(n as bigint) as "rows", cast(m as bigint) missing,
round(m::double/n, 6) share from c""")
def result_table_export(spark, sf):
    report = (
        sensor(spark, sf)
        .groupBy("y")
        .agg(F.count("*").alias("rows"), F.count(F.when(F.col("f_tax").isNull(), 1)).alias("missing"))
        .withColumn("share", F.round(F.col("missing") / F.col("rows"), 6))
    )
    path = scratch_path(spark, "report")
    tables.export_csv(report, path)
    return tables.read_csv(spark, path, report.schema)


@query("schema_rules", f"""with {SENSOR} select * from (values ('target_present', true, 'y'),
('same_width', true, 'train=8 test=8'), ('expected_width', true, 'width=8 expected=8')) v(rule, ok, detail)
union all select 'rows_filled', count(case when coalesce(f_total, f_qty, f_price, f_disc, f_tax, f_lines) is null then 1 end) = 0,
'blank=' || cast(count(case when coalesce(f_total, f_qty, f_price, f_disc, f_tax, f_lines) is null then 1 end) as varchar)
|| ' of ' || cast(count(*) as varchar) from sensor""")
def schema_rules(spark, sf):
    rows = sensor(spark, sf)
    train, test = rows.where(~is_test()), rows.where(is_test())
    return quality.schema_rules(train, test, "y", width=8)


@query("label_domain_rule", f"""with {SENSOR} select 'label_domain' as rule,
min(y)=0 and max(y)=1 and count(distinct y)=2 as ok,
'other=' || cast(count(case when y not in (0,1) then 1 end) as varchar) as detail from sensor""")
def label_domain_rule(spark, sf):
    return quality.label_domain_rule(sensor(spark, sf))


@query("imbalance_rule", f"""with {SENSOR} select 'imbalance' as rule, avg(y) < 0.05 as ok,
round(avg(y), 6) positive_rate, round((count(*)-sum(y))::double/sum(y), 6) neg_per_pos from sensor""")
def imbalance_rule(spark, sf):
    return quality.imbalance_rule(sensor(spark, sf)).select(
        "rule", "ok", r6("positive_rate"), r6("neg_per_pos")
    )


@query("load_summary", f"""with {SENSOR} select case when row_id % 5 = 0 then 'test' else 'train' end as split,
cast(count(*) as bigint) as "rows", cast(sum(y) as bigint) positives, round(avg(y), 6) positive_rate,
cast(sum((f_total is null)::int + (f_qty is null)::int + (f_price is null)::int + (f_disc is null)::int
 + (f_tax is null)::int + (f_lines is null)::int) as bigint) missing_cells from sensor group by 1""")
def load_summary(spark, sf):
    rows = sensor(spark, sf).withColumn("split", F.when(is_test(), "test").otherwise("train"))
    return quality.load_summary(rows, FEATURES).withColumn("positive_rate", r6("positive_rate"))


@query("split_leak_check", f"""with {TRAIN}, s as (select (select count(*) from train) a, (select count(*) from test) b,
(select count(y) from train) + (select count(y) from test) l, (select avg(y) from test) r)
select 'labels_complete' as rule, l = a+b as ok, cast(l as varchar) as detail from s
union all select 'train_larger', a > b, cast(a as varchar) || ' vs ' || cast(b as varchar) from s
union all select 'test_not_resampled', r < 0.1, cast(round(r, 6) as varchar) from s""")
def split_leak_check(spark, sf):
    return quality.split_leak_check(*sensor_split(spark, sf))


@query("row_overlap", """with d as (select l_orderkey % 2 side, l_quantity q, l_discount d, l_tax t,
l_orderkey*100000 + l_partkey row_id from lineitem)
select a.row_id from d a where a.side = 1 and exists (select 1 from d b where b.side = 0
and b.q is not distinct from a.q and b.d is not distinct from a.d and b.t is not distinct from a.t)""")
def row_overlap(spark, sf):
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        (F.col("l_orderkey") % 2).alias("side"),
        F.col("l_quantity").alias("q"),
        F.col("l_discount").alias("d"),
        F.col("l_tax").alias("t"),
        (F.col("l_orderkey") * 100000 + F.col("l_partkey")).alias("row_id"),
    )
    return quality.row_overlap(rows.where("side = 0"), rows.where("side = 1"), ["q", "d", "t"])
