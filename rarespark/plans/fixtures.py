"""Stand-ins for sensor data, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rarespark.functions.hashing import spread
from rarespark.session import cut_lineage

FEATURES = ["f_total", "f_qty", "f_price", "f_disc", "f_tax", "f_lines"]
FOLDS = 5
N_TREES = 10


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def sensor(spark: SparkSession, sf: str) -> DataFrame:
    """Wide numeric rows with a rare label and natural gaps."""
    lines = (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("f_qty"),
            F.max("l_extendedprice").alias("f_price"),
            F.max("l_discount").alias("f_disc"),
            F.min(F.when(F.col("l_tax") > 0, F.col("l_tax"))).alias("f_tax"),
            F.count("*").cast("double").alias("f_lines"),
        )
    )
    urgent = (
        (F.col("o_orderpriority") == "1-URGENT")
        & (F.col("o_orderstatus") == "F")
        & (F.col("o_totalprice") > 300000)
    )
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.when(urgent, 1).otherwise(0).alias("y"),
        F.col("o_totalprice").alias("f_total"),
    )
    joined = orders.join(lines, orders.row_id == lines.l_orderkey, "left")
    return joined.select("row_id", "y", *FEATURES)


def sensor_table(spark: SparkSession, sf: str) -> DataFrame:
    """``sensor`` written once, for queries that read it many times."""
    return cut_lineage(sensor(spark, sf), "sensor")


def is_test(row_id: Column = None) -> Column:
    return (F.col("row_id") if row_id is None else row_id) % 5 == 0


def sensor_split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = sensor_table(spark, sf)
    return rows.where(~is_test()), rows.where(is_test())


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Two score columns with a label: ``p_a`` in [0, 1], ``k`` an integer per cent."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("row_id"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("y"),
        F.round(F.col("value") / 500, 4).alias("p_a"),
        F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("k"),
    )


def scored_long(spark: SparkSession, sf: str) -> DataFrame:
    """``(row_id, model, y, proba, split, fold)`` for models A and B."""
    wide = scored(spark, sf).withColumn("p_b", F.col("k") / F.lit(100.0))
    long = wide.select(
        "row_id",
        "y",
        F.explode(
            F.array(
                F.struct(F.lit("A").alias("model"), F.col("p_a").alias("proba")),
                F.struct(F.lit("B").alias("model"), F.col("p_b").alias("proba")),
            )
        ).alias("_s"),
    ).select("row_id", "_s.model", "y", "_s.proba")
    return long.withColumn("split", F.when(is_test(), "test").otherwise("train")).withColumn(
        "fold", F.floor(spread(F.col("row_id"), 3) / 65536).cast("int") % FOLDS
    )


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("row_id"),
        F.col("embedding").cast("array<double>").alias("x"),
        F.when(F.col("label") == 0, 1).otherwise(0).alias("y"),
    )


def leaf_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Leaf id per tree for every order, by arithmetic: ``(row_id, leaves)``."""
    leaf = [(F.col("row_id") * (2 * t + 3)) % 97 % 7 for t in range(N_TREES)]
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"), F.array(*[x.cast("int") for x in leaf]).alias("leaves")
    )


def phi(spark: SparkSession, sf: str) -> DataFrame:
    """Attribution stand-in: feature minus its mean, long, with a fold and the value."""
    rows = sensor(spark, sf).withColumn("fold", (F.col("row_id") % FOLDS).cast("int"))
    means = rows.agg(*[F.avg(c).alias(c) for c in FEATURES]).first()
    centred = rows.select(
        "row_id",
        "y",
        "fold",
        *[F.struct((F.col(c) - means[c]).alias("phi"), F.col(c).alias("value")).alias(c) for c in FEATURES],
    )
    long = centred.unpivot(["row_id", "y", "fold"], FEATURES, "feature", "cell")
    return long.select("row_id", "y", "fold", "feature", "cell.phi", "cell.value").where("phi is not null")


def trial_log(spark: SparkSession, sf: str) -> DataFrame:
    """Trial log stand-in: one trial per customer, two studies of 50 trials per experiment."""
    key = F.col("c_custkey")
    return (
        table(spark, sf, "customer")
        .select(
            F.floor(key / 100).alias("experiment"),
            F.when(F.floor(key / 50) % 2 == 0, "weighted").otherwise("focal").alias("study"),
            (key % 50).cast("int").alias("trial"),
            ((spread(F.col("c_custkey"), 5) % 1000) / F.lit(1000.0)).alias("value"),
            (F.lit(3) + spread(F.col("c_custkey"), 6) % 8).cast("int").alias("max_depth"),
            (F.lit(0.01) + (spread(F.col("c_custkey"), 7) % 290) / F.lit(1000.0)).alias("learning_rate"),
        )
    )
