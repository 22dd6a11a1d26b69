"""All registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rarespark.plans import (  # noqa: F401
    calibration_queries,
    ingest_queries,
    metric_queries,
    model_queries,
    profile_queries,
)
from rarespark.operators import metrics, training
from rarespark.plans.fixtures import FEATURES, sensor_split
from rarespark.plans.registry import ORACLES, QUERIES  # noqa: F401


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Which decision threshold costs least, and what does it cost on unseen rows?

    Raw tables to sensors; medians, scales, class weights and an elastic net from the
    train rows; the threshold from the train scores; cost and rates from the test rows.
    """
    train, test = sensor_split(spark, sf)
    model = training.fit_elastic_net(train, FEATURES, c=0.1, l1_ratio=0.5, max_iter=200)
    scores = {n: training.score_models({"Elastic Net": model}, d) for n, d in (("train", train), ("test", test))}
    return metrics.tune_then_evaluate(scores["train"], scores["test"], "cost")
