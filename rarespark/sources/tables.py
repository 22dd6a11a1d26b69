"""Result tables and fitted models on disk."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def export_encoded(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Encoded split, one folder per split where there is a ``split`` column."""
    writer = df.write.mode("overwrite")
    if "split" in df.columns:
        writer = writer.partitionBy("split")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_preamble_csv(
    df: DataFrame, path: str, preamble: list[str], na: str = "na", short: str | None = None
) -> None:
    """Write text files that each start with ``preamble`` and a header line. The column
    ``short`` tells how many of a row's last fields are left out."""
    names = [c for c in df.columns if c != short]
    header = ",".join(names)
    cells = F.array(*[F.coalesce(F.col(c).cast("string"), F.lit(na)) for c in names])
    if short is not None:
        cells = F.slice(cells, 1, F.lit(len(names)) - F.col(short))
    lines = df.select(F.array_join(cells, ",").alias("value"))

    def with_head(batches):
        import pandas as pd

        yield pd.DataFrame({"value": [*preamble, header]})
        yield from batches

    lines.mapInPandas(with_head, "value string").write.mode("overwrite").text(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
