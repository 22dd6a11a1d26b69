"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: str = "8", name: str = "rarespark") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, whose driver
    and tasks share one disk, may do without: a fresh local folder is made and recorded
    for the session. On a cluster such a folder would lose rows, so that is an error.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder is None:
        folder = spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if folder is None:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors of {master} share")
        folder = "file://" + tempfile.mkdtemp(prefix="rarespark-", dir="/tmp")
        spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


def bounded_batches(spark: SparkSession, most: int) -> None:
    """Arrow batches are cut at ``most`` bytes too, so large cells don't fill a worker's memory."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key, str(2**31 - 1))) > most:
        spark.conf.set(key, str(most))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the workers, once per application.

    Tasks import them by name, and a worker started elsewhere has no path to them.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="rarespark-code-")) / "rarespark.zip"
    with zipfile.ZipFile(path, "w") as out:
        for module in sorted(root.rglob("*.py")):
            out.write(module, module.relative_to(root.parent))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """New, unused path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df, name: str = "stage", by: str | None = None, codec: str | None = None, options: dict[str, str] | None = None):
    """Write a table to the shared folder and read it back.

    Survives the loss of executors, and keeps plans short in iterative fits. With ``by``
    the rows are spread evenly by that key first, for tables that are read many times.
    ``codec`` is the files' compression, for tables of texts; ``options`` go to the writer.
    ``drop_stage`` removes the files of a stage that nothing reads any more.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df if by is None else df.repartition(by)).write.options(**(options or {})).parquet(path, compression=codec)
    stage = spark.read.schema(df.schema).parquet(path)
    stage.stage_path = path
    return stage


def _file_system(stage):
    spark = stage.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(stage.stage_path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def stage_bytes(stage) -> int:
    """Size on disk of a table that ``cut_lineage`` wrote."""
    system, target = _file_system(stage)
    return system.getContentSummary(target).getLength()


def drop_stage(stage) -> None:
    """Delete a table that ``cut_lineage`` wrote, once its successor is written."""
    if getattr(stage, "stage_path", None) is not None:
        system, target = _file_system(stage)
        system.delete(target, True)
