"""A SparkSession with the settings that carry the engine's semantics."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: ANSI casts raise, so the engine uses try_* functions; partition values stay text ("01", not 1).
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "cartorio", master: str | None = None, shuffle_partitions: int | None = None,
            checkpoint_dir: str | None = None, **conf: str) -> SparkSession:
    """A session with SEMANTIC_CONF; master and sizes only where the launcher has not set them."""
    builder = SparkSession.builder.appName(app).config(map=SEMANTIC_CONF | {"spark.ui.enabled": "false"} | conf)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession, own: str | None = None) -> str:
    """The shared folder the cluster names; `own` (or a folder in the warehouse) only where none is set."""
    return (spark.conf.get("spark.checkpoint.dir", None) or own
            or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")


def materialised(df: DataFrame) -> DataFrame:
    """df cut from its lineage by checkpoint() in the shared folder: worked out once, and reread after a lost executor."""
    spark = df.sparkSession
    if spark._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(f"{checkpoint_folder(spark)}/{uuid.uuid4().hex}")
    return df.checkpoint()


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable on the executors, once for each application."""
    context = spark.sparkContext
    if getattr(context, "_cartorio_shipped", False):
        return spark
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp()  # the driver serves the archive from here as long as it runs
    atexit.register(shutil.rmtree, folder, True)
    context.addPyFile(shutil.make_archive(str(Path(folder) / package.name), "zip", package.parent, package.name))
    context._cartorio_shipped = True
    return spark
