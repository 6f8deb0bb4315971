"""Small Spark helpers that the operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cartorio.session import checkpoint_folder, ship


#: Rows and bytes in an Arrow batch at most (a longer single row still comes whole): Python holds a batch at a time.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def lean(df: DataFrame) -> DataFrame:
    """df, whose session from now on hands texts to Python in small batches (smaller bounds that are set already stay) and whose
    executors have this package."""
    ship(df.sparkSession)
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = conf.get(key)
        if not now.lstrip("-").isdigit() or not 0 < int(now) <= most:
            conf.set(key, str(most))
    return df


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return lean(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def reliable(df: DataFrame) -> DataFrame:
    """df cut from its lineage by checkpoint() in the shared folder, so that a lost executor costs a reread only."""
    spark = df.sparkSession
    if spark._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(f"{checkpoint_folder(spark)}/{uuid.uuid4().hex}")
    return df.checkpoint()


def parts(spark: SparkSession) -> int:
    """The number of shuffle partitions that the launcher sized for its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
