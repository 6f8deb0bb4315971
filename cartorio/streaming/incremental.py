"""Incremental ingest: new files in bounded batches, changed units replaced, finished ones skipped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartorio import units
from cartorio.operators.joins import unprocessed
from cartorio.operators.sync import classify_unit
from cartorio.sinks import MOST_ROWS, replace_source_unit


def ingest_new(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, kind: str = "parquet", files: int = 4,
               transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Takes every file that has come since the last call, a few a batch, and appends its rows to target. A batch is
    written below its own number, so one that is run again after a loss replaces itself: each row lands once."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(kind).load(source)
    stream = transform(stream) if transform else stream
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def units_to_process(inventory: DataFrame, ledger: DataFrame) -> DataFrame:
    """Units of the inventory (unit, exists, etag, size_bytes) that are new or changed, by the ledger."""
    old = ledger.select("unit", F.lit(True).alias("_known"), F.col("etag").alias("_etag"), F.col("size_bytes").alias("_size"))
    status = classify_unit(F.coalesce("_known", F.lit(False)), F.col("exists"), F.col("_etag"), F.col("etag"), F.col("_size"), F.col("size_bytes"))
    return inventory.join(old, "unit", "left").withColumn("status", status).filter(F.col("status").isin("new", "updated")).drop("_known", "_etag", "_size")


def resume(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that a run that broke off has left."""
    return unprocessed(files, ledger)


def reprocess(read: Callable[[str], DataFrame], root: str, units: list[str], keys: list[str], salt: int = 1) -> None:
    """Replaces each changed unit as a whole; corrections may be years old, so no watermark applies."""
    for unit in units:
        replace_source_unit(read(unit), root, unit, keys, salt=salt)


def follow(spark: SparkSession, snapshots: str, schema: str, root: str, checkpoint: str, read: Callable[[str], DataFrame], keys: list[str], files: int = 100, salt: int = 1,
           kind: str = "json") -> None:
    """Follows inventory snapshots (unit, exists, etag, size_bytes, seen) as files that come, and replaces each unit that is new or
    changed, once.

    Of several sightings in a batch the last counts. What has been done is what the units' own pointers say, which change in the
    same step as the rows: after a run that was killed anywhere, units that were made current aren't written again, and the
    others are, whether or not the stream had noted the batch. A batch is `files` snapshots at most; its changed units are
    worked through one after the other, each as a job of its own.
    """
    def batch(found: DataFrame, _: int) -> None:
        w = Window.partitionBy("unit").orderBy(F.col("seen").desc(), F.col("etag").desc_nulls_last())
        last = found.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
        for r in units_to_process(last, units.current(found.sparkSession, root)).orderBy("unit").collect():
            units.replace(read(r["unit"]), root, r["unit"], keys, MOST_ROWS, salt, {"etag": r["etag"], "size_bytes": r["size_bytes"]})

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(kind).load(snapshots)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
