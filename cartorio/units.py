"""Source units that are replaced in one step: each writing has a folder of its own, and a small pointer says which one counts.

Below a root lie `source_unit=<unit>/version=<id>/<key>=<value>/...` and `_units/<unit>`, one line of JSON each: unit, version, rows, and the tag and size
of the source that was read, if told: the ledger of a unit can't be older or newer than its rows.
A writing that fails, or a driver that dies before the pointer is renamed, leaves what was there as it was.
"""

from __future__ import annotations

import json
import time
import uuid
from urllib.parse import quote

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cartorio.session import materialised

#: Where the pointers are, below a root; Spark's listings pass over names that begin so.
POINTERS = "_units"
POINTER = "unit string, version string, rows bigint, etag string, size_bytes bigint"


class WriteMismatch(RuntimeError):
    """What was written isn't what there was to write; nothing has been made current."""


def _fs(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _name(unit: str) -> str:
    return quote(unit, safe="")


def dealt(df: DataFrame, salt: int) -> tuple[DataFrame, list[Column]]:
    """df and what to deal its rows by besides their keys: a number that each row is given once, and is written with, so that
    a task that runs again deals as before. Any columns will do, and equal rows spread too."""
    if salt <= 1:
        return df, []
    name = "_deal"
    while name in df.columns:
        name = f"_{name}"
    return materialised(df.withColumn(name, F.pmod(F.monotonically_increasing_id(), F.lit(salt)))), [F.col(name)]


def write_version(df: DataFrame, root: str, unit: str, keys: list[str], most_rows: int, salt: int = 1) -> tuple[str, int]:
    """(version, rows) of a new folder of the unit with all rows of df, counted while they're written and again as they're read
    back. Nothing refers to it yet."""
    spark, version, seen = df.sparkSession, f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}", Observation()
    folder = f"{root.rstrip('/')}/source_unit={_name(unit)}/version={version}"
    ready, more = dealt(df, salt)
    ready = ready.repartition(*(F.col(k) for k in keys), *more).select(df.columns).observe(seen, F.count(F.lit(1)).alias("rows"))
    ready.write.option("maxRecordsPerFile", most_rows).partitionBy(*keys).parquet(folder)
    rows = seen.get["rows"]
    # Without rows Spark leaves no file to read back.
    back = spark.read.schema(df.schema).option("pathGlobFilter", "*.parquet").parquet(folder).count() if rows else 0
    if back != rows:
        raise WriteMismatch(f"{unit}: {rows} rows written, {back} read back")
    return version, rows


def commit(spark: SparkSession, root: str, unit: str, version: str, rows: int, source: dict[str, object] | None = None) -> None:
    """Makes a version the unit's current one: its pointer is written beside the old one and renamed over it, which readers see
    as one step."""
    folder = f"{root.rstrip('/')}/{POINTERS}"
    fs, target = _fs(spark, f"{folder}/{_name(unit)}")
    _, fresh = _fs(spark, f"{folder}/.{_name(unit)}-{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    out.write(bytearray((json.dumps({"unit": unit, "version": version, "rows": rows, **(source or {})}) + "\n").encode()))
    out.close()
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(fresh), fs.makeQualified(target), options)


def replace(df: DataFrame, root: str, unit: str, keys: list[str], most_rows: int, salt: int = 1, source: dict[str, object] | None = None) -> str:
    """Writes, verifies and makes current. Until the last step, and if anything fails before it, readers see the old rows.
    source: the etag and size_bytes of what was read."""
    version, rows = write_version(df, root, unit, keys, most_rows, salt)
    commit(df.sparkSession, root, unit, version, rows, source)
    return version


def current(spark: SparkSession, root: str) -> DataFrame:
    """(unit, version, rows, etag, size_bytes) of each unit that has been committed below root: as many rows as there are units."""
    if not exists(spark, f"{root.rstrip('/')}/{POINTERS}"):
        return spark.createDataFrame([], POINTER)
    return spark.read.schema(POINTER).option("pathGlobFilter", "[!.]*").json(f"{root.rstrip('/')}/{POINTERS}")


def paths(spark: SparkSession, root: str) -> list[str]:
    """The current versions' folders that hold rows, a path for each unit."""
    found = current(spark, root).filter("rows > 0").select("unit", "version").collect()
    return [f"{root.rstrip('/')}/source_unit={_name(r['unit'])}/version={r['version']}" for r in found]


def read(spark: SparkSession, root: str, superset: bool = False) -> DataFrame:
    """The rows of all current versions, with `source_unit` and the keys as partition columns. A frame keeps to the versions that were
    current when it was made; units without rows have none, and if no unit has any there's nothing to take columns from."""
    own = paths(spark, root)
    reader = spark.read.option("pathGlobFilter", "*.parquet").option("mergeSchema", superset).option("basePath", root)
    return reader.parquet(*own).drop("version")


def remove_old(spark: SparkSession, root: str, older_than_s: float = 86_400) -> list[str]:
    """Deletes versions that aren't current and were begun longer ago than that, so that readers and writers at work keep
    theirs; returns their folders. Run it when no writing is older than the bound."""
    keep, gone, before = set(paths(spark, root)), [], time.time_ns() - int(older_than_s * 1e9)
    fs, top = _fs(spark, root)
    for unit in fs.listStatus(top):
        name = unit.getPath().getName()
        if name.startswith("source_unit="):
            for v in fs.listStatus(unit.getPath()):
                version, folder = v.getPath().getName().removeprefix("version="), f"{root.rstrip('/')}/{name}/{v.getPath().getName()}"
                if folder not in keep and version.partition("-")[0].isdigit() and int(version.partition("-")[0]) < before:
                    fs.delete(v.getPath(), True)
                    gone.append(folder)
    return sorted(gone)
