"""Writers: partitioned Parquet, source-unit replacement, CSV, manifests, status and ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio import units

#: Rows in one output file at most.
MOST_ROWS = 500_000


def write_partitioned(df: DataFrame, root: str, keys: list[str], most_rows: int = MOST_ROWS, salt: int = 1, mode: str = "error") -> None:
    """Parquet below key=value folders, keys dropped from the file body. Rows are dealt by key, so each folder gets few
    files; salt > 1 splits large keys (a big state) among so many tasks, for which the rows are written once before."""
    ready, more = units.dealt(df, salt)
    (ready.repartition(*(F.col(k) for k in keys), *more).select(df.columns).write.mode(mode).option("maxRecordsPerFile", most_rows).partitionBy(*keys).parquet(root))


def replace_source_unit(df: DataFrame, root: str, unit: str, keys: list[str], most_rows: int = MOST_ROWS, salt: int = 1) -> None:
    """All that a source unit wrote before goes, stale keys too, in one step once the new rows are written and counted; `files.scan`
    reads the current ones. salt > 1 splits its large keys among so many tasks."""
    units.replace(df, root, unit, keys, most_rows, salt)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def manifest(files: DataFrame, partition: str = "partition", path: str = "path", size: str = "size_bytes", rows: str = "record_count") -> DataFrame:
    """(partition, output_files sorted by path, total_records, total_size_bytes) from one row a file."""
    return files.groupBy(partition).agg(
        F.sort_array(F.collect_list(F.when(F.col(path).isNotNull(), F.struct(F.col(path).alias("path"), F.col(size).cast("bigint").alias("size_bytes"),
                                                                              F.col(rows).cast("bigint").alias("record_count"))))).alias("output_files"),
        F.sum(F.col(rows).cast("bigint")).alias("total_records"), F.sum(F.col(size).cast("bigint")).alias("total_size_bytes"))


def merge_manifest(old: DataFrame, new: DataFrame, partition: str = "partition") -> DataFrame:
    """Partitions processed now replace their old entries; the others stay as they were."""
    return old.join(new.select(partition), partition, "left_anti").unionByName(new, allowMissingColumns=True)


def manifest_json(entries: DataFrame, dataset: str, partition: str = "partition") -> DataFrame:
    """One JSON text with the partitions as a sorted map. Its size follows the number of partitions, not of rows."""
    body = F.struct(*(c for c in entries.columns if c != partition))
    pairs = F.sort_array(F.collect_list(F.struct(F.col(partition).alias("key"), body.alias("value"))))
    return entries.agg(F.to_json(F.struct(F.lit("1.0").alias("manifest_version"), F.lit(dataset).alias("dataset"),
                                          F.map_from_entries(pairs).alias("partitions"))).alias("json"))


def write_status(details: DataFrame, summary: DataFrame, root: str, mode: str = "overwrite") -> None:
    details.write.mode(mode).parquet(f"{root}/details")
    summary.write.mode(mode).json(f"{root}/summary")


def upsert_ledger(ledger: DataFrame, rows: DataFrame, unit: str = "unit") -> DataFrame:
    """The ledger with the units' rows replaced. Write it only after the unit's data was read back and agreed."""
    return ledger.join(rows.select(unit), unit, "left_anti").unionByName(rows)


def stack(*frames: DataFrame) -> DataFrame:
    """All frames below each other by name, missing columns as nulls."""
    out, *rest = frames
    for f in rest:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
