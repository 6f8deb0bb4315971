"""Schemas and counts of Parquet trees from their footers alone, read by tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.session import ship
from cartorio.sources import streams
from cartorio.sources.files import inventory

FOOTER = "path string, rows bigint, row_groups int, column_name string, type string, nulls bigint, least string, greatest string"


def _text(value: object) -> str | None:
    return None if value is None else value.decode(errors="replace") if isinstance(value, bytes) else str(value)


def _columns(path: str) -> list[tuple]:
    """A row for each column of a file. Bounds and nulls are null where a row group has no statistics."""
    with streams.open_file(path) as f:
        meta = pq.ParquetFile(f).metadata  # the file's last bytes only
    out = []
    for k in range(meta.num_columns):
        column = meta.schema.column(k)
        kind = column.logical_type.type if column.logical_type and column.logical_type.type != "NONE" else column.physical_type
        each = [meta.row_group(g).column(k).statistics for g in range(meta.num_row_groups)]
        known = bool(each) and all(s is not None and s.has_null_count for s in each)
        bounds = [(s.min, s.max) for s in each if s is not None and s.has_min_max]
        empty = all(s is not None and (s.has_min_max or s.has_null_count and s.num_values == 0) for s in each)
        out.append((path, meta.num_rows, meta.num_row_groups, column.path, str(kind).lower(), sum(s.null_count for s in each) if known else None,
                    _text(min(b[0] for b in bounds)) if bounds and empty else None, _text(max(b[1] for b in bounds)) if bounds and empty else None))
    return out


def footers(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, rows, row_groups, column_name, type, nulls, least, greatest): a row for each column of each Parquet file below root.
    Spark lists the files, tasks read their footers; no column is read. Needs a store that tasks can open (`streams.known`)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                rows = _columns(path)
                kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], [c.split()[0] for c in FOOTER.split(", ")])

    n = int(ship(spark).conf.get("spark.sql.shuffle.partitions"))
    return inventory(spark, root, pattern).select("path").repartition(n, "path").mapInArrow(run, FOOTER)


def row_counts(found: DataFrame, *keys: F.Column) -> DataFrame:
    """(keys, files, rows) from footers; keys are taken from the path, as by `codes.path_key`."""
    return found.groupBy("path", "rows").agg(F.count("*").alias("_columns")).groupBy(*keys).agg(F.count("*").alias("files"), F.sum("rows").alias("rows"))


def column_eras(found: DataFrame, era: F.Column) -> DataFrame:
    """(column_name, type, first_era, last_era, files) of each column and type that occurs: what appears, goes or changes."""
    return found.groupBy("column_name", "type").agg(F.min(era).alias("first_era"), F.max(era).alias("last_era"), F.count_distinct("path").alias("files"))
