"""Files read by tasks as streams or in pieces, for what Spark's own readers take as one value only."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.session import ship

#: Bytes read at once.
BLOCK = 1 << 20


def store(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of a path as Spark names it, and the name there. Stores that Arrow doesn't know raise."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    scheme, rest = path.split("://", 1)
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")


def open_file(path: str) -> pa.NativeFile:
    system, name = store(path)
    return system.open_input_file(name)


def known(path: str) -> bool:
    """Whether tasks can open the path's store in pieces."""
    try:
        return store(path)[0] is not None
    except (pa.ArrowException, OSError, ValueError):
        return False


def _hashed(path: str, first: int, size: int) -> tuple[str, str]:
    """SHA-256 and MD5 of a part of a file, in memory of one block."""
    sha, md5, left = hashlib.sha256(), hashlib.md5(usedforsecurity=False), size
    with open_file(path) as f:
        f.seek(first)
        while left:
            block = f.read(min(BLOCK, left))
            if not block:
                raise OSError(f"{path} ends {left} bytes too early")
            sha.update(block)
            md5.update(block)
            left -= len(block)
    return sha.hexdigest(), md5.hexdigest()


def hashed(parts: DataFrame) -> DataFrame:
    """(path, first, size_bytes) with the `sha256` and `md5` of each part; a part is one task's stream, none is held whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, first, size in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                sha, md5 = _hashed(path, first, size)
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([first], pa.int64()), pa.array([size], pa.int64()), pa.array([sha]), pa.array([md5])],
                                                 ["path", "first", "size_bytes", "sha256", "md5"])

    ship(parts.sparkSession)
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parts.select("path", "first", "size_bytes").repartition(n, "path", "first").mapInArrow(run, "path string, first bigint, size_bytes bigint, sha256 string, md5 string")


def pieces(files: DataFrame, size: int) -> DataFrame:
    """(path, piece, first, size_bytes) of files (path, size_bytes): parts of `size` bytes, the last shorter; an empty file has one
    empty part."""
    last = F.greatest(F.ceil(F.col("size_bytes") / size).cast("long") - 1, F.lit(0).cast("long"))
    each = files.select("path", F.col("size_bytes").alias("all"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    first = F.col("piece") * size
    return each.select("path", "piece", first.alias("first"), F.least(F.lit(size).cast("long"), F.col("all") - first).alias("size_bytes"))
