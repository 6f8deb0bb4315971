"""dBase III tables as a Spark data source: header on the driver, records decoded in byte ranges on the executors."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from cartorio.session import materialised, ship
from cartorio.sources import streams

#: Records that one task decodes.
RECORDS = 200_000


@dataclass
class Layout:
    records: int
    start: int
    width: int
    fields: list[tuple[str, int, int]]  # name, offset in the record, width


def layout(head: bytes) -> Layout:
    """From a file's first bytes: the count, where records start, their width, and the fields."""
    records, start, width = struct.unpack_from("<IHH", head, 4)
    fields, at = [], 1  # a deletion flag comes first
    for p in range(32, start - 1, 32):
        if head[p] == 0x0D:
            break
        size = head[p + 16]
        fields.append((head[p : p + 11].split(b"\0")[0].decode("ascii"), at, size))
        at += size
    return Layout(records, start, width, fields)


@dataclass
class Range(InputPartition):
    path: str
    first: int
    last: int


class DbfReader(DataSourceReader):
    def __init__(self, path: str, names: list[str], encoding: str, records: int):
        self.path, self.names, self.encoding, self.records = path, names, encoding, records

    def partitions(self) -> list[Range]:
        n = _layout(self.path).records
        return [Range(self.path, lo, min(lo + self.records, n)) for lo in range(0, max(n, 1), self.records)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        yield from range_batches(part.path, part.first, part.last, self.encoding, self.names)


def _layout(path: str) -> Layout:
    with streams.open_file(path) as f:
        head = f.read(32)
        return layout(head + f.read(struct.unpack_from("<H", head, 8)[0] - 32))


def _texts(rows: np.ndarray, at: int, size: int, encoding: str) -> pa.Array:
    """One field of some records; blanks are null."""
    text = np.ascontiguousarray(rows[:, at : at + size]).view(f"S{size}").ravel()
    column = pc.utf8_trim_whitespace(pa.array(np.char.decode(text, encoding).tolist(), pa.string()))
    return pc.if_else(pc.equal(column, ""), pa.scalar(None, pa.string()), column)


def decoded(rows: np.ndarray, fields: list[tuple[str, int, int]], names: list[str], encoding: str, equals: dict[str, list[str]] | None = None) -> pa.RecordBatch:
    """The named columns of records (one a row of bytes) as text, null where the file lacks one. Deleted records go, and those in
    which a column of `equals` has none of its values: of these no other column is decoded."""
    rows, place = rows[rows[:, 0] != ord("*")], {n: (at, size) for n, at, size in fields}
    for name, wanted in (equals or {}).items():
        if name not in place:
            rows = rows[:0]
            continue
        rows = rows[pc.fill_null(pc.is_in(_texts(rows, *place[name], encoding), pa.array(wanted, pa.string())), False).to_numpy(zero_copy_only=False)]
    columns = [_texts(rows, *place[n], encoding) if n in place else pa.nulls(len(rows), pa.string()) for n in names]
    return pa.RecordBatch.from_arrays(columns, names)


def range_batches(path: str, first: int, last: int, encoding: str, names: list[str], equals: dict[str, list[str]] | None = None, step: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Records first to last of a file, some at a time: only these bytes are read."""
    shape = _layout(path)
    with streams.open_file(path) as f:
        f.seek(shape.start + first * shape.width)
        for lo in range(first, last, step):
            raw = f.read((min(lo + step, last) - lo) * shape.width)
            n = len(raw) // shape.width if shape.width else 0
            if n:
                yield decoded(np.frombuffer(raw, np.uint8, n * shape.width).reshape(n, shape.width), shape.fields, names, encoding, equals)


class Dbf(DataSource):
    """format("dbf").load(path): all columns text; blanks are null. The path, local or a URI, must be open to driver and executors alike."""

    @classmethod
    def name(cls) -> str:
        return "dbf"

    def _path(self) -> str:
        return self.options["path"]

    def schema(self) -> StructType:
        return StructType([StructField(n, StringType()) for n, _, _ in _layout(self._path()).fields])

    def reader(self, schema: StructType) -> DbfReader:
        return DbfReader(self._path(), schema.names, self.options.get("encoding", "ISO-8859-1"), int(self.options.get("records", RECORDS)))


def read_dbf(spark: SparkSession, path: str, encoding: str = "ISO-8859-1", records: int = RECORDS) -> DataFrame:
    """One file, in ranges of so many records."""
    ship(spark)
    spark.dataSource.register(Dbf)
    return spark.read.format("dbf").option("encoding", encoding).option("records", str(records)).load(path)


def read_dbf_folder(spark: SparkSession, root: str, names: list[str] | None = None, pattern: str = "*.[dD][bB][fF]", encoding: str = "ISO-8859-1",
                    equals: dict[str, list[str]] | None = None, records: int = RECORDS) -> DataFrame:
    """All dBase files below root: `_path` and every column that any of them has (or `names`), as text, of the records in which each
    column of `equals` has one of its values.

    Spark lists the files; tasks read their heads, and then each range of at most `records` records by itself. In a store that tasks
    can't open (`streams.known`) each file comes as one value instead (2 GB at most), with the same rows.
    """
    ship(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    one = files.select("path").limit(1).collect()
    if one and not streams.known(one[0]["path"]):
        return _whole_files(files.select("path", "content"), names, encoding, equals)

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                shape = _layout(path)
                first = list(range(0, shape.records, records))
                yield pa.RecordBatch.from_arrays([pa.array([path] * (len(first) or 1)), pa.array(first or [0], pa.int64()), pa.array([min(k + records, shape.records) for k in first] or [0], pa.int64()),
                                                  pa.array([[n for n, _, _ in shape.fields] if k == 0 else [] for k in first or [0]], pa.list_(pa.string()))], ["path", "first", "last", "names"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = materialised(files.select("path").repartition(n, "path").mapInArrow(heads, "path string, first bigint, last bigint, names array<string>"))  # a row a range
    names = names or _names(ranges.select(F.explode("names").alias("name")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, first, last in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                for rows in range_batches(path, first, last, encoding, names, equals):
                    yield pa.RecordBatch.from_arrays([pa.array([path] * rows.num_rows, pa.string()), *rows.columns], ["_path", *names])

    return ranges.select("path", "first", "last").repartition(max(n, ranges.count()), "path", "first").mapInArrow(run, _schema(names))


def _names(found: DataFrame) -> list[str]:
    return sorted(r["name"] for r in found.distinct().collect())  # as many as there are columns


def _schema(names: list[str]) -> str:
    return ", ".join(["_path string", *(f"`{n}` string" for n in names)])


def _whole_files(files: DataFrame, names: list[str] | None, encoding: str, equals: dict[str, list[str]] | None) -> DataFrame:
    """read_dbf_folder of files that come as values."""
    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = {n for c in b.column(1) for n, _, _ in layout(c.as_py()).fields}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["name"])

    names = names or _names(files.mapInArrow(heads, "name string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                raw = content.as_py()
                shape = layout(raw[: struct.unpack_from("<H", raw, 8)[0]])
                n = min(shape.records, (len(raw) - shape.start) // shape.width) if shape.width else 0
                body = np.frombuffer(raw, np.uint8, n * shape.width, shape.start).reshape(n, shape.width)
                for lo in range(0, n, 50_000):
                    rows = decoded(body[lo : lo + 50_000], shape.fields, names, encoding, equals)
                    yield pa.RecordBatch.from_arrays([pa.array([path] * rows.num_rows, pa.string()), *rows.columns], ["_path", *names])

    return files.mapInArrow(run, _schema(names))


def dbf_bytes(fields: list[tuple[str, int]], rows: list[tuple[str | None, ...]], encoding: str = "ISO-8859-1") -> bytes:
    """A dBase III file of character fields."""
    width = 1 + sum(w for _, w in fields)
    head = struct.pack("<B3BIHH20x", 3, 24, 1, 1, len(rows), 32 + 32 * len(fields) + 1, width)
    for name, w in fields:
        head += name.encode("ascii")[:10].ljust(11, b"\0") + b"C" + bytes(4) + bytes([w, 0]) + bytes(14)
    body = b"".join(b" " + b"".join((v or "").encode(encoding)[:w].ljust(w) for v, (_, w) in zip(r, fields, strict=True)) for r in rows)
    return head + b"\r" + body + b"\x1a"
