"""Readers of publisher files and of our own Parquet."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartorio import units
from cartorio.schemas import BASELINE, LEDGER, MANIFEST, all_string
from cartorio.sources import streams
from cartorio.sources.json_arrays import json_records

CORRUPT = "_corrupt"


def read_json_array(spark: SparkSession, path: str, names: list[str], lines: bool = False, rescue: bool = True, range_bytes: int | None = None) -> DataFrame:
    """JSON records with every value as its raw text. Keys outside `names` are kept in `_rescued` where records come as
    lines or in ranges; bad records are kept in `_corrupt`. A file of one array is one task, unless range_bytes is given: then
    it is read in ranges of so many bytes, by many tasks (`json_arrays.json_records`), and values that are objects or lists come
    without white space between their parts, as from lines."""
    schema = T.StructType([*all_string(names).fields, T.StructField(CORRUPT, T.StringType())])
    if range_bytes:
        found = json_records(spark, path, range_bytes)
        return _by_names(found.select(F.col("record").alias("value"), "is_whole"), names, F.col("is_whole"))
    if not lines:
        return spark.read.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    if not rescue:
        return spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return _by_names(spark.read.text(path), names)


def _by_names(raw: DataFrame, names: list[str], whole: Column | None = None) -> DataFrame:
    """The values of JSON objects in the column value, with what can't be read and what isn't asked for beside them."""
    parsed = F.from_json("value", "map<string,string>")
    raw = raw.select("value", (parsed if whole is None else F.when(whole, parsed)).alias("_m"))
    known = F.array(*(F.lit(n) for n in names))
    rest = F.map_filter("_m", lambda k, v: ~F.array_contains(known, k))
    return raw.select(*(F.col("_m")[n].alias(n) for n in names), F.when(F.col("_m").isNull(), F.col("value")).alias(CORRUPT),
                      F.when(F.size(rest) > 0, F.to_json(rest)).alias("_rescued"))


def read_csv_strings(spark: SparkSession, path: str, names: list[str], sep: str = ";", quote: str = '"', encoding: str = "UTF-8",
                     header: bool = True, trailing: bool = False) -> DataFrame:
    """Separated text with every value as text and malformed lines in `_corrupt`. trailing: lines end with a separator,
    whose empty last column goes."""
    fields = [*all_string(names).fields, *([T.StructField("_artefact", T.StringType())] if trailing else []), T.StructField(CORRUPT, T.StringType())]
    df = (spark.read.schema(T.StructType(fields)).option("sep", sep).option("quote", quote).option("encoding", encoding).option("header", header)
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).csv(path))
    return df.drop("_artefact")


def good_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_rows(df: DataFrame) -> DataFrame:
    """Malformed lines: counted and kept, not lost."""
    return df.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def drop_header_row(df: DataFrame, column: str) -> DataFrame:
    """Without rows that hold the column's own name: the header of a file read by position."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(column)))


def scan(spark: SparkSession, root: str, where: Column | str | None = None, superset: bool = False) -> DataFrame:
    """Hive-partitioned Parquet below root; other files there (readme, manifest) are passed over. Key filters prune. Where source
    units have been replaced below root, their current versions are read."""
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")  # keys are text: 01, not 1
    if units.exists(spark, f"{root.rstrip('/')}/{units.POINTERS}"):
        df = units.read(spark, root, superset)
    else:
        df = spark.read.option("pathGlobFilter", "*.parquet").option("mergeSchema", superset).parquet(root)
    return df.filter(where) if where is not None else df


def scan_foreign(spark: SparkSession, root: str, keys: tuple[str, ...] = ("ano", "uf")) -> DataFrame:
    """Layouts whose directory keys collide with data columns (ano/ANO): no partition discovery, keys come from the path
    as p_<key>, and both values survive."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").option("mergeSchema", True).parquet(root)
    path = F.col("_metadata.file_path")
    return df.withColumns({f"p_{k}": F.nullif(F.regexp_extract(path, rf"/{k}=([^/]+)/", 1), F.lit("")) for k in keys})


def select_present(df: DataFrame, wanted: list[str]) -> DataFrame:
    return df.select(*(c for c in wanted if c in df.columns))


#: Chosen partitions that become predicates of the scan at most.
CHOSEN = 2_000


def sampled_scan(df: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the chosen partitions. A few chosen keys (their count is checked) become literal predicates, so that a scan
    partitioned by them lists and reads only their folders; more are joined, and then all folders are read."""
    found = chosen.select(*keys).distinct()
    few = found.limit(CHOSEN + 1).collect()
    if len(few) > CHOSEN:
        return df.join(found, keys, "left_semi")
    whole = [r for r in few if None not in tuple(r)]
    if not whole:
        return df.filter(F.lit(False))
    # Each key's values by themselves prune too where a filter of several columns can't; both together are exact.
    where = F.lit(True)
    for k in keys:
        where = where & F.col(k).isin(sorted({r[k] for r in whole}))
    if len(keys) > 1:
        where = where & reduce(or_, (reduce(and_, (F.col(k) == r[k] for k in keys)) for r in whole))
    return df.filter(where)


def first_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def below(spark: SparkSession, path: Column, root: str) -> Column:
    """A path as it stands below root, whether it's whole (with or without a scheme) or relative already."""
    whole = spark._jvm.org.apache.hadoop.fs.Path(root)
    whole = whole.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(whole)
    out = path
    for start in (whole.toString(), whole.toUri().getPath(), root):
        start = start.rstrip("/") + "/"
        out = F.when(out.startswith(start), F.substr(out, F.lit(len(start) + 1))).otherwise(out)
    return F.regexp_replace(out, r"^\./", "")


def inventory(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, size_bytes, modified) of the files below root; Spark lists no empty ones."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
            .select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified")))


def whole_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, parts, size_bytes) of each folder below root that holds files: what a writer cuts into parts (of `sinks.MOST_ROWS` rows
    at most) is one file."""
    inv = inventory(spark, root, pattern)
    return (inv.groupBy(F.regexp_replace(below(spark, F.col("path"), root), r"/?[^/]*$", "").alias("path"))
            .agg(F.count("*").alias("parts"), F.sum("size_bytes").alias("size_bytes")))


#: Files of more bytes are hashed as streams.
WHOLE = 128 << 20
#: Bytes of a piece that is hashed by itself.
PIECE = 64 << 20


def digests(spark: SparkSession, root: str, pattern: str = "*.parquet", whole: int = WHOLE) -> DataFrame:
    """(path, size_bytes, sha256, md5) of each file below root, of any size. Files of up to `whole` bytes come as values, from any
    store that Spark reads; larger ones are streamed, each by one task, from stores that tasks can open (`streams.known`)."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
             .withColumnRenamed("length", "size_bytes"))
    values = found.filter(F.col("size_bytes") <= whole).select("path", "size_bytes", F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5"))
    large = found.filter(F.col("size_bytes") > whole).select("path", F.lit(0).cast("long").alias("first"), "size_bytes")
    return values.unionByName(streams.hashed(large).drop("first"))


def piece_digests(spark: SparkSession, root: str, pattern: str = "*.parquet", size: int = PIECE) -> DataFrame:
    """(path, piece, first, size_bytes, sha256) of parts of `size` bytes of each file below root: one file is checked by many tasks,
    and a difference is found within a part. (SHA-256 of a whole file can't be put together from them.)"""
    parts = streams.pieces(inventory(spark, root, pattern), size)
    return streams.hashed(parts).withColumn("piece", F.floor(F.col("first") / size)).select("path", "piece", "first", "size_bytes", "sha256")


def read_ledger(spark: SparkSession, path: str, schema: str = LEDGER) -> DataFrame:
    """The ledger, or no rows of the same schema where there is none yet."""
    if not units.exists(spark, path):
        return spark.createDataFrame([], schema)
    if path.endswith(".csv"):
        return spark.read.schema(schema).option("header", True).csv(path)
    return spark.read.schema(schema).parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row for each partition of the manifests at path."""
    raw = spark.read.schema(MANIFEST).option("multiLine", True).json(path)
    return raw.select("dataset", F.explode("partitions").alias("partition", "p")).select("dataset", "partition", "p.*")


def manifest_files(manifest: DataFrame) -> DataFrame:
    """One row for each output file; partitions without files have one of nulls."""
    return manifest.select("dataset", "partition", F.explode_outer("output_files").alias("f")).select("dataset", "partition", "f.*")


def read_baseline(spark: SparkSession, path: str) -> DataFrame:
    """(unit, n) stored counts; no rows where there is no baseline."""
    if not units.exists(spark, path):
        return spark.createDataFrame([], "unit string, n bigint")
    return spark.read.schema(BASELINE).option("multiLine", True).json(path).select(F.explode("counts").alias("unit", "n"))
