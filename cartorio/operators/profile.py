"""Column profiles in one pass over the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.session import materialised


def unfold(df: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    """(column_name, value), beside the columns to keep, of every cell, each table row read once."""
    cells = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns))
    return df.select(*keep, F.explode(cells).alias("c")).select(*keep, "c.*")


def profile(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """For each column: rows, nulls, empty texts, distinct values, whether any value has a lost-able leading zero, the
    shares of date-like, integer-like and numeric-like values among non-empty ones, and the least and greatest value.

    approximate: distinct values by sketch, for tables whose columns don't group cheaply."""
    full = F.when((F.col("value") != ""), F.col("value"))
    share = lambda p: F.avg(F.when(full.isNotNull(), full.rlike(p).cast("int")))
    distinct = F.approx_count_distinct("value") if approximate else F.count_distinct("value")
    return unfold(df, columns).groupBy("column_name").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("value").isNull()).alias("nulls"), F.count_if(F.col("value") == "").alias("empties"),
        distinct.alias("distinct_values"), F.coalesce(F.max(full.rlike("^0[0-9]+$")), F.lit(False)).alias("leading_zero"),
        share(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}").alias("date_share"), share("^-?[0-9]+$").alias("integer_share"), share(r"^-?[0-9]+([.,][0-9]+)?$").alias("numeric_share"),
        F.min(full).alias("least"), F.max(full).alias("greatest"))


def suggest_type(profiled: DataFrame, least: float = 0.99) -> DataFrame:
    """date where nearly all values look like one; integer or decimal where nearly all are numbers and none has a leading
    zero; otherwise string."""
    kind = (F.when(F.col("date_share") >= least, "date").when(F.col("leading_zero"), "string").when(F.col("integer_share") >= least, "integer")
            .when(F.col("numeric_share") >= least, "decimal").otherwise("string"))
    return profiled.withColumn("suggestion", kind)


def code_length(df: DataFrame, column: str, short: int = 6) -> DataFrame:
    n = F.length(column)
    return df.agg(F.min(n).alias("least"), F.max(n).alias("most"), F.avg(n).alias("mean"), F.count_if(n < short).alias("shorter"))


def suffix_counts(df: DataFrame, column: str) -> DataFrame:
    """Values with a float suffix, and values that start with a zero."""
    return df.agg(F.count_if(F.col(column).rlike(r"\.[0-9]+$")).alias("float_suffix"), F.count_if(F.col(column).rlike("^0")).alias("leading_zero"))


def null_share(df: DataFrame, columns: list[str]) -> DataFrame:
    return unfold(df, columns).groupBy("column_name").agg(
        F.count_distinct("value").alias("distinct_values"), F.count_if(F.col("value").isNull()).alias("nulls"),
        (F.count_if(F.col("value").isNull()) * 100.0 / F.count("*")).alias("null_pct"))


def misdecoded(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values that show UTF-8 read as Latin-1, or replacement characters, for each column."""
    bad = F.col("value").contains("Ã") | F.col("value").contains("�")
    return unfold(df, columns).groupBy("column_name").agg(F.count_if(bad).alias("misdecoded"))


def compare_formats(a: DataFrame, b: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Two encodings of the same rows, field by field: equal, different, float suffixes in b, zeros lost in b."""
    x = a.select(key, *(F.col(c).alias(f"_a_{c}") for c in columns))
    y = b.select(key, *(F.col(c).alias(f"_b_{c}") for c in columns))
    cells = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"_a_{c}").cast("string").alias("a"), F.col(f"_b_{c}").cast("string").alias("b")) for c in columns))
    return x.join(y, key).select(F.explode(cells).alias("c")).select("c.*").groupBy("column_name").agg(
        F.count_if(F.col("a").eqNullSafe(F.col("b"))).alias("equal"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("different"),
        F.count_if(F.col("b").rlike(r"\.[0-9]+$") & ~F.col("a").rlike(r"\.[0-9]+$")).alias("float_suffix"),
        F.count_if(F.col("a").rlike("^0") & ~F.col("b").rlike("^0")).alias("lost_zero"))


def _row_digests(df: DataFrame, key: str, columns: list[str], buckets: int) -> DataFrame:
    """(bucket, rows, sum, xor): digests of the bucket's rows that don't hang on their order. Nulls count as a value of their own."""
    marked = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in (key, *columns)]
    h, g = F.xxhash64(*marked), F.xxhash64(*reversed(marked))
    return df.groupBy(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).alias("bucket")).agg(
        F.count("*").alias("rows"), F.sum(h.cast("decimal(38,0)")).alias("sum"), F.bit_xor(g).alias("xor"))


def differing_buckets(a: DataFrame, b: DataFrame, key: str, columns: list[str], buckets: int = 4096) -> DataFrame:
    """(bucket, rows_a, rows_b, same) of all buckets of keys on either side, by digests: one row a bucket and map task is shuffled."""
    x = _row_digests(a, key, columns, buckets).select("bucket", F.col("rows").alias("rows_a"), F.struct("rows", "sum", "xor").alias("_a"))
    y = _row_digests(b, key, columns, buckets).select("bucket", F.col("rows").alias("rows_b"), F.struct("rows", "sum", "xor").alias("_b"))
    return x.join(y, "bucket", "full").select("bucket", F.coalesce("rows_a", F.lit(0)).alias("rows_a"), F.coalesce("rows_b", F.lit(0)).alias("rows_b"),
                                              F.col("_a").eqNullSafe(F.col("_b")).alias("same"))


def compare_by_digests(a: DataFrame, b: DataFrame, key: str, columns: list[str], buckets: int = 4096) -> DataFrame:
    """The result of compare_formats for unique keys, of which only the buckets that differ are joined field by field: the others'
    rows are equal in all fields (two digests of 64 bits agree)."""
    found = materialised(differing_buckets(a, b, key, columns, buckets))
    bucket = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets))
    differ = F.broadcast(found.filter(~F.col("same")).select(F.col("bucket").alias("_bucket")))  # at most `buckets` numbers
    some = [df.join(differ, bucket == F.col("_bucket"), "left_semi") for df in (a, b)]
    equal = found.filter("same").agg(F.coalesce(F.sum("rows_a"), F.lit(0)).alias("_n"))
    names = equal.select("_n", F.explode(F.array(*(F.lit(c) for c in columns))).alias("column_name"))
    return (compare_formats(*some, key, columns).join(names, "column_name", "right")
            .select("column_name", (F.coalesce("equal", F.lit(0)) + F.col("_n")).alias("equal"), *(F.coalesce(c, F.lit(0)).alias(c) for c in ("different", "float_suffix", "lost_zero"))))
