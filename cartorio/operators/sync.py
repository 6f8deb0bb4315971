"""Comparing sources with copies: statuses, counters, fallbacks and checks of written data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartorio.functions.codes import thousands


def _known(c: Column) -> Column:
    """Empty text and 0 stand for unknown, which is different from nothing."""
    return F.nullif(c.cast("string"), F.lit("")).isNotNull() & (c.cast("string") != "0")


def classify_unit(in_ledger: Column, source: Column, old_etag: Column, new_etag: Column, old_size: Column, new_size: Column) -> Column:
    """unavailable, new, unchanged (same etag and size) or updated."""
    same = old_etag.eqNullSafe(new_etag) & old_size.eqNullSafe(new_size)
    return F.when(~source, "unavailable").when(~in_ledger, "new").when(same, "unchanged").otherwise("updated")


def classify_sync(error: Column, source: Column, copy: Column, old_etag: Column, new_etag: Column, old_size: Column, new_size: Column) -> Column:
    """check_failed, not_published, missing, extra, outdated or in_sync; the first that holds."""
    def differ(a: Column, b: Column) -> Column:
        return F.coalesce(_known(a) & _known(b) & (a != b), F.lit(False))

    return (F.when(F.coalesce(error != "", F.lit(False)), "check_failed").when(~source & ~copy, "not_published").when(source & ~copy, "missing")
            .when(~source & copy, "extra").when(differ(old_etag, new_etag) | differ(old_size, new_size), "outdated").otherwise("in_sync"))


def classify_counts(source: Column, copy: Column, stored: Column) -> Column:
    """(status, note) by record counts. A source count of 0 without a copy is not published; an unknown stored count
    can't be compared."""
    none, unknown = source.isNull() | (source == 0), stored.isNull() | (stored == 0)
    status = (F.when(none & ~copy, "not_published").when(~copy, "missing").when(none, "extra").when(unknown, "in_sync")
              .when(source != stored, "outdated").otherwise("in_sync"))
    change = lambda word: F.concat(thousands(F.abs(source - stored)), F.lit(f" {word} records ("), thousands(stored), F.lit(" -> "), thousands(source), F.lit(")"))
    note = (F.when(~none & copy & unknown, "no stored count").when(~none & copy & (source > stored), change("new"))
            .when(~none & copy & (source < stored), change("fewer")))
    return F.struct(status.alias("status"), note.alias("note"))


def status_summary(details: DataFrame, dataset: str = "dataset", status: str = "status") -> DataFrame:
    """One row a dataset: counts by status and the overall one. Missing or outdated units make it outdated; failed checks
    without any unit in sync make it check_failed, whatever else there is."""
    n = lambda s: F.count_if(F.col(status) == s).alias(s)
    out = details.groupBy(dataset).agg(F.count("*").alias("units"), *(n(s) for s in ("in_sync", "outdated", "missing", "not_published", "extra", "check_failed")))
    overall = (F.when((F.col("check_failed") > 0) & (F.col("in_sync") == 0), "check_failed").when((F.col("missing") > 0) | (F.col("outdated") > 0), "outdated")
               .otherwise("in_sync"))
    return out.withColumn("overall", overall)


def compare(expected: DataFrame, source: DataFrame, copy: DataFrame, keys: list[str]) -> DataFrame:
    """Units with both sides and a status. source: exists, etag, size_bytes, error; copy: source_etag, source_size_bytes. A unit that
    isn't expected but that the copy has comes too: as extra where the source lacks it."""
    expected = expected.unionByName(copy.join(expected, keys, "left_anti").select(*keys).distinct(), allowMissingColumns=True)
    s = source.select(*keys, F.col("exists").alias("_exists"), "etag", "size_bytes", "error")
    c = copy.select(*keys, F.lit(True).alias("_copy"), "source_etag", "source_size_bytes")
    both = expected.join(s, keys, "left").join(c, keys, "left")
    yes = lambda name: F.coalesce(F.col(name), F.lit(False))
    status = classify_sync(F.col("error"), yes("_exists"), yes("_copy"), F.col("source_etag"), F.col("etag"), F.col("source_size_bytes"), F.col("size_bytes"))
    return both.withColumn("status", status).withColumns({"in_source": yes("_exists"), "in_copy": yes("_copy")}).drop("_exists", "_copy")


def size_balance(details: DataFrame, source_size: str, copy_size: str, source: str = "in_source", copy: str = "in_copy") -> DataFrame:
    """Bytes at the source and in the copy, of units that exist, and their ratio."""
    a, b = F.sum(F.when(F.col(source), F.col(source_size))), F.sum(F.when(F.col(copy), F.col(copy_size)))
    return details.agg(a.alias("source_bytes"), b.alias("copy_bytes"), F.try_divide(b.cast("double"), a.cast("double")).alias("copy_ratio"))


def counts_or_baseline(live: DataFrame, stored: DataFrame, ok: bool) -> DataFrame:
    """(unit, n, origin): live counts where the query for them succeeded, else the stored ones."""
    return live.withColumn("origin", F.lit("live")) if ok else stored.withColumn("origin", F.lit("baseline"))


def total_or_sum(counts: DataFrame, total: int | None) -> DataFrame:
    return counts.agg(F.coalesce(F.lit(total).cast("bigint"), F.sum("n")).alias("total"))


def validate_copy(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """(path, result): ok, mismatch, missing or extra, by the digests of files found and of the manifest's."""
    f = found.select("path", F.col("sha256").alias("_found"))
    w = wanted.select("path", F.col("sha256").alias("_wanted"))
    result = (F.when(F.col("_found").isNull(), "missing").when(F.col("_wanted").isNull(), "extra").when(F.col("_found") == F.col("_wanted"), "ok").otherwise("mismatch"))
    return f.join(w, "path", "full").select("path", result.alias("result"))


def validate_pieces(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """(path, pieces, different, first_difference): of each file on either side, by digests of its pieces (path, piece, first, sha256),
    how many there are, how many differ or are on one side only, and the first byte of the first of these."""
    f = found.select("path", "piece", F.col("first").alias("_f"), F.col("sha256").alias("_found"))
    w = wanted.select("path", "piece", F.col("first").alias("_w"), F.col("sha256").alias("_wanted"))
    bad = ~F.col("_found").eqNullSafe(F.col("_wanted"))
    return (f.join(w, ["path", "piece"], "full").groupBy("path")
            .agg(F.count("*").alias("pieces"), F.count_if(bad).alias("different"), F.min(F.when(bad, F.coalesce("_f", "_w"))).alias("first_difference")))


def same_after_write(df: DataFrame, path: str) -> DataFrame:
    """(rows_in, rows_out, columns_in, columns_out, same) of a frame and what was written of it."""
    back = df.sparkSession.read.option("pathGlobFilter", "*.parquet").parquet(path)
    a, b = df.agg(F.count("*").alias("rows_in")), back.agg(F.count("*").alias("rows_out"))
    return (a.crossJoin(b).withColumns({"columns_in": F.lit(len(df.columns)), "columns_out": F.lit(len(back.columns))})
            .withColumn("same", (F.col("rows_in") == F.col("rows_out")) & (F.col("columns_in") == F.col("columns_out"))))


def copied_enough(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Whether at least as many files (path, parts) are at the target as here. One counts there only if it has at least as many parts as here."""
    here, there = local.select("path", F.col("parts").alias("_here")), remote.select("path", F.col("parts").alias("_there"))
    whole = F.col("_there") >= F.coalesce("_here", F.lit(0))
    out = here.join(there, "path", "full").agg(F.count("_here").alias("local_files"), F.count_if(whole).alias("remote_files"))
    return out.withColumn("enough", F.col("remote_files") >= F.col("local_files"))


def account(df: DataFrame, reason: Column) -> DataFrame:
    """(rows_read, valid, quarantined or rejected by reason): every row read is in one of them."""
    return df.groupBy(F.coalesce(reason, F.lit("valid")).alias("outcome")).agg(F.count("*").alias("n"))


def observed(df: DataFrame, name: str, reason: Column) -> DataFrame:
    """The same rows; counts of all and of rejected ones are told as metrics once the frame is written."""
    return df.observe(name, F.count(F.lit(1)).alias("rows_read"), F.count_if(reason.isNotNull()).alias("rejected"))


INVENTORY = "dataset string, unit_key string, variant_rank int, exists boolean, size_bytes bigint, etag string, last_modified string, error string"
