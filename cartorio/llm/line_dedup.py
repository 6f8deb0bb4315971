"""Line dedup: windows of consecutive lines that repeat anywhere lose their later occurrences. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartorio.llm.frames import reliable


def _windows(lines: Column, size: int) -> Column:
    """(at, digest) of each window of `size` lines that isn't blank."""
    starts = F.sequence(F.lit(0), F.size(lines) - size)
    each = F.transform(F.when(F.size(lines) >= size, starts).otherwise(F.array().cast("array<int>")),
                       lambda i: F.struct(i.alias("at"), F.array_join(F.slice(lines, i + 1, size), "\n").alias("content")))
    return F.transform(F.filter(each, lambda w: F.length(F.trim(F.translate(w["content"], "\n\r\t", ""))) > 0),
                       lambda w: F.struct(w["at"].alias("at"), F.unhex(F.md5(w["content"])).alias("digest")))


def repeated_windows(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, starts): for each document that has any, the first lines of its later occurrences of a window."""
    lines = F.split(F.col(text_col).cast("string"), "\n", -1)
    # Windows are cut and digested once; what is written has a place and 16 bytes each.
    windows = reliable(docs.select(F.col(id_col).alias("id"), lines.alias("lines"))
                       .select("id", F.explode(_windows(F.col("lines"), size)).alias("w")).select("id", "w.at", "w.digest"))
    # One row for each digest and map task reaches the shuffle, so a window that a third of all rows hold stays small. The
    # repeated ones are written, so that their join with all windows is a plain one, of which Spark splits the long keys.
    first = reliable(windows.groupBy("digest").agg(F.min(F.struct("id", "at")).alias("first"), F.count("*").alias("n"))
                     .filter("n > 1").drop("n"))
    later = windows.join(first, "digest").filter(F.struct("id", "at") > F.col("first"))
    return later.groupBy("id").agg(F.collect_set("at").alias("starts"))


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front where docs has such a column."""
    taken, out = {c.lower() for c in docs.columns}, []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        out.append(n)
    return out


def dedup_lines(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with repeated line windows removed from the text, and two last columns `_n_lines`, `_n_removed` (with more
    underscores where docs has those).

    Lines end at each line feed. A window is `size` consecutive lines; the first in order of (id, line) stays and
    the lines that any later one covers go (overlapping ones merge, in the first document too). Blank windows never
    count. Texts of fewer lines, null and empty texts stay as they are, and longer ones are taken whole; a null id comes first in
    the order and its row stays whole; rows that repeat an id count as the same place. No rows give none. Other columns
    pass unchanged, whatever their names.
    """
    starts = repeated_windows(docs, size, id_col, text_col)
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(id_col).alias("key"))
    own = F.col(f"row.`{text_col}`").cast("string")
    joined = row.join(starts, F.col("key") == F.col("id"), "left").select("row", own.alias("text"), "starts", F.split(own, "\n", -1).alias("lines"))
    hit = F.col("starts").isNotNull()
    covered = joined.withColumn("covered", F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + size - 1)))))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("covered"))
    text = F.when(hit, F.array_join(F.transform(kept, lambda i: F.element_at("lines", i + 1)), "\n")).otherwise(F.col("text"))
    n_lines, n_removed = free_names(docs, "_n_lines", "_n_removed")
    return covered.select(*((text if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns),
                          F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("lines")).cast("long").alias(n_lines),
                          F.when(hit, F.size("covered")).otherwise(0).cast("long").alias(n_removed))
