"""Labelled rows to fit on: a bounded sample, the same on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))


def sample(docs: DataFrame, labels: DataFrame, label_col: str, keep: Column, most: int, id_col: str = "doc_id",
           text_col: str = "text", most_bytes: int | None = None) -> DataFrame:
    """(text, label) of at most `most` labelled rows that `keep` admits, those of the least id hashes; null texts are empty. An id with several labels has the largest.

    Only ids and labels are sorted; at most `most` of them are sent to the scan of the documents. With most_bytes, a first
    scan measures their texts, and in the same order each id whose rows no longer fit in what is left is passed over:
    texts are never cut, and all together have at most so many bytes.
    """
    chosen = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"))
              .filter(F.col("label").isNotNull() & keep).groupBy("_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("_id"), "_id").limit(most))
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    if most_bytes is not None:
        sizes = (texts.join(F.broadcast(chosen), "_id").groupBy("_id", "label").agg(F.sum(F.octet_length("text").cast("long")).alias("n"))
                 .orderBy(F.xxhash64("_id"), "_id").collect())
        admitted, left = [], most_bytes
        for r in sizes:
            if r["n"] <= left:
                left -= r["n"]
                admitted.append((r["_id"], r["label"]))
        chosen = docs.sparkSession.createDataFrame(admitted, chosen.schema)
    return texts.join(F.broadcast(chosen), "_id").select("text", "label")
