"""The corpus pipeline: each stage calls one operator of the llm subpackage on all that the stage before kept.

Toxic documents go; repeated line windows go from the texts; of each near-duplicate class the least id stays;
contaminated documents go; what is left is packed into bins.

All stages take null, empty and very long texts, ties, repeated rows, rows without an id, no rows at all, and further columns of any
name, which all but the last pass on as they are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.llm import decontam, line_dedup, ngram_join, packing, toxicity
from cartorio.llm.frames import load
from cartorio.session import checkpoint_folder, ship


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more by a model of the labelled ones go; null and empty texts stay."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, load(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; n_chars follows the text. Rows that repeat an id count as one place, and those without one stay whole."""
    out = line_dedup.dedup_lines(docs)
    n_removed = out.columns[-1]
    return out.withColumn("n_chars", F.when(F.col(n_removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class, that of the least id; rows without an id or without words stay, and rows that repeat the least id too."""
    gone = ngram_join.join(docs).filter("class_id <> doc_id").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth of the words stands in benchmark windows go; rows without an id stay."""
    gone = decontam.decontaminate(docs, load(spark, sf_dir, "benchmark")).filter("contaminated").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each text and its bin; texts without words have one row without a bin, repeated rows one each."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_bins),
]

#: The classifier and the class search aren't SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each result is written to the shared folder and read again."""
    ship(spark)
    docs = load(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
