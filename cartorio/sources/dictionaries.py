"""Code dictionaries: fixed-width text files, and a tolerant reading of freer ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    text = F.decode(F.col("content"), encoding)
    return (spark.read.format("binaryFile").load(path).select("path", F.posexplode(F.split(text, "\r?\n")).alias("line_no", "line"))
            .filter(F.trim("line") != ""))


def read_code_dictionary(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """(path, line_no, code, label, source_codes, declared) of files whose header is `N WIDTH` and whose lines are 5
    blanks, a code of that width, 2 blanks, a label and, after the last gap of two blanks or more, the source codes."""
    lines = _lines(spark, path, encoding)
    head = (lines.filter("line_no = 0").select("path", F.regexp_extract("line", r"^\s*(\d+)\s+(\d+)", 1).cast("int").alias("declared"),
                                                F.regexp_extract("line", r"^\s*(\d+)\s+(\d+)", 2).cast("int").alias("width")))
    body = lines.filter("line_no > 0").join(head, "path")
    rest = F.trim(F.expr("substring(line, 6 + width)"))
    gap = r"^(.*\S)\s{2,}(\S+)$"
    return body.select("path", "line_no", F.trim(F.expr("substring(line, 6, width)")).alias("code"),
                       F.when(rest.rlike(gap), F.regexp_extract(rest, gap, 1)).otherwise(rest).alias("label"),
                       F.when(rest.rlike(gap), F.regexp_extract(rest, gap, 2)).alias("source_codes"), "declared")


def count_faults(dictionary: DataFrame) -> DataFrame:
    """Files whose header states another number of rows than they have."""
    return dictionary.groupBy("path", "declared").agg(F.count("*").alias("found")).filter("declared <> found")


def read_loose_dictionary(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """(path, line_no, code, label) by the first of three shapes that fits: code first; a flag, then a short code; code
    last. What fits none has the code ???."""
    line = F.rtrim("line")
    # The three shapes.
    shapes = ((r"^\s*(\d+)\s*[,;]?\s*(.+)$", 1, 2), (r"^.(\s*\d{1,3})\s*(.+)$", 1, 2), (r"^(.+?)\s+(\d{1,4})\s*$", 2, 1))
    code = F.coalesce(*(F.when(line.rlike(p), F.trim(F.regexp_extract(line, p, c))) for p, c, _ in shapes), F.lit("???"))
    label = F.coalesce(*(F.when(line.rlike(p), F.trim(F.regexp_extract(line, p, t))) for p, _, t in shapes), F.trim(line))
    return _lines(spark, path, encoding).filter("line_no > 0").select("path", "line_no", code.alias("code"), label.alias("label"))
