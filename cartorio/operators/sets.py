"""Set operations on rows, keys and columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def schema_rows(df: DataFrame, dataset: str) -> DataFrame:
    """(dataset, column_name, kind): the frame's schema as rows."""
    rows = [(dataset, f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "dataset string, column_name string, kind string")


def column_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """(column_name, side, kind_a, kind_b) of all columns of either frame; side: both, a or b."""
    x = schema_rows(a, "a").select("column_name", F.col("kind").alias("kind_a"))
    y = schema_rows(b, "b").select("column_name", F.col("kind").alias("kind_b"))
    side = F.when(F.col("kind_a").isNotNull() & F.col("kind_b").isNotNull(), "both").when(F.col("kind_a").isNotNull(), "a").otherwise("b")
    return x.join(y, "column_name", "full").withColumn("side", side)


def type_changes(a: DataFrame, b: DataFrame) -> DataFrame:
    """(column_name, kind_a, kind_b) of columns that both have, of different types."""
    return column_diff(a, b).filter("side = 'both' and kind_a <> kind_b").select("column_name", "kind_a", "kind_b")


def common_columns(*frames: DataFrame) -> list[str]:
    return [c for c in frames[0].columns if all(c in f.columns for f in frames[1:])]


def keys_in_both(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def keys_only_in(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)
