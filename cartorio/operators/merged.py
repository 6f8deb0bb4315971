"""Profiles that are stored for each source unit and merged without reading its data again."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartorio.operators.profile import unfold

#: Least and greatest values that are kept, and the size of a sketch (2**12 registers: 1.6 % standard error).
ENDS, LG_K = 4, 12
SHAPES = (("dates", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), ("integers", "^-?[0-9]+$"), ("numbers", r"^-?[0-9]+([.,][0-9]+)?$"), ("zero_led", "^0[0-9]+$"))
COUNTS = ("n_rows", "nulls", "empties", *(n for n, _ in SHAPES))


def unit_profiles(df: DataFrame, unit: str, columns: list[str], ends: int = ENDS) -> DataFrame:
    """(unit, column_name, counts, first_values, last_values, distinct_sketch) of every source unit and column, to be stored.

    Cells are grouped by value once, with partial sums in the map tasks; counts, the sketch and both ends come from the
    different values. Ends are picked by rank, which Spark limits before its shuffle: no task gathers more than it has to.
    """
    cells = unfold(df, columns, unit).groupBy(unit, "column_name", "value").agg(F.count("*").alias("n"))
    full = F.when(F.col("value") != "", F.col("value"))
    n_if = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    sums = cells.groupBy(unit, "column_name").agg(
        F.sum("n").alias("n_rows"), n_if(F.col("value").isNull()).alias("nulls"), n_if(F.col("value") == "").alias("empties"),
        *(n_if(F.coalesce(full.rlike(p), F.lit(False))).alias(name) for name, p in SHAPES), F.hll_sketch_agg(F.concat(F.lit("="), "value"), LG_K).alias("distinct_sketch"))  # a sketch passes over empty texts
    values = cells.filter(full.isNotNull())

    def end(order: F.Column, name: str) -> DataFrame:
        w = Window.partitionBy(unit, "column_name").orderBy(order)
        picked = values.withColumn("_at", F.row_number().over(w)).filter(F.col("_at") <= ends)
        return picked.groupBy(F.col(unit).alias("_u"), F.col("column_name").alias("_c")).agg(F.array_sort(F.collect_list("value")).alias(name))

    out = sums
    for order, name in ((F.col("value").asc(), "first_values"), (F.col("value").desc(), "last_values")):
        out = out.join(end(order, name), F.col(unit).eqNullSafe(F.col("_u")) & (F.col("column_name") == F.col("_c")), "left").drop("_u", "_c")
    none = F.array().cast("array<string>")
    return out.select(unit, "column_name", *COUNTS, F.coalesce("first_values", none).alias("first_values"), F.coalesce("last_values", none).alias("last_values"), "distinct_sketch")


def merge_profiles(stored: DataFrame, ends: int = ENDS) -> DataFrame:
    """One profile a column of any stored units: rows, nulls, empty texts, about how many different values, the shares of shapes among
    non-empty values, whether a zero could be lost, and the first and last values. No data is read."""
    pool = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))  # noqa: E731  `ends` values a unit
    out = stored.groupBy("column_name").agg(*(F.sum(c).alias(c) for c in COUNTS), F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_about"),
                                            pool("first_values").alias("_first"), pool("last_values").alias("_last"))
    filled = F.col("n_rows") - F.col("nulls") - F.col("empties")
    share = lambda c: F.try_divide(F.col(c).cast("double"), filled.cast("double"))
    n = F.size("_last")
    return out.select("column_name", "n_rows", "nulls", "empties", "distinct_about", (F.col("zero_led") > 0).alias("leading_zero"), share("dates").alias("date_share"),
                      share("integers").alias("integer_share"), share("numbers").alias("numeric_share"), F.slice("_first", 1, ends).alias("first_values"),
                      F.when(n > ends, F.slice("_last", n - ends + 1, ends)).otherwise(F.col("_last")).alias("last_values"))


def value_ends(df: DataFrame, columns: list[str], ends: int = ENDS) -> DataFrame:
    """(column_name, first_values, last_values): exactly the least and greatest different non-empty values of each column."""
    one = unit_profiles(df.withColumn("_unit", F.lit(1)), "_unit", columns, ends)
    return one.select("column_name", "first_values", "last_values")
