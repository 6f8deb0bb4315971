"""Counts, coverage, composite indicators, dropout and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartorio.functions.codes import number


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def weighted_sum(df: DataFrame, keys: list[str], measure: str, kind: str = "bigint") -> DataFrame:
    """Sum of a measure kept as text; what is no number counts as null."""
    return df.groupBy(*keys).agg(F.sum(number(F.col(measure), kind)).alias("total"))


def mean_of(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))


def percent(numerator: Column, denominator: Column) -> Column:
    """Coverage: null where the denominator is null or zero."""
    return F.try_divide(numerator.cast("double") * 100.0, denominator.cast("double"))


def composite(doses: DataFrame, components: DataFrame, vaccine: str, dose: str, measure: str, keys: list[str]) -> DataFrame:
    """Doses of all vaccines with the same component, for each indicator: `components` has (indicator, vaccine, dose)."""
    from cartorio.operators.joins import small

    return doses.join(small(components), [vaccine, dose]).groupBy("indicator", *keys).agg(F.sum(measure).alias("doses"))


def dropout(df: DataFrame, keys: list[str], dose: str, measure: str, first: tuple, last: tuple) -> DataFrame:
    """(first - last) / first x 100, with both sums."""
    given = lambda codes: F.sum(F.when(F.col(dose).isin(*codes), F.col(measure)))
    out = df.groupBy(*keys).agg(given(first).alias("first_doses"), given(last).alias("last_doses"))
    return out.withColumn("dropout_pct", percent(F.col("first_doses") - F.col("last_doses"), F.col("first_doses")))


def dropout_by_rules(df: DataFrame, rules: DataFrame, vaccine: str, dose: str, year: str, measure: str, keys: list[str]) -> DataFrame:
    """Dropout of every indicator in its years: rules has (indicator, first_dose, last_dose, year_from, year_to)."""
    from cartorio.operators.joins import small

    inside = (F.col(year) >= F.col("year_from")) & (F.col("year_to").isNull() | (F.col(year) <= F.col("year_to")))
    joined = df.join(small(rules), F.col(vaccine) == F.col("indicator")).filter(inside)
    given = lambda which: F.sum(F.when(F.col(dose) == F.col(which), F.col(measure)))
    out = joined.groupBy("indicator", *keys).agg(given("first_dose").alias("first_doses"), given("last_dose").alias("last_doses"))
    return out.withColumn("dropout_pct", percent(F.col("first_doses") - F.col("last_doses"), F.col("first_doses")))


def cumulative_target(annual: Column, months: Column) -> Column:
    return annual / 12.0 * months


def attained(coverage: Column, target: Column) -> Column:
    return F.when(coverage.isNotNull() & target.isNotNull(), coverage >= target)


def distinct_pairs(df: DataFrame, code: str, label: str) -> DataFrame:
    return df.dropna(subset=[code, label]).select(code, label).distinct()


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value) of all columns in one pass."""
    return df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns))).alias("v")).select("v.*").distinct()


def top_k(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values, ties by value."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(k)


def extremes(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("least"), F.max(column).alias("most"))


def reconcile(parts: DataFrame, whole: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Sum of the parts against the whole for each key, with the difference; a side without the key counts 0."""
    a = parts.groupBy(*keys).agg(F.sum(measure).alias("parts"))
    b = whole.groupBy(*keys).agg(F.sum(measure).alias("whole"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return a.join(b, keys, "full").withColumns({"parts": zero("parts"), "whole": zero("whole")}).withColumn("difference", F.col("parts") - F.col("whole"))


def recomputed(df: DataFrame, numerator: str, denominator: str, stored: Column, tolerance: float = 0.01) -> DataFrame:
    """The rate computed again, and whether the stored one differs by more than the tolerance."""
    again = percent(F.col(numerator), F.col(denominator))
    return df.withColumn("again", again).withColumn("differs", ~F.coalesce(F.abs(again - stored) <= tolerance, again.isNull() & stored.isNull(), F.lit(False)))


def agrees(ours: Column, theirs: Column, share: float = 0.001) -> Column:
    """Counts within a share of the source's."""
    return F.abs(ours - theirs) <= theirs * share


def duplicates_ignoring(df: DataFrame, ignored: list[str]) -> DataFrame:
    """Groups of rows that are equal but for the ignored columns, with their size."""
    return df.groupBy(*(c for c in df.columns if c not in ignored)).agg(F.count("*").alias("copies")).filter("copies > 1")


def drop_duplicates_ignoring(df: DataFrame, ignored: list[str]) -> DataFrame:
    return df.dropDuplicates([c for c in df.columns if c not in ignored])


def with_many(df: DataFrame, key: str, least: int = 3) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def combinations(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(F.count_distinct(F.struct(*columns)).alias("combinations"))


def extrapolate(sample_rows: Column, sample_units: Column, all_units: Column) -> Column:
    return F.try_divide(sample_rows.cast("double") * all_units, sample_units.cast("double"))


def ledger_summary(ledger: DataFrame, year: str, rows: str, columns: str) -> DataFrame:
    return ledger.groupBy(year).agg(F.count("*").alias("files"), F.sum(rows).alias("n_rows"), F.max(columns).alias("most_columns"))


def totals(df: DataFrame, keys: list[str], size: str, rows: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("files"), F.sum(rows).alias("n_rows"), F.sum(size).alias("size_bytes"))
