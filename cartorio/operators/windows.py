"""Series, running sums, ranks and drift between years."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartorio.operators.aggregates import cumulative_target
from cartorio.operators.joins import small


def enter_leave(df: DataFrame, code: str, year: str) -> DataFrame:
    """(year, code, change) of codes that enter or leave between two years that follow each other in the data."""
    seen = df.select(F.col(code).alias("code"), F.col(year).alias("year")).distinct()
    years = seen.select("year").distinct()
    # The list of years is short; its own window numbers them.
    ranked = years.withColumn("n", F.row_number().over(Window.orderBy("year")))
    ranked = small(ranked)
    has = seen.join(ranked, "year")
    own, other = has.select("code", "n"), has.select("code", (F.col("n") + 1).alias("n"))
    last = ranked.agg(F.max("n").alias("last"))
    entered = own.join(other, ["code", "n"], "left_anti").filter("n > 1").withColumn("change", F.lit("enters"))
    left = other.join(own, ["code", "n"], "left_anti").crossJoin(F.broadcast(last)).filter("n <= last").drop("last").withColumn("change", F.lit("leaves"))
    return entered.unionByName(left).join(ranked, "n").select("year", "code", "change")


def presence(df: DataFrame, code: str, year: str, years: list) -> DataFrame:
    """One row a code, one column a year: X where the code occurs, else a dot."""
    marked = df.groupBy(code).pivot(year, years).agg(F.when(F.count(F.lit(1)) > 0, "X"))
    return marked.select(code, *(F.coalesce(F.col(f"`{y}`"), F.lit(".")).alias(f"y{y}") for y in years))


def transitions(df: DataFrame, order: str, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Rows (one a year) of which some column differs from the row before, with both values' names in `changed`."""
    w = Window.partitionBy(*(by or [])).orderBy(order)
    before = {c: F.lag(c).over(w) for c in columns}
    first = F.row_number().over(w) == 1
    changed = F.array_compact(F.array(*(F.when(~F.col(c).eqNullSafe(b), F.lit(c)) for c, b in before.items())))
    return (df.withColumn("_first", first).withColumn("changed", changed).filter("not _first and size(changed) > 0").drop("_first"))


def series(old: DataFrame, new: DataFrame, year: str, break_year: int, tags: tuple[str, str] = ("aggregated", "microdata")) -> DataFrame:
    """One series of two sources: the old one before the break year, the new one from it on; each row tells its source,
    and the break year is marked, not smoothed."""
    a = old.filter(F.col(year) < break_year).withColumn("source", F.lit(tags[0]))
    b = new.filter(F.col(year) >= break_year).withColumn("source", F.lit(tags[1]))
    return a.unionByName(b, allowMissingColumns=True).withColumn("series_break", F.col(year) == break_year)


def running_sum(df: DataFrame, by: list[str], order: str, measure: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("running", F.sum(measure).over(w))


def running_against_target(df: DataFrame, by: list[str], month: str, measure: str, annual: str) -> DataFrame:
    """Running sums of the year beside the target that the months so far add up to, and whether it's reached: the
    preliminary coverage of a year that isn't over. `annual` has the year's target population."""
    out = running_sum(df, by, month, measure).withColumn("target", cumulative_target(F.col(annual).cast("double"), F.col(month)))
    return out.withColumn("reached", F.col("running") >= F.col("target"))


def latest(df: DataFrame, unit: list[str], order: list[str]) -> DataFrame:
    """The last row of each unit by the given order."""
    w = Window.partitionBy(*unit).orderBy(*(F.col(c).desc_nulls_last() for c in order))
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def ranked(df: DataFrame, keys: list[str], measure: str | None = None) -> DataFrame:
    """Keys by volume, with their rank: one more than the keys of larger volume. The window runs over the different
    volumes, which are far fewer than keys."""
    out = df.groupBy(*keys).agg((F.sum(measure) if measure else F.count("*")).alias("volume"))
    above = F.coalesce(F.sum("n").over(Window.orderBy(F.desc("v")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = out.groupBy(F.col("volume").alias("v")).agg(F.count("*").alias("n")).withColumn("place", above + 1)
    return out.join(places, F.col("volume").eqNullSafe(F.col("v"))).select(*keys, "volume", "place")


def grains(df: DataFrame, date: str, measure: str) -> DataFrame:
    """Sums by month and by year and in all: null marks the coarser grain."""
    return (df.select(F.year(date).alias("year"), F.month(date).alias("month"), F.col(measure).alias("_m")).rollup("year", "month")
            .agg(F.sum("_m").alias("total"), F.count("*").alias("n")))


def grain_levels(df: DataFrame, date: str, measure: str) -> DataFrame:
    """Sums by day, month, year and in all. `level` tells the grain (0 day, 1 month, 3 year, 7 all), so that rows without a
    date stay apart from totals."""
    return (df.select(F.year(date).alias("year"), F.month(date).alias("month"), F.dayofmonth(date).alias("day"), F.col(measure).alias("_m")).rollup("year", "month", "day")
            .agg(F.sum("_m").alias("total"), F.count("*").alias("n"), F.grouping_id().cast("bigint").alias("level")))


def previous(df: DataFrame, by: list[str], order: str, value: str, into: str = "previous") -> DataFrame:
    return df.withColumn(into, F.lag(value).over(Window.partitionBy(*by).orderBy(order)))
