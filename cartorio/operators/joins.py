"""Decoding, crosswalks, grids and rule-table joins. Dictionaries and rules are broadcast only when they are small."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartorio.operators.ranges import in_periods

#: A dimension of at most so many rows is broadcast; a larger one is left to Spark's own choice.
SMALL = 10_000


def small(df: DataFrame, most: int = SMALL) -> DataFrame:
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def expand_codes(dictionary: DataFrame, label: str = "label", codes: str = "source_codes", order: str = "line_no") -> DataFrame:
    """(source_code, label), one label a code. The list is comma separated and may hold ranges (11-31), which widen to
    codes of the lower bound's width. A single code beats a range, and then the dictionary's order decides."""
    item = dictionary.select(F.col(label).alias("label"), F.col(order).alias("_order"), F.explode(F.split(F.col(codes), ",")).alias("_item")).withColumn("_item", F.trim("_item")).filter("_item <> ''")
    span = r"^(\d+)\s*[-–]\s*(\d+)$"
    low, high = F.regexp_extract("_item", span, 1), F.regexp_extract("_item", span, 2)
    is_range = F.col("_item").rlike(span)
    numbers = F.when(is_range, F.sequence(low.try_cast("int"), F.greatest(low.try_cast("int"), high.try_cast("int"))))
    each = F.when(is_range, F.transform(numbers, lambda n: F.lpad(n.cast("string"), F.length(low), "0"))).otherwise(F.array("_item"))
    w = Window.partitionBy("source_code").orderBy("_range", "_order", "label")
    return (item.select("label", "_order", is_range.cast("int").alias("_range"), F.explode(each).alias("source_code"))
            .withColumn("_n", F.row_number().over(w)).filter("_n = 1").select("source_code", "label"))


def ambiguous_codes(dictionary: DataFrame, label: str = "label", codes: str = "source_codes") -> DataFrame:
    """Codes that stand singly under several labels: to be reported."""
    item = dictionary.select(F.col(label).alias("label"), F.explode(F.split(F.col(codes), ",")).alias("source_code")).withColumn("source_code", F.trim("source_code"))
    return item.groupBy("source_code").agg(F.count_distinct("label").alias("labels")).filter("labels > 1")


def decode(df: DataFrame, dictionary: DataFrame, column: str, label: str = "label", codes: str = "source_codes", order: str = "line_no",
           into: str = "label") -> DataFrame:
    """Every row once, with its code's label, or null where the dictionary has none."""
    d = expand_codes(dictionary, label, codes, order).select(F.col("source_code").alias("_code"), F.col("label").alias(into))
    return df.join(small(d), F.col(column) == F.col("_code"), "left").drop("_code")


def with_denominator(numerators: DataFrame, population: DataFrame, keys: list[str]) -> DataFrame:
    """Every numerator once, with its population or null."""
    return numerators.join(population, keys, "left")


def crosswalk(df: DataFrame, bridge: DataFrame, column: str, bridge_column: str) -> DataFrame:
    """Many-to-many by a bridge table: a row comes once for each indicator it counts for."""
    return df.join(small(bridge), F.col(column) == F.col(bridge_column)).drop(bridge_column)


def grid(spark, years: tuple[int, int], units: DataFrame, months: bool = False) -> DataFrame:
    """Expected units: every year (and month) with every row of `units`, a list of states."""
    df = spark.range(1).select(F.explode(F.sequence(F.lit(years[0]), F.lit(years[1]))).alias("year"))
    if months:
        df = df.select("year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    return units.crossJoin(F.broadcast(df))


def missing(expected: DataFrame, have: DataFrame, keys: list[str]) -> DataFrame:
    """Expected units that aren't there: to be reported, never explained away."""
    return expected.join(have, keys, "left_anti")


def unprocessed(files: DataFrame, ledger: DataFrame, name: str = "unit") -> DataFrame:
    return files.join(ledger.select(name), name, "left_anti")


def attach_files(ledger: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Ledger rows with their output files as an array; an empty one where there are none."""
    own = files.groupBy(key).agg(F.sort_array(F.collect_list("path")).alias("files"))
    return ledger.join(own, key, "left").withColumn("files", F.coalesce("files", F.array().cast("array<string>")))


def cross_check(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """All keys of either side with where they are: both, left or right."""
    a, b = left.select(*keys).distinct().withColumn("_l", F.lit(True)), right.select(*keys).distinct().withColumn("_r", F.lit(True))
    side = F.when(F.col("_l") & F.col("_r"), "both").when(F.col("_l"), "left").otherwise("right")
    return a.join(b, keys, "full").withColumn("side", side).drop("_l", "_r")


def lookup_year(df: DataFrame, rules: DataFrame, births: DataFrame, year: str = "year", group: str = "age_group", states: str = "state_group", uf: str = "uf") -> DataFrame:
    """Denominators by rule: the rule gives each (year, age group, state group) its source year, whose births count."""
    r = rules.select(F.col(year).alias(year), group, states, "source", "source_year")
    b = births.select(F.col(year).alias("source_year"), uf, "births")
    return df.join(small(r), [year, group, states], "left").join(b, ["source_year", uf], "left")


def valid_rules(df: DataFrame, rules: DataFrame, value: str, low: str, high: str) -> DataFrame:
    """Every row with each rule whose period [low, high] holds its value; a null bound is open. Values and bounds are of any
    type that sorts. A few rules are broadcast; more go through `ranges.in_periods`, with the same result."""
    if rules.limit(SMALL + 1).count() > SMALL:
        return in_periods(df, rules, value, low, high)
    inside = (F.col(low).isNull() | (F.col(value) >= F.col(low))) & (F.col(high).isNull() | (F.col(value) <= F.col(high)))
    return df.join(F.broadcast(rules), inside & F.col(value).isNotNull())


def by_place_and_year(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Systems side by side by place and year; what one lacks is null. Frames are aggregated to the keys beforehand."""
    out, *rest = frames
    for f in rest:
        out = out.join(f, keys, "full")
    return out
