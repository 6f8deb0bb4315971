"""Joins of values with periods, of any type that sorts: bounds are numbered, periods cut into nodes of a binary tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartorio.session import materialised


def numbered(values: DataFrame, bounds: DataFrame) -> tuple[DataFrame, int]:
    """((value, place), places) of all distinct values and bounds, single columns of one type: the k-th bound has place
    2k - 1, and what lies between two bounds the even place between theirs.

    Sorted by range over all tasks; each counts the bounds in its own part, and the counts of the parts before, a row for each
    part, say where it begins.
    """
    name = values.columns[0]
    every = values.select(F.col(name).alias("value"), F.lit(0).alias("is_bound")).unionByName(bounds.select(F.col(bounds.columns[0]).alias("value"), F.lit(1).alias("is_bound")))
    once = every.filter("value is not null").groupBy("value").agg(F.max("is_bound").alias("is_bound"))
    n = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = materialised(once.repartitionByRange(n, "value").withColumn("part", F.spark_partition_id()))
    counts = parts.groupBy("part").agg(F.sum("is_bound").alias("bounds"))
    before = counts.select("part", (F.sum("bounds").over(Window.orderBy("part")) - F.col("bounds")).alias("before"))  # a row a task
    so_far = F.sum("is_bound").over(Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    place = 2 * (F.col("before") + F.col("so_far")) - F.col("is_bound")
    out = materialised(parts.withColumn("so_far", so_far).join(F.broadcast(before), "part").select("value", place.cast("long").alias("place")))
    total = counts.agg(F.sum("bounds")).first()[0] or 0
    return out, 2 * total + 1


def _at_level(place: Column, level: Column) -> Column:
    return F.call_function("shiftright", place, level)


def cover(first: Column, last: Column, height: int) -> Column:
    """The fewest nodes (level, node) of a binary tree over places that hold just first..last: two a level at most. A node of
    level h holds 2**h places."""
    def own(h: Column) -> Column:
        lo, hi = _at_level(first + F.call_function("shiftleft", F.lit(1).cast("long"), h) - 1, h), _at_level(last + 1, h)
        odd = lambda x: x.bitwiseAND(F.lit(1).cast("long")) == 1
        node = lambda test, x: F.when((lo < hi) & test, F.struct(h.cast("int").alias("level"), x.alias("node")))
        return F.array_compact(F.array(node(odd(lo), lo), node(odd(hi), hi - 1)))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(height)), own))


def in_periods(df: DataFrame, rules: DataFrame, value: str, low: str, high: str) -> DataFrame:
    """Every row of df with each rule whose period [low, high] holds its value; a null bound is open, a null value is in none.

    The periods' nodes meet the nodes above each distinct value on equal numbers, so each match is found once and nothing else is
    looked at; then rows join by value. No nested loop, whatever the type, the number of rules and how they overlap.
    """
    bounds = rules.select(F.col(low).alias("b")).unionByName(rules.select(F.col(high).alias("b")))
    places, total = numbered(df.select(value).distinct(), bounds)
    height = total.bit_length()
    own = rules.select(F.struct(*(F.col(c) for c in rules.columns)).alias("_rule"), F.col(low).alias("_low"), F.col(high).alias("_high"))
    at = lambda name: places.select(F.col("value").alias(f"_{name}"), F.col("place").alias(f"_at_{name}"))
    located = own.join(at("low"), "_low", "left").join(at("high"), "_high", "left")
    nodes = located.select("_rule", F.explode(cover(F.coalesce("_at_low", F.lit(0).cast("long")), F.coalesce("_at_high", F.lit(total - 1).cast("long")), height)).alias("n"))
    nodes = materialised(nodes.select("_rule", "n.level", "n.node"))
    levels = sorted(r[0] for r in nodes.select("level").distinct().collect())  # as many as the tree is high
    above = places.select("value", F.explode(F.array(*(F.struct(F.lit(h).alias("level"), F.shiftright("place", h).alias("node")) for h in levels))
                                             if levels else F.array().cast("array<struct<level:int,node:bigint>>")).alias("n")).select("value", "n.level", "n.node")
    held = above.join(nodes, ["level", "node"]).select(F.col("value").alias("_value"), "_rule")
    row = df.select(F.struct(*(F.col(c) for c in df.columns)).alias("_row"), F.col(value).alias("_own"))
    return row.join(held, F.col("_own") == F.col("_value")).select("_row.*", "_rule.*")
