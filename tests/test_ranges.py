"""Periods of any type, by nodes of a tree and by broadcast, against SQL and plain loops; coverage by rules."""

import datetime as dt
import random
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from cartorio import api
from cartorio.operators import joins, ranges

DAY = dt.date(2000, 1, 1)
KINDS = {
    "date": lambda k: DAY + dt.timedelta(days=k), "string": lambda k: f"k{k:05d}é", "decimal(12,3)": lambda k: Decimal(k) / 8, "bigint": lambda k: 7 * k - 300, "double": lambda k: k / 3,
    "timestamp": lambda k: dt.datetime(2001, 2, 3) + dt.timedelta(seconds=k),
}


@pytest.mark.parametrize("kind", KINDS)
def test_periods_of_any_type_on_both_sides_of_small(spark, kind, monkeypatch):
    r, of = random.Random(4), KINDS[kind]
    rules = [(i, None if r.random() < 0.1 else a, None if r.random() < 0.1 else a + r.randint(-2, 60)) for i in range(120) for a in [r.randint(0, 200)]]
    rules += [rules[0], (500, None, None), (501, 50, 50)]
    values = [(j, None if j % 17 == 0 else r.randint(-5, 270)) for j in range(150)]
    df = spark.createDataFrame([(j, None if v is None else of(v)) for j, v in values], f"j int, v {kind}").repartition(3)
    table = spark.createDataFrame([(i, *(None if b is None else of(b) for b in ab)) for i, *ab in rules], f"i int, a {kind}, b {kind}").repartition(3)
    want = sorted((j, i) for j, v in values for i, a, b in rules if v is not None and (a is None or v >= a) and (b is None or v <= b))
    for small in (10_000, 5):
        monkeypatch.setattr(joins, "SMALL", small)
        out = joins.valid_rules(df, table, "v", "a", "b")
        assert out.columns == ["j", "v", "i", "a", "b"] and sorted((x["j"], x["i"]) for x in out.collect()) == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_rules_no_values_and_only_open_ones(spark):
    df, none = spark.createDataFrame([(1, 5)], "j int, v int"), spark.createDataFrame([], "i int, a int, b int")
    assert ranges.in_periods(df, none, "v", "a", "b").count() == 0
    assert ranges.in_periods(df.limit(0), spark.createDataFrame([(1, 1, 9)], none.schema), "v", "a", "b").count() == 0
    assert ranges.in_periods(df, spark.createDataFrame([(1, None, None)], none.schema), "v", "a", "b").count() == 1


def test_fifty_thousand_overlapping_periods_as_sql(spark):
    r = random.Random(8)
    rows = [(i, a, a + r.randint(0, 40)) for i in range(50_000) for a in [r.randint(0, 9000)]]
    rules = spark.createDataFrame(rows, "i int, a int, b int").select("i", F.date_add(F.lit(DAY), "a").alias("a"), F.date_add(F.lit(DAY), "b").alias("b"))
    df = spark.range(9000).select(F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("d"))
    got = joins.valid_rules(df, rules, "d", "a", "b").groupBy("d").agg(F.count("*").alias("n"), F.sum("i").alias("s")).toPandas()
    con = duckdb.connect()
    con.register("rules", rules.toPandas())
    want = con.sql("select d::date as d, count(*) as n, sum(i)::bigint as s from (select date '2000-01-01' + i::int as d from range(9000) t(i)) join rules on d between a::date and b::date group by 1").fetchall()
    assert sorted(map(tuple, got.itertuples(index=False))) == sorted((d if isinstance(d, dt.date) else d.date(), n, s) for d, n, s in want)


def test_nodes_cover_just_their_places(spark):
    pairs = [(a, b) for a in range(11) for b in range(11)]
    out = spark.createDataFrame(pairs, "a bigint, b bigint").select("a", "b", ranges.cover(F.col("a"), F.col("b"), 4).alias("n")).collect()
    for r in out:
        held = [p for n in r["n"] for p in range(n["node"] << n["level"], (n["node"] + 1) << n["level"])]
        assert held == sorted(set(held)) or len(held) == len(set(held))
        assert sorted(held) == list(range(r["a"], r["b"] + 1)) and len(r["n"]) <= 8


def series_of(spark, rows):
    return spark.createDataFrame(rows, "year int, uf string, vaccine string, dose string, doses bigint")


def test_coverage_counts_a_dose_once_and_only_in_its_periods(spark):
    old = series_of(spark, [(1990, "AC", "HB", "D3", 7), (1995, "AC", "HB", "D3", 50), (2000, "AC", "HB", "D3", 40)])
    components = spark.createDataFrame([("Hepatitis B", "HB", "D3", 1994, 1999), ("Hepatitis B", "HB", "D3", 1994, None), ("Hepatitis B", "HB", "D3", 2000, None)],
                                       "indicator string, vaccine string, dose string, year_from int, year_to int")
    population = spark.createDataFrame([(y, "AC", 100) for y in (1990, 1995, 2000)], "year int, uf string, population bigint")
    out = api.coverage_series(old, old.limit(0), population, components, "Hepatitis B").collect()
    assert sorted((r["year"], r["doses"], r["coverage_pct"]) for r in out) == [(1995, 50, 50.0), (2000, 40, 40.0)]
    timeless = api.coverage_series(old, old.limit(0), population, components.select("indicator", "vaccine", "dose"), "Hepatitis B").collect()
    assert {r["year"]: r["doses"] for r in timeless} == {1990: 7, 1995: 50, 2000: 40}


def test_coverage_takes_each_states_denominator_by_its_rule(spark):
    from cartorio import rules

    new = series_of(spark, [(y, u, "MMR", "D1", 30) for y in (2003, 2012, 2021) for u in ("AC", "AL")])
    components = spark.createDataFrame([("MMR D1", "MMR", "D1")], "indicator string, vaccine string, dose string")
    births = spark.createDataFrame([(y, u, 10 * (y - 2000) + (u == "AL")) for y in range(2000, 2022) for u in ("AC", "AL")], "year int, uf string, births bigint")
    people = spark.createDataFrame([(y, u, "1", 1000) for y in (2003, 2012, 2021) for u in ("AC", "AL")] + [(2003, "AC", "<1", 5)], "year int, uf string, age_group string, population bigint")
    states = rules.state_groups(spark).filter("uf in ('AC', 'AL')")
    how = {"break_year": 1990, "rules": rules.denominators(spark), "births": births, "states": states, "age_group": "1"}
    got = {r["year"]: (r["denominator"], r["denominator_source"]) for r in api.coverage_series(new, new, people, components, "MMR D1", **how).collect()}
    # 2003: births of 2002 in group B, population in group A; 2012: births of the frozen year; 2021: no rule
    assert got == {2003: (20 + 1000, "births+population"), 2012: (90 + 91, "births"), 2021: (2000, "population")}
    one = api.coverage_series(new, new, people, components, "MMR D1", uf="AL", **how).collect()
    assert {r["year"]: (r["doses"], r["denominator"]) for r in one} == {2003: (30, 1000), 2012: (30, 91), 2021: (30, 2000 // 2)}
