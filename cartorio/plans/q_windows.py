"""Series, windows and drift, and the user API, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio import api
from cartorio.operators import windows as W
from cartorio.plans.q_aggregates import LINES_SQL, _lines
from cartorio.plans.registry import query, table

YEARS = list(range(1995, 2003))


def _codes(spark: SparkSession, sf: str) -> DataFrame:
    """Vaccine codes by year, of which some don't occur every year."""
    l = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year"), (F.col("l_partkey") % 40).alias("code"))
    return l.filter((F.col("code") * 7 + F.col("year")) % 5 != 0)


CODES_SQL = "codes as (select distinct year(l_shipdate) as year, l_partkey % 40 as code from lineitem where ((l_partkey % 40) * 7 + year(l_shipdate)) % 5 <> 0)"


@query(f"""with {CODES_SQL},
ranked as (select year, row_number() over (order by year) as n from (select distinct year from codes)),
has as (select code, n from codes join ranked using (year))
select r.year::bigint as year, code, change from (
  select code, n, 'enters' as change from has h where n > 1 and not exists (select 1 from has p where p.code = h.code and p.n = h.n - 1)
  union all select code, n + 1, 'leaves' from has h where n < (select max(n) from ranked) and not exists (select 1 from has p where p.code = h.code and p.n = h.n + 1)) c
join ranked r on r.n = c.n""")
def codes_enter_leave(spark: SparkSession, sf: str) -> DataFrame:
    return W.enter_leave(_codes(spark, sf), "code", "year").select(F.col("year").cast("bigint").alias("year"), "code", "change")


@query(f"with {CODES_SQL} select code, " + ", ".join(f"coalesce(max('X') filter (year = {y}), '.') as y{y}" for y in YEARS) + " from codes group by code")
def presence_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Codes by years."""
    return W.presence(_codes(spark, sf), "code", "year", YEARS)


@query("""
with y as (select year(l_shipdate) as year, case when year(l_shipdate) < 1998 then 7 else 12 end as columns_n, case when year(l_shipdate) < 2000 then 7 else 6 end as code_width from lineitem group by 1)
select year::bigint as year, columns_n::bigint as columns_n, code_width::bigint as code_width, concat_ws(',', case when columns_n <> pc then 'columns_n' end, case when code_width <> pw then 'code_width' end) as changed
from (select *, lag(columns_n) over (order by year) as pc, lag(code_width) over (order by year) as pw from y) where pc is not null and (columns_n <> pc or code_width <> pw)
""")
def schema_transition(spark: SparkSession, sf: str) -> DataFrame:
    """Years whose structure differs from the year before."""
    y = F.col("year")
    t = (table(spark, sf, "lineitem").select(F.year("l_shipdate").cast("bigint").alias("year")).distinct()
         .withColumns({"columns_n": F.when(y < 1998, 7).otherwise(12).cast("bigint"), "code_width": F.when(y < 2000, 7).otherwise(6).cast("bigint")}))
    return W.transitions(t, "year", ["columns_n", "code_width"]).withColumn("changed", F.array_join("changed", ","))


@query("""
select year(o_orderdate)::bigint as year, case when year(o_orderdate) < 1998 then 'aggregated' else 'microdata' end as source, year(o_orderdate) = 1998 as series_break, count(*) as n
from orders group by 1, 2, 3
""")
def series_union(spark: SparkSession, sf: str) -> DataFrame:
    """Two sources, one series; the break is tagged."""
    o = table(spark, sf, "orders").groupBy(F.year("o_orderdate").cast("bigint").alias("year")).agg(F.count("*").alias("n"))
    return W.series(o, o, "year", 1998)


@query("""
select year, month, n, cast(sum(n) over (partition by year order by month) as bigint) as running
from (select year(o_orderdate)::bigint as year, month(o_orderdate)::bigint as month, count(*) as n from orders group by 1, 2)
""")
def running_sum(spark: SparkSession, sf: str) -> DataFrame:
    """Running doses of the year."""
    o = table(spark, sf, "orders").groupBy(F.year("o_orderdate").cast("bigint").alias("year"), F.month("o_orderdate").cast("bigint").alias("month")).agg(F.count("*").alias("n"))
    return W.running_sum(o, ["year"], "month", "n")


@query("""
select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as n from orders) where n = 1
""")
def latest_wins(spark: SparkSession, sf: str) -> DataFrame:
    """The last row of each unit."""
    return W.latest(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("""select p_brand, count(*) as volume, rank() over (order by count(*) desc) as place from part group by 1""")
def rank_volume(spark: SparkSession, sf: str) -> DataFrame:
    return W.ranked(table(spark, sf, "part"), ["p_brand"]).withColumn("place", F.col("place").cast("bigint"))


@query("""
select year(l_shipdate)::bigint as year, month(l_shipdate)::bigint as month, cast(sum(cast(l_quantity as bigint)) as bigint) as total, count(*) as n from lineitem
group by rollup (year(l_shipdate), month(l_shipdate))
""")
def grain_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Months, years and all."""
    l = table(spark, sf, "lineitem").select("l_shipdate", F.col("l_quantity").cast("bigint").alias("q"))
    return W.grains(l, "l_shipdate", "q").withColumns({c: F.col(c).cast("bigint") for c in ("year", "month")})


@query("""
select uf, year::bigint as year, births, lag(births) over (partition by uf order by year) as previous
from (select c_nationkey as uf, year(o_orderdate) as year, count(*) as births from orders join customer on o_custkey = c_custkey group by 1, 2)
""")
def prev_year(spark: SparkSession, sf: str) -> DataFrame:
    """The year before by window."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    b = o.groupBy(F.col("c_nationkey").alias("uf"), F.year("o_orderdate").cast("bigint").alias("year")).agg(F.count("*").alias("births"))
    return W.previous(b, ["uf"], "year", "births")


#: Periods of components that overlap, begin late and end early; dose codes of the old source; states by group.
PERIODS = [("HB", "Brand#1", "D3", None, 1997), ("HB", "Brand#1", "D3", 1996, None), ("HB", "Brand#2", "D3", 1998, None), ("HB", "Brand#2", "SD", None, None),
           ("HB", "Brand#3", "D3", 1994, 1996), ("BCG", "Brand#3", "D3", None, None)]
DOSE_CODES = [("D3", "A", 1), ("SD", "R,N", 2)]
#: Births of the year for half of the states from 1996 and for all from 1998, capped at 1999; population before; no rule from 2000 on.
ERAS = [(y, "<1", g, "SINASC" if y >= 1998 or (y >= 1996 and g == "B") else "IBGE", min(y, 1999)) for y in range(1994, 2000) for g in "AB"]
_sql = lambda rows: "values " + ", ".join("(" + ", ".join("null" if v is None else repr(v) for v in r) + ")" for r in rows)


@query(f"""with {LINES_SQL}, periods(indicator, vaccine, dose, a, b) as ({_sql(PERIODS)}), eras(year, age_group, state_group, source, source_year) as ({_sql(ERAS)}),
decoded as (select year, vaccine, case dose when 'A' then 'D3' else 'SD' end as dose, doses from lines where year between 1994 and 2001),
given as (
  select year, sum(doses) as doses from decoded d
  where exists (from periods p where p.indicator = 'HB' and p.vaccine = d.vaccine and p.dose = d.dose and (a is null or year >= a) and (b is null or year <= b)) group by 1),
births as (select year(o_orderdate) as year, c_nationkey as uf, count(*) as births from orders join customer on o_custkey = c_custkey group by 1, 2),
units as (select distinct given.year, n_nationkey as uf, case when n_nationkey % 2 = 0 then 'A' else 'B' end as state_group from given, nation),
by_state as (
  select u.year, case when source = 'SINASC' then births else people end as n, case when source = 'SINASC' then 'births' else 'population' end as of
  from units u left join eras e on e.year = u.year and e.state_group = u.state_group
  left join births b on b.year = e.source_year and b.uf = u.uf
  left join (select year, uf, births * 50 as people from births) p on p.year = coalesce(e.source_year, u.year) and p.uf = u.uf),
below as (select year, sum(n) as denominator, string_agg(distinct of, '+' order by of) as denominator_source from by_state where n is not null group by 1)
select given.year::bigint as year, case when given.year < 1997 then 'aggregated' else 'microdata' end as source, given.year = 1997 as series_break, cast(doses as bigint) as doses,
  cast(denominator as bigint) as denominator, denominator_source, round(doses * 100.0 / denominator, 6) as coverage_pct from given left join below on below.year = given.year""")
def api_series(spark: SparkSession, sf: str) -> DataFrame:
    """K1: an indicator's coverage over both sources, with codes decoded, components by period and denominators by era."""
    l = _lines(spark, sf)
    periods = spark.createDataFrame(PERIODS, "indicator string, vaccine string, dose string, year_from int, year_to int")
    codes = spark.createDataFrame(DOSE_CODES, "label string, source_codes string, line_no int")
    eras = spark.createDataFrame(ERAS, "year int, age_group string, state_group string, source string, source_year int")
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    births = o.groupBy(F.year("o_orderdate").alias("year"), F.col("c_nationkey").alias("uf")).agg(F.count("*").alias("births"))
    states = table(spark, sf, "nation").select(F.col("n_nationkey").alias("uf"), F.when(F.col("n_nationkey") % 2 == 0, "A").otherwise("B").alias("state_group"))
    out = api.coverage_series(l, l, births.select("year", "uf", (F.col("births") * 50).alias("population")), periods, "HB", years=(1994, 2001), break_year=1997,
                              dictionaries={"dose": codes}, rules=eras, births=births, states=states)
    return out.withColumns({"year": F.col("year").cast("bigint"), "coverage_pct": F.round("coverage_pct", 6)})


@query(f"""with {LINES_SQL}
select year::bigint as year, cast(sum(doses) as double) as doses from lines where vaccine = 'Brand#1' and uf = 7 and year between 1996 and 2001 group by 1""")
def api_doses(spark: SparkSession, sf: str) -> DataFrame:
    """K2: a vaccine's doses in one municipality, by seven digits or six."""
    l = _lines(spark, sf).withColumn("municipality", F.concat((F.lit(350000) + F.col("uf")).cast("string"), (F.col("doses") % 10).cast("string")))
    return api.doses(l, "Brand#1", "350007", (1996, 2001)).withColumn("year", F.col("year").cast("bigint"))


@query("select c_mktsegment as diagnosis, count(*) as n from customer group by 1 order by n desc, 1 limit 3")
def api_registry(spark: SparkSession, sf: str) -> DataFrame:
    """K6: the most frequent diagnoses."""
    return api.registry_counts(table(spark, sf, "customer").withColumnRenamed("c_mktsegment", "diagnosis"), "diagnosis", 3)
