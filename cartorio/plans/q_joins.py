"""Joins, decoding, grids and set operations over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio import rules
from cartorio.operators import joins as J
from cartorio.operators import sets
from cartorio.operators.ranges import in_periods
from cartorio.plans.q_aggregates import LINES_SQL, _lines
from cartorio.plans.registry import folder, query, table
from cartorio.sinks import write_partitioned
from cartorio.sources.files import first_n, scan


def _dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """Regions as labels, each with the comma list of its even nation keys."""
    n = table(spark, sf, "nation").filter("n_nationkey % 2 = 0").groupBy("n_regionkey").agg(F.array_join(F.sort_array(F.collect_list(F.col("n_nationkey").cast("string"))), ",").alias("source_codes"))
    return (table(spark, sf, "region").join(n, F.col("r_regionkey") == F.col("n_regionkey"))
            .select(F.col("r_name").alias("label"), "source_codes", F.col("r_regionkey").alias("line_no")))


@query("""
select c_custkey, r_name as label from customer left join nation on c_nationkey = n_nationkey and n_nationkey % 2 = 0 left join region on n_regionkey = r_regionkey
""")
def decode_left(spark: SparkSession, sf: str) -> DataFrame:
    """Labels by a dictionary with many codes a label; unmatched codes stay."""
    c = table(spark, sf, "customer").withColumn("code", F.col("c_nationkey").cast("string"))
    return J.decode(c, _dictionary(spark, sf), "code").select("c_custkey", "label")


@query("""
select c_custkey, case when c_nationkey % 2 = 0 and c_nationkey >= 10 then r_name when c_nationkey between 10 and 17 then 'RANGE' when c_nationkey % 2 = 0 then r_name end as label
from customer left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey
""")
def decode_guard(spark: SparkSession, sf: str) -> DataFrame:
    """A range that overlaps single codes never multiplies rows; the single code wins."""
    wide = spark.createDataFrame([("RANGE", "10-17", -1)], "label string, source_codes string, line_no int")
    c = table(spark, sf, "customer").withColumn("code", F.col("c_nationkey").cast("string"))
    return J.decode(c, _dictionary(spark, sf).unionByName(wide), "code").select("c_custkey", "label")


@query("""
with births as (select year(o_orderdate) as y, c_nationkey as uf, count(*) as births from orders join customer on o_custkey = c_custkey group by 1, 2)
select d.y::bigint as year, d.uf, g as age_group, case when g = '<1' then d.y else d.y - 1 end::bigint as source_year, b.births
from (select distinct y, uf, unnest(['<1', '1']) as g from births) d left join births b on b.uf = d.uf and b.y = case when g = '<1' then d.y else d.y - 1 end
""")
def denominator_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Births of the same year for those under one, of the year before for those of one."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    births = o.groupBy(F.year("o_orderdate").cast("bigint").alias("year"), F.col("c_nationkey").alias("uf")).agg(F.count("*").alias("births"))
    wanted = births.select("year", "uf", F.explode(F.array(F.lit("<1"), F.lit("1"))).alias("age_group"), F.lit("B").alias("state_group"))
    years = births.select("year").distinct()
    by_age = years.select("year", F.explode(F.array(F.lit("<1"), F.lit("1"))).alias("age_group"), F.lit("B").alias("state_group"), F.lit("SINASC").alias("source"))
    by_age = by_age.withColumn("source_year", F.when(F.col("age_group") == "<1", F.col("year")).otherwise(F.col("year") - 1))
    return J.lookup_year(wanted, by_age, births).select("year", "uf", "age_group", "source_year", "births")


@query("""
with births as (select year(o_orderdate) as y, c_nationkey as uf, count(*) as births from orders join customer on o_custkey = c_custkey group by 1, 2),
w as (select y, uf, case when uf % 2 = 0 then 'A' else 'B' end as state_group, unnest(['<1', '1']) as age_group from births),
s as (select *, case when y >= 2006 or (y >= 2000 and state_group = 'B') then case when age_group = '<1' then y else greatest(y - 1, 2000) end else y end as source_year,
  case when y >= 2006 or (y >= 2000 and state_group = 'B') then 'SINASC' else 'IBGE' end as source from w)
select s.y::bigint as year, s.uf, age_group, state_group, source, source_year::bigint as source_year, b.births from s left join births b on b.y = s.source_year and b.uf = s.uf
""")
def denominator_eras(spark: SparkSession, sf: str) -> DataFrame:
    """The published rules by year, age and state group."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    births = o.groupBy(F.year("o_orderdate").alias("year"), F.col("c_nationkey").alias("uf")).agg(F.count("*").alias("births"))
    wanted = births.select("year", "uf", F.when(F.col("uf") % 2 == 0, "A").otherwise("B").alias("state_group"), F.explode(F.array(F.lit("<1"), F.lit("1"))).alias("age_group"))
    out = J.lookup_year(wanted, rules.denominators(spark), births)
    return out.select(F.col("year").cast("bigint").alias("year"), "uf", "age_group", "state_group", "source", F.col("source_year").cast("bigint").alias("source_year"), "births")


@query("""
select year(o_orderdate)::bigint as year, o_orderpriority from orders where year(o_orderdate) = 1996 and o_orderpriority = '1-URGENT' group by 1, 2
""")
def known_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """E5: of the missing years and states, those without any published data; MG lacks 1996 only from then on."""
    o = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(F.year("o_orderdate").alias("year"), "o_orderpriority", F.lit("MG").alias("uf")).distinct()
    gaps = rules.no_data(spark).filter("year = 1996")
    return o.join(gaps, ["year", "uf"], "left_semi").select(F.col("year").cast("bigint").alias("year"), "o_orderpriority")


#: Fixed values of the documents: indicators with their target share and period.
RULES = [("BCG", 90.0, 1994, None), ("Rotavirus", 90.0, 2006, None), ("DTP", 95.0, 1994, 2002), ("Hib", 95.0, 1999, 2002), ("Tetra", 95.0, 2003, 2012), ("MMR D1", 95.0, 2000, None)]


@query("""
with rules(indicator, target, a, b) as (values """ + ", ".join(f"('{i}', {t}, {a}, {b if b else 'null'})" for i, t, a, b in RULES) + """)
select y::bigint as year, indicator, target::double as target, n from (select year(o_orderdate) as y, count(*) as n from orders group by 1)
join rules on y >= a and (b is null or y <= b)
""")
def rule_validity(spark: SparkSession, sf: str) -> DataFrame:
    """Every year with the rules in force."""
    years = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    in_force = spark.createDataFrame(RULES, "indicator string, target double, a int, b int")
    return J.valid_rules(years, in_force, "year", "a", "b").select(F.col("year").cast("bigint").alias("year"), "indicator", "target", "n")


@query("""
with bands(band, a, b) as (values ('child', 0, 11), ('young', 12, 19), ('adult', 20, 59))
select band, count(*) as n from part join bands on p_size between a and b group by 1
""")
def age_band_join(spark: SparkSession, sf: str) -> DataFrame:
    """Bands as a table."""
    bands = spark.createDataFrame([("child", 0, 11), ("young", 12, 19), ("adult", 20, 59)], "band string, a int, b int")
    return J.valid_rules(table(spark, sf, "part"), bands, "p_size", "a", "b").groupBy("band").agg(F.count("*").alias("n"))


MANY_SQL = """rules as (
  select l_orderkey as k, l_linenumber as i, l_shipdate::date as a, case when l_orderkey % 100 = 4 then null else l_shipdate::date + cast(7 + l_quantity as int) end as b from lineitem where l_linenumber % 2 = 0)"""


@query(f"""with {MANY_SQL}, days as (select o_orderdate::date as day, count(*) as n from orders group by 1)
select day, n, held, sums, longest from days join (
  select day as d, count(*) as held, cast(sum(k * 7 + i) as bigint) as sums, max(b) as longest from days join rules on day >= a and (b is null or day <= b) group by 1) on day = d""")
def rules_many(spark: SparkSession, sf: str) -> DataFrame:
    """As many overlapping periods of dates, some without end, as half of the lines, joined by nodes of a tree."""
    l = table(spark, sf, "lineitem").filter("l_linenumber % 2 = 0")
    a = F.to_date("l_shipdate")
    many = l.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("i"), a.alias("a"), F.when(F.col("l_orderkey") % 100 != 4, F.date_add(a, (7 + F.col("l_quantity")).cast("int"))).alias("b"))
    days = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    return in_periods(days, many, "day", "a", "b").groupBy("day", "n").agg(F.count("*").alias("held"), F.sum(F.col("k") * 7 + F.col("i")).cast("bigint").alias("sums"), F.max("b").alias("longest"))


@query("""
with bounds as (select s.s_name as a, t.s_name as b, s.s_suppkey from supplier s left join supplier t on t.s_suppkey = s.s_suppkey + 9)
select c_custkey, count(*) as n, cast(sum(s_suppkey) as bigint) as keys from customer join bounds on replace(c_name, 'Customer', 'Supplier') >= a and (b is null or replace(c_name, 'Customer', 'Supplier') <= b) group by 1
""")
def rules_of_text(spark: SparkSession, sf: str) -> DataFrame:
    """Periods of text, ten deep."""
    s = table(spark, sf, "supplier")
    bounds = s.select(F.col("s_name").alias("a"), "s_suppkey").join(s.select((F.col("s_suppkey") - 9).alias("s_suppkey"), F.col("s_name").alias("b")), "s_suppkey", "left")
    named = table(spark, sf, "customer").select("c_custkey", F.regexp_replace("c_name", "Customer", "Supplier").alias("name"))
    return in_periods(named, bounds, "name", "a", "b").groupBy("c_custkey").agg(F.count("*").alias("n"), F.sum("s_suppkey").cast("bigint").alias("keys"))


@query("""
with g as (select n_name as uf, y, m from nation, (select unnest(range(1995, 1998)) as y), (select unnest(range(1, 13)) as m))
select uf, count(*) as cells, cast(min(y) as bigint) as first_year, cast(max(m) as bigint) as last_month from g group by uf
""")
def grid(spark: SparkSession, sf: str) -> DataFrame:
    """States x years x months."""
    g = J.grid(spark, (1995, 1997), table(spark, sf, "nation").select(F.col("n_name").alias("uf")), months=True)
    return g.groupBy("uf").agg(F.count("*").alias("cells"), F.min("year").cast("bigint").alias("first_year"), F.max("month").cast("bigint").alias("last_month"))


@query("""
select s as uf, y::bigint as year, m::bigint as month from (select unnest(['F', 'O', 'P', 'Q']) as s), (select unnest(range(1995, 1997)) as y), (select unnest(range(1, 13)) as m)
where not exists (select 1 from orders where o_orderstatus = s and year(o_orderdate) = y and month(o_orderdate) = m and o_custkey % 2 = 0)
""")
def missing_units(spark: SparkSession, sf: str) -> DataFrame:
    """E5: expected units without any record."""
    units = spark.createDataFrame([("F",), ("O",), ("P",), ("Q",)], "uf string")
    have = table(spark, sf, "orders").filter("o_custkey % 2 = 0").select(F.col("o_orderstatus").alias("uf"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    return J.missing(J.grid(spark, (1995, 1996), units, months=True), have, ["uf", "year", "month"]).select("uf", F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"))


@query("""select cast(o_orderkey as varchar) as unit from orders where o_orderkey % 3 <> 0""")
def skip_done(spark: SparkSession, sf: str) -> DataFrame:
    """What the ledger has is left out."""
    u = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("unit"))
    return J.unprocessed(u, u.filter(F.col("unit").cast("bigint") % 3 == 0))


@query("""
select c_custkey as unit, count(o_orderkey) as n_files, coalesce(string_agg('f' || o_orderkey, ',' order by 'f' || o_orderkey), '') as paths
from customer left join orders on o_custkey = c_custkey and o_orderstatus = 'F' group by 1
""")
def attach_files(spark: SparkSession, sf: str) -> DataFrame:
    """Output files of each ledger row, none allowed."""
    ledger = table(spark, sf, "customer").select(F.col("c_custkey").alias("unit"))
    files = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("unit"), F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("path"))
    return J.attach_files(ledger, files, "unit").select("unit", F.size("files").cast("bigint").alias("n_files"), F.array_join("files", ",").alias("paths"))


@query("""
select coalesce(a.k, b.k) as k, case when a.k is not null and b.k is not null then 'both' when a.k is not null then 'left' else 'right' end as side
from (select distinct o_custkey as k from orders where o_orderstatus = 'F') a full join (select distinct o_custkey as k from orders where o_orderstatus = 'P') b on a.k = b.k
""")
def cross_check(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of two sides."""
    k = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), "o_orderstatus")
    return J.cross_check(k.filter("o_orderstatus = 'F'"), k.filter("o_orderstatus = 'P'"), ["k"])


@query(f"""with {LINES_SQL},
a as (select uf, year, cast(sum(doses) as bigint) as doses from lines group by 1, 2),
b as (select c_nationkey as uf, year(o_orderdate) as year, count(*) as births from orders join customer on o_custkey = c_custkey group by 1, 2),
c as (select s_nationkey as uf, year(l_shipdate) as year, count(*) as admissions from lineitem join supplier on l_suppkey = s_suppkey group by 1, 2)
select uf, year::bigint as year, doses, births, admissions from a full join b using (uf, year) full join c using (uf, year)""")
def cross_system(spark: SparkSession, sf: str) -> DataFrame:
    """Doses, births and admissions by place and year."""
    a = _lines(spark, sf).groupBy("uf", "year").agg(F.sum("doses").alias("doses"))
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    b = o.groupBy(F.col("c_nationkey").alias("uf"), F.year("o_orderdate").alias("year")).agg(F.count("*").alias("births"))
    s = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    c = s.groupBy(F.col("s_nationkey").alias("uf"), F.year("l_shipdate").alias("year")).agg(F.count("*").alias("admissions"))
    return J.by_place_and_year([a, b, c], ["uf", "year"]).withColumn("year", F.col("year").cast("bigint"))


@query("""
select column_name, case when o and c then 'both' when o then 'a' else 'b' end as side from (
  select column_name, bool_or(table_name = 'orders') as o, bool_or(table_name = 'renamed') as c from (
    select unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority']) as column_name, 'orders' as table_name
    union all select unnest(['o_orderkey', 'o_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment']), 'renamed') group by 1)
""")
def colset_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of two eras."""
    c = table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey").withColumn("o_orderkey", F.lit(1))
    return sets.column_diff(table(spark, sf, "orders"), c).select("column_name", "side")


@query("""
select (select count(*) from (select o_custkey from orders where o_orderstatus = 'F' intersect select o_custkey from orders where o_orderstatus = 'O')) as in_both,
  (select count(*) from (select o_custkey from orders where o_orderstatus = 'F' except select o_custkey from orders where o_orderstatus = 'O')) as only_first
""")
def keyset_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of two sets."""
    o = table(spark, sf, "orders")
    a, b = (o.filter(F.col("o_orderstatus") == s).select("o_custkey") for s in "FO")
    return sets.keys_in_both(a, b).agg(F.count("*").alias("in_both")).crossJoin(sets.keys_only_in(a, b).agg(F.count("*").alias("only_first")))


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 30")
def sorted_head(spark: SparkSession, sf: str) -> DataFrame:
    """S1, S2."""
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(30)


@query("select n_nationkey as k, n_name as name from nation union all select r_regionkey, r_name from region")
def stack(spark: SparkSession, sf: str) -> DataFrame:
    """S3: frames of one schema below each other."""
    from cartorio.sinks import stack as below

    return below(table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name")),
                 table(spark, sf, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name")))


@query("select distinct o_orderstatus, o_orderpriority from orders")
def distinct(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query("select o_orderkey, o_orderstatus from orders")
def subset_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Wanted columns that exist; the rest isn't read."""
    from cartorio.sources.files import select_present

    return select_present(table(spark, sf, "orders"), ["o_orderkey", "o_orderstatus", "no_such_column"])


@query("select o_orderkey from orders where (year(o_orderdate), o_orderstatus) in (select (1996, 'F') union select (1998, 'O'))")
def sampled_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Chosen years and states of a partitioned tree."""
    from cartorio.sources.files import sampled_scan as pick

    chosen = spark.createDataFrame([("1996", "F"), ("1998", "O")], "year string, o_orderstatus string")
    root = folder(spark)
    write_partitioned(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year")), root, ["year", "o_orderstatus"])
    return pick(scan(spark, root), chosen, ["year", "o_orderstatus"]).select("o_orderkey")


@query("select event_id, event_type from events order by event_id limit 50")
def first_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows by a unique key."""
    return first_n(table(spark, sf, "events").select("event_id", "event_type"), 50, "event_id")
