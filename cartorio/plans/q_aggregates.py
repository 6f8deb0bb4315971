"""Aggregates, profiles and quality checks over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.functions import codes as C
from cartorio.operators import aggregates as A
from cartorio.operators import profile as P
from cartorio.operators import sync
from cartorio.plans.registry import query, table


def _lines(spark: SparkSession, sf: str, place: bool = True) -> DataFrame:
    """Dose lines: vaccine = brand, dose = return flag, doses = quantity, uf = nation of the customer, year of shipping.
    place: with the uf, which takes two more joins."""
    if not place:
        l, p = table(spark, sf, "lineitem"), table(spark, sf, "part").select("p_partkey", "p_brand")
        return l.join(p, l["l_partkey"] == p["p_partkey"]).select(F.col("p_brand").alias("vaccine"), F.col("l_returnflag").alias("dose"), F.col("l_quantity").cast("bigint").alias("doses"),
                                                                  F.year("l_shipdate").alias("year"))
    l, p = table(spark, sf, "lineitem"), table(spark, sf, "part").select("p_partkey", "p_brand")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return (l.join(p, l["l_partkey"] == p["p_partkey"]).join(o, l["l_orderkey"] == o["o_orderkey"]).join(c, o["o_custkey"] == c["c_custkey"])
            .select(F.col("p_brand").alias("vaccine"), F.col("l_returnflag").alias("dose"), F.col("l_quantity").cast("bigint").alias("doses"),
                    F.col("c_nationkey").alias("uf"), F.year("l_shipdate").alias("year")))


LINES_SQL = """
lines as (
  select p_brand as vaccine, l_returnflag as dose, cast(l_quantity as bigint) as doses, c_nationkey as uf, year(l_shipdate) as year
  from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey)"""


def _population(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("uf")).agg((F.count("*") * 100).alias("population"))


@query("select l_returnflag, l_linestatus, count(*) as n from lineitem group by 1, 2")
def count_by(spark: SparkSession, sf: str) -> DataFrame:
    return A.count_by(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


@query("select l_returnflag, cast(sum(cast(l_quantity as bigint)) as bigint) as total from lineitem group by 1")
def weighted_sum(spark: SparkSession, sf: str) -> DataFrame:
    """the measure is text."""
    l = table(spark, sf, "lineitem").select("l_returnflag", F.col("l_quantity").cast("bigint").cast("string").alias("qt_dose"))
    return A.weighted_sum(l, ["l_returnflag"], "qt_dose")


@query("""select event_type, round(avg(case when event_id % 4 <> 0 then value end), 6) as mean, count(case when event_id % 4 <> 0 then value end) as n from events group by 1""")
def mean_skip_null(spark: SparkSession, sf: str) -> DataFrame:
    out = A.mean_of(table(spark, sf, "events"), ["event_type"], F.when(F.col("event_id") % 4 != 0, F.col("value")))
    return out.withColumn("mean", F.round("mean", 6))


@query("select strftime(min(o_orderdate), '%Y-%m-%d') as least, strftime(max(o_orderdate), '%Y-%m-%d') as most from orders")
def min_max(spark: SparkSession, sf: str) -> DataFrame:
    return A.extremes(table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("d")), "d")


@query("select distinct p_brand, p_type from part where p_size % 5 <> 0")
def distinct_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """code and label pairs without nulls."""
    p = table(spark, sf, "part").select("p_brand", F.when(F.col("p_size") % 5 != 0, F.col("p_type")).alias("p_type"))
    return A.distinct_pairs(p, "p_brand", "p_type")


@query("""
select distinct 'l_returnflag' as column_name, l_returnflag as value from lineitem union select distinct 'l_linestatus', l_linestatus from lineitem
""")
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    return A.distinct_values(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("select p_brand, count(*) as n from part group by 1 order by n desc, p_brand limit 5")
def topk(spark: SparkSession, sf: str) -> DataFrame:
    return A.top_k(table(spark, sf, "part"), "p_brand", 5)


@query(f"""
with {LINES_SQL}, pop as (select c_nationkey as uf, count(*) * 100 as population from customer group by 1)
select l.uf, population, doses, round(doses * 100.0 / population, 6) as coverage_pct
from (select uf, cast(sum(doses) as bigint) as doses from lines where dose = 'A' group by 1) l left join pop on l.uf = pop.uf
""")
def coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Doses over population."""
    from cartorio.operators.joins import with_denominator

    given = _lines(spark, sf).filter("dose = 'A'").groupBy("uf").agg(F.sum("doses").alias("doses"))
    out = with_denominator(given, _population(spark, sf), ["uf"])
    return out.withColumn("coverage_pct", F.round(A.percent(F.col("doses"), F.col("population")), 6))


#: Components: the first brands stand in for vaccines that share one.
COMPONENTS = [("HB", "Brand#1", "A"), ("HB", "Brand#2", "A"), ("HB", "Brand#3", "A"), ("POLIO", "Brand#2", "R"), ("POLIO", "Brand#4", "R"), ("BCG", "Brand#5", "N")]
COMPONENTS_SQL = "components(indicator, vaccine, dose) as (values " + ", ".join(str(c) for c in COMPONENTS) + ")"


def _components(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COMPONENTS, "indicator string, vaccine string, dose string")


@query(f"""with {LINES_SQL}, {COMPONENTS_SQL}
select indicator, year::bigint as year, cast(sum(doses) as bigint) as doses from lines join components using (vaccine, dose) group by 1, 2""")
def composite(spark: SparkSession, sf: str) -> DataFrame:
    """Doses of all vaccines with the same component."""
    return A.composite(_lines(spark, sf, place=False), _components(spark), "vaccine", "dose", "doses", ["year"]).withColumn("year", F.col("year").cast("bigint"))


@query(f"""with {LINES_SQL}
select vaccine, f as first_doses, l as last_doses, round((f - l) * 100.0 / nullif(f, 0), 6) as dropout_pct
from (select vaccine, cast(sum(doses) filter (dose = 'A') as bigint) as f, cast(sum(doses) filter (dose = 'R') as bigint) as l from lines group by 1)""")
def dropout(spark: SparkSession, sf: str) -> DataFrame:
    return A.dropout(_lines(spark, sf, place=False), ["vaccine"], "dose", "doses", ("A",), ("R",)).withColumn("dropout_pct", F.round("dropout_pct", 6))


@query("""
select c_nationkey, m::bigint as month, round(n * 1.0 / 12 * m, 6)::double as target
from (select c_nationkey, count(*) as n, unnest(range(1, 13)) as m from customer group by 1)
""")
def target_cumulative(spark: SparkSession, sf: str) -> DataFrame:
    """a twelfth of the year's population for each month begun."""
    pop = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    months = pop.select("c_nationkey", "n", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("m"))
    return months.select("c_nationkey", F.col("m").cast("bigint").alias("month"), F.round(A.cumulative_target(F.col("n").cast("double"), F.col("m")), 6).alias("target"))


@query(f"""with {LINES_SQL}, pop as (select c_nationkey as uf, count(*) * 100 as population from customer group by 1)
select l.uf, cast(sum(doses) as double) * 100 / population >= 95.0 as attained from lines l join pop on l.uf = pop.uf where dose = 'N' group by l.uf, population""")
def target_attained(spark: SparkSession, sf: str) -> DataFrame:
    given = _lines(spark, sf).filter("dose = 'N'").groupBy("uf").agg(F.sum("doses").alias("doses"))
    return given.join(_population(spark, sf), "uf").select("uf", A.attained(A.percent(F.col("doses"), F.col("population")), F.lit(95.0)).alias("attained"))


PROFILE_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]


def _order_texts(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return C.all_to_string(o.select("o_orderkey", F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("o_custkey"),
                                    F.when(F.col("o_orderkey") % 10 != 0, F.when(F.col("o_orderkey") % 10 == 1, "").otherwise(F.col("o_orderstatus"))).alias("o_orderstatus"),
                                    F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority"))


ORDER_TEXTS_SQL = """texts as (
  select o_orderkey::varchar as o_orderkey, lpad(o_custkey::varchar, 6, '0') as o_custkey,
    case when o_orderkey % 10 = 0 then null when o_orderkey % 10 = 1 then '' else o_orderstatus end as o_orderstatus,
    strftime(o_orderdate, '%Y-%m-%d') as o_orderdate, o_orderpriority from orders),
cells as (""" + " union all ".join(f"select '{c}' as column_name, {c} as value from texts" for c in PROFILE_COLUMNS) + "),\n" + r"""prof as (
  select column_name, count(*) as n_rows, count(*) filter (value is null) as nulls, count(*) filter (value = '') as empties, count(distinct value) as distinct_values,
    coalesce(bool_or(regexp_matches(value, '^0[0-9]+$')) filter (value <> ''), false) as leading_zero,
    round(avg(regexp_matches(value, '^[0-9]{4}-[0-9]{2}-[0-9]{2}')::int) filter (value <> ''), 6) as date_share,
    round(avg(regexp_matches(value, '^-?[0-9]+$')::int) filter (value <> ''), 6) as integer_share,
    round(avg(regexp_matches(value, '^-?[0-9]+([.,][0-9]+)?$')::int) filter (value <> ''), 6) as numeric_share,
    min(value) filter (value <> '') as least, max(value) filter (value <> '') as greatest
  from cells group by 1)"""


@query(f"with {ORDER_TEXTS_SQL} select * from prof")
def profile(spark: SparkSession, sf: str) -> DataFrame:
    out = P.profile(_order_texts(spark, sf), PROFILE_COLUMNS)
    return out.withColumns({c: F.round(c, 6) for c in ("date_share", "integer_share", "numeric_share")})


@query(f"""with {ORDER_TEXTS_SQL}
select column_name, case when date_share >= 0.99 then 'date' when leading_zero then 'string' when integer_share >= 0.99 then 'integer' when numeric_share >= 0.99 then 'decimal'
  else 'string' end as suggestion from prof""")
def type_suggest(spark: SparkSession, sf: str) -> DataFrame:
    return P.suggest_type(P.profile(_order_texts(spark, sf), PROFILE_COLUMNS)).select("column_name", "suggestion")


@query("""
select cast(min(length(c)) as bigint) as least, cast(max(length(c)) as bigint) as most, round(avg(length(c)), 6) as mean, count(*) filter (length(c) < 6) as shorter
from (select o_custkey::varchar || case when o_orderkey % 2 = 0 then '.00' else '' end as c from orders)
""")
def code_length(spark: SparkSession, sf: str) -> DataFrame:
    c = F.concat(F.col("o_custkey").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, ".00").otherwise(""))
    return P.code_length(table(spark, sf, "orders").select(c.alias("c")), "c").select(
        F.col("least").cast("bigint").alias("least"), F.col("most").cast("bigint").alias("most"), F.round("mean", 6).alias("mean"), "shorter")


@query("""
select count(*) filter (o_orderkey % 2 = 0) as float_suffix, count(*) filter (o_orderkey % 3 = 0) as leading_zero from orders
""")
def float_suffix(spark: SparkSession, sf: str) -> DataFrame:
    c = F.concat(F.when(F.col("o_orderkey") % 3 == 0, "0").otherwise("1"), F.col("o_custkey").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, ".0").otherwise(""))
    return P.suffix_counts(table(spark, sf, "orders").select(c.alias("c")), "c")


@query(f"""with {ORDER_TEXTS_SQL}
select column_name, count(distinct value) as distinct_values, count(*) filter (value is null) as nulls, round(count(*) filter (value is null) * 100.0 / count(*), 6) as null_pct
from cells group by 1""")
def null_pct(spark: SparkSession, sf: str) -> DataFrame:
    return P.null_share(_order_texts(spark, sf), PROFILE_COLUMNS).withColumn("null_pct", F.round(F.col("null_pct").cast("double"), 6))


@query("""
with a as (select o_orderstatus as key, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as v from orders group by 1)
select key, v as parts, v as whole, 0.0::double as difference from a
""")
def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """the sum over customers' nations against the sum over orders."""
    money = F.col("o_totalprice").cast("decimal(18,2)")
    o = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("key"), money.alias("m"), "o_custkey")
    parts = o.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("key", "c_nationkey").agg(F.sum("m").alias("m"))
    return A.reconcile(parts, o, ["key"], "m").select("key", *(F.col(c).cast("double").alias(c) for c in ("parts", "whole", "difference")))


@query("""
select o_orderstatus, count(*) as ours, count(*) + count(*) // 500 as theirs, count(*) // 500 <= (count(*) + count(*) // 500) * 0.001 as agrees from orders group by 1
""")
def count_agreement(spark: SparkSession, sf: str) -> DataFrame:
    """Within a thousandth of the source's count."""
    o = table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("ours"))
    o = o.withColumn("theirs", F.col("ours") + F.floor(F.col("ours") / 500))
    return o.withColumn("agrees", A.agrees(F.col("ours"), F.col("theirs")))


@query("""
select l_orderkey, l_linenumber, abs(round(l_quantity * 100.0 / (l_orderkey % 7 + 1), 2) + case when l_orderkey % 5 = 0 then 1 else 0 end - l_quantity * 100.0 / (l_orderkey % 7 + 1)) > 0.01 as differs
from lineitem
""")
def recompute_check(spark: SparkSession, sf: str) -> DataFrame:
    """stored rates against rates computed again."""
    pop = F.col("l_orderkey") % 7 + 1
    l = table(spark, sf, "lineitem").withColumn("pop", pop)
    stored = F.round(F.col("l_quantity") * 100.0 / F.col("pop"), 2) + F.when(F.col("l_orderkey") % 5 == 0, 1).otherwise(0)
    return A.recomputed(l, "l_quantity", "pop", stored).select("l_orderkey", "l_linenumber", "differs")


@query("""select text, lang, count(*) as copies from documents group by 1, 2 having count(*) > 1""")
def dup_ignoring(spark: SparkSession, sf: str) -> DataFrame:
    """documents that are equal but for id, source and length."""
    return A.duplicates_ignoring(table(spark, sf, "documents"), ["doc_id", "source", "n_chars"])


@query("select user_id, count(*) as n from events group by 1 having count(*) >= 3")
def three_plus(spark: SparkSession, sf: str) -> DataFrame:
    return A.with_many(table(spark, sf, "events"), "user_id")


@query("select count(*) as combinations from (select distinct p_brand, p_type from part)")
def combo_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return A.combinations(table(spark, sf, "part"), ["p_brand", "p_type"])


@query("""
select unnest(['page_id', 'size']) as column_name, (select count(*) from pages) - unnest([0, (select count(*) from pages where page_id % 5 = 0)]) as equal,
  unnest([0, (select count(*) from pages where page_id % 5 = 0)]) as different, unnest([0, (select count(*) from pages where page_id % 5 = 0)]) as float_suffix,
  0::bigint as lost_zero
""")
def format_compare(spark: SparkSession, sf: str) -> DataFrame:
    """One table in two encodings, field by field."""
    p = table(spark, sf, "pages").select("page_id", F.octet_length("html").cast("string").alias("size")).withColumn("id", F.col("page_id").cast("string"))
    a = p.select("page_id", F.struct("id", "size").alias("x")).select("page_id", F.col("x.id").alias("key"), F.col("x.size").alias("size"))
    b = a.withColumn("size", F.when(F.col("page_id") % 5 == 0, F.concat("size", F.lit(".0"))).otherwise(F.col("size")))
    out = P.compare_formats(a.withColumnRenamed("page_id", "_k").withColumnRenamed("key", "page_id"), b.withColumnRenamed("page_id", "_k").withColumnRenamed("key", "page_id"),
                            "_k", ["page_id", "size"])
    return out


@query("""select 'text' as column_name, count(*) filter (doc_id % 4 = 0) as misdecoded from documents""")
def encoding_check(spark: SparkSession, sf: str) -> DataFrame:
    """UTF-8 read as Latin-1 shows, in the whole texts as they are; each fourth document also gets a planted case."""
    planted = F.when(F.col("doc_id") % 4 == 0, F.decode(F.encode(F.lit("é"), "UTF-8"), "ISO-8859-1")).otherwise("")
    d = table(spark, sf, "documents").select(F.concat(F.coalesce("text", F.lit("")), planted).alias("text"))
    return P.misdecoded(d, ["text"])


@query("""
select case when o_orderkey % 8 = 0 then 'year' when o_orderkey % 8 = 1 then 'state' when o_orderkey % 8 = 2 then 'month' else 'valid' end as outcome, count(*) as n from orders group by 1
""")
def reject_account(spark: SparkSession, sf: str) -> DataFrame:
    """Every row read is valid, or rejected for one reason."""
    k = F.col("o_orderkey") % 8
    d = F.date_format("o_orderdate", "yyyy-MM-dd")
    o = table(spark, sf, "orders").select(F.when(k == 0, "19").when(k == 2, F.substring(d, 1, 4)).otherwise(d).alias("d"), F.when(k == 1, "SPX").otherwise("SP").alias("uf"))
    return sync.account(C.derive_keys(o, "d", "uf"), C.key_reject())


@query("""select o_orderstatus, strftime(o_orderdate, '%Y-%m') as month, count(*) as n from orders group by 1, 2""")
def rows_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """rows by state and month."""
    return A.count_by(table(spark, sf, "orders").select("o_orderstatus", F.date_format("o_orderdate", "yyyy-MM").alias("month")), "o_orderstatus", "month")


@query("""
select round(cast(count(*) filter (o_orderstatus = 'F') as double) * (select count(*) from customer) / (count(distinct o_custkey) filter (o_orderstatus = 'F')), 6) as expected from orders
""")
def extrapolate(spark: SparkSession, sf: str) -> DataFrame:
    """a state's volume carried to all units."""
    o = table(spark, sf, "orders").filter("o_orderstatus = 'F'").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("u"))
    c = table(spark, sf, "customer").agg(F.count("*").alias("all_units"))
    return o.crossJoin(c).select(F.round(A.extrapolate(F.col("n"), F.col("u"), F.col("all_units")), 6).alias("expected"))


@query("""
select case when o_orderkey % 2 = 0 then 'DPNI' else 'RD' end as kind, cast(year(o_orderdate) as bigint) as year_value, count(*) as n from orders group by 1, 2
""")
def files_by_type(spark: SparkSession, sf: str) -> DataFrame:
    """file names counted by type and year."""
    y = F.year("o_orderdate")
    name = F.when(F.col("o_orderkey") % 2 == 0, C.file_name("DPNI", F.lit("SP"), y)).otherwise(C.file_name("RD", F.lit("SP"), y, F.month("o_orderdate")))
    p = table(spark, sf, "orders").select(C.parse_file_name(name).alias("p")).select("p.kind", F.col("p.year").cast("bigint").alias("year_value"))
    return A.count_by(p, "kind", "year_value")


@query("""select count(*) as files, cast(sum(o_orderkey) as bigint) as n_rows, cast(sum(o_custkey) as bigint) as size_bytes from orders""")
def grand_total(spark: SparkSession, sf: str) -> DataFrame:
    return A.totals(table(spark, sf, "orders"), [], "o_custkey", "o_orderkey")


@query("""select strftime(o_orderdate, '%Y') as part, count(*) as files, cast(sum(o_orderkey) as bigint) as n_rows, cast(sum(o_custkey) as bigint) as size_bytes from orders group by 1""")
def partition_totals(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumn("part", F.date_format("o_orderdate", "yyyy"))
    return A.totals(o, ["part"], "o_custkey", "o_orderkey")


@query("""select strftime(o_orderdate, '%Y') as year, count(*) as files, cast(sum(o_custkey) as bigint) as n_rows, max(o_orderkey % 113) as most_columns from orders group by 1""")
def ledger_summary(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy").alias("year"), "o_custkey", (F.col("o_orderkey") % 113).alias("c"))
    return A.ledger_summary(o, "year", "o_custkey", "c")
