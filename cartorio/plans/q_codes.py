"""Projections, casts, codes, dates and filters over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.functions import codes as C
from cartorio.functions import dates as D
from cartorio.operators import filters
from cartorio.plans.registry import query, table
from cartorio.schemas import BIRTH_CONTROL, BIRTH_RENAMES


@query("""
select case when substr(d, 1, 4) between '1996' and '2000' then substr(d, 1, 4) else '_invalid' end as p_ano, substr(d, 6, 2) as p_mes, uf as p_uf,
  count(*) as n
from (select strftime(o_orderdate, '%Y-%m-%d') as d, substr(o_orderpriority, 3, 2) as uf from orders)
group by 1, 2, 3
""")
def keys_derive(spark: SparkSession, sf: str) -> DataFrame:
    """Keys from a date as text; years outside the bounds are quarantined, not lost."""
    o = C.all_to_string(table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d"), F.substring("o_orderpriority", 3, 2).alias("uf")))
    k = C.drop_unkeyed(C.derive_keys(o, "d", "uf"))
    return k.withColumn("p_ano", C.quarantine_year(F.col("p_ano"), "1996", "2000")).groupBy("p_ano", "p_mes", "p_uf").agg(F.count("*").alias("n"))


@query("""
select o_orderkey, strftime(o_orderdate, '%Y%m%d') as ymd, case when o_orderkey % 7 = 0 then 'bad' || (o_orderkey % 10)::varchar else strftime(o_orderdate, '%d%m%Y') end as flipped
from orders
""")
def date_flip(spark: SparkSession, sf: str) -> DataFrame:
    """Eight digits flip, anything else stays."""
    o = table(spark, sf, "orders").withColumn("ymd", F.date_format("o_orderdate", "yyyyMMdd"))
    given = F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("bad"), (F.col("o_orderkey") % 10).cast("string"))).otherwise(F.col("ymd"))
    return o.select("o_orderkey", "ymd", D.flip_date(given).alias("flipped"))


@query("""
select o_orderkey, case when o_orderkey % 5 = 4 then null else strftime(o_orderdate, '%Y-%m-%d') end as parsed from orders
""")
def date_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Four spellings by era, and zero dates, which are null."""
    o, d, k = table(spark, sf, "orders"), F.col("o_orderdate"), F.col("o_orderkey") % 5
    text = (F.when(k == 0, F.date_format(d, "yyyy-MM-dd'T'00:00:00.000'Z'")).when(k == 1, F.date_format(d, "yyyyMMdd"))
            .when(k == 2, F.date_format(d, "ddMMyyyy")).when(k == 3, F.date_format(d, "yyMMdd")).otherwise("00000000"))
    o = o.withColumn("t", text)
    out = (F.when(k == 0, D.parse_date(F.col("t"), "iso")).when(k == 2, D.parse_date(F.col("t"), "dmy")).when(k == 3, D.parse_date(F.col("t"), "short"))
           .otherwise(D.parse_date(F.col("t"), "ymd")))
    return o.select("o_orderkey", out.cast("string").alias("parsed"))


@query("""
select o_orderkey, case when o_orderkey % 4 = 3 then o_orderstatus end as kept from orders
""")
def sentinel_null(spark: SparkSession, sf: str) -> DataFrame:
    """Marks that stand for nothing become null."""
    k = F.col("o_orderkey") % 4
    given = F.when(k == 0, "").when(k == 1, "NA").when(k == 2, "0001-01-01").otherwise(F.col("o_orderstatus"))
    return table(spark, sf, "orders").select("o_orderkey", C.null_if(given, *D.ZERO_DATES).alias("kept"))


@query("""
select c_custkey, lpad((120000 + c_custkey)::varchar, 6, '0') as code6 from customer
""")
def municipality6(spark: SparkSession, sf: str) -> DataFrame:
    """Seven digits lose the check digit, six stay."""
    six = (F.lit(120000) + F.col("c_custkey")).cast("string")
    given = F.when(F.col("c_custkey") % 2 == 0, F.concat(six, (F.col("c_custkey") % 10).cast("string"))).otherwise(six)
    return table(spark, sf, "customer").select("c_custkey", C.municipality6(F.when(F.length(given) <= 7, given).otherwise(six)).alias("code6"))


@query("""
select l_returnflag, round(avg(case when (l_orderkey + l_linenumber) % 11 = 0 then null else cast(cast(l_extendedprice as decimal(18,2)) as double) end), 6) as mean_value, count(*) as n
from lineitem group by 1
""")
def decimal_comma(spark: SparkSession, sf: str) -> DataFrame:
    """C11: comma and point decimals as numbers; what is none is null."""
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    k = F.col("l_orderkey") + F.col("l_linenumber")
    text = F.when(k % 11 == 0, "n/d").when(k % 2 == 0, F.replace(price, F.lit("."), F.lit(","))).otherwise(price)
    return (table(spark, sf, "lineitem").groupBy("l_returnflag")
            .agg(F.round(F.avg(C.decimal_comma(text)), 6).alias("mean_value"), F.count("*").alias("n")))


@query("""select c_custkey, lpad(c_nationkey::varchar, 2, '0') as code from customer""")
def code_repair(spark: SparkSession, sf: str) -> DataFrame:
    """A float suffix goes, lost zeros come back."""
    n = F.col("c_nationkey").cast("string")
    given = F.when(F.col("c_custkey") % 3 == 0, F.concat(n, F.lit(".0"))).otherwise(n)
    return table(spark, sf, "customer").select("c_custkey", C.repair_code(given, 2).alias("code"))


@query("""
select c_custkey, case when c_custkey % 100 >= 92 then 1900 + c_custkey % 100 else 2000 + c_custkey % 100 end as year_value, lpad((c_custkey % 100)::varchar, 2, '0') as yy from customer
""")
def year_pivot(spark: SparkSession, sf: str) -> DataFrame:
    """Two-digit years and back."""
    yy = F.lpad((F.col("c_custkey") % 100).cast("string"), 2, "0")
    year = C.four_digit_year(yy)
    return table(spark, sf, "customer").select("c_custkey", year.cast("bigint").alias("year_value"), C.two_digit_year(year.cast("string")).alias("yy"))


@query("""
with a as (select cast(floor(value) as integer) + 50 as code from events),
b as (select code, case when code between 100 and 499 then code // 100 else 0 end as unit, code % 100 as rest from a),
c as (select unit, case unit when 1 then 0 when 2 then rest // 30 when 3 then rest when 4 then rest * 12 end as months from b)
select cast(unit as bigint) as unit,
  case when months < 1 then 'menor_1_mes' when months < 12 then 'menor_1_ano' when months < 24 then '1_ano' when months < 36 then '2_anos' when months < 48 then '3_anos'
    when months < 60 then '4_anos' when months < 84 then '5_6_anos' when months < 144 then '7_11_anos' when months < 180 then '12_14_anos' when months < 600 then '15_49_anos'
    when months < 720 then '50_59_anos' when months is not null then '60_anos_e_mais' end as band, count(*) as n
from c group by 1, 2
""")
def age_decode_band(spark: SparkSession, sf: str) -> DataFrame:
    """Age codes to months and bands, counted by unit."""
    code = (F.floor("value") + 50).cast("string")
    e = table(spark, sf, "events").select(C.age_unit(code).cast("bigint").alias("unit"), C.age_band(C.age_months(code)).alias("band"))
    return e.groupBy("unit", "band").agg(F.count("*").alias("n"))


@query("""
select o_orderkey, case o_orderkey % 4 when 0 then 'DPNI' when 1 then 'CPNI' when 2 then 'DN' else 'RD' end as kind, 'AC' as uf, cast(year(o_orderdate) as bigint) as year_value,
  case when o_orderkey % 4 = 3 then cast(month(o_orderdate) as bigint) end as month_value
from orders
""")
def filename_parse(spark: SparkSession, sf: str) -> DataFrame:
    """C17: publisher file names, built and read."""
    y, m, k, uf = F.year("o_orderdate"), F.month("o_orderdate"), F.col("o_orderkey") % 4, F.lit("AC")
    name = (F.when(k == 0, C.file_name("DPNI", uf, y)).when(k == 1, C.file_name("CPNI", uf, y)).when(k == 2, C.file_name("DN", uf, y)).otherwise(C.file_name("RD", uf, y, m)))
    p = table(spark, sf, "orders").select("o_orderkey", C.parse_file_name(name).alias("p"))
    return p.select("o_orderkey", "p.kind", "p.uf", F.col("p.year").cast("bigint").alias("year_value"), F.col("p.month").cast("bigint").alias("month_value"))


@query("""select o_orderkey, strftime(o_orderdate, '%Y') as p_ano, strftime(o_orderdate, '%m') as p_mes, o_orderstatus as p_uf from orders""")
def path_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys out of object paths."""
    d = F.col("o_orderdate")
    path = F.concat(F.lit("root/ano="), F.date_format(d, "yyyy"), F.lit("/mes="), F.date_format(d, "MM"), F.lit("/uf="), F.col("o_orderstatus"), F.lit("/part-0.parquet"))
    return table(spark, sf, "orders").select("o_orderkey", *(C.path_key(path, k).alias(f"p_{k}") for k in ("ano", "mes", "uf")))


@query("""
select strftime(o_orderdate, '%Y-%m') || '-' || o_orderstatus as key, strftime(o_orderdate, '%m') as part2, count(*) as n from orders group by 1, 2
""")
def partition_key_text(spark: SparkSession, sf: str) -> DataFrame:
    """Partition keys as text, and split again."""
    key = C.partition_key(F.date_format("o_orderdate", "yyyy"), F.date_format("o_orderdate", "MM"), F.col("o_orderstatus"))
    o = table(spark, sf, "orders").select(key.alias("key"))
    return o.groupBy("key", C.split_partition_key(F.col("key"))[1].alias("part2")).agg(F.count("*").alias("n"))


@query("""
select p_partkey, case when s >= 1000000000 then ((s + 50000000) // 1000000000) || '.' || ((s + 50000000) // 100000000 % 10) || ' GB'
  when s >= 1000000 then ((s + 50000) // 1000000) || '.' || ((s + 50000) // 100000 % 10) || ' MB'
  when s >= 1000 then ((s + 50) // 1000) || '.' || ((s + 50) // 100 % 10) || ' KB' else s::varchar || ' B' end as size_text
from (select p_partkey, p_partkey * p_partkey * p_partkey * (p_size + 1) as s from part)
""")
def size_format(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes in decimal units; a cube of keys outgrows 64 bits beyond some 560,000 parts."""
    k = F.col("p_partkey").cast("decimal(38,0)")
    s = k * k * k * (F.col("p_size") + 1)
    return table(spark, sf, "part").select("p_partkey", C.size_text(s).alias("size_text"))


@query("""
select p_partkey, 'Source has ' || format('{:,}', p_partkey * 1000) || ' records' as note from part
""")
def note_text(spark: SparkSession, sf: str) -> DataFrame:
    """Notes with thousands separators."""
    return table(spark, sf, "part").select("p_partkey", F.concat(F.lit("Source has "), C.thousands(F.col("p_partkey") * 1000), F.lit(" records")).alias("note"))


@query("""select doc_id, sha256(text) as sha256, md5(text) as md5 from documents""")
def digest(spark: SparkSession, sf: str) -> DataFrame:
    """Content digests."""
    return table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), F.md5("text").alias("md5"))


@query("""
select event_id, case when event_id % 9 = 0 then '—' else strftime(ts, '%Y-%m-%d %H:%M') || ' UTC' end as stamp from events
""")
def timestamp_text(spark: SparkSession, sf: str) -> DataFrame:
    """C20: time stamps as text, a dash for none."""
    return table(spark, sf, "events").select("event_id", D.stamp_text(F.when(F.col("event_id") % 9 != 0, F.col("ts"))).alias("stamp"))


@query("""
with v as (
  select o_custkey as unit, o_orderkey % 3 as variant, bool_or(o_orderstatus = 'F') as present from orders group by 1, 2)
select unit, coalesce(min(variant) filter (present), min(variant)) as variant, bool_or(present) as present from v group by unit
""")
def variant_pick(spark: SparkSession, sf: str) -> DataFrame:
    """The first of several name variants that exists."""
    v = (table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("unit"), (F.col("o_orderkey") % 3).alias("variant"))
         .agg(F.bool_or(F.col("o_orderstatus") == "F").alias("present")))
    return C.first_present(v, "unit", "variant", "present")


@query("""
select cast(l_returnflag as varchar) as flag, cast(sum(cast(l_quantity as bigint)) as bigint) as total from lineitem group by 1
""")
def typed_sum(spark: SparkSession, sf: str) -> DataFrame:
    """Text typed at query time."""
    t = C.all_to_string(table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_quantity").cast("bigint").alias("q")))
    return t.groupBy("flag").agg(F.sum(C.number(F.col("q"))).alias("total"))


@query("""select cast(n_nationkey as varchar) as n_nationkey, n_name, cast(n_regionkey as varchar) as n_regionkey from nation""")
def all_string(spark: SparkSession, sf: str) -> DataFrame:
    return C.all_to_string(table(spark, sf, "nation"))


@query("""select s_suppkey, s_name from supplier""")
def lower_names(spark: SparkSession, sf: str) -> DataFrame:
    """Column names to lower case."""
    return C.lower_names(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("S_SUPPKEY"), F.col("s_name").alias("S_Name")))


@query("""select o_orderkey as "NUMERODN", o_orderstatus as "SEXO", o_orderpriority as "PARTO" from orders""")
def rename_drop(spark: SparkSession, sf: str) -> DataFrame:
    """Names of an old era to today's, absent ones passed over, control fields dropped."""
    old = table(spark, sf, "orders").select(F.col("o_orderkey").alias("CODIGO"), F.col("o_orderstatus").alias("SEXO"), F.col("o_orderpriority").alias("TIPO_PARTO"),
                                            F.lit("x").alias("CRITICA"))
    return C.drop_any(C.rename_map(old, BIRTH_RENAMES), BIRTH_CONTROL)


@query("""
select year(l_shipdate)::bigint as year_value, case when year(l_shipdate) >= 2001 then 2 when year(l_shipdate) >= 1996 then 2 else 1 end::bigint as births_era,
  (case when year(l_shipdate) >= 1994 then 1 else 0 end + case when year(l_shipdate) >= 2004 then 1 else 0 end)::bigint as doses_era, count(*) as n
from lineitem group by 1, 2, 3
""")
def era_label(spark: SparkSession, sf: str) -> DataFrame:
    """The era of a year."""
    y = F.year("l_shipdate")
    return (table(spark, sf, "lineitem").groupBy(y.cast("bigint").alias("year_value"), C.era("births", y).cast("bigint").alias("births_era"),
                                                 C.era("doses", y).cast("bigint").alias("doses_era")).agg(F.count("*").alias("n")))


@query("""select doc_id, n_chars from documents where regexp_matches(text, 'lic[a-z]+ under')""")
def pattern_filter(spark: SparkSession, sf: str) -> DataFrame:
    return filters.matching(table(spark, sf, "documents"), "text", "lic[a-z]+ under").select("doc_id", "n_chars")


@query("""select o_orderpriority, count(*) as n from orders where o_orderpriority in ('1-URGENT', '2-HIGH', '5-LOW') group by 1""")
def exclude_consolidated(spark: SparkSession, sf: str) -> DataFrame:
    """D3: listed units only."""
    return filters.states_only(table(spark, sf, "orders"), "o_orderpriority", ("1-URGENT", "2-HIGH", "5-LOW")).groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("""
select o_orderkey from orders where o_orderstatus <> 'P' and o_orderkey % 6 <> 0
""")
def valid_only(spark: SparkSession, sf: str) -> DataFrame:
    """Records neither entered in error nor deleted."""
    o = table(spark, sf, "orders").withColumn("deleted", F.when(F.col("o_orderkey") % 6 == 0, "2024-01-01").when(F.col("o_orderkey") % 6 == 1, "0001-01-01"))
    return filters.valid_records(o, "o_orderstatus", "deleted", wrong="P").select("o_orderkey")


@query("""select event_type, count(*) as n from events where event_type not in ('error', 'signup') group by 1""")
def code_exclusion(spark: SparkSession, sf: str) -> DataFrame:
    return filters.without_codes(table(spark, sf, "events"), "event_type", ("error", "signup")).groupBy("event_type").agg(F.count("*").alias("n"))


@query("""select count(*) filter (o_orderkey % 3 = 0 or o_orderkey % 3 = 1) as blanks, count(*) filter (o_orderkey % 3 <> 0) as complete from orders""")
def null_predicates(spark: SparkSession, sf: str) -> DataFrame:
    """Blank values, and rows without nulls."""
    k = F.col("o_orderkey") % 3
    o = table(spark, sf, "orders").select(F.when(k == 1, "").when(k == 2, F.col("o_orderstatus")).alias("c"))
    return o.agg(F.count_if(filters.blank("c")).alias("blanks")).crossJoin(filters.complete(o, ["c"]).agg(F.count("*").alias("complete")))


@query("""select page_id from pages where strlen(html) > 500""")
def threshold(spark: SparkSession, sf: str) -> DataFrame:
    """Sources large enough to hold anything."""
    return filters.present(table(spark, sf, "pages").withColumn("size", F.octet_length("html")), "size").select("page_id")


@query("""select o_orderstatus, count(*) as n from orders where o_orderstatus in ('F', 'O') group by 1""")
def status_filter(spark: SparkSession, sf: str) -> DataFrame:
    return filters.with_status(table(spark, sf, "orders"), "F", "O", column="o_orderstatus").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("""
select p_brand, cast(sum(cast(l_quantity as bigint)) as bigint) as doses from lineitem join part on l_partkey = p_partkey
where p_brand in ('Brand#1', 'Brand#2', 'Brand#11') and l_returnflag in ('A', 'R') and p_size * 6 >= 12 and p_size * 6 < 144 group by 1
""")
def numerator(spark: SparkSession, sf: str) -> DataFrame:
    """Doses by vaccine, dose and age."""
    j = table(spark, sf, "lineitem").join(table(spark, sf, "part").withColumn("months", F.col("p_size") * 6), F.col("l_partkey") == F.col("p_partkey"))
    hit = filters.numerator("p_brand", ("Brand#1", "Brand#2", "Brand#11"), "l_returnflag", ("A", "R"), "months", 12, 144)
    return j.filter(hit).groupBy("p_brand").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("doses"))
