"""What is kept beside the data: profiles by unit, footers, digests of buckets, and pointers that a stream of snapshots moves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio import units
from cartorio.functions import codes as C
from cartorio.operators import merged
from cartorio.operators import profile as P
from cartorio.plans.q_aggregates import ORDER_TEXTS_SQL, PROFILE_COLUMNS, _order_texts
from cartorio.plans.registry import folder, query, table
from cartorio.sources import files, footers
from cartorio.streaming import incremental

ENDS_SQL = """ends as (
  select column_name, list_slice(list_sort(list(distinct value)), 1, 4) as f, list_sort(list_slice(list_reverse_sort(list(distinct value)), 1, 4)) as l from cells where value <> '' group by 1)"""


@query(f"""with {ORDER_TEXTS_SQL}, {ENDS_SQL}
select prof.column_name, n_rows, nulls, empties, leading_zero, date_share, integer_share, numeric_share, array_to_string(f, '|') as first_values, array_to_string(l, '|') as last_values,
  true as about_right from prof join ends using (column_name)""")
def profile_merged(spark: SparkSession, sf: str) -> DataFrame:
    """profiles stored by month, merged without the data; different values within 5 % of the exact count."""
    texts, root = _order_texts(spark, sf).withColumn("unit", F.substring("o_orderdate", 1, 7)), folder(spark)
    merged.unit_profiles(texts, "unit", PROFILE_COLUMNS).write.parquet(root)
    out = merged.merge_profiles(spark.read.parquet(root))
    exact = P.null_share(texts, PROFILE_COLUMNS).select("column_name", F.col("distinct_values").alias("exact"))
    right = F.abs(F.col("distinct_about") - F.col("exact")) <= 0.05 * F.col("exact")
    return out.join(exact, "column_name").select("column_name", "n_rows", "nulls", "empties", "leading_zero", *(F.round(c, 6).alias(c) for c in ("date_share", "integer_share", "numeric_share")),
                                                 F.array_join("first_values", "|").alias("first_values"), F.array_join("last_values", "|").alias("last_values"), right.alias("about_right"))


@query(f"""with {ORDER_TEXTS_SQL}, {ENDS_SQL} select column_name, array_to_string(f, '|') as first_values, array_to_string(l, '|') as last_values from ends""")
def profile_ends(spark: SparkSession, sf: str) -> DataFrame:
    """the first and last four values of each column."""
    return merged.value_ends(_order_texts(spark, sf), PROFILE_COLUMNS).select("column_name", *(F.array_join(c, "|").alias(c) for c in ("first_values", "last_values")))


def _eras(spark: SparkSession, sf: str) -> str:
    """Orders by year as a publisher's files change: a column appears in 1995, another becomes text in 1997."""
    root, o = folder(spark), table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    for where, columns in (("year < 1995", ["o_orderkey", "o_custkey"]), ("year between 1995 and 1996", ["o_orderkey", "o_custkey", "o_orderstatus"]),
                           ("year > 1996", ["o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"), "o_orderstatus"])):
        o.filter(where).select("year", *columns).repartition("year").write.mode("append").partitionBy("year").parquet(root)
    return root


@query("""
with y as (select distinct year(o_orderdate) as y from orders),
seen(column_name, type, y) as (
  select 'o_orderkey', 'int64', y from y union all select 'o_custkey', case when y > 1996 then 'string' else 'int64' end, y from y union all select 'o_orderstatus', 'string', y from y where y >= 1995)
select column_name, type, min(y)::varchar as first_era, max(y)::varchar as last_era from seen group by 1, 2
""")
def footer_schema(spark: SparkSession, sf: str) -> DataFrame:
    """When columns appear and change type, from footers alone."""
    found = footers.footers(spark, _eras(spark, sf))
    return footers.column_eras(found, C.path_key(F.col("path"), "year")).drop("files")


@query("""select year(o_orderdate)::varchar as year, count(*) as n, min(o_orderkey)::varchar as least, max(o_orderkey)::varchar as greatest from orders group by 1""")
def footer_counts(spark: SparkSession, sf: str) -> DataFrame:
    """rows and bounds of each year, from footers alone."""
    found = footers.footers(spark, _eras(spark, sf)).withColumn("year", C.path_key(F.col("path"), "year"))
    keys = found.filter("column_name = 'o_orderkey'").groupBy("year").agg(*(f(F.col(c).cast("bigint")).cast("string").alias(c) for f, c in ((F.min, "least"), (F.max, "greatest"))))
    return footers.row_counts(found, C.path_key(F.col("path"), "year").alias("year")).select("year", F.col("rows").alias("n")).join(keys, "year")


@query("""
select unnest(['a', 'b']) as column_name, unnest([count(*), count(*) - count(*) filter (o_orderkey % 1000 = 0)]) as equal, unnest([0, count(*) filter (o_orderkey % 1000 = 0)]) as different,
  unnest([0, count(*) filter (o_orderkey % 1000 = 0)]) as float_suffix, 0::bigint as lost_zero from orders
""")
def format_compare_digests(spark: SparkSession, sf: str) -> DataFrame:
    """Two encodings of the orders, of which only the buckets that differ are joined."""
    a = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("a"), F.col("o_custkey").cast("string").alias("b"))
    b = a.withColumn("b", F.when(F.col("o_orderkey") % 1000 == 0, F.concat("b", F.lit(".0"))).otherwise(F.col("b")))
    return P.compare_by_digests(a, b, "o_orderkey", ["a", "b"])


@query("""
with unit as (select o_orderstatus as unit, count(*) as n from orders group by 1)
select unit, case when unit = 'F' then 2 * n else n end as n, case when unit = 'F' then 'second' else 'first' end as etag from unit where unit <> 'P'
""")
def followed_units(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots as a stream; one unit changes, one is never there, and each is written once a change."""
    o, root, at, noted = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year")), folder(spark), folder(spark), folder(spark)
    seen = o.select(F.col("o_orderstatus").alias("unit"), (F.col("o_orderstatus") != "P").alias("exists")).distinct()
    for k, etag in enumerate(("first", "second")):
        changed = F.when((F.col("unit") == "F") | (F.lit(k) == 0), etag).otherwise("first")
        seen.select("unit", "exists", changed.alias("etag"), F.lit(5).cast("bigint").alias("size_bytes"), F.lit(k).alias("seen")).write.mode("append").json(at)
        own = lambda unit, k=k: (o if k == 0 or unit != "F" else o.unionByName(o)).filter(F.col("o_orderstatus") == unit).drop("o_orderstatus")
        incremental.follow(spark, at, "unit string, exists boolean, etag string, size_bytes bigint, seen int", root, noted, own, ["year"])
    counts = files.scan(spark, root).groupBy(F.col("source_unit").alias("unit")).agg(F.count("*").alias("n"))
    return counts.join(units.current(spark, root).select("unit", "etag"), "unit")
