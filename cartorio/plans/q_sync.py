"""Sources against copies, over inventories and manifests derived from orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio import api
from cartorio.operators import sync
from cartorio.plans.registry import query, table


def _units(spark: SparkSession, sf: str) -> DataFrame:
    """One unit a customer that ordered; its key decides what is known of it."""
    return table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))


UNITS_SQL = "units as (select o_custkey as k, count(*) as n from orders group by 1)"


@query(f"""with {UNITS_SQL}
select k, case when k % 7 = 0 then 'unavailable' when k % 3 = 0 then 'new' when k % 5 = 0 then 'updated' when k % 11 = 0 then 'updated' else 'unchanged' end as status from units""")
def classify_unit(spark: SparkSession, sf: str) -> DataFrame:
    """Unavailable, new, unchanged or updated."""
    k = F.col("k")
    return _units(spark, sf).select("k", sync.classify_unit(k % 3 != 0, k % 7 != 0, F.lit("a"), F.when(k % 5 == 0, "b").otherwise("a"), F.col("n"), F.col("n") + F.when(k % 11 == 0, 1).otherwise(0)).alias("status"))


def _details(spark: SparkSession, sf: str) -> DataFrame:
    k, u = F.col("k"), _units(spark, sf)
    source = u.filter("k % 8 <> 1").select("k", F.when(k % 8 == 0, False).otherwise(True).alias("exists"), F.when(k % 5 == 0, "").when(k % 6 == 0, "b").otherwise("a").alias("etag"),
                                           (F.col("n") + F.when(k % 9 == 0, 1).otherwise(0)).alias("size_bytes"), F.when(k % 13 == 0, "timeout").alias("error"))
    copy = u.filter("k % 7 <> 0").select("k", F.lit("a").alias("source_etag"), F.when(k % 10 == 0, 0).otherwise(F.col("n")).alias("source_size_bytes"))
    return sync.compare(u.select("k", (k % 4).cast("string").alias("dataset")), source, copy, ["k"])


DETAILS_SQL = f"""{UNITS_SQL}, details as (
  select k, (k % 4)::varchar as dataset, n, k % 8 not in (0, 1) as in_source, k % 7 <> 0 as in_copy,
    case when k % 8 <> 1 and k % 13 = 0 then 'check_failed' when k % 8 in (0, 1) and k % 7 = 0 then 'not_published' when k % 7 = 0 then 'missing' when k % 8 in (0, 1) then 'extra'
      when k % 5 <> 0 and k % 6 = 0 then 'outdated' when k % 10 <> 0 and k % 9 = 0 then 'outdated' else 'in_sync' end as status from units)"""


@query(f"with {DETAILS_SQL} select k, status from details")
def classify_sync(spark: SparkSession, sf: str) -> DataFrame:
    """Every branch; empty tags and sizes of 0 are unknown, not different."""
    return _details(spark, sf).select("k", "status")


@query(f"""with {UNITS_SQL}
select k, case when (s is null or s = 0) and not c then 'not_published' when not c then 'missing' when s is null or s = 0 then 'extra' when m is null or m = 0 then 'in_sync' when s <> m then 'outdated' else 'in_sync' end as status,
  case when coalesce(s, 0) = 0 or not c then null when coalesce(m, 0) = 0 then 'no stored count'
    when s > m then format('{{:,}}', s - m) || ' new records (' || format('{{:,}}', m) || ' -> ' || format('{{:,}}', s) || ')'
    when s < m then format('{{:,}}', m - s) || ' fewer records (' || format('{{:,}}', m) || ' -> ' || format('{{:,}}', s) || ')' end as note
from (select k, case when k % 6 = 0 then null when k % 6 = 1 then 0 else k * 1000 end as s, k % 5 <> 0 as c, case when k % 4 = 0 then null when k % 4 = 1 then 0 when k % 4 = 2 then k * 1000 + k % 3 - 1 else k * 1000 end as m from units)""")
def classify_counts(spark: SparkSession, sf: str) -> DataFrame:
    """By record counts, with a note."""
    k = F.col("k")
    s = F.when(k % 6 == 1, 0).when(k % 6 != 0, k * 1000)
    m = F.when(k % 4 == 1, 0).when(k % 4 == 2, k * 1000 + k % 3 - 1).when(k % 4 == 3, k * 1000)
    u = _units(spark, sf).select("k", s.alias("s"), m.alias("m"), (k % 5 != 0).alias("c"))
    return u.select("k", sync.classify_counts(F.col("s"), F.col("c"), F.col("m")).alias("x")).select("k", "x.status", "x.note")


SUMMARY_SQL = """select dataset, count(*) as units, """ + ", ".join(f"count(*) filter (status = '{s}') as {s}" for s in ("in_sync", "outdated", "missing", "not_published", "extra", "check_failed")) + """,
  case when count(*) filter (status = 'check_failed') > 0 and count(*) filter (status = 'in_sync') = 0 then 'check_failed' when count(*) filter (status in ('missing', 'outdated')) > 0 then 'outdated' else 'in_sync' end as overall
from details group by 1"""


@query(f"with {DETAILS_SQL} {SUMMARY_SQL}")
def overall_status(spark: SparkSession, sf: str) -> DataFrame:
    """Counters and the overall status of each dataset."""
    return sync.status_summary(_details(spark, sf))


@query(f"with {DETAILS_SQL} {SUMMARY_SQL}")
def api_check_sync(spark: SparkSession, sf: str) -> DataFrame:
    """K4: all datasets at once."""
    k, u = F.col("k"), _units(spark, sf)
    source = u.filter("k % 8 <> 1").select("k", F.when(k % 8 == 0, False).otherwise(True).alias("exists"), F.when(k % 5 == 0, "").when(k % 6 == 0, "b").otherwise("a").alias("etag"),
                                           (F.col("n") + F.when(k % 9 == 0, 1).otherwise(0)).alias("size_bytes"), F.when(k % 13 == 0, "timeout").alias("error"))
    copy = u.filter("k % 7 <> 0").select("k", F.lit("a").alias("source_etag"), F.when(k % 10 == 0, 0).otherwise(F.col("n")).alias("source_size_bytes"))
    return api.check_sync(u.select("k", (k % 4).cast("string").alias("dataset")), source, copy, ["k"])[1]


@query(f"""with {DETAILS_SQL}
select s as source_bytes, c as copy_bytes, round(c / s::double, 6) as copy_ratio from (
  select cast(sum(n + case when k % 9 = 0 then 1 else 0 end) filter (in_source) as bigint) as s, cast(sum(case when k % 10 = 0 then 0 else n end) filter (in_copy) as bigint) as c from details)""")
def size_balance(spark: SparkSession, sf: str) -> DataFrame:
    """bytes of what exists, and their ratio."""
    return sync.size_balance(_details(spark, sf), "size_bytes", "source_size_bytes").withColumn("copy_ratio", F.round("copy_ratio", 6))


@query("""
select 'live' as origin, o_orderstatus as unit, count(*) as n, (select count(*) from orders) as total from orders group by 2
union all select 'baseline', o_orderpriority, count(*), (select count(*) from orders) from orders group by 2
""")
def fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Live counts, or stored ones where the source gave none; the total falls back to their sum."""
    o = table(spark, sf, "orders")
    live, stored = (o.groupBy(F.col(c).alias("unit")).agg(F.count("*").alias("n")) for c in ("o_orderstatus", "o_orderpriority"))
    out = [sync.counts_or_baseline(live, stored, ok) for ok in (True, False)]
    return out[0].crossJoin(sync.total_or_sum(out[0], None)).unionByName(out[1].crossJoin(sync.total_or_sum(out[1], None)))


@query("""
select case when doc_id = 5 then 'missing' when doc_id = 6 then 'extra' when doc_id % 10 = 0 then 'mismatch' else 'ok' end as result, count(*) as n from documents group by 1
""")
def validate_copy(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of texts against a manifest of them with wrong, missing and extra entries."""
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("path"), F.sha2("text", 256).alias("sha256"), "doc_id")
    wanted = d.filter("doc_id <> 6").withColumn("sha256", F.when(F.col("doc_id") % 10 == 0, "0").otherwise(F.col("sha256")))
    return sync.validate_copy(d.filter("doc_id <> 5"), wanted).groupBy("result").agg(F.count("*").alias("n"))
