"""Further queries: rules applied as tables, whole trees validated, lists by status, levels and types."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio import api, rules, sinks
from cartorio.functions import codes as C
from cartorio.operators import aggregates as A
from cartorio.operators import joins as J
from cartorio.operators import sets, sync
from cartorio.operators import windows as W
from cartorio.plans.q_aggregates import _lines
from cartorio.plans.q_sync import DETAILS_SQL, _details
from cartorio.plans.registry import folder, query, table
from cartorio.schemas import MONTHS, NO_DATA
from cartorio.sources import dbf, files
from cartorio.streaming import incremental

_text = lambda v: "null" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
values = lambda rows: "values " + ", ".join("(" + ", ".join(map(_text, r)) + ")" for r in rows)

#: Brands stand in for the vaccines of the nine dropout rules; years of shipping, 20 years on, fall into their periods.
BRIDGE = [(f"Brand#{i}", r[0]) for i in range(1, 26) for k, r in enumerate(rules.DROPOUT) if (i + k) % 5 == 0]


@query(f"""with rules(indicator, first_dose, last_dose, a, b) as ({values(rules.DROPOUT)}), bridge(vaccine, indicator) as ({values(BRIDGE)}),
lines as (select p_brand as vaccine, l_returnflag as flag, cast(l_quantity as bigint) as doses, year(l_shipdate) + 20 as year from lineitem join part on l_partkey = p_partkey),
sums as (
  select indicator, year, sum(doses) filter (flag = 'A') as f, sum(doses) filter (flag = 'R') as l
  from lines join bridge using (vaccine) join rules using (indicator) where year >= a and (b is null or year <= b) group by 1, 2)
select indicator, year::bigint as year, cast(f as bigint) as first_doses, cast(l as bigint) as last_doses, round((f - l) * 100.0 / nullif(f, 0), 6) as dropout_pct from sums""")
def dropout_rules(spark: SparkSession, sf: str) -> DataFrame:
    """The nine published dropout rates, each in its years, over a many-to-many crosswalk."""
    bridge = spark.createDataFrame(BRIDGE, "bridge_vaccine string, counts_for string")
    lines = J.crosswalk(_lines(spark, sf, place=False), bridge, "vaccine", "bridge_vaccine")
    last = {r[0]: r[2] for r in rules.DROPOUT}
    dose = F.when(F.col("dose") == "A", "D1").when(F.col("dose") == "R", F.create_map(*(F.lit(x) for kv in last.items() for x in kv))[F.col("counts_for")])
    lines = lines.select("counts_for", dose.alias("dose"), (F.col("year") + 20).cast("bigint").alias("year"), "doses")
    out = A.dropout_by_rules(lines, rules.dropout_rules(spark), "counts_for", "dose", "year", "doses", ["year"])
    return out.withColumn("dropout_pct", F.round("dropout_pct", 6))


@query(f"""with bridge(vaccine, indicator) as ({values(BRIDGE)})
select indicator, count(*) as n from part join bridge on p_brand = vaccine group by 1""")
def crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    """A part counts for every indicator of its brand."""
    bridge = spark.createDataFrame(BRIDGE, "bridge_vaccine string, indicator string")
    return A.count_by(J.crosswalk(table(spark, sf, "part"), bridge, "p_brand", "bridge_vaccine"), "indicator")


@query("""
with m as (select year(o_orderdate)::bigint as year, month(o_orderdate)::bigint as month, count(*) as n from orders group by 1, 2),
r as (select *, cast(sum(n) over (partition by year order by month) as bigint) as running, (select count(*) from customer) * 1.0 / 12 * month as target from m)
select year, month, n, running, round(target, 6)::double as target, running >= target as reached from r
""")
def running_target(spark: SparkSession, sf: str) -> DataFrame:
    """The year's running doses against the target of the months so far."""
    o = table(spark, sf, "orders").groupBy(F.year("o_orderdate").cast("bigint").alias("year"), F.month("o_orderdate").cast("bigint").alias("month")).agg(F.count("*").alias("n"))
    annual = table(spark, sf, "customer").agg(F.count("*").alias("annual"))
    out = W.running_against_target(o.crossJoin(F.broadcast(annual)), ["year"], "month", "n", "annual")
    return out.withColumn("target", F.round("target", 6)).select("year", "month", "n", "running", "target", "reached")


@query("""
select year(l_shipdate)::bigint as year, month(l_shipdate)::bigint as month, day(l_shipdate)::bigint as day, cast(sum(cast(l_quantity as bigint)) as bigint) as total, count(*) as n,
  grouping(year(l_shipdate), month(l_shipdate), day(l_shipdate))::bigint as level from lineitem group by rollup (year(l_shipdate), month(l_shipdate), day(l_shipdate))
""")
def grain_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Days, months, years and all, each with its level."""
    l = table(spark, sf, "lineitem").select("l_shipdate", F.col("l_quantity").cast("bigint").alias("q"))
    return W.grain_levels(l, "l_shipdate", "q").withColumns({c: F.col(c).cast("bigint") for c in ("year", "month", "day")})


@query("""
select unnest(['o_custkey', 'o_totalprice']) as column_name, unnest(['int', 'double']) as kind_a, unnest(['string', 'int']) as kind_b,
  count(*) filter (o_orderkey % 2 = 0) as n_a, count(*) filter (o_orderkey % 2 = 1) as n_b from orders
""")
def colset_types(spark: SparkSession, sf: str) -> DataFrame:
    """Columns that two eras' files share, of types that differ as they are read from the values, and how many each era has."""
    o, roots = table(spark, sf, "orders"), (folder(spark), folder(spark))
    price = F.round("o_totalprice").cast("int")
    o.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey", (price + 0.5).cast("string").alias("o_totalprice"), "o_orderstatus").write.option("header", True).csv(roots[0])
    o.filter("o_orderkey % 2 = 1").select("o_orderkey", F.concat(F.lit("C"), "o_custkey").alias("o_custkey"), price.alias("o_totalprice")).write.option("header", True).csv(roots[1])
    a, b = (spark.read.option("header", True).option("inferSchema", True).csv(root) for root in roots)
    counts = a.agg(F.count("o_custkey").alias("n_a")).crossJoin(b.agg(F.count("o_custkey").alias("n_b")))  # a row each
    return sets.type_changes(a, b).crossJoin(counts)


@query("""
with item as (select r_name as label, n_nationkey::varchar as code from nation join region on r_regionkey = n_regionkey union all select 'SHARED', n_nationkey::varchar from nation where n_nationkey % 4 = 0)
select code as source_code, count(distinct label) as labels from item join customer on c_nationkey = code::bigint group by 1 having count(distinct label) > 1
""")
def ambiguous_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Codes in use that a dictionary lists under several labels."""
    codes = lambda where: F.array_join(F.sort_array(F.collect_list(F.when(F.expr(where), F.col("n_nationkey").cast("string")))), ", ").alias("source_codes")
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    d = n.groupBy(F.col("r_name").alias("label")).agg(codes("true")).unionByName(n.groupBy(F.lit("SHARED").alias("label")).agg(codes("n_nationkey % 4 = 0")))
    used = table(spark, sf, "customer").select(F.col("c_nationkey").cast("string").alias("_code")).distinct()
    return J.ambiguous_codes(d).join(used, F.col("source_code") == F.col("_code"), "left_semi")


@query("select distinct text, lang, n_chars from documents")
def drop_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """one row of those that are equal but for the id and source."""
    return A.drop_duplicates_ignoring(table(spark, sf, "documents"), ["doc_id", "source"]).select("text", "lang", "n_chars")


@query("""select o_orderstatus, o_custkey from orders where o_orderkey % 2 = 0 union all select o_orderstatus, o_custkey from orders where o_orderkey % 2 = 1""")
def common_stack(spark: SparkSession, sf: str) -> DataFrame:
    """Two eras stacked on the columns that both have."""
    o = table(spark, sf, "orders")
    a, b = o.filter("o_orderkey % 2 = 0").select("o_orderstatus", "o_custkey", "o_totalprice"), o.filter("o_orderkey % 2 = 1").select("o_orderkey", "o_orderstatus", "o_custkey")
    both = sets.common_columns(a, b)
    return sinks.stack(a.select(both), b.select(both))


@query(f"""select (['{"', '".join(MONTHS)}'])[month(o_orderdate)] as name, year(o_orderdate)::bigint as year, month(o_orderdate)::bigint as month, 'routine' as kind, count(*) as n from orders group by all""")
def routine_names(spark: SparkSession, sf: str) -> DataFrame:
    """C17: monthly routine file names, built and parsed."""
    d = table(spark, sf, "orders").select(C.file_name("routine", F.lit("SP"), F.year("o_orderdate"), F.month("o_orderdate")).alias("file"))
    d = d.groupBy("file").agg(F.count("*").alias("n")).select("n", F.substring("file", 11, 3).alias("name"), C.parse_file_name(F.col("file")).alias("p")).filter("p.uf is null")
    return d.select("name", F.col("p.year").cast("bigint").alias("year"), F.col("p.month").cast("bigint").alias("month"), "p.kind", "n")


@query("""
select 'u' as source_unit, year(o_orderdate)::varchar as year, count(*) as n from orders where o_orderkey % 2 = 0 group by 2
""")
def replace_unit_salted(spark: SparkSession, sf: str) -> DataFrame:
    """A unit is replaced whole, its large keys written by several tasks."""
    o, root = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate")).select("o_orderkey", "year"), folder(spark)
    for rows in ("o_orderkey % 2 = 1", "o_orderkey % 2 = 0"):
        incremental.reprocess(lambda _, rows=rows: o.filter(rows), root, ["u"], ["year"], salt=4)
    back = files.scan(spark, root).select("source_unit", F.col("year").cast("string").alias("year"))
    return back.groupBy("source_unit", "year").agg(F.count("*").alias("n"))


@query("select count(distinct year(o_orderdate)) as local_files, count(distinct year(o_orderdate)) - 1 as remote_files, false as enough from orders")
def copied_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A copy that lacks the first year's file, however many parts a year's file has. Rows without a year are in no file."""
    here, there = folder(spark), folder(spark)
    o = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year")).dropna(subset="year")
    first = o.agg(F.min("year").alias("first"))
    sinks.write_partitioned(o, here, ["year"])
    sinks.write_partitioned(o.crossJoin(F.broadcast(first)).filter("year > first").drop("first"), there, ["year"])
    return sync.copied_enough(files.whole_files(spark, here), files.whole_files(spark, there))


GAPS = [(y, u) for y, states in NO_DATA.items() for u in states]


@query(f"""with gap(year, uf) as ({values(GAPS)})
select o_orderpriority, gap.year::bigint as year, uf, count(*) as n from orders join gap on year(o_orderdate) = gap.year group by all""")
def known_gaps_all(spark: SparkSession, sf: str) -> DataFrame:
    """E5: every state and year that never had data, with what a count by year would wrongly expect there."""
    o = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year"), "o_orderpriority").agg(F.count("*").alias("n"))
    return o.join(J.small(rules.no_data(spark)), "year").select("o_orderpriority", F.col("year").cast("bigint").alias("year"), "uf", "n")


@query(f"with {DETAILS_SQL} select dataset, status, k from details where status in ('missing', 'outdated', 'extra', 'check_failed')")
def api_sync_lists(spark: SparkSession, sf: str) -> DataFrame:
    """K4: the units of each dataset by status, as lists to work off."""
    return api.to_do(_details(spark, sf), ["k"])


@query("""
with f as (select year(o_orderdate) as year, o_orderstatus, count(*) as n from orders group by 1, 2), most as (select max(year) as y from f)
select o_orderstatus, case when year = y then 'mismatch' else 'ok' end as result, count(*) as n from f, most group by 1, 2
union all select 'gone', 'missing', 1 union all select 'new', 'extra', 1
""")
def api_validate_tree(spark: SparkSession, sf: str) -> DataFrame:
    """K5: a Hive tree in which every folder has a file of the same name: the last year's digests are wrong in the manifest,
    one file is gone and one is new."""
    root, where = folder(spark), folder(spark)
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year"))
    sinks.write_partitioned(o, root, ["year", "o_orderstatus"])
    tree = files.digests(spark, root).withColumn("path", files.below(spark, F.col("path"), root))
    year = C.path_key(F.col("path"), "year")
    d = tree.crossJoin(F.broadcast(tree.agg(F.max(year).alias("last")))).select("path", "size_bytes", F.when(year == F.col("last"), "0").otherwise(F.col("sha256")).alias("sha256"))
    gone = o.limit(1).select(F.lit("year=0/o_orderstatus=gone/part-0.parquet").alias("path"), F.lit(1).cast("bigint").alias("size_bytes"), F.lit("0").alias("sha256"))
    o.limit(1).select("o_orderkey").write.mode("append").parquet(f"{root}/year=0/o_orderstatus=new")
    body = F.collect_list(F.struct("path", "size_bytes", "sha256"))
    m = d.filter("path not like '%=new/%'").unionByName(gone).agg(F.to_json(F.struct(F.lit("orders").alias("dataset"), F.create_map(F.lit("all"), F.struct(body.alias("output_files"))).alias("partitions"))).alias("value"))
    m.coalesce(1).write.text(where)
    return api.validate_local(spark, root, where).groupBy(C.path_key(F.col("path"), "o_orderstatus").alias("o_orderstatus"), "result").agg(F.count("*").alias("n"))


@query("select o_orderstatus as status, count(*) as n, cast(sum(o_orderkey) as bigint) as keys, count(case when o_orderkey % 3 <> 0 then 1 end) as with_clerk from orders group by 1")
def dbf_folder(spark: SparkSession, sf: str) -> DataFrame:
    """A5: orders dealt to many dBase files of two layouts, written by the tasks and read as one folder."""
    from pyarrow import fs

    root = folder(spark)
    system, path = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root.removeprefix("file:"))
    system.create_dir(path)

    def write(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        wide = key[0] % 2 == 0  # the other half lacks the clerk's column, and has none to lose
        fields = [("KEY", 12), ("STATUS", 1), *([("CLERK", 8)] if wide else [])]
        body = [(str(k), s, *((f"é{k}"[:8] if k % 3 else None,) if wide else ())) for k, s in zip(rows["o_orderkey"], rows["o_orderstatus"], strict=True)]
        place, name = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), path)
        with place.open_output_stream(f"{name}/F{key[0]}.DBF") as f:
            f.write(dbf.dbf_bytes(fields, body))
        return pd.DataFrame({"n": [len(rows)]})

    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    files_of = max(2, 2 * -(-o.count() // 40_000))
    # Even numbers get the rows with a clerk and, so that blanks are met too, half of the others.
    part = F.when((F.col("o_orderkey") % 3 != 0) | (F.col("o_orderkey") % 2 == 0), 2 * (F.col("o_orderkey") % (files_of // 2))).otherwise(2 * (F.col("o_orderkey") % (files_of // 2)) + 1)
    o.groupBy(part.cast("int").alias("part")).applyInPandas(write, "n long").agg(F.sum("n")).collect()
    back = dbf.read_dbf_folder(spark, root)
    return back.groupBy(F.col("STATUS").alias("status")).agg(F.count("*").alias("n"), F.sum(F.col("KEY").cast("bigint")).alias("keys"), F.count("CLERK").alias("with_clerk"))
