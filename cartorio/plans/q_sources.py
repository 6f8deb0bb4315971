"""Sources and sinks: tables written in each format, read back, and compared with the originals."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio import api, sinks, units
from cartorio.functions import codes as C
from cartorio.operators import joins, sync
from cartorio.plans.registry import folder, query, table
from cartorio.schemas import LEDGER
from cartorio.sources import dbf, dictionaries, files, streams
from cartorio.streaming import incremental


def _by_region(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as text with date and region, the shape of a publisher's records."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    j = (o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    return C.all_to_string(j.select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("date"), F.substring("r_name", 1, 2).alias("uf")))


def _keyed(spark: SparkSession, sf: str) -> DataFrame:
    df = C.drop_unkeyed(C.derive_keys(_by_region(spark, sf), "date", "uf"))
    return df.withColumn("p_ano", C.quarantine_year(F.col("p_ano"), "1996", "2000"))


REGION_SQL = """by_region as (
  select o_orderkey::varchar as o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') as date, substr(r_name, 1, 2) as uf
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
keyed as (select *, case when substr(date, 1, 4) between '1996' and '2000' then substr(date, 1, 4) else '_invalid' end as p_ano, substr(date, 6, 2) as p_mes, uf as p_uf from by_region)"""


@query(f"with {REGION_SQL} select p_uf, o_orderstatus, count(*) as n from keyed where p_ano = '1997' group by 1, 2")
def hive_roundtrip_count(spark: SparkSession, sf: str) -> DataFrame:
    """The minimum slice: keys, rejects, quarantine, partitioned sink, pruned scan, count."""
    root = folder(spark)
    sinks.write_partitioned(_keyed(spark, sf), root, ["p_ano", "p_uf"])
    return files.scan(spark, root, F.col("p_ano") == "1997").groupBy("p_uf", "o_orderstatus").agg(F.count("*").alias("n"))


@query(f"with {REGION_SQL} select p_ano, p_uf, count(*) as n from keyed group by 1, 2")
def annual_sink(spark: SparkSession, sf: str) -> DataFrame:
    """B2: year and state folders; a large state may be split by a salt."""
    root = folder(spark)
    sinks.write_partitioned(_keyed(spark, sf), root, ["p_ano", "p_uf"], salt=2)
    return files.scan(spark, root).groupBy("p_ano", "p_uf").agg(F.count("*").alias("n"))


@query("select count(*) as n, true as bounded from orders")
def bounded_files(spark: SparkSession, sf: str) -> DataFrame:
    """No file over the bound."""
    root = folder(spark)
    sinks.write_partitioned(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), root, ["o_orderstatus"], most_rows=1000)
    per_file = files.scan(spark, root).groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"))
    return per_file.agg(F.sum("n").alias("n"), (F.max("n") <= 1000).alias("bounded"))


@query("select o_orderkey, o_orderstatus, case when o_orderkey % 2 = 0 then o_orderpriority end as o_orderpriority from orders where o_orderstatus = 'F'")
def stacked_export(spark: SparkSession, sf: str) -> DataFrame:
    """All years of one state, stacked and written as CSV with a header."""
    o, root = table(spark, sf, "orders").filter("o_orderstatus = 'F'"), folder(spark)
    a, b = o.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_orderstatus", "o_orderpriority"), o.filter("o_orderkey % 2 = 1").select("o_orderkey", "o_orderstatus")
    sinks.write_csv(sinks.stack(a, b), root)
    return spark.read.schema("o_orderkey bigint, o_orderstatus string, o_orderpriority string").option("header", True).csv(root)


@query("select s_suppkey::varchar as s_suppkey, s_name from supplier")
def csv_sink(spark: SparkSession, sf: str) -> DataFrame:
    root = folder(spark)
    sinks.write_csv(table(spark, sf, "supplier").select("s_suppkey", "s_name"), root)
    return files.good_rows(files.read_csv_strings(spark, root, ["s_suppkey", "s_name"], sep=","))


@query("""
select n_name, n_nationkey::varchar as n_nationkey, coalesce(n_regionkey::varchar, '') as n_regionkey from nation where n_nationkey % 5 <> 4
""")
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A2-A4: Latin-1 lines with a trailing separator, a header met as a row, and malformed lines kept apart."""
    n, root = table(spark, sf, "nation"), folder(spark)
    line = F.concat_ws(";", F.col("n_nationkey").cast("string"), "n_name", F.col("n_regionkey").cast("string"), F.lit(""))
    broken = F.concat(line, F.lit("one;more;and;more"))
    (n.select(F.when(F.col("n_nationkey") % 5 == 4, broken).otherwise(line).alias("value")).unionByName(spark.createDataFrame([("n_nationkey;n_name;n_regionkey;",)], "value string"))
     .write.text(root))
    df = files.read_csv_strings(spark, root, ["n_nationkey", "n_name", "n_regionkey"], header=False, encoding="ISO-8859-1", trailing=True).persist()
    return files.drop_header_row(files.good_rows(df), "n_nationkey")


@query("select count(*) filter (n_nationkey % 5 = 4) as bad, count(*) as n from nation")
def csv_bad_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A3: malformed lines are counted, not lost."""
    n, root = table(spark, sf, "nation"), folder(spark)
    line = F.concat_ws(";", F.col("n_nationkey").cast("string"), F.when(F.col("n_nationkey") % 5 != 4, F.col("n_name")))
    n.select(line.alias("value")).write.text(root)
    df = files.read_csv_strings(spark, root, ["n_nationkey", "n_name"], header=False).persist()
    return files.bad_rows(df).agg(F.count("*").alias("bad")).crossJoin(df.agg(F.count("*").alias("n")))


@query("select n_nationkey::varchar as n_nationkey, n_name, n_regionkey::varchar as n_regionkey, null::varchar as absent from nation")
def json_array_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A1: one array in one file; numbers keep their text, absent keys are null."""
    n, root = table(spark, sf, "nation"), folder(spark)
    n.agg(F.to_json(F.collect_list(F.struct("n_nationkey", "n_name", "n_regionkey"))).alias("value")).coalesce(1).write.text(root)
    return files.good_rows(files.read_json_array(spark, root, ["n_nationkey", "n_name", "n_regionkey", "absent"]))


#: What stands behind each text, to be read as text: braces and quotes that aren't the record's own.
NASTY = ' \\" {"a": [1, "}"]} }{ \\\\'


@query(f"""select doc_id::varchar as doc_id, text || '{NASTY}' as text, lang, case when source is not null then '{{"source":"' || source || '"}}' end as "_rescued" from documents""")
def json_array_split(spark: SparkSession, sf: str) -> DataFrame:
    """A1: arrays of 500 records each over several lines, of some 1.2 MB and several in a file, read in ranges of 150,000 bytes."""
    d, root = table(spark, sf, "documents"), folder(spark)
    record = F.to_json(F.struct("doc_id", F.concat("text", F.lit(NASTY)).alias("text"), "lang", "source"), {"pretty": "true"})
    arrays = d.groupBy(F.floor(F.col("doc_id") / 500).alias("b")).agg(F.concat(F.lit("["), F.array_join(F.collect_list(record), ",\n"), F.lit("]")).alias("value"))
    arrays.repartition("b").select("value").write.text(root)
    return files.good_rows(files.read_json_array(spark, root, ["doc_id", "text", "lang"], range_bytes=150_000))


@query("""select s_suppkey::varchar as s_suppkey, s_name, '{"s_nationkey":"' || s_nationkey || '"}' as "_rescued" from supplier""")
def json_lines_rescue(spark: SparkSession, sf: str) -> DataFrame:
    """A1: line-delimited records; keys that no one declared are kept."""
    root = folder(spark)
    table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey").write.json(root)
    return files.good_rows(files.read_json_array(spark, root, ["s_suppkey", "s_name"], lines=True))


@query("""select n_nationkey::varchar as "NATIONKEY", n_name as "NAME", case when n_regionkey <> 3 then n_regionkey::varchar end as "REGIONKEY" from nation""")
def dbf_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A5: a fixed-width dBase file of the nations, written by a task and read in ranges of ten records."""
    root = folder(spark)
    n = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("NATIONKEY"), F.col("n_name").alias("NAME"),
                                          F.when(F.col("n_regionkey") != 3, F.col("n_regionkey").cast("string")).alias("REGIONKEY"))
    write_dbf(n.withColumn("file", F.lit("NATION.DBF")), root, "file", [("NATIONKEY", 4), ("NAME", 25), ("REGIONKEY", 4)])
    return dbf.read_dbf(spark, f"{root}/NATION.DBF", records=10)


def write_dbf(df: DataFrame, root: str, file: str, fields: list[tuple[str, int]]) -> int:
    """A dBase file of each value of the column `file`, written by a task each; returns how many rows."""
    def write(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        system, path = streams.store(root)
        system.create_dir(path)
        with system.open_output_stream(f"{path}/{key[0]}") as f:
            f.write(dbf.dbf_bytes(fields, list(rows[[n for n, _ in fields]].astype(object).where(rows.notna(), None).itertuples(index=False, name=None))))
        return pd.DataFrame({"n": [len(rows)]})

    return df.groupBy(file).applyInPandas(write, "n long").agg(F.sum("n")).first()[0] or 0


@query("""select o_orderkey % 7 as file, count(*) as n, cast(sum(o_orderkey) as bigint) as keys from orders where o_orderstatus in ('F', 'P') and o_orderkey % 7 <> 5 group by 1""")
def dbf_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """A5: a tree of dBase files, each read in ranges; only two columns and two of three statuses are decoded."""
    root, o = folder(spark), table(spark, sf, "orders")
    rows = o.select(F.format_string("part=%d-%d.dbf", F.col("o_orderkey") % 7, F.floor(F.col("o_orderkey") / 100_000)).alias("file"), F.col("o_orderkey").cast("string").alias("KEY"), F.col("o_orderstatus").alias("STATUS"),
                    F.substring("o_orderpriority", 1, 10).alias("PRIORITY"))
    write_dbf(rows.filter("file not like 'part=5-%'"), root, "file", [("KEY", 12), ("STATUS", 1), ("PRIORITY", 10)])
    write_dbf(rows.filter("file like 'part=5-%'").select("file", "KEY"), root, "file", [("KEY", 12)])  # without the column that is asked for
    back = dbf.read_dbf_folder(spark, root, ["KEY"], equals={"STATUS": ["F", "P"]}, records=1000)
    key = F.col("KEY").cast("bigint")
    return back.groupBy((key % 7).alias("file")).agg(F.count("*").alias("n"), F.sum(key).alias("keys"))


@query("""
with c as (select s_nationkey, string_agg(s_name || ':' || s_suppkey, ';' order by s_suppkey) || chr(10) as body from supplier group by 1)
select s_nationkey, k as piece, sha256(substr(body, 64 * k + 1, 64)) as sha256, sha256(body) as whole, strlen(body) as size_bytes
from (select *, unnest(range(0, (strlen(body) + 63) // 64)) as k from c)
""")
def digest_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """A file for each nation, hashed as a stream and in pieces of 64 bytes."""
    root, s = folder(spark), table(spark, sf, "supplier")
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("s_suppkey", "s_name"))), lambda x: F.concat(x["s_name"], F.lit(":"), x["s_suppkey"].cast("string"))), ";")
    s.groupBy("s_nationkey").agg(body.alias("value")).repartition("s_nationkey").write.partitionBy("s_nationkey").text(root)
    whole = files.digests(spark, root, "*.txt", whole=0).select("path", F.col("sha256").alias("whole"), "size_bytes")
    parts = files.piece_digests(spark, root, "*.txt", 64).select("path", "piece", "sha256")
    nation = F.regexp_extract("path", r"s_nationkey=(\d+)", 1).cast("bigint")
    return parts.join(whole, "path").select(nation.alias("s_nationkey"), "piece", "sha256", "whole", "size_bytes")


@query("""
select year(l_shipdate)::bigint as year, count(*) as n, count(case when year(l_shipdate) >= 1998 then l_linestatus end) as with_status from lineitem group by 1
""")
def era_superset(spark: SparkSession, sf: str) -> DataFrame:
    """Eras with different columns, read as one superset."""
    l, root = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate").cast("bigint")), folder(spark)
    old, new = l.filter("year < 1998").select("year", "l_quantity"), l.filter("year >= 1998").select("year", "l_quantity", "l_linestatus")
    old.write.parquet(f"{root}/era=1")
    new.write.parquet(f"{root}/era=2")
    return files.scan(spark, root, superset=True).groupBy("year").agg(F.count("*").alias("n"), F.count("l_linestatus").alias("with_status"))


@query("""select 'AC' as p_uf, '2004' as p_ano, '12' as "UF", count(*) as n from nation""")
def foreign_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Folders ano=/uf= over data columns ANO, UF; both values survive."""
    root = folder(spark)
    table(spark, sf, "nation").select(F.lit("12").alias("UF"), F.lit("2004").alias("ANO"), "n_name").write.parquet(f"{root}/ano=2004/uf=AC")
    return files.scan_foreign(spark, root).groupBy("p_uf", "p_ano", "UF").agg(F.count("*").alias("n"))


def _dictionary_file(spark: SparkSession, sf: str, declared: int = 0) -> str:
    """Regions as a fixed-width dictionary, each with the list of its nation keys."""
    root = folder(spark)
    n = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list("n_nationkey")), lambda x: x.cast("string")), ",").alias("codes"))
    r = table(spark, sf, "region").join(n, F.col("r_regionkey") == F.col("n_regionkey"))
    line = F.concat(F.lit("     "), F.lpad(F.col("r_regionkey").cast("string"), 2, "0"), F.lit("  "), F.rpad("r_name", 30, " "), F.lit("  "), F.col("codes"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r_regionkey", line.alias("line")))), lambda x: x["line"]), "\n")
    r.agg(F.concat(F.lpad((F.count("*") + declared).cast("string"), 3, " "), F.lit(" 2\n"), body).alias("value")).coalesce(1).write.text(root)
    return f"{root}/*.txt"


@query("""
select lpad(r_regionkey::varchar, 2, '0') as code, r_name as label, string_agg(n_nationkey::varchar, ',' order by n_nationkey) as source_codes
from region join nation on r_regionkey = n_regionkey group by 1, 2
""")
def dictionary_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Code, label and source codes by position."""
    return dictionaries.read_code_dictionary(spark, _dictionary_file(spark, sf)).select("code", "label", "source_codes")


@query("select count(*) as found, count(*) + 1 as declared from region")
def dictionary_count(spark: SparkSession, sf: str) -> DataFrame:
    """A header that states another count is a fault."""
    d = dictionaries.read_code_dictionary(spark, _dictionary_file(spark, sf, declared=1))
    return dictionaries.count_faults(d).select("found", F.col("declared").cast("bigint").alias("declared"))


@query("""
select case n_nationkey % 3 when 2 then '???' else n_nationkey::varchar end as code, case n_nationkey % 3 when 2 then '(x)' else 'NAT' end as label from nation
""")
def dictionary_loose(spark: SparkSession, sf: str) -> DataFrame:
    """A10: code first, code last, or neither."""
    root, k = folder(spark), F.col("n_nationkey")
    line = F.when(k % 3 == 0, F.concat(k.cast("string"), F.lit(" NAT"))).when(k % 3 == 1, F.concat(F.lit("NAT  "), k.cast("string"))).otherwise("(x)")
    table(spark, sf, "nation").agg(F.concat(F.lit("header\n"), F.array_join(F.collect_list(line), "\n")).alias("value")).coalesce(1).write.text(root)
    return dictionaries.read_loose_dictionary(spark, f"{root}/*.txt").select("code", "label")


@query(f"with {REGION_SQL} select p_ano, count(distinct p_uf) as folders, true as enough from keyed group by 1")
def file_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Files found below the root, by key; at least as many as folders."""
    root = folder(spark)
    sinks.write_partitioned(_keyed(spark, sf), root, ["p_ano", "p_uf"])
    inv = files.inventory(spark, root).select(C.path_key(F.col("path"), "p_ano").alias("p_ano"), C.path_key(F.col("path"), "p_uf").alias("p_uf"))
    return inv.groupBy("p_ano").agg(F.count_distinct("p_uf").alias("folders"), (F.count("*") >= F.count_distinct("p_uf")).alias("enough"))


@query("select count(distinct c_nationkey) as local_files, count(distinct c_nationkey) filter (c_nationkey >= 5) as remote_files, count(distinct c_nationkey) filter (c_nationkey < 5) = 0 as enough from customer")
def copied_files(spark: SparkSession, sf: str) -> DataFrame:
    """Fewer files at the target than here, of which there is one, in any number of parts, for each nation that has customers."""
    here, there = folder(spark), folder(spark)
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey").dropna(subset="c_nationkey")
    sinks.write_partitioned(c, here, ["c_nationkey"])
    sinks.write_partitioned(c.filter("c_nationkey >= 5"), there, ["c_nationkey"])
    return sync.copied_enough(files.whole_files(spark, here), files.whole_files(spark, there))


@query("""select 'month-' || strftime(o_orderdate, '%Y%m') as unit, count(*) as n_rows, 0::bigint as absent from orders group by 1""")
def ledger_read(spark: SparkSession, sf: str) -> DataFrame:
    """A ledger as it was written, and none where none is."""
    root = folder(spark)
    rows = table(spark, sf, "orders").groupBy(F.concat(F.lit("month-"), F.date_format("o_orderdate", "yyyyMM")).alias("unit")).agg(F.count("*").alias("n_rows"))
    (rows.select("unit", F.lit("e").alias("etag"), F.lit(1).cast("bigint").alias("size_bytes"), F.lit("d").alias("digest"), "n_rows", F.lit(3).alias("n_columns"),
                 F.lit("2024-01-01 00:00:00").cast("timestamp").alias("processed_at")).write.parquet(root))
    absent = files.read_ledger(spark, f"{root}-absent", LEDGER).agg(F.count("*").alias("absent"))
    return files.read_ledger(spark, root).select("unit", "n_rows").crossJoin(absent)


@query("select o_orderstatus as unit, count(*) as n from orders group by 1")
def baseline_read(spark: SparkSession, sf: str) -> DataFrame:
    """Stored counts as a JSON map."""
    root = folder(spark)
    c = table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    c.agg(F.to_json(F.struct(F.lit("x").alias("source"), F.map_from_entries(F.collect_list(F.struct("o_orderstatus", "n"))).alias("counts"))).alias("value")).coalesce(1).write.text(root)
    return files.read_baseline(spark, root)


@query("""
select strftime(o_orderdate, '%Y') as partition, 'f' || (o_orderkey % 3) as path, count(*) as record_count, cast(sum(o_custkey) as bigint) as size_bytes from orders group by 1, 2
""")
def manifest_explode(spark: SparkSession, sf: str) -> DataFrame:
    """Files to a manifest in JSON, and back to one row a file."""
    root = folder(spark)
    f = (table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy").alias("partition"), F.concat(F.lit("f"), (F.col("o_orderkey") % 3).cast("string")).alias("path"))
         .agg(F.count("*").alias("record_count"), F.sum("o_custkey").alias("size_bytes")))
    sinks.manifest_json(sinks.manifest(f), "orders").select(F.col("json").alias("value")).coalesce(1).write.text(root)
    return files.manifest_files(files.read_manifest(spark, root)).select("partition", "path", "record_count", "size_bytes")


@query("""
select strftime(o_orderdate, '%Y') as partition, case when year(o_orderdate) = 1996 then 1 else count(*) end as total_records from orders group by 1, year(o_orderdate)
""")
def manifest_merge(spark: SparkSession, sf: str) -> DataFrame:
    """A partition processed again replaces its entry, the others stay."""
    f = (table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy").alias("partition")).agg(F.count("*").alias("record_count"))
         .withColumns({"path": F.lit("p"), "size_bytes": F.lit(1)}))
    new = f.filter("partition = '1996'").withColumn("record_count", F.lit(1).cast("bigint"))
    return sinks.merge_manifest(sinks.manifest(f), sinks.manifest(new)).select("partition", "total_records")


@query("""
select o_custkey::varchar as unit, case when o_custkey % 3 = 0 then 'new' else 'old' end as digest from orders group by o_custkey
""")
def ledger_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The units' rows are replaced, the others stay."""
    u = table(spark, sf, "orders").select(F.col("o_custkey").alias("k")).distinct()
    old = u.select(F.col("k").cast("string").alias("unit"), F.lit("old").alias("digest"))
    return sinks.upsert_ledger(old, u.filter("k % 3 = 0").select(F.col("k").cast("string").alias("unit"), F.lit("new").alias("digest")))


@query("""
select o_orderstatus as dataset, count(*) filter (o_orderkey % 10 <> 0) as in_sync, count(*) filter (o_orderkey % 10 = 0) as missing,
  case when count(*) filter (o_orderkey % 10 = 0) > 0 then 'outdated' else 'in_sync' end as overall from orders group by 1
""")
def status_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Details and summary written, and the summary read back."""
    root = folder(spark)
    d = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("dataset"), F.when(F.col("o_orderkey") % 10 == 0, "missing").otherwise("in_sync").alias("status"))
    sinks.write_status(d, sync.status_summary(d), root)
    return spark.read.schema("dataset string, in_sync bigint, missing bigint, overall string").json(f"{root}/summary")


@query("""
select 'u2' as source_unit, o_orderstatus, count(*) as n from orders where o_orderkey % 2 = 1 group by 2
union all select 'u1', o_orderstatus, count(*) from orders where o_orderkey % 2 = 0 and o_orderstatus = 'F' group by 2
""")
def replace_unit(spark: SparkSession, sf: str) -> DataFrame:
    """A unit written again leaves nothing of the first writing, not even keys it no longer has."""
    o, root = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), folder(spark)
    for unit, rows in (("u1", "o_orderkey % 2 = 0"), ("u2", "o_orderkey % 2 = 1"), ("u1", "o_orderkey % 2 = 0 and o_orderstatus = 'F'")):
        incremental.reprocess(lambda _, rows=rows: o.filter(rows), root, [unit], ["o_orderstatus"])
    return files.scan(spark, root).groupBy("source_unit", "o_orderstatus").agg(F.count("*").alias("n"))


@query("""
select case when o_orderkey % 3 = 0 then 'a' else 'b/2' end as source_unit, o_orderstatus, count(*) as n, min(o_orderkey) as least from orders
where o_orderkey % 3 = 0 and o_orderstatus <> 'O' or o_orderkey % 3 = 1 group by 1, 2
""")
def atomic_replace(spark: SparkSession, sf: str) -> DataFrame:
    """A unit is replaced; another's new version is written but its driver goes before it is made current; old ones go later."""
    o, root = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.create_map(F.lit("k"), F.col("o_custkey")).alias("m")), folder(spark)
    for unit, rows in (("a", "o_orderkey % 3 = 2"), ("b/2", "o_orderkey % 3 = 1"), ("a", "o_orderkey % 3 = 0 and o_orderstatus <> 'O'")):
        sinks.replace_source_unit(o.filter(rows), root, unit, ["o_orderstatus"], salt=3)
    units.write_version(o, root, "b/2", ["o_orderstatus"], sinks.MOST_ROWS)
    units.remove_old(spark, root, older_than_s=0)
    return files.scan(spark, root).groupBy(F.regexp_replace("source_unit", "%2F", "/").alias("source_unit"), "o_orderstatus").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("least"))


@query("select count(*) as rows_in, count(*) as rows_out, 3::bigint as columns_in, 3::bigint as columns_out, true as same from supplier")
def roundtrip_check(spark: SparkSession, sf: str) -> DataFrame:
    """What was written is what there was."""
    root, s = folder(spark), table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    s.write.parquet(root)
    return sync.same_after_write(s, root).withColumns({c: F.col(c).cast("bigint") for c in ("columns_in", "columns_out")})


@query(f"with {REGION_SQL} select o_orderkey, o_orderstatus from keyed where p_uf = 'AS' and p_ano = '1999'")
def api_microdata(spark: SparkSession, sf: str) -> DataFrame:
    """K3: one state and year; only its folders are read."""
    root = folder(spark)
    sinks.write_partitioned(_keyed(spark, sf), root, ["p_ano", "p_uf"])
    return api.microdata(spark, root, "AS", "1999").select("o_orderkey", "o_orderstatus")


@query("""select unnest(['ok', 'missing', 'mismatch']) as result, unnest([2, 1, 1])::bigint as n""")
def api_validate(spark: SparkSession, sf: str) -> DataFrame:
    """K5: files against the manifest's digests, of which one is wrong and one has no file."""
    root, where = folder(spark), folder(spark)
    table(spark, sf, "nation").repartition(3).write.parquet(root)
    name = F.regexp_replace("path", r"^.*/(?=[^/]+$)", "")
    d = files.digests(spark, root).select(name.alias("path"), "size_bytes", "sha256").persist()
    bad = d.agg(F.min("path").alias("bad"))
    entry = d.crossJoin(bad).select("path", "size_bytes", F.when(F.col("path") == F.col("bad"), "0").otherwise(F.col("sha256")).alias("sha256"))
    gone = spark.createDataFrame([("gone.parquet", 1, "0")], "path string, size_bytes bigint, sha256 string")
    body = F.collect_list(F.struct("path", "size_bytes", "sha256"))
    m = entry.unionByName(gone).agg(F.to_json(F.struct(F.lit("nation").alias("dataset"), F.create_map(F.lit("all"), F.struct(body.alias("output_files"))).alias("partitions"))).alias("value"))
    m.coalesce(1).write.text(where)
    return api.validate_local(spark, root, where).groupBy("result").agg(F.count("*").alias("n"))


@query("select event_id, event_type, user_id from events")
def incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Files that come in two lots are taken in bounded batches, each row once."""
    e, root = table(spark, sf, "events").select("event_id", "event_type", "user_id"), folder(spark)
    for lot in range(2):
        e.filter(F.col("event_id") % 2 == lot).repartition(3).write.mode("append").parquet(f"{root}/in")
        incremental.ingest_new(spark, f"{root}/in", e.schema, f"{root}/out", f"{root}/progress", files=2)
    return files.scan(spark, f"{root}/out").select("event_id", "event_type", "user_id")


@query("""
select o_custkey::varchar as unit, case when o_custkey % 4 = 0 then 'new' else 'updated' end as status from orders where o_custkey % 4 in (0, 1) group by o_custkey
""")
def units_to_process(spark: SparkSession, sf: str) -> DataFrame:
    """New and changed units by the ledger."""
    k = table(spark, sf, "orders").select("o_custkey").distinct()
    unit = F.col("o_custkey").cast("string").alias("unit")
    inv = k.select(unit, F.lit(True).alias("exists"), F.lit("b").alias("etag"), F.lit(5).cast("bigint").alias("size_bytes"))
    led = k.filter("o_custkey % 4 <> 0").select(unit, F.when(F.col("o_custkey") % 4 == 1, "a").otherwise("b").alias("etag"), F.lit(5).cast("bigint").alias("size_bytes"))
    return incremental.units_to_process(inv, led).select("unit", "status")


@query("select o_orderkey::varchar as unit from orders where o_orderkey % 7 = 0")
def resume_run(spark: SparkSession, sf: str) -> DataFrame:
    """What a run that broke off has left."""
    u = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("unit"), "o_orderkey")
    return incremental.resume(u.select("unit"), u.filter("o_orderkey % 7 <> 0").select("unit"))
