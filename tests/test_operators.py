"""Truth tables, fan-out guards, reprocessing and plans."""

import json
import os
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from cartorio import api, sinks
from cartorio.functions import codes
from cartorio.operators import aggregates, joins, profile, sync, windows
from cartorio.plans.catalogue import QUERIES
from cartorio.sources import dbf, dictionaries, files
from cartorio.streaming import incremental

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("error,source,copy,old,new,a,b,status", [
    ("x", True, True, "a", "a", 1, 1, "check_failed"), (None, False, False, None, None, None, None, "not_published"), (None, True, False, None, "a", None, 1, "missing"),
    (None, False, True, "a", None, 1, None, "extra"), (None, True, True, "a", "b", 1, 1, "outdated"), (None, True, True, "a", "a", 10, 11, "outdated"),
    ("", True, True, None, "b", 10, 11, "outdated"), (None, True, True, "", "b", 10, 10, "in_sync"), (None, True, True, "a", "a", 0, 11, "in_sync"), (None, True, True, None, None, None, None, "in_sync")])
def test_classify_sync(spark, error, source, copy, old, new, a, b, status):
    df = spark.createDataFrame([(error, source, copy, old, new, a, b)], "e string, s boolean, c boolean, o string, n string, a long, b long")
    assert df.select(sync.classify_sync(*(F.col(c) for c in "esconab"))).first()[0] == status


@pytest.mark.parametrize("source,copy,stored,status,note", [
    (None, False, None, "not_published", None), (0, False, None, "not_published", None), (5, False, None, "missing", None), (None, True, 5, "extra", None), (0, True, 5, "extra", None),
    (5, True, None, "in_sync", "no stored count"), (5, True, 0, "in_sync", "no stored count"), (7, True, 5, "outdated", "2 new records (5 -> 7)"),
    (5, True, 7, "outdated", "2 fewer records (7 -> 5)"), (5, True, 5, "in_sync", None)])
def test_classify_counts(spark, source, copy, stored, status, note):
    df = spark.createDataFrame([(source, copy, stored)], "s long, c boolean, m long")
    got = df.select(sync.classify_counts(F.col("s"), F.col("c"), F.col("m")).alias("x")).first()[0]
    assert (got["status"], got["note"]) == (status, note)


def test_a_copied_file_counts_with_all_its_parts(spark, tmp_path):
    here, there = str(tmp_path / "here"), str(tmp_path / "there")
    rows = spark.range(100).select("id", F.when(F.col("id") < 70, "a").otherwise("b").alias("k"))
    sinks.write_partitioned(rows, here, ["k"], most_rows=20)
    shutil.copytree(here, there)
    found = lambda: files.whole_files(spark, here), lambda: files.whole_files(spark, there)
    assert {(r["path"], r["parts"]) for r in found[0]().collect()} == {("k=a", 4), ("k=b", 2)}
    assert tuple(sync.copied_enough(*(f() for f in found)).first()) == (2, 2, True)
    os.remove(next((tmp_path / "there" / "k=a").glob("*.parquet")))
    assert tuple(sync.copied_enough(*(f() for f in found)).first()) == (2, 1, False)
    assert tuple(sync.copied_enough(found[1](), found[0]()).first()) == (2, 2, True)


def test_copies_of_large_years_and_rows_without_one(spark, tmp_path):
    """A year of over 500,000 rows is written in parts."""
    date = F.when(F.col("id") % 20 == 0, "1996-01-01").when(F.col("id") % 1000 != 1, "1995-01-01").cast("timestamp")
    spark.range(600_000).select(F.col("id").alias("o_orderkey"), date.alias("o_orderdate")).write.parquet(str(tmp_path / "orders.parquet"))
    assert QUERIES["copied_counts"](spark, str(tmp_path)).first().asDict() == {"local_files": 2, "remote_files": 1, "enough": False}


def test_decode_never_multiplies_rows(spark):
    d = spark.createDataFrame([(1, "A", "00-99"), (2, "B", "62"), (3, "C", "62,7"), (4, "D", None)], "line_no int, label string, source_codes string")
    df = spark.createDataFrame([("62",), ("05",), ("7",), ("x",), (None,)], "code string")
    got = {r["code"]: r["label"] for r in joins.decode(df, d, "code").collect()}
    assert got == {"62": "B", "05": "A", "7": "C", "x": None, None: None}
    assert joins.ambiguous_codes(d).collect()[0]["source_code"] == "62"


def test_dictionary_file(spark, tmp_path):
    body = "  4 2\n     06  Hepatite A (HA)        88,45\n     07  Com  vão duplo        12\r\n     08  Sem códigos\n     09  Faixa            00-99\n"
    (tmp_path / "d.cnv").write_bytes(body.encode("latin-1"))
    rows = dictionaries.read_code_dictionary(spark, str(tmp_path / "d.cnv")).orderBy("code").collect()
    assert [(r["code"], r["label"], r["source_codes"]) for r in rows] == [
        ("06", "Hepatite A (HA)", "88,45"), ("07", "Com  vão duplo", "12"), ("08", "Sem códigos", None), ("09", "Faixa", "00-99")]
    assert dictionaries.count_faults(dictionaries.read_code_dictionary(spark, str(tmp_path / "d.cnv"))).count() == 0


def test_dbf(spark, tmp_path):
    rows = [("12", "Acre é"), ("13", None), ("14", "Amapá"), ("15", "x" * 30), ("16", "")]
    (tmp_path / "t.dbf").write_bytes(dbf.dbf_bytes([("UF", 2), ("NOME", 20)], rows))
    from cartorio.session import ship

    ship(spark)
    got = [tuple(r) for r in dbf.read_dbf(spark, str(tmp_path / "t.dbf"), records=2).orderBy("UF").collect()]
    assert got == [("12", "Acre é"), ("13", None), ("14", "Amapá"), ("15", "x" * 20), ("16", None)]
    (tmp_path / "e.dbf").write_bytes(dbf.dbf_bytes([("UF", 2)], []))
    assert dbf.read_dbf(spark, str(tmp_path / "e.dbf")).count() == 0


def test_dbf_folder(spark, tmp_path):
    (tmp_path / "in" / "x").mkdir(parents=True)
    (tmp_path / "in" / "a.dbf").write_bytes(dbf.dbf_bytes([("UF", 2), ("NOME", 20)], [("12", "Acre é"), ("13", None)]))
    raw = bytearray(dbf.dbf_bytes([("UF", 2), ("ANO", 4)], [("14", "1994"), ("15", "1995")]))
    raw[-8 - 7] = ord("*")  # the first record is deleted
    (tmp_path / "in" / "x" / "b.DBF").write_bytes(bytes(raw))
    (tmp_path / "in" / "e.dbf").write_bytes(dbf.dbf_bytes([("UF", 2)], []))
    (tmp_path / "in" / "note.txt").write_text("x")
    from cartorio.session import ship

    ship(spark)
    got = dbf.read_dbf_folder(spark, str(tmp_path / "in"))
    assert got.columns == ["_path", "ANO", "NOME", "UF"]
    assert sorted((tuple(r)[1:] for r in got.collect()), key=str) == [("1995", None, "15"), (None, "Acre é", "12"), (None, None, "13")]
    assert dbf.read_dbf_folder(spark, str(tmp_path / "in"), ["UF"]).columns == ["_path", "UF"]


def test_files_are_validated_by_their_path_below_the_root(spark, tmp_path):
    root = str(tmp_path / "tree")
    for uf in ("AC", "SP"):
        spark.createDataFrame([(uf,)], "v string").coalesce(1).write.parquet(f"{root}/uf={uf}")
    for part in (tmp_path / "tree").glob("*/*.parquet"):
        part.rename(part.parent / "part-0.parquet")
    rows = [{"path": r["path"], "sha256": r["sha256"]} for r in files.digests(spark, root).collect()]
    for start in ("", f"{root}/", None):  # relative, absolute and whole paths in the manifest
        listed = [{**r, "path": r["path"] if start is None else start + r["path"].split("/tree/")[1]} for r in rows]
        (tmp_path / "m.json").write_text(json.dumps({"dataset": "d", "partitions": {"all": {"output_files": listed}}}))
        got = api.validate_local(spark, root, str(tmp_path / "m.json")).collect()
        assert sorted(map(tuple, got)) == [("uf=AC/part-0.parquet", "ok"), ("uf=SP/part-0.parquet", "ok")]


def test_routine_file_names(spark):
    names = ["vacinacao_mar_2024.json", "vacinacao_xyz_2024.json", "DNSP2003.dbc", "RDSP0811.dbc", "DPNISP99.DBF", None]
    got = [r[0] and tuple(r[0]) for r in spark.createDataFrame([(n,) for n in names], "n string").select(codes.parse_file_name(F.col("n"))).collect()]
    assert got == [("routine", None, 2024, 3), (None, None, None, None), ("DN", "SP", 2003, None), ("RD", "SP", 2008, 11), ("DPNI", "SP", 1999, None), (None, None, None, None)]


@pytest.mark.parametrize("small", [10_000, 1])
def test_rules_in_force(spark, monkeypatch, small):
    """Few rules and many, which are joined another way, give the same rows."""
    monkeypatch.setattr(joins, "SMALL", small)
    rules = spark.createDataFrame([("a", 1994, 2002), ("b", None, 2000), ("c", 2001, None), ("d", None, None), ("e", 2050, 2060), ("f", 2005, 2001)], "rule string, lo int, hi int")
    df = spark.createDataFrame([(1990,), (2001,), (2001,), (2010,), (None,)], "year int")
    got = sorted((r["year"] or 0, r["rule"]) for r in joins.valid_rules(df, rules, "year", "lo", "hi").filter("year is not null").collect())
    assert got == [(1990, "b"), (1990, "d"), (2001, "a"), (2001, "a"), (2001, "c"), (2001, "c"), (2001, "d"), (2001, "d"), (2010, "c"), (2010, "d")]


def test_rows_equal_but_for_some_columns(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 5), (3, "b", 5)], "id int, k string, v int")
    assert sorted((r["k"], r["v"]) for r in aggregates.drop_duplicates_ignoring(df, ["id"]).collect()) == [("a", 5), ("b", 5)]


def test_rejects_are_told_as_metrics(spark, tmp_path):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    kept = sync.observed(df, "reject_metrics", F.when(F.col("v").isNull(), "empty"))
    assert kept.count() == 3 and kept.columns == ["v"]


def test_ranks_are_shared_by_equal_volumes(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), ("c",)], "k string")
    assert sorted((r["k"], r["volume"], r["place"]) for r in windows.ranked(df, ["k"]).collect()) == [("a", 2, 1), ("b", 2, 1), ("c", 1, 3)]


def test_readers_pass_over_other_files(spark, tmp_path):
    root = str(tmp_path / "data")
    df = spark.createDataFrame([("1", "2024", "01", "AC"), ("2", "2024", "02", "SP")], "v string, p_ano string, p_mes string, p_uf string")
    sinks.write_partitioned(df, root, ["p_ano", "p_mes", "p_uf"])
    (tmp_path / "data" / "README.md").write_text("x")
    (tmp_path / "data" / "manifest.json").write_text("{}")
    got = files.scan(spark, root, F.col("p_mes") == "01")
    assert [tuple(r) for r in got.select("v", "p_mes").collect()] == [("1", "01")]
    assert "p_mes" in got._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:200]


def test_reprocessing_a_unit_twice_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "u")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string")
    for _ in range(2):
        sinks.replace_source_unit(df, root, "m1", ["k"])
    sinks.replace_source_unit(df.filter("k = 'a'"), root, "m1", ["k"])
    assert [tuple(r) for r in files.scan(spark, root).select("v", "k", "source_unit").collect()] == [(1, "a", "m1")]


def test_stream_takes_each_file_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    df = spark.range(10)
    df.repartition(3).write.parquet(src)
    for _ in range(2):
        incremental.ingest_new(spark, src, df.schema, out, ck, files=1)
    assert spark.read.parquet(out).count() == 10


def test_profile_is_one_pass_and_safe_on_empty(spark):
    df = spark.createDataFrame([("01", "2024-01-02"), ("", None), ("10", "2024-01-03")], "a string, b string")
    got = {r["column_name"]: r for r in profile.suggest_type(profile.profile(df, ["a", "b"])).collect()}
    assert got["a"]["suggestion"] == "string" and got["a"]["leading_zero"] and got["a"]["empties"] == 1
    assert got["b"]["suggestion"] == "date" and got["b"]["nulls"] == 1
    assert profile.profile(df.limit(0), ["a"]).collect() == []


def test_rates_guard_zero(spark):
    df = spark.createDataFrame([(63, 158), (144, 222), (1, 0), (None, 5)], "n int, d int")
    assert [r[0] and round(r[0], 2) for r in df.select(aggregates.percent(F.col("n"), F.col("d"))).collect()] == [39.87, 64.86, None, None]


def test_series_tags_its_break(spark):
    df = spark.createDataFrame([(2018, 1), (2019, 2), (2020, 3)], "year int, n int")
    got = [(r["year"], r["source"], r["series_break"]) for r in windows.series(df, df, "year", 2020).orderBy("year").collect()]
    assert got == [(2018, "aggregated", False), (2019, "aggregated", False), (2020, "microdata", True)]


def test_aggregates_shuffle_once(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 7)
    plan = aggregates.count_by(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan


def test_manifest_round_trip(spark, tmp_path):
    f = spark.createDataFrame([("2024-AC", "p1", 3, 10), ("2024-AC", "p0", 2, 5), ("2024-SP", None, None, None)], "partition string, path string, record_count long, size_bytes long")
    text = sinks.manifest_json(sinks.manifest(f), "d").first()[0]
    assert list(json.loads(text)["partitions"]) == ["2024-AC", "2024-SP"]
    (tmp_path / "m.json").write_text(text)
    rows = files.manifest_files(files.read_manifest(spark, str(tmp_path / "m.json"))).orderBy("partition", "path").collect()
    assert [(r["partition"], r["path"], r["record_count"]) for r in rows] == [("2024-AC", "p0", 2), ("2024-AC", "p1", 3), ("2024-SP", None, None)]


def test_the_rest_imports_without_the_optional_subpackage(tmp_path):
    shutil.copytree(REPO, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})


def test_encoding_check_reads_the_texts(spark, tmp_path):
    from cartorio.plans.q_aggregates import encoding_check

    texts = ["plain", "caf\u00c3\u00a9", "caf\u00e9", None, None, "lost \ufffd"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [tuple(r) for r in encoding_check(spark, str(tmp_path)).collect()] == [("text", 4)]  # 1 and 5, and planted in 0 and 4
