"""What is kept beside the data: merged profiles, footers, digests of buckets, pruned scans, and snapshots followed to the end."""

import json
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cartorio import sinks, units
from cartorio.operators import merged
from cartorio.operators import profile as P
from cartorio.sources import files, footers
from cartorio.streaming import incremental


def plain_profile(values):
    filled = sorted({v for v in values if v})
    return len(values), values.count(None), values.count(""), filled[:4], filled[-4:]


def test_profiles_merge_without_the_data(spark, tmp_path):
    r = random.Random(3)
    rows = [(r.choice(["u1", "u2", None]), r.choice([None, "", *(f"{k:03d}" for k in range(30))]), str(k), None) for k in range(3000)]
    df = spark.createDataFrame(rows, "unit string, code string, id string, none string").repartition(4)
    stored = merged.unit_profiles(df, "unit", ["code", "id", "none"])
    assert stored.count() == 9
    for unit in ("u1", "u2"):
        stored.filter(F.col("unit") == unit).write.parquet(str(tmp_path / unit))
    back = spark.read.parquet(str(tmp_path / "u1")).unionByName(spark.read.parquet(str(tmp_path / "u2")))
    out = {r["column_name"]: r for r in merged.merge_profiles(back).collect()}
    for k, name in enumerate(("code", "id", "none"), 1):
        values = [row[k] for row in rows if row[0] is not None]
        x = out[name]
        assert (x["n_rows"], x["nulls"], x["empties"], x["first_values"], x["last_values"]) == plain_profile(values)
        assert abs(x["distinct_about"] - len({v for v in values if v is not None})) <= 0.05 * len(values)
    assert out["code"]["leading_zero"] and not out["id"]["leading_zero"] and out["none"]["integer_share"] is None and out["id"]["integer_share"] == 1
    exact = {r["column_name"]: tuple(r)[1:] for r in merged.value_ends(df, ["code", "none"]).collect()}
    assert exact == {"code": (["000", "001", "002", "003"], ["026", "027", "028", "029"]), "none": ([], [])}
    assert "WindowGroupLimit" in merged.value_ends(df, ["code"])._jdf.queryExecution().executedPlan().toString()


def test_footers_tell_rows_types_and_bounds(spark, tmp_path):
    pq.write_table(pa.table({"a": pa.array([3, None, 1, 9], pa.int32()), "s": ["x", "é", "b", None]}), tmp_path / "1.parquet", row_group_size=2)
    pq.write_table(pa.table({"a": pa.array([], pa.string())}), tmp_path / "2.parquet")
    pq.write_table(pa.table({"a": pa.array([7], pa.int32())}), tmp_path / "3.parquet", write_statistics=False)
    got = {(r["path"][-9:], r["column_name"]): tuple(r)[1:3] + tuple(r)[4:] for r in footers.footers(spark, str(tmp_path)).collect()}
    assert got[("1.parquet", "a")] == (4, 2, "int32", 1, "1", "9") and got[("1.parquet", "s")] == (4, 2, "string", 1, "b", "é")
    assert got[("2.parquet", "a")][0] == 0 and got[("2.parquet", "a")][4:] == (None, None)
    assert got[("3.parquet", "a")] == (1, 1, "int32", None, None, None)


def test_footers_read_no_data(spark, tmp_path):
    """A file whose pages are destroyed still has its footer."""
    pq.write_table(pa.table({"a": list(range(1000))}), tmp_path / "1.parquet", use_dictionary=False)
    raw = bytearray((tmp_path / "1.parquet").read_bytes())
    raw[4:2000] = bytes(1996)
    (tmp_path / "1.parquet").write_bytes(raw)
    assert footers.row_counts(footers.footers(spark, str(tmp_path))).first()["rows"] == 1000


def test_only_buckets_that_differ_are_joined(spark):
    r = random.Random(5)
    rows = [(k, r.choice([None, "", "07", "7"]), str(k)) for k in range(2000)]
    changed = [(k, *(("7.0" if k % 500 == 0 else a), b)) for k, a, b in rows if k != 77] + [(5000, "x", "y")]
    a, b = (spark.createDataFrame(x, "k long, a string, b string").repartition(3) for x in (rows, changed))
    plain = P.compare_formats(a, b, "k", ["a", "b"])
    quick = P.compare_by_digests(a, b, "k", ["a", "b"], 64)
    assert sorted(map(tuple, quick.collect())) == sorted(map(tuple, plain.select(quick.columns).collect()))
    found = P.differing_buckets(a, b, "k", ["a", "b"], 64)
    assert 1 <= found.filter("not same").count() <= 6 and found.agg(F.sum("rows_a")).first()[0] == 2000
    assert P.differing_buckets(a, a.repartition(7), "k", ["a", "b"], 64).filter("not same").isEmpty()
    swapped = a.select("k", F.col("b").alias("a"), F.col("a").alias("b"))
    assert not P.differing_buckets(a, swapped, "k", ["a", "b"], 64).filter("not same").isEmpty()  # columns count, and so do nulls
    same = P.compare_by_digests(a, a, "k", ["a"])
    assert tuple(same.first()) == ("a", 2000, 0, 0, 0)


def partition_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x.split("]")[0] for x in plan.split("PartitionFilters: [")[1:]], plan


def test_chosen_partitions_are_the_only_ones_read(spark, tmp_path, monkeypatch):
    df = spark.range(600).select("id", (F.col("id") % 10).cast("string").alias("p_ano"), F.when(F.col("id") % 3 == 0, "AC").otherwise("SP").alias("p_uf"))
    sinks.write_partitioned(df, str(tmp_path / "t"), ["p_ano", "p_uf"])
    chosen = spark.createDataFrame([("1", "AC"), ("4", "SP"), ("4", "SP"), (None, "AC")], "p_ano string, p_uf string")
    out = files.sampled_scan(files.scan(spark, str(tmp_path / "t")), chosen, ["p_ano", "p_uf"])
    told, _ = partition_filters(out)
    assert told and "p_ano" in told[0] and "AC" in told[0]
    assert out.select(F.input_file_name().alias("f")).select(F.regexp_extract("f", "p_ano=(.)", 1)).distinct().count() == 2
    want = sorted(i for i in range(600) if (i % 10, i % 3 == 0) in ((1, True), (4, False)))
    assert sorted(r["id"] for r in out.collect()) == want
    read = out._jdf.queryExecution().executedPlan()
    scans = [leaf for leaf in [read.collectLeaves().apply(k) for k in range(read.collectLeaves().size())]]
    assert scans[0].selectedPartitions().totalNumberOfFiles() <= 4  # of 20 folders
    monkeypatch.setattr(files, "CHOSEN", 1)
    assert sorted(r["id"] for r in files.sampled_scan(files.scan(spark, str(tmp_path / "t")), chosen, ["p_ano", "p_uf"]).collect()) == want
    assert files.sampled_scan(df, chosen.limit(0), ["p_ano"]).count() == 0


SNAPSHOT = "unit string, exists boolean, etag string, size_bytes bigint, seen int"


class Killed(RuntimeError):
    """Ends the query where it stands."""


@pytest.fixture
def world(spark, tmp_path):
    """(tell, run, calls, rows): snapshots as files, a run over them, what it read, and the rows below the root."""
    (tmp_path / "in").mkdir()
    calls, number = [], [0]

    def tell(*rows):
        number[0] += 1
        body = "\n".join(json.dumps({"unit": u, "exists": True, "etag": e, "size_bytes": 1, "seen": number[0]}) for u, e in rows)
        (tmp_path / "in" / f"{number[0]}.json").write_text(body)
        now.update(rows)

    now = {}

    def read(unit):
        calls.append(unit)
        return spark.createDataFrame([(now[unit], "k")], "v string, k string")

    run = lambda: incremental.follow(spark, str(tmp_path / "in"), SNAPSHOT, str(tmp_path / "out"), str(tmp_path / "noted"), read, ["k"])
    rows = lambda: {r["source_unit"]: r["v"] for r in files.scan(spark, str(tmp_path / "out")).collect()}
    return tell, run, calls, rows


def test_each_change_is_written_once(world):
    tell, run, calls, rows = world
    tell(("a", "1"), ("b", "1"))
    run()
    assert calls == ["a", "b"] and rows() == {"a": "1", "b": "1"}
    tell(("a", "1"), ("b", "2"), ("c", "1"))
    tell(("b", "3"))
    run()
    assert calls == ["a", "b", "b", "c"] and rows() == {"a": "1", "b": "3", "c": "1"}
    run()
    assert len(calls) == 4


@pytest.mark.parametrize("after", [False, True])
def test_a_killed_run_repeats_nothing_and_loses_nothing(world, monkeypatch, after):
    """Killed at its second unit, just before or just after that became current; the stream hasn't noted the batch."""
    tell, run, calls, rows = world
    tell(("a", "1"), ("b", "1"), ("c", "1"))
    real = units.commit

    def fatal(spark, root, unit, *rest):
        if unit == "b":
            if after:
                real(spark, root, unit, *rest)
            raise Killed
        real(spark, root, unit, *rest)

    monkeypatch.setattr(units, "commit", fatal)
    with pytest.raises(Exception, match="Killed|foreachBatch|FOREACH_BATCH"):
        run()
    monkeypatch.setattr(units, "commit", real)
    assert calls == ["a", "b"]
    run()
    assert calls == (["a", "b", "c"] if after else ["a", "b", "b", "c"]) and rows() == {"a": "1", "b": "1", "c": "1"}
