"""Replacing a source unit: whatever fails, and wherever, the old rows are read until the new ones are all there."""

import pytest
from pyspark.sql import functions as F

from cartorio import sinks, units
from cartorio.sources import files


def rows(spark, root):
    return sorted((r["v"], r["k"], r["source_unit"]) for r in files.scan(spark, root).select("v", "k", "source_unit").collect())


@pytest.fixture
def root(spark, tmp_path):
    sinks.replace_source_unit(spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string"), str(tmp_path), "m/1", ["k"])
    sinks.replace_source_unit(spark.createDataFrame([(9, "a")], "v int, k string"), str(tmp_path), "m2", ["k"])
    return str(tmp_path)


OLD = [(1, "a", "m%2F1"), (2, "b", "m%2F1"), (9, "a", "m2")]


def test_a_unit_is_replaced_whole(spark, root):
    assert [(v, k, u.replace("/", "%2F")) for v, k, u in rows(spark, root)] == OLD
    sinks.replace_source_unit(spark.createDataFrame([(5, "c")], "v int, k string"), root, "m/1", ["k"])
    assert [r[:2] for r in rows(spark, root)] == [(5, "c"), (9, "a")]
    assert sorted((r["unit"], r["rows"]) for r in units.current(spark, root).collect()) == [("m/1", 1), ("m2", 1)]


@pytest.mark.parametrize("salt", [1, 3])
def test_a_write_that_fails_in_its_tasks_leaves_the_old_rows(spark, root, salt):
    bad = spark.range(1000).select(F.when(F.col("id") == 999, F.raise_error("no such date").cast("int")).otherwise(F.col("id").cast("int")).alias("v"), F.lit("a").alias("k"))
    with pytest.raises(Exception, match="no such date"):
        sinks.replace_source_unit(bad, root, "m/1", ["k"], salt=salt)
    assert [r[:2] for r in rows(spark, root)] == [r[:2] for r in OLD]


def test_a_file_format_that_refuses_a_value_leaves_the_old_rows(spark, root):
    """The writer itself fails, after the shuffle: an old date under the rebase mode that raises."""
    key = "spark.sql.parquet.datetimeRebaseModeInWrite"
    before = spark.conf.get(key)
    spark.conf.set(key, "EXCEPTION")
    try:
        with pytest.raises(Exception):
            sinks.replace_source_unit(spark.sql("select 1 as v, date '1400-01-01' as d, 'a' as k"), root, "m/1", ["k"])
    finally:
        spark.conf.set(key, before)
    assert [r[:2] for r in rows(spark, root)] == [r[:2] for r in OLD]


def test_a_driver_that_goes_before_the_commit_leaves_the_old_rows(spark, root, monkeypatch):
    def gone(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(units, "commit", gone)
    with pytest.raises(KeyboardInterrupt):
        sinks.replace_source_unit(spark.createDataFrame([(5, "c")], "v int, k string"), root, "m/1", ["k"])
    monkeypatch.undo()
    assert [r[:2] for r in rows(spark, root)] == [r[:2] for r in OLD]
    assert units.remove_old(spark, root) == []  # it may still be at work
    left = units.remove_old(spark, root, older_than_s=0)
    assert len(left) == 1 and "source_unit=m%2F1" in left[0]
    assert [r[:2] for r in rows(spark, root)] == [r[:2] for r in OLD]


def test_lost_rows_are_not_made_current(spark, root, monkeypatch):
    import glob
    import os

    real = units.WriteMismatch
    count = type(spark.range(1)).count
    monkeypatch.setattr(type(spark.range(1)), "count", lambda self: count(self) - 1)
    with pytest.raises(real):
        sinks.replace_source_unit(spark.createDataFrame([(5, "c")], "v int, k string"), root, "m/1", ["k"])
    monkeypatch.undo()
    assert [r[:2] for r in rows(spark, root)] == [r[:2] for r in OLD]
    assert not [p for p in glob.glob(f"{root}/_units/.*") if not p.endswith(".crc")] and os.path.isdir(f"{root}/_units")


def test_no_rows_replace_a_unit_too(spark, root):
    sinks.replace_source_unit(spark.createDataFrame([], "v int, k string"), root, "m/1", ["k"])
    assert [r[:2] for r in rows(spark, root)] == [(9, "a")]


def test_any_rows_are_dealt_by_salt(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else such small parts become one file
    same = spark.range(3000).select(F.lit("a").alias("k"), F.create_map(F.lit(1), F.lit(2)).alias("m"))
    sinks.replace_source_unit(same, str(tmp_path / "maps"), "u", ["k"], salt=4)
    back = files.scan(spark, str(tmp_path / "maps"))
    assert back.count() == 3000 and back.select(F.input_file_name()).distinct().count() > 1 and back.columns == ["m", "source_unit", "k"]
    only_keys = spark.range(100).select(F.lit("a").alias("k"), F.lit("b").alias("j"), F.lit(1).alias("_deal"))
    sinks.write_partitioned(only_keys, str(tmp_path / "keys"), ["k", "j"], salt=4)
    assert files.scan(spark, str(tmp_path / "keys")).count() == 100
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
