"""Edge values of codes and dates."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartorio.functions import codes as C
from cartorio.functions import dates as D
from cartorio.plans.catalogue import QUERIES
from cartorio.schemas import BIRTH_CONTROL, BIRTH_RENAMES, STATE_GROUP_A, UFS


def column(spark, f, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_keys_quarantine_and_rejects(spark):
    rows = [("2024-01-15", "AC"), ("1899-12-31", "SP"), ("2999-01-01", "SP"), ("202A-05-01", "SP"), ("2024", "SP"), (None, "SP"), ("2024-01-01", None), ("2024-01-01", "SPX")]
    df = C.derive_keys(spark.createDataFrame(rows, "d string, uf string"), "d", "uf").withColumn("why", C.key_reject())
    assert [r["why"] for r in df.collect()] == [None, None, None, None, "month", "year", "state", "state"]
    kept = C.drop_unkeyed(df).withColumn("p_ano", C.quarantine_year(F.col("p_ano"), "2020", "2026"))
    assert [r["p_ano"] for r in kept.collect()] == ["2024", "_invalid", "_invalid", "_invalid"]


def test_flip_date(spark):
    assert column(spark, D.flip_date, ["19940810", "00000000", "1994081", None]) == ["10081994", "00000000", "1994081", None]


@pytest.mark.parametrize("style,text,out", [
    ("iso", "2022-03-10T00:00:00.000Z", "2022-03-10"), ("iso", "2022-13-10", None), ("ymd", "19980101", "1998-01-01"), ("dmy", "10081994", "1994-08-10"),
    ("short", "940929", "1994-09-29"), ("short", "000000", None), ("ymd", "00000000", None), ("ymd", "1998011", None)])
def test_parse_date(spark, style, text, out):
    assert column(spark, lambda c: D.parse_date(c, style).cast("string"), [text]) == [out]


def test_century_pivot_is_a_parameter(spark):
    assert column(spark, lambda c: D.parse_date(c, "short", pivot=30).cast("string"), ["601217"]) == ["1960-12-17"]
    assert column(spark, lambda c: D.parse_date(c, "short").cast("string"), ["601217"]) == ["2060-12-17"]


def test_codes(spark):
    assert column(spark, C.municipality6, ["1200401", "120040", None]) == ["120040", "120040", None]
    assert column(spark, C.decimal_comma, ["64,86", "39.87", "x", "", None]) == [64.86, 39.87, None, None, None]
    assert column(spark, lambda c: C.repair_code(c, 2), ["3.0", "03", "10.0", "3"]) == ["03", "03", "10", "03"]
    assert column(spark, C.age_unit, ["105", "230", "301", "415", "500", "99", "x"]) == [1, 2, 3, 4, 0, 0, None]
    assert column(spark, lambda c: C.age_band(C.age_months(c)), ["105", "229", "230", "311", "312", "403", "415", "470", "999"]) == [
        "menor_1_mes", "menor_1_mes", "menor_1_ano", "menor_1_ano", "1_ano", "3_anos", "15_49_anos", "60_anos_e_mais", None]
    assert column(spark, C.size_text, ["999", "1000", "1500000", "2000000000", None]) == ["999 B", "1.0 KB", "1.5 MB", "2.0 GB", None]


def test_sizes_beyond_doubles_and_64_bits(spark):
    sizes = [90000000000049999999, 9007199254749999999, 88127783999999999949999999, 10**18 - 1]
    assert column(spark, C.size_text, [str(n) for n in sizes]) == [f"{t // 10}.{t % 10} GB" for t in ((n + 5 * 10**7) // 10**8 for n in sizes)]


def test_size_format_of_large_keys(spark, tmp_path):
    rows = [(0, 1), (11, 1), (199_999, 50), (1_199_999, 50), (7_199_999, 50), (3, None)]
    spark.createDataFrame(rows, "p_partkey long, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    got = {r["p_partkey"]: r["size_text"] for r in QUERIES["size_format"](spark, str(tmp_path)).collect()}
    tenths = {k: (k**3 * (s + 1) + 5 * 10**7) // 10**8 for k, s in rows[2:5]}
    assert got == {0: "0 B", 11: "2.7 KB", 3: None} | {k: f"{t // 10}.{t % 10} GB" for k, t in tenths.items()}


def test_file_names(spark):
    names = ["DPNIAC94.DBF", "CPNISP05.DBF", "DNAC2015.dbc", "DNRSP1994.dbc", "RDSP9208.dbc", "RDSP0801.dbc", "README.md", None]
    got = column(spark, lambda c: C.parse_file_name(c), names)
    assert [tuple(g) for g in got] == [("DPNI", "AC", 1994, None), ("CPNI", "SP", 2005, None), ("DN", "AC", 2015, None), ("DNR", "SP", 1994, None),
                                       ("RD", "SP", 1992, 8), ("RD", "SP", 2008, 1), (None,) * 4, (None,) * 4]
    assert column(spark, lambda c: C.file_name("routine", F.lit(""), F.lit(2020), c), ["1", "12"]) == ["vacinacao_jan_2020.json", "vacinacao_dez_2020.json"]


def test_birth_names(spark):
    old = spark.createDataFrame([tuple("x" * (len(BIRTH_RENAMES) + len(BIRTH_CONTROL)))], [*BIRTH_RENAMES, *BIRTH_CONTROL])
    new = C.drop_any(C.rename_map(old, BIRTH_RENAMES), BIRTH_CONTROL)
    assert new.columns == list(BIRTH_RENAMES.values())


def test_states():
    assert len(UFS) == 27 and set(STATE_GROUP_A) < set(UFS)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789-AX", max_size=10)), min_size=1, max_size=20))
def test_every_row_is_valid_or_rejected(spark, texts):
    from cartorio.operators.sync import account

    df = C.derive_keys(spark.createDataFrame([(t, "SP") for t in texts], "d string, uf string"), "d", "uf")
    assert sum(r["n"] for r in account(df, C.key_reject()).collect()) == len(texts)


def test_rule_tables(spark):
    from cartorio import rules

    d = {(r["year"], r["age_group"], r["state_group"]): (r["source"], r["source_year"]) for r in rules.denominators(spark).collect()}
    assert d[1999, "1", "B"] == ("IBGE", 1999) and d[2000, "1", "B"] == ("SINASC", 2000) and d[2003, "1", "B"] == ("SINASC", 2002) and d[2003, "<1", "A"] == ("IBGE", 2003)
    assert d[2006, "1", "A"] == ("SINASC", 2005) and d[2010, "<1", "A"] == ("SINASC", 2009) and d[2010, "1", "A"] == ("SINASC", 2009) and d[2012, "1", "B"] == ("SINASC", 2009)
    assert rules.no_data(spark).groupBy("year").count().orderBy("year").collect()[0]["count"] == 12
    assert rules.state_groups(spark).filter("state_group = 'A'").count() == 12
    assert rules.indicators(spark).filter("year_to < year_from").count() == 0 and rules.dropout_rules(spark).count() == 9
