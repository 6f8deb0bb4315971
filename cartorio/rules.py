"""Rule tables that the programme's documents state, as data. Codes of vaccines and doses aren't among them: they come
from dictionaries. All are small and fixed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartorio.schemas import NO_DATA, STATE_GROUP_A, UFS

# Indicator, component vaccine, dose, target population, target share, first and last year.
INDICATORS = (
    ("BCG", "BCG", "SD", "<1", 90.0, 1994, None),
    ("Hepatitis B", "HB", "D3", "<1", 95.0, 1994, None), ("Hepatitis B", "Penta", "D3", "<1", 95.0, 1994, None), ("Hepatitis B", "Hexa", "D3", "<1", 95.0, 1994, None),
    ("Hepatitis B newborn", "HB", "D", "<1m", None, 2014, None),
    ("Rotavirus", "Rotavirus", "D2", "<1", 90.0, 2006, None),
    ("Pneumo", "Pneumo 10V", "D3", "<1", 95.0, 2010, None), ("Pneumo", "Pneumo 13V", "D3", "<1", 95.0, 2010, None),
    ("Meningo C", "Meningo C", "D2", "<1", 95.0, 2010, None),
    ("Penta", "Penta", "D3", "<1", 95.0, 2012, None), ("Penta", "Hexa", "D3", "<1", 95.0, 2012, None),
    ("Poliomyelitis", "OPV", "D3", "<1", 95.0, 1994, None), ("Poliomyelitis", "IPV", "D3", "<1", 95.0, 1994, None), ("Poliomyelitis", "Hexa", "D3", "<1", 95.0, 1994, None),
    ("Poliomyelitis", "Penta inactivated", "D3", "<1", 95.0, 1994, None), ("Poliomyelitis", "Seq. IPV/OPV", "D3", "<1", 95.0, 1994, None),
    ("MMR D1", "MMR", "D1", "1", 95.0, 2000, None),
    ("MMR D2", "MMR", "D2", "1", 95.0, 2013, None), ("MMR D2", "MMRV", "SD", "1", 95.0, 2013, None),
    ("MMRV", "MMRV", "SD", "1", None, 2013, None),
    ("Hepatitis A", "Hepatitis A", "SD", "1", None, 2014, None),
    ("Yellow fever", "Yellow fever", "SD", "<1", 100.0, 1994, None), ("Yellow fever", "Yellow fever", "D1", "<1", 100.0, 1994, None),
    ("DTP boost", "DTP", "BOOST1", "1", 95.0, 1994, None),
    ("DTP", "DTP", "D3", "<1", 95.0, 1994, 2002),
    ("Measles", "Measles", "SD", "<1", 95.0, 1994, 2002),
    ("Hib", "Hib", "D3", "<1", 95.0, 1999, 2002),
    ("Tetra", "Tetra", "D3", "<1", 95.0, 2003, 2012),
)

# Indicator, first dose, last dose, first and last year of the dropout rate.
DROPOUT = (("Hepatitis B", "D1", "D3", 1994, None), ("Rotavirus", "D1", "D2", 2006, None), ("Pneumo", "D1", "D3", 2010, None), ("Meningo C", "D1", "D2", 2010, None),
           ("Seq. IPV/OPV", "D1", "D3", 2012, None), ("Penta", "D1", "D3", 2012, None), ("MMR", "D1", "D2", 2013, None), ("Poliomyelitis", "D1", "D3", 1994, None),
           ("Tetra", "D1", "D3", 2003, 2012))

#: Last year of live births that the published denominators of later years repeat.
FROZEN = 2009


def indicators(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(INDICATORS, "indicator string, vaccine string, dose string, target_population string, target_pct double, year_from int, year_to int")


def dropout_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DROPOUT, "indicator string, first_dose string, last_dose string, year_from int, year_to int")


def state_groups(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(u, "A" if u in STATE_GROUP_A else "B") for u in UFS], "uf string, state_group string")


def no_data(spark: SparkSession) -> DataFrame:
    """(year, uf) of which aggregated data never existed: to tell them from what is missing."""
    return spark.createDataFrame([(y, u) for y, states in NO_DATA.items() for u in states], "year int, uf string")


def denominators(spark: SparkSession) -> DataFrame:
    """(year, age_group, state_group, source, source_year), 1994-2012: census estimates of the year until 1999, and in
    group A until 2005; live births otherwise, of the same year for those under one and of the year before for those of one
    (2000 for 2000), never after the frozen year. Later years have no row here: their denominators come with the publisher's own tables,
    so a lookup by rule leaves them null, to be told from a denominator of nothing."""
    rows = []
    for year in range(1994, 2013):
        for group in "AB":
            births = year >= 2006 or (year >= 2000 and group == "B")
            for age in ("<1", "1"):
                of = year if age == "<1" else max(year - 1, 2000)
                rows.append((year, age, group, "SINASC" if births else "IBGE", min(of, FROZEN) if births else year))
    return spark.createDataFrame(rows, "year int, age_group string, state_group string, source string, source_year int")
