"""What a researcher calls: doses, coverage series, microdata, and the state of the copy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.functions.codes import municipality6, number
from cartorio.operators.aggregates import count_by, percent, top_k
from cartorio.operators.joins import decode, lookup_year, small
from cartorio.operators.sync import compare, status_summary, validate_copy
from cartorio.operators.windows import series
from cartorio.sources.files import below, digests, manifest_files, read_manifest, scan


def coverage_series(old: DataFrame, new: DataFrame, population: DataFrame, components: DataFrame, indicator: str, uf: str | None = None,
                    years: tuple[int, int] | None = None, break_year: int = 2020, *, dictionaries: dict[str, DataFrame] | None = None,
                    rules: DataFrame | None = None, births: DataFrame | None = None, states: DataFrame | None = None, age_group: str = "<1") -> DataFrame:
    """(year, coverage_pct, doses, denominator, denominator_source, source, series_break) of an indicator over both sources.

    old, new: year, uf, vaccine, dose, doses. Codes of the columns that `dictionaries` names are decoded first (label, source_codes,
    line_no); those it lacks stay. components: indicator, vaccine, dose, and if they hold for a period only year_from, year_to; a dose
    counts once in a year, however many of the indicator's periods hold it.

    population: year, uf, population, and age_group if there are several. With rules (year, age_group, state_group, source,
    source_year), births (year, uf, births) and states (uf, state_group), each state's denominator of a year is by its rule: live births
    or population of the source year; years without a rule have the population of the year. denominator_source names what
    was added up. A state for which the tables have nothing adds nothing.
    """
    rows = series(old, new, "year", break_year)
    for column, dictionary in (dictionaries or {}).items():
        rows = decode(rows, dictionary, column, into="_label").withColumn(column, F.coalesce("_label", column)).drop("_label")
    if uf:
        rows, population = rows.filter(F.col("uf") == uf), population.filter(F.col("uf") == uf)
    if years:
        rows = rows.filter(F.col("year").between(*years))
    given = rows.groupBy("year", "source", "series_break", "vaccine", "dose").agg(F.sum("doses").alias("doses"))
    c = components.filter(F.col("indicator") == indicator)
    open_end = F.lit(None).cast("int")
    wanted = c.select(F.col("vaccine").alias("_vaccine"), F.col("dose").alias("_dose"), *((F.col(k) if k in c.columns else open_end).alias(f"_{k}") for k in ("year_from", "year_to")))
    in_force = (F.col("_year_from").isNull() | (F.col("year") >= F.col("_year_from"))) & (F.col("_year_to").isNull() | (F.col("year") <= F.col("_year_to")))
    counted = given.join(small(wanted), (F.col("vaccine") == F.col("_vaccine")) & (F.col("dose") == F.col("_dose")) & in_force, "left_semi")
    doses_of = counted.groupBy("year", "source", "series_break").agg(F.sum("doses").alias("doses"))
    if "age_group" in population.columns:
        population = population.filter(F.col("age_group") == age_group)
    people = population.groupBy("year", "uf").agg(F.sum("population").alias("people"))
    if rules is None:
        by_state = people.select("year", F.col("people").alias("n"), F.lit("population").alias("of"))
    else:
        by_state = _by_rule(doses_of.select("year").distinct(), people, rules, births, states, age_group, uf)
    below_line = by_state.filter("n is not null").groupBy("year").agg(F.sum("n").alias("denominator"), F.array_join(F.array_sort(F.collect_set("of")), "+").alias("denominator_source"))
    return doses_of.join(below_line, "year", "left").withColumn("coverage_pct", percent(F.col("doses"), F.col("denominator")))


def _by_rule(years: DataFrame, people: DataFrame, rules: DataFrame, births: DataFrame, states: DataFrame, age_group: str, uf: str | None) -> DataFrame:
    """(year, n, of) of each state and year: what its rule counts in the rule's source year, or the year's population."""
    states = states.filter(F.col("uf") == uf) if uf else states
    units = states.select("uf", "state_group").crossJoin(small(years)).withColumn("age_group", F.lit(age_group))  # states x years: a grid
    ruled = lookup_year(units, rules, births).withColumn("_of_year", F.coalesce("source_year", "year"))
    own = people.select(F.col("year").alias("_of_year"), "uf", "people")
    by_births = F.col("source") == "SINASC"
    return (ruled.join(own, ["_of_year", "uf"], "left")
            .select("year", F.when(by_births, F.col("births")).otherwise(F.col("people")).alias("n"), F.when(by_births, "births").otherwise("population").alias("of")))


def doses(df: DataFrame, vaccine: str, municipality: str, years: tuple[int, int], names: tuple[str, str, str, str] = ("year", "vaccine", "municipality", "doses")) -> DataFrame:
    """(year, doses) of a vaccine in a municipality, its code of six or seven digits."""
    year, vac, place, measure = names
    hit = (municipality6(F.col(place)) == municipality6(F.lit(municipality))) & (F.col(vac) == vaccine) & F.col(year).between(*years)
    return df.filter(hit).groupBy(year).agg(F.sum(number(F.col(measure).cast("string"), "double")).alias("doses"))


def microdata(spark: SparkSession, root: str, uf: str, year: str, month: str | None = None) -> DataFrame:
    """A lazy scan of one state and year (and month); only its folders are read."""
    where = (F.col("p_uf") == uf) & (F.col("p_ano") == year)
    return scan(spark, root, where & (F.col("p_mes") == month) if month else where)


def check_sync(expected: DataFrame, source: DataFrame, copy: DataFrame, keys: list[str], dataset: str = "dataset") -> tuple[DataFrame, DataFrame]:
    """(details, summary) of all datasets at once; to_do() lists the units."""
    details = compare(expected, source, copy, keys)
    return details, status_summary(details, dataset)


def to_do(details: DataFrame, keys: list[str], dataset: str = "dataset", statuses: tuple[str, ...] = ("missing", "outdated", "extra", "check_failed")) -> DataFrame:
    """The lists of each status, a row a unit: (dataset, status, keys) of the units that aren't as they should be."""
    return details.filter(F.col("status").isin(*statuses)).select(dataset, "status", *keys)


def validate_local(spark: SparkSession, root: str, manifest: str) -> DataFrame:
    """(path, result) of the files below root against the manifest; paths are those below root, with their folders (the
    manifest's too, or whole ones)."""
    found = digests(spark, root).withColumn("path", below(spark, F.col("path"), root))
    wanted = manifest_files(read_manifest(spark, manifest)).filter("path is not null").withColumn("path", below(spark, F.col("path"), root))
    return validate_copy(found, wanted)


def registry_counts(df: DataFrame, by: str, top: int | None = None) -> DataFrame:
    """Admissions by diagnosis, births by sex: counts, or the most frequent."""
    return top_k(df, by, top) if top else count_by(df, by)
