"""Codes and texts as Column expressions: no UDFs, null in gives null out unless said otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartorio.schemas import ERAS, INVALID, MONTHS


def all_to_string(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def derive_keys(df: DataFrame, date: str, uf: str) -> DataFrame:
    """Adds p_ano, p_mes (characters 1-4 and 6-7 of the date) and p_uf. The prefix keeps them apart from data columns ANO, UF."""
    return df.withColumns({"p_ano": F.substring(date, 1, 4), "p_mes": F.substring(date, 6, 2), "p_uf": F.col(uf)})


def key_reject(month_required: bool = True) -> Column:
    """Why a row has no usable keys; null where it has. A short date gives an empty month, which is rejected too."""
    return (F.when(F.length("p_uf").isNull() | (F.length("p_uf") != 2), "state")
            .when(F.length("p_ano").isNull() | (F.length("p_ano") != 4), "year")
            .when(F.lit(month_required) & (F.col("p_mes").isNull() | (F.length("p_mes") != 2)), "month"))


def drop_unkeyed(df: DataFrame) -> DataFrame:
    return df.filter(key_reject().isNull())


def quarantine_year(year: Column, low: str, high: str) -> Column:
    """The year if it lies in [low, high] as text, else `_invalid`; rows stay."""
    return F.when(year.between(low, high), year).otherwise(F.lit(INVALID))


def rename_map(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Renames the columns that exist."""
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def drop_any(df: DataFrame, names: tuple[str, ...] | list[str]) -> DataFrame:
    return df.drop(*names)


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.lower() for c in df.columns))


def municipality6(code: Column) -> Column:
    """A 7-digit municipality code without its check digit; others as they are."""
    return F.when(F.length(code) == 7, F.substring(code, 1, 6)).otherwise(code)


def decimal_comma(text: Column) -> Column:
    """64,86 and 39.87 as double; null for anything else."""
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")


def repair_code(code: Column, width: int) -> Column:
    """Strips a float suffix and restores leading zeros; only for codes whose width a standard fixes."""
    bare = F.regexp_replace(code, r"\.0$", "")
    return F.when(F.length(bare) < width, F.lpad(bare, width, "0")).otherwise(bare)


def number(text: Column, kind: str = "bigint") -> Column:
    return text.try_cast(kind)


def age_unit(code: Column) -> Column:
    """1 hours, 2 days, 3 months, 4 years by the hundreds of a three-digit age code; 0 for anything else."""
    n = code.try_cast("int")
    return F.when(n.between(100, 499), F.floor(n / 100).cast("int")).otherwise(F.when(n.isNotNull(), 0))


def age_months(code: Column) -> Column:
    """Whole months of an age code; days count by 30, hours as none."""
    n, unit = code.try_cast("int"), age_unit(code)
    rest = F.pmod(n, F.lit(100))
    return F.when(unit == 1, 0).when(unit == 2, F.floor(rest / 30).cast("int")).when(unit == 3, rest).when(unit == 4, rest * 12)


#: Upper bounds in months (exclusive) of the age bands, in order.
AGE_BANDS = (("menor_1_mes", 1), ("menor_1_ano", 12), ("1_ano", 24), ("2_anos", 36), ("3_anos", 48), ("4_anos", 60), ("5_6_anos", 84), ("7_11_anos", 144),
             ("12_14_anos", 180), ("15_49_anos", 600), ("50_59_anos", 720))


def age_band(months: Column) -> Column:
    chain = reduce(lambda c, b: c.when(months < b[1], b[0]), AGE_BANDS, F.when(months < 0, F.lit(None)))
    return chain.when(months.isNotNull(), "60_anos_e_mais")


def four_digit_year(yy: Column, pivot: int = 92) -> Column:
    """Two-digit years from the pivot on are of the 1900s."""
    n = yy.try_cast("int")
    return F.when(n >= pivot, n + 1900).otherwise(n + 2000)


def two_digit_year(year: Column) -> Column:
    return F.lpad(F.pmod(year.try_cast("int"), F.lit(100)).cast("string"), 2, "0")


def file_name(kind: str, uf: Column, year: Column, month: Column | None = None) -> Column:
    """Publisher file names: DPNI/CPNI {UF}{YY}, DN {UF}{YYYY}, DNR {UF}{YYYY}, RD {UF}{YYMM}, routine {month}{YYYY}."""
    if kind in ("DPNI", "CPNI"):
        return F.concat(F.lit(kind), uf, two_digit_year(year), F.lit(".DBF"))
    if kind in ("DN", "DNR"):
        return F.concat(F.lit(kind), uf, year.cast("string"), F.lit(".dbc"))
    if kind == "RD":
        return F.concat(F.lit(kind), uf, two_digit_year(year), F.lpad(month.cast("string"), 2, "0"), F.lit(".dbc"))
    if kind == "routine":
        names = F.array(*(F.lit(m) for m in MONTHS))
        return F.concat(F.lit("vacinacao_"), F.get(names, month.try_cast("int") - 1), F.lit("_"), year.cast("string"), F.lit(".json"))
    raise ValueError(kind)


def parse_file_name(name: Column) -> Column:
    """(kind, uf, year, month) of a publisher file name; nulls where it is none. Monthly routine files have no state."""
    p = r"^(DPNI|CPNI|DNR|DN|RD)([A-Z]{2})(\d{2,4})\."
    kind, digits = F.regexp_extract(name, p, 1), F.regexp_extract(name, p, 3)
    year = (F.when(kind.isin("DPNI", "CPNI") & (F.length(digits) == 2), four_digit_year(digits))
            .when(kind.isin("DN", "DNR") & (F.length(digits) == 4), digits.try_cast("int"))
            .when((kind == "RD") & (F.length(digits) == 4), four_digit_year(F.substring(digits, 1, 2))))
    month = F.when((kind == "RD") & (F.length(digits) == 4), F.substring(digits, 3, 2).try_cast("int"))
    monthly = r"^vacinacao_([a-z]{3})_(\d{4})\.json$"
    routine = F.nullif(F.array_position(F.array(*(F.lit(m) for m in MONTHS)), F.regexp_extract(name, monthly, 1)).cast("int"), F.lit(0))
    year, month = F.when(routine.isNotNull(), F.regexp_extract(name, monthly, 2).try_cast("int")).otherwise(year), F.coalesce(routine, month)
    some = year.isNotNull()
    return F.struct(F.when(routine.isNotNull(), "routine").when(some, kind).alias("kind"), F.when(some & routine.isNull(), F.regexp_extract(name, p, 2)).alias("uf"),
                    year.alias("year"), month.alias("month"))


def path_key(path: Column, key: str) -> Column:
    """The value of key=value in an object path; null where it has none."""
    return F.nullif(F.regexp_extract(path, rf"(?:^|/){key}=([^/]+)", 1), F.lit(""))


def partition_key(*parts: Column) -> Column:
    return F.concat_ws("-", *parts)


def split_partition_key(key: Column) -> Column:
    return F.split(key, "-")


def null_if(text: Column, *marks: str) -> Column:
    """Null for the marks that stand for nothing (zero dates, NA, empty text)."""
    return F.when(~text.isin(*marks), text)


def size_text(size: Column) -> Column:
    """Bytes in decimal B, KB, MB or GB with one digit, halves up. Whole numbers throughout, so exact beyond 2**53 and 2**63 too."""
    size = size.cast("decimal(38,0)")

    def in_unit(power: int, unit: str) -> Column:
        tenths = F.call_function("div", size + F.lit(5 * 10 ** (power - 2)), F.lit(10 ** (power - 1)))
        return F.concat(F.call_function("div", tenths, F.lit(10)).cast("string"), F.lit("."), F.pmod(tenths, F.lit(10)).cast("string"), F.lit(" " + unit))

    return (F.when(size >= 10**9, in_unit(9, "GB")).when(size >= 10**6, in_unit(6, "MB")).when(size >= 10**3, in_unit(3, "KB"))
            .when(size.isNotNull(), F.concat(size.cast("string"), F.lit(" B"))))


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def thousands(n: Column) -> Column:
    return F.format_number(n, 0)


def first_present(df: DataFrame, unit: str, rank: str, exists: str) -> DataFrame:
    """One row for each unit: its lowest-ranked variant that exists, else its lowest-ranked. One variant's failed check
    never hides the next."""
    from pyspark.sql import Window

    w = Window.partitionBy(unit).orderBy(F.col(exists).desc_nulls_last(), F.col(rank))
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def era(dataset: str, year: Column) -> Column:
    """The era of a year: the number of the dataset's eras begun by then; 0 before the first."""
    return reduce(lambda a, b: a + b, (F.when(year >= y, 1).otherwise(0) for y in ERAS[dataset]))
