"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartorio.schemas import UFS


def matching(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.filter(F.col(column).rlike(pattern))


def states_only(df: DataFrame, uf: str, states: tuple[str, ...] = UFS) -> DataFrame:
    """Without consolidated units (national, ignored, state totals)."""
    return df.filter(F.col(uf).isin(*states))


def valid_records(df: DataFrame, status: str, deleted: str | None = None, wrong: str = "entered-in-error") -> DataFrame:
    """Rows whose status isn't `wrong` (a null status is valid) and that bear no deletion date."""
    keep = ~F.col(status).eqNullSafe(F.lit(wrong))
    if deleted:
        keep &= F.col(deleted).isNull() | F.col(deleted).isin("", "0001-01-01")
    return df.filter(keep)


def without_codes(df: DataFrame, column: str, codes: tuple) -> DataFrame:
    return df.filter(F.col(column).isNull() | ~F.col(column).isin(*codes))


def blank(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == "")


def complete(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def present(df: DataFrame, size: str, least: int = 500) -> DataFrame:
    """Sources of more than `least` bytes; smaller ones are empty files."""
    return df.filter(F.col(size) > least)


def with_status(df: DataFrame, *status: str, column: str = "status") -> DataFrame:
    return df.filter(F.col(column).isin(*status)) if status else df


def numerator(vaccine: str, vaccines: tuple, dose: str, doses: tuple, months: str, low: int, high: int) -> Column:
    """Vaccine, dose and age range (months, upper bound exclusive) that count for an indicator."""
    return F.col(vaccine).isin(*vaccines) & F.col(dose).isin(*doses) & (F.col(months) >= low) & (F.col(months) < high)
