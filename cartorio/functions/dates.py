"""Dates in their five spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartorio.functions.codes import four_digit_year, null_if

ZERO_DATES = ("", "000000", "00000000", "0001-01-01", "NA")


def flip_date(text: Column) -> Column:
    """YYYYMMDD to DDMMYYYY, for texts of eight digits only. It isn't its own inverse."""
    flipped = F.concat(F.substring(text, 7, 2), F.substring(text, 5, 2), F.substring(text, 1, 4))
    return F.when(text.rlike("^[0-9]{8}$"), flipped).otherwise(text)


def parse_date(text: Column, style: str, pivot: int = 92) -> Column:
    """A date, or null. style: iso (with or without time), ymd (YYYYMMDD), dmy (DDMMYYYY), short (YYMMDD, by century pivot)."""
    clean = null_if(text, *ZERO_DATES)
    if style == "iso":
        return F.try_to_date(F.substring(clean, 1, 10), "yyyy-MM-dd")
    if style in ("ymd", "dmy"):
        return F.when(clean.rlike("^[0-9]{8}$"), F.try_to_date(clean, "yyyyMMdd" if style == "ymd" else "ddMMyyyy"))
    if style == "short":
        whole = F.concat(four_digit_year(F.substring(clean, 1, 2), pivot).cast("string"), F.substring(clean, 3, 4))
        return F.when(clean.rlike("^[0-9]{6}$"), F.try_to_date(whole, "yyyyMMdd"))
    raise ValueError(style)


def month_start(yyyymm: Column) -> Column:
    return F.try_to_date(F.concat(yyyymm, F.lit("01")), "yyyyMMdd")


def stamp_text(ts: Column) -> Column:
    """2024-01-31 09:05 UTC; a dash for null."""
    return F.coalesce(F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm"), F.lit(" UTC")), F.lit("—"))
