"""Which XSD date or time type a text is written as."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- Fixed values: ISO 8601 shapes -----------------------------------------
_TIME = r"(?:[01][0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9](?:[.][0-9]{0,9})?)?"
_DATE = r"(?:[0-9]{4}|-[0-9]{4,10}|\+[0-9]{5,10})-[0-9]{2}-[0-9]{2}"
_OFFSET = r"(?:[Zz]|[+-](?:(?:0[0-9]|1[0-7])(?::[0-5][0-9](?::[0-5][0-9])?)?|18(?::00(?::00)?)?))"
_ZONE = r"\[[A-Za-z0-9_/+:~.-]+\]"
TIME = rf"^{_TIME}\z"
DATE = rf"^{_DATE}\z"
DATE_TIME = rf"^{_DATE}[Tt]{_TIME}(?:{_OFFSET}(?:{_ZONE})?)?\z"
# Three-letter names that Spark reads as zones and the ISO form does not have.
SHORT_ZONES = (
    "ACT", "AET", "AGT", "ART", "AST", "BET", "BST", "CAT", "CNT", "CST", "CTT", "EAT", "ECT",
    "IET", "IST", "JST", "MIT", "NET", "NST", "PLT", "PNT", "PRT", "PST", "SST", "VST",
)


def _on_calendar(text: Column) -> Column:
    """True if year, month and day at the start of ``text`` name a day of the calendar."""

    def part(group: int) -> Column:
        shape = r"^([+-]?[0-9]+)-([0-9]{2})-([0-9]{2})"
        return F.regexp_extract(text, shape, group).try_cast("bigint")

    year, month, day = part(1), part(2), part(3)
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    days = (
        F.when(month == 2, F.when(leap, F.lit(29)).otherwise(28))
        .when(month.isin(4, 6, 9, 11), F.lit(30))
        .otherwise(31)
    )
    in_range = year.between(-999_999_999, 999_999_999) & ~text.startswith("-0000")
    return in_range & month.between(1, 12) & day.between(1, 1_000) & (day <= days)


def _zone_known(text: Column) -> Column:
    zone = F.regexp_extract(text, r"\[(.+)\]$", 1)
    resolved = F.concat(F.lit("2000-01-01 00:00:00 "), zone).try_cast("timestamp")
    return (zone == "") | (resolved.isNotNull() & ~zone.isin(*SHORT_ZONES))


def detect_datetime(text: Column) -> Column:
    """``time``, ``date`` or ``dateTime``; null for any other text."""
    return (
        F.when(text.rlike(TIME), F.lit("time"))
        .when(text.rlike(DATE) & _on_calendar(text), F.lit("date"))
        .when(
            text.rlike(DATE_TIME) & _on_calendar(text) & _zone_known(text), F.lit("dateTime")
        )
    )
