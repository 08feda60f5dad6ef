"""Dates in running text to ISO form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.constants import MONTHS
from corpusmill.functions.common import let

_MONTH = (
    r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|"
    r"sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)
_DAY = r"(\d{1,2})(?:st|nd|rd|th)?"
_ISO = r"(?<!\d)(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?!\d)"
_COMPACT = r"(?<!\d)(\d{4})(\d{2})(\d{2})(?!\d)"
_NUMERIC = r"(?<!\d)(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})(?!\d)"
_MONTH_FIRST = rf"(?i)\b{_MONTH}\.?\s+{_DAY}\s*,?\s+(\d{{4}})\b"
_DAY_FIRST = rf"(?i)(?<!\d){_DAY}[\s-]+(?:of\s+)?{_MONTH}\.?,?[\s-]+(\d{{4}})\b"


def _month_number(name: Column) -> Column:
    """Number of a month whose name starts with one of the three-letter abbreviations."""
    place = F.position(F.lower(F.substring(name, 1, 3)), F.lit("".join(MONTHS)))
    return ((place + 2) / 3).cast("int")


def _iso(year: Column, month: Column, day: Column) -> Column:
    text = F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))
    return F.date_format(F.try_to_date(text, "yyyy-MM-dd"), "yyyy-MM-dd")


def parse_date(text: Column) -> Column:
    """First complete date in ``text`` as ``YYYY-MM-DD``, month before day; '' when there is none.

    Partial dates give '' too: completing them from today's date would make results change from day to day.
    """

    def part(pattern: str, group: int) -> Column:
        return F.regexp_extract(text, pattern, group)

    def numeric() -> Column:
        first = part(_NUMERIC, 1).cast("int")
        second = part(_NUMERIC, 2).cast("int")
        swap = first > 12
        return _iso(part(_NUMERIC, 3), F.when(swap, second).otherwise(first), F.when(swap, first).otherwise(second))

    found = (
        F.when(text.rlike(_ISO), _iso(part(_ISO, 1), part(_ISO, 2), part(_ISO, 3)))
        .when(text.rlike(_MONTH_FIRST),
              _iso(part(_MONTH_FIRST, 3), _month_number(part(_MONTH_FIRST, 1)), part(_MONTH_FIRST, 2)))
        .when(text.rlike(_DAY_FIRST),
              _iso(part(_DAY_FIRST, 3), _month_number(part(_DAY_FIRST, 2)), part(_DAY_FIRST, 1)))
        .when(text.rlike(_NUMERIC), numeric())
        .when(text.rlike(_COMPACT), _iso(part(_COMPACT, 1), part(_COMPACT, 2), part(_COMPACT, 3)))
    )
    return F.coalesce(found, F.lit(""))


def normalize_infobox(infobox: Column) -> Column:
    """Trim every value; values under keys containing "date" become ISO dates."""

    def value(key: Column, val: Column) -> Column:
        stripped = F.regexp_replace(val, r"(?U)^\s+|\s+$", "")
        return F.when(F.contains(F.lower(key), F.lit("date")), let(stripped, parse_date)).otherwise(stripped)

    return F.transform_values(infobox, value)


def normalize_person(infobox: Column) -> Column:
    """Struct of name, birth_date and the occupation list; absent fields become ''."""

    def field(name: str) -> Column:
        return F.coalesce(F.try_element_at(infobox, F.lit(name)), F.lit(""))

    return F.struct(
        field("name").alias("name"),
        field("birth_date").alias("birth_date"),
        F.split(field("occupation"), r"\|").alias("occupation"),
    )
