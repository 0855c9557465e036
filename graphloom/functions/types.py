"""Casts between source text and typed properties.

A declared property is String, Number, DateTime or Boolean. Falsy input (null, '', 0, false) becomes null for String and
Number; Boolean keeps false, a deliberate difference from a plain falsy test. Numbers are DECIMAL(38,6); ids use their canonical text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = "decimal(38,6)"
GRAPH_TIME = "yyyy-MM-dd'T'HH:mm:ssZ"
#: Fixed formats of the sources' dates.
SOURCE_TIME, SOURCE_DATE = "M/d/yyyy h:mm:ss a", "M/d/yyyy"


def canonical(number: Column) -> Column:
    """A number's text without trailing zeros: 1941.000000 is 1941, 2.500000 is 2.5."""
    text = number.cast("string")
    short = F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", "")
    return F.when(text.contains("."), short).otherwise(text)


def to_property(value: Column, kind: str) -> Column:
    if kind == "String":
        return F.nullif(value.cast("string"), F.lit(""))
    if kind == "Number":
        return F.nullif(value.try_cast(NUMBER), F.lit(0).cast(NUMBER))
    if kind == "DateTime":
        return value.try_cast("timestamp")
    if kind == "Boolean":
        return value.try_cast("boolean")
    raise ValueError(f"no property type {kind}")


def graph_time(moment: Column) -> Column:
    return F.date_format(moment.cast("timestamp"), GRAPH_TIME)


def source_time(text: Column) -> Column:
    """A source's date and time; a date alone is midnight; anything else null."""
    return F.coalesce(F.try_to_timestamp(text, F.lit(SOURCE_TIME)), F.try_to_timestamp(F.concat(text, F.lit(" 12:00:00 AM")), F.lit(SOURCE_TIME)))


def zone_corrected(text: Column, is_utc: bool) -> Column:
    """A time with an offset (`2020-01-02 03:04:05-05:00`) as a timestamp. Sources that are known to write UTC give it a wrong offset: then the clock's reading counts and the offset is dropped."""
    bare = F.regexp_replace(text, r"\s*(Z|[+-]\d{2}:?\d{2})$", "")
    return F.try_to_timestamp(F.concat(bare, F.lit("Z")) if is_utc else text)


def date_from(as_of: str, days: int = 0) -> Column:
    """The day so many days after a moment."""
    return F.date_format(F.lit(as_of).cast("timestamp") + F.expr(f"interval {days} days"), "MM/dd/yyyy")


def is_true(text: Column) -> Column:
    """Whether a flag's text is the word True; absent is false."""
    return F.coalesce(text == "True", F.lit(False))


def any_text(text: Column) -> Column:
    """Whether a flag has any text at all, be it False."""
    return F.coalesce(F.length(text) > 0, F.lit(False))


def filter_date(moment: Column, as_of: str, days: int = 3650) -> Column:
    """A filter's date text; no date means `days` before as_of."""
    return F.date_format(F.coalesce(moment.cast("timestamp"), F.lit(as_of).cast("timestamp") - F.expr(f"interval {days} days")), "MM/dd/yyyy")


def xml_value(text: Column, kind: str) -> Column:
    """A typed XML cell: numbers, booleans as the word true, times; text is cut to 45,000 characters and loses bold tags; absent text is ''."""
    if kind in ("int", "short", "long"):
        return text.try_cast("bigint")
    if kind in ("double", "float", "decimal"):
        return text.try_cast("double")
    if kind == "boolean":
        return F.when(text.isNotNull(), text == "true")
    if kind == "dateTime":
        return F.try_to_timestamp(text)
    return F.coalesce(F.regexp_replace(F.substring(text, 1, 45_000), "</?b>", ""), F.lit(""))


def csv_value(text: Column, kind: str) -> Column:
    blank = F.nullif(text, F.lit(""))
    if kind == "number":
        return blank.try_cast(NUMBER)
    if kind in ("datetime", "date", "utc_datetime"):
        return source_time(blank)
    return blank
