"""Tolerant scalar conversions. Spark runs in ANSI mode, where plain casts and divisions
raise; source feeds contain bad values, which become null here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(col: Column) -> Column:
    """Text to double; anything that is not a number, NaN included, is null."""
    number = F.trim(col.cast("string")).try_cast("double")
    return F.when(~F.isnan(number), number)


def month_start(col: Column) -> Column:
    """``yyyy-MM`` text, or a longer date, to the first day of its month."""
    text = col.cast("string")
    return F.trunc(F.try_to_date(F.substring(F.concat(text, F.lit("-01")), 1, 10)), "month")


def to_day(col: Column) -> Column:
    """``yyyy-MM-dd`` or ``yyyy-MM`` text, or a timestamp, to a date."""
    text = F.substring(col.cast("string"), 1, 10)
    return F.coalesce(F.try_to_date(text), F.try_to_date(F.concat(text, F.lit("-01"))))


def to_time(col: Column) -> Column:
    return F.try_to_timestamp(col.cast("string"))


def epoch_time(seconds: Column) -> Column:
    """Epoch seconds to a timestamp; missing means the epoch itself."""
    return F.timestamp_seconds(F.coalesce(seconds, F.lit(0)))


def calendar(col: Column) -> dict[str, Column]:
    """Date parts used by the trend tables."""
    day = F.to_date(col)
    return {
        "date": day,
        "year": F.year(day),
        "month": F.month(day),
        "year_month": F.date_format(day, "yyyy-MM"),
        "month_name": F.date_format(day, "MMMM"),
    }


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part, whole) * 100, 1)


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def lookup_code(col: Column) -> Column:
    """Postcode without spaces, in capitals."""
    return F.replace(F.upper(col), F.lit(" "), F.lit(""))


def file_label(col: Column) -> Column:
    """Category text made safe for a file name."""
    return F.regexp_replace(col, "-", "_")


def capped_product(a: Column, b: Column, cap: float = 1.0) -> Column:
    """``a * b`` up to ``cap``; callers fill nulls first, since ``least`` skips them."""
    return F.least(a * b, F.lit(cap))


def dominant(col: Column, how: str = "last") -> Column:
    """Representative category of a group: alphabetically last, or the most frequent."""
    if how == "mode":
        return F.mode(col, deterministic=True)
    return F.max(col)


def mean_bearing(degrees: Column) -> Column:
    """Direction average on the circle, 0-360."""
    rad = F.radians(degrees)
    return F.pmod(F.degrees(F.atan2(F.avg(F.sin(rad)), F.avg(F.cos(rad)))), F.lit(360.0))
