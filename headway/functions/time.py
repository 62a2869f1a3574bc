"""Durations and times of day as column expressions.

A time of day is a number of seconds after midnight; text form is ``HH:mm:ss``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.binding import let

DAY_SECONDS = 86400
_SINGLE = r"^PT\d{1,9}[HMS]$"
_CLOCK = r"^([01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d$"


def duration_seconds(text: Column) -> Column:
    """ISO-8601 duration to seconds; null or unreadable text gives 0.

    A single number and unit, by far the most usual form, is read with plain
    string functions. Other forms are read designator by designator.
    """
    unit = F.substring(text, -1, 1)
    factor = F.when(unit == "M", 60.0).when(unit == "S", 1.0).otherwise(3600.0)
    number = F.substr(text, F.lit(3), F.length(text) - 3).try_cast("double")
    return F.when(text.rlike(_SINGLE), number * factor).otherwise(_any_duration(text))


def _any_duration(text: Column) -> Column:
    """Sign, ``P``, days, then behind ``T`` hours, minutes and seconds in this order.

    Each part is optional. What follows the last readable part is ignored; a time
    counts only right behind ``P`` or the days. Years, months and weeks have no
    fixed length here and are not read.
    """
    negative = F.startswith(text, F.lit("-"))
    body = F.when(negative, F.substr(text, F.lit(2))).otherwise(text)
    halves = F.split(F.substr(body, F.lit(2)), "T", 2)

    def total(p: Column) -> Column:
        date, time = F.get(p, F.lit(0)), F.coalesce(F.get(p, F.lit(1)), F.lit(""))
        whole_date = date.rlike("^([0-9]+D)?$")
        seconds = _amount(date, "D") * DAY_SECONDS + F.when(whole_date, _clock_part(time)).otherwise(0.0)
        return F.when(negative, -seconds).otherwise(seconds)

    return F.when(F.startswith(body, F.lit("P")), let(halves, total)).otherwise(0.0)


def _amount(part: Column, designator: str, number: str = "[0-9]+") -> Column:
    """The number that stands before the designator at the start, else 0."""
    return F.coalesce(F.regexp_extract(part, f"^({number}){designator}", 1).try_cast("double"), F.lit(0.0))


def _clock_part(time: Column) -> Column:
    after_hours = F.regexp_replace(time, "^[0-9]+H", "")
    after_minutes = F.regexp_replace(after_hours, "^[0-9]+M", "")
    return _amount(time, "H") * 3600 + _amount(after_hours, "M") * 60 + _amount(after_minutes, "S", "[0-9]+(?:[.][0-9]+)?")


def seconds_of_day(text: Column) -> Column:
    """``H:M:S`` text to seconds after midnight; anything else is null."""
    parts = F.split(text, ":")
    return F.when(
        text.rlike(_CLOCK),
        parts[0].cast("int") * 3600 + parts[1].cast("int") * 60 + parts[2].cast("int"),
    )


def clock(seconds: Column) -> Column:
    """Seconds after midnight to ``HH:mm:ss`` text."""
    whole = F.floor(seconds).cast("int")

    def two(value: Column) -> Column:
        return F.lpad(F.floor(value).cast("string"), 2, "0")

    return F.when(
        seconds.isNotNull(),
        F.concat_ws(":", two(whole / 3600), two((whole % 3600) / 60), two(whole % 60)),
    )


def advance(start: Column, run: Column, wait: Column) -> Column:
    """Start plus run plus wait, wrapping at midnight; a null start stays null."""
    return F.pmod(start + run + wait, F.lit(DAY_SECONDS))


def weekday(day: Column) -> Column:
    """ISO weekday number, Monday = 1."""
    return F.weekday(day) + 1


def day_range(start: Column, end: Column) -> Column:
    """All days from start to end, both included; a reversed range is empty."""
    return F.when(start <= end, F.sequence(start, end)).otherwise(
        F.array().cast("array<date>")
    )
