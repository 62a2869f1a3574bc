"""Operating calendars: weekdays, special days, bank holidays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.time import day_range

# Weekday names in ISO order.
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


# Sets of days are bitmaps: 64-bit words, word w for the days 64 w to 64 w + 63 since
# 1970-01-01 (a Thursday). A year is six words.
_EPOCH_WEEKDAY = 3


def _signed(word: int) -> int:
    return word - (1 << 64) if word >> 63 else word


# For each weekday and each weekday of a word's first day, the days of the word.
_WEEKDAY_WORDS = [_signed(sum(1 << i for i in range(64) if (first + i) % 7 == day)) for day in range(7) for first in range(7)]


def word_of(day: Column) -> Column:
    return F.shiftright(F.unix_date(day), 6)


def bit_of(day: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.unix_date(day).bitwiseAND(F.lit(63)))


def words_between(start: Column, end: Column) -> Column:
    """Words of an inclusive range of days, as ``array<struct<word, bits>>``; a reversed one has none."""
    a, b = F.unix_date(start), F.unix_date(end)

    def word(w: Column) -> Column:
        low = F.greatest(a - 64 * w, F.lit(0))
        high = F.least(b - 64 * w, F.lit(63))
        ones = F.lit(-1).cast("long")
        bits = F.call_function("shiftleft", ones, low).bitwiseAND(F.call_function("shiftrightunsigned", ones, 63 - high))
        return F.struct(w.alias("word"), bits.alias("bits"))

    none = F.expr("cast(array() as array<struct<word:int,bits:bigint>>)")
    whole = F.transform(F.sequence(F.shiftright(a, 6), F.shiftright(b, 6)), word)
    return F.when(a.isNotNull() & b.isNotNull() & (a <= b), whole).otherwise(none)


def regular_word(days: Column, word: Column) -> Column:
    """Days of a word that are regular weekdays."""
    table = F.array(*[F.lit(w) for w in _WEEKDAY_WORDS])
    first = F.pmod(64 * word + _EPOCH_WEEKDAY, F.lit(7))
    found = F.lit(0).cast("long")
    for i, name in enumerate(WEEKDAYS):
        found = found.bitwiseOR(F.when(days[name], F.get(table, 7 * i + first)).otherwise(F.lit(0).cast("long")))
    return found


def days_in(word: Column, bits: Column) -> Column:
    """The days a word holds."""
    places = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftrightunsigned", bits, i).bitwiseAND(F.lit(1)) == 1)
    return F.transform(places, lambda i: F.date_from_unix_date((64 * word + i).cast("int")))


def weekday_numbers(days: Column) -> Column:
    """ISO numbers of the weekdays set in a struct of flags."""
    flags = [F.when(days[name], F.lit(i)) for i, name in enumerate(WEEKDAYS, 1)]
    return F.filter(F.array(*flags), lambda d: d.isNotNull())


def weekday_rows(profiles: DataFrame) -> DataFrame:
    """One row per journey and regular weekday."""
    names = F.array(*[F.lit(n) for n in WEEKDAYS])
    return profiles.select(
        "file_id", "vj_code", F.explode(weekday_numbers(F.col("days"))).alias("iso_day")
    ).select("file_id", "vj_code", F.element_at(names, F.col("iso_day")).alias("day_of_week"))


def expand_ranges(ranges: Column) -> Column:
    """Distinct days of an array of inclusive date ranges; reversed ones are empty."""
    days = F.flatten(F.transform(ranges, lambda r: day_range(r["start"], r["end"])))
    return F.array_distinct(F.coalesce(days, F.array().cast("array<date>")))


def holidays_in_range(
    bank_holidays: DataFrame, periods: DataFrame, divisions: list[str] | None = None
) -> DataFrame:
    """Holiday dates by name within each period, one row per name and date.

    ``periods(file_id, start_date, end_date, txc_element)`` names the holidays a
    file asks for, so the join has an equality key; an open end is unbounded.
    """
    chosen = bank_holidays if not divisions else bank_holidays.where(F.col("division").isin(*divisions))
    return (
        periods.join(chosen.select("txc_element", "date"), "txc_element")
        .where(
            (F.col("date") >= F.col("start_date"))
            & (F.col("end_date").isNull() | (F.col("date") <= F.col("end_date")))
        )
        .drop("start_date", "end_date")
    )


def exceptions(profiles: DataFrame, services: DataFrame, bank_holidays: DataFrame, divisions: list[str] | None = None) -> DataFrame:
    """Dates on which a journey departs from its weekdays.

    Operating: special or bank days that are not regular weekdays.
    Non-operating: special or bank days that are. One row per journey, date and
    kind; bank holidays count within the period of the file's first service.
    """
    def special(source: str, operates: bool) -> Column:
        words = F.flatten(F.transform(source, lambda r: words_between(r["start"], r["end"])))
        return F.transform(words, lambda w: F.struct(F.lit(operates).alias("operates"), w["word"].alias("word"), w["bits"].alias("bits")))

    none = F.expr("cast(array() as array<struct<operates:boolean,word:int,bits:bigint>>)")
    both = F.concat(*[F.coalesce(special(c, v), none) for c, v in (("special_operation", True), ("special_non_operation", False))])
    named_days = profiles.select("file_id", "vj_code", "days", F.inline(both))
    period = services.groupBy("file_id").agg(
        F.min_by(F.struct("start_date", "end_date"), "service_pos").alias("period")
    )
    named = F.array(
        *[
            F.struct(F.coalesce(F.col(c), F.array().cast("array<string>")).alias("names"), F.lit(v).alias("operates"))
            for c, v in (("bank_operation", True), ("bank_non_operation", False))
        ]
    )
    asked = (
        profiles.select("file_id", "vj_code", "days", F.explode(named).alias("e"))
        .select("file_id", "vj_code", "days", "e.operates", F.explode("e.names").alias("txc_element"))
        .join(period, "file_id")
        .select("file_id", "vj_code", "days", "operates", "txc_element", "period.*")
    )
    bank = holidays_in_range(bank_holidays, asked, divisions)
    bank = bank.select("file_id", "vj_code", "days", "operates", word_of(F.col("date")).alias("word"), bit_of(F.col("date")).alias("bits"))
    named_days = named_days.unionByName(bank)
    # A row's days are held against its own weekdays before they are united, so
    # a journey's words are aggregated once and its days told apart already.
    regular = regular_word(F.col("days"), F.col("word"))
    changed = F.when(F.col("operates"), F.col("bits").bitwiseAND(F.bitwise_not(regular))).otherwise(F.col("bits").bitwiseAND(regular))
    rows = named_days.select("file_id", "vj_code", "operates", "word", changed.alias("bits")).where("bits <> 0")
    words = rows.groupBy("file_id", "vj_code", "operates", "word").agg(F.bit_or("bits").alias("bits"))
    return words.select("file_id", "vj_code", F.explode(days_in(F.col("word"), F.col("bits"))).alias("date"), "operates")


def operating_days(journeys: DataFrame, exception_days: DataFrame, horizon: Column) -> DataFrame:
    """Every day each journey runs.

    Regular weekdays within the service period, plus operating exceptions,
    minus non-operating ones. ``journeys`` has days, start_date and end_date,
    one row per journey. A service without an end runs on; its days are given up
    to ``horizon``.

    Days are bitmaps throughout: exceptions are united per word, a few words go
    with each journey, and days are told one by one only in the end.
    """
    changed = (
        exception_days.groupBy("file_id", "vj_code", word_of(F.col("date")).alias("word"))
        .agg(
            F.bit_or(F.when(F.col("operates"), bit_of(F.col("date")))).alias("added"),
            F.bit_or(F.when(~F.col("operates"), bit_of(F.col("date")))).alias("removed"),
        )
        .groupBy("file_id", "vj_code")
        .agg(F.collect_list(F.struct("word", "added", "removed")).alias("changed"))
    )
    joined = journeys.select("file_id", "vj_code", "days", "start_date", "end_date").join(
        changed, ["file_id", "vj_code"], "left"
    )
    none = F.lit(0).cast("long")
    period = words_between(F.col("start_date"), F.coalesce(F.col("end_date"), horizon))
    regular = F.transform(
        period, lambda p: F.struct(p["word"].alias("word"), p["bits"].bitwiseAND(regular_word(F.col("days"), p["word"])).alias("bits"), none.alias("removed"))
    )
    extra = F.transform(
        F.coalesce("changed", F.expr("cast(array() as array<struct<word:int,added:bigint,removed:bigint>>)")),
        lambda c: F.struct(c["word"].alias("word"), F.coalesce(c["added"], none).alias("bits"), F.coalesce(c["removed"], none).alias("removed")),
    )
    words = joined.select("file_id", "vj_code", F.inline(F.concat(regular, extra)))
    united = words.groupBy("file_id", "vj_code", "word").agg(F.bit_or("bits").alias("bits"), F.bit_or("removed").alias("removed"))
    kept = F.col("bits").bitwiseAND(F.bitwise_not("removed"))
    return united.where(kept != 0).select("file_id", "vj_code", F.explode(days_in(F.col("word"), kept)).alias("date"))


def flexible_operation_periods(flexible_journeys: DataFrame) -> DataFrame:
    """Operating period of flexible journeys; all-day service is 00:00:00-23:59:59.

    ``service_times`` is ``ARRAY<STRUCT<all_day BOOLEAN, start STRING, end STRING>>``.
    A period whose times cannot be read is flagged.
    """
    from headway.functions.time import clock, seconds_of_day

    rows = flexible_journeys.select("file_id", "vj_code", F.posexplode("service_times").alias("pos", "t"))
    start = F.when(F.col("t.all_day"), F.lit(0)).otherwise(seconds_of_day(F.col("t.start")))
    end = F.when(F.col("t.all_day"), F.lit(86399)).otherwise(seconds_of_day(F.col("t.end")))
    return rows.select(
        "file_id",
        "vj_code",
        "pos",
        clock(start).alias("start_time"),
        clock(end).alias("end_time"),
        (start.isNull() | end.isNull()).alias("is_error"),
    )
