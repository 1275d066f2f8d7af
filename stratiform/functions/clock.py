"""Dates, clocks and durations from text as Column expressions. A value that cannot be read is null and blocks no later one."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratiform.functions.text import SEP, once


def date(c: Column) -> Column:
    """YYYYMMDD with or without a clock and zone, or ISO with or without a clock."""
    s = F.trim(c.cast("string"))
    compact = F.when(s.rlike(r"^\d{8}(\d{2}){0,3}(\.\d{1,6})?([+-]\d{4})?$"), F.try_to_date(F.substring(s, 1, 8), "yyyyMMdd"))
    iso = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$"), F.try_to_date(F.substring(s, 1, 10), "yyyy-MM-dd"))
    return F.coalesce(compact, iso)


def clock(c: Column) -> Column:
    """Seconds of the day of HH:MM:SS[.f], HHMMSS[.f], and of date-times in either form; hours, minutes and seconds in range."""
    s = F.regexp_replace(F.trim(c.cast("string")), r"^(\d{4}-\d{2}-\d{2}[T ])", "")
    s = F.when(s.rlike(r"^\d{14}(\.\d+)?([+-]\d{4})?$"), F.substring(s, 9, 99)).otherwise(s)
    pattern = r"^(\d{2}):?(\d{2}):?(\d{2}(?:\.\d{1,6})?)(?:[+-]\d{2}:?\d{2}|Z)?$"
    part = lambda i: F.regexp_extract(s, pattern, i).try_cast("double")
    h, m, sec = part(1), part(2), part(3)
    return F.when((h < 24) & (m < 60) & (sec < 60), h * 3600 + m * 60 + sec)


def short_clock(c: Column) -> Column:
    """Seconds of HH, HHMM, HHMMSS; odd lengths get a leading zero; 60 seconds carry; midnight counts as missing."""
    whole = F.regexp_extract(F.trim(c.cast("string")), r"^(\d{1,6})(\.\d+)?$", 1)
    fraction = F.coalesce(F.regexp_extract(F.trim(c.cast("string")), r"^(\d{1,6})(\.\d+)?$", 2).try_cast("double"), F.lit(0.0))
    even = F.when(F.length(whole) % 2 == 1, F.concat(F.lit("0"), whole)).otherwise(whole)
    full = F.rpad(even, 6, "0")
    h, m, s = (F.substring(full, i, 2).try_cast("int") for i in (1, 3, 5))
    ok = (whole != "") & (h < 24) & (m < 60) & (s <= 60)
    return F.when(ok, F.nullif(h * 3600 + m * 60 + s + fraction, F.lit(0.0)))


def first_of(candidates: Mapping[str, Column], parse) -> tuple[Column, Column]:
    """The first candidate that can be read, and its name."""
    parsed = {n: parse(c) for n, c in candidates.items()}
    return F.coalesce(*parsed.values()), F.coalesce(*(F.when(p.isNotNull(), F.lit(n)) for n, p in parsed.items()))


def earliest(values: Column, parse) -> Column:
    return F.array_min(F.filter(F.transform(values, parse), lambda x: x.isNotNull()))


def stamp(day: Column, seconds: Column) -> Column:
    return day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


#: Fixed: names of the units of a duration, in English and French.
UNITS = {
    "hour": ("h", "hr", "hrs", "hour", "hours", "heure", "heures"),
    "minute": ("mn", "min", "mins", "minute", "minutes"),
    "second": ("s", "sec", "secs", "second", "seconds", "seconde", "secondes"),
}
_HOUR, _MINUTE, _SECOND = _MARKS = "\ue001\ue002\ue003"  # private characters that stand for the units
_AMOUNT = r"\d+(?:[.,]\d+)?"
#: A duration in a text with unit marks: amounts of falling units beside each other, the first of which has a mark.
MARKED_DURATION = (
    rf"(?iu)(?<![\p{{L}}\p{{N}}])(?<!\d[.,:])(?:t{SEP})?(?={_AMOUNT}[{_MARKS}])"
    + "".join(rf"(?:({_AMOUNT}){m}{SEP})?" for m in (_HOUR, _MINUTE))
    + rf"(?:({_AMOUNT}){_SECOND})?(?![\p{{L}}\p{{N}}])"
)


def with_marks(text: Column) -> Column:
    """Unit names after numbers become marks, m:ss two marked amounts, bare minutes after hours marked ones."""
    for mark, names in zip(_MARKS, UNITS.values()):
        text = F.regexp_replace(text, rf"(?iu)(?<=\d){SEP}(?:{'|'.join(sorted(names, key=len, reverse=True))})(?!\p{{L}})", mark)
    text = F.regexp_replace(text, r"(?<![\d.,:])(\d+):([0-5]\d)(?!\d|[.,:]\d)", f"$1{_MINUTE}$2{_SECOND}")
    return F.regexp_replace(text, rf"({_HOUR}{SEP}\d{{1,2}})(?![\d.,:{_MARKS}])", f"$1{_MINUTE}")


def without_durations(text: Column) -> Column:
    """The text with a space for every duration. Units of numbers that are no durations are written short."""
    return F.translate(F.regexp_replace(with_marks(text), MARKED_DURATION, " "), _MARKS, "hms")


def durations(text: Column) -> Column:
    """All durations of a text in seconds: m:ss, 2h05, 1 min 31 s, 45 sec, decimal comma or point."""
    value = lambda c: F.coalesce(F.regexp_replace(c, ",", ".").try_cast("double"), F.lit(0.0))

    def told(marked: Column) -> Column:
        hours, minutes, seconds = (F.regexp_extract_all(marked, F.lit(MARKED_DURATION), F.lit(i)) for i in (1, 2, 3))
        return F.transform(F.arrays_zip(hours.alias("h"), minutes.alias("m"), seconds.alias("s")), lambda x: value(x["h"]) * 3600 + value(x["m"]) * 60 + value(x["s"]))

    return once(with_marks(text), told)
