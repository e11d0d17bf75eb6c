"""Column expressions on names, ids and times of text sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_key(name: Column) -> Column:
    """Upper case, letters A-Z and digits only; UNNAMED is null, an empty key stays."""
    return F.nullif(F.regexp_replace(F.upper(name), "[^A-Z0-9]", ""), F.lit("UNNAMED"))


def case_id(number: Column, width: int = 5) -> Column:
    """An id padded with zeros, never cut."""
    s = number.cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def lenient_timestamp(text: Column, pattern: str | None = None) -> Column:
    """Text as a timestamp without zone (the session's zone is UTC); null if it is none."""
    return F.try_to_timestamp(text, *([F.lit(pattern)] if pattern else [])).cast("timestamp_ntz")


def hotspot_time(date: Column, time: Column) -> Column:
    """First ten characters of the date and an HHMM number that may lack its zeros; null if either is bad."""
    digits = F.regexp_replace(time.cast("string"), "[^0-9]", "")
    hhmm = F.lpad(F.substring(digits, 1, 4), 4, "0")
    return lenient_timestamp(F.concat(F.substring(date.cast("string"), 1, 10), F.lit(" "), hhmm), "yyyy-MM-dd HHmm")


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def time_key(file_name: Column) -> Column:
    """The time MM-DD-YYYY_HHMM in a file name; null without one."""
    part = F.regexp_extract(file_name, r"(\d{2}-\d{2}-\d{4}_\d{4})", 1)
    return lenient_timestamp(F.nullif(part, F.lit("")), "MM-dd-yyyy_HHmm")


def osm_width(text: Column) -> Column:
    """Metres of a width tag: the first of a list, without its unit; null if it is no number."""
    first = F.split(text, "[;,/]").getItem(0)
    return F.trim(F.replace(F.lower(first), F.lit("m"), F.lit(""))).try_cast("double")


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds between two times, with their fraction."""
    return F.timestamp_diff("MICROSECOND", start, end) / 1e6


def whole_days(start: Column, end: Column) -> Column:
    """Days between two times, rounded down: -36 hours are -2 days."""
    return F.floor(seconds_between(start, end) / 86400)


def naive_utc(ts: Column, zone: str) -> Column:
    """A clock time in a zone as the UTC time without one."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ts.cast("timestamp_ntz"))
