"""Lenient date and timestamp parsing, month periods.

Bad text parses to null instead of failing the job (ANSI mode stays on; only
the ``try_*`` forms are used).  Every value is parsed on its own, so one
column may mix formats.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day-first text such as 15/10/2022 (one- or two-digit day and month).
DAYFIRST_FORMAT = "d/M/yyyy"
ISO_DATE_FORMAT = "yyyy-M-d"
# The reference's day-first reading of ISO text swaps day and month.
YDM_DATE_FORMAT = "yyyy-d-M"
SECONDS_PER_DAY = 86400


def has_zone(text: Column) -> Column:
    """Text with a time and a zone suffix: ``Z``, ``+05``, ``+0530`` or ``-05:00``.

    A character test instead of a regular expression (it runs once per value
    of every timestamp column): ISO text without a zone ends in digits, ``:``
    or ``.``, so a sign at a suffix position or a final ``Z`` marks a zone.
    """
    sign = lambda pos: F.substring(text, pos, 1).isin("+", "-")
    return (F.instr(text, ":") > 0) & (text.endswith("Z") | sign(-3) | sign(-5) | sign(-6))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_timestamp(c: Column | str) -> Column:
    """ISO-like text -> timestamp in the session zone (UTC), bad text -> null.

    Accepts date only, ``T`` or space separator, any fraction length and an
    optional zone offset, which is converted to UTC.
    """
    return F.try_to_timestamp(_col(c).cast("string"))


def lenient_date(c: Column | str) -> Column:
    """Timestamp text -> its calendar date in UTC, whatever the session time zone.

    Text without a zone is a UTC wall-clock time: its own date.  Text with a
    zone is an instant: the UTC day it falls on
    (``2022-10-05T23:30:00-05:00`` -> 2022-10-06).  Bad text -> null.
    """
    text = _col(c).cast("string")
    instant_day = F.date_from_unix_date(
        F.floor(F.unix_seconds(F.try_to_timestamp(text)) / SECONDS_PER_DAY).cast("int"))
    wall_clock_day = F.to_date(text.try_cast("timestamp_ntz"))
    slashed = lambda t: F.coalesce(F.try_to_date(t, "yyyy/M/d"), F.try_to_date(t, "M/d/yyyy"))
    # a zone by name (Area/City) is an instant as well
    named_zone = (F.instr(text, ":") > 0) & (F.instr(text, "/") > 0)
    # the usual shapes first: each value is parsed by the one parser its shape picks
    return (F.when(is_iso_day(text), text.try_cast("date"))
             .when(~text.rlike("[0-9]"), F.lit(None).cast("date"))
             .when(has_zone(text) | named_zone, instant_day)
             .when(F.instr(text, "/") > 0, _apart(text, slashed))
             .otherwise(F.coalesce(wall_clock_day, _apart(text, other_shapes))))


def _apart(text: Column, parse) -> Column:
    """``parse(text)`` for the seldom shapes, outside the code made for the whole stage: with the parsers of several date
    columns in it that becomes one method too long for the JVM to compile, and each row takes about six times as long."""
    return F.transform(F.array(text), parse)[0]


def is_iso_day(text: Column) -> Column:
    """Ten characters shaped ``yyyy-MM-dd``."""
    return (F.length(text) == 10) & (F.instr(text, " ") == 0) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")


def is_slashed_day(text: Column) -> Column:
    """Ten characters shaped ``dd/MM/yyyy``."""
    return (F.length(text) == 10) & (F.instr(text, " ") == 0) & (F.substring(text, 3, 1) == "/") & (F.substring(text, 6, 1) == "/")


def other_shapes(text: Column) -> Column:
    """Day-first text with ``-``, ``.`` or spaces, month names, two-digit years with a month name, and
    compact ``yyyyMMdd`` -> date; anything else -> null."""
    parts = F.regexp_replace(F.trim(text), "[-. ]+", "/")
    return (F.when(parts.rlike(r"^\d{8}$"), F.try_to_date(parts, "yyyyMMdd"))
             .when(parts.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(parts, DAYFIRST_FORMAT))
             .when(parts.rlike(r"^\d{1,2}/[A-Za-z]{3}/\d{4}$"), F.try_to_date(F.initcap(F.translate(parts, "/", " ")), "d MMM yyyy"))
             .when(parts.rlike(r"^\d{1,2}/[A-Za-z]{3}/\d{2}$"), F.try_to_date(F.initcap(F.translate(parts, "/", " ")), "d MMM yy")))


def dayfirst_date(c: Column | str, date_order: str = "ymd") -> Column:
    """Date text in ISO or day-first ``dd/MM/yyyy`` form -> date; bad -> null.

    ``date_order="ymd"`` reads ISO text as year-month-day.  ``"ydm"`` reads it
    as year-day-month, which reproduces the reference's silver month values
    (2022-09-01 -> 2022-01-09); it exists for parity tests only.

    Each value is parsed once, by the parser its shape picks: ``dd/MM/yyyy`` and
    ``yyyy-MM-dd`` by a cast (no pattern is interpreted), other day-first text by its
    ``/``, other ISO text by the ``-`` after the year; anything else goes to the
    timestamp reading.
    """
    text = _col(c).cast("string")
    iso = YDM_DATE_FORMAT if date_order == "ydm" else ISO_DATE_FORMAT
    turned = F.concat(F.substring(text, 7, 4), F.lit("-"), F.substring(text, 4, 2), F.lit("-"), F.substring(text, 1, 2)).try_cast("date")
    iso_day = is_iso_day(text) if date_order == "ymd" else F.lit(False)
    return (F.when(is_slashed_day(text), turned).when(iso_day, text.try_cast("date")).when((F.instr(text, "/") > 0) & (F.instr(text, ":") == 0),
                   F.when(F.instr(text, "/") == 5, F.try_to_date(text, "yyyy/M/d")).otherwise(F.try_to_date(text, DAYFIRST_FORMAT)))
             .when(F.substring(text, 5, 1) == "-", F.coalesce(F.try_to_date(text, iso), lenient_date(text)))
             .otherwise(lenient_date(text)))


def month_period(c: Column | str) -> Column:
    """Date or timestamp -> ``yyyy-MM`` text; null stays null."""
    return F.date_format(_col(c), "yyyy-MM")
