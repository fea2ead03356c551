"""Dates, kick-off times and match clocks. Bad text gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOME_ZONE = "Europe/London"
LOCAL_ZONE = "Asia/Ho_Chi_Minh"

def parse_long_date(text: Column) -> Column:
    """"31 March 1998" -> date."""
    return F.try_to_timestamp(text, F.lit("d MMMM yyyy")).cast("date")


def _digits(text: Column) -> Column:
    """Text of digits as INT, other text as null.

    The pattern comes first because a cast that fails costs an exception per
    row, even a tried one.
    """
    return F.when(text.rlike(r"^\s*-?\d{1,9}$"), text.try_cast("int"))


def _wall_time(text: Column) -> Column:
    """"Sat 12 Aug 2023, 15:00 BST" as a zone-free timestamp.

    The zone word is optional and carries no information beyond the wall
    time. Read as UTC and rebuilt from the epoch, the text is parsed once
    and the zone of the session plays no part.
    """
    bare = F.trim(F.replace(F.replace(text, F.lit("BST"), F.lit("")), F.lit("GMT"), F.lit("")))
    as_utc = F.concat(F.substr(bare, F.lit(5)), F.lit(" Z"))
    seconds = F.unix_seconds(F.try_to_timestamp(as_utc, F.lit("d MMM yyyy, H:mm X")))
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def london_to_local(text: Column) -> Column:
    """Kick-off text (London wall time) -> local wall time as TIMESTAMP_NTZ.

    In the hour that repeats when summer time ends, the standard-time reading
    holds: an hour later in UTC, if that instant shows the same wall time.
    That happens on autumn nights only, so other rows skip the test.
    """
    wall = _wall_time(text)
    utc = F.convert_timezone(F.lit(HOME_ZONE), F.lit("UTC"), wall)
    later = utc + F.expr("INTERVAL '1' HOUR")
    autumn_night = (F.month(wall) >= 9) & (F.hour(wall) < 4)
    repeated = autumn_night & (F.convert_timezone(F.lit("UTC"), F.lit(HOME_ZONE), later) == wall)
    return F.convert_timezone(F.lit("UTC"), F.lit(LOCAL_ZONE), F.when(repeated, later).otherwise(utc))


def local_date(text: Column) -> Column:
    return F.to_date(london_to_local(text))


def local_time(text: Column) -> Column:
    return clock_text(london_to_local(text))


def clock_text(wall: Column) -> Column:
    """HH:mm of a zone-free timestamp. Formatting one as a whole would read it
    in the zone of the session first and move times that zone skips."""
    two = lambda part: F.lpad(part.cast("string"), 2, "0")
    return F.concat(two(F.hour(wall)), F.lit(":"), two(F.minute(wall)))


def clock_minutes(label: Column) -> Column:
    """"90 +5'00" -> 95: the numbers left after removing + and '00, added up."""
    cleaned = F.replace(F.replace(label, F.lit("+"), F.lit("")), F.lit("'00"), F.lit(""))
    return F.aggregate(
        F.split(cleaned, " "), F.lit(0), lambda total, part: total + _digits(part)
    )


def academic_year(day: Column, start_month: int = 9) -> Column:
    """2023-05-13 -> "2022-23": a year that starts in ``start_month``."""
    start = F.year(day) - F.when(F.month(day) < start_month, 1).otherwise(0)
    return F.concat(start.cast("string"), F.lit("-"), F.substring((start + 1).cast("string"), 3, 8))


def hms(seconds: Column) -> Column:
    """Seconds, rounded half to even, as HH:MM:SS with unbounded hours."""
    total = F.bround(seconds, 0).cast("bigint")
    return F.when(
        total.isNotNull(),
        F.format_string(
            "%02d:%02d:%02d", F.floor(total / 3600), F.pmod(F.floor(total / 60), F.lit(60)), F.pmod(total, F.lit(60))
        ),
    )
