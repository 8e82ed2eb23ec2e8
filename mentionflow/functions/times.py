"""Time text to timestamps, and UTC day stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mentionflow.functions.text import trimmed

# Shape of the social platform's dates after the weekday, and of the day in output paths.
SOCIAL_TIME_FORMAT = "MMM dd HH:mm:ss Z yyyy"
DAY_FORMAT = "yyyyMMdd"


def parsed_time(col: Column) -> Column:
    """Timestamp from ISO-8601 text (`Z` or an offset) or from the weekday form of the social platform.

    Empty and unreadable text gives null. Text without an offset is read in the session's time zone.
    """
    text = trimmed(col)
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))
    social = F.when(
        text.rlike(r"^[A-Za-z]{3} [A-Za-z]{3} "),
        F.try_to_timestamp(F.substring(text, 5, 2147483647), F.lit(SOCIAL_TIME_FORMAT)),
    )
    return F.coalesce(iso, social)


def utc_wall_time(ts: Column) -> Column:
    """A timestamp as UTC wall-clock time without zone, whatever the session's time zone is."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))


def from_utc_wall_time(wall: Column) -> Column:
    """The timestamp of a UTC wall-clock time, whatever the session's time zone is."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), wall).cast("timestamp")


def utc_day(ts: Column) -> Column:
    return F.date_format(utc_wall_time(ts), DAY_FORMAT)


def utc_date(ts: Column) -> Column:
    return utc_wall_time(ts).cast("date")


def iso_text(ts: Column) -> Column:
    """UTC ISO-8601 text with microseconds and an explicit offset."""
    return F.concat(F.date_format(utc_wall_time(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
