"""Publication times and local calendar dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork import settings as S


def parse_rfc822(text: Column) -> Column:
    """Instant of ``[Mon, ]15 Jan 2024 10:30:00 +0900``; null for any other form."""
    body = F.regexp_replace(text, "^\\s*[A-Za-z]{3},\\s*", "")
    shaped = body.rlike("^\\d{1,2} [A-Za-z]{3} \\d{4} \\d{2}:\\d{2}:\\d{2} [+-]\\d{4}$")
    return F.when(shaped, F.try_to_timestamp(body, F.lit("d MMM yyyy HH:mm:ss Z")))


def local_time(instant: Column, zone: str = S.LOCAL_ZONE) -> Column:
    """Wall-clock time in ``zone``, whatever the session's own zone is."""
    return F.convert_timezone(F.current_timezone(), F.lit(zone), instant.cast("timestamp_ntz"))


def instant_of(local: Column, zone: str = S.LOCAL_ZONE) -> Column:
    """The instant of a wall-clock time in ``zone``."""
    wall_clock = local.cast("timestamp_ntz")
    return F.convert_timezone(F.lit(zone), F.current_timezone(), wall_clock).cast("timestamp")


def local_date(instant: Column, zone: str = S.LOCAL_ZONE) -> Column:
    return F.to_date(local_time(instant, zone))


def parse_day(text: Column) -> Column:
    """Date of a ``YYYY-MM-DD`` text; null when it is not one."""
    return F.when(text.rlike("^\\d{4}-\\d{1,2}-\\d{1,2}$"), F.try_to_date(text, "y-M-d"))


def in_window(day: Column, asof: Column, months: int = 3) -> Column:
    """True when ``day`` is no later than ``asof`` and at most ``months`` months before it."""
    return F.coalesce(day.between(F.add_months(asof, -months), asof), F.lit(False))
