"""Clock helpers: UTC instants, business days, departure-local times, Korean weekdays.

Instants are ``timestamp_ntz`` values holding UTC wall-clock time. Every conversion names its zones, so
results are the same under any session time zone. All are built-in expressions (codegen, no Python UDF).
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from faresight.constants import BUSINESS_ZONE, WEEKDAYS_KR


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _zone(z) -> Column:
    return F.lit(z) if isinstance(z, str) else z


def local_time(ts_utc, zone) -> Column:
    """UTC instant -> wall-clock time in ``zone`` (a zone name or a column of zone names); DST aware."""
    return F.convert_timezone(F.lit("UTC"), _zone(zone), _col(ts_utc))


def local_date(ts_utc, zone=BUSINESS_ZONE) -> Column:
    """Calendar day of the instant in ``zone``."""
    return F.to_date(local_time(ts_utc, zone))


def day_window_bounds(day: dt.date | str, zone: str = BUSINESS_ZONE, days: int = 1):
    """Half-open UTC instant range ``[start, end)`` of ``days`` local days starting at ``day``.

    Computed on the driver as plain literals so the range reaches the parquet scan as pushed filters.
    """
    if isinstance(day, str):
        day = dt.date.fromisoformat(day)
    tz = ZoneInfo(zone)
    start = dt.datetime.combine(day, dt.time(0), tzinfo=tz)
    end = dt.datetime.combine(day + dt.timedelta(days=days), dt.time(0), tzinfo=tz)
    utc = dt.timezone.utc
    return (start.astimezone(utc).replace(tzinfo=None), end.astimezone(utc).replace(tzinfo=None))


def ntz_literal(value: dt.datetime) -> Column:
    """A ``timestamp_ntz`` literal (a plain ``lit(datetime)`` would be a session-zone timestamp)."""
    return F.to_timestamp_ntz(F.lit(value.strftime("%Y-%m-%d %H:%M:%S")))


def in_day_window(ts_utc, day, zone: str = BUSINESS_ZONE, days: int = 1) -> Column:
    """``ts >= start AND ts < end`` for the local day window; null when ``ts`` is null."""
    start, end = day_window_bounds(day, zone, days)
    c = _col(ts_utc)
    return (c >= ntz_literal(start)) & (c < ntz_literal(end))


def run_date(logical: str | dt.datetime, zone: str = BUSINESS_ZONE) -> dt.date:
    """Run date of a scheduled job: logical instant + 1 day, seen in ``zone``, as a date.

    Accepts ISO text with ``Z`` or an offset; a naive value is taken as UTC. Driver-side scalar (a job
    parameter), the column form is :func:`business_date`.
    """
    if isinstance(logical, str):
        logical = dt.datetime.fromisoformat(logical.replace("Z", "+00:00"))
    if logical.tzinfo is None:
        logical = logical.replace(tzinfo=dt.timezone.utc)
    return (logical + dt.timedelta(days=1)).astimezone(ZoneInfo(zone)).date()


def business_date(ts_utc, zone: str = BUSINESS_ZONE) -> Column:
    """Column form of :func:`run_date`: (instant + 1 day) in ``zone``, as a date."""
    return local_date(_col(ts_utc) + F.expr("INTERVAL 1 DAY"), zone)


#: A date, or a date and a time of day to the microsecond, with ``Z``, an offset, or neither.
ISO_TEXT = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)?(?:Z|[+-]\d{2}:?\d{2})?$"
_CLOCK = r"^\d{4}-\d{2}-\d{2}[T ]"


def instant_of_text(text) -> Column:
    """ISO 8601 text -> the instant as a UTC ``timestamp_ntz``; null for what is no such text, or no such day or time.

    ``Z`` and offsets (``+09:00``, ``+0900``) are taken as written, a text without either as UTC, whatever the session's
    time zone is. White space around the text is passed over.
    """
    t = F.trim(_col(text))
    dated = F.when(t.rlike(ISO_TEXT), t)
    # What the parser wants: a time of day with seconds, and an offset with a colon.
    timed = F.when(dated.rlike(_CLOCK), dated).otherwise(F.concat(F.substring(dated, 1, 10), F.lit("T00:00"), F.substring(dated, 11, 6)))
    timed = F.regexp_replace(timed, r"^(.{11}\d{2}:\d{2})(?=[Z+-]|$)", "$1:00")
    zoned = F.when(timed.rlike(r"(?:Z|[+-]\d{2}:?\d{2})$"), F.regexp_replace(timed, r"([+-]\d{2})(\d{2})$", "$1:$2")).otherwise(F.concat(timed, F.lit("Z")))
    micros = F.unix_micros(zoned.try_cast("timestamp"))
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return epoch + F.make_dt_interval(secs=(micros / F.lit(1_000_000)).cast("decimal(18,6)"))


def business_date_of_text(text, zone: str = BUSINESS_ZONE) -> Column:
    """:func:`business_date` of ISO text: run dates as they come in data, null where the text is no instant."""
    return business_date(instant_of_text(text), zone)


def weekday_kr(d) -> Column:
    """Korean weekday name of a date, Monday first (``weekday`` is 0 for Monday)."""
    names = F.array(*[F.lit(n) for n in WEEKDAYS_KR])
    return F.element_at(names, F.weekday(_col(d)) + 1)


def iso_date_text(d) -> Column:
    """``yyyy-MM-dd`` text of a date (a plain cast, cheaper per row than a format pattern)."""
    return _col(d).cast("string")


def ts_text(ts) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a ``timestamp_ntz`` (how archived times are printed)."""
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss")
