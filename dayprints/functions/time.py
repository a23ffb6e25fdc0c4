"""Time columns. All times are UTC without a zone (``timestamp_ntz``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SLOTS = 48
SLOT_SECONDS = 1800
BINS = 288
BIN_SECONDS = 300

_TEXT = r"^\s*(\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(text: Column | str) -> Column:
    """``YYYY-MM-DD HH:MM:SS[.fff] UTC`` to a timestamp, null if it does not parse."""
    found = F.regexp_extract(_col(text), _TEXT, 1)
    return F.nullif(found, F.lit("")).try_cast("timestamp_ntz")


def from_millis(ms: Column | str) -> Column:
    """Epoch milliseconds to a timestamp in UTC."""
    # make_dt_interval has microsecond seconds, so no precision is lost
    ms = _col(ms).cast("bigint")
    days = F.floor(ms / F.lit(86_400_000)).cast("int")
    rest = F.pmod(ms, F.lit(86_400_000)).cast("decimal(18,3)") / F.lit(1000).cast("decimal(18,3)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        days, F.lit(0), F.lit(0), rest.cast("decimal(18,6)"))


def date_document_millis(text: Column | str) -> Column:
    """The epoch in ``{"$date": 1530000000000}`` document text."""
    return F.regexp_extract(_col(text), r'"?\$date"?\s*:\s*(-?\d+)', 1).try_cast("bigint")


def day(ts: Column | str) -> Column:
    return F.to_date(_col(ts))


def second_of_day(ts: Column | str) -> Column:
    ts = _col(ts)
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 in UTC, whatever the session time zone is."""
    days = F.datediff(day(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + second_of_day(ts)


def epoch_millis(ts: Column | str) -> Column:
    fraction = F.date_part(F.lit("SECOND"), _col(ts)) * 1000
    return (epoch_seconds(ts) - F.second(_col(ts))) * 1000 + F.floor(fraction).cast("bigint")


def slot48(ts: Column | str) -> Column:
    """Half hour of the day, 0 to 47."""
    return F.floor(second_of_day(ts) / SLOT_SECONDS).cast("int")


def bin288(ts: Column | str) -> Column:
    """Index of the first five-minute mark after the sample (1 to 288).

    The axis ends at bin 287, so callers drop 288 (samples from 23:55:00 on).
    """
    return (F.floor(second_of_day(ts) / BIN_SECONDS) + 1).cast("int")


def week_year(d: Column | str) -> Column:
    return F.year(_col(d))


def iso_week(d: Column | str) -> Column:
    return F.weekofyear(_col(d))


def week_start(d: Column | str) -> Column:
    """Monday of the day's week."""
    d = _col(d)
    return F.date_sub(d, F.weekday(d))


def week_label(year: Column | str, week: Column | str) -> Column:
    """Monday of Monday-based week ``week`` of ``year`` (week 1 = first Monday on).

    This is the label the weekly indicators are published under: the week number
    is an ISO one but read as a Monday-counted one.
    """
    first = F.make_date(_col(year), F.lit(1), F.lit(1))
    return F.date_add(F.next_day(F.date_sub(first, 1), "MON"), (_col(week) - 1) * 7)


def time_text(seconds: Column | str) -> Column:
    """Seconds of the day as ``HH:mm:ss``."""
    s = _col(seconds).cast("int")
    two = lambda c: F.lpad(c.cast("int").cast("string"), 2, "0")
    return F.concat_ws(":", two(F.floor(s / 3600)), two(F.floor((s % 3600) / 60)), two(s % 60))


def ms_to_s(ms: Column | str) -> Column:
    return F.floor(_col(ms) / F.lit(1000)).cast("bigint")
