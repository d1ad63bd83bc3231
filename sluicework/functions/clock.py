"""Time expressions on zone-less timestamps.

Everything is computed from the calendar fields of the value, so no result depends on the session
time zone (``date_trunc`` and ``timestampdiff`` would go through it).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted spellings of an ISO date and an ISO timestamp.
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d{1,6})?)?)?$"


def epoch_minutes(ts: Column) -> Column:
    """Index of the minute that contains ``ts``, counted from 1970-01-01 00:00."""
    days = F.unix_date(F.to_date(ts)).cast("bigint")
    return days * F.lit(1440) + F.hour(ts) * F.lit(60) + F.minute(ts)


def second_micros(ts: Column) -> Column:
    """Microseconds since the start of the minute, 0 to 59,999,999."""
    return (F.extract(F.lit("SECOND"), ts) * F.lit(1_000_000)).cast("bigint")


def epoch_micros(ts: Column) -> Column:
    return epoch_minutes(ts) * F.lit(60_000_000) + second_micros(ts)


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from ``start`` to ``end``: 08:00:30 to 09:00:00 counts 60."""
    return epoch_minutes(end) - epoch_minutes(start)


def hours_between(start: Column, end: Column) -> Column:
    """Elapsed time in hours, as a fraction."""
    return (epoch_micros(end) - epoch_micros(start)) / F.lit(3_600_000_000.0)


def sub_milli_micros(ts: Column) -> Column:
    """The microseconds below the millisecond, 0 to 999."""
    return F.pmod(second_micros(ts), F.lit(1000))


def to_millis(ts: Column) -> Column:
    """Cut (never round) to milliseconds."""
    below = (sub_milli_micros(ts) / F.lit(1_000_000)).cast("decimal(18,6)")
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), below)


def millis_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSS``, always with three digits."""
    text = to_millis(ts).cast("string")
    return F.rpad(F.when(F.length(text) == 19, F.concat(text, F.lit("."))).otherwise(text), 23, "0")


def at_time(date: Column, seconds: Column) -> Column:
    """A date plus a time of day given as seconds."""
    return date.cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")
    )


def iso_timestamp(text: Column) -> Column:
    """ISO text to a timestamp: ``T`` or a blank between date and time, up to six fraction digits."""
    return F.when(F.trim(text).rlike(ISO_TIMESTAMP), F.trim(text).try_cast("timestamp_ntz"))


def iso_date(text: Column) -> Column:
    return F.when(F.trim(text).rlike(ISO_DATE), F.trim(text).try_cast("date"))


def iso_time(text: Column) -> Column:
    """An ISO time of day as ``HH:MM:SS.ffffff`` text, which casts to TIME; NULL for what is none.

    ``10``, ``10:11``, ``10:11:12`` and ``10:11:12.5`` (or with a comma), with or without a leading T, and the
    same without colons. Digits beyond microseconds are cut. A time with an offset is no time of day.
    """
    shape = r"^T?([01]\d|2[0-3])(?:(:?)([0-5]\d)(?:\2([0-5]\d)(?:[.,](\d+))?)?)?$"

    def part(group: int) -> Column:
        return F.regexp_extract(text, shape, group)

    written = F.concat(
        part(1), F.lit(":"), F.rpad(part(3), 2, "0"), F.lit(":"), F.rpad(part(4), 2, "0"),
        F.lit("."), F.rpad(part(5), 6, "0"))
    return F.when(text.rlike(shape), written)
