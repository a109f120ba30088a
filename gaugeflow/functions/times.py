"""Time text: ISO prefixes, date prefixes and bucket labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket for records without a usable date, and its timestamp pattern.
NO_DATE_BUCKET = "00000000"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def iso_timestamp(text: Column, honour_offset: bool = False) -> Column:
    """Timestamp from the first 19 characters of ISO text, read as UTC.

    An offset after the seconds is ignored, as is a fraction. Text that does not
    parse gives NULL. With ``honour_offset`` a trailing offset shifts the instant.
    The zone is written into the pattern, so the session time zone has no effect.
    """
    prefix = F.try_to_timestamp(
        F.concat(F.substr(text, F.lit(1), F.lit(19)), F.lit("Z")),
        F.lit(ISO_SECONDS + "XXX"),
    )
    if not honour_offset:
        return prefix
    zoned = F.try_to_timestamp(text, F.lit(ISO_SECONDS + "[.SSSSSS][.SSS]XXX"))
    return F.coalesce(zoned, prefix)


def iso_micros(text: Column, honour_offset: bool = False) -> Column:
    """Microseconds since the epoch of :func:`iso_timestamp`."""
    return F.unix_micros(iso_timestamp(text, honour_offset))


def prefix_date(service_date: str | Column, time_text: Column) -> Column:
    """``<service date> <time>``; the date is a parameter so that reruns agree."""
    date = F.lit(service_date) if isinstance(service_date, str) else service_date
    return F.concat(date, F.lit(" "), time_text)


def bucket_label(date_text: Column) -> Column:
    """Directory label of a record's date; null and empty fall back to a fixed one."""
    return F.coalesce(F.nullif(date_text, F.lit("")), F.lit(NO_DATE_BUCKET))
