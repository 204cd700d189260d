"""Reporting periods: the bounds differ from report to report, so they are explicit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_period(ts: Column, start: str, end: str, bounds: str = "[)") -> Column:
    """``ts`` inside a period; ``bounds`` is one of ``[)``, ``()`` and ``[]``."""
    if bounds not in ("[)", "()", "[]"):
        raise ValueError(f"unknown period bounds: {bounds}")
    lower = ts >= F.lit(start) if bounds[0] == "[" else ts > F.lit(start)
    upper = ts <= F.lit(end) if bounds[1] == "]" else ts < F.lit(end)
    return lower & upper


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def month_of(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "MM")


def local_date(ts: Column, zone: str = "America/Los_Angeles") -> Column:
    """Calendar date in ``zone`` of a naive UTC timestamp."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz")))


def calendar_days_between(later: Column, earlier: Column) -> Column:
    """Midnights crossed between two instants."""
    return F.datediff(later, earlier)


def elapsed_days_between(later: Column, earlier: Column) -> Column:
    """Whole 24-hour spans between two instants."""
    return F.timestamp_diff("DAY", earlier, later)


def in_zone_to_utc(text: Column) -> Column:
    """ISO-8601 text (with ``Z``, an offset, or neither) as a naive UTC timestamp; NULL if unreadable."""
    trimmed = F.nullif(F.trim(text), F.lit(""))
    zoned = F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), F.try_to_timestamp(trimmed).cast("timestamp_ntz")
    )
    has_zone = trimmed.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & trimmed.contains(":")
    return F.when(has_zone, zoned).otherwise(trimmed.try_cast("timestamp_ntz"))


def lenient_date(col: Column) -> Column:
    """A date written as a date, as text, or as a spreadsheet serial number."""
    text = col.cast("string")
    serial = text.try_cast("double")
    return F.coalesce(
        F.when(serial.isNull(), F.to_date(text.try_cast("timestamp"))),
        F.date_add(F.lit("1899-12-30").cast("date"), F.floor(serial).cast("int")),
    )


# The month abbreviations printed in the monthly tables.
MONTH_LABELS = ["ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "sept", "oct", "nov", "dic"]


def month_label(ts: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_LABELS]), F.month(ts))
