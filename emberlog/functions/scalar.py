"""Scalar expressions on log columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from emberlog.schema import ERROR_LEVELS, LEVELS, SLOW_MS

ISO_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d{1,9})?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
)


#: The usual form, which needs no mending.
ISO_PLAIN = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})?\z"


def level_int(level: Column, default: int | None = None) -> Column:
    """Ordinal of the level; ``default`` (or null) for unknown ones."""
    out = None
    for i, name in enumerate(LEVELS):
        out = F.when(level == name, F.lit(i)) if out is None else out.when(level == name, F.lit(i))
    return out if default is None else out.otherwise(F.lit(default))


def is_error(level: Column) -> Column:
    return level.isin(*ERROR_LEVELS)


def is_slow(response_ms: Column) -> Column:
    return response_ms > SLOW_MS


def count_char(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to a timestamp; a missing offset means UTC, anything else is null."""
    trimmed = strip(text)
    spaced = F.regexp_replace(trimmed, r"([+-]\d{2})(\d{2})$", "$1:$2")
    spaced = F.regexp_replace(spaced, r"^(\d{4}-\d{2}-\d{2}[T ]\d{2})(Z|[+-]\d{2}:\d{2})?$", "$1:00$2")
    has_time = F.length(trimmed) > 10
    mended = F.when(has_time, spaced).otherwise(trimmed)
    return F.try_to_timestamp(F.when(text.rlike(ISO_PLAIN), text).when(trimmed.rlike(ISO_PATTERN), mended))


def iso_text(instant: Column) -> Column:
    """UTC ISO-8601 text with microseconds."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return F.when(whole > 0, F.round(part / whole * 100, places)).otherwise(F.lit(0.0))


def settled(value: Column, places: int) -> Column:
    """Round half up after dropping the floating-point noise of an interpolated value."""
    return F.round(F.round(value.cast("double"), 6), places)


def per_minute(count: Column, window_s: int) -> Column:
    return F.round(count / F.lit(window_s) * 60, 1)


def epoch_bucket_us(us: Column, width_s: int) -> Column:
    """Start of the epoch-aligned bucket, in microseconds."""
    width = F.lit(width_s * 1_000_000)
    return us - F.pmod(us, width)


def clean_response(value: Column) -> Column:
    """Latency as a number: unreadable, NaN and negative values are 0."""
    return F.greatest(F.coalesce(F.nanvl(value.try_cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(0.0))


def is_http_error(status: Column) -> Column:
    """1 when the status is 400 or more; an unreadable or NaN status counts as 200."""
    return F.when(F.coalesce(F.nanvl(status.try_cast("double"), F.lit(200.0)), F.lit(200.0)) >= 400, 1).otherwise(0)


def instant(as_of: datetime | Column | None) -> Column:
    """The reference instant of a 'last N' query; now unless given."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
