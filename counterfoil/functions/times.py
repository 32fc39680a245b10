"""Time arithmetic in whole microseconds, and reading ISO 8601 texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted ISO 8601 texts. A date, plain or compact, then optionally
# any separator, a time with parts left out at the end, and an offset or Z.
_HOUR, _SIXTY = r"(?:[01]\d|2[0-3])", r"[0-5]\d"
_TIME = (
    rf"{_HOUR}(?::{_SIXTY}(?::{_SIXTY}(?:[.,]\d+)?)?|{_SIXTY}(?:{_SIXTY}(?:[.,]\d+)?)?)?"
)
_OFFSET = rf"(?:Z|[+-](?:0\d|1[0-7])(?::?{_SIXTY})?|[+-]18(?::?00)?)"
ISO_SHAPE = rf"^(?!0000)(?:\d{{4}}-\d{{2}}-\d{{2}}|\d{{8}})(?:.{_TIME}{_OFFSET}?)?$"

# Rewriting steps towards yyyy-MM-ddTHH:mm:ss and an offset.
_REWRITES = (
    (r"^(\d{4})(\d\d)(\d\d)", "$1-$2-$3"),
    (r"^(.{10}).(\d\d):?(\d\d)?:?(\d\d)?", "$1T$2:0$3:0$4"),
    (r":0(\d\d)", ":$1"),
    (r":0(?!\d)", ":00"),
    (r"[.,](\d{1,6})\d*", ".$1"),
    (r"(T.*[+-]\d\d):?(\d\d)?$", "$1:0$2"),
    (r"(T.*[+-]\d\d:)0(\d\d)$", "$1$2"),
    (r"(T.*[+-]\d\d:)0$", "$100"),
)


def is_iso(text: Column) -> Column:
    """Whether a text has the shape of an ISO 8601 date or date and time."""
    return text.rlike(ISO_SHAPE)


def iso_instant(text: Column) -> Column:
    """The instant of an ISO 8601 text, UTC where it names no offset; else null.

    Reads the forms a cast does not: compact ones, other separators, an offset
    after a time without seconds.
    """
    plain = text
    for pattern, replacement in _REWRITES:
        plain = F.regexp_replace(plain, pattern, replacement)
    return F.when(is_iso(text), plain.try_cast("timestamp"))


def micros(at: Column) -> Column:
    """Microseconds since the epoch; also takes timestamps without a zone."""
    return F.unix_micros(at.cast("timestamp"))


def seconds_between(a: Column, b: Column) -> Column:
    """Absolute distance in seconds, sub-second part kept."""
    return F.abs(micros(a) - micros(b)) / F.lit(1_000_000.0)


def day_of(at: Column) -> Column:
    return F.to_date(at)
