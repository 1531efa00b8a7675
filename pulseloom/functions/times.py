"""Timestamp parsing and differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The zone names that may stand before a trailing year.
ZONE_NAMES = ["PST", "PDT", "MST", "MDT", "CST", "CDT", "EST", "EDT", "UTC", "GMT"]

_ZONE_BEFORE_YEAR = r"\s+(?:" + "|".join(ZONE_NAMES) + r")\s+(\d{4})$"
_WEEKDAY = r"^\s*(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,?\s+"
_FORMATS = ["MMM d HH:mm:ss yyyy", "d MMM yyyy HH:mm:ss", "M/d/yyyy HH:mm:ss", "M/d/yyyy HH:mm", "M/d/yyyy", "yyyy/M/d"]


def parse_timestamp(text: Column) -> Column:
    """Text to zone-less timestamp; NULL where no known form fits.

    A zone name before the year is dropped, not applied. Spark does not parse
    weekday names, so they go too.
    """
    plain = F.regexp_replace(text.cast("string"), _ZONE_BEFORE_YEAR, " $1")
    bare = F.regexp_replace(plain, _WEEKDAY, "")
    tries = [plain.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(bare, F.lit(f)).cast("timestamp_ntz") for f in _FORMATS]
    return F.coalesce(*tries)


def seconds(ts: Column) -> Column:
    """Whole seconds since 1970 (the session zone must be UTC for zone-less input)."""
    return F.unix_timestamp(ts.cast("timestamp"))


def hours_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from start to end, in hours."""
    return (seconds(end) - seconds(start)) / F.lit(3600)


def epoch_to_iso(value: Column) -> Column:
    """Epoch seconds to ISO text in UTC."""
    stamp = F.timestamp_seconds(value)
    whole = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(stamp, "SSSSSS")
    return F.concat(whole, F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)), F.lit("+00:00"))


def timestamp_to_iso(ts: Column) -> Column:
    """Zone-less timestamp to ISO text."""
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)),
    )


def to_iso(value: Column, kind: str) -> Column:
    """ISO text of a value of a Spark type name: numbers are epoch seconds in UTC, times and dates are written out, text stays."""
    if kind in ("byte", "short", "integer", "long", "float", "double") or kind.startswith("decimal"):
        return epoch_to_iso(value)
    if kind in ("timestamp", "timestamp_ntz"):
        written = timestamp_to_iso(value)
        return F.concat(written, F.lit("+00:00")) if kind == "timestamp" else written
    if kind == "date":
        return F.date_format(value, "yyyy-MM-dd")
    return value.cast("string")
