"""Scalar column expressions. All are built-in functions, so they stay in codegen.

ANSI mode is on in Spark 4: whatever comes from raw text goes through a ``try_``
function and yields null instead of an error. Timestamps are zone-free
(``TIMESTAMP_NTZ``) wall-clock UTC, whatever the session time zone is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlake.fixed_values import (
    RATE_FILE_DATE_FORMAT,
    RATE_FILE_DATE_PATTERN,
    ROW_KEY_DATE_FORMAT,
    SALT_BUCKETS,
    TICK_FILE_NAME_FORMAT,
)

_FIRST_MS = -62135596800000  # 0001-01-01
_LAST_MS = 253402300799999  # 9999-12-31 23:59:59.999


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _epoch() -> Column:
    return F.expr("timestamp_ntz'1970-01-01'")


def to_double(c: Column | str) -> Column:
    """Text to double; unreadable text becomes null."""
    return _col(c).try_cast("double")


def is_epoch_ms(c: Column | str) -> Column:
    """True for a number that is a time in years 1 to 9999; false for null and NaN."""
    return F.coalesce(_col(c).between(_FIRST_MS, _LAST_MS), F.lit(False))


def epoch_ms_to_ts(c: Column | str) -> Column:
    """Epoch milliseconds (number or text) to a zone-free UTC timestamp."""
    ms = to_double(c)
    micros = F.round(ms * 1000).cast("bigint")
    return F.when(is_epoch_ms(ms), F.timestamp_add("MICROSECOND", micros, _epoch()))


def _ntz_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-free timestamp, from its own fields.

    ``timestampdiff`` and casts would go through the session time zone.
    """
    days = F.unix_date(ts.cast("date")).cast("bigint")
    minutes = (days * 24 + F.hour(ts)) * 60 + F.minute(ts)
    seconds = F.date_part(F.lit("SECOND"), ts)
    return minutes * 60_000_000 + (seconds * 1_000_000).cast("bigint")


def ntz_to_epoch_ms(c: Column | str) -> Column:
    return F.unix_millis(ntz_to_instant(c))


def ntz_to_instant(c: Column | str) -> Column:
    """Zone-free UTC wall clock to an instant (streams need ``TIMESTAMP``)."""
    return F.timestamp_micros(_ntz_micros(_col(c)))


def instant_to_ntz(c: Column | str) -> Column:
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(c)), _epoch())


def ratio_change(now: Column | str, before: Column | str) -> Column:
    """``now / before - 1``; null when either is null or ``before`` is 0."""
    return F.try_divide(_col(now), _col(before)) - F.lit(1.0)


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(_col(c)), F.lit(""))


def file_name_date(name: Column | str) -> Column:
    """Date in a rate file's own name; folders with digits do not matter."""
    digits = F.regexp_extract(_col(name), RATE_FILE_DATE_PATTERN, 1)
    return F.try_to_date(F.nullif(digits, F.lit("")), RATE_FILE_DATE_FORMAT)


def path_attributes(ts: Column | str) -> dict[str, Column]:
    """Folder and file attributes of a tick: date, hour and ``dd-HH-mm``."""
    ts = _col(ts)
    return {
        "date": F.to_date(ts),
        "hour": F.hour(ts),
        "minute_name": F.date_format(ts, TICK_FILE_NAME_FORMAT),
    }


def salt(symbol: Column | str, day: Column | str, buckets: int = SALT_BUCKETS) -> Column:
    """Salt digit of a row key. ``abs`` comes after ``%``: it cannot overflow."""
    stamp = F.date_format(_col(day), ROW_KEY_DATE_FORMAT)
    return F.abs(F.hash(_col(symbol), stamp) % F.lit(buckets))


def row_key(symbol: Column | str, day: Column | str, buckets: int = SALT_BUCKETS) -> Column:
    """``salt|symbol|yyyyMMdd``; null when a part is missing."""
    symbol, day = _col(symbol), _col(day)
    key = F.concat_ws(
        "|",
        salt(symbol, day, buckets).cast("string"),
        symbol,
        F.date_format(day, ROW_KEY_DATE_FORMAT),
    )
    return F.when(symbol.isNotNull() & day.isNotNull(), key)
