"""Column expressions for reading change envelopes.

All of these are native Catalyst expressions: they stay inside whole-stage
codegen and never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Change-capture operation codes and the names they map to.
# c (create) and r (snapshot read) -> INSERT, u -> UPDATE, d -> DELETE,
# anything else, NULL included -> UNKNOWN.
OP_NAMES = {"c": "INSERT", "r": "INSERT", "u": "UPDATE", "d": "DELETE"}
UNKNOWN_OP = "UNKNOWN"
DELETE_OP = "DELETE"
KEY_SEPARATOR = "|"
MONTH_FORMAT = "yyyy-MM"


def operation_type(op: Column) -> Column:
    """Normalise a raw op code (``c|r|u|d``) to INSERT/UPDATE/DELETE/UNKNOWN."""
    expr = None
    for code, name in OP_NAMES.items():
        expr = F.when(op == code, name) if expr is None else expr.when(op == code, name)
    return expr.otherwise(UNKNOWN_OP)


def surrogate_key(key: Column, lsn: Column) -> Column:
    """Replay-stable 64-bit key of one change: xxhash64 of ``key|lsn`` as text.

    ``concat_ws`` skips NULLs, so (NULL, 5) and (5, NULL) share a key and the
    result is never NULL.
    """
    return F.xxhash64(F.concat_ws(KEY_SEPARATOR, key.cast("string"), lsn.cast("string")))


def month_bucket(event_ts_text: Column, fallback_ts: Column) -> Column:
    """``yyyy-MM`` in UTC of the event time, else of ``fallback_ts``.

    UTC whatever the session zone: the instant is shifted to its UTC wall clock before
    rendering. Junk timestamps become NULL via ``try_cast`` (ANSI mode would throw on
    ``cast``).
    """
    instant = F.coalesce(event_ts_text.try_cast("timestamp"), fallback_ts)
    return F.date_format(F.to_utc_timestamp(instant, F.current_timezone()), MONTH_FORMAT)


def envelope_timestamp(ts: Column) -> Column:
    """Render a timestamp the way the capture connector does (UTC, microseconds, ``Z``),
    whatever the session zone. ``to_json`` of a timestamp would keep only milliseconds.
    """
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
