"""Timestamp helpers.

Raw request dates are text in ``RAW_DATE_PATTERN``.  They are parsed to
``timestamp_ntz`` (wall-clock, no zone): the values come from a local clock,
and a zone-free type keeps hours, dates and differences independent of the
session time zone.  Unparseable text (blank, unpadded, malformed) becomes
NULL instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reqlens.roles import RAW_DATE_PATTERN


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Session zones without DST: a zoned parse cast to timestamp_ntz is exact there.
FIXED_OFFSET_ZONES = frozenset({"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "UCT", "Etc/UCT", "Zulu"})


def parse_timestamp(text, pattern: str = RAW_DATE_PATTERN, session_zone: str | None = None) -> Column:
    """Text -> ``timestamp_ntz``; NULL where the text does not match ``pattern``.

    ``try_to_timestamp`` tolerates bad input but yields a zoned timestamp, and
    casting that to ``timestamp_ntz`` shifts wall-clock times that fall into a
    DST gap of the session zone.  In a zone without DST (``session_zone`` in
    :data:`FIXED_OFFSET_ZONES`) that single parse is exact; otherwise it only
    guards the zone-free parse (two parses per value).
    """
    c, fmt = _col(text), F.lit(pattern)
    zoned = F.try_to_timestamp(c, fmt)
    if session_zone in FIXED_OFFSET_ZONES:
        return zoned.cast("timestamp_ntz")
    return F.when(zoned.isNotNull(), F.to_timestamp_ntz(c, fmt))


def format_raw_timestamp(ts, session_zone: str | None = None) -> Column:
    """``timestamp_ntz`` -> text in ``RAW_DATE_PATTERN`` (``MM/dd/yyyy hh:mm:ss a``), wall-clock exact.

    ``date_format`` passes a ``timestamp_ntz`` through the session zone, which
    moves wall-clock times inside a DST gap (02:30 becomes 03:30).  In a zone
    without DST it is exact and used; otherwise the text is assembled from the
    zone-free string form of the value.
    """
    c = _col(ts)
    if session_zone in FIXED_OFFSET_ZONES:
        return F.date_format(c, RAW_DATE_PATTERN)
    s = c.cast("string")  # yyyy-MM-dd HH:mm:ss[.ffffff]
    hour = F.substring(s, 12, 2).cast("int")
    return F.concat(
        F.substring(s, 6, 2), F.lit("/"), F.substring(s, 9, 2), F.lit("/"), F.substring(s, 1, 4), F.lit(" "),
        F.lpad(((hour + 11) % 12 + 1).cast("string"), 2, "0"), F.lit(":"), F.substring(s, 15, 2), F.lit(":"),
        F.substring(s, 18, 2), F.lit(" "), F.when(hour < 12, "AM").otherwise("PM"),
    )


def whole_seconds_between(start, end) -> Column:
    """``unix_timestamp(end) - unix_timestamp(start)``: each side floored to whole seconds."""
    return F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))


def hour_label(hour) -> Column:
    """0..23 -> ``'HH:00'``; NULL stays NULL."""
    return F.concat(F.lpad(_col(hour).cast("string"), 2, "0"), F.lit(":00"))
