"""Timestamp parsing and formatting as native column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted extraction-timestamp layouts (Spark datetime patterns),
# tried in this order; the colon-free ones match text whose ':' was cleaned away.
EXTRACTION_FORMATS = [
    "yyyy-MM-dd'T'HHmmss.SSSSSS",
    "yyyy-MM-dd HH:mm:ss",
    "dd/MM/yyyy HH:mm",
    "yyyy-MM-dd",
    "yyyy-MM-dd'T'HHmmss",
]

ISO_UTC_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# zone-less ISO-8601 shapes (read as UTC)
ISO_LOCAL_FORMATS = [
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd",
]


_DIGIT_LETTERS = set("yMdHhmsS")


def pattern_shape(fmt: str) -> str:
    """Regex of the text a datetime pattern can produce: pattern letters are digits,
    quoted text and other characters are literal. Used as a cheap guard so the
    parser only sees candidates (a failed parse costs an exception per row)."""
    out, i = [], 0
    while i < len(fmt):
        ch = fmt[i]
        if ch == "'":
            j = fmt.index("'", i + 1)
            out.append(re.escape(fmt[i + 1:j]) if j > i + 1 else "'")
            i = j + 1
            continue
        if ch in _DIGIT_LETTERS:
            j = i
            while j < len(fmt) and fmt[j] == ch:
                j += 1
            n = j - i
            out.append(r"\d{%d}" % n if ch == "y" and n > 2 else r"\d{1,%d}" % max(n, 2))
            i = j
            continue
        if ch in "[]":  # optional section
            out.append("(?:" if ch == "[" else ")?")
            i += 1
            continue
        out.append(re.escape(ch))
        i += 1
    return "^" + "".join(out) + "$"


_ZONE_LETTERS = set("XxZOVz")


def _has_zone(fmt: str) -> bool:
    unquoted = "".join(part for i, part in enumerate(fmt.split("'")) if i % 2 == 0)
    return any(ch in _ZONE_LETTERS for ch in unquoted)


def parse_timestamp(c: Column, formats: Sequence[str] | None = None) -> Column:
    """An instant (TIMESTAMP); the first format that parses wins; NULL when none
    does (never raises).

    Text without a zone is read as UTC, whatever the session time zone. Without
    formats: ISO-8601 text, where an offset or ``Z`` is honoured."""
    if not formats:
        # zone-less ISO shapes pinned to UTC; text with a zone keeps its zone
        return F.coalesce(
            *[
                F.when(
                    c.rlike(pattern_shape(f)),
                    F.try_to_timestamp(F.concat(c, F.lit("Z")), F.lit(f + "X")),
                )
                for f in ISO_LOCAL_FORMATS
            ],
            F.try_to_timestamp(c),
        )
    out = []
    for f in formats:
        if _has_zone(f):
            parsed = F.try_to_timestamp(c, F.lit(f))
        else:  # pin zone-less text to UTC
            parsed = F.try_to_timestamp(F.concat(c, F.lit("Z")), F.lit(f + "X"))
        out.append(F.when(c.rlike(pattern_shape(f)), parsed))
    return F.coalesce(*out)


def utc_wall_clock(ts: Column) -> Column:
    """An instant as TIMESTAMP_NTZ holding its UTC wall-clock time."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))


def instant_of_utc_wall_clock(ntz: Column) -> Column:
    """Inverse of ``utc_wall_clock``: a UTC wall-clock TIMESTAMP_NTZ as an instant."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), ntz).cast("timestamp")


def parse_timestamp_ntz(c: Column, formats: Sequence[str] | None = None) -> Column:
    """As ``parse_timestamp`` but TIMESTAMP_NTZ holding the UTC wall-clock time."""
    return utc_wall_clock(parse_timestamp(c, formats))


def format_iso_utc(ts: Column, ntz: bool = False) -> Column:
    """Timestamp -> ``YYYY-MM-DDTHH:MM:SSZ`` in UTC, whatever the session zone.

    ``ntz=True``: the value is already a UTC wall-clock TIMESTAMP_NTZ."""
    return F.date_format(ts if ntz else utc_wall_clock(ts), ISO_UTC_SECONDS)
