"""Order keys packed into one fixed-size value.

``max_by(x, struct(date, tiebreak))`` keeps a struct in the aggregation buffer,
which Spark cannot update in place, so the whole aggregate falls back from hash to
sort aggregation (every input partition sorted). When the date is a date or
timestamp and the tiebreak an integer, both fit into one ``DECIMAL(38,0)``:

    (microseconds since epoch + 3e17) * 1e20 + (tiebreak + 2^63)

(wall-clock fields for TIMESTAMP_NTZ, so no time-zone conversion is involved),
which orders exactly like the struct and keeps the aggregate hash-based.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import quote

_MICROS_PER_DAY = 86_400_000_000
_MICROS_OFFSET = 300_000_000_000_000_000  # > |micros| for years 1..9999
_TB_OFFSET = 2**63
_SHIFT = 10**20
PACKED_TYPE = "decimal(38,0)"
_INTEGRAL = {"tinyint", "smallint", "int", "bigint"}


def _dec(n: int, precision: int) -> Column:
    """An exact integer literal of any size (Python ints above 2^63 do not fit lit)."""
    return F.lit(str(n)).cast(f"decimal({precision},0)")


def micros_of(c: Column, dtype: str) -> Column | None:
    """Exact microseconds since 1970-01-01 as a long, or None if unsupported."""
    if dtype == "timestamp":
        return F.unix_micros(c)
    if dtype in ("timestamp_ntz", "date"):
        days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
        if dtype == "date":
            return days * _MICROS_PER_DAY
        frac_seconds = F.date_part(F.lit("SECOND"), c)  # decimal(8,6): seconds with fraction
        return (
            days * _MICROS_PER_DAY
            + F.hour(c).cast("long") * 3_600_000_000
            + F.minute(c).cast("long") * 60_000_000
            + (frac_seconds * 1_000_000).cast("long")
        )
    return None


def packed_order(d: Column, d_type: str, tb: Column | None, tb_type: str | None) -> Column | None:
    """One DECIMAL(38,0) ordering like ``struct(d, tb)``; None when not packable.

    NULL tiebreaks order first (as inside a struct); ``d`` must not be NULL."""
    m = micros_of(d, d_type)
    if m is None:
        return None
    if tb is None:
        t = _dec(0, 20)
    elif tb_type in _INTEGRAL:
        t = F.coalesce(tb.cast("decimal(20,0)") + _dec(_TB_OFFSET, 20), _dec(0, 20))
    else:
        return None
    hi = (m + F.lit(_MICROS_OFFSET)).cast("decimal(38,0)") * _dec(_SHIFT, 21)
    return (hi + t).cast(PACKED_TYPE)


def packed_order_or_least(d: str, d_type: str, tb: str | None, tb_type: str | None) -> Column | None:
    """``packed_order`` of two columns by name, where rows without a date come before
    all dates and are ordered by their tiebreak; None when not packable."""
    tie = F.col(quote(tb)) if tb is not None else None
    packed = packed_order(F.col(quote(d)), d_type, tie, tb_type)
    if packed is None:
        return None
    least = packed_order(F.lit("0001-01-01").cast("date"), "date", tie, tb_type) - _dec(_SHIFT, 21)
    return F.coalesce(packed, least).cast(PACKED_TYPE)
