"""Incremental loads driven by a saved high-water mark.

The mark is a timestamp per source kept in a small state table (parquet folder;
rows are appended, the latest saved row per source wins). Order of a run: read
pages -> clean -> coerce -> write data -> **then** save the new mark, so a failed
write never skips rows; the inclusive ``>=`` re-read is made harmless by upsert.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from ..functions.names import quote
from ..functions.timestamps import (
    format_iso_utc,
    instant_of_utc_wall_clock,
    parse_timestamp,
    utc_wall_clock,
)
from ..session import create_new, small_files

STATE_SCHEMA = StructType(
    [
        StructField("source", StringType(), False),
        StructField("last_update", TimestampType(), True),
        StructField("saved_at", TimestampType(), False),
    ]
)


def _field(df: DataFrame, name: str) -> tuple[Column, str]:
    """A column, or a field inside one (``attributes.updated_at``), and its type."""
    if name in df.columns:
        c = F.col(quote(name))
    else:
        c = F.col(".".join(quote(part) for part in name.split(".")))
    return c, df.select(c.alias("c")).dtypes[0][1]


def _mark_col(mark) -> Column:
    if isinstance(mark, Column):
        return mark
    if isinstance(mark, dt.datetime):
        return F.lit(mark)
    return parse_timestamp(F.lit(str(mark)))


def incremental_filter(
    df: DataFrame,
    ts_column: str,
    mark=None,
    is_historical: bool = False,
    floor_to_day: bool = False,
) -> DataFrame:
    """Rows with ``ts >= mark`` (inclusive); no mark or ``is_historical`` = all rows.

    ``floor_to_day`` compares from the mark's midnight (shape B sources). The
    predicate is a plain comparison, so it reaches the parquet scan."""
    if mark is None or is_historical:
        return df
    m = utc_wall_clock(_mark_col(mark))  # UTC wall clock, zone-free from here on
    if floor_to_day:
        m = F.date_trunc("day", m)
    ts, dtype = _field(df, ts_column)
    if dtype == "string":
        ts = utc_wall_clock(parse_timestamp(ts))
    elif dtype != "timestamp_ntz":
        m = instant_of_utc_wall_clock(m)
    return df.filter(ts >= m)


def next_watermark(
    df: DataFrame,
    ts_column: str,
    formats: Sequence[str] | None = None,
    floor: str | None = None,
) -> DataFrame:
    """One row: the new mark (``YYYY-MM-DDTHH:MM:SSZ``), the values seen and the
    values that did not parse (ignored, reported).

    ``floor="day"`` gives the mark at midnight of the latest day (shape B)."""
    c, dtype = _field(df, ts_column)
    # everything as a UTC wall-clock TIMESTAMP_NTZ: max, floor and format are zone-free
    if dtype == "timestamp_ntz":
        parsed = c
    elif dtype in ("timestamp", "date"):
        parsed = utc_wall_clock(c.cast("timestamp"))
    else:
        parsed = utc_wall_clock(parse_timestamp(c, formats))
    agg = df.select(parsed.alias("_t"), c.isNotNull().alias("_seen")).agg(
        F.max("_t").alias("_max"),
        F.count_if(F.col("_seen")).alias("values_seen"),
        F.count_if(F.col("_seen") & F.col("_t").isNull()).alias("values_unparsed"),
    )
    mx = F.col("_max")
    if floor == "day":
        mx = F.date_trunc("day", mx)
    elif floor is not None:
        raise ValueError("floor must be None or 'day'")
    return agg.select(
        format_iso_utc(mx, ntz=True).alias("last_update"), "values_seen", "values_unparsed"
    )


class StaleMarkError(RuntimeError):
    """Another run has saved a mark since this one began."""


class WatermarkStore:
    """Per-source marks in a parquet folder; appends only, latest save wins (K8)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _read(self) -> DataFrame | None:
        if not any(x.startswith("part-") for x in small_files(self.spark, self.path)):  # no mark saved yet
            return None
        return self.spark.read.schema(STATE_SCHEMA).parquet(self.path)

    def load(self, source: str) -> str | None:
        """The saved mark as ``YYYY-MM-DDTHH:MM:SSZ``, or None."""
        df = self._read()
        if df is None:
            return None
        rows = (
            df.filter(F.col("source") == source)
            .agg(F.max_by("last_update", "saved_at").alias("m"))
            .select(format_iso_utc(F.col("m")).alias("m"))
            .collect()
        )
        return rows[0]["m"] if rows else None

    def version(self, source: str) -> int:
        """How many marks were saved for the source; give it to ``save`` so that of two
        runs that began at one mark only the first can save its own."""
        return max((int(x) for x in small_files(self.spark, self._claims(source)) if x.isdigit()), default=0)

    def _claims(self, source: str) -> str:
        return f"{self.path}/_versions/{hashlib.sha256(source.encode()).hexdigest()[:32]}"

    def save(self, source: str, mark: str, version: int | None = None) -> None:
        """Append a mark. With ``version`` (from before the run) the next version is claimed
        first, by creating a file of its number: if another run has it, this one ends
        with ``StaleMarkError`` and nothing is saved."""
        if version is None:
            version = self.version(source)
            while not create_new(self.spark, f"{self._claims(source)}/{version + 1}", mark):
                version += 1
        elif not create_new(self.spark, f"{self._claims(source)}/{version + 1}", mark):
            raise StaleMarkError(f"the mark of {source!r} was moved by another run")
        row = self.spark.range(1).select(
            F.lit(source).alias("source"),
            parse_timestamp(F.lit(mark)).alias("last_update"),
            F.current_timestamp().alias("saved_at"),
        )
        row.write.mode("append").parquet(self.path)
