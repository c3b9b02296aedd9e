"""Typed coercion of extracted rows to a declared schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import quote
from ..functions.timestamps import EXTRACTION_FORMATS, parse_timestamp, utc_wall_clock

ISO_LOCAL = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"

# Declared type names and the Spark type each one maps to.
TYPE_MAP = {
    "int64": "bigint",
    "int8": "tinyint",
    "float64": "double",
    "string": "string",
    "timestamp[ns]": "timestamp_ntz",
    "bool": "boolean",
}

# Date, hour and minute with anything after them: seconds, 1 to 9 fraction digits, a zone.
ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"
# A number with a point or an exponent.
NUMBER_FORM = r"^[+-]?[0-9]*\.?[0-9]*([eE][+-]?[0-9]+)?$"


def coerce_schema(
    df: DataFrame,
    schema: Mapping[str, str],
    timestamp_formats: Sequence[str] | None = None,
    strict: bool = False,
    rejects: str | None = None,
) -> DataFrame:
    """Exactly the declared columns, in declared order, each cast leniently:
    bad numbers and timestamps become NULL (``try_cast``), never an error.

    A declared column missing from ``df`` is a NULL column unless ``strict``;
    undeclared columns are dropped. Whole numbers may be written with a point or an
    exponent (``12.0``, ``1e3``). ``rejects`` names one more column: a map of the refused
    values by declared name (empty where nothing was refused). Timestamps try ISO text first, then
    ``timestamp_formats`` (default: the extraction layouts)."""
    fmts = list(timestamp_formats or EXTRACTION_FORMATS)
    have = {c.lower(): (c, t) for c, t in df.dtypes}
    out, refused = [], []
    for name, decl in schema.items():
        if decl not in TYPE_MAP:
            raise ValueError(f"unsupported type {decl!r} for {name!r}")
        target = TYPE_MAP[decl]
        found = have.get(name.lower())
        if found is None:
            if strict:
                raise ValueError(f"declared column {name!r} missing")
            out.append(F.lit(None).cast(target).alias(name))
            continue
        src, src_type = found
        c = F.col(quote(src))
        if target == "timestamp_ntz":
            if src_type == "timestamp":
                e = utc_wall_clock(c)
            elif src_type in ("timestamp_ntz", "date"):
                e = c.cast("timestamp_ntz")
            else:
                text = F.trim(c.cast("string"))
                # any other ISO shape: a zone is honoured, text without one is UTC
                iso = F.when(
                    text.rlike(ISO_SHAPE),
                    F.coalesce(F.try_to_timestamp(F.concat(text, F.lit("Z"))), F.try_to_timestamp(text)),
                )
                e = utc_wall_clock(F.coalesce(parse_timestamp(text, [ISO_LOCAL] + fmts), iso))
        elif target == "string":
            e = c.cast("string")
        else:
            e = F.expr(f"try_cast({quote(src)} AS {target})")
            if src_type == "string" and target in ("bigint", "tinyint"):
                # 12.0 and 1e3 are whole, 12.5 is not; the text itself comes first
                wide = f"try_cast({quote(src)} AS decimal(38,9))"
                whole = F.expr(f"CASE WHEN {wide} = floor({wide}) THEN try_cast({wide} AS {target}) END")
                e = F.coalesce(e, F.when(F.trim(c).rlike(NUMBER_FORM), whole))
        out.append(e.alias(name))
        if rejects is not None:
            given = c.isNotNull() if src_type != "string" else F.trim(c) != ""
            refused.append(F.when(given & e.isNull(), F.struct(F.lit(name).alias("k"), c.cast("string").alias("v"))))
    if rejects is not None:
        kept = F.array_compact(F.array(*refused)) if refused else F.array().cast("array<struct<k:string,v:string>>")
        out.append(F.map_from_entries(kept).alias(rejects))
    return df.select(*out)
