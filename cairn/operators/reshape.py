"""Reshaping: standardise by mapping, unpivot, union by position or by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import quote


@dataclass(frozen=True)
class StandardMapping:
    """One source of the standardisation mapping.

    ``columns`` maps each target column to ``{"value": ..., "is_column": bool}``.
    """

    source: str
    columns: Mapping[str, Mapping[str, object]] = field(default_factory=dict)
    its_manual_registry: bool = False

    @staticmethod
    def from_dict(d: Mapping) -> "StandardMapping":
        return StandardMapping(
            source=d["source"],
            columns=d.get("map", {}),
            its_manual_registry=bool(d.get("its_manual_registry", False)),
        )


def standardize(df: DataFrame, columns: Mapping[str, Mapping[str, object]]) -> DataFrame:
    """One ``select``: each target is a source column, a constant, or NULL.

    Any falsy value (None, "", 0, False) gives a NULL string column."""
    exprs = []
    for target, spec in columns.items():
        value = spec.get("value")
        if not value:
            exprs.append(F.lit(None).cast("string").alias(target))
        elif spec.get("is_column"):
            exprs.append(F.col(quote(str(value))).alias(target))
        else:
            exprs.append(F.lit(value).alias(target))
    if not exprs:
        raise ValueError("standardisation mapping has no columns")
    return df.select(*exprs)


def standardized_table_name(source: str) -> str:
    """``schema.table`` -> ``SCHEMA.STANDARDIZED_TABLE``."""
    schema, name = source.split(".")
    return f"{schema.upper()}.STANDARDIZED_{name.upper()}"


def unpivot_columns(
    df: DataFrame,
    columns: Sequence[str],
    name_column: str,
    value_column: str,
    include_nulls: bool = False,
    value_type: str | None = None,
) -> DataFrame:
    """Columns to rows (P12): other columns repeat; NULL values dropped by default.

    Columns of different types need ``value_type`` (a common type to cast to)."""
    if not columns:
        raise ValueError("no columns to unpivot")
    taken = {c.lower() for c in columns}  # names match as Spark resolves them
    ids = [c for c in df.columns if c.lower() not in taken]
    src = df
    if value_type:
        src = df.withColumns({c: F.col(quote(c)).cast(value_type) for c in columns})
    out = src.unpivot(
        [quote(c) for c in ids], [quote(c) for c in columns], name_column, value_column
    )
    if not include_nulls:
        out = out.filter(F.col(quote(value_column)).isNotNull())
    return out


def concat_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; missing columns become NULL."""
    if not dfs:
        raise ValueError("nothing to concatenate")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_all(dfs: Sequence[DataFrame], by_name: bool = False) -> DataFrame:
    """UNION ALL, by position (default) or by name; duplicates kept."""
    if not dfs:
        raise ValueError("no tables to union")
    if by_name:
        return reduce(lambda a, b: a.unionByName(b), dfs)
    return reduce(DataFrame.union, dfs)
