"""Key/value filters (F1, F2, F4): ``[{key, value}]`` lists become one predicate,
which Catalyst pushes into the parquet scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import quote


def _pairs(params) -> list[tuple[str, object]]:
    if isinstance(params, Mapping):
        return list(params.items())
    out = []
    for p in params:
        if isinstance(p, Mapping):
            out.append((p["key"], p["value"]))
        else:
            k, v = p
            out.append((k, v))
    return out


def params_condition(params) -> Column:
    """AND of ``col(key) == value``; a list value means ``IN``; None means IS NULL."""
    conds = []
    for k, v in _pairs(params):
        c = F.col(quote(k))
        if v is None:
            conds.append(c.isNull())
        elif isinstance(v, (list, tuple, set)):
            conds.append(c.isin(list(v)))
        else:
            conds.append(c == F.lit(v))
    if not conds:
        raise ValueError("empty filter")
    return reduce(lambda a, b: a & b, conds)


def filter_by_params(df: DataFrame, params) -> DataFrame:
    """Keep rows matching every ``{key, value}`` pair."""
    if not _pairs(params):
        return df
    return df.filter(params_condition(params))


def exclude_by_params(df: DataFrame, params) -> DataFrame:
    """Drop rows matching every pair (F2). An empty filter is an error, never
    "delete everything"; rows where the predicate is NULL are kept."""
    cond = params_condition(params)
    return df.filter(~F.coalesce(cond, F.lit(False)))


def lookup_one(
    df: DataFrame, params, key_columns: Sequence[str] | None = None, require: bool = False
) -> DataFrame:
    """Exact-match lookup by several attributes.

    With ``require`` anything but one match is an error that tells none from several;
    at most two matches are read for it."""
    out = filter_by_params(df, params)
    out = out.select(*key_columns) if key_columns else out
    if require:
        found = out.limit(2).count()
        if found != 1:
            raise LookupError("no row matches" if found == 0 else "more than one row matches")
    return out
