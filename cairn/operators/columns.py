"""Column-level operators: drop, rename, strip prefixes, text transforms, cleaning.

Each returns a lazy DataFrame; name logic runs on the driver over the schema only,
and every rename is one ``toDF``/``select`` so Catalyst collapses the chain into a
single projection over the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.names import quote


def _check_unique(names: Sequence[str], what: str) -> None:
    seen: set[str] = set()
    for n in names:
        k = n.lower()
        if k in seen:
            raise ValueError(f"{what} would produce duplicate column {n!r}")
        seen.add(k)


def remove_columns(df: DataFrame, columns: Sequence[str], ignore_missing: bool = False) -> DataFrame:
    """Drop the named columns (P1). Unknown names are an error unless ignored."""
    present = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in present]
    if missing and not ignore_missing:
        raise ValueError(f"columns not found: {missing}")
    return df.drop(*[c for c in columns if c.lower() in present])


def drop_by_prefix(df: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Drop every column whose name starts with any of ``prefixes``."""
    doomed = [c for c in df.columns if any(c.startswith(p) for p in prefixes)]
    return df.drop(*doomed) if doomed else df


def stripped_names(columns: Sequence[str], prefixes: Sequence[str]) -> list[str]:
    """Names after prefix stripping: longest prefix first, one pass per prefix;
    a matching name loses every occurrence of that prefix."""
    names = list(columns)
    for p in sorted(prefixes, key=len, reverse=True):
        if not p:
            continue
        names = [n.replace(p, "") if n.startswith(p) else n for n in names]
    return names


def strip_prefixes(df: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Remove prefixes from column names."""
    names = stripped_names(df.columns, prefixes)
    if any(n == "" for n in names):
        raise ValueError("stripping would leave an empty column name")
    _check_unique(names, "strip_prefixes")
    return df.toDF(*names)


def _rename_pairs(renames) -> list[tuple[str, str]]:
    if isinstance(renames, Mapping):
        return list(renames.items())
    pairs = []
    for r in renames:
        if isinstance(r, Mapping):
            pairs.append((r["column_name"], r["new_column_name"]))
        else:
            a, b = r
            pairs.append((a, b))
    return pairs


def rename_columns(df: DataFrame, renames) -> DataFrame:
    """Rename in order (P4): ``[{column_name, new_column_name}]``, pairs or a dict.

    A missing source name or a duplicate result is an error."""
    names = list(df.columns)
    for old, new in _rename_pairs(renames):
        hits = [i for i, n in enumerate(names) if n.lower() == old.lower()]
        if not hits:
            raise ValueError(f"column to rename not found: {old!r}")
        for i in hits:
            names[i] = new
    _check_unique(names, "rename_columns")
    return df.toDF(*names)


def prepare_columns(
    df: DataFrame,
    columns_to_remove: Sequence[str] = (),
    column_prefixes_to_remove: Sequence[str] = (),
    remove_prefix_from_columns: Sequence[str] = (),
) -> DataFrame:
    """Pre-flatten clean-up chain (P10): drop named, drop by prefix, strip prefixes."""
    if columns_to_remove:
        df = remove_columns(df, columns_to_remove, ignore_missing=True)
    if column_prefixes_to_remove:
        df = drop_by_prefix(df, column_prefixes_to_remove)
    if remove_prefix_from_columns:
        df = strip_prefixes(df, remove_prefix_from_columns)
    return df


# The supported text transformations.
TEXT_TRANSFORMATIONS = {"lower": F.lower, "upper": F.upper, "trim": F.trim}


def text_transform(df: DataFrame, transformations) -> DataFrame:
    """Apply lower/upper/trim in place, in list order.

    ``transformations``: ``[{column_name, transformation_to_apply}]`` or pairs. A
    column may be hit several times; the steps compose into one expression."""
    exprs: dict[str, object] = {}
    cols = {c.lower(): c for c in df.columns}
    for t in transformations:
        if isinstance(t, Mapping):
            name, how = t["column_name"], t["transformation_to_apply"]
        else:
            name, how = t
        if how not in TEXT_TRANSFORMATIONS:
            raise ValueError(f"unknown transformation {how!r}")
        real = cols.get(name.lower())
        if real is None:
            raise ValueError(f"column not found: {name!r}")
        exprs[real] = TEXT_TRANSFORMATIONS[how](exprs.get(real, F.col(quote(real))))
    return df.withColumns(exprs) if exprs else df


# Fixed value: characters removed from every string value.
ILLEGAL_CHARS_PATTERN = r'[<>:"/\\|?*\x00-\x1F\x7F]'


def clean_strings(
    df: DataFrame, columns: Sequence[str] | None = None, exclude: Sequence[str] = ()
) -> DataFrame:
    """Remove ``< > : " / \\ | ? *`` and control characters from string columns."""
    skip = {c.lower() for c in exclude}
    if columns is None:
        columns = [
            f.name for f in df.schema.fields
            if isinstance(f.dataType, StringType) and f.name.lower() not in skip
        ]
    if not columns:
        return df
    return df.withColumns(
        {c: F.regexp_replace(F.col(quote(c)), ILLEGAL_CHARS_PATTERN, "") for c in columns}
    )
