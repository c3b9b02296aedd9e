"""Flatten JSON-object string columns into one string column per key.

Key discovery is the only action: all columns, found or given, are scanned in **one**
job that emits distinct (column, key) pairs, aggregated map-side before the shuffle, so
what reaches the driver is the key set (the future schema), never the data, and at most
``MAX_KEYS`` of them. The second scan is the result's own: each column is parsed
**once** into ``map<string,string>`` and indexed per key.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.names import dedupe_names, normalize_name, quote

log = logging.getLogger(__name__)

MAP_TYPE = "map<string,string>"
#: Most keys that discovery brings to the driver; more are an error, never left out.
MAX_KEYS = 100_000


def _string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def discover_json_columns(df: DataFrame, candidates: Sequence[str] | None = None) -> list[str]:
    """String columns whose non-null values are all JSON objects.

    One aggregation over all candidates; all-NULL columns are not chosen."""
    cols = list(candidates) if candidates is not None else _string_columns(df)
    if not cols:
        return []
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(quote(c))
        aggs.append(F.count(v).alias(f"n{i}"))
        aggs.append(F.count(F.json_object_keys(v)).alias(f"o{i}"))
    row = df.agg(*aggs).collect()[0]
    return [c for i, c in enumerate(cols) if row[f"n{i}"] > 0 and row[f"n{i}"] == row[f"o{i}"]]


def discover_keys(
    df: DataFrame, columns: Sequence[str], max_keys: int | None = MAX_KEYS
) -> tuple[dict[str, list[str]], dict[str, bool], dict[str, bool]]:
    """Distinct keys per column (sorted), whether a column holds a non-object, and
    whether it holds any non-null value.

    One job for all columns (R6). At most ``max_keys`` keys reach the driver: more
    is an error, so an unbounded key set never lands on the driver."""
    if not columns:
        return {}, {}, {}
    entries = []
    for c in columns:
        v = F.col(quote(c))
        keys = F.json_object_keys(v)
        entries.append(
            F.struct(
                F.lit(c).alias("c"),
                keys.alias("keys"),
                (v.isNotNull() & keys.isNull()).alias("bad"),
                v.isNotNull().alias("seen"),
            )
        )
    pairs = (
        df.select(F.explode(F.array(*entries)).alias("e"))
        .select(
            F.col("e.c").alias("c"),
            F.explode_outer("e.keys").alias("k"),
            F.col("e.bad").alias("bad"),
            F.col("e.seen").alias("seen"),
        )
        .groupBy("c", "k")
        .agg(F.max("bad").alias("bad"), F.max("seen").alias("seen"))
    )
    keys: dict[str, set[str]] = {c: set() for c in columns}
    bad: dict[str, bool] = {c: False for c in columns}
    seen: dict[str, bool] = {c: False for c in columns}
    # per column: at most one row without a key, plus the keys
    cap = None if max_keys is None else max_keys + len(columns) + 1
    rows = (pairs.limit(cap) if cap is not None else pairs).collect()
    if cap is not None and sum(r["k"] is not None for r in rows) > max_keys:
        raise ValueError(f"more than {max_keys} distinct JSON keys; pass keys= explicitly")
    for r in rows:
        if r["k"] is not None:
            keys[r["c"]].add(r["k"])
        bad[r["c"]] = bad[r["c"]] or bool(r["bad"])
        seen[r["c"]] = seen[r["c"]] or bool(r["seen"])
    return {c: sorted(ks) for c, ks in keys.items()}, bad, seen


def flatten_columns(
    df: DataFrame,
    columns: Sequence[str] | Sequence[Mapping] | None = None,
    keys: Mapping[str, Sequence[str]] | None = None,
    uppercase: bool = True,
    on_invalid: str = "keep",
    max_columns: int | None = None,
) -> DataFrame:
    """One column per JSON key, named ``COLUMN__KEY``; flattened columns removed.

    ``columns``: names (or ``{"name": ...}`` objects); ``None`` discovers them.
    ``keys``: explicit key lists per column, which skips key discovery; with
    ``on_invalid="keep"`` one aggregation still looks for values that are no objects.
    ``on_invalid``: "keep" leaves a column with non-object values unchanged;
    "null" flattens it anyway (those rows give NULLs).
    ``max_columns``: more new columns than this are an error (default: ``MAX_KEYS``
    discovered keys; keys given are not limited). A string column that is no JSON may
    hold values that are objects: their keys count too while columns are discovered.
    New columns come first, then the remaining columns in their order.
    """
    if on_invalid not in ("keep", "null"):
        raise ValueError("on_invalid must be 'keep' or 'null'")
    max_keys = MAX_KEYS if max_columns is None else max_columns
    discovered = None
    if columns is None:
        # one scan finds the columns and their keys
        columns = _string_columns(df)
        discovered = discover_keys(df, columns, max_keys=max(max_keys, MAX_KEYS))
        columns = [c for c in columns if discovered[2][c] and not discovered[1][c]]
        if not columns:
            raise ValueError("no column holds JSON objects")
    names = [c["name"] if isinstance(c, Mapping) else c for c in columns]
    by_lower = {c.lower(): c for c in df.columns}
    missing = [c for c in names if c.lower() not in by_lower]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    names = [by_lower[c.lower()] for c in names]

    if keys is None:
        found, bad, seen = discovered or discover_keys(df, names, max_keys=max_keys)
    else:
        found = {c: list(keys.get(c, [])) for c in names}
        bad = {c: False for c in names}
        seen = {c: True for c in names}
        if discovered is None and on_invalid == "keep":
            objects = set(discover_json_columns(df, names))
            bad = {c: c not in objects for c in names}

    # kept unchanged: columns with non-objects (on_invalid="keep") and all-NULL ones
    keep = {c for c in names if (bad[c] and on_invalid == "keep") or not seen[c]}
    for c in sorted(keep):
        log.warning("column %s holds values that are not JSON objects; kept as is", c)
    flat = [c for c in names if c not in keep]
    total = sum(len(found[c]) for c in flat)
    if max_columns is not None and total > max_columns:
        raise ValueError(f"flatten would add {total} columns (max_columns={max_columns})")

    # Parse each column once into a map, then index it per key.
    parsed = {c: f"__cairn_map_{i}" for i, c in enumerate(flat)}
    staged = df.withColumns(
        {parsed[c]: F.from_json(F.col(quote(c)), MAP_TYPE) for c in flat}
    ) if flat else df

    new_exprs, new_names = [], []
    for c in flat:
        for k in found[c]:
            name = f"{normalize_name(c)}__{normalize_name(k)}"
            new_names.append(name.upper() if uppercase else name)
            new_exprs.append(F.col(parsed[c]).getItem(k))
    rest = [c for c in df.columns if c not in set(flat)]
    all_names = dedupe_names(new_names + rest)
    out = [e.alias(n) for e, n in zip(new_exprs, all_names)]
    out += [F.col(quote(c)).alias(n) for c, n in zip(rest, all_names[len(new_names):])]
    return staged.select(*out)
