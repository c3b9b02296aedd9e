"""Top-1 per key and per-key statistics, both skew-safe.

``ROW_NUMBER() OVER (PARTITION BY k ORDER BY d DESC) = 1`` sends every row of a key
to one task, and any aggregate that carries whole rows sorts them. Here whole rows are
fetched late: a narrow scan of the key and order columns finds each key's greatest order
(a hash aggregate with partial results, so a hot key costs one row per partition), that
table is stored, and a second scan keeps the rows that are in it. The table is
broadcast when it is small; else a bitmap of hashes, one bit in sixteen set, is, and
only the few rows that pass it are shuffled to the join.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import quote
from ..functions.ordering import packed_order_or_least
from ..session import materialize


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(quote(c)) if isinstance(c, str) else c for c in names]


def comparable_row(df: DataFrame) -> Column:
    """The whole row as a struct that can be ordered: a column that holds a map anywhere,
    which Spark cannot order, takes part as its JSON text."""
    return F.struct(
        *[
            F.to_json(F.struct(F.col(quote(f.name)).alias("v"))).alias(f"c{i}")
            if "map<" in f.dataType.simpleString()
            else F.col(quote(f.name)).alias(f"c{i}")
            for i, f in enumerate(df.schema.fields)
        ]
    )


_BITMAP_BITS = 32_768  # of one bitmap, fixed by ``bitmap_construct_agg``


_FIXED = ("tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz", "boolean", "decimal")


def _order_columns(df: DataFrame, order_by: Sequence[str | Column]) -> list[Column]:
    """The order as one value of fixed size, which a hash aggregate can keep, or (more
    than a date and a whole number, texts) as its columns."""
    if not order_by:
        return [_row_hash(df)]
    types = dict(df.dtypes)
    names = [c for c in order_by if isinstance(c, str) and c in types]
    if len(names) == len(order_by) == 1 and types[names[0]].startswith(_FIXED):
        return _cols(names)
    if len(names) == len(order_by) == 2:
        packed = packed_order_or_least(names[0], types[names[0]], names[1], types[names[1]])
        if packed is not None:
            return [packed]
    return _cols(order_by)


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(comparable_row(df))


def _passes(rows: DataFrame, best: DataFrame, n: int, on: list[str]) -> DataFrame:
    """Those of ``rows`` whose values of ``on`` may be in ``best``: one bit per hash, at
    least sixteen bits for each of the ``n`` rows of ``best``."""
    buckets = 1
    while buckets * _BITMAP_BITS < 16 * n:
        buckets *= 2
    place = F.pmod(F.xxhash64(*on), F.lit(buckets * _BITMAP_BITS))
    bits = best.select((place / _BITMAP_BITS).cast("int").alias("__bucket"), (place % _BITMAP_BITS).alias("__bit"))
    maps = bits.groupBy("__bucket").agg(F.bitmap_construct_agg("__bit").alias("__map"))
    # ``buckets`` maps of 4 KB at most; the caller has checked their size
    found = rows.withColumn("__at", place).withColumn("__bucket", (F.col("__at") / _BITMAP_BITS).cast("int")).join(F.broadcast(maps), "__bucket")
    byte = F.substring("__map", ((F.col("__at") % _BITMAP_BITS) / 8).cast("int") + 1, 1)
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return found.filter(F.getbit(value, (F.col("__at") % 8).cast("int")) == 1).drop("__bucket", "__map", "__at")


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    keep_null_keys: bool = True,
    broadcast_rows: int = 500_000,
    filter_bytes: int = 64 << 20,
) -> DataFrame:
    """One row per key: the greatest by ``order_by`` (descending), ties broken by a hash of
    the whole row, so the pick is deterministic (W2, W4, T1).

    The keys' greatest orders are stored at once (one job); up to ``broadcast_rows``
    of them are broadcast, and a bitmap of up to ``filter_bytes`` filters the rows before
    the join for more. ``df`` is read twice and must give the same rows both times."""
    cols = df.columns
    if not keys:
        raise ValueError("latest_per_key needs at least one key")
    src = df if keep_null_keys else df.dropna(subset=list(keys))
    own = [f"__k{i}" for i in range(len(keys))]
    order = {f"__o{i}": c for i, c in enumerate(_order_columns(df, order_by))}
    tagged = src.withColumns({k: F.col(quote(c)) for k, c in zip(own, keys)} | order)
    narrow = tagged.select(*own, *order).groupBy(*own)
    if len(order) == 1:
        best = narrow.agg(F.max("__o0").alias("__o0"))
    else:
        best = narrow.agg(F.max(F.struct(*order)).alias("__m")).select(*own, *[F.col("__m")[c].alias(c) for c in order])
    stored = materialize(best, "latest")
    on, n = [*own, *order], stored.count()
    other = stored.select(*[F.col(c).alias(f"{c}_") for c in on])
    same = functools.reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in on])
    if n <= broadcast_rows:
        found = tagged.join(F.broadcast(other), same, "left_semi")
    else:
        if 4 * n <= filter_bytes:  # sixteen bits a row, doubled at most by rounding up
            tagged = _passes(tagged, stored, n, on)
        found = tagged.join(other, same, "left_semi")
    # rows that tie: the limit to one is applied by every task before the shuffle
    one = Window.partitionBy(*own).orderBy(F.desc("__h"))
    ranked = found.withColumn("__h", _row_hash(df)).withColumn("__rn", F.row_number().over(one))
    return ranked.filter("__rn = 1").select(*map(quote, cols))


def attach_key_stats(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    prefix: str = "",
) -> DataFrame:
    """Every row plus SUM / AVG / STDDEV_POP of ``value`` over its key.

    Aggregate (partial before the shuffle), then join the per-key row back; AQE
    splits a skewed key on the big side of that join."""
    stats = df.groupBy(*[F.col(quote(k)) for k in keys]).agg(
        F.sum(quote(value)).alias(f"{prefix}sum"),
        (F.sum(quote(value)).cast("double") / F.count(quote(value))).alias(f"{prefix}avg"),
        F.stddev_pop(F.col(quote(value)).cast("double")).alias(f"{prefix}stddev_pop"),
        F.count(F.lit(1)).alias(f"{prefix}rows"),
    )
    # NULL keys are a group like any other, so the join back is null-safe.
    own = [f"__cairn_key_{i}" for i in range(len(keys))]
    renamed = stats.withColumnsRenamed(dict(zip(keys, own)))
    same = [F.col(quote(k)).eqNullSafe(F.col(o)) for k, o in zip(keys, own)]
    joined = df.join(renamed, on=functools.reduce(Column.__and__, same), how="left")
    first = list(keys)
    return joined.select(*map(quote, first + [c for c in df.columns if c not in first]), *[c for c in stats.columns if c not in keys])


def key_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per-key SUM / AVG / STDDEV_POP / COUNT of ``value`` (A6 as a plain aggregate)."""
    v = F.col(quote(value))
    return df.groupBy(*[F.col(quote(k)) for k in keys]).agg(
        F.sum(v).alias("total"),
        (F.sum(v).cast("double") / F.count(v)).alias("mean"),
        F.stddev_pop(v.cast("double")).alias("std"),
        F.count(F.lit(1)).alias("rows"),
    )
