"""Merge (upsert) of a source into a target on key pairs.

Semantics: keys compare with ``=`` so NULL keys never match (such source rows are
inserted); a matched target row takes every column the source also has (source
NULLs overwrite), keeps its target-only columns; unmatched source rows are all
inserted (target-only columns NULL); columns only in the source are an error.
Several source rows on one target key: the greatest by ``order_by`` wins
(default: the whole source row), so reruns give the same table.

Plan: the update side de-duplicates the source with ``max_by`` (partial
aggregation, skew-safe). No job runs to choose a join: Spark measures each shuffled
side in bytes and broadcasts one below ``spark.sql.autoBroadcastJoinThreshold``; else
both joins are shuffle joins on the keys and AQE splits skewed keys. Source rows with a
NULL key take part in no join.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.names import quote
from .latest import comparable_row


def align_to_schema(df: DataFrame, schema: StructType, strict: bool = True) -> DataFrame:
    """Select the target schema's columns, cast to its types.

    Columns absent from ``df`` become typed NULLs unless ``strict``."""
    have = {c.lower(): c for c in df.columns}
    out = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        if src is None:
            if strict:
                raise ValueError(f"column {f.name!r} missing from source")
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            out.append(F.col(quote(src)).cast(f.dataType).alias(f.name))
    return df.select(*out)


def to_dataframe(spark: SparkSession, source, schema: StructType | None = None) -> DataFrame:
    """Accept a DataFrame, pandas frame, list of dicts, table name or file path."""
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, str):
        low = source.lower()
        for ext, fmt in ((".parquet", "parquet"), (".json", "json"), (".csv", "csv")):
            if low.endswith(ext):
                from ..sources.files import read_file

                return read_file(spark, source, fmt)
        return spark.table(source)
    try:
        import pandas as pd

        if isinstance(source, pd.DataFrame):
            return spark.createDataFrame(source, schema=schema)
    except ImportError:  # pragma: no cover
        pass
    if isinstance(source, list):
        return spark.createDataFrame(source, schema=schema)
    raise TypeError("source must be a DataFrame, pandas frame, list of dicts, table name or file path")


def borrow_types(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns that ``schema`` also has, cast to its types; the others as they are."""
    types = {f.name.lower(): f.dataType for f in schema.fields}
    return df.select(
        *[F.col(quote(c)).cast(types[c.lower()]).alias(c) if c.lower() in types else F.col(quote(c)) for c in df.columns]
    )


def merge_upsert(
    target: DataFrame,
    source,
    source_on: Sequence[str],
    target_on: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """The target's new contents after the merge, in the target's schema.

    ``source``: a DataFrame, or anything ``to_dataframe`` takes (rows, a pandas frame, a
    table name, a file), which borrows the types of the target's columns."""
    if not isinstance(source, DataFrame):
        source = borrow_types(to_dataframe(target.sparkSession, source), target.schema)
    target_on = list(target_on or source_on)
    source_on = list(source_on)
    if not source_on or len(source_on) != len(target_on):
        raise ValueError("source_on and target_on must be non-empty and of equal length")
    t_cols = target.columns
    t_lower = {c.lower(): c for c in t_cols}
    extra = [c for c in source.columns if c.lower() not in t_lower]
    if extra:
        raise ValueError(f"source columns not in target: {extra}")
    s_cols = source.columns
    tschema = {f.name: f.dataType for f in target.schema.fields}

    # source rows that can match: keys all non-null; one winner per key
    s_key_alias = [f"__sk{i}" for i in range(len(source_on))]
    row = F.struct(*[F.col(quote(c)) for c in s_cols])
    order = F.struct(*[F.col(quote(c)) for c in (order_by or [])], comparable_row(source).alias("__row"))
    has_key = reduce(lambda a, b: a & b, [F.col(quote(k)).isNotNull() for k in source_on])
    keyed = source.filter(has_key)
    winners = (
        keyed.groupBy(*[F.col(quote(k)).alias(a) for k, a in zip(source_on, s_key_alias)])
        .agg(F.max_by(row, order).alias("__w"))
        .select(*s_key_alias, *[F.col("__w").getField(c).alias(f"__s_{c}") for c in s_cols])
        .withColumn("__matched", F.lit(True))
    )

    # 1) every target row, updated where a winner matches
    cond = reduce(
        lambda a, b: a & b,
        [target[quote(t)] == winners[a] for t, a in zip(target_on, s_key_alias)],
    )
    joined = target.join(winners, cond, "left")
    s_by_lower = {c.lower(): c for c in s_cols}
    updated = joined.select(
        *[
            F.when(F.col("__matched"), F.col(quote(f"__s_{s_by_lower[c.lower()]}")).cast(tschema[c]))
            .otherwise(target[quote(c)])
            .alias(c)
            if c.lower() in s_by_lower
            else target[quote(c)].alias(c)
            for c in t_cols
        ]
    )

    # 2) source rows whose key matches no target row: all inserted
    t_keys = target.select(*[F.col(quote(t)).alias(a) for t, a in zip(target_on, s_key_alias)])
    inserts_src = keyed.join(
        t_keys,
        reduce(lambda a, b: a & b, [keyed[quote(k)] == t_keys[a] for k, a in zip(source_on, s_key_alias)]),
        "left_anti",
    ).unionByName(source.filter(~has_key))
    inserts = inserts_src.select(
        *[
            F.col(quote(s_by_lower[c.lower()])).cast(tschema[c]).alias(c)
            if c.lower() in s_by_lower
            else F.lit(None).cast(tschema[c]).alias(c)
            for c in t_cols
        ]
    )
    return updated.unionByName(inserts)


def merge_one_per_key(
    target: DataFrame,
    source,
    source_on: Sequence[str],
    target_on: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """``merge_upsert`` where a key of several source rows gives one row, also where it is
    inserted: one full outer join, so the target is read once. Of a target bucketed by
    the key nothing is shuffled. Source rows with a NULL key are all inserted."""
    if not isinstance(source, DataFrame):
        source = borrow_types(to_dataframe(target.sparkSession, source), target.schema)
    source_on, target_on = list(source_on), list(target_on or source_on)
    if not source_on or len(source_on) != len(target_on):
        raise ValueError("source_on and target_on must be non-empty and of equal length")
    by_lower = {c.lower(): c for c in source.columns}
    extra = sorted(set(by_lower) - {c.lower() for c in target.columns})
    if extra:
        raise ValueError(f"source columns not in target: {extra}")
    has_key = reduce(lambda a, b: a & b, [F.col(quote(k)).isNotNull() for k in source_on])
    keys = [F.col(quote(k)).alias(f"__sk{i}") for i, k in enumerate(source_on)]
    row = F.struct(*[F.col(quote(c)) for c in source.columns])
    order = F.struct(*[F.col(quote(c)) for c in (order_by or [])], comparable_row(source).alias("__row"))
    winners = source.filter(has_key).groupBy(*keys).agg(F.max_by(row, order).alias("__w"))
    others = source.filter(~has_key).select(*keys, row.alias("__w"))
    right = winners.unionByName(others) if any(source.schema[k].nullable for k in source_on) else winners
    same = reduce(lambda a, b: a & b, [target[quote(t)] == right[f"__sk{i}"] for i, t in enumerate(target_on)])
    joined = target.join(right.withColumn("__s", F.lit(True)), same, "full")
    return joined.select(
        *[
            F.when(F.col("__s"), F.col("__w").getField(by_lower[f.name.lower()]).cast(f.dataType)).otherwise(target[quote(f.name)]).alias(f.name)
            if f.name.lower() in by_lower
            else target[quote(f.name)].alias(f.name)
            for f in target.schema.fields
        ]
    )


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, location: str | None = None) -> None:
    """A catalog table bucketed and sorted by ``keys``: one file a bucket, so joins and
    merges on them neither shuffle nor sort it. Choose ``buckets`` so that one is a few
    hundred megabytes. ``location``: a folder for an external table."""
    writer = df.repartition(buckets, *[F.col(quote(k)) for k in keys]).write
    writer = writer.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite")
    (writer.option("path", location) if location else writer).saveAsTable(name)


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def bucketing(spark: SparkSession, name: str) -> tuple[int, list[str]] | None:
    """Number of buckets and bucket columns of a catalog table, None if it has none."""
    about = _described(spark, name)
    if "Num Buckets" not in about:
        return None
    return int(about["Num Buckets"]), [c.strip(" `") for c in about["Bucket Columns"].strip("[]").split(",")]


def merge_into(spark: SparkSession, name: str, source, keys: Sequence[str], order_by: Sequence[str] | None = None) -> None:
    """Merge into a bucketed catalog table in place (``merge_one_per_key``): the new contents
    are written to a staging table of the same buckets, which then takes the name; that of
    an external table lies beside the old folder. The join leaves each bucket's rows in
    one task, so a bucket is again one file."""
    from ..session import delete_folder
    from ..sinks.writers import swap_table

    spec = bucketing(spark, name)
    if spec is None or {c.lower() for c in spec[1]} != {k.lower() for k in keys}:
        raise ValueError(f"{name} is not bucketed by {list(keys)}")
    about, tag = _described(spark, name), uuid.uuid4().hex[:8]
    # in the order of the buckets' columns, so that the exchange of the source is the table's
    on = sorted(keys, key=lambda k: [c.lower() for c in spec[1]].index(k.lower()))
    merged = merge_one_per_key(spark.table(name), source, on, None, order_by)
    writer = merged.write.bucketBy(spec[0], *spec[1]).sortBy(*spec[1])
    external = about.get("Type") == "EXTERNAL"
    if external:
        old = about["Location"].rstrip("/")
        writer = writer.option("path", f"{old.split('__merged_')[0]}__merged_{tag}")
    writer.saveAsTable(f"{name}__staging_{tag}")
    swap_table(spark, f"{name}__staging_{tag}", name)
    if external:  # dropping such a table leaves its files
        delete_folder(spark, old)
