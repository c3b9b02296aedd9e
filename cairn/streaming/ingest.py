"""Incremental landing as a Structured Streaming job (§2.10).

``readStream`` over the landed-pages folder replaces the hand-kept watermark file:
the stream checkpoint records which files were consumed, and ``trigger(availableNow)``
processes what is there and stops.

The target is a log of row versions: every micro-batch *appends* its new and changed rows
under the date of their event time and replaces no file, so a batch costs what its own
rows cost, however large the table is. Rows that come again (the inclusive ``>=``
re-read, a replayed batch, a new checkpoint) are found among the versions of their own
dates, by key and row hash, and are not appended: the state that the stream needs is the
table itself, so losing a checkpoint loses nothing. ``read_current`` gives the latest
version of every key, ``compact`` rewrites a few dates at a time to the versions that
can still be read. A catalog whose tables have row-level MERGE does without the log.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, LongType, StructField, StructType

from ..functions.names import quote
from ..operators.latest import comparable_row, latest_per_key
from ..session import materialize, path_exists, release

DATE, ROW, SOLO, VERSION = "cairn_date", "cairn_row", "cairn_solo", "cairn_version"
_OWN = [StructField(ROW, LongType()), StructField(SOLO, LongType()), StructField(VERSION, LongType()), StructField(DATE, DateType())]
_NO_DATE = "__HIVE_DEFAULT_PARTITION__"
_TABLE = "_table"  # a folder that Spark's readers skip: keys and schema


def _known(spark: SparkSession, target: str) -> dict | None:
    """Keys and schema of the table, or None before the first batch."""
    # a missing table is looked for, not found out by an error
    if not path_exists(spark, f"{target}/{_TABLE}"):
        return None
    return json.loads(spark.read.text(f"{target}/{_TABLE}").first()[0])


def _log(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """All versions of all rows."""
    return spark.read.schema(StructType([*schema.fields, *_OWN])).parquet(target)


def _of(known: dict, schema: StructType | None = None) -> StructType:
    return schema or StructType.fromJson(known["schema"])


def _same(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(Column.__and__, [a[quote(c)].eqNullSafe(b[quote(c)]) for c in columns])


def read_current(spark: SparkSession, target: str, schema: StructType | None = None) -> DataFrame | None:
    """The latest version of every key (None before the first batch). Rows with a NULL
    key match nothing, so each distinct one is there once."""
    target = target.rstrip("/")
    known = _known(spark, target)
    if known is None:
        return None
    log = _log(spark, target, _of(known, schema))
    return latest_per_key(log, [*known["keys"], SOLO], [VERSION]).drop(ROW, SOLO, VERSION, DATE)


def upsert_batch(
    batch: DataFrame,
    target: str,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    event_time: str | None = None,
    version: int | None = None,
) -> None:
    """Append one micro-batch's new and changed rows to ``target``.

    Of records with one key in a batch the greatest by ``order_by`` (then by a hash of the
    whole row) stays; a later batch's record replaces an earlier one's. Rows with a NULL
    key match nothing; equal ones are kept once. A row that is its key's latest version
    among those of its date is not news and is left out. ``event_time`` names the column
    whose date the log is partitioned by (NULL and unknown dates have a folder of their
    own); without it all rows go to that one folder, and every batch reads the key
    columns of all of them. ``version`` (default: the clock in microseconds) must rise
    from batch to batch. An empty batch writes nothing."""
    spark = batch.sparkSession
    target = target.rstrip("/")
    taken = {DATE, ROW, SOLO, VERSION} & set(batch.columns)
    if taken:
        raise ValueError(f"records hold columns named {sorted(taken)}")
    any_null = reduce(Column.__or__, [F.col(quote(k)).isNull() for k in keys])
    date = F.to_date(F.col(quote(event_time))) if event_time else F.lit(None).cast("date")
    tagged = batch.withColumn(ROW, F.xxhash64(comparable_row(batch)))
    tagged = tagged.withColumns({SOLO: F.when(any_null, F.col(ROW)), DATE: date})
    stored = materialize(tagged, "batch")
    identity = [*keys, SOLO]
    try:
        fresh = materialize(latest_per_key(stored, identity, list(order_by or []) or [ROW]), "batch-latest")
        dates = [r[0] for r in fresh.select(DATE).distinct().collect()]  # a batch's dates
        if not dates:
            return
        changed = fresh
        if _known(spark, target) is None:
            about = json.dumps({"keys": list(keys), "schema": batch.schema.jsonValue()})
            spark.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(f"{target}/{_TABLE}")
        else:
            log = _log(spark, target, batch.schema)
            in_dates = F.col(DATE).isin([d for d in dates if d is not None])
            if None in dates:
                in_dates = in_dates | F.col(DATE).isNull()
            known = log.filter(in_dates).select(*map(quote, identity), ROW, VERSION, DATE)
            known = known.join(fresh.select(*map(quote, identity), DATE), _same(known, fresh, [*identity, DATE]), "left_semi")
            known = known.groupBy(*map(quote, identity), DATE).agg(F.max_by(ROW, VERSION).alias(ROW))
            changed = fresh.join(known, _same(fresh, known, [*identity, DATE, ROW]), "left_anti")
        version = time.time_ns() // 1000 if version is None else version
        (
            changed.select(*map(quote, batch.columns), ROW, SOLO, F.lit(version).cast("bigint").alias(VERSION), DATE)
            .hint("rebalance", DATE)  # few files a date, large ones split
            .write.mode("append")
            .partitionBy(DATE)
            .parquet(target)
        )
        release(fresh)
    finally:
        release(stored)


def files_by_date(log: DataFrame) -> Counter:
    """How many files the log has for each date (its folder's name)."""
    return Counter(part.split("=", 1)[1] for f in log.inputFiles() for part in f.split("/") if part.startswith(f"{DATE}="))


def compact(
    spark: SparkSession,
    target: str,
    most_files: int = 8,
    schema: StructType | None = None,
    dates_at_once: int = 8,
) -> list[str]:
    """Rewrite the dates that have more than ``most_files`` files, ``dates_at_once`` at a
    time, keeping of each key the latest version within the date; returns the dates.

    What ``read_current`` gives stays the same. The new files of these dates are complete
    in scratch storage before their folders are replaced; no reader should run meanwhile."""
    target = target.rstrip("/")
    known = _known(spark, target)
    if known is None:
        return []
    keys, schema = known["keys"], _of(known, schema)
    log = _log(spark, target, schema)
    crowded = sorted(d for d, n in files_by_date(log).items() if n > most_files)
    for first in range(0, len(crowded), dates_at_once):
        some = crowded[first:first + dates_at_once]
        wanted = F.col(DATE).isin([dt.date.fromisoformat(d) for d in some if d != _NO_DATE])
        if _NO_DATE in some:
            wanted = wanted | F.col(DATE).isNull()
        staged = materialize(latest_per_key(log.filter(wanted), [*keys, SOLO, DATE], [VERSION]), "compacted")
        try:
            (
                staged.hint("rebalance", DATE)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(DATE)
                .parquet(target)
            )
        finally:
            release(staged)
        log = _log(spark, target, schema)  # list the files anew
    return crowded


def ingest_stream(
    spark: SparkSession,
    landing: str,
    item_schema: StructType,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    items: str = "data",
    order_by: Sequence[str] | None = None,
    max_files_per_trigger: int | None = None,
    event_time: str | None = None,
):
    """Start the landing stream (availableNow) and return the ``StreamingQuery``.

    Call ``.awaitTermination()`` to wait for the files present at start. ``keys`` and
    ``event_time`` must stay the same for one target; see ``upsert_batch``."""
    page_schema = StructType([StructField(items, ArrayType(item_schema))])
    reader = spark.readStream.schema(page_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    records = (
        reader.json(landing)
        .select(F.explode(F.col(items)).alias("__r"))
        .select("__r.*")
    )
    return (
        records.writeStream.foreachBatch(
            lambda df, epoch: upsert_batch(df, target, keys, order_by, event_time)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
