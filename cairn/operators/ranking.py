"""Global ranking without a single-partition window.

``F.ntile(k).over(Window.orderBy(...))`` has no partition key, so Spark moves every
row into one task. Here the rows are range-partitioned on the ordering instead:

1. ``repartitionByRange`` on the (total) order, sort inside each partition, and tag
   each row with its partition id and its position inside the partition;
2. store that once (``materialize``) so the counts and the final pass see the same
   placement;
3. count rows per partition (observed while storing; one small entry per
   partition reaches the driver), turn the counts into offsets, and add them to
   the local position: the global row number;
4. map the row number to a bucket with the NTILE rule: with ``q, r = divmod(N, k)``
   the first ``r`` buckets hold ``q + 1`` rows, the rest ``q``.

The order must be total (append a unique tiebreak column): then every step is
deterministic, and a heavy value of the ordering column is still spread over many
partitions because the tiebreak splits it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import materialize, release

_PID = "__cairn_pid"
_POS = "__cairn_pos"


def _as_columns(order_by: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def global_row_number(
    df: DataFrame,
    order_by: Sequence[Column | str],
    out_col: str = "row_number",
    num_partitions: int | None = None,
) -> tuple[DataFrame, int]:
    """1-based row number over the whole frame in ``order_by`` order.

    Returns the numbered frame (rows stay spread over range partitions) and the
    total row count.
    """
    order = _as_columns(order_by)
    spark = df.sparkSession
    if num_partitions is None:
        # let AQE merge small adjacent ranges (order is kept: merged partitions are
        # consecutive); the bound below covers every partition id it can produce
        bound = _max_shuffle_partitions(spark)
        repartitioned = df.repartitionByRange(*order)
    else:
        bound = num_partitions
        repartitioned = df.repartitionByRange(num_partitions, *order)
    ranged = (
        repartitioned
        .sortWithinPartitions(*order)
        .withColumn(_PID, F.spark_partition_id())
        # position inside the partition: the id's low 33 bits count rows in order
        .withColumn(
            _POS,
            F.monotonically_increasing_id()
            - F.shiftleft(F.spark_partition_id().cast("long"), 33),
        )
    )
    # rows per range partition, observed while the pass is stored (no extra job):
    # histogram_numeric is exact when it has at least as many bins as distinct
    # values, and the observer runs in the storing job's result stage, where
    # accumulator updates count once per task even when tasks are retried
    observation = Observation(f"cairn_rank_{uuid.uuid4().hex}")
    observed = ranged.observe(
        observation,
        F.histogram_numeric(F.col(_PID), F.lit(bound + 1)).alias("h"),
        F.max(_PID).alias("max_pid"),
        F.count(F.lit(1)).alias("n"),
    )
    stored = materialize(observed, "rank")
    metrics = observation.get
    counts = _exact_counts(metrics, bound + 1)
    if counts is None:  # not provably exact (or nothing observed): count
        counts = dict((r[0], r[1]) for r in stored.groupBy(_PID).count().collect())
    n_parts = max(counts) + 1 if counts else 0
    per_part = [counts.get(i, 0) for i in range(n_parts)]
    offsets = [0] + list(accumulate(per_part))[:-1]
    total = sum(per_part)
    if total == 0:
        return stored.drop(_PID, _POS).withColumn(out_col, F.lit(None).cast("long")), 0
    offset_col = F.element_at(
        F.array(*[F.lit(o).cast("long") for o in offsets]), F.col(_PID) + 1
    )
    numbered = stored.withColumn(out_col, offset_col + F.col(_POS) + 1).drop(_PID, _POS)
    _LAST_STORED[id(numbered)] = (numbered, stored)
    return numbered, total


def _max_shuffle_partitions(spark) -> int:
    """Upper bound of the partition count of a shuffle without an explicit number."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    if initial:
        n = max(n, int(initial))
    return n


def _exact_counts(metrics: dict, bins: int) -> dict[int, int] | None:
    """Per-partition counts from the observed histogram, or None when they are not
    provably exact (fewer distinct ids than bins: ids are 0..max_pid)."""
    hist, max_pid, n = metrics.get("h"), metrics.get("max_pid"), metrics.get("n")
    if not hist or max_pid is None or n is None or max_pid + 1 >= bins:
        return None
    counts = {}
    for b in hist:
        x, y = float(b["x"]), float(b["y"])
        if x != int(x) or y != int(y):
            return None
        counts[int(x)] = int(y)
    return counts if sum(counts.values()) == n else None


# id -> numbered frame (held, so its id is not reused) and the stored frame it reads
_LAST_STORED: dict[int, tuple[DataFrame, DataFrame]] = {}


def release_ranking(df: DataFrame) -> None:
    """Delete the stored pass behind a frame returned by ``distributed_ntile`` /
    ``global_row_number`` once no plan reads it any more."""
    held = _LAST_STORED.pop(id(df), None)
    if held is not None:
        release(held[1])


def ntile_of_row_number(rn: Column, total: int, buckets: int) -> Column:
    """NTILE bucket for 1-based row number ``rn`` among ``total`` rows."""
    q, r = divmod(total, buckets)
    big = r * (q + 1)  # rows held by the first r buckets (q + 1 each)
    if q == 0:
        return rn.cast("int")
    return (
        F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1)
        .otherwise(F.floor((rn - big - 1) / q) + r + 1)
        .cast("int")
    )


def distributed_ntile(
    df: DataFrame,
    buckets: int,
    order_by: Sequence[Column | str],
    out_col: str = "ntile",
    num_partitions: int | None = None,
) -> DataFrame:
    """``NTILE(buckets) OVER (ORDER BY order_by)`` with no single-partition step."""
    if buckets < 1:
        raise ValueError("buckets must be >= 1")
    rn_col = "__cairn_rn"
    numbered, total = global_row_number(df, order_by, rn_col, num_partitions)
    if total == 0:
        return numbered.withColumn(out_col, F.lit(None).cast("int")).drop(rn_col)
    out = numbered.withColumn(
        out_col, ntile_of_row_number(F.col(rn_col), total, buckets)
    ).drop(rn_col)
    _LAST_STORED[id(out)] = (out, _LAST_STORED.pop(id(numbered))[1])
    return out
