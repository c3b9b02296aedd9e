"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

WHITESPACE = "[\\x20\\x09-\\x0D]+"


def named(name: str) -> Column:
    """The column with exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``pick(df, doc_id="id", text="body")``: only these columns, renamed."""
    return df.select(*[named(source).alias(name) for name, source in columns.items()])


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fold(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo ``n`` (a NULL key counts as empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def evidence(a: Column, b: Column, of_a: int, of_b: int) -> Column:
    """The likelihood-ratio statistic of a form found in ``a`` of ``of_a`` documents of
    one kind and ``b`` of ``of_b`` of the other, against equal rates."""
    share = of_a / (of_a + of_b)
    n = a + b
    return 2 * (F.when(a > 0, a * F.log(a / (n * share))).otherwise(0.0) + F.when(b > 0, b * F.log(b / (n * (1 - share)))).otherwise(0.0))


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: lineage
    ends there, so a lost executor costs only the tasks that were running."""
    return materialize(df, f"llm-{name}")


def batches(rows: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``most`` rows."""
    for batch in rows:
        for start in range(0, batch.num_rows, most):
            yield batch.slice(start, most)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of a string column as UTF-8 bytes; NULL is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    """The texts of a string column; NULL is empty."""
    return [x or "" for x in column.to_pylist()]


def numbered(df: DataFrame, part: Column, order: Column, blocks: int) -> DataFrame:
    """Adds ``number``: a gapless long from 0 within each value of ``part``.

    ``order`` must be unique. Rows are numbered inside hash blocks and shifted by
    the sizes of the blocks before, so no task holds more than one block of one
    part and only the block sizes (one row a block) are summed in order. ``df``
    should be stored: it is read twice.
    """
    from pyspark.sql import Window

    keyed = df.withColumns({"_part": part, "_block": F.pmod(F.xxhash64(order), F.lit(blocks)), "_order": order})
    sizes = keyed.groupBy("_part", "_block").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.partitionBy("_part").orderBy("_block")) - F.col("_size")
    starts = sizes.select(F.col("_part").alias("_p"), F.col("_block").alias("_b"), before.alias("_start"))
    local = F.row_number().over(Window.partitionBy("_part", "_block").orderBy("_order")) - 1
    return (
        keyed.withColumn("_local", local)
        .join(starts, (F.col("_part").eqNullSafe(F.col("_p"))) & (F.col("_block") == F.col("_b")))
        .withColumn("number", (F.col("_start") + F.col("_local")).cast("long"))
        .drop("_part", "_block", "_order", "_local", "_p", "_b", "_start")
    )


def block_count(rows: int, most: int = 20_000) -> int:
    """Blocks so that one holds about ``most`` rows, however many rows there are."""
    return max(1, -(-rows // most))
