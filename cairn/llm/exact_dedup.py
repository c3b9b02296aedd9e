"""Exact duplicates by counting quotient filters and byte verification.

A text's fingerprint is the XXH64 of its normalised form (each run of white space
is one space). Every partition builds a counting quotient filter of its
fingerprints: the high bits (quotient) say which run a fingerprint belongs to, the
low bits (remainder) are stored sorted inside the run, each with its count. A
quotient and a remainder give the whole fingerprint back, so filters merge without
loss by merging their sorted remainders and adding the counts. Filters are cut into
blocks of quotients; a block is merged in one task whose size depends on the number
of distinct fingerprints in it alone, copies are already summed.

Texts whose fingerprint was counted once are unique. The others go on to byte
verification: they are grouped by the normalised text itself, so a collision of
fingerprints can't drop a text. (Rows are tied to their group by fingerprint and
SHA-256, the digest that is part of the result.)
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITESPACE, fresh, named, pick, store

REMAINDER_BITS = 40


def normalised(text: Column) -> Column:
    """Each run of white space as one space; NULL is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITESPACE, " ")


def encode_filter(fps: np.ndarray, counts: np.ndarray) -> bytes:
    """A counting quotient filter of sorted distinct uint64 fingerprints: the quotients
    in use, the length of each one's run, all remainders in order, a bit for those
    counted more than once, and their counts."""
    quotients, lengths = np.unique(fps >> np.uint64(REMAINDER_BITS), return_counts=True)
    remainders = fps & np.uint64((1 << REMAINDER_BITS) - 1)
    many = counts > 1
    return b"".join(
        [
            np.array([len(quotients), len(fps)], "<u8").tobytes(),
            quotients.astype("<u4").tobytes(),
            lengths.astype("<u4").tobytes(),
            remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : REMAINDER_BITS // 8].tobytes(),
            np.packbits(many).tobytes(),
            counts[many].astype("<u8").tobytes(),
        ]
    )


def decode_filter(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints, sorted, and their counts."""
    runs, n = (int(x) for x in np.frombuffer(blob, "<u8", 2))
    at = 16
    quotients = np.frombuffer(blob, "<u4", runs, at).astype(np.uint64)
    lengths = np.frombuffer(blob, "<u4", runs, at := at + 4 * runs)
    width = REMAINDER_BITS // 8
    low = np.zeros((n, 8), np.uint8)
    low[:, :width] = np.frombuffer(blob, np.uint8, n * width, at := at + 4 * runs).reshape(n, width)
    marks = (n + 7) // 8
    many = np.unpackbits(np.frombuffer(blob, np.uint8, marks, at := at + n * width), count=n).astype(bool)
    counts = np.ones(n, np.uint64)
    counts[many] = np.frombuffer(blob, "<u8", int(many.sum()), at + marks)
    fps = (np.repeat(quotients, lengths) << np.uint64(REMAINDER_BITS)) | low.view("<u8")[:, 0]
    return fps, counts


def merge_filters(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One filter's content from many: sorted runs merge, equal remainders add up."""
    parts = [decode_filter(x) for x in blobs]
    fps = np.concatenate([x for x, _ in parts])
    counts = np.concatenate([x for _, x in parts])
    order = np.argsort(fps, kind="stable")  # merges the runs that are sorted already
    fps, counts = fps[order], counts[order]
    first = np.flatnonzero(np.r_[True, fps[1:] != fps[:-1]]) if len(fps) else np.zeros(0, int)
    return fps[first], np.add.reduceat(counts, first) if len(fps) else counts


def repeated_fingerprints(fps: DataFrame, rows: int, block_rows: int = 65_536) -> DataFrame:
    """(fp, n) for every fingerprint (column fp, signed long) that occurs n > 1 times.
    ``rows``, about how many there are, sets the number of blocks."""
    bits = max(0, (max(1, rows) // block_rows).bit_length())

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            found.append(np.unique(np.asarray(batch["fp"]).view(np.uint64), return_counts=True))
        if not found:
            return
        fps = np.concatenate([x for x, _ in found])
        counts = np.concatenate([x for _, x in found])
        fps, at = np.unique(fps, return_inverse=True)
        counts = np.bincount(at, weights=counts).astype(np.uint64)
        blocks = fps >> np.uint64(64 - bits) if bits else np.zeros(len(fps), np.uint64)
        ids, starts = np.unique(blocks, return_index=True)
        for i, a, b in zip(ids, starts, [*starts[1:], len(fps)]):
            yield pa.RecordBatch.from_arrays([pa.array([int(i)], pa.int64()), pa.array([encode_filter(fps[a:b], counts[a:b])], pa.binary())], ["block", "filter"])

    def merge(table: pa.Table) -> pa.Table:
        fps, counts = merge_filters(table["filter"].to_pylist())
        many = counts > 1
        return pa.table({"fp": fps[many].view(np.int64), "n": counts[many].astype(np.int64)})

    filters = fps.select("fp").mapInArrow(build, "block bigint, filter binary")
    return filters.groupBy("block").applyInArrow(merge, "fp bigint, n bigint")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_rows: int = 65_536) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    Texts are equal when identical after each run of white space became one space;
    NULL counts as empty, and all empty texts are one group. Of a group the row with
    the smallest doc_id stays; of rows with that same doc_id exactly one. A NULL
    doc_id counts as larger than any. No documents, no rows.
    """
    texts = pick(docs, doc_id=id_col, text=text_col).select("doc_id", normalised(F.col("text")).alias("text"))
    marked = texts.select("doc_id", "text", F.xxhash64("text").alias("fp"))
    rows = store(
        marked.select(F.monotonically_increasing_id().alias("row"), "doc_id", "fp", F.sha2(F.col("text").cast("binary"), 256).alias("sha")),
        "exact-rows",
    )
    repeated = store(repeated_fingerprints(rows, rows.count(), block_rows), "repeated-fingerprints").select("fp")
    # Byte verification: grouped by the text itself, copies summed before the shuffle.
    equal = marked.join(repeated, "fp", "left_semi").groupBy("fp", "text").agg(F.min("doc_id").alias("keep"), F.count("*").alias("size"))
    groups = store(equal.select("fp", F.sha2(F.col("text").cast("binary"), 256).alias("sha"), "keep", "size"), "exact-groups")
    # Of the rows that have a group's smallest doc_id, one stays.
    tied = rows.join(groups, ["fp", "sha"]).where(F.col("doc_id").eqNullSafe(F.col("keep")))
    stays = tied.groupBy("fp", "sha").agg(F.min("row").alias("stay"))
    groups = store(groups.join(stays, ["fp", "sha"]), "exact-kept")
    joined = rows.join(groups, ["fp", "sha"], "left")
    return joined.select(
        "doc_id",
        F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("size").isNull() | (F.col("row") == F.col("stay"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, one of each group of equal texts: that of the
    smallest doc_id (of rows that have it, one; a NULL doc_id is larger than any)."""
    sha, keep = fresh(docs, "sha"), fresh(docs, "keep")
    found = exact_duplicates(docs, id_col, text_col).where("group_size > 1 and kept")
    winners = found.select(F.col("text_sha256").alias(sha), F.struct("keep_id").alias(keep))
    whole = docs.withColumn(sha, F.sha2(normalised(named(text_col)).cast("binary"), 256)).join(winners, sha, "left")
    stays = named(keep).isNull() | named(id_col).eqNullSafe(named(keep)["keep_id"])
    # What is left of a group are rows of one doc_id: no hot key.
    return whole.where(stays).dropDuplicates([sha]).select(*map(named, docs.columns))
