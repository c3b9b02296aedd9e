"""Near duplicates by SimHash and multi-index hashing.

A fingerprint has 64 bits: bit i is set when it is set in over half of the XXH64
hashes of the text's word shingles. For a distance of at most d the fingerprint is
cut into d // 2 + 1 segments. Two fingerprints within d bits then differ in at most
one bit in some segment, so it is enough to file every fingerprint under its own
segment values and to enumerate, per segment, the ball of radius one around them.
Of two values that differ in one bit one has that bit set; only that one probes, by
clearing it, which halves the ball. What meets under one segment value is verified
over all 64 bits.

Distinct fingerprints are searched, never documents: copies share a row. A segment
value is worked through in one pass over its sorted fingerprints that returns a
spanning forest of the links instead of all pairs. A segment value that more than
``run_limit`` fingerprints share is not compared pair by pair: its members are
grouped by the rest of the fingerprint with every choice of d bits masked out. Who
agrees under a mask differs in those bits only, so each group is a clique and a star
to its smallest member loses no connection, at a cost in proportion to the members.
(For distances over 3 there would be more masks than pairs; runs are then compared
pair by pair at any size.)
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import fresh, named, pick, store, utf8
from .graph import components

BITS = 64
SEED = 42


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The unsigned fingerprint of one UTF-8 text; A-Z count as a-z. Fewer words than
    a shingle: the whole sequence is the only shingle. No words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    digest = functools.partial(xxhash.xxh64_digest, seed=SEED)
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 100_000):  # bounds the memory of a very long text
        some = words[at : at + 100_000 + shingle - 1] if n > 1 else words
        rows = [b" ".join(some)] if n == 1 else map(b" ".join, zip(*[some[i:] for i in range(shingle)]))
        hashes = np.frombuffer(b"".join(map(digest, rows)), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp): one row per row; fp is the fingerprint as a signed long."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [_signed(fingerprint(x, shingle)) for x in utf8(batch["text"])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.int64())], ["doc_id", "fp"])

    narrow = pick(docs, doc_id=id_col, text=text_col)
    return narrow.mapInArrow(run, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, fp bigint")


def _segments(distance: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment."""
    n = distance // 2 + 1
    edges = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _value(fp, shift: int, width: int):
    part = F.shiftrightunsigned(fp, shift)
    return part if width == BITS else part.bitwiseAND(F.lit((1 << width) - 1))


def _filed(fps: DataFrame, distance: int) -> DataFrame:
    """(seg, key, probe, fp): each fingerprint under its own segment values (probe 0)
    and under those that one set bit less gives (probe 1)."""
    out = None
    for i, (shift, width) in enumerate(_segments(distance)):
        flips = F.array(*[F.lit(x) for x in [0] + [_signed(1 << b) for b in range(width)] * (distance > 0)])
        rows = fps.select("fp", _value(F.col("fp"), shift, width).alias("own"), F.explode(flips).alias("flip"))
        rows = rows.where("flip = 0 or (own & flip) <> 0").select(
            F.lit(i).alias("seg"),
            F.col("own").bitwiseXOR(F.col("flip")).alias("key"),
            (F.col("flip") != 0).cast("int").alias("probe"),
            "fp",
        )
        out = rows if out is None else out.union(rows)
    return out


def _forest(fps: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Edges that connect whatever links of at most ``distance`` bits connect."""
    rest = np.arange(len(fps))
    while len(rest) > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            i = todo.pop()
            near = np.bitwise_count(fps[rest] ^ fps[i]) <= distance
            hit, rest = rest[near], rest[~near]
            for j in hit:
                yield int(fps[i]), int(fps[j])
            todo.extend(hit)


def _runs(distance: int):
    """mapInArrow function over rows sorted by (seg, key)."""

    def links(seg, key, probe, fp) -> list[tuple[int, int]]:
        starts = np.flatnonzero(np.r_[True, (seg[1:] != seg[:-1]) | (key[1:] != key[:-1])])
        ends = np.r_[starts[1:], len(seg)]
        some = (ends - starts > 1) & (np.minimum.reduceat(probe, starts) == 0)
        found: list[tuple[int, int]] = []
        for a, b in zip(starts[some], ends[some]):
            if b - a == 2:
                if int(fp[a] ^ fp[a + 1]).bit_count() <= distance:
                    found.append((int(fp[a]), int(fp[a + 1])))
            else:
                found.extend(_forest(fp[a:b], distance))
        return found

    def out(found: list[tuple[int, int]]) -> pa.RecordBatch:
        pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in rows:
            now = [np.asarray(batch[c]) for c in ("seg", "key", "probe")] + [np.asarray(batch["fp"]).view(np.uint64)]
            if kept is not None:
                now = [np.concatenate(x) for x in zip(kept, now)]
            if not len(now[0]):
                continue
            last = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
            cut = last[-1] + 1 if len(last) else 0  # the last run may go on in the next batch
            kept = [x[cut:] for x in now]
            if cut:
                yield out(links(*[x[:cut] for x in now]))
        if kept is not None:
            yield out(links(*kept))

    return run


def _masked(filed: DataFrame, seg: int, distance: int, bits: int) -> DataFrame:
    """Edges among rows of one segment's keys that agree outside the segment and
    ``bits`` masked bits; every row is linked to the smallest filed one (probe 0)."""
    shift, width = _segments(distance)[seg]
    free = [b for b in range(BITS) if not shift <= b < shift + width]
    outside = sum(1 << b for b in free)
    masks = [_signed(outside & ~sum(1 << b for b in some)) for some in combinations(free, min(bits, len(free)))]
    rows = filed.where(F.col("seg") == seg).select("key", "probe", "fp", F.posexplode(F.array(*map(F.lit, masks))).alias("mask", "keep"))
    rows = rows.select("key", "probe", "fp", "mask", F.col("fp").bitwiseAND(F.col("keep")).alias("rest"))
    least = rows.where("probe = 0").groupBy("key", "mask", "rest").agg(F.min("fp").alias("a"))
    return rows.join(least, ["key", "mask", "rest"]).where("fp <> a").select("a", F.col("fp").alias("b"))


def links(fps: DataFrame, distance: int = 3, run_limit: int = 8192) -> DataFrame:
    """Edges (a, b) between distinct fingerprints of at most ``distance`` bits: not
    all pairs, but the same connected components. ``fps``: one column fp, distinct."""
    filed = _filed(fps, distance)
    counts = filed.where("probe = 0").groupBy("seg", "key").count()
    hot = store(counts.where(F.col("count") > run_limit).select("seg", "key"), "hot-segments")
    plain, masked = filed, None
    if distance <= 3 and not hot.isEmpty():  # beyond, masks outnumber any run's pairs
        # Who probes a hot value, or is itself hot and probes another, meets by masks.
        widths = [w for _, w in _segments(distance)]
        lower = F.filter(
            F.transform(F.sequence(F.lit(0), F.lit(max(widths) - 1)), lambda b: F.expr("key").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), b))),
            lambda bit: bit != 0,
        )
        below = hot.select("seg", F.explode(lower).alias("bit"), "key").select("seg", F.col("key").bitwiseXOR(F.col("bit")).alias("key"))
        zone = hot.select("seg", "key", F.lit(1).alias("is_hot")).union(below.select("seg", "key", F.lit(0)))
        zone = store(zone.groupBy("seg", "key").agg(F.max("is_hot").alias("is_hot")), "hot-zone")
        marked = filed.join(zone, ["seg", "key"], "left")
        # Outside the zone, and filed rows of values near a hot one: pair by pair.
        plain = marked.where("is_hot is null or (is_hot = 0 and probe = 0)").drop("is_hot")
        for seg in range(len(widths)):
            probing = _masked(marked.where("is_hot is not null"), seg, distance, distance - 1)
            filed_hot = _masked(marked.where("is_hot = 1 and probe = 0"), seg, distance, distance)
            masked = probing.union(filed_hot) if masked is None else masked.union(probing).union(filed_hot)
    near = plain.repartition("seg", "key").sortWithinPartitions("seg", "key").mapInArrow(_runs(distance), "a bigint, b bigint")
    return near if masked is None else near.union(masked)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    distance: int = 3,
    run_limit: int = 8192,
) -> DataFrame:
    """(doc_id, fingerprint, component_id, fp, component_fp), a row per row of ``docs``.

    ``fingerprint`` is ``fp`` in 16 hex digits, ``component_fp`` the component's
    smallest fp; ``component_id`` the smallest doc_id that links of at most ``distance`` bits reach, itself included. A NULL or empty
    text has the fingerprint 0 and is linked like any other. Rows with one doc_id
    stay apart rows. A NULL doc_id never names a component (NULL if a component has
    no other). No documents, no rows.
    """
    if distance < 0 or shingle < 1:
        raise ValueError("distance must be 0 or more and shingle 1 or more")
    rows = store(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    # One row a distinct fingerprint: copies, even a third of all rows, are summed
    # before the shuffle.
    distinct = store(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), distance, run_limit))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("component_fp"))
    ids = rooted.groupBy("component_fp").agg(F.min("first_id").alias("component_id"))
    classes = store(rooted.join(ids, "component_fp").select("fp", "component_id", "component_fp"), "components")
    # AQE splits the partition of a fingerprint that very many rows share.
    return rows.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "fp", "component_fp"
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each group: that of the
    smallest doc_id (of rows that share this doc_id, the one of the smallest
    fingerprint; of identical ones any). Only the winners' keys meet the texts."""
    classes = store(near_duplicates(docs, id_col, text_col, shingle, distance), "near-duplicates")
    first = classes.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = first.groupBy("component_fp").agg(F.min("component_id").alias("_id"), F.min("fp").alias("_fp")).drop("component_fp")
    fp = fresh(docs, "fp")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [_signed(fingerprint(x, shingle)) for x in utf8(batch[text_col])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], [*batch.schema.names, fp])

    marked = docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(fp, LongType())]))
    same = (marked[fp] == kept["_fp"]) & named(id_col).eqNullSafe(kept["_id"])
    return marked.join(kept, same, "left_semi").dropDuplicates([id_col, fp]).select(*map(named, docs.columns))
