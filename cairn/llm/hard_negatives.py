"""Hard negatives by inner product, filtered by segment summaries.

A vector is cut into segments; of each its mean and its deviation (the norm of what is
left without the mean) are stored, at several numbers of segments. For two vectors

    sum of (length mean mean') - sum of (deviation deviation') <= inner product
                               <= sum of (length mean mean') + sum of (deviation deviation')

so a pair whose bounds miss what is still wanted is out. Pairs that stay are looked at
with more and shorter segments, and only the last ones are scored, exactly.

The stated anchors are compared with all rows in a grid: rows are packed into blocks,
blocks into stripes, anchors into groups, and a cell (group, stripe) is one task's work
and memory. A cell keeps the best found so far, which narrows what is wanted from its next
rows; the cells' lists are merged by anchor. First come the positives of each anchor, then
the negatives in the score range of each positive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import release
from .common import named, store

LEVELS = (4, 16)  # segments of a summary, coarse to fine
CHUNK = 512  # rows compared before what is wanted is narrowed
NOTHING = -(2**63)
EXACT = 2**53


def segments(width: int, level: int) -> np.ndarray:
    """Where the segments of a vector of ``width`` components start."""
    return np.unique(np.arange(min(level, width)) * width // max(1, min(level, width)))


def summary(vectors: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """By row and segment the mean and the deviation."""
    starts = segments(vectors.shape[1], level)
    lengths = np.diff(np.r_[starts, vectors.shape[1]])
    mean = np.add.reduceat(vectors, starts, axis=1) / lengths
    rest = vectors - np.repeat(mean, lengths, axis=1)
    return mean.astype(np.float32), np.sqrt(np.add.reduceat(rest**2, starts, axis=1)).astype(np.float32)


class Rows:
    """Vectors of one width with ids, labels, places (block, number) and summaries."""

    def __init__(self, ids, labels, places, vectors):
        self.ids, self.labels, self.places = ids, labels, places
        self.vectors = vectors.astype(np.float64)
        self.size = int(np.abs(vectors).max(initial=0))
        if self.size == 2**63 - 1 or vectors.min(initial=0) == -(2**63):
            raise ValueError("a component does not fit in a long")
        self.exact = vectors
        self.norms = np.sqrt((self.vectors**2).sum(1))
        width = vectors.shape[1]
        self.levels = [summary(self.vectors, level) for level in LEVELS] if width else []
        self.lengths = [np.diff(np.r_[segments(width, level), width]) for level in LEVELS] if width else []

    def part(self, a: int, b: int) -> Rows:
        out = object.__new__(Rows)
        out.__dict__ = self.__dict__ | {k: self.__dict__[k][a:b] for k in ("ids", "labels", "places", "vectors", "exact", "norms")}
        out.levels = [(m[a:b], d[a:b]) for m, d in self.levels]
        return out


def bounds(a: Rows, b: Rows, level: int, pairs=None) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of inner products at one level: of all pairs as a matrix,
    or of the given pairs. Widened by more than the rounding of the summaries."""
    (am, ad), (bm, bd) = a.levels[level], b.levels[level]
    weighted = am.astype(np.float64) * a.lengths[level]
    if pairs is None:
        middle, spread = weighted @ bm.T.astype(np.float64), ad.astype(np.float64) @ bd.T.astype(np.float64)
        slack = np.outer(a.norms, b.norms)
    else:
        i, j = pairs
        middle = np.einsum("ij,ij->i", weighted[i], bm[j].astype(np.float64))
        spread = np.einsum("ij,ij->i", ad[i].astype(np.float64), bd[j].astype(np.float64))
        slack = a.norms[i] * b.norms[j]
    spread = spread + 1e-6 * slack + 1e-6
    return middle - spread, middle + spread


def largest(a: Rows, b: Rows) -> int:
    """What no inner product exceeds. Raises where one might not fit in a long."""
    most = a.size * b.size * max(1, a.vectors.shape[1])
    if most >= 2**63:
        raise ValueError("an inner product may not fit in a long")
    return most


def scores(a: Rows, b: Rows, pairs) -> np.ndarray:
    """Exact inner products of pairs."""
    i, j = pairs
    most = largest(a, b)
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), 65_536):
        x, y = i[at : at + 65_536], j[at : at + 65_536]
        if most < EXACT:  # sums of doubles are exact here
            out[at : at + 65_536] = np.einsum("ij,ij->i", a.vectors[x], b.vectors[y])
        else:
            out[at : at + 65_536] = np.einsum("ij,ij->i", a.exact[x].astype(np.int64), b.exact[y].astype(np.int64))
    return out


class Best:
    """The ``keep`` best (score, then smaller id) by anchor and range of scores."""

    def __init__(self, low: np.ndarray, high: np.ndarray, keep: int):
        self.low, self.high, self.keep = low, high, keep  # by anchor and range
        self.wanted = low.copy()  # scores below are of no use any more
        self.found = np.zeros((0, 5), np.int64)  # anchor, range, score, id, row

    def add(self, anchors: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        new = [self.found]
        for p in range(self.low.shape[1]):
            ok = (score >= self.wanted[anchors, p]) & (score <= self.high[anchors, p])
            new.append(np.stack([anchors[ok], np.full(ok.sum(), p), score[ok], ids[ok], rows[ok]], axis=1))
        table = np.concatenate(new)
        # ~score falls as the score rises and never overflows
        table = table[np.lexsort((table[:, 4], table[:, 3], ~table[:, 2], table[:, 1], table[:, 0]))]
        first = np.flatnonzero(np.r_[True, (np.diff(table[:, 0]) != 0) | (np.diff(table[:, 1]) != 0)]) if len(table) else np.zeros(0, int)
        rank = np.arange(len(table)) - np.repeat(first, np.diff(np.r_[first, len(table)]))
        self.found = table[rank < self.keep]
        last = table[rank == self.keep - 1]
        self.wanted[last[:, 0], last[:, 1]] = np.maximum(self.wanted[last[:, 0], last[:, 1]], last[:, 2])


def search(a: Rows, b: Rows, best: Best, same: bool, offset: int = 0) -> int:
    """Adds to ``best`` what rows ``b`` have for anchors ``a``: rows of the ``same`` label
    (but the anchor's own), or of others. Returns the number of pairs scored exactly."""
    scored = 0
    largest(a, b)  # before bounds, which a score beyond a long would miss
    for at in range(0, len(b.ids), CHUNK):
        rows = b.part(at, at + CHUNK)
        open_ = (a.labels[:, None] == rows.labels[None, :]) == same
        if same:
            open_ &= (a.places[:, None, :] != rows.places[None, :, :]).any(axis=2)
        pairs = None
        for level in range(len(a.levels)):
            lower, upper = bounds(a, rows, level, pairs)
            if pairs is None:
                use = np.zeros(open_.shape, bool)
                for p in range(best.low.shape[1]):
                    use |= (upper >= best.wanted[:, p, None]) & (lower <= best.high[:, p, None])
                pairs = np.nonzero(use & open_)
            else:
                i, j = pairs
                use = ((upper[:, None] >= best.wanted[i]) & (lower[:, None] <= best.high[i])).any(axis=1)
                pairs = i[use], j[use]
        if pairs is None:  # vectors without components
            pairs = np.nonzero(open_)
        i, j = pairs
        scored += len(i)
        best.add(i, scores(a, rows, pairs), rows.ids[j], j + at + offset)
    return scored


PACKED = "block bigint, width int, ids binary, labels binary, places binary, vectors binary, kind string"


def _pack(ids, labels, places, vectors: np.ndarray, block: int) -> pa.RecordBatch:
    kind = np.result_type(np.min_scalar_type(int(vectors.min(initial=0))), np.min_scalar_type(int(vectors.max(initial=0))), np.int8)
    kind = np.dtype(np.int64) if kind.kind == "f" else kind
    return pa.RecordBatch.from_pydict(
        {
            "block": pa.array([block], pa.int64()),
            "width": pa.array([vectors.shape[1]], pa.int32()),
            "ids": pa.array([np.asarray(ids, np.int64).tobytes()], pa.binary()),
            "labels": pa.array([np.asarray(labels, np.int64).tobytes()], pa.binary()),
            "places": pa.array([np.asarray(places, np.int64).tobytes()], pa.binary()),
            "vectors": pa.array([vectors.astype(kind).tobytes()], pa.binary()),
            "kind": pa.array([kind.str]),
        }
    )


def _unpack(row: dict) -> Rows:
    ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
    vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(len(ids), row["width"])
    return Rows(ids, labels, np.frombuffer(row["places"], np.int64).reshape(-1, 2), vectors)


def _blocks(block_rows: int):
    """Rows to blocks of vectors of one width, told apart by (block, number)."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blocks = TaskContext.get().partitionId(), 0
        waiting: dict[int, list] = {}

        def packed(width: int) -> pa.RecordBatch:
            nonlocal blocks
            block, blocks = part << 32 | blocks, blocks + 1
            held = waiting.pop(width)
            vectors = np.concatenate([v for _, _, v in held]).reshape(-1, width) if width else np.zeros((sum(len(i) for i, _, _ in held), 0), np.int64)
            ids, labels = np.concatenate([i for i, _, _ in held]), np.concatenate([x for _, x, _ in held])
            return _pack(ids, labels, np.stack([np.full(len(ids), block), np.arange(len(ids))], axis=1), vectors, block)

        for batch in rows:
            ids, labels = (np.asarray(batch[c], np.int64) for c in ("id", "label"))
            widths = np.diff(np.asarray(batch["vector"].offsets, np.int64))
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width)
                for start in range(0, len(at), block_rows):
                    some = at[start : start + block_rows]
                    flat = np.asarray(batch["vector"].take(pa.array(some)).flatten(), np.int64)
                    waiting.setdefault(width, []).append((ids[some], labels[some], flat))
                    if sum(len(i) for i, _, _ in waiting[width]) >= block_rows:
                        yield packed(width)
        for width in list(waiting):
            yield packed(width)

    return run


def _anchors(every: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                found = _unpack(row)
                at = np.flatnonzero(found.ids % every == 0)
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array(found.places[at, 0]),
                        "number": pa.array(found.places[at, 1]),
                        "width": pa.array([row["width"]] * len(at), pa.int32()),
                        "id": pa.array(found.ids[at]),
                        "label": pa.array(found.labels[at]),
                        "vector": pa.array([x.astype(np.int64).tobytes() for x in found.exact[at]], pa.binary()),
                    }
                )

    return run


ANCHORS = "block bigint, number bigint, width int, id bigint, label bigint, vector binary"
GROUPED = "group int, low binary, high binary, " + PACKED


def _grouped(table: pa.Table) -> pa.Table:
    """Anchors of one group as one row, with the ranges of scores wanted."""
    table = table.sort_by([("block", "ascending"), ("number", "ascending")])
    width = table["width"][0].as_py()
    vectors = np.frombuffer(b"".join(table["vector"].to_pylist()), np.int64).reshape(table.num_rows, width)
    places = np.stack([np.asarray(table["block"]), np.asarray(table["number"])], axis=1)
    packed = _pack(np.asarray(table["id"]), np.asarray(table["label"]), places, vectors, 0)
    ranges = [np.array(table[c].to_pylist(), np.int64).reshape(table.num_rows, -1).tobytes() for c in ("low", "high")]
    row = {"group": pa.array([table["group"][0].as_py()], pa.int32()), "low": pa.array([ranges[0]], pa.binary()), "high": pa.array([ranges[1]], pa.binary())}
    return pa.table(row | {name: packed[name] for name in packed.schema.names})


FOUND = "block bigint, number bigint, range int, score bigint, id bigint, at bigint"


def _cell(same: bool, keep: int):
    def run(blocks: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        for group in anchors.to_pylist():
            a = _unpack(group)
            low, high = (np.frombuffer(group[c], np.int64).reshape(len(a.ids), -1) for c in ("low", "high"))
            best, offset = Best(low, high, keep), 0
            for i in range(blocks.num_rows):
                b = _unpack(blocks.slice(i, 1).to_pylist()[0])
                search(a, b, best, same, offset)
                offset += len(b.ids)
            at = best.found[:, 0]
            out.append(np.column_stack([a.places[at], best.found[:, 1:]]))
        found = np.concatenate(out) if out else np.zeros((0, 6), np.int64)
        names = ("block", "number", "range", "score", "id", "at")
        return pa.table({n: pa.array(found[:, i], pa.int32() if n == "range" else pa.int64()) for i, n in enumerate(names)})

    return run


def _compared(blocks: DataFrame, anchors: DataFrame, same: bool, keep: int, stripes: int, groups: int) -> DataFrame:
    """The best rows by anchor and range: every group of anchors meets every stripe of
    blocks in one cell; ``anchors`` have low and high, arrays with one entry a range."""
    group = F.pmod(F.xxhash64("block", "number"), F.lit(groups)).cast("int")
    grouped = anchors.withColumn("group", group).groupBy("group", "width").applyInArrow(_grouped, GROUPED)
    stripe = (F.shiftright("block", 32) + F.col("block").bitwiseAND(F.lit(2**32 - 1))) % stripes
    left = blocks.withColumn("stripe", stripe.cast("int")).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = grouped.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    key = ["group", "stripe", "width"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_cell(same, keep), FOUND)
    order = Window.partitionBy("block", "number", "range").orderBy(F.desc("score"), "id", "at")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def hard_negatives(
    df: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: Column | str = "label",
    every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    block_rows: int = 2048,
    group_rows: int = 1024,
    stripe_rows: int = 131_072,
    least_stripes: int = 16,
) -> DataFrame:
    """For each anchor and each of its positives the nearest rows of other labels that are
    clearly farther than the positive.

    Components become floor(``scale`` * x), scores are integer inner products, higher
    first, ties by smaller id. Anchors: ids divisible by ``every``; positives: an anchor's
    first ``positives`` other rows of its label; negatives: the first ``negatives`` rows
    of other labels with low * positive <= 100 * negative <= high * positive. Returns
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a NULL id, label or vector or a component that is NULL or not finite take no
    part. Vectors of different lengths are not compared. A repeated row is a row of its own: it can
    be the positive of its twin, and repeated anchors give their rows as often. Anchors
    with no positive or no negative in range give no rows. A score that might not fit in a
    long is an error. ``label`` may be an expression."""
    components = named(vector)
    fine = components.isNotNull() & ~F.exists(components, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = df.select(
        named(vec_id).cast("bigint").alias("id"),
        (named(label) if isinstance(label, str) else label).cast("bigint").alias("label"),
        F.when(F.coalesce(fine, F.lit(False)), F.transform(components, lambda x: F.floor(x.cast("double") * scale))).alias("vector"),
    ).dropna()
    blocks = store(rows.mapInArrow(_blocks(block_rows), PACKED), "negatives-blocks")
    n = blocks.agg(F.sum(F.length("ids")) / 8).first()[0] or 0
    stripes = int(max(-(-n // stripe_rows), min(least_stripes, -(-n // block_rows)), 1))
    anchors = store(blocks.mapInArrow(_anchors(every), ANCHORS), "negatives-anchors")
    groups = int(max(1, -(-anchors.count() // group_rows)))
    any_score = anchors.withColumns({"low": F.array(F.lit(NOTHING)), "high": F.array(F.lit(2**63 - 1))})
    near = store(_compared(blocks, any_score, True, positives, stripes, groups), "negatives-positives")
    wide = "decimal(38,0)"
    limits = {
        "low": F.expr(f"cast(ceil(cast(score AS {wide}) * {low} / 100) AS bigint)"),
        "high": F.expr(f"cast(floor(cast(score AS {wide}) * {high} / 100) AS bigint)"),
    }
    ranges = near.withColumns(limits).groupBy("block", "number").agg(
        F.map_from_entries(F.collect_list(F.struct("rank", F.struct("low", "high")))).alias("ranges")
    )  # ``positives`` entries at most
    # a range without a positive holds no score
    sides = {
        side: F.array(*[F.coalesce(F.element_at("ranges", r)[side], F.lit(empty)) for r in range(1, positives + 1)])
        for side, empty in (("low", 1), ("high", 0))
    }
    ready = anchors.join(ranges, ["block", "number"]).withColumns(sides).drop("ranges")
    far = store(_compared(blocks, ready, False, negatives, stripes, groups), "negatives-found")
    release(blocks)
    positive = near.select("block", "number", (F.col("rank") - 1).alias("range"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    own = anchors.select("block", "number", F.col("id").alias("anchor_id"))
    return (
        far.join(positive, ["block", "number", "range"])
        .join(own, ["block", "number"])
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
