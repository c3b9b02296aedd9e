"""NTILE of several orders at once, by the boundaries between buckets.

The bucket of a row depends only on where its key lies among the last keys of the first
``buckets - 1`` buckets. Those keys are found by distributed selection, not by sorting:

1. the rows are stored once, and while they are written a mergeable quantile sketch of
   each order's first column is observed: a bracket for every boundary;
2. a round counts, exactly, the keys before and inside every bracket, and draws a
   bounded sample of the keys inside; the sample gives a narrower bracket. Equal values
   are told apart by the order's further columns (an id), which are sampled only inside
   the values where a boundary lies;
3. once a bracket has few keys the round reads them all and the boundary is exact.

A round is one narrow scan without a shuffle, for all orders together; their number grows
with the logarithm of the rows, and what reaches the driver is bounded by ``SAMPLE`` keys
a boundary. The buckets are then comparisons with literals: no sort, join or window.
A bracket that misses its boundary is found out by the exact counts and widened, so
sketch and samples decide on the number of rounds only, never on the result.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.names import quote
from ..session import materialize

SAMPLE = 32_768  # keys a boundary that a round brings to the driver
ACCURACY = 10_000  # of the sketch: ranks are off by 1 / ACCURACY of the rows


@dataclass(frozen=True)
class Order:
    """One column of an order. NULLs come last ascending and first descending unless
    said otherwise."""

    column: str
    descending: bool = False
    nulls_first: bool | None = None

    @property
    def null_rank(self) -> int:
        first = self.descending if self.nulls_first is None else self.nulls_first
        return 0 if first else 2  # values have 1


Key = tuple  # the values of an order's columns


def _comes(order: Sequence[Order], key: Key, types: Mapping[str, str], before: bool, equal: bool) -> Column:
    """Whether a row's key comes before (or after) the given one, or is equal to it."""
    out = F.lit(equal)
    for o, value in reversed(list(zip(order, key))):
        c = F.col(quote(o.column))
        if types[o.column] in ("float", "double"):
            c, value = c + F.lit(0.0).cast(types[o.column]), value if value is None else value + 0.0  # -0.0 is 0.0
        if value is None:
            same = c.isNull()
            strict = F.lit(False) if (o.null_rank == 0) == before else c.isNotNull()
        else:
            x = F.lit(value).cast(types[o.column])
            null_side = (o.null_rank == 0) == before  # NULLs lie on the side asked for
            same = c.eqNullSafe(x)
            strict = F.coalesce(c < x if before != o.descending else c > x, F.lit(null_side))
        out = strict | (same & out)
    return out


def _python_order(order: Sequence[Order]):
    """A sort key for Python that orders as Spark does."""

    class Reversed:
        __slots__ = ("x",)

        def __init__(self, x):
            self.x = x

        def __lt__(self, other):
            return other.x < self.x

        def __eq__(self, other):
            return self.x == other.x

    def one(o: Order, x):
        if x is None:
            return (o.null_rank, 0)
        if isinstance(x, float) and math.isnan(x):
            x = (1, 0.0)  # above all numbers
        elif isinstance(x, float):
            x = (0, x)
        elif isinstance(x, str):
            x = x.encode()
        return (1, Reversed(x) if o.descending else x)

    return lambda key: tuple(one(o, x) for o, x in zip(order, key))


@dataclass
class _Boundary:
    """The search for the ``target``-th key of an order, between low and high (both
    included; None: open)."""

    score: str
    target: int
    low: Key | None
    high: Key | None
    expected: int  # keys inside, at most as far as is known
    found: Key | None = None

    def narrow(self, before: int, inside: int, sample: list[Key], whole: bool, total: int) -> None:
        if self.target <= before:  # the bracket lies too high
            self.low, self.high, self.expected = None, self.low, total
            return
        if self.target > before + inside:
            self.low, self.high, self.expected = self.high, None, total
            return
        rank = self.target - before
        if whole:
            self.found = sample[rank - 1]
            return
        self.expected = inside
        if len(sample) < 64:
            return  # the next sample is dense enough
        at, off = rank / inside * len(sample), 4 * math.sqrt(len(sample)) + 1
        a, b = math.floor(at - off), math.ceil(at + off)
        self.low = sample[a] if a >= 0 else self.low
        self.high = sample[b] if b < len(sample) else self.high
        self.expected = max(1, math.ceil(inside * min(1.0, (b - a + 1) / len(sample))))


def _last_ranks(total: int, buckets: int) -> list[int]:
    """The ranks of the last rows of the buckets, without that of the last row of all."""
    q, r = divmod(total, buckets)
    ranks = {min(total, b * q + min(b, r)) for b in range(1, buckets)}
    return sorted(x for x in ranks if 0 < x < total)


def _sketched(rows: DataFrame, scores: Mapping[str, Sequence[Order]], buckets: int) -> tuple[DataFrame, dict]:
    """The rows, stored once, and what was observed on the way."""
    numeric = {f.name for f in rows.schema.fields if isinstance(f.dataType, NumericType)}
    grid = [min(1.0, max(0.0, b / buckets + d)) for b in range(1, buckets) for d in (-2 / ACCURACY, 2 / ACCURACY)]
    seen = [F.count(F.lit(1)).alias("rows")]
    for i, order in enumerate(scores.values()):
        first = F.col(quote(order[0].column))
        seen.append(F.count(first).alias(f"values{i}"))
        if order[0].column in numeric:
            seen.append(F.percentile_approx(first, grid, ACCURACY).alias(f"sketch{i}"))
    observation = Observation(f"cairn_sketch_{uuid.uuid4().hex}")
    stored = materialize(rows.observe(observation, *seen), "scored")
    return stored, observation.get


def _first_bracket(order: Sequence[Order], rank: int, seen: dict, i: int) -> tuple[Key | None, Key | None]:
    """Keys around the ``rank``-th by the sketch of the first column, or None for open
    ends. Only that column is given: the rest of a bracket's end is the least or greatest."""
    sketch, values = seen.get(f"sketch{i}"), seen[f"values{i}"] or 0
    if not sketch or not values:
        return None, None
    nulls = seen["rows"] - values
    rank -= nulls if order[0].null_rank == 0 else 0
    if not 0 < rank <= values:
        return None, None
    share = rank / values
    if order[0].descending:
        share = 1 - share
    pairs = [(sketch[j], sketch[j + 1]) for j in range(0, len(sketch), 2)]
    buckets = len(pairs) + 1
    nearest = min(range(1, buckets), key=lambda b: abs(b / buckets - share))
    if abs(nearest / buckets - share) > 1 / ACCURACY:  # NULLs have moved the boundary
        return None, None
    low, high = pairs[nearest - 1]
    return ((high,), (low,)) if order[0].descending else ((low,), (high,))


def boundaries(
    stored: DataFrame, scores: Mapping[str, Sequence[Order]], buckets: int, seen: dict | None = None, sample: int | None = None
) -> dict[str, list[Key]]:
    """By score the last keys of its buckets (fewer where there are fewer rows than
    buckets). ``stored`` is scanned once a round; ``seen`` is what was observed when it was
    stored."""
    sample = sample or SAMPLE
    types = dict(stored.dtypes)
    if seen is None:
        seen = {"rows": stored.count()} | {f"values{i}": 0 for i in range(len(scores))}
    total = seen["rows"] or 0
    open_: list[_Boundary] = []
    for i, (name, order) in enumerate(scores.items()):
        for rank in _last_ranks(total, buckets):
            open_.append(_Boundary(name, rank, *_first_bracket(order, rank, seen, i), total))
    every, turn = list(open_), 0
    while open_:
        turn += 1
        asked, whole = [], []
        for i, b in enumerate(open_):
            order = scores[b.score]
            low = order[: len(b.low)] if b.low else order
            high = order[: len(b.high)] if b.high else order
            before = _comes(low, b.low, types, True, False) if b.low else F.lit(False)
            after = _comes(high, b.high, types, False, False) if b.high else F.lit(False)
            inside = ~before & ~after
            key = F.struct(*[F.col(quote(o.column)).alias(f"k{j}") for j, o in enumerate(order)])
            whole.append(b.expected <= sample)
            drawn = inside
            if not whole[-1]:
                spread = F.pmod(F.xxhash64(key, F.lit(turn)), F.lit(2**40))
                drawn = inside & (spread < int(sample / b.expected * 2**40))
            asked += [
                F.count(F.when(before, 1)).alias(f"before{i}"),
                F.count(F.when(inside, 1)).alias(f"inside{i}"),
                F.collect_list(F.when(drawn, key)).alias(f"keys{i}"),
            ]
        observation = Observation(f"cairn_round_{uuid.uuid4().hex}")
        columns = sorted({o.column for order in scores.values() for o in order})
        stored.select(*map(quote, columns)).observe(observation, *asked).write.format("noop").mode("overwrite").save()
        got = observation.get
        for i, b in enumerate(open_):
            keys = sorted((tuple(k) for k in got[f"keys{i}"] or []), key=_python_order(scores[b.score]))
            b.narrow(got[f"before{i}"], got[f"inside{i}"], keys, whole[i], total)
        open_ = [b for b in open_ if b.found is None]
    return {name: [b.found for b in every if b.score == name] for name in scores}


def bucket_of(order: Sequence[Order], ends: Sequence[Key], types: Mapping[str, str]) -> Column:
    """The bucket (from 1) of a row, given the last keys of the buckets."""
    passed = [F.when(_comes(order, end, types, False, False), 1).otherwise(0) for end in ends]
    return sum(passed, F.lit(1)).cast("int")


def ntile_scores(rows: DataFrame, scores: Mapping[str, Sequence[Order]], buckets: int, sample: int | None = None) -> DataFrame:
    """``rows`` (stored once) with ``NTILE(buckets) OVER (ORDER BY ...)`` for every entry
    of ``scores``.

    Each order must be total: end it with a unique column. No rows give no rows; the
    columns are ints."""
    if buckets < 1:
        raise ValueError("buckets must be >= 1")
    stored, seen = _sketched(rows, scores, buckets)
    ends = boundaries(stored, scores, buckets, seen, sample)
    types = dict(stored.dtypes)
    return stored.withColumns({name: bucket_of(order, ends[name], types) for name, order in scores.items()})
