"""NTILE by boundaries against Spark's own single-task window."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cairn.operators import boundaries
from cairn.operators.boundaries import Order, ntile_scores


def _window(order):
    out = []
    for o in order:
        c = F.col(o.column)
        first = o.descending if o.nulls_first is None else o.nulls_first
        out.append((c.desc_nulls_first() if first else c.desc_nulls_last()) if o.descending else (c.asc_nulls_first() if first else c.asc_nulls_last()))
    return Window.orderBy(*out)


def _same(df, scores, k, sample=None):
    got = ntile_scores(df, scores, k, sample=sample)
    want = df.select("*", *[F.ntile(k).over(_window(o)).alias(n) for n, o in scores.items()])
    key = repr  # NaN and NULL compare by their text
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


def _rows(n, seed):
    r = random.Random(seed)
    return [
        (
            i,
            f"c{r.randint(0, 10**6)}-é{i}",
            r.choice([None, 1, 1, 1, 2, 3, r.randint(0, 50)]),
            r.choice([None, float("nan"), -0.0, 0.0, float("inf"), r.random(), r.random() * -100]),
            Decimal(r.randint(-9999, 9999)) / 100 if r.random() < 0.9 else None,
        )
        for i in range(n)
    ]


SCHEMA = "id BIGINT, name STRING, n BIGINT, x DOUBLE, amount DECIMAL(18,2)"
SCORES = {
    "a": [Order("amount"), Order("id")],
    "b": [Order("n"), Order("name")],
    "c": [Order("n", descending=True), Order("id", descending=True)],
    "d": [Order("x", nulls_first=True), Order("id")],
    "e": [Order("x", descending=True, nulls_first=False), Order("name", descending=True)],
    "f": [Order("name")],
}


@pytest.mark.parametrize("n,k", [(0, 5), (1, 5), (3, 5), (5, 5), (7, 1), (103, 5), (250, 7)])
def test_equals_the_window(spark, n, k):
    _same(spark.createDataFrame(_rows(n, n + k), SCHEMA), SCORES, k)


def test_many_rounds(spark):
    """A sample of few keys takes several rounds and gives the same buckets."""
    _same(spark.createDataFrame(_rows(3000, 1), SCHEMA).repartition(5), SCORES, 5, sample=200)


def test_one_value_for_all(spark):
    rows = spark.range(2000).select("id", F.lit(7).alias("n"))
    _same(rows, {"s": [Order("n"), Order("id")], "t": [Order("n", descending=True), Order("id", descending=True)]}, 5, sample=150)


def test_wrong_brackets_are_found_out(spark, monkeypatch):
    """Brackets that miss every boundary cost rounds, not results."""
    monkeypatch.setattr(boundaries, "_first_bracket", lambda order, rank, seen, i: ((49,), (50,)) if rank % 2 else ((-5,), (0,)))
    rows = spark.range(1000).select("id", (F.col("id") % 40).alias("n"))
    _same(rows, {"s": [Order("n"), Order("id")], "t": [Order("n", descending=True), Order("id")]}, 5)


def test_rounds_and_keys_are_few(spark, monkeypatch):
    """The sketch leaves few keys to read, ties apart; one scan a round."""
    seen, narrow = [], boundaries._Boundary.narrow

    def watched(self, before, inside, sample, whole, total):
        seen.append((self.score, len(sample)))
        narrow(self, before, inside, sample, whole, total)

    monkeypatch.setattr(boundaries._Boundary, "narrow", watched)
    rows = spark.range(30_000).select("id", (F.col("id") * 7919 % 30_011).alias("v"))
    _same(rows, {"s": [Order("v"), Order("id")]}, 5)
    assert len(seen) == 4 and all(n <= 4 * 30_000 / boundaries.ACCURACY + 10 for _, n in seen), seen


def test_last_ranks_are_those_of_ntile():
    for total in range(0, 40):
        for k in range(1, 9):
            q, r = divmod(total, k)
            sizes = [q + (b < r) for b in range(k)]
            want = sorted({sum(sizes[: b + 1]) for b in range(k)} - {0, total})
            assert boundaries._last_ranks(total, k) == want


def test_bucket_is_literals_only(spark):
    out = ntile_scores(spark.createDataFrame(_rows(100, 3), SCHEMA), SCORES, 5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Sort", "Window", "Join")), plan
    assert math.prod(plan.count(x) for x in ("FileScan",)) == 1
