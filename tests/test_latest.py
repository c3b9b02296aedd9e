"""latest_per_key against rows picked one by one in Python, on every way of fetching."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cairn.operators import latest
from cairn.operators.latest import latest_per_key

SCHEMA = "a BIGINT, b STRING, d TIMESTAMP_NTZ, day DATE, v INT, text STRING, m MAP<STRING,INT>"
WAYS = {"broadcast": {}, "bitmap": {"broadcast_rows": 0}, "shuffled": {"broadcast_rows": 0, "filter_bytes": 0}}


def _rows(n=600, seed=4):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        d = r.choice([None, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=r.randint(0, 50), microseconds=r.randint(0, 2))])
        rows.append((r.choice([None, 1, 1, 1, r.randint(2, 60)]), r.choice([None, "x", "y"]), d, d and d.date(), r.choice([None, *range(5)]), f"t{i % 90}", {"k": i % 3}))
    return rows + rows[:40]  # repeated rows


def _brute(rows, key, order):
    best = {}
    for row in rows:
        k = tuple(row[i] for i in key)
        o = tuple((row[i] is not None, row[i] if row[i] is not None else 0) for i in order)
        best.setdefault(k, {}).setdefault(o, []).append(row)
    return {k: by[max(by)] for k, by in best.items()}


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("keys,order", [(["a"], ["d", "v"]), (["a", "b"], ["day", "v"]), (["b"], ["v"]), (["a"], ["text"]), (["a"], ["v", "text", "d"]), (["a"], [])])
def test_greatest_row_of_each_key(spark, way, keys, order):
    rows, names = _rows(), [x.split()[0] for x in SCHEMA.split(", ")]
    at = names.index
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = latest_per_key(df, keys, order, **WAYS[way]).collect()
    want = _brute(rows, [at(k) for k in keys], [at(o) for o in order])
    assert len(got) == len(want)
    for row in got:
        tied = want[tuple(row[k] for k in keys)]
        assert tuple(row) in tied
    # the pick among ties does not depend on how the rows lie
    again = latest_per_key(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3), keys, order, **WAYS[way]).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_null_keys_may_go(spark):
    df = spark.createDataFrame(_rows(), SCHEMA)
    got = latest_per_key(df, ["a"], ["d", "v"], keep_null_keys=False)
    assert got.filter("a IS NULL").count() == 0
    assert latest_per_key(df.filter("1 = 0"), ["a"], ["d", "v"]).collect() == []


@pytest.mark.parametrize("order", [["d", "v"], ["d"], ["v"], []])
def test_no_sort_aggregate(spark, monkeypatch, order):
    plans, store = [], latest.materialize
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(latest, "materialize", lambda df, name: plans.append(plan(df)) or store(df, name))
    for how in WAYS.values():
        plans.append(plan(latest_per_key(spark.createDataFrame(_rows(), SCHEMA), ["a", "b"], order, **how)))
    sorts = [line for p in plans for line in p.splitlines() if "SortAggregate" in line]
    assert plans and all("bitmap_construct_agg" in line for line in sorts), sorts  # of hashes, never of rows
    assert all("HashAggregate" in p for p in plans[::2])


def test_a_hot_key_sends_one_row_a_task(spark):
    """A key that holds nearly all rows, all of them alike: the limit to one row comes
    before the exchange."""
    df = spark.createDataFrame([(1, 5, "x")] * 3000, "a INT, v INT, text STRING").repartition(6)
    out = latest_per_key(df, ["a"], ["v"])
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and text.rindex("WindowGroupLimit") > text.index("Exchange")
    assert out.collect() == [(1, 5, "x")]


def test_bitmap_lets_few_rows_through(spark):
    rows = spark.range(40_000).select((F.col("id") % 2000).alias("k"), F.col("id").alias("v"))
    best = rows.groupBy("k").agg(F.max("v").alias("v"))
    through = latest._passes(rows, best, 2000, ["k", "v"])
    assert best.exceptAll(through).count() == 0  # no winner is lost
    assert through.count() <= 2000 + 38_000 * 0.08
