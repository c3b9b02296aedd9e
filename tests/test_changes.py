"""In-place merges, staged overwrites, SQL parameters, number forms, marks under two runs,
and the driver's entry without optional libraries."""

import random
import re
import subprocess
import sys
import threading
import uuid

import pytest
from pyspark.sql import functions as F

from cairn import session
from cairn.operators.coerce import coerce_schema
from cairn.operators.merge import bucketing, merge_into, merge_one_per_key, merge_upsert, save_bucketed
from cairn.sinks.writers import save_table
from cairn.sources.tables import read_sql
from cairn.streaming.watermark import StaleMarkError, WatermarkStore
from tests.conftest import ROOT


def _rows(df):
    return sorted(map(repr, df.collect()))


def _tables(spark, seed=2, n=80):
    r = random.Random(seed)
    target = [(r.choice([None, *range(40)]), r.choice("ab"), f"n{i}", i) for i in range(n)]
    source = [(r.choice([None, *range(60)]), r.choice("ab"), r.choice([None, i])) for i in range(n)]
    return spark.createDataFrame(target, "k INT, s STRING, name STRING, v INT"), spark.createDataFrame(source, "k INT, s STRING, v INT")


def test_one_per_key_is_the_merge_of_the_winners(spark):
    target, source = _tables(spark)
    best = source.filter("k IS NOT NULL").groupBy("k", "s").agg(F.max(F.struct("v")).alias("w")).select("k", "s", "w.v")
    unique = best.unionByName(source.filter("k IS NULL"))
    want = _rows(merge_upsert(target, unique, ["k", "s"]))
    assert _rows(merge_one_per_key(target, source, ["k", "s"], order_by=["v"])) == want
    with pytest.raises(ValueError, match="not in target"):
        merge_one_per_key(target, source.withColumn("x", F.lit(1)), ["k"])


def test_bucketed_merge_in_place(spark, tmp_path):
    target, source = _tables(spark)
    name = f"bucketed_{uuid.uuid4().hex[:8]}"
    save_bucketed(target, name, ["k", "s"], 4, location=str(tmp_path / "t"))
    assert bucketing(spark, name) == (4, ["k", "s"])
    for step in range(2):
        changes = source.filter(F.col("k").isNotNull()).withColumn("v", F.col("v") + step)
        want = _rows(merge_one_per_key(spark.table(name), changes, ["k", "s"]))
        merge_into(spark, name, changes, ["s", "k"])
        assert _rows(spark.table(name)) == want and bucketing(spark, name) == (4, ["k", "s"])
    assert len([p for p in tmp_path.iterdir() if p.is_dir()]) == 1  # old contents are gone
    with pytest.raises(ValueError, match="not bucketed"):
        merge_into(spark, name, source, ["k"])


def test_the_bucketed_target_is_read_once_and_not_shuffled(spark, tmp_path):
    name = f"bucketed_{uuid.uuid4().hex[:8]}"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        save_bucketed(spark.range(5000).select("id", F.lit("old").alias("v")), name, ["id"], 4, location=str(tmp_path / "t"))
        merged = merge_one_per_key(spark.table(name), spark.range(4000, 6000).select("id", F.lit("new").alias("v")), ["id"])
        lines = merged._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = [i for i, x in enumerate(lines) if "FileScan" in x]
    assert len(scans) == 1
    depth = len(lines[scans[0]]) - len(lines[scans[0]].lstrip(" :+-*()0123456789"))
    above, at = [], depth
    for x in reversed(lines[: scans[0]]):  # the scan's ancestors, by their indentation
        d = len(x) - len(x.lstrip(" :+-*()0123456789"))
        if d < at:
            above.append(x)
            at = d
    assert any("Join" in x for x in above) and not any("Exchange" in x for x in above), above


def test_overwriting_a_path(spark, tmp_path):
    path = str(tmp_path / "t")
    save_table(spark.range(10), path=path)
    bad = spark.range(10).select(F.when(F.col("id") < 20, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        save_table(bad, path=path)
    assert spark.read.parquet(path).count() == 10
    save_table(spark.read.parquet(path).select((F.col("id") + 1).alias("id")), path=path)  # of itself
    assert spark.read.parquet(path).agg(F.sum("id")).first()[0] == 55
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_sql_quotes_and_lists(spark):
    spark.range(10).select("id", F.concat(F.lit("a"), "id").alias("v")).createOrReplaceTempView("v_quoted")
    one = read_sql(spark, 'SELECT "{{a}}" AS x, "p {{a}} ""q""" AS y, "plain" AS z', parameters={"a": 'it"s'}).first()
    assert (one.x, one.z) == ('it"s', "plain") and one.y.startswith('p it"s ')
    for given, want in (([1, 3], [1, 3]), ((5,), [5]), ([], []), ({2}, [2])):
        got = read_sql(spark, "SELECT id FROM v_quoted WHERE id in ( {{ l }} ) ORDER BY id", parameters={"l": given})
        assert [r.id for r in got.collect()] == want
    got = read_sql(spark, "SELECT id FROM v_quoted WHERE v NOT IN ({{l}}) AND id IN ({{one}})", parameters={"l": ["a1", "x'; --"], "one": 2})
    assert [r.id for r in got.collect()] == [2]
    assert read_sql(spark, "SELECT size({{l}}) AS n", parameters={"l": [1, 2]}).first().n == 2  # a list elsewhere is an array
    with pytest.raises(KeyError):
        read_sql(spark, "SELECT 1 WHERE 1 IN ({{l}})", parameters={"m": [1]})


def test_number_forms_and_rejects(spark):
    forms = {"12": 12, "12.0": 12, "1e3": 1000, " 7.00 ": 7, "-3.0": -3, "+4": 4, "1.5e1": 15, "12.5": None, "x": None, "1e400": None, "": None, ".": None,
             "9223372036854775807": 2**63 - 1, "9223372036854775808": None, "9223372036854775807.0": 2**63 - 1, "e": None, "1e-1": None, "0x10": None}
    df = spark.createDataFrame([(t, t) for t in [*forms, None]], "n string, t string")
    got = coerce_schema(df, {"n": "int64", "t": "string"}, rejects="bad").collect()
    for r in got:
        want = forms.get(r.t)
        assert r.n == want, r
        assert r.bad == ({"n": r.t} if want is None and r.t not in (None, "") else {}), r
    small = coerce_schema(df, {"n": "int8"}, rejects="bad").collect()
    assert sorted(r.n for r in small if r.n is not None) == [-3, 4, 7, 12, 12, 15]


def test_of_two_runs_from_one_mark_the_second_fails(spark, tmp_path):
    store = WatermarkStore(spark, str(tmp_path / "marks"))
    assert store.load("s") is None and store.version("s") == 0
    store.save("s", "2024-01-01T00:00:00Z")
    version, outcome = store.version("s"), []

    def run(mark):
        try:
            store.save("s", mark, version)
            outcome.append(mark)
        except StaleMarkError:
            outcome.append(None)

    threads = [threading.Thread(target=run, args=(f"2024-01-0{d}T00:00:00Z",)) for d in (2, 3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(x is None for x in outcome) == [False, True]
    assert store.load("s") == next(x for x in outcome if x) and store.version("s") == 2 and store.version("other") == 0


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(session, "checkpoint_dir", lambda s: None)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_path(spark, "x")


def test_entry_without_an_optional_library():
    """A library that only the training-data operators need may be missing."""
    code = (
        "import sys; sys.modules['ahocorasick'] = None\n"
        "import __spark_entry__ as e; names = e.queries()\n"
        "assert 'rfm_analysis' in names and not any(n.startswith('op') and n[2].isdigit() for n in names), sorted(names)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
    assert re.search("except ImportError", open(f"{ROOT}/__spark_entry__.py").read())
