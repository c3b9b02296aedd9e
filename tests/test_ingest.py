"""The stream's target: a log of row versions that batches only append to."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cairn.streaming.ingest import compact, files_by_date, ingest_stream, read_current, upsert_batch

SCHEMA = "id BIGINT, sub STRING, ts TIMESTAMP_NTZ, v INT, m MAP<STRING,INT>"


def _files(path):
    return {(p.parent.name, p.name) for p in path.rglob("part-*.parquet")}


def _current(spark, target):
    return sorted(map(repr, read_current(spark, target).collect()))


@pytest.mark.parametrize("event_time", ["ts", None])
def test_batches_against_a_dictionary(spark, tmp_path, event_time):
    """Random batches of new, changed and repeated records, NULL keys and dates included;
    a date is compacted now and then. A key keeps its date."""
    r, target, want = random.Random(8), str(tmp_path / "t"), {}
    day = {i: r.choice([None, dt.datetime(2024, 1, r.randint(1, 4), r.randint(0, 23))]) for i in range(40)}
    sent = []
    for step in range(4):
        batch = [(i, "a", day[i], step * 100 + n, {"k": step}) for n, i in enumerate(r.sample(range(40), 12))]
        batch += r.sample(sent, min(5, len(sent)))[:0] + [(None, "n", None, 1, None), (None, "n", None, 1, None), (3, None, day[3], step % 2, None)]
        df = spark.createDataFrame(batch, SCHEMA)
        before = _files(tmp_path / "t")
        upsert_batch(df, target, ["id", "sub"], ["v"], event_time)
        assert before <= _files(tmp_path / "t")  # nothing is replaced
        upsert_batch(df, target, ["id", "sub"], ["v"], event_time)  # run again: no news
        sent += batch
        for row in batch:
            want[(row[0], row[1]) if None not in row[:2] else row[:4]] = row
        if step % 2:
            compact(spark, target, most_files=1)
        rows = spark.createDataFrame(list(want.values()), SCHEMA)
        assert _current(spark, target) == sorted(map(repr, rows.collect()))
    compact(spark, target, most_files=0)
    assert max(files_by_date(spark.read.schema(SCHEMA).parquet(target)).values()) == 1


def test_random_keys_replace_no_file(spark, tmp_path):
    """200 random keys of a large table: only the batch's own rows are written, and
    sending them again writes none."""
    target = str(tmp_path / "t")
    base = spark.range(20_000).select(
        "id", F.lit("s").alias("sub"), F.timestamp_seconds(F.col("id") * 40).cast("timestamp_ntz").alias("ts"), F.lit(0).alias("v")
    )
    upsert_batch(base, target, ["id"], None, "ts")
    before = _files(tmp_path / "t")
    keys = random.Random(1).sample(range(20_000), 200)
    batch = base.filter(F.col("id").isin(keys)).withColumn("v", F.lit(1))
    upsert_batch(batch, target, ["id"], None, "ts")
    after = _files(tmp_path / "t")
    assert before < after
    new = spark.read.parquet(*[str(tmp_path / "t" / d / f) for d, f in after - before])
    assert new.count() == 200
    upsert_batch(batch, target, ["id"], None, "ts")
    assert _files(tmp_path / "t") == after
    got = read_current(spark, target)
    assert got.count() == 20_000 and got.agg(F.sum("v")).first()[0] == 200


def test_a_key_whose_date_moves_is_there_once(spark, tmp_path):
    target = str(tmp_path / "t")
    for day, v in ((1, 1), (2, 2), (1, 3)):
        df = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, day), v, None)], SCHEMA)
        upsert_batch(df, target, ["id"], None, "ts")
    assert [(x.v, x.ts.day) for x in read_current(spark, target).collect()] == [(3, 1)]
    compact(spark, target, most_files=1)
    assert [(x.v, x.ts.day) for x in read_current(spark, target).collect()] == [(3, 1)]


def test_back_and_forth(spark, tmp_path):
    """A value that returns to an earlier one is news."""
    target = str(tmp_path / "t")
    for v in (1, 2, 1):
        upsert_batch(spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1), v, None)], SCHEMA), target, ["id"], None, "ts")
    assert [x.v for x in read_current(spark, target).collect()] == [1]


def test_nothing_and_clashing_names(spark, tmp_path):
    target = str(tmp_path / "t")
    assert read_current(spark, target) is None and compact(spark, target) == []
    upsert_batch(spark.createDataFrame([], SCHEMA), target, ["id"])
    assert read_current(spark, target) is None
    with pytest.raises(ValueError, match="cairn_version"):
        upsert_batch(spark.range(1).withColumn("cairn_version", F.lit(1)), target, ["id"])


def test_a_lost_checkpoint_adds_no_versions(spark, tmp_path):
    item = StructType.fromDDL("id BIGINT, ts TIMESTAMP_NTZ, v STRING")
    (tmp_path / "land").mkdir()
    for day in (1, 2):
        records = [{"id": day * 10 + i, "ts": f"2024-01-0{day}T00:00:00", "v": "x"} for i in range(5)]
        (tmp_path / "land" / f"{day}.json").write_text(json.dumps({"data": records}) + "\n")
    for checkpoint in ("a", "b"):
        args = (f"{tmp_path}/land", item, f"{tmp_path}/t", f"{tmp_path}/{checkpoint}", ["id"])
        ingest_stream(spark, *args, event_time="ts", max_files_per_trigger=1).awaitTermination()
        assert spark.read.parquet(f"{tmp_path}/t").count() == 10
    assert read_current(spark, f"{tmp_path}/t").count() == 10


def test_dates_are_compacted_several_at_once(spark, tmp_path, monkeypatch):
    """Nine dates and rows without one: the versions that can still be read stay, in two
    rounds."""
    from cairn.streaming import ingest

    target = str(tmp_path / "t")
    for v in (1, 2):
        rows = [(i, "a", dt.datetime(2024, 1, 1 + i % 9) if i % 10 else None, v * (i % 3), None) for i in range(40)] + [(None, "n", None, 1, None)]
        upsert_batch(spark.createDataFrame(rows, SCHEMA), target, ["id"], None, "ts")
    moved = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 9), 7, None)], SCHEMA)
    upsert_batch(moved, target, ["id"], None, "ts")
    before, rounds, store = _current(spark, target), [], ingest.materialize
    monkeypatch.setattr(ingest, "materialize", lambda df, name: (rounds.append(name), store(df, name))[1])
    assert len(compact(spark, target, most_files=0)) == 10
    assert rounds == ["compacted"] * 2
    assert _current(spark, target) == before and len(before) == 41
    log = spark.read.parquet(target)
    assert log.count() == 42  # the moved key's version under its old date stays, too
    assert set(files_by_date(log).values()) == {1}
