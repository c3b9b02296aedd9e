"""Rows that were once lost or answered wrongly."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cairn.operators.coerce import coerce_schema
from cairn.operators.columns import clean_strings
from cairn.operators.filters import lookup_one
from cairn.operators.flatten import flatten_columns
from cairn.operators.latest import attach_key_stats, latest_per_key
from cairn.operators.merge import merge_upsert
from cairn.operators.text import extract_text
from cairn.plans.rfm import rfm_base
from cairn.sinks.writers import write_by_date, write_objects
from cairn.sources.files import read_file
from cairn.sources.tables import read_sql
from cairn.operators.reshape import unpivot_columns
from cairn.plans.rfm import SEGMENT_RULES, rfm_segment


def test_iso_variants_are_read(spark):
    given = {
        "2024-01-15T10:00:05Z": dt.datetime(2024, 1, 15, 10, 0, 5),
        "2024-01-15T10:00:05+02:00": dt.datetime(2024, 1, 15, 8, 0, 5),
        "2024-01-02 03:04:05.5": dt.datetime(2024, 1, 2, 3, 4, 5, 500_000),
        "2024-01-02T03:04": dt.datetime(2024, 1, 2, 3, 4),
        "2024-01-02T03:04:05.123456789": dt.datetime(2024, 1, 2, 3, 4, 5, 123_456),
        "junk": None,
    }
    df = spark.createDataFrame([(x, x) for x in given], "id string, t string")
    got = coerce_schema(df, {"id": "string", "t": "timestamp[ns]"}).collect()
    assert {r.id: r.t for r in got} == given


def test_null_keys_have_statistics(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "k string, v double")
    got = sorted((r.k or "", r.v, r["sum"], r["rows"]) for r in attach_key_stats(df, ["k"], "v").collect())
    assert got == [("", 1.0, 4.0, 2), ("", 3.0, 4.0, 2), ("a", 2.0, 2.0, 1)]


def test_unpivot_matches_names_without_case(spark):
    out = unpivot_columns(spark.createDataFrame([(1, 2)], "A int, i int"), ["a"], "n", "v")
    assert out.columns == ["i", "n", "v"] and [tuple(r) for r in out.collect()] == [(2, "a", 1)]


def test_every_score_has_a_segment(spark):
    scores = [(r, m / 2) for r in range(1, 6) for m in range(2, 11)] + [(None, 2.0)]
    df = spark.createDataFrame(scores, "r int, m double")
    got = {(x.r, x.m): x.s for x in df.select("r", "m", rfm_segment(df.r, df.m).alias("s")).collect()}
    labels = {label for _, bounds in SEGMENT_RULES for *_, label in bounds}
    assert {v for k, v in got.items() if k[0]} == labels and got[None, 2.0] not in labels
    assert got[3, 2.5] == got[3, 3.5] == got[4, 3.0] and got[3, 3.0] != got[3, 2.5] and got[1, 4.5] == got[2, 5.0]


def test_small_amounts_keep_their_scale(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1), Decimal("0.0040")), (1, dt.date(2024, 1, 2), Decimal("0.0015"))],
                               "c int, d date, a decimal(18,4)")
    row = rfm_base(df, "c", "d", "a", as_of="2024-02-01").first()
    assert row.MONETARY == Decimal("0.0055") and row.AMOUNT_LAST_40D == Decimal("0.0015")
    assert row.STD_MONETARY_40D == pytest.approx(0.00125, abs=1e-12)


def test_map_columns_are_carried(spark):
    df = spark.sql("SELECT 1 AS k, 1 AS t, map('a', 'x') AS m UNION ALL SELECT 1, 2, map('a', 'y')")
    assert latest_per_key(df, ["k"], ["t"]).first().m == {"a": "y"}
    assert merge_upsert(df.filter("t = 1"), df, ["k"], order_by=["t"]).first().m == {"a": "y"}


def test_given_keys_keep_other_values(spark):
    df = spark.createDataFrame([("{\"a\": 1}", "not json"), ("{}", "{\"a\": 2}")], "good string, mixed string")
    out = flatten_columns(df, ["good", "mixed"], keys={"good": ["a"], "mixed": ["a"]})
    assert out.columns == ["GOOD__A", "mixed"] and {r.mixed for r in out.collect()} == {"not json", "{\"a\": 2}"}


def test_lookup_tells_none_from_several(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "id int, v string")
    assert lookup_one(df, {"id": 1}, require=True).first().v == "a"
    for params in ({"v": "a"}, {"v": "z"}):
        with pytest.raises(LookupError):
            lookup_one(df, params, require=True)


def test_unknown_placeholder_is_an_error(spark):
    with pytest.raises(KeyError):
        read_sql(spark, "SELECT {{a}} AS a, '{{b}}' AS b", parameters={"a": 1})


def test_quotes_in_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,t\n1,"say ""hi"", ok"\n2,"two\nlines"\n')
    rows = read_file(spark, str(tmp_path), "csv", multiline=True).collect()
    assert [tuple(r) for r in rows] == [(1, 'say "hi", ok'), (2, "two\nlines")]


def test_one_timestamp_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(200_000).withColumn("ts", F.lit("2024-01-01 10:00:00").cast("timestamp_ntz"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_by_date(df, str(tmp_path / "d"), "ts")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list((tmp_path / "d" / "extract_date=2024-01-01").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "d")).count() == 200_000


def test_failures_are_counted(spark, tmp_path):
    df = spark.createDataFrame([(f"n{i % 30}", "x") for i in range(60)], "file_name string, file_content string")
    with pytest.raises(ValueError, match="^30 duplicate"):
        write_objects(df, str(tmp_path / "o"))


def test_operators_start_no_job(spark):
    """Building these plans runs nothing: no size check, no look at the data."""
    df = spark.range(100).select("id", F.col("id").cast("string").alias("s")).groupBy("id").agg(F.max("s").alias("s"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("built", "plans")
    try:
        clean_strings(df)
        coerce_schema(df, {"id": "int64", "s": "string"})
        extract_text(df, "s", "t")
        merge_upsert(df, df.limit(3), ["id"])
        assert list(tracker.getJobIdsForGroup("built")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
