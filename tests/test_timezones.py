"""Timestamp semantics do not depend on the session time zone."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cairn.operators.coerce import coerce_schema
from cairn.streaming.watermark import WatermarkStore, incremental_filter, next_watermark


@pytest.fixture(params=["UTC", "America/Sao_Paulo", "Asia/Kolkata"])
def zone(spark, request):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", old)


def test_watermark_and_filter(spark, zone, tmp_dir):
    text = spark.createDataFrame(
        [("2024-12-27T10:46:28Z",), ("2024-12-27T12:46:28+03:00",), ("2024-12-27 11:00:00",), ("x",)], "u STRING"
    )
    got = next_watermark(text, "u", formats=["yyyy-MM-dd HH:mm:ss"]).collect()[0]
    assert got.last_update == "2024-12-27T11:00:00Z" and got.values_unparsed == 3  # only the listed layout
    iso = next_watermark(text, "u").collect()[0]
    assert iso.last_update == "2024-12-27T11:00:00Z"  # naive ISO-like text read as UTC
    ntz = spark.createDataFrame(
        [(dt.datetime(2024, 1, 2, 3, 4, 5),), (dt.datetime(2024, 1, 2, 3, 4, 4),)], "ts TIMESTAMP_NTZ"
    )
    assert incremental_filter(ntz, "ts", "2024-01-02T03:04:05Z").count() == 1
    assert incremental_filter(ntz, "ts", "2024-01-02T06:04:05+03:00").count() == 1
    assert incremental_filter(ntz, "ts", "2024-01-02T23:00:00Z", floor_to_day=True).count() == 2
    assert next_watermark(ntz, "ts", floor="day").collect()[0].last_update == "2024-01-02T00:00:00Z"
    store = WatermarkStore(spark, f"{tmp_dir}/state")
    store.save("s", "2024-01-02T03:04:05Z")
    assert store.load("s") == "2024-01-02T03:04:05Z"


def test_coerce_keeps_wall_clock(spark, zone):
    df = spark.createDataFrame([("2024-03-10 02:30:00",), ("2024-01-02T030405",)], "t STRING")
    got = [r.t for r in coerce_schema(df, {"t": "timestamp[ns]"}).collect()]
    assert got == [dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 1, 2, 3, 4, 5)]
