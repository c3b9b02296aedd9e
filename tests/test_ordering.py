"""The packed DECIMAL(38,0) order key sorts exactly like struct(date, tiebreak)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cairn.functions.ordering import packed_order


@pytest.mark.parametrize("ts_type", ["timestamp_ntz", "timestamp", "date"])
def test_packed_matches_struct(spark, ts_type):
    rnd = random.Random(3)
    base = dt.datetime(1970, 1, 1)
    rows = []
    for i in range(300):
        t = base + dt.timedelta(microseconds=rnd.randint(-2 * 10**15, 2 * 10**15))
        if i % 7 == 0 and rows:
            t = rows[-1][0]  # same instant, tiebreak decides
        tb = rnd.choice([None, rnd.randint(-(2**63), 2**63 - 1), rnd.randint(-5, 5)])
        rows.append((t, tb))
    df = spark.createDataFrame(rows, "t TIMESTAMP_NTZ, tb BIGINT").withColumn("t", F.col("t").cast(ts_type))
    packed = packed_order(F.col("t"), ts_type, F.col("tb"), "bigint")
    got = [tuple(r) for r in df.orderBy(packed).select("t", "tb").collect()]
    want = [tuple(r) for r in df.orderBy(F.struct("t", "tb")).select("t", "tb").collect()]
    assert got == want


def test_not_packable_types():
    assert packed_order(F.col("t"), "string", None, None) is None
    assert packed_order(F.col("t"), "date", F.col("s"), "string") is None
