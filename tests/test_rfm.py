"""RFM on hand-written rows: the traps listed in the survey."""

import datetime as dt
from decimal import Decimal

import pytest

from cairn.plans.rfm import OUTPUT_COLUMNS, rfm_analysis, rfm_segment
from pyspark.sql import functions as F

D = dt.datetime


def _df(spark, rows):
    return spark.createDataFrame(rows, "cust BIGINT, d TIMESTAMP_NTZ, amt DECIMAL(18,2), id BIGINT")


def test_columns_and_null_customer(spark):
    rows = [
        (1, D(2024, 1, 1), Decimal("10.00"), 1),
        (1, D(2024, 1, 5), Decimal("20.00"), 2),
        (None, D(2024, 1, 3), Decimal("5.00"), 3),
        (2, None, Decimal("7.00"), 4),  # no date: dropped
        (2, D(2023, 12, 1), None, 5),
    ]
    out = rfm_analysis(_df(spark, rows), "cust", "d", "amt", as_of="2024-01-10", tiebreak="id")
    assert out.columns == OUTPUT_COLUMNS
    got = {r.CUSTOMER_ID: r for r in out.collect()}
    assert set(got) == {1, 2, None}
    assert got[1].FREQUENCY == 2 and got[1].MONETARY == Decimal("30.00")
    assert got[1].AMOUNT_LAST_40D == Decimal("20.00") and got[1].RECENCY == 5
    assert got[None].FREQUENCY == 0  # COUNT(customer) of the NULL group
    assert got[None].AMOUNT_LAST_40D is None and got[None].TOTAL_MONETARY_40D is None
    assert got[2].MONETARY is None and got[2].AMOUNT_LAST_40D is None
    assert got[2].MEAN_MONETARY_40D is None


def test_latest_amount_tiebreak_same_day(spark):
    rows = [(1, D(2024, 1, 5), Decimal("1.00"), 10), (1, D(2024, 1, 5), Decimal("2.00"), 11)]
    out = rfm_analysis(_df(spark, rows), "cust", "d", "amt", as_of="2024-01-10", tiebreak="id")
    assert out.collect()[0].AMOUNT_LAST_40D == Decimal("2.00")


@pytest.mark.parametrize("n", [3, 5, 7])
def test_bucket_counts(spark, n):
    rows = [(i, D(2024, 1, 1 + i), Decimal(i + 1), i) for i in range(n)]
    out = rfm_analysis(_df(spark, rows), "cust", "d", "amt", as_of="2024-02-01", tiebreak="id").collect()
    ms = sorted(r.MONETARY_SCORE for r in out)
    q, r = divmod(n, 5)
    expected = []
    for b in range(1, 6):
        expected += [b] * (q + (1 if b <= r else 0))
    assert ms == expected
    # most recent customer gets the highest recency score
    latest = max(out, key=lambda r: r.LASTBUY)
    assert latest.RECENCY_SCORE == max(r.RECENCY_SCORE for r in out)


def test_segment_table(spark):
    cases = [
        (5, 1.5, "New Customers"), (5, 2.5, "Potential Loyalist"), (5, 3.0, "Champions"),
        (4, 1.0, "Promising"), (4, 2.0, "Potential Loyalist"), (4, 4.5, "Loyal Customer"),
        (3, 2.0, "Needs Attention"), (3, 2.5, "Loyal Customer"), (3, 3.0, "About to Sleep"),
        (3, 3.5, "Loyal Customer"), (2, 2.0, "Hibernating"), (1, 4.0, "At Risk"),
        (2, 4.5, "Cannot Lose Them"), (None, 3.0, "Categoria não encontrada"),
    ]
    df = spark.createDataFrame(cases, "r INT, m DOUBLE, want STRING")
    got = df.select(rfm_segment(F.col("r"), F.col("m")).alias("seg"), "want").collect()
    assert all(r.seg == r.want for r in got), got


def test_as_of_window_limits_rows(spark):
    rows = [
        (1, D(2022, 1, 1), Decimal("100.00"), 1),  # outside one year
        (1, D(2023, 11, 20), Decimal("10.00"), 2),  # inside the year, outside 40 days
        (1, D(2024, 1, 5), Decimal("20.00"), 3),   # inside 40 days
    ]
    out = rfm_analysis(
        _df(spark, rows), "cust", "d", "amt", as_of="2024-01-10", tiebreak="id", window="as_of"
    ).collect()[0]
    assert out.FREQUENCY == 2 and out.MONETARY == Decimal("30.00")
    assert out.TOTAL_MONETARY_40D == Decimal("20.00")


def test_plan_has_no_single_partition(spark):
    rows = [(i % 13, D(2024, 1, 1 + i % 20), Decimal(i), i) for i in range(200)]
    out = rfm_analysis(_df(spark, rows), "cust", "d", "amt", as_of="2024-02-01", tiebreak="id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_hot_customer_matches_window_ntile(spark):
    """One customer holds a third of all rows; scores equal the single-task window."""
    from pyspark.sql import Window

    rows = []
    for i in range(600):
        cust = 0 if i % 3 == 0 else 1 + (i * 7) % 97
        rows.append((cust, D(2024, 1, 1 + i % 28), Decimal(i % 50 + 1), i))
    df = _df(spark, rows)
    out = rfm_analysis(df, "cust", "d", "amt", as_of="2024-02-01", tiebreak="id")
    base = (
        df.groupBy("cust")
        .agg(F.count("cust").alias("f"), F.sum("amt").alias("m"), F.max("d").alias("last"))
        .withColumn("r", F.datediff(F.lit("2024-02-01").cast("date"), F.col("last").cast("date")))
    )
    want = base.select(
        F.col("cust").alias("CUSTOMER_ID"),
        F.ntile(5).over(Window.orderBy(F.col("m").asc_nulls_last(), F.col("cust").asc_nulls_last())).alias("M"),
        F.ntile(5).over(Window.orderBy(F.col("f").asc_nulls_last(), F.col("cust").asc_nulls_last())).alias("FQ"),
        F.ntile(5).over(Window.orderBy(F.col("r").desc_nulls_first(), F.col("cust").asc_nulls_last())).alias("R"),
    )
    got = {r.CUSTOMER_ID: (r.MONETARY_SCORE, r.FREQUENCY_SCORE, r.RECENCY_SCORE) for r in out.collect()}
    assert got == {r.CUSTOMER_ID: (r.M, r.FQ, r.R) for r in want.collect()}
    assert dict((r.CUSTOMER_ID, r.FREQUENCY) for r in out.collect())[0] == 200
