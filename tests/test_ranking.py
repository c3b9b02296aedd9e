"""distributed_ntile / global_row_number against Spark's own single-task window."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cairn.operators.ranking import distributed_ntile, global_row_number


@pytest.mark.parametrize("n,k,parts", [(0, 5, 4), (1, 5, 4), (3, 5, 4), (5, 5, 2), (7, 5, 3), (103, 5, 4), (250, 7, 16), (64, 3, 1)])
def test_ntile_equals_window_ntile(spark, n, k, parts):
    rnd = random.Random(n * 31 + k)
    rows = [(i, rnd.choice([None, rnd.randint(0, 9)])) for i in range(n)]
    df = spark.createDataFrame(rows, "id BIGINT, v INT")
    order = [F.col("v").asc_nulls_last(), F.col("id").asc()]
    got = distributed_ntile(df, k, order, "b", num_partitions=parts)
    want = df.withColumn("b", F.ntile(k).over(Window.orderBy(*order)))
    assert sorted(got.collect()) == sorted(want.collect())


def test_ntile_heavy_value_is_spread(spark):
    # one value holds half of the rows; ties are split by the id tiebreak
    rows = [(i, 1 if i % 2 else i) for i in range(400)]
    df = spark.createDataFrame(rows, "id BIGINT, v BIGINT")
    order = [F.col("v").desc_nulls_first(), F.col("id").asc()]
    got = distributed_ntile(df, 5, order, "b", num_partitions=8)
    want = df.withColumn("b", F.ntile(5).over(Window.orderBy(*order)))
    assert sorted(got.collect()) == sorted(want.collect())


def test_global_row_number_is_a_permutation(spark):
    df = spark.range(1000).withColumn("v", (F.col("id") * 7919) % 1000)
    numbered, total = global_row_number(df, [F.col("v"), F.col("id")], "rn", num_partitions=6)
    assert total == 1000
    rows = numbered.orderBy("rn").collect()
    assert [r.rn for r in rows] == list(range(1, 1001))
    assert [r.v for r in rows] == sorted(r.v for r in rows)


def test_no_single_partition_exchange(spark):
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    out = distributed_ntile(df, 5, [F.col("v"), F.col("id")], "b", num_partitions=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
