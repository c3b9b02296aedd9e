"""Property tests (hypothesis): unpivot counts, flatten round trip, NTILE."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from cairn.operators.flatten import flatten_columns
from cairn.operators.ranking import distributed_ntile
from cairn.operators.reshape import unpivot_columns

SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

cells = st.one_of(st.none(), st.integers(-5, 5))


@settings(**SETTINGS)
@given(st.lists(st.tuples(cells, cells, cells), min_size=0, max_size=30))
def test_unpivot_rows_equal_non_null_cells(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id INT, a INT, b INT, c INT")
    out = unpivot_columns(df, ["a", "b", "c"], "name", "value")
    assert out.count() == sum(x is not None for r in rows for x in r)
    assert unpivot_columns(df, ["a", "b", "c"], "name", "value", include_nulls=True).count() == 3 * len(rows)


maps = st.dictionaries(
    st.text(alphabet="abcdefgh", min_size=1, max_size=4),
    st.text(alphabet="xyz 019-é", max_size=6),
    min_size=1,
    max_size=5,
)


@settings(**SETTINGS)
@given(st.lists(maps, min_size=1, max_size=8))
def test_flatten_inverts_to_json(spark, records):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(records)], "id INT, m MAP<STRING,STRING>")
    packed = df.select("id", F.to_json("m").alias("j"))
    flat = flatten_columns(packed, ["j"], uppercase=False)
    keys = sorted({k for m in records for k in m})
    assert flat.columns == [f"j__{k}" for k in keys] + ["id"]
    got = {r["id"]: {k: r[f"j__{k}"] for k in keys if r[f"j__{k}"] is not None} for r in flat.collect()}
    assert got == dict(enumerate(records))


@settings(**SETTINGS)
@given(st.integers(0, 60), st.integers(1, 9), st.integers(1, 7))
def test_ntile_matches_window(spark, n, k, parts):
    df = spark.range(n).withColumn("v", (F.col("id") * 37) % 11)
    order = [F.col("v").desc(), F.col("id").asc()]
    got = distributed_ntile(df, k, order, "b", num_partitions=parts)
    want = df.withColumn("b", F.ntile(k).over(Window.orderBy(*order)))
    assert sorted(got.collect()) == sorted(want.collect())
