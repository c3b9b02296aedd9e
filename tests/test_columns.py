"""Column operators, cleaning, coercion, reshaping and filters on edge fixtures."""

import datetime as dt

import pytest

from cairn.operators.coerce import coerce_schema
from cairn.operators.columns import (
    clean_strings, drop_by_prefix, remove_columns, rename_columns, strip_prefixes,
    stripped_names, text_transform,
)
from cairn.operators.filters import exclude_by_params, filter_by_params
from cairn.operators.reshape import (
    StandardMapping, concat_by_name, standardize, standardized_table_name, union_all,
    unpivot_columns,
)


def test_strip_prefixes_rules():
    # longest first; every occurrence of the prefix in a matching name goes
    assert stripped_names(["ab_x", "a_b", "ab_ab_y", "zz"], ["a", "ab_"]) == ["x", "_b", "y", "zz"]


def test_names_edge(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "P_A INT, P_P_B INT, Q INT, P_ INT")
    with pytest.raises(ValueError):
        strip_prefixes(df, ["P_"])  # P_ would become empty
    out = strip_prefixes(df.drop("P_"), ["P_"])
    assert out.columns == ["A", "B", "Q"]
    assert drop_by_prefix(df, ["P_"]).columns == ["Q"]
    with pytest.raises(ValueError):
        remove_columns(df, ["nope"])
    assert remove_columns(df, ["nope", "Q"], ignore_missing=True).columns == ["P_A", "P_P_B", "P_"]


def test_rename_sequential_and_errors(spark):
    df = spark.createDataFrame([(1, 2)], "a INT, b INT")
    assert rename_columns(df, [("a", "x"), ("x", "y")]).columns == ["y", "b"]
    with pytest.raises(ValueError):
        rename_columns(df, [("zz", "x")])
    with pytest.raises(ValueError):
        rename_columns(df, [("a", "b")])


def test_text_transform_chain(spark):
    df = spark.createDataFrame([("  MiXed  ",)], "s STRING")
    out = text_transform(df, [("s", "trim"), ("s", "lower")]).collect()[0].s
    assert out == "mixed"
    with pytest.raises(ValueError):
        text_transform(df, [("s", "reverse")])


def test_clean_edge(spark):
    raw = 'a<b>c:d"e/f\\g|h?i*j\x01k\x1fl\x7fm ção'
    df = spark.createDataFrame([(raw, 5)], "c STRING, n INT")
    assert clean_strings(df).collect()[0].c == "abcdefghijklm ção"


def test_coerce_edge(spark):
    rows = [("3", " 4 ", "3.5", "2024-01-02 03:04:05", "x"),
            ("x", "300", "1e2", "2024-01-02T030405", "y"),
            ("7", "-5", "abc", "02/01/2024 03:04", None),
            (None, None, None, "2024-01-02T03:04:05.123456", None),
            ("8", "1", "2", "garbage", None)]
    df = spark.createDataFrame(rows, "a STRING, b STRING, c STRING, t STRING, extra STRING")
    out = coerce_schema(df, {"a": "int64", "b": "int8", "c": "float64", "t": "timestamp[ns]", "m": "string"})
    assert out.columns == ["a", "b", "c", "t", "m"]
    got = [tuple(r) for r in out.collect()]
    assert got[0][:3] == (3, 4, 3.5) and got[0][3] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got[1][:3] == (None, None, 100.0) and got[1][3] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got[2][:3] == (7, -5, None) and got[2][3] == dt.datetime(2024, 1, 2, 3, 4)
    assert got[3][3] == dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    assert got[4][3] is None
    assert dict(out.dtypes) == {"a": "bigint", "b": "tinyint", "c": "double", "t": "timestamp_ntz", "m": "string"}
    with pytest.raises(ValueError):
        coerce_schema(df, {"m": "string"}, strict=True)
    with pytest.raises(ValueError):
        coerce_schema(df, {"a": "decimal"})


def test_unpivot_edge(spark):
    df = spark.createDataFrame([(1, 10, None, "s"), (2, None, None, "t")], "id INT, a INT, b INT, s STRING")
    dropped = unpivot_columns(df.drop("s"), ["a", "b"], "name", "value")
    assert sorted(map(tuple, dropped.collect())) == [(1, "a", 10)]
    kept = unpivot_columns(df.drop("s"), ["a", "b"], "name", "value", include_nulls=True)
    assert kept.count() == 4
    mixed = unpivot_columns(df, ["a", "s"], "name", "value", value_type="string", include_nulls=True)
    assert mixed.filter("name = 's'").count() == 2
    assert "s" not in mixed.columns[:1]


def test_standardize_rules(spark):
    df = spark.createDataFrame([(1, "x")], "id INT, name STRING")
    m = StandardMapping.from_dict({
        "its_manual_registry": False, "source": "crm.people",
        "map": {"STD_ID": {"value": "id", "is_column": True}, "STD_C": {"value": "k", "is_column": False},
                "STD_N": {"value": 0, "is_column": False}},
    })
    out = standardize(df, m.columns).collect()[0]
    assert tuple(out) == (1, "k", None)
    assert standardized_table_name(m.source) == "CRM.STANDARDIZED_PEOPLE"


def test_unions(spark):
    a = spark.createDataFrame([(1, "a")], "x INT, y STRING")
    b = spark.createDataFrame([("b", 2)], "y STRING, z INT")
    out = concat_by_name([a, b])
    assert out.columns == ["x", "y", "z"] and out.count() == 2
    assert union_all([a, a]).count() == 2
    with pytest.raises(ValueError):
        union_all([])


def test_filters(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k INT, s STRING")
    assert filter_by_params(df, [{"key": "s", "value": "a"}]).count() == 1
    assert filter_by_params(df, {"k": [1, 3]}).count() == 2
    # NULL comparison keeps the row in exclude (never deleted by accident)
    assert exclude_by_params(df, [{"key": "s", "value": "a"}]).count() == 2
    with pytest.raises(ValueError):
        exclude_by_params(df, [])
