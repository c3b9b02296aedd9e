"""Flatten: the worked example and the JSON edge cases."""

import pytest

from cairn.functions.names import dedupe_names, normalize_name
from cairn.operators.columns import prepare_columns
from cairn.operators.flatten import discover_json_columns, discover_keys, flatten_columns


def test_worked_example(spark):
    value = (
        '{"Value":"Nine","Timestamp":"2021-11-05T08:00:01.250000Z",'
        '"Source":"FORM","Source ID":"row:17;try:2"}'
    )
    df = spark.createDataFrame(
        [(value, "x", "y", 1)], "PROPERTY_HOME_OFFICE STRING, DROP_ME STRING, TMP_A STRING, ID INT"
    )
    df = prepare_columns(df, ["DROP_ME"], ["TMP_"], ["PROPERTY_"])
    cols = discover_json_columns(df)
    assert cols == ["HOME_OFFICE"]
    out = flatten_columns(df, None)
    assert out.columns == [
        "HOME_OFFICE__SOURCE", "HOME_OFFICE__SOURCE_ID", "HOME_OFFICE__TIMESTAMP",
        "HOME_OFFICE__VALUE", "ID",
    ]
    row = out.collect()[0]
    assert row.HOME_OFFICE__SOURCE_ID == "row:17;try:2"
    assert row.HOME_OFFICE__VALUE == "Nine"
    assert dict(out.dtypes)["HOME_OFFICE__VALUE"] == "string"


EDGE = [
    ('{"a": 1, "b": "x"}',),
    ("{}",),
    ('{"a": {"n": 1}, "c": null, "d": true, "e": 1.5}',),
    (None,),
    ('{"key with space": 1, "dot.key": 2, "k\\"q": 3}',),
]


def test_edge_objects(spark):
    df = spark.createDataFrame(EDGE, "c STRING")
    keys, bad, seen = discover_keys(df, ["c"])
    assert keys["c"] == sorted(["a", "b", "c", "d", "e", "key with space", "dot.key", 'k"q'])
    assert bad == {"c": False} and seen == {"c": True}
    out = flatten_columns(df, ["c"])
    got = {k: v for k, v in out.collect()[2].asDict().items()}
    assert got["C__A"] == '{"n":1}'
    assert got["C__C"] is None
    assert got["C__D"] == "true"
    assert "C__KEY_WITH_SPACE" in out.columns and "C__DOT_KEY" in out.columns and "C__K_Q" in out.columns


@pytest.mark.parametrize("junk", ["[1, 2]", "5", "not json"])
def test_non_object_keeps_column(spark, junk):
    df = spark.createDataFrame([('{"a": 1}',), (junk,)], "c STRING")
    kept = flatten_columns(df, ["c"], on_invalid="keep")
    assert kept.columns == ["c"]
    nulled = flatten_columns(df, ["c"], on_invalid="null")
    assert nulled.columns == ["C__A"]
    assert sorted((r.C__A is None) for r in nulled.collect()) == [False, True]


def test_all_null_column_kept_and_empty_dropped(spark):
    df = spark.createDataFrame([(None, "{}", 1)], "n STRING, e STRING, i INT")
    out = flatten_columns(df, ["n", "e"])
    assert out.columns == ["n", "i"]


def test_explicit_keys_skip_discovery_and_guard(spark):
    df = spark.createDataFrame([('{"a": 1, "b": 2}',)], "c STRING")
    out = flatten_columns(df, ["c"], keys={"c": ["b"]}, uppercase=False)
    assert out.columns == ["c__b"] and out.collect()[0][0] == "2"
    with pytest.raises(ValueError):
        flatten_columns(df, ["c"], max_columns=1)


def test_name_rules():
    assert normalize_name("a b@c#d$e%f^g&h*i(j)k-l+m=n{o}p[q]r:s;t'u\"v|w\\x<y>z,1.2/3?4!5~6`7") == (
        "a_b_c_d_e_f_g_h_i_j_k_l_m_n_o_p_q_r_s_t_u_v_w_x_y_z_1_2_3_4_5_6_7"
    )
    assert dedupe_names(["A", "a", "A", "b"]) == ["A", "a_2", "A_3", "b"]


def test_colliding_keys(spark):
    df = spark.createDataFrame([('{"x y": 1, "x-y": 2, "X_Y": 3}',)], "c STRING")
    out = flatten_columns(df, ["c"])
    assert len(set(n.lower() for n in out.columns)) == 3
