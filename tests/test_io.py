"""Sources, sinks, pages, watermarks, objects, streaming and step chains."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cairn.operators.text import extract_text
from cairn.plans.steps import run_steps
from cairn.sinks.writers import create_view, save_table, write_by_date, write_objects
from cairn.sources.files import objects_to_rows, read_file, read_folder, read_objects
from cairn.sources.pages import page_completeness_a, page_completeness_b, read_listing, read_pages
from cairn.sources.tables import list_tables, read_sql, to_named_markers
from cairn.streaming.ingest import ingest_stream, read_current
from cairn.streaming.watermark import WatermarkStore, incremental_filter, next_watermark


def _write(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as fh:
        fh.write(text)


def test_pages_edge_shape_a(spark, tmp_dir):
    item = "id BIGINT, attributes STRUCT<updated_at: STRING>"
    _write(f"{tmp_dir}/p/1.json", json.dumps({"data": [
        {"id": 1, "attributes": {"updated_at": "2024-12-27T10:46:28Z"}},
        {"id": 2, "attributes": {"updated_at": "2024-12-27T12:46:28+03:00"}},
    ], "meta": {"total": 4}}) + "\n")
    _write(f"{tmp_dir}/p/2.json", json.dumps({"data": [], "meta": {"total": 4}}) + "\n")
    _write(f"{tmp_dir}/p/3.json", json.dumps({"data": [
        {"id": 3, "attributes": {"updated_at": "bad"}}], "meta": {"total": 4}}) + "\n")
    rows = read_pages(spark, f"{tmp_dir}/p", "data", item_schema=item)
    assert rows.count() == 3
    wm = next_watermark(rows.select("id", F.col("attributes.updated_at").alias("u")), "u").collect()[0]
    # +03:00 is 09:46 UTC, so the Z value is the latest; the bad value is reported
    assert wm.last_update == "2024-12-27T10:46:28Z" and wm.values_unparsed == 1
    pages = spark.read.schema(f"data ARRAY<STRUCT<{item}>>, meta STRUCT<total: BIGINT>").json(f"{tmp_dir}/p")
    c = page_completeness_a(pages).collect()[0]
    assert (c.records, c.expected, c.complete) == (3, 4, False)  # a page is missing


def test_pages_shape_b_completeness(spark, tmp_dir):
    for tenant, page, total in [("10", 1, 2), ("10", 2, 2), ("11", 1, 3)]:
        _write(f"{tmp_dir}/b/{tenant}_{page}.json", json.dumps({
            "items": [{"Nome": f"n{page}"}], "currentPage": page, "totalPages": total,
            "hasNext": page < total, "tenant": tenant}) + "\n")
    pages = spark.read.json(f"{tmp_dir}/b")
    got = {r.tenant: r.complete for r in page_completeness_b(pages).collect()}
    assert got == {"10": True, "11": False}
    rows = read_pages(spark, f"{tmp_dir}/b", "items", item_schema="Nome STRING", keep=("tenant",))
    assert rows.columns == ["tenant", "Nome"] and rows.count() == 3


def test_watermark_store_and_filter(spark, tmp_dir):
    store = WatermarkStore(spark, f"{tmp_dir}/state")
    assert store.load("alunos") is None
    store.save("alunos", "1999-09-09T00:00:00Z")
    store.save("alunos", "2024-01-02T03:04:05Z")
    store.save("cursos", "2020-01-01T00:00:00Z")
    assert store.load("alunos") == "2024-01-02T03:04:05Z"
    df = spark.createDataFrame(
        [(1, "2024-01-02 03:04:05"), (2, "2024-01-02 03:04:04"), (3, "2024-01-01 00:00:00")],
        "id INT, ts STRING",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert incremental_filter(df, "ts", store.load("alunos")).count() == 1  # inclusive
    assert incremental_filter(df, "ts", store.load("alunos"), floor_to_day=True).count() == 2
    assert incremental_filter(df, "ts", None).count() == 3
    plan = incremental_filter(df, "ts", "2024-01-02T00:00:00Z")._jdf.queryExecution().optimizedPlan().toString()
    assert ">=" in plan


def test_objects_roundtrip_and_folder(spark, tmp_dir):
    objs = spark.createDataFrame(
        [("a.b", bytearray(b"x")), ("c", bytearray(b"")), ("d", bytearray("ção".encode()))],
        "file_name STRING, file_content BINARY",
    )
    write_objects(objs, f"{tmp_dir}/obj", file_extension="html")
    back = {r.file_name: bytes(r.file_content) for r in read_objects(spark, f"{tmp_dir}/obj").collect()}
    assert back == {"a": b"x", "c": b"", "d": "ção".encode()}  # stem cut at the first dot
    _write(f"{tmp_dir}/obj/nested/e.txt", "deep")
    assert read_objects(spark, f"{tmp_dir}/obj").count() == 4
    flat = read_folder(spark, f"{tmp_dir}/obj")
    assert sorted(r.file_name for r in flat.collect()) == ["a.b.html", "c.html", "d.html"]
    dup = spark.createDataFrame([("x", "1"), ("x", "2")], "file_name STRING, file_content STRING")
    with pytest.raises(ValueError):
        write_objects(dup, f"{tmp_dir}/dup")


def test_objects_to_rows(spark, tmp_dir):
    _write(f"{tmp_dir}/rec/a.json", json.dumps([{"k": 1, "v": "x"}, {"k": 2}]))
    _write(f"{tmp_dir}/rec/b.json", json.dumps([{"k": 3, "v": "z"}]))
    rows = objects_to_rows(read_objects(spark, f"{tmp_dir}/rec"), "k INT, v STRING")
    assert sorted(map(tuple, rows.collect())) == [(1, "x"), (2, None), (3, "z")]


def test_csv_options(spark, tmp_dir):
    _write(f"{tmp_dir}/c/a.csv", "junk line\nanother\na;b\n1;x\n2;y\n")
    _write(f"{tmp_dir}/c/b.csv", "junk line\nanother\na;b\n3;z\n")
    df = read_file(spark, f"{tmp_dir}/c", "csv", delimiter=";", skip_lines=2)
    assert df.columns == ["a", "b"] and sorted(map(tuple, df.collect())) == [(1, "x"), (2, "y"), (3, "z")]
    with pytest.raises(ValueError):
        read_file(spark, f"{tmp_dir}/c", "csv", delimiter="\t")


def test_write_by_date_dynamic_overwrite(spark, tmp_dir):
    df = spark.createDataFrame(
        [(1, "2024-01-01 10:00:00"), (2, "2024-01-02 10:00:00"), (3, None)], "id INT, ts STRING"
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    write_by_date(df, f"{tmp_dir}/d", "ts")
    again = spark.createDataFrame([(4, "2024-01-02 11:00:00")], "id INT, ts STRING").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz"))
    write_by_date(again, f"{tmp_dir}/d", "ts")
    back = spark.read.parquet(f"{tmp_dir}/d")
    assert sorted(r.id for r in back.collect()) == [1, 4]  # day 2 replaced, NULL ts dropped


def test_tables_and_sql(spark):
    df = spark.range(3).withColumn("v", F.col("id") * 2)
    save_table(df, name="standardized_a")
    save_table(df, name="standardized_b")
    save_table(df, name="other_c")
    save_table(spark.table("standardized_a").filter("id > 0"), name="standardized_a")  # read while replaced
    assert spark.table("standardized_a").count() == 2
    names = list_tables(spark, "standardized_")
    assert names == ["default.standardized_a", "default.standardized_b"]
    save_table(df, name="")  # empty name: nothing written
    create_view(df, "v_nums")
    out = read_sql(spark, "SELECT * FROM v_nums WHERE id >= {{ lo }} AND v < '{{hi}}'",
                   parameters=[{"key": "lo", "value": 1}, {"key": "hi", "value": 4}])
    assert [r.id for r in out.collect()] == [1]
    assert to_named_markers("x = '{{a}}' and y = {{ b }}") == "x = :a and y = :b"
    with pytest.raises(ValueError):
        read_sql(spark)


def test_listing_and_filters(spark, tmp_dir):
    listing = {"connections": [
        {"id": "c1", "customer_id": "u1", "type": "db", "name": "a", "updated_at": "2024-01-01T00:00:00Z"},
        {"id": "c2", "customer_id": "u1", "type": "api", "name": "b", "network_config_id": "n1"},
        {"id": "c3", "customer_id": "u2", "type": "db", "name": "c"},
    ], "message": "ok"}
    _write(f"{tmp_dir}/l/list.json", json.dumps(listing, indent=1))
    rows = read_listing(spark, f"{tmp_dir}/l")
    from cairn.operators.filters import exclude_by_params, filter_by_params

    assert filter_by_params(rows, [{"key": "type", "value": "db"}]).count() == 2
    assert exclude_by_params(rows, [{"key": "customer_id", "value": "u1"}]).count() == 1


def test_extract_text_edge(spark):
    html = ("<html><head><title>T</title><style>p{}</style></head><body><!-- c -->"
            "<script>var t='</p>';</script><p>A &amp; B&nbsp;&lt;c&gt;</p>\n<div>D</div></body></html>")
    out = extract_text(spark.createDataFrame([(html,)], "html STRING")).collect()[0].text
    assert out == "A & B <c> D"


def test_stream_rerun_delivers_nothing_new(spark, tmp_dir):
    item = StructType.fromDDL("id BIGINT, v STRING")
    _write(f"{tmp_dir}/land/1.json", json.dumps({"data": [{"id": 1, "v": "a"}, {"id": 2, "v": "b"}]}) + "\n")
    args = dict(target=f"{tmp_dir}/tgt", checkpoint=f"{tmp_dir}/ck", keys=["id"])
    ingest_stream(spark, f"{tmp_dir}/land", item, **args).awaitTermination()
    _write(f"{tmp_dir}/land/2.json", json.dumps({"data": [{"id": 2, "v": "B"}, {"id": 3, "v": "c"}]}) + "\n")
    ingest_stream(spark, f"{tmp_dir}/land", item, **args).awaitTermination()
    ingest_stream(spark, f"{tmp_dir}/land", item, **args).awaitTermination()  # nothing new
    got = sorted(map(tuple, read_current(spark, f"{tmp_dir}/tgt").collect()))
    assert got == [(1, "a"), (2, "B"), (3, "c")]


def test_step_chain_errors(spark):
    with pytest.raises(KeyError):
        run_steps(spark, [{"step": "nope"}])
    with pytest.raises(KeyError):
        run_steps(spark, [{"step": "remove_columns", "input": "missing", "params": {"columns": []}}])


def test_standardize_tables_and_union_view(spark):
    from cairn.plans.standardization import standardize_tables, standardized_union_view

    spark.sql("CREATE DATABASE IF NOT EXISTS crm")
    spark.createDataFrame([(1, "a")], "id INT, name STRING").write.mode("overwrite").saveAsTable("crm.people")
    spark.createDataFrame([(2, "b")], "pid INT, nm STRING").write.mode("overwrite").saveAsTable("crm.leads")
    mapping = [
        {"its_manual_registry": False, "source": "crm.people",
         "map": {"STD_ID": {"value": "id", "is_column": True}, "STD_SRC": {"value": "people", "is_column": False}}},
        {"its_manual_registry": False, "source": "crm.leads",
         "map": {"STD_ID": {"value": "pid", "is_column": True}, "STD_SRC": {"value": "leads", "is_column": False}}},
        {"its_manual_registry": True, "source": "crm.manual", "map": {}},
    ]
    made = standardize_tables(spark, mapping)
    assert set(made) == {"CRM.STANDARDIZED_PEOPLE", "CRM.STANDARDIZED_LEADS"}
    view = standardized_union_view(spark, "std_all", "standardized_", database="crm")
    assert sorted(map(tuple, view.collect())) == [(1, "people"), (2, "leads")]
    with pytest.raises(FileNotFoundError):
        standardize_tables(spark, "/nonexistent/mapping.json")


def test_extract_increment(spark, tmp_dir):
    from cairn.plans.extraction import extract_increment, split_tenants

    assert split_tenants(" 10, 11 ,,12") == ["10", "11", "12"]
    schema = {"CursoID": "int64", "Nome": "string", "Sigla": "string", "Excluido": "int8",
              "DataExtracao": "timestamp[ns]", "CodCliSponte": "int64"}
    page = {"items": [
        {"CursoID": "1", "Nome": "A<b>", "Sigla": "x:y", "Excluido": "0", "DataExtracao": "2024-01-02 10:00:00", "CodCliSponte": "10"},
        {"CursoID": "2", "Nome": "B", "Sigla": "s", "Excluido": "300", "DataExtracao": "2024-01-03T101010", "CodCliSponte": "10"},
        {"CursoID": "3", "Nome": "C", "Sigla": "s", "Excluido": "1", "DataExtracao": None, "CodCliSponte": "10"},
    ], "currentPage": 1, "totalPages": 1, "hasNext": False}
    _write(f"{tmp_dir}/cursos/p1.json", json.dumps(page) + "\n")
    state = WatermarkStore(spark, f"{tmp_dir}/state")
    wm = extract_increment(spark, f"{tmp_dir}/cursos", "cursos", schema, f"{tmp_dir}/out", state, "DataExtracao")
    assert wm.collect()[0].last_update == "2024-01-03T00:00:00Z"
    assert state.load("cursos") == "2024-01-03T00:00:00Z"
    out = spark.read.parquet(f"{tmp_dir}/out")
    rows = {r.CursoID: r for r in out.collect()}
    assert set(rows) == {1, 2}  # the row without a timestamp has no date
    assert rows[1].Nome == "Ab" and rows[1].Sigla == "xy" and rows[2].Excluido is None
    # second run: only rows on or after the saved day are re-landed
    wm2 = extract_increment(spark, f"{tmp_dir}/cursos", "cursos", schema, f"{tmp_dir}/out", state, "DataExtracao")
    assert wm2.collect()[0].last_update == "2024-01-03T00:00:00Z"
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 2
    # a missing page stops the run before anything moves
    gap = dict(page, currentPage=3, totalPages=3)
    _write(f"{tmp_dir}/cursos/p3.json", json.dumps(gap) + "\n")
    with pytest.raises(RuntimeError, match="incomplete"):
        extract_increment(spark, f"{tmp_dir}/cursos", "cursos", schema, f"{tmp_dir}/out", state, "DataExtracao")
    assert state.load("cursos") == "2024-01-03T00:00:00Z"


@pytest.mark.parametrize("key", [(), ("id",)])
def test_extract_increment_keeps_the_morning(spark, tmp_dir, key):
    from cairn.plans.extraction import extract_increment

    schema = {"id": "int64", "name": "string", "at": "timestamp[ns]"}
    state = WatermarkStore(spark, f"{tmp_dir}/state")
    runs = [
        [("1", "a", "2024-01-01 23:00:00"), ("2", "b", "2024-01-02 08:00:00"), ("3", "c", "2024-01-02 11:00:00"), (None, "n", "2024-01-02 11:00:00")],
        # asked from 11:00: the rows of that second again, one of them changed, and later ones
        [("3", "C", "2024-01-02 11:00:00"), (None, "n", "2024-01-02 11:00:00"), ("4", "d", "2024-01-02 15:00:00"), ("5", "e", "2024-01-03 01:00:00")],
    ]
    for n, rows in enumerate(runs):
        page = {"items": [dict(zip(schema, r)) for r in rows], "currentPage": 1, "totalPages": 1}
        _write(f"{tmp_dir}/landing{n}/p.json", json.dumps(page) + "\n")
        extract_increment(spark, f"{tmp_dir}/landing{n}", "e", schema, f"{tmp_dir}/out", state, "at", floor_to_day=False, key=key)
    got = sorted((r.id or 0, r.name) for r in spark.read.parquet(f"{tmp_dir}/out").collect())
    third = [(3, "C")] if key else [(3, "C"), (3, "c")]
    assert got == [(0, "n"), (1, "a"), (2, "b"), *third, (4, "d"), (5, "e")]
    assert state.load("e") == "2024-01-03T01:00:00Z"


def test_load_file_to_table(spark, tmp_dir):
    from cairn.sinks.writers import load_file_to_table

    _write(f"{tmp_dir}/f/a.csv", "a|b\n1|x\n")
    load_file_to_table(spark, "loaded_csv", f"{tmp_dir}/f", "csv", delimiter="|")
    load_file_to_table(spark, "loaded_csv", f"{tmp_dir}/f", "csv", delimiter="|")
    assert [tuple(r) for r in spark.table("loaded_csv").collect()] == [(1, "x")]


def test_csv_skip_lines_with_schema(spark, tmp_dir):
    _write(f"{tmp_dir}/cs/a.csv", "junk\na|b\n1|x\n2|y\n")
    _write(f"{tmp_dir}/cs/b.csv", "junk\na|b\n3|z\n")
    df = read_file(spark, f"{tmp_dir}/cs", "csv", delimiter="|", skip_lines=1, schema="a INT, b STRING")
    assert sorted(map(tuple, df.collect())) == [(1, "x"), (2, "y"), (3, "z")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "PythonRDD" not in plan


def test_lookup_and_user_steps(spark, tmp_dir):
    from cairn.operators.filters import lookup_one
    from cairn.plans.steps import STEPS, register_sink, register_source, register_transform

    jobs = spark.createDataFrame(
        [("u1", "pipe-a", "job-1"), ("u1", "pipe-b", "job-2"), ("u2", "pipe-a", "job-3")],
        "owner STRING, flow STRING, job_uuid STRING",
    )
    hit = lookup_one(jobs, {"owner": "u1", "flow": "pipe-a"}, ["job_uuid"]).limit(2).collect()
    assert [r.job_uuid for r in hit] == ["job-1"]

    written = {}
    register_source("numbers", lambda spark, n: spark.range(n))
    register_transform("double", lambda df, col: df.withColumn(col, df[col] * 2))
    register_sink("remember", lambda df, key: written.__setitem__(key, sorted(r.id for r in df.collect())))
    run_steps(spark, [
        {"step": "numbers", "params": {"n": 3}, "output": "n"},
        {"step": "double", "input": "n", "params": {"col": "id"}, "output": "d"},
        {"step": "remember", "input": "d", "params": {"key": "out"}},
    ])
    assert written == {"out": [0, 2, 4]}
    for name in ("numbers", "double", "remember"):
        STEPS.pop(name)


def test_read_sql_identifier_and_file(spark, tmp_dir):
    spark.range(5).createOrReplaceTempView("nums_for_sql")
    out = read_sql(spark, "SELECT count(*) AS n FROM IDENTIFIER({{t}}) WHERE id < {{lim}}",
                   parameters={"t": "nums_for_sql", "lim": 3})
    assert out.collect()[0].n == 3
    _write(f"{tmp_dir}/q.sql", "SELECT max(id) AS m FROM nums_for_sql WHERE id <= {{hi}}")
    assert read_sql(spark, sql_file=f"{tmp_dir}/q.sql", parameters=[{"key": "hi", "value": 2}]).collect()[0].m == 2


def test_steps_file(spark, tmp_dir):
    from cairn.plans.steps import run_steps_file

    spark.range(4).write.parquet(f"{tmp_dir}/src")
    steps = [
        {"step": "read_file", "params": {"path": f"{tmp_dir}/src", "fmt": "parquet"}, "output": "a"},
        {"step": "filter_by_params", "input": "a", "params": {"params": {"id": [1, 2]}}, "output": "b"},
        {"step": "save_table", "input": "b", "params": {"path": f"{tmp_dir}/dst"}},
    ]
    _write(f"{tmp_dir}/steps.json", json.dumps(steps))
    out = run_steps_file(spark, f"{tmp_dir}/steps.json")
    assert set(out) == {"a", "b"}
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_dir}/dst").collect()) == [1, 2]
