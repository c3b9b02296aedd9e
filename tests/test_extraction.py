"""Landed pages: what is missing, both page shapes, records that move; CSV records of
several lines; flatten's one discovery scan."""

import csv
import json
import random

import pytest
from pyspark.sql import functions as F

from cairn.operators.flatten import flatten_columns
from cairn.plans.extraction import check_pages_complete, extract_increment
from cairn.sinks.writers import SCHEMES, _mover, _open_root, write_objects
from cairn.sources.files import read_file, read_objects
from cairn.sources.pages import missing_page_ranges
from cairn.streaming.watermark import WatermarkStore


def _land(folder, pages):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "p.json").write_text("".join(json.dumps(p) + "\n" for p in pages))
    return str(folder)


@pytest.mark.parametrize("block", [1, 3, 65_536])
def test_missing_ranges_are_those_of_a_plain_loop(spark, block):
    rng = random.Random(block)
    rows, want = [], set()
    for tenant, total in (("a", 40), ("b", 1), ("c", 25), (None, 12), ("all", 9), ("outside", 5)):
        landed = set(range(1, total + 1)) if tenant == "all" else {p for p in range(1, total + 1) if rng.random() < 0.4}
        landed = landed or {0}  # page 0 is outside: all is missing
        if tenant == "outside":
            landed = {0, 9}
        rows += [(tenant, p, total) for p in landed] * 2 + [(tenant, None, total - 1)]
        gaps = [p for p in range(1, total + 1) if p not in landed]
        for p in gaps:
            if p - 1 not in gaps:
                end = next(q for q in range(p, total + 1) if q + 1 not in gaps)
                want.add((tenant, p, end, end - p + 1))
    pages = spark.createDataFrame(rows, "tenant STRING, currentPage BIGINT, totalPages BIGINT")
    got = [tuple(r) for r in missing_page_ranges(pages, tenant="tenant", block=block).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_missing_ranges_from_a_record_total(spark):
    pages = spark.createDataFrame([(2, (230,)), (4, (230,))], "page BIGINT, meta STRUCT<total: BIGINT>")
    got = missing_page_ranges(pages, "page", F.ceil(F.col("meta.total") / 50)).orderBy("first_missing").collect()
    assert [tuple(r) for r in got] == [("all", 1, 1, 1), ("all", 3, 3, 1), ("all", 5, 5, 1)]
    empty = missing_page_ranges(pages.limit(0), "page", "meta.total")
    assert empty.collect() == []


def test_an_incomplete_landing_names_the_ranges(spark, tmp_path):
    where = _land(tmp_path / "l", [{"items": [], "currentPage": p, "totalPages": 6} for p in (1, 4)])
    with pytest.raises(RuntimeError, match="2-3.*5-6"):
        check_pages_complete(spark, where)


def _record(i, at, name="n"):
    return {"id": str(i), "type": "lead", "attributes": {"updated_at": at, "name": name}}


LEADS = {"id": "int64", "attributes.updated_at": "timestamp[ns]", "attributes.name": "string"}


def _leads(spark, tmp_path, landing, **options):
    state = WatermarkStore(spark, str(tmp_path / "state"))
    extract_increment(spark, landing, "leads", LEADS, str(tmp_path / "out"), state, "attributes.updated_at", key=("id",), shape="a", **options)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    return sorted((r.id, r.attributes__name, str(r.extract_date)) for r in rows), state.load("leads")


def test_pages_with_a_record_total(spark, tmp_path):
    first = [_record(1, "2024-01-01T10:00:00Z"), _record(2, "2024-01-02T09:00:00Z"), _record(3, "2024-01-02T10:46:28Z")]
    landing = _land(tmp_path / "l0", [{"data": first[:2], "meta": {"total": 3}}, {"data": first[2:], "meta": {"total": 3}}])
    got, mark = _leads(spark, tmp_path, landing)
    assert got == [(1, "n", "2024-01-01"), (2, "n", "2024-01-02"), (3, "n", "2024-01-02")]
    assert mark == "2024-01-02T10:46:28Z"
    # asked from the mark: record 1 has moved to another date, which leaves the first empty
    second = [_record(3, "2024-01-02T10:46:28Z"), _record(1, "2024-01-03T08:00:00Z", "m")]
    got, mark = _leads(spark, tmp_path, _land(tmp_path / "l1", [{"data": second, "meta": {"total": 2}}]))
    assert got == [(1, "m", "2024-01-03"), (2, "n", "2024-01-02"), (3, "n", "2024-01-02")]
    assert mark == "2024-01-03T08:00:00Z" and not (tmp_path / "out" / "extract_date=2024-01-01").exists()
    # a page landed twice does not hide the missing one
    again = _land(tmp_path / "l2", [{"data": second, "meta": {"total": 4}}] * 2)
    with pytest.raises(RuntimeError, match="2/4 records"):
        _leads(spark, tmp_path, again)
    # a timestamp that is none stops the run before anything is written
    bad = _land(tmp_path / "l3", [{"data": [_record(7, "soon")], "meta": {"total": 1}}])
    with pytest.raises(ValueError, match="1 values"):
        _leads(spark, tmp_path, bad)
    assert _leads(spark, tmp_path, _land(tmp_path / "l4", [{"data": [], "meta": {"total": 0}}]), require_complete=False)[0] == got


def test_part_of_a_day_keeps_the_rest_unless_asked(spark, tmp_path):
    schema = {"id": "int64", "at": "timestamp[ns]"}
    for replace, want in ((False, [1, 2, 3]), (True, [1, 3])):
        state = WatermarkStore(spark, str(tmp_path / f"state{replace}"))
        out = str(tmp_path / f"out{replace}")
        for n, rows in enumerate([[("1", "2024-01-01 09:00:00"), ("2", "2024-01-02 09:00:00")], [("3", "2024-01-02 13:00:00")]]):
            page = {"items": [dict(zip(schema, r)) for r in rows], "currentPage": 1, "totalPages": 1}
            extract_increment(spark, _land(tmp_path / f"in{replace}{n}", [page]), "e", schema, out, state, "at", replace_dates=replace)
        assert sorted(r.id for r in spark.read.parquet(out).collect()) == want


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "8000", "spark.sql.files.openCostInBytes": "0"}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k in names:
        spark.conf.unset(k)


def test_records_of_several_lines_are_read_by_many_tasks(spark, tmp_path, small_splits):
    rng = random.Random(7)
    want = []
    for f, end in enumerate(("\n", "\r\n")):
        with open(tmp_path / f"f{f}.csv", "w", newline="") as h:
            h.write("an export\nof two lines\n")
            out = csv.writer(h, lineterminator=end)
            out.writerow(["id", "text", "v"])
            for i in range(300):
                text = "q" + "".join(rng.choice('ab"\n, x') for _ in range(rng.choice([1, 5, 60])))
                if i == 150:
                    text = "long\n" * 6_000  # over several blocks
                out.writerow([f * 1000 + i, text, i / 2])
                want.append((f * 1000 + i, text, i / 2))
    typed = read_file(spark, str(tmp_path), "csv", skip_lines=2, multiline=True)
    assert typed.dtypes == [("id", "int"), ("text", "string"), ("v", "double")]
    assert sorted(map(tuple, typed.collect())) == want
    given = read_file(spark, str(tmp_path), "csv", skip_lines=2, multiline=True, schema="id INT, text STRING, v DOUBLE")
    assert sorted(map(tuple, given.collect())) == want
    assert spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 4


def test_quotes_that_do_not_pair(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,t\n1,5" pipe\n2,b\n')
    with pytest.raises(ValueError, match="do not pair"):
        read_file(spark, str(tmp_path), "csv", multiline=True)
    rows = read_file(spark, str(tmp_path), "csv", multiline=True, split=False).collect()
    assert [tuple(r) for r in rows] == [(1, '5" pipe'), (2, "b")]


@pytest.mark.parametrize("options", [{}, {"multiline": True}, {"skip_lines": 1}])
def test_files_in_another_column_order_are_refused(spark, tmp_path, options):
    top = "x\n" if "skip_lines" in options else ""
    (tmp_path / "a.csv").write_text(f"{top}id,name\n1,2\n")
    (tmp_path / "b.csv").write_text(f"{top}name,id\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_file(spark, str(tmp_path), "csv", **options).collect()


def test_empty_objects_below_hidden_folders_stay_out(spark, tmp_path):
    for name in ("a/x.txt", "a/_tmp/y.txt", "z.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("")
    (tmp_path / "full.txt").write_text("f")
    got = sorted((r.file_name, bytes(r.file_content)) for r in read_objects(spark, str(tmp_path)).collect())
    assert got == [("full", b"f"), ("x", b""), ("z", b"")]


def test_a_failed_write_leaves_no_object(spark, tmp_path):
    root = tmp_path / "objects"
    old = spark.createDataFrame([("a", "old")], "file_name STRING, file_content STRING")
    write_objects(old, str(root), "txt")
    rows = [(n, "new") for n in ("a", "b/c", "d", "x" * 300, "e")]  # no file can have the long name
    with pytest.raises(RuntimeError, match="1 objects were not written"):
        write_objects(spark.createDataFrame(rows, old.schema).repartition(3), str(root), "txt")
    assert [p.name for p in root.rglob("*")] == ["a.txt"] and (root / "a.txt").read_text() == "old"
    done = write_objects(spark.createDataFrame([r for r in rows if len(r[0]) < 300], old.schema), str(root), "txt")
    assert done.filter("ok").count() == 4
    assert sorted(str(p.relative_to(root)) for p in root.rglob("*") if p.is_file()) == ["a.txt", "b/c.txt", "d.txt", "e.txt"]
    assert (root / "a.txt").read_text() == "new"


def test_a_repeated_move_finds_its_object_moved(tmp_path):
    (tmp_path / "a").write_text("moved")
    row = type("Row", (), {"file_name": "a"})
    fs, base = _open_root(str(tmp_path))
    _mover("_staging-1")(fs, base, "a", row)
    assert (tmp_path / "a").read_text() == "moved"
    with pytest.raises(OSError):
        _mover("_staging-1")(fs, base, "b", row)
    assert SCHEMES["s3a"] == "s3"


def test_flatten_finds_columns_and_keys_in_one_scan(spark, tmp_path):
    row = json.dumps({f"k{i}": i for i in range(5_000)})
    spark.createDataFrame([(1, row, '{"a": 1}', "text"), (2, '{"k0": 7}', "5", None)], "id INT, wide STRING, mixed STRING, t STRING").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    group = "flatten-one-scan"
    spark.sparkContext.setJobGroup(group, group)
    out = flatten_columns(df)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("", "")
    # one query: the jobs of its shuffle's stages, and no second scan
    scans = sum(
        len(spark.sparkContext.statusTracker().getJobInfo(j).stageIds) for j in jobs
    )
    assert len(jobs) <= 2 and scans <= 3
    assert len(out.columns) == 5_003 and out.columns[-3:] == ["id", "mixed", "t"]
    assert [r.WIDE__K0 for r in out.select("id", "WIDE__K0").orderBy("id").collect()] == ["0", "7"]
    with pytest.raises(ValueError, match="more than 100"):
        flatten_columns(df, ["wide"], max_columns=100)
