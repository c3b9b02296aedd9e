"""Folders of many objects: listed and read by tasks, written by tasks."""

import pytest
from py4j.java_gateway import GatewayClient
from pyspark.sql import functions as F

from cairn.plans.steps import run_steps
from cairn.sinks.writers import write_objects
from cairn.sources.files import read_folder, read_objects


def _fill(folder, n):
    folder.mkdir(parents=True)
    for i in range(n):
        (folder / f"o_{i}.v1.txt").write_text(f"text {i}" if i % 5 else "")
    (folder / "_hidden").write_text("x")
    (folder / ".hidden").write_text("x")
    return str(folder)


@pytest.mark.parametrize("read", [read_objects, read_folder])
def test_the_driver_does_not_walk_the_listing(spark, tmp_path, monkeypatch, read):
    """The driver's calls and its file index do not grow with the number of files."""
    calls, send = [], GatewayClient.send_command
    monkeypatch.setattr(GatewayClient, "send_command", lambda self, *a, **k: (calls.append(1), send(self, *a, **k))[1])
    made, files = [], []
    for n in (10, 400):
        folder = _fill(tmp_path / f"f{n}", n)
        before = len(calls)
        df = read(spark, folder)
        made.append(len(calls) - before)
        files.append(len(df.inputFiles()))
        assert df.count() == n
    assert made[1] < made[0] + 100 and files[0] == files[1] == 1


def test_what_is_read_of_a_folder(spark, tmp_path):
    """Contents as they are (a name that ends in .gz too), empty ones, nested ones, keys
    as Spark names them, and more bytes than a batch holds."""
    root = tmp_path / "r"
    _fill(root, 10)
    (root / "z.gz").write_bytes(b"no gzip \x00\xff")
    (root / "a" / "b").mkdir(parents=True)
    (root / "a" / "b" / "deep one.txt").write_bytes(b"d" * (9 << 20))
    (root / "a" / "second.txt").write_bytes(b"e" * (9 << 20))
    (root / "_left" / "c").mkdir(parents=True)
    (root / "_left" / "c" / "x.txt").write_text("x")
    want = {f"file:{p}": p.read_bytes() for p in root.rglob("*") if p.is_file() and "_left" not in p.parts and p.name[0] not in "._"}
    got = read_objects(spark, str(root)).coalesce(1).collect()
    assert len(got) == len(want) == 13
    assert {r.key: bytes(r.file_content) for r in got} == want
    assert {r.file_name for r in got} == {f"o_{i}" for i in range(10)} | {"z", "deep one", "second"}
    assert read_objects(spark, f"file://{root}/", recursive=False).count() == 11
    assert read_objects(spark, str(root), include_empty=False).count() == 11
    assert read_folder(spark, str(root), limit=4).count() == 4
    assert read_folder(spark, str(root), include_empty=False).agg(F.min(F.length("file_content"))).first()[0] > 0


def test_folders_without_files_files_and_patterns(spark, tmp_path):
    _fill(tmp_path / "p" / "one", 3)
    (tmp_path / "none").mkdir()
    assert read_folder(spark, str(tmp_path / "none")).count() == 0
    assert read_objects(spark, str(tmp_path / "p" / "o*")).count() == 2  # as Spark's source reads a pattern
    one = read_folder(spark, str(tmp_path / "p" / "one" / "o_1.v1.txt")).collect()
    assert [(r.file_name, bytes(r.file_content)) for r in one] == [("o_1.v1.txt", b"text 1")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_objects(spark, str(tmp_path / "missing"))


def test_objects_of_one_partition_are_written_by_many_tasks(spark, tmp_path):
    objects = spark.range(400).select(F.concat(F.lit("o_"), F.col("id")).alias("file_name"), F.col("id").cast("string").alias("file_content"))
    done = write_objects(objects.coalesce(1), str(tmp_path / "w"), "txt")
    assert done.count() == 400 and len(done.inputFiles()) > 1
    assert {p.name: p.read_text() for p in (tmp_path / "w").iterdir()} == {f"o_{i}.txt": str(i) for i in range(400)}
    assert write_objects(objects.limit(0), str(tmp_path / "none")).count() == 0


def _calls(monkeypatch):
    calls, send = [], GatewayClient.send_command
    monkeypatch.setattr(GatewayClient, "send_command", lambda self, *a, **k: (calls.append(1), send(self, *a, **k))[1])
    return calls


def test_a_roundtrip_costs_the_driver_no_more_for_more_objects(spark, tmp_path, monkeypatch):
    calls, made = _calls(monkeypatch), []
    for n in (10, 300):
        objects = spark.range(n).select(F.concat(F.lit("o_"), F.col("id")).alias("file_name"), F.repeat(F.lit("x"), F.col("id").cast("int") % 7).alias("file_content"))
        before = len(calls)
        write_objects(objects, str(tmp_path / f"r{n}"), "txt")
        back = read_objects(spark, str(tmp_path / f"r{n}"))
        made.append(len(calls) - before)
        assert back.select("file_name", F.decode("file_content", "UTF-8").alias("file_content")).exceptAll(objects).count() == 0
        assert back.count() == n
    assert made[1] < made[0] + 100


def test_a_step_chain_over_objects_costs_the_driver_no_more_for_more(spark, tmp_path, monkeypatch):
    calls, made = _calls(monkeypatch), []
    for n in (5, 300):
        base = tmp_path / f"s{n}"
        (base / "in").mkdir(parents=True)
        for i in range(n):
            (base / "in" / f"page_{i}.html").write_text(f"<p>text <b>{i}</b></p>" if i else "")
        before = len(calls)
        run_steps(spark, [
            {"step": "read_objects", "params": {"root": f"{base}/in"}, "output": "objects"},
            {"step": "coerce_schema", "input": "objects",
             "params": {"schema": {"file_name": "string", "file_content": "string"}}, "output": "pages"},
            {"step": "extract_text", "input": "pages",
             "params": {"html_column": "file_content", "out_column": "file_content"}, "output": "texts"},
            {"step": "write_objects", "input": "texts", "params": {"root": f"{base}/out", "file_extension": "txt"}},
        ])
        made.append(len(calls) - before)
        got = {p.name: " ".join(p.read_text().split()) for p in (base / "out").iterdir() if not p.name.startswith(".")}
        assert got == {f"page_{i}.txt": f"text {i}" if i else "" for i in range(n)}
    assert made[1] < made[0] + 100
