"""Sinks (K1-K9): tables, date-partitioned parquet, views, one object per row."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, StringType, StructField, StructType

from ..functions.names import quote
from ..session import delete_folder, materialize, path_exists, release, swap_folder


def save_table(
    df: DataFrame,
    name: str | None = None,
    path: str | None = None,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> None:
    """Write ``df`` to a catalog table or a parquet folder (K1, K2, K7).

    An empty name is a no-op (as in the reference's append). Overwriting goes through a
    staging table, or a staging folder beside ``path``, and a swap of names: a plan that
    reads what it replaces still works, and a write that fails leaves the old rows."""
    if not name and not path:
        return
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    spark = df.sparkSession
    if path:
        replaced = mode == "overwrite" and path_exists(spark, path)
        if replaced and not (partition_by and spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"):
            staging = f"{path.rstrip('/')}__staging_{uuid.uuid4().hex[:8]}"
            try:
                w.parquet(staging)
                swap_folder(spark, staging, path)
            finally:
                delete_folder(spark, staging)
        else:
            w.parquet(path)
        return
    if mode == "overwrite" and spark.catalog.tableExists(name):
        staging = f"{name}__staging_{uuid.uuid4().hex[:8]}"
        w.saveAsTable(staging)
        swap_table(spark, staging, name)
    else:
        w.saveAsTable(name)


def swap_table(spark: SparkSession, staging: str, name: str) -> None:
    """Give ``staging`` the name of an existing table, which is dropped only then."""
    old = f"{name}__old_{uuid.uuid4().hex[:8]}"
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")
    spark.sql(f"DROP TABLE {old}")


def create_view(df: DataFrame, name: str, global_view: bool = False) -> DataFrame:
    """Create or replace a view over ``df`` (K6)."""
    if global_view:
        df.createOrReplaceGlobalTempView(name)
    else:
        df.createOrReplaceTempView(name)
    return df


def write_by_date(
    df: DataFrame,
    path: str,
    ts_column: str,
    date_column: str = "extract_date",
    mode: str = "overwrite",
) -> None:
    """Parquet split by the calendar date of ``ts_column`` (K5, A5).

    Rows without a timestamp are dropped (they have no date). Existing dates are
    replaced, others kept (dynamic partition overwrite). Rows are range-partitioned
    on (date, timestamp, hash of the row) first, so a task writes one or two dates and
    a heavy date, even of one timestamp, is spread over many tasks."""
    ts = F.col(quote(ts_column))
    dated = df.filter(ts.isNotNull()).withColumn(date_column, F.to_date(ts))
    spreading = F.xxhash64(*[F.col(quote(f.name)) for f in df.schema.fields if "map<" not in f.dataType.simpleString()])
    (
        dated.repartitionByRange(F.col(date_column), ts, spreading)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column)
        .parquet(path)
    )


def load_file_to_table(
    spark: SparkSession,
    name: str | None,
    path: str,
    fmt: str,
    table_path: str | None = None,
    **options,
) -> None:
    """Read a file (parquet/json/csv) and overwrite a table with it (K4): a
    catalog table ``name`` or a parquet table at ``table_path``."""
    from ..sources.files import read_file

    save_table(read_file(spark, path, fmt, **options), name=name, path=table_path, mode="overwrite")


WRITE_RESULT = StructType(
    [
        StructField("file_name", StringType()),
        StructField("key", StringType()),
        StructField("ok", BooleanType()),
        StructField("error", StringType()),
    ]
)


#: Objects that a task writes, about.
TASK_OBJECTS = 10_000

#: Names of one store: what Hadoop calls s3a, pyarrow calls s3.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _open_root(root: str):
    """The file system of ``root`` and the path of ``root`` there."""
    import pyarrow.fs as pafs

    scheme, sep, rest = root.partition("://")
    uri = SCHEMES.get(scheme, scheme) + sep + rest if sep else root
    fs, base = pafs.FileSystem.from_uri(uri)
    return fs, base.rstrip("/")


def _object_batches(root: str, extension: str | None, act) -> Callable:
    """A function over batches that runs ``act(fs, staged, target, row)`` for each object
    and gives its outcome; errors are collected, the driver raises them."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        fs, base = _open_root(root)
        end = f".{extension}" if extension else ""
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                name = f"{row.file_name}{end}"
                key = f"{root.rstrip('/')}/{name}"
                try:
                    act(fs, base, name, row)
                    out.append((row.file_name, key, True, None))
                except Exception as e:
                    out.append((row.file_name, key, False, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["file_name", "key", "ok", "error"])

    return run


def _stager(staging: str):
    """Writes one object below the staging folder; a repeated task writes it again."""
    last = []  # the folder this task made last

    def act(fs, base, name, row) -> None:
        content = row.file_content
        data = content.encode("utf-8") if isinstance(content, str) else b"" if content is None else bytes(content)
        path = f"{base}/{staging}/{name}"
        folder = path.rsplit("/", 1)[0]
        if last != [folder]:
            fs.create_dir(folder, recursive=True)
            last[:] = [folder]
        with fs.open_output_stream(path) as fh:
            fh.write(data)

    return act


def _mover(staging: str):
    """Gives one staged object its name. One no longer staged was moved by an earlier
    attempt of this task, which is looked for only when the move fails."""
    last = []  # the folder this task made last

    def act(fs, base, name, row) -> None:
        import pyarrow.fs as pafs

        path, target = f"{base}/{staging}/{name}", f"{base}/{name}"
        folder = target.rsplit("/", 1)[0]
        if "/" in name and last != [folder]:
            fs.create_dir(folder, recursive=True)
            last[:] = [folder]
        try:
            fs.move(path, target)
        except OSError:
            staged, there = fs.get_file_info([path, target])
            if staged.type != pafs.FileType.NotFound or there.type != pafs.FileType.File:
                raise

    return act


def _some(df: DataFrame, text):
    """The number of rows ``n`` and ``some`` example texts for an error message."""
    ends = F.array_distinct(F.filter(F.array(F.min("_t"), F.max("_t")), lambda t: t.isNotNull()))
    return df.select(text.alias("_t")).agg(F.count(F.lit(1)).alias("n"), ends.alias("some")).first()


def write_objects(
    objects: DataFrame, root: str, file_extension: str | None = None
) -> DataFrame:
    """One object per row at ``root/file_name[.ext]`` (K3, K9).

    ``file_content`` may be binary or string (UTF-8) or a struct/map (JSON).
    Two phases, both by the executors in parallel (Arrow batches), for which the objects
    are dealt out by name, however few files or row groups hold them: all objects are
    written below a staging folder of ``root`` whose name begins with ``_``, and only
    when every one is there are they moved to their names. A write that fails leaves
    no object and what was there before. A failure while moving raises too; objects moved
    before it keep their new content. Failures are collected and raised together. Two rows
    with one name are an error (checked first).
    Returns the per-object result rows."""
    twice = F.when(F.col("count") > 1, F.col("file_name"))
    seen = objects.groupBy("file_name").count().agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("rows"),
        F.count_if(F.col("count") > 1).alias("dups"),
        F.array_compact(F.array_distinct(F.array(F.min(twice), F.max(twice)))).alias("some"),
    ).first()
    if seen.dups:
        raise ValueError(f"{seen.dups} duplicate object names, such as {sorted(seen.some)}")
    ctype = objects.schema["file_content"].dataType
    if isinstance(ctype, (BinaryType, StringType)):
        content = F.col("file_content")
    else:
        content = F.to_json(F.col("file_content"))
    spark = objects.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, seen.rows // TASK_OBJECTS)
    src = objects.select("file_name", content.alias("file_content")).repartition(max(1, min(seen.rows, tasks)), "file_name")
    staging = f"_staging-{uuid.uuid4().hex}"
    fs, base = _open_root(root)
    fs.create_dir(base, recursive=True)
    try:
        staged = materialize(src.mapInPandas(_object_batches(root, file_extension, _stager(staging)), WRITE_RESULT), "objects-staged")
        _raise_failed(staged, "written")
        moves = staged.select("file_name").mapInPandas(_object_batches(root, file_extension, _mover(staging)), WRITE_RESULT)
        done = materialize(moves, "objects")
        release(staged)
        _raise_failed(done, "moved to their names")
    finally:
        if fs.get_file_info(f"{base}/{staging}").type.name == "Directory":
            fs.delete_dir(f"{base}/{staging}")
    return done


def _raise_failed(result: DataFrame, what: str) -> None:
    failed = _some(result.filter(~F.col("ok")), F.concat_ws(": ", "file_name", "error"))
    if failed.n:
        raise RuntimeError(f"{failed.n} objects were not {what}, such as " + "; ".join(sorted(failed.some)))
