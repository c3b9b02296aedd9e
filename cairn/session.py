"""Session helpers: building a session for tests/bench, and cutting lineage.

Lineage is cut by writing a parquet table under the folder the cluster names in
``spark.checkpoint.dir`` (a shared, reliable file system on a real cluster). The
library never invents a machine-local folder: only ``local_session`` (tests, bench)
sets a checkpoint folder, and only when none is configured.
"""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "cairn",
    extra: dict | None = None,
) -> SparkSession:
    """A session tuned for local runs (tests, bench). UI off, UTC, AQE on."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not checkpoint_dir(spark):
        # Only for local runs where nothing is configured.
        path = tempfile.mkdtemp(prefix="cairn-ckpt-")
        spark.sparkContext.setCheckpointDir(path)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder configured for this session, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    conf = spark.conf.get("spark.checkpoint.dir", None)
    return conf.rstrip("/") if conf else None


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str, remove_at_exit: bool = False) -> str:
    """A fresh path under the session's checkpoint folder.

    Scratch output must live on a shared file system, never on one machine's disk: on a
    cluster that names none this raises. A session that runs on this one machine gets a
    temporary folder when none is set. ``remove_at_exit`` deletes the folder when the
    Python process ends.
    """
    base = checkpoint_dir(spark)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder for scratch output")
        base = tempfile.mkdtemp(prefix="cairn-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        base = checkpoint_dir(spark)
    path = f"{base}/cairn/{name}-{uuid.uuid4().hex}"
    if remove_at_exit:
        _SCRATCH.append((spark, path))
    return path


# stored intermediates of this process: id(DataFrame) -> (path, DataFrame)
_STORED: dict[int, tuple[str, DataFrame]] = {}


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Run ``df`` once and return a DataFrame that reads the stored result.

    Written as parquet under the checkpoint folder (survives executor loss, lineage cut,
    later reads are column-pruned). Call ``release`` once no plan needs it; whatever is
    left is removed when the Python process exits.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    _STORED[id(out)] = (path, out)
    return out


def _delete(spark: SparkSession | None, path: str) -> None:
    try:
        if spark is not None:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
            return
    except Exception:  # JVM gone: try a native delete below
        pass
    try:
        import pyarrow.fs as pafs

        local = path[len("file:"):] if path.startswith("file:") else path
        if "://" in local:
            fs, base = pafs.FileSystem.from_uri(local)
        else:
            fs, base = pafs.LocalFileSystem(), local
        fs.delete_dir(base)
    except Exception:
        pass


def release(df: DataFrame) -> None:
    """Drop what ``materialize`` stored for ``df`` (no-op for other frames)."""
    entry = _STORED.pop(id(df), None)
    if entry is None:
        return
    path, kept = entry
    _delete(kept.sparkSession, path)


@atexit.register
def _release_all() -> None:
    while _SCRATCH:
        spark, path = _SCRATCH.pop()
        try:
            alive = spark.sparkContext._jsc is not None
        except Exception:
            alive = False
        _delete(spark if alive else None, path)
    for key in list(_STORED):
        path, kept = _STORED.pop(key)
        try:
            spark = kept.sparkSession if kept.sparkSession.sparkContext._jsc else None
        except Exception:
            spark = None
        _delete(spark, path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, asked of the session's own file systems."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    fs, p = _file_system(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def swap_folder(spark: SparkSession, staging: str, path: str) -> None:
    """Give ``staging`` the name of the existing folder ``path``; the old one is deleted
    only then, and comes back if the new one cannot get its name."""
    fs, new = _file_system(spark, staging)
    _, target = _file_system(spark, path)
    _, old = _file_system(spark, f"{path.rstrip('/')}__old_{uuid.uuid4().hex[:8]}")
    if not fs.rename(target, old):
        raise OSError(f"cannot rename {path}")
    if not fs.rename(new, target):
        fs.rename(old, target)
        raise OSError(f"cannot rename {staging}")
    fs.delete(old, True)


def create_new(spark: SparkSession, path: str, content: str) -> bool:
    """Create a small file unless there is one of this name; whether it was created. On a
    file system with atomic create only one of several callers gets True."""
    fs, p = _file_system(spark, path)
    data = content.encode()
    if fs.getUri().getScheme() == "file":
        local = p.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            handle = os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
        except FileExistsError:
            return False
        with os.fdopen(handle, "wb") as out:
            out.write(data)
        return True
    if fs.exists(p):
        return False
    try:
        out = fs.create(p, False)
    except Exception as error:
        if "AlreadyExists" in str(error):
            return False
        raise
    out.write(bytearray(data))
    out.close()
    return True


def small_files(spark: SparkSession, folder: str) -> list[str]:
    """The names of the files of a folder that holds few."""
    fs, p = _file_system(spark, folder)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []
