"""A session with the settings the library relies on."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def session(app: str = "lakewarden", master: str | None = None, **conf: str) -> SparkSession:
    """UTC and adaptive execution; sizes of partitions are left to the cluster's own settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir; a temporary one only if all is local."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='lakewarden-')}"
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _file_system(spark, path)
    return fs.exists(p)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has written, if it is there."""
    p, fs = _file_system(spark, path)
    fs.delete(p, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    p, fs = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    p, fs = _file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole or not at all; false if there is one already."""
    sc = spark.sparkContext
    aside, fs = _file_system(spark, f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    none = sc._gateway.new_array(sc._jvm.org.apache.hadoop.fs.Options.Rename, 0)  # doesn't replace a file
    try:
        sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration()).rename(fs.makeQualified(aside), fs.makeQualified(p), none)
    except Py4JJavaError as e:
        fs.delete(aside, False)
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    return True


def file_version(spark: SparkSession, path: str) -> str:
    """Changes when the files of a table do: their number, bytes and the latest time of change."""
    p, fs = _file_system(spark, path)
    files = fs.listStatus(p)
    return f"{len(files)}-{sum(f.getLen() for f in files)}-{max((f.getModificationTime() for f in files), default=0)}"


def scratch_folder(spark: SparkSession, prefix: str) -> str:
    """A new path in the shared folder, deleted when Python ends: for what results are read from until then."""
    path = f"{shared_folder(spark)}/{prefix}-{uuid.uuid4().hex}"

    def drop() -> None:
        with contextlib.suppress(Exception):  # the session may have ended before
            drop_path(spark, path)

    atexit.register(drop)
    return path
