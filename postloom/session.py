"""Spark session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, tempfile.TemporaryDirectory] = {}
# The folder inside the shared one that the running job keeps its intermediate tables in.
_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def session(app: str = "postloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for; `conf` overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: the folder the cluster names in spark.checkpoint.dir.

    Only a local session that names none gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.TemporaryDirectory(prefix="postloom-", dir="/tmp")
    return _local_folders[app].name


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """SQL settings, dots written as "__", that hold inside this block only."""
    names = {name.replace("__", "."): value for name, value in conf.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside this block are deleted at its end."""
    folder = f"{shared_folder(spark)}/job-{uuid.uuid4().hex}"
    token = _scratch.set(folder)
    try:
        yield
    finally:
        _scratch.reset(token)
        delete(spark, folder)


def _hadoop(spark: SparkSession, path: str):
    """A path and its file system, as Spark itself sees them."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, folder: str) -> None:
    path, files = _hadoop(spark, folder)
    files.delete(path, True)


def exists(spark: SparkSession, folder: str) -> bool:
    path, files = _hadoop(spark, folder)
    return files.exists(path)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder inside one file system; the target must not exist, its parents may not either."""
    path, files = _hadoop(spark, source)
    to, _ = _hadoop(spark, target)
    files.mkdirs(to.getParent())
    if files.exists(to) or not files.rename(path, to):
        raise FileExistsError(f"cannot move {source} to {target}")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it back.

    The result survives the loss of executors, is pruned by column on each later use,
    and gives Catalyst the true size for its choice of join.
    """
    spark = df.sparkSession
    path = f"{_scratch.get() or shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
