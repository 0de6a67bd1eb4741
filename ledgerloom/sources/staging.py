"""Tables between the steps of a plan that are read more than once, kept for as long as the files they come from stay the same."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

LOCAL_CHECKPOINTS = "/tmp/checkpoints"
#: Folders of inputs whose staged tables are kept at once in a session.
FOLDERS = 4


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. A local one only in local mode, where the session names none, as in tests."""
    conf = spark.sparkContext.getConf()
    found = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir names no shared folder; on a cluster there must be one")
    return (found or LOCAL_CHECKPOINTS).rstrip("/")


def hadoop_path(spark: SparkSession, path: str) -> tuple:
    """(file system, path) of the JVM, whatever store the path is in."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def removed(spark: SparkSession, path: str) -> None:
    fs, at = hadoop_path(spark, path)
    fs.delete(at, True)


#: Settings of Spark for tables that are staged. Shuffle files go when the query that wrote them ends, and not when the driver
#: happens to collect garbage, so that the disk holds one step's shuffles at a time. Generated methods beyond 8,000 bytes of
#: bytecode, which HotSpot never compiles, give way to smaller ones.
STAGING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.codegen.hugeMethodLimit": "8000"}


@contextmanager
def staging_settings(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in STAGING}
    for k, v in STAGING.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Paths that were staged for the tables being built, the innermost last.
_building: list[list[str]] = []


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read again: computed once, and safe from lost executors. One that is
    staged while another is built goes when that is there."""
    path = f"{shared_dir(df.sparkSession)}/ledgerloom/{uuid.uuid4().hex}/{name}"
    with staging_settings(df.sparkSession):
        df.select("*").write.option("compression", "zstd").parquet(path)  # a plan of its own, made under the settings
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    if _building:
        _building[-1].append(path)
    return out


def fingerprint(spark: SparkSession, paths: Iterable[str]) -> str:
    """A hash of name, size and modification time of every file below the paths. Missing paths count as empty."""
    found = []
    for path in paths:
        fs, at = hadoop_path(spark, path)
        if not fs.exists(at):
            found.append(f"{path} -")
            continue
        files = fs.listFiles(at, True)
        while files.hasNext():
            f = files.next()
            found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


@dataclass
class Kept:
    mark: str
    frame: DataFrame


_kept: dict[tuple[str, str], dict[str, Kept]] = {}


def _kept_table(made: DataFrame, name: str) -> DataFrame:
    """Staged, and no step of the table that is built with it."""
    _building.append([])
    try:
        return staged(made, name)
    finally:
        _building.pop()


def cached(spark: SparkSession, folder: str, name: str, inputs: Iterable[str], build: Callable[[], DataFrame]) -> DataFrame:
    """The staged result of `build`, built anew when a file of its inputs changed. What it supersedes is deleted,
    and so are the tables of the folder that was asked for longest ago when there are more than FOLDERS."""
    mark = fingerprint(spark, [f"{folder}/{t}.parquet" for t in inputs])
    key = (spark.sparkContext.applicationId, folder)
    own = _kept.pop(key, {})
    _kept[key] = own  # the newest comes last
    old = own.get(name)
    if old is None or old.mark != mark:
        steps: list[str] = []
        _building.append(steps)
        try:
            made = build()
        finally:
            _building.pop()
        own[name] = Kept(mark, _kept_table(made, name))
        for path in steps:
            removed(spark, path)
        if old is not None:
            removed(spark, old.frame._staged_at)
    for past in [k for k in _kept if k[0] == key[0]][:-FOLDERS]:
        for kept in _kept.pop(past).values():
            removed(spark, kept.frame._staged_at)
    return own[name].frame
