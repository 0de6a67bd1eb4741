"""A warehouse in a folder: whole versions of its tables, one of which is current; and an append-only history of audits.

    <root>/versions/<version>/<table>/   Parquet, never changed once the version is current
    <root>/versions/<version>/manifest   JSON: tables in load order with their row counts, the version before
    <root>/CURRENT                       the name of the current version, switched by one rename
    <root>/history/<table>/load_timestamp=<stamp>/

A load writes parents before children, counts the rows as they are written and again as they are read back, checks natural
and foreign keys on what was written, and only then switches. Whatever fails leaves the old version current and removes the
new one. A table whose write fails is written again, over what is left of it, before the load gives up. Readers that opened
a version keep it until it is cleaned. One load at a time: there is no lock. The rename replaces in one step on HDFS and
local disks; a store whose rename is a copy needs a catalog instead.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import star
from ledgerloom.sources.staging import hadoop_path, removed

# The tables in the order of their load.
LOAD_ORDER = (
    "dim_product", "dim_marketplace", "dim_month", "dim_fulfillment", "fact_marketplace_activity", "fact_product_performance", "fact_inventory_action", "fact_performance_variance",
    "audit_validation", "audit_dataset_profile",
)
AUDITS = ("audit_validation", "audit_dataset_profile")


class LoadError(Exception):
    """A load that didn't come about; the version before it is still current."""


def _put(spark: SparkSession, path: str, text: str) -> None:
    fs, at = hadoop_path(spark, path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _get(spark: SparkSession, path: str) -> str | None:
    fs, at = hadoop_path(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _switch(spark: SparkSession, root: str, version: str) -> None:
    jvm = spark.sparkContext._jvm
    new, now = f"{root}/.next-{version}", f"{root}/CURRENT"
    _put(spark, new, version)
    _, at = hadoop_path(spark, now)
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    files.rename(hadoop_path(spark, new)[1], at, how)


def without_nan(df: DataFrame) -> DataFrame:
    """A NaN is no value."""
    return df.select(*[F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`")).alias(c) if kind in ("double", "float") else F.col(f"`{c}`") for c, kind in df.dtypes])


def write_counted(df: DataFrame, path: str, attempts: int = 2) -> int:
    """Writes rows over what is at `path` and counts them in the same pass and again on reading; N24: tries so many times."""
    for left in range(attempts - 1, -1, -1):
        seen = Observation()
        try:
            df.observe(seen, F.count("*").alias("rows")).write.mode("overwrite").parquet(path)
        except Exception as e:
            if left:
                continue
            raise LoadError(f"{path.rsplit('/', 1)[-1]} was not written in {attempts} attempts: {type(e).__name__}") from e
        sent, found = seen.get["rows"], df.sparkSession.read.schema(df.schema).parquet(path).count()
        if sent != found:
            raise LoadError(f"{path.rsplit('/', 1)[-1]}: {sent} rows were sent and {found} are there")
        return found
    raise LoadError("no attempt was allowed")


def load(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, order: Sequence[str] = LOAD_ORDER, attempts: int = 2) -> dict:
    """A full reload of the tables that are given. The manifest of the new version, or LoadError."""
    root = root.rstrip("/")
    before = current(spark, root)
    version = f"{int(before['version'].split('-')[0]) + 1 if before else 1:06d}-{uuid.uuid4().hex[:8]}"
    folder, counts = f"{root}/versions/{version}", {}
    present = [t for t in order if t in tables]
    try:
        for name in present:
            counts[name] = write_counted(without_nan(tables[name]), f"{folder}/{name}", attempts)
        made = {t: spark.read.schema(tables[t].schema).parquet(f"{folder}/{t}") for t in present}
        try:
            if all(t in made for t, _ in star.NATURAL_KEYS):
                star.assert_unique(made)
            if all(t in made for f, _, d, _ in star.FOREIGN_KEYS for t in (f, d)):
                star.assert_foreign_keys(made)
        except ValueError as e:
            raise LoadError(str(e)) from e
        manifest = {"version": version, "before": before["version"] if before else None, "tables": [{"table": t, "rows": counts[t], "schema": json.loads(tables[t].schema.json())} for t in present]}
        _put(spark, f"{folder}/manifest", json.dumps(manifest))
        _switch(spark, root, version)
    except Exception:
        removed(spark, folder)
        raise
    return manifest


def current(spark: SparkSession, root: str) -> dict | None:
    version = _get(spark, f"{root.rstrip('/')}/CURRENT")
    return json.loads(_get(spark, f"{root.rstrip('/')}/versions/{version}/manifest")) if version else None


def read(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the current version."""
    from pyspark.sql.types import StructType

    made = current(spark, root)
    if made is None:
        raise LoadError(f"nothing was loaded to {root}")
    return {t["table"]: spark.read.schema(StructType.fromJson(t["schema"])).parquet(f"{root.rstrip('/')}/versions/{made['version']}/{t['table']}") for t in made["tables"]}


def cleaned(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Removes all but the newest so many versions; the current one always stays. Returns what went."""
    root, made = root.rstrip("/"), current(spark, root)
    fs, at = hadoop_path(spark, f"{root}/versions")
    names = sorted((s.getPath().getName() for s in fs.listStatus(at)), reverse=True) if fs.exists(at) else []
    gone = [n for n in names[keep:] if made is None or n != made["version"]]
    for n in gone:
        removed(spark, f"{root}/versions/{n}")
    return gone


def load_report(spark: SparkSession, tables: Mapping[str, DataFrame], root: str) -> DataFrame:
    """Rows of each source and of the current version, in load order."""
    rows = [(k + 1, t["table"], tables[t["table"]].count(), t["rows"]) for k, t in enumerate(current(spark, root)["tables"])]
    got = spark.createDataFrame(rows, "load_order int, table_name string, source_rows long, loaded_rows long")
    return got.withColumn("status", F.when(F.col("source_rows") == F.col("loaded_rows"), "OK").otherwise("MISMATCH"))


def append_history(df: DataFrame, root: str, name: str, stamp: str) -> None:
    """Adds a load to the history of a table. The same load again replaces its own partition and no other."""
    df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/history/{name}/load_timestamp={stamp}")


def history(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/history/{name}").withColumn("load_timestamp", F.col("load_timestamp").cast("string"))


def latest(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest load of a table; the subquery's result prunes the other partitions."""
    return spark.sql("select * from {h} where load_timestamp = (select max(load_timestamp) from {h})", h=history(spark, root, name))


def failing(spark: SparkSession, root: str) -> DataFrame:
    """V1: the checks that fail in the newest load. A WARN is no failure."""
    return latest(spark, root, "audit_validation").where("check_status = 'FAIL'").select("check_name", "check_status", "check_value", "expected_value", "notes", "load_timestamp")
