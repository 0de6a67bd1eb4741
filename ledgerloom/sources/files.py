"""CSV sources with a preamble above their header, folders of CSV files, and CSV and JSON sinks, through Spark's file systems."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.columns import normal_name, normal_names

#: Columns that a file with a preamble may have; shorter records are filled up with nulls, a wider header is refused.
WIDEST = 1024
#: Records that are looked at first for the header; beyond them the search goes on in the whole first block.
PEEKED = 50
FINANCE = {"product_sales", "selling_fees", "fba_fees", "total"}


def is_transaction_header(cells: list) -> bool:
    names = {normal_name(c) for c in cells if c is not None}
    return {"date_time", "sku"} <= names and bool(FINANCE & names) and bool({"order_id", "type"} & names)


def with_preamble(spark: SparkSession, path: str, is_header=is_transaction_header) -> DataFrame:
    """One file's rows as strings, under the normal names of its header, wherever that stands.

    Records are read in the file's order until the header is found; the rows are then those of the first block after it, and
    all rows of the other blocks, so that a large file is read by many tasks.
    """
    raw = spark.read.schema(", ".join(f"c{k} string" for k in range(WIDEST + 1))).option("quote", '"').option("escape", '"').csv(path)
    raw = raw.withColumns({"_block": F.col("_metadata.file_block_start"), "_at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)})
    first = raw.where("_block = 0")
    found = next((r for r in first.limit(PEEKED).collect() if is_header(list(r)[:WIDEST])), None)
    found = found or next((r for r in first.toLocalIterator() if is_header(list(r)[:WIDEST])), None)
    if found is None:
        raise ValueError(f"no header row in {path}")
    if found[WIDEST] is not None:
        raise ValueError(f"the header of {path} has more than {WIDEST} columns")
    cells = list(found)[:WIDEST]
    last = max(k for k, c in enumerate(cells) if c is not None) + 1
    rows = raw.where(~((F.col("_block") == 0) & (F.col("_at") <= found["_at"])))
    return rows.select(*[F.col(f"c{k}").alias(n) for k, n in enumerate(normal_names(cells[:last]))]).dropna("all")


def stems(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The CSV files of a folder by name without ending, all strings."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/*.csv")
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at) or []
    return {f.getPath().getName()[:-4]: spark.read.option("header", True).csv(f.getPath().toString()) for f in found}


def save_outputs(outputs: dict[str, DataFrame], folder: str) -> None:
    """A CSV table with a header for each output."""
    for name, df in outputs.items():
        df.write.mode("overwrite").option("header", True).csv(f"{folder.rstrip('/')}/{name}.csv")


def save_metrics(spark: SparkSession, metrics: dict, path: str) -> None:
    """A few scalars as one JSON record."""
    spark.range(1).select(F.lit(json.dumps(metrics, sort_keys=True)).alias("value")).write.mode("overwrite").text(path)


def load_metrics(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])
