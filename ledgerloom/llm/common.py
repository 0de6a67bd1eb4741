"""What the corpus operators share: tables, words, durable intermediate tables, connected components."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The separators of the word contract: space and the ASCII controls TAB to CR.
SEPARATORS = r"[ \x09-\x0D]+"
LOCAL_CHECKPOINTS = "/tmp/checkpoints"
#: Words of texts that a task handles at once.
STEP_WORDS = 200_000


def shipped(name: str) -> None:
    """Sends a module's functions to executors by value, so that they need not have the package on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


shipped(__name__)


def part_ranges(column, words: int = STEP_WORDS) -> Iterator[tuple[int, int]]:
    """Parts of an Arrow column of texts with about so many words each: first row and number of rows."""
    import pyarrow.compute as pc

    sizes, start, size = pc.binary_length(column).to_pylist(), 0, 0
    for i, n in enumerate(sizes):
        size += (n or 0) // 5 + 1
        if size >= words or i + 1 == len(sizes):
            yield start, i + 1 - start
            start, size = i + 1, 0


def text_parts(column, words: int = STEP_WORDS) -> Iterator[tuple[int, list]]:
    """Parts of an Arrow column of texts with about so many words each: their first row and their texts as bytes, '' for null."""
    import pyarrow as pa

    for start, n in part_ranges(column, words):
        yield start, [t or b"" for t in column.slice(start, n).cast(pa.binary()).to_pylist()]


def split_words(texts):
    """Words of an Arrow array of texts laid end to end, as numbers of distinct words; these words; how many words each text has."""
    import numpy as np
    import pyarrow.compute as pc

    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten().dictionary_encode()
    own, distinct = words.indices.to_numpy(), words.dictionary
    offsets = lists.offsets.to_numpy().astype(np.int64)
    empty = pc.index(distinct, "").as_py()  # white space at either end of a text leaves an empty word
    if empty < 0:
        return own, distinct, np.diff(offsets)
    full = own != empty
    before = np.r_[0, np.cumsum(full)]
    return own[full], distinct, np.diff(before[offsets - offsets[0]])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text; null and blank texts have none."""
    return F.array_remove(F.split(text_or_empty(text), SEPARATORS), "")


def ascii_lower(text: Column) -> Column:
    """A-Z only, so that other alphabets keep their case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only where the session names none, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return (found or LOCAL_CHECKPOINTS).rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: the rows as a Parquet table in the shared folder, read again. It survives a lost executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/ledgerloom/{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._ledgerloom_path = path
    return out


def dropped(df: DataFrame) -> None:
    """Removes a table made by written() that nothing reads any more."""
    spark, path = df.sparkSession, df._ledgerloom_path
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links (a long, b long): (node, component), component being the least reachable node.

    Each round hangs every neighbour of a node on that node's least neighbour (alternating the larger and the smaller
    ones), which leaves stars after about log(n) rounds; rounds go on until nothing changes. A node of very high degree becomes many short rows, never one
    group in memory. Self links and repeats are fine; nodes without links don't appear.
    """
    pairs = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    pairs = pairs.where("a is not null and b is not null and a <> b")
    now = written(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    was = _digest(now)
    while was[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # every larger neighbour of a goes to a's least neighbour
        large = now.select(F.col("b").alias("k"), F.col("a").alias("v")).join(least.withColumnRenamed("a", "k"), "k")
        large = large.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # then a node's smaller neighbours, itself included, go to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("x"))
        small = small.select(F.col("x.a").alias("a"), F.col("x.m").alias("b")).where("a <> b").distinct()
        after = written(small, "links")
        before, was = was, _digest(after)
        dropped(now)
        now = after
        if was == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _digest(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return tuple(row)

