"""The corpus pipeline over `documents`: each stage works on all that the one before kept, and its decisions take effect.

1. toxicity: documents with a score of 0.5 or more go.
2. near_duplicates: one document of each group of near-duplicates stays, the one with the least id.
3. secrets: every secret found is replaced by a mark; n_chars follows.
4. mixing: a document is repeated or cut so that each source comes near its target share; of a cut one the chosen blocks stay.
5. packing: the texts become token sequences of 2048; the result has a row per piece.

Rows without an id are never near-duplicates of others and are mixed as they are, once. Of rows with one id and different
texts, the kept id's stay, one of each text. A stage returns the columns of
its input; stages 2 to 4 leave extra columns alone. Empty tables pass through. SQL can't express the first two stages and
the last, so there is no SQL for the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import common, minhash, mixing, packing, secret_scan, toxicity

THRESHOLD = 0.5
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    field = toxicity.learn(docs, common.table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct("*").alias("_row"), "text")  # as one column, so that no name clashes with the score's
    return toxicity.tagged(rows, field, id_col="_row").where(F.col("score") < THRESHOLD).select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = minhash.clusters(docs)
    first = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_id")).distinct()
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_text"))
    kept = rows.where("_id is not null").join(first, "_id", "left_semi").dropDuplicates(["_id", "_text"])
    return kept.select("_row.*").unionByName(docs.where(F.col("doc_id").isNull()))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = secret_scan.redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named = docs.where(F.col("doc_id").isNotNull())
    sizes = common.written(mixing.sized(named, [F.xxhash64("text").alias("_text")]), "sizes")
    taken = mixing.mix(sizes).where("taken > 0").withColumn("runs", mixing.ranges())
    taken = taken.groupBy(F.col("doc_id").alias("_id"), "_text").agg(F.max(F.struct("taken", "size", "runs")).alias("_mix"))
    own = [F.struct(*[c for c in docs.columns if c not in ("text", "n_chars")]).alias("_row"), "text"]  # the rest as one column, so that no name clashes
    rows = named.select(*own, F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_text")).join(taken, ["_id", "_text"])
    # whole copies, then the chosen blocks left over as one shorter copy
    copies = F.array_repeat(F.col("text"), F.expr("int(_mix.taken div _mix.size)"))
    rest = F.when(F.expr("_mix.taken % _mix.size > 0"), F.array(mixing.excerpt(F.col("text"), F.col("_mix.runs")))).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("text", F.explode(F.concat(copies, rest))).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    rows = rows.select("_row.*", "text", "n_chars")
    return rows.select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
