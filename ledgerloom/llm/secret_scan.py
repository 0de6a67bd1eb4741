"""Secret scans with an incremental blob ledger: every version of a path is addressed by the SHA-256 of its text; only pairs
of blob and rule version that the ledger lacks are scanned; findings are joined back to all paths.

Built-in functions only. Copies of a blob meet in a map-side aggregate, so a blob with very many paths is one row per
task; the join back is on hash keys with at most one finding row per blob.

Edge cases: a null text is the empty blob. Repeated rows and paths each get the blob's findings. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import common

RULES_VERSION = 1
# Kind, pattern, group whose length counts, least length. The order is the order of kinds at one start.
RULES = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
)
#: A text without a match of these has no finding of any kind.
TRIGGER = r"""(?i:passw|secret|token|api_?key)|AKIA|[0-9a-f]{16}|-----BEGIN|eyJ|gh[pousr]_"""
#: Matches whose positions are summed up at once.
BLOCK = 256


def spans_of(text: Column, rank: int) -> Column:
    """Array of (start, rank, end, kind) of one rule's matches in code points, leftmost and without overlap.

    The parts between the matches and the matches themselves give every position by running sums of lengths.
    """
    kind, pattern, group, least = RULES[rank]
    gaps, hits = F.split(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sized = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    steps = F.zip_with(F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.struct(F.length(g).alias("g"), F.length(h).alias("h"))), sized, lambda p, v: F.struct(p.g.alias("g"), p.h.alias("h"), (F.length(v) >= least).alias("ok")))
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    n = F.size(steps)
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(BLOCK)), lambda b: F.slice(steps, b + 1, BLOCK))

    def add(acc: Column, x: Column) -> Column:
        span = F.struct((acc.at + x.g).alias("start"), (acc.at + x.g + x.h).alias("end"))
        return F.struct((acc.at + x.g + x.h).alias("at"), F.when(x.ok, F.concat(acc.spans, F.array(span))).otherwise(acc.spans).alias("spans"))

    def chain(acc: Column, b: Column) -> Column:
        return F.struct((acc.at + b.at).alias("at"), F.concat(acc.parts, F.array(F.struct(acc.at.alias("base"), b.spans.alias("spans")))).alias("parts"))

    # an accumulator is copied with each step: blocks keep the steps short, and there are few blocks
    inside = "array<struct<start:int,end:int>>"
    own = F.transform(blocks, lambda b: F.aggregate(b, F.struct(F.lit(0).alias("at"), F.array().cast(inside).alias("spans")), add))
    parts = F.aggregate(own, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<base:int,spans:{inside}>>").alias("parts")), chain).parts
    shifted = lambda p: F.transform(p.spans, lambda x: F.struct((p.base + x.start).alias("start"), F.lit(rank).alias("rank"), (p.base + x.end).alias("end"), F.lit(kind).alias("kind")))
    found = F.flatten(F.transform(parts, shifted))
    return F.when(text.rlike(pattern), found).otherwise(empty)


def findings(blobs: DataFrame) -> DataFrame:
    """Scans (sha, text): (sha, rules, spans) for each blob, spans sorted by start, then by the order of kinds."""
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    text = F.col("text")
    spans = F.when(text.rlike(TRIGGER), F.sort_array(F.concat(*[spans_of(text, k) for k in range(len(RULES))]))).otherwise(empty)
    return blobs.select("sha", F.lit(RULES_VERSION).alias("rules"), spans.alias("spans"))


def addressed(versions: DataFrame, path_cols: list[str], text_col: str = "text") -> DataFrame:
    return versions.select(*path_cols, common.text_or_empty(F.col(text_col)).alias("text")).withColumn("sha", F.sha2("text", 256))


def scan(versions: DataFrame, path_cols: list[str], ledger: DataFrame | None = None, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(spans of every path's version, new ledger rows). The ledger has (sha, rules, spans) of blobs scanned before."""
    blobs = addressed(versions, path_cols, text_col)
    unseen = blobs.groupBy("sha").agg(F.first("text").alias("text"))
    if ledger is not None:
        unseen = unseen.join(ledger.where(F.col("rules") == RULES_VERSION).select("sha"), "sha", "left_anti")
    new = common.written(findings(unseen), "ledger")
    known = new if ledger is None else new.unionByName(ledger.where(F.col("rules") == RULES_VERSION).select(*new.columns))
    hits = known.where(F.size("spans") > 0).select("sha", "spans")
    out = blobs.drop("text").join(hits, "sha", "left")
    return out.withColumn("spans", F.coalesce("spans", F.array().cast(hits.schema["spans"].dataType))), new


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones as one, replaced by a mark."""

    def put(acc: Column, x: Column) -> Column:
        fresh = F.concat(acc.out, F.substring(text, acc.at + 1, F.greatest(x.start - acc.at, F.lit(0))), F.lit(mark))
        return F.struct(F.greatest(acc.at, x.end).alias("at"), F.when((x.start < acc.at) & (acc.at > 0), acc.out).otherwise(fresh).alias("out"))

    rest = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), put, lambda a: F.concat(a.out, F.substring(text, a.at + 1, F.length(text))))
    return F.when(F.size(spans) > 0, rest).otherwise(text)


def redacted(versions: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The rows with every finding in their text replaced by a mark; null texts stay null."""
    blobs = versions.select(F.struct("*").alias("row"), F.col(text_col).alias("text"), F.sha2(common.text_or_empty(F.col(text_col)), 256).alias("sha"))
    _, found = scan(versions, [], text_col=text_col)
    both = blobs.join(found.where(F.size("spans") > 0).select("sha", "spans"), "sha", "left")
    text = F.when(F.col("spans").isNotNull(), redact(F.col("text"), F.col("spans"), mark)).otherwise(F.col("text"))
    return both.select(*[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in versions.columns])


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = scan(common.table(spark, sf_dir, "documents"), ["doc_id"])
    count = lambda kind: F.size(F.filter("spans", lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x.rank < 3)
    return out.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
