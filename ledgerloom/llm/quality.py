"""Quality rules by weak supervision: rules vote good, bad or abstain; expectation-maximisation estimates how each rule
votes on good and on bad documents; the posterior probability of quality replaces an all-must-pass filter.

Edge cases: a null or blank text has no words, so it fails the base and is not kept. Repeated rows get equal results each.
Columns other than the id and the text are not read, so extra or clashing names do no harm. An empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import common

SYMBOLS = "#*$%&|<>"
#: A word without any letter.
BARE_WORD = r"(?:^|[ \x09-\x0D])[^ \x09-\x0D\p{L}]+(?=[ \x09-\x0D]|$)"
#: Positions are packed below a gram's hash in one long; longer texts take the plain sort.
PACKED_WORDS = 1 << 21
#: Rules: name, when it votes bad, when it votes good (otherwise it abstains).
RULES = (
    ("length", "n_words < 30", "n_words >= 60"),
    ("word_length", "mean_word < 2.2 or mean_word > 14", "mean_word between 3 and 11"),
    ("symbols", "symbol_ratio > 0.25", "symbol_ratio < 0.05"),
    ("lines", "n_dup_lines >= 2 and dup_line_ratio > 0.3", "n_dup_lines = 0"),
    ("repeats", "repeat_ratio > 0.4", "repeat_ratio < 0.2"),
    ("bare_words", "bare_ratio > 0.25", "bare_ratio < 0.1"),
    ("digits", "digit_ratio > 0.2", "digit_ratio < 0.08"),
)


@dataclass(frozen=True)
class Voting:
    """What expectation-maximisation found: P(good), and for each rule P(vote | bad) and P(vote | good) for -1, 0, 1."""

    prior: float
    given: tuple[tuple[tuple[float, float, float], tuple[float, float, float]], ...]


def repeated_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words to rows with an array `words`: words inside 3-word windows found twice or more, the first too.

    Windows are hashed and sorted within the row; only windows whose hash prefix occurs twice are compared as text, so
    the count is exact and no row of words leaves its task.
    """
    low, n = PACKED_WORDS - 1, "greatest(size(words) - 2, 0)"
    df = df.withColumn("packed", F.expr(f"case when size(words) < {PACKED_WORDS} then slice(transform(words, (w, i) -> (xxhash64(w, get(words, i + 1), get(words, i + 2)) & {~low}L) | i), 1, {n}) end"))
    df = df.withColumn("packed", F.sort_array("packed"))
    df = df.withColumn("maybe", F.expr(f"""
        case when packed is null then transform(slice(words, 1, {n}), (w, i) -> i)
             else transform(filter(packed, (x, k) -> shiftright(x, {low.bit_length()}) = shiftright(get(packed, k - 1), {low.bit_length()})
                                                  or shiftright(x, {low.bit_length()}) = shiftright(get(packed, k + 1), {low.bit_length()})),
                            x -> int(x & {low}L)) end"""))
    df = df.withColumn("maybe", F.expr("sort_array(transform(maybe, i -> struct(concat_ws(' ', get(words, i), get(words, i + 1), get(words, i + 2)) as g, i as i)))"))
    df = df.withColumn("maybe", F.expr("sort_array(transform(filter(maybe, (x, k) -> x.g = get(maybe, k - 1).g or x.g = get(maybe, k + 1).g), x -> x.i))"))
    return df.withColumn("n_repeat_words", F.expr("aggregate(maybe, struct(0L as e, 0L as n), (a, p) -> struct(p + 3L as e, a.n + least(3L, p + 3L - a.e) as n)).n")).drop("packed", "maybe")


def features(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The counts that the rules vote on, one row per document, each from its whole text."""
    text = common.text_or_empty(F.col(text_col))
    df = documents.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    df = df.withColumn("words", common.words(F.col("text")))
    df = df.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^ \x09-\x0D]")))
    df = df.select(
        "doc_id", "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("[0-9]")).cast("long").alias("n_digits"),
        F.regexp_count("text", F.lit(BARE_WORD)).cast("long").alias("n_bare_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    return repeated_words(df).drop("words")


def votes(df: DataFrame) -> DataFrame:
    """Adds a vote_<rule> column of -1, 0 or 1 for each rule."""

    def ratio(top: str, bottom: str) -> Column:
        return F.coalesce(F.try_divide(F.col(top), F.col(bottom)), F.lit(0.0))

    df = df.withColumns({
        "mean_word": ratio("word_chars", "n_words"), "symbol_ratio": ratio("n_symbols", "n_words"), "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        "repeat_ratio": ratio("n_repeat_words", "n_words"), "bare_ratio": ratio("n_bare_words", "n_words"), "digit_ratio": ratio("n_digits", "word_chars"),
    })
    return df.withColumns({f"vote_{k}": F.expr(f"case when {bad} then -1 when {good} then 1 else 0 end") for k, bad, good in RULES})


def learn(voted: DataFrame, rounds: int = 40, smooth: float = 1.0) -> Voting:
    """Expectation-maximisation on the counts of vote patterns: at most 3 ** len(RULES) rows reach the driver, for any corpus."""
    names = [f"vote_{k}" for k, *_ in RULES]
    patterns = [(tuple(r[:-1]), r[-1]) for r in voted.groupBy(*names).count().collect()]
    total = sum(n for _, n in patterns)
    if not total:
        return Voting(0.5, tuple(((1 / 3,) * 3, (1 / 3,) * 3) for _ in RULES))
    good = {p: 1 / (1 + math.exp(-1.5 * sum(p) / max(1, sum(map(abs, p))) * 2)) for p, _ in patterns}
    voting = None
    for _ in range(rounds):
        mass = sum(n * good[p] for p, n in patterns)
        given = []
        for i in range(len(RULES)):
            by = [[smooth, smooth, smooth], [smooth, smooth, smooth]]
            for p, n in patterns:
                by[1][p[i] + 1] += n * good[p]
                by[0][p[i] + 1] += n * (1 - good[p])
            given.append(tuple(tuple(x / sum(side) for x in side) for side in by))
        voting = Voting((mass + smooth) / (total + 2 * smooth), tuple(given))
        good = {p: 1 / (1 + math.exp(max(-700.0, min(700.0, -_log_odds(voting, p))))) for p, _ in patterns}
    return voting


def _log_odds(v: Voting, pattern: tuple[int, ...]) -> float:
    return math.log(v.prior / (1 - v.prior)) + sum(math.log(g[1][x + 1] / g[0][x + 1]) for g, x in zip(v.given, pattern, strict=True))


def posterior(voting: Voting) -> Column:
    """P(good) of a row with vote columns, as one expression."""
    odds = F.lit(math.log(voting.prior / (1 - voting.prior)))
    for (name, *_), (bad, good) in zip(RULES, voting.given, strict=True):
        weights = F.array(*[F.lit(math.log(g / b)) for b, g in zip(bad, good, strict=True)])
        odds = odds + F.get(weights, F.col(f"vote_{name}") + 1)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def score(documents: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts, base_failed, votes, quality (posterior) and kept."""
    found = common.written(features(documents, id_col, text_col), "quality")
    voted = votes(found)
    voting = learn(voted)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = voted.withColumn("base_failed", failed).withColumn("quality", F.round(posterior(voting), 9))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")
