"""Rows that once broke an operator."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import lm, secret_scan, substrings, toxicity


@pytest.mark.parametrize("sizes", [[1, 2, 3], [65535], [65534, 65536, 0, 200_000], [131_070, 1]])
def test_sizes_of_long_words(sizes):
    given = np.array(sizes)
    packed, ends = lm.packed_sizes(given, np.array([1, len(sizes)]))
    assert packed.max() <= 65535 and lm.unpacked_sizes(packed).tolist() == sizes and ends[-1] == len(packed)
    assert lm.unpacked_sizes(packed[: ends[0]]).tolist() == sizes[:1]


def test_scores_with_a_very_long_word(spark):
    rows = [(i, f"word{i % 7} again and again word{i % 5}") for i in range(35)] + [(99, "x" + "Zq8+/kW0pLm3" * 8000 + " end")]
    got = {r.doc_id: r for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == 36 and got[99].n_tokens == 3 and all(np.isfinite(r.score) and r.score < 0 for r in got.values())


def test_toxicity_learns_beside_one_large_text(spark):
    rng = np.random.default_rng(2)
    plain = lambda n: [f"plain{k}" for k in rng.integers(0, 30, n)]
    rows = [(i, " ".join(x for w in plain(5) for x in ([w, "stupid"] if i % 2 else [w]))) for i in range(1, 60)]
    docs = spark.createDataFrame([*rows, (1000, "bad " * 20_000), (1001, "fine")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows] + [(1000, 1), (1000, 0), (1001, 0), (1001, 1)], "doc_id long, toxic int")
    field = toxicity.learn(docs, labels.unionByName(spark.createDataFrame([(1002, 1)], "doc_id long, toxic int")), size=9_000)
    assert field is not None
    score = {r.doc_id: r.score for r in toxicity.tagged(docs, field).collect()}
    assert score[5] > score[4] + 0.2


def test_many_secrets_in_one_text(spark):
    text = " ".join(f"deadbeefdeadbeef{k:05x} ok" for k in range(20_000))
    df = spark.createDataFrame([(1, text), (2, "deadbeefdeadbeef00"), (3, "none")], "doc_id long, text string")
    began = time.time()
    got = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in secret_scan.scan(df, ["doc_id"])[0].where(F.col("doc_id").isNotNull()).collect()}
    assert got == {1: [(k * 25, k * 25 + 21) for k in range(20_000)], 2: [(0, 18)], 3: []} and time.time() - began < 60


def test_a_common_phrase_is_dealt_to_all_tasks(spark, monkeypatch):
    """One 40-word phrase in every third document, between different words: no task meets all strings around it."""
    rng = np.random.default_rng(8)
    phrase = [f"common{k}" for k in range(40)]
    plain = lambda n: [f"v{k}" for k in rng.integers(0, 5000, n)]
    bodies = [plain(60) + (phrase if d % 3 == 0 else []) + plain(60) for d in range(900)]
    for d in range(300, 900, 100):
        bodies[d] = bodies[d - 297][:160]
    rows = [(d, " ".join(w)) for d, w in enumerate(bodies)]
    monkeypatch.setattr(substrings, "HOT_STRINGS", 50)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    numbered = docs.selectExpr("doc_id", "xxhash64(text) as rid", "text")
    bits, hot = substrings.shared_minimisers(numbered)
    assert 0 < hot.count() <= 33
    packed = substrings.strings(numbered, spark.sparkContext.broadcast(bits))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # small partitions would be read as one
    dealt = [r["count"] for r in substrings.counted(packed, hot=hot).where("w1 is not null").select(F.spark_partition_id().alias("p"), "h1", "h2").distinct().groupBy("p").count().collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(dealt) > 1 and max(dealt) < 0.5 * sum(dealt)
    first, want = {}, {}
    for d, w in enumerate(bodies):
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), d)
    for d, w in enumerate(bodies):
        gone = set()
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < d:
                gone.update(range(k, k + 50))
        want[d] = " ".join(x for k, x in enumerate(w) if k not in gone)
    assert {r.doc_id: r.kept for r in substrings.without_repeats(docs).collect()} == want


def test_repeats_are_placed_by_the_pass_that_finds_them(spark):
    """The texts' windows are not computed once more for where the strings stand."""
    words = [f"w{k}" for k in range(70)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:60], "other", "end"])), (3, " ".join(["x", *words[5:]]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "xxhash64(text) as rid", "text")
    cuts = substrings.intervals(docs)
    assert "InArrow" not in cuts._jdf.queryExecution().toString()
    got = {r.doc_id: {c.start + k for c in r.cuts for k in range(c.n)} for r in cuts.collect()}
    assert got == {2: set(range(11)), 3: set(range(1, 17))}
