"""What slows training down."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import common, lm, packing


def test_moments_of_unseen_ids_are_never_subnormal(monkeypatch):
    monkeypatch.setattr(lm, "BATCH", 1)
    trainer, kept, classes = lm.Trainer(lm.initial()), np.arange(lm.IDS) % lm.KEPT_IDS, np.arange(lm.KEPT_IDS) % lm.CLASSES
    span = lm.CONTEXT + lm.STRIDE + 1
    rows = np.r_[np.arange(4 * span).reshape(4, span), np.full((1500, span), 900)]
    trainer.learn(rows, np.ones((len(rows), lm.STRIDE), bool), kept, classes)
    for moments in (trainer.m, trainer.v):
        flat = np.abs(np.concatenate([np.ravel(x) for x in moments]))
        assert not ((flat > 0) & (flat < np.finfo(np.float32).tiny)).any()


def test_hashes_of_words_are_summed_up_in_arrays():
    words = pa.array(["river", "mill", "", "été", "river", "mill", "river"])
    got = lm.summed(lm.hashed(words), np.arange(1, 8))
    want = {"river": 13, "mill": 8, "": 3, "été": 4}
    assert dict(zip(*(x.tolist() for x in got))) == {int(np.uint64(xxhash.xxh3_64_intdigest(w.encode())).view(np.int64)): n for w, n in want.items()}
    assert [len(x) for x in lm.summed(np.zeros(0, np.int64), np.zeros(0, np.int64))] == [0, 0]


@pytest.mark.parametrize("least", [1_000_000, 10])
def test_a_task_counts_by_distinct_word_and_sums_its_hashes_up_only_when_many(spark, monkeypatch, least):
    """Ids are counted once for each distinct word of a step, not for each place; hashes wait for their sum."""
    monkeypatch.setattr(lm, "HASHES", least)
    monkeypatch.setattr(packing, "STEP_WORDS", 20)
    rows = [(i, f"River mill river, w{i % 9} " * 5) for i in range(200)]
    calls, real = spark.sparkContext.accumulator(0), lm.summed
    monkeypatch.setattr(lm, "summed", lambda *a: calls.add(1) or real(*a))
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = common.written(lm.spelled(df, packing.vocabulary()), "spelled").where("kind > 0").groupBy("kind", "word").agg(F.sum("n").alias("n")).collect()
    if least > 1000:
        assert calls.value == 1
    words, want = packing.WordIds(packing.vocabulary()), Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            ids, sizes, *_ = packing.text_ids(words, [t.lower().encode()])
            ends = np.cumsum(sizes)
            want.update((1, int(np.uint64(xxhash.xxh3_64_intdigest(w.encode())).view(np.int64))) for w in t.lower().split())
            want.update((kind, int(x)) for kind, own in ((2, ids), (3, ids[ends - sizes]), (4, ids[ends - 1])) for x in own)
    assert {(r.kind, r.word): r.n for r in got} == dict(want)


def test_windows_are_cut_from_chains_with_room_around_them():
    rng = np.random.default_rng(4)
    sizes = np.array([1, 23, 24, 25, 200, 48, 3])
    ids, ends = rng.integers(2, 900, sizes.sum()), np.cumsum(sizes)
    rows, real = lm.windows(ids, ends, 7)
    at = 0
    for lo, hi in zip(ends - sizes, ends, strict=True):
        for start in range(lo, hi, lm.STRIDE):
            places = range(start - lm.CONTEXT - 1, start + lm.STRIDE)
            assert rows[at].tolist() == [ids[k] if lo <= k < hi else 7 for k in places] and real[at].tolist() == [k < hi for k in places[lm.CONTEXT + 1 :]]
            at += 1
    assert at == len(rows) and [len(x) for x in lm.windows(ids[:0], ends[:0])] == [0, 0]


def test_mixture_of_two_probabilities():
    whole, spelling = np.array([-2.0, -9.0, -np.inf, -3.0, -400.0]), np.array([-3.0, -2.0, -5.0, -3.0, -900.0])
    want = np.logaddexp(whole * np.log(10) + np.log(0.9), spelling * np.log(10) + np.log(0.1)) / np.log(10)
    assert np.abs(lm.mixture(whole, spelling, 0.1) - want).max() < 1e-6


def test_frequent_words_are_chosen_by_their_count_without_a_sort(spark, monkeypatch):
    """The words most frequent, by whole counts: no single task reads them all to sort them."""
    monkeypatch.setattr(lm, "SHARED_WORDS", 5)
    assert [lm.least_shared(x) for x in ({}, {1: 9}, {1: 9, 2: 5}, {1: 9, 2: 3, 8: 2}, {1: 9, 2: 4, 8: 2}, {1: 2})] == [1, 2, 2, 2, 8, 1]
    rows = [(i, f"river mill w{i % 9} x{i}") for i in range(60)]
    want = {r.doc_id: (r.n_known, round(r.base_score, 6), round(r.score, 3)) for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    monkeypatch.setattr(lm, "SHARED_WORDS", 400_000)
    assert want == {r.doc_id: (r.n_known, round(r.base_score, 6), round(r.score, 3)) for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
