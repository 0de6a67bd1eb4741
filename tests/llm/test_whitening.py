"""Whitening against whole-number arithmetic and numpy, and on rows that are hard."""

import math
from fractions import Fraction

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from ledgerloom.llm import common, whitening


def brute(rows):
    """n, sums, deviations by place, centred rows as doubles."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in rows]
    n, s = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * a - b) ** 2 for a, b in zip(r, s, strict=True)) for r in x]
    return n, deviation, np.array([[float(Fraction(n * a - b, n)) for a, b in zip(r, s, strict=True)] for r in x])


def agrees(got, given, components=32):
    n, deviation, c = brute([v for _, v in given])
    v = c.T @ c / n
    e = np.sort(np.linalg.eigvalsh(v))[::-1][:components]
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert len(got) == len(given) * len(e) and {r.n for r in got} == {n}
    w = np.array([[by[i][k + 1].whitened for k in range(len(e))] for i, _ in given])
    assert [by[i][1].deviation for i, _ in given] == deviation
    assert np.allclose([by[given[0][0]][k + 1].explained for k in range(len(e))], e / np.trace(v), rtol=1e-6)
    assert np.abs(w.T @ w / n - np.eye(len(e))).max() < 1e-6 and got[0].identity_error < 1e-6
    # each column is a projection on an eigenvector: centred rows times it give it back
    for k in range(len(e)):
        direction = c.T @ w[:, k] / n
        assert np.allclose(v @ direction, e[k] * direction, atol=1e-6 * e[0]) and abs(np.linalg.norm(direction) - math.sqrt(e[k])) < 1e-6 * math.sqrt(e[0])


@pytest.mark.parametrize("pairs", [4096, 7])
def test_made_vectors(spark, pairs, monkeypatch):
    monkeypatch.setattr(whitening, "PAIRS", pairs)  # several aggregations
    rng = np.random.default_rng(5)
    given = [(i, [float(c) for c in row]) for i, row in enumerate(rng.normal(size=(300, 6)) * [0.1, 3, 0.5, 8, 1, 0.2])]
    bad = [(900, None), (901, []), (902, [float("nan")] * 6), (903, [None] * 6), (904, [1.0, 2.0]), (905, [float("inf")] + [0.0] * 5)]
    df = spark.createDataFrame(given + bad, "vec_id long, embedding array<double>")
    for name in ("x", "v", "w", "n", "k", "many", "dim", "component", "shares"):
        df = df.withColumn(name, F.lit(name))
    agrees(whitening.whiten(df).collect(), given)


def test_given_vectors(spark):
    df = common.table(spark, SF, "embeddings")
    agrees(whitening.op11_embedding_whitening(spark, SF).collect(), [(r.vec_id, r.embedding) for r in df.collect()])


def test_hard_vectors(spark):
    of = lambda rows: whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert of([]) == [] and of([(1, None), (2, [])]) == []
    alone = of([(1, [0.5, -0.5])])
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [(1, 1, 0, None, 0.0, 0.0), (2, 1, 0, None, 0.0, 0.0)]
    # equal rows, one of them without an id; the second dimension depends on the first
    got = of([(1, [0.0, 0.0]), (1, [0.0, 0.0]), (None, [1.0, 1.0]), (4, [1.0, 1.0])])
    first = [r for r in got if r.component == 1]
    assert sorted(abs(r.whitened) for r in first) == pytest.approx([1.0] * 4) and {r.deviation for r in first} == {2 * 128**2}
    assert {r.whitened for r in got if r.component == 2} == {None} and first[0].explained == pytest.approx(1.0)
    # beyond a long: the decimal holds it
    wide = [r for r in of([(1, [3e38]), (2, [0.0]), (3, [0.0])]) if r.vec_id == 1]
    assert wide[0].deviation is None and wide[0].deviation_exact == (2 * 2**52) ** 2 and wide[0].whitened is not None
