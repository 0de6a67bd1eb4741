"""Tiles of near-duplicates pass on few pairs."""

import numpy as np
import pytest

from ledgerloom.llm import common, minhash


@pytest.mark.parametrize("passed", [0, 1])
def test_minhash_tiles_pass_on_few_pairs(spark, monkeypatch, passed):
    """Bits that tell no texts apart: every pair of a tile is a candidate, yet a tile passes on two rows a class at most."""
    monkeypatch.setattr(minhash, "PASSED", passed)
    monkeypatch.setattr(minhash, "bounded", lambda n, bits, i, j, percent: (i, j, np.zeros(len(i))))
    seen, real = [], minhash.by_tile

    def by_tile(placed, *more):
        out = common.written(real(placed, *more), "tiles")
        seen.append((out.count(), placed.count()))
        return out

    monkeypatch.setattr(minhash, "by_tile", by_tile)
    shared = [f"s{k}" for k in range(60)]
    rows = [(10 * g + c, " ".join([*shared, *[f"g{g}k{k}" for k in range(24)], f"c{c}"])) for g in range(60) for c in range(3)]
    got = {r.doc_id: r.component_id for r in minhash.clusters(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i // 10 * 10 for i, _ in rows}
    assert len(seen) == 2 and all(made <= 2 * many for made, many in seen)
