"""Embedding near-duplicates by int8 tile products with rigorous error bounds.

Equal vectors are one class. Classes are dealt into blocks; every pair of blocks is a tile, and a tile is one group of
bounded size. In it vectors are quantised to int8, products of the integers bound every cosine from above, and only pairs
whose bound reaches the threshold are computed again in double precision. A tile returns link counts and a spanning forest
of its links, and keeps no links beyond a strip of rows, so thousands of near copies stay a few thousand rows.

The bound: u = s q + r with |r| = e and |s q| = n, so u.v <= s_u s_v q_u.q_v + e_u n_v + e_v for unit vectors u and v: each
pair has the slack of its own two vectors. Vectors are scaled by their largest component first, so that none over- or underflows.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components, and rows without an id, link with
nothing; vectors of different lengths don't link; equal rows link with each other. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import common

common.shipped(__name__)
THRESHOLD = 0.9
LEAST_TILE, MOST_TILE = 1024, 16384
#: Rows of a tile multiplied at once, and pairs computed again at once.
ROWS, PAIRS = 512, 65_536


def scaled_rows(x):
    import numpy as np

    return x / np.abs(x).max(axis=1, keepdims=True)


def quantised(u):
    """(integers as float32, scale, length of the rest, length of the quantised vector) of unit rows."""
    import numpy as np

    s = np.abs(u).max(axis=1) / 127
    q = np.rint(u / s[:, None])
    rest = u - q * s[:, None]
    return q.astype(np.int8), s, np.sqrt((rest * rest).sum(axis=1)), s * np.sqrt((q * q).sum(axis=1))


def linked(xa, xb, threshold: float, same: bool):
    """Pairs (i, j) of rows with cosine >= threshold, strip by strip; i < j where both sides are the same rows."""
    import numpy as np

    xa, xb = scaled_rows(xa), scaled_rows(xb)
    ra, rb = (np.sqrt(np.einsum("ij,ij->i", x, x)) for x in (xa, xb))
    (qa, sa, ea, _), (qb, sb, eb, nb) = quantised(xa / ra[:, None]), quantised(xb / rb[:, None])
    wide = xa.shape[1] > 1000  # beyond, sums of products of int8 are not exact in float32
    kind = np.float64 if wide else np.float32
    fb, sb, nb, eb = qb.astype(kind).T, sb.astype(kind), nb.astype(kind), eb.astype(kind)
    for lo in range(0, len(xa), ROWS):
        top = qa[lo : lo + ROWS].astype(kind) @ fb
        top *= sb
        top *= sa[lo : lo + ROWS].astype(kind)[:, None]
        top += ea[lo : lo + ROWS].astype(kind)[:, None] * nb + eb
        i, j = np.nonzero(top >= threshold - 1e-5)
        i += lo
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), PAIRS):
            a, b = i[k : k + PAIRS], j[k : k + PAIRS]
            yes = np.einsum("ij,ij->i", xa[a], xb[b]) / (ra[a] * rb[b]) >= threshold
            yield a[yes], b[yes]


def joined(label, i, j) -> None:
    """Hangs the roots of linked rows on the lesser root, in place, until links hold within one root."""
    import numpy as np

    while True:
        x, y = label[i], label[j]
        odd = x != y
        if not odd.any():
            return
        i, j, x, y = i[odd], j[odd], x[odd], y[odd]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label[:] = label[label]


def tile(threshold: float):
    def run(group):
        import numpy as np
        import pyarrow as pa

        side, rep, many = (group.column(c).to_numpy() for c in ("side", "rep", "many"))
        same = bool(group.column("same")[0].as_py())
        x = group.column("vector").combine_chunks()
        x = np.asarray(x.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(rep), -1)
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == (0 if same else 1))
        n, label = np.zeros(len(rep)), np.arange(len(rep))
        if len(one) and len(two):
            for i, j in linked(x[one], x[two], threshold, same):
                i, j = one[i], two[j]
                n += np.bincount(i, many[j], len(rep)) + np.bincount(j, many[i], len(rep))
                joined(label, i, j)
        got, tied = np.flatnonzero(n), np.flatnonzero(label != np.arange(len(rep)))
        return pa.table({"a": pa.array(np.r_[rep[got], rep[tied]], pa.int64()), "b": pa.array([None] * len(got) + rep[label[tied]].tolist(), pa.int64()), "n": pa.array(n[got].astype(np.int64).tolist() + [None] * len(tied), pa.int64())})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id) for every row."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.coalesce(~bad & F.exists("vector", lambda x: x != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    rows = rows.select("vec_id", F.when(good, F.col("vector")).alias("vector"))
    classes = rows.where("vector is not null").groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("many"))
    classes = common.written(classes, "vectors")
    size = F.least(F.lit(MOST_TILE), F.greatest(F.lit(LEAST_TILE), F.ceil(F.col("n") / 16)))
    dims = classes.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n")).select("dim", F.ceil(F.col("n") / size).cast("int").alias("blocks"))
    dealt = classes.withColumn("dim", F.size("vector")).join(dims, "dim").withColumn("block", F.expr("int(pmod(xxhash64(rep), blocks))"))
    tiles = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("block", j).alias("p"), F.greatest("block", j).alias("q"), (F.col("block") > j).cast("int").alias("side")))
    dealt = dealt.select("dim", "rep", "many", "vector", F.explode(tiles).alias("t"))
    tasks = dims.agg(F.sum(F.expr("blocks * (blocks + 1) div 2"))).first()[0] or 1  # a task for each tile, up to a few thousand
    dealt = dealt.select("dim", "t.p", "t.q", "t.side", (F.col("t.p") == F.col("t.q")).alias("same"), "rep", "many", "vector").repartition(min(4000, int(tasks)), "dim", "p", "q")
    found = common.written(dealt.groupBy("dim", "p", "q").applyInArrow(tile(threshold), "a long, b long, n long"), "tiles")
    counts = found.where("n is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    tied = common.components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "rep")
    member = classes.join(counts, "rep", "left").join(tied, "rep", "left")
    member = member.select("vector", (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = rows.join(member, "vector", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(common.table(spark, sf_dir, "embeddings"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
