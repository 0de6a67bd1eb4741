"""Embedding whitening by upper-triangle column aggregates.

Entries become integers x = floor(64 c) + 1000000. One aggregation sums every dimension; from the sums, generated SQL
expressions centre each column, and one aggregation sums the centred products of every pair of dimensions i <= j. The
covariance is put together on the driver (dimensions squared, whatever the rows) and decomposed by LAPACK; tasks project
rows in Arrow batches. What comes out is measured again: the covariance of the projections, by the same aggregates.

Centring loses nothing: S = m n + r with whole m and 0 <= r < n, so x - S/n is the exact integer x - m less r/n. Beyond
PAIRS pairs (about 90 dimensions) the triangle is summed in several aggregations of so many expressions each.

Edge cases: rows whose vector is null, empty or holds null or non-finite entries are left out, and so are vectors of
another length than most (ties: the longer), which have no place in one covariance. Entries beyond 2^46 in size count as
that, so that x is a whole number in double precision too. Repeated rows and rows without an id count and are returned.
Directions without variance to double precision (one row only, equal rows, dependent dimensions) have no whitened value:
null; `identity_error` speaks of the others and is 0 without any. `deviation` is null where it doesn't fit a long;
`deviation_exact` is a decimal that holds it up to 38 digits. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import common

common.shipped(__name__)
SCALE, SHIFT, LARGEST = 64, 1_000_000, 2**46
COMPONENTS = 32
#: Products summed by one aggregation.
PAIRS = 4096


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x array<bigint>) of the rows that have a place in the fit."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    entry = lambda c: F.floor(F.least(F.greatest(c, F.lit(-float(LARGEST))), F.lit(float(LARGEST))) * SCALE).cast("long") + SHIFT
    rows = rows.where(F.coalesce(~bad, F.lit(False)) & (F.size("v") > 0)).select("vec_id", F.transform("v", entry).alias("x"))
    rows = common.written(rows, "integers")
    most = rows.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("many")).orderBy(F.desc("many"), F.desc("dim")).first()
    return rows.where(F.size("x") == (most.dim if most else 0))


@dataclass(frozen=True)
class Sums:
    n: int
    total: list[int]
    spread: int  # the largest x less the least

    def centred(self, column: str, i: int) -> Column:
        m, r = divmod(self.total[i], self.n)
        return F.expr(f"cast(element_at({column}, {i + 1}) - {m}L as double) - {r / self.n!r}D")


def sums(rows: DataFrame) -> Sums | None:
    first = rows.select(F.size("x")).first()
    if first is None:
        return None
    exact = [F.sum(F.col("x")[i].cast("decimal(18,0)")).alias(f"s{i}") for i in range(first[0])]
    got = rows.agg(F.count("*"), F.min(F.array_min("x")), F.max(F.array_max("x")), *exact).first()
    return Sums(got[0], [int(s) for s in got[3:]], got[2] - got[1])


def covariance(columns: DataFrame, n: int):
    """The divisor-n covariance of double columns that are centred: one sum for each pair of the upper triangle."""
    import numpy as np

    names = columns.columns
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    out = np.zeros((len(names), len(names)))
    for at in range(0, len(pairs), PAIRS):
        part = pairs[at : at + PAIRS]
        got = columns.agg(*[F.expr(f"sum(`{names[i]}` * `{names[j]}`)").alias(f"p{k}") for k, (i, j) in enumerate(part)]).first()
        for (i, j), v in zip(part, got, strict=True):
            out[i, j] = out[j, i] = v / n
    return out


def directions(v, components: int):
    """(eigenvalues falling, eigenvectors by column, how many have variance), the first so many."""
    import numpy as np

    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return e, u, int((e > len(v) * np.finfo(float).eps * max(e[0], 0)).sum())


def projector(fit: Sums, u, root):
    """Batches of integers to deviations and projections."""
    import numpy as np

    m = np.array([s // fit.n for s in fit.total], np.int64)
    r = [s % fit.n for s in fit.total]
    low, rest = np.array(r) / fit.n, np.array(r, object)
    fits = (fit.n * (fit.spread + 1)) ** 2 * len(m) < 2**63

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            x = batch.column("x")
            d = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1) - m
            whole = (d * fit.n - rest.astype(np.int64)) if fits else (d.astype(object) * fit.n - rest)
            deviation = [int(k) if abs(int(k)) < 10**38 else None for k in (whole * whole).sum(axis=1)]
            w = (d - low) @ u / root
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(deviation, pa.decimal128(38, 0)), pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), w.shape[1]).cast(pa.list_(pa.float64()))], ["vec_id", "deviation_exact", "w"])

    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each vector and component: (vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact)."""
    import numpy as np

    rows = integers(vectors, id_col, vector_col)
    kind = rows.schema["vec_id"].dataType.simpleString()
    fit = sums(rows)
    if fit is None:
        nothing = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"
        return vectors.sparkSession.createDataFrame([], nothing)
    dim = len(fit.total)
    v = covariance(rows.select(*[fit.centred("x", i).alias(f"x{i}") for i in range(dim)]), fit.n)
    e, u, varied = directions(v, components)
    root = np.sqrt(np.where(np.arange(len(e)) < varied, np.maximum(e, 1e-300), 1.0))
    out = common.written(rows.mapInArrow(projector(fit, u, root), f"vec_id {kind}, deviation_exact decimal(38,0), w array<double>"), "whitened")
    error = 0.0
    if varied:
        mean = out.agg(*[F.avg(F.col("w")[k]) for k in range(varied)]).first()
        again = covariance(out.select(*[(F.col("w")[k] - F.lit(mean[k])).alias(f"w{k}") for k in range(varied)]), fit.n)
        error = float(np.abs(again - np.eye(varied)).max())
    share = e / np.trace(v) if np.trace(v) > 0 else np.zeros(len(e))
    shares = F.array(*[F.lit(float(s)) for s in share])
    out = out.select("vec_id", "deviation_exact", shares.alias("shares"), F.posexplode("w").alias("k", "w"))
    whitened = F.when(F.col("k") < varied, F.col("w"))
    return out.select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(fit.n).cast("long").alias("n"), F.expr("try_cast(deviation_exact as bigint)").alias("deviation"),
        whitened.alias("whitened"), F.col("shares")[F.col("k")].alias("explained"), F.lit(error).alias("identity_error"), "deviation_exact",
    )


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(common.table(spark, sf_dir, "embeddings"))
