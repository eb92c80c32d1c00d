"""Embedding whitening from a covariance by polarisation.

An entry c of a vector becomes the whole number x = floor(1024 c) + 100000.  Two passes over the vectors give the
covariance exactly.  The first counts them (n) and sums each dimension (S).  The second centres every x at the
whole number m next to its dimension's mean, z = x - m, and sums z squared for every dimension, and (z_a + z_b) squared
for every pair of dimensions.  What m leaves of the mean, R = S - n m, comes off in whole numbers too:
n^2 Var(a) = n sum(z_a^2) - R_a^2, likewise for sums of two dimensions with R_a + R_b, and

    Cov(a, b) = (Var(a + b) - Var(a) - Var(b)) / 2,

whose one rounding is the last division.  ``eigh`` of that matrix gives the components.

Tasks sum in 64 bits where that is exact (else in Python's whole numbers), and hand on each sum once, in two
parts of 60 bits, as decimals; Spark adds them.  The driver gets one row for a pair of dimensions, whatever the number of vectors.

Defined cases: vectors null or with null or non-finite entries take no part; nor do those whose length isn't the most
frequent one (the shorter, if two are), nor those with an entry of 2^50 or more, whose x leaves a long no room.  Repeated rows
and null ids count like others.  A component whose eigenvalue is zero to double precision can't be scaled and isn't
returned, so one vector, or equal ones alone, give no rows, like an empty table.  ``deviation`` is null where it exceeds a long.
Other columns aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rewardloom.llm.common import materialize

STEP, LIFT, LARGEST = 1024, 100000, 2.0**50
_LIMB = 60
_SUMS = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64()), ("high", pa.decimal128(38, 0)), ("low", pa.decimal128(38, 0))])
_SUMS_SQL = "a int, b int, n long, high decimal(38,0), low decimal(38,0)"


@dataclass
class Whitening:
    n: int
    near: list            # the whole number m next to each dimension's mean
    rest: list            # R = S - n m
    covariance: np.ndarray
    values: np.ndarray    # eigenvalues, falling; those of zero left out
    vectors: np.ndarray   # unit eigenvectors, a column each

    @property
    def explained(self) -> list:
        trace = float(np.trace(self.covariance))
        return [float(e) / trace for e in self.values]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    fits = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST))
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(F.col("v").isNotNull() & fits))
    length = rows.groupBy(F.size("v").alias("s")).count().orderBy(F.desc("count"), "s").first()
    return rows.where(F.size("v") == (length["s"] if length else 0))


def whole(column) -> np.ndarray:
    """(rows, dims) x of an Arrow list column."""
    c = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return np.floor(STEP * c).astype(np.int64) + LIFT


def column_sums(values: np.ndarray) -> list:
    """Exact sums of a (rows, k) array of whole numbers, as Python's."""
    if values.dtype == object or not values.size:
        return [sum(c) for c in values.T.tolist()]
    most = max(int(values.max()), -int(values.min()), 1)
    step = max(1, (2**62) // most)
    return [int(x) for x in sum((values[i:i + step].sum(axis=0).astype(object) for i in range(0, len(values), step)))]


def squares(z: np.ndarray) -> list:
    """Sums of z_a^2 and (z_a + z_b)^2, a row (a, a..d) after the other."""
    if z.size and 2 * int(np.abs(z).max()) >= 2**31:
        z = z.astype(object)
    out = []
    for a in range(z.shape[1]):
        both = np.concatenate([z[:, a:a + 1], z[:, a:a + 1] + z[:, a + 1:]], axis=1)
        out += column_sums(both * both)
    return out


def _handed_on(pairs: list, n: int, sums: list) -> pa.RecordBatch:
    a, b = zip(*pairs)
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array([n] * len(a), pa.int64()),
         pa.array([Decimal(s >> _LIMB) for s in sums], pa.decimal128(38, 0)),
         pa.array([Decimal(s & ((1 << _LIMB) - 1)) for s in sums], pa.decimal128(38, 0))], schema=_SUMS)


def _summed(rows: DataFrame, run) -> dict:
    """{(a, b): (n, sum)} of what the tasks hand on."""
    got = rows.select("v").mapInArrow(run, _SUMS_SQL).groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"))
    return {(r.a, r.b): (r.n, (int(r.high) << _LIMB) + int(r.low)) for r in got.collect()}        # one row a pair of dimensions


def _totals(batches):
    n, sums = 0, None
    for batch in batches:
        if batch.num_rows:
            x = column_sums(whole(batch.column("v")))
            n, sums = n + batch.num_rows, x if sums is None else [s + t for s, t in zip(sums, x)]
    if sums:
        yield _handed_on([(a, a) for a in range(len(sums))], n, sums)


def _squared(near: list):
    def run(batches):
        n, sums, m = 0, None, np.array(near, np.int64)
        for batch in batches:
            if batch.num_rows:
                q = squares(whole(batch.column("v")) - m)
                n, sums = n + batch.num_rows, q if sums is None else [s + t for s, t in zip(sums, q)]
        if sums:
            yield _handed_on([(a, b) for a in range(len(near)) for b in range(a, len(near))], n, sums)
    return run


def fit(rows: DataFrame) -> Whitening | None:
    """The whitening of (…, v) rows of one length; None if there is none."""
    first = _summed(rows, _totals)
    if not first:
        return None
    d, n = len(first), first[0, 0][0]
    total = [first[a, a][1] for a in range(d)]
    near = [(2 * s + n) // (2 * n) for s in total]
    rest = [s - n * m for s, m in zip(total, near)]
    q = {k: v for k, (_, v) in _summed(rows, _squared(near)).items()}
    spread = [n * q[a, a] - rest[a]**2 for a in range(d)]                    # n^2 times the variance
    cov = np.empty((d, d))
    for a in range(d):
        cov[a, a] = spread[a] / n**2
        for b in range(a + 1, d):
            cov[a, b] = cov[b, a] = (n * q[a, b] - (rest[a] + rest[b])**2 - spread[a] - spread[b]) / (2 * n**2)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(d)] < 0, -1, 1)      # one sign for all runs
    real = values > d * np.finfo(float).eps * max(values[0], 0)
    return Whitening(n, near, rest, cov, values[real], vectors[:, real])


def deviations(z: np.ndarray, n: int, rest: list) -> list:
    """Sum over dimensions of (n z - R)^2 of each row, exact; None where it exceeds a long."""
    most = n * max(int(np.abs(z).max()), 1) + max(abs(r) for r in rest)
    if most**2 * len(rest) < 2**63:
        y = n * z - np.array(rest, np.int64)
        return (y * y).sum(axis=1).tolist()
    exact = (sum((n * v - r)**2 for v, r in zip(row, rest)) for row in z.tolist())
    return [x if x < 2**63 else None for x in exact]


def whitened(rows: DataFrame, w: Whitening, components: int) -> DataFrame:
    """(vec_id, deviation, white): the rows on the first components, each scaled to variance one."""
    by = w.vectors[:, :components] / np.sqrt(w.values[:components])
    m, left, n, rest = np.array(w.near, np.int64), np.array([r / w.n for r in w.rest]), w.n, w.rest
    shape = pa.schema([("vec_id", pa.int64()), ("deviation", pa.int64()), ("white", pa.list_(pa.float64()))])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                z = whole(batch.column("v")) - m
                white = (z - left) @ by
                ends = pa.array(np.arange(len(z) + 1) * by.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(deviations(z, n, rest), pa.int64()),
                                                  pa.ListArray.from_arrays(ends, pa.array(white.ravel()))], schema=shape)

    return rows.mapInArrow(run, "vec_id long, deviation long, white array<double>")


def identity_error(white: DataFrame, n: int, components: int) -> float:
    """Largest absolute entry of the covariance of ``white`` minus the identity."""
    def run(batches):
        total, mean = np.zeros((components, components)), np.zeros(components)
        for batch in batches:
            x = batch.column("white").flatten().to_numpy(zero_copy_only=False).reshape(-1, components)
            total, mean = total + x.T @ x, mean + x.sum(axis=0)
        a, b = np.triu_indices(components)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([a, np.full(components, -1)]), pa.int64()), pa.array(np.concatenate([b, np.arange(components)]), pa.int64()),
             pa.array(np.concatenate([total[a, b], mean]))], names=["a", "b", "s"])

    sums = {(r.a, r.b): r.s / n for r in white.select("white").mapInArrow(run, "a long, b long, s double")
            .groupBy("a", "b").agg(F.sum("s").alias("s")).collect()}                     # one row a pair of components
    return max(abs(sums[a, b] - sums[-1, a] * sums[-1, b] - (a == b)) for a in range(components) for b in range(a, components))


def whiten(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error)."""
    rows = usable(vectors, id_col, vector_col)
    w = fit(rows)
    k = min(components, len(w.values)) if w else 0
    if not k:
        return vectors.sparkSession.createDataFrame(
            [], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    white = materialize(whitened(rows, w, k), "whitened")
    error = identity_error(white, w.n, k)
    share = F.array(*[F.lit(e) for e in w.explained[:k]])
    return (white.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened"))
                 .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation", "whitened",
                         F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error")))
