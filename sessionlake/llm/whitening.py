"""Embedding whitening by bit-sliced scatter.

Entries become integers. A task takes its rows in blocks, subtracts the block's
least value of each dimension and packs every bit plane of every dimension
across the rows into 64-bit words. The popcount of the AND of two planes,
weighted by their two powers of two, gives the block's exact cross-products;
undoing the shift keeps them exact. Spark sums the tasks' partial sums per pair
of dimensions (two longs each, so nothing overflows), and only the dimensions'
square comes to the driver: n*XX - S*S' is centred as integers and divided once
before ``eigh``. Rows are then projected in Arrow batches, and the whitened
rows' own covariance, summed in blocks that are centred first, is measured
against the identity.

Defined results: rows whose vector is null, empty, or holds null, non-finite or
entries beyond MAX_ENTRY are dropped; so are rows whose length is not the most
common one (ties: the longer), as no covariance joins different lengths. Null
and repeated ids, equal rows and ties are kept as they are. Only components
whose eigenvalue exceeds RANK_TOLERANCE of the largest are returned (constant
columns have none; with equal rows only, nothing is returned). A ``deviation``
beyond a long is null. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import ship

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Entries beyond it have no long after scaling.
MAX_ENTRY = 2.0**55
RANK_TOLERANCE = 1e-12
#: Numbers of a block that are handled at a time.
BLOCK_NUMBERS = 1 << 20
#: Partial sums travel as high * 2**LOW_BITS + low.
LOW_BITS = 40
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def integers(values: np.ndarray) -> np.ndarray:
    return np.floor(values * float(SCALE)).astype(np.int64) + OFFSET


def blocks(batch: pa.RecordBatch, d: int) -> Iterator[tuple[int, np.ndarray]]:
    """Start row and integer matrix of slices of a batch with a column ``v``."""
    col = batch.column(batch.schema.get_field_index("v"))
    flat = np.asarray(col.flatten())
    x = flat.reshape(len(col), d)
    step = max(64, BLOCK_NUMBERS // d)
    for at in range(0, len(col), step):
        yield at, integers(x[at:at + step])


def bit_planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Planes of a non-negative integer matrix as rows of words, and the
    dimension and bit of each."""
    bits = np.array([int(m).bit_length() for m in y.max(axis=0)])
    dims = np.repeat(np.arange(y.shape[1]), bits)
    bit = np.concatenate([np.arange(b) for b in bits]) if len(dims) else np.zeros(0, int)
    pad = -len(y) % 64
    on = ((y.T[dims] >> bit[:, None].astype(np.int64)) & 1).astype(np.uint8)
    words = np.packbits(np.pad(on, ((0, 0), (0, pad))), axis=1).view(np.uint64)
    return words, dims, bit


def cross_products(x: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, sums and cross-products of an integer matrix, exact (objects)."""
    n, d = x.shape
    low = x.min(axis=0)
    y = x - low
    words, dims, bit = bit_planes(y)
    top = int(y.max()).bit_length() if n else 0
    small = 2 * top + n.bit_length() < 62
    kind = np.int64 if small else object
    weight = np.array([1 << int(b) for b in bit], dtype=kind)
    scatter = np.zeros((d, d), dtype=kind)
    for k in range(len(words)):
        both = np.bitwise_count(words[k:] & words[k]).sum(axis=1, dtype=np.int64).astype(kind) * weight[k:] * weight[k]
        # two different planes of one dimension count from either side
        both[1:] *= np.where(dims[k + 1:] == dims[k], 2, 1).astype(kind)
        np.add.at(scatter[dims[k]], dims[k:], both)
    scatter = scatter.astype(object)
    # planes are ordered by dimension, so only the upper triangle was filled
    scatter = np.triu(scatter) + np.triu(scatter, 1).T
    part = y.sum(axis=0, dtype=np.int64 if small else object).astype(object)
    low = low.astype(object)
    sums = part + n * low
    xx = scatter + np.outer(low, part) + np.outer(part, low) + n * np.outer(low, low)
    return n, sums, xx


def _numbers(df: DataFrame, column: str, key: str) -> DataFrame:
    """``id`` and ``v`` of the usable rows, all lengths."""
    ok = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) <= MAX_ENTRY))
    return (df.select(F.col(key).alias("id"), F.col(column).cast("array<double>").alias("v"))
            .filter(F.col("v").isNotNull() & (F.size("v") > 0) & ok))


@dataclass
class Whitening:
    """What was learned of the fit list; ``mean`` is base + rest / n per dimension."""

    n: int
    sums: list[int]
    base: np.ndarray
    rest: np.ndarray
    matrix: np.ndarray
    explained: list[float]


def _summed(rows: DataFrame, d: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Exact n, S and XX over all rows; Spark adds the tasks' parts."""
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, xx = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            for _, x in blocks(batch, d):
                m, a, b = cross_products(x)
                n, s, xx = n + m, s + a, xx + b
        if not n:
            return
        i, j = np.triu_indices(d)
        # S and n ride along as rows -1 and -2
        i = np.concatenate([np.full(d, -1), [-2], i])
        j = np.concatenate([np.arange(d), [0], j])
        values = [*s, n, *xx[np.triu_indices(d)]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([int(v) >> LOW_BITS for v in values], pa.int64()),
             pa.array([int(v) & ((1 << LOW_BITS) - 1) for v in values], pa.int64())], ["i", "j", "high", "low"])

    got = (ship(rows.select("v")).mapInArrow(parts, "i int, j int, high long, low long")
           .groupBy("i", "j").agg(F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum("low").alias("low")).toPandas())
    n, s, xx = 0, np.zeros(d, object), np.zeros((d, d), object)
    for i, j, high, low in zip(got["i"], got["j"], got["high"], got["low"]):
        v = (int(high) << LOW_BITS) + int(low)
        if i == -2:
            n = v
        elif i == -1:
            s[j] = v
        else:
            xx[i, j] = xx[j, i] = v
    return n, s, xx


def covariance(n: int, s: np.ndarray, xx: np.ndarray) -> np.ndarray:
    """Centred as integers, divided once (each entry correctly rounded)."""
    centred = n * xx - np.outer(s, s)
    d = len(s)
    return np.array([[int(centred[i, j]) / (n * n) for j in range(d)] for i in range(d)], dtype=float)


def fit(rows: DataFrame, d: int, components: int = COMPONENTS) -> Whitening | None:
    n, s, xx = _summed(rows, d)
    if not n:
        return None
    v = covariance(n, s, xx)
    e, u = np.linalg.eigh(v)
    order = np.argsort(-e, kind="stable")
    order = [k for k in order if e[k] > RANK_TOLERANCE * max(e[order[0]], 0) and e[k] > 0][:components]
    trace = float(sum(Fraction(float(v[k, k])) for k in range(d)))
    base = np.array([int(a) // n for a in s], dtype=np.int64)
    rest = np.array([int(a) % n for a in s], dtype=np.int64)
    return Whitening(n, [int(a) for a in s], base, rest, u[:, order] / np.sqrt(e[order]), [float(e[k] / trace) for k in order])


def deviations(x: np.ndarray, w: Whitening) -> list[int | None]:
    """Sum over dimensions of (n*x - S)**2, exact; None beyond a long."""
    y = x - w.base
    top = (int(np.abs(y).max()) + 1) * w.n if len(y) else 0
    if top * top * x.shape[1] < 1 << 62:
        z = y * w.n - w.rest
        return (z * z).sum(axis=1).tolist()
    z = y.astype(object) * w.n - w.rest.astype(object)
    return [t if t < 1 << 63 else None for t in (z * z).sum(axis=1)]


def projected(x: np.ndarray, w: Whitening) -> np.ndarray:
    return ((x - w.base).astype(float) - w.rest / w.n) @ w.matrix


def identity_error(rows: DataFrame, d: int, w: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k = w.matrix.shape[1]

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, mean, scatter = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for _, x in blocks(batch, d):
                z = projected(x, w)
                m, mu = len(z), z.mean(axis=0)
                z = z - mu
                step = mu - mean
                scatter += z.T @ z + np.outer(step, step) * (total * m / (total + m))
                mean, total = mean + step * (m / (total + m)), total + m
        if not total:
            return
        i, j = np.triu_indices(k)
        # beside the centred scatter: what the task's own mean adds
        outer = np.outer(mean, mean) * total
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([i, np.full(k, -1)]), pa.int32()), pa.array(np.concatenate([j, np.arange(k)]), pa.int32()),
             pa.array(np.concatenate([(scatter + outer)[i, j], mean * total]))], ["i", "j", "part"])

    got = (rows.select("v").mapInArrow(parts, "i int, j int, part double").groupBy("i", "j").agg(F.sum("part").alias("part")).toPandas())
    cov, mean = np.zeros((k, k)), np.zeros(k)
    for i, j, part in zip(got["i"], got["j"], got["part"]):
        if i < 0:
            mean[j] = part / w.n
        else:
            cov[i, j] = cov[j, i] = part / w.n
    return float(np.abs(cov - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, column: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component, see SCHEMA."""
    rows = _numbers(df, column, key)
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    w = None
    if common is not None:
        d = common["d"]
        rows = rows.filter(F.size("v") == d)
        w = fit(rows, d, components)
    if w is None or not w.explained:
        return df.sparkSession.createDataFrame([], SCHEMA)
    error = identity_error(rows, d, w)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("id"))
            for at, x in blocks(batch, d):
                z = projected(x, w)
                ends = np.arange(0, z.size + 1, z.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(x)).cast(pa.int64()), pa.array(deviations(x, w), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(z.ravel()))], ["vec_id", "deviation", "z"])

    wide = ship(rows).mapInArrow(project, "vec_id long, deviation long, z array<double>")
    explained = F.array(*[F.lit(x) for x in w.explained])
    return (wide.select("vec_id", F.lit(w.n).cast("long").alias("n"), "deviation", F.posexplode("z").alias("p", "whitened"))
            .select("vec_id", (F.col("p") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
                    F.get(explained, F.col("p")).alias("explained"), F.lit(error).alias("identity_error")))
