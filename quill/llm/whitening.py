"""Whitening of embeddings by a polarisation covariance.

Entries become integers (``floor(256 c)``), so every sum below is exact. The fit list
holds each distinct vector once. Two passes over it run in tasks: the count and the
sums ``S`` per dimension; then the squared centred values, summed for every dimension
and for the sum of every pair of dimensions. As ``var(x + y) = var(x) + var(y) +
2 cov(x, y)``, differences of these variances are all cross-covariances; numpy's
``eigh`` takes the assembled matrix apart.

Values are centred before they are squared: at the integer nearest to the mean in the
tasks, and for the remainder exactly, in whole numbers, when the variances are put
together. Sums leave the tasks as 32-bit limbs of one number each and are added up by
Spark, so neither range nor count of the vectors is limited.

The driver holds matrices of dimensions x dimensions, nothing that grows with the
rows; the model sent to the tasks is of that size too. Equal vectors meet after
they are reduced in each task, so one that a third of all rows hold crosses the network
once per task.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries
go, and so do rows whose vector doesn't have the number of dimensions that most
distinct vectors have (ties: the larger); entries beyond 64 bits saturate; repeated
rows are returned each and enter the fit once; rows with a null id are treated like
any other; a component without variance is 0 in every row; an empty table gives no
rows; other columns are not read. ``deviation`` is null where it needs more than 64
bits, ``deviation_exact`` has 38 digits (null beyond).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.io import written

SCALE = 256
COMPONENTS = 4
#: vectors that are squared in one go (bounds a task's memory)
ROWS = 4096
_LIMB = 32
_KINDS = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.int64}
#: a variance below this share of the largest one counts as none
RANK_SHARE = 1e-12

WHITENED = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
            "identity_error double, deviation_exact decimal(38,0)")


def integer_vectors(column) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows of a list column that are whole and finite, and their integer vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.int64), []
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten()                           # entries of non-null lists
    c = pc.cast(pc.fill_null(values, float("nan")), pa.float64()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(c))])
    whole = (size > 0) & (bad[ends] == bad[ends - size])
    with np.errstate(invalid="ignore", over="ignore"):
        f = np.floor(c * SCALE)
    edge = 2.0 ** 63
    x = np.where(np.abs(f) < edge, f, 0).astype(np.int64)
    x[f >= edge], x[f < -edge] = np.iinfo(np.int64).max, np.iinfo(np.int64).min
    rows = np.flatnonzero(whole)
    return rows, [x[ends[i] - size[i]:ends[i]] for i in rows.tolist()]


def packed(x: np.ndarray) -> bytes:
    """One byte string per vector: the width of its integers, then these."""
    low, high = int(x.min()), int(x.max())
    width = next(w for w in _KINDS if -(1 << (8 * w - 1)) <= low and high < 1 << (8 * w - 1))
    return bytes([width]) + x.astype(_KINDS[width]).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, _KINDS[raw[0]], offset=1).astype(np.int64)


def _limbs(key: tuple, value: int) -> Iterator[tuple]:
    """``value`` as signed limbs ``(*key, limb, part)``, whose sums stay in 64 bits."""
    sign, value, at = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield *key, at, sign * (value & ((1 << _LIMB) - 1))
        value >>= _LIMB
        at += 1


def _whole(rows, size: int) -> dict:
    """Collected limb sums back to whole numbers by key."""
    out: dict = {}
    for r in rows:
        key = tuple(r)[:size]
        out[key if size > 1 else key[0]] = out.get(key if size > 1 else key[0], 0) + (r["part"] << (_LIMB * r["limb"]))
    return out


def fit_list(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``(code)``: each distinct integer vector once, written."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = {packed(x) for x in integer_vectors(batch.column(0))[1]}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(codes), pa.binary())], ["code"])

    return written(vectors.select(F.col(column)).mapInArrow(encode, "code binary").distinct())


def _matrices(batches: Iterator[pa.RecordBatch], dims: int | None = None) -> Iterator[np.ndarray]:
    """Vectors of equal length together, at most ``ROWS`` at a time."""
    for batch in batches:
        by_size: dict[int, list] = {}
        for raw in batch.column(0).to_pylist():
            x = unpacked(raw)
            if dims is None or len(x) == dims:
                by_size.setdefault(len(x), []).append(x)
        for group in by_size.values():
            for a in range(0, len(group), ROWS):
                yield np.stack(group[a:a + ROWS])


def count_and_sums(fit: DataFrame) -> tuple[int, int, list[int]]:
    """Dimensions of the fit, its vectors and their sum per dimension."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, int] = {}
        for x in _matrices(batches):
            wide = x if x.size and abs(x).max() < 1 << 40 else x.astype(object)
            for at, s in enumerate((len(x), *wide.sum(axis=0).tolist())):
                key = (x.shape[1], at - 1)              # -1: how many
                total[key] = total.get(key, 0) + int(s)
        yield _limb_batch([r for k, v in total.items() for r in _limbs(k, v)], ("dims", "at"))

    sums = _whole(fit.mapInArrow(add, "dims int, at int, limb int, part long")
                  .groupBy("dims", "at", "limb").agg(F.sum("part").alias("part")).collect(), 2)
    if not sums:
        return 0, 0, []
    dims = max((n, d) for (d, at), n in sums.items() if at == -1)[1]
    return dims, sums[dims, -1], [sums.get((dims, i), 0) for i in range(dims)]


def _limb_batch(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * (len(names) + 2)
    types = [*[pa.int32()] * (len(names) + 1), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [*names, "limb", "part"])


def squared_sums(x: np.ndarray) -> list[int]:
    """Sums over the rows of ``x_i^2`` for every dimension, and of ``(x_i + x_j)^2`` for
    every pair, in the order of ``pair_numbers``."""
    top = int(abs(x).max()) if x.size else 0
    if 4 * top * top * len(x) >= 1 << 62:
        x = x.astype(object)
    out = []
    for i in range(x.shape[1]):
        both = x[:, i:i + 1] + x[:, i + 1:]
        out.append(int((x[:, i] * x[:, i]).sum()))
        out += [int(s) for s in ((both * both).sum(axis=0) if x.dtype == object else np.einsum("rj,rj->j", both, both))]
    return out


def pair_numbers(dims: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(dims) for j in range(i, dims)]


def nearest_mean(total: int, n: int) -> int:
    return (2 * total + n) // (2 * n)


def polarised_covariance(fit: DataFrame, dims: int, n: int, sums: list[int]) -> np.ndarray:
    """Covariance matrix (divisor ``n``): whole-number variances of every dimension and
    of every sum of two, differenced, then rounded once to double precision."""
    middle = [nearest_mean(s, n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle)]    # what centring at an integer leaves over
    pairs = pair_numbers(dims)

    def square(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * len(pairs)
        for x in _matrices(batches, dims):
            centred = x.astype(object) - np.array(middle, object) if abs(x).max() >= 1 << 61 or max(map(abs, middle)) >= 1 << 61 \
                else x - np.array(middle, np.int64)
            total = [a + b for a, b in zip(total, squared_sums(centred))]
        yield _limb_batch([r for k, v in enumerate(total) for r in _limbs((k,), v)], ("pair",))

    squares = _whole(fit.mapInArrow(square, "pair int, limb int, part long")
                     .groupBy("pair", "limb").agg(F.sum("part").alias("part")).collect(), 1)
    # n^2 times the variance of a dimension or of a sum
    spread = {}
    for k, (i, j) in enumerate(pairs):
        left_over = rest[i] if i == j else rest[i] + rest[j]
        spread[i, j] = n * squares.get(k, 0) - left_over * left_over
    cov = np.empty((dims, dims))
    for i, j in pairs:
        twice = 2 * spread[i, i] if i == j else spread[i, j] - spread[i, i] - spread[j, j]
        cov[i, j] = cov[j, i] = twice / (2 * n * n)     # division of integers rounds once
    return cov


@dataclass
class Whitening:
    """What the tasks need: means as integer and remainder over ``n``, the projection,
    shares of the variance, and how far the whitened fit list is from the identity."""
    n: int
    sums: list[int]
    projection: np.ndarray
    explained: list[float]
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        middle = np.array([nearest_mean(s, self.n) for s in self.sums], object)
        rest = np.array([(s - self.n * int(m)) / self.n for s, m in zip(self.sums, middle)], float)
        wide = abs(x).max() >= 1 << 52 or abs(middle).max() >= 1 << 52
        whole = (x.astype(object) - middle).astype(float) if wide else (x - middle.astype(np.int64)).astype(float)
        return whole - rest

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.projection

    def deviations(self, x: np.ndarray) -> list[int]:
        """``sum((n x - S)^2)`` per row, exact."""
        middle = [nearest_mean(s, self.n) for s in self.sums]
        top = max(int(abs(x).max()), max(map(abs, middle)))
        if x.shape[1] * (2 * self.n * (top + 1)) ** 2 < 1 << 62:
            y = self.n * x - np.array(self.sums, np.int64)
            return [int(v) for v in (y * y).sum(axis=1)]
        y = self.n * x.astype(object) - np.array(self.sums, object)
        return [int(v) for v in (y * y).sum(axis=1)]


def fit_whitening(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a table's vectors; None when no row has a usable one."""
    fit = fit_list(vectors, column)
    dims, n, sums = count_and_sums(fit)
    if not n:
        return None
    cov = polarised_covariance(fit, dims, n, sums)
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    trace = float(np.trace(cov))
    has = e > RANK_SHARE * max(float(e[0]), 0.0)
    model = Whitening(n, sums, np.where(has, v / np.sqrt(np.where(has, e, 1.0)), 0.0),
                      [float(x) / trace if trace > 0 else 0.0 for x in np.maximum(e, 0.0)])
    model.identity_error = _identity_error(fit, model, has)
    return model


def _identity_error(fit: DataFrame, model: Whitening, has: np.ndarray) -> float:
    """Largest absolute entry of the whitened fit list's covariance less the identity,
    over components with variance. The list is centred, so sums of products suffice."""
    k, dims = len(has), len(model.sums)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, mean = np.zeros((k, k)), np.zeros(k)
        for x in _matrices(batches, dims):
            w = model.whiten(x)
            total += w.T @ w
            mean += w.sum(axis=0)
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(k * k + k), pa.int32()),
                                          "value": pa.array([*total.ravel(), *mean], pa.float64())})

    rows = fit.mapInArrow(products, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    value = np.zeros(k * k + k)
    for r in rows:
        value[r["at"]] = r["value"]
    mean = value[k * k:] / model.n
    cov = value[:k * k].reshape(k, k) / model.n - np.outer(mean, mean)
    off = np.abs(cov - np.eye(k))[np.ix_(has, has)]
    return float(off.max()) if off.size else 0.0


def whiten(vectors: DataFrame, model: Whitening | None, column: str = "embedding") -> DataFrame:
    """``WHITENED``: one row for each usable row and component."""
    chosen = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column))
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                        ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64()),
                        ("deviation_exact", pa.decimal128(38, 0))])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = integer_vectors(batch.column(1))
            fits = [i for i, x in enumerate(found) if model is not None and len(x) == len(model.sums)]
            for a in range(0, len(fits), ROWS):
                part = fits[a:a + ROWS]
                x = np.stack([found[i] for i in part])
                w, off = model.whiten(x), model.deviations(x)
                k, m = w.shape[1], len(part)
                ids = batch.column(0).take(pa.array(np.repeat(rows[part], k)))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)),
                    pa.array([d if d < 1 << 63 else None for d in off for _ in range(k)], pa.int64()),
                    pa.array(w.ravel()), pa.array(np.tile(model.explained, m)),
                    pa.array(np.full(m * k, model.identity_error)),
                    pa.array([Decimal(d) if d < 10 ** 38 else None for d in off for _ in range(k)], pa.decimal128(38, 0)),
                ], schema=schema)

    return chosen.mapInArrow(project, WHITENED)
