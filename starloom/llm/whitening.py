"""Whitening of embeddings by principal components, with the covariance recovered from variances (polarisation).

1. Each entry c becomes the whole number floor(``SCALE`` * c) + ``SHIFT``; the fit list is every distinct vector of these once, n in number.
2. One pass sums every dimension, S. A second one takes D = n * x - S, the exact centred values, and sums D_i**2 for each dimension and
   (D_i + D_j)**2 for each pair of dimensions, exactly. Half of what the latter exceeds the former two by is the sum of D_i * D_j, so the
   covariance is a quotient of whole numbers, rounded once. Only these d * (d + 1) / 2 sums reach the driver, for eigh.
3. Vectors are projected in the tasks. The covariance of the projected fit list tells how far it is from the identity.

Defined results: rows whose vector is null or holds null or non-finite entries are left out; rows without id and repeated rows are transformed like all
others, yet equal vectors count once in the fit; a component without variance (the fit list spans fewer dimensions) has ``whitened`` 0, ``explained`` 0 and no part in
``identity_error``; an empty table, and vectors without entries, give an empty result; other columns are ignored. Vectors of different lengths raise ValueError. The
sums are exact up to centred values of 2**49; ``deviation`` must fit a long. Both raise OverflowError beyond.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import read
from starloom.session import materialise

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Vectors of which the squares are summed at once.
ROWS_AT_ONCE = 4096
WHOLE = pa.decimal128(38, 0)


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    finite = F.forall(vector, lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def whole_numbers(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, x`` of the usable rows."""
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT).cast("long"))
    return rows.filter(usable(F.col(vector))).select(F.col(id_column).cast("long").alias("vec_id"), x.alias("x"))


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dims)


def _parts(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield _matrix(batch.slice(at, ROWS_AT_ONCE), dims)


def totals(fit: DataFrame, dims: int) -> list[int]:
    """The sum of each dimension."""

    def run(batches):
        total = [0] * dims
        for x in _parts(batches, dims):
            low = x.min(axis=0)
            total = [t + int(s) + len(x) * int(o) for t, s, o in zip(total, (x - low).sum(axis=0), low, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([Decimal(t) for t in total], WHOLE)], names=["i", "total"])

    found = fit.select("x").mapInArrow(run, "i int, total decimal(38,0)").groupBy("i").agg(F.sum("total").alias("total")).collect()
    return [int(r.total) for r in sorted(found, key=lambda r: r.i)]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exactly; written so that no step is larger than the result."""
    base = np.array([s // n for s in sums], np.int64)
    over = np.array([s - n * (s // n) for s in sums], np.int64)
    away = x - base
    if away.size and int(np.abs(away).max()) * n >= 1 << 49:
        raise OverflowError("centred values beyond 2**49")
    return away * np.int64(n) - over


def _sum_of_squares(t: np.ndarray) -> list[int]:
    """Exact sums of squares of the columns of at most ``ROWS_AT_ONCE`` rows below 2**50."""
    most = int(np.abs(t).max(initial=0))
    if most * most * len(t) < 1 << 63:
        return np.einsum("ij,ij->j", t, t).tolist()
    high, low = t >> 25, t & ((1 << 25) - 1)
    hh, hl, ll = (np.einsum("ij,ij->j", a, b).tolist() for a, b in ((high, high), (high, low), (low, low)))
    return [(a << 50) + (b << 26) + c for a, b, c in zip(hh, hl, ll, strict=True)]


def squares(fit: DataFrame, n: int, sums: list[int]) -> dict[tuple[int, int], int]:
    """The sum of squared centred values of each dimension (i, i) and of each sum of two dimensions (i, j)."""
    dims = len(sums)

    def run(batches):
        total = [[0] * (dims - i) for i in range(dims)]
        for x in _parts(batches, dims):
            d = centred(x, n, sums)
            for i in range(dims):
                t = d[:, i:].copy()
                t[:, 1:] += d[:, i : i + 1]
                total[i] = [a + b for a, b in zip(total[i], _sum_of_squares(t), strict=True)]
        pairs = [(i, j) for i in range(dims) for j in range(i, dims)]
        i, j = zip(*pairs, strict=True)
        of = [Decimal(v) for row in total for v in row]
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(of, WHOLE)], names=["i", "j", "of"])

    found = fit.select("x").mapInArrow(run, "i int, j int, of decimal(38,0)").groupBy("i", "j").agg(F.sum("of").alias("of")).collect()
    return {(r.i, r.j): int(r.of) for r in found}


def covariance(of: dict[tuple[int, int], int], n: int, dims: int) -> np.ndarray:
    """Each covariance is a quotient of whole numbers, rounded once."""
    v = np.empty((dims, dims))
    for (i, j), s in of.items():
        v[i, j] = v[j, i] = s / n**3 if i == j else (s - of[i, i] - of[j, j]) / (2 * n**3)
    return v


@dataclass(frozen=True)
class Whitener:
    """What a vector is centred by, and its components by falling variance, each over the root of its variance."""

    n: int
    sums: list[int]
    columns: np.ndarray
    explained: np.ndarray
    alive: int

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of squared centred values, and the components, of each row."""
        d = centred(x, self.n, self.sums)
        most = int(np.abs(d).max(initial=0))
        if most * most * max(1, d.shape[1]) >= 1 << 63:
            raise OverflowError("deviation beyond a long")
        return np.einsum("ij,ij->i", d, d), (d / self.n) @ self.columns


def fit_list(x: DataFrame) -> DataFrame:
    """Every distinct vector once, in a table. Copies are merged before they are shuffled."""
    return materialise(x.select("x").distinct(), "fit-list")


def whitener(fit: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    n, dims, least = fit.agg(F.count(F.lit(1)), F.max(F.size("x")), F.min(F.size("x"))).first()
    if dims != least:
        raise ValueError(f"vectors of {least} and of {dims} entries")
    if not n or not dims:
        return None
    sums = totals(fit, dims)
    v = covariance(squares(fit, n, sums), n, dims)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    trace = float(np.trace(v))
    alive = int(np.count_nonzero(values > 16 * dims * np.finfo(float).eps * trace))
    scale = np.where(np.arange(len(values)) < alive, 1 / np.sqrt(np.where(values > 0, values, 1)), 0.0)
    explained = np.where(np.arange(len(values)) < alive, values / (trace or 1.0), 0.0)
    return Whitener(n, sums, np.ascontiguousarray(vectors * scale), explained, alive)


def transform(x: DataFrame, model: Whitener) -> DataFrame:
    """``vec_id, deviation, whitened`` (an array of all components) of ``vec_id, x``."""
    dims = len(model.sums)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                deviation, w = model(_matrix(part, dims))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, w.shape[1]), pa.int32()), pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays([part["vec_id"], pa.array(deviation, pa.int64()), lists], names=["vec_id", "deviation", "whitened"])

    return x.select("vec_id", "x").mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def identity_error(fit: DataFrame, model: Whitener) -> float:
    """The largest entry of the whitened fit list's covariance minus the identity."""
    if not model.alive:
        return 0.0
    w = transform(fit.select(F.lit(None).cast("long").alias("vec_id"), "x"), model)
    pairs = [(i, j) for i in range(model.alive) for j in range(i, model.alive)]
    entry = w.select(*[F.col("whitened")[i].alias(f"w{i}") for i in range(model.alive)])
    row = entry.agg(*[F.covar_pop(f"w{i}", f"w{j}") for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(row, pairs, strict=True))


def whiten(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Whitener | None, float]:
    """``vec_id, deviation, whitened`` of the usable rows, the model, and how far the whitened fit list is from white."""
    x = whole_numbers(rows, id_column, vector)
    fit = fit_list(x)
    model = whitener(fit, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], "vec_id long, deviation long, whitened array<double>"), None, 0.0
    return transform(x, model), model, identity_error(fit, model)


def op12_whitening(spark, sf_dir):
    white, model, error = whiten(read(spark, sf_dir, "embeddings"))
    explained = F.array(*[F.lit(float(e)) for e in model.explained]) if model else F.array().cast("array<double>")
    long = white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return long.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )


QUERIES = {"op12_whitening": op12_whitening}
