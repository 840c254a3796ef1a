"""Embedding whitening from an exact, bit-sliced scatter matrix.

Entries become integers. Tasks shift each dimension to start at 0, pack its bit planes across
rows into 64-bit words, and AND them: the popcounts of all pairs of planes, weighted by their
powers of two, are exact cross-products. Sums over tasks stay integers, and so does the centring
``n * sum(xy) - sum(x) * sum(y)``; only the result becomes a matrix of doubles for ``eigh``. What
reaches the driver is a few numbers per pair of dimensions, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlode.sources import materialize

COMPONENTS = 16
SCALE = 64
SHIFT = 1_000_000
#: Scaled entries beyond this count as this; so far, sums over 10 ** 13 rows are exact.
FARTHEST = 1 << 40
_BLOCK = 4096  # rows whose bit planes are compared at a time
_SAFE = 1 << 62
_EXACT = "decimal(38,0)"


def integers(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """floor(scale * entry) + shift for each entry."""

    def one(c: Column) -> Column:
        far = F.lit(float(FARTHEST))
        return F.floor(F.greatest(F.least(c.cast("double") * scale, far), -far)).cast("long") + F.lit(shift)

    return F.transform(vector, one)


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows with a vector of finite entries, of the length that most rows have."""
    kept = rows.where(
        F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda c: c.isNotNull() & (F.abs(c) < float("inf"))), F.lit(False))
    )
    lengths = kept.groupBy(F.size(vector).alias("size")).agg(F.count("*").alias("n"))
    often = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    return kept.where(F.size(vector) == (often["size"] if often else -1))


def matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """The integer vectors of a batch, a block at a time, and where the block begins."""
    column = batch.column("x")
    for begin in range(0, batch.num_rows, _BLOCK):
        part = column.slice(begin, _BLOCK)
        yield begin, part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)


def _whole(high: np.ndarray, low: np.ndarray) -> list[str]:
    """(high << 31) + low, which may not fit a long, as decimal text."""
    return [str((h << 31) + n) for h, n in zip(high.tolist(), low.tolist(), strict=True)]


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, held = 0, None
    for batch in batches:
        for _, x in matrices(batch):
            found = np.stack([(x >> 31).sum(axis=0), (x & (2**31 - 1)).sum(axis=0), x.min(axis=0), x.max(axis=0)])
            if held is None:
                held = found
            else:
                held[:2] += found[:2]
                held[2], held[3] = np.minimum(held[2], found[2]), np.maximum(held[3], found[3])
            n += len(x)
    if held is not None:
        dims = held.shape[1]
        yield pa.RecordBatch.from_pydict(
            {
                "dim": pa.array(np.arange(dims, dtype=np.int32)),
                "n": pa.array(np.full(dims, n, np.int64)),
                "total": pa.array(_whole(held[0], held[1])),
                "low": pa.array(held[2]),
                "high": pa.array(held[3]),
            }
        )


def bit_planes(y: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """One row of 64-bit words per dimension and bit; bit r of them belongs to row r of ``y``."""
    rows = -(-len(y) // 64) * 64
    planes = np.zeros((int(bits.sum()), rows), np.uint8)
    dim = np.repeat(np.arange(len(bits)), bits)
    bit = np.arange(len(dim)) - np.repeat(np.cumsum(bits) - bits, bits)
    planes[:, : len(y)] = (y.T[dim] >> bit[:, None]) & 1
    return np.packbits(planes, axis=1, bitorder="little").view(np.uint64)


def cross_products(y: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Sums over the rows of y[i] * y[j] for i <= j, from popcounts of pairs of bit planes."""
    planes = bit_planes(y, bits)
    starts = np.cumsum(bits) - bits
    dim = np.repeat(np.arange(len(bits)), bits)
    bit = np.arange(len(dim)) - starts[dim]
    kind = np.int64 if 2 * int(bits.max(initial=0)) + len(y).bit_length() < 62 else object
    out = np.zeros((len(bits), len(bits)), kind)
    filled = np.flatnonzero(bits)
    weight = np.array([1 << int(b) for b in bit], kind)
    for p in range(len(planes)):
        i = dim[p]
        both = np.bitwise_count(planes[p] & planes[starts[i] :]).sum(axis=1).astype(kind)
        both *= weight[starts[i] :] * weight[p]
        later = filled[filled >= i]
        out[i, later] += np.add.reduceat(both, starts[later] - starts[i])
    return out


def _scatter(low: np.ndarray, bits: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, j = np.triu_indices(len(low))
        high, rest = np.zeros(len(i), object), np.zeros(len(i), np.int64)
        for batch in batches:
            for _, x in matrices(batch):
                found = cross_products(x - low, bits)[i, j]
                high += (found >> 31).astype(object)
                rest += (found & (2**31 - 1)).astype(np.int64)
        if rest.any() or any(high):
            yield pa.RecordBatch.from_pydict(
                {"i": pa.array(i.astype(np.int32)), "j": pa.array(j.astype(np.int32)), "total": pa.array(_whole(high, rest))}
            )

    return scatter


@dataclass(frozen=True)
class Whitening:
    """What whitening needs: per dimension and component, so its size does not follow the rows.

    ``total`` sums the entries less ``low``; ``vectors`` has a column per component.
    """

    n: int
    low: np.ndarray
    high: np.ndarray
    total: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: longs where they and the sum of their squares fit, else integers."""
        far = self.n * max((int(h) - int(low) for h, low in zip(self.high, self.low, strict=True)), default=0)
        if far * far * len(self.low) < _SAFE:
            return (x - self.low) * self.n - np.array(self.total, np.int64)
        return (x - self.low).astype(object) * self.n - np.array(self.total, object)

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        with np.errstate(invalid="ignore", divide="ignore"):
            return (deviations / self.n).astype(float) @ self.vectors / np.sqrt(self.values)

    def defined(self) -> np.ndarray:
        """Components along which the rows vary, beyond the rounding of doubles."""
        return self.values > len(self.low) * np.finfo(float).eps * max(self.trace, 0.0)


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the rows of ``x``, an array of longs; None if there are none."""
    ranges = distinct.mapInArrow(_ranges, "dim int, n long, total string, low long, high long")
    ranges = ranges.groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast(_EXACT)).alias("total"), F.min("low"), F.max("high")
    )
    found = sorted(tuple(r) for r in ranges.collect())  # a row per dimension
    if not found:
        return None
    n = found[0][1]
    low, high = (np.array([r[k] for r in found], np.int64) for k in (3, 4))
    total = [int(r[2]) - n * r[3] for r in found]
    bits = np.array([int(h - w).bit_length() for w, h in zip(low.tolist(), high.tolist(), strict=True)])
    products = distinct.mapInArrow(_scatter(low, bits), "i int, j int, total string")
    products = products.groupBy("i", "j").agg(F.sum(F.col("total").cast(_EXACT)).alias("total"))
    centred = np.zeros((len(low), len(low)))
    known = {(r["i"], r["j"]): int(r["total"]) for r in products.collect()}  # a row per pair of dimensions
    for i in range(len(low)):
        for j in range(i, len(low)):
            exact = n * known.get((i, j), 0) - total[i] * total[j]
            centred[i, j] = centred[j, i] = exact / (n * n)
    values, vectors = np.linalg.eigh(centred)
    values, vectors = values[::-1][:components].copy(), vectors[:, ::-1][:, :components].copy()
    top = np.abs(vectors).argmax(axis=0)
    vectors *= np.where(vectors[top, np.arange(len(top))] < 0, -1.0, 1.0)
    return Whitening(n, low, high, total, vectors, values, float(np.trace(centred)))


def identity_error(distinct: DataFrame, w: Whitening) -> float | None:
    """Largest entry of the covariance of the whitened rows, less the identity."""
    kept = np.flatnonzero(w.defined())

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, both = np.zeros(len(kept)), np.zeros((len(kept), len(kept)))
        for batch in batches:
            for _, x in matrices(batch):
                z = w.whitened(w.deviations(x))[:, kept]
                sums += z.sum(axis=0)
                both += z.T @ z
        i, j = (a.ravel().astype(np.int32) for a in np.indices((len(kept), len(kept) + 1)))
        yield pa.RecordBatch.from_pydict(
            {"i": pa.array(i), "j": pa.array(j), "total": pa.array(np.column_stack([both, sums]).ravel())}
        )

    told = distinct.mapInArrow(products, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total"))
    table = np.zeros((len(kept), len(kept) + 1))
    for i, j, total in told.collect():  # a row per pair of components
        table[i, j] = total / w.n
    mean = table[:, -1]
    found = np.abs(table[:, :-1] - np.outer(mean, mean) - np.eye(len(kept)))
    return float(found.max()) if len(kept) else None


def whiten(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error.

    One row per usable row and component, repeated rows included; ids stay as they are, null ones
    too. Rows are left out whose vector is null, empty, or holds a null or non-finite entry, or
    is of another length than most are (of two lengths as frequent, the longer counts); scaled
    entries beyond 2 ** 40 count as that. Distinct vectors alone are fitted, so copies weigh
    nothing. Along a component without variance (few or equal vectors) ``whitened`` is null; so
    is ``explained`` if there is no variance at all, and ``deviation`` where it fits no long. An
    empty table gives no rows. Only the two named columns are read.
    """
    kept = usable(rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v")), "v")
    kept = kept.select("vec_id", integers(F.col("v"), scale, shift).alias("x"))
    distinct = materialize(kept.select("x").distinct(), "distinct-vectors")
    w = fit(distinct, components)
    kind = dict(rows.dtypes)[id_col]
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double"
    if w is None:
        none = F.lit(None).cast("double").alias("identity_error")
        return rows.sparkSession.createDataFrame([], schema).select("*", none)
    error, defined, many = identity_error(distinct, w), w.defined(), len(w.values)
    explained = np.clip(w.values / w.trace, 0, 1) if w.trace > 0 else np.full(many, np.nan)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, x in matrices(batch):
                d = w.deviations(x)
                square = [s if s < 2**63 else None for s in (d * d).sum(axis=1).tolist()]
                z = w.whitened(d)
                ids = batch.column("vec_id").take(pa.array(begin + np.repeat(np.arange(len(x)), many)))
                none = np.tile(~defined, len(x))
                share = np.tile(explained, len(x))
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": ids,
                        "component": pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(x))),
                        "n": pa.array(np.full(len(x) * many, w.n, np.int64)),
                        "deviation": pa.array(square, pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), many))),
                        "whitened": pa.array(z.ravel(), mask=none),
                        "explained": pa.array(share, mask=np.isnan(share)),
                    }
                )

    found = kept.mapInArrow(project, schema)
    return found.withColumn("identity_error", F.lit(error).cast("double"))
