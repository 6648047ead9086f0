"""Whitening of embeddings by a bit-sliced scatter matrix (operator 12).

Entries become whole numbers x. Each dimension, shifted so that its least x is 0, is taken apart into bit
planes, and a plane of many rows is packed into machine words. The number of rows that have bit a of
dimension i and bit b of dimension j is the population count of two planes' and; counts weighted by
2^(a + b) give the exact cross-products. Sums of them are kept as limbs of 40 bits, so they are exact at
any number of rows. On the driver the scatter matrix, whose size is that of the dimensions only, is
centred in whole numbers, n * sum(xy) - sum(x) * sum(y), before a double is made of it for the
eigenvectors. Rows are centred in whole numbers as well.

The table is read five times and never shuffled: for the dimension, the least x, the scatter, the
covariance of the whitened rows, and the result.

Defined cases: vectors that are null, or hold a null, non-finite or beyond-long entry, are dropped; so are
those whose length isn't the most frequent one (of equals the longest), as if the rest were null; empty
vectors and empty tables give no rows; a null or repeated id is a row like others; a component without
variance gives whitened 0 and stands apart from the identity error; a deviation beyond what 38 digits
hold is null; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molspark.llm.common import arrow_schema, schema_of

SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 55)  # entries from here on have no long x with room for the shift
COMPONENTS = 32
ROWS = 1 << 16  # rows whose planes are packed at once
LIMB, LIMBS = 40, 5
FLAT = 1e-12  # a component with less of the largest variance than this has none


def usable(vector: Column) -> Column:
    """No entry is null, non-finite or too large. A null vector is not usable."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) >= F.lit(LARGEST)))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def whole(values: np.ndarray) -> np.ndarray:
    return np.floor(values.astype(np.float64) * SCALE).astype(np.int64) + SHIFT


def blocks(batches: Iterator[pa.RecordBatch], dims: int, rows: int = ROWS) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, x) of up to `rows` vectors at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            if part.num_rows:
                yield part.column(0), whole(part.column(1).flatten().to_numpy(zero_copy_only=False)).reshape(-1, dims)


def planes(u: np.ndarray, bits: list[int]) -> np.ndarray:
    """Bit planes of the columns of u, each packed over the rows into 64-bit words."""
    padded = np.zeros((-(-len(u) // 64) * 64, u.shape[1]), np.int64)
    padded[: len(u)] = u
    out = [
        np.packbits((padded[:, d] >> b & 1).astype(np.uint8)).view(np.uint64) for d, n in enumerate(bits) for b in range(n)
    ]
    return np.stack(out)


def plane_counts(words: np.ndarray) -> np.ndarray:
    """How many rows both planes of each pair have; the upper triangle."""
    out = np.zeros((len(words), len(words)), np.int64)
    for k, plane in enumerate(words):
        out[k, k:] = np.bitwise_count(words[k:] & plane).sum(1, dtype=np.int64)
    return out


def products(counts: np.ndarray, bits: list[int]) -> tuple[list[int], dict[tuple[int, int], int]]:
    """Sums of each dimension, and of products of two dimensions, from the counts of their planes."""
    weights = np.array([1 << b for n in bits for b in range(n)], object)
    full = np.triu(counts) + np.triu(counts, 1).T
    starts = np.r_[0, np.cumsum(bits)[:-1]]
    weighted = full.astype(object) * weights
    by_dim = np.add.reduceat(weighted, starts, axis=1)
    both = np.add.reduceat(by_dim * weights[:, None], starts, axis=0)
    own = np.add.reduceat(np.diag(counts).astype(object) * weights, starts)
    return own.tolist(), {(i, j): both[i, j] for i in range(len(bits)) for j in range(i, len(bits))}


def limbs(value: int) -> list[int]:
    return [value >> LIMB * k & (1 << LIMB) - 1 for k in range(LIMBS)]


class Fit(NamedTuple):
    """What whitening needs; its size is that of the dimensions."""

    n: int
    sums: list[int]  # of x, by dimension
    low: np.ndarray
    high: np.ndarray
    values: np.ndarray  # variances, falling
    vectors: np.ndarray  # unit columns
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: longs if those hold it, else Python's numbers."""
        most = max(max(abs(self.n * int(v) - s) for v in (a, b)) for a, b, s in zip(self.low, self.high, self.sums))
        fits = most < 1 << 62 and self.n * max(abs(self.low).max(), abs(self.high).max()) < 1 << 62
        if fits:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def deviations(self, centred: np.ndarray) -> list[Decimal | None]:
        """Sums of squares of the rows."""
        if centred.dtype != object:
            most = int(np.abs(centred).max(initial=0))
            if most * most * centred.shape[1] >= 1 << 62:
                centred = centred.astype(object)
        found = (centred * centred).sum(1).tolist()
        return [Decimal(v) if v < 10**38 else None for v in map(int, found)]

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        flat = self.values <= FLAT * self.values.max(initial=0)
        scale = np.where(flat, 0, 1 / np.sqrt(np.where(flat, 1, self.values)))
        return (centred / self.n).astype(np.float64) @ (self.vectors * scale)


def _usable(table: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    vector = F.col(f"`{vector_col}`")
    rows = table.where(usable(vector)).select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), vector.cast("array<double>").alias("v"))
    common = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = common["dims"] if common else 0
    return rows.where(F.size("v") == dims), dims


def _each(rows: DataFrame, ddl: str, work: Callable[[Iterator[tuple[pa.Array, np.ndarray]]], Iterator[list[tuple]]], dims: int) -> DataFrame:
    """mapInArrow whose function gets blocks of x and yields lists of result rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(ddl)
        for made in work(blocks(batches, dims)):
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), schema)], schema=schema)

    return rows.mapInArrow(run, schema_of(ddl))


def _range(rows: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    def work(parts):
        low = high = None
        for _, x in parts:
            low = x.min(0) if low is None else np.minimum(low, x.min(0))
            high = x.max(0) if high is None else np.maximum(high, x.max(0))
        if low is not None:
            yield list(zip(range(dims), low.tolist(), high.tolist()))

    found = _each(rows, "dim bigint, low bigint, high bigint", work, dims)
    ends = sorted(found.groupBy("dim").agg(F.min("low"), F.max("high")).collect())
    return np.array([r[1] for r in ends], np.int64), np.array([r[2] for r in ends], np.int64)


def _scatter(rows: DataFrame, low: np.ndarray, bits: list[int]) -> tuple[int, list[int], np.ndarray]:
    """n, the sums and the sums of products of x - low."""
    dims = len(bits)

    def work(parts):
        n, counts = 0, 0
        for _, x in parts:
            n, counts = n + len(x), counts + plane_counts(planes(x - low, bits))
        if n:
            own, both = products(counts, bits)
            made = [(-1, -1, n)] + [(i, -1, s) for i, s in enumerate(own)] + [(i, j, p) for (i, j), p in both.items()]
            yield [(i, j, *limbs(value)) for i, j, value in made]

    names = [f"l{k}" for k in range(LIMBS)]
    found = _each(rows, "i bigint, j bigint, " + ", ".join(f"{c} bigint" for c in names), work, dims)
    n, sums, both = 0, [0] * dims, np.zeros((dims, dims), object)
    for i, j, *parts in found.groupBy("i", "j").agg(*(F.sum(c) for c in names)).collect():
        value = sum(p << LIMB * k for k, p in enumerate(parts))
        if i < 0:
            n = value
        elif j < 0:
            sums[i] = value
        else:
            both[i, j] = both[j, i] = value
    return n, sums, both


def fit(rows: DataFrame, dims: int, components: int) -> Fit | None:
    """The fit over all rows (vec_id, v) of `dims` entries, or None without any."""
    if not dims:
        return None
    low, high = _range(rows, dims)
    bits = [max(1, int(b - a).bit_length()) for a, b in zip(low.tolist(), high.tolist())]
    n, sums, both = _scatter(rows, low, bits)
    own = np.array(sums, object)
    # Python's division of whole numbers is rounded once.
    variances = np.array([[v / (n * n) for v in row] for row in n * both - np.outer(own, own)], np.float64)
    values, vectors = np.linalg.eigh(variances)
    order = np.argsort(-values, kind="stable")[:components]
    vectors = vectors[:, order]
    # Either sign is right; the entry of largest size is made positive, so that a repeated run gives the same.
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), range(vectors.shape[1])] < 0, -1, 1)
    sums = [s + n * int(a) for s, a in zip(sums, low)]
    return Fit(n, sums, low, high, np.maximum(values[order], 0), vectors, float(np.trace(variances)))


def identity_error(rows: DataFrame, fitted: Fit, dims: int) -> float:
    """The largest absolute entry of the whitened rows' covariance, less the identity."""
    shared = rows.sparkSession.sparkContext.broadcast(fitted)
    width = len(fitted.values)

    def work(parts):
        own, both = np.zeros(width), np.zeros((width, width))
        n = 0
        for _, x in parts:
            w = shared.value.whitened(shared.value.centred(x))
            n, own, both = n + len(w), own + w.sum(0), both + w.T @ w
        if n:
            yield [(i, -1, s) for i, s in enumerate(own.tolist())] + [
                (i, j, both[i, j]) for i in range(width) for j in range(width)
            ]

    found = _each(rows, "i bigint, j bigint, s double", work, dims).groupBy("i", "j").agg(F.sum("s")).collect()
    own, both = np.zeros(width), np.zeros((width, width))
    for i, j, s in found:
        if j < 0:
            own[i] = s
        else:
            both[i, j] = s
    # The means are zero up to rounding, so taking them off loses nothing.
    cov = both / fitted.n - np.outer(own, own) / fitted.n**2
    real = fitted.values > FLAT * fitted.values.max(initial=0)
    return float(np.abs(cov - np.eye(width))[np.ix_(real, real)].max(initial=0))


WHITENED = "vec_id bigint, n bigint, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"


def whiten(
    table: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """vec_id, n, deviation, whitened, explained and identity_error for every usable vector.

    `whitened` and `explained` are arrays over up to `components` components, by falling variance.
    """
    rows, dims = _usable(table, id_col, vector_col)
    fitted = fit(rows, dims, components)
    spark = table.sparkSession
    if fitted is None:
        return spark.createDataFrame([], schema_of(WHITENED))
    error = identity_error(rows, fitted, dims)
    shared = spark.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for ids, x in blocks(batches, dims):
            centred = f.centred(x)
            w = f.whitened(centred)
            offsets = np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(f.deviations(centred), pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(w.reshape(-1))),
                ],
                names=["vec_id", "deviation", "whitened"],
            )

    made = rows.mapInArrow(run, schema_of("vec_id bigint, deviation decimal(38,0), whitened array<double>"))
    explained = [float(v / fitted.trace) if fitted.trace else 0.0 for v in fitted.values]
    return made.select(
        "vec_id",
        F.lit(fitted.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.array(*map(F.lit, explained)).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
