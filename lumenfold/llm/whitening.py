"""Embedding whitening: scores on the leading components, each scaled to variance one.

Vectors become whole numbers first, so sums and products are exact and do not depend on how rows are dealt: one pass
sums per dimension, a second one multiplies what is left of each vector after the mean. Only matrices of one row per
dimension leave the tasks, and they are added in tasks before the driver reads one. The driver finds the components
(``spectrum``). A third pass measures the covariance of the scores, with means taken off first.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.llm.spectrum import leading

#: Entries count in steps of 1/64; whole numbers are shifted so that they are positive.
STEP, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Vectors with an entry beyond this have no whole numbers of 64 bits.
_LARGEST = 2.0**46
_ROWS_AT_A_TIME = 2048
_LOW_BITS = 31
_LOW = (1 << _LOW_BITS) - 1


@dataclass
class Whitening:
    """What was fitted: n rows, sums per dimension, and components as columns with eigenvalues and shares."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    explained: np.ndarray

    @property
    def center(self) -> np.ndarray:
        """The mean's nearest whole numbers below."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """n times what the mean exceeds ``center`` by."""
        return np.array([s % self.n for s in self.sums], np.int64)


def usable(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """``id, vector`` of the rows that can be used, and their number of dimensions.

    Null, empty and non-finite vectors go, and such as have an entry of 2^46 or more, and those of another length than
    most have (of equally frequent lengths the largest counts).
    """
    rows = vectors.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(_LARGEST)))
    rows = rows.where((F.size("vector") > 0) & F.coalesce(fine, F.lit(False)))
    size = F.size("vector")
    most = rows.groupBy(size.alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    width = most["size"] if most else 0
    return rows.where(size == width), width


def _whole(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of whole numbers, some at a time, with the place of the first."""
    for at in range(0, batch.num_rows, _ROWS_AT_A_TIME):
        part = batch.column("vector").slice(at, _ROWS_AT_A_TIME)
        values = part.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        yield at, np.floor(values * STEP).astype(np.int64) + SHIFT


def _exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """left' right of whole numbers: by floats where they stay exact, else with numbers of any length."""
    most = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * max(len(left), 1)
    if most < 1 << 53:
        return (left.T.astype(np.float64) @ right.astype(np.float64)).astype(np.int64)
    return left.T.astype(object) @ right.astype(object)


def _summed(rows: DataFrame, width: int, size: int, blocks: Callable[[pa.RecordBatch], Iterator[np.ndarray]]) -> list[list[int]]:
    """``width`` lists of ``size`` whole numbers: the sum over all rows of what ``blocks`` makes of a batch.

    Numbers travel as two halves, so 64 bits hold the sums of 2^32 tasks.
    """

    def halves(block: np.ndarray) -> np.ndarray:
        return np.stack([(block >> _LOW_BITS).astype(np.int64), (block & _LOW).astype(np.int64)])

    def batch_of(total: np.ndarray) -> pa.RecordBatch:
        binary = pa.array([total[:, k].tobytes() for k in range(width)], pa.binary())
        return pa.record_batch([pa.array(range(width), pa.int32()), binary], ["part", "sums"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, width, size), np.int64)
        for batch in batches:
            for block in blocks(batch):
                total += halves(block)
                total[0] += total[1] >> _LOW_BITS
                total[1] &= _LOW
        yield batch_of(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, held in zip(batch.column("part").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                sums[part] = sums.get(part, 0) + np.frombuffer(held, np.int64)
        made = [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())]
        yield pa.record_batch(made, ["part", "sums"])

    kept = "part int, sums binary"
    total = [[0] * size for _ in range(width)]
    for row in rows.mapInArrow(make, kept).repartition("part").mapInArrow(add, kept).collect():
        high, low = np.frombuffer(row["sums"], np.int64).reshape(2, size).tolist()
        total[row["part"]] = [(h << _LOW_BITS) + v for h, v in zip(high, low, strict=True)]
    return total


def fit(rows: DataFrame, width: int, components: int = COMPONENTS) -> Whitening:
    """The components of all ``rows`` of ``usable``; none without rows or without any variance."""

    def sums_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, x in _whole(batch, width):
            yield np.append(x.sum(axis=0, dtype=np.int64), len(x))[None, :]

    *sums, n = _summed(rows, 1, width + 1, sums_of)[0]
    if not n:
        return Whitening(0, sums, np.empty(0), np.empty((width, 0)), np.empty(0))
    center, rest = np.array([s // n for s in sums], np.int64), [s % n for s in sums]

    def products_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, x in _whole(batch, width):
            yield _exact(x - center, x - center)

    gram = _summed(rows, width, width, products_of)
    matrix = np.array([[(n * g - rest[i] * rest[j]) / (n * n) for j, g in enumerate(line)] for i, line in enumerate(gram)])
    values, vectors = leading(matrix, components)
    total = math.fsum(matrix.diagonal())
    return Whitening(n, sums, values, vectors, values / total if len(values) else values)


def _scores(x: np.ndarray, fitted: Whitening) -> np.ndarray:
    apart = (x - fitted.center) - fitted.rest / fitted.n
    return (apart @ fitted.components) / np.sqrt(fitted.values)


def identity_error(rows: DataFrame, width: int, fitted: Whitening) -> float | None:
    """Largest absolute entry of the scores' covariance minus the identity; null without components.

    Tasks keep means and centred products and join them without ever taking products of what is not centred.
    """
    k = len(fitted.values)
    if not k:
        return None

    def joined(one: tuple, two: tuple) -> tuple:
        (n, mean, products), (m, other, more) = one, two
        apart = other - mean
        return n + m, mean + apart * (m / (n + m)), products + more + np.outer(apart, apart) * (n * m / (n + m))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for _, x in _whole(batch, width):
                scores = _scores(x, fitted)
                mean = scores.mean(axis=0)
                made = (len(x), mean, (scores - mean).T @ (scores - mean))
                held = joined(held, made) if held else made
        if held:
            yield packed([held])

    def packed(parts: list[tuple]) -> pa.RecordBatch:
        binary = [np.concatenate([[n], mean, products.ravel()]).tobytes() for n, mean, products in parts]
        return pa.record_batch([pa.array(binary, pa.binary())], ["part"])

    def unpacked(part: bytes) -> tuple:
        numbers = np.frombuffer(part)
        return int(numbers[0]), numbers[1 : k + 1], numbers[k + 1 :].reshape(k, k)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for part in batch.column("part").to_pylist():
                held = joined(held, unpacked(part)) if held else unpacked(part)
        if held:
            yield packed([held])

    parts = rows.mapInArrow(measure, "part binary").repartition(64).mapInArrow(join, "part binary").collect()
    held = unpacked(parts[0]["part"])
    for row in parts[1:]:
        held = joined(held, unpacked(row["part"]))
    return float(np.abs(held[2] / held[0] - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row per usable row and component: id, component, n, deviation, whitened, explained, identity_error.

    An entry c counts as floor(64 c) + 1,000,000. ``deviation`` is the sum over dimensions of (n x - S)^2, exact;
    ``whitened`` the score on the component over the root of its eigenvalue; ``explained`` the eigenvalue's share of
    the trace. A component whose eigenvalue is zero to rounding has no scores and no rows, so equal vectors give none.
    Which rows are usable is said there; ids may be null or repeat. Other columns are ignored. No rows give none.
    """
    rows, width = usable(vectors, id, vector)
    fitted = fit(rows, width, components)
    error = identity_error(rows, width, fitted)
    plain = rows.schema["id"].dataType.simpleString()
    schema = f"id {plain}, component int, n bigint, deviation decimal(38,0), whitened double, explained double"
    k = len(fitted.values)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _whole(batch, width):
                apart = x - fitted.center
                most = int(np.abs(apart).max(initial=0)) * fitted.n + fitted.n
                if width * most * most < 1 << 63:
                    off = apart * fitted.n - fitted.rest
                else:
                    off = apart.astype(object) * fitted.n - fitted.rest.astype(object)
                deviation = pa.array([Decimal(int(d)) for d in (off * off).sum(axis=1)], pa.decimal128(38, 0))
                every = pa.array(np.repeat(np.arange(len(x)), k))
                made = [
                    batch.column("id").slice(at, len(x)).take(every),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(every), fitted.n)),
                    deviation.take(every),
                    pa.array(_scores(x, fitted).ravel()),
                    pa.array(np.tile(fitted.explained, len(x))),
                ]
                yield pa.record_batch(made, ["id", "component", "n", "deviation", "whitened", "explained"])

    found = rows.mapInArrow(place, schema) if k else rows.sparkSession.createDataFrame([], schema)
    return found.select(F.col("id").alias(id), *found.columns[1:], F.lit(error).cast("double").alias("identity_error"))
