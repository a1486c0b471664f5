"""Arrow-batched vector helpers: each call handles a whole batch with numpy."""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenfold.functions.text import SLICE, slices, split_words

VECTOR = T.ArrayType(T.FloatType())


def present_rows(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Which rows of a list column hold a vector."""
    return np.asarray(column.is_valid())


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """List column of equally long vectors as one float64 matrix; a null vector is a row of zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    there = present_rows(column)
    if not there.any():
        return np.zeros((len(column), 0))
    lengths = pc.list_value_length(column.drop_null()).to_numpy(zero_copy_only=False)
    if lengths.min() != lengths.max():
        raise ValueError(f"vectors of {lengths.min()} and of {lengths.max()} numbers in one column")
    rows = np.zeros((len(column), int(lengths[0])))
    rows[there] = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lengths), -1)
    return rows


def list_array(rows: np.ndarray, there: np.ndarray | None = None) -> pa.Array:
    """Matrix back to a float32 list column; rows that are not ``there`` are null."""
    n, width = rows.shape
    there = np.ones(n, bool) if there is None else there
    offsets = pa.array(np.append(0, np.cumsum(there * width)).astype(np.int32))
    mask = None if there.all() else pa.array(~there)
    return pa.ListArray.from_arrays(offsets, pa.array(rows[there].astype(np.float32).ravel()), mask=mask)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; a zero row stays zero."""
    norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


@F.arrow_udf(VECTOR)
def unit_vector(vectors: pa.Array) -> pa.Array:
    return list_array(unit_rows(matrix(vectors)), present_rows(vectors))


SLOT_COUNTS = T.StructType([T.StructField("slots", T.ArrayType(T.IntegerType())), T.StructField("hits", T.ArrayType(T.IntegerType()))])


def word_slots(dim: int):
    """Text → which of ``dim`` hash slots its words hit, ascending, and how often.

    The slot of a word is the first 32 bits of its MD5 digest modulo ``dim``;
    distinct words of a part of a batch are hashed once.
    """

    def of_part(texts: pa.Array) -> pa.Array:
        rows = [split_words(t) for t in texts.to_pylist()]
        n = len(rows)
        coded = pa.array(itertools.chain.from_iterable(rows), pa.string()).dictionary_encode()
        slot = np.array([int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dim for w in coded.dictionary.to_pylist()], np.int64)
        cell = np.repeat(np.arange(n, dtype=np.int64) * dim, [len(r) for r in rows])
        if len(cell):
            cell = cell + slot[coded.indices.to_numpy(zero_copy_only=False)]
        hit, times = np.unique(cell, return_counts=True)
        ends = pa.array(np.searchsorted(hit, np.arange(n + 1) * dim).astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends, pa.array(v.astype(np.int32))) for v in (hit % dim, times)]
        return pa.StructArray.from_arrays(lists, ["slots", "hits"])

    @F.arrow_udf(SLOT_COUNTS)
    def slots(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([of_part(part) for part in slices(texts)] or [of_part(texts)])

    return slots


def _spread(slots: pa.Array, values: pa.Array, dim: int) -> np.ndarray:
    """Lists of slots and their values as rows of a matrix; null lists give zeros."""
    rows = np.zeros((len(slots), dim))
    sizes = pc.fill_null(pc.list_value_length(slots), 0).to_numpy(zero_copy_only=False)
    at = np.repeat(np.arange(len(slots)), sizes)
    rows[at, slots.flatten().to_numpy(zero_copy_only=False)] = values.flatten().to_numpy(zero_copy_only=False)
    return rows


def spread(dim: int):
    """Lists of slots and of numbers → ``dim`` numbers, zero where no slot is listed."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def dense(slots: pa.Array, values: pa.Array) -> pa.Array:
        rows = _spread(slots, values, dim)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * dim), pa.array(rows.ravel()))

    return dense


@F.arrow_udf(VECTOR)
def weigh_slots(slots: pa.Array, hits: pa.Array, entries: pa.Array, containing: pa.Array) -> pa.Array:
    """Unit vector of ln(1 + hits) · ln((1 + entries) / (1 + entries containing the slot))."""
    made = []
    for at in range(0, max(1, len(slots)), SLICE):  # matrices of a few rows at a time
        part = [column.slice(at, SLICE) for column in (slots, hits, entries, containing)]
        total = part[2].to_numpy(zero_copy_only=False).astype(np.float64)[:, None]
        rarity = np.log((1.0 + total) / (1.0 + matrix(part[3])))
        made.append(list_array(unit_rows(np.log1p(_spread(part[0], part[1], rarity.shape[1])) * rarity)))
    return pa.concat_arrays(made)


@F.arrow_udf(T.DoubleType())
def row_dot(left: pa.Array, right: pa.Array) -> pa.Array:
    """Dot product of two vector columns."""
    there = present_rows(left) & present_rows(right)
    a, b = matrix(left), matrix(right)
    dots = (a * b).sum(axis=1) if there.any() else np.zeros(len(left))
    return pa.array(dots, pa.float64(), mask=~there)


def vector_sum(vector: Column) -> Column:
    """Aggregate: element-wise sum, combined on the map side."""
    return vector_to_array(Summarizer.sum(array_to_vector(vector)))


def squared_length(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
