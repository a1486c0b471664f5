"""Exact cosine neighbours inside scopes, computed block by block.

A scope is cut into blocks of bounded size, each packed into one row. Pairs of
blocks come from a join of these rows and go straight to Python, so a scope with
most of the data becomes many tasks, and what is shuffled are the blocks and not
their pairs. A task returns the best matches of each left block among its right
ones (or the pairs at or above a threshold), never all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenfold.functions.vectors import matrix
from lumenfold.schema import SCOPE
from lumenfold.session import materialize

BLOCK_ROWS = 2048
#: Blocks that one task holds of a side at most; parts that blocks of large scopes are dealt to at least; left blocks of a
#: small scope per task; bytes of pairs handed to Python at once; bytes of best matches that a task holds.
GROUP, PARTS, SHARE, PAIR_BYTES, HELD_BYTES = 16, 20, 2, 8 << 20, 96 << 20
#: Rows of a block multiplied at once, so that their products stay in the processor's cache; pairs multiplied again at once.
STRIP, AGAIN = 256, 512
# Similarities are rounded so that equal vectors tie whatever the order of summation.
DECIMALS = 9


def _blocks(vectors: DataFrame, ident: str, rows: int) -> DataFrame:
    """Add the block count ``_of`` of the scope, a block number ``_block`` and the scope size ``_n``."""
    sizes = vectors.groupBy(*SCOPE).agg(F.count("*").alias("_n"))
    return (
        vectors.join(sizes, SCOPE)
        .withColumn("_of", F.ceil(F.col("_n") / rows).cast("int"))
        .withColumn("_block", F.pmod(F.xxhash64(ident), F.col("_of").cast("long")).cast("int"))
    )


def _packed(vectors: DataFrame, rows: int) -> DataFrame:
    """One row per block: ``(scope, _n, _of, _block, ids, cells, width)`` with the ids in order and their vectors' compressed numbers."""
    number = "<f4" if vectors.schema["vector"].dataType.elementType == T.FloatType() else "<f8"

    def pack(key, table):
        table = table.take(pa.array(np.argsort(table["entry_index"].to_numpy(), kind="stable")))
        cells = matrix(table["vector"])
        ids = table["entry_index"].combine_chunks()
        return pa.table(
            {
                "app_id": table["app_id"][:1].cast(pa.string()),
                "user_id": table["user_id"][:1].cast(pa.string()),
                "_n": table["_n"][:1].cast(pa.int64()),
                "_of": table["_of"][:1].cast(pa.int32()),
                "_block": table["_block"][:1].cast(pa.int32()),
                "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.cast(pa.int64())),
                "cells": pa.array([pa.compress(cells.astype(number).tobytes(), "zstd", asbytes=True)], pa.binary()),
                "width": pa.array([cells.shape[1]], pa.int32()),
            }
        )

    blocks = _blocks(vectors.select(*SCOPE, "entry_index", "vector"), "entry_index", rows)
    packed = "app_id string, user_id string, _n long, _of int, _block int, ids array<long>, cells binary, width int"
    return blocks.groupBy(*SCOPE, "_block").applyInArrow(pack, packed).withColumn("number", F.lit(number))


def _block_pairs(vectors: DataFrame, rows: int, once: bool) -> DataFrame:
    """Every pair of blocks of a scope as a row: ``(scope, _n, l_block, l_ids, …, r_block, r_ids, …)``; ``once`` takes
    each unordered pair once.

    The pairs are never stored or shuffled, only the blocks are. A scope of few blocks is joined with itself; some copies
    of its right side let several tasks share it. Blocks of larger scopes are dealt evenly over partitions of at most about
    ``GROUP`` blocks, and a Cartesian product reads each partition with each other one, so what is written is the input,
    however many pairs. With ``once``, which of two blocks is the left one alternates, so left blocks have equally many
    pairs.
    """
    packed = materialize(_packed(vectors, rows), "blocks")
    side = lambda df, s: df.select(
        *[F.col(c).alias(f"{s}_{c.lstrip('_')}") for c in (*SCOPE, "_block", "_of", "_n", "ids", "cells", "width", "number")]
    )
    same = (F.col("l_app_id") == F.col("r_app_id")) & (F.col("l_user_id") == F.col("r_user_id"))
    even = (F.col("l_block") + F.col("r_block")) % 2 == 0
    if once:
        same = same & ((F.col("l_block") == F.col("r_block")) | ((F.col("l_block") < F.col("r_block")) == even))
    shares = lambda of: F.ceil(F.col(of) / SHARE)
    is_large = F.col("_of") > GROUP
    left_groups = F.count_distinct(F.when(~is_large, F.struct(*SCOPE, F.col("_block") % shares("_of"))))
    large, groups = packed.agg(F.count(F.when(is_large, 1)), left_groups).first()
    # Blocks are small and what is done with them is not, so the number of tasks must not follow from their bytes.
    keys, tasks = lambda s: [f"{s}_app_id", f"{s}_user_id", f"{s}_share"], max(1, min(4 * groups, 64 + groups // GROUP))
    few = packed.where(~is_large)
    few_left = side(few, "l").withColumn("l_share", F.col("l_block") % shares("l_of")).repartition(tasks, *keys("l"))
    few_right = side(few, "r").withColumn("r_share", F.explode(F.sequence(F.lit(0).cast("long"), shares("r_of") - 1))).repartition(tasks, *keys("r"))
    pairs = few_left.join(few_right.hint("merge"), same & (F.col("l_share") == F.col("r_share"))).drop("l_share", "r_share")
    if large:
        parts = max(-(-large // GROUP), min(large, PARTS))
        dealt = packed.where(is_large).repartitionByRange(parts, *SCOPE, "_block")
        pairs = pairs.unionByName(side(dealt, "l").hint("shuffle_replicate_nl").join(side(dealt, "r"), same))
    return pairs.drop("r_app_id", "r_user_id", "l_of", "r_of", "r_n")


def _cells(row: dict, side: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of one side of a pair."""
    ids, width = row[f"{side}_ids"].values.to_numpy(zero_copy_only=False), row[f"{side}_width"].as_py()
    number = np.dtype(row[f"{side}_number"].as_py())
    cells = pa.decompress(row[f"{side}_cells"].as_buffer(), len(ids) * width * number.itemsize, "zstd")
    return ids, np.frombuffer(cells, number).reshape(len(ids), width)


def _each_pair(batches):
    """``(scope, left block, right block, left ids, left vectors, right ids, right vectors, row)`` of each pair."""
    held = None
    for batch in batches:
        for at in range(batch.num_rows):
            row = {name: batch.column(name)[at] for name in batch.schema.names}
            scope, l_block, r_block = (row["l_app_id"].as_py(), row["l_user_id"].as_py()), row["l_block"].as_py(), row["r_block"].as_py()
            if (scope, l_block) != held:
                held, (left_ids, left) = (scope, l_block), _cells(row, "l")
            right_ids, right = (left_ids, left) if l_block == r_block else _cells(row, "r")
            widths = {w for w in (left.shape[1], right.shape[1]) if w}
            if len(widths) > 1:
                raise ValueError(f"vectors of {min(widths)} and of {max(widths)} numbers in one column")
            width = max(widths, default=0)  # a block of null vectors has no width of its own
            wide = lambda rows: rows if rows.shape[1] == width else np.zeros((len(rows), width), rows.dtype)
            yield scope, l_block, r_block, left_ids, wide(left), right_ids, wide(right), row


def _dots(left: np.ndarray, right: np.ndarray, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Rounded products of the pairs ``(r, c)`` of rows."""
    sims = np.empty(len(r))
    for at in range(0, len(r), AGAIN):
        a, b = left[r[at : at + AGAIN]].astype(np.float64), right[c[at : at + AGAIN]].astype(np.float64)
        sims[at : at + AGAIN] = np.einsum("ij,ij->i", a, b)
    return np.round(sims, DECIMALS) + 0.0


def _close_pairs(left: np.ndarray, right: np.ndarray, left_floor: np.ndarray, right_floor: np.ndarray, take: int | None, same: bool):
    """Row numbers of both sides and the products of all pairs that may count.

    A pair counts if its product reaches the floor of its left or of its right row; with ``take``, only if it is also among
    the ``take`` largest of that row. With ``same`` sides a row is not paired with itself and each pair comes once.
    Products are first made with 32 bits: what they may be off by is bounded by the lengths and the number of terms, so
    a pair is left out only if it cannot count, and all others are multiplied again with 64 bits.
    """
    longest = lambda rows: np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0))
    off = (left.shape[1] + 8) * 2.0**-22 * max(1.0, longest(left) * longest(right)) + 10.0**-DECIMALS
    if not np.isfinite(off):
        raise ValueError("vectors must be finite")
    a, b = left.astype(np.float32, copy=False), np.ascontiguousarray(right.astype(np.float32, copy=False).T)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for at in range(0, len(a), STRIP):
        sims = a[at : at + STRIP] @ b
        if same:
            sims[np.arange(len(sims))[:, None] + at >= np.arange(b.shape[1])] = -np.inf
        rows, columns = (left_floor[at : at + STRIP] - off).astype(np.float32), (right_floor - off).astype(np.float32)
        near = sims >= rows[:, None]
        near |= sims >= columns
        many = np.count_nonzero(near)
        if take is not None and many > 4 * take * len(sims):  # the largest of these rows raise the floors
            if sims.shape[1] > take:
                rows = np.maximum(rows, np.partition(sims, sims.shape[1] - take, axis=1)[:, sims.shape[1] - take] - np.float32(2 * off))
            if len(sims) > take:
                columns = np.maximum(columns, np.partition(sims, len(sims) - take, axis=0)[len(sims) - take] - np.float32(2 * off))
            near = sims >= rows[:, None]
            near |= sims >= columns
            many = np.count_nonzero(near)
        if same:
            near &= sims > -np.inf
        r, c = np.divmod(np.flatnonzero(near), b.shape[1])
        if many > sims.size // 64:
            exact = np.round((left[at : at + STRIP].astype(np.float64) @ right.astype(np.float64).T)[r, c], DECIMALS) + 0.0
        else:
            exact = _dots(left[at : at + STRIP], right, r, c)
        found.append((r + at, c, exact))
    return tuple(np.concatenate(p) for p in zip(*found))


class _Best:
    """The ``take`` best matches so far of the rows of a block, and the floor that others must reach."""

    def __init__(self, ids: np.ndarray, take: int, floor: float) -> None:
        self.ids, self.take, self.least = ids, take, floor
        self.at, self.dst, self.sim = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.floor = np.full(len(ids), floor)

    def add(self, at: np.ndarray, dst: np.ndarray, sim: np.ndarray) -> None:
        good = sim >= self.floor[at]
        if not good.any():
            return
        at, dst, sim = (np.concatenate(p) for p in ((self.at, at[good]), (self.dst, dst[good]), (self.sim, sim[good])))
        order = np.lexsort((dst, -sim, at))
        at, dst, sim = at[order], dst[order], sim[order]
        start = np.searchsorted(at, at)
        place = np.arange(len(at)) - start
        best = place < self.take
        self.at, self.dst, self.sim = at[best], dst[best], sim[best]
        last = place == self.take - 1
        self.floor[at[last]] = np.maximum(sim[last], self.least)

    def rows(self, scope: tuple) -> pa.RecordBatch:
        n = len(self.at)
        return pa.RecordBatch.from_pydict(
            {
                "app_id": pa.array([scope[0]] * n, pa.string()),
                "user_id": pa.array([scope[1]] * n, pa.string()),
                "src": pa.array(self.ids[self.at], pa.int64()),
                "dst": pa.array(self.dst, pa.int64()),
                "sim": pa.array(self.sim, pa.float64()),
                "k": pa.array(np.full(n, self.take), pa.int32()),
            }
        )


def _stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` stored, with pairs of blocks handed to Python a few at a time."""
    spark, name = df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(PAIR_BYTES))
    try:
        return materialize(df, label)
    finally:
        spark.conf.set(name, before)


def _best(sims: np.ndarray, k: int, floor: float):
    """Row and column numbers of each row's ``k`` largest values at or above ``floor``.

    Equal values go to the smaller column, so columns must be in id order.
    """
    if sims.shape[1] > k:
        nth = np.partition(sims, sims.shape[1] - k, axis=1)[:, sims.shape[1] - k]
        above = sims > nth[:, None]
        equal = sims == nth[:, None]
        room = k - above.sum(axis=1, keepdims=True)
        keep = above | (equal & (np.cumsum(equal, axis=1) <= room))
    else:
        keep = np.ones_like(sims, dtype=bool)
    return np.nonzero(keep & (sims >= floor))


def knn_topk(
    vectors: DataFrame, k: int | Column, min_similarity: float | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The ``k`` most similar other entries of each entry: ``(scope, src, dst, sim, rank)``.

    ``k`` may be an expression over the scope size ``_n``; it is cut to the
    number of other entries. Ties go to the smaller entry index. With
    ``min_similarity`` weaker neighbours are left out inside the blocks, which
    does not change the ranks of the others.

    ``vectors`` is ``(scope, entry_index, vector)`` with unit or zero vectors.
    """
    floor = -2.0 if min_similarity is None else float(min_similarity)
    limit = F.lit(k) if isinstance(k, int) else k
    sized = _block_pairs(vectors, block_rows, once=True).withColumnRenamed("l_n", "_n")
    paired = sized.withColumn("take", F.greatest(F.lit(0), F.least(limit, F.col("_n") - 1)).cast("int")).withColumnRenamed("_n", "l_n")

    def partial(batches):
        held, size = {}, 0
        for scope, l_block, r_block, left_ids, left, right_ids, right, row in _each_pair(batches):
            take = row["take"].as_py()
            if take == 0:
                continue
            for key, ids in (((scope, l_block), left_ids), ((scope, r_block), right_ids)):
                if key not in held:
                    held[key], size = _Best(ids, take, floor), size + 24 * take * len(ids)
            ours, theirs = held[scope, l_block], held[scope, r_block]
            r, c, sims = _close_pairs(left, right, ours.floor, theirs.floor, take, ours is theirs)
            if ours is theirs:
                ours.add(np.concatenate([r, c]), np.concatenate([right_ids[c], left_ids[r]]), np.concatenate([sims, sims]))
            else:
                ours.add(r, right_ids[c], sims)
                theirs.add(c, left_ids[r], sims)
            if size > HELD_BYTES:
                yield from (best.rows(key[0]) for key, best in held.items())
                held, size = {}, 0
        yield from (best.rows(key[0]) for key, best in held.items())

    pieces = paired.mapInArrow(partial, "app_id string, user_id string, src long, dst long, sim double, k int")
    rank = F.row_number().over(Window.partitionBy(*SCOPE, "src").orderBy(F.desc("sim"), "dst"))
    return _stored(pieces.withColumn("rank", rank).where(F.col("rank") <= F.col("k")).drop("k"), "neighbours")


def cosine_pairs(vectors: DataFrame, min_similarity: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All unordered pairs ``src < dst`` of a scope with cosine at or above ``min_similarity``."""

    def above(batches):
        for scope, l_block, r_block, left_ids, left, right_ids, right, _ in _each_pair(batches):
            floors = (np.full(len(ids), float(min_similarity)) for ids in (left_ids, right_ids))
            r, c, sims = _close_pairs(left, right, *floors, None, l_block == r_block)
            close = sims >= min_similarity
            a, b = left_ids[r[close]], right_ids[c[close]]
            n = len(a)
            yield pa.RecordBatch.from_pydict(
                {
                    "app_id": pa.array([scope[0]] * n, pa.string()),
                    "user_id": pa.array([scope[1]] * n, pa.string()),
                    "src": pa.array(np.minimum(a, b), pa.int64()),
                    "dst": pa.array(np.maximum(a, b), pa.int64()),
                    "sim": pa.array(sims[close], pa.float64()),
                }
            )

    pairs = _block_pairs(vectors, block_rows, once=True)
    return _stored(pairs.mapInArrow(above, "app_id string, user_id string, src long, dst long, sim double"), "cosine-pairs")


def mutual_edges(knn: DataFrame, min_similarity: float) -> DataFrame:
    """Edges ``src < dst`` between entries that are in each other's list, with their similarity.

    Both directions of a pair meet in one aggregate instead of a self-join.
    """
    return (
        knn.where(F.col("sim") >= min_similarity)
        .groupBy(*SCOPE, F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .agg(F.count("*").alias("_seen"), F.max("sim").alias("w"))
        .where(F.col("_seen") == 2)
        .drop("_seen")
    )


def best_matches(
    left: DataFrame,
    right: DataFrame,
    k: int | None,
    min_similarity: float = -2.0,
    above: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``k`` most similar rows of ``right`` for each row of ``left`` in the same scope.

    ``left`` is ``(scope, left_id, vector[, threshold])`` and ``right`` ``(scope,
    right_id string, vector)``. Ties go to the smaller ``right_id``; of rows with
    the same ``right_id`` the best one counts. Without ``k`` all rows above the
    floor are matches. A
    ``threshold`` column on the left sets the floor per row, else
    ``min_similarity`` does (exclusive with ``above``). ``left`` is repeated once
    per right block: a small right side is one block, so nothing is repeated.
    """
    id_type = dict(left.dtypes)["left_id"]
    with_floor = "threshold" in left.columns
    split_left = _blocks(
        left.select(*SCOPE, "left_id", "vector", *(["threshold"] if with_floor else [])), "left_id", block_rows
    ).drop("_n")
    split_right = _blocks(right.select(*SCOPE, "right_id", "vector"), "right_id", block_rows).drop("_n")
    left_blocks = split_left.select(*SCOPE, "_of").distinct().withColumnRenamed("_of", "_left_of")
    right_blocks = split_right.select(*SCOPE, "_of").distinct().withColumnRenamed("_of", "_right_of")
    spread_left = (
        split_left.join(right_blocks, SCOPE)
        .withColumn("_rb", F.explode(F.sequence(F.lit(0), F.col("_right_of") - 1)))
        .select(*SCOPE, F.col("_block").alias("_lb"), "_rb", "left_id", "vector", *(["threshold"] if with_floor else []))
    )
    spread_right = (
        split_right.join(left_blocks, SCOPE)
        .withColumn("_lb", F.explode(F.sequence(F.lit(0), F.col("_left_of") - 1)))
        .select(*SCOPE, "_lb", F.col("_block").alias("_rb"), "right_id", "vector")
    )
    # Fresh columns, in case both sides come from the same frame.
    spread_right = spread_right.select(*[F.col(c).alias(c) for c in spread_right.columns])
    arrow_id = pa.string() if id_type == "string" else pa.int64()

    def match(key, lefts, rights):
        n = 0
        if lefts.num_rows and rights.num_rows:
            names = rights["right_id"].to_pylist()
            order = np.array(sorted(range(len(names)), key=names.__getitem__))
            sims = np.round(matrix(lefts["vector"]) @ matrix(rights["vector"])[order].T, DECIMALS) + 0.0
            names = [names[i] for i in order]
            starts = [i for i, name in enumerate(names) if i == 0 or name != names[i - 1]]
            names, sims = [names[i] for i in starts], np.maximum.reduceat(sims, starts, axis=1)
            floor = lefts["threshold"].to_numpy()[:, None] if with_floor else min_similarity
            sims[(sims <= floor) if above else (sims < floor)] = -np.inf
            r, c = _best(sims, len(names) if k is None else k, -2.0)
            n = len(r)
        if n == 0:
            r = c = np.zeros(0, np.int64)
            picked, sim, lefts_out = [], np.zeros(0), pa.array([], arrow_id)
        else:
            picked = [names[i] for i in c]
            sim, lefts_out = sims[r, c], lefts["left_id"].combine_chunks().take(pa.array(r))
        return pa.table(
            {
                "app_id": pa.array([key[0].as_py()] * n, pa.string()),
                "user_id": pa.array([key[1].as_py()] * n, pa.string()),
                "left_id": lefts_out,
                "right_id": pa.array(picked, pa.string()),
                "sim": pa.array(sim, pa.float64()),
            }
        )

    keys = [*SCOPE, "_lb", "_rb"]
    pieces = (
        spread_left.groupBy(*keys)
        .cogroup(spread_right.groupBy(*keys))
        .applyInArrow(match, f"app_id string, user_id string, left_id {id_type}, right_id string, sim double")
    )
    rank = F.row_number().over(Window.partitionBy(*SCOPE, "left_id").orderBy(F.desc("sim"), "right_id"))
    ranked = pieces.withColumn("rank", rank)
    return ranked if k is None else ranked.where(F.col("rank") <= k)
