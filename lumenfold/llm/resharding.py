"""Resharding by minimum-cost flow: from old shard sizes and new capacities to the fewest moved bytes.

The unit that moves is a block: rows of one old shard whose texts hash alike, so equal texts move together. Spark
sums the sizes of blocks; a flow between old and new shards, solved on the driver, has one node per shard; blocks
are then dealt to the flow's edges; and the files of shards that gained or lost a block are written anew. What the
driver holds is bounded by shards times ``BLOCKS``, whatever the data.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenfold.session import materialize, scratch_path

#: Blocks of an old shard.
BLOCKS = 1024
#: A block above this share of a mean shard is numbered in parts; one above half a shard is also moved in parts.
_PART_OF_SHARD = 64
FILE_BYTES = 128 << 20
_LEAST_FILES = 4


def min_cost_flow(sizes: list[int], capacities: list[int], cost=lambda i, j: int(i != j)) -> dict[tuple[int, int], int]:
    """Bytes from each old to each new shard, all placed and no capacity exceeded, at the least total cost.

    Successive shortest paths with potentials: each round sends what fits along the cheapest path of the residual
    graph. ``sum(sizes) <= sum(capacities)``; staying in place costs nothing by default.
    """
    if sum(sizes) > sum(capacities):
        raise ValueError("the new shards are too small")
    n, m = len(sizes), len(capacities)
    start, end = n + m, n + m + 1
    room: dict[int, dict[int, int]] = defaultdict(dict)
    price: dict[tuple[int, int], int] = {}

    def edge(a: int, b: int, most: int, each: int) -> None:
        room[a][b], room[b][a], price[a, b], price[b, a] = most, 0, each, -each

    for i, size in enumerate(sizes):
        edge(start, i, size, 0)
        for j in range(m):
            edge(i, n + j, size, cost(i, j))
    for j, most in enumerate(capacities):
        edge(n + j, end, most, 0)
    potential = [0] * (n + m + 2)
    while True:
        distance, back, heap = {start: 0}, {}, [(0, start)]
        while heap:
            far, a = heapq.heappop(heap)
            if far > distance[a]:
                continue
            for b, most in room[a].items():
                reached = far + price[a, b] + potential[a] - potential[b]
                if most > 0 and reached < distance.get(b, float("inf")):
                    distance[b], back[b] = reached, a
                    heapq.heappush(heap, (reached, b))
        if end not in distance:
            break
        for a, far in distance.items():
            potential[a] += far
        path, at = [], end
        while at != start:
            path.append((back[at], at))
            at = back[at]
        sent = min(room[a][b] for a, b in path)
        for a, b in path:
            room[a][b] -= sent
            room[b][a] += sent
    return {(i, j): sent for i in range(n) for j in range(m) if (sent := room[n + j][i]) > 0}


def deal_blocks(blocks: dict[int, list[tuple[tuple, int]]], flow: dict[tuple[int, int], int]) -> dict[tuple, int]:
    """The new shard of each block. Of every old shard, largest blocks first, each to the edge that lacks most.

    What a shard's blocks miss an edge by is carried over to the same target's next old shard, so new shards stay
    within one of the smallest blocks of their capacity.
    """
    placed: dict[tuple, int] = {}
    carried: dict[int, int] = defaultdict(int)
    for old in sorted(blocks):
        lacks = {j: sent + carried.pop(j, 0) for (i, j), sent in sorted(flow.items()) if i == old}
        if not lacks:
            lacks = {old: 0}
        heap = [(-left, j != old, j) for j, left in lacks.items()]
        heapq.heapify(heap)
        for block, size in sorted(blocks[old], key=lambda x: (-x[1], x[0])):
            left, moves, j = heapq.heappop(heap)
            placed[block] = j
            heapq.heappush(heap, (left + size, moves, j))
        for left, _, j in heap:
            carried[j] -= left
    return placed


def equal_capacities(total: int, count: int) -> list[int]:
    return [total // count + (k < total % count) for k in range(count)]


@dataclass
class Resharded:
    """rows: id, text, size, shard, slot, moved, of all shards; files: where affected shards were written."""

    rows: DataFrame
    files: str
    affected: list[int]
    moved_bytes: int
    shard_bytes: list[int]


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text, none if null, and one for its end."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1


def reshard(docs: DataFrame, old: Column, n_old: int, n_new: int, text: str = "text", id: str = "doc_id") -> Resharded:
    """Move ``docs`` from shards ``old`` (0 to n_old - 1) to n_new shards of equal bytes, moving the fewest.

    Slots count rows of a shard from 0. Null and empty texts have size 1. Rows that repeat an id or a text are
    rows of their own; order among equal rows does not matter. Equal texts stay together if ``old`` keeps them so
    and they do not exceed half a shard together: a large block is cut by a hash of the text, and only the rows of
    texts beyond that (at most two of them per new shard) by their ids. Other columns are ignored.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(
        F.col(id).alias("id"),
        F.col(text).alias("text"),
        text_bytes(F.col(text)).alias("size"),
        old.cast("int").alias("old"),
        F.pmod(F.xxhash64(value, F.lit("block")), F.lit(BLOCKS)).cast("int").alias("block"),
        F.xxhash64(value, F.lit("part")).alias("same"),
        F.xxhash64(id, value, F.lit("part")).alias("spread"),
    )
    small = materialize(base.select("size", "old", "block", "same", "spread"), "block-rows")
    sums = [F.sum("size").alias("size"), F.count("*").alias("rows")]
    found = [tuple(r) for r in small.groupBy("old", "block").agg(*sums).select("old", "block", "size", "rows").collect()]
    total = sum(r[2] for r in found)
    capacities = equal_capacities(total, n_new)
    step = max(1, total // n_new // _PART_OF_SHARD)
    parts = {(o, b): -(-size // step) for o, b, size, _ in found if size > step}
    spark = docs.sparkSession
    cut = spark.createDataFrame([(o, b, p) for (o, b), p in parts.items()], "old int, block int, parts int")
    large = small.join(F.broadcast(cut), ["old", "block"]).groupBy("old", "block", "same").agg(F.sum("size").alias("size"))
    hot = [(r["old"], r["block"], r["same"]) for r in large.where(F.col("size") > total / n_new / 2).collect()] if parts else []
    torn = spark.createDataFrame([(*r, True) for r in hot], "old int, block int, same bigint, torn boolean")

    def split(df: DataFrame) -> DataFrame:
        df = df.join(F.broadcast(cut), ["old", "block"], "left").join(F.broadcast(torn), ["old", "block", "same"], "left")
        part = F.when(F.col("torn"), F.col("parts") + F.pmod("spread", "parts")).otherwise(F.pmod("same", "parts"))
        return df.withColumn("part", F.coalesce(part, F.lit(0)).cast("int"))

    pieces = defaultdict(list)
    if parts:
        for o, b, p, size, rows in split(small).where("parts IS NOT NULL").groupBy("old", "block", "part").agg(*sums).select("old", "block", "part", "size", "rows").collect():
            pieces[o, b].append((p, size, rows))

    items, units = defaultdict(list), {}
    for o, b, size, rows in found:
        for p, part_size, part_rows in pieces.get((o, b), [(0, size, rows)]):
            units[o, b, p] = (part_size, part_rows)
        if size > total / n_new / 2:
            items[o] += [((o, b, p), part_size) for p, part_size, _ in pieces[o, b]]
        else:
            items[o].append(((o, b), size))
    old_sizes = [sum(s for _, s in items[o]) for o in range(n_old)]
    placed = deal_blocks(items, min_cost_flow(old_sizes, capacities))

    plan, files, next_slot, shard_bytes, affected, moved = [], {}, [0] * n_new, [0] * n_new, set(range(n_old, n_new)), 0
    per_file = max(1, min(FILE_BYTES, total // n_new // _LEAST_FILES))
    for (o, b, p), (size, rows) in sorted(units.items()):
        shard = placed[o, b, p] if (o, b, p) in placed else placed[o, b]
        file = files.setdefault((shard, shard_bytes[shard] // per_file), len(files))
        plan.append((o, b, p, shard, file, next_slot[shard], shard != o))
        next_slot[shard] += rows
        shard_bytes[shard] += size
        if shard != o:
            affected |= {o, shard}
            moved += size
    table = spark.createDataFrame(plan, "old int, block int, part int, shard int, file int, start bigint, moved boolean")
    assigned = split(base).join(F.broadcast(table), ["old", "block", "part"])
    # A task a file: files are numbered through, so ranges of one number deal them evenly.
    assigned = assigned.repartitionByRange(max(1, len(files)), "file")
    within = Window.partitionBy("shard", "file", "old", "block", "part").orderBy("id", "spread")
    placed_rows = assigned.withColumn("slot", F.col("start") + F.row_number().over(within) - 1)
    placed_rows = placed_rows.select("id", "text", "size", "shard", "slot", "moved")
    path, kept = scratch_path(spark, "shards"), sorted(affected & set(range(n_new)))
    placed_rows.where(F.col("shard").isin(kept)).write.partitionBy("shard").parquet(path)
    if not kept:
        return Resharded(placed_rows, path, kept, moved, shard_bytes)
    schema = placed_rows.drop("shard").schema.add("shard", "integer")
    rows = spark.read.schema(schema).parquet(path)
    if len(kept) < n_new:
        rows = rows.unionByName(placed_rows.where(~F.col("shard").isin(kept)))
    return Resharded(rows, path, kept, moved, shard_bytes)
