"""N-gram Jaccard join as a blocked sparse product of the document by n-gram matrix.

A row of the matrix is a text's set of word shingles, a column a shingle. Two texts link when
``100 * overlap >= percent * union``. With sizes a <= b a link needs ``100 a >= percent b`` and an overlap of
at least ``ceil(percent (a + b) / (100 + percent))``; these two bounds, made of sizes alone, steer everything:

1. Rows with the same set are one node, so exact copies cost one row.
2. Columns get one global order, rarest first. Rarity is an estimate: a fixed number of counters, to which every
   shingle of every text is added. It decides costs only; any order gives the same links. Of a row only the first
   ``n - ceil(percent n / 100) + 1 + extra(n)`` columns enter the product: linked rows, needing overlap o, share at
   least ``1 + e`` of their first ``a - o + 1 + e`` and ``b - o + 1 + e`` columns; here e = extra(a).
3. The product runs by block, a column crossed with a band of sizes; columns with one row are left out first.
4. In a block every row is first multiplied with one row only, the one that meets the column earliest (the least
   edited of a group of copies). Verified links are contracted to components, so the pairs inside a large group
   of near copies are never produced.
5. Then the rows of a block outside its first row's component meet the rows of other components. Overlaps are
   accumulated per pair over the pair's first columns, and pairs that stay under ``1 + e`` are discarded. What
   remains is counted exactly on whole sets and completes the components.

No pair of different components is lost: its ``1 + e`` common columns all lie in blocks of the larger row's band.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfold.llm import grams
from lumenfold.llm.batches import small_batches
from lumenfold.llm.components import components
from lumenfold.session import materialize, materialize_counting

#: Counters of the rarity estimate; their 8 bytes each are all that is sent to the driver and to the tasks.
COUNTER_BITS = 20
_PART_BITS = 10
#: Up to this many wanted texts are sent to all tasks (16 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Rows of a block that a task multiplies by itself, rows of all blocks of a task, and pairs that it holds at a time.
BLOCK_ROWS, TASK_ROWS, _PAIRS_AT_A_TIME = 256, 1 << 17, 1 << 20
#: Sets and shingles of a tile of the exact count, on average.
TILE_SETS, TILE_GRAMS = 512, 1 << 18


def count_columns(texts: DataFrame, words: int, bits: int = COUNTER_BITS) -> np.ndarray:
    """In how many texts the shingles of each counter occur; ``texts`` has a binary column ``text``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for found in grams.word_hashes(batch.column(0).to_pylist()):
                held.append((grams.shingle_set(found, words) >> np.uint64(64 - bits)).astype(np.int64))
                size += len(held[-1])
                if size >= total.size:
                    total += np.bincount(np.concatenate(held), minlength=total.size)
                    held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=total.size)
        yield _parts(dict(enumerate(total.reshape(-1, 1 << _PART_BITS))))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                values = np.frombuffer(counts, np.int64)
                sums[part] = sums[part] + values if part in sums else values
        yield _parts(sums)

    kept = "part int, counts binary"
    split = texts.select("text").mapInArrow(count, kept).repartition("part").mapInArrow(add, kept)
    total = np.zeros((1 << (bits - _PART_BITS), 1 << _PART_BITS), np.int64)
    for row in split.collect():
        total[row["part"]] += np.frombuffer(row["counts"], np.int64)
    return total.ravel()


def _parts(counts: dict[int, np.ndarray]) -> pa.RecordBatch:
    values = [v.tobytes() for v in counts.values()]
    return pa.record_batch([pa.array(list(counts), pa.int32()), pa.array(values, pa.binary())], ["part", "counts"])


def column_ranks(counts: np.ndarray) -> np.ndarray:
    """A small number per counter: 0 where the count is what chance gives, more the more it exceeds that."""
    usual = float(np.median(counts))
    excess = np.maximum(0, counts - usual - 3 * math.sqrt(usual))
    return np.ceil(np.log2(1 + excess) * 2).astype(np.uint8)


def extra(n, percent: int):
    """How many columns beyond the first are asked of a pair whose smaller set has n; an eighth of its slack."""
    share = n * (100 - percent)
    return F.floor(share / 800) if isinstance(n, Column) else share // 800


def incidence(texts: DataFrame, words: int, percent: int, ranks: np.ndarray) -> DataFrame:
    """``texts`` with, in place of ``text``: n (set size), node (the set's number, null if empty), prefix."""
    bits = int(math.log2(len(ranks)))
    shared = texts.sparkSession.sparkContext.broadcast(ranks)
    others = [c for c in texts.columns if c != "text"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranked = shared.value
        for batch in batches:
            sizes, nodes, prefixes = [], [], []
            for found in grams.word_hashes(batch.column("text").to_pylist()):
                chosen = grams.shingle_set(found, words)
                n = len(chosen)
                sizes.append(n)
                nodes.append(xxhash.xxh3_64_intdigest(chosen.tobytes()) - (1 << 63) if n else None)
                order = np.argsort(ranked[(chosen >> np.uint64(64 - bits)).astype(np.int64)], kind="stable")
                reach = n + (-percent * n) // 100 + 1 + extra(n, percent) if n else 0
                prefixes.append(chosen[order[:reach]].view(np.int64))
            ends = np.cumsum([0, *map(len, prefixes)])
            flat = pa.array(np.concatenate(prefixes) if prefixes else np.empty(0, np.int64))
            made = [pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)]
            yield pa.record_batch([*(batch.column(c) for c in others), *made], [*others, "n", "node", "prefix"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in texts.schema if f.name != "text")
    return texts.mapInArrow(rows, kept + "n bigint, node bigint, prefix array<bigint>")


def shingle_arrays(texts: DataFrame, words: int) -> DataFrame:
    """``node, grams``: the whole sets of some texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sets = batch.column("node").to_pylist(), grams.word_hashes(batch.column("text").to_pylist())
            for at, found in enumerate(sets):
                chosen = pa.array(grams.shingle_set(found, words).view(np.int64))
                ends = pa.array([0, len(chosen)], pa.int32())
                yield pa.record_batch([pa.array([nodes[at]], pa.int64()), pa.ListArray.from_arrays(ends, chosen)], ["node", "grams"])

    return texts.select("node", "text").mapInArrow(rows, "node bigint, grams array<bigint>")


def _needed(a: Column, b: Column, percent: int) -> Column:
    """The least overlap of two linked sets of these sizes."""
    return F.floor((percent * (a + b) + 99 + percent) / (100 + percent))


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _counts(a: Column, i: Column, b: Column, j: Column, percent: int) -> Column:
    """Whether a common column at positions i and j is among the pair's first columns."""
    most = extra(F.least(a, b), percent) - _needed(a, b, percent)
    return _sizes_fit(a, b, percent) & (i <= a + most) & (j <= b + most)


def link_nodes(nodes: DataFrame, wanted_sets, percent: int) -> tuple[DataFrame, DataFrame]:
    """All that links sets of different content: ``links (a, b)`` found, and ``node, root`` of their components.

    ``nodes`` has one row per set: node, n, prefix. ``wanted_sets(frame of node)`` gives ``node, grams``.
    """
    entries = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "gram"))
    entries = entries.select("gram", "node", (F.shiftleft("n", 32) + F.col("pos")).alias("both"))
    several = entries.groupBy("gram").agg(F.count("*").alias("rows")).where("rows > 1").select("gram")
    shared = entries.join(several, "gram", "left_semi")
    shared = shared.select("gram", "node", F.shiftright("both", 32).alias("n"), F.col("both").bitwiseAND(0xFFFFFFFF).alias("pos"))
    # A little wider than the size bound, so that linked rows are never more than one band apart.
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100.5 / percent)).cast("int")
    shared = materialize(shared.withColumn("band", band), "shared-columns")
    blocks = shared.select("*", F.explode(F.array("band", F.col("band") + 1)).alias("block"))
    first = blocks.groupBy("gram", "block").agg(F.min(F.struct("pos", "node", "n", "band")).alias("f"), F.count("*").alias("rows"))
    first = first.where("rows > 1").select("gram", "block", *(F.col(f"f.{c}").alias(f"first_{c}") for c in ("pos", "node", "n", "band")))
    col = F.col

    star = blocks.join(first, ["gram", "block"]).where(col("node") != col("first_node"))
    star = star.where((col("block") == F.greatest("band", "first_band")) & _counts(col("n"), col("pos"), col("first_n"), col("first_pos"), percent))
    star = star.groupBy(F.least("node", "first_node").alias("a"), F.greatest("node", "first_node").alias("b")).agg(
        F.count("*").alias("overlap"), F.least(F.first("n"), F.first("first_n")).alias("smaller")
    )
    # Not all columns of a pair have the same first row: a third of the asked overlap is enough to look closer.
    star = star.where(3 * col("overlap") >= 1 + extra(col("smaller"), percent)).select("a", "b")
    links = materialize(_verified(materialize(star, "star-pairs"), wanted_sets, percent), "star-links")
    roots = materialize(components(links), "star-roots")

    member = blocks.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    member = materialize(member, "members")
    summed = _overlaps(member, percent).groupBy("a", "b").agg(F.sum("overlap").alias("overlap"), F.first("smaller").alias("smaller"))
    rest = summed.where(col("overlap") >= 1 + extra(col("smaller"), percent)).select("a", "b")
    links = links.unionByName(_verified(materialize(rest, "rest-pairs"), wanted_sets, percent))
    links = materialize(links, "links")
    return links, materialize(components(links), "roots")


def _overlaps(member: DataFrame, percent: int) -> DataFrame:
    """``a, b, smaller, overlap``: first columns that rows of different components share, in parts to be added up.

    Columns of one group of similar rows mostly have the same smallest row, so blocks are dealt by it: a task adds up
    what its blocks say of a pair and gives it out once. Blocks of one smallest row that hold too many rows together
    are dealt to several tasks by column. A block with too many rows for one task is joined with itself, by Spark.
    """
    col = F.col
    blocks = member.groupBy("gram", "block").agg(F.count("*").alias("rows"), F.min("node").alias("least"), (F.min("root") < F.max("root")).alias("mixed"))
    blocks = materialize(blocks.where("mixed"), "mixed-blocks")
    dealt = blocks.where(col("rows") <= BLOCK_ROWS)
    loads = dealt.groupBy("least").agg(F.ceil(F.sum("rows") / TASK_ROWS).alias("parts"))
    dealt = dealt.join(loads, "least").select("gram", "block", "least", F.pmod(F.xxhash64("gram"), "parts").alias("part"))
    given = member.join(dealt, ["gram", "block"]).select("least", "part", "gram", "block", "node", "root", "n", "pos", "band")
    made = given.groupBy("least", "part").applyInArrow(_product(percent), "a bigint, b bigint, smaller bigint, overlap bigint")

    wide = member.join(blocks.where(col("rows") > BLOCK_ROWS).select("gram", "block"), ["gram", "block"])
    side = lambda k: wide.select("gram", "block", *(col(c).alias(f"{k}_{c}") for c in ("node", "n", "pos", "band", "root")))
    met = side("l").join(side("r"), ["gram", "block"]).where(
        (col("l_root") != col("r_root"))
        & (col("l_node") < col("r_node"))
        & (col("block") == F.greatest("l_band", "r_band"))
        & _counts(col("l_n"), col("l_pos"), col("r_n"), col("r_pos"), percent)
    )
    smaller = F.least(F.first("l_n"), F.first("r_n")).alias("smaller")
    rest = met.groupBy(col("l_node").alias("a"), col("r_node").alias("b")).agg(smaller, F.count("*").alias("overlap"))
    return made.unionByName(rest)


def _product(percent: int):
    """The product of some blocks: per pair of rows of different components, the columns that count."""

    def multiply(table: pa.Table) -> pa.Table:
        columns = {c: table.column(c).to_numpy() for c in ("gram", "block", "node", "root", "n", "pos", "band")}
        order = np.lexsort((columns["node"], columns["block"], columns["gram"]))
        columns = {c: v[order] for c, v in columns.items()}
        new = np.append(True, (np.diff(columns["gram"]) != 0) | (np.diff(columns["block"]) != 0))
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(order)))
        held: list[np.ndarray] = []
        for size in np.unique(sizes).tolist():
            left, right = np.triu_indices(size, 1)
            of_size = starts[sizes == size]
            step = max(1, _PAIRS_AT_A_TIME // len(left)) if len(left) else len(of_size)
            for k in range(0, len(of_size), step):
                at = of_size[k : k + step, None]
                held.append(_counted_pairs({c: v[(at + left).ravel()] for c, v in columns.items()}, {c: v[(at + right).ravel()] for c, v in columns.items()}, percent))
                if sum(map(len, held)) > _PAIRS_AT_A_TIME:
                    held = [_added(held)]
        found = _added(held)
        return pa.table({name: pa.array(found[:, k]) for k, name in enumerate(("a", "b", "smaller", "overlap"))})

    return multiply


def _counted_pairs(left: dict[str, np.ndarray], right: dict[str, np.ndarray], percent: int) -> np.ndarray:
    """Rows a, b, smaller size, 1 of the pairs whose common column counts; a is the smaller node."""
    a, b = left["n"], right["n"]
    least, most = np.minimum(a, b), np.maximum(a, b)
    reach = extra(least, percent) - (percent * (a + b) + 99 + percent) // (100 + percent)
    good = (left["root"] != right["root"]) & (left["block"] == np.maximum(left["band"], right["band"])) & (100 * least >= percent * most)
    good &= (left["pos"] <= a + reach) & (right["pos"] <= b + reach)
    found = np.column_stack([left["node"][good], right["node"][good], least[good], np.ones(int(good.sum()), np.int64)])
    return _added([found])


def _added(parts: list[np.ndarray]) -> np.ndarray:
    """Parts with each pair once, and its overlaps added up."""
    rows = np.concatenate([np.empty((0, 4), np.int64), *parts])
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    first = np.flatnonzero(np.append(True, (np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 1]) != 0)))
    made = rows[first]
    made[:, 3] = np.add.reduceat(rows[:, 3], first)
    return made


def _verified(pairs: DataFrame, wanted_sets, percent: int) -> DataFrame:
    """The pairs whose whole sets overlap enough."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = materialize(wanted_sets(ends), "wanted-sets")
    one = sets.select(F.col("node").alias("a"), F.col("grams").alias("a_grams"))
    two = sets.select(F.col("node").alias("b"), F.col("grams").alias("b_grams"))
    overlap = F.size(F.array_intersect("a_grams", "b_grams"))
    union = F.size("a_grams") + F.size("b_grams") - overlap
    return pairs.join(one, "a").join(two, "b").where(100 * overlap >= percent * union).select("a", "b")


def count_links(members: DataFrame, wanted_sets, percent: int) -> DataFrame:
    """``node, n_linked``: how many rows of other sets of its component each set links with, counted exactly.

    ``members`` has one row per set of a component: node, root, n, copies. A component is cut into tiles by bands of
    sizes and a hash, bounded in sets and shingles. One task multiplies two tiles and keeps sums per set, no pairs.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100.5 / percent)).cast("int")
    members = materialize(members.withColumn("band", band), "members-banded")
    cells = members.groupBy("root", "band").agg(F.count("*").alias("sets"), F.sum("n").alias("grams"))
    cells = cells.select("root", "band", F.ceil(F.greatest(F.col("sets") / TILE_SETS, F.col("grams") / TILE_GRAMS)).cast("int").alias("tiles"))
    cells = materialize(cells, "cells")
    tiled = members.join(cells, ["root", "band"]).withColumn("tile", F.pmod(F.xxhash64("node"), "tiles").cast("int"))
    rows = materialize(tiled.join(wanted_sets(members.select("node")), "node").select("root", "band", "tile", "node", "copies", "grams"), "tiles")
    tiles = cells.select("root", "band", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
    # Linked sets are never more than one band apart.
    one = tiles.select("root", F.col("band").alias("a_band"), F.col("tile").alias("a_tile"), F.explode(F.array("band", F.col("band") + 1)).alias("b_band"))
    two = tiles.select("root", F.col("band").alias("b_band"), F.col("tile").alias("b_tile"))
    pairs = one.join(two, ["root", "b_band"]).where("a_band < b_band OR a_tile <= b_tile")
    same = (F.col("a_band") == F.col("b_band")) & (F.col("a_tile") == F.col("b_tile"))
    key = ["root", "a_band", "a_tile", "b_band", "b_tile"]
    ends = F.when(same, F.array(F.lit(2))).otherwise(F.array(F.lit(0), F.lit(1)))
    sides = pairs.select(*key, F.explode(ends).alias("side"))
    sides = sides.withColumn("band", F.when(F.col("side") == 1, F.col("b_band")).otherwise(F.col("a_band")))
    sides = sides.withColumn("tile", F.when(F.col("side") == 1, F.col("b_tile")).otherwise(F.col("a_tile")))
    met = sides.join(rows, ["root", "band", "tile"]).select(*key, "side", "node", "copies", "grams")

    def multiply(table: pa.Table) -> pa.Table:
        side, nodes, copies = (table.column(c).to_numpy() for c in ("side", "node", "copies"))
        lists = table.column("grams").combine_chunks()
        sizes = lists.value_lengths().to_numpy()
        grams_, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(nodes)), sizes)
        owner = owner[np.argsort(grams_, kind="stable")]
        _, counts = np.unique(grams_, return_counts=True)
        overlap = np.zeros((len(nodes), len(nodes)), np.int32)
        for rows_ in np.split(owner, np.cumsum(counts)[:-1]):
            if len(rows_) > 1:
                overlap[np.ix_(rows_, rows_)] += 1
        linked = 100 * overlap.astype(np.int64) >= percent * (sizes[:, None] + sizes[None, :] - overlap)
        linked &= (side[:, None] != side[None, :]) | (side[:, None] == 2)
        np.fill_diagonal(linked, False)
        return pa.table({"node": pa.array(nodes, pa.int64()), "n_linked": pa.array(linked @ copies.astype(np.int64), pa.int64())})

    found = met.groupBy(*key).applyInArrow(multiply, "node bigint, n_linked bigint")
    return found.groupBy("node").agg(F.sum("n_linked").alias("n_linked"))


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", id: str = "doc_id", counted: bool = True) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id and, if ``counted``, n_linked.

    component_id is the smallest id reachable over links, its own included. n_linked is the number of other rows the
    row links with, rows of the same set included. Counting is quadratic in the size of one component.
    Null and empty texts and texts without words have no shingles, link with nothing, and keep their own id.
    Rows may repeat ids; a null id gets the smallest id of its component, or null. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("binary").alias("text"))
    ranks = column_ranks(count_columns(rows, words))
    keyed = rows.withColumn("text_key", F.xxhash64("text"))
    stored = materialize(incidence(keyed, words, percent, ranks), "incidence")
    worded = stored.where("n > 0")
    nodes = worded.groupBy("node").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))

    def wanted_sets(ends: DataFrame) -> DataFrame:
        ends, count = materialize_counting(worded.join(ends, "node", "left_semi").groupBy("node").agg(F.min("text_key").alias("text_key")), "wanted", F.lit(True))
        ends = F.broadcast(ends) if count <= BROADCAST_ROWS else ends
        # Copies of a text pass here too; one of each stays.
        texts = keyed.join(ends, "text_key").select("node", "text")
        return shingle_arrays(texts, words).groupBy("node").agg(F.first("grams").alias("grams"))

    _, roots = link_nodes(nodes, wanted_sets, percent)
    member = stored.select("id", "n", "node").join(roots, "node", "left")
    if counted:
        copies = worded.groupBy("node").agg(F.first("n").alias("n"), F.count("*").alias("copies"))
        copies = materialize(copies.join(roots, "node", "left"), "set-copies")
        others = count_links(copies.where("root IS NOT NULL"), wanted_sets, percent)
        alike = copies.select("node", (F.col("copies") - 1).alias("alike")).join(others, "node", "left")
        member = member.join(alike.select("node", (F.col("alike") + F.coalesce("n_linked", F.lit(0))).alias("n_linked")), "node", "left")
    member = member.withColumn("root", F.coalesce("root", "node"))
    lowest = member.where("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("component_id"))
    found = member.join(lowest, "root", "left")
    return found.select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
        *([F.coalesce("n_linked", F.lit(0)).alias("n_linked")] if counted else []),
    )


def keep_representatives(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component: the one with its smallest doc_id.

    Rows with a null doc_id stay, and so do all rows that repeat the smallest id.
    """
    found = jaccard_components(docs, words, percent, counted=False).where("doc_id IS NOT NULL")
    first = found.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("first"))
    # The few that go are sent to the texts, not the texts to them.
    gone, count = materialize_counting(first.where("NOT first").select("doc_id"), "near-duplicates", F.lit(True))
    return docs.join(F.broadcast(gone) if count <= BROADCAST_ROWS else gone, "doc_id", "left_anti")
