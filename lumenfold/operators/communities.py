"""Weighted community detection.

Quality: Q = 1/2m · Σ (w_ij − γ·k_i·k_j / 2m) over pairs in one community
(Reichardt & Bornholdt 2006). Local moves with contraction (Blondel et al. 2008)
run for every scope and every sweep setting in the same plan: all rounds of a graph
in one task, or as joins and aggregates if its links are too many. What contraction
has fixed too early is then mended (Traag et al. 2019): single nodes move until
none improves, and communities that are not connected are split. On request each
community is then refined, from single nodes, into parts that hang together
well, and whole parts move next door or leave, until nothing changes. State between rounds is stored in the
shared folder. Only counts reach the driver.

Why it ends: a level starts with some rounds in which all nodes move at once,
which is fast but need not raise Q. After those, nodes move only as far as their
gains outweigh what other moves of the round can take from them, so Q rises every
round; there are finitely many partitions. A contraction that merges leaves fewer
nodes. A split of an unconnected community never lowers Q, and parts move by the
same rule, so each pass that changes something raises Q too. How many rounds that
takes does not grow with the size of a community.
"""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenfold.functions.index import dense_index
from lumenfold.operators import moves
from lumenfold.schema import DEFAULT_SEED
from lumenfold.session import materialize, materialize_counting

EPSILON = 1e-12
DROP_SETTLED_EVERY = 4


#: How far from the best part a node may draw, in shares of its strength.
RANDOMNESS = 0.01

#: Rounds in which all nodes move at once, before only those move whose gains add up.
FAST_ROUNDS = 24

#: Links, both directions counted, up to which the rounds of a graph run in the memory of one task.
LOCAL_LINKS = 4_000_000


def _move_round(links: DataFrame, state: DataFrame, keys: list[str], salt: str, backward: bool, summed: bool = False, alone: bool = False, crowds: bool = True) -> DataFrame:
    """One round: every node looks at the communities next door.

    A node whose best community beats staying moves if that community comes
    before its own in this round's order, a hash of label and round. An order
    runs one way, so two neighbours can never swap places; every second round
    runs ``backward``, so no move waits longer than that. Ties go to the smaller
    label. In a ``summed`` round nodes move whose gains add up (``_summed_moves``);
    the best move of all always happens. With ``alone`` a node may also leave for a
    community of its own, which gets a negative name.
    """
    near = links.join(state.select(*keys, F.col("node").alias("dst"), "label"), [*keys, "dst"]).select(
        *keys, F.col("src").alias("node"), "label", "w"
    )
    staying = state.select(*keys, "node", "label", F.lit(0.0).alias("w"))
    if alone:
        leaving = state.select(*keys, "node", (-1 - F.col("node")).alias("label"), F.lit(0.0).alias("w"))
        staying = staying.unionByName(leaving)
    pull = near.unionByName(staying).groupBy(*keys, "node", "label").agg(F.sum("w").alias("w"))
    strength = state.groupBy(*keys, "label").agg(F.sum("k").alias("label_k"))
    own = state.select(*keys, "node", F.col("label").alias("own"), "k", "two_m", "resolution")
    rest = F.coalesce("label_k", F.lit(0.0)) - F.when(F.col("label") == F.col("own"), F.col("k")).otherwise(0.0)
    gain = F.col("w") - F.col("resolution") * F.col("k") * rest / F.col("two_m")
    offers = pull.join(strength, [*keys, "label"], "left").join(own, [*keys, "node"]).withColumn("gain", gain)
    best = offers.groupBy(*keys, "node").agg(
        F.max_by("label", F.struct("gain", -F.col("label"))).alias("best"),
        F.max("gain").alias("best_gain"),
        F.max(F.when(F.col("label") == F.col("own"), F.col("gain"))).alias("stay_gain"),
        *[F.first(c).alias(c) for c in ("own", "k", "two_m", "resolution")],
    )
    improving = F.col("best_gain") > F.col("stay_gain") + EPSILON
    if summed:
        return _summed_moves(best.withColumn("improving", improving), keys, crowds)
    ahead, behind = ("own", "best") if backward else ("best", "own")
    onward = F.xxhash64(ahead, F.lit(salt)) < F.xxhash64(behind, F.lit(salt))
    return best.select(
        *keys,
        "node",
        F.when(improving & onward, F.col("best")).otherwise(F.col("own")).alias("label"),
        "k",
        "two_m",
        "resolution",
        improving.alias("improving"),
    )


def _summed_moves(best: DataFrame, keys: list[str], crowds: bool) -> DataFrame:
    """The state after moves whose gains add up, many for each community.

    A community is left or joined in this round, as its best move says; moves against that wait. So two movers meet in
    the community that both leave, or in the one that both join, or in both. For links that are not negative each such
    meeting adds to the sum of their gains at least ``-resolution * k * k' / two_m``. A node moves if its gain is more than
    that for all others that want to leave its community or to join its new one. A move that is the best of both its
    communities always happens: it meets only moves that allow for it, and the best move of all is one. Without
    ``crowds``, for links that may be negative, only such moves happen.
    """
    order = F.struct((F.col("best_gain") - F.col("stay_gain")).alias("delta"), (-F.col("node")).alias("node"))
    moves = best.where("improving").select(*keys, "own", "best", "k", order.alias("move"))
    side = lambda label, leaves: F.struct(F.col(label).alias("label"), F.lit(leaves).alias("leaves"))
    touched = moves.select(*keys, "k", "move", F.inline(F.array(side("own", True), side("best", False))))
    top = touched.groupBy(*keys, "label").agg(
        F.max(F.struct("move", "leaves")).alias("top"),
        F.sum(F.when(F.col("leaves"), F.col("k")).otherwise(0.0)).alias("leaving"),
        F.sum(F.when(F.col("leaves"), 0.0).otherwise(F.col("k"))).alias("joining"),
    )
    of = lambda label: top.select(*keys, F.col("label").alias(label), F.struct("top.*", "leaving", "joining").alias(f"at_{label}"))
    first = (order == F.col("at_own.move")) & (order == F.col("at_best.move"))
    others = F.col("at_own.leaving") + F.col("at_best.joining") - 2 * F.col("k")
    loss = F.col("resolution") * F.col("k") * others / F.col("two_m")
    along = F.col("at_own.leaves") & ~F.col("at_best.leaves") & (order["delta"] > loss + EPSILON)
    goes = F.col("improving") & (first | (F.lit(crowds) & along))
    return best.join(of("own"), [*keys, "own"], "left").join(of("best"), [*keys, "best"], "left").select(
        *keys, "node", F.when(goes, F.col("best")).otherwise(F.col("own")).alias("label"), "k", "two_m", "resolution", "improving"
    )


def _settle(links: DataFrame, state: DataFrame, keys: list[str], salt: str, fast: int = FAST_ROUNDS, alone: bool = False, crowds: bool = True, large: DataFrame | None = None) -> DataFrame:
    """Repeat rounds until no node of any key improves.

    The ``fast`` rounds end early when two in a row leave no fewer improving nodes than one before: they may go in circles.
    All rounds of a key run in one task (``moves``), but those of the keys in ``large`` as joins and aggregates.
    """
    if large is None:
        return _settle_in_tasks(links, state, keys, salt, fast, alone, crowds)
    joined = _settle_by_joins(links.join(large, keys, "left_semi"), state.join(large, keys, "left_semi"), keys, salt, fast, alone, crowds)
    rest = _settle_in_tasks(links.join(large, keys, "left_anti"), state.join(large, keys, "left_anti"), keys, salt, fast, alone, crowds)
    return rest.unionByName(joined.select(*rest.columns))


def _settle_in_tasks(links: DataFrame, state: DataFrame, keys: list[str], salt: str, fast: int, alone: bool, crowds: bool) -> DataFrame:
    """``_settle`` with a task for each key. How long the fast rounds go on follows from all keys, so it is known only
    after they have run: when they should have ended early, all is run again with as many as it takes."""
    state = state.select(*keys, "node", "label", "k", "two_m", "resolution")
    schema = T.StructType([*state.schema.fields, T.StructField("counts", T.ArrayType(T.LongType()))])
    spark = state.sparkSession
    # Links are few bytes and rounds are not, so the number of tasks must not follow from their bytes.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    links, state = links.select(*keys, "src", "dst", "w").repartition(tasks, *keys), state.repartition(tasks, *keys)
    while True:
        task = moves.settled_task(salt, fast, alone, crowds)
        settled = materialize(links.groupBy(*keys).cogroup(state.groupBy(*keys)).applyInArrow(task, schema), "settled-tasks")
        by_round = settled.where("counts IS NOT NULL").select(F.posexplode("counts").alias("number", "left"))
        left = dict(by_round.groupBy("number").agg(F.sum("left")).collect()) if fast else {}
        enough = _fast_enough([left.get(number, 0) for number in range(fast)])
        if enough == fast:
            return settled.drop("counts")
        fast = enough


def _fast_enough(left: list[int]) -> int:
    """After how many fast rounds, of which each left so many improving nodes, no more should follow."""
    fewest, idle = None, 0
    for number, count in enumerate(left):
        if not count:
            return len(left)  # nothing moves from here on
        idle = 0 if fewest is None or count < fewest else idle + 1
        fewest = count if fewest is None else min(count, fewest)
        if idle >= 2:
            return number + 1
    return len(left)


def _settle_by_joins(links: DataFrame, state: DataFrame, keys: list[str], salt: str, fast: int, alone: bool, crowds: bool) -> DataFrame:
    """``_settle`` as a loop of joins and aggregates, which needs no memory for a whole graph. Every few rounds the settled
    keys leave the loop."""
    settled, active, fewest, idle = [], state, None, 0
    for number in itertools.count():
        summed = number >= fast or idle >= 2
        made = _move_round(links, active, keys, f"{salt}:{number // 2}", number % 2 == 1, summed, alone, crowds)
        moved, left = materialize_counting(made, "round", F.col("improving"))
        active = moved.drop("improving")
        if not left:
            break
        if not summed:
            idle = 0 if fewest is None or left < fewest else idle + 1
            fewest = left if fewest is None else min(left, fewest)
        if number % DROP_SETTLED_EVERY == DROP_SETTLED_EVERY - 1:
            open_keys = moved.where("improving").select(*keys).distinct()
            settled.append(active.join(open_keys, keys, "left_anti"))
            active = active.join(open_keys, keys, "left_semi")
    return reduce(DataFrame.unionByName, [*settled, active])


def refine(links: DataFrame, state: DataFrame, keys: list[str], salt: str) -> DataFrame:
    """Parts of every community that hang together well: ``state`` with the column ``part``, named after one member.

    ``state`` is ``(keys, node, label, k, two_m, resolution)``. All nodes start alone. A node that is alone, and tied to
    the rest of its community at least as strongly as its strength lets one expect, joins a part of its community that
    is tied to the rest likewise, if joining does not lower the quality. Among such parts it draws one, better ones with
    higher odds (seeded; the largest of score and noise). A part is never taken apart, so each has grown by joins of
    single nodes that did not lower the quality.

    Several nodes may join one part in one round: the best of them, and those that would still join if all others had
    joined before. Of nodes that want to join each other, a hash of node and round decides who stays; along a chain of
    wishes the hash falls until somebody stays, so each round somebody joins, and the loop ends.
    """
    at = state.select(*keys, "node", "label")
    inside = materialize(
        links.join(at.withColumnsRenamed({"node": "src", "label": "_a"}), [*keys, "src"])
        .join(at.withColumnsRenamed({"node": "dst", "label": "_b"}), [*keys, "dst"])
        .where("_a = _b")
        .select(*keys, "src", "dst", "w"),
        "inside-links",
    )
    whole = state.groupBy(*keys, "label").agg(F.sum("k").alias("whole"))
    parts = state.join(whole, [*keys, "label"]).withColumn("part", F.col("node"))
    expected = lambda one, other: F.col("resolution") * one * other / F.col("two_m")
    for number in itertools.count():
        sizes = parts.groupBy(*keys, "part").agg(
            F.sum("k").alias("part_k"), F.count("*").alias("many"),
            *[F.first(c).alias(c) for c in ("whole", "two_m", "resolution")],
        )
        of = lambda side, name: parts.select(*keys, F.col("node").alias(side), F.col("part").alias(name))
        pull = (
            inside.join(of("dst", "part"), [*keys, "dst"])
            .join(of("src", "own"), [*keys, "src"])
            .where("own <> part")
            .groupBy(*keys, F.col("src").alias("node"), "own", "part")
            .agg(F.sum("w").alias("w"))
        )
        pull = materialize(pull, "pull")
        ties = pull.groupBy(*keys, F.col("part")).agg(F.sum("w").alias("cut"))
        sound = sizes.join(ties, [*keys, "part"]).where(
            F.col("cut") >= expected(F.col("part_k"), F.col("whole") - F.col("part_k"))
        )
        single = sound.where("many = 1").select(*keys, F.col("part").alias("node"), F.col("part_k").alias("k"))
        gain = F.col("w") - expected(F.col("k"), F.col("part_k"))
        noise = (F.pmod(F.xxhash64("node", "part", F.lit(f"{salt}:{number}")), F.lit(1 << 52)) + 0.5) / float(1 << 52)
        offers = (
            pull.join(single, [*keys, "node"])
            .join(sound, [*keys, "part"])
            .withColumn("gain", gain)
            .where("gain >= 0")
            .withColumn("score", F.col("gain") / (RANDOMNESS * F.col("k")) - F.log(-F.log(noise)))
        )
        wish = offers.groupBy(*keys, "node").agg(
            F.max_by(F.struct("part", "many", "w", "gain", "part_k", "k", "two_m", "resolution"), "score").alias("wish")
        )
        wish = wish.select(*keys, "node", "wish.*")
        order = lambda c: F.xxhash64(c, F.lit(f"{salt}:{number}"))
        ready = wish.where((F.col("many") > 1) | (order(F.col("part")) < order(F.col("node"))))
        movers = ready.join(ready.select(*keys, F.col("node").alias("part")), [*keys, "part"], "left_anti")
        crowd = movers.groupBy(*keys, "part").agg(
            F.sum("k").alias("crowd_k"), F.max(F.struct("gain", "node")).alias("first")
        )
        late = F.col("part_k") + F.col("crowd_k") - F.col("k")
        joins = movers.join(crowd, [*keys, "part"]).where(
            (F.col("first.node") == F.col("node")) | (F.col("w") >= expected(F.col("k"), late))
        )
        joined = parts.join(joins.select(*keys, "node", F.col("part").alias("_to")), [*keys, "node"], "left")
        joined = joined.withColumns({"part": F.coalesce("_to", "part"), "moved": F.col("_to").isNotNull()}).drop("_to")
        parts, moved = materialize_counting(joined.select(*parts.columns, "moved"), "parts-of", F.col("moved"))
        parts = parts.drop("moved")
        if not moved:
            return parts.drop("whole")


def _between(links: DataFrame, parts: DataFrame, keys: list[str]) -> DataFrame:
    """Links between parts, both directions, with the weights of their nodes' links added up."""
    of = lambda side, name: parts.select(*keys, F.col("node").alias(side), F.col("part").alias(name))
    return (
        links.join(of("src", "_a"), [*keys, "src"])
        .join(of("dst", "_b"), [*keys, "dst"])
        .where("_a <> _b")
        .groupBy(*keys, F.col("_a").alias("src"), F.col("_b").alias("dst"))
        .agg(F.sum("w").alias("w"))
    )


def _part_state(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The parts as nodes of their communities."""
    return parts.groupBy(*keys, F.col("part").alias("node")).agg(
        F.first("label").alias("label"), F.sum("k").alias("k"), F.first("two_m").alias("two_m"), F.first("resolution").alias("resolution")
    )


def _move_parts(links: DataFrame, state: DataFrame, keys: list[str], salt: str, crowds: bool = True, large: DataFrame | None = None) -> tuple[DataFrame, int]:
    """``(keys, node, label)`` after whole parts have moved until none improves, and how many have moved."""
    parts = refine(links, state, keys, salt)
    before = materialize(_part_state(parts, keys), "part-nodes")
    settled = _settle(materialize(_between(links, parts, keys), "part-links"), before, keys, f"{salt}:parts", 0, alone=True, crowds=crowds, large=large)
    after = settled.select(*keys, F.col("node").alias("part"), F.col("label").alias("_to"))
    placed = parts.join(after, [*keys, "part"])
    placed, moved = materialize_counting(placed, "moved-parts", F.expr("label <> _to"))
    return placed.select(*keys, "node", F.col("_to").alias("label")), moved


def connected_components(links: DataFrame, nodes: DataFrame, keys: list[str]) -> DataFrame:
    """Smallest node id of each node's component: ``(keys, node, component)``.

    ``links`` holds both directions. Each round takes the smallest label next
    door and then the label of that label, so paths halve in length. Labels only
    sink, so it ends.
    """
    state = nodes.select(*keys, "node", F.col("node").alias("component"))
    while True:
        near = (
            links.join(state.select(*keys, F.col("node").alias("dst"), "component"), [*keys, "dst"])
            .groupBy(*keys, F.col("src").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lowered = state.join(near, [*keys, "node"], "left").select(
            *keys, "node", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        jump = lowered.select(*keys, F.col("node").alias("component"), F.col("component").alias("jump"))
        jumped, changed = materialize_counting(
            lowered.join(jump, [*keys, "component"], "left").select(
                *keys, "node", "old", F.least("component", "jump").alias("component")
            ),
            "components",
            F.expr("component < old"),
        )
        state = jumped.drop("old")
        if not changed:
            return state


def detect_communities(
    edges: DataFrame,
    keys: list[str],
    *,
    resolution: float | None = None,
    seed: int = DEFAULT_SEED,
    refined: bool = False,
) -> DataFrame:
    """Community of every node that has an edge: ``(keys, node, community)``.

    ``edges`` is ``(keys, src < dst, w)`` with a ``resolution`` column unless one
    value is given. The community is named after its smallest member. Nodes
    without an edge are communities of their own and are not listed. No single
    node can raise the quality by moving to a community next to it. If ``refined``,
    no part that ``refine`` finds can do so either, nor by leaving; that takes some
    more loops, and node numbers must not be negative.
    """
    if resolution is not None:
        edges = edges.withColumn("resolution", F.lit(float(resolution)))
    flip = edges.select(*keys, F.col("dst").alias("src"), F.col("src").alias("dst"), "w", "resolution")
    weak = ~F.coalesce(F.col("w") > EPSILON, F.lit(False))
    both, weak_links = materialize_counting(edges.select(*keys, "src", "dst", "w", "resolution").unionByName(flip), "links", weak)
    crowds = not weak_links
    links = both.select(*keys, "src", "dst", "w")
    strengths = both.groupBy(*keys, F.col("src").alias("node")).agg(
        F.sum("w").alias("k"), F.first("resolution").alias("resolution"), F.count("*").alias("_links")
    )
    totals = strengths.groupBy(*keys).agg(F.sum("k").alias("two_m"), F.sum("_links").alias("_of"))
    too_many = F.col("_of") > LOCAL_LINKS
    sized, many = materialize_counting(strengths.drop("_links").join(totals, keys), "nodes", too_many)
    large = sized.where(too_many).select(*keys).distinct() if many else None
    nodes = sized.drop("_of")
    if resolution == 0 and crowds:  # any two parts with a link belong together, so no move has to be weighed
        whole = connected_components(links.select(*keys, "src", "dst"), nodes.where("node is not null"), keys)
        return whole.withColumnRenamed("component", "community")
    placed = nodes.select(*keys, "node", F.col("node").alias("label"))

    level_nodes, level_links = nodes, links
    for level in itertools.count():
        state = level_nodes.withColumn("label", F.col("node"))
        state, merged = materialize_counting(
            _settle(level_links, state, keys, f"{seed}:{level}", crowds=crowds, large=large), "settled", F.expr("label <> node")
        )
        moved = state.select(*keys, F.col("node").alias("label"), F.col("label").alias("_to"))
        placed = placed.join(moved, [*keys, "label"]).select(*keys, "node", F.col("_to").alias("label"))
        if not merged:
            break
        placed = materialize(placed, "placed")
        level_nodes = materialize(
            state.groupBy(*keys, F.col("label").alias("node")).agg(
                F.sum("k").alias("k"), F.first("resolution").alias("resolution"), F.first("two_m").alias("two_m")
            ),
            "level-nodes",
        )
        ends = state.select(*keys, "node", "label")
        level_links = materialize(
            level_links.join(ends.select(*keys, F.col("node").alias("src"), F.col("label").alias("_a")), [*keys, "src"])
            .join(ends.select(*keys, F.col("node").alias("dst"), F.col("label").alias("_b")), [*keys, "dst"])
            .where("_a <> _b")
            .groupBy(*keys, F.col("_a").alias("src"), F.col("_b").alias("dst"))
            .agg(F.sum("w").alias("w")),
            "level-links",
        )
    for turn in itertools.count():
        state = nodes.join(placed.select(*keys, "node", "label"), [*keys, "node"])
        state = materialize(_settle(links, state, keys, f"{seed}:nodes", 0, crowds=crowds, large=large), "refined")
        placed = state.select(*keys, "node", "label")
        inside = (
            links.join(placed.select(*keys, F.col("node").alias("src"), F.col("label").alias("_a")), [*keys, "src"])
            .join(placed.select(*keys, F.col("node").alias("dst"), F.col("label").alias("_b")), [*keys, "dst"])
            .where("_a = _b")
            .select(*keys, "src", "dst")
        )
        parts = connected_components(materialize(inside, "inside"), placed, keys)
        sizes = placed.groupBy(*keys, "label").agg(F.min("node").alias("_least"))
        named = placed.join(parts, [*keys, "node"]).join(sizes, [*keys, "label"])
        named, split = materialize_counting(named, "parts", F.expr("component <> _least"))
        placed = named.select(*keys, "node", F.col("component").alias("label"))
        if split:
            continue
        moved = 0
        if refined and (resolution is None or resolution > 0):  # at resolution 0 no part of a connected community gains by leaving
            state = state.drop("label").join(placed, [*keys, "node"])
            placed, moved = _move_parts(links, state, keys, f"{seed}:refine:{turn}", crowds, large)
        if not moved:
            return named.select(*keys, "node", F.col("component").alias("community"))


def _state_of(edges: DataFrame, placed: DataFrame, keys: list[str], resolution: float) -> tuple[DataFrame, DataFrame]:
    """Links in both directions and the state of a given partition."""
    flip = edges.select(*keys, F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
    links = edges.select(*keys, "src", "dst", "w").unionByName(flip)
    strengths = links.groupBy(*keys, F.col("src").alias("node")).agg(F.sum("w").alias("k"))
    totals = strengths.groupBy(*keys).agg(F.sum("k").alias("two_m"))
    state = strengths.join(totals, keys).join(placed.select(*keys, "node", F.col("community").alias("label")), [*keys, "node"])
    return links, state.withColumn("resolution", F.lit(float(resolution)))


def improving_moves(edges: DataFrame, placed: DataFrame, keys: list[str], resolution: float) -> DataFrame:
    """Nodes that would raise the quality by moving to a community next to them: ``(keys, node)``."""
    links, state = _state_of(edges, placed, keys, resolution)
    return _move_round(links, state, keys, "", False).where("improving").select(*keys, "node")


def improving_parts(edges: DataFrame, placed: DataFrame, keys: list[str], resolution: float, seed: int = DEFAULT_SEED) -> DataFrame:
    """Refined parts that would raise the quality next door or alone: ``(keys, node)``, named after a member."""
    links, state = _state_of(edges, placed, keys, resolution)
    parts = refine(links, state, keys, str(seed))
    moves = _move_round(_between(links, parts, keys), _part_state(parts, keys), keys, "", False, alone=True)
    return moves.where("improving").select(*keys, "node")


def quality(edges: DataFrame, placed: DataFrame, keys: list[str], resolution: float) -> DataFrame:
    """Q of a partition per key, from edge and strength sums."""
    at = placed.select(*keys, "node", "community")
    ends = edges.join(at.withColumnsRenamed({"node": "src", "community": "_a"}), [*keys, "src"]).join(
        at.withColumnsRenamed({"node": "dst", "community": "_b"}), [*keys, "dst"]
    )
    inner = ends.groupBy(*keys).agg(
        F.sum(F.when(F.col("_a") == F.col("_b"), F.col("w")).otherwise(0.0)).alias("inner_w"), F.sum("w").alias("m")
    )
    halves = ends.select(*keys, F.col("_a").alias("community"), "w").unionByName(
        ends.select(*keys, F.col("_b").alias("community"), "w")
    )
    squares = (
        halves.groupBy(*keys, "community").agg(F.sum("w").alias("k")).groupBy(*keys).agg(F.sum(F.col("k") * F.col("k")).alias("kk"))
    )
    two_m = 2 * F.col("m")
    return inner.join(squares, keys).select(
        *keys, (F.col("inner_w") / F.col("m") - resolution * F.col("kk") / (two_m * two_m)).alias("quality")
    )


def filter_communities(placed: DataFrame, keys: list[str], min_size="min_cluster_size") -> DataFrame:
    """Communities of enough members: ``(keys, community, size, cluster_no)``.

    They are numbered from 1 by their smallest member. ``min_size`` is a number
    or the name of a column of ``placed``.
    """
    floor = F.col(min_size) if isinstance(min_size, str) else F.lit(min_size)
    sized = placed.withColumn("_floor", floor).groupBy(*keys, "community").agg(
        F.count("*").alias("size"), F.min("node").alias("first_member"), F.first("_floor").alias("_floor")
    )
    kept = sized.where(F.col("size") >= F.col("_floor")).drop("_floor")
    return dense_index(kept, keys, "first_member", out="cluster_no", start=1)
