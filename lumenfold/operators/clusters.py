"""Building a cluster index per scope and tagging entries with it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenfold.functions import text as tx
from lumenfold.functions import vectors as vx
from lumenfold.operators import communities as cm
from lumenfold.operators import graph, labels, sweep
from lumenfold.operators.embed import embed_entries, rarity_of, require_vectors, slot_counts, weighed
from lumenfold.operators.shape import all_text, normalize_entries, resolve_entry_id, with_builder_text
from lumenfold.schema import (
    DEFAULT_ID_PREFIX,
    DEFAULT_K,
    DEFAULT_MIN_CLUSTER_SIZE,
    DEFAULT_RESOLUTION,
    DEFAULT_SEED,
    DEFAULT_THRESHOLD,
    SCOPE,
)
from lumenfold.session import materialize

CLUSTER = labels.CLUSTER
REPRESENTATIVES = 5


@dataclass
class ClusterIndex:
    """``header``: one row per scope (model, dimension, id_prefix,
    assignment_min_similarity); ``clusters``: one row per cluster; ``rarity``:
    the word weights per scope when the built-in vectoriser was used."""

    header: DataFrame
    clusters: DataFrame
    rarity: DataFrame | None = None


@dataclass
class Assigned:
    entries: DataFrame
    assignments: DataFrame
    clusters: DataFrame


def cluster_centroids(members: DataFrame, vectors: DataFrame) -> DataFrame:
    """``(cluster, size, centroid, cohesion)`` from one aggregate over the members.

    The centroid is the normalised mean; a zero mean stays zero. Cohesion is the
    mean pairwise cosine, which the sums give without forming a pair.
    """
    sums = sweep.cluster_sums(
        members.select(*CLUSTER, F.col("entry_index").alias("node"), F.col("cluster_no").alias("community")),
        vectors,
        CLUSTER,
    )
    return sums.select(
        *CLUSTER, "size", vx.unit_vector("total").alias("centroid"), sweep.pair_mean().alias("cohesion")
    )


def rank_members(members: DataFrame, vectors: DataFrame, centroids: DataFrame) -> DataFrame:
    """Members with the cosine to their cluster's centroid (``similarity``)."""
    placed = members.select(*CLUSTER, "entry_index").join(
        vectors.select(*SCOPE, "entry_index", "vector"), [*SCOPE, "entry_index"]
    )
    return placed.join(centroids.select(*CLUSTER, "centroid"), CLUSTER).select(
        *CLUSTER, "entry_index", F.round(vx.row_dot("vector", "centroid"), graph.DECIMALS).alias("similarity")
    )


def cluster_representatives(entries: DataFrame, ranked: DataFrame) -> DataFrame:
    """``(cluster, representatives)``: the five most central members, best first.

    Members are cut to five before their text is joined.
    """
    order = Window.partitionBy(*CLUSTER).orderBy(F.desc("similarity"), "entry_index")
    top = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= REPRESENTATIVES)
    portable = tx.present(F.col("portable_id"))
    title = tx.present(F.col("title")) if "title" in entries.columns else F.lit(None).cast("string")
    texts = entries.select(
        *SCOPE,
        "entry_index",
        F.coalesce(title, portable, F.lit("Untitled")).alias("title"),
        tx.shorten(all_text(entries)).alias("text"),
        portable.alias("entry_id"),
    )
    shown = top.join(texts, [*SCOPE, "entry_index"])
    one = F.struct("rank", F.struct("title", "text", "similarity", "entry_id").alias("rep"))
    return shown.groupBy(*CLUSTER).agg(
        F.transform(F.array_sort(F.collect_list(one)), lambda r: r["rep"]).alias("representatives")
    )


def describe_clusters(entries: DataFrame, vectors: DataFrame, members: DataFrame, prefix: str) -> DataFrame:
    """Full cluster rows for a given membership ``(cluster, entry_index)``."""
    centroids = materialize(cluster_centroids(members, vectors), "centroids")
    ranked = materialize(rank_members(members, vectors, centroids), "ranked-members")
    named = labels.cluster_ids(labels.cluster_keywords(entries, ranked, centroids), prefix)
    reps = cluster_representatives(entries, ranked)
    return (
        centroids.join(named.drop("size"), CLUSTER)
        .join(reps, CLUSTER)
        .select(
            *CLUSTER,
            "cluster_id",
            F.col("centroid").alias("embedding"),
            "keywords",
            "size",
            F.col("cohesion"),
            F.col("representatives")[0].alias("medoid"),
            "representatives",
        )
    )


def _prepare(entries: DataFrame) -> DataFrame:
    entries = normalize_entries(entries)
    return entries if "entry_index" in entries.columns else resolve_entry_id(entries)


def build_cluster_index(
    entries: DataFrame,
    *,
    text: Column | None = None,
    vectors: DataFrame | None = None,
    vectorizer=None,
    id_prefix: str = DEFAULT_ID_PREFIX,
    granularity: str = "balanced",
    k: int | None = None,
    min_similarity: float | None = None,
    min_cluster_size: int | None = None,
    resolution: float | None = None,
    seed: int = DEFAULT_SEED,
) -> ClusterIndex:
    """Cluster every scope of ``entries`` in one go.

    Without low-level settings each scope picks its own from a scored sweep.
    Vectors are computed once and stored; the neighbour graph is built once at
    the loosest threshold, and each setting filters it.
    """
    entries = with_builder_text(_prepare(entries), text)
    if vectors is not None:
        require_vectors(entries, vectors)
    builtin = vectors is None and vectorizer is None
    rarity, keep = None, ["entry_id", "entry_index"]
    if builtin:
        counts = materialize(slot_counts(entries, keep=keep), "slot-counts")
        rarity = materialize(rarity_of(counts), "slot-rarity")
        embedded = weighed(counts, rarity)
    else:
        embedded = embed_entries(entries, vectors=vectors, vectorizer=vectorizer, keep=keep)
    stored = materialize(embedded, "entry-vectors")
    sizes = stored.groupBy(*SCOPE).agg(
        F.count("*").alias("n"), F.max("model").alias("model"), F.max(F.size("vector")).alias("dimension")
    )
    fixed = any(v is not None for v in (k, min_similarity, min_cluster_size, resolution))
    if fixed:
        candidates = sizes.select(
            *SCOPE,
            "n",
            F.lit(k or DEFAULT_K).alias("k"),
            F.lit(min_cluster_size or DEFAULT_MIN_CLUSTER_SIZE).alias("min_cluster_size"),
            F.lit(0).alias("candidate_id"),
            F.lit(float(DEFAULT_RESOLUTION if resolution is None else resolution)).alias("resolution"),
            F.lit(float(DEFAULT_THRESHOLD if min_similarity is None else min_similarity)).alias("min_similarity"),
        )
        neighbours = k or DEFAULT_K
    else:
        candidates = sweep.param_candidates(sizes, granularity)
        neighbours = sweep.default_k(F.col("_n"))
    candidates = materialize(candidates, "candidates")
    loosest = candidates.agg(F.min("min_similarity")).first()[0]
    if loosest is None:
        loosest = DEFAULT_THRESHOLD

    knn = graph.knn_topk(stored, neighbours, loosest)
    edges = materialize(graph.mutual_edges(knn, loosest), "edges")
    setting = candidates.select(*SCOPE, "candidate_id", "resolution", "min_similarity")
    swept = edges.join(setting, SCOPE).where(F.col("w") >= F.col("min_similarity")).drop("min_similarity")
    same = float(DEFAULT_RESOLUTION if resolution is None else resolution) if fixed else None
    placed = cm.detect_communities(swept.drop("resolution") if fixed else swept, sweep.CANDIDATE, resolution=same, seed=seed)
    floors = candidates.select(*sweep.CANDIDATE, "min_cluster_size")
    if fixed and (min_cluster_size or DEFAULT_MIN_CLUSTER_SIZE) <= 1:
        placed = _with_singletons(placed, stored, floors)
    placed = placed.join(floors, sweep.CANDIDATE)
    kept = materialize(cm.filter_communities(placed, sweep.CANDIDATE), "communities")
    members = placed.select(*sweep.CANDIDATE, "node", "community").join(
        kept.select(*sweep.CANDIDATE, "community", "cluster_no"), [*sweep.CANDIDATE, "community"]
    )
    if fixed:
        chosen = candidates
    else:
        chosen = materialize(
            sweep.select_params(sweep.score_communities(candidates, kept, members, stored, granularity)), "chosen"
        )
    final = materialize(
        members.join(chosen.select(*sweep.CANDIDATE), sweep.CANDIDATE, "left_semi").select(
            *CLUSTER, F.col("node").alias("entry_index")
        ),
        "members",
    )
    header = chosen.join(sizes.drop("n"), SCOPE).select(
        *SCOPE,
        F.coalesce("model", F.lit("")).alias("model"),
        F.col("dimension").cast("int").alias("dimension"),
        F.lit(id_prefix).alias("id_prefix"),
        F.col("min_similarity").alias("assignment_min_similarity"),
    )
    clusters = materialize(describe_clusters(entries, stored, final, id_prefix), "clusters")
    return ClusterIndex(header, clusters, rarity)


def _with_singletons(placed: DataFrame, stored: DataFrame, floors: DataFrame) -> DataFrame:
    """Entries without an edge as communities of one (only a minimum size of 1 can keep them)."""
    nodes = stored.select(*SCOPE, F.col("entry_index").alias("node")).join(floors.drop("min_cluster_size"), SCOPE)
    alone = nodes.join(placed, [*sweep.CANDIDATE, "node"], "left_anti")
    return placed.unionByName(alone.select(*sweep.CANDIDATE, "node", F.col("node").alias("community")))


def assign_clusters(
    vectors: DataFrame,
    index: ClusterIndex,
    *,
    min_similarity: float | None = None,
    max_clusters_per_entry: int = 1,
) -> DataFrame:
    """``(scope, entry_index, entry_id, cluster_id, similarity, rank)`` at or above the threshold.

    ``vectors`` is ``(scope, entry_index, entry_id, vector)``. The threshold is
    the scope's stored one unless given.
    """
    if max_clusters_per_entry < 1:
        raise ValueError("max_clusters_per_entry must be at least 1")
    floor = F.col("assignment_min_similarity") if min_similarity is None else F.lit(float(min_similarity))
    left = vectors.join(index.header.select(*SCOPE, "assignment_min_similarity"), SCOPE).select(
        *SCOPE, F.col("entry_index").alias("left_id"), vx.unit_vector("vector").alias("vector"), floor.alias("threshold")
    )
    right = index.clusters.select(
        *SCOPE, F.col("cluster_id").alias("right_id"), vx.unit_vector("embedding").alias("vector")
    )
    found = graph.best_matches(left, right, max_clusters_per_entry)
    return found.withColumnsRenamed({"left_id": "entry_index", "right_id": "cluster_id", "sim": "similarity"}).join(
        vectors.select(*SCOPE, "entry_index", "entry_id"), [*SCOPE, "entry_index"]
    )


def append_tags(entries: DataFrame, assignments: DataFrame, target_field: str = "tags") -> DataFrame:
    """Add cluster ids to ``target_field`` unless already there; unassigned rows keep theirs.

    A scalar field becomes an array. Rows without an assignment keep null, so an
    absent field stays absent.
    """
    if not target_field:
        raise ValueError("target_field must not be empty")
    kinds = dict(entries.dtypes)
    if target_field not in kinds:
        own = F.lit(None).cast("array<string>")
    elif kinds[target_field].startswith("array"):
        own = F.col(target_field)
    else:
        own = F.when(F.col(target_field).isNotNull(), F.array(F.col(target_field).cast("string")))
    new = assignments.groupBy(*SCOPE, "entry_index").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "cluster_id"))), lambda a: a["cluster_id"]).alias("_new")
    )
    tagged = entries.join(new, [*SCOPE, "entry_index"], "left")
    grown = F.when(own.isNull(), F.col("_new")).otherwise(F.concat(own, F.array_except("_new", own)))
    return tagged.withColumn(target_field, F.when(F.col("_new").isNull(), own).otherwise(grown)).drop("_new")


def assign_entries(
    entries: DataFrame,
    index: ClusterIndex,
    *,
    text: Column | None = None,
    vectors: DataFrame | None = None,
    vectorizer=None,
    min_similarity: float | None = None,
    max_clusters_per_entry: int = 1,
    target_field: str = "tags",
) -> Assigned:
    """Tag entries against a stored index.

    A custom text is embedded as it is here, while the build embeds the usual
    fields next to it. The built-in vectoriser uses the word weights stored with
    the index.
    """
    entries = _prepare(entries)
    if vectors is not None:
        require_vectors(entries, vectors)
    keep = ["entry_id", "entry_index"]
    embedded = embed_entries(
        entries, text=text, vectors=vectors, vectorizer=vectorizer, rarity=index.rarity, keep=keep
    )
    assignments = assign_clusters(
        embedded, index, min_similarity=min_similarity, max_clusters_per_entry=max_clusters_per_entry
    )
    return Assigned(append_tags(entries, assignments, target_field), assignments, index.clusters)


def text_entries(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Single-text variant: rows of (body, optional title, optional metadata) as entries with ``text``."""
    return bodies.withColumnRenamed(body, "text")


def cluster_entries(entries: DataFrame, *, target_field: str = "tags", tag_prefix: str | None = None, **kw) -> Assigned:
    """Build an index from the entries and tag the same entries with it."""
    if tag_prefix is not None:
        kw.setdefault("id_prefix", tag_prefix)
    entries = _prepare(entries)
    index = build_cluster_index(entries, **kw)
    same = {name: kw.get(name) for name in ("text", "vectors", "vectorizer")}
    return assign_entries(entries, index, target_field=target_field, **same)
