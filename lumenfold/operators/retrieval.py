"""Thematic questions (catalysts) and search through them, for tables of queries.

Definitions: relevance(q, c) is the cosine of query and catalyst; an entry
belongs to a catalyst if it mentions its entity, with association cos(c, d);
similarity(q, d) is the largest relevance · max(association, 0) over all
catalysts with positive relevance.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenfold.functions import vectors as vx
from lumenfold.operators.graph import DECIMALS, best_matches
from lumenfold.operators.labels import contrast_keywords
from lumenfold.schema import SCOPE
from lumenfold.session import kept_apart, materialize

ENTITY = [*SCOPE, "entity_type", "entity"]
QUERY = [*SCOPE, "query_id"]
#: What a vector of usual length takes as a row.
VECTOR_BYTES = 2048

# How a catalyst question opens for each profile.
PROFILE_LEADS = {
    "preference_evidence": "Which preferences show",
    "tension_trace": "Which tensions show",
    "resonance_trace": "What resonates",
    "relational": "Who and what is connected",
    "operational": "How things get done",
    "decision_trace": "Which decisions show",
    "reflective": "What is reflected on",
}


@dataclass
class SearchResult:
    results: DataFrame
    catalysts: DataFrame
    totals: DataFrame


def build_catalysts(
    entries: DataFrame,
    mentions: DataFrame,
    vectors: DataFrame,
    profiles: DataFrame | None = None,
    text: Column | None = None,
) -> DataFrame:
    """One catalyst per entity: question text, centroid vector of its entries, entry count.

    The question names the entity and the words that set its entries apart. A
    user's own ``text`` expression (over ``entity_type, entity, keywords,
    profile``) replaces it. Hot entities cost one vector per map task.
    """
    placed = mentions.join(kept_apart(vectors.select(*SCOPE, "entry_id", "vector"), VECTOR_BYTES), [*SCOPE, "entry_id"])
    summed = placed.groupBy(*ENTITY).agg(F.count("*").alias("size"), vx.vector_sum(F.col("vector")).alias("total"))
    sums = materialize(summed, "entity-sums")
    indexed = entries.select(*SCOPE, "entry_id", "entry_index")
    members = mentions.join(indexed, [*SCOPE, "entry_id"]).select(*ENTITY, "entry_index")
    words = contrast_keywords(entries, members, sums.select(*ENTITY, "size"), ENTITY)
    named = sums.join(words, ENTITY, "left")
    if profiles is not None:
        folder = profiles.select(F.lit("folder").alias("entity_type"), F.col("collection_id").alias("entity"), "profile")
        named = named.join(folder, ["entity_type", "entity"], "left")
    else:
        named = named.withColumn("profile", F.lit(None).cast("string"))
    lead = F.lit("What recurs")
    for profile, opening in PROFILE_LEADS.items():
        lead = F.when(F.col("profile") == profile, opening).otherwise(lead)
    about = F.when(F.size("keywords") > 0, F.concat(F.lit(" around "), F.array_join("keywords", ", "))).otherwise("")
    question = F.concat(lead, F.lit(" in "), "entity", about, F.lit("?"))
    return named.select(
        *SCOPE,
        F.concat_ws(":", "entity_type", "entity").alias("catalyst_id"),
        "entity_type",
        "entity",
        "profile",
        (question if text is None else text).alias("text"),
        F.col("size").alias("entries"),
        vx.unit_vector("total").alias("vector"),
    )


def catalyst_documents(catalysts: DataFrame, mentions: DataFrame, vectors: DataFrame) -> DataFrame:
    """``(scope, catalyst_id, entry_id, entry_index, assoc)``: the entries of each catalyst."""
    given = vectors.select(*SCOPE, "entry_id", "entry_index", "vector")
    placed = mentions.join(kept_apart(given, VECTOR_BYTES), [*SCOPE, "entry_id"])
    own = kept_apart(catalysts.select(*ENTITY, "catalyst_id", F.col("vector").alias("_catalyst")), VECTOR_BYTES)
    return placed.join(own, ENTITY).select(
        *SCOPE,
        "catalyst_id",
        "entry_id",
        "entry_index",
        (F.round(vx.row_dot("_catalyst", "vector"), DECIMALS) + F.lit(0.0)).alias("assoc"),
    )


def relevant_catalysts(queries: DataFrame, catalysts: DataFrame) -> DataFrame:
    """``(query, catalyst_id, relevance)``: the catalysts with positive relevance."""
    found = best_matches(
        queries.select(*SCOPE, F.col("query_id").alias("left_id"), "vector"),
        catalysts.select(*SCOPE, F.col("catalyst_id").alias("right_id"), "vector"),
        None,
        0.0,
        above=True,
    )
    return found.select(*SCOPE, F.col("left_id").alias("query_id"), F.col("right_id").alias("catalyst_id"), F.col("sim").alias("relevance"))


def reached_totals(kept: DataFrame, documents: DataFrame) -> DataFrame:
    """Distinct entries the kept catalysts of each query reach, before any limit.

    Catalysts carry bitmaps of entry numbers, so a query combines bitmaps
    instead of every (query, entry) pair.
    """
    bits = documents.groupBy(*SCOPE, "catalyst_id", F.bitmap_bucket_number("entry_index").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("entry_index")).alias("_bits")
    )
    return (
        kept.join(bits, [*SCOPE, "catalyst_id"])
        .groupBy(*QUERY, "_bucket")
        .agg(F.bitmap_count(F.bitmap_or_agg("_bits")).alias("_n"))
        .groupBy(*QUERY)
        .agg(F.sum("_n").alias("total_results"))
    )


def catalyze(
    queries: DataFrame,
    catalysts: DataFrame,
    documents: DataFrame,
    *,
    limit: int = 10,
    register: str = "explore",
) -> SearchResult:
    """Route each query through its catalysts to whole entries.

    ``queries`` is ``(scope, query_id, vector)``. Results: ``(query, rank,
    entry_id, similarity)``, similarity descending, each entry once. An entry
    beyond a catalyst's own first ``limit`` cannot be among the query's first
    ``limit``, so each catalyst sends only those; the totals still count all.
    ``register`` is carried through unchanged.
    """
    if not 1 <= limit <= 100:
        raise ValueError("limit must be between 1 and 100")
    kept = relevant_catalysts(queries, catalysts)
    share = F.greatest(F.col("assoc"), F.lit(0.0))
    by_share = Window.partitionBy(*SCOPE, "catalyst_id").orderBy(F.desc("share"), "entry_id")
    front = (
        documents.withColumn("share", share)
        .withColumn("_rank", F.row_number().over(by_share))
        .where(F.col("_rank") <= limit)
        .select(*SCOPE, "catalyst_id", "entry_id", "share")
    )
    reached = (
        kept.join(front, [*SCOPE, "catalyst_id"])
        .groupBy(*QUERY, "entry_id")
        .agg(F.max(F.col("relevance") * F.col("share")).alias("similarity"))
    )
    order = Window.partitionBy(*QUERY).orderBy(F.desc("similarity"), "entry_id")
    results = (
        reached.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= limit)
        .withColumn("register", F.lit(register))
    )
    routed = (
        results.select(*QUERY, "entry_id")
        .join(documents.select(*SCOPE, "entry_id", "catalyst_id"), [*SCOPE, "entry_id"])
        .groupBy(*QUERY, "catalyst_id")
        .agg(F.count("*").alias("contribution_count"))
    )
    contributing = (
        kept.join(routed, [*QUERY, "catalyst_id"], "left")
        .join(catalysts.drop("vector"), [*SCOPE, "catalyst_id"])
        .withColumn("contribution_count", F.coalesce("contribution_count", F.lit(0).cast("long")))
    )
    return SearchResult(results, contributing, reached_totals(kept, documents))


def catalyze_by_catalyst(found: SearchResult, documents: DataFrame, entries: DataFrame) -> DataFrame:
    """Published shape: per query and catalyst the result entries it routed, best first."""
    titles = entries.select(*SCOPE, "entry_id", "title")
    routed = (
        found.results.join(documents.select(*SCOPE, "entry_id", "catalyst_id"), [*SCOPE, "entry_id"])
        .join(found.catalysts.select(*QUERY, "catalyst_id", "entity", "text"), [*QUERY, "catalyst_id"])
        .join(titles, [*SCOPE, "entry_id"], "left")
    )
    one = F.struct("rank", "entry_id", "title", "similarity")
    return routed.groupBy(*QUERY, "catalyst_id", "entity", "text").agg(
        F.transform(
            F.array_sort(F.collect_list(one)), lambda d: F.struct(d["entry_id"].alias("entry_id"), d["title"].alias("title"), d["similarity"].alias("similarity"))
        ).alias("documents")
    )


def scope_search(
    queries: DataFrame, catalysts: DataFrame, documents: DataFrame, entries: DataFrame, *, limit: int = 10, register: str = "explore"
) -> tuple[DataFrame, SearchResult]:
    """One search over all collections of a user.

    Catalysts and their entries may come per collection (``collection_id``);
    they are searched together, each once, and the collection is not shown. Result rows are
    what an app needs to show the item: primitive, source id, title, snippet,
    URL, time, metadata, similarity.
    """
    together = catalysts.drop("collection_id").dropDuplicates([*SCOPE, "catalyst_id"])
    reached = documents.drop("collection_id").dropDuplicates([*SCOPE, "catalyst_id", "entry_id"])
    found = catalyze(queries, together, reached, limit=limit, register=register)
    get = lambda name: F.col(name) if name in entries.columns else F.lit(None).cast("string")
    shown = entries.select(
        *SCOPE,
        "entry_id",
        F.coalesce(get("primitive"), F.lit("")).alias("primitive"),
        F.coalesce(get("source_id"), F.lit("")).alias("source_id"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce(get("snippet"), get("content"), F.lit("")).alias("snippet"),
        get("app_url").alias("app_url"),
        "created_at",
        F.coalesce(get("metadata"), F.lit("{}")).alias("metadata"),
    )
    rows = found.results.join(shown, [*SCOPE, "entry_id"]).drop("entry_id")
    return rows, found


def search_routes(found: SearchResult, documents: DataFrame, generations: DataFrame) -> DataFrame:
    """Debug view: which catalyst of which collection led to each result, with the collection's generation."""
    return (
        found.results.select(*QUERY, "entry_id", "rank")
        .join(documents.select(*SCOPE, "collection_id", "catalyst_id", "entry_id"), [*SCOPE, "entry_id"])
        .join(found.catalysts.select(*QUERY, "catalyst_id", "relevance"), [*QUERY, "catalyst_id"])
        .join(generations, [*SCOPE, "collection_id"], "left")
    )


def normalize_catalysts(raw: Column) -> Column:
    """JSON list mixing bare strings and objects → array of objects with a ``text`` field, as JSON."""
    items = F.from_json(raw, "array<variant>")
    wrapped = lambda v: F.to_json(F.struct(F.variant_get(v, "$", "string").alias("text")))
    return F.transform(items, lambda v: F.when(F.schema_of_variant(v) == "STRING", wrapped(v)).otherwise(F.to_json(v)))
