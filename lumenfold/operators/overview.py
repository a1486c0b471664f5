"""Which entities are active, how often and how recently; index health; text blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenfold.functions import text as tx
from lumenfold.operators.entities import scope_counts
from lumenfold.operators.graph import best_matches
from lumenfold.operators.retrieval import ENTITY, QUERY
from lumenfold.schema import SCOPE


def entity_activity(mentions: DataFrame, entries: DataFrame, as_of: str) -> DataFrame:
    """Per entity: frequency, last 12 months, last seen, recency score, trend.

    ``mentions`` holds each (entry, entity) once. One join by entry and one
    aggregate that map tasks combine.
    """
    now = F.lit(as_of).cast("timestamp")
    seen = mentions.join(entries.select(*SCOPE, "entry_id", "created_at"), [*SCOPE, "entry_id"])
    at = F.col("created_at")
    recent = at > now - F.expr("interval 30 days")
    before = (at > now - F.expr("interval 60 days")) & ~recent
    stats = seen.groupBy(*ENTITY).agg(
        F.count("*").alias("frequency"),
        F.sum((at > F.add_months(now, -12).cast("timestamp")).cast("long")).alias("frequency_12m"),
        F.max(at).alias("last_seen"),
        F.sum(recent.cast("long")).alias("recent"),
        F.sum(before.cast("long")).alias("previous"),
    )
    days = F.datediff(now, "last_seen")
    trend = (
        F.when(F.col("recent") > 1.2 * F.col("previous"), "rising")
        .when(F.col("recent") < 0.8 * F.col("previous"), "declining")
        .otherwise("stable")
    )
    return stats.select(
        *ENTITY,
        "frequency",
        F.coalesce("frequency_12m", F.lit(0)).alias("frequency_12m"),
        "last_seen",
        days.cast("long").alias("days_since_last_seen"),
        F.round(F.pow(F.lit(2.0), -days / 90.0), 9).alias("recency_score"),
        trend.alias("activity_trend"),
    )


def _with_catalysts(top: DataFrame, catalysts: DataFrame) -> DataFrame:
    """Add the catalyst texts of the entities shown (joined after the limit)."""
    texts = (
        catalysts.join(top.select(*ENTITY).distinct(), ENTITY, "left_semi")
        .groupBy(*ENTITY)
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("catalyst_id", "text"))), lambda c: c["text"]).alias("catalysts"))
    )
    return top.join(texts, ENTITY, "left").withColumn(
        "catalysts", F.coalesce("catalysts", F.array().cast("array<string>"))
    )


def entity_overview(
    mentions: DataFrame, entries: DataFrame, catalysts: DataFrame, as_of: str, top: int = 10
) -> DataFrame:
    """The ``top`` entities per scope by recency · ln(1 + frequency), with their catalysts and the entity total."""
    stats = entity_activity(mentions, entries, as_of)
    weight = F.round(F.col("recency_score") * F.log1p("frequency"), 9)
    order = Window.partitionBy(*SCOPE).orderBy(F.desc("_weight"), "entity", "entity_type")
    ranked = (
        stats.withColumn("_weight", weight).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).drop("_weight")
    )
    totals = stats.groupBy(*SCOPE).agg(F.count("*").alias("total_entities"))
    return _with_catalysts(ranked, catalysts).join(totals, SCOPE)


def entity_overview_by_query(
    queries: DataFrame, mentions: DataFrame, entries: DataFrame, catalysts: DataFrame, as_of: str, top: int = 10
) -> DataFrame:
    """Entities by the best cosine of their catalysts to each query.

    The catalysts of an entity share a block of the search, which keeps the best of them, so the cut to ``top`` is
    made on entities; equal ones are put in the order of their names.
    """
    place = F.concat_ws("\x01", "entity", "entity_type")
    found = best_matches(
        queries.select(*SCOPE, F.col("query_id").alias("left_id"), "vector"),
        catalysts.select(*SCOPE, place.alias("right_id"), "vector"),
        top,
    )
    relevance = (
        found.select(*SCOPE, F.col("left_id").alias("query_id"), F.col("right_id").alias("_place"), F.col("sim").alias("relevance"))
        .join(catalysts.select(*ENTITY, place.alias("_place")).distinct(), [*SCOPE, "_place"])
        .drop("_place")
    )
    order = Window.partitionBy(*QUERY).orderBy(F.desc("relevance"), "entity", "entity_type")
    ranked = relevance.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    stats = entity_activity(mentions, entries, as_of)
    return _with_catalysts(ranked.join(stats, ENTITY), catalysts)


def index_status(entries: DataFrame, vectors: DataFrame, mentions: DataFrame, catalysts: DataFrame) -> DataFrame:
    """Per scope: documents, embedded ``done/total``, entities, catalysts, model."""
    count = lambda df, name: df.groupBy(*SCOPE).agg(F.count("*").alias(name))
    docs = count(entries, "documents")
    done = vectors.where("vector is not null").groupBy(*SCOPE).agg(
        F.count("*").alias("_done"), F.max("model").alias("model")
    )
    entities = count(mentions.select(*ENTITY).distinct(), "entities")
    joined = docs.join(done, SCOPE, "left").join(entities, SCOPE, "left").join(count(catalysts, "catalysts"), SCOPE, "left")
    zero = lambda name: F.coalesce(name, F.lit(0).cast("long"))
    return joined.select(
        *SCOPE,
        "documents",
        F.concat_ws("/", zero("_done"), "documents").alias("embedded"),
        zero("entities").alias("entities"),
        zero("catalysts").alias("catalysts"),
        F.coalesce("model", F.lit("")).alias("model"),
    )


def scope_fingerprint(generations: DataFrame) -> DataFrame:
    """SHA-256 over the sorted ``collection:generation`` list of each scope (collections are few)."""
    pair = F.concat_ws(":", "collection_id", "index_generation")
    return generations.groupBy(*SCOPE).agg(
        F.sha2(F.array_join(F.array_sort(F.collect_list(pair)), "\n"), 256).alias("scope_fingerprint")
    )


def scope_status(
    entries: DataFrame, mentions: DataFrame, catalysts: DataFrame, vectors: DataFrame, generations: DataFrame
) -> DataFrame:
    """Counts per collection and in total (null collection), with generation and scope fingerprint."""
    counts = scope_counts(entries, mentions, catalysts, vectors)
    return counts.join(generations, [*SCOPE, "collection_id"], "left").join(scope_fingerprint(generations), SCOPE, "left")


def _block(lines: Column) -> Column:
    return F.array_join(lines, "\n")


def render_search_context(
    queries: DataFrame, results: DataFrame, catalysts: DataFrame, max_chars: int = 2000
) -> DataFrame:
    """One text block per query: its routing signals and its documents.

    ``queries`` is ``(query, query)``; ``results`` ``(query, rank, name, content,
    similarity)``; ``catalysts`` ``(query, entity, text, relevance,
    contribution_count, guidance)``. Both are limited per query before.
    """
    guidance = F.coalesce(F.array_join("guidance", "; "), F.lit(""))
    signal = F.format_string(
        "- **%s**: %s (relevance: %s, routed %d results%s)",
        "entity", "text", tx.fixed(F.col("relevance"), 2), "contribution_count",
        F.when(guidance != "", F.concat(F.lit(" — "), guidance)).otherwise(""),
    )
    order = F.struct(-F.col("relevance"), F.col("catalyst_id"), signal.alias("line"))
    signals = catalysts.groupBy(*QUERY).agg(
        F.transform(F.array_sort(F.collect_list(order)), lambda s: s["line"]).alias("_signals")
    )
    shown = F.when(
        F.length("content") > max_chars, F.concat(F.substring("content", 1, max_chars), F.lit("\n[...truncated]"))
    ).otherwise(F.col("content"))
    head = F.format_string("#### %d. %s (similarity: %s)", "rank", "name", tx.fixed(F.col("similarity"), 3))
    document = F.struct("rank", F.concat_ws("\n", head, shown, F.lit("")).alias("line"))
    documents = results.groupBy(*QUERY).agg(
        F.transform(F.array_sort(F.collect_list(document)), lambda d: d["line"]).alias("_documents")
    )
    none = F.array().cast("array<string>")
    section = lambda title, lines, end: F.when(
        lines.isNotNull(), F.concat(F.array(F.lit(title)), lines, end)
    ).otherwise(none)
    lines = F.concat(
        F.array(F.concat(F.lit('## Search: "'), F.col("query"), F.lit('"')), F.lit("")),
        section("### Routing signals (catalysts that matched)", F.col("_signals"), F.array(F.lit(""))),
        section("### Matched documents", F.col("_documents"), none),
    )
    joined = queries.join(signals, QUERY, "left").join(documents, QUERY, "left")
    return joined.select(*QUERY, _block(lines).alias("context"))


def render_overview_context(overview: DataFrame, max_catalysts: int = 5) -> DataFrame:
    """One text block per scope from its overview rows (at most ``top`` per scope)."""
    days = F.col("days_since_last_seen")
    fresh = F.when(days > 0, F.format_string("last seen: %dd ago", days)).otherwise("active today")
    head = F.format_string(
        "### %s: %s (%d occurrences, %s, recency: %s, %s)",
        "entity_type", "entity", "frequency", "activity_trend", tx.fixed(F.col("recency_score"), 1), fresh,
    )
    shown = F.filter(F.slice("catalysts", 1, max_catalysts), lambda t: t != "")
    lines = F.concat(F.array(head), F.transform(shown, lambda t: F.concat(F.lit("  - "), t)), F.array(F.lit("")))
    blocks = overview.groupBy(*SCOPE, "total_entities").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", _block(lines).alias("block")))), lambda b: b["block"]).alias("_blocks")
    )
    opening = F.array(
        F.lit("## Context: what this user's entries reveal"),
        F.lit(""),
        F.format_string("Tracking %d entities across the corpus.", "total_entities"),
        F.lit(""),
    )
    return blocks.select(*SCOPE, _block(F.concat(opening, "_blocks")).alias("context"))
