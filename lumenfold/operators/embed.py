"""Entries to unit vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfold.functions import vectors as vx
from lumenfold.operators.shape import embedding_text, resolve_entry_id
from lumenfold.schema import SCOPE
from lumenfold.session import kept_apart, materialize


def slot_counts(entries: DataFrame, text: Column | None = None, dim: int = 512, keep: list[str] | None = None) -> DataFrame:
    """``(scope, keep…, slots, hits)``: the hash slots that the words of an entry hit, and how often.

    Texts are split into words here and nowhere else; weights and vectors follow from these short lists.
    """
    value = embedding_text(entries) if text is None else text
    counted = entries.select(*SCOPE, *(keep or ["entry_id", "seq"]), vx.word_slots(dim)(value).alias("_counts"))
    return counted.select("*", "_counts.slots", "_counts.hits").drop("_counts")


def rarity_of(counts: DataFrame, dim: int = 512) -> DataFrame:
    """Per scope: entry count and, for each hash slot, the entries whose text hits it.

    Both are counts combined on the map side; ``dim`` numbers per scope remain.
    """
    hit = counts.select(*SCOPE, F.explode("slots").alias("slot")).groupBy(*SCOPE, "slot").agg(F.count("*").alias("n"))
    listed = hit.groupBy(*SCOPE).agg(F.collect_list("slot").alias("_slots"), F.collect_list("n").alias("_ns"))
    sizes = counts.groupBy(*SCOPE).agg(F.count("*").alias("_entries"))
    found = sizes.join(listed, SCOPE, "left")
    return found.select(*SCOPE, "_entries", vx.spread(dim)("_slots", "_ns").alias("_containing"))


def slot_rarity(entries: DataFrame, text: Column | None = None, dim: int = 512) -> DataFrame:
    """``rarity_of`` the words of ``entries``."""
    return rarity_of(slot_counts(entries, text, dim, keep=[]), dim)


def weighed(counts: DataFrame, rarity: DataFrame, dim: int = 512) -> DataFrame:
    """``slot_counts`` with, in place of the lists, the model and the unit vector of their weights."""
    kept = [c for c in counts.columns if c not in ("slots", "hits")]
    model = F.lit(f"hashed-words-{dim}").alias("model")
    vector = vx.weigh_slots("slots", "hits", "_entries", "_containing").alias("vector")
    return counts.join(kept_apart(rarity, 8 * dim), SCOPE).select(*kept, model, vector)


def embed_entries(
    entries: DataFrame,
    *,
    text: Column | None = None,
    vectors: DataFrame | None = None,
    vectorizer=None,
    rarity: DataFrame | None = None,
    dim: int = 512,
    keep: list[str] | None = None,
) -> DataFrame:
    """One unit vector per entry: ``(scope, keep…, model, vector)``.

    * ``vectors``: a supplied table keyed by scope and ``entry_id``;
    * ``vectorizer``: a user's Arrow or pandas UDF over the embedding text;
    * otherwise hashed words weighted by how rare they are in the scope.
      ``rarity`` brings the weights of an existing index (for queries and new
      entries); without it the word counts are stored once and give them.
    """
    keep = keep or ["entry_id", "seq"]
    value = embedding_text(entries) if text is None else text
    if vectors is not None:
        joined = entries.select(*SCOPE, *keep).join(vectors, [*SCOPE, "entry_id"], "left")
        return joined.withColumn("vector", vx.unit_vector("vector"))
    if vectorizer is not None:
        made = entries.select(*SCOPE, *keep, F.lit("custom").alias("model"), vectorizer(value).alias("vector"))
        return made.withColumn("vector", vx.unit_vector("vector"))
    counts = slot_counts(entries, value, dim, keep)
    if rarity is None:
        counts = materialize(counts, "slot-counts")
        rarity = materialize(rarity_of(counts, dim), "rarity")
    return weighed(counts, rarity, dim)


def check_vectors(entries: DataFrame, vectors: DataFrame) -> DataFrame:
    """Per scope of the entries: how many vectors are expected and there, their shortest and longest length.

    A vector counts for the entry it belongs to; ``orphans`` are those of no entry.
    """
    ids = [*SCOPE, "entry_id"]
    entries = entries if "entry_id" in entries.columns else resolve_entry_id(entries)
    given = vectors.groupBy(*ids).agg(
        F.count("vector").alias("_there"), F.min(F.size("vector")).alias("_short"), F.max(F.size("vector")).alias("_long")
    )
    wanted = entries.select(*ids).withColumn("_wanted", F.lit(True))
    joined = wanted.join(given, ids, "full_outer").groupBy(*SCOPE).agg(
        F.count("_wanted").alias("expected"),
        F.count(F.when(F.col("_wanted") & (F.col("_there") > 0), 1)).alias("items"),
        F.coalesce(F.min(F.when(F.col("_wanted"), F.col("_short"))), F.lit(0)).alias("shortest"),
        F.coalesce(F.max(F.when(F.col("_wanted"), F.col("_long"))), F.lit(0)).alias("longest"),
        F.count(F.when(F.col("_wanted").isNull(), 1)).alias("orphans"),
    )
    return joined.where("expected > 0")


def require_vectors(entries: DataFrame, vectors: DataFrame) -> None:
    """Fail when a scope lacks vectors or mixes lengths. Brings one offending row to the driver."""
    bad = check_vectors(entries, vectors).where(
        (F.col("items") != F.col("expected")) | (F.col("shortest") != F.col("longest"))
    )
    for row in bad.take(1):
        raise ValueError(
            f"scope {row.app_id}/{row.user_id}: {row['items']} vectors for {row['expected']} entries, "
            f"lengths {row['shortest']} to {row['longest']}"
        )


def normalize_vectors(vectors: DataFrame) -> DataFrame:
    """Scale every vector to length one (float32); a zero vector stays zero."""
    return vectors.withColumn("vector", vx.unit_vector("vector"))
