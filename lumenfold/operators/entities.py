"""Entities, collections and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.operators.shape import column_or_null
from lumenfold.schema import CATALYST_PROFILES, SCOPE


def collection_profiles(entries: DataFrame, profiles: DataFrame) -> DataFrame:
    """Distinct collections per scope as ``folder:<id>`` with their first arrival and optional profile."""
    many = F.coalesce(column_or_null(entries, "collections", "array<string>"), F.array().cast("array<string>"))
    single = column_or_null(entries, "collection")
    both = F.concat(many, F.when(single.isNotNull(), F.array(single)).otherwise(F.array().cast("array<string>")))
    first = (
        entries.select(*SCOPE, "seq", F.posexplode(both).alias("pos", "collection_id"))
        .groupBy(*SCOPE, "collection_id")
        .agg(F.min(F.struct("seq", "pos")).alias("first_seen"))
    )
    return first.join(profiles, "collection_id", "left").select(
        *SCOPE,
        "collection_id",
        F.concat(F.lit("folder:"), "collection_id").alias("entity_ref"),
        "profile",
        F.col("first_seen.seq").alias("first_seq"),
        F.col("first_seen.pos").alias("first_pos"),
    )


def check_profiles(profiles: DataFrame) -> DataFrame:
    """Rows whose profile is not one of the known ones."""
    return profiles.where(~F.col("profile").isin(CATALYST_PROFILES))


def extract_entities(entries: DataFrame) -> DataFrame:
    """One row per (entry, entity): tags, folders with collections, and links.

    Mentions are made distinct inside the row, so nothing is shuffled.
    """
    none = F.array().cast("array<string>")
    many = lambda name: F.coalesce(column_or_null(entries, name, "array<string>"), none)
    one = lambda name: F.when(column_or_null(entries, name).isNotNull(), F.array(column_or_null(entries, name))).otherwise(none)
    body = F.concat_ws("\n", column_or_null(entries, "content"), column_or_null(entries, "notes"))
    wiki = F.regexp_extract_all(body, F.lit(r"\[\[([^\]]+)\]\]"), F.lit(1))
    kind = lambda name, values: F.transform(
        F.filter(F.array_distinct(values), lambda v: v.isNotNull() & (v != "")),
        lambda v: F.struct(F.lit(name).alias("entity_type"), v.alias("entity")),
    )
    found = F.concat(
        kind("tag", F.transform(many("tags"), lambda t: F.regexp_replace(t, "^#+", ""))),
        kind("folder", F.concat(one("folder"), one("collection"), many("collections"))),
        kind("link", F.concat(many("links"), wiki)),
    )
    return entries.select(*SCOPE, "entry_id", F.explode(found).alias("_e")).select(*SCOPE, "entry_id", "_e.*")


def activity_counts(activities: DataFrame, kind: str = "kind", collections: str = "collections") -> DataFrame:
    """Activities by type and by collection (an activity counts in each of its collections)."""
    by_type = activities.groupBy(*SCOPE, F.lit("type").alias("grouping"), F.col(kind).alias("name")).agg(
        F.count("*").alias("activities")
    )
    exploded = activities.select(*SCOPE, F.explode(collections).alias("name"))
    by_collection = exploded.groupBy(*SCOPE, F.lit("collection").alias("grouping"), "name").agg(
        F.count("*").alias("activities")
    )
    return by_type.unionByName(by_collection)


def scope_counts(entries: DataFrame, mentions: DataFrame, catalysts: DataFrame, vectors: DataFrame) -> DataFrame:
    """Documents, entities, catalysts and embeddings per collection and over the scope.

    The total row has a null ``collection_id`` and counts distinct things: an
    entry in two collections counts once. Each input is first brought down to
    distinct ids per collection, which map tasks combine.
    """
    homes = entries.select(*SCOPE, "entry_id", F.explode_outer("collections").alias("collection_id"))

    def distinct(df: DataFrame, ident: str, out: str) -> DataFrame:
        ids = df.select(*SCOPE, "collection_id", F.col(ident).alias("_id")).distinct()
        each = ids.where("collection_id is not null").groupBy(*SCOPE, "collection_id").agg(F.count("*").alias(out))
        whole = ids.select(*SCOPE, "_id").distinct().groupBy(*SCOPE).agg(F.count("*").alias(out))
        return each.unionByName(whole.withColumn("collection_id", F.lit(None).cast("string")))

    entity = F.concat_ws(":", "entity_type", "entity")
    mentioned = mentions.select(*SCOPE, "entry_id", entity.alias("_entity")).join(homes, [*SCOPE, "entry_id"])
    entity_homes = mentioned.select(*SCOPE, "collection_id", "_entity").distinct()
    owned = catalysts.select(*SCOPE, "catalyst_id", entity.alias("_entity")).join(entity_homes, [*SCOPE, "_entity"])
    embedded = vectors.where("vector is not null").select(*SCOPE, "entry_id").join(homes, [*SCOPE, "entry_id"])
    parts = [
        distinct(homes, "entry_id", "docs"),
        distinct(entity_homes, "_entity", "entities"),
        distinct(owned, "catalyst_id", "catalysts"),
        distinct(embedded, "entry_id", "embeddings"),
    ]
    names = ["docs", "entities", "catalysts", "embeddings"]
    padded = [
        p.select(*SCOPE, "collection_id", *[F.col(n) if n in p.columns else F.lit(0).cast("long").alias(n) for n in names])
        for p in parts
    ]
    stacked = padded[0]
    for p in padded[1:]:
        stacked = stacked.unionByName(p)
    return stacked.groupBy(*SCOPE, "collection_id").agg(*[F.sum(n).alias(n) for n in names])


def observed_coverage(overview: DataFrame) -> DataFrame:
    """Entities about observed preferences in an overview, and how many catalysts they show."""
    about = F.col("entity").contains("observed") | F.col("entity").contains("preference")
    return overview.where(about).groupBy(*SCOPE).agg(
        F.count("*").alias("entities"), F.sum(F.size("catalysts")).cast("long").alias("catalysts")
    )
