"""Naming clusters: keywords from source fields, from contrast, from titles; ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenfold.functions import text as tx
from lumenfold.functions.index import dense_index
from lumenfold.operators.shape import all_text
from lumenfold.schema import KEYWORD_FIELDS, METADATA_KEYWORD_FIELDS, SCOPE
from lumenfold.session import materialize

CLUSTER = [*SCOPE, "cluster_no"]
KEYWORDS = 4
#: Words of a group that are scored first.
PROBES = 64


def _values(value: Column, kind: str) -> Column:
    """Keyword values of a field: a string is one, a list its non-empty items, a map its enabled keys."""
    if kind.startswith("map"):
        return F.map_keys(F.map_filter(value, lambda k, v: F.coalesce(v, F.lit(False))))
    if kind.startswith("array"):
        return F.filter(value.cast("array<string>"), lambda v: v.isNotNull() & (v != ""))
    return F.when(value.isNotNull(), F.array(value.cast("string")))


def _metadata_values(metadata: Column, field: str) -> Column:
    raw = F.get_json_object(metadata, f"$.{field}")
    items = F.filter(F.from_json(raw, "array<string>"), lambda v: v.isNotNull() & ~v.isin("", "0", "false"))
    enabled = F.map_keys(
        F.map_filter(F.from_json(raw, "map<string,string>"), lambda k, v: v.isNotNull() & ~v.isin("", "0", "false"))
    )
    return F.when(raw.startswith("["), items).when(raw.startswith("{"), enabled).when(raw.isNotNull(), F.array(raw))


def keyword_values(entries: DataFrame) -> Column:
    """All keyword values of an entry; repeats inside one entry count."""
    kinds = dict(entries.dtypes)
    found = [_values(F.col(c), kinds[c]) for c in KEYWORD_FIELDS if c in kinds]
    if "metadata" in kinds:
        found += [_metadata_values(F.col("metadata"), c) for c in METADATA_KEYWORD_FIELDS]
    none = F.array().cast("array<string>")
    return F.concat(none, *[F.coalesce(f, none) for f in found])


def _top_terms(scored: DataFrame, order: list, keys: list[str] = CLUSTER) -> DataFrame:
    """First four terms per group; ranking is limited before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        scored.withColumn("_rank", rank)
        .where(F.col("_rank") <= KEYWORDS)
        .groupBy(*keys)
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("_rank", "term"))), lambda t: t["term"]).alias("keywords"))
    )


def source_keywords(entries: DataFrame, members: DataFrame) -> DataFrame:
    """Most counted keyword values per cluster that hold a usable word."""
    terms = entries.select(*SCOPE, "entry_index", F.explode(keyword_values(entries)).alias("term"))
    counts = (
        terms.join(members.select(*CLUSTER, "entry_index"), [*SCOPE, "entry_index"])
        .groupBy(*CLUSTER, "term")
        .agg(F.count("*").alias("times"))
        .where(F.size(tx.words(F.col("term"))) > 0)
    )
    return _top_terms(counts, [F.desc("times"), "term"])


def contrast_keywords(
    entries: DataFrame, members: DataFrame, clusters: DataFrame, keys: list[str] = CLUSTER
) -> DataFrame:
    """Words much more frequent inside a cluster than in the rest of its scope.

    ``clusters`` is ``(cluster, size)`` of the clusters to name; ``keys`` may name
    another kind of group inside the scope. Per-entry
    distinct words are counted inside and in the whole scope; outside is the
    difference. Entries of the same groups are counted together, then for each of
    their groups; counts are combined on the map side.

    Most words are too rare in a group to come first whatever the rest of the scope
    holds. The words that are most frequent in it are scored first; of the others
    only those that could beat them are counted in the whole scope.
    """
    wanted = clusters.select(*SCOPE).distinct()
    scope_entries = entries.join(wanted, SCOPE, "left_semi")
    totals = scope_entries.groupBy(*SCOPE).agg(F.count("*").alias("n"))
    chosen = members.join(clusters.select(*keys), keys, "left_semi").select(*keys, "entry_index")
    group = F.struct(*[k for k in keys if k not in SCOPE])
    placed = chosen.groupBy(*SCOPE, "entry_index").agg(F.array_sort(F.collect_list(group)).alias("groups"))
    kinds = placed.groupBy(*SCOPE, "groups").agg(F.min("entry_index").alias("kind"))
    placed = materialize(placed.join(kinds, [*SCOPE, "groups"]), "entry-groups")
    # Texts are split once; the words are taken out of their lists right before they are counted.
    words = scope_entries.select(*SCOPE, "entry_index", tx.distinct_words(all_text(entries)).alias("terms"))
    worded = words.join(placed.drop("groups"), [*SCOPE, "entry_index"], "left").select(*SCOPE, "kind", F.explode("terms").alias("term"))
    counted = materialize(worded.groupBy(*SCOPE, "kind", "term").agg(F.count("*").alias("times")), "entry-words")
    of_kind = placed.where(F.col("entry_index") == F.col("kind")).select(
        *SCOPE, "kind", (F.size("groups") > F.size(F.array_distinct("groups"))).alias("twice"), F.explode("groups").alias("_group")
    )
    inside = materialize(
        counted.where(F.length("term") >= 3)
        .join(of_kind.select(*SCOPE, "kind", "twice", "_group.*"), [*SCOPE, "kind"])
        .groupBy(*keys, "term")
        .agg(F.sum("times").alias("inside"), F.max("twice").alias("twice")),
        "group-words",
    )
    sized = inside.join(clusters.select(*keys, "size"), keys).join(totals, SCOPE)
    outside = F.col("in_scope") - F.col("inside")
    members_total = F.greatest(F.lit(1), F.col("size"))
    others_total = F.greatest(F.lit(1), F.col("n") - F.col("size"))
    rate = F.col("inside") / members_total

    def scored(rows: DataFrame) -> DataFrame:
        asked = rows.select(*SCOPE, "term").distinct()
        everywhere = counted.join(asked, [*SCOPE, "term"], "left_semi").groupBy(*SCOPE, "term").agg(F.sum("times").alias("in_scope"))
        score = rate * F.log((1.0 + members_total + others_total) / (1.0 + outside)) + F.greatest(
            F.lit(0.0), rate - outside / others_total
        )
        return rows.join(everywhere, [*SCOPE, "term"]).withColumn("score", F.round(score, 9))

    # The count that at least PROBES words of a group reach, from how many words have each count: no word is sorted.
    above = F.sum("_words").over(Window.partitionBy(*keys).orderBy(F.desc("inside"))) - F.col("_words")
    spectrum = inside.groupBy(*keys, "inside").agg(F.count("*").alias("_words")).withColumn("_above", above)
    least = spectrum.where(F.col("_above") < PROBES).groupBy(*keys).agg(F.min("inside").alias("_least"))
    probes = materialize(sized.join(least, keys).where(F.col("inside") >= F.col("_least")).drop("_least"), "probes")
    reached = F.element_at(F.sort_array(F.collect_list("score"), asc=False), KEYWORDS)
    floors = scored(probes).groupBy(*keys).agg(F.when(F.count("score") >= KEYWORDS, reached).alias("floor"))
    # No word scores more than if it were nowhere else; where members come twice, ``outside`` may fall below zero.
    at_most = rate * (F.log(1.0 + members_total + others_total) + 1.0)
    able = sized.join(materialize(floors, "floors"), keys).where(
        F.col("twice") | F.col("floor").isNull() | (at_most >= F.col("floor") - 1e-6)
    )
    return _top_terms(scored(materialize(able, "able-words")), [F.desc("score"), "term"], keys)


def title_keywords(entries: DataFrame, ranked: DataFrame) -> DataFrame:
    """First four distinct title words, members taken from most to least central.

    ``ranked`` is ``(cluster, entry_index, similarity)``. The first place of each
    word is an aggregate; the members themselves are never sorted.
    """
    title = F.coalesce(F.col("title"), F.lit(""))
    words = entries.select(*SCOPE, "entry_index", F.posexplode(tx.words(title)).alias("pos", "term"))
    place = F.struct(-F.col("similarity"), F.col("entry_index"), F.col("pos"))
    first = (
        words.join(ranked, [*SCOPE, "entry_index"]).groupBy(*CLUSTER, "term").agg(F.min(place).alias("place"))
    )
    return _top_terms(first, ["place"])


def cluster_keywords(entries: DataFrame, ranked: DataFrame, clusters: DataFrame) -> DataFrame:
    """``(cluster, size, keywords)``: source keywords, else contrast, else title words."""
    size = clusters.select(*CLUSTER, "size")
    named = materialize(source_keywords(entries, ranked), "source-keywords")
    bare = size.join(named, CLUSTER, "left_anti")
    if not bare.isEmpty():
        contrast = materialize(contrast_keywords(entries, ranked, bare), "contrast-keywords")
        named = named.unionByName(contrast)
        silent = bare.select(*CLUSTER).join(contrast, CLUSTER, "left_anti")
        if not silent.isEmpty():
            named = named.unionByName(title_keywords(entries, ranked.join(silent, CLUSTER, "left_semi")))
    return size.join(named, CLUSTER, "left").withColumn(
        "keywords", F.coalesce("keywords", F.array().cast("array<string>"))
    )


def cluster_ids(named: DataFrame, prefix: str) -> DataFrame:
    """Readable id per cluster: first four distinct keyword words, 48 characters, suffix for repeats."""
    parts = F.slice(F.array_distinct(tx.words(F.array_join("keywords", " "))), 1, KEYWORDS)
    fallback = F.concat(F.lit("c"), F.lpad(F.col("cluster_no").cast("string"), 3, "0"))
    fallback = F.when(F.col("cluster_no") > 999, F.concat(F.lit("c"), F.col("cluster_no"))).otherwise(fallback)
    slug = tx.first_present(F.regexp_replace(F.substring(F.array_join(parts, "-"), 1, 48), "-+$", ""), fallback)
    numbered = dense_index(named.withColumn("_slug", slug), [*SCOPE, "_slug"], "cluster_no", out="_repeat", start=1)
    suffix = F.when(F.col("_repeat") > 1, F.concat(F.lit("-"), F.col("_repeat"))).otherwise("")
    return numbered.withColumn(
        "cluster_id", F.concat(F.lit(tx.id_prefix(prefix) + "-"), F.col("_slug"), suffix)
    ).drop("_slug", "_repeat")
