"""Queries over catalysts, search, overviews, status and text blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenfold.functions import text as tx
from lumenfold.operators import embed, entities, overview, retrieval, shape
from lumenfold.plans import data
from lumenfold.plans.cluster_queries import contrast_sql, documents, embedded_sql
from lumenfold.plans.data import AS_OF
from lumenfold.plans.registry import query
from lumenfold.plans.shape_queries import COUNTS_SQL, counted_inputs
from lumenfold.schema import SCOPE
from lumenfold.session import materialize

DIM = 128

_QUERIES_CTE = """queries AS (SELECT 'notes' AS app_id, 'u' || (item_id % 4) AS user_id, 'q' || item_id AS query_id, text FROM benchmark)"""
_INDEX = f"""{embedded_sql(DIM)}, {data.MENTIONS_SQL},
csum AS (SELECT user_id, entity_type, entity, slot, sum(v) AS s FROM mentions JOIN dv USING (user_id, entry_id) GROUP BY ALL),
cnorm AS (SELECT user_id, entity_type, entity, sqrt(sum(s * s)) AS norm FROM csum GROUP BY ALL),
cvec AS (SELECT user_id, entity_type || ':' || entity AS catalyst_id, slot, (s / norm)::FLOAT::DOUBLE AS v FROM csum JOIN cnorm USING (user_id, entity_type, entity)),
docs AS (SELECT m.user_id, m.entity_type || ':' || m.entity AS catalyst_id, m.entry_id, round(sum(c.v * d.v), 9) + 0.0 AS assoc
  FROM mentions m JOIN dv d ON d.user_id = m.user_id AND d.entry_id = m.entry_id
  JOIN cvec c ON c.user_id = m.user_id AND c.catalyst_id = m.entity_type || ':' || m.entity AND c.slot = d.slot GROUP BY ALL),
{_QUERIES_CTE}, {data.slots_sql("qslots", "queries", "query_id", "text", DIM)}, {data.vectors_sql("qv", "qslots", "query_id")},
rel AS (SELECT q.user_id, query_id, catalyst_id, round(sum(q.v * c.v), 9) AS relevance FROM qv q JOIN cvec c ON q.user_id = c.user_id AND q.slot = c.slot GROUP BY ALL),
kept AS (SELECT *, row_number() OVER (PARTITION BY user_id, query_id ORDER BY relevance DESC, catalyst_id) AS cr FROM rel WHERE relevance > 0),
reach AS (SELECT k.user_id, query_id, entry_id, max(relevance * greatest(assoc, 0.0)) AS similarity FROM kept k JOIN docs d USING (user_id, catalyst_id) GROUP BY ALL),
results AS (SELECT *, row_number() OVER (PARTITION BY user_id, query_id ORDER BY similarity DESC, entry_id) AS rank FROM reach QUALIFY rank <= 10),
totals AS (SELECT user_id, query_id, count(*) AS total_results FROM reach GROUP BY ALL),
routed AS (SELECT r.user_id, query_id, catalyst_id, count(*) AS contribution_count FROM results r JOIN docs USING (user_id, entry_id) GROUP BY ALL),
contributing AS (SELECT k.user_id, k.query_id, k.catalyst_id, k.relevance, coalesce(contribution_count, 0) AS contribution_count
  FROM kept k LEFT JOIN routed USING (user_id, query_id, catalyst_id))"""


_BUILT: dict[tuple, Index] = {}


def built_index(spark, d) -> Index:
    """The stored document index of a data folder, built once per application and content of its tables."""
    content = [
        tuple(data.table(spark, d, name).agg(F.count("*"), F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first())
        for name in ("documents", "benchmark")
    ]
    key = (spark.sparkContext.applicationId, d, *content)
    if key not in _BUILT:
        _BUILT[key] = Index(spark, d)
    return _BUILT[key]


class Index:
    """The document index: entries, vectors, mentions, catalysts, their entries, query vectors."""

    def __init__(self, spark, d):
        self.entries = materialize(documents(spark, d), "entries")
        counts = materialize(embed.slot_counts(self.entries, dim=DIM, keep=["entry_id", "entry_index"]), "slot-counts")
        self.rarity = materialize(embed.rarity_of(counts, DIM), "rarity")
        self.vectors = materialize(embed.weighed(counts, self.rarity, DIM), "vectors")
        self.mentions = materialize(entities.extract_entities(self.entries), "mentions")
        catalysts = retrieval.build_catalysts(self.entries, self.mentions, self.vectors)
        self.catalysts = materialize(catalysts, "catalysts")
        self.documents = materialize(
            retrieval.catalyst_documents(self.catalysts, self.mentions, self.vectors), "catalyst-documents"
        )
        self.texts = data.table(spark, d, "benchmark").select(
            F.lit("notes").alias("app_id"), F.concat(F.lit("u"), F.col("item_id") % 4).alias("user_id"),
            F.concat(F.lit("q"), "item_id").alias("query_id"), "text",
        )
        self.queries = embed.embed_entries(
            self.texts, text=F.col("text"), rarity=self.rarity, dim=DIM, keep=["query_id"]
        )

    def search(self):
        found = retrieval.catalyze(self.queries, self.catalysts, self.documents)
        return retrieval.SearchResult(
            materialize(found.results, "results"), materialize(found.catalysts, "contributing"), found.totals
        )


_ENTITY_MEMBERS = """emem AS (SELECT m.user_id, e.entry_index, entity_type || ':' || entity AS catalyst_id, entity,
  count(*) OVER (PARTITION BY m.user_id, entity_type, entity) AS size FROM mentions m JOIN entries e USING (user_id, entry_id))"""
_CATALYST_TEXT = f"""{_ENTITY_MEMBERS}, {contrast_sql("emem", "catalyst_id")},
catalysts AS (SELECT DISTINCT m.user_id, m.catalyst_id, m.entity, m.size,
  'What recurs in ' || m.entity || ' around ' || array_to_string(keywords, ', ') || '?' AS text FROM emem m JOIN contrast USING (user_id, catalyst_id))"""


@query("build_catalysts", f"WITH {_INDEX}, {_CATALYST_TEXT} SELECT user_id, catalyst_id, entity, size AS entries, text FROM catalysts")
def build_catalysts(spark, d):
    return built_index(spark, d).catalysts.select("user_id", "catalyst_id", "entity", "entries", "text")


@query(
    "catalyze",
    f"""WITH {_INDEX} SELECT user_id, query_id, rank, entry_id, title, length(content) AS n_chars, round(similarity, 6) AS similarity, total_results, 'explore' AS register
    FROM results JOIN totals USING (user_id, query_id) JOIN entries USING (user_id, entry_id)""",
)
def catalyze(spark, d):
    index = built_index(spark, d)
    found = index.search()
    shown = index.entries.select(*SCOPE, "entry_id", "title", F.length("content").cast("long").alias("n_chars"))
    return found.results.join(shown, [*SCOPE, "entry_id"]).join(found.totals, retrieval.QUERY).select(
        "user_id", "query_id", F.col("rank").cast("long").alias("rank"), "entry_id", "title", "n_chars",
        F.round("similarity", 6).alias("similarity"), "total_results", "register",
    )


@query(
    "contributing_catalysts",
    f"WITH {_INDEX} SELECT user_id, query_id, catalyst_id, round(relevance, 6) AS relevance, contribution_count FROM contributing",
)
def contributing_catalysts(spark, d):
    return built_index(spark, d).search().catalysts.select(
        "user_id", "query_id", "catalyst_id", F.round("relevance", 6).alias("relevance"), "contribution_count"
    )


@query(
    "catalyze_by_catalyst",
    f"""WITH {_INDEX} SELECT user_id, query_id, catalyst_id, string_agg(entry_id || '/' || title, ' ' ORDER BY rank) AS documents
    FROM results JOIN docs USING (user_id, entry_id) JOIN kept USING (user_id, query_id, catalyst_id) JOIN entries USING (user_id, entry_id) GROUP BY ALL""",
)
def catalyze_by_catalyst(spark, d):
    index = built_index(spark, d)
    shaped = retrieval.catalyze_by_catalyst(index.search(), index.documents, index.entries)
    line = F.transform("documents", lambda r: F.concat_ws("/", r["entry_id"], r["title"]))
    return shaped.select("user_id", "query_id", "catalyst_id", F.array_join(line, " ").alias("documents"))


@query(
    "scope_search",
    f"""WITH {_INDEX} SELECT user_id, query_id, rank, 'note' AS primitive, entry_id AS source_id, title, content AS snippet, '' AS app_url,
    strftime(created_at, '%Y-%m-%d') AS created_at, '{{"lang":"' || lang || '","n_chars":' || n_chars || '}}' AS metadata, round(similarity, 6) AS similarity
    FROM results JOIN entries USING (user_id, entry_id)""",
)
def scope_search(spark, d):
    index = built_index(spark, d)
    twice = F.explode(F.array(F.lit("all"), F.col("catalyst_id"))).alias("collection_id")  # every catalyst in two collections
    rows, _ = retrieval.scope_search(
        index.queries, index.catalysts.select("*", twice), index.documents.select("*", twice), index.entries
    )
    return rows.select(
        "user_id", "query_id", F.col("rank").cast("long").alias("rank"), "primitive", "source_id", "title", "snippet",
        F.coalesce("app_url", F.lit("")).alias("app_url"), F.date_format("created_at", "yyyy-MM-dd").alias("created_at"), "metadata",
        F.round("similarity", 6).alias("similarity"),
    )


@query(
    "search_routes",
    f"""WITH {_INDEX} SELECT user_id, query_id, rank, entry_id, catalyst_id, 'box/' || folder AS collection_id, length(folder) AS index_generation, round(relevance, 6) AS relevance
    FROM results JOIN docs USING (user_id, entry_id) JOIN kept USING (user_id, query_id, catalyst_id) JOIN entries USING (user_id, entry_id)""",
)
def search_routes(spark, d):
    index = built_index(spark, d)
    boxes = index.entries.select(*SCOPE, "entry_id", F.concat(F.lit("box/"), "folder").alias("collection_id"))
    homed = index.documents.join(boxes, [*SCOPE, "entry_id"])
    generations = boxes.select(*SCOPE, "collection_id").distinct().withColumn(
        "index_generation", (F.length("collection_id") - 4).cast("long")
    )
    return retrieval.search_routes(index.search(), homed, generations).select(
        "user_id", "query_id", F.col("rank").cast("long").alias("rank"), "entry_id", "catalyst_id", "collection_id", "index_generation",
        F.round("relevance", 6).alias("relevance"),
    )


# --- overview ---------------------------------------------------------------

_STATS = f"""stats AS (SELECT user_id, entity_type, entity, count(*) AS frequency,
  count(*) FILTER (created_at > TIMESTAMP '{AS_OF}' - INTERVAL 12 MONTH) AS frequency_12m, max(created_at) AS last_seen,
  count(*) FILTER (created_at > TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY) AS recent,
  count(*) FILTER (created_at > TIMESTAMP '{AS_OF}' - INTERVAL 60 DAY AND created_at <= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY) AS previous
  FROM mentions JOIN entries USING (user_id, entry_id) GROUP BY ALL),
activity AS (SELECT *, date_diff('day', last_seen, TIMESTAMP '{AS_OF}') AS days, round(2.0 ** (-date_diff('day', last_seen, TIMESTAMP '{AS_OF}') / 90.0), 9) AS recency,
  CASE WHEN recent > 1.2 * previous THEN 'rising' WHEN recent < 0.8 * previous THEN 'declining' ELSE 'stable' END AS trend FROM stats),
overview AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(recency * ln(1 + frequency), 9) DESC, entity, entity_type) AS rank,
  count(*) OVER (PARTITION BY user_id) AS total_entities FROM activity QUALIFY rank <= 10)"""
_ENTRY_MENTIONS = f"{data.ENTRIES_SQL}, {data.MENTIONS_SQL}"


def _plain_catalysts(mentions):
    """Two short questions per entity, for overviews that need no vectors."""
    owned = mentions.select(*retrieval.ENTITY).distinct()
    return owned.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        *retrieval.ENTITY, F.concat_ws(":", "entity_type", "entity", "n").alias("catalyst_id"),
        F.concat(F.lit("Question "), "n", F.lit(" on "), "entity").alias("text"),
    )


def _overview(spark, d):
    entries = data.entries(spark, d)
    mentions = entities.extract_entities(entries)
    return overview.entity_overview(mentions, entries, _plain_catalysts(mentions), AS_OF)


@query(
    "entity_overview",
    f"""WITH {_ENTRY_MENTIONS}, {_STATS} SELECT user_id, rank, entity_type, entity, frequency, frequency_12m, strftime(last_seen, '%Y-%m-%d') AS last_seen,
    days AS days_since_last_seen, round(recency, 6) AS recency_score, trend AS activity_trend, total_entities,
    'Question 1 on ' || entity || '|Question 2 on ' || entity AS catalysts FROM overview""",
)
def entity_overview(spark, d):
    return _overview(spark, d).select(
        "user_id", F.col("rank").cast("long").alias("rank"), "entity_type", "entity", "frequency", "frequency_12m",
        F.date_format("last_seen", "yyyy-MM-dd").alias("last_seen"), "days_since_last_seen", F.round("recency_score", 6).alias("recency_score"),
        "activity_trend", "total_entities", F.array_join("catalysts", "|").alias("catalysts"),
    )


@query(
    "entity_overview_by_query",
    f"""WITH {_INDEX}, {_STATS}, er AS (SELECT q.user_id, q.query_id, c.catalyst_id, coalesce(round(sum(q.v * c.v), 9), 0.0) AS relevance
      FROM qv q JOIN cvec c ON q.user_id = c.user_id AND q.slot = c.slot GROUP BY ALL),
    ranked AS (SELECT er.*, a.entity_type, a.entity, a.frequency, a.trend, row_number() OVER (PARTITION BY er.user_id, query_id ORDER BY relevance DESC, entity, entity_type) AS rank
      FROM er JOIN activity a ON a.user_id = er.user_id AND er.catalyst_id = a.entity_type || ':' || a.entity QUALIFY rank <= 10)
    SELECT user_id, query_id, rank, entity_type, entity, round(relevance, 6) AS relevance, frequency, trend AS activity_trend FROM ranked""",
)
def entity_overview_by_query(spark, d):
    index = built_index(spark, d)
    found = overview.entity_overview_by_query(index.queries, index.mentions, index.entries, index.catalysts, AS_OF)
    return found.select(
        "user_id", "query_id", F.col("rank").cast("long").alias("rank"), "entity_type", "entity", F.round("relevance", 6).alias("relevance"),
        "frequency", "activity_trend",
    )


@query(
    "index_status",
    f"""WITH {_ENTRY_MENTIONS}, e AS (SELECT user_id, count(DISTINCT entity_type || ':' || entity) AS entities,
      count(DISTINCT CASE WHEN entity_type <> 'link' THEN entity_type || ':' || entity END) AS catalysts FROM mentions GROUP BY ALL)
    SELECT user_id, count(*) AS documents, count(vec_id) || '/' || count(*) AS embedded, max(entities) AS entities, max(catalysts) AS catalysts,
      CASE WHEN count(vec_id) > 0 THEN 'given' ELSE '' END AS model
    FROM entries JOIN e USING (user_id) LEFT JOIN embeddings ON vec_id = seq GROUP BY user_id""",
)
def index_status(spark, d):
    entries, mentions, catalysts, vectors = counted_inputs(spark, d)
    return overview.index_status(entries, vectors, mentions, catalysts).drop("app_id")


@query(
    "scope_status",
    f"""WITH {COUNTS_SQL}, g AS (SELECT DISTINCT user_id, unnest(collections) AS collection_id FROM entries),
    f AS (SELECT user_id, sha256(string_agg(collection_id || ':' || length(collection_id), chr(10) ORDER BY collection_id || ':' || length(collection_id))) AS scope_fingerprint FROM g GROUP BY user_id)
    SELECT user_id, collection_id, docs, entities, catalysts, embeddings, CASE WHEN collection_id = 'TOTAL' THEN 0 ELSE length(collection_id) END AS index_generation, scope_fingerprint
    FROM counts JOIN f USING (user_id)""",
)
def scope_status(spark, d):
    entries, mentions, catalysts, vectors = counted_inputs(spark, d)
    homes = entries.select(*SCOPE, F.explode("collections").alias("collection_id")).distinct()
    generations = homes.withColumn("index_generation", F.length("collection_id").cast("long"))
    status = overview.scope_status(entries, mentions, catalysts, vectors, generations)
    return status.drop("app_id").fillna({"collection_id": "TOTAL", "index_generation": 0})


@query(
    "observed_coverage",
    f"""WITH {data.RAW_SQL}, {data.ROWS_SQL}, {data.GROUPED_SQL}, found AS (
      SELECT user_id, 'preference-repeat' AS entity, recipe_name FROM grouped WHERE contains(lower(notes), 'again') OR contains(lower(notes), 'keeper') OR contains(lower(notes), 'repertoire')
      UNION ALL SELECT user_id, 'preference-substitutions', recipe_name FROM grouped WHERE contains(lower(notes), 'substitut') OR contains(lower(notes), 'instead')
      UNION ALL SELECT user_id, 'preference-sweetness', recipe_name FROM grouped WHERE contains(lower(notes), 'too sweet') OR contains(lower(notes), 'less sugar'))
    SELECT user_id, count(DISTINCT entity) AS entities, count(*) AS catalysts FROM found GROUP BY user_id""",
)
def observed_coverage(spark, d):
    """Entities: the recipes and the observed preferences of each commenter; catalysts: what mentions them."""
    rows = shape.normalize_rows(data.raw_comments(spark, d), AS_OF)
    made = shape.derive_observations(shape.group_entries(rows)).withColumn("app_id", F.lit("recipes"))
    preference = F.concat(F.lit("preference-"), F.substring_index("id", ":", -1))
    entity = F.when(F.col("kind") == "observed_preference", preference).otherwise(F.col("recipe_name"))
    shown = made.groupBy(*SCOPE, entity.alias("entity")).agg(F.collect_set("recipe_name").alias("catalysts"))
    return entities.observed_coverage(shown).drop("app_id")


# --- text blocks ------------------------------------------------------------


@query(
    "normalize_catalysts",
    """SELECT conv_id, string_agg('{"text":"' || t || '"}', '|' ORDER BY turn) AS catalysts FROM
    (SELECT conv_id, turn, role || ' ' || turn AS t FROM conversations) GROUP BY conv_id""",
)
def normalize_catalysts(spark, d):
    text = F.concat_ws(" ", "role", "turn")
    mixed = F.when(F.col("turn") % 2 == 0, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(F.to_json(F.struct(text.alias("text"))))
    raw = data.table(spark, d, "conversations").groupBy("conv_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("turn", mixed.alias("v")))), lambda t: t["v"]).alias("values")
    ).withColumn("raw", F.concat(F.lit("["), F.array_join("values", ","), F.lit("]")))
    return raw.select("conv_id", F.array_join(retrieval.normalize_catalysts(F.col("raw")), "|").alias("catalysts"))


@query(
    "render_search_context",
    f"""WITH {_INDEX}, sig AS (SELECT user_id, query_id, string_agg('- **' || catalyst_id || '**: about ' || catalyst_id || ' (relevance: ' || printf('%.2f', relevance) ||
      ', routed ' || contribution_count || ' results — brief; dated)', chr(10) ORDER BY relevance DESC, catalyst_id) AS block FROM contributing GROUP BY ALL),
    res AS (SELECT user_id, query_id, string_agg('#### ' || rank || '. ' || entry_id || '.md (similarity: ' || printf('%.3f', similarity) || ')' || chr(10) ||
      CASE WHEN length(content) > 2000 THEN content[1:2000] || chr(10) || '[...truncated]' ELSE content END || chr(10), chr(10) ORDER BY rank) AS block
      FROM results JOIN entries USING (user_id, entry_id) GROUP BY ALL)
    SELECT q.user_id, q.query_id, '## Search: "' || text || '"' || chr(10) ||
      coalesce(chr(10) || '### Routing signals (catalysts that matched)' || chr(10) || sig.block || chr(10), '') || coalesce(chr(10) || '### Matched documents' || chr(10) || res.block, '') AS context
    FROM queries q LEFT JOIN sig USING (user_id, query_id) LEFT JOIN res USING (user_id, query_id)""",
)
def render_search_context(spark, d):
    index = built_index(spark, d)
    found = index.search()
    guidance = F.array(F.lit("brief"), F.lit("dated"))
    signals = found.catalysts.drop("entity", "text").withColumns(
        {"entity": F.col("catalyst_id"), "text": F.concat(F.lit("about "), "catalyst_id"), "guidance": guidance}
    )
    path = F.concat(F.lit("a/"), "folder", F.lit("/"), "entry_id", F.lit(".md"))
    named = index.entries.select(*SCOPE, "entry_id", tx.display_filename(path).alias("name"), "content")
    results = found.results.join(named, [*SCOPE, "entry_id"])
    asked = index.texts.withColumnRenamed("text", "query")
    return overview.render_search_context(asked, results, signals).select("user_id", "query_id", "context")


@query(
    "render_overview_context",
    f"""WITH {_ENTRY_MENTIONS}, {_STATS}, blocks AS (SELECT user_id, max(total_entities) AS n, string_agg('### ' || entity_type || ': ' || entity || ' (' || frequency || ' occurrences, ' || trend ||
      ', recency: ' || printf('%.1f', recency) || ', ' || CASE WHEN days > 0 THEN 'last seen: ' || days || 'd ago' ELSE 'active today' END || ')' || chr(10) ||
      '  - Question 1 on ' || entity || chr(10) || '  - Question 2 on ' || entity || chr(10), chr(10) ORDER BY rank) AS block FROM overview GROUP BY user_id)
    SELECT user_id, '## Context: what this user''s entries reveal' || chr(10) || chr(10) || 'Tracking ' || n || ' entities across the corpus.' || chr(10) || chr(10) || block AS context FROM blocks""",
)
def render_overview_context(spark, d):
    return overview.render_overview_context(_overview(spark, d)).select("user_id", "context")
