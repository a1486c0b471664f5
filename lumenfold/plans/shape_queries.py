"""Queries over shaping, entities and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenfold.functions import text as tx
from lumenfold.operators import entities as en
from lumenfold.operators import shape as sh
from lumenfold.plans import data
from lumenfold.plans.data import AS_OF
from lumenfold.plans.registry import query

_ROWS = f"WITH {data.RAW_SQL}, {data.ROWS_SQL}"
_GROUPED = f"{_ROWS}, {data.GROUPED_SQL}"
_ENTRIES = f"WITH {data.ENTRIES_SQL}"
_ACTIVITIES = f"WITH {data.ACTIVITIES_SQL}"


def _rows(spark, d):
    return sh.normalize_rows(data.raw_comments(spark, d), AS_OF)


@query("normalize_rows", f"{_ROWS} SELECT seq, user_key, user_id, recipe_name, comment, date FROM rows")
def normalize_rows(spark, d):
    return _rows(spark, d)


@query("clean_text", f"SELECT page_id, {data.clean_sql('html')} AS text FROM pages")
def clean_text(spark, d):
    return data.table(spark, d, "pages").select("page_id", tx.clean_markup(F.col("html")).alias("text"))


@query(
    "parse_dates",
    f"""WITH {data.RAW_SQL} SELECT seq, CASE WHEN date IS NOT NULL THEN date[1:10] WHEN seq % 4 = 0 THEN '{AS_OF}'
    ELSE strftime(to_timestamp(approveDate::BIGINT) AT TIME ZONE 'UTC', '%Y-%m-%d') END AS date FROM raw""",
)
def parse_dates(spark, d):
    raw = data.raw_comments(spark, d)
    epoch = F.when(F.col("seq") % 4 == 0, "").otherwise(F.col("approveDate"))
    return raw.select("seq", sh.parse_date(F.col("date"), epoch, AS_OF).alias("date"))


@query(
    "filter_users",
    f"""{_ROWS} SELECT seq, user_key FROM rows
    WHERE user_key IN (SELECT c_name FROM customer WHERE c_mktsegment = 'BUILDING')
    UNION ALL SELECT -seq, user_key FROM rows WHERE user_key = 'Customer#000000007' OR user_id = '8'""",
)
def filter_users(spark, d):
    rows = _rows(spark, d)
    users = data.table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_name").alias("user_key"))
    one = sh.filter_user(rows, "Customer#000000007", "8")
    return sh.filter_users(rows, users).select("seq", "user_key").unionByName(one.select((-F.col("seq")).alias("seq"), "user_key"))


@query(
    "group_entries",
    f"""{_GROUPED} SELECT user_id, user_key, recipe_name, notes, created_at, seq,
    'Recipe ' || recipe_name[8:8] || ' ' || t AS title, 'Recipe: Recipe ' || recipe_name[8:8] || ' ' || t AS content
    FROM (SELECT *, CASE recipe_name[10:] WHEN 'urgent' THEN 'Urgent' WHEN 'high' THEN 'High' WHEN 'medium' THEN 'Medium'
      WHEN 'not-specified' THEN 'Not Specified' ELSE 'Low' END AS t FROM grouped)""",
)
def group_entries(spark, d):
    return sh.group_entries(_rows(spark, d)).select(
        "user_id", "user_key", "recipe_name", "notes", "created_at", "seq", "title", "content"
    )


_OBSERVED = """SELECT user_id, recipe_name, created_at, 'recipe_comment' AS kind, 'recipe-comment:' || user_id || ':' || recipe_name AS id,
  '' AS topic, notes AS summary, '' AS source_activity_id FROM grouped
UNION ALL SELECT user_id, recipe_name, created_at, 'observed_preference', 'observed-preference:' || user_id || ':' || recipe_name || ':substitutions',
  'substitutions', user_key || ' often adapts ' || recipe_name || ' around available ingredients.', 'recipe-comment:' || user_id || ':' || recipe_name
  FROM grouped WHERE contains(lower(notes), 'substitut') OR contains(lower(notes), 'instead')
UNION ALL SELECT user_id, recipe_name, created_at, 'observed_preference', 'observed-preference:' || user_id || ':' || recipe_name || ':repeat',
  'repeat-worthy recipes', user_key || ' marked ' || recipe_name || ' as worth returning to.', 'recipe-comment:' || user_id || ':' || recipe_name
  FROM grouped WHERE contains(lower(notes), 'again') OR contains(lower(notes), 'keeper') OR contains(lower(notes), 'repertoire')
UNION ALL SELECT user_id, recipe_name, created_at, 'observed_preference', 'observed-preference:' || user_id || ':' || recipe_name || ':sweetness',
  'sweetness adjustments', user_key || ' tends to reduce sweetness in ' || recipe_name || '.', 'recipe-comment:' || user_id || ':' || recipe_name
  FROM grouped WHERE contains(lower(notes), 'too sweet') OR contains(lower(notes), 'less sugar')"""


@query("derive_observations", f"{_GROUPED} {_OBSERVED}")
def derive_observations(spark, d):
    made = sh.derive_observations(sh.group_entries(_rows(spark, d)))
    return made.select(
        "user_id", "recipe_name", "created_at", "kind", "id", "summary",
        F.coalesce("topic", F.lit("")).alias("topic"), F.coalesce("source_activity_id", F.lit("")).alias("source_activity_id"),
    )


@query(
    "activity_transform",
    rf"""{_ACTIVITIES} SELECT user_id, seq, title, content || chr(10) || chr(10) || 'Metadata: ' || metadata AS content,
    coalesce(source_id, '') AS id, coalesce(array_to_string(collections, ','), 'none') AS collections FROM activities""",
)
def activity_transform(spark, d):
    return sh.activity_transform(data.activities(spark, d)).select(
        "user_id", "seq", "title", "content", F.coalesce("id", F.lit("")).alias("id"),
        F.coalesce(F.array_join("collections", ","), F.lit("none")).alias("collections"),
    )


@query(
    "map_fields",
    f"{_ACTIVITIES} SELECT user_id, seq, kind AS title, content, 0::BIGINT AS n_tags, '' AS source_id, upper(kind) AS primitive FROM activities",
)
def map_fields(spark, d):
    mapped = sh.map_fields(
        data.activities(spark, d),
        {"title": "kind", "content": "content", "tags": "no_such_field", "source_id": "missing", "primitive": F.upper("kind")},
        keep=["user_id", "seq"],
    )
    return mapped.withColumn("n_tags", F.size("tags").cast("long")).drop("tags")


@query(
    "map_collections",
    f"""{_ACTIVITIES} SELECT user_id, seq, CASE seq % 3 WHEN 0 THEN 'chat-' || kind WHEN 1 THEN '' ELSE 'own-value' END AS collection,
    CASE WHEN seq % 3 = 1 THEN 'recipe/' || kind || ',all' ELSE '' END AS collections FROM activities""",
)
def map_collections(spark, d):
    kind = F.col("kind")
    base = data.activities(spark, d).withColumn("collection", F.when(F.col("seq") % 3 == 2, " Own  Value! "))
    one = F.array(F.concat(F.lit("Chat "), kind), F.concat(F.lit("chat-"), kind))
    many = F.array(F.concat(F.lit("recipe/"), kind), F.lit("All"), F.concat(F.lit(" Recipe/"), kind))
    hook = F.when(F.col("seq") % 3 == 0, one).when(F.col("seq") % 3 == 1, many)
    return sh.map_collections(base, hook).select(
        "user_id", "seq", F.coalesce("collection", F.lit("")).alias("collection"),
        F.coalesce(F.array_join("collections", ","), F.lit("")).alias("collections"),
    )


@query(
    "primary_collection",
    f"""{_ACTIVITIES} SELECT user_id, seq, CASE WHEN collections IS NOT NULL THEN collections[1] WHEN seq % 2 = 1 THEN kind ELSE 'chat-notes' END
    AS primary_collection FROM activities""",
)
def primary_collection(spark, d):
    shaped = sh.activity_transform(data.activities(spark, d)).withColumn("collection", F.when(F.col("seq") % 2 == 1, F.col("kind")))
    return sh.primary_collection(shaped, "Chat Notes").select("user_id", "seq", "primary_collection")


@query(
    "clean_tags",
    "SELECT doc_id, CASE WHEN quality IS NULL THEN lang || ',' || lang ELSE lang || ',q' || quality || ',' || lang END AS tags "
    "FROM documents LEFT JOIN labels USING (doc_id)",
)
def clean_tags(spark, d):
    labels = data.table(spark, d, "labels")
    tags = F.array("lang", F.lit(""), F.concat(F.lit("q"), "quality"), F.lit(None), "lang")
    return data.table(spark, d, "documents").join(labels, "doc_id", "left").select(
        "doc_id", F.array_join(sh.clean_tags(tags), ",").alias("tags")
    )


@query(
    "validate_collections",
    f"""{_ENTRIES}, declared AS (SELECT DISTINCT 'box/' || source AS c FROM documents WHERE lang = 'es' UNION SELECT 'lang-en')
    SELECT user_id, entry_id, string_agg(c, ',' ORDER BY c) AS unknown FROM (SELECT user_id, entry_id, unnest(collections) AS c FROM entries)
    WHERE c NOT IN (SELECT c FROM declared) GROUP BY ALL""",
)
def validate_collections(spark, d):
    docs = data.table(spark, d, "documents")
    boxes = docs.where("lang = 'es'").select(F.concat(F.lit("box/"), "source").alias("collection_id"))
    english = docs.where("lang = 'en'").select(F.lit("lang-en").alias("collection_id"))
    declared = boxes.unionByName(english).distinct()
    found = sh.validate_collections(data.entries(spark, d), declared, ["user_id", "entry_id"])
    return found.withColumn("unknown", F.array_join("unknown", ","))


@query(
    "normalize_created_at",
    """SELECT event_id, strftime(CASE WHEN event_id % 4 = 3 THEN date_trunc('day', ts) ELSE date_trunc('second', ts) END, '%Y-%m-%d %H:%M:%S') AS created_at
    FROM events""",
)
def normalize_created_at(spark, d):
    ts = F.col("ts").cast("timestamp")
    form = F.col("event_id") % 4
    written = (
        F.when(form == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
        .when(form == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(form == 2, (F.unix_timestamp(ts) * 1000).cast("string"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd"))
    )
    instant = sh.created_at(F.col("written"))
    return data.table(spark, d, "events").withColumn("written", written).select(
        "event_id", F.date_format(instant, "yyyy-MM-dd HH:mm:ss").alias("created_at")
    )


@query(
    "resolve_entry_id",
    f"""{_ACTIVITIES} SELECT user_id, seq, (row_number() OVER (PARTITION BY user_id ORDER BY seq) - 1) AS entry_index,
    coalesce(source_id, 'entry-' || (row_number() OVER (PARTITION BY user_id ORDER BY seq) - 1)) AS entry_id FROM activities""",
)
def resolve_entry_id(spark, d):
    bare = data.activities(spark, d).withColumnRenamed("source_id", "source").drop("title")
    return sh.resolve_entry_id(bare).select("user_id", "seq", "entry_index", "entry_id")


@query(
    "embedding_text",
    rf"{_ENTRIES} SELECT entry_id, title || chr(10) || chr(10) || trim(regexp_replace(content, '\s+', ' ', 'g')) || chr(10) || chr(10) || lang || ' ' || lang AS text FROM entries",
)
def embedding_text(spark, d):
    tag = F.col("tags")[0]
    df = data.entries(spark, d).withColumns({"notes": F.lit("  \n "), "body": F.array(tag, F.lit(""), tag)})
    return df.select("entry_id", sh.embedding_text(df).alias("text"))


@query("normalize_entries", "SELECT 'b' || item_id AS entry_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM benchmark")
def normalize_entries(spark, d):
    bare = data.table(spark, d, "benchmark").select(F.concat(F.lit("b"), "item_id").alias("entry_id"), F.col("text").alias("value"))
    shaped = sh.normalize_entries(bare)
    return shaped.select("entry_id", sh.embedding_text(shaped).alias("text"))


# --- entities and counts ----------------------------------------------------


def profiles(spark, d):
    """A profile for two thirds of the sources, derived from the given table."""
    from lumenfold.schema import CATALYST_PROFILES

    number = F.substring("source", 4, 3).cast("int")
    names = F.array(*[F.lit(p) for p in CATALYST_PROFILES])
    return (
        data.table(spark, d, "documents").select("source").distinct().where(number % 3 != 0)
        .select(F.concat(F.lit("box/"), "source").alias("collection_id"), names[number % 7].alias("profile"))
    )


@query(
    "collection_profiles",
    f"""{_ENTRIES} SELECT user_id, c AS collection_id, 'folder:' || c AS entity_ref, min(seq) AS first_seq, arg_min(pos, seq) AS first_pos,
    CASE WHEN c LIKE 'box/%' AND c[8:]::INTEGER % 3 <> 0 THEN
      ['preference_evidence','tension_trace','resonance_trace','relational','operational','decision_trace','reflective'][c[8:]::INTEGER % 7 + 1] ELSE '' END AS profile
    FROM (SELECT user_id, seq, unnest(collections) AS c, unnest([0::BIGINT, 1::BIGINT]) AS pos FROM entries) GROUP BY user_id, c""",
)
def collection_profiles(spark, d):
    return en.collection_profiles(data.entries(spark, d), profiles(spark, d)).select(
        "user_id", "collection_id", "entity_ref", "first_seq", F.col("first_pos").cast("long").alias("first_pos"),
        F.coalesce("profile", F.lit("")).alias("profile"),
    )


@query(
    "extract_entities",
    f"{_ENTRIES}, {data.MENTIONS_SQL} SELECT DISTINCT user_id, entry_id, entity_type, entity FROM mentions",
)
def extract_entities(spark, d):
    return en.extract_entities(data.entries(spark, d)).select("user_id", "entry_id", "entity_type", "entity")


@query(
    "activity_counts",
    f"""{_ACTIVITIES} SELECT user_id, 'type' AS grouping, kind AS name, count(*) AS activities FROM activities GROUP BY ALL
    UNION ALL SELECT user_id, 'collection', c, count(*) FROM (SELECT user_id, unnest(collections) AS c FROM activities) GROUP BY ALL""",
)
def activity_counts(spark, d):
    shaped = sh.activity_transform(data.activities(spark, d))
    return en.activity_counts(shaped).drop("app_id")


COUNTS_SQL = f"""{data.ENTRIES_SQL}, {data.MENTIONS_SQL},
  homes AS (SELECT user_id, entry_id, unnest(collections) AS c FROM entries),
  ents AS (SELECT DISTINCT user_id, entry_id, entity_type || ':' || entity AS e FROM mentions),
  vecs AS (SELECT user_id, entry_id FROM entries JOIN embeddings ON vec_id = seq),
  counts AS (
  SELECT user_id, c AS collection_id, count(DISTINCT entry_id) AS docs, count(DISTINCT e) AS entities,
    count(DISTINCT CASE WHEN e NOT LIKE 'link:%' THEN e END) AS catalysts, count(DISTINCT v) AS embeddings
  FROM (SELECT h.user_id, h.c, h.entry_id, ents.e, vecs.entry_id AS v FROM homes h LEFT JOIN ents USING (user_id, entry_id) LEFT JOIN vecs USING (user_id, entry_id))
  GROUP BY ALL
  UNION ALL
  SELECT user_id, 'TOTAL', count(DISTINCT entry_id), count(DISTINCT e), count(DISTINCT CASE WHEN e NOT LIKE 'link:%' THEN e END), count(DISTINCT v)
  FROM (SELECT h.user_id, h.entry_id, ents.e, vecs.entry_id AS v FROM entries h LEFT JOIN ents USING (user_id, entry_id) LEFT JOIN vecs USING (user_id, entry_id))
  GROUP BY ALL)"""


def counted_inputs(spark, d):
    """Entries, mentions, catalysts of tags and folders, and the given vectors of the documents of their number."""
    entries = data.entries(spark, d)
    mentions = en.extract_entities(entries)
    owned = mentions.where("entity_type <> 'link'").select("app_id", "user_id", "entity_type", "entity").distinct()
    catalysts = owned.withColumn("catalyst_id", F.concat_ws(":", "entity_type", "entity"))
    given = data.vectors(spark, d).select(
        F.lit("notes").alias("app_id"), "user_id", F.concat(F.lit("doc-"), "seq").alias("entry_id"), "model", "vector"
    )
    vectors = given.join(entries.select("app_id", "user_id", "entry_id"), ["app_id", "user_id", "entry_id"], "left_semi")
    return entries, mentions, catalysts, vectors


@query("scope_counts", f"WITH {COUNTS_SQL} SELECT user_id, collection_id, docs, entities, catalysts, embeddings FROM counts")
def scope_counts(spark, d):
    return en.scope_counts(*counted_inputs(spark, d)).drop("app_id").fillna({"collection_id": "TOTAL"})
