"""The given tables seen as entries, comments, activities and vectors.

Each view exists twice: as a DataFrame and as SQL text for the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.schema import STOP_WORDS

AS_OF = "2024-12-31"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- documents as entries ---------------------------------------------------

LINKS = {"en": "the", "fr": "de", "de": "und", "es": "que"}


def entries(spark: SparkSession, folder: str) -> DataFrame:
    link = F.create_map(*[F.lit(x) for pair in LINKS.items() for x in pair])[F.col("lang")]
    return table(spark, folder, "documents").select(
        F.lit("notes").alias("app_id"),
        F.concat(F.lit("u"), F.col("doc_id") % 4).alias("user_id"),
        F.concat(F.lit("doc-"), "doc_id").alias("id"),
        F.concat(F.lit("doc-"), "doc_id").alias("entry_id"),
        F.col("doc_id").alias("seq"),
        F.concat(F.lit("Note "), "doc_id", F.lit(" from "), "source").alias("title"),
        F.col("text").alias("content"),
        F.col("source").alias("folder"),
        F.lit("note").alias("primitive"),
        F.concat(F.lit("doc-"), "doc_id").alias("source_id"),
        F.timestamp_seconds(F.lit(1704067200) + (F.col("doc_id") % 365) * 86400).alias("created_at"),
        F.array("lang").alias("tags"),
        F.array(link).alias("links"),
        F.array(F.concat(F.lit("lang-"), "lang"), F.concat(F.lit("box/"), "source")).alias("collections"),
        F.to_json(F.struct("lang", "n_chars")).alias("metadata"),
    )


_LINK_CASE = "CASE lang " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LINKS.items()) + " END"
ENTRIES_SQL = f"""entries AS (
  SELECT 'notes' AS app_id, 'u' || (doc_id % 4) AS user_id, 'doc-' || doc_id AS entry_id, doc_id AS seq,
    row_number() OVER (PARTITION BY doc_id % 4 ORDER BY doc_id) - 1 AS entry_index,
    'Note ' || doc_id || ' from ' || source AS title, text AS content, source AS folder, lang, n_chars,
    {_LINK_CASE} AS link, TIMESTAMP '2024-01-01' + to_days((doc_id % 365)::INTEGER) AS created_at,
    ['lang-' || lang, 'box/' || source] AS collections
  FROM documents)"""

MENTIONS_SQL = """mentions AS (
  SELECT app_id, user_id, entry_id, 'tag' AS entity_type, lang AS entity FROM entries
  UNION ALL SELECT app_id, user_id, entry_id, 'folder', folder FROM entries
  UNION ALL SELECT app_id, user_id, entry_id, 'folder', unnest(collections) FROM entries
  UNION ALL SELECT app_id, user_id, entry_id, 'link', link FROM entries)"""

_STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"


def words_sql(text: str) -> str:
    """The word list of a text (the given texts hold no ligatures or fractions)."""
    plain = rf"lower(regexp_replace(strip_accents({text}), '[^\x00-\x7F]', '', 'g'))"
    return (
        f"list_filter(regexp_extract_all({plain}, '[a-z0-9]+'), "
        f"lambda w: NOT list_contains({_STOP_SQL}, w) AND NOT regexp_full_match(w, '[0-9]+'))"
    )


def slots_sql(name: str, source: str, ident: str, text: str, dim: int) -> str:
    """CTE ``name(app_id, user_id, ident, slot, times)``."""
    return f"""{name} AS (
  SELECT app_id, user_id, {ident}, ('0x' || substr(md5(w), 1, 8))::BIGINT % {dim} AS slot, count(*) AS times
  FROM (SELECT app_id, user_id, {ident}, unnest({words_sql(text)}) AS w FROM {source}) GROUP BY ALL)"""


def rarity_sql(slots: str, source: str) -> str:
    return f"""sizes AS (SELECT app_id, user_id, count(*) AS n FROM {source} GROUP BY ALL),
rarity AS (SELECT app_id, user_id, slot, ln((1.0 + max(n)) / (1.0 + count(*))) AS idf
  FROM {slots} JOIN sizes USING (app_id, user_id) GROUP BY ALL)"""


def vectors_sql(name: str, slots: str, ident: str) -> str:
    """CTE ``name(app_id, user_id, ident, slot, v)`` with unit length, rounded to 32 bits.

    A slot no entry hits has the largest rarity of its scope.
    """
    return f"""{name}_raw AS (
  SELECT app_id, user_id, {ident}, slot, ln(1.0 + times) * coalesce(idf, ln(1.0 + n)) AS v
  FROM {slots} JOIN sizes USING (app_id, user_id) LEFT JOIN rarity USING (app_id, user_id, slot)),
{name} AS (
  SELECT r.app_id, r.user_id, r.{ident}, slot, (CASE WHEN norm > 0 THEN v / norm ELSE 0 END)::FLOAT::DOUBLE AS v
  FROM {name}_raw r JOIN (SELECT app_id, user_id, {ident}, sqrt(sum(v * v)) AS norm FROM {name}_raw GROUP BY ALL) s
  ON r.app_id = s.app_id AND r.user_id = s.user_id AND r.{ident} = s.{ident})"""


# --- orders and customers as recipe comments --------------------------------

_COMMENT = (
    "CASE o_orderstatus "
    "WHEN 'F' THEN '<p>Made it for order ' || o_orderkey || ' &amp; would make it Again,<br/>a  keeper for our table &amp;lt;3</p>' "
    "WHEN 'O' THEN 'It was too sweet, so <b>less sugar</b> next time; I substituted honey instead &quot;as is&quot;, order ' || o_orderkey "
    "ELSE 'Fine: ' || o_orderkey || ', nothing to change here for the ' || c_mktsegment END"
)
_RECIPE = "'recipe-' || lower(replace(o_orderpriority, ' ', '-'))"


def raw_comments(spark: SparkSession, folder: str) -> DataFrame:
    """Odd orders use the one spelling of the source columns, even ones the other."""
    joined = table(spark, folder, "orders").join(
        table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    odd = "o_orderkey % 2 = 1"
    return joined.selectExpr(
        "o_orderkey AS seq",
        f"CASE WHEN {odd} THEN c_name END AS user_key",
        f"CASE WHEN {odd} THEN CAST(o_custkey AS STRING) END AS user_id",
        f"CASE WHEN {odd} THEN {_RECIPE} END AS recipe_name",
        f"CASE WHEN {odd} THEN {_COMMENT} END AS comment",
        f"CASE WHEN {odd} THEN date_format(o_orderdate, 'yyyy-MM-dd HH:mm') END AS date",
        f"CASE WHEN NOT {odd} THEN c_name END AS userDisplayName",
        f"CASE WHEN NOT {odd} THEN CAST(o_custkey AS STRING) END AS userID",
        f"CASE WHEN NOT {odd} THEN {_RECIPE} END AS recipeName",
        f"CASE WHEN NOT {odd} THEN {_COMMENT} END AS commentBody",
        f"CASE WHEN NOT {odd} THEN CAST(unix_timestamp(o_orderdate) AS STRING) END AS approveDate",
    )


RAW_SQL = f"""raw AS (
  SELECT o_orderkey AS seq,
    CASE WHEN o_orderkey % 2 = 1 THEN c_name END AS user_key,
    CASE WHEN o_orderkey % 2 = 1 THEN o_custkey::VARCHAR END AS user_id,
    CASE WHEN o_orderkey % 2 = 1 THEN {_RECIPE} END AS recipe_name,
    CASE WHEN o_orderkey % 2 = 1 THEN {_COMMENT} END AS comment,
    CASE WHEN o_orderkey % 2 = 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M') END AS date,
    CASE WHEN o_orderkey % 2 = 0 THEN c_name END AS userDisplayName,
    CASE WHEN o_orderkey % 2 = 0 THEN o_custkey::VARCHAR END AS userID,
    CASE WHEN o_orderkey % 2 = 0 THEN {_RECIPE} END AS recipeName,
    CASE WHEN o_orderkey % 2 = 0 THEN {_COMMENT} END AS commentBody,
    CASE WHEN o_orderkey % 2 = 0 THEN epoch(o_orderdate)::BIGINT::VARCHAR END AS approveDate
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def clean_sql(text: str) -> str:
    text = rf"regexp_replace({text}, '<br\s*/?>', chr(10), 'g')"
    text = f"regexp_replace({text}, '<[^>]+>', '', 'g')"
    for coded, plain in [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''")]:
        text = f"replace({text}, '{coded}', '{plain}')"
    return rf"trim(regexp_replace({text}, '\s+', ' ', 'g'))"


ROWS_SQL = f"""rows AS (
  SELECT seq, coalesce(user_key, userDisplayName) AS user_key, coalesce(user_id, userID) AS user_id,
    trim(coalesce(recipe_name, recipeName)) AS recipe_name, {clean_sql("coalesce(comment, commentBody)")} AS comment,
    coalesce(date[1:10], strftime(to_timestamp(approveDate::BIGINT) AT TIME ZONE 'UTC', '%Y-%m-%d')) AS date
  FROM raw)"""

GROUPED_SQL = """grouped AS (
  SELECT user_id, recipe_name, string_agg(comment, chr(10) || chr(10) ORDER BY seq) AS notes, max(date) AS created_at,
    arg_min(user_key, seq) AS user_key, min(seq) AS seq
  FROM rows WHERE recipe_name <> '' AND length(comment) > 50 GROUP BY user_id, recipe_name)"""


# --- conversations as activities --------------------------------------------


def activities(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations").select(
        F.lit("chat").alias("app_id"),
        F.concat(F.lit("c"), "conv_id").alias("user_id"),
        F.col("turn").alias("seq"),
        F.col("role").alias("kind"),
        F.concat("role", F.lit(" turn "), "turn").alias("title"),
        F.col("text").alias("content"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("turn") * 60).alias("created_at"),
        F.when(F.col("turn") > 0, F.concat_ws("-", F.lit("msg"), "conv_id", "turn")).otherwise("").alias("source_id"),
        F.when(F.col("role") != "system", F.array(F.lit("ChatTurn"), F.concat(F.initcap("role"), F.lit("Message"))))
        .otherwise(F.array().cast("array<string>"))
        .alias("classes"),
        F.to_json(F.struct(F.col("turn"), F.col("role").alias("role"), F.array(F.lit("é"), F.col("role")).alias("labels"))).alias("metadata"),
    )


ACTIVITIES_SQL = """activities AS (
  SELECT 'chat' AS app_id, 'c' || conv_id AS user_id, turn AS seq, role AS kind, role || ' turn ' || turn AS title,
    text AS content, CASE WHEN turn > 0 THEN 'msg-' || conv_id || '-' || turn END AS source_id,
    CASE WHEN role <> 'system' THEN ['chat-turn', role || '-message'] END AS collections,
    '{"labels": ["é", "' || role || '"], "role": "' || role || '", "turn": ' || turn || '}' AS metadata
  FROM conversations)"""


# --- events as saves --------------------------------------------------------


def saves(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.lit("app").alias("app_id"),
        F.concat(F.lit("u"), "user_id").alias("user_id"),
        F.concat(F.lit("event-"), "event_id").alias("entry_id"),
        F.col("event_id").alias("seq"),
        F.concat("event_type", F.lit(" "), "event_id").alias("title"),
        F.col("props").alias("content"),
        F.col("event_type").alias("folder"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type"),
    )


# --- embeddings as entry vectors --------------------------------------------


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.lit("vec").alias("app_id"),
        F.concat(F.lit("u"), F.col("vec_id") % 4).alias("user_id"),
        F.concat(F.lit("vec-"), "vec_id").alias("entry_id"),
        F.col("vec_id").alias("seq"),
        F.floor(F.col("vec_id") / 4).alias("entry_index"),
        F.lit("given").alias("model"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").alias("vector"),
    )


VECTORS_SQL = """vecs AS (
  SELECT 'vec' AS app_id, 'u' || (vec_id % 4) AS user_id, 'vec-' || vec_id AS entry_id, vec_id // 4 AS entry_index, label::BIGINT AS label,
    list_transform(embedding, lambda x: (x::DOUBLE / nullif(sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE))), 0))::FLOAT::DOUBLE) AS v
  FROM embeddings)"""
