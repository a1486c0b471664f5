"""Queries that write the given tables in a format, read them back, and follow their life cycle."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenfold.operators import lifecycle as lc
from lumenfold.operators import refresh
from lumenfold.operators import shape as sh
from lumenfold.plans import data
from lumenfold.plans.cluster_queries import BEST_CLUSTERS, DOC_SIMS
from lumenfold.plans.data import AS_OF
from lumenfold.plans.registry import query
from lumenfold.session import scratch_path
from lumenfold.sources import comments, generations, markdown, store
from lumenfold.streaming import activity
from lumenfold.streaming import saves as st

_FIELDS = ", ".join(f"coalesce({c}, '') AS {c}" for c in comments.COMMENT_FIELDS if c != "seq")
_RAW_OUT = f"WITH {data.RAW_SQL} SELECT seq, {_FIELDS} FROM raw"
_ENTRIES = f"WITH {data.ENTRIES_SQL}"


def _shown(df):
    return df.select("seq", *[F.coalesce(c, F.lit("")).alias(c) for c in comments.COMMENT_FIELDS if c != "seq"])


@query("scan_comments_json", _RAW_OUT)
def scan_comments_json(spark, d):
    path = scratch_path(spark, "comments-json")
    comments.write_json_envelopes(data.raw_comments(spark, d), path)
    return _shown(comments.scan_comments(spark, path, "json"))


@query("scan_comments_csv", _RAW_OUT)
def scan_comments_csv(spark, d):
    path = scratch_path(spark, "comments-csv")
    data.raw_comments(spark, d).write.option("header", True).option("escape", '"').csv(path)
    return _shown(comments.scan_comments(spark, path, "csv"))


@query("scan_comments_zip", _RAW_OUT)
def scan_comments_zip(spark, d):
    path = scratch_path(spark, "comments-zip")
    comments.write_zip_archives(data.raw_comments(spark, d), path)
    return _shown(comments.scan_comments(spark, path, "zip"))


_LINKED = r"regexp_replace(content, '(^|[^\p{L}\p{N}_])(' || link || ')($|[^\p{L}\p{N}_])', '\1[[\2]]\3')"
_MARKDOWN = f"""SELECT user_id, folder, 'note-' || seq || '-from-' || folder || '.md' AS filename,
  array_to_string(['---', 'title: "' || title || '"', 'date: ' || strftime(created_at, '%Y-%m-%d'), 'tags:', '  - ' || lang,
  'lang: "' || lang || '"', 'n_chars: "' || n_chars || '"', '---', '', '# ' || title, '', {_LINKED}, ''], chr(10)) AS markdown FROM entries"""


@query("export_markdown", f"{_ENTRIES} {_MARKDOWN}")
def export_markdown(spark, d):
    return markdown.render_markdown(data.entries(spark, d), AS_OF).drop("app_id")


@query(
    "scan_markdown_folder",
    f"{_ENTRIES} SELECT 'notes/' || user_id || '/' || folder AS folder, filename, markdown AS content FROM ({_MARKDOWN})",
)
def scan_markdown_folder(spark, d):
    path = scratch_path(spark, "markdown")
    markdown.export_markdown(data.entries(spark, d), path, AS_OF)
    return markdown.scan_markdown_folder(spark, path)


@query(
    "ingest_batch",
    f"""{_ENTRIES} SELECT user_id, entry_id, CASE WHEN lang = 'en' THEN title || ' (edited)' ELSE title END AS title, length(content) AS n_chars,
    strftime(created_at, '%Y-%m-%d') AS created_at, array_to_string(collections, ',') AS collections FROM entries""",
)
def ingest_batch(spark, d):
    path = scratch_path(spark, "ingest")
    entries = data.entries(spark, d)
    written = entries.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss"))
    store.ingest_batch(written, path, 0)
    edited = written.where(F.array_contains("tags", "en")).withColumn("title", F.concat("title", F.lit(" (edited)")))
    store.ingest_batch(edited, path, 1)
    return store.read_entries(spark, path).select(
        "user_id", "entry_id", "title", F.length("content").cast("long").alias("n_chars"),
        F.date_format("created_at", "yyyy-MM-dd").alias("created_at"), F.array_join("collections", ",").alias("collections"),
    )


def _save_stream(spark, d, label):
    """The events as a stream of three files, in parts of about 1 MB so that several tasks read a file."""
    path = scratch_path(spark, label)
    saves = data.saves(spark, d)
    saves.repartitionByRange(3, "seq").write.option("parquet.block.size", 1 << 20).parquet(path)
    return spark.readStream.schema(saves.schema).option("maxFilesPerTrigger", 1).parquet(path)


_SAVES = """SELECT 'u' || user_id AS user_id, 'event-' || event_id AS entry_id, event_type || ' ' || event_id AS title, props AS content FROM events"""


@query("ingest_stream", _SAVES)
def ingest_stream(spark, d):
    path = scratch_path(spark, "ingest-stream")
    st.ingest_stream(_save_stream(spark, d, "saves"), path, scratch_path(spark, "cp")).awaitTermination()
    return store.read_entries(spark, path).select("user_id", "entry_id", "title", "content")


def _connected(spark, d):
    """Customers of the first market segments stand for the connected users of the event stream."""
    customers = data.table(spark, d, "customer").where("c_mktsegment in ('BUILDING', 'MACHINERY', 'HOUSEHOLD')")
    return customers.select(F.lit("app").alias("app_id"), F.concat(F.lit("u"), "c_custkey").alias("user_id"))


_GATE = "user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD'))"


@query("gate_connected", f"{_SAVES} WHERE {_GATE}")
def gate_connected(spark, d):
    return lc.gate_connected(data.saves(spark, d), _connected(spark, d)).select("user_id", "entry_id", "title", "content")


@query("stream_saves", f"{_SAVES} WHERE {_GATE}")
def stream_saves(spark, d):
    path = scratch_path(spark, "stream-saves")
    stream = _save_stream(spark, d, "gated")
    st.stream_saves(stream, _connected(spark, d), path, scratch_path(spark, "cp")).awaitTermination()
    return spark.read.parquet(f"{path}/saves").select("user_id", "entry_id", "title", "content")


@query(
    "entity_activity_stream",
    """SELECT 'u' || user_id AS user_id, event_type AS entity, count(*) AS frequency, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen
    FROM events GROUP BY ALL""",
)
def entity_activity_stream(spark, d):
    path = scratch_path(spark, "activity")
    stream = _save_stream(spark, d, "activity-saves")
    st.entity_activity_stream(stream, F.col("event_type"), path, scratch_path(spark, "cp")).awaitTermination()
    return st.read_entity_activity(spark, path).select(
        "user_id", "entity", "frequency", F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss").alias("last_seen")
    )


_ARRIVALS = """WITH placed AS (SELECT *, CASE WHEN event_id % 50 = 0 THEN 3 ELSE (dayofmonth(ts) - 1) // 8 END AS batch FROM events WHERE ts IS NOT NULL),
arrivals AS (SELECT * FROM placed UNION ALL SELECT * REPLACE (least(batch + 1, 3) AS batch) FROM placed WHERE event_id % 40 = 1),
marks AS (SELECT b, (SELECT max(ts) FROM arrivals WHERE batch < b) - INTERVAL 4 DAY AS mark FROM range(4) t(b)),
judged AS (SELECT a.*, coalesce(date_trunc('day', ts) + INTERVAL 1 DAY <= mark, false) AS late FROM arrivals a JOIN marks ON batch = b)"""


@query(
    "entity_activity_state",
    f"""{_ARRIVALS} SELECT 'u' || user_id AS user_id, event_type AS entity, strftime(ts, '%Y-%m-%d') AS day,
      count(DISTINCT event_id) FILTER (NOT late) AS frequency, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_seen
    FROM judged GROUP BY ALL""",
)
def entity_activity_state(spark, d):
    """All events in four steps of eight days; some come again in the next step, some only in the last one.

    The stream is stopped after each step and goes on from its checkpoint.
    """
    saves = data.saves(spark, d)
    step = F.when(F.col("seq") % 50 == 0, 3).otherwise(F.expr("(dayofmonth(ts) - 1) div 8"))
    placed = saves.withColumn("step", step)
    again = placed.where("seq % 40 = 1").withColumn("step", F.least(F.col("step") + 1, F.lit(3)))
    arrivals = placed.unionByName(again)
    source, path, checkpoint = (scratch_path(spark, label) for label in ("arrivals", "activity-state", "cp"))
    for number in range(4):
        arrivals.where(F.col("step") == number).drop("step").write.mode("append").parquet(source)
        stream = spark.readStream.schema(saves.schema).parquet(source)
        activity.activity_stream(
            stream, F.col("event_type"), path, checkpoint, lateness="4 days", shards=2, fold=3
        ).awaitTermination()
    return activity.read_activity_days(spark, path).select(
        "user_id", "entity", F.date_format("day", "yyyy-MM-dd").alias("day"), "frequency",
        F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_seen"),
    )


@query(
    "write_prepared",
    f"""WITH {data.RAW_SQL}, {data.ROWS_SQL}, {data.GROUPED_SQL}
    SELECT 'all' AS part, user_id, recipe_name, notes FROM grouped
    UNION ALL SELECT 'one', user_id, recipe_name, notes FROM grouped WHERE user_key = 'Customer#000000007' OR user_id = '8'""",
)
def write_prepared(spark, d):
    path = scratch_path(spark, "prepared")
    grouped = sh.group_entries(sh.normalize_rows(data.raw_comments(spark, d), AS_OF))
    store.write_prepared(grouped, path, "Customer#000000007", "8")
    read = lambda part, folder: spark.read.parquet(f"{path}/{folder}").select(
        F.lit(part).alias("part"), "user_id", "recipe_name", "notes"
    )
    return read("all", "cluster_entries").unionByName(read("one", "entries"))


@query(
    "collection_catalog",
    f"""{_ENTRIES}, kept AS (SELECT user_id, entry_id, list_filter(collections, lambda c: c NOT IN ('lang-fr', 'box/src3')) AS collections FROM entries
      WHERE lang <> 'de'),
    shown AS (SELECT user_id, unnest(collections) AS collection_id FROM kept)
    SELECT user_id, collection_id, count(*) AS documents, true AS found FROM shown GROUP BY ALL
    UNION ALL SELECT DISTINCT user_id, 'lang-fr', 0, false FROM entries""",
)
def collection_catalog(spark, d):
    entries = data.entries(spark, d)
    kept = store.delete_documents(entries, entries.where(F.array_contains("tags", "de")))
    scopes = entries.select("app_id", "user_id").distinct()
    gone = scopes.select("app_id", "user_id", F.explode(F.array(F.lit("lang-fr"), F.lit("box/src3"))).alias("collection_id"))
    left = store.delete_collections(kept, gone)
    asked = scopes.withColumn("collection_id", F.lit("lang-fr"))
    missing = store.collection_exists(left, asked).withColumn("documents", F.lit(0).cast("long"))
    catalog = store.collection_catalog(left).withColumn("exists", F.lit(True))
    return catalog.unionByName(missing).select("user_id", "collection_id", "documents", F.col("exists").alias("found"))


@query(
    "connect_snapshot",
    f"""{_ENTRIES} SELECT user_id, entry_id, title FROM entries WHERE user_id = 'u3' OR (user_id IN ('u0', 'u1') AND lang = 'en')""",
)
def connect_snapshot(spark, d):
    path = scratch_path(spark, "snapshots")
    entries = data.entries(spark, d)
    store.connect_snapshot(entries, entries.select("app_id", "user_id"), path, 1)
    again = entries.where("user_id <> 'u3'").select("app_id", "user_id")
    fresh = entries.where("user_id in ('u0', 'u1')").where(F.array_contains("tags", "en"))
    store.connect_snapshot(fresh, again, path, 2)
    return store.read_snapshot(spark, path).select("user_id", "entry_id", "title")


_CHANGES = """old AS (SELECT user_id, entry_id, sha256('=' || title) AS h FROM entries WHERE lang <> 'fr'),
  fresh AS (SELECT user_id, entry_id, sha256('=' || title || CASE WHEN lang = 'en' THEN '!' ELSE '' END) AS h FROM entries WHERE lang <> 'es'),
  changes AS (SELECT user_id, entry_id, CASE WHEN o.h IS NULL THEN 'new' WHEN f.h IS NULL THEN 'deleted' ELSE 'changed' END AS change
  FROM old o FULL JOIN fresh f USING (user_id, entry_id) WHERE o.h IS DISTINCT FROM f.h)"""


def _changes(spark, d):
    entries = data.entries(spark, d)
    lang = F.col("tags")[0]
    hashed = lambda df: df.withColumn("content_hash", lc.entry_hash("title"))
    stored = hashed(entries.where(lang != "fr"))
    fresh = hashed(entries.where(lang != "es").withColumn("title", F.when(lang == "en", F.concat("title", F.lit("!"))).otherwise(F.col("title"))))
    return entries, lc.refresh_incremental(fresh, stored)


@query("refresh_incremental", f"{_ENTRIES}, {_CHANGES} SELECT user_id, entry_id, change FROM changes")
def refresh_incremental(spark, d):
    return _changes(spark, d)[1].select("user_id", "entry_id", "change")


@query(
    "next_generations",
    f"""{_ENTRIES}, {_CHANGES}, homes AS (SELECT user_id, entry_id, unnest(collections) AS c FROM entries)
    SELECT user_id, c AS collection_id, 3 + max(CASE WHEN change IS NULL THEN 0 ELSE 1 END) AS index_generation
    FROM homes LEFT JOIN changes USING (user_id, entry_id) GROUP BY ALL""",
)
def next_generations(spark, d):
    entries, changes = _changes(spark, d)
    homes = entries.select("app_id", "user_id", "entry_id", F.explode("collections").alias("collection_id"))
    known = store.collection_catalog(entries).select("app_id", "user_id", "collection_id", F.lit(3).alias("index_generation"))
    return lc.next_generations(known, changes, homes).drop("app_id")


@query(
    "plan_refresh",
    """SELECT 'c' || conv_id AS user_id, count(*) AS entries, CASE WHEN conv_id % 3 = 0 THEN 'refresh' ELSE 'init' END AS action,
    count(*) >= 3 AS cluster_first FROM conversations GROUP BY conv_id""",
)
def plan_refresh(spark, d):
    scopes = data.activities(spark, d).groupBy("app_id", "user_id").agg(F.count("*").alias("entries"))
    number = F.substring("user_id", 2, 9).cast("long")
    status = scopes.where(number % 3 != 2).select("app_id", "user_id", F.when(number % 3 == 0, 4).alias("catalysts"))
    return lc.plan_refresh(scopes, status).drop("app_id")


_FRESH = """given AS ({entries}), entries AS (
  SELECT * REPLACE (CASE WHEN user_id IN ('u0', 'u1') AND lang = 'en' THEN title || '!' ELSE title END AS title,
    row_number() OVER (PARTITION BY user_id ORDER BY seq) - 1 AS entry_index) FROM given WHERE user_id NOT IN ('u0', 'u1') OR lang <> 'fr')""".format(
    entries=data.ENTRIES_SQL.removeprefix("entries AS (").removesuffix(")")
)


@query(
    "run_refresh",
    f"""WITH RECURSIVE {DOC_SIMS.replace(data.ENTRIES_SQL, _FRESH)}, {BEST_CLUSTERS},
    tagged AS (SELECT e.user_id, e.entry_id, title, lang, folder, collections, cluster_id FROM entries e LEFT JOIN best USING (user_id, entry_index)),
    found AS (SELECT user_id, count(*) AS entries, count(DISTINCT lang) + count(DISTINCT cluster_id) AS labels FROM tagged GROUP BY ALL),
    folders AS (SELECT user_id, count(DISTINCT f) AS folders FROM (SELECT user_id, folder AS f FROM tagged UNION ALL SELECT user_id, unnest(collections) FROM tagged) GROUP BY ALL)
    SELECT user_id, entry_id, title, lang || CASE WHEN cluster_id IS NULL THEN '' ELSE ',' || cluster_id END AS tags,
      CASE WHEN user_id IN ('u0', 'u1') THEN 'refresh' ELSE 'init' END AS action, true AS clustered, entries, labels + folders AS catalysts
    FROM tagged JOIN found USING (user_id) JOIN folders USING (user_id)
    UNION ALL SELECT 'u9', '', '', '', 'init', false, 0, 0""",
)
def run_refresh(spark, d):
    """All users are indexed; then two of them come again, changed, with a third who has nothing."""
    path = scratch_path(spark, "refreshed")
    fixed = {"k": 8, "min_similarity": 0.7, "min_cluster_size": 3, "resolution": 0.0}
    entries = data.entries(spark, d).drop("links")
    refresh.run_refresh(spark, path, entries, **fixed)
    lang = F.col("tags")[0]
    fresh = entries.where("user_id IN ('u0', 'u1')").where(lang != "fr")
    fresh = fresh.withColumn("title", F.when(lang == "en", F.concat("title", F.lit("!"))).otherwise(F.col("title")))
    users = spark.range(10).where("id IN (0, 1, 9)").select(F.lit("notes").alias("app_id"), F.concat(F.lit("u"), "id").alias("user_id"))
    refresh.run_refresh(spark, path, fresh, users, **fixed)
    now = generations.open_store(spark, path)
    shown = now.table("entries").select("app_id", "user_id", "entry_id", "title", F.array_join("tags", ",").alias("tags"))
    both = now.table("outcome").join(shown, ["app_id", "user_id"], "left").fillna("", ["entry_id", "title", "tags"])
    return both.select("user_id", "entry_id", "title", "tags", "action", "clustered", "entries", "catalysts")


@query(
    "refresh_stream",
    f"""SELECT 'u' || user_id AS user_id, 'folder:' || event_type AS catalyst_id, count(*) AS entries, sum(count(*)) OVER (PARTITION BY user_id)::BIGINT AS of_user
    FROM events WHERE {_GATE} GROUP BY user_id, event_type""",
)
def refresh_stream(spark, d):
    """Saves arrive in three batches; the index follows in its own query."""
    path, index = scratch_path(spark, "stream-saves"), scratch_path(spark, "stream-index")
    stream = _save_stream(spark, d, "gated")
    st.stream_saves(stream, _connected(spark, d), path, scratch_path(spark, "cp")).awaitTermination()
    st.refresh_stream(spark, path, index, scratch_path(spark, "cp"), files=2, cluster=False).awaitTermination()
    now = generations.open_store(spark, index)
    whole = now.table("outcome").select("app_id", "user_id", F.col("entries").alias("of_user"))
    return now.table("catalysts").join(whole, ["app_id", "user_id"]).select("user_id", "catalyst_id", "entries", "of_user")


@query(
    "search_saved",
    """SELECT 'u' || user_id AS user_id, 'event-' || event_id AS entry_id, event_type || ' ' || event_id AS title FROM events""",
)
def search_saved(spark, d):
    """Entries are indexed in the micro-batch that stores them; searched are all of them, through their folders."""
    path, index = scratch_path(spark, "ingest-stream"), scratch_path(spark, "ingest-index")
    st.ingest_stream(_save_stream(spark, d, "saves"), path, scratch_path(spark, "cp"), index).awaitTermination()
    found = refresh.searchable(generations.open_store(spark, index))
    reached = found.documents.select("app_id", "user_id", "entry_id").distinct()
    return found.entries.join(reached, ["app_id", "user_id", "entry_id"]).select("user_id", "entry_id", "title")


@query(
    "replace_sections",
    f"""{_ENTRIES}, placed AS (SELECT user_id, seq, unnest(collections) AS c FROM entries WHERE user_id <> 'u3'),
    runs AS (SELECT *, CASE WHEN user_id = 'u0' THEN 'relational' ELSE 'reflective' END AS p FROM placed WHERE user_id = 'u0' OR seq % 3 > 0)
    SELECT user_id, 'folder:' || c AS entity_ref, coalesce(max(p) FILTER (c LIKE 'box/%'), '') AS profile, min(seq) AS first_seq FROM runs GROUP BY user_id, c""",
)
def replace_sections(spark, d):
    """Sections of two users are written, then those of one of them and a third with other entries and profiles."""
    path = scratch_path(spark, "sections")
    entries = data.entries(spark, d)
    boxes = entries.select(F.explode("collections").alias("collection_id")).where("collection_id LIKE 'box/%'").distinct()
    for users, profile, rows in ((["u0", "u1"], "relational", "true"), (["u1", "u2"], "reflective", "seq % 3 > 0")):
        mine = entries.where(F.col("user_id").isin(users))
        made = refresh.sections(mine.where(rows), boxes.withColumn("profile", F.lit(profile)))
        generations.commit(spark, path, {"sections": made}, mine)
    generations.compact(spark, path)
    return generations.open_store(spark, path).table("sections").select("user_id", "entity_ref", F.coalesce("profile", F.lit("")).alias("profile"), "first_seq")


_LOG_SQL = """ends AS (SELECT user_id, max(seq) // 2 AS half, max(seq) + 1 AS last FROM entries GROUP BY user_id),
log AS (
  SELECT user_id, unnest(['empty', 'lang-fr', 'dropped']) AS collection_id, -1 AS seq, 'create' AS op FROM ends
  UNION ALL SELECT user_id, unnest(['lang-fr', 'box/src3', 'dropped', 'again']), half, 'delete' FROM ends
  UNION ALL SELECT user_id, 'again', last, 'create' FROM ends)"""


@query(
    "collection_log",
    f"""{_ENTRIES}, {_LOG_SQL}, states AS (SELECT user_id, collection_id, max(seq) FILTER (op = 'create') AS made, max(seq) FILTER (op = 'delete') AS gone,
      count(*) FILTER (op = 'delete') AS generation FROM log GROUP BY ALL),
    placed AS (SELECT user_id, seq, unnest(collections) AS collection_id FROM entries),
    seen AS (SELECT p.* FROM placed p LEFT JOIN states s USING (user_id, collection_id) WHERE gone IS NULL OR p.seq > gone),
    docs AS (SELECT user_id, collection_id, count(*) AS documents FROM seen GROUP BY ALL),
    shown AS (SELECT user_id, count(DISTINCT seq) AS visible FROM seen GROUP BY ALL)
    SELECT user_id, collection_id, coalesce(generation, 0) AS generation, coalesce(documents, 0) AS documents, visible
    FROM states FULL JOIN docs USING (user_id, collection_id) JOIN shown USING (user_id) WHERE documents IS NOT NULL OR made > coalesce(gone, -2)""",
)
def collection_log(spark, d):
    """Collections created, filled, deleted half way and created again."""
    entries = data.entries(spark, d)
    ends = entries.groupBy("app_id", "user_id").agg(F.max("seq").alias("last"))
    event = lambda op, seq, *names: [F.struct(F.lit(n).alias("collection_id"), seq.alias("seq"), F.lit(op).alias("op")) for n in names]
    half, last = F.floor(F.col("last") / 2), F.col("last") + 1
    first = F.lit(-1).cast("long")
    events = event("create", first, "empty", "lang-fr", "dropped") + event("delete", half, "lang-fr", "box/src3", "dropped", "again") + event("create", last, "again")
    log = ends.select("app_id", "user_id", F.explode(F.array(*events)).alias("e")).select("app_id", "user_id", "e.*")
    visible = store.visible_entries(entries, log).groupBy("app_id", "user_id").agg(F.count("*").alias("visible"))
    return store.collections_by_log(entries, log).join(visible, ["app_id", "user_id"]).select("user_id", "collection_id", "generation", "documents", "visible")


@query(
    "upsert_patch_delete",
    """WITH log AS (SELECT event_id AS seq, user_id, event_id % 7 AS item,
      CASE WHEN event_type IN ('view', 'click') THEN 'patch' WHEN event_type = 'error' THEN 'delete' ELSE 'create' END AS op,
      CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type || event_id END AS title, CASE WHEN event_id % 5 <> 0 THEN props END AS content FROM events),
    since AS (SELECT user_id, item, max(seq) AS since FROM log WHERE op <> 'patch' GROUP BY ALL),
    alive AS (SELECT s.user_id, s.item, s.since FROM since s JOIN log l ON l.seq = s.since WHERE l.op = 'create')
    SELECT 'u' || a.user_id AS user_id, a.item, coalesce(arg_max(l.title, l.seq) FILTER (l.title IS NOT NULL), '') AS title,
      coalesce(arg_max(l.content, l.seq) FILTER (l.content IS NOT NULL), '') AS content, max(l.seq) AS seq
    FROM alive a JOIN log l ON l.user_id = a.user_id AND l.item = a.item AND l.seq >= a.since GROUP BY a.user_id, a.item""",
)
def upsert_patch_delete(spark, d):
    kind = F.col("event_type")
    op = F.when(kind.isin("view", "click"), "patch").when(kind == "error", "delete").otherwise("create")
    log = data.table(spark, d, "events").select(
        F.col("event_id").alias("seq"), F.concat(F.lit("u"), "user_id").alias("user_id"), (F.col("event_id") % 7).alias("item"), op.alias("op"),
        F.when(F.col("event_id") % 3 != 0, F.concat("event_type", "event_id")).alias("title"),
        F.when(F.col("event_id") % 5 != 0, F.col("props")).alias("content"),
    )
    return lc.upsert_patch_delete(log, ["user_id", "item"], ["title", "content"]).fillna({"title": "", "content": ""})


@query(
    "chunk_and_hash",
    rf"""{_ENTRIES}, w AS (SELECT user_id, entry_id, string_split(trim(regexp_replace(title || ' ' || content, '\s+', ' ', 'g')), ' ') AS ws FROM entries),
    c AS (SELECT *, unnest(range(0, greatest(0, ceil((len(ws) - 200) / 160.0))::BIGINT + 1)) AS chunk_no FROM w)
    SELECT user_id, entry_id, chunk_no, sha256(array_to_string(ws[chunk_no * 160 + 1 : chunk_no * 160 + 200], ' ')) AS chunk_hash FROM c""",
)
def chunk_and_hash(spark, d):
    return lc.chunk_and_hash(data.entries(spark, d)).select(
        "user_id", "entry_id", F.col("chunk_no").cast("long").alias("chunk_no"), "chunk_hash"
    )


@query(
    "snapshot_reuse",
    f"""{_ENTRIES}, h AS (SELECT user_id, count(*) AS documents,
      sum(('0x' || substr(sha256('=' || title || chr(10) || '=' || content), 1, 12))::BIGINT)::VARCHAR AS snapshot FROM entries GROUP BY user_id)
    SELECT user_id, documents, snapshot, user_id IN ('u0', 'u3') AS reuse FROM h""",
)
def snapshot_reuse(spark, d):
    entries = data.entries(spark, d)
    fields = ["title", "content"]
    user = F.col("user_id")
    stored = lc.snapshot_headers(entries, fields).withColumns(
        {
            "catalysts": F.when(user == "u1", 0).otherwise(5),
            "snapshot": F.when(user == "u2", F.lit("other")).otherwise(F.col("snapshot")),
        }
    )
    return lc.snapshot_reuse(entries, stored, fields).drop("app_id")
