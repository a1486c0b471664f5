"""Queries over vectors, neighbour graphs, communities, clusters and tags."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenfold.functions import vectors as vx
from lumenfold.operators import clusters as cl
from lumenfold.operators import communities as cm
from lumenfold.operators import embed, graph, labels, shape, sweep
from lumenfold.plans import data
from lumenfold.plans.registry import query
from lumenfold.schema import SCOPE, SWEEP
from lumenfold.session import materialize, scratch_path
from lumenfold.sources import store
from lumenfold.streaming import saves as st

DIM = 512
_TEXT = "title || ' ' || content"


def embedded_sql(dim: int = DIM) -> str:
    """Entries and their hashed word vectors ``dv(…, entry_id, slot, v)``."""
    return (
        f"{data.ENTRIES_SQL}, {data.slots_sql('slots', 'entries', 'entry_id', _TEXT, dim)}, "
        f"{data.rarity_sql('slots', 'entries')}, {data.vectors_sql('dv', 'slots', 'entry_id')}"
    )


def documents(spark, d):
    """Document entries with their index."""
    return shape.resolve_entry_id(data.entries(spark, d).drop("entry_id")).drop("portable_id")


# --- vectors ----------------------------------------------------------------


@query("embed_entries", f"WITH {embedded_sql()} SELECT user_id, entry_id, slot, round(v, 6) AS weight FROM dv WHERE v > 0")
def embed_entries(spark, d):
    vectors = embed.embed_entries(data.entries(spark, d), dim=DIM)
    rows = vectors.select("user_id", "entry_id", F.posexplode("vector").alias("slot", "weight"))
    return rows.where("weight > 0").select(
        "user_id", "entry_id", F.col("slot").cast("long").alias("slot"), F.round(F.col("weight").cast("double"), 6).alias("weight")
    )


@query(
    "normalize_vectors",
    f"WITH {data.VECTORS_SQL} SELECT entry_id, unnest(range(0, len(v))) AS pos, round(unnest(v), 6) + 0.0 AS value FROM vecs",
)
def normalize_vectors(spark, d):
    unit = embed.normalize_vectors(data.vectors(spark, d))
    rows = unit.select("entry_id", F.posexplode("vector").alias("pos", "value"))
    return rows.select("entry_id", F.col("pos").cast("long").alias("pos"), (F.round(F.col("value").cast("double"), 6) + F.lit(0.0)).alias("value"))


@query(
    "check_vectors",
    """SELECT 'u' || (doc_id % 4) AS user_id, count(*) AS expected, count(vec_id) AS items, coalesce(min(len(embedding)), 0)::BIGINT AS shortest,
    coalesce(max(len(embedding)), 0)::BIGINT AS longest FROM documents LEFT JOIN embeddings ON vec_id = doc_id GROUP BY ALL""",
)
def check_vectors(spark, d):
    entries = data.entries(spark, d)
    given = data.vectors(spark, d).withColumns({"app_id": F.lit("notes"), "entry_id": F.concat(F.lit("doc-"), "seq")})
    return embed.check_vectors(entries, given).select(
        "user_id", "expected", "items", F.col("shortest").cast("long").alias("shortest"), F.col("longest").cast("long").alias("longest")
    )


_SIMS = f"""WITH {data.VECTORS_SQL}, sims AS MATERIALIZED (
  SELECT a.user_id, a.entry_index AS src, b.entry_index AS dst, round(list_dot_product(a.v, b.v), 9) AS sim
  FROM vecs a JOIN vecs b ON a.user_id = b.user_id AND a.entry_index <> b.entry_index),
knn AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY user_id, src ORDER BY sim DESC, dst) AS rank FROM sims QUALIFY rank <= 10),
edges AS (SELECT a.user_id, a.src, a.dst, a.sim AS w FROM knn a JOIN knn b ON a.user_id = b.user_id AND a.src = b.dst AND a.dst = b.src
  WHERE a.src < a.dst AND a.sim >= 0.25)"""


def _unit(spark, d):
    return embed.normalize_vectors(data.vectors(spark, d))


@query("cosine_pairs", f"{_SIMS} SELECT user_id, src, dst, round(sim, 6) AS sim FROM sims WHERE src < dst AND sim >= 0.2")
def cosine_pairs(spark, d):
    return graph.cosine_pairs(_unit(spark, d), 0.2).select("user_id", "src", "dst", F.round("sim", 6).alias("sim"))


@query("knn_topk", f"{_SIMS} SELECT user_id, src, dst, rank, round(sim, 6) AS sim FROM knn")
def knn_topk(spark, d):
    knn = graph.knn_topk(_unit(spark, d), 10)
    return knn.select("user_id", "src", "dst", F.col("rank").cast("long").alias("rank"), F.round("sim", 6).alias("sim"))


def _edges(spark, d):
    return graph.mutual_edges(graph.knn_topk(_unit(spark, d), 10, 0.25), 0.25)


@query("mutual_edges", f"{_SIMS} SELECT user_id, src, dst, round(w, 6) AS w FROM edges")
def mutual_edges(spark, d):
    return _edges(spark, d).select("user_id", "src", "dst", F.round("w", 6).alias("w"))


# --- communities and sweep --------------------------------------------------

_COMPONENTS = """twoway AS (SELECT user_id, src, dst FROM edges UNION ALL SELECT user_id, dst, src FROM edges),
reach AS (SELECT DISTINCT user_id, src AS node, src AS other FROM twoway
  UNION SELECT r.user_id, r.node, b.dst FROM reach r JOIN twoway b ON b.user_id = r.user_id AND b.src = r.other),
placed AS (SELECT user_id, node, min(other) AS community FROM reach GROUP BY ALL)"""


@query("detect_communities", f"{_SIMS.replace('WITH', 'WITH RECURSIVE', 1)}, {_COMPONENTS} SELECT user_id, node, community FROM placed")
def detect_communities(spark, d):
    """At resolution 0 every connected component is one community, which SQL can check."""
    return cm.detect_communities(_edges(spark, d), SCOPE, resolution=0.0).drop("app_id")


@query(
    "check_communities",
    f"""{_SIMS} SELECT user_id, count(DISTINCT node) AS nodes, 0 AS improving, 0 AS across, true AS better
    FROM (SELECT user_id, src AS node FROM edges UNION ALL SELECT user_id, dst FROM edges) GROUP BY user_id""",
)
def check_communities(spark, d):
    """Of communities at resolution 1: nodes that one move would improve, communities that reach over
    components, and whether the quality is at least that of the components."""
    edges = materialize(_edges(spark, d), "edges")
    placed = materialize(cm.detect_communities(edges, SCOPE, resolution=1.0), "placed")
    flip = edges.select(*SCOPE, F.col("dst").alias("src"), F.col("src").alias("dst"))
    whole = cm.connected_components(edges.select(*SCOPE, "src", "dst").unionByName(flip), placed, SCOPE)
    both = placed.join(whole.select(*SCOPE, "node", "component"), [*SCOPE, "node"])
    spread = both.groupBy(*SCOPE, "community").agg(F.count_distinct("component").alias("parts"), F.count("*").alias("nodes"))
    sums = spread.groupBy(*SCOPE).agg(F.sum("nodes").alias("nodes"), F.sum((F.col("parts") > 1).cast("int")).alias("across"))
    open_ = cm.improving_moves(edges, placed, SCOPE, 1.0).groupBy(*SCOPE).agg(F.count("*").alias("improving"))
    found = cm.quality(edges, placed, SCOPE, 1.0).withColumnRenamed("quality", "found")
    plain = cm.quality(edges, whole.withColumnRenamed("component", "community"), SCOPE, 1.0)
    joined = sums.join(open_, SCOPE, "left").join(found, SCOPE).join(plain, SCOPE)
    return joined.select(
        "user_id", "nodes", F.coalesce("improving", F.lit(0)).cast("int").alias("improving"), F.col("across").cast("int").alias("across"),
        (F.col("found") >= F.col("quality") - 1e-9).alias("better"),
    )


@query("detect_communities_resolution")
def detect_communities_resolution(spark, d):
    return cm.detect_communities(_edges(spark, d), SCOPE, resolution=1.0).drop("app_id")


def _label_members(spark, d):
    """Labels of the given vectors as a partition: ``(cluster, entry_index)`` with clusters numbered by first member."""
    placed = data.vectors(spark, d).select(*SCOPE, F.col("entry_index").alias("node"), F.col("label").alias("community"))
    kept = cm.filter_communities(placed, SCOPE, 10)
    return placed.join(kept.select(*SCOPE, "community", "cluster_no"), [*SCOPE, "community"]).select(
        *SCOPE, "cluster_no", F.col("node").alias("entry_index")
    )


_LABELS = f"""WITH {data.VECTORS_SQL}, sized AS (SELECT user_id, label, count(*) AS size, min(entry_index) AS first_member FROM vecs GROUP BY ALL),
kept AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY first_member) AS cluster_no FROM sized WHERE size >= 10),
members AS (SELECT v.user_id, v.entry_id, v.entry_index, v.v, cluster_no FROM vecs v JOIN kept USING (user_id, label)),
cells AS (SELECT user_id, cluster_no, entry_index, unnest(range(0, len(v))) AS pos, unnest(v) AS x FROM members),
sums AS (SELECT user_id, cluster_no, pos, sum(x) AS s FROM cells GROUP BY ALL),
norms AS (SELECT user_id, cluster_no, sqrt(sum(s * s)) AS norm FROM sums GROUP BY ALL),
centroids AS (SELECT user_id, cluster_no, pos, (s / norm)::FLOAT::DOUBLE AS x FROM sums JOIN norms USING (user_id, cluster_no)),
ranked AS (SELECT m.user_id, m.cluster_no, m.entry_index, m.entry_id, round(list_dot_product(m.v, c.v), 9) AS similarity FROM members m JOIN
  (SELECT user_id, cluster_no, list(x ORDER BY pos) AS v FROM centroids GROUP BY ALL) c USING (user_id, cluster_no))"""


@query("filter_communities", f"{_LABELS} SELECT user_id, label AS community, size, first_member, cluster_no FROM kept")
def filter_communities(spark, d):
    placed = data.vectors(spark, d).select(*SCOPE, F.col("entry_index").alias("node"), F.col("label").alias("community"))
    return cm.filter_communities(placed, SCOPE, 10).drop("app_id")


_SIZES = """sizes AS (SELECT 'u' || (doc_id % 4) AS user_id, count(*) AS n FROM documents GROUP BY ALL
  UNION ALL SELECT 'c' || conv_id, count(*) FROM conversations GROUP BY ALL
  UNION ALL SELECT 'e' || user_id, count(*) FROM events GROUP BY ALL)"""


def _candidate_sql(granularity: str) -> str:
    rows = ", ".join(f"({i}, {r:.2f}::DOUBLE, {t:.2f}::DOUBLE)" for i, (r, t) in enumerate(SWEEP[granularity]))
    large = "least(greatest(round_even(sqrt(n) / 6, 0), 4), 6)" if granularity == "fine" else "least(greatest(round_even(sqrt(n) / 2, 0), 4), 12)"
    return f"""SELECT '{granularity}' AS granularity, user_id, n, candidate_id, resolution, min_similarity,
      least(greatest(round_even(sqrt(n), 0), 2), 24)::BIGINT AS k,
      (CASE WHEN n < 40 THEN 2 WHEN n < 500 THEN {4 if granularity == "fine" else 5} ELSE {large} END)::BIGINT AS min_cluster_size
      FROM sizes, (VALUES {rows}, (6, 1.20::DOUBLE, 0.45::DOUBLE)) t(candidate_id, resolution, min_similarity) WHERE candidate_id < 6 OR n < 50"""


@query("param_candidates", f"WITH {_SIZES} {_candidate_sql('balanced')} UNION ALL {_candidate_sql('fine')}")
def param_candidates(spark, d):
    def size(df, prefix, key):
        return df.groupBy(F.lit("app").alias("app_id"), F.concat(F.lit(prefix), key).alias("user_id")).agg(F.count("*").alias("n"))

    sizes = (
        size(data.table(spark, d, "documents"), "u", F.col("doc_id") % 4)
        .unionByName(size(data.table(spark, d, "conversations"), "c", F.col("conv_id")))
        .unionByName(size(data.table(spark, d, "events"), "e", F.col("user_id")))
    )
    both = [sweep.param_candidates(sizes, g).withColumn("granularity", F.lit(g)) for g in SWEEP]
    return both[0].unionByName(both[1]).select(
        "granularity", "user_id", "n", "candidate_id", "resolution", "min_similarity",
        F.col("k").cast("long").alias("k"), F.col("min_cluster_size").cast("long").alias("min_cluster_size"),
    )


_CANDIDATES = 6
_RANGE = lambda v, low, high: (
    f"CASE WHEN {v} BETWEEN {low} AND {high} THEN 1.0 WHEN {v} < {low} THEN greatest(0.0, {v} / {low}) "
    f"ELSE greatest(0.0, 1.0 - ({v} - {high}) / greatest({high}, 1.0)) END"
)
_SCORED = f"""WITH {data.VECTORS_SQL}, n AS (SELECT user_id, count(*) AS n FROM vecs GROUP BY ALL),
cand AS (SELECT user_id, n, unnest([0, 1, 2, 3, 4, 5]) AS candidate_id, (CASE WHEN n < 40 THEN 2 WHEN n < 500 THEN 5 ELSE least(greatest(round_even(sqrt(n) / 2, 0), 4), 12) END)::BIGINT AS mcs FROM n),
setting(candidate_id, resolution, min_similarity) AS (VALUES {", ".join(f"({i}, {r}, {t})" for i, (r, t) in enumerate(SWEEP["balanced"]))}),
placed AS (SELECT v.user_id, candidate_id, entry_index, v, label % (candidate_id + 2) AS community, mcs FROM vecs v JOIN cand USING (user_id)),
sized AS (SELECT user_id, candidate_id, community, count(*) AS size FROM placed GROUP BY ALL HAVING count(*) >= max(mcs)),
members AS (SELECT p.* FROM placed p JOIN sized USING (user_id, candidate_id, community)),
pairs AS (SELECT a.user_id, a.candidate_id, a.community, avg(list_dot_product(a.v, b.v)) AS cohesion FROM members a JOIN members b
  ON a.user_id = b.user_id AND a.candidate_id = b.candidate_id AND a.community = b.community AND a.entry_index < b.entry_index GROUP BY ALL),
coh AS (SELECT user_id, candidate_id, sum(cohesion * size) / sum(size) AS cohesion FROM pairs JOIN sized USING (user_id, candidate_id, community) GROUP BY ALL),
shape AS (SELECT user_id, candidate_id, count(*) AS clusters, sum(size)::DOUBLE AS covered, max(size) AS largest,
  sum(CASE WHEN size <= greatest(mcs + 1, ceil(mcs * 1.35)) THEN 1 ELSE 0 END) AS tiny FROM sized JOIN cand USING (user_id, candidate_id) GROUP BY ALL),
pieces AS (SELECT user_id, candidate_id, clusters, cohesion, {_RANGE("clusters", "greatest(1.0, c * 0.55)", "least(45.0, c * 1.45)")} AS count_score,
  {_RANGE("covered / n", "0.30", "0.70")} AS coverage_score, tiny / clusters AS fragmentation,
  CASE WHEN largest / n > 0.25 THEN least(1.0, (largest / n - 0.25) / 0.5) ELSE 0.0 END AS giant
  FROM (SELECT *, greatest(2.0, least(30.0, sqrt(n))) AS c FROM shape JOIN cand USING (user_id, candidate_id) JOIN coh USING (user_id, candidate_id))),
scored AS (SELECT *, 1.2 * count_score + 1.4 * coverage_score + cohesion - 0.7 * fragmentation - 1.2 * giant AS score FROM pieces)"""


def _scored(spark, d):
    """Six partitions of the given vectors (labels folded to 2…7 values) scored as sweep candidates."""
    vectors = _unit(spark, d)
    sizes = vectors.groupBy(*SCOPE).agg(F.count("*").alias("n"))
    candidates = sweep.param_candidates(sizes).where(F.col("candidate_id") < _CANDIDATES)
    placed = vectors.select(*SCOPE, F.col("entry_index").alias("node"), "label").join(
        candidates.select(*sweep.CANDIDATE, "min_cluster_size"), SCOPE
    ).withColumn("community", F.col("label") % (F.col("candidate_id") + 2)).drop("label")
    kept = cm.filter_communities(placed, sweep.CANDIDATE)
    members = placed.join(kept.select(*sweep.CANDIDATE, "community"), [*sweep.CANDIDATE, "community"], "left_semi")
    return sweep.score_communities(candidates, kept, members.drop("min_cluster_size"), vectors)


@query(
    "score_communities",
    f"""{_SCORED} SELECT user_id, candidate_id, clusters, round(cohesion, 6) AS cohesion, round(count_score, 6)::DOUBLE AS count_score,
    round(coverage_score, 6)::DOUBLE AS coverage_score, round(fragmentation, 6)::DOUBLE AS fragmentation, round(giant, 6)::DOUBLE AS giant, round(score, 6)::DOUBLE AS score FROM scored""",
)
def score_communities(spark, d):
    names = ["cohesion", "count_score", "coverage_score", "fragmentation", "giant", "score"]
    return _scored(spark, d).select("user_id", "candidate_id", "clusters", *[F.round(n, 6).alias(n) for n in names])


@query(
    "select_params",
    f"""{_SCORED} SELECT user_id, candidate_id, round(score, 6)::DOUBLE AS score FROM scored JOIN setting USING (candidate_id)
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, min_similarity, resolution) = 1""",
)
def select_params(spark, d):
    return sweep.select_params(_scored(spark, d)).select("user_id", "candidate_id", F.round("score", 6).alias("score"))


# --- describing clusters ----------------------------------------------------


def _label_clusters(spark, d):
    vectors = _unit(spark, d)
    members = _label_members(spark, d)
    return vectors, members, cl.cluster_centroids(members, vectors)


@query("cluster_centroids", f"{_LABELS} SELECT user_id, cluster_no, pos, round(x, 6) + 0.0 AS value FROM centroids")
def cluster_centroids(spark, d):
    cells = _label_clusters(spark, d)[2].select("user_id", "cluster_no", F.posexplode("centroid").alias("pos", "value"))
    return cells.select("user_id", "cluster_no", F.col("pos").cast("long").alias("pos"), (F.round(F.col("value").cast("double"), 6) + F.lit(0.0)).alias("value"))


@query(
    "cluster_cohesion",
    f"""{_LABELS} SELECT a.user_id, a.cluster_no, round(avg(list_dot_product(a.v, b.v)), 6) + 0.0 AS cohesion FROM members a JOIN members b
    ON a.user_id = b.user_id AND a.cluster_no = b.cluster_no AND a.entry_index < b.entry_index GROUP BY ALL""",
)
def cluster_cohesion(spark, d):
    return _label_clusters(spark, d)[2].select("user_id", "cluster_no", (F.round("cohesion", 6) + F.lit(0.0)).alias("cohesion"))


@query(
    "cluster_representatives",
    f"""{_LABELS} SELECT user_id, cluster_no, row_number() OVER (PARTITION BY user_id, cluster_no ORDER BY similarity DESC, entry_index) AS rank,
    'Item ' || entry_id AS title, 'Item ' || entry_id AS text, entry_id, round(similarity, 6) + 0.0 AS similarity FROM ranked QUALIFY rank <= 5""",
)
def cluster_representatives(spark, d):
    vectors, members, centroids = _label_clusters(spark, d)
    ranked = cl.rank_members(members, vectors, centroids)
    entries = vectors.select(*SCOPE, "entry_index", F.concat(F.lit("Item "), "entry_id").alias("title"), F.col("entry_id").alias("portable_id"))
    reps = cl.cluster_representatives(entries, ranked)
    return reps.select("user_id", "cluster_no", F.posexplode("representatives").alias("pos", "r")).select(
        "user_id", "cluster_no", (F.col("pos") + 1).cast("long").alias("rank"), "r.title", "r.text", "r.entry_id",
        (F.round("r.similarity", 6) + F.lit(0.0)).alias("similarity"),
    )


def _folder_members(entries):
    """Documents partitioned by folder, clusters numbered by their first member."""
    placed = entries.select(*SCOPE, F.col("entry_index").alias("node"), F.col("folder").alias("community"))
    kept = cm.filter_communities(placed, SCOPE, 1)
    members = placed.join(kept.select(*SCOPE, "community", "cluster_no"), [*SCOPE, "community"]).select(
        *SCOPE, "cluster_no", F.col("node").alias("entry_index")
    )
    return members, kept.select(*SCOPE, "cluster_no", "size")


FOLDERS_SQL = """folders AS (SELECT user_id, folder, count(*) AS size, row_number() OVER (PARTITION BY user_id ORDER BY min(entry_index)) AS cluster_no
  FROM entries GROUP BY user_id, folder),
members AS (SELECT e.user_id, e.entry_index, f.cluster_no, f.size FROM entries e JOIN folders f USING (user_id, folder))"""


def contrast_sql(members: str, group: str) -> str:
    """CTEs up to ``contrast(user_id, group…, keywords)`` for ``members(user_id, entry_index, group…, size)``."""
    return f"""ewords AS (SELECT user_id, entry_index, unnest(list_distinct({data.words_sql(_TEXT)})) AS term FROM entries),
total AS (SELECT user_id, term, count(*) AS in_scope FROM ewords GROUP BY ALL), scope_n AS (SELECT user_id, count(*) AS n FROM entries GROUP BY ALL),
inside AS (SELECT user_id, {group}, term, max(size) AS size, count(*) AS inside FROM ewords JOIN {members} USING (user_id, entry_index) WHERE length(term) >= 3 GROUP BY ALL),
contrast_scored AS (SELECT i.*, round((inside / size) * ln((1.0 + size + greatest(1, n - size)) / (1.0 + in_scope - inside))
  + greatest(0.0, inside / size - (in_scope - inside) / greatest(1, n - size)), 9) AS score
  FROM inside i JOIN total USING (user_id, term) JOIN scope_n USING (user_id)),
contrast_top AS (SELECT *, row_number() OVER (PARTITION BY user_id, {group} ORDER BY score DESC, term) AS r FROM contrast_scored QUALIFY r <= 4),
contrast AS (SELECT user_id, {group}, list(term ORDER BY r) AS keywords FROM contrast_top GROUP BY ALL)"""


def _with_keywords(entries):
    lang = F.col("tags")[0]
    return entries.withColumns(
        {
            "keywords": F.array(F.concat(lang, F.lit(" notes")), F.lit(None).cast("string"), F.lit("")),
            "labels": F.when(lang == "en", F.lit("the")),
            "metadata": F.to_json(F.struct(F.array(lang, lang).alias("categories"), F.lit("all").alias("keywords"), F.lit("x").alias("labels"))),
        }
    )


_SOURCE_KEYWORDS = """terms AS (SELECT user_id, entry_index, unnest([lang || ' notes', lang, lang, 'all'] || CASE WHEN lang = 'en' THEN ['the'] ELSE [] END) AS term FROM entries),
term_counts AS (SELECT user_id, cluster_no, term, count(*) AS times FROM terms JOIN members USING (user_id, entry_index) WHERE term <> 'the' GROUP BY ALL),
term_top AS (SELECT *, row_number() OVER (PARTITION BY user_id, cluster_no ORDER BY times DESC, term) AS r FROM term_counts QUALIFY r <= 4),
source_keywords AS (SELECT user_id, cluster_no, list(term ORDER BY r) AS keywords FROM term_top GROUP BY ALL)"""


@query(
    "source_keywords",
    f"WITH {data.ENTRIES_SQL}, {FOLDERS_SQL}, {_SOURCE_KEYWORDS} SELECT user_id, cluster_no, array_to_string(keywords, '|') AS keywords FROM source_keywords",
)
def source_keywords(spark, d):
    entries = documents(spark, d)
    members, _ = _folder_members(entries)
    found = labels.source_keywords(_with_keywords(entries), members)
    return found.select("user_id", "cluster_no", F.array_join("keywords", "|").alias("keywords"))


@query(
    "contrast_keywords",
    f"WITH {data.ENTRIES_SQL}, {FOLDERS_SQL}, {contrast_sql('members', 'cluster_no')} SELECT user_id, cluster_no, array_to_string(keywords, '|') AS keywords FROM contrast",
)
def contrast_keywords(spark, d):
    entries = documents(spark, d)
    members, clusters = _folder_members(entries)
    # Title and content are the text here; the other text fields do not exist.
    found = labels.contrast_keywords(entries, members, clusters)
    return found.select("user_id", "cluster_no", F.array_join("keywords", "|").alias("keywords"))


@query(
    "title_keywords",
    f"""WITH {data.ENTRIES_SQL}, {FOLDERS_SQL}, tw AS (SELECT user_id, entry_index, n_chars, {data.words_sql("content")} AS ws FROM entries),
    places AS (SELECT user_id, entry_index, n_chars, unnest(ws) AS term, unnest(range(0, len(ws))) AS pos FROM tw),
    firsts AS (SELECT user_id, cluster_no, term, min((-n_chars, entry_index, pos)) AS place FROM places JOIN members USING (user_id, entry_index) GROUP BY ALL),
    tops AS (SELECT *, row_number() OVER (PARTITION BY user_id, cluster_no ORDER BY place) AS r FROM firsts QUALIFY r <= 4)
    SELECT user_id, cluster_no, string_agg(term, '|' ORDER BY r) AS keywords FROM tops GROUP BY ALL""",
)
def title_keywords(spark, d):
    """The whole text stands for the title, the text length for the closeness to the centroid."""
    entries = documents(spark, d)
    members, _ = _folder_members(entries)
    size = F.get_json_object("metadata", "$.n_chars").cast("double")
    ranked = members.join(entries.select(*SCOPE, "entry_index", size.alias("similarity")), [*SCOPE, "entry_index"])
    found = labels.title_keywords(entries.withColumn("title", F.col("content")), ranked)
    return found.select("user_id", "cluster_no", F.array_join("keywords", "|").alias("keywords"))




@query(
    "cluster_ids",
    f"""WITH {data.ENTRIES_SQL}, {FOLDERS_SQL}, {_SOURCE_KEYWORDS}, split AS (SELECT user_id, cluster_no, keywords,
      string_split(array_to_string(keywords, ' '), ' ') AS ws FROM source_keywords),
    dedup AS (SELECT user_id, cluster_no, list_filter(ws, lambda w, i: list_position(ws, w) = i)[1:4] AS ws FROM split),
    slugs AS (SELECT user_id, cluster_no, array_to_string(ws, '-') AS slug FROM dedup),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id, slug ORDER BY cluster_no) AS r FROM slugs)
    SELECT user_id, cluster_no, 'auto-theme-' || slug || CASE WHEN r > 1 THEN '-' || r ELSE '' END AS cluster_id FROM numbered""",
)
def cluster_ids(spark, d):
    entries = documents(spark, d)
    members, clusters = _folder_members(entries)
    named = clusters.join(labels.source_keywords(_with_keywords(entries), members), labels.CLUSTER)
    return labels.cluster_ids(named, " Auto Thémé! ").select("user_id", "cluster_no", "cluster_id")


# --- building and assigning -------------------------------------------------

DOC_SIMS = f"""{embedded_sql()}, dvi AS (SELECT dv.*, entry_index FROM dv JOIN entries USING (user_id, entry_id)),
sims AS (SELECT a.user_id, a.entry_index AS src, b.entry_index AS dst, round(sum(a.v * b.v), 9) AS sim FROM dvi a JOIN dvi b
  ON a.user_id = b.user_id AND a.slot = b.slot AND a.entry_index <> b.entry_index GROUP BY ALL),
knn AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY user_id, src ORDER BY sim DESC, dst) AS rank FROM sims QUALIFY rank <= 8),
edges AS (SELECT a.user_id, a.src, a.dst, a.sim AS w FROM knn a JOIN knn b ON a.user_id = b.user_id AND a.src = b.dst AND a.dst = b.src
  WHERE a.src < a.dst AND a.sim >= 0.7), {_COMPONENTS},
comp AS (SELECT user_id, community, count(*) AS size, row_number() OVER (PARTITION BY user_id ORDER BY community) AS cluster_no
  FROM placed GROUP BY user_id, community HAVING count(*) >= 3),
members AS (SELECT p.user_id, p.node AS entry_index, c.cluster_no, c.size FROM placed p JOIN comp c USING (user_id, community)),
csum AS (SELECT user_id, cluster_no, slot, sum(v) AS s FROM members JOIN dvi USING (user_id, entry_index) GROUP BY ALL),
cnorm AS (SELECT user_id, cluster_no, sqrt(sum(s * s)) AS norm FROM csum GROUP BY ALL),
cvec AS (SELECT user_id, cluster_no, slot, (s / norm)::FLOAT::DOUBLE AS v FROM csum JOIN cnorm USING (user_id, cluster_no)),
csq AS (SELECT user_id, cluster_no, sum(v * v) AS sq FROM members JOIN dvi USING (user_id, entry_index) GROUP BY ALL),
{contrast_sql("members", "cluster_no")},
built AS (SELECT c.user_id, c.cluster_no, c.size, (norm * norm - sq) / (c.size * (c.size - 1)) AS cohesion, keywords,
  array_to_string(keywords, '-') AS slug FROM comp c JOIN cnorm USING (user_id, cluster_no) JOIN csq USING (user_id, cluster_no) JOIN contrast USING (user_id, cluster_no)),
ided AS (SELECT *, row_number() OVER (PARTITION BY user_id, left(slug, 48) ORDER BY cluster_no) AS r FROM built),
index_rows AS (SELECT *, 'auto-cluster-' || rtrim(left(slug, 48), '-') || CASE WHEN r > 1 THEN '-' || r ELSE '' END AS cluster_id FROM ided)"""


BEST_CLUSTERS = """hits AS (SELECT user_id, entry_index, cluster_id, round(sum(d.v * c.v), 9) AS sim FROM dvi d
      JOIN cvec c USING (user_id, slot) JOIN index_rows USING (user_id, cluster_no) GROUP BY ALL HAVING round(sum(d.v * c.v), 9) >= 0.7),
    best AS (SELECT *, row_number() OVER (PARTITION BY user_id, entry_index ORDER BY sim DESC, cluster_id) AS r FROM hits QUALIFY r = 1)"""


def _fixed(spark, d):
    entries = data.entries(spark, d).drop("links")
    return cl.build_cluster_index(entries, k=8, min_similarity=0.7, min_cluster_size=3, resolution=0.0)


@query(
    "build_cluster_index",
    f"""WITH RECURSIVE {DOC_SIMS} SELECT user_id, cluster_no, cluster_id, array_to_string(keywords, '|') AS keywords, size, round(cohesion, 6) AS cohesion FROM index_rows""",
)
def build_cluster_index(spark, d):
    """Fixed settings with resolution 0, so that SQL can rebuild the same communities."""
    return _fixed(spark, d).clusters.select(
        "user_id", "cluster_no", "cluster_id", F.array_join("keywords", "|").alias("keywords"), "size", F.round("cohesion", 6).alias("cohesion")
    )


@query("build_cluster_index_sweep")
def build_cluster_index_sweep(spark, d):
    """Settings chosen per scope by the scored sweep."""
    index = cl.build_cluster_index(data.entries(spark, d))
    return index.clusters.join(index.header, SCOPE).select(
        "user_id", "cluster_no", "cluster_id", F.array_join("keywords", "|").alias("keywords"), "size",
        F.round("cohesion", 6).alias("cohesion"), "assignment_min_similarity",
    )


@query(
    "cluster_entries",
    f"""WITH RECURSIVE {DOC_SIMS}, {BEST_CLUSTERS}
    SELECT e.user_id, e.entry_id, lang || CASE WHEN cluster_id IS NULL THEN '' ELSE ',' || cluster_id END AS tags FROM entries e LEFT JOIN best USING (user_id, entry_index)""",
)
def cluster_entries(spark, d):
    entries = data.entries(spark, d).drop("links")
    tagged = cl.cluster_entries(entries, k=8, min_similarity=0.7, min_cluster_size=3, resolution=0.0).entries
    return tagged.select("user_id", "entry_id", F.array_join("tags", ",").alias("tags"))


def _label_index(spark, d):
    """Label centroids of the given vectors as a cluster index with threshold 0.25."""
    vectors, _, centroids = _label_clusters(spark, d)
    empty = F.array().cast("array<string>")
    rows = centroids.select(
        *SCOPE, "cluster_no", F.concat(F.lit("auto-cluster-c"), "cluster_no").alias("cluster_id"),
        F.col("centroid").alias("embedding"), empty.alias("keywords"), "size", "cohesion",
    )
    header = rows.select(*SCOPE).distinct().select(
        *SCOPE, F.lit("given").alias("model"), F.lit(64).alias("dimension"), F.lit("auto-cluster").alias("id_prefix"),
        F.lit(0.25).alias("assignment_min_similarity"),
    )
    return vectors, cl.ClusterIndex(header, rows)


_ASSIGNED = f"""{_LABELS}, cents AS (SELECT user_id, cluster_no, list(x ORDER BY pos) AS c FROM centroids GROUP BY ALL),
hits AS (SELECT v.user_id, v.entry_index, v.entry_id, 'auto-cluster-c' || cluster_no AS cluster_id, round(list_dot_product(v.v, c.c), 9) AS sim
  FROM vecs v JOIN cents c USING (user_id)),
assigned AS (SELECT *, row_number() OVER (PARTITION BY user_id, entry_index ORDER BY sim DESC, cluster_id) AS rank FROM hits WHERE sim >= 0.25 QUALIFY rank <= 2)"""


@query("assign_clusters", f"{_ASSIGNED} SELECT user_id, entry_index, entry_id, cluster_id, rank, round(sim, 6) AS similarity FROM assigned")
def assign_clusters(spark, d):
    vectors, index = _label_index(spark, d)
    found = cl.assign_clusters(vectors, index, max_clusters_per_entry=2)
    return found.select(
        "user_id", "entry_index", "entry_id", "cluster_id", F.col("rank").cast("long").alias("rank"), F.round("similarity", 6).alias("similarity")
    )


_TAGGED = """SELECT v.user_id, v.entry_id, coalesce((CASE WHEN label % 2 = 0 THEN 'own,auto-cluster-c1' ELSE '' END) ||
  (CASE WHEN label % 2 = 0 AND added <> '' THEN ',' ELSE '' END) || added, '') AS tags
FROM vecs v LEFT JOIN (SELECT v.user_id, v.entry_index, coalesce(string_agg(a.cluster_id, ',' ORDER BY a.rank) FILTER (v.label % 2 = 1 OR a.cluster_id <> 'auto-cluster-c1'), '') AS added
  FROM vecs v LEFT JOIN assigned a USING (user_id, entry_index) GROUP BY ALL) t USING (user_id, entry_index)"""


def _own_tags(df):
    return F.when(F.col("label") % 2 == 0, F.array(F.lit("own"), F.lit("auto-cluster-c1")))


@query("append_tags", f"{_ASSIGNED} {_TAGGED}")
def append_tags(spark, d):
    vectors, index = _label_index(spark, d)
    found = cl.assign_clusters(vectors, index, max_clusters_per_entry=2)
    entries = vectors.select(*SCOPE, "entry_index", "entry_id", "label").withColumn("tags", _own_tags(vectors))
    tagged = cl.append_tags(entries, found)
    return tagged.select("user_id", "entry_id", F.coalesce(F.array_join("tags", ","), F.lit("")).alias("tags"))


@query("assign_stream", f"{_ASSIGNED} {_TAGGED}")
def assign_stream(spark, d):
    """The given vectors' entries arrive as three files and are tagged batch by batch."""
    vectors, index = _label_index(spark, d)
    stored_index = scratch_path(spark, "index")
    store.save_index(index, stored_index)
    entries = vectors.select(*SCOPE, "seq", F.col("entry_id").alias("id"), "label").withColumn("tags", _own_tags(vectors))
    arriving, out = scratch_path(spark, "arriving"), scratch_path(spark, "tagged")
    entries.repartitionByRange(3, "seq").write.parquet(arriving)
    stream = spark.readStream.schema(entries.schema).option("maxFilesPerTrigger", 1).parquet(arriving)
    static = vectors.select(*SCOPE, "entry_id", "model", "vector")
    st.assign_stream(
        stream, store.load_index(spark, stored_index), static, out, scratch_path(spark, "cp"), max_clusters_per_entry=2
    ).awaitTermination()
    tagged = spark.read.parquet(f"{out}/tagged")
    return tagged.select("user_id", "entry_id", F.coalesce(F.array_join("tags", ","), F.lit("")).alias("tags"))


@query(
    "cluster_index_roundtrip",
    f"""{_LABELS} SELECT user_id, cluster_no, 'auto-cluster-c' || cluster_no AS cluster_id, round(sum(x * x), 6) AS length, max(k.size) AS size,
    '' AS model, 0::BIGINT AS dimension, 'auto-cluster' AS id_prefix, 0.25::DOUBLE AS assignment_min_similarity
    FROM centroids JOIN kept k USING (user_id, cluster_no) GROUP BY user_id, cluster_no""",
)
def cluster_index_roundtrip(spark, d):
    """Saved without model and dimension, so that loading fills in the defaults."""
    _, index = _label_index(spark, d)
    path = scratch_path(spark, "index")
    store.save_index(cl.ClusterIndex(index.header.drop("model", "dimension"), index.clusters), path)
    loaded = store.load_index(spark, path)
    return loaded.clusters.join(loaded.header, SCOPE).select(
        "user_id", "cluster_no", "cluster_id", F.round(vx.squared_length(F.col("embedding")), 6).alias("length"), "size",
        "model", F.col("dimension").cast("long").alias("dimension"), "id_prefix", "assignment_min_similarity",
    )
