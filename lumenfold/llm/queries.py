"""The registered queries of this package and their SQL."""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenfold.llm import chat, exact_dedup, mixing, ngram_join, packing, pieces, pii, quality, resharding, secrets, spelling, toxicity, whitening

#: Public model files; the driver reads them and sends them to the tasks.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_IDS = "/opt/tokenizers/byte_bpe_50k.json"
#: A key for the tables of the tests; a user passes their own.
PSEUDONYM_KEY = b"key for given tables"

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


WORDS_SQL = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"


@query(
    "op1_ngram_join",
    rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)] END) AS gram FROM d
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS met FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * met >= 90 * (x.n + y.n - met)
), sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, sides.b FROM reach JOIN sides ON sides.a = reach.other
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
)
def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents linked at three words and 0.9."""
    return ngram_join.jaccard_components(documents(spark, folder), words=3, percent=90, counted=False)


@query("op3_pieces")
def op3_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document's best pieces, and whether they decode to its text."""
    return pieces.encode(documents(spark, folder).select("doc_id", "text"), pieces.read_model(PIECES))


@query("op4_resharding")
def op4_resharding(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of 12 shards by text, moved to 16 shards of equal bytes; read from the rewritten files."""
    docs = documents(spark, folder)
    old = F.pmod(F.crc32(F.coalesce("text", F.lit("")).cast("binary")), F.lit(12))
    done = resharding.reshard(docs, old, 12, 16)
    return done.rows.select(
        F.col("id").alias("doc_id"),
        resharding.text_bytes(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "moved",
    )


@query("op5_quality")
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, base verdict and weakly supervised verdict of every document."""
    found = quality.judged(documents(spark, folder), keep=["doc_id"])
    counts = [F.col(f"q.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return found.select("doc_id", *counts, "base_failed", "kept", "p_good")


@query("op7_secrets")
def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of secrets in every document."""
    docs = documents(spark, folder)
    found = secrets.scan(docs, secrets.train(secrets.samples_of(docs)))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == secrets.KINDS.index(kind))).cast("bigint")
    base = F.filter("found", lambda s: s["kind"] < secrets.KINDS.index("markov"))
    counts = [count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    digest = F.sha2(secrets.listed(base), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, secrets.listed(F.col("found")).alias("spans"))


CHAT_SQL = """
WITH rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), turns AS (
  SELECT *, replace(replace(replace(text, '\\', '\\\\'), '<', '\\l'), '[', '\\b') AS escaped FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>') + length(role) + 1 + length(escaped) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id""".replace("\\\\", "\\")


@query("op8_chat", CHAT_SQL)
def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations replayed from their event logs, formatted and read back."""
    given = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT -7L AS conv_id, * FROM VALUES (0L, 'user', '{said}'), (1L, 'assistant', '{said}') AS t(turn, role, text)")
    messages = chat.fold_events(chat.events_of_turns(given.unionByName(extra)))
    read = chat.read_back(chat.render(messages))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query(
    "op9_exact_dedup",
    r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS plain FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, sha256(plain) AS text_sha256
FROM d WINDOW same AS (PARTITION BY plain)""",
)
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Which document stays of each group of equal texts."""
    return exact_dedup.exact_groups(documents(spark, folder))


MIX_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('a' || source, 'z') AS key,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5('0:' || doc_id) AS drawn
  FROM documents
), s AS (
  SELECT key, sum(size)::BIGINT AS size,
    (CASE (row_number() OVER (ORDER BY key) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END)::DOUBLE AS weight
  FROM d GROUP BY key
), level AS (
  SELECT 0 AS step, (SELECT sum(size) / sum(weight) FROM s)::DOUBLE AS level, 0::BIGINT AS clamped
  UNION ALL
  SELECT step + 1, x.level, x.clamped FROM level, LATERAL (
    SELECT (((SELECT sum(size) FROM s) - coalesce(sum(size * 3) FILTER (weight * level.level > size * 3), 0))
      / sum(weight) FILTER (NOT weight * level.level > size * 3))::DOUBLE AS level,
      count(*) FILTER (weight * level.level > size * 3) AS clamped FROM s) x
  WHERE x.clamped > level.clamped
), filled AS (
  SELECT key, size AS source_size,
    CASE WHEN weight * level > size * 3 THEN (size * 3)::DOUBLE ELSE weight * level END AS target
  FROM s, (SELECT level FROM level ORDER BY step DESC LIMIT 1)
), wanted AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM filled
), summed AS (
  SELECT doc_id, size, source_size, target, whole, target - whole * source_size AS rest,
    sum(size) OVER (PARTITION BY d.key ORDER BY drawn, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN wanted USING (key)
)
SELECT doc_id, size, source_size, target,
  ((whole + CASE WHEN 2 * upto - size < 2 * rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM summed"""


@query("op10_mixing", MIX_SQL)
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words the mix takes of every document."""
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    found = mixing.mix(documents(spark, folder), size, [5, 2, 1])
    return found.select("doc_id", "size", "source_size", "target", "taken")


@query("op2_pii")
def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with pseudonyms for personal data."""
    docs = documents(spark, folder).select("doc_id", "text")
    return pii.pseudonymised(docs, PSEUDONYM_KEY).withColumn("n_pii", F.size("pii_spans").cast("bigint"))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document; learned from the labels that are not held out."""
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    docs = documents(spark, folder).select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(~held_out)
    found = toxicity.scored(docs, toxicity.learn(docs, labels.select("doc_id", "toxic")))
    predicted = (F.col("score") >= 0.5).cast("int")
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", predicted.alias("predicted"), "n_terms")


@F.arrow_udf(T.LongType())
def ids_crc32(ids: pa.Array) -> pa.Array:
    """Of each list, the crc32 of its ids as little-endian unsigned 32-bit numbers."""
    flat, ends = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_pylist()
    return pa.array([zlib.crc32(flat[a:b]) for a, b in zip(ends, ends[1:], strict=False)], pa.int64())


@query("op11_packing")
def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of 1,024 tokens; each document ends with id 0."""
    with open(BYTE_IDS, encoding="utf-8") as file:
        found = packing.pack(documents(spark, folder), file.read(), end_id=0)
    return found.select("doc_id", "start", "length", ids_crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


# DuckDB has no crc32: its table is made by its rule, and the remainder is taken byte by byte. Its edit distance counts
# bytes, so letters of two bytes are first renamed to signs of one.
_ACCENTED = "".join(map(chr, range(0xC0, 0x100)))
_SIGNS = "".join(c for c in map(chr, range(33, 127)) if not c.islower() and c != "'")[:64]
SPELLING_SQL = rf"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([k, 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) ORDER BY k) AS t
  FROM range(256) r(k)
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run
  FROM documents
), counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
keyed AS (
  SELECT run, n, list_prepend(4294967295::UBIGINT, flatten([CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END
    FOR c IN string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, '')])::UBIGINT[]) AS bytes FROM counted
), hashed AS (
  SELECT run, n, xor(list_reduce(bytes, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::INT + 1])), 4294967295::UBIGINT) AS h FROM keyed, crc
), spelled AS (
  SELECT CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n, translate(word, '{_ACCENTED}', '{_SIGNS}') AS plain
  FROM spelled WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), near AS (
  SELECT x.word, x.n, y.word AS other, y.n AS other_n FROM words x JOIN words y
    ON length(y.plain) BETWEEN length(x.plain) - 1 AND length(x.plain) + 1 AND x.word <> y.word WHERE levenshtein(x.plain, y.plain) = 1
), best AS (
  SELECT word, count(*) AS n_near, any_value(n) AS n, first(other ORDER BY other_n DESC, other) AS form, max(other_n) AS form_n FROM near GROUP BY word
), forms AS (SELECT word, form, form_n FROM best WHERE form_n >= 5 * n),
ways AS (
  SELECT word, word AS root, 0 AS step FROM words UNION ALL SELECT ways.word, forms.form, step + 1 FROM ways JOIN forms ON forms.word = ways.root
), roots AS (SELECT word, last(root ORDER BY step) AS root FROM ways GROUP BY word)
SELECT word, words.n, coalesce(best.n_near, 0) AS n_near, forms.form, forms.form_n, root
FROM words JOIN roots USING (word) LEFT JOIN best USING (word) LEFT JOIN forms USING (word)"""


@query("op12_spelling", SPELLING_SQL)
def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Words of six letters and five occurrences or more, with the words one edit apart."""
    return spelling.variants(spelling.word_counts(documents(spark, folder), drop=199))


@query("op13_whitening")
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Whitened scores of every vector on the 32 leading components."""
    found = whitening.whiten(spark.read.parquet(f"{folder}/embeddings.parquet"))
    return found.withColumn("deviation", F.col("deviation").cast("bigint"))
