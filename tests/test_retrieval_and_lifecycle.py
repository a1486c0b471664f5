import json
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfold.operators import lifecycle as lc
from lumenfold.functions import text as tx
from lumenfold.operators import labels, overview, retrieval, shape
from lumenfold.schema import SCOPE
from lumenfold.session import materialize
from lumenfold.sources import comments, markdown, store


def test_search_equals_brute_force_with_hot_catalyst(spark):
    rng = np.random.default_rng(2)
    unit = lambda n: (lambda m: m / np.linalg.norm(m, axis=1, keepdims=True))(rng.normal(size=(n, 5))).astype(np.float32).astype(float)
    docs, cats, asks = unit(60), unit(40), unit(4)
    member = {(c, d) for c in range(40) for d in range(60) if c == 0 or (d + c) % 5 == 0}  # catalyst 0 has every entry
    assoc = np.round(cats @ docs.T, 9)
    vec = "array<float>"
    rows = lambda m, p: [("a", "u", f"{p}{i:02d}", [float(x) for x in r]) for i, r in enumerate(m)]
    queries = spark.createDataFrame(rows(asks, "q"), f"app_id string, user_id string, query_id string, vector {vec}")
    catalysts = spark.createDataFrame(rows(cats, "c"), f"app_id string, user_id string, catalyst_id string, vector {vec}").withColumns({"entity": F.col("catalyst_id"), "text": F.lit("t")})
    documents = spark.createDataFrame([("a", "u", f"c{c:02d}", f"d{d:02d}", d, float(assoc[c, d])) for c, d in member], "app_id string, user_id string, catalyst_id string, entry_id string, entry_index long, assoc double")
    found = retrieval.catalyze(queries, catalysts, documents, limit=5)
    got = {(r.query_id, r.rank): r.entry_id for r in found.results.collect()}
    totals = {r.query_id: r.total_results for r in found.totals.collect()}
    for q in range(4):
        rel = np.round(cats @ asks[q], 9)
        kept = [c for c in sorted(range(40), key=lambda c: (-rel[c], c)) if rel[c] > 0]
        assert len(kept) > 10
        best = {}
        for c, d in member:
            if c in kept:
                best[d] = max(best.get(d, 0.0), rel[c] * max(assoc[c, d], 0.0))
        order = sorted(best, key=lambda d: (-best[d], d))[:5]
        assert [got[f"q{q:02d}", i + 1] for i in range(5)] == [f"d{d:02d}" for d in order]
        assert totals[f"q{q:02d}"] == len(best)
    with pytest.raises(ValueError):
        retrieval.catalyze(queries, catalysts, documents, limit=101)


def test_normalize_catalysts(spark):
    row = spark.createDataFrame([('["plain", {"text": "t", "more": 1}]',)], "raw string")
    assert row.select(retrieval.normalize_catalysts(F.col("raw"))).first()[0] == ['{"text":"plain"}', '{"more":1,"text":"t"}']


def test_unconnected_search_fails(spark):
    queries = spark.createDataFrame([("a", "u1"), ("a", "u2")], "app_id string, user_id string")
    assert lc.require_connected(queries, queries).count() == 2
    with pytest.raises(Exception, match="not connected"):
        lc.require_connected(queries, queries.limit(1)).collect()


def test_log_semantics(spark):
    log = [
        ("k", 1, "patch", "lost", None), ("k", 2, "create", "a", "x"), ("k", 3, "patch", None, "y"), ("k", 4, "patch", "b", None),
        ("gone", 1, "create", "a", None), ("gone", 2, "delete", None, None), ("gone", 3, "patch", "z", None),
        ("again", 1, "create", "a", "old"), ("again", 2, "delete", None, None), ("again", 3, "create", "c", None),
    ]
    got = lc.upsert_patch_delete(spark.createDataFrame(log, "id string, seq long, op string, t string, c string"), ["id"], ["t", "c"])
    assert {r.id: (r.t, r.c) for r in got.collect()} == {"k": ("b", "y"), "again": ("c", None)}


def test_chunks_cover_the_whole_text(spark):
    for words in (1, 200, 201, 360, 361, 1000):
        text = " ".join(f"w{i}" for i in range(words))
        df = spark.createDataFrame([("a", "u", "e", text)], "app_id string, user_id string, entry_id string, content string")
        pieces = [r.chunk.split() for r in lc.chunk_and_hash(df).orderBy("chunk_no").collect()]
        assert {w for p in pieces for w in p} == set(text.split()) and all(len(p) <= 200 for p in pieces)
        assert len(pieces) == max(0, -(-(words - 200) // 160)) + 1


def test_refresh_kinds(spark):
    side = lambda rows: spark.createDataFrame([("a", "u", *r) for r in rows], "app_id string, user_id string, entry_id string, content_hash string")
    new, old = side([("1", "x"), ("2", "y"), ("3", "n")]), side([("1", "x"), ("2", "old"), ("4", "gone")])
    kinds = lambda df: {r.entry_id: r.change for r in df.collect()}
    assert kinds(lc.refresh_incremental(new, old)) == {"2": "changed", "3": "new", "4": "deleted"}
    assert kinds(lc.refresh_incremental(new, old, full=True))["1"] == "changed"


def test_markdown(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", "u", 0, "My Note!", "Sarah met (A+B) and Sarah. resarah", "box", ["#x", "y"], ["Sarah", "A+B"], '{"author": "R", "n": 2, "l": ["p", "q"]}'),
         ("a", "u", 1, "my note", "later", "box", None, None, None)],
        "app_id string, user_id string, seq long, title string, content string, folder string, tags array<string>, links array<string>, metadata string",
    )
    lines = markdown.render_markdown(df.where("seq = 0"), "2024-05-06").first().markdown.split("\n")
    assert lines[:3] == ["---", 'title: "My Note!"', "date: 2024-05-06"]
    assert "  - x" in lines and 'author: "R"' in lines and 'n: "2"' in lines and lines[lines.index("l:") + 1] == "  - p"
    assert "[[Sarah]] met (A+B) and Sarah. resarah" in lines or "[[Sarah]] met ([[A+B]]) and Sarah. resarah" in lines
    markdown.export_markdown(df, str(tmp_path / "md"), "2024-05-06")
    hidden = tmp_path / "md" / markdown.INDEX_DIR
    hidden.mkdir()
    (hidden / "x.md").write_text("no")
    got = markdown.scan_markdown_folder(spark, str(tmp_path / "md")).collect()
    assert [(r.folder, r.filename) for r in got] == [("a/u/box", "my-note.md")] and "later" in got[0].content


def test_ingest_checks_titles_and_keeps_the_latest(spark, tmp_path):
    path = str(tmp_path / "store")
    make = lambda rows: spark.createDataFrame([("a", "u", *r) for r in rows], "app_id string, user_id string, entry_id string, seq long, title string, content string")
    store.ingest_batch(make([("1", 0, "t", "old"), ("2", 1, "t", "two")]), path, 0)
    store.ingest_batch(make([("1", 2, "t", "new")]), path, 1)
    store.ingest_batch(make([("1", 2, "t", "new")]), path, 1)  # a batch that runs again
    assert {r.entry_id: r.content for r in store.read_entries(spark, path).collect()} == {"1": "new", "2": "two"}
    assert {r.chunk for r in store.read_chunks(spark, path).collect()} == {"t new", "t two"}
    with pytest.raises(Exception, match="needs a title"):
        store.ingest_batch(make([("3", 3, None, "x")]), path, 2)


def test_overview_trend_and_text(spark):
    days = {"up": [1, 2, 3, 40], "down": [45, 46, 2], "flat": [5, 35], "old": [500]}
    mentions = spark.createDataFrame([("a", "u", f"{e}{i}", "tag", e) for e, ds in days.items() for i in range(len(ds))], "app_id string, user_id string, entry_id string, entity_type string, entity string")
    entries = spark.createDataFrame([("a", "u", f"{e}{i}", d) for e, ds in days.items() for i, d in enumerate(ds)], "app_id string, user_id string, entry_id string, d int").withColumn("created_at", F.lit("2024-12-31").cast("timestamp") - F.make_dt_interval("d"))
    catalysts = spark.createDataFrame([("a", "u", "tag", "up", f"c{i}", f"q{i}" if i else "") for i in range(7)], "app_id string, user_id string, entity_type string, entity string, catalyst_id string, text string")
    rows = {r.entity: r for r in overview.entity_overview(mentions, entries, catalysts, "2024-12-31", top=3).collect()}
    assert {e: r.activity_trend for e, r in rows.items()} == {"up": "rising", "down": "declining", "flat": "stable"}
    assert rows["up"].total_entities == 4 and rows["up"].days_since_last_seen == 1
    text = overview.render_overview_context(overview.entity_overview(mentions, entries, catalysts, "2024-12-31")).first().context
    assert "Tracking 4 entities" in text and "  - q4" in text and "q5" not in text and "  - \n" not in text


def test_comments_without_numbers_keep_their_order(spark, tmp_path):
    (tmp_path / "json").mkdir()
    for name, words in (("b.json", ["three", "four"]), ("a.json", ["one", "two"])):
        rows = [{"userID": "7", "recipeName": "r", "commentBody": w * 20, "approveDate": "1700000000"} for w in words]
        (tmp_path / "json" / name).write_text(json.dumps({"comments": rows}))
    (tmp_path / "csv").mkdir()
    for name, words in (("b.csv", ["three", "four"]), ("a.csv", ["one", "two"])):
        (tmp_path / "csv" / name).write_text("user_id,recipe_name,comment\n" + "".join(f'7,r,"{w * 20}"\n' for w in words))
    (tmp_path / "zip").mkdir()
    for name in ("a", "b"):
        with zipfile.ZipFile(tmp_path / "zip" / f"{name}.zip", "w") as archive:
            archive.write(tmp_path / "csv" / f"{name}.csv", "comments.csv")
    for kind in ("json", "csv", "zip"):
        rows = shape.normalize_rows(comments.scan_comments(spark, str(tmp_path / kind), kind), "2024-01-01")
        notes = shape.group_entries(rows).first().notes.split("\n\n")
        assert notes == ["one" * 20, "two" * 20, "three" * 20, "four" * 20], kind


def test_a_csv_with_other_columns_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("seq,user_id\n1,7\n")
    (tmp_path / "b.csv").write_text("user_id,seq\n7,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        comments.scan_comments(spark, str(tmp_path), "csv").collect()


def test_a_folder_named_like_its_root(spark, tmp_path):
    root = tmp_path / "R"
    for name in ("x/R/y.md", "top.md", ".index/z.md"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text("t")
    got = {(r.folder, r.filename) for r in markdown.scan_markdown_folder(spark, str(root)).collect()}
    assert {f for f, _ in got} == {"x/R", None}


def test_stored_entries_keep_their_fields(spark, tmp_path):
    entries = spark.createDataFrame(
        [("a", "u", "e", 0, "t", "c", "n1 n2", "note", "s1", ["k"])],
        "app_id string, user_id string, entry_id string, seq long, title string, content string, notes string, primitive string, source_id string, keywords array<string>",
    )
    store.ingest_batch(entries, str(tmp_path), 0)
    row = store.read_entries(spark, str(tmp_path)).first()
    assert (row.primitive, row.source_id, row.keywords) == ("note", "s1", ["k"])
    assert [r.chunk for r in store.read_chunks(spark, str(tmp_path)).collect()] == ["t c n1 n2"]


def test_one_catalyst_in_two_collections_counts_once(spark):
    key = "app_id string, user_id string, "
    queries = spark.createDataFrame([("a", "u", "q", [1.0, 0.0])], key + "query_id string, vector array<float>")
    catalysts = spark.createDataFrame([("a", "u", "c", "e", "t", k, [1.0, 0.0]) for k in ("x", "y")], key + "catalyst_id string, entity string, text string, collection_id string, vector array<float>")
    documents = spark.createDataFrame([("a", "u", "c", "d", 0, 0.5, k) for k in ("x", "y")], key + "catalyst_id string, entry_id string, entry_index long, assoc double, collection_id string")
    entries = spark.createDataFrame([("a", "u", "d", "title", None)], key + "entry_id string, title string, created_at timestamp")
    rows, found = retrieval.scope_search(queries, catalysts, documents, entries)
    assert rows.count() == 1 and [r.contribution_count for r in found.catalysts.collect()] == [1]


def test_numbers_are_rounded_as_their_binary_value(spark):
    df = spark.createDataFrame([(0.25, 0.125, 0.345), (None, 1.0, 2.0)], "a double, b double, c double")
    got = [tuple(r) for r in df.select(tx.fixed(F.col("a"), 1), tx.fixed(F.col("b"), 2), tx.fixed(F.col("c"), 2)).collect()]
    assert got == [("0.2", "0.12", "0.34"), (None, "1.00", "2.00")]


def test_stored_vectors_of_zeros_are_not_broadcast(spark):
    row = [F.lit("a").alias("app_id"), F.lit("u").alias("user_id"), F.col("id").cast("string").alias("entry_id")]
    many = spark.range(30_000)  # files far below the broadcast limit, rows of 60 MB
    zeros = F.array_repeat(F.lit(0.0).cast("float"), 512).alias("vector")
    vectors = materialize(many.select(*row, F.col("id").alias("entry_index"), zeros), "zeros")
    mentions = materialize(many.select(*row, F.lit("tag").alias("entity_type"), F.lit("x").alias("entity")), "zero-mentions")
    catalysts = materialize(
        spark.range(1).select(*row[:2], F.lit("tag:x").alias("catalyst_id"), F.lit("tag").alias("entity_type"), F.lit("x").alias("entity"), zeros), "zero-catalysts"
    )
    assert vectors._jdf.queryExecution().analyzed().stats().sizeInBytes() < 10 << 20
    placed = retrieval.catalyst_documents(catalysts, mentions, vectors)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1  # the one catalyst still is
    assert placed.count() == 30_000


def test_rare_words_of_a_group_are_not_counted_in_the_whole_scope(spark, monkeypatch):
    rows, place = [], {}
    for n in range(400):
        group = n % 2
        rare = " ".join(f"rare{chr(97 + n % 26)}{chr(97 + n // 26)}{chr(97 + k)}" for k in range(20))
        often = " ".join(f"both{chr(97 + k)}" for k in range(26) if (n // 2) % 27 > k)
        own = " ".join(f"only{group}x{chr(97 + k)}" for k in range(26) if (n // 2) % 29 > k)
        own2 = " ".join(f"more{group}x{chr(97 + k)}" for k in range(26) if (n // 2) % 31 > k)
        place[n] = group
        rows.append(("a", "u", n, f"{own} {own2} {often} {rare}"))
    entries = spark.createDataFrame(rows, "app_id string, user_id string, entry_index long, content string")
    members = entries.select(*SCOPE, "entry_index", (F.col("entry_index") % 2).alias("cluster_no"))
    sizes = members.groupBy(*SCOPE, "cluster_no").agg(F.count("*").alias("size"))
    kept, stored = {}, labels.materialize

    def watch(df, label):
        kept[label] = stored(df, label)
        return kept[label]

    monkeypatch.setattr(labels, "materialize", watch)
    found = {r["cluster_no"]: r["keywords"] for r in labels.contrast_keywords(entries, members, sizes).collect()}
    counts = {}
    for _, _, n, text in rows:
        for word in set(text.split()):
            counts.setdefault(word, [0, 0])[place[n]] += 1
    for group in (0, 1):
        score = {}
        for word, c in counts.items():
            if c[group]:
                rate, outside = c[group] / 200, c[1 - group]
                score[word] = round(rate * np.log(401 / (1 + outside)) + max(0.0, rate - outside / 200), 9)
        assert found[group] == sorted(score, key=lambda w: (-score[w], w))[:4]
    assert kept["group-words"].where("term LIKE 'rare%'").count() == 8000
    assert kept["able-words"].where("term LIKE 'rare%'").count() == 0 and kept["able-words"].count() >= 8


def test_markdown_folders_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    """The driver listed all files, and some 30 made a task. The names that count are those of Spark's reader."""
    names = ["empty.md", "a.md", "é ü.md", "x.MD", "_no.md", ".no.md", "_yes=1.md", "_metadata.md", "b/c/d.md", "b/_no/e.md", "b/.index/f.md", "b/k=v/g.md", "idx/h.md", "dir.md/i.md", "b/none.txt"]
    for at, name in enumerate(names):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("é\n" * at)
    (tmp_path / "empty").mkdir()
    rows = lambda df: sorted((r.folder or "", r.filename, r.content) for r in df.collect())
    found = markdown.scan_markdown_folder(spark, str(tmp_path), "idx")
    assert not any(f.endswith(".md") for f in found.inputFiles())
    got = rows(found)
    assert {f"{a}/{b}".lstrip("/") for a, b, _ in got} >= {"a.md", "é ü.md", "b/c/d.md", "b/k=v/g.md", "dir.md/i.md"}

    def unknown(path):
        raise ValueError(path)

    monkeypatch.setattr(markdown, "opened", unknown)
    assert rows(markdown.scan_markdown_folder(spark, str(tmp_path), "idx")) == got
    with pytest.raises(Exception, match="(?i)path"):
        markdown.scan_markdown_folder(spark, str(tmp_path / "missing"))
