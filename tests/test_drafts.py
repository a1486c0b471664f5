"""What a refresh writes, and how its saves arrive."""

import os

import pyarrow.parquet as pq

from lumenfold.operators import refresh
from lumenfold.plans import source_queries
from lumenfold.session import shared_dir
from lumenfold.sources import generations as gen


def test_a_refresh_writes_its_tables_once(spark, tmp_path):
    """Vectors, counts and catalysts were written as scratch tables first and again by the commit."""
    rows = [("a", "u", f"n{i}", i, f"Apples {i}", f"green apples and pears {i}", "box", ["fruit"]) for i in range(6)]
    names = "app_id string, user_id string, entry_id string, seq long, title string, content string, folder string, tags array<string>"
    there = set(os.listdir(shared_dir(spark).removeprefix("file://")))
    refresh.run_refresh(spark, str(tmp_path), spark.createDataFrame(rows, names), cluster=False)
    made = {name.rsplit("-", 1)[0] for name in set(os.listdir(shared_dir(spark).removeprefix("file://"))) - there}
    assert not made & {"refresh-vectors", "refresh-counts", "refresh-rarity", "refresh-mentions", "refresh-catalysts"}
    now = gen.open_store(spark, str(tmp_path))
    assert sorted(now.live[0]["tables"]) == ["catalysts", "counts", "documents", "entries", "mentions", "outcome", "rarity", "sections", "vectors"]
    assert {t: now.table(t).count() for t in ("vectors", "counts", "entries", "outcome")} == {"vectors": 6, "counts": 6, "entries": 6, "outcome": 1}


def test_a_draft_is_not_seen_before_its_commit(spark, tmp_path):
    path, rows = str(tmp_path), spark.createDataFrame([("a", "u", 1)], "app_id string, user_id string, x int")
    draft = gen.Draft(spark, path)
    assert draft.put("x", rows).collect() == rows.collect()
    assert gen.open_store(spark, path).number == 0
    assert gen.commit(spark, path, {"y": rows}, rows, draft=draft) == 1
    now = gen.open_store(spark, path)
    assert now.live[0]["tables"] == ["x", "y"] and now.table("x").collect() == now.table("y").collect() == rows.collect()


def test_several_tasks_can_read_a_file_of_saves(spark, tmp_path, monkeypatch):
    """Each of the three files was one row group, so one task read it, however large."""
    given = spark.range(300_000).selectExpr(
        "id AS event_id", "timestamp_seconds(id * 7) AS ts", "id * 31 % 999 AS user_id", "'view' AS event_type", "sha2(string(id), 256) AS props"
    )
    given.write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(source_queries, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    source_queries._save_stream(spark, str(tmp_path), "saves")
    files = [f"{tmp_path}/saves/{n}" for n in os.listdir(f"{tmp_path}/saves") if n.endswith(".parquet")]
    assert len(files) == 3 and all(pq.ParquetFile(f).num_row_groups > 2 for f in files)
    assert spark.read.parquet(f"{tmp_path}/saves").count() == 300_000
