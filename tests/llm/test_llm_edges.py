"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import pytest
from pyspark.sql import functions as F

from lumenfold.llm import chat, exact_dedup, mixing, ngram_join, pieces, pii, quality, resharding, secrets, toxicity
from lumenfold.llm.queries import PIECES

LONG = "word after other word in a very long text without any end " * 4000
SCHEMA = "doc_id long, text string, source string, q string, kept string, _words string, n int, root string, shard int, size string, bucket string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "x", "x", 1, "x", 1, "x", "x") for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    same = "one two three four five six seven eight nine ten eleven twelve"
    return frame(spark, [(5, same, "a"), (3, same, "b"), (3, same, "b"), (None, same, None), (7, None, "a"), (8, "", None), (9, " \n\t", "c"), (10, LONG, "c"), (11, "x" * 300_000, "c"), (12, "ok", "a")])


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_ngram_join(odd, none):
    found = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(odd, 3, 90).collect()}
    assert {(5, 10, 3), (3, 10, 3), (None, 10, 3), (7, 0, 7), (8, 0, 8), (9, 0, 9), (11, 1, 11), (12, 1, 12)} <= found
    assert ngram_join.jaccard_components(odd).count() == odd.count()
    kept = sorted(r["doc_id"] or 0 for r in ngram_join.keep_representatives(odd).collect())
    assert kept == [0, 3, 3, 7, 8, 9, 10, 11, 12]
    assert ngram_join.jaccard_components(none).count() == 0
    assert ngram_join.keep_representatives(none).columns == none.columns


def test_pii(odd, none):
    found = {r["doc_id"]: r for r in pii.pseudonymised(odd, b"k").collect()}
    assert found[7]["text"] is None and found[7]["pii_spans"] == [] and found[10]["text"] == LONG
    assert pii.pseudonymised(none, b"k").count() == 0


def test_pieces(odd, none):
    model = pieces.read_model(PIECES)
    found = {r["doc_id"]: r for r in pieces.encode(odd, model).collect()}
    assert all(r["round_trip"] for r in found.values()) and found[7]["ids"] == [] and found[8]["n_tokens"] == 0
    back = {r["doc_id"]: r["text"] for r in pieces.decode(pieces.encode(odd, model), model).collect()}
    assert back[10] == LONG and back[7] == "" and back[11] == "x" * 300_000
    assert pieces.encode(none, model).count() == 0


def test_resharding(odd, none):
    done = resharding.reshard(odd, F.lit(0), 1, 3)
    found = done.rows.collect()
    assert len(found) == odd.count()
    for shard in range(3):
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in found)))
    assert {r["size"] for r in found if not r["text"]} == {1}
    assert resharding.reshard(none, F.lit(0), 1, 3).rows.count() == 0


def test_quality(odd, none):
    found = {r["doc_id"]: r for r in quality.judged(odd).collect()}
    assert not any(found[i]["kept"] for i in (7, 8, 9, 12)) and found[7]["q"]["n_words"] == 0
    assert found[10]["base_failed"] and found[10]["q"]["n_repeat_words"] == 12 * 4000
    assert quality.judged(none).where("kept").count() == 0


def test_toxicity(spark, odd, none):
    labels = spark.createDataFrame([(5, 1), (10, 0), (None, 1), (12, 2)], "doc_id long, toxic int")
    for lexicon in (toxicity.learn(odd, labels), toxicity.learn(none, labels.limit(0))):
        found = toxicity.scored(odd, lexicon).collect()
        assert len(found) == odd.count() and all(0 <= r["score"] <= 1 for r in found)
    assert toxicity.scored(none, lexicon).count() == 0


def test_secrets(odd, none):
    weights = secrets.train(secrets.samples_of(odd))
    found = {r["doc_id"]: r["found"] for r in secrets.scan(odd, weights).collect()}
    assert found[7] == [] and found[8] == [] and found[10] == []
    assert secrets.scan(none, weights).count() == 0
    assert len(secrets.train(secrets.samples_of(none))) == len(weights)


def test_chat(spark):
    turns = spark.createDataFrame([(1, 0, "user", None), (1, 0, "user", None), (1, 1, None, "a"), (None, 0, "assistant", LONG), (2, None, "assistant", "")], "conv_id long, turn long, role string, text string")
    read = {r["conv_id"]: r for r in chat.read_back(chat.render(chat.fold_events(chat.events_of_turns(turns)))).collect()}
    assert [(t["role"], t["text"]) for t in read[1]["turns"]] == [("user", ""), ("user", ""), ("", "a")]
    assert read[None]["learned"] == [LONG] and read[2]["learned"] == [""]
    assert chat.render(chat.fold_events(chat.events_of_turns(turns.limit(0)))).count() == 0


def test_exact_dedup(odd, none):
    found = exact_dedup.exact_groups(odd).collect()
    group = [r for r in found if r["doc_id"] in (5, 3, None)]
    assert len(found) == odd.count() and sum(r["kept"] for r in group) == 1
    assert all(r["keep_id"] == 3 and r["group_size"] == 4 for r in group)
    assert {r["doc_id"]: r["keep_id"] for r in found if r["doc_id"] in (7, 8, 9)} == {7: 7, 8: 7, 9: 9}
    assert sorted(r["doc_id"] for r in exact_dedup.keep_first(odd).collect()) == [3, 7, 9, 10, 11, 12]
    assert exact_dedup.keep_first(none).columns == none.columns and exact_dedup.keep_first(none).count() == 0


def test_mixing(odd, none):
    size = F.coalesce(F.length("text"), F.lit(0))
    found = mixing.mix(odd, size, [5, 2, 1])
    assert found.count() == odd.count() and rows(found) == rows(mixing.mix(odd, size, [5, 2, 1]))
    assert all(r["taken"] <= 3 * r["size"] for r in found.collect())
    assert mixing.mix(none, size, [1]).count() == 0
    mixed = mixing.mixed_rows(odd, size, [5, 2, 1])
    assert mixed.columns == odd.columns and mixing.mixed_rows(none, size, [1]).count() == 0
    assert mixed.select(F.sum(size)).first()[0] == found.select(F.sum("taken")).first()[0]
    assert mixed.where("doc_id IS NULL").count() == found.where("doc_id IS NULL").first()["repeats"]
