import json

import pytest
from pyspark.sql import functions as F

from lumenfold.operators import entities, shape

AS_OF = "2024-06-01"


def raw(spark, rows):
    return spark.createDataFrame(rows, "seq long, user_key string, user_id string, recipe_name string, comment string, date string, userDisplayName string, userID string, recipeName string, commentBody string, approveDate string")


def test_rows_and_entries(spark):
    keep, short = "x" * 51, "y" * 50
    rows = raw(
        spark,
        [
            (0, "ann", "1", "black-rice", keep, "2024-02-03T10:00", None, None, None, None, None),
            (1, "", None, "", None, None, "", "1", " black-rice ", "<b>z</b>" + keep, "1704067200"),
            (2, "ann", "1", "black-rice", short, "2025-01-01", None, None, None, None, None),
            (3, "ann", "1", "", keep, "2025-01-01", None, None, None, None, None),
            (4, "ann", "1", "cake", keep, None, None, None, None, None, None),
        ],
    )
    normal = shape.normalize_rows(rows, AS_OF)
    got = {r.seq: r for r in normal.collect()}
    assert (got[1].user_key, got[1].user_id, got[1].recipe_name, got[1].date) == ("1", "1", "black-rice", "2024-01-01")
    assert got[4].date == AS_OF and got[0].date == "2024-02-03"
    entries = {r.recipe_name: r for r in shape.group_entries(normal).collect()}
    assert set(entries) == {"black-rice", "cake"}
    assert entries["black-rice"].notes == keep + "\n\nz" + keep
    assert (entries["black-rice"].created_at, entries["black-rice"].title) == ("2024-02-03", "Black Rice")
    assert json.loads(entries["black-rice"].metadata)["user_key"] == "ann"


def test_a_recipe_with_sparse_numbers_is_one_entry(spark):
    rows = spark.range(1000).select(
        (F.col("id") * 1_000_003).alias("seq"), F.lit("k").alias("user_key"), F.lit("1").alias("user_id"), F.lit("hot").alias("recipe_name"),
        F.concat(F.rpad(F.lit("c"), 60, "c"), "id").alias("comment"), F.lit("2024-01-01").alias("date"),
    )
    entries = shape.group_entries(rows)
    one = entries.collect()
    assert len(one) == 1 and [n[60:] for n in one[0].notes.split("\n\n")] == [str(k) for k in range(1000)]
    assert shape.derive_observations(entries).select("id").distinct().count() == 1


def test_numbering_loses_no_row(spark):
    rows = [("a", "u", 5), ("a", "u", None), (None, "u", 1), ("a", "u", 5), ("a", "u", 10**12), (None, "u", None)]
    df = spark.createDataFrame(rows, "app_id string, user_id string, seq long").withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    got = sorted((r.app_id or "", r.entry_index) for r in shape.resolve_entry_id(df).collect())
    assert got == [("", 0), ("", 1), ("a", 0), ("a", 1), ("a", 2), ("a", 3)]


def test_naive_times_are_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        same = ["2026-04-25T14:30:00+00:00", "2026-04-25T14:30", "2026-04-25 14:30:00", "1777127400000"]
        df = spark.createDataFrame([(s,) for s in [*same, "2026-04-25"]], "s string")
        got = [r[0] for r in df.select(F.unix_timestamp(shape.created_at(F.col("s")))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [1777127400] * 4 + [1777075200]


def test_a_scalar_tag(spark):
    df = spark.createDataFrame([("x",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(shape.clean_tags(F.col("t"), "scalar")).collect()] == [["x"], [], []]


def test_observation_rules(spark):
    rows = [("1", "ann", "r", 0, "2024", n) for n in ["plain", "Substituted", "a keeper, too sweet", "instead less sugar again"]]
    made = shape.derive_observations(spark.createDataFrame(rows, "user_id string, user_key string, recipe_name string, part int, created_at string, notes string"))
    assert made.groupBy("kind").count().collect() and made.count() == 4 + 1 + 2 + 3
    assert made.where("topic = 'substitutions'").first().summary == "ann often adapts r around available ingredients."


def test_activity_and_metadata_fold(spark):
    rows = [("t", "Good.", "s1", ["CookingEvent"], '{"b": {"z": 1, "a": "é"}, "activity_type": "x"}'), ("t", "Bare", "", [], None)]
    got = shape.activity_transform(spark.createDataFrame(rows, "title string, content string, source_id string, classes array<string>, metadata string")).collect()
    assert got[0].content == 'Good.\n\nMetadata: {"activity_type": "x", "b": {"a": "é", "z": 1}}'
    assert (got[0].id, got[0].collections) == ("s1", ["cooking-event"])
    assert (got[1].content, got[1].id, got[1].collections) == ("Bare", None, None)


def test_collections(spark):
    df = spark.createDataFrame(
        [(0, None, None, ["b/x", "b/y", "b/x"]), (1, None, None, ["One"]), (2, "Own", None, ["h"]), (3, "Own", ["C D"], ["h"]), (4, None, ["e"], ["h"])],
        "seq long, collection string, collections array<string>, hook array<string>",
    )
    got = {r.seq: (r.collection, r.collections) for r in shape.map_collections(df, F.col("hook")).collect()}
    assert got == {0: (None, ["b/x", "b/y"]), 1: ("one", None), 2: ("own", None), 3: (None, ["c-d"]), 4: (None, ["e"])}
    entries = shape.map_collections(df, F.col("hook"))
    declared = spark.createDataFrame([("e",), ("b/x",)], "collection_id string")
    bad = {r.seq: r.unknown for r in shape.validate_collections(entries, declared, ["seq"]).collect()}
    assert bad == {0: ["b/y"], 3: ["c-d"]}
    assert shape.validate_collections(entries, declared.limit(0), ["seq"]).count() == 0
    with pytest.raises(Exception, match="Unknown collection"):
        shape.require_declared(entries, ["e"]).collect()


def test_tags_and_times(spark):
    df = spark.createDataFrame([(["weeknight", None, "ginger", ""],), (None,)], "tags array<string>")
    assert [r[0] for r in df.select(shape.clean_tags(F.col("tags"))).collect()] == [["weeknight", "ginger"], []]
    same = ["2026-04-25T14:30:00+00:00", "2026-04-25T14:30", "1777127400000"]
    times = spark.createDataFrame([(s,) for s in same], "s string").select(shape.created_at(F.col("s")).alias("t"))
    assert times.distinct().count() == 1


def test_entry_ids_and_text(spark):
    df = spark.createDataFrame(
        [("a", "u", 7, None, "", "T", ["x", None, "y"]), ("a", "u", 9, "i", None, None, None), ("a", "u", 11, None, None, None, None)],
        "app_id string, user_id string, seq long, id string, source string, title string, body array<string>",
    )
    got = {r.seq: r.entry_id for r in shape.resolve_entry_id(df).collect()}
    assert got == {7: "T", 9: "i", 11: "entry-2"}
    assert df.where("seq = 7").select(shape.embedding_text(df)).first()[0] == "T\n\nx y"


def test_profiles_keep_first_seen_order(spark):
    entries = spark.createDataFrame(
        [("a", "u", 0, ["cooking-event", "observed"]), ("a", "u", 1, ["cooking-event", "substitutions"])],
        "app_id string, user_id string, seq long, collections array<string>",
    )
    profiles = spark.createDataFrame([("cooking-event", "preference_evidence")], "collection_id string, profile string")
    rows = entities.collection_profiles(entries, profiles).orderBy("first_seq", "first_pos").collect()
    assert [(r.entity_ref, r.profile) for r in rows] == [
        ("folder:cooking-event", "preference_evidence"), ("folder:observed", None), ("folder:substitutions", None)
    ]
    assert entities.check_profiles(profiles).count() == 0
