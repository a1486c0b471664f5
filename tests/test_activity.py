"""Activity with state: late and repeated events, open days only, merged copies."""

import datetime

from pyspark.sql import functions as F

from lumenfold.session import scratch_path
from lumenfold.sources.generations import Files
from lumenfold.streaming import activity

SCHEMA = "app_id string, user_id string, entry_id string, kind string, ts timestamp"


def at(day, hour=0):
    return datetime.datetime(2024, 3, day, hour)


def run(spark, place, events):
    spark.createDataFrame([("a", *e) for e in events], SCHEMA).coalesce(1).write.mode("append").parquet(f"{place}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{place}/in")
    options = {"lateness": "1 day", "shards": 2, "fold": 2}
    activity.activity_stream(stream, F.col("kind"), f"{place}/out", f"{place}/cp", **options).awaitTermination()


def open_days(spark, place):
    state = spark.read.format("statestore").option("stateVarName", "days").load(f"{place}/cp")
    return sorted(r["day"] for r in state.select(F.date_from_unix_date("user_map_key.day").alias("day")).collect())


def test_late_and_repeated_events_and_state_of_open_days_only(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        _late_and_repeated(spark)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def _late_and_repeated(spark):
    place = scratch_path(spark, "activity-test")
    run(spark, place, [])
    assert activity.read_activity(spark, f"{place}/out").count() == 0
    run(spark, place, [("u", "1", "view", at(1, 1)), ("u", "1", "view", at(1, 1)), ("u", "2", "view", at(1, 5)), ("u", "3", None, at(1, 2)), ("u", "4", "view", None)])
    run(spark, place, [("u", "1", "view", at(1, 1)), ("u", "5", "view", at(4, 0)), ("v", None, "view", at(4, 2))])
    # The watermark is at 02:00 of day 3 now: day 1 is closed, its repetition counts nothing, its late event moves the time.
    assert {d.day for d in open_days(spark, place)} == {4}
    run(spark, place, [("u", "2", "view", at(1, 5)), ("u", "6", "view", at(1, 9)), ("u", "7", "view", at(3, 3)), ("w", "8", "save", at(2, 7))])
    found = {(r["user_id"], r["entity"], r["day"].day): (r["frequency"], r["last_seen"]) for r in activity.read_activity_days(spark, f"{place}/out").collect()}
    assert found == {
        ("u", "view", 1): (2, at(1, 9)),
        ("u", None, 1): (1, at(1, 2)),
        ("u", "view", 3): (1, at(3, 3)),
        ("u", "view", 4): (1, at(4, 0)),
        ("v", "view", 4): (1, at(4, 2)),
        ("w", "save", 2): (0, at(2, 7)),
    }
    total = {(r["user_id"], r["entity"]): (r["frequency"], r["last_seen"]) for r in activity.read_activity(spark, f"{place}/out").collect()}
    assert total[("u", "view")] == (4, at(4, 0)) and total[("w", "save")] == (0, at(2, 7))
    run(spark, place, [("u", "9", "view", at(20, 0))])
    assert {d.day for d in open_days(spark, place)} == {20}
    files = Files(spark, place)
    assert len(files.names(f"{place}/out/folded")) <= 2 and len(files.names(f"{place}/out/windows")) <= 4
    # A batch that is stored again, also behind the copy that holds it, changes nothing.
    before = sorted(map(tuple, activity.read_activity(spark, f"{place}/out").collect()), key=str)
    newest = max(int(n.removeprefix("batch=")) for n in files.names(f"{place}/out/windows"))
    stored = f"{place}/out/windows/batch={newest}"
    spark.read.parquet(stored).write.parquet(f"{place}/out/windows/batch={newest + 1}")
    assert sorted(map(tuple, activity.read_activity(spark, f"{place}/out").collect()), key=str) == before


def test_users_share_keys_of_the_state(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        place = scratch_path(spark, "activity-many")
        events = [(f"u{n % 1500}", str(n), "view", at(1 + n % 2, 3)) for n in range(3000)]
        run(spark, place, events)
        run(spark, place, events[:10])
        state = spark.read.format("statestore").option("stateVarName", "days").load(f"{place}/cp")
        assert state.count() <= 2 * 512  # one row a user and day before: 3,000
        found = activity.read_activity(spark, f"{place}/out")
        assert found.count() == 1500 and found.where("frequency <> 2").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
