"""Frequency and last-seen time per entity with state that lasts as long as its window.

An event belongs to the day of its time. A day is open until the watermark has passed its end; while it is open, an
event that is delivered again counts once. An event of a closed day is late: it no longer counts, but it still moves
the last-seen time, which is a maximum. Events without a time belong to no day and are left out.

The state is a map of open days, with the ids counted on each; a timer removes a day when it closes, so the state is
bounded by the events of the open days and nothing is kept of closed ones. Time to live is not used for that, because it
runs by the clock of the machine and results would depend on it. Most (user, entity) have few events a day, and each key
of the state and each value in it costs a call between Python and the store. So many of them share a key, one of
``buckets``, and a batch is counted by arrays: calls grow with buckets and open days, not with users. Ids are spread over
``shards`` before that, so the events of one hot user and entity are counted in several tasks; an event always meets its
repetitions in the same one.

What a micro-batch changes is stored as (user, entity, shard, day, frequency, last_seen). Both numbers only grow, so
the stored rows of a day merge by their maximum: a batch that is written again changes nothing. Every ``fold`` batches
they are merged into one copy, and a reader takes the newest copy and the batches behind it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from lumenfold.schema import SCOPE
from lumenfold.sources.generations import Files

_KEYS = [*SCOPE, "entity", "shard"]
_WINDOWS = "app_id string, user_id string, entity string, shard int, day date, frequency long, last_seen timestamp"
_CHANGED = "app_id string, user_id string, entity string, shard int, day int, frequency long, last_seen long"
_DAY_MS = 86_400_000
_HALF, _MARK = np.dtype("V16"), np.dtype("V32")  # of an event: whose it is, and that with its id
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class DayCounts(StatefulProcessor):
    """Open days of one bucket of (user, entity, shard): whose the ids are that were counted so far, and the ids."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", "day int", "marks binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        events = pd.concat(list(rows), ignore_index=True)
        found = events.drop_duplicates(["whose", "day"]).drop(columns=["id", "at"])
        last = events.groupby(["whose", "day"], sort=False)["at"].max().rename("last_seen").reset_index()
        found = found.merge(last, on=["whose", "day"])
        times: dict[tuple[bytes, int], int] = {}
        for day, arrived in events[(events["day"] + 1) * _DAY_MS > watermark].groupby("day"):
            for whose, n in self._counted(int(day), b"".join((arrived["whose"] + arrived["id"]).tolist())):
                times[whose, int(day)] = n
        found["frequency"] = [times.get(k, 0) for k in zip(found["whose"], found["day"].tolist(), strict=True)]
        yield found[[*_KEYS, "day", "frequency", "last_seen"]]

    def _counted(self, day: int, arrived: bytes) -> Iterator[tuple[bytes, int]]:
        """Add marks to the open day; how many different ones each owner has on it."""
        if self.days.containsKey((day,)):
            arrived += bytes(self.days.getValue((day,))[0])
        else:
            self.handle.registerTimer((day + 1) * _DAY_MS)
        marks = np.unique(np.frombuffer(arrived, _MARK))
        self.days.updateValue((day,), (marks.tobytes(),))
        owners, counts = np.unique(marks.view(_HALF)[::2], return_counts=True)
        return zip(map(bytes, owners), counts.tolist(), strict=True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.days.removeKey((expiredTimerInfo.getExpiryTimeInMs() // _DAY_MS - 1,))
        yield from ()

    def close(self) -> None:
        pass


def day_counts(events: DataFrame, entity: Column, lateness: str, shards: int = 8, buckets: int = 512) -> DataFrame:
    """Changed days of a stream of ``(app_id, user_id, entry_id, ts)``, as update rows."""
    marked = events.where("ts IS NOT NULL").withWatermark("ts", lateness)
    # The time goes on as a plain number: Spark would take late rows out before they reach the last-seen time.
    plain = marked.select(
        *SCOPE,
        entity.cast("string").alias("entity"),
        F.pmod(F.xxhash64("entry_id"), F.lit(shards)).cast("int").alias("shard"),
        F.unix_date(F.to_date("ts")).alias("day"),
        F.unhex(F.md5(F.concat_ws(":", F.unix_micros("ts").cast("string"), "entry_id"))).alias("id"),
        F.unix_micros("ts").alias("at"),
    )
    owner = F.struct(*_KEYS)
    plain = plain.withColumns(
        {"whose": F.unhex(F.md5(F.to_json(owner))), "bucket": F.pmod(F.xxhash64(owner), F.lit(buckets)).cast("int")}
    )
    changed = plain.groupBy("bucket").transformWithStateInPandas(DayCounts(), _CHANGED, "Update", "EventTime")
    return changed.withColumns({"day": F.date_from_unix_date("day"), "last_seen": F.timestamp_micros("last_seen")})


def activity_stream(
    events: DataFrame, entity: Column, path: str, checkpoint: str, *, lateness: str = "7 days", shards: int = 8, fold: int = 20, buckets: int = 512
) -> StreamingQuery:
    """Keep the activity of all entities below ``path``; days close ``lateness`` after their end (days of UTC).

    ``shards`` and ``buckets`` are part of the state and stay the same for the life of a checkpoint.
    """
    spark = events.sparkSession

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/windows/batch={number}")
        if number % fold == fold - 1:
            _fold(batch.sparkSession, path, number)

    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)  # map state and timers need it; a started query keeps the setting it found
    try:
        writer = day_counts(events, entity, lateness, shards, buckets).writeStream.outputMode("update").foreachBatch(store)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(_PROVIDER, before)


def _batches(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the folders whose writing has ended."""
    files = Files(spark, path)
    names = [n for n in files.names(f"{path}/{kind}") if n.startswith("batch=")]
    done = [n for n in names if files.fs.exists(files.place(f"{path}/{kind}/{n}/_SUCCESS"))]
    return sorted(int(n.removeprefix("batch=")) for n in done)


def _merged(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """One row per (user, entity, shard, day) from the newest copy before ``upto`` and the batches behind it."""
    below = lambda numbers: [n for n in numbers if upto is None or n <= upto]
    copies = [n for n in below(_batches(spark, path, "folded")) if n != upto]
    newest = copies[-1] if copies else -1
    places = [f"{path}/folded/batch={newest}"] if copies else []
    places += [f"{path}/windows/batch={n}" for n in below(_batches(spark, path, "windows")) if n > newest]
    if not places:
        return spark.createDataFrame([], _WINDOWS)
    stored = spark.read.schema(_WINDOWS).parquet(*places)
    return stored.groupBy(*_KEYS, "day").agg(F.max("frequency").alias("frequency"), F.max("last_seen").alias("last_seen"))


def _fold(spark: SparkSession, path: str, number: int) -> None:
    """Merge all up to this batch into one copy. What the copy before it already held is deleted, so that a reader
    that started from that copy still finds its files."""
    earlier = [n for n in _batches(spark, path, "folded") if n < number]
    _merged(spark, path, number).write.mode("overwrite").parquet(f"{path}/folded/batch={number}")
    if earlier:
        files = Files(spark, path)
        old = [f"{path}/windows/batch={n}" for n in _batches(spark, path, "windows") if n <= earlier[-1]]
        for place in old + [f"{path}/folded/batch={n}" for n in earlier[:-1]]:
            files.fs.delete(files.place(place), True)


def read_activity(spark: SparkSession, path: str) -> DataFrame:
    """``(app_id, user_id, entity, frequency, last_seen)`` over all days."""
    return _merged(spark, path).groupBy(*SCOPE, "entity").agg(
        F.sum("frequency").alias("frequency"), F.max("last_seen").alias("last_seen")
    )


def read_activity_days(spark: SparkSession, path: str) -> DataFrame:
    """The same per day: ``(app_id, user_id, entity, day, frequency, last_seen)``."""
    return _merged(spark, path).groupBy(*SCOPE, "entity", "day").agg(
        F.sum("frequency").alias("frequency"), F.max("last_seen").alias("last_seen")
    )
