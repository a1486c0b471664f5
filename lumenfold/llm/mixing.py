"""Mixing sources to target weights by capped water-filling, and seeded whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenfold.session import materialize, materialize_counting

#: A document is taken at most this many times.
EPOCHS = 3
#: Up to this many sources are sent to all tasks (some 50 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Hexadecimal digits of the drawing key that name a bucket: 4096 per source.
_BUCKET_DIGITS = 3


def source_key(source: Column) -> Column:
    """Sorts as the source does, with null last, and is never null."""
    return F.coalesce(F.concat(F.lit("a"), source.cast("string")), F.lit("z"))


def cyclic_weights(sources: DataFrame, cycle: list[float], partitions: int = 16) -> DataFrame:
    """``key, weight``: the weights of the cycle in turn, by the order of ``key`` (distinct).

    Keys are numbered inside ranges, and the ranges' sizes are added up, so no task sees all of them.
    """
    ranged = sources.repartitionByRange(partitions, "key").withColumn("range", F.spark_partition_id())
    ranged = materialize(ranged, "source-ranges")
    sizes = ranged.groupBy("range").agg(F.count("*").alias("rows"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # at most `partitions` rows
    starts = sizes.select("range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    place = F.col("start") + F.row_number().over(Window.partitionBy("range").orderBy("key")) - 1
    numbered = ranged.join(starts, "range").select("key", place.alias("place"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (F.col("place") % len(cycle) + 1).cast("int"))
    return numbered.select("key", weight.alias("weight"))


def water_fill(sources: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """``sources`` (key, size, weight) with ``target``: shares of the sum of all sizes by weight, capped.

    While a source stands above ``epochs`` times its size it is clamped there and the rest is shared by weight
    among the others. Each round is one aggregate over the sources; the driver sees two sums. Each round clamps
    at least one more source, usually all of them in two or three rounds. Sources of size zero get zero.
    """
    total = sources.agg(F.sum("size")).first()[0] or 0
    cap = F.col("size") * epochs
    level, clamped = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("weight") * F.lit(level) > cap
        row = sources.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)).alias("held"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
            F.count(F.when(above, 1)).alias("clamped"),
        ).first()
        if row["clamped"] == clamped or not row["weight"]:
            break
        level, clamped = (total - row["held"]) / row["weight"], row["clamped"]
    if level is None:  # no sources, or no weight at all
        return sources.withColumn("target", F.lit(0.0))
    above = F.col("weight") * F.lit(level) > cap
    return sources.withColumn("target", F.when(above, cap.cast("double")).otherwise(F.col("weight") * F.lit(level)))


def drawing_key(seed: int, id: str) -> Column:
    """The seeded hash of the id that decides the order of a source's rows; null ids share one."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))))


def mix(docs: DataFrame, size: Column, cycle: list[float], seed: int = 0, epochs: int = EPOCHS, source: str = "source", id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, repeats, taken (repeats times size).

    With share = target / source_size, every document is taken floor(share) times. The rest of the target is
    filled in the order of a seeded hash of the id, as long as half of the next document still fits, so a source
    misses its target by half a document at most. The running sums are formed over buckets of that hash and then
    inside the one bucket where the target is reached, so a hot source is never in one task. Null ids share a
    hash; rows with equal hashes are drawn smaller ones first, so that reruns agree. A null source is a source.
    """
    drawn = drawing_key(seed, id)
    rows = docs.select(F.col(id).alias("id"), source_key(F.col(source)).alias("key"), size.cast("bigint").alias("size"), drawn.alias("drawn"))
    rows = materialize(rows.withColumn("bucket", F.substring("drawn", 1, _BUCKET_DIGITS)), "mix-sizes")
    found = _taken(rows, cycle, epochs)
    return found.select(F.col("id").alias(id), "size", "source_size", "target", "repeats", (F.col("repeats") * F.col("size")).alias("taken"))


def _taken(rows: DataFrame, cycle: list[float], epochs: int) -> DataFrame:
    """``rows`` (id, key, size, drawn, bucket) with source_size, target, whole, more and repeats."""
    sums = rows.groupBy("key", "bucket").agg(F.sum("size").alias("size"))
    totals = materialize(sums.groupBy("key").agg(F.sum("size").alias("size")), "mix-sources")
    filled = water_fill(materialize(totals.join(cyclic_weights(totals.select("key"), cycle), "key"), "mix-weights"), epochs)

    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    filled = filled.select("key", F.col("size").alias("source_size"), "target")
    filled = filled.withColumn("whole", F.floor(share)).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    upto = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    buckets = sums.withColumn("end", F.sum("size").over(upto)).join(filled, "key")
    buckets = buckets.select("key", "bucket", "source_size", "target", "whole", "rest", "end", (F.col("end") - F.col("size")).alias("start"))
    joined = rows.join(materialize(buckets, "mix-buckets"), ["key", "bucket"])
    inside = joined.where("rest <= start OR rest >= end").withColumn("more", (F.col("end") <= F.col("rest")) & (F.col("rest") > 0))
    within = Window.partitionBy("key", "bucket").orderBy("drawn", "size").rowsBetween(Window.unboundedPreceding, 0)
    edge = joined.where("rest > start AND rest < end")
    edge = edge.withColumn("more", 2 * (F.col("start") + F.sum("size").over(within)) - F.col("size") < 2 * F.col("rest"))
    return inside.unionByName(edge).withColumn("repeats", F.col("whole") + F.col("more").cast("bigint"))


def mixed_rows(docs: DataFrame, size: Column, cycle: list[float], seed: int = 0, epochs: int = EPOCHS, source: str = "source", id: str = "doc_id") -> DataFrame:
    """Each row of ``docs`` as often as ``mix`` takes it.

    The rows stay where they are: whether a row is taken once more follows from its source's share and from where its
    drawing key lies, which is the same for all rows of a bucket but the one in which the source's target is reached.
    Of that bucket's rows the sizes are summed up per drawing key and size; rows equal in both are taken alike up to
    the number that is left for them, told apart by a hash of the row. Null ids and repeated ids are rows like others.
    """
    plain = {name: f"_given_{k}" for k, name in enumerate(docs.columns)}  # the input's names cannot clash
    keyed = docs.select(
        *[F.col(name).alias(new) for name, new in plain.items()],
        source_key(F.col(source)).alias("key"),
        size.cast("bigint").alias("size"),
        drawing_key(seed, id).alias("drawn"),
    ).withColumn("bucket", F.substring("drawn", 1, _BUCKET_DIGITS))
    measured = materialize(keyed.select(F.lit(None).cast("string").alias("id"), "key", "size", "drawn", "bucket"), "mix-sizes")
    taken = materialize(_taken(measured, cycle, epochs).select("key", "bucket", "drawn", "size", "repeats", "whole", "rest", "start", "end"), "mix-taken")
    split = F.expr("rest > start AND rest < end")
    sources = taken.groupBy("key").agg(
        F.first("whole").alias("whole"), F.max(F.when(split, F.col("bucket"))).alias("edge"), F.max(F.when(~split & (F.col("repeats") > F.col("whole")), F.col("bucket"))).alias("upto")
    )
    sources, count = materialize_counting(sources, "mix-shares", F.lit(True))
    placed = keyed.join(F.broadcast(sources) if count <= BROADCAST_ROWS else sources, "key")
    more = F.coalesce(F.col("bucket") <= F.col("upto"), F.lit(False)).cast("bigint")
    alike = placed.where("edge IS NULL OR bucket <> edge").withColumn("repeats", F.col("whole") + more)
    edges = taken.where(split).groupBy("key", "drawn", "size").agg(F.min("repeats").alias("fewest"), F.sum("repeats").alias("sum"), F.count("*").alias("rows"))
    # Of a source, one row in 4,096 is in that bucket; only those move.
    apart = placed.where("bucket = edge").join(edges, ["key", "drawn", "size"])
    order = Window.partitionBy("key", "drawn", "size").orderBy(F.xxhash64(*[F.col(c) for c in plain.values()]))
    extra = F.col("sum") - F.col("fewest") * F.col("rows")
    single = apart.where("sum = fewest * rows").withColumn("repeats", F.col("fewest"))
    several = apart.where("sum <> fewest * rows").withColumn("repeats", F.col("fewest") + (F.row_number().over(order) <= extra).cast("bigint"))
    columns = [*plain.values(), "repeats"]
    every = alike.select(*columns).unionByName(single.select(*columns)).unionByName(several.select(*columns)).where("repeats > 0")
    copies = every.select(*plain.values(), F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))).alias("_copy"))
    return copies.select(*[F.col(new).alias(name) for name, new in plain.items()])
