"""Exact duplicates by content-defined chunk recipes.

A text is normalised (each run of space and 0x09 to 0x0D becomes one space) and cut where a rolling hash of its
last bytes says so, so equal texts have equal chunks. Its recipe is the ordered list of chunk hashes. Only recipes
move between tasks; the bytes of a chunk move only if its recipe occurs more than once, and then once per map task
and distinct chunk. There, equal hashes are verified byte by byte: a chunk's identifier is its hash and its place
among the different chunks of that hash. Two texts are equal when their ordered identifier lists are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenfold.llm.batches import small_batches
from lumenfold.session import materialize, materialize_counting

#: Bytes of a chunk: at least, on average beyond that, at most.
LEAST, MEAN, MOST = 512, 2048, 16384
#: Up to this many repeated texts are sent to all tasks as 16-byte digests; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
_GEAR = np.random.default_rng(7).integers(0, 2**32, 256, dtype=np.uint32)
_SPACES = b" \t\n\x0b\x0c\r"


def normalised(text: bytes | None) -> bytes:
    if not text:
        return b""
    inner = b" ".join(text.split())
    if not inner:
        return b" "
    return b" " * (text[0] in _SPACES) + inner + b" " * (text[-1] in _SPACES)


def chunks(text: bytes) -> Iterator[bytes]:
    """The text in chunks; the empty text has none."""
    if len(text) <= LEAST:
        if text:
            yield text
        return
    start, piece = 0, 1 << 20
    ends: list[int] = []
    for at in range(0, len(text), piece):  # the hash needs the 31 bytes before, not the whole text
        lead = min(31, at)
        rolled = _GEAR[np.frombuffer(text, np.uint8, min(piece, len(text) - at) + lead, at - lead)]
        for k in (1, 2, 4, 8, 16):  # doubles the number of bytes that each hash covers
            rolled[k:] += rolled[:-k] << np.uint32(k)
        ends.extend((np.flatnonzero(rolled[lead:] >> np.uint32(32 - MEAN.bit_length() + 1) == 0) + at + 1).tolist())
    for end in [*ends, len(text)]:
        while end - start > MOST:
            yield text[start : start + MOST]
            start += MOST
        if end - start >= LEAST or end == len(text) and end > start:
            yield text[start:end]
            start = end


def chunk_hash(chunk: bytes, bits: int) -> int:
    return (xxhash.xxh3_64_intdigest(chunk) >> (64 - bits)) - (1 << (bits - 1))


def recipes(rows: DataFrame, bits: int = 64) -> DataFrame:
    """``rows`` with, in place of the binary column ``text``: text_sha256, n_bytes and the list ``recipe``."""
    others = [c for c in rows.columns if c != "text"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes, lists = [], [], []
            for text in batch.column("text"):
                plain = normalised(text.as_py())
                digests.append(hashlib.sha256(plain).hexdigest())
                sizes.append(len(plain))
                lists.append([chunk_hash(c, bits) for c in chunks(plain)])
            made = [pa.array(digests, pa.string()), pa.array(sizes, pa.int64()), pa.array(lists, pa.list_(pa.int64()))]
            yield pa.record_batch([*(batch.column(c) for c in others), *made], [*others, "text_sha256", "n_bytes", "recipe"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != "text")
    return rows.mapInArrow(cut, kept + "text_sha256 string, n_bytes bigint, recipe array<bigint>")


def chunk_rows(texts: DataFrame, bits: int = 64) -> DataFrame:
    """``text_key, pos, hash, chunk`` of some texts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("text_key").to_pylist(), batch.column("text"), strict=True):
                parts = list(chunks(normalised(text.as_py())))
                hashes = [chunk_hash(c, bits) for c in parts]
                made = [pa.array([key] * len(parts), pa.string()), pa.array(range(len(parts)), pa.int32()), pa.array(hashes, pa.int64()), pa.array(parts, pa.binary())]
                yield pa.record_batch(made, ["text_key", "pos", "hash", "chunk"])

    return texts.select("text_key", "text").mapInArrow(cut, "text_key string, pos int, hash bigint, chunk binary")


def exact_groups(docs: DataFrame, text: str = "text", id: str = "doc_id", bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    A null text counts as empty. Of equal texts the row with the smallest id stays, a null id comes last, and of
    rows that repeat that id exactly one stays. Other columns are ignored, whatever their names. ``bits`` is the
    width of the chunk hash, narrower only in tests of the verification.
    """
    every = _grouped(docs, text, id, bits)
    return every.select(F.col("id").alias(id), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")


def _grouped(docs: DataFrame, text: str, id: str, bits: int) -> DataFrame:
    """Of each row: id, row, text_key, text_sha256, group_size, keep_id, keep_row."""
    small_batches(docs.sparkSession)
    keyed = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    keyed = keyed.withColumn("text_key", F.md5("text"))
    rows = keyed.withColumn("row", F.monotonically_increasing_id())
    made = materialize(recipes(rows, bits).withColumn("recipe_key", F.xxhash64("recipe", "n_bytes")), "recipes")

    repeated = made.groupBy("recipe_key").agg(F.count("*").alias("rows")).where("rows > 1").select("recipe_key")
    candidate = materialize(made.join(repeated, "recipe_key", "left_semi"), "repeated-recipes")
    wanted, count = materialize_counting(candidate.select("text_key").distinct(), "repeated-texts", F.lit(True))
    wanted = F.broadcast(wanted) if count <= BROADCAST_ROWS else wanted
    cut = chunk_rows(keyed.join(wanted, "text_key", "left_semi"), bits)
    different = materialize(cut.select("hash", "chunk").distinct(), "chunks")

    # Hashes of one chunk are verified; the others are told apart by their bytes.
    shared = different.groupBy("hash").agg(F.count("*").alias("chunks")).where("chunks > 1").select("hash")
    nth = different.join(shared, "hash", "left_semi").withColumn("nth", F.row_number().over(Window.partitionBy("hash").orderBy("chunk")))
    told = cut.join(nth, ["hash", "chunk"]).select("text_key", "pos", "nth").distinct()
    told = materialize(told.groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("pos", "nth"))).alias("told")), "told-apart")
    listed = candidate.join(told, "text_key", "left").withColumn("told", F.coalesce("told", F.array().cast("array<struct<pos:int,nth:int>>")))

    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")).alias("first")
    group = listed.groupBy("recipe", "told").agg(F.count("*").alias("group_size"), first)
    # The list is compared whole above; the join back goes by the group's own number.
    group = group.withColumn("list_key", F.xxhash64("recipe", "told")).select("list_key", "recipe", "told", "group_size", "first")
    listed = listed.withColumn("list_key", F.xxhash64("recipe", "told"))
    same = [listed[c] == group[c] for c in ("list_key", "recipe", "told")]
    found = listed.join(group, same).select("id", "row", "text_key", "text_sha256", "group_size", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"))
    alone = made.join(repeated, "recipe_key", "left_anti")
    alone = alone.select("id", "row", "text_key", "text_sha256", F.lit(1).cast("bigint").alias("group_size"), F.col("id").alias("keep_id"), F.col("row").alias("keep_row"))
    return found.unionByName(alone)


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text another row, with a smaller doc_id, has too.

    A null doc_id counts as larger than all others; of rows with the same doc_id and text one stays. The texts stay
    where they are: the few (id, digest) pairs that go are sent to them. Only rows whose pair stays and stands there
    several times are brought together, one pair at a time, to keep one.
    """
    pair = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    plain = {name: f"_given_{k}" for k, name in enumerate(docs.columns)}  # the input's names cannot clash
    keyed = docs.select(pair.alias("_pair"), *[F.col(name).alias(new) for name, new in plain.items()])
    found = _grouped(docs, "text", "doc_id", 64).where("group_size > 1")
    named = F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("null")), "text_key").alias("_pair")
    pairs = found.groupBy(named).agg(F.count("*").alias("rows"), F.count(F.when(F.col("row") == F.col("keep_row"), 1)).alias("kept"))
    pairs, count = materialize_counting(pairs.where("rows > kept"), "pairs-that-go", F.lit(True))
    small = (lambda df: F.broadcast(df)) if count <= BROADCAST_ROWS else (lambda df: df)
    stay = keyed.join(small(pairs.select("_pair")), "_pair", "left_anti")
    again = keyed.join(small(pairs.where("kept > 0").select("_pair")), "_pair", "left_semi").dropDuplicates(["_pair"])
    return stay.unionByName(again).select(*[F.col(new).alias(name) for name, new in plain.items()])
