"""Packing texts into training sequences: bounded-space online best fit, then a merge of what is left open.

A document is its token ids and an end id. Of a long one, whole sequences leave at once; the rest of it, like every
shorter one, goes into the fullest of a fixed number of open windows that still has room for it. If none has and no
further window may be opened, the fullest is emitted; when its gap is worth a cut, the document's first ids fill it.

Each partition packs its own documents and holds nothing but its open windows. At its end they are left open. These
leftovers, a bounded number per partition, are merged by groups of partitions with the same packer, longest piece
first, until one group is left; its last windows are filled up by cutting. So all sequences but the very last lack
less than the least cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.llm.batches import small_batches
from lumenfold.llm.byte_ids import ByteIds
from lumenfold.session import materialize, materialize_counting

#: Tokens of a sequence, open windows of a packer, and the shortest piece that a cut may make to fill a gap.
LENGTH, WINDOWS, LEAST_CUT = 1024, 64, 8
#: Partitions whose leftovers one task merges.
FAN_IN_BITS = 4
_ROWS_OUT = 4096
_COLUMNS = ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]


class Packer:
    """At most ``windows`` open windows; a piece is a tuple whose last field is its ids."""

    def __init__(self, length: int, windows: int, least_cut: int) -> None:
        self.length, self.windows, self.least_cut = length, windows, least_cut
        self.open: list[tuple[int, list[tuple]]] = []  # tokens and pieces, fullest first

    def add(self, head: tuple, start: int, ids: np.ndarray) -> Iterator[list[tuple]]:
        """Windows that are emitted when this piece is placed."""
        while len(ids) >= self.length:
            yield [(*head, start, ids[: self.length])]
            start, ids = start + self.length, ids[self.length :]
        while len(ids):
            # Windows are in order, so the first that has room is the best fit.
            at = next((k for k, (used, _) in enumerate(self.open) if used + len(ids) <= self.length), None)
            if at is None and len(self.open) == self.windows:
                used, pieces = self.open.pop(0)
                gap = self.length - used
                if gap >= self.least_cut:
                    pieces.append((*head, start, ids[:gap]))
                    start, ids = start + gap, ids[gap:]
                yield pieces
                continue
            used, pieces = self.open.pop(at) if at is not None else (0, [])
            pieces.append((*head, start, ids))
            used += len(ids)
            if used == self.length:
                yield pieces
            else:
                place = next((k for k, (other, _) in enumerate(self.open) if other < used), len(self.open))
                self.open.insert(place, (used, pieces))
            return

    def close(self) -> Iterator[list[tuple]]:
        """The last windows: what is open is laid end to end and cut where a sequence ends."""
        pieces: list[tuple] = []
        used = 0
        for _, held in self.open:
            for *head, start, ids in held:
                while len(ids):
                    part = ids[: self.length - used]
                    pieces.append((*head, start, part))
                    used += len(part)
                    start, ids = start + len(part), ids[len(part) :]
                    if used == self.length:
                        yield pieces
                        pieces, used = [], 0
        self.open = []
        if pieces:
            yield pieces


class _Rows:
    """Windows as Arrow rows; ``sequence_id`` has the round in its first bits, then the group, then a number."""

    def __init__(self, first_id: int, kind: pa.DataType) -> None:
        self.next_id, self.kind, self.rows = first_id, kind, []

    def put(self, pieces: list[tuple]) -> None:
        offset = 0
        for id, total, start, ids in pieces:
            self.rows.append((id, start, len(ids), total, self.next_id, offset, ids))
            offset += len(ids)
        self.next_id += 1

    def batch(self, group: int, open: bool) -> pa.RecordBatch:
        id, start, length, total, sequence, offset, ids = zip(*self.rows, strict=True) if self.rows else [()] * 7
        ends = np.cumsum([0, *length])
        flat = pa.array(np.concatenate(ids).view(np.int32) if ids else np.empty(0, np.int32))
        numbers = [pa.array(c, pa.int64()) for c in (start, length, total, sequence, offset)]
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
        marks = [pa.array([group] * len(id), pa.int64()), pa.array([open] * len(id), pa.bool_())]
        self.rows = []
        return pa.record_batch([pa.array(id, self.kind), *numbers, lists, *marks], [*_COLUMNS, "group", "open"])


def pack(
    docs: DataFrame, model: str, end_id: int, length: int = LENGTH, windows: int = WINDOWS, least_cut: int = LEAST_CUT, text: str = "text", id: str = "doc_id"
) -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, sequence_id, offset, ids.

    ``start`` counts the document's ids before the piece, ``offset`` the ids before it in its sequence. Every id of
    every document, its ``end_id`` included, lies in one piece. A null or empty text is one piece, the ``end_id``.
    Rows with equal or null ids are documents of their own. A long text is encoded in parts; its ids and the open
    windows are what a task holds. Other columns are ignored. No rows give none. The order of rows inside a partition
    decides how they are packed; the packed pieces are stored, so a lost executor changes nothing.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    plain = rows.schema["id"].dataType.simpleString()
    schema = f"id {plain}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids array<int>, group bigint, open boolean"
    end = np.array([end_id], np.uint32)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer, out = ByteIds.of_worker(shared.value), Packer(length, windows, least_cut), None
        group = TaskContext.get().partitionId()
        for batch in batches:
            out = out or _Rows(group << 24, batch.column("id").type)
            for name, encoded in zip(batch.column("id").to_pylist(), encoder.encode(batch.column("text")), strict=True):
                ids = np.concatenate([encoded, end])
                for pieces in packer.add((name, len(ids)), 0, ids):
                    out.put(pieces)
                if len(out.rows) >= _ROWS_OUT:
                    yield out.batch(group, False)
        if out:
            yield out.batch(group, False)
            for _, pieces in packer.open:
                out.put(pieces)
            yield out.batch(group, True)

    stored = materialize(rows.mapInArrow(place, schema), "packed")
    done, left, round_ = [stored.where("NOT open")], stored.where("open"), 0
    groups = left.agg(F.max("group")).first()[0]
    while groups is not None:
        round_ += 1
        last = groups >> FAN_IN_BITS == 0
        merged, _ = materialize_counting(_merged(left, round_, last, length, windows, least_cut, schema), "merged", F.lit(True))
        done.append(merged.where("NOT open"))
        left, groups = merged.where("open"), None if last else groups >> FAN_IN_BITS
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    return found.select(F.col("id").alias(id), *_COLUMNS[1:])


def _merged(left: DataFrame, round_: int, last: bool, length: int, windows: int, least_cut: int, schema: str) -> DataFrame:
    """The open windows of each group of partitions packed together; in the last round all are closed."""

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("group", "ascending"), ("sequence_id", "ascending"), ("offset", "ascending")])
        group = table.column("into")[0].as_py()
        packer, out = Packer(length, windows, least_cut), _Rows((round_ << 56) | (group << 24), table.column("id").type)
        names, totals, starts = (table.column(c).to_pylist() for c in ("id", "doc_tokens", "start"))
        for at, ids in enumerate(table.column("ids")):
            for pieces in packer.add((names[at], totals[at]), starts[at], ids.values.to_numpy().view(np.uint32)):
                out.put(pieces)
        for pieces in packer.close() if last else ():
            out.put(pieces)
        closed = out.batch(group, False)
        for _, pieces in packer.open:
            out.put(pieces)
        return pa.Table.from_batches([closed, out.batch(group, True)])

    into = F.shiftright("group", FAN_IN_BITS).alias("into")
    return left.select("*", into).groupBy("into").applyInArrow(merge, schema)
