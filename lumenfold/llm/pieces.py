"""SentencePiece encoding and decoding with a streaming Viterbi search.

The best segmentation is the one whose pieces' scores, as the model file gives them, have the largest sum; of equal
sums the search keeps the path that came first, which starts farther back. (For a file made by merging, scores are
ranks of merges; the best sum need not be what replaying the merges gives.) Spaces become U+2581 and one is put in
front. A character without a piece is written as its bytes and costs more than any piece.

The search reads a stream. It keeps the positions since its last commit and reads ahead by at most two lengths of the
longest piece; at least once in such a length it commits the ids up to where all paths that can still grow meet. Every
path passes the starts of words and lines, so a stretch between two of them that a task has met before is not searched
again: what the search gave is remembered. A text is fed in bounded parts; beside them only the text itself and its
packed ids are held, which are one row.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lumenfold.llm.batches import small_batches

SPACE = "▁"
_UNKNOWN_COST = 10.0
#: Stretches whose ids a worker process remembers before it starts anew (a text may add _MORE).
REMEMBERED = 900_000
_MORE, _LONGEST_REMEMBERED = 100_000, 48
#: No piece has this mark after another character, so a new search can start before a run of marks.
_UNIT = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_CUT_IN_LINE = re.compile(f"(?<![ {SPACE}])[ {SPACE}]")
_CUT = re.compile(f"{_CUT_IN_LINE.pattern}|\n")
#: Characters of a text, up to the next cut, that are fed at a time.
_AT_A_TIME = 1 << 15


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


_HELD: dict[bytes, tuple[Pieces, dict[str, bytes]]] = {}


class Pieces:
    """The normal pieces of a model with scores, and its byte pieces."""

    @classmethod
    def of_worker(cls, model: bytes) -> tuple[Pieces, dict[str, bytes]]:
        """The pieces that this process holds for the model, and what its tasks have remembered."""
        if model not in _HELD:
            _HELD.clear()
            _HELD[model] = (cls(model), {})
        return _HELD[model]

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        reader = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.names = [reader.id_to_piece(i) for i in range(reader.get_piece_size())]
        special = {i for i in range(len(self.names)) if reader.is_control(i) or reader.is_unknown(i) or reader.is_unused(i)}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.names) if reader.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.scores = {p: (reader.get_score(i), i) for i, p in enumerate(self.names) if i not in special and i not in self.byte_of}
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte pieces")
        if any(p.strip(SPACE) and SPACE in p.lstrip(SPACE) for p in self.scores):
            raise ValueError("pieces of this model reach over words")
        self.longest = max(map(len, self.scores))
        #: Score and id of a piece, None for what only begins one.
        self.table = dict.fromkeys((p[:k] for p in self.scores for k in range(1, len(p))), None) | self.scores
        self.lines = not any("\n" in p for p in self.scores)
        self.unknown = min(s for s, _ in self.scores.values()) - _UNKNOWN_COST
        self.written = [b"" if i in special else bytes([self.byte_of[i]]) if i in self.byte_of else p.encode() for i, p in enumerate(self.names)]

    def search(self, parts: Iterable[str]) -> Iterator[int]:
        """Ids of a stream of characters or longer parts, given out as soon as they are certain."""
        for ids in self._commits(parts):
            yield from ids

    def _commits(self, parts: Iterable[str]) -> Iterator[list[int]]:
        """The search: ids by commit."""
        parts = (part[k : k + self.longest] for part in parts for k in range(0, len(part), self.longest))
        look, longest, single, unknown = self.table.get, self.longest, self.scores, self.unknown
        window, position, ended = "", 0, False  # the window starts at the last commit
        best: list[tuple[float, int, int | None] | None] = [(0.0, 0, None)]  # by position: sum, length of last piece, its id
        while True:
            while not ended and len(window) < position + 2 * longest:
                part = next(parts, None)
                if part is None:
                    ended = True
                else:
                    window += part
                    best += [None] * len(part)
            size = len(window)
            if position == size:
                break
            # Pieces that start before `stop` lie in the window.
            stop = min(position + longest, size if ended else size - longest + 1)
            for at in range(position, stop):
                so_far = best[at][0]
                for k in range(at + 1, size + 1):
                    found = look(window[at:k], 0)  # nothing begins with what is longer than the longest piece
                    if found:
                        total, old = so_far + found[0], best[k]
                        if old is None or total > old[0]:
                            best[k] = (total, k - at, found[1])
                    elif found is not None:
                        break
                if window[at] not in single:
                    total, old = so_far + unknown, best[at + 1]
                    if old is None or total > old[0]:
                        best[at + 1] = (total, 1, None)
            position = stop
            # Paths that can still grow end at `position` or later; they meet where their ways back do.
            meet = position if position == size else self._meeting(best, position)
            if meet == size and ended:
                yield self._ids(best, window, meet)
                break
            if meet:
                yield self._ids(best, window, meet)
                window, best, position = window[meet:], best[meet:], position - meet

    @staticmethod
    def _meeting(best: list[tuple[float, int, int | None] | None], position: int) -> int:
        open_ends = {p for p in range(position, len(best)) if best[p]}
        while len(open_ends) > 1:
            last = max(open_ends)
            open_ends.remove(last)
            open_ends.add(last - best[last][1])
        return open_ends.pop()

    def _ids(self, best, window: str, end: int) -> list[int]:
        found: list[int] = []
        at = end
        while at:
            _, length, piece = best[at]
            if piece is None:
                found.extend(reversed([self.bytes[b] for b in window[at - length : at].encode()]))
            else:
                found.append(piece)
            at -= length
        return found[::-1]

    def _stretches(self, text: str) -> Iterator[list[str]]:
        """The text between places that every path passes, so a search can start anew there; some thousand at a time."""
        at, cut = 0, _CUT if self.lines else _CUT_IN_LINE
        while at < len(text):
            place = cut.search(text, at + _AT_A_TIME)
            end = place.start() if place else len(text)
            found: list[str] = []
            # A character that no piece holds is a stretch of its own, so there is one at every line.
            for nth, line in enumerate(text[at:end].split("\n") if self.lines else (text[at:end],)):
                if nth:
                    found.append("\n")
                front = SPACE if not nth and not at else ""
                if not line and not front:
                    continue
                if line[:1] == " " or "  " in line or SPACE in line:
                    found += _UNIT.findall(front + line.replace(" ", SPACE))
                else:
                    first, *words = line.split(" ")
                    found.append(front + first)
                    found += [SPACE + word for word in words]
            yield found
            at = end

    def encode(self, text: str, known: dict[str, bytes]) -> np.ndarray:
        """The ids of a text."""
        return self.encode_checked(text, known)[0]

    def encode_checked(self, text: str, known: dict[str, bytes]) -> tuple[np.ndarray, bool]:
        """The ids of a text, and whether they decode to it.

        ``known`` remembers, as packed numbers, what the search gave for short stretches. Each stretch is decoded when
        it is searched, and one that does not give itself again is not remembered; the text is its stretches in a row.
        """
        packed: list[bytes] = []
        same = SPACE not in text
        for stretches in self._stretches(text):
            found = list(map(known.get, stretches))
            if None in found:
                if len(known) >= REMEMBERED:
                    known.clear()
                for at, ids in enumerate(found):
                    if ids is None:
                        stretch = stretches[at]
                        ids = known.get(stretch)
                        if ids is None:
                            found_ids = array("i")
                            for committed in self._commits((stretch,)):
                                found_ids.extend(committed)
                            ids = found_ids.tobytes()
                            back = b"".join(map(self.written.__getitem__, found_ids)) == stretch.encode()
                            same = same and back
                            if back and len(stretch) <= _LONGEST_REMEMBERED and len(known) < REMEMBERED + _MORE:
                                known[stretch] = ids
                        found[at] = ids
            packed.append(b"".join(found))
        return np.frombuffer(b"".join(packed), np.int32), same

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids. Bytes that form no character become U+FFFD; ids that stand for no text are left out."""
        text = b"".join(map(self.written.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


def encode(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """``docs`` with, in place of the text: ids, n_tokens and round_trip (whether decoding gives the text again).

    Null and empty texts have no ids, and round_trip is true. A text that holds U+2581 itself decodes to a space
    there, so its round_trip is false. Rows are encoded one by one; new columns replace old ones of that name.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    made = ("ids", "n_tokens", "round_trip")
    others = [c for c in docs.columns if c not in (text, *made)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, known = Pieces.of_worker(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                lists, same = [], []
                for value in batch.column(text).to_pylist():
                    ids, back = pieces.encode_checked(value or "", known)
                    lists.append(ids)
                    same.append(back)
                ends = np.cumsum([0, *map(len, lists)])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(lists)))
                sizes = pa.array(np.diff(ends), pa.int64())
                yield pa.record_batch([*(batch.column(c) for c in others), ids, sizes, pa.array(same)], [*others, *made])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name in others)
    return docs.select(*others, text).mapInArrow(rows, kept + "ids array<int>, n_tokens bigint, round_trip boolean")


def decode(encoded: DataFrame, model: bytes, ids: str = "ids") -> DataFrame:
    """``encoded`` with the column ``text`` in place of the ids; null lists give null."""
    small_batches(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    others = [c for c in encoded.columns if c not in (ids, "text")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, _ = Pieces.of_worker(shared.value)
        for batch in batches:
            texts = [None if v is None else pieces.decode(v) for v in batch.column(ids).to_pylist()]
            yield pa.record_batch([*(batch.column(c) for c in others), pa.array(texts, pa.string())], [*others, "text"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in encoded.schema if f.name in others)
    return encoded.select(*others, ids).mapInArrow(rows, kept + "text string")
