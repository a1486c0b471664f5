"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

Letters fall into groups by their code point. A word's vector has, per group, the number of its letters; the trie has
one level per group, and a path to a leaf spells a vector. One inserted, deleted or replaced letter changes a vector by
a surplus of one, a deficit of one, or one of each. So the words near a word lie in the leaves that a depth-first
search reaches which may spend one surplus and one deficit on its way down. Words of a leaf agree in length and are
looked up by their first and by their last half, of which one edit leaves one as it is; what is found is verified.

The upper levels of the trie, down to nodes with a bounded number of words, are the key that words are dealt by: each
word is sent to its own node and, as a question, to all nodes that the search reaches with what is left of its budget.
Below, each task builds the rest of its trie. A leaf with more words than that is dealt in tiles.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.llm.batches import small_batches
from lumenfold.session import materialize, materialize_counting

#: A maximal run of letters, after A to Z were lowered.
_RUN = re.compile("[a-z\u00c0-\u00ff]+")
GROUPS = 16
#: Different words that a task counts before it hands on their sums.
_HELD_WORDS = 200_000
#: A node with more words is split. With more words in all the bound rises, so that at most NODES are split.
CELL_WORDS, NODES = 16_384, 1 << 16
#: Leaves with fewer words are verified one by one.
_SCANNED = 6


def word_counts(docs: DataFrame, drop: int | None = None, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``word, n``: how often each lower-cased run of letters occurs, added up per task first.

    With ``drop``, h is the crc32 of ``id:run``, and where ``drop`` divides h the run loses its letter h % length.
    Null and empty texts have no runs; a null id counts as an empty one.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id).cast("string").alias("id"), F.col(text).cast("binary").alias("text"))

    def batch(counts: Counter) -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for given in batches:
            for name, value in zip(given.column("id").to_pylist(), given.column("text").to_pylist(), strict=True):
                runs = Counter(_RUN.findall((value or b"").lower().decode()))  # of bytes, only A to Z are lowered
                if drop:
                    runs = _dropped(runs, zlib.crc32(f"{name or ''}:".encode()), drop)
                total.update(runs)
                if len(total) > _HELD_WORDS:
                    yield batch(total)
                    total.clear()
        yield batch(total)

    return rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _dropped(runs: Counter, head: int, drop: int) -> Counter:
    crc = zlib.crc32
    cut = [(run, h) for run in runs if not (h := crc(run.encode(), head)) % drop]
    for run, n in [(run, runs.pop(run)) for run, _ in cut]:  # all go before the first comes back under another name
        h = crc(run.encode(), head)
        at = h % len(run)
        runs[run[:at] + run[at + 1 :]] += n
    return runs


def vector(word: str) -> list[int]:
    counts = [0] * GROUPS
    for letter in word:
        counts[ord(letter) % GROUPS] += 1
    return counts


def is_near(a: str, b: str) -> bool:
    """Whether exactly one letter is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    at = 0
    while at < len(a) and a[at] == b[at]:
        at += 1
    if len(a) == len(b):
        return at < len(a) and a[at + 1 :] == b[at + 1 :]
    return len(b) - len(a) == 1 and a[at:] == b[at + 1 :]


class Leaf:
    """Words of one vector, so of one length."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        # One edit leaves the first `head` or the last `tail` letters of a word of this length as they are.
        self.head = (len(words[0]) - 1) // 2
        self.tail = len(words[0]) - 1 - self.head
        self.by_head = None
        if len(words) >= _SCANNED:
            self.by_head, self.by_tail = defaultdict(list), defaultdict(list)
            for word in words:
                self.by_head[word[: self.head]].append(word)
                self.by_tail[word[len(word) - self.tail :]].append(word)

    def near(self, word: str) -> list[str]:
        if self.by_head is None:
            return [w for w in self.words if is_near(word, w)]
        head = word[: self.head]
        found = [w for w in self.by_head.get(head, ()) if is_near(word, w)]
        others = self.by_tail.get(word[len(word) - self.tail :], ())
        return found + [w for w in others if w[: self.head] != head and is_near(word, w)]


class Trie:
    """Nested tables by group count from level ``depth`` on; what lies below the last level is a leaf."""

    def __init__(self, vectors: dict[tuple[int, ...], list[str]], depth: int) -> None:
        self.root: dict = {}
        for counts, words in vectors.items():
            path, node = counts[depth:] or (0,), self.root
            for c in path[:-1]:
                node = node.setdefault(c, {})
            node[path[-1]] = Leaf(words)

    def leaves(self, path: tuple[int, ...], surplus: int, deficit: int) -> list[Leaf]:
        """Leaves whose vectors exceed ``path`` by at most ``surplus`` and lack at most ``deficit``."""
        last, found = len(path) - 1, []
        stack = [(self.root, 0, surplus, deficit)]
        while stack:
            node, at, more, less = stack.pop()
            c = path[at]
            for child, a, b in ((node.get(c), more, less), (node.get(c + 1) if more else None, more - 1, less), (node.get(c - 1) if less else None, more, less - 1)):
                if child is not None:
                    if at == last:
                        found.append(child)
                    else:
                        stack.append((child, at + 1, a, b))
        return found


def cells_of(counts: list[int], split: dict[str, int]) -> Iterator[tuple[str, int, int]]:
    """Nodes of the upper trie that the search for this vector reaches: path, surplus left, deficit left."""
    stack = [("", 0, 1, 1)]
    while stack:
        path, depth, more, less = stack.pop()
        if depth == GROUPS or path not in split:
            yield path, more, less
            continue
        head = path + "," if depth else ""
        c = counts[depth]
        stack.append((f"{head}{c}", depth + 1, more, less))
        if more:
            stack.append((f"{head}{c + 1}", depth + 1, more - 1, less))
        if less and c:
            stack.append((f"{head}{c - 1}", depth + 1, more, less - 1))


def _dealt(words: DataFrame, split: dict[str, int], limit: int) -> DataFrame:
    """A row per word and node of the upper trie that it belongs to or asks: cell, depth, more, less, home, word, n, counts."""
    shared = words.sparkSession.sparkContext.broadcast(split)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes = shared.value
        for batch in batches:
            rows = []
            for word, n, path in zip(*(batch.column(c).to_pylist() for c in ("word", "n", "vector")), strict=True):
                counts = [int(c) for c in path.split(",")]
                for cell, more, less in cells_of(counts, nodes):
                    depth = cell.count(",") + 1 if cell else 0
                    # Only a whole vector can still stand here with too many words: they are dealt in tiles.
                    tiles = -(-nodes.get(cell, 0) // limit) or 1
                    own = zlib.crc32(word.encode()) % tiles
                    home = more == less == 1
                    rows += [(f"{cell};{k}" if k else cell, depth, more, less, home and k == own, word, n, path) for k in range(tiles)]
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.string(), pa.int64(), pa.string())
            made = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 8, kinds, strict=True)]
            yield pa.record_batch(made, ["cell", "depth", "more", "less", "home", "word", "n", "vector"])

    return words.mapInArrow(deal, "cell string, depth int, more int, less int, home boolean, word string, n bigint, vector string")


def near_words(words: DataFrame, dominance: int, cell_words: int = CELL_WORDS) -> DataFrame:
    """``word, n_near, form, form_n`` of the words (word, n; distinct) that are near another one.

    ``form`` is the near word with the largest n (of equal ones the first in order of code points) if that is at least
    ``dominance`` times the word's own, else null, as is ``form_n``. ``cell_words`` decides only how the work is cut.
    """

    def add_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [",".join(map(str, vector(w))) for w in batch.column("word").to_pylist()]
            yield pa.record_batch([batch.column("word"), batch.column("n"), pa.array(paths, pa.string())], ["word", "n", "vector"])

    worded, total = materialize_counting(words.select("word", "n").mapInArrow(add_vectors, "word string, n bigint, vector string"), "words", F.lit(True))
    limit = max(cell_words, -(-total * (GROUPS + 1) // NODES))
    vectors = worded.groupBy("vector").agg(F.count("*").alias("rows"))
    paths = F.transform(F.sequence(F.lit(1), F.lit(GROUPS)), lambda k: F.array_join(F.slice(F.split("vector", ","), F.lit(1), k), ","))
    nodes = vectors.select("rows", F.explode(paths).alias("path")).groupBy("path").agg(F.sum("rows").alias("rows")).where(F.col("rows") > limit)
    # At most NODES rows: on each of the GROUPS + 1 levels, nodes with more than `limit` of all words.
    split = {r["path"]: r["rows"] for r in nodes.collect()} | ({"": total} if total > limit else {})

    def search(table: pa.Table) -> pa.Table:
        depth = table.column("depth")[0].as_py()
        names, sizes, paths, homes, mores, lesses = (table.column(c).to_pylist() for c in ("word", "n", "vector", "home", "more", "less"))
        seen: dict[str, tuple[int, ...]] = {p: tuple(int(c) for c in p.split(",")) for p in set(paths)}
        members, n_of = defaultdict(list), {}
        for word, n, path, home in zip(names, sizes, paths, homes, strict=True):
            if home:
                members[seen[path]].append(word)
                n_of[word] = n
        trie, reached, rows = Trie(members, depth), {}, []
        for word, n, path, more, less in zip(names, sizes, paths, mores, lesses, strict=True):
            key = (path, more, less)
            if key not in reached:
                reached[key] = trie.leaves(seen[path][depth:] or (0,), more, less)
            found = [w for leaf in reached[key] for w in leaf.near(word)]
            if found:
                best = min(found, key=lambda w: (-n_of[w], w))
                rows.append((word, len(found), best, n_of[best]))
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
        made = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 4, kinds, strict=True)]
        return pa.table(made, ["word", "n_near", "form", "form_n"])

    found = _dealt(worded, split, limit).groupBy("cell").applyInArrow(search, "word string, n_near bigint, form string, form_n bigint")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).join(worded.select("word", "n"), "word")
    better = -F.col("best.less") >= dominance * F.col("n")
    return found.select("word", "n_near", F.when(better, F.col("best.form")).alias("form"), F.when(better, -F.col("best.less")).alias("form_n"))


def followed(forms: DataFrame) -> DataFrame:
    """``word, root`` of words with a form: the last word on the way from form to form.

    A form occurs more often than its word, so there are no circles; each round doubles the way that is known.
    """
    ways = materialize(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "forms")
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = ways.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        longer, moved = materialize_counting(longer, "forms", F.col("moved"))
        ways = longer.drop("moved")
        if not moved:
            return ways


def variants(words: DataFrame, least_length: int = 6, least_count: int = 5, dominance: int = 5, cell_words: int = CELL_WORDS) -> DataFrame:
    """One row per word of ``words`` (word, n; distinct) that is long and frequent enough: word, n, n_near, form, form_n, root.

    Words are near that differ by exactly one inserted, deleted or replaced code point. ``form`` and ``form_n`` are as
    in ``near_words``; ``root`` is where the way from form to form ends, the word itself if it has none. Null words go.
    """
    kept = materialize(words.where((F.length("word") >= least_length) & (F.col("n") >= least_count)).select("word", "n"), "vocabulary")
    near = materialize(near_words(kept, dominance, cell_words), "near-words")
    found = kept.join(near, "word", "left").join(followed(near), "word", "left")
    return found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))
