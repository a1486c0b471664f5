"""Toxicity by a weighted lexicon, matched by an Aho-Corasick automaton after folding.

Folding lowers letters, drops accents and marks of no width, and writes look-alike letters of other scripts, full
width forms and digits or signs that stand for letters as the Latin letter. The lexicon (words and beginnings of words) and its
weights are learned from labelled texts, as are the phrases in which a word is harmless. A text's score is a logistic
function of the weight it holds, in all and per hundred words.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.llm.batches import small_batches
from lumenfold.session import materialize

#: At most so many labelled texts are learned from, drawn by a hash of their ids.
FIT_ROWS = 20_000
#: Letters of a beginning of a word.
STEMS = (4, 5, 6, 7)
#: Least number of toxic texts that hold a term, and its least weight (log of the ratio of its shares).
_LEAST_TEXTS, _LEAST_WEIGHT = 4, 3.0
# Multipliers of the hashes by which copies of a text are known, and how many of them look for one.
_FACTORS = np.random.default_rng(1).integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = 4
#: Words that count without a labelled text, with the weight they start from.
SEEDS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown", "filth", "vermin", "imbecile")
_SEED_WEIGHT = 3.0
# Characters that are read as Latin letters.
LOOK_ALIKES = {
    "аɑα": "a", "ьбв": "b", "сϲ": "c", "ԁ": "d", "еєε": "e", "ɡ": "g", "һн": "h", "іıι": "i", "јϳ": "j", "кκ": "k", "ӏ": "l",
    "мμ": "m", "пη": "n", "оοσөø": "o", "рρ": "p", "ԛ": "q", "гѓ": "r", "ѕ": "s", "тτ": "t", "υս": "u", "νѵ": "v", "ԝω": "w",
    "хχ": "x", "уγү": "y", "ᴢ": "z",
}
# Digits and signs that stand for letters. i and l are one letter here, since 1 stands for both.
STAND_INS = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "i": "l"}
_NO_WIDTH = "­​‌‍⁠﻿"


def _folding() -> dict[int, str | None]:
    table: dict[int, str | None] = {}
    alike = {c: latin for many, latin in LOOK_ALIKES.items() for c in many}
    listed = [ord(x) for c in alike for x in (c, c.upper()) if len(x) == 1]
    for code in [*listed, *range(0x250), *range(0x370, 0x530), *range(0x1D00, 0x1D80), *range(0x1E00, 0x2000), *range(0x2000, 0x2070), *range(0xFF00, 0xFF5F)]:
        c = chr(code).lower()
        c = alike.get(c) or unicodedata.normalize("NFKD", chr(code)).lower()
        c = "".join(alike.get(x, x) for x in c if not unicodedata.combining(x))
        c = "".join(STAND_INS.get(x, x) for x in c)
        table[code] = c if c.isalnum() else "" if chr(code) in _NO_WIDTH else " "
    table |= dict.fromkeys(range(0x300, 0x370), None)
    for c in _NO_WIDTH:
        table[ord(c)] = None
    return table


_TABLE = _folding()
_SIGN_AFTER = re.compile(r"[@$]+(?!\w)")


def folded(text: str | None) -> str:
    """The text in folded letters, a space before, after and in place of everything that is no letter or digit."""
    text = text or ""
    if "$" in text or "@" in text:
        text = _SIGN_AFTER.sub(" ", text)
    return f" {text.translate(_TABLE)} "


@dataclass
class Lexicon:
    """terms: folded words (a space before and after) and beginnings (a space before) to weights."""

    terms: dict[str, float]
    harmless: list[str]
    weights: tuple[float, float, float] = (-4.0, 1.0, 1.0)

    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton()
        for phrase in self.harmless:
            made.add_word(phrase, (len(phrase), -1.0))
        for term, weight in self.terms.items():
            made.add_word(term, (len(term), weight))
        made.make_automaton()
        return made


def held(text: str, automaton: ahocorasick.Automaton) -> tuple[float, int, int]:
    """Summed weight, number of terms and number of words of a folded text.

    Of the terms that start at one word the heaviest counts. A term inside a harmless phrase does not count.
    """
    words = len(text.split())
    if not len(automaton):
        return 0.0, 0, words
    heaviest: dict[int, float] = {}
    harmless: list[tuple[int, int]] = []
    for end, (length, weight) in automaton.iter(text):
        start = end - length + 1
        if weight < 0:
            harmless.append((start, end))
        elif weight > heaviest.get(start, 0.0):
            heaviest[start] = weight
    counted = [w for start, w in heaviest.items() if not any(a <= start < b for a, b in harmless)] if harmless else heaviest.values()
    return float(sum(counted)), len(counted), words


def features(total: float, words: int) -> tuple[float, float]:
    return math.log1p(total), math.log1p(100 * total / max(words, 1))


def _terms(text: str) -> set[str]:
    found: set[str] = set()
    for word in set(text.split()):
        if len(word) > 2:
            found.add(f" {word} ")
            found.update(f" {word[:k]}" for k in STEMS if len(word) >= k)
    return found


def _signature(text: str) -> np.ndarray:
    """Least values of some hashes over a folded text's pairs of words; two texts agree in as many as they share pairs."""
    words = text.split()
    pairs = {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)} or {text}
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(p) for p in pairs), np.uint64, len(pairs))
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 1024):
        np.minimum(least, (hashes[at : at + 1024, None] * _FACTORS).min(0), out=least)
    return least


def copy_groups(signs: list[np.ndarray]) -> list[int]:
    """The group of each signature's text, named by its first: texts tied to one another by sharing most pairs of words."""
    root = list(range(len(signs)))

    def top(a: int) -> int:
        while root[a] != a:
            root[a] = a = root[root[a]]
        return a

    first: dict[tuple[int, bytes], int] = {}
    for nth, sign in enumerate(signs):
        for band in range(0, len(sign), _BAND):
            met = first.setdefault((band, sign[band : band + _BAND].tobytes()), nth)
            if met != nth and 2 * int((signs[met] == sign).sum()) >= len(sign):
                root[max(top(met), top(nth))] = min(top(met), top(nth))
    return [top(a) for a in range(len(signs))]


def learn(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, text: str = "text", id: str = "doc_id", label: str = "toxic") -> Lexicon:
    """A lexicon from at most ``rows`` labelled texts.

    It holds a few common words, which labels can weigh anew or drop, and every term that enough toxic texts hold and
    that weighs enough. Copies of a text, edited ones too, count as one text, so words that they share by chance do
    not enter. Labels other than 0 and 1 do not count.
    """
    small_batches(docs.sparkSession)
    chosen = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull()).groupBy(F.col(id).alias("id")).agg(F.max(label).alias("label"))
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(rows)
    sample = docs.join(F.broadcast(chosen), docs[id] == chosen["id"]).select(F.col("label").cast("int").alias("label"), F.col(text).alias("text"))
    sample = sample.withColumn("key", F.xxhash64(F.coalesce("text", F.lit(""))))
    sample = materialize(sample.repartition(16), "toxic-sample")

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = [_signature(folded(v)).tobytes() for v in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(signs, pa.binary())], ["key", "sign"])

    signs = sample.select("key", "text").mapInArrow(signed, "key bigint, sign binary").dropDuplicates(["key"]).orderBy("key").collect()
    groups = copy_groups([np.frombuffer(r["sign"], np.uint64) for r in signs])
    named = pa.table({"key": pa.array([r["key"] for r in signs], pa.int64()), "group": pa.array(groups, pa.int64())})
    sample = sample.join(F.broadcast(docs.sparkSession.createDataFrame(named)), "key")
    sizes = sample.groupBy("group").agg(F.count("*").alias("rows"), F.max("label").alias("bad"), F.max(1 - F.col("label")).alias("good"))
    sizes = [tuple(r) for r in sizes.collect()]
    bad, good = sum(r[2] for r in sizes), sum(r[3] for r in sizes)
    if not bad:
        return Lexicon({}, [])
    several = docs.sparkSession.createDataFrame([(r[0], True) for r in sizes if r[1] > 1], "group bigint, several boolean")
    sample = sample.join(F.broadcast(several), "group", "left")
    alone = F.col("several").isNull()

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for mark, group, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = list(_terms(folded(value)))
                columns = [pa.array([mark] * len(found), pa.int32()), pa.array([group] * len(found), pa.int64()), pa.array(found, pa.string())]
                yield pa.record_batch(columns, ["label", "group", "term"])

    seen = lambda part: part.select("label", "group", "text").mapInArrow(terms, "label int, group bigint, term string")
    # Where a text is its group, nothing has to be told apart.
    once = seen(sample.where(alone)).unionByName(seen(sample.where(~alone)).distinct())
    counts = once.groupBy("term").agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good"))
    weight = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    seeds = [folded(w) for w in SEEDS]
    counts = counts.withColumn("weight", weight).where((F.col("bad") >= _LEAST_TEXTS) & (F.col("weight") >= _LEAST_WEIGHT) | F.col("term").isin(seeds))
    counts = {r["term"]: r for r in counts.collect()}
    start = {t: counts[t]["weight"] if t in counts and counts[t]["bad"] + counts[t]["good"] >= _LEAST_TEXTS else _SEED_WEIGHT for t in seeds}
    kept = {t: r["weight"] for t, r in sorted(counts.items()) if t not in start}
    return _calibrated(sample.select("label", "text"), Lexicon({t: w for t, w in start.items() if w > 1} | kept, []))


def _calibrated(sample: DataFrame, lexicon: Lexicon) -> Lexicon:
    """The lexicon with harmless phrases and the logistic weights, from the same texts."""
    terms = lexicon.terms

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Lexicon(terms, []).automaton()
        for batch in batches:
            for mark, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = folded(value)
                if not len(automaton) or not any(True for _ in automaton.iter(text)):
                    continue
                words = text.split()
                held_by = {w for w in set(words) if f" {w} " in terms or any(f" {w[:k]}" in terms for k in STEMS if len(w) >= k)}
                near = {f" {a} {b} " for a, b in zip(words, words[1:], strict=False) if a in held_by or b in held_by}
                yield pa.record_batch([pa.array([mark] * len(near), pa.int32()), pa.array(list(near), pa.string())], ["label", "phrase"])

    seen = sample.select(F.col("label").cast("int"), "text").mapInArrow(phrases, "label int, phrase string")
    harmless = seen.groupBy("phrase").agg(F.sum("label").alias("bad"), F.count("*").alias("rows")).where("bad = 0 AND rows >= 3")
    made = Lexicon(terms, [r["phrase"] for r in harmless.orderBy(F.desc("rows"), "phrase").collect()])
    rows = weighed(sample, made).select("label", "toxic_weight", "n_words").collect()
    x = np.array([[1.0, *features(r["toxic_weight"], r["n_words"])] for r in rows])
    y = np.array([r["label"] for r in rows], float)
    w = np.array([-1.0, 1.0, 0.0])
    for _ in range(25):  # Newton's steps for a logistic regression with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3), x.T @ (y - p) - 0.1 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    made.weights = tuple(float(v) for v in w)
    return made


def weighed(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """``docs`` with, in place of the text: toxic_weight, n_terms, n_words."""
    made = ("toxic_weight", "n_terms", "n_words")
    others = [c for c in docs.columns if c not in (text, *made)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            found = [held(folded(v), automaton) for v in batch.column(text).to_pylist()]
            columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.float64(), pa.int64(), pa.int64()))]
            yield pa.record_batch([*(batch.column(c) for c in others), *columns], [*others, *made])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name in others)
    return docs.select(*others, text).mapInArrow(rows, kept + "toxic_weight double, n_terms bigint, n_words bigint")


def scored(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """``docs`` with toxic_weight, n_terms, n_words and ``score`` (0 to 1) in place of the text.

    Null and empty texts hold no terms and get the score of a text without any. Rows are scored one by one.
    """
    small_batches(docs.sparkSession)
    base, total, dense = lexicon.weights
    x = F.lit(base) + total * F.log1p("toxic_weight") + dense * F.log1p(100 * F.col("toxic_weight") / F.greatest("n_words", F.lit(1)))
    return weighed(docs, lexicon, text).withColumn("score", 1 / (1 + F.exp(-x)))
