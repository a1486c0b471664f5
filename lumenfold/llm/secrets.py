"""Secret scans: fixed patterns, and character Markov models of random strings against ordinary identifiers.

Positions come from splitting a text at the matches: the pieces between matches and the matches themselves, in
turn, add up to the text. A long run of token characters that no pattern covers is scored by two first-order Markov
models, one of random strings and one of identifiers, both counted from labelled samples; it is a secret when the
log-likelihood ratio per character is high enough. Everything is made of DataFrame functions.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lumenfold.llm.fence import fenced

#: Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "markov")
# The patterns of the three plain kinds. A run of a fixed class is taken whole, so a least length can
# stand in the pattern itself; an assignment is matched first and measured afterwards.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
ACCESS = r"(AKIA[A-Z0-9]{14,})"
HEX = r"([0-9a-f]{16,})"
ASSIGN_WORDS = ("password", "passwd", "secret", "token")
ASSIGN_LEAST = 12

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CLASS = "A-Za-z0-9+/_=-"
RUN_LEAST = 16
RUN = rf"((?<![{_CLASS}])[{_CLASS}]{{{RUN_LEAST},}})"
#: Log-likelihood ratio per character from which a run is a secret.
THRESHOLD = 0.35
#: At most so many documents give training samples.
FIT_DOCUMENTS = 400


_SPANS = "array<struct<start:int,kind:int,end:int,match:string>>"
_FAR = 2**31 - 1


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it stands there."""
    return F.transform(F.array(value), use)[0]


def _running(values: Column, add: Callable[[Column, Column], Column], start: int) -> Column:
    """Element k is what the first k + 1 values add up to.

    Values are taken by pieces of about the root of their number, so the work grows with its power of 1.5 and
    nothing is appended to a growing array.
    """

    def pieces(given: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(given))).cast("int")
        return F.transform(F.sequence(F.lit(0), F.ceil(F.size(given) / width).cast("int") - 1), lambda c: F.slice(given, c * width + 1, width))

    def whole(array: Column, count: Column) -> Column:
        return F.aggregate(F.slice(array, F.lit(1), count), F.lit(start), add)

    def joined(parts: Column) -> Column:
        sums = F.transform(parts, lambda part: whole(part, F.size(part)))

        def one(totals: Column) -> Column:
            inside = lambda part, before: F.transform(part, lambda _, i: add(before, whole(part, i + 1)))
            return F.flatten(F.transform(parts, lambda part, c: _once(whole(totals, c), lambda before: inside(part, before))))

        return _once(sums, one)

    none = F.array().cast("array<int>")
    return _once(values, lambda v: F.when(F.size(v) > 0, _once(pieces(v), joined)).otherwise(none))


def _spans(text: Column, pattern: str, kind: str) -> Column:
    """Array of start, kind number, end, match for all matches of a pattern that is one group."""
    between = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    paired = F.filter(F.arrays_zip(between.alias("gap"), matches.alias("match")), lambda p: p["match"].isNotNull())

    def placed(pairs: Column) -> Column:
        ends = _running(F.transform(pairs, lambda p: p["gap"] + F.length(p["match"])), lambda a, b: a + b, 0)

        def span(p: Column, end: Column) -> Column:
            return F.struct((end - F.length(p["match"])).alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"), p["match"].alias("match"))

        return F.zip_with(pairs, ends, span)

    return _once(paired, placed)


def _free(runs: Column, base: Column) -> Column:
    """The runs that overlap no base span, found by one pass over both in order of their starts."""
    is_base = lambda e: e["kind"] < KINDS.index("markov")

    def chosen(events: Column) -> Column:
        ends = F.transform(events, lambda e: F.when(is_base(e), e["end"]).otherwise(0))
        starts = F.reverse(F.transform(events, lambda e: F.when(is_base(e), e["start"]).otherwise(_FAR)))
        before = _running(ends, lambda a, b: F.greatest(a, b), 0)
        after = F.reverse(_running(starts, lambda a, b: F.least(a, b), _FAR))
        near = F.arrays_zip(events.alias("e"), before.alias("before"), after.alias("after"))
        kept = F.filter(near, lambda n: ~is_base(n["e"]) & (n["before"] <= n["e"]["start"]) & (n["after"] >= n["e"]["end"]))
        return F.transform(kept, lambda n: n["e"])

    return F.when(F.size(runs) > 0, _once(F.array_sort(F.concat(runs, base)), chosen)).otherwise(F.array().cast(_SPANS))


def _when(test: Column, spans: Column) -> Column:
    return F.when(test, spans).otherwise(F.array().cast(_SPANS))


def base_spans(text: Column) -> Column:
    lower = F.lower(text)
    named = F.lit(False)
    for word in ASSIGN_WORDS:
        named = named | lower.contains(word)
    named = named | (lower.contains("api") & lower.contains("key"))
    assign = F.filter(
        _when(named, _spans(text, ASSIGN, "assign")),
        lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= ASSIGN_LEAST,
    )
    access = _when(text.contains("AKIA"), _spans(text, ACCESS, "access"))
    hexed = _when(text.rlike(HEX), _spans(text, HEX, "hex"))
    return F.concat(assign, access, hexed)


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios of character pairs from ``sample, label`` (1 random string, 0 identifier).

    The table is (alphabet + 1) squared: a string's ends are one more character, other characters count as an end.
    Pairs of each label are smoothed by one. Null samples and labels do not count.
    """
    size = len(ALPHABET) + 1
    # instr gives 0 for a character outside the alphabet and 1 for no character at all
    place = lambda c: F.when(c == "", size - 1).otherwise((F.instr(F.lit(ALPHABET), c) + size - 1) % size)
    chars = F.transform(F.sequence(F.lit(0), F.length("sample") + 1), lambda i: place(_char(F.col("sample"), i)))
    rows = samples.where("label IN (0, 1) AND sample <> ''").select("label", chars.alias("chars"))
    pairs = F.transform(F.sequence(F.lit(0), F.size("chars") - 2), lambda i: F.get("chars", i) * size + F.get("chars", i + 1))
    counted = rows.select("label", F.explode(pairs).alias("pair")).groupBy("label", "pair").agg(F.count("*").alias("n")).collect()
    tables = [[1.0] * (size * size) for _ in range(2)]
    for row in counted:
        tables[row["label"]][row["pair"]] += row["n"]
    for table in tables:
        for k in range(size):
            whole = sum(table[k * size : (k + 1) * size])
            table[k * size : (k + 1) * size] = [math.log(v / whole) for v in table[k * size : (k + 1) * size]]
    return [a - b for a, b in zip(tables[1], tables[0], strict=True)]


def _char(text: Column, i: Column) -> Column:
    """Character i of a text counted from 1; empty beyond both ends."""
    return F.when(i >= 1, F.substring(text, i.cast("int"), F.lit(1))).otherwise("")


def ratio(run: Column, weights: list[float]) -> Column:
    """Log-likelihood ratio per character of a run of alphabet characters."""
    size = len(ALPHABET) + 1
    table = F.split(F.lit(",".join(f"{w:.6f}" for w in weights)), ",").cast("array<double>")
    place = lambda c: F.instr(F.lit(ALPHABET), c) - 1
    start = F.struct(F.lit(size - 1).alias("last"), F.lit(0.0).alias("sum"))

    def step(acc: Column, c: Column) -> Column:
        here = place(c)
        return F.struct(here.alias("last"), (acc["sum"] + F.get(table, acc["last"] * size + here)).alias("sum"))

    def close(acc: Column) -> Column:
        return acc["sum"] + F.get(table, acc["last"] * size + size - 1)

    chars = F.filter(F.split(run, ""), lambda c: c != "")
    return F.aggregate(chars, start, step, close) / F.length(run)


def scan(docs: DataFrame, weights: list[float], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``found``: all spans (start, kind, end, match; code points, end exclusive) in order.

    Spans of the plain patterns always stay; a scored run counts where it overlaps none of them. A null text is
    empty. Rows are scanned one by one, so repeats agree. The work on a text grows with its length and, with the power
    of 1.5, with the number of its matches. Columns keep their content whatever their names; ``found`` is replaced.
    """
    kept = [c for c in docs.columns if c != "found"]
    given = [F.col(c).alias(f"_given_{k}") for k, c in enumerate(kept)]  # the input's names cannot clash
    base = fenced(docs.select(*given, F.coalesce(F.col(text), F.lit("")).alias("scanned")), [f"_given_{k}" for k in range(len(kept))] + ["scanned"], base=base_spans(F.col("scanned")))
    runs = _when(F.col("scanned").rlike(RUN), _spans(F.col("scanned"), RUN, "markov"))
    scored = F.filter(_free(runs, F.col("base")), lambda r: ratio(r["match"], weights) >= threshold)
    made = fenced(base, [f"_given_{k}" for k in range(len(kept))], found=F.array_sort(F.concat("base", scored)))
    return made.select(*[F.col(f"_given_{k}").alias(c) for k, c in enumerate(kept)], "found")


def listed(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    kind = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def samples_of(docs: DataFrame, documents: int = FIT_DOCUMENTS, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Labelled samples from at most ``documents`` documents, drawn by a hash of the id.

    Random strings are digests of their words as base64 and hexadecimal digits, and the access keys found there;
    identifiers are their words, alone and joined as in snake case, camel case (two ways, three words) and paths, also in
    capitals.
    """
    ids = docs.where(F.col(id).isNotNull()).select(F.col(id).alias("_id")).distinct().orderBy(F.xxhash64("_id"), "_id").limit(documents)
    some = docs.join(F.broadcast(ids), docs[id] == ids["_id"]).select(F.coalesce(F.col(text), F.lit("")).alias("t"))
    words = some.select(F.explode(F.regexp_extract_all("t", F.lit("([A-Za-z]{3,})"), F.lit(1))).alias("w")).distinct()
    joined = words.select("w", F.lead("w").over(_by_hash()).alias("next"), F.lead("w", 2).over(_by_hash()).alias("third")).where("next IS NOT NULL")
    title = F.concat(F.initcap("w"), F.initcap("next"), F.initcap(F.coalesce("third", "w")))
    camel = F.concat(F.lower("w"), F.initcap("next"), F.initcap(F.coalesce("third", "w")))
    forms = ["w", F.concat_ws("_", "w", "next"), camel, title, F.lower(F.concat_ws("/", "w", "next", "third")), F.upper("w"), F.upper(F.concat_ws("_", "w", "next"))]
    ordinary = joined.select(F.explode(F.array(*forms)).alias("sample"))
    digest = F.unhex(F.sha2(F.concat(F.lit("sample:"), "w"), 256))
    random = words.select(F.explode(F.array(F.base64(digest), F.substring(F.regexp_replace(F.base64(digest), "[+/=]", ""), 5, 32), F.substring(F.lower(F.hex(digest)), 1, 40))).alias("sample"))
    keys = some.select(F.explode(F.regexp_extract_all("t", F.lit(ACCESS), F.lit(1))).alias("sample"))
    label = lambda df, n: df.select("sample", F.lit(n).alias("label"))
    return label(ordinary, 0).unionByName(label(random, 1)).unionByName(label(keys, 1))


def _by_hash() -> WindowSpec:
    return Window.partitionBy(F.pmod(F.xxhash64("w"), F.lit(64))).orderBy("w")
