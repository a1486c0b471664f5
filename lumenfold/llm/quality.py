"""Quality rules as weak supervision: rules vote or abstain, and expectation-maximisation weighs their votes.

Every rule says good (1), bad (0) or nothing (null) about a text. Texts are counted by their pattern of votes, at
most 3 to the number of rules; how often each rule says what about good and about bad texts is estimated from those
counts alone, without labels. The verdict is the posterior probability that a text is good. Everything on the rows
is made of DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfold.llm.fence import fenced
from lumenfold.session import materialize

SPACE = " \\t\\n\\x0B\\f\\r"
SYMBOLS = "#*$%&|<>"
#: ASCII characters that are neither letters nor space, as ranges.
MARKS = r"!-@\[-`{-~"
WINDOW = 5


def measured(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``docs`` (all by default) with a struct column ``q`` of counts over the whole text.

    A null text counts as empty.
    """
    others = [c for c in keep or docs.columns if c != "q"]
    plain = docs.withColumn("_quality_text", F.coalesce(F.col(text), F.lit("")))
    found = plain.withColumn("_quality_words", F.transform(F.regexp_extract_all("_quality_text", F.lit(f"([^{SPACE}]+)"), F.lit(1)), lambda w: F.xxhash64(w)))
    found = found.withColumn("_quality_lines", F.filter(F.split("_quality_text", "\n", -1), lambda line: line.rlike(f"[^{SPACE}]")))
    count = F.size("_quality_words")
    at = lambda i, k: F.get(F.col("_quality_words"), i + k)
    windows = F.transform(F.sequence(F.lit(0), count - WINDOW), lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)]))
    found = found.withColumn("_quality_windows", F.when(count >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")))
    # Texts without a repeated window, nearly all, are done here; the others sort their windows.
    several = F.size("_quality_windows") > F.size(F.array_distinct("_quality_windows"))
    placed = F.sort_array(F.transform("_quality_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    found = found.withColumn("_quality_sorted", F.when(several, placed))
    same = lambda e, i, k: F.coalesce(F.get(F.col("_quality_sorted"), i + k)["h"] == e["h"], F.lit(False))
    again = F.filter("_quality_sorted", lambda e, i: same(e, i, -1) | same(e, i, 1))
    found = found.withColumn("_quality_again", F.sort_array(F.transform(again, lambda e: e["i"])))
    reach = F.transform("_quality_again", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_quality_again"), i + 1) - p, F.lit(WINDOW))))
    covered = F.aggregate(reach, F.lit(0).cast("bigint"), lambda a, x: a + x)
    chars = lambda kind: F.length(F.regexp_replace("_quality_text", F.lit(f"[^{kind}]+"), F.lit("")))
    measures = {
        "n_words": count,
        "word_chars": F.length(F.regexp_replace("_quality_text", F.lit(f"[{SPACE}]+"), F.lit(""))),
        "n_symbols": chars(SYMBOLS),
        "n_lines": F.size("_quality_lines"),
        "n_dup_lines": F.size("_quality_lines") - F.size(F.array_distinct("_quality_lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_distinct_words": F.size(F.array_distinct("_quality_words")),
        "n_upper": chars("A-Z"),
        "n_shouts": chars("!?"),
        "n_marks": chars(MARKS),
    }
    q = F.struct(*[c.cast("bigint").alias(name) for name, c in measures.items()])
    return fenced(found, others, q=q)


def _rule(bad: Column, good: Column) -> Column:
    return F.when(bad, 0).when(good, 1)


def rules() -> dict[str, Column]:
    """The votes on a measured text. Each rule looks at one kind of fault and abstains in between."""
    q = lambda name: F.col(f"q.{name}")
    n = q("n_words")
    return {
        "symbols": _rule(100 * q("n_symbols") > 20 * n, 100 * q("n_symbols") <= n),
        "symbol_share": _rule(100 * q("n_symbols") > 3 * q("word_chars"), 200 * q("n_symbols") <= q("word_chars")),
        "marks": _rule(100 * q("n_marks") > 12 * q("word_chars"), 100 * q("n_marks") <= 7 * q("word_chars")),
        "repeats": _rule(100 * q("n_repeat_words") > 10 * n, 100 * q("n_repeat_words") <= 2 * n),
        "lines": _rule(100 * q("n_dup_lines") > 30 * q("n_lines"), (q("n_dup_lines") == 0) & (q("n_lines") > 1)),
        "capitals": _rule(100 * q("n_upper") > 35 * q("word_chars"), 100 * q("n_upper") <= 12 * q("word_chars")),
        "shouts": _rule(100 * q("n_shouts") > 20 * n, 100 * q("n_shouts") <= 2 * n),
        "length": _rule(n < 10, n >= 40),
        "word_length": _rule((q("word_chars") < 2 * n) | (q("word_chars") > 20 * n), (q("word_chars") >= 3 * n) & (q("word_chars") <= 12 * n)),
        "variety": _rule((n >= 20) & (100 * q("n_distinct_words") < 15 * n), 100 * q("n_distinct_words") >= 30 * n),
    }


def estimate(patterns: list[tuple[tuple[int | None, ...], int]], width: int) -> tuple[float, list[dict]]:
    """Expectation-maximisation over vote patterns with counts: log odds of good, and what each vote adds.

    Rules are taken as independent given the class. A fault shows in few rules, so it starts from the number of bad
    votes: none is likely good, one is open, two are likely bad. It ends when the posteriors settle, however many
    rounds that takes: every round raises the likelihood, and the patterns are few.
    """
    total = sum(c for _, c in patterns) or 1
    share = []
    for votes, _ in patterns:
        share.append((0.95, 0.5, 0.05)[min(2, sum(v == 0 for v in votes))])
    while True:
        good = sum(p * c for p, (_, c) in zip(share, patterns, strict=True))
        prior = math.log((good + 1) / (total - good + 1))
        adds = []
        for j in range(width):
            said = {v: [1.0, 1.0] for v in (None, 0, 1)}  # one imagined text of each kind
            for p, (votes, c) in zip(share, patterns, strict=True):
                said[votes[j]][0] += p * c
                said[votes[j]][1] += (1 - p) * c
            adds.append({v: math.log(a / (good + 3)) - math.log(b / (total - good + 3)) for v, (a, b) in said.items()})
        odds = [prior + sum(adds[j][v] for j, v in enumerate(votes)) for votes, _ in patterns]
        before, share = share, [1 / (1 + math.exp(-max(-500.0, min(500.0, o)))) for o in odds]
        if all(abs(a - b) <= 1e-9 for a, b in zip(before, share, strict=True)):
            break
    return prior, adds


def judged(docs: DataFrame, text: str = "text", keep: list[str] | None = None, stored: bool = True) -> DataFrame:
    """The ``keep`` columns of ``docs`` (all by default) with q, base_failed, p_good (the posterior) and kept.

    Kept are texts that pass the base rule (10 words, at most a fifth of them in repeated windows) and are good
    with probability one half at least. Null and empty texts fail. Rows are judged one by one, so repeats agree;
    columns named like the new ones are replaced.

    Counting the votes and giving the verdicts both need the measures. ``stored`` keeps them in the shared folder
    with the ``keep`` columns; without it the texts are measured twice and nothing is written.
    """
    votes = rules()
    found = measured(docs, text, keep)
    if stored:
        found = materialize(found, "measured")
    patterns = found.groupBy(*[vote.alias(name) for name, vote in votes.items()]).agg(F.count("*").alias("_rows")).collect()
    prior, adds = estimate(sorted(((tuple(r)[:-1], r["_rows"]) for r in patterns), key=str), len(votes))
    odds = F.lit(prior)
    for name, vote, add in zip(votes, votes.values(), adds, strict=True):
        odds = odds + F.when(vote.isNull(), add[None]).when(vote == 1, add[1]).otherwise(add[0])
    found = found.withColumn("base_failed", (F.col("q.n_words") < 10) | (100 * F.col("q.n_repeat_words") > 20 * F.col("q.n_words")))
    found = found.withColumn("p_good", 1 / (1 + F.exp(-odds)))
    return found.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5))
