import unicodedata

import pytest
from pyspark.sql import functions as F

import pyarrow as pa

from lumenfold.functions import text as tx
from lumenfold.functions.index import dense_index


def one(spark, expression, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(expression.alias("x")).first()["x"]


def test_words_fold_accents_and_ligatures_and_drop_stop_words():
    assert tx.split_words("The Éclair ﬁlling, 2024 and ½ cup of x2!") == ["eclair", "filling", "cup", "of", "x2"]
    assert tx.split_words("ß") == [] and tx.split_words(None) == []


@pytest.mark.parametrize("raw, clean", [("a<br>b<br />c", "a b c"), ("<p>x</p>y", "xy"), ("&amp;lt;b&gt; &quot;q&#39;", "<b> \"q'"), ("  a \n b ", "a b")])
def test_clean_markup(spark, raw, clean):
    assert one(spark, tx.clean_markup(F.col("s")), s=raw) == clean


@pytest.mark.parametrize("raw", ["don't stop", "3bean chili", "a-b c", "MIXED case", "über-ñandú"])
def test_title_case_is_pythons(spark, raw):
    assert one(spark, tx.title_case(F.col("s")), s=raw) == raw.title()


@pytest.mark.parametrize("name, slug", [("CookingEvent", "cooking-event"), ("ABCNote", "a-b-c-note"), ("_x Y", "x-y"), ("__", "activity"), ("v2Beta", "v2-beta")])
def test_class_slug(spark, name, slug):
    assert one(spark, tx.class_slug(F.col("s")), s=name) == slug


@pytest.mark.parametrize("raw, slug", [(" Recipe/Main Dishes! ", "recipe/main-dishes"), ("--", "content"), ("a.b_c", "a.b_c")])
def test_collection_slug(spark, raw, slug):
    assert one(spark, tx.collection_slug(F.col("s")), s=raw) == slug


def test_shorten_keeps_420_and_cuts_at_a_blank(spark):
    assert one(spark, tx.shorten(F.col("s")), s="x" * 420) == "x" * 420
    long = "word " * 100
    text = long.strip()
    assert one(spark, tx.shorten(F.col("s")), s=long) == text[:419].rsplit(" ", 1)[0].rstrip() + "..."
    assert one(spark, tx.shorten(F.col("s")), s="y" * 500) == "y" * 419 + "..."


def test_prefix_and_filename(spark):
    assert tx.id_prefix(" Thémé 1! ") == "theme-1" and tx.id_prefix("!") == "auto-cluster"
    assert one(spark, tx.safe_filename(F.col("s")), s="-Session — onboarding 3!") == "session-onboarding-3.md"


def test_white_space_class_matches_python(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    rows = spark.createDataFrame([(c,) for c in spaces], "s string")
    assert rows.where(tx.collapse(F.concat(F.lit("a"), "s", F.lit("b"))) != "a b").count() == 0
    others = [chr(c) for c in range(0x3001) if not chr(c).isspace() and unicodedata.category(chr(c)) != "Cs"]
    kept = spark.createDataFrame([(c,) for c in others], "s string")
    assert kept.where(tx.collapse(F.concat(F.lit("a"), "s", F.lit("b"))) == "a b").count() == 0


def test_dense_index_over_ranges_and_gaps(spark):
    rows = [("a", s) for s in (5, 70, 71, 300, 301, 999)] + [("b", 0)]
    got = dense_index(spark.createDataFrame(rows, "k string, s long"), ["k"], "s", width=64).collect()
    assert {(r.k, r.s): r.entry_index for r in got} == {("a", 5): 0, ("a", 70): 1, ("a", 71): 2, ("a", 300): 3, ("a", 301): 4, ("a", 999): 5, ("b", 0): 0}


def test_a_batch_of_texts_is_split_in_parts_of_bounded_rows_and_bytes():
    texts = pa.array(["ab " * 100, None, "é" * 40, ""] * 400 + ["x" * 5000])
    parts = list(tx.slices(texts, 1000))
    assert pa.concat_arrays(parts) == texts and list(tx.slices(texts.slice(0, 0))) == []
    assert all(len(p) == 1 or (len(p) <= tx.SLICE and sum(len((t or "").encode()) for t in p.to_pylist()) <= 1000) for p in parts)
    assert [len(p) for p in tx.slices(pa.nulls(1100, pa.string()))] == [512, 512, 76]


def test_repeated_words_stay_in_the_splitter(spark):
    df = spark.createDataFrame([(0, "Pear apple pear 12 The Äpfel apple"), (1, None), (2, "")], "i int, t string")
    got = {r.i: (r.once, r.want) for r in df.select("i", tx.distinct_words("t").alias("once"), F.array_distinct(tx.words("t")).alias("want")).collect()}
    assert got == {0: (["pear", "apple", "apfel"],) * 2, 1: ([],) * 2, 2: ([],) * 2}
