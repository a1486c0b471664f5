"""Packing, spelling variants and whitening against plain versions."""

import collections
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from lumenfold.llm import packing, spectrum, spelling, whitening
from lumenfold.llm.byte_ids import ByteIds
from lumenfold.llm.queries import BYTE_IDS


@pytest.fixture(scope="module")
def model():
    with open(BYTE_IDS, encoding="utf-8") as file:
        return file.read()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTE_IDS)


def test_ids_are_those_of_whole_texts(model, tokenizer):
    generate, encoder = random.Random(5), ByteIds(model)
    signs = ["a", "Be", "é", "'s", "'re", " ", " ", "  ", "\n", "\t", "\x1c", "!", "?", "1", "23", ",", "<|", "\u0301", "²", "\xa0", "中", "<|endoftext|>", "​", " ", "\x85"]
    texts = [None, *("".join(generate.choice(signs) for _ in range(generate.randrange(14))) for _ in range(8000))]
    for text, ids in zip(texts, encoder.encode(pa.array(texts)), strict=True):
        assert ids.tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_long_text_is_encoded_in_parts(model, tokenizer, monkeypatch):
    monkeypatch.setattr("lumenfold.llm.byte_ids._AT_A_TIME", 1000)
    monkeypatch.setattr("lumenfold.llm.byte_ids.REMEMBERED", 3)
    text = " some words, and more\n\nof them  here " * 3_000 + "x" * 5_000
    assert next(ByteIds(model).encode(pa.array([text]))).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check_pieces(rows, ids_of, length):
    """Every id in one piece, sequences without gaps; returns the tokens of each sequence."""
    documents, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        documents[r["doc_id"]].append((r["start"], r["ids"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["length"] == len(r["ids"]) and r["doc_tokens"] == len(ids_of[r["doc_id"]])
    for name, ids in ids_of.items():
        found = sorted(documents.pop(name))
        assert [x for _, part in found for x in part] == ids
        assert [s for s, _ in found] == [0, *itertools.accumulate(len(p) for _, p in found[:-1])]
    assert not documents
    used = []
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *itertools.accumulate(n for _, n in parts[:-1])]
        used.append(sum(n for _, n in parts))
        assert used[-1] <= length
    return used


@pytest.mark.parametrize(("length", "windows", "least_cut", "partitions"), [(64, 4, 5, 1), (64, 2, 1, 40), (16, 1, 20, 3)])
def test_packing(spark, model, tokenizer, length, windows, least_cut, partitions):
    generate = random.Random(length + windows)
    texts = {k: " ".join(generate.choice(["one", "Two", "é!", "x9"]) for _ in range(int(generate.expovariate(0.03)))) for k in range(300)} | {300: None, 301: "", 302: "so long " * 3000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(partitions, "doc_id")
    ids_of = {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [7] for k, t in texts.items()}
    found = packing.pack(docs, model, 7, length, windows, least_cut)
    used = check_pieces(found.collect(), ids_of, length)
    if least_cut <= length:  # one sequence may be short, the others lack less than the least cut
        assert sorted(used)[1] > length - least_cut
    assert sorted(map(str, found.collect())) == sorted(map(str, found.collect()))


def test_packer_holds_a_fixed_number_of_windows():
    generate, packer, out = random.Random(1), packing.Packer(100, 3, 101), []
    for k in range(500):
        out += packer.add((k,), 0, np.zeros(generate.randrange(1, 260), np.uint32))
        assert len(packer.open) <= 3
    packer.open = [(90, []), (70, []), (40, [])]
    assert list(packer.add(("fits the second best",), 0, np.zeros(25, np.uint32))) == []
    assert [used for used, _ in packer.open] == [95, 90, 40]
    emitted = list(packer.add(("fits none",), 0, np.zeros(80, np.uint32)))
    assert len(emitted) == 1 and [used for used, _ in packer.open] == [90, 80, 40]


def test_packing_edges(spark, model, tokenizer):
    schema = "doc_id long, text string, start int, ids string, `group` int, open boolean, offset string"
    odd = spark.createDataFrame([(1, "a b", 5, "x", 1, True, "x"), (1, "a b", 5, "x", 1, True, "x"), (None, None, 5, "x", 1, True, "x")], schema)
    found = packing.pack(odd, model, 0).collect()
    assert sorted((r["doc_id"] or 0, r["start"], r["length"]) for r in found) == [(0, 0, 1), (1, 0, 3), (1, 0, 3)]
    assert {r["sequence_id"] for r in found} == {found[0]["sequence_id"]} and sorted(r["offset"] for r in found) in ([0, 3, 6], [0, 1, 4])
    assert packing.pack(odd.limit(0), model, 0).count() == 0


def test_packing_query(spark, folder, tokenizer):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ids_of = {k: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for k, t in texts.items()}
    used = collections.Counter()
    for r in entry.queries()["op11_packing"](spark, folder).collect():
        part = ids_of[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids_of[r["doc_id"]])
        used[r["sequence_id"]] += r["length"]
    assert sum(used.values()) == sum(map(len, ids_of.values())) and max(used.values()) <= 1024
    assert sum(1024 - n for n in used.values()) < 0.01 * sum(used.values()) + 1024


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(a == b[:k] + b[k + 1 :] for k in range(len(b)))


def plain_variants(counts, dominance):
    made = {}
    for word, n in counts.items():
        others = [w for w in counts if near(word, w)]
        best = min(others, key=lambda w: (-counts[w], w), default=None)
        form = best if best and counts[best] >= dominance * n else None
        made[word] = [n, len(others), form, counts[form] if form else None]
    for word, row in made.items():
        root = word
        while made[root][2]:
            root = made[root][2]
        row.append(root)
    return {w: tuple(r) for w, r in made.items()}


@pytest.mark.parametrize("cell_words", [2, 9, 10_000])
def test_spelling_variants(spark, cell_words, monkeypatch):
    """Also with leaves (here permutations of the same letters) that are dealt in tiles."""
    monkeypatch.setattr(spelling, "NODES", 1 << 30)
    generate, counts = random.Random(3), {}
    for _ in range(25):
        base = "".join(generate.choice("abqré") for _ in range(generate.randrange(2, 9)))
        for _ in range(12):
            word, at = base, generate.randrange(len(base))
            word = generate.choice([word[:at] + word[at + 1 :], word[:at] + generate.choice("aÿz") + word[at:], word[:at] + "b" + word[at + 1 :], word])
            counts[word] = generate.choice([1, 2, 5, 30, 200, 1000])
    counts |= {"".join(p): k + 1 for k, p in enumerate(itertools.islice(itertools.permutations("abcdef"), 120))}
    counts |= {"x" * 300: 4, "x" * 301: 20, "": 9}
    kept = {w: n for w, n in counts.items() if len(w) >= 1 and n >= 2}
    words = spark.createDataFrame([*counts.items(), (None, 50)], "word string, n long")
    found = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in spelling.variants(words, 1, 2, 5, cell_words).collect()}
    assert found == plain_variants(kept, 5)


def test_spelling_has_no_pairs_of_other_groups():
    assert not spelling.is_near("abcd", "abcd") and not spelling.is_near("abcd", "abdc") and not spelling.is_near("", "ab")
    assert spelling.is_near("", "a") and spelling.is_near("abcd", "abd") and spelling.is_near("abcd", "xbcd")
    words = ["".join(w) for k in range(4) for w in itertools.product("aqz", repeat=k)]
    by_vector = collections.defaultdict(list)
    for word in words:
        by_vector[tuple(spelling.vector(word))].append(word)
    trie = spelling.Trie(by_vector, 0)
    for word in words:
        found = [w for leaf in trie.leaves(tuple(spelling.vector(word)), 1, 1) for w in leaf.near(word)]
        assert sorted(found) == sorted(w for w in words if near(word, w))


def test_word_counts(spark):
    texts = [(k, "Spelling spelling ÉTÉ-été straße x " * (k % 3) + f"word{'a' * (k % 4)}") for k in range(400)] + [(None, "alone"), (7, None), (8, ""), (9, "é" * 50_000)]
    plain = collections.Counter()
    for name, text in texts:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in "".join(c if "a" <= c <= "z" or "À" <= c <= "ÿ" else " " for c in lowered).split():
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            plain[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 7 == 0 else run] += 1
    docs = spark.createDataFrame([(*t, 1, "x") for t in texts], "doc_id long, text string, n int, word string")
    assert {r["word"]: r["n"] for r in spelling.word_counts(docs, 7).collect()} == plain
    assert spelling.variants(spelling.word_counts(docs.limit(0), 7)).count() == 0


def matrices():
    draw = np.random.default_rng(0)
    turn = np.linalg.qr(draw.standard_normal((40, 40)))[0]
    wide = draw.standard_normal((40, 90))
    yield wide @ wide.T
    yield turn @ np.diag([5.0] * 10 + [1.0] * 30) @ turn.T
    yield turn @ np.diag([10.0**-k for k in range(16)] + [0.0] * 24) @ turn.T
    yield np.diag([3.0, 3.0, 3.0] + [1 + 1e-9 * k for k in range(37)])
    yield np.array([[2.0]])
    yield np.zeros((3, 3))


def test_slices_find_the_leading_pairs():
    for matrix in map(lambda m: (m + m.T) / 2, matrices()):
        wanted = np.linalg.eigvalsh(matrix)[::-1]
        values, vectors = spectrum.leading(matrix, 12)
        assert len(values) == min(12, (wanted > 8 * len(matrix) * 2.3e-16 * np.abs(matrix).sum(axis=1).max()).sum())
        scale = max(wanted[0], 1e-300)
        assert np.abs(values - wanted[: len(values)]).max(initial=0) < 1e-13 * scale
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) < 1e-12
        assert np.abs(matrix @ vectors - vectors * values).max(initial=0) < 1e-13 * scale


def test_pivots_count_eigenvalues():
    draw = np.random.default_rng(1)
    for _ in range(300):
        half = draw.integers(-3, 4, (draw.integers(1, 20),) * 2).astype(float)
        shift = draw.standard_normal() * 3
        assert spectrum.count_above(half + half.T, shift) == (np.linalg.eigvalsh(half + half.T) > shift).sum()


def plain_whitened(vectors, k):
    whole = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(whole), [sum(c) for c in zip(*whole, strict=True)]
    apart = np.array(whole, float) - np.array(sums, float) / n
    values, parts = np.linalg.eigh(apart.T @ apart / n)
    values, parts = values[::-1], parts[:, ::-1]
    return n, [sum((n * x - s) ** 2 for x, s in zip(v, sums, strict=True)) for v in whole], apart @ parts[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def agree(rows, names, vectors, k):
    n, deviations, scores, explained = plain_whitened(vectors, k)
    table = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(rows) == len(table) == len(vectors) * k
    for c in range(k):
        found = np.array([table[name, c + 1]["whitened"] for name in names])
        assert min(np.abs(found - scores[:, c]).max(), np.abs(found + scores[:, c]).max()) < 1e-8
    for name, deviation in zip(names, deviations, strict=True):
        assert table[name, 1]["deviation"] == deviation and table[name, 1]["n"] == n
    assert max(abs(r["explained"] - explained[r["component"] - 1]) for r in rows) < 1e-12
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-10


def test_whitening_query(spark, folder):
    given = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    rows = entry.queries()["op13_whitening"](spark, folder).collect()
    agree(rows, [r["vec_id"] for r in given], [r["embedding"] for r in given], 32)


def test_whitening_edges(spark):
    draw = np.random.default_rng(4)
    fine = [(k, [float(c) for c in draw.standard_normal(5) * [1, 2, 3, 4, 5]]) for k in range(60)]
    fine[7] = (7, list(fine[3][1]))
    fine[9] = (9, [1e9, -1e9, 3.0, 2.0**40, 0.0])  # sums of products leave the exact floats
    bad = [(100, None), (101, [1.0, None, 1.0, 1.0, 1.0]), (102, [float("nan")] * 5), (103, [float("inf")] + [0.0] * 4), (104, []), (105, [1.0] * 4), (106, [1e30] * 5)]
    schema = "vec_id long, embedding array<double>, component string, n string, vector int, part string"
    frame = spark.createDataFrame([(*r, "x", "x", 1, "x") for r in fine[:9] + fine[10:] + bad], schema).repartition(7)
    rows = whitening.whiten(frame, 4).collect()
    agree(rows, [k for k, _ in fine if k != 9], [v for k, v in fine if k != 9], 4)
    large = whitening.whiten(spark.createDataFrame([(*r, "x", "x", 1, "x") for r in fine], schema), 1).collect()
    whole = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in fine]
    sums = [sum(c) for c in zip(*whole, strict=True)]
    assert {r["vec_id"]: int(r["deviation"]) for r in large} == {k: sum((60 * x - s) ** 2 for x, s in zip(v, sums, strict=True)) for (k, _), v in zip(fine, whole, strict=True)}
    for nothing in (frame.limit(0), frame.where("vec_id > 99"), frame.where("vec_id = 5"), frame.where("vec_id IN (3, 7)")):
        assert whitening.whiten(nothing).count() == 0
    again = spark.createDataFrame([(None, [1.0, 2.0]), (None, [1.0, 3.0]), (4, [1.0, 3.0])], "vec_id long, embedding array<float>")
    found = whitening.whiten(again).collect()
    assert sorted(round(abs(r["whitened"]), 3) for r in found) == [0.707, 0.707, 1.414] and found[0]["explained"] == 1


def test_whitening_counts_rows_exactly_however_they_are_dealt(spark, folder):
    given = spark.read.parquet(f"{folder}/embeddings.parquet")
    one, many = (whitening.fit(*whitening.usable(given.repartition(n))) for n in (1, 13))
    assert one.sums == many.sums and (one.values == many.values).all() and (one.components == many.components).all()
