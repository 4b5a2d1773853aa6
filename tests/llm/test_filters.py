"""Quality rules, benchmark passages and quotes, against plain versions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import contamination, outliers, quotes


def prose(rng, n, vocabulary=900):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# -- quality -------------------------------------------------------------------------------------------------------

TEXTS = [None, "", " \n ", "one", "a b a b a b a b", "x\nx\n\nx\n y", "#tag $5 50% <b> a|b & *", "é ü " * 60,
         "the cat sat on the mat " * 15, "w " * 200, "a b c d e f g h\n" * 3, "\t".join("abcdefgh") * 40]


def test_statistics_of_whole_texts(documents):
    rng = random.Random(1)
    rows = list(enumerate(TEXTS + [prose(rng, rng.randrange(400), rng.choice([12, 40, 900])) for _ in range(60)]
                          + [prose(rng, 20_000, 60)]))
    out = outliers.with_statistics(documents(rows, n_words=("string", "clash"), lang=("string", "en")))
    found = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.failed)
             for r in out.withColumn("failed", outliers.base_failed()).collect()}
    assert out.columns.count("n_words") == 1
    assert found == {doc: brute.statistics(text) for doc, text in rows}


def determinant_estimate(points, steps=200):
    """Concentration steps from the same start, in numpy."""
    spread = (np.quantile(points, 0.75, axis=0, method="inverted_cdf") - np.quantile(points, 0.25, axis=0, method="inverted_cdf"))
    centre = np.quantile(points, 0.5, axis=0, method="inverted_cdf")
    floor = np.diag([f ** 2 for f in outliers.FLOOR.values()])
    cov, last = np.diag((spread / 1.349) ** 2) + floor, np.inf
    for step in range(outliers.STEPS):
        apart = points - centre
        distance = np.einsum("ij,jk,ik->i", apart, np.linalg.inv(cov), apart)
        near = points[distance <= np.quantile(distance, outliers.SUBSET, method="inverted_cdf")]
        was, centre = np.linalg.slogdet(cov)[1], near.mean(axis=0)
        cov = np.cov(near.T, bias=True) * outliers.CONSISTENCY + floor
        if step and not np.linalg.slogdet(cov)[1] < was - 1e-9:
            break
    apart = points - centre
    return np.einsum("ij,jk,ik->i", apart, np.linalg.inv(cov), apart)


def test_distances_equal_a_plain_estimate(spark):
    rng = np.random.default_rng(4)
    rows, expected = [], {}
    for cell, n in (("a", 400), ("b", 150)):
        points = rng.normal(size=(n, 4)) @ rng.normal(size=(4, 4)) + rng.normal(size=4)
        points[: n // 10] += 9
        expected[cell] = determinant_estimate(points)
        rows += [(cell, i, *map(float, p)) for i, p in enumerate(points)]
    table = spark.createDataFrame(rows, "cell string, i int, " + ", ".join(f"{n} double" for n in outliers.NAMES))
    out = outliers._distances(table, outliers.estimate(table.select("cell", *outliers.NAMES))).collect()
    for cell, distances in expected.items():
        found = [r.distance for r in sorted((r for r in out if r.cell == cell), key=lambda r: r.i)]
        assert np.allclose(found, distances, rtol=1e-6)
        limit = outliers.chi_square_quantile(outliers.CONFIDENCE, 4)
        assert all(d > limit for d in found[: len(found) // 10]) and sum(d > limit for d in found) < len(found) / 8


def test_columns_of_any_name_stay(spark):
    rng = random.Random(9)
    names = ["cell", "distance", "symbols", "repeats", "dup_lines", "word_length", "kept", "n_words", "y0", "m0", "bound", "__x"]
    rows = [(i, prose(rng, 80), "en", None, *[f"{c}{i}" for c in names]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                 + ", ".join(f"`{c}` string" for c in names))
    out = outliers.judge(docs)
    replaced = ("distance", "kept", "n_words")
    assert out.columns == ["doc_id", "lang", "source", *[c for c in names if c not in replaced], "n_words", "word_chars",
                           "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept"]
    found = out.collect()
    assert len(found) == 60 and all(r[c] == f"{c}{r.doc_id}" for r in found for c in names if c not in replaced)
    assert all(r.n_words == 80 and r.distance is not None for r in found)


def test_chi_square():
    assert math.isclose(outliers.chi_square_quantile(0.95, 4), 9.4877, abs_tol=1e-4)
    assert math.isclose(outliers.chi_square_quantile(0.75, 6), 7.8408, abs_tol=1e-4)


def test_outliers_are_rejected_and_the_rest_kept(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        lang, source = rng.choice([("en", "s1"), ("en", "s2"), ("de", "s1"), (None, None)])
        rows.append((i, prose(rng, rng.randrange(60, 700)), lang, source))
    rows += [(1000 + i, " | ".join(prose(rng, 120).split(" ")), "en", "s1") for i in range(8)]
    rows += [(2000, None, "en", "s1"), (2001, "short", None, "s1"), (2002, "a b c " * 60, "de", None), (3, rows[3][1], "en", "s1")]
    out = outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.kept == (r.doc_id < 1000) and r.base_failed == (r.doc_id >= 2000)
        assert (r.distance is None) == r.base_failed
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert outliers.judge(empty).count() == 0


@pytest.mark.parametrize("name", outliers.NAMES)
def test_each_statistic_rejects_alone(spark, name):
    rng = random.Random(8)
    lined = lambda: "\n".join(prose(rng, 12) for _ in range(rng.randrange(5, 30)))
    rows = [(i, lined()) for i in range(200)]
    words = prose(rng, 100).split(" ")
    rows.append((1000, {
        "word_length": " ".join(w + w for w in words),
        "symbols": " ".join(w[:-1] + "|" for w in words),
        "dup_lines": "\n".join([prose(rng, 12) for _ in range(4)] + [f"w{100 + rng.randrange(15)}" for _ in range(60)]),
        "repeats": " ".join(words[:60] + words[:20] + words[80:]),
    }[name]))
    docs = spark.createDataFrame([(*r, "en", "s") for r in rows], "doc_id long, text string, lang string, source string")
    out = {r.doc_id: r for r in outliers.judge(docs).collect()}
    odd = out[1000]
    assert not odd.base_failed and not odd.kept
    assert all(r.kept for i, r in out.items() if i < 1000)
    assert (odd.n_dup_lines > 0) == (name == "dup_lines") and (odd.n_symbols > 0) == (name == "symbols")
    assert 7 * odd.n_repeat_words < odd.n_words or name == "repeats"


# -- benchmark -----------------------------------------------------------------------------------------------------

ITEMS = [(1, "The quick, brown Fox jumps over the lazy dog again and again today."), (2, "short one"), (3, ""), (4, None),
         (5, "the of and to in a is that it was the of and"), (6, "Éa ÉB c d e f g h i j k"), (10, "Short, ONE!"),
         (11, "the quick brown fox jumps over the lazy dog again"), (11, "the quick brown fox jumps over the lazy dog again")]


def contaminated(docs, items):
    out = contamination.contamination(docs, items)
    return sorted(((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_hit, r["items"]) for r in out.collect()))


def contamination_rows():
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randrange(1, 80))) for i in range(30)]
    for i in range(40):
        item = rng.choice(ITEMS)[1] or ""
        text = f"{prose(rng, rng.randrange(20))} {item.upper() if i % 3 else item} {prose(rng, rng.randrange(20))}"
        rows.append((100 + i, text))
    return rows + [(500, None), (501, ""), (502, "short"), (503, "one short one short one"), (504, ITEMS[0][1][:40]),
                   (505, "the of and to in a is that it was " * 30), (506, "éa Éb c d e f g h i j k"),
                   (507, "ÉA ÉB c d e f g h i j k"), (508, "w1 " * 20_000 + ITEMS[0][1]), (None, "short one"),
                   (509, "short one"), (509, "short one"), (509, "no")]


def test_benchmark_passages(spark, documents):
    rows = contamination_rows()
    items = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, words string")
    expected = sorted((d is not None, d or 0, n, h, s) for d, n, h, s in brute.contamination(rows, ITEMS))
    assert contaminated(documents(rows, row=("string", "r"), n_words=("int", 1)), items) == expected


def test_benchmark_beyond_broadcasts_and_with_a_full_bitmap(spark, documents, monkeypatch):
    monkeypatch.setattr(contamination, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(contamination._bitmap, "__defaults__", (6,))
    rows = contamination_rows()[:45]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    expected = sorted((d is not None, d or 0, n, h, s) for d, n, h, s in brute.contamination(rows, ITEMS))
    assert contaminated(documents(rows), items) == expected


def test_a_null_text_is_not_the_row_whose_text_looks_like_its_id(spark):
    item = [("i1", "12345")]
    rows = [(12345, None), (None, "12345"), (12345, "12345"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = contamination.contamination(docs, spark.createDataFrame(item, "item_id string, text string")).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in out) == [
        ("12345", 0, 0, []), ("12345", 1, 1, ["i1"]), ("None", 0, 0, []), ("None", 1, 1, ["i1"])]


def test_benchmark_of_nothing(spark, documents):
    items = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(documents([(1, "a b"), (2, None)]), items) == [(True, 1, 2, 0, []), (True, 2, 0, 0, [])]
    assert contaminated(documents([]), spark.createDataFrame(ITEMS, "item_id long, text string")) == []


# -- quotes --------------------------------------------------------------------------------------------------------

def talk(spark, rows):
    out = quotes.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    return {(r.conv_id, r.turn): (r.text, r.n_quotes, r.n_linked, r.parent_turn, r.thread, r.depth) for r in out.collect()}


def test_quotes(spark):
    found = talk(spark, [
        (1, 0, "user", "Hello there.\nHow are   you?\n\nSecond paragraph here"),
        (1, 1, "assistant", "> how are you?\nFine."),
        (1, 2, "user", "Ann wrote:\n>> how are you?\n> Fine.\n\nGood"),
        (1, 3, "user", "> nobody said\nalone"),
        (1, 4, "user", "> > Fine.\n>Good\nyes"),
        (1, 5, "user", "> no such line\n> Second paragraph here\nlongest line"),
        (2, 0, "user", "x"), (2, 1, "user", "> second paragraph HERE\nfar"),
        (3, 0, None, None), (None, 0, "user", "> x\ny"), (4, 0, "user", "> later"), (4, 1, "user", "later"), (5, 0, "user", ""),
    ])
    assert found == {
        (1, 0): ("Hello there.\nHow are   you?\n\nSecond paragraph here", 0, 0, None, 0, 0),
        (1, 1): ("Fine.", 1, 1, 0, 0, 1),
        (1, 2): ("Good", 2, 2, 1, 0, 2),
        (1, 3): ("alone", 1, 0, None, 3, 0),
        (1, 4): ("yes", 2, 2, 2, 0, 3),
        (1, 5): ("longest line", 1, 1, 0, 0, 1),
        (2, 0): ("x", 0, 0, None, 0, 0),
        (2, 1): ("far", 1, 1, None, 1, 0),
        (3, 0): (None, 0, 0, None, 0, 0),
        (None, 0): ("y", 1, 0, None, 0, 0),
        (4, 0): ("", 1, 0, None, 0, 0),
        (4, 1): ("later", 0, 0, None, 1, 0),
        (5, 0): ("", 0, 0, None, 0, 0),
    }


def test_long_chain_and_repeats(spark):
    rows = [(7, 0, "user", "message 0")] + [(7, i, "user", f"> message {i - 1}\nmessage {i}") for i in range(1, 40)]
    found = talk(spark, rows + rows[:3])
    assert all(found[7, i] == (f"message {i}", int(i > 0), int(i > 0), i - 1 if i else None, 0, i) for i in range(40))
    out = quotes.conversations(spark.createDataFrame(rows + rows[:3], "conv_id long, turn long, role string, text string"))
    assert out.count() == 43


def test_messages_at_one_turn_have_parents_of_their_own(spark):
    rows = [(1, 0, "user", "first words"), (1, 1, "user", "> first words\nreply"), (1, 1, "assistant", "unrelated"),
            (1, 1, "user", "another"), (1, 2, "user", "> unrelated\nto the unrelated one"), (1, 3, "user", "> reply\nend")]
    out = quotes.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted((r.text, r.n_quotes, r.parent_turn, r.thread, r.depth) for r in out) == sorted([
        ("first words", 0, None, 0, 0), ("reply", 1, 0, 0, 1), ("unrelated", 0, None, 1, 0), ("another", 0, None, 1, 0),
        ("to the unrelated one", 1, 1, 1, 1), ("end", 1, 1, 0, 2)])


def test_conversations_of_nothing(spark):
    assert talk(spark, []) == {}
    table = spark.createDataFrame([(1, 0, "u", "a", "x")], "conv_id long, turn long, role string, text string, conv string")
    assert quotes.conversations(table).select(F.max("thread")).first()[0] == 0
