"""Language identification and the language model: exact parts, and what they reach on held-out rows."""

from __future__ import annotations

import math
import os
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tidemark.llm import language, maxent, spans

SF = "/root/testdata/sf0.01"


# -- language ------------------------------------------------------------------------------------------------------

def best_value(scores):
    value = scores[0].copy()
    for row in scores[1:]:
        value = np.maximum(value, value.max() - language.SWITCH) + row
    return value.max()


@pytest.mark.parametrize("seed", range(20))
def test_path_is_the_best_one(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(0, 3 * language.RUN, 5)
    first = np.concatenate([[0], np.cumsum(lengths)])
    scores = (rng.normal(size=(first[-1], int(rng.integers(1, 6)))) * 6).astype(np.float32)
    labels = language._path(scores, first) if len(scores) else np.zeros(0, int)
    for a, b in zip(first[:-1], first[1:]):
        if a < b:
            own = labels[a:b]
            value = scores[np.arange(a, b), own].sum() - language.SWITCH * (own[1:] != own[:-1]).sum()
            assert math.isclose(value, best_value(scores[a:b]), rel_tol=1e-3, abs_tol=0.05)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language.identify(docs).select("doc_id", "lang", "held_out", "lang_pred", "score").collect()
    assert len(found) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) > 0.98 * len(held)


def test_mixed_text_and_scripts(spark):
    rng = random.Random(1)
    words = {"aa": "the and with from house water".split(), "bb": "der und mit aus haus wasser".split(),
             "cc": "вода дом улица город река".split()}
    say = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    rows = [(i, say(lang, 40), lang) for i in range(60) for lang in ("aa", "bb", "cc")]
    learned = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert learned.languages == ["aa", "bb", "cc"]
    texts = [(1, say("aa", 30) + " " + say("bb", 30) + " " + say("cc", 30)), (2, None), (3, ""), (4, "12 34 !!"),
             (5, "日本語"), (6, say("cc", 3)), (7, say("aa", 20_000)), (7, "улица"), (8, "é")]
    docs = spark.createDataFrame([(*t, "clash") for t in texts], "doc_id long, text string, score string")
    out = language.label(docs, learned).collect()
    by_id = {r.doc_id: r for r in out if r.text != "улица"}
    assert len(out) == len(texts)
    assert [s.lang for s in by_id[1].lang_spans] == ["aa", "bb", "cc"]
    assert [(s.first_word, s.end_word) for s in by_id[1].lang_spans] == [(0, 30), (30, 60), (60, 90)]
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 and not by_id[i].lang_spans for i in (2, 3, 4))
    assert by_id[5].lang_pred in words and by_id[6].lang_pred == "cc" and by_id[8].lang_pred in words
    assert by_id[7].lang_pred == "aa" and by_id[7].score == 1


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b", None), (None, "c", "en"), (3, None, "en")], "doc_id long, text string, lang string")
    out = language.identify(docs).collect()
    assert [(r.lang_pred, r.score) for r in out] == [("und", 0.0)] * 3
    assert not [r for r in out if r.doc_id is None and r.held_out]
    assert language.identify(docs.limit(0)).count() == 0


def test_a_large_batch_is_worked_on_in_small_pieces():
    rng = np.random.default_rng(5)
    words = np.array(["".join(chr(97 + c) for c in rng.integers(0, 26, n)) for n in rng.integers(2, 9, 5000)])
    texts = [" ".join(rng.choice(words, 300)) for _ in range(900)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    model = language.Model(["aa", "bb", "cc"], rng.random((1 << language.FEATURE_BITS, 3)).astype(np.float32),
                           np.ones((len(language._NAMES) + 1, 3), bool))

    def labelled(limit):
        tracemalloc.start()
        found = [language._label(model, piece.column("text"))[:2] for piece in spans.pieces([batch], "text", limit)]
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return [value for columns in found for value in zip(*(c.to_pylist() for c in columns))], peak

    small, least = labelled(language.PIECE_BYTES)
    large, most = labelled(spans.PIECE_BYTES)
    assert small == large and least < most / 2


# -- language model ------------------------------------------------------------------------------------------------

def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(brute.UPPER)) + [None]


def unigram(rows):
    """(id, held out, tokens, known, N, base) of (id, text) rows."""
    held = {doc: doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2 for doc, _ in rows}
    counts = Counter(t for doc, text in rows if doc is not None and not held[doc] for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    return [(doc, held[doc], len(tokens(text)), sum(counts[t] > 0 for t in tokens(text)), n,
             sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens(text))) for doc, text in rows]


def scored(docs):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[5])
    return sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                   for r in maxent.score(docs).collect()], key=key)


def same_base(found, rows):
    expected = sorted(unigram(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[5]))
    assert [f[:5] for f in found] == [e[:5] for e in expected]
    assert np.allclose([f[5] for f in found], [e[5] for e in expected], rtol=1e-9)


def test_model_beats_its_base_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = scored(docs)
    same_base(found, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    held = [f for f in found if f[1]]
    assert sum(f[6] for f in held) > sum(f[5] for f in held) + 0.1 * sum(f[2] for f in held)


def test_counts_beyond_the_known_tokens(documents, monkeypatch):
    """Tokens whose count is not with the model are looked up in the distributed table."""
    monkeypatch.setattr(maxent, "KNOWN", maxent.FREQUENT)
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.4)) % 9000}" for _ in range(200))) for i in range(120)]
    rows += [(500, None), (501, ""), (None, "w1 w2"), (3, rows[3][1]), (502, "UNSEEN w1"), (503, "x" * 50_000)]
    same_base(scored(documents(rows, row=("int", 1), score=("int", 2))), rows)


def test_probabilities_add_up_to_one(documents):
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.7)) % 6000}" for _ in range(300))) for i in range(60)]
    docs = documents(rows).selectExpr("xxhash64(doc_id) AS row", "text")
    model = maxent.train(docs, maxent.count_tokens(docs))
    one, two = (np.array([h], np.uint64) for h in (model.hashes[5], model.hashes[9]))
    class_table, word_table = model.tables()
    classes = np.exp(maxent._softmax(model.class_bias, class_table, maxent._features(one, two)))[0]
    assert math.isclose(classes.sum(), 1, rel_tol=1e-5)
    for c in range(maxent.CLASSES_OF_WORDS):
        features = maxent._features(one, two, np.array([c]))
        assert math.isclose(np.exp(maxent._softmax(model.word_bias[[c]], word_table, features)).sum(), 1, rel_tol=1e-5)
    # of an ending class: all its infrequent words, and one for any other
    total = model.ending_count + model.ending_distinct + 1
    assert np.all(model.ending_count + model.ending_distinct + 1 == total) and np.all(model.ending_count >= model.ending_distinct)


def test_words_beyond_the_first_classes_are_chosen_by_their_context(documents):
    """Two words of one count and one ending, both beyond the first 3,072: each is likelier after its own neighbour."""
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{j}" for j in rng.sample(range(3500), 3500))) for i in range(32)]
    rows += [(100 + i, ("here xone", "there yone")[i % 2]) for i in range(56)]
    docs = documents(rows).selectExpr("xxhash64(doc_id) AS row", "text")
    model = maxent.train(docs, maxent.count_tokens(docs))
    pairs = maxent.Tokens.of(pa.array(["here xone", "here yone", "there xone", "there yone"]))
    rank = model.look_up(pairs.hashes)[1]
    assert min(rank[1::3]) >= maxent.FREQUENT
    here_x, here_y, there_x, there_y = maxent.log_probabilities(model, pairs, rank)[1::3]
    assert here_x > here_y + 0.1 and there_y > there_x + 0.1


@pytest.mark.parametrize("often", [3072, 3073, 9000, 40_000, 300_000])
def test_words_have_places_of_their_own(often):
    tree, rank = maxent.Tree(often), np.arange(often + 5)
    paths = [[] for _ in rank]
    for at, node, place in tree.steps(rank):
        assert node.max(initial=0) < tree.nodes and place.max(initial=0) < maxent.CLASS_WORDS
        for i, step in zip(at.tolist(), zip(node.tolist(), place.tolist())):
            paths[i].append(step)
    assert len({tuple(p) for p in paths[:often]}) == often and not any(paths[often:])
    assert all(p[0][0] == c for p, c in zip(paths[:often], tree.classes(rank[:often]).tolist()))


def test_tree_probabilities_add_up_to_one(documents, monkeypatch):
    monkeypatch.setattr(maxent, "LEAST_COUNT", 1)
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{rng.randrange(9000)}" for _ in range(600))) for i in range(60)]
    docs = documents(rows).selectExpr("xxhash64(doc_id) AS row", "text")
    model = maxent.train(docs, maxent.count_tokens(docs))
    n = model.tree.often
    assert n == model.distinct > maxent.FREQUENT
    names = list({t for _, text in rows for t in tokens(text) if t})
    texts = maxent.Tokens.of(pa.array([f"{names[0]} {t}" for t in names] + [names[0]]))
    second = texts.first[:-1] + 1
    logs = maxent.log_probabilities(model, texts, model.look_up(texts.hashes)[1])[second]
    one, two = (np.array([h], np.uint64) for h in (texts.hashes[0], maxent.START))
    classes = np.exp(maxent._softmax(model.class_bias, model.tables()[0], maxent._features(one, two)))[0]
    assert math.isclose(np.exp(logs).sum() + classes[maxent.CLASSES_OF_WORDS:].sum(), 1, rel_tol=1e-4)


def test_every_training_row_is_in_a_gradient_update(documents, monkeypatch):
    docs = documents([(i, f"a b{i % 7} c{i}") for i in range(100)]).selectExpr("xxhash64(doc_id) AS row", "text")
    read, plain = [], maxent._sum_tables

    def sum_tables(rows, tasks, work):
        read.append([r.text for r in rows.collect()])
        return plain(rows, tasks, work)
    monkeypatch.setattr(maxent, "_sum_tables", sum_tables)
    maxent.train(docs, maxent.count_tokens(docs))
    assert sorted(t for shard in read[1:] for t in shard) == sorted(read[0]) and len(read[0]) == 100


def test_sums_go_through_no_files_and_models_leave_the_executors(documents, monkeypatch):
    docs = documents([(i, f"a b{i % 7} c{i}") for i in range(100)]).selectExpr("xxhash64(doc_id) AS row", "text")
    written, models, keep = [], [], maxent.materialize
    monkeypatch.setattr(maxent, "materialize", lambda df, name: written.append(name) or keep(df, name))
    for name in ("_occurrences", "_gradient"):
        plain = getattr(maxent, name)
        monkeypatch.setattr(maxent, name, lambda shared, plain=plain: models.append(shared) or plain(shared))
    maxent.train(docs, maxent.count_tokens(docs))
    assert written == ["token-counts"]
    assert len(models) == 1 + maxent.SHARDS and not any(os.path.exists(shared._path) for shared in models)


def test_only_tokens_as_frequent_as_those_known_go_to_the_driver(documents, monkeypatch):
    monkeypatch.setattr(maxent, "KNOWN", 5)
    monkeypatch.setattr(maxent, "FREQUENT", 3)
    times = {f"w{i}": 25 - i for i in range(25)}             # 6 words of 20 or more
    docs = documents([(i, w) for w, n in times.items() for i in range(n)]).select("text")
    counts, asked, plain = maxent.count_tokens(docs), [], maxent._of_count
    monkeypatch.setattr(maxent, "_of_count", lambda least: asked.append(least) or plain(least))
    model = maxent._empty_model(counts)
    assert asked == [20] and model.tree.often == 7 and model.n == 2 * sum(times.values()) and model.distinct == 26
    assert sorted(model.counts) == [20, 21, 22, 23, 24, 25, 325]
    monkeypatch.setattr(maxent, "KNOWN", 10)
    assert sorted(maxent._empty_model(counts).counts) == [*range(17, 26), 325] and asked == [20, 17]
    monkeypatch.setattr(maxent, "KNOWN", 100)
    assert len(maxent._empty_model(counts).counts) == 26 and asked == [20, 17, 1]


def test_tables_of_several_tasks_are_summed_into_one(spark):
    def work(batches):
        table = np.zeros(maxent._TABLE, np.float32)
        for batch in batches:
            for i in batch.column("id").to_pylist():
                table[[i, maxent._PART + i, maxent._TABLE - 1]] += 1
        return table
    expected = np.zeros(maxent._TABLE)
    for i in range(40):
        expected[[i, maxent._PART + i, maxent._TABLE - 1]] += 1
    assert (maxent._sum_tables(spark.range(0, 40, 1, 10), 5, work) == expected).all()


def test_hashing_needs_little_memory_whatever_the_piece():
    words = [b"x" * 100_000] + [b"w%d" % (i % 1000) for i in range(800_000)] + [b"y" * 100_000]
    data, offsets = spans.buffers(pa.array([b" ".join(words)], pa.binary()))
    starts, ends, _ = spans.words(data, offsets)
    spans.hash_spans(data, starts[:1], ends[:1])        # what is kept for all further calls
    tracemalloc.start()
    try:
        hashes = spans.hash_spans(data, starts, ends)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 16 * len(data)
    alone = [spans.hash_spans(*spans.buffers(pa.array([w], pa.binary()))[:1], np.array([0]), np.array([len(w)]))[0]
             for w in words[:5] + words[-5:]]
    assert [*hashes[:5], *hashes[-5:]] == alone


def test_model_of_nothing(documents):
    assert scored(documents([])) == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    assert scored(documents([(held, "a b")])) == [(held, True, 3, 0, 0, 0.0, 0.0)]
