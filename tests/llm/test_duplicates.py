"""Repeated passages, line runs and similar documents, against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm import brute
from tidemark import session
from tidemark.llm import components, forest, lines, spans, substring


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def mixed(seed, docs=60):
    """Documents with shared passages, copies, near copies, repeats inside, odd white space and empty texts."""
    rng = random.Random(seed)
    shared = [prose(rng, rng.randrange(10, 40)) for _ in range(6)]
    rows = []
    for i in range(docs):
        parts = [prose(rng, rng.randrange(0, 60), 5000)]
        if rng.random() < 0.7:
            parts.append(rng.choice(shared))
        parts.append(prose(rng, rng.randrange(0, 30), 5000))
        if rng.random() < 0.2:
            parts.append(" ".join(["again and"] * rng.randrange(5, 60)))
        rows.append((rng.randrange(1000) * 3 + i % 3, rng.choice([" ", "\n", "  \t"]).join(parts)))
    rows = list(dict(rows).items())
    for doc, text in rows[:8]:
        rows.append((doc + 5000, text))
        words = text.split(" ")
        words[len(words) // 2] = "changed"
        rows.append((doc + 9000, " ".join(words)))
    return rows + [(20001, None), (20002, ""), (20003, " \n"), (20004, "one two"), (20005, "one two"),
                   (20006, "é" * 3000), (20007, prose(rng, 6000, 5000))]


# -- passages ------------------------------------------------------------------------------------------------------

def test_cover_meets_every_difference():
    differences = {(a - b) % substring.PERIOD for a in substring.COVER for b in substring.COVER}
    assert differences == set(range(substring.PERIOD))


def removed(docs, **more):
    out = substring.remove_repeats(docs, **more)
    return sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_removed, brute.sha(r.kept)) for r in out.collect())


def expected(rows):
    return sorted((d is not None, d or 0, n, k, s) for d, n, k, s in brute.repeats(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_passages(documents, seed):
    rows = mixed(seed)
    assert removed(documents(rows)) == expected(rows)


def test_hot_passages(documents, monkeypatch):
    monkeypatch.setattr(substring, "HOT_SHARE", 10_000)
    rows = mixed(3)
    assert len(substring.hot(substring._rows(documents(rows), "doc_id", "text"), 3)[1])
    assert removed(documents(rows), hot_least=3) == expected(rows)


def test_passages_of_ties_and_nulls(documents):
    rng = random.Random(5)
    passage = prose(rng, 30, 5000)
    rows = [(4, passage), (4, passage), (4, "x " + passage), (9, passage + " y"), (None, passage), (None, passage)]
    assert removed(documents(rows, row=("string", "r"), places=("int", 1))) == expected(rows)
    assert removed(documents([])) == []


# -- lines ---------------------------------------------------------------------------------------------------------

def plain_lines(rows):
    """Kept text per row, by checking every run against all earlier ones."""
    split = {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        split[doc] = [(i, line) for i, line in enumerate((text or "").split("\n")) if brute.WORD.search(line)]
    first, gone = {}, {d: set() for d in split}
    for doc, held in split.items():
        for i in range(len(held)):
            for n in (1, 2, 3):
                run = tuple(line for _, line in held[i:i + n])
                if len(run) == n and (n == 3 or sum(len(brute.words(x)) for x in run) >= 50):
                    other = first.setdefault(run, (doc, i))
                    if other[0] != doc or i >= other[1] + n:
                        gone[doc].update(range(i, i + n))
    out = []
    for doc, text in rows:
        drop = {split[doc][k][0] for k in gone[doc]}
        kept = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop)
        out.append((doc, kept, len(split[doc]), len(gone[doc])))
    return sorted(out)


def lined(seed):
    rng = random.Random(seed)
    short = [f"line {i}" for i in range(12)]
    long = [prose(rng, 60, 5000) for _ in range(4)]
    rows = []
    for doc in range(80):
        held = [rng.choice(short + long + ["", " ", prose(rng, 8, 5000), prose(rng, 30)]) for _ in range(rng.randrange(0, 14))]
        rows.append((doc * 5 % 397, "\n".join(held)))
    return rows + [(9001, None), (9002, ""), (9003, "\n\n"), (9004, "same\n" * 20), (9005, "same\n" * 20), (9006, "x " * 9000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_line_runs(documents, seed):
    rows = lined(seed)
    out = lines.remove_repeated(documents(rows, n_lines=("string", "clash")))
    assert out.columns == ["doc_id", "text", "n_lines", "n_removed"]
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_removed) for r in out.collect()) == plain_lines(rows)


def test_longer_runs_by_doubling(documents):
    """Runs of five lines are named by two overlapping runs of four."""
    a, b = [f"a{i}" for i in range(5)], [f"b{i}" for i in range(4)]
    rows = [(1, "\n".join(a + ["x"] + b)), (2, "\n".join(["y"] + a)), (3, "\n".join(b + ["z"])), (4, "\n".join(a[:4]))]
    out = {r.doc_id: r.text for r in lines.remove_repeated(documents(rows), min_lines=5).collect()}
    assert out == {1: rows[0][1], 2: "y", 3: rows[2][1], 4: rows[3][1]}


def test_runs_are_maximal(documents):
    rows = [(1, "a\nb\nc\nd"), (2, "q\na\nb\nc\nd\nr\na\nb\nc")]
    found = lines.runs(lines.repeated_lines(documents(rows)))
    assert sorted((r.start, r.n_lines) for r in found.collect()) == [(1, 4), (6, 3)]


def test_lines_of_ties_and_nothing(documents):
    text = "a\nb\nc"
    out = lines.remove_repeated(documents([(None, text), (2, text), (2, text + "\nd")])).collect()
    assert sorted((r.doc_id or 0, r.text) for r in out) == [(0, text), (2, ""), (2, "d")]
    assert lines.remove_repeated(documents([])).count() == 0


# -- similar documents ---------------------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", [1, 2])
def test_similar(documents, seed):
    rows = mixed(seed)
    found = sorted((r.doc_id, r.class_id, r.copy_id, r.n_links) for r in forest.join(documents(rows)).collect())
    assert found == brute.similar(rows)


def test_buckets_are_cut_into_blocks(documents, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK", 4)
    rng = random.Random(7)
    base = prose(rng, 120, 5000).split(" ")
    rows = []
    for doc in range(40):
        words = list(base)
        words[rng.randrange(len(words))] = f"own{doc}"
        rows.append((doc, " ".join(words)))
    found = sorted((r.doc_id, r.class_id, r.copy_id, r.n_links) for r in forest.join(documents(rows)).collect())
    assert found == brute.similar(rows)


def borderline(rng, n):
    """Pairs of similarity 0.8: 40 of 50 shingles shared. Their ids are 2k and 2k + 1."""
    rows = []
    for k in range(n):
        common = [f"c{k}x{rng.randrange(10 ** 6)}" for _ in range(44)]
        rows += [(2 * k + side, " ".join(common + [f"d{k}y{side}z{i}" for i in range(5)])) for side in (0, 1)]
    return rows


def unpaired(docs, n):
    return [r for r in forest.join(docs).collect() if r.doc_id < 2 * n and (r.class_id, r.n_links) != (r.doc_id // 2 * 2, 1)]


def test_close_copies_take_no_links_from_other_pairs(documents):
    rng = random.Random(11)
    base = [prose(rng, 1, 10 ** 6) + f"b{i}" for i in range(300)]
    hot = [(10_000 + i, " ".join(base[:i] + [f"own{i}"] + base[i + 1:])) for i in range(160)]
    assert not unpaired(documents(borderline(rng, 400) + hot), 400)


def test_pairs_whose_signatures_agree_less_are_verified(documents):
    assert forest.given_up() < 1e-6 and forest.recall(forest.SHORTEST) >= forest.TARGET
    assert not unpaired(documents(borderline(random.Random(12), 2000)), 2000)


def test_similar_with_ties_and_nulls(documents):
    text = " ".join(f"t{i}" for i in range(60))
    rows = [(5, text), (5, text), (3, text), (8, text + " end"), (None, text), (9, None), (9, None)]
    out = forest.join(documents(rows, doc=("int", 1), size=("int", 2))).collect()
    assert sorted((r.doc_id or 0, r.class_id or 0, r.n_links) for r in out) == [
        (0, 0, 0), (3, 3, 1), (5, 3, 1), (5, 3, 1), (8, 3, 1), (9, 9, 0), (9, 9, 0)]
    assert forest.join(documents([])).count() == 0


def test_small_steps_write_few_files(spark, documents):
    """A file per core, not one per shuffle partition: each file costs an executor helper processes."""
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in held}
    docs = documents(mixed(3), lang=("string", "en"), source=("string", "s"), n_chars=("long", 1))
    try:
        for key, value in held.items():
            spark.conf.set(key, value)
        with session.temporary(spark):
            corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
            files = [len(spark.read.parquet(path).inputFiles()) for path in session._recorded[-1]]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(files) > 10 and max(files) <= spark.sparkContext.defaultParallelism


def test_files_follow_the_bytes(spark):
    cores = spark.sparkContext.defaultParallelism
    assert session.file_count(spark, 0) == cores
    assert session.file_count(spark, 10 * cores * session.TARGET_FILE_BYTES) == 10 * cores


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [
        (5000, 5000 + i) for i in range(1, 50)]
    root = {n: n for link in links for n in link}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    out = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert sorted((r.node, r.root) for r in out) == sorted((n, find(n)) for n in linked)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- the word kernel -----------------------------------------------------------------------------------------------

def test_words_and_windows():
    texts = ["a  bb\tc", "", None, "\x0b x y ", "é\n日本"]
    data, offsets = spans.buffers(pa.array(texts))
    starts, ends, first = spans.words(data, offsets)
    for i, text in enumerate(texts):
        own = [data[a:b].tobytes().decode() for a, b in zip(starts[first[i]:first[i + 1]], ends[first[i]:first[i + 1]])]
        assert own == brute.words(text)
    sliced = pa.array(["zz", *texts, "q"]).slice(1, len(texts))
    assert all(np.array_equal(x, y) for x, y in zip(spans.buffers(sliced), (data, offsets)))


def test_equal_words_have_equal_hashes_anywhere():
    rng = random.Random(2)
    words = [prose(rng, 1, 50) for _ in range(500)]
    data, offsets = spans.buffers(pa.array([" ".join(words)]))
    starts, ends, _ = spans.words(data, offsets)
    hashes = spans.hash_spans(data, starts, ends)
    assert len(set(hashes.tolist())) == len(set(words))
    assert {(w, h) for w, h in zip(words, hashes.tolist())} == {(w, dict(zip(words, hashes.tolist()))[w]) for w in words}
    runs = spans.windows(hashes, 3)
    assert len({tuple(words[i:i + 3]) for i in range(len(runs))}) == len(set(runs.tolist()))
