"""The quality classifier: features and pair sums against plain versions, and what it reaches on held-out rows."""

from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tidemark.llm import factors, queries

SF = "/root/testdata/sf0.1"


def test_query_on_the_table(spark):
    found = queries.queries()["op13_classified"](spark, SF)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()
    assert sorted(r.doc_id for r in rows) == sorted(d.doc_id for d in docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(r.score, quality[r.doc_id]) for r in rows if r.held_out and r.doc_id in quality]
    good, bad = ([s for s, q in held if q == kind] for kind in (1, 0))
    assert len(good) > 100 and len(bad) > 20
    assert sum(s >= 0.5 for s in good) > 0.97 * len(good)
    assert sum(s < 0.5 for s in bad) > 0.9 * len(bad)
    ranked = sorted(held)
    ranks = [i for i, (_, q) in enumerate(ranked, 1) if q == 1]
    assert (sum(ranks) - len(good) * (len(good) + 1) / 2) / (len(good) * len(bad)) > 0.98       # area under the curve


def plain_logit(model, features):
    out = model.bias + sum(model.weights[f] * v for f, v in features)
    for (f, v), (g, w) in itertools.combinations(features, 2):
        out += float(np.dot(model.factors[f].astype(float), model.factors[g].astype(float))) * v * w
    return out


def test_pairs_by_squares_are_all_pairs():
    rng = np.random.default_rng(4)
    model = factors.Model(0.3, rng.normal(size=factors.FEATURES), rng.normal(size=(factors.FEATURES, factors.RANK)))
    texts = ["", None, "one", "a b a c!", "DIE the 12 ** " * 5, "é à\n\n x\nx"]
    x = factors.features(pa.array(texts, pa.string()), pa.array([3, None, 0, 9, 80, 1]))
    found = factors.logits(model, x)
    for i in range(len(texts)):
        own = list(zip(x.feature[x.first[i]:x.first[i + 1]].tolist(), x.value[x.first[i]:x.first[i + 1]].tolist()))
        assert len(dict(own)) == len(own)
        assert math.isclose(found[i], plain_logit(model, own), rel_tol=1e-6, abs_tol=1e-6)


@pytest.mark.parametrize("seed", range(4))
def test_statistics(seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(["Ab", "x", " ", " ", "\n", "\n\n", "#", "9", "é!", "AB "]) for _ in range(rng.randint(0, 60)))
             for _ in range(30)] + ["", "\n", " "]
    data, offsets = factors.spans.buffers(pa.array(texts))
    starts, ends, first = factors.spans.words(data, offsets)
    found = factors._statistics(data, offsets, starts, ends, factors.spans.owners(first),
                                factors.spans.hash_spans(data, starts, ends))
    for i, text in enumerate(texts):
        words, lines = brute.words(text), [line for line in text.split("\n") if line]
        raw = text.encode()
        share = lambda n, of: n / max(of, 1)
        wanted = {
            "upper": share(sum(65 <= b < 91 for b in raw), len(raw)), "digits": share(sum(48 <= b < 58 for b in raw), len(raw)),
            "exclaimed": share(raw.count(b"!"), len(raw)), "n_words": len(words), "n_lines": len(lines),
            "follows_equal": share(sum(a == b for a, b in zip(words, words[1:])), len(words)),
            "repeated_words": share(len(words) - len(set(words)), len(words)),
            "repeated_lines": share(len(lines) - len(set(lines)), len(lines)),
            "symbol_words": share(sum("#" in w for w in words), len(words)),
            "upper_words": share(sum(2 * sum(c.isascii() and c.isupper() for c in w) > len(w.encode()) for w in words), len(words)),
            "longest_word": max((len(w.encode()) for w in words), default=0),
        }
        for name, value in wanted.items():
            assert math.isclose(found[name][i], value, abs_tol=1e-12), (name, text)


def test_word_weights():
    x = factors.features(pa.array(["b A a a\tB c"]), pa.array([1], pa.int64()))
    words = x.value[x.feature < 1 << factors.WORD_BITS]
    counts = sorted(Counter("b a a a b c".split()).values())
    wanted = np.array([1 + math.log(c) for c in counts])
    assert np.allclose(sorted(words), wanted / np.sqrt((wanted**2).sum()))


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7, 1) for r in rows],
                                 "doc_id long, text string, n_chars long, score string, label int, quality int")


def test_edges(spark):
    rng = random.Random(2)
    plain = lambda: " ".join(rng.choice("the of and with house water".split()) for _ in range(40)) + "."
    rows = [(i, plain() if i % 2 else plain().upper().replace(" ", "## "), i) for i in range(400)]
    rows += [(1000, None, None), (1001, "", 0), (None, plain(), None), (1002, plain() * 3000, 9), (3, None, 5), (3, "x", 5)]
    labels = [(i, int(i % 2), 0) for i in range(400)] + [(None, 0, 0), (5, None, 0), (7, 9, 0), (1000, 1, 1), (99_999, 0, 0)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, text int")
    out = factors.classify(table(spark, rows), marks)
    assert out.columns == ["doc_id", "n_chars", "label", "quality", "held_out", "score", "predicted"]
    found = out.collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert not [r for r in found if r.doc_id is None and r.held_out]
    held = [r for r in found if r.held_out and r.doc_id < 400 and r.doc_id != 3]
    assert held and all(r.predicted == r.doc_id % 2 for r in held)
    again = factors.classify(table(spark, rows).repartition(5), marks.repartition(3)).collect()
    assert sorted((str(r.doc_id), r.n_chars or 0, r.score) for r in found) == sorted(
        (str(r.doc_id), r.n_chars or 0, r.score) for r in again)


def test_nothing_to_learn_from(spark):
    docs, none = table(spark, [(1, "a", 1), (2, None, None)]), spark.createDataFrame([], "doc_id long, quality int")
    one_kind = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "doc_id long, quality int")
    for labels in (none, one_kind):
        assert [(r.score, r.predicted) for r in factors.classify(docs, labels).collect()] == [(0.5, 1)] * 2
    assert factors.classify(docs.limit(0), none).count() == 0
