"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text has up to ``2^WORD_BITS`` hashed words (weighted by the logarithm of their counts, the whole of them of length 1),
a bin of each structure statistic (shares of upper case, digits, punctuation, symbols and repeated words and lines, lengths,
distinct words) and a bin of the metadata column ``n_chars``. The score is the logistic function of a bias, a weight per
feature and, for each pair of features, the product of their vectors of ``RANK`` factors; the sum over pairs is found in
linear time as half of the square of the sum less the sum of squares.

Training takes about ``LABELLED`` labelled rows (the bound of the sample; equally many of each label as far as there
are), chosen by a hash of their id; features are made in tasks, weights are fitted by mini-batches of AdaGrad on the
collected features. The factors start from a fixed seed, so equal input gives an equal model. Every text is scored whole, in the
tasks, by itself.

Labels, language, source and id are no inputs of a score. Null and empty texts have no words and get the score of their bins.
Null ids are scored, not learned from; of rows with one id the text of the least hash is learned. Labels other than 0 and
1 are not learned from. Without a label of both kinds, every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import spans

WORD_BITS = 18
RANK = 8
LABELLED = 16_000              # bound of the training sample
EPOCHS = 6
BATCH = 64
RATE, DECAY = 0.1, 1e-5
SEED = 20_011
PARTS = 3

# Upper bounds of the bins of shares, and of lengths.
SHARES = (0.0, 0.005, 0.01, 0.02, 0.04, 0.07, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
LENGTHS = (0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24, 32, 48, 64, 100, 200, 500, 1000, 2000, 5000, 10_000, 50_000)
# Byte classes (ASCII); letters beyond ASCII are none of them.
UPPER, DIGIT = (65, 91), (48, 58)
SYMBOL_BYTES, ENDING_BYTES = b"#*$%&|<>@^_~=+\\/{}[]", b".!?,;:"

_SHARED = ("upper", "digits", "symbols", "endings", "exclaimed", "symbol_words", "upper_words", "digit_words", "follows_equal",
           "repeated_words", "distinct_words", "repeated_lines", "short_words", "beyond_ascii")
_MEASURED = ("n_words", "mean_word", "longest_word", "n_lines", "words_a_line", "metadata")
STATISTICS = (*_SHARED, *_MEASURED)
_BINS = max(len(SHARES), len(LENGTHS)) + 2            # the last: unknown
FEATURES = (1 << WORD_BITS) + len(STATISTICS) * _BINS


@dataclass
class Model:
    bias: float
    weights: np.ndarray        # by feature
    factors: np.ndarray        # by feature and rank


@dataclass
class Sparse:
    """Features of texts, one after another: ``first[i]`` to ``first[i + 1]`` are those of text ``i``."""

    first: np.ndarray
    feature: np.ndarray
    value: np.ndarray

    def take(self, rows: np.ndarray) -> Sparse:
        lengths = self.first[rows + 1] - self.first[rows]
        at = spans.ragged(self.first[rows], lengths)
        return Sparse(np.concatenate([[0], np.cumsum(lengths)]), self.feature[at], self.value[at])


# -- features ------------------------------------------------------------------------------------------------------

def _class(members) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


_UPPER, _DIGIT = _class(range(*UPPER)), _class(range(*DIGIT))
_SYMBOL, _ENDING, _HIGH = _class(SYMBOL_BYTES), _class(ENDING_BYTES), _class(range(128, 256))
_EXCLAIM = _class(b"!")


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each line that is not empty, and its text."""
    breaks = np.flatnonzero(data == 10)
    starts = np.union1d(offsets[:-1], breaks + 1)
    ends = np.append(starts[1:], len(data))
    ends = ends - ((ends > starts) & (data[np.maximum(ends, 1) - 1] == 10) if len(data) else 0)
    kept = ends > starts
    starts, ends = starts[kept], ends[kept]
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def _again(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether an item occurred before in its text."""
    return pd.DataFrame({"owner": owner, "hash": hashes}).duplicated().to_numpy()


def _statistics(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray,
                hashes: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offsets) - 1

    def inside(table: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[data])])
        return total[end] - total[begin]

    def words(flags: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=flags, minlength=n)

    n_bytes, n_words = np.maximum(np.diff(offsets), 1), np.bincount(owner, minlength=n)
    length = ends - starts
    upper_in = inside(_UPPER, starts, ends)
    follows = np.zeros(len(hashes), bool)
    follows[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    again = _again(owner, hashes)
    line_start, line_end, line_owner = _lines(data, offsets)
    line_again = _again(line_owner, spans.hash_spans(data, line_start, line_end, 1))
    n_lines = np.bincount(line_owner, minlength=n)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, owner, length)
    some = np.maximum(n_words, 1)
    whole = lambda table: inside(table, offsets[:-1], offsets[1:]) / n_bytes
    return {
        "upper": whole(_UPPER), "digits": whole(_DIGIT), "symbols": whole(_SYMBOL), "endings": whole(_ENDING),
        "exclaimed": whole(_EXCLAIM),
        "symbol_words": words(inside(_SYMBOL, starts, ends) > 0) / some,
        "upper_words": words(2 * upper_in > length) / some,
        "digit_words": words(inside(_DIGIT, starts, ends) > 0) / some,
        "follows_equal": words(follows) / some,
        "repeated_words": words(again) / some,
        "distinct_words": (n_words - words(again)) / some,
        "repeated_lines": np.bincount(line_owner, weights=line_again, minlength=n) / np.maximum(n_lines, 1),
        "short_words": words(length <= 2) / some, "beyond_ascii": whole(_HIGH),
        "n_words": n_words, "mean_word": words(length) / some, "longest_word": longest, "n_lines": n_lines,
        "words_a_line": n_words / np.maximum(n_lines, 1),
    }


def features(texts: pa.Array, metadata: pa.Array) -> Sparse:
    """Features of texts and their metadata (a number, or null)."""
    data, offsets = spans.buffers(texts)
    starts, ends, first = spans.words(data, offsets)
    owner, n = spans.owners(first), len(texts)
    found = _statistics(data, offsets, starts, ends, owner, spans.hash_spans(data, starts, ends, 2))
    meta = metadata.cast(pa.float64()).to_numpy(zero_copy_only=False)
    bins = np.empty((n, len(STATISTICS)), np.int64)
    for i, name in enumerate(STATISTICS):
        values = meta if name == "metadata" else found[name]
        bins[:, i] = np.searchsorted(SHARES if name in _SHARED else LENGTHS, values, side="left")
    bins[np.isnan(meta), STATISTICS.index("metadata")] = _BINS - 1
    bins += (1 << WORD_BITS) + np.arange(len(STATISTICS)) * _BINS
    # words: distinct ones of a text with their counts, lower-cased
    hashes = spans.hash_spans(spans.lower_ascii(data), starts, ends) >> np.uint64(64 - WORD_BITS)
    key, count = np.unique((owner << WORD_BITS) | hashes.astype(np.int64), return_counts=True)
    of, weight = key >> WORD_BITS, 1 + np.log(count)
    norm = np.sqrt(np.bincount(of, weights=weight * weight, minlength=n))
    weight = weight / norm[of]
    fixed = len(STATISTICS)
    sizes = np.bincount(of, minlength=n) + fixed
    begin = np.concatenate([[0], np.cumsum(sizes)])
    feature, value = np.empty(begin[-1], np.int32), np.empty(begin[-1], np.float32)
    at = (begin[:-1, None] + np.arange(fixed)).ravel()
    feature[at], value[at] = bins.ravel(), 1 / np.sqrt(fixed)
    rest = np.ones(begin[-1], bool)
    rest[at] = False
    feature[rest], value[rest] = key & ((1 << WORD_BITS) - 1), weight
    return Sparse(begin, feature, value)


# -- the machine ---------------------------------------------------------------------------------------------------

def logits(model: Model, x: Sparse) -> np.ndarray:
    """Bias, weights, and half of (square of the sum - sum of the squares) of the factors, per text."""
    rows = np.repeat(np.arange(len(x.first) - 1), np.diff(x.first))
    n = len(x.first) - 1
    value = x.value.astype(np.float64)
    out = model.bias + np.bincount(rows, weights=model.weights[x.feature] * value, minlength=n)
    for k in range(model.factors.shape[1]):
        held = model.factors[x.feature, k] * value
        total = np.bincount(rows, weights=held, minlength=n)
        out += 0.5 * (total * total - np.bincount(rows, weights=held * held, minlength=n))
    return out


def scores(model: Model, x: Sparse) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logits(model, x), -50, 50)))


def fit(x: Sparse, labels: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Weights by mini-batches of AdaGrad; each label counts as much as the other."""
    rng = np.random.default_rng(SEED)
    model = Model(0.0, np.zeros(FEATURES), rng.normal(0, 0.05, (FEATURES, RANK)))
    seen_w, seen_v, seen_b = np.full(FEATURES, 1e-6), np.full(FEATURES, 1e-6), 1e-6
    share = np.bincount(labels, minlength=2) / max(len(labels), 1)
    if share.min() == 0:
        return Model(0.0, np.zeros(FEATURES), np.zeros((FEATURES, RANK)))
    importance = 0.5 / share[labels]
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for start in range(0, len(order), BATCH):
            rows = order[start:start + BATCH]
            part = x.take(rows)
            there, own = np.unique(part.feature, return_inverse=True)
            row = np.repeat(np.arange(len(rows)), np.diff(part.first))
            value = part.value.astype(np.float64)
            held = model.factors[part.feature] * value[:, None]
            total = np.add.reduceat(held, part.first[:-1], axis=0)          # every text has features
            squares = np.add.reduceat(held * held, part.first[:-1], axis=0)
            logit = (model.bias + np.bincount(row, weights=model.weights[part.feature] * value, minlength=len(rows))
                     + 0.5 * (total * total - squares).sum(axis=1))
            off = (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - labels[rows]) * importance[rows] / len(rows)
            by = off[row] * value
            grad_w = np.bincount(own, weights=by, minlength=len(there)) + DECAY * model.weights[there]
            pull = by[:, None] * (total[row] - held)
            grad_v = np.column_stack([np.bincount(own, weights=pull[:, k], minlength=len(there)) for k in range(RANK)])
            grad_v += DECAY * model.factors[there]
            seen_w[there] += grad_w * grad_w
            seen_v[there] += (grad_v * grad_v).mean(axis=1)
            seen_b += off.sum() ** 2
            model.weights[there] -= RATE * grad_w / np.sqrt(seen_w[there])
            model.factors[there] -= RATE / 2 * grad_v / np.sqrt(seen_v[there])[:, None]
            model.bias -= RATE * off.sum() / np.sqrt(seen_b)
    return Model(model.bias, model.weights.astype(np.float32), model.factors.astype(np.float32))


# -- over documents ------------------------------------------------------------------------------------------------

def held_out(key: str = "doc_id", parts: int = PARTS) -> Column:
    """Whether a row is kept from training: a null key is not, nor is it learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % parts == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", text: str = "text",
           metadata: str = "n_chars", most: int = LABELLED) -> DataFrame:
    """Columns ``text``, ``metadata`` and ``label`` of about ``most`` rows that are not held out."""
    usable = (labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(key))
              .groupBy(F.col(key).alias("__key"), F.col(label).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("__n")))
    sizes = {row[0]: row[1] for row in usable.groupBy("label").count().collect()}        # two rows at most
    share = F.coalesce(*[F.when(F.col("label") == kind, F.lit(min(1.0, most / 2 / n))) for kind, n in sizes.items()],
                       F.lit(0.0))
    place = F.pmod(F.xxhash64(F.col("__key").cast("string"), F.lit(13)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = F.broadcast(usable.where(place < share).select("__key", "label"))           # about ``most`` ids
    own = F.struct(F.col(text).alias("text"), F.col(metadata).cast("double").alias("metadata"))
    texts = docs.select(F.col(key).alias("__key"), own.alias("__own"))
    found = texts.join(chosen, "__key").groupBy("__key", "label").agg(
        F.min_by("__own", F.xxhash64("__own")).alias("__own"))
    return found.select("__own.text", "__own.metadata", "label")


def train(docs: DataFrame, labels: DataFrame, **columns) -> Model:
    on = sample(docs, labels, **columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in spans.pieces(batches, "text"):
            x = features(batch.column("text"), batch.column("metadata"))
            border = pa.array(x.first.astype(np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.ListArray.from_arrays(border, pa.array(x.feature)),
                 pa.ListArray.from_arrays(border, pa.array(x.value))], names=["label", "feature", "value"])

    # features of a bounded sample
    found = on.mapInArrow(run, "label int, feature array<int>, value array<float>").toArrow().combine_chunks()
    feature, value = (found.column(c).combine_chunks() for c in ("feature", "value"))
    feature, value = (c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in (feature, value))
    label = found.column("label").to_numpy().astype(np.int64)
    x = Sparse(np.concatenate([[0], np.cumsum(feature.value_lengths().to_numpy())]).astype(np.int64),
               feature.flatten().to_numpy(), value.flatten().to_numpy())
    # an order that does not depend on the tasks
    order = np.lexsort([np.add.reduceat(x.value, x.first[:-1]), np.add.reduceat(x.feature.astype(np.int64), x.first[:-1]),
                        label]) if len(label) else np.zeros(0, np.int64)
    return fit(x.take(order), label[order])


def score(docs: DataFrame, model: Model, text: str = "text", metadata: str = "n_chars") -> DataFrame:
    """``docs`` without the text, with ``score`` and ``predicted``. Columns of these names are replaced."""
    added = ("score", "predicted")
    kept = [c for c in docs.columns if c not in (*added, text)]
    wanted = docs.select(*[f"`{c}`" for c in kept], F.col(text).alias("__text"),
                         F.col(metadata).cast("double").alias("__metadata"))
    schema = docs.select(*[f"`{c}`" for c in kept], F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)       # a row of RANK + 1 floats for each of FEATURES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in spans.pieces(batches, "__text"):
            found = scores(shared.value, features(batch.column("__text"), batch.column("__metadata")))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                names=[*kept, *added])

    return wanted.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", text: str = "text",
             metadata: str = "n_chars") -> DataFrame:
    """Train on the labelled rows that are not held out and score all rows."""
    model = train(docs, labels, key=key, label=label, text=text, metadata=metadata)
    return score(docs.withColumn("held_out", held_out(key)), model, text, metadata)
