"""Language model: a hashed maximum-entropy model with a class-factored softmax.

Tokens are words (A-Z lower-cased) and one end per text. Those of ``LEAST_COUNT`` or more occurrences, and the most frequent
``FREQUENT`` anyway, are in classes by frequency: ``DIRECT_CLASSES`` classes hold ``CLASS_WORDS`` words each, the others share
the rest, as trees of up to 64 branches a node whose depth follows the number of words. All other tokens are in ``ENDINGS``
classes by their last two bytes. The probability of a token given the tokens before it is that of its class times that of the
token in its class:

* class: softmax over all classes of a bias plus the weights of hashed features (the word before, the word before that as
  a skip feature, and both as a bigram);
* frequent word in its class: softmax over the words or branches of the class, with ``OWN_ROWS`` hashed feature rows for
  each class; then, down its branch, a softmax at each node, with ``SHARED_ROWS`` feature rows hashed with the node;
* other word in its class: (count + 1) / (class count + distinct words + 1). A word that was never seen has count 0.

Training, over all rows that aren't held out: token counts; then the occurrences of each feature with each class and
word, which give the first weights (the log ratio to the bias; 0 in shared rows); then ``SHARDS`` gradient updates, each over the rows that a
hash deals to it, so that every row is in one: tasks sum the gradients of their rows at the same weights, the driver adds the
sum, scaled by the occurrences. Weight tables have a fixed size; the words in classes grow with the corpus and are with the
model, with a bias each; the counts of all tokens stay distributed.

Scoring reads the texts once. Counts of frequent tokens (those in classes, ``KNOWN`` at least) are with the model; the others of each text are
dealt to buckets of the count table by hash, and come back as sums per text.

Words are known by 64-bit hashes. A null text is empty and has one token. Rows with a null key are neither held out nor
learned from. Repeated rows each get their score. Without training rows, ``score`` is ``base_score``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import blocks, spans
from tidemark.llm.substring import release
from tidemark.session import materialize

CLASSES_OF_WORDS, CLASS_WORDS, ENDINGS = 48, 64, 16
CLASSES = CLASSES_OF_WORDS + ENDINGS
FREQUENT = CLASSES_OF_WORDS * CLASS_WORDS
DIRECT_CLASSES = 40
DIRECT = DIRECT_CLASSES * CLASS_WORDS
LEAST_COUNT = 20
KNOWN = 1 << 16
OWN_ROWS, SHARED_ROWS = 1 << 8, 1 << 13       # feature rows of a class of words, and of all nodes below classes together
CLASS_ROWS, WORD_ROWS = 1 << 14, CLASSES_OF_WORDS * OWN_ROWS + SHARED_ROWS      # feature rows of the two weight tables
FEATURES = 3
SHARDS = 4            # gradient updates, each over the rows of one shard
PRIOR = 20.0          # occurrences of a feature at which its first weights count half
SHARE = 0.5           # of the log ratio that a first weight takes, as features overlap
STEP, DAMPING = 0.5, 10.0
CHUNK = 1024          # tokens worked on at once: their 64 outcomes stay in the cache of a core
_TABLE = (CLASS_ROWS + WORD_ROWS) * 64        # both tables, one after the other
_PART = 1 << 14                               # numbers of a table sent as one row
_SCANS_PER_TABLE = 6                          # scan partitions that one task takes in turn, with one table for all
_NONE = -1e30
_NO_RANK = np.iinfo(np.int64).max

START, END = np.uint64(1), np.uint64(2)       # stand for the places before a text and its end
Batches = Iterator[pa.RecordBatch]


def held_out(key: str = "doc_id", parts: int = 7, part: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % parts == part, F.lit(False))


@dataclass
class Tokens:
    """Tokens of some texts, one after another: hash, ending class, and the number before each text (one more entry)."""
    hashes: np.ndarray
    endings: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Tokens:
        data, offsets = spans.buffers(texts)
        data = spans.lower_ascii(data)
        starts, ends, first = spans.words(data, offsets)
        last = data[ends - 1].astype(np.uint64) * np.uint64(256) + data[np.maximum(ends - 2, starts)]
        endings = (spans.mix(last + np.uint64(11)) % np.uint64(ENDINGS)).astype(np.int8)
        hashes = spans.hash_spans(data, starts, ends) | np.uint64(4)       # never START or END
        return cls(np.insert(hashes, first[1:], END), np.insert(endings, first[1:], 0),
                   first + np.arange(len(first)))

    def before(self) -> tuple[np.ndarray, np.ndarray]:
        """The hashes one and two places before each token."""
        one, two = (np.full(len(self.hashes), START) for _ in range(2))
        one[1:], two[2:] = self.hashes[:-1], self.hashes[:-2]
        heads = self.first[:-1]
        one[heads] = two[heads] = START
        two[(heads + 1)[heads + 1 < self.first[1:]]] = START
        return one, two


def _keys(one: np.ndarray, two: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Keys of the word before, of the one before that, and of both; and their hashes."""
    keys = [one, two ^ np.uint64(0x5BD1E995), one * np.uint64(31) + spans.mix(two)]
    return keys, [_hashed(k) for k in keys]


def _hashed(keys: np.ndarray) -> np.ndarray:
    return (spans.mix(keys) >> np.uint64(40)).view(np.int64)


def _rows_of(keys: list[np.ndarray], hashes: list[np.ndarray], cls: np.ndarray | None = None) -> list[np.ndarray]:
    """Feature rows (their numbers are powers of two) of all classes, or of the given nodes."""
    if cls is None:
        return [h & (CLASS_ROWS - 1) for h in hashes]
    if len(cls) and cls[0] >= CLASSES_OF_WORDS:        # nodes below classes come by themselves
        node = spans.mix(cls.astype(np.uint64) + np.uint64(7))
        return [CLASSES_OF_WORDS * OWN_ROWS + (_hashed(k ^ node) & (SHARED_ROWS - 1)) for k in keys]
    return [cls * OWN_ROWS + (h & (OWN_ROWS - 1)) for h in hashes]


def _features(one: np.ndarray, two: np.ndarray, cls: np.ndarray | None = None) -> list[np.ndarray]:
    """Feature rows after the words ``one`` and ``two`` places before."""
    return _rows_of(*_keys(one, two), cls)


@dataclass
class Tree:
    """Places of ``often`` words, by their rank, in classes and in the nodes below those of many words.

    Nodes are numbered level by level, the classes of words first."""
    often: int
    width: int = field(init=False)                 # words of a class that isn't a direct one
    branches: int = field(init=False)
    spans: list[int] = field(init=False)           # words of a branch, level by level

    def __post_init__(self):
        self.width = max(CLASS_WORDS, -(-(self.often - DIRECT) // (CLASSES_OF_WORDS - DIRECT_CLASSES)))
        depth = 1
        while CLASS_WORDS ** depth < self.width:
            depth += 1
        self.branches = next(b for b in range(2, CLASS_WORDS + 1) if b ** depth >= self.width)
        self.spans = [self.width]
        for _ in range(depth):
            self.spans.append(-(-self.spans[-1] // self.branches))
        del self.spans[0]

    @property
    def nodes(self) -> int:
        return DIRECT_CLASSES + sum((CLASSES_OF_WORDS - DIRECT_CLASSES) * self.branches ** k for k in range(len(self.spans)))

    def classes(self, rank: np.ndarray) -> np.ndarray:
        """Class of words in classes."""
        return np.where(rank < DIRECT, rank // CLASS_WORDS, DIRECT_CLASSES + (rank - DIRECT) // self.width)

    def steps(self, rank: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per level: the numbers of the tokens that have a node there, the nodes and the places taken in them."""
        at = np.flatnonzero(rank < min(DIRECT, self.often))
        yield at, rank[at] // CLASS_WORDS, rank[at] % CLASS_WORDS
        at = np.flatnonzero((rank >= DIRECT) & (rank < self.often))
        index, within = np.divmod(rank[at] - DIRECT, self.width)
        first, n = DIRECT_CLASSES, CLASSES_OF_WORDS - DIRECT_CLASSES
        for span in self.spans:
            place, rest = np.divmod(within, span)
            yield at, first + index, place
            first, n, index, within = first + n, n * self.branches, index * self.branches + place, rest


@dataclass
class Model:
    """Weight tables of a fixed size, and the words in classes, which grow with the vocabulary: 28 bytes each."""

    n: int                                     # training tokens
    distinct: int
    hashes: np.ndarray                         # known tokens, sorted
    counts: np.ndarray
    rank: np.ndarray                           # by frequency
    ending_count: np.ndarray                   # tokens and distinct tokens of each ending class
    ending_distinct: np.ndarray
    tree: Tree
    class_bias: np.ndarray = field(default_factory=lambda: np.zeros(CLASSES, np.float32))
    word_bias: np.ndarray = field(default_factory=lambda: np.zeros((CLASSES_OF_WORDS, CLASS_WORDS), np.float32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(_TABLE, np.float32))

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count (-1: not among the known) and rank (``_NO_RANK`` if not) of tokens."""
        if not len(self.hashes):
            return np.full(len(hashes), -1), np.full(len(hashes), _NO_RANK)
        codes, distinct = pd.factorize(hashes)
        at = np.minimum(np.searchsorted(self.hashes, distinct), len(self.hashes) - 1)
        there = self.hashes[at] == distinct
        return np.where(there, self.counts[at], -1)[codes], np.where(there, self.rank[at], _NO_RANK)[codes]

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        return (self.weights[:CLASS_ROWS * 64].reshape(CLASS_ROWS, 64), self.weights[CLASS_ROWS * 64:].reshape(WORD_ROWS, 64))

    def levels(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Offset, weights and biases of the classes, of the words of direct classes, and of the nodes of the trees, which have
        fewer outcomes."""
        by_class, by_word = self.tables()
        few = self.tree.branches
        return [(0, by_class, self.class_bias), (_offset(1), by_word, self.word_bias),
                (_offset(1), np.ascontiguousarray(by_word[:, :few]), np.ascontiguousarray(self.word_bias[:, :few]))]

    def classes(self, tokens: Tokens, rank: np.ndarray) -> np.ndarray:
        return np.where(rank < self.tree.often, self.tree.classes(rank), CLASSES_OF_WORDS + tokens.endings)


_scratch: dict[tuple[int, int], np.ndarray] = {}


def _held(number: int, rows: int, width: int) -> np.ndarray:
    """Memory that is used again for every chunk, so that a chunk stays in the cache."""
    if (number, width) not in _scratch or len(_scratch[number, width]) < rows:
        _scratch[number, width] = np.empty((max(rows, CHUNK), width), np.float32)
    return _scratch[number, width][:rows]


def _logits(bias: np.ndarray, table: np.ndarray, features: list[np.ndarray]) -> np.ndarray:
    """Bias plus weights, for each row of feature numbers; in memory that the next call uses again.

    They need no shift before ``exp``: biases are logarithms of shares, and no sum of three weights reaches 60."""
    rows, width = len(features[0]), table.shape[1]
    out, more = _held(0, rows, width), _held(1, rows, width)
    np.take(table, features[0], axis=0, out=out, mode="clip")
    for f in features[1:]:
        np.take(table, f, axis=0, out=more, mode="clip")
        out += more
    out += bias
    return out


def _softmax(bias: np.ndarray, table: np.ndarray, features: list[np.ndarray]) -> np.ndarray:
    """Log probabilities of all outcomes for each row of feature numbers."""
    logits = _logits(bias, table, features).copy()
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def _chosen(bias: np.ndarray, table: np.ndarray, features: list[np.ndarray], outcome: np.ndarray) -> np.ndarray:
    """Log probability of one outcome for each row of feature numbers."""
    logits = _logits(bias, table, features)
    own = logits[np.arange(len(logits)), outcome]
    np.exp(logits, out=logits)
    return own - np.log(logits @ np.ones(logits.shape[1], np.float32))


def _passes(model: Model, tokens: Tokens, rank: np.ndarray):
    """Chunks of the softmaxes of classes and of nodes: token numbers, offset and table, bias, features, outcome."""
    cls = model.classes(tokens, rank)
    keys, hashes = _keys(*tokens.before())
    levels = model.levels()
    offset, table, bias = levels[0]
    for a in range(0, len(cls), CHUNK):
        at = slice(a, a + CHUNK)
        yield at, offset, table, bias, _rows_of(keys, [h[at] for h in hashes]), cls[at]
    for i, (of, node, place) in enumerate(model.tree.steps(rank)):
        offset, table, bias = levels[min(i, 1) + 1]
        for a in range(0, len(of), CHUNK):
            at, own = of[a:a + CHUNK], node[a:a + CHUNK]
            yield at, offset, table, bias[own], _rows_of([k[at] for k in keys], [h[at] for h in hashes], own), place[a:a + CHUNK]


def log_probabilities(model: Model, tokens: Tokens, rank: np.ndarray) -> np.ndarray:
    """Natural logarithm of the modelled part of each token's probability (all but the count of an infrequent one)."""
    out = np.zeros(len(tokens.hashes))
    for at, _, table, bias, features, outcome in _passes(model, tokens, rank):
        out[at] += _chosen(bias, table, features, outcome)
    return out


# -- counting ------------------------------------------------------------------------------------------------------

def _count(n: int):
    def items(batches: Batches):
        for batch in spans.pieces(batches, "text", 4 << 20):
            tokens = Tokens.of(batch.column("text"))
            codes, distinct = pd.factorize(tokens.hashes)
            ending = np.zeros(len(distinct), np.int8)
            ending[codes] = tokens.endings
            yield blocks.of_hash(distinct, n), spans.signed(distinct), ending, np.bincount(codes).astype(np.int64)
    return lambda batches: blocks.deal(items(batches))


def _add_counts(batches: Batches) -> Batches:
    """Each bucket's tokens with their counts, as one row sorted by hash."""
    for bucket, (hashes, ending, count) in blocks.whole_buckets(batches, ["<i8", "i1", "<i8"]):
        order = np.argsort(hashes, kind="stable")
        hashes, starts = _runs(hashes[order])
        payload = hashes.tobytes() + ending[order][starts].tobytes() + np.add.reduceat(count[order], starts).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([len(hashes)], pa.int32()),
                                          pa.array([payload], pa.binary())], names=["bucket", "n", "payload"])


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[starts], starts


def _totals(most: int):
    """Per bucket: tokens and distinct tokens of each ending class, and distinct tokens by their count, up to ``most``."""
    def run(batches: Batches) -> Batches:
        for _, (_, ending, count) in blocks.whole_buckets(batches, ["<i8", "i1", "<i8"]):
            sums = np.concatenate([np.bincount(ending, count, ENDINGS), np.bincount(ending, minlength=ENDINGS),
                                   np.bincount(np.minimum(count, most), minlength=most + 1)]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums)], names=["place", "n"])
    return run


def _of_count(least: int):
    """The tokens of ``least`` or more occurrences."""
    def run(batches: Batches) -> Batches:
        for _, (hashes, ending, count) in blocks.whole_buckets(batches, ["<i8", "i1", "<i8"]):
            kept = count >= least
            yield pa.RecordBatch.from_arrays([pa.array(hashes[kept]), pa.array(count[kept]),
                                              pa.array(ending[kept].astype(np.int32))], names=["hash", "n", "ending"])
    return run


def count_tokens(rows: DataFrame) -> DataFrame:
    n = blocks.bucket_count(rows)
    dealt = rows.select("text").mapInArrow(_count(n), blocks.SCHEMA)
    return materialize(blocks.gather(dealt, n).mapInArrow(_add_counts, blocks.SCHEMA), "token-counts")


def _empty_model(counts: DataFrame) -> Model:
    found = np.zeros(2 * ENDINGS + LEAST_COUNT + 1, np.int64)
    sums = counts.mapInArrow(_totals(LEAST_COUNT), "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    for row in sums.collect():                   # as many rows as ``found`` has places
        found[row["place"]] = row["n"]
    totals, by_count = found[:2 * ENDINGS], found[2 * ENDINGS:]
    n_often = max(FREQUENT, int(by_count[-1]))
    most = max(KNOWN, n_often)
    # only tokens of the counts that the most frequent ones have go to the driver
    enough = np.flatnonzero(np.cumsum(by_count[::-1])[::-1] >= most)
    frequent = counts.mapInArrow(_of_count(max(int(enough.max(initial=0)), 1)), "hash long, n long, ending int")
    top = frequent.orderBy(F.desc("n"), "hash").limit(most).toPandas()
    # the end of a text is always a frequent token, whatever its count
    end = top["hash"].to_numpy() == np.int64(END)
    top = pd.concat([top[end], top[~end]]) if end.any() and end.argmax() >= n_often else top
    hashes, count = top["hash"].to_numpy().view(np.uint64), top["n"].to_numpy()
    often = top.iloc[:n_often]
    tokens = totals[:ENDINGS] - np.bincount(often["ending"], often["n"], ENDINGS).astype(np.int64)
    distinct = totals[ENDINGS:] - np.bincount(often["ending"], minlength=ENDINGS)
    order = np.argsort(hashes)
    model = Model(int(totals[:ENDINGS].sum()), int(totals[ENDINGS:].sum()), hashes[order], count[order],
                  np.arange(len(hashes))[order], tokens, distinct, Tree(n_often))
    times, by_node = often["n"].to_numpy(float), np.zeros((model.tree.nodes, CLASS_WORDS))
    for at, node, place in model.tree.steps(np.arange(len(often))):
        np.add.at(by_node, (node, place), times[at])
    mass = np.concatenate([by_node[:CLASSES_OF_WORDS].sum(axis=1), tokens + distinct + 1.0])
    with np.errstate(divide="ignore"):
        model.class_bias = np.maximum(np.log(mass / mass.sum()), _NONE).astype(np.float32)
        of_node = by_node.sum(axis=1, keepdims=True)
        shares = np.log(by_node / np.maximum(of_node, 1))
        model.word_bias = np.where(of_node > 0, np.maximum(shares, _NONE), 0).astype(np.float32)   # 0: a node without words
    return model


# -- weights -------------------------------------------------------------------------------------------------------

def _sum_tables(rows: DataFrame, tasks: int, work) -> np.ndarray:
    """Sum over all tasks of the table that ``work`` makes from batches; a table has a fixed size.

    A task sends its whole table, so fewer tasks than the scan has partitions make them. The sum, one table whatever the
    number of tasks, comes to the driver without files between.
    """
    def run(batches: Batches) -> Batches:
        table = work(batches)
        for i in range(0, _TABLE, _PART):
            part = table[i:i + _PART]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i // _PART], pa.int32()), pa.array([len(part)], pa.int32()),
                     pa.array([part.astype(np.float32).tobytes()], pa.binary())], names=["bucket", "n", "payload"])

    def add(batches: Batches) -> Batches:
        current, total = None, None

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int32()), pa.array([len(total)], pa.int32()),
                 pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["bucket", "n", "payload"])
        for batch in batches:
            for bucket, block in zip(batch.column("bucket").to_pylist(), batch.column("payload").to_pylist()):
                if bucket != current and current is not None:
                    yield row()
                    total = None
                part = np.frombuffer(block, np.float32).astype(np.float64)
                current, total = bucket, part if total is None else total + part
        if current is not None:
            yield row()

    out = np.zeros(_TABLE)
    made = rows.coalesce(tasks).mapInArrow(run, blocks.SCHEMA)
    summed = blocks.gather(made, min(blocks.bucket_count(rows), -(-_TABLE // _PART))).mapInArrow(add, blocks.SCHEMA)
    for row in summed.collect():                 # one table, of a fixed size
        at = row["bucket"] * _PART
        out[at:at + row["n"]] = np.frombuffer(row["payload"], np.float32)
    del made, summed
    release(rows.sparkSession)
    return out


def _sum_with(model: Model, rows: DataFrame, tasks: int, work) -> np.ndarray:
    """The sum of tables of a ``work`` that needs the model, which leaves the executors afterwards."""
    shared = rows.sparkSession.sparkContext.broadcast(model)     # see Model
    try:
        return _sum_tables(rows, tasks, work(shared))
    finally:
        shared.destroy()


def _offset(level: int) -> int:
    return level * CLASS_ROWS * 64


def _occurrences(shared):
    def work(batches: Batches) -> np.ndarray:
        table = np.zeros(_TABLE, np.float32)
        for batch in spans.pieces(batches, "text"):
            model = shared.value
            tokens = Tokens.of(batch.column("text"))
            rank = model.look_up(tokens.hashes)[1]
            cls = model.classes(tokens, rank)
            keys, hashes = _keys(*tokens.before())
            cells = [f * 64 + cls for f in _rows_of(keys, hashes)]
            for at, node, place in model.tree.steps(rank):
                cells += [_offset(1) + f * 64 + place
                          for f in _rows_of([k[at] for k in keys], [h[at] for h in hashes], node)]
            for c in cells:
                np.add.at(table, c, np.float32(1))
        return table
    return work


def _gradient(shared):
    def work(batches: Batches) -> np.ndarray:
        table = np.zeros(_TABLE, np.float32)
        for batch in spans.pieces(batches, "text"):
            model = shared.value
            tokens = Tokens.of(batch.column("text"))
            rank = model.look_up(tokens.hashes)[1]
            for _, offset, weights, bias, features, outcome in _passes(model, tokens, rank):
                slope = _logits(bias, weights, features)
                np.exp(slope, out=slope)
                outcomes = np.arange(slope.shape[1])
                slope /= -(slope @ np.ones(len(outcomes), np.float32))[:, None]
                slope[np.arange(len(outcome)), outcome] += 1
                for f in features:          # flat, as numpy adds fast in one dimension only
                    np.add.at(table, ((f * 64 + offset)[:, None] + outcomes).ravel(), slope.ravel())
        return table
    return work


def train(rows: DataFrame, counts: DataFrame) -> Model:
    """``rows`` (``row``, ``text``) to learn from, and their token counts."""
    model = _empty_model(counts)
    if not model.n:
        return model
    tasks = max(1, -(-rows.select("text").rdd.getNumPartitions() // _SCANS_PER_TABLE))
    seen = _sum_with(model, rows.select("text"), tasks, _occurrences)
    scale = np.zeros(_TABLE, np.float32)
    for level, n_rows in ((0, CLASS_ROWS), (1, CLASSES_OF_WORDS * OWN_ROWS)):
        part = slice(_offset(level), _offset(level) + n_rows * 64)
        table = seen[part].reshape(n_rows, 64)
        total = table.sum(axis=1, keepdims=True)
        bias = model.class_bias if level == 0 else np.repeat(model.word_bias[:CLASSES_OF_WORDS], OWN_ROWS, axis=0)
        prior = np.exp(bias.astype(float))
        ratio = np.log((table + PRIOR * prior + 1e-9) / ((total + PRIOR) * prior + 1e-9))
        model.weights[part] = (SHARE * ratio).astype(np.float32).ravel()
        scale[part] = np.maximum(table, total * prior).ravel()
    shared = seen[-SHARED_ROWS * 64:].reshape(SHARED_ROWS, 64)       # rows of many nodes, each of another bias
    scale[-SHARED_ROWS * 64:] = np.maximum(shared, shared.mean(axis=1, keepdims=True)).ravel()
    for turn in range(SHARDS):
        shard = rows.where(F.pmod(F.xxhash64("row"), F.lit(SHARDS)) == turn)
        slope = _sum_with(model, shard.select("text"), tasks, _gradient)
        model.weights += np.clip(STEP * slope / (scale / SHARDS + DAMPING), -1, 1).astype(np.float32)
    return model


# -- scoring -------------------------------------------------------------------------------------------------------

_RARE = ["<i8", "<i8", "<i4"]                   # hash, row, times
_SUMS = ["<i8", "<f8", "<i8"]                   # row, sum of log10(count + 1), tokens of a count
_RECORD = ["<i8", "<i8", "u1", "u1", "<i8", "<f8", "<f8", "<i8"]      # row, key, null, held out, tokens, and so far:
#                                                                       sum of log10(count + 1), score, known tokens


def _score(shared, n: int):
    """Per text a record (bucket ``n`` + that of the row), and its tokens of unknown count (bucket of the hash)."""
    def items(batches: Batches):
        for batch in spans.pieces(batches, "text"):
            model: Model = shared.value
            tokens = Tokens.of(batch.column("text"))
            row, texts = batch.column("row").to_numpy(), batch.num_rows
            owner = np.repeat(np.arange(texts), np.diff(tokens.first))
            count, rank = model.look_up(tokens.hashes)
            score = log_probabilities(model, tokens, rank) / math.log(10)
            own = np.log10(np.maximum(count, 0) + 1.0)
            rare = rank >= model.tree.often
            norm = np.log10(model.ending_count + model.ending_distinct + 1.0)
            score[rare] += own[rare] - norm[tokens.endings[rare]]
            key = batch.column("doc")
            yield "record", (
                n + blocks.of_row(row, n), row, key.fill_null(0).to_numpy(),
                key.is_null().to_numpy(zero_copy_only=False).astype(np.uint8),
                batch.column("held_out").to_numpy(zero_copy_only=False).astype(np.uint8), np.diff(tokens.first),
                np.bincount(owner, own, texts), np.bincount(owner, score, texts),
                np.bincount(owner, count > 0, texts).astype(np.int64))
            unknown = np.flatnonzero(count < 0)
            codes, distinct = pd.factorize(tokens.hashes[unknown])
            pairs, times = np.unique(codes * texts + owner[unknown], return_counts=True)
            hashes = distinct[pairs // texts]
            yield "rare", (blocks.of_hash(hashes, n), spans.signed(hashes), row[pairs % texts], times.astype(np.int32))

    def run(batches: Batches) -> Batches:
        held: dict[str, list] = {"record": [], "rare": []}
        size = dict.fromkeys(held, 0)
        for kind, item in items(batches):
            held[kind].append(item)
            size[kind] += len(item[0])
            if size[kind] >= blocks.ITEMS:
                yield from blocks.deal(iter(held[kind]))
                held[kind], size[kind] = [], 0
        for kept in held.values():
            yield from blocks.deal(iter(kept))
    return run


def _parts(batches: Batches) -> Iterator[tuple[int, int, int, bytes]]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("bucket", "part", "n", "payload")))


def _look_up_rare(n: int):
    """The counts of a bucket (part 0) turn its rare tokens (1) into sums per row; records (2) go on as they are."""
    def run(batches: Batches) -> Batches:
        current, known, counts = None, np.zeros(0, np.int64), np.zeros(0, np.int64)

        def sums(count: int, payload: bytes):
            hashes, row, times = blocks.unpack([payload], [count], _RARE)
            found = np.zeros(len(hashes), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                found = np.where(known[at] == hashes, counts[at], 0)
            order = np.argsort(row, kind="stable")
            rows, starts = _runs(row[order])
            return (blocks.of_row(rows, n), rows, np.add.reduceat((np.log10(found + 1.0) * times)[order], starts),
                    np.add.reduceat(((found > 0) * times)[order], starts).astype(np.int64))

        held, size = [], 0
        for bucket, part, count, payload in _parts(batches):
            if bucket != current:
                current, known, counts = bucket, np.zeros(0, np.int64), np.zeros(0, np.int64)
            if part == 0:
                known, _, counts = blocks.unpack([payload], [count], ["<i8", "i1", "<i8"])
            elif part == 1:
                held.append(sums(count, payload))
                size += len(held[-1][0])
                if size >= blocks.ITEMS:
                    yield from blocks.deal(iter(held))
                    held, size = [], 0
            else:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n + bucket], pa.int32()), pa.array([count], pa.int32()), pa.array([payload], pa.binary())],
                    names=["bucket", "n", "payload"])
        yield from blocks.deal(iter(held))
    return run


def _finish(model: Model):
    """Records and the sums of their rows."""
    floor = math.log10(model.n + model.distinct + 1)
    n, learned = model.n, model.n > 0

    def run(batches: Batches) -> Batches:
        held: dict[int, tuple[list, list]] = {}

        def out():
            rows, logs, more = blocks.unpack(*held.get(0, ([], [])), _SUMS)
            row, key, null, out_, tokens, log, score, known = blocks.unpack(*held.get(1, ([], [])), _RECORD)
            distinct, times = np.unique(row, return_counts=True)       # equal rows have had their sums taken together
            at = np.searchsorted(distinct, rows)
            own = np.searchsorted(distinct, row)
            extra = np.bincount(at, logs, len(distinct))[own] / times[own]
            base = log + extra - tokens * floor
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, mask=null.astype(bool)), pa.array(out_.astype(bool)), pa.array(tokens),
                 pa.array(known + (np.bincount(at, more, len(distinct))[own] / times[own]).astype(np.int64)),
                 pa.array(np.full(len(row), n, np.int64)), pa.array(base),
                 pa.array(score + extra if learned else base)],
                names=["doc", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        current = None
        for bucket, part, count, payload in _parts(batches):
            if bucket != current and current is not None:
                yield from out()
                held = {}
            current = bucket
            payloads, counts = held.setdefault(part, ([], []))
            payloads.append(payload)
            counts.append(count)
        if current is not None:
            yield from out()
    return run


def _with_part(df: DataFrame, n: int, first: int) -> DataFrame:
    """Rows of buckets from ``n`` on are the part after ``first``, of the bucket less ``n``."""
    return df.select(F.pmod("bucket", F.lit(n)).cast("int").alias("bucket"),
                     (F.lit(first) + (F.col("bucket") >= n).cast("int")).alias("part"), "n", "payload")


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Learn from the rows that aren't held out and score all: one row per row, logarithms to base 10."""
    spark, n = docs.sparkSession, blocks.bucket_count(docs)
    rows = docs.select(F.col(key).cast("long").alias("doc"), held_out(key).alias("held_out"), F.col(text).alias("text"))
    rows = rows.select(F.xxhash64("doc", "text").alias("row"), "doc", "held_out", "text")
    learning = rows.where("NOT held_out AND doc IS NOT NULL").select("row", "text")
    counts = count_tokens(learning)
    release(spark)
    model = train(learning, counts)
    release(spark)
    dealt = rows.mapInArrow(_score(spark.sparkContext.broadcast(model), n), blocks.SCHEMA)
    first = counts.select("bucket", F.lit(0).alias("part"), "n", "payload").union(_with_part(dealt, n, 1))
    sums = blocks.gather(first, n, "part").mapInArrow(_look_up_rare(n), blocks.SCHEMA)
    found = blocks.gather(_with_part(sums, n, 0), n, "part").mapInArrow(
        _finish(model), "doc long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double")
    return found.withColumnRenamed("doc", key)
