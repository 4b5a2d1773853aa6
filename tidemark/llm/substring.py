"""Repeated passages across documents, found by difference-cover anchors.

A passage is a run of ``WINDOW`` words. Two equal passages, wherever they stand, hold equal anchors (runs of ``ANCHOR``
words) at places that are aligned in both: the anchor starts of a document are the word places whose remainder modulo
``PERIOD`` is in ``COVER``, and every difference of two remainders is a difference of two members of ``COVER``. So only
3 of 7 places are hashed to find candidates, and a candidate is extended to the passages around it:

1. the anchors of each document, once each, are dealt to buckets by hash; those of two or more documents are candidates;
2. the passages that hold a candidate, once each per document, are dealt to buckets by hash; a passage counts where a
   document of a smaller id has it too (96-bit hashes);
3. the words of these passages go, at all their places in the document.

An anchor or passage of very many documents would put many items into one bucket. Those of at least 1 in ``HOT_SHARE``
documents of a bounded sample are therefore kept out of the buckets: such an anchor is a candidate anyway, and of such a
passage the smallest document id is combined in each task. Which ones are found changes the load only, not the result.

Rows are told apart by a hash of id and text; documents with one id are apart, and none is smaller than the other.
A null text has no words. A document with a null id is neither shortened nor a reason to shorten another. Documents of
fewer than ``WINDOW`` words stay whole.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import blocks, spans
from tidemark.session import materialize

WINDOW = 13
PERIOD, COVER = 7, (1, 2, 4)       # a perfect difference set modulo 7
ANCHOR = WINDOW - PERIOD + 1       # words left for the anchor after the largest shift
SAMPLE_DOCS = 8000                 # looked at for hot anchors and passages
HOT_SHARE, HOT_LEAST, HOT_MOST = 64, 50, 4096

_IN_COVER = np.isin(np.arange(PERIOD), COVER)
Batches = Iterator[pa.RecordBatch]


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of steps whose results are written down.

    The first round tells the JVM which plans Python has dropped, the second one finds their shuffles unused.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()


@dataclass
class Words:
    """The words of some texts: byte spans, hashes, text number (``owner``) and first word of each text."""
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    owner: np.ndarray
    hashes: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Words:
        data, offsets = spans.buffers(texts)
        starts, ends, first = spans.words(data, offsets)
        return cls(data, starts, ends, first, spans.owners(first), spans.hash_spans(data, starts, ends))

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Place (among all words) and hash of the anchors of texts that hold a passage."""
        hashes = spans.windows(self.hashes, ANCHOR)
        owner, count = self.owner, len(hashes)
        place = np.arange(count) - self.first[owner[:count]]
        at = np.flatnonzero(_IN_COVER[place % PERIOD] & (owner[:count] == owner[ANCHOR - 1:ANCHOR - 1 + count])
                            & (np.diff(self.first)[owner[:count]] >= WINDOW))
        return at, hashes[at]

    def passages(self, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place and both hashes of the passages, of all or of those that may start at ``at``."""
        one = spans.windows(self.hashes, WINDOW)
        count = len(one)
        whole = self.owner[:count] == self.owner[WINDOW - 1:WINDOW - 1 + count]
        at = np.flatnonzero(whole) if at is None else at[at < count][whole[at[at < count]]]
        two = spans.windows(spans.mix(self.hashes), WINDOW, seed=1)[at]
        return at, one[at], (two >> np.uint64(32)).astype(np.uint32).view(np.int32)

    def per_text(self, at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """A number for each (text, hash)."""
        codes = pd.factorize(hashes)[0].astype(np.int64)
        return codes * (len(self.first) - 1) + self.owner[at]


def _member(values: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Which values are in the sorted ``held``."""
    if not len(held):
        return np.zeros(len(values), bool)
    return held[np.minimum(np.searchsorted(held, values), len(held) - 1)] == values


# -- hot anchors and passages --------------------------------------------------------------------------------------

def hot(rows: DataFrame, least: int = HOT_LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of anchors and of passages (the first hash) in very many documents of a sample; sorted, bounded lists."""
    total = rows.count()
    share = min(1.0, SAMPLE_DOCS / max(total, 1))
    sample = rows.where(F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < int(share * (1 << 20)))
    threshold = max(least, int(min(total, SAMPLE_DOCS) / HOT_SHARE))

    def run(batches: Batches) -> Batches:
        parts = ([], [])
        for batch in spans.pieces(batches, "text"):
            words = Words.of(batch.column("text"))
            for part, (at, hashes) in zip(parts, (words.anchors(), words.passages()[:2])):
                part.append(hashes[~pd.Series(words.per_text(at, hashes)).duplicated().to_numpy()])
        for kind, part in enumerate(parts):
            if part:
                hashes, counts = np.unique(np.concatenate(part), return_counts=True)
                often = counts > 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(int(often.sum()), kind, np.int32)), pa.array(spans.signed(hashes[often])),
                     pa.array(counts[often].astype(np.int64))], names=["kind", "hash", "n"])

    found = (sample.mapInArrow(run, "kind int, hash long, n long").groupBy("kind", "hash").agg(F.sum("n").alias("n"))
             .where(F.col("n") >= threshold).orderBy(F.desc("n"), "hash").limit(2 * HOT_MOST).collect())
    return tuple(np.sort(np.array([r["hash"] for r in found if r["kind"] == kind][:HOT_MOST], np.int64).view(np.uint64))
                 for kind in (0, 1))


# -- steps ---------------------------------------------------------------------------------------------------------

def _rows(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    picked = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text).alias("text"))
    return picked.select(F.xxhash64("doc", "text").alias("row"), "doc", "text")


def _emit_anchors(n: int, hot_anchors: np.ndarray, hot_passages: np.ndarray):
    """Anchors as (hash, row, place); smallest id of each hot passage under bucket ``n`` + its number."""
    def items(batches: Batches):
        least = np.full(len(hot_passages), np.iinfo(np.int64).max)
        for batch in spans.pieces(batches, "text"):
            words = Words.of(batch.column("text"))
            row = batch.column("row").to_numpy()
            at, hashes = words.anchors()
            common = _member(hashes, hot_anchors)
            if len(hot_passages):
                places, one, _ = words.passages()
                known = _member(one, hot_passages)
                np.minimum.at(least, np.searchsorted(hot_passages, one[known]),
                              batch.column("doc").to_numpy()[words.owner[places[known]]])
            at, hashes = at[~common], hashes[~common]
            once = ~pd.Series(words.per_text(at, hashes)).duplicated().to_numpy()
            at, hashes = at[once], hashes[once]
            yield (blocks.of_hash(hashes, n), spans.signed(hashes), row[words.owner[at]],
                   (at - words.first[words.owner[at]]).astype(np.int32))
        seen = np.flatnonzero(least != np.iinfo(np.int64).max)
        if len(seen):
            yield (seen + n).astype(np.int32), least[seen], np.zeros(len(seen), np.int64), np.zeros(len(seen), np.int32)

    return lambda batches: blocks.deal(items(batches))


def _around(words: Words, anchors: np.ndarray) -> np.ndarray:
    """Starts, in order, of the passages that hold one of the anchors; the last ones of a text may reach over its end."""
    depth = np.zeros(len(words.starts) + 1, np.int32)
    np.add.at(depth, np.maximum(anchors - (PERIOD - 1), words.first[words.owner[anchors]]), 1)
    np.add.at(depth, anchors + 1, -1)
    return np.flatnonzero(np.cumsum(depth)[:-1] > 0)


def _shared_anchors(n: int):
    """Places of anchors that two or more rows hold, by row; smallest ids of hot passages under negative buckets."""
    def items(batches: Batches):
        for bucket, (hashes, row, place) in blocks.whole_buckets(batches, ["<i8", "<i8", "<i4"]):
            if bucket >= n:
                yield np.array([n - 1 - bucket], np.int32), hashes.min(keepdims=True), np.zeros(1, np.int32)
                continue
            order = np.argsort(hashes, kind="stable")
            hashes, row, place = hashes[order], row[order], place[order]
            starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
            several = np.minimum.reduceat(row, starts) != np.maximum.reduceat(row, starts)
            keep = np.repeat(several, np.diff(np.append(starts, len(hashes))))
            yield blocks.of_row(row[keep], n), row[keep], place[keep]

    return lambda batches: blocks.deal(items(batches))


def _with_places(texts: DataFrame, places: DataFrame, n: int) -> DataFrame:
    """Texts and the places of their rows side by side: per bucket first the places, then the texts."""
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (("row", "long"), ("doc", "long"), ("text", "string"))]
    first = places.where("bucket >= 0").select("bucket", F.lit(0).alias("part"), "n", "payload", *none)
    then = texts.select(F.pmod("row", F.lit(n)).cast("int").alias("bucket"), F.lit(1).alias("part"),
                        F.lit(0).alias("n"), F.lit(None).cast("binary").alias("payload"), "row", "doc", "text")
    return blocks.gather(first.union(then), n, "part")


def _texts_with_places(batches: Batches) -> Iterator[tuple[pa.RecordBatch, Words, np.ndarray]]:
    """Pieces of texts, their words, and the places (among all words) that belong to them."""
    current, payload, counts, held = None, [], [], None
    for batch in batches:
        buckets, part = batch.column("bucket").to_numpy(), batch.column("part").to_numpy()
        cuts = np.flatnonzero((buckets[1:] != buckets[:-1]) | (part[1:] != part[:-1])) + 1
        for a, b in zip(np.append(0, cuts), np.append(cuts, batch.num_rows)):
            if a == b:
                continue
            run = batch.slice(a, b - a)
            if buckets[a] != current:
                current, payload, counts, held = buckets[a], [], [], None
            if part[a] == 0:
                payload += run.column("payload").to_pylist()
                counts += run.column("n").to_pylist()
                continue
            if held is None:
                rows, places = blocks.unpack(payload, counts, ["<i8", "<i4"])
                order = np.argsort(rows, kind="stable")
                held, payload = (rows[order], places[order]), []
            for texts in spans.pieces(iter([run]), "text"):
                words, row = Words.of(texts.column("text")), texts.column("row").to_numpy()
                low, high = (np.searchsorted(held[0], row, side=side) for side in ("left", "right"))
                own = held[1][spans.ragged(low, high - low)]
                yield texts, words, own + np.repeat(words.first[:-1], high - low)


def _equal_places(words: Words, at: np.ndarray, hashes: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """Of ``at``, those whose text has an equal hash at one of the ``marked`` places."""
    codes, distinct = pd.factorize(words.per_text(at, hashes))
    wanted = np.zeros(len(distinct), bool)
    wanted[codes[np.isin(at, marked)]] = True
    return at[wanted[codes]]


def _emit_passages(n: int, hot_anchors: np.ndarray, hot_passages: np.ndarray):
    def items(batches: Batches):
        for texts, words, marked in _texts_with_places(batches):
            at, hashes = words.anchors()
            at = np.concatenate([_equal_places(words, at, hashes, marked), at[_member(hashes, hot_anchors)]])
            places, one, two = words.passages(_around(words, at))
            rest = ~_member(one, hot_passages)
            rest[rest] = ~pd.Series(words.per_text(places[rest], one[rest])).duplicated().to_numpy()
            places, one, two = places[rest], one[rest], two[rest]
            owner = words.owner[places]
            yield (blocks.of_hash(one, n), spans.signed(one), two, texts.column("doc").to_numpy()[owner],
                   texts.column("row").to_numpy()[owner], (places - words.first[owner]).astype(np.int32))

    return lambda batches: blocks.deal(items(batches))


def _later_passages(n: int):
    """Places of passages that a document of a smaller id has too, by row."""
    def items(batches: Batches):
        for _, (one, two, doc, row, place) in blocks.whole_buckets(batches, ["<i8", "<i4", "<i8", "<i8", "<i4"]):
            order = np.lexsort((two, one))
            one, two, doc = one[order], two[order], doc[order]
            starts = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]))
            least = np.repeat(np.minimum.reduceat(doc, starts), np.diff(np.append(starts, len(one))))
            keep = order[doc > least]
            yield blocks.of_row(row[keep], n), row[keep], place[keep]

    return lambda batches: blocks.deal(items(batches))


def _shorten(hot_passages: np.ndarray, hot_least: np.ndarray):
    def run(batches: Batches) -> Batches:
        for texts, words, marked in _texts_with_places(batches):
            first, owner, n = words.first, words.owner, texts.num_rows
            at, one, _ = words.passages()
            begins = [_equal_places(words, at, one, marked)] if len(marked) else []
            known = np.flatnonzero(_member(one, hot_passages))
            if len(known):
                doc = texts.column("doc")
                ids = doc.fill_null(np.iinfo(np.int64).min).to_numpy()[owner[at[known]]]
                begins.append(at[known[ids > hot_least[np.searchsorted(hot_passages, one[known])]]])
            depth = np.zeros(len(owner) + 1, np.int32)
            for places in begins:
                np.add.at(depth, places, 1)
                np.add.at(depth, places + WINDOW, -1)
            kept = np.cumsum(depth)[:-1] == 0
            n_words = np.diff(first)
            n_kept = np.diff(np.concatenate([[0], np.cumsum(kept)])[first])
            yield pa.RecordBatch.from_arrays(
                [texts.column("doc"), pa.array(n_words.astype(np.int64)), pa.array((n_words - n_kept).astype(np.int64)),
                 _joined(words, np.flatnonzero(kept), n)], names=["doc", "n_words", "n_removed", "kept"])

    return run


def _joined(words: Words, at: np.ndarray, n: int) -> pa.Array:
    """The words ``at`` of each of ``n`` texts, joined by one space: the byte after a word becomes the space."""
    owner = words.owner[at]
    last = np.ones(len(at), bool)
    last[:-1] = owner[1:] != owner[:-1]
    padded = np.append(words.data, np.uint8(32))
    padded[words.ends[at][~last]] = 32
    lengths = words.ends[at] - words.starts[at] + ~last
    joined = padded[spans.ragged(words.starts[at], lengths)]
    sizes = np.bincount(owner, weights=lengths, minlength=n).astype(np.int64)
    borders = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.StringArray.from_buffers(n, pa.py_buffer(borders.tobytes()), pa.py_buffer(joined.tobytes()))


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", hot_least: int = HOT_LEAST) -> DataFrame:
    """Per row: id, ``n_words``, ``n_removed`` and ``kept`` (the words that stay, joined by one space)."""
    spark = docs.sparkSession
    n = blocks.bucket_count(docs)
    rows = _rows(docs, id_column, text)
    named = rows.where("doc IS NOT NULL")
    hot_anchors, hot_passages = hot(named, hot_least)
    anchors = named.mapInArrow(_emit_anchors(n, hot_anchors, hot_passages), blocks.SCHEMA)
    places = materialize(blocks.gather(anchors, n).mapInArrow(_shared_anchors(n), blocks.SCHEMA), "anchor-places")
    del anchors
    release(spark)
    smallest = np.full(len(hot_passages), np.iinfo(np.int64).max)
    for row in places.where("bucket < 0").select("bucket", "n", "payload").collect():     # at most HOT_MOST items
        ids = np.frombuffer(row["payload"], "<i8", row["n"])
        smallest[-1 - row["bucket"]] = min(smallest[-1 - row["bucket"]], ids.min())
    passages = _with_places(named, places, n).mapInArrow(
        _emit_passages(n, hot_anchors, hot_passages), blocks.SCHEMA)
    later = materialize(blocks.gather(passages, n).mapInArrow(_later_passages(n), blocks.SCHEMA), "later-passages")
    del passages
    release(spark)
    return _with_places(rows, later, n).mapInArrow(
        _shorten(hot_passages, smallest), "doc long, n_words long, n_removed long, kept string").withColumnRenamed(
        "doc", id_column)
