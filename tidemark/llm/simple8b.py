"""Token ids in binary files, packed by Simple-8b: word-aligned coding of many ids per 64-bit word.

A word's upper 4 bits select how many ids of how many bits the lower 60 hold (:data:`COUNTS`, :data:`WIDTHS`). An id of
more than 60 bits is an escape: selector 15, with the place of the id in a list of plain 64-bit ids.

File layout, little-endian: frames one after another, each followed by the byte 0x0A that the text writer adds::

    magic 'TS8B' | uint32 part | uint64 first id of the frame within its part
    uint32 documents | uint32 ids | uint32 words | uint32 escapes
    int64 key per document (doc_id) | uint8 per document: 1 if the key is null | uint32 ids per document
    uint32 first word of each block of BLOCK ids | words | escaped ids

Ids run through a frame regardless of documents; each block of :data:`BLOCK` ids starts a new word, so that blocks are
packed side by side and found by their offset. A frame holds whole documents: about :data:`FRAME_IDS` ids, or one longer
document. Files are made by range of the key, so the parts, and the frames of a part, are in ascending order.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import bpe, spans

# Ids per word, and bits per id, of selectors 0-13.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 15
_NARROWEST = np.searchsorted(WIDTHS, np.arange(66)).clip(max=13).astype(np.uint8)     # by bit length
BLOCK = 1024
FRAME_IDS = 1 << 18
FRAMES_PER_FILE = 64
TEXT_BYTES = 2 << 20      # texts encoded at once
MAGIC = b"TS8B"
_HEAD = struct.Struct("<4sIQIIII")


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, the first word of each block, and the escaped ids."""
    ids = ids.astype(np.uint64)
    if not len(ids):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint64)
    blocks = -(-len(ids) // BLOCK)
    table = np.zeros((blocks, BLOCK + 60), np.uint64)       # past the end: zeros, which fit any width
    padded = np.zeros(blocks * BLOCK, np.uint64)
    padded[:len(ids)] = ids
    table[:, :BLOCK] = padded.reshape(blocks, BLOCK)
    # number of the narrowest width that holds each id; 14: none
    need = _NARROWEST[np.frexp(table.astype(np.float64))[1]]
    need[table >= np.uint64(1 << 60)] = 14
    # the selector at each place: of those whose ids all fit, the one that takes most
    choice = np.where(need[:, :BLOCK] == 14, ESCAPE, 13).astype(np.uint8)
    widest, taken = need[:, :BLOCK].copy(), 1
    for selector in range(12, -1, -1):
        while taken < COUNTS[selector]:
            np.maximum(widest, need[:, taken:taken + BLOCK], out=widest)
            taken += 1
        fits = widest <= selector
        if not fits.any():
            break
        choice[fits] = selector
    step = np.append(COUNTS, [0, 1])[choice]
    # walk all blocks in step, one word at a time
    sizes = np.full(blocks, BLOCK)
    sizes[-1] = len(ids) - (blocks - 1) * BLOCK
    rows, places, at, active = [], [], np.zeros(blocks, np.int64), np.arange(blocks)
    while len(active):
        here = at[active]
        rows.append(active)
        places.append(here)
        at[active] = here + step[active, here]
        active = active[at[active] < sizes[active]]
    taken = np.zeros((blocks, BLOCK), bool)
    taken[np.concatenate(rows), np.concatenate(places)] = True
    rows, places = np.nonzero(taken)
    selectors = choice[rows, places]
    words = np.zeros(len(rows), np.uint64)
    for selector in range(14):
        of = np.flatnonzero(selectors == selector)
        value = np.full(len(of), selector << 60, np.uint64)
        for k in range(COUNTS[selector]):
            value |= table[rows[of], places[of] + k] << np.uint64(k * WIDTHS[selector])
        words[of] = value
    escaped = np.flatnonzero(selectors == ESCAPE)
    words[escaped] = (np.uint64(ESCAPE) << np.uint64(60)) | np.arange(len(escaped), dtype=np.uint64)
    return words, np.searchsorted(rows, np.arange(blocks)).astype(np.uint32), table[rows[escaped], places[escaped]]


def unpack(words: np.ndarray, first_words: np.ndarray, escapes: np.ndarray, count: int) -> np.ndarray:
    """The ids back: all words of one selector at a time."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    held = np.append(COUNTS, [0, 1])[selectors]
    # ids of a block past BLOCK are padding: each block's words start at a multiple of BLOCK
    block = np.searchsorted(first_words, np.arange(len(words)), side="right") - 1
    before = np.cumsum(held) - held
    start = block * BLOCK + before - before[first_words][block] if len(words) else before
    ids = np.zeros(len(first_words) * BLOCK + 60, np.uint64)
    for selector in range(13, -1, -1):
        of = np.flatnonzero(selectors == selector)
        mask, width = np.uint64((1 << int(WIDTHS[selector])) - 1), int(WIDTHS[selector])
        room = (block[of] + 1) * BLOCK - start[of]
        for k in range(COUNTS[selector]):
            in_block = room > k
            if not in_block.all():
                of, room = of[in_block], room[in_block]
            ids[start[of] + k] = (words[of] >> np.uint64(k * width)) & mask
    of = np.flatnonzero(selectors == ESCAPE)
    ids[start[of]] = escapes[(words[of] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return ids[:count]


def frame(part: int, begins: int, keys: np.ndarray, missing: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    words, first_words, escapes = pack(ids)
    return b"".join([
        _HEAD.pack(MAGIC, part, begins, len(keys), len(ids), len(words), len(escapes)),
        keys.astype("<i8").tobytes(), missing.astype(np.uint8).tobytes(), counts.astype("<u4").tobytes(),
        first_words.astype("<u4").tobytes(), words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes()])


def frames(content: bytes) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Part, first id within the part, keys, missing marks, ids per document and ids of each frame of a file."""
    at = 0
    while at < len(content):
        magic, part, begins, documents, count, n_words, n_escapes = _HEAD.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at += _HEAD.size
        taken = []
        for kind, n in (("<i8", documents), ("u1", documents), ("<u4", documents), ("<u4", -(-count // BLOCK)),
                        ("<u8", n_words), ("<u8", n_escapes)):
            taken.append(np.frombuffer(content, kind, n, at))
            at += taken[-1].nbytes
        at += 1     # the line feed after the frame
        keys, missing, counts, first_words, words, escapes = taken
        yield part, begins, keys, missing, counts, unpack(words, first_words.astype(np.int64), escapes, count)


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int, partitions: int, key: str = "doc_id",
          text: str = "text") -> None:
    """Encode the texts and write them to ``path`` in ascending order of ``key`` (null first; equal keys by text).

    Each document is followed by ``end_id``; a null text is an empty one. Files hold about 64 frames at most. The writer
    is Spark's own, so files of failed or repeated tasks are never seen.
    """
    bpe._ship(docs, vocabulary)
    ordered = (docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
               .repartitionByRange(partitions, "key").sortWithinPartitions("key", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, begins = TaskContext.get().partitionId(), 0
        own = bpe.codec(vocabulary, True)
        held, size = [], 0

        def close():
            nonlocal held, size, begins
            keys, missing, counts, ids = (np.concatenate(x) for x in zip(*held))
            made = frame(part, begins, keys, missing, counts, ids)
            begins, held, size = begins + len(ids), [], 0
            return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["frame"])

        for batch in spans.pieces(batches, "text", TEXT_BYTES):
            data, offsets = spans.buffers(batch.column("text"))
            ids, before = own.encode(data, offsets)
            ids = np.insert(ids, before[1:], end_id)
            keys = batch.column("key")
            held.append((keys.fill_null(0).to_numpy(), keys.is_null().to_numpy(zero_copy_only=False),
                         np.diff(before) + 1, ids))
            size += len(ids)
            if size >= FRAME_IDS:
                yield close()
        if held:
            yield close()

    # the text writer puts the bytes out as they are
    ordered.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value")).write.option(
        "maxRecordsPerFile", FRAMES_PER_FILE).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files in ``path``: ``doc_id``, ``part``, ``begins`` (ids of the part before it), ``ids``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for part, begins, keys, missing, counts, ids in frames(memoryview(content.as_buffer())):
                    ends = np.cumsum(counts, dtype=np.int64)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(keys, mask=missing.astype(bool)), pa.array(np.full(len(keys), part, np.int32)),
                        pa.array(begins + ends - counts),
                        pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids.view(np.int64)))],
                        names=["doc_id", "part", "begins", "ids"])

    return _files(spark, path).mapInArrow(run, "doc_id long, part int, begins long, ids array<long>")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files with their place among all ids and the CRC-32 of their ids as 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for part, begins, keys, missing, counts, ids in frames(memoryview(content.as_buffer())):
                    ends = np.cumsum(counts, dtype=np.int64)
                    plain = memoryview(ids.astype("<u4").tobytes())
                    sums = [zlib.crc32(plain[4 * (e - c):4 * e]) for e, c in zip(ends.tolist(), counts.tolist())]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(keys, mask=missing.astype(bool)), pa.array(np.full(len(keys), part, np.int32)),
                        pa.array(begins + ends - counts), pa.array(counts.astype(np.int64)), pa.array(sums, pa.int64())],
                        names=["doc_id", "part", "begins", "n_tokens", "ids_crc32"])

    return _files(spark, path).mapInArrow(
        run, "doc_id long, part int, begins long, n_tokens long, ids_crc32 long")


def starts(found: DataFrame) -> DataFrame:
    """``found`` with ``start``: all ids of earlier parts, plus those of the own part before the document."""
    parts = found.groupBy("part").agg(F.sum("n_tokens").alias("held"))     # one row per part
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("earlier"))
    return found.join(F.broadcast(parts), "part").withColumn("start", F.col("earlier") + F.col("begins"))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
