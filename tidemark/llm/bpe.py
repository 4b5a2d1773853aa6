"""Byte-level BPE encoding and decoding with the ``tokenizers`` library over Arrow batches.

A codec is made from a ``tokenizers`` JSON file or from a file of ranks (base64 token and rank a line). Byte-level BPE
works on characters that stand for bytes; :func:`byte_characters` is that table, and decoding reverses it.

A text is cut before each single space or line feed between two characters that are surely not white space. The
splitting pattern never joins across such a cut, so the tokens of the whole are the tokens of the units one after another.
Units repeat, so each is encoded once and kept; a kept unit is used only where its bytes are the same.

Results: the ids of a text, and for each id the byte and the character at which it starts. A token may hold part of a
character (split characters): its start is then the place of the character that its first byte belongs to.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import spans

UNITS_KEPT = 1_500_000   # units kept by a worker (about 90 MB) before it starts afresh
TEXT_BYTES = 1 << 20     # texts encoded at once
RUN_BYTES = 1 << 17      # new units encoded as one text, as the library needs over 100 bytes a token
IDS_AT_ONCE = 1 << 18    # ids decoded at once

_codecs: dict[str, Codec] = {}


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where printable, else the next one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


def _merge_parts(token: bytes, ranks: dict[bytes, int], below: int) -> tuple[bytes, ...]:
    """What is left of a token's bytes after all merges of a rank under ``below``: the two parts that it is made from."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
        if rank >= below:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return tuple(parts)


def _from_ranks(path: str):
    from tokenizers import Tokenizer, models, pre_tokenizers
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
    shown = byte_characters()
    spelled = lambda token: "".join(shown[b] for b in token)
    merges = []
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        if len(token) > 1:
            parts = _merge_parts(token, ranks, rank)
            if len(parts) == 2:
                merges.append((spelled(parts[0]), spelled(parts[1])))
    tokenizer = Tokenizer(models.BPE(vocab={spelled(t): r for t, r in ranks.items()}, merges=merges,
                                     ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    return tokenizer


class Codec:
    """A tokenizer with the bytes of each id, working on many texts at once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"    # Spark runs one task a core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path) if path.endswith(".json") else _from_ranks(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        spelled = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            known = all(c in byte_of for c in token)
            spelled[number] = bytes(byte_of[c] for c in token) if known else token.encode()
        self.token_lengths = np.array([len(s) for s in spelled], np.int64)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        self.token_bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.forget()

    def forget(self) -> None:
        """Drop the units kept."""
        self.hashes = np.zeros(0, np.uint64)                      # of the units kept, sorted
        self.unit_starts, self.unit_lengths, self.unit_ids, self.unit_counts = (np.zeros(0, np.int64) for _ in range(4))
        self.unit_bytes, self.ids = np.zeros(0, np.uint8), np.zeros(0, np.int32)

    # -- encoding --------------------------------------------------------------------------------------------------

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the number of ids before each text (one more entry than texts)."""
        starts, ends = _units(data, offsets)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        hashes = spans.hash_spans(data, starts, ends)
        if len(self.hashes) > UNITS_KEPT:
            self.forget()
        inverse, unlike = pd.factorize(hashes)
        at = np.zeros(len(unlike), np.int64)
        at[inverse[::-1]] = np.arange(len(hashes))[::-1]      # the first unit of each hash
        order = np.argsort(unlike)                            # looked up in order: near in memory
        unlike, at = unlike[order], at[order]
        place = np.searchsorted(self.hashes, unlike)
        known = np.zeros(len(unlike), bool)
        inner = place < len(self.hashes)
        known[inner] = self.hashes[place[inner]] == unlike[inner]
        if not known.all():
            self._keep(data, starts[at[~known]], ends[at[~known]], unlike[~known])
            place = np.searchsorted(self.hashes, unlike)
        unit = np.empty_like(place)
        unit[order] = place
        unit = unit[inverse]
        lengths = ends - starts
        if not np.array_equal(self.unit_lengths[unit], lengths) or not np.array_equal(
                self.unit_bytes[spans.ragged(self.unit_starts[unit], lengths)], data):
            return self._encode_plainly(data, offsets)    # two units of one hash
        counts = self.unit_counts[unit]
        ids = self.ids[spans.ragged(self.unit_ids[unit], counts)]
        before = np.concatenate([[0], np.cumsum(counts)])
        return ids, before[np.searchsorted(starts, offsets)]

    def _encode_plainly(self, data, offsets):
        texts = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return (np.fromiter((i for ids in found for i in ids), np.int32),
                np.concatenate([[0], np.cumsum([len(ids) for ids in found], dtype=np.int64)]))

    def _keep(self, data, starts, ends, hashes) -> None:
        """Encode new units: those that may stand side by side as one text, the others each by itself."""
        lengths = ends - starts
        joinable = _opens(data)[starts] & _closes(data)[ends - 1]
        order = np.concatenate([np.flatnonzero(joinable), np.flatnonzero(~joinable)])
        held = data[spans.ragged(starts[order], lengths[order])]
        ends_held = np.cumsum(lengths[order])
        # texts of whole units: runs of joinable ones, then the others one by one
        together = ends_held[:int(joinable.sum())]
        cuts = [int(together[np.searchsorted(together, x, side="right") - 1])
                for x in range(RUN_BYTES, int(together[-1]) if len(together) else 0, RUN_BYTES)]
        borders = np.unique([0, *(c for c in cuts if c > 0), *together[-1:], *ends_held[len(together):]])
        found = []
        for a, b in zip(borders[:-1], borders[1:]):
            text = held[a:b].tobytes().decode()
            found.append(np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32))
        ids = np.concatenate(found)
        through = np.concatenate([[0], np.cumsum(self.token_lengths[ids])])      # bytes before each id
        borders = np.concatenate([[0], np.cumsum(lengths[order])])
        cuts = np.searchsorted(through, borders)
        if not np.array_equal(through[cuts], borders):
            raise ValueError("a token reaches over the end of a unit")
        new_starts = borders[:-1] + len(self.unit_bytes)
        new_ids = cuts[:-1] + len(self.ids)
        merged = np.concatenate([self.hashes, hashes[order]])
        sort = np.argsort(merged, kind="stable")
        self.hashes = merged[sort]
        self.unit_starts = np.concatenate([self.unit_starts, new_starts])[sort]
        self.unit_lengths = np.concatenate([self.unit_lengths, lengths[order]])[sort]
        self.unit_ids = np.concatenate([self.unit_ids, new_ids])[sort]
        self.unit_counts = np.concatenate([self.unit_counts, np.diff(cuts)])[sort]
        self.unit_bytes = np.concatenate([self.unit_bytes, held])
        self.ids = np.concatenate([self.ids, ids])

    # -- decoding --------------------------------------------------------------------------------------------------

    def decode(self, ids: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts and their offsets."""
        lengths = self.token_lengths[ids]
        through = np.concatenate([[0], np.cumsum(lengths)])
        return self.token_bytes[spans.ragged(self.token_starts[ids], lengths)], through[before]

    def places(self, data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, before: np.ndarray) -> tuple:
        """For each id the byte and the character of its text at which it starts."""
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
        through = np.cumsum(self.token_lengths[ids]) - self.token_lengths[ids]
        characters = np.cumsum((data & 0xC0) != 0x80)      # characters begun up to and with each byte
        base = np.concatenate([[0], characters])[offsets[:-1]]
        return through - offsets[text], characters[through] - 1 - base[text]


def _opens(data: np.ndarray) -> np.ndarray:
    """Where a byte is a space or line feed, and a character that is surely not white space follows."""
    follows = np.zeros(len(data), bool)
    then = data[1:]
    follows[:-1] = ((then > 0x20) & (then < 0x7F)) | ((then >= 0xC3) & ~((then >= 0xE1) & (then <= 0xE3)))
    return follows & ((data == 32) | (data == 10))


def _closes(data: np.ndarray) -> np.ndarray:
    """Where a byte ends a character that is surely not white space."""
    closes = (data > 0x20) & (data < 0x7F)
    closes[1:] |= (data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
    return closes


def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = _opens(data)[1:] & _closes(data)[:-1]
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    cut[-1] = False
    # a cut in front of a text's end or after its start must not look across the border
    starts = np.flatnonzero(cut)
    return starts, np.append(starts[1:], len(data)) if len(starts) else starts


def codec(path: str, shipped: bool = False) -> Codec:
    key = f"{path}|{shipped}"
    if key not in _codecs:
        _codecs[key] = Codec(SparkFiles.get(os.path.basename(path)) if shipped and not os.path.exists(path) else path)
    return _codecs[key]


def encode(df: DataFrame, path: str, text: str = "text", places: bool = True, decoded: bool = False) -> DataFrame:
    """``df`` with ``ids`` in place of the text and, if asked for, ``byte_starts`` and ``char_starts``, and ``decoded``.

    ``decoded`` holds the bytes that the ids stand for, made in the same pass. A null or empty text has no ids. Columns
    of these names are replaced; other columns stay, rows keep their number.
    """
    lists = ["ids", "byte_starts", "char_starts"][:3 if places else 1]
    added = [T.StructField(name, T.ArrayType(T.IntegerType(), False)) for name in lists]
    added += [T.StructField("decoded", T.BinaryType())] * decoded
    kept = [f for f in df.schema.fields if f.name not in (text, *(f.name for f in added))]
    schema = T.StructType([*kept, *added])
    _ship(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, True)
        for batch in spans.pieces(batches, text, TEXT_BYTES):
            data, offsets = spans.buffers(batch.column(text))
            ids, before = own.encode(data, offsets)
            found = [ids, *(own.places(data, offsets, ids, before) if places else ())]
            columns = [batch.column(f.name) for f in kept]
            columns += [pa.ListArray.from_arrays(pa.array(before, pa.int32()), pa.array(x, pa.int32())) for x in found]
            if decoded:
                columns.append(_binary(*own.decode(ids, before)))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        own.forget()      # the worker lives on, and what it runs next needs the memory
        pa.default_memory_pool().release_unused()

    return df.select(*[F.col(f"`{f.name}`") for f in kept], F.col(text)).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded`` (the bytes; a split character may leave bytes that are no UTF-8) in place of the ids."""
    kept = [f for f in df.schema.fields if f.name not in (ids, "decoded")]
    schema = T.StructType([*kept, T.StructField("decoded", T.BinaryType())])
    _ship(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, True)
        for batch, before in _id_pieces(batches, ids):
            lists = batch.column(ids)
            data, offsets = own.decode(lists.flatten().to_numpy(zero_copy_only=False), before)
            columns = [batch.column(f.name) for f in kept] + [_binary(data, offsets)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(*[F.col(f"`{f.name}`") for f in kept], F.col(ids)).mapInArrow(run, schema)


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    held = [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, held)


def _id_pieces(batches: Iterator[pa.RecordBatch], ids: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Runs of rows of about ``IDS_AT_ONCE`` ids, with the number of ids before each row."""
    for batch in batches:
        counts = batch.column(ids).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        through = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(through, through[row] + IDS_AT_ONCE, side="right")) - 1
            end = min(max(end, row + 1), batch.num_rows)
            yield batch.slice(row, end - row), through[row:end + 1] - through[row]
            row = end


def characters(pieces_of_text: list[bytes]) -> list[str]:
    """The text of each token in turn, a split character given with the token that ends it."""
    import codecs
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    shown = [decoder.decode(p) for p in pieces_of_text]
    if shown:
        shown[-1] += decoder.decode(b"", True)
    return shown


def _ship(df: DataFrame, path: str) -> None:
    """Executors get the vocabulary file (a few MB) from the driver if they don't have it."""
    if os.path.exists(path):
        df.sparkSession.sparkContext.addFile(path)


def round_trip(docs: DataFrame, path: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Ids of each text and their bytes, with the digests by which they are compared."""
    coded = encode(docs.select("doc_id", "text", *keep), path, places=False, decoded=True)
    return coded.select("doc_id", *keep, F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
