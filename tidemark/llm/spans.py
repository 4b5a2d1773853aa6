"""Word spans, hashes and ragged gathers over the UTF-8 buffers of an Arrow column.

Texts are worked on as one byte array with offsets, a few megabytes at a time, so that no Python object is made per
word. A word is a run of bytes other than 0x20 and 0x09-0x0D; as those are ASCII, byte runs are character runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20    # texts worked on at once; one longer text is a piece of its own
HASHED_BYTES = 1 << 16   # bytes of spans hashed at once; one longer span comes by itself
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_codes: dict[int, tuple[np.ndarray, np.uint64]] = {}
_powers: dict[int, np.ndarray] = {}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if texts.null_count:
        texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32) if len(texts) else np.zeros(1, np.int64)
    offsets = offsets[texts.offset if len(texts) else 0:][:len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose texts hold about ``limit`` bytes."""
    for batch in batches:
        _, offsets = buffers(batch.column(column))
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
            end = min(max(end, row + 1), batch.num_rows)
            yield batch.slice(row, end - row)
            row = end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the number of the first word of each text (one more entry than texts)."""
    inside = ~((data == 32) | ((data - np.uint8(9)) <= 4))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the items of the spans ``starts[i] .. starts[i] + lengths[i]``, one after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans that don't overlap: a polynomial over random byte codes, mixed with the length."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    if seed not in _codes:
        drawn = np.random.default_rng(7919 + seed).integers(0, 1 << 63, 257, np.uint64) << np.uint64(1)
        _codes[seed] = (drawn[:256] + np.uint64(1), (drawn[256] & ~np.uint64(7)) | np.uint64(5))
    code, base = _codes[seed]
    lengths = ends - starts
    longest = int(lengths.max())
    power = _powers.get(seed)
    if power is None or len(power) < longest:
        power = np.full(max(longest, 64), base, np.uint64)
        power[0] = 1
        power = _powers[seed] = np.multiply.accumulate(power)
    through = np.cumsum(lengths)
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):      # a run of spans at a time, as each byte needs five numbers
        done = int(through[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(through, done + HASHED_BYTES, side="right")))
        size = lengths[first:last]
        before = through[first:last] - size - done
        inner = np.arange(int(through[last - 1]) - done) - np.repeat(before, size)
        values = power[inner]
        values *= code[data[inner + np.repeat(starts[first:last], size)]]
        out[first:last] = np.add.reduceat(values, before)
        first = last
    return mix(out + lengths.astype(np.uint64) * _GOLDEN)


def windows(hashes: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``n`` word hashes that start at each place; ``len(hashes) - n + 1`` of them."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    factor = mix(np.array([seed + 1], np.uint64) * _GOLDEN)[0] | np.uint64(1)
    value = hashes[:count].copy()
    for k in range(1, n):
        value = value * factor + hashes[k:k + count]
    return mix(value + np.uint64(n))


def owners(first: np.ndarray) -> np.ndarray:
    """The text number of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def signed(values: np.ndarray) -> np.ndarray:
    """Hashes as Spark longs."""
    return values.view(np.int64)
