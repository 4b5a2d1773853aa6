"""Language identification of mixed text: script ranges, scores per word, and a Viterbi path with a switching penalty.

Training counts hashed byte n-grams of words, and letters per script, for each language. For a text, each word gets a
score per language (the log probabilities of its n-grams); languages that don't use the word's script are no candidates
for it. The best path over the words, where each change of language costs ``SWITCH``, labels spans of one language. Long
texts are cut into runs of ``RUN`` words; the best path through each run is found for every language at its start, so
that all runs of a batch are worked on together.

The prediction is the language of most words; the score is its share of the words. A null text, or one without a
letter, is ``und`` with score 0 and has no spans. A text of letters in scripts that no learned language uses still gets a
learned language (the scores then say little). Ties go to the first language in sorted order. Training takes rows with a
text and a language; without any, every prediction is ``und``.
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

UNKNOWN = "und"
DOCS_PER_LANGUAGE = 2000       # bound of the training sample: about so many documents of each language
FEATURE_BITS = 16
GRAMS = (1, 2, 3, 4)
SWITCH = 12.0                  # cost of changing the language between two words, in nats
RUN = 128
PIECE_BYTES = 1 << 18          # texts worked on at once: a piece needs several hundred bytes of memory for each of its own
SCRIPT_SHARE = 0.002           # a language uses a script if this share of its letters is in it

# First code point and script of ranges of letters (Unicode blocks).
SCRIPTS = ((0x0000, "none"), (0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
           (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "indic"),
           (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"),
           (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "none"), (0x3040, "kana"), (0x3100, "han"),
           (0xA000, "other"), (0xAC00, "hangul"), (0xD800, "other"), (0x20000, "han"), (0x30000, "other"))
_BOUNDS = np.array([start for start, _ in SCRIPTS])
_NAMES = sorted({name for _, name in SCRIPTS} - {"none"})
_SCRIPT_OF = np.array([_NAMES.index(name) if name != "none" else len(_NAMES) for _, name in SCRIPTS])


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray        # log probability of a feature, by feature and language
    uses: np.ndarray         # whether a language uses a script, by script (the last: none) and language


def _distinct_words(data: np.ndarray, offsets: np.ndarray):
    """Bytes of the distinct words between spaces, the place of each, and for each word of the texts its number."""
    starts, ends, first = spans.words(data, offsets)
    number, distinct = pd.factorize(spans.hash_spans(data, starts, ends))
    at = np.zeros(len(distinct), np.int64)
    at[number[::-1]] = np.arange(len(starts))[::-1]
    lengths = ends[at] - starts[at]
    begins = np.cumsum(lengths + 2) - (lengths + 2)
    padded = np.full(int((lengths + 2).sum()), 32, np.uint8)
    padded[spans.ragged(begins + 1, lengths)] = data[spans.ragged(starts[at], lengths)]
    return padded, begins, number, first


def _features(padded: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the padded words and the word of each, in order of the words."""
    word = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(padded))))
    found, owner = [], []
    value = np.zeros(len(padded), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        count = len(padded) - n + 1
        if count <= 0:
            break
        value = value[:count] * np.uint64(257) + padded[n - 1:] + np.uint64(1)
        if n in GRAMS:
            whole = word[:count] == word[n - 1:]
            if n == 1:
                whole &= padded != 32
            found.append((spans.mix(value[whole] + np.uint64(n << 56)) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64))
            owner.append(word[:count][whole])
    found, owner = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found, owner))
    order = np.argsort(owner, kind="stable")
    return found[order], owner[order]


def _letters(padded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the letters of the known ranges, and their script."""
    lead = np.flatnonzero((padded & 0xC0) != 0x80)
    value = padded[lead].astype(np.int64)
    more = np.append(padded, [0, 0, 0]).astype(np.int64) & 0x3F
    two, three, four = ((value >= low) & (value < high) for low, high in ((0xC0, 0xE0), (0xE0, 0xF0), (0xF0, 0x100)))
    point = value.copy()
    point[two] = (value[two] & 0x1F) << 6 | more[lead[two] + 1]
    point[three] = (value[three] & 0x0F) << 12 | more[lead[three] + 1] << 6 | more[lead[three] + 2]
    point[four] = ((value[four] & 0x07) << 18 | more[lead[four] + 1] << 12 | more[lead[four] + 2] << 6
                   | more[lead[four] + 3])
    letter = (point >= 0xC0) | ((point | 0x20) >= 0x61) & ((point | 0x20) <= 0x7A)
    letter &= (point != 0xD7) & (point != 0xF7)
    script = _SCRIPT_OF[np.searchsorted(_BOUNDS, point, side="right") - 1]
    letter &= script < len(_NAMES)
    return lead[letter], script[letter]


# -- training ------------------------------------------------------------------------------------------------------

def train(docs: DataFrame, text: str = "text", language: str = "lang", key: str = "doc_id",
          per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """Count on about ``per_language`` documents of each language, chosen by a hash of their key."""
    known = docs.where(F.col(text).isNotNull() & F.col(language).isNotNull())
    sizes = {row[0]: row[1] for row in known.groupBy(language).count().collect()}    # a row per language
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((1 << FEATURE_BITS, 0), np.float32), np.zeros((len(_NAMES) + 1, 0), bool))
    share = F.coalesce(*[F.when(F.col(language) == name, F.lit(min(1.0, per_language / size)))
                         for name, size in sizes.items()])
    place = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(9)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = known.where(place < share).select(F.col(language).alias("lang"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in spans.pieces(batches, "text", PIECE_BYTES):
            data, offsets = spans.buffers(batch.column("text"))
            padded, begins, number, first = _distinct_words(data, offsets)
            own = pd.Index(languages).get_indexer(batch.column("lang").to_pandas())[spans.owners(first)]
            times = np.bincount(own * len(begins) + number, minlength=len(languages) * len(begins))
            features, owner = _features(padded, begins)
            letters, script = _letters(padded)
            word = np.searchsorted(begins, letters, side="right") - 1
            for i in range(len(languages)):
                of = times[i * len(begins):(i + 1) * len(begins)]
                counts = np.bincount(features, weights=of[owner], minlength=1 << FEATURE_BITS)
                counts = np.append(counts, np.bincount(script, weights=of[word], minlength=len(_NAMES)))
                there = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(there), i, np.int32)), pa.array(there.astype(np.int32)),
                     pa.array(counts[there].astype(np.int64))], names=["lang", "feature", "n"])

    # at most languages x features rows
    found = (sample.mapInArrow(run, "lang int, feature int, n long").groupBy("lang", "feature")
             .agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros(((1 << FEATURE_BITS) + len(_NAMES), len(languages)))
    counts[found["feature"], found["lang"]] = found["n"]
    grams, letters = counts[:1 << FEATURE_BITS], counts[1 << FEATURE_BITS:]
    table = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * (1 << FEATURE_BITS)))
    uses = letters >= SCRIPT_SHARE * np.maximum(letters.sum(axis=0), 1)
    uses[~uses.any(axis=1)] = True               # a script that nobody uses tells nothing
    return Model(languages, table.astype(np.float32), np.vstack([uses, np.ones(len(languages), bool)]))


# -- labelling -----------------------------------------------------------------------------------------------------

def _word_scores(model: Model, padded: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Score of each distinct word in each language; overlapping n-grams count as one reading of the word."""
    features, owner = _features(padded, begins)
    scores = np.zeros((len(begins), len(model.languages)), np.float32)
    rows, cuts = np.unique(owner, return_index=True)
    if len(rows):
        scores[rows] = np.add.reduceat(model.table[features], cuts, axis=0) / len(GRAMS)
    scores -= scores.max(axis=1, keepdims=True)
    letters, script = _letters(padded)
    allowed = np.ones(scores.shape, bool)
    word = np.searchsorted(begins, letters, side="right") - 1
    for s in np.unique(script):
        allowed[word[script == s]] &= model.uses[s]
    allowed[~allowed.any(axis=1)] = True         # a word of several scripts that no language uses together
    return np.where(allowed, scores, np.float32(-1e4))


def _path(scores: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Language of each word on the best path of its text."""
    n_words, n_langs = scores.shape
    lengths = np.diff(first)
    runs = -(-lengths // RUN)
    run_text = np.repeat(np.arange(len(lengths)), runs)
    run_number = np.arange(len(run_text)) - np.repeat(np.cumsum(runs) - runs, runs)
    run_start = first[run_text] + run_number * RUN
    run_length = np.minimum(RUN, first[run_text + 1] - run_start)
    at = np.minimum(run_start[:, None] + np.arange(RUN), n_words - 1)
    held = np.where((np.arange(RUN) < run_length[:, None])[:, :, None], scores[at], np.float32(0))
    # best value at the end of each run, by the language before it and the language at its end
    best = np.where(np.eye(n_langs, dtype=bool), np.float32(0), np.float32(-SWITCH))[None].repeat(len(run_text), axis=0)
    best += held[:, 0, None, :]
    for t in range(1, RUN):
        np.maximum(best, best.max(axis=2, keepdims=True) - np.float32(SWITCH), out=best)
        best += held[:, t, None, :]
    # through the runs of a text: value by language at the end of each run, and the language before it
    value = np.zeros((len(lengths), n_langs), np.float32)
    came = np.zeros((len(run_text), n_langs), np.int16)
    for k in range(int(runs.max(initial=0))):
        now = np.flatnonzero(run_number == k)
        through = value[run_text[now]][:, :, None] + best[now]
        came[now] = through.argmax(axis=1)
        value[run_text[now]] = through.max(axis=1)
    state = value.argmax(axis=1)
    before, after = np.zeros(len(run_text), np.int64), np.zeros(len(run_text), np.int64)
    for k in range(int(runs.max(initial=0)) - 1, -1, -1):
        now = np.flatnonzero(run_number == k)
        after[now] = state[run_text[now]]
        before[now] = came[now, after[now]]
        state[run_text[now]] = before[now]
    # inside all runs, from the language before to the one at the end
    row = np.arange(len(run_text))
    value = np.full((len(run_text), n_langs), -SWITCH, np.float32)
    value[row, before] = 0
    value += held[:, 0]
    back = np.zeros((RUN, len(run_text), n_langs), np.int16)
    for t in range(1, RUN):
        top = value.argmax(axis=1)
        switched = value[row, top][:, None] - np.float32(SWITCH)
        back[t] = np.where(value >= switched, np.arange(n_langs), top[:, None])
        value = np.maximum(value, switched) + held[:, t]
    labels = np.zeros((len(run_text), RUN), np.int16)
    state = after
    for t in range(RUN - 1, -1, -1):
        labels[:, t] = state
        state = back[t][row, state] if t else state
    return labels[np.arange(RUN) < run_length[:, None]].astype(np.int64)


def _label(model: Model, texts: pa.Array) -> list[pa.Array]:
    data, offsets = spans.buffers(texts)
    n, n_langs = len(texts), len(model.languages)
    ascii_letters = np.concatenate([[0], np.cumsum(((data | 0x20) - np.uint8(97)) < 26)])
    lettered = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
    for i in np.flatnonzero(~lettered & (np.diff(offsets) > 0)):
        lettered[i] = any(c.isalpha() for c in data[offsets[i]:offsets[i + 1]].tobytes().decode())
    padded, begins, number, first = _distinct_words(data, offsets)
    owner = spans.owners(first)
    if n_langs and len(owner):
        labels = _path(_word_scores(model, padded, begins)[number], first)
    else:
        labels, lettered = np.zeros(len(owner), np.int64), lettered & (n_langs > 0)
    counts = np.bincount(owner * max(n_langs, 1) + labels, minlength=n * max(n_langs, 1)).reshape(n, -1)
    top = counts.argmax(axis=1)
    score = np.where(lettered, counts.max(axis=1, initial=0) / np.maximum(np.diff(first), 1), 0.0)
    names = np.array([*model.languages, UNKNOWN], object)
    begins_span = np.ones(len(labels), bool)
    begins_span[1:] = (labels[1:] != labels[:-1]) | (owner[1:] != owner[:-1])
    span = np.flatnonzero(begins_span & lettered[owner]) if len(owner) else np.zeros(0, np.int64)
    ends = np.append(np.flatnonzero(begins_span)[1:], len(labels))[np.searchsorted(np.flatnonzero(begins_span), span)]
    struct = pa.StructArray.from_arrays(
        [pa.array((span - first[owner[span]]).astype(np.int32)), pa.array((ends - first[owner[span]]).astype(np.int32)),
         pa.array(names[labels[span]], pa.string())], names=["first_word", "end_word", "lang"])
    borders = np.concatenate([[0], np.cumsum(np.bincount(owner[span], minlength=n))])
    return [pa.array(names[np.where(lettered, top, n_langs)], pa.string()), pa.array(score),
            pa.ListArray.from_arrays(pa.array(borders, pa.int32()), struct)]


def label(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``lang_spans`` (runs of words of one language).

    Only the text is looked at. Columns of these names are replaced.
    """
    added = {"lang_pred": "string", "score": "double",
             "lang_spans": "array<struct<first_word:int,end_word:int,lang:string>>"}
    kept = [f.name for f in docs.schema.fields if f.name not in added]
    schema = docs.select(*[f"`{c}`" for c in kept]).withColumns(
        {name: F.lit(None).cast(kind) for name, kind in added.items()}).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)     # 2^16 features x languages, 4 bytes each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in spans.pieces(batches, text, PIECE_BYTES):
            columns = [batch.column(name) for name in kept] + _label(shared.value, batch.column(text))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(*[f"`{c}`" for c in kept]).mapInArrow(run, schema)


def held_out(key: str = "doc_id", parts: int = 5) -> Column:
    """Whether a row is kept from training: a null key is not, nor is it learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % parts == 0, F.lit(False))


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang") -> DataFrame:
    """Train on the rows that aren't held out and label all rows."""
    learned = train(docs.where(F.col(key).isNotNull() & ~held_out(key)), text, language, key)
    return label(docs.withColumn("held_out", held_out(key)), learned, text)
