"""Byte-level BPE and Simple-8b files: exact against the libraries, and exact round trips."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import bpe, queries, simple8b, spans
from tidemark.session import work_path

RANKS = queries.vocabulary("byte_bpe_50k.tiktoken")
JSON = queries.vocabulary("byte_bpe_50k.json")
ODD = [None, "", " ", "\n", "a  b", "x \n y", "don't we'll", "日本語 text", "é   z", "🙂🇩🇪", "\x00\x1c\x85", "a" * 5000,
       "word " * 4000, "1234567 89", "<|endoftext|>", "ÀÉ ßüö", "tab\tand\r\nline"]


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers as P
    import tiktoken
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(codec, texts):
    data, offsets = spans.buffers(pa.array(texts, pa.string()))
    ids, before = codec.encode(data, offsets)
    decoded, ends = codec.decode(ids, before)
    assert np.array_equal(decoded, data) and np.array_equal(ends, offsets)
    return [ids[a:b].tolist() for a, b in zip(before[:-1], before[1:])]


def test_ranks_encode_as_the_rank_library(reference):
    assert encoded(bpe.codec(RANKS), ODD) == [reference.encode_ordinary(t or "") for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(list(" \n\t 　 ab'sßé日🙂.,1!́\x85\x1c")), max_size=40), min_size=1, max_size=6))
def test_any_text_encodes_as_the_rank_library(reference, texts):
    assert encoded(bpe.codec(RANKS), texts) == [reference.encode_ordinary(t) for t in texts]


def test_json_file_encodes_as_the_tokenizers_library():
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(JSON)
    plain.encode_special_tokens = True
    assert encoded(bpe.codec(JSON), ODD) == [plain.encode(t or "", add_special_tokens=False).ids for t in ODD]


def test_units_of_one_hash_are_still_right(monkeypatch, reference):
    codec = bpe.Codec(RANKS)
    monkeypatch.setattr(spans, "hash_spans", lambda data, starts, ends, seed=0: np.zeros(len(starts), np.uint64))
    assert encoded(codec, ["one two three", "four"]) == [reference.encode_ordinary(t) for t in ("one two three", "four")]


def test_kept_units_are_forgotten_in_time(monkeypatch, reference):
    monkeypatch.setattr(bpe, "UNITS_KEPT", 3)
    codec = bpe.Codec(RANKS)
    for text in ("one two three four five", "six seven eight nine", "one six"):
        assert encoded(codec, [text]) == [reference.encode_ordinary(text)]


def test_places_of_split_characters():
    codec = bpe.codec(RANKS)
    data, offsets = spans.buffers(pa.array(["né 🙂x", ""]))
    ids, before = codec.encode(data, offsets)
    byte, char = codec.places(data, offsets, ids, before)
    spelled = [codec.token_bytes[codec.token_starts[i]:][:codec.token_lengths[i]].tobytes() for i in ids]
    assert "".join(bpe.characters(spelled)) == "né 🙂x"
    text = "né 🙂x".encode()
    assert byte.tolist() == [len(b"".join(spelled[:i])) for i in range(len(spelled))]
    for b, c in zip(byte, char):
        assert len(text[:b].decode(errors="ignore")) == c


def test_encode_keeps_columns_and_rows(spark):
    docs = spark.createDataFrame([(1, "a b", 5), (1, "a b", 6), (None, None, 7)], "doc_id long, text string, ids int")
    out = bpe.encode(docs, RANKS)
    assert out.columns == ["doc_id", "ids", "byte_starts", "char_starts"]
    assert sorted((r.doc_id or 0, len(r.ids)) for r in out.collect()) == [(0, 0), (1, 2), (1, 2)]
    back = bpe.decode(out, RANKS).collect()
    assert sorted(bytes(r.decoded) for r in back) == [b"", b"a b", b"a b"]
    assert bpe.encode(docs.limit(0), RANKS).count() == 0


def test_query_of_op8(spark, reference, documents):
    rows = list(enumerate(ODD))
    found = {r.doc_id: r for r in bpe.round_trip(documents(rows), RANKS).collect()}
    for doc, text in rows:
        ids = reference.encode_ordinary(text or "")
        assert found[doc].n_tokens == len(ids)
        assert found[doc].ids_sha256 == brute.sha(" ".join(map(str, ids)))
        assert found[doc].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


# -- Simple-8b -----------------------------------------------------------------------------------------------------

@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 64).flatmap(lambda b: st.integers(0, (1 << b) - 1 if b else 0)), max_size=300), st.integers(1, 9))
def test_simple8b_round_trip(values, times):
    ids = np.array(values * times, np.uint64)
    words, first, escapes = simple8b.pack(ids)
    assert np.array_equal(simple8b.unpack(words, first.astype(np.int64), escapes, len(ids)), ids)


def test_simple8b_packs_tightly():
    for width, count in zip(simple8b.WIDTHS, simple8b.COUNTS):
        ids = np.full(simple8b.BLOCK, (1 << int(width)) - 1, np.uint64)
        assert len(simple8b.pack(ids)[0]) == -(-simple8b.BLOCK // int(count))


def token_table(spark, docs):
    folder = work_path(spark, "token-test")
    simple8b.write(docs, folder, JSON, end_id=0, partitions=3)
    found = simple8b.starts(simple8b.digests(spark, folder))
    ids = simple8b.read(spark, folder)
    return sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in found.collect()), ids


def test_files_in_order(spark, documents, monkeypatch):
    monkeypatch.setattr(simple8b, "FRAME_IDS", 50)
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(JSON)
    plain.encode_special_tokens = True
    rows = [(i * 7 % 40, t) for i, t in enumerate(ODD * 2)] + [(None, "no id"), (3, "same"), (3, "same"), (-5, "below")]
    found, ids = token_table(spark, documents(rows))
    expected = brute.token_rows(rows, lambda t: plain.encode(t, add_special_tokens=False).ids)
    assert found == sorted((start, doc, n, crc) for doc, start, n, crc in expected)
    assert ids.select(F.sum(F.size("ids"))).first()[0] == sum(n for _, _, n, _ in expected)


def test_files_of_nothing(spark, documents):
    folder = work_path(spark, "token-test")
    simple8b.write(documents([]), folder, JSON, end_id=0, partitions=3)
    assert simple8b.starts(simple8b.digests(spark, folder)).count() == 0
