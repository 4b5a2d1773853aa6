"""Near-duplicate join by a MinHash LSH forest: sorted prefix tries of signatures, then exact verification.

Texts are sets of ``SHINGLE`` consecutive words (a text of fewer words is one shingle). ``TREES`` tries hold signatures of
``DEPTH`` min-hashes each. Two texts of similarity s share a prefix of length d in some trie with probability
``1 - (1 - s^d)^TREES``. The join starts at full depth and shortens the matched prefix step by step: each step brings the
pairs whose longest common prefix over all tries is just that long, so no pair comes twice. Pairs whose signatures agree
enough are verified exactly on their shingle sets. The prefix is shortened until a pair of the least similarity that counts
is found with the chance ``TARGET``, whatever the similarities of other pairs are (see :func:`recall`).

Texts with equal shingle sets form one class, and only its member of the smallest id enters the tries. Tries' buckets are
cut into blocks of ``BLOCK`` members, and pairs of blocks are worked on by different tasks.

A text without words (null, empty) has no shingles and no links; rows with a null id have no links. Rows of one id are
one document; if their texts differ, that of the smallest hash stands for it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import spans
from tidemark.llm.components import components
from tidemark.session import file_count, materialize

SHINGLE, SIMILARITY = 5, 0.8
TREES, DEPTH = 24, 8
TARGET = 0.9999
BLOCK = 512
SLACK = 6.0          # standard deviations that an estimate may fall short by before the pair is given up
PAIRS_AT_ONCE = 1 << 16
ROW_BYTES = TREES * DEPTH + 64    # of a signature with its numbers, at most
_FACTORS = (np.random.default_rng(1).integers(0, 1 << 62, TREES * DEPTH, np.uint64) << np.uint64(1)) + np.uint64(1)

Batches = Iterator[pa.RecordBatch]


#: The least share of equal min-hashes (without those equal by chance in a byte) of pairs to verify.
LEAST_SHARE = SIMILARITY - SLACK * math.sqrt(SIMILARITY * (1 - SIMILARITY) / (TREES * DEPTH))


def given_up() -> float:
    """Chance that the signatures of two texts of similarity ``SIMILARITY`` agree in too few places."""
    n, equal = TREES * DEPTH, SIMILARITY + (1 - SIMILARITY) / 256
    least = math.ceil((LEAST_SHARE * (1 - 1 / 256) + 1 / 256) * n)
    return sum(math.comb(n, k) * equal ** k * (1 - equal) ** (n - k) for k in range(least))


def recall(depth: int) -> float:
    """Least chance that a pair of similarity ``SIMILARITY`` shares a prefix of ``depth`` or more in some trie and is
    verified."""
    return 1 - (1 - SIMILARITY ** depth) ** TREES - given_up()


#: The last depth that prefixes are shortened to.
SHORTEST = next((d for d in range(DEPTH, 1, -1) if recall(d) >= TARGET), 1)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of each text in turn, and the number of the first one of each text."""
    starts, ends, first = spans.words(data, offsets)
    hashes, owner = spans.hash_spans(data, starts, ends), spans.owners(first)
    n_words = np.diff(first)
    whole = spans.windows(hashes, SHINGLE)
    at = np.flatnonzero(owner[:len(whole)] == owner[SHINGLE - 1:SHINGLE - 1 + len(whole)])
    short = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
    alone = np.array([spans.windows(hashes[first[i]:first[i + 1]], n_words[i])[0] for i in short], np.uint64)
    texts = np.concatenate([owner[at], short])
    order = np.argsort(texts, kind="stable")
    return np.concatenate([whole[at], alone])[order], np.searchsorted(texts[order], np.arange(len(offsets)))


def signatures(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """Per document with words: ``doc``, ``tag`` (its text's hash), its set's fingerprint (``one``, ``two``), ``size``,
    ``signature`` (a byte per min-hash) and the text's ``n_bytes``."""
    def run(batches: Batches) -> Batches:
        for batch in spans.pieces(batches, "text", 1 << 20):
            data, offsets = spans.buffers(batch.column("text"))
            hashes, first = shingles(data, offsets)
            some = np.flatnonzero(np.diff(first))
            least = np.zeros((len(some), TREES * DEPTH), np.uint8)
            if len(some):
                for k, factor in enumerate(_FACTORS):
                    lowest = np.minimum.reduceat(hashes * factor, first[some])
                    least[:, k] = (spans.mix(lowest) & np.uint64(0xFF)).astype(np.uint8)
            sets = [np.unique(hashes[first[i]:first[i + 1]]) for i in some]
            one = np.array([s.sum() for s in sets], np.uint64)
            two = np.array([(s * _FACTORS[0] ^ s >> np.uint64(29)).sum() for s in sets], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(pa.array(some)), batch.column("tag").take(pa.array(some)), pa.array(spans.signed(spans.mix(one))),
                 pa.array(spans.signed(spans.mix(two))), pa.array(np.array([len(s) for s in sets], np.int32)),
                 pa.array([x.tobytes() for x in least], pa.binary()), pa.array(np.diff(offsets)[some].astype(np.int64))],
                names=["doc", "tag", "one", "two", "size", "signature", "n_bytes"])

    found = _texts(docs, id_column, text).mapInArrow(
        run, "doc long, tag long, one long, two long, size int, signature binary, n_bytes long")
    rest = [c for c in found.columns if c != "doc"]
    return found.groupBy("doc").agg(F.min(F.struct(*rest)).alias("least")).select("doc", "least.*")


def _texts(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc"), F.xxhash64(text).alias("tag"),
                       F.col(text).alias("text")).where("doc IS NOT NULL")


def whole_groups(batches: Batches, key: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by ``key`` as tables of whole groups, with the border of each group (one more than groups)."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        borders = _borders(table, key)
        if len(borders) > 2:
            yield table.slice(0, borders[-2]), borders[:-1]
        rest = table.slice(borders[-2]) if len(borders) > 1 else None
    if rest is not None and rest.num_rows:
        yield rest, _borders(rest, key)


def _borders(table: pa.Table, key: list[str]) -> np.ndarray:
    change = np.zeros(max(table.num_rows - 1, 0), bool)
    for name in key:
        values = table.column(name).to_numpy()
        change |= values[1:] != values[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [table.num_rows]]) if table.num_rows else np.zeros(1, int)


def _near_pairs(table: pa.Table, borders: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of pairs of a bucket whose signatures agree enough, each in one bucket only: they have no longer
    common prefix in any trie, and this trie is the first that has this one."""
    doc, own = table.column("doc").to_numpy(), table.column("block").to_numpy()
    cross = (table.column("low").to_numpy() != table.column("high").to_numpy())
    tree, size = table.column("tree").to_numpy(), table.column("size").to_numpy()
    held = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(len(doc), TREES, DEPTH)
    row = np.arange(len(doc))
    counts = np.repeat(borders[1:], np.diff(borders)) - row - 1
    begin = 0
    while begin < len(row):
        end = begin + max(1, int(np.searchsorted(np.cumsum(counts[begin:]), PAIRS_AT_ONCE, side="right")))
        left = np.repeat(row[begin:end], counts[begin:end])
        right = spans.ragged(row[begin:end] + 1, counts[begin:end])
        begin = end
        apart = (~cross[left] | (own[left] != own[right])) & (doc[left] != doc[right])
        apart &= np.minimum(size[left], size[right]) >= SIMILARITY * np.maximum(size[left], size[right])
        left, right = left[apart], right[apart]
        same = held[left] == held[right]
        new = same[:, :, :depth].all(axis=2).argmax(axis=1) == tree[left]
        if depth < DEPTH:
            new &= ~same[:, :, :depth + 1].all(axis=2).any(axis=1)
        share = (same.mean(axis=(1, 2)) - 1 / 256) / (1 - 1 / 256)
        near = new & (share >= LEAST_SHARE)
        yield left[near], right[near]


_GROUP = ["bucket", "low", "high"]
_MEMBER = "bucket long, low int, high int, block int, tree int, doc long, size int, signature binary"


def _members_of_pairs(depth: int):
    """The members of buckets that are in at least one pair to verify."""
    def run(batches: Batches) -> Batches:
        for table, borders in whole_groups(batches, _GROUP):
            wanted = np.zeros(table.num_rows, bool)
            for left, right in _near_pairs(table, borders, depth):
                wanted[left] = wanted[right] = True
            yield from table.filter(pa.array(wanted)).combine_chunks().to_batches()
    return run


def _links(depth: int):
    """Per group and member with links: their number, and the smallest member reached over links of the group.

    Links are counted where they are verified, so a group of very many links gives a row a member.
    """
    def run(batches: Batches) -> Batches:
        for table, borders in whole_groups(_with_sets(batches), _GROUP):
            doc, sets = table.column("doc").to_numpy(), table.column("set").combine_chunks()
            size = table.column("size").to_numpy()
            linked = _Links()
            for left, right in _near_pairs(table, borders, depth):
                for i, j in zip(left.tolist(), right.tolist()):
                    one, two = (np.frombuffer(sets[k].as_buffer(), np.uint64) for k in (i, j))
                    both = len(np.intersect1d(one, two, assume_unique=True))
                    similarity = both / (size[i] + size[j] - both)
                    if similarity >= SIMILARITY:
                        linked.add(int(doc[i]), int(doc[j]))
            yield linked.rows()
    return run


_LINKED = "doc long, n_links long, root long"


class _Links:
    def __init__(self):
        self.count: Counter[int] = Counter()
        self.root: dict[int, int] = {}

    def find(self, doc: int) -> int:
        while (up := self.root.setdefault(doc, doc)) != doc:
            self.root[doc] = doc = self.root[up]
        return doc

    def add(self, a: int, b: int) -> None:
        self.count.update((a, b))
        low, high = sorted((self.find(a), self.find(b)))
        self.root[high] = low

    def rows(self) -> pa.RecordBatch:
        docs = list(self.count)
        columns = (docs, list(self.count.values()), [self.find(d) for d in docs])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc", "n_links", "root"])


def _with_sets(batches: Batches) -> Batches:
    """The sorted shingle set in place of the text."""
    for batch in spans.pieces(batches, "text"):
        hashes, first = shingles(*spans.buffers(batch.column("text")))
        sets = pa.array([np.unique(hashes[x:y]).tobytes() for x, y in zip(first[:-1], first[1:])], pa.large_binary())
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), sets], names=[*names, "set"])


def _buckets(members: DataFrame, depth: int) -> DataFrame:
    """``doc``, ``tree`` and ``bucket`` (hash of the tree and the prefix), and the size ``n`` of shared buckets."""
    prefix = [F.xxhash64(F.lit(t), F.substring("signature", t * DEPTH + 1, depth)) for t in range(TREES)]
    rows = members.select("doc", F.posexplode(F.array(*prefix)).alias("tree", "bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows.join(shared, "bucket")


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "doc")


def links(docs: DataFrame, members: DataFrame, id_column: str, text: str) -> DataFrame:
    """Verified links of the members, summed up per member and smallest member reached in a group (see :func:`_links`); each
    link is in one group."""
    # only members that share a shortest prefix can be in a pair at all
    near = _buckets(members, SHORTEST).select("doc").distinct()
    files = file_count(members.sparkSession, ROW_BYTES * members.count())
    signed = materialize(members.join(near, "doc"), "near-members", files)
    n_bytes = signed.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    # a merge join whatever the size, so that the plan is the same for small and large tables
    texts = materialize(_texts(docs, id_column, text).join(signed.select("doc", "tag").hint("merge"), ["doc", "tag"])
                        .dropDuplicates(["doc"]).select("doc", "text"), "near-texts",
                        file_count(members.sparkSession, n_bytes))
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    found: DataFrame | None = None
    for depth in range(DEPTH, SHORTEST - 1, -1):
        block = F.pmod(F.xxhash64("doc", "bucket"), blocks).cast("int")
        spread = (_buckets(signed, depth).select("doc", "tree", "bucket", block.alias("block"), blocks.alias("blocks"))
                  .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                  .select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                          "block", "tree", "doc"))
        rows = spread.join(signed.select("doc", "size", "signature"), "doc").select(
            "bucket", "low", "high", "block", "tree", "doc", "size", "signature")
        paired = _grouped(rows).mapInArrow(_members_of_pairs(depth), _MEMBER)
        verified = _grouped(paired.join(texts, "doc").select(*paired.columns, "text")).mapInArrow(_links(depth), _LINKED)
        new = materialize(verified.groupBy("doc", "root").agg(F.sum("n_links").alias("n_links")), "links", files)
        found = new if found is None else found.unionByName(new)
    return found


def join(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``class_id``, ``copy_id`` and ``n_links``.

    ``copy_id`` is the smallest id with an equal shingle set; ``n_links`` counts the other such sets of similarity 0.8 or
    more; ``class_id`` is the smallest id reached over such links. Without words all are the own id and 0.
    """
    files = file_count(docs.sparkSession, ROW_BYTES * docs.count())
    signed = materialize(signatures(docs, id_column, text), "signatures", files)
    # written down, so that the join has a shuffle of its own, in which Spark splits a class of very many copies
    classes = materialize(signed.groupBy("one", "two").agg(
        F.min(F.struct("doc", "tag", "size", "signature", "n_bytes")).alias("least")).select("one", "two", "least.*"),
        "classes", files)
    copies = signed.select("doc", "one", "two").join(
        classes.select("one", "two", F.col("doc").alias("copy")), ["one", "two"])
    members = classes.drop("one", "two")
    linked = links(docs, members, id_column, text)
    degrees = linked.groupBy("doc").agg(F.sum("n_links").alias("n_links")).withColumnRenamed("doc", "copy")
    roots = components(linked.select("doc", "root")).select(F.col("node").alias("copy"), "root")
    own = (copies.select("doc", "copy")
           .join(degrees, "copy", "left").join(roots, "copy", "left").withColumnRenamed("doc", "member"))
    base = docs.select(F.col(id_column).cast("long").alias("doc"))
    return base.join(own, base["doc"] == own["member"], "left").select(
        F.col("doc").alias(id_column), F.coalesce("root", "copy", "doc").alias("class_id"),
        F.coalesce("copy", "doc").alias("copy_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
