"""Benchmark passages in documents, by a prefix-filtered join of item windows.

A window is ``WINDOW`` consecutive words of an item; an item of fewer words, but not none, is one window. A document holds
a window only if it holds every word of it, so the necessary prefix of a window, in the order of rarity over all documents,
is its rarest word. Steps, all of them DataFrame expressions:

1. the texts are cut into words, once, and written down; occurrences in the documents of each word of the benchmark;
2. each window is listed under its rarest word, with the word's place in it; windows with a word that no document has go;
3. places of listed words in the documents, with the words around them. A fixed-size bitmap of the listed words is looked
   up first, so only few places become rows;
4. join on the word; the window has to begin and end inside the document (position and length bounds);
5. exact comparison of the words.

Words are runs of ASCII digits, letters (A-Z lower-cased) and characters beyond ASCII. A null text has no words. Rows are
told apart by a hash of id and text, nulls included, so repeated rows and null ids keep their rows. Items of one id count
once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import fits_broadcast
from tidemark.session import materialize

WINDOW = 10
BITMAP_BITS = 20          # 2^20 bits: 128 KiB, whatever the benchmark's size; a full one only filters less

# What is no word character once A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z only; ``lower`` does just that to a text of ASCII characters, and faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def row_key(id_column: str, text: str) -> Column:
    """Nulls are hashed as such, as a plain hash leaves them out."""
    return F.xxhash64(F.col(id_column).isNull(), F.col(text).isNull(), F.col(id_column).cast("string"), F.col(text))


def item_windows(items: DataFrame, id_column: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``item`` (id as text), ``window`` (its words joined by a space) and ``len``, once each."""
    words = items.select(F.col(id_column).cast("string").alias("item"), words_of(F.col(text)).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    return (words.where("size(words) > 0 AND item IS NOT NULL")
            .select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, window))).alias("words"))
            .select("item", F.array_join("words", " ").alias("window"), F.size("words").alias("len")).distinct())


def _bitmap(words: DataFrame, bits: int = BITMAP_BITS):
    """A test for words: false only for words that aren't listed."""
    place = F.pmod(F.xxhash64("word"), F.lit(1 << bits))
    rows = (words.select((place / 64).cast("int").alias("at"), F.pmod(place, F.lit(64)).cast("int").alias("bit"))
            .groupBy("at").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).collect())   # 2^bits / 64 at most
    longs = [0] * ((1 << bits) // 64)
    for row in rows:
        longs[row["at"]] = row["bits"]
    held = F.lit(longs).cast("array<long>")

    def test(word: Column) -> Column:
        hashed = F.pmod(F.xxhash64(word), F.lit(1 << bits))
        bits_there = F.get(held, F.floor(hashed / 64).cast("int"))
        return F.getbit(bits_there, F.pmod(hashed, F.lit(64)).cast("int")) == 1
    return test


def _sized(small: DataFrame) -> DataFrame:
    return F.broadcast(small) if fits_broadcast(small) else small


def find(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", item_id: str = "item_id",
         item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row with words: ``row``, ``n_words``, ``hits`` (start and length of windows) and ``items`` (ids as text)."""
    listed = materialize(item_windows(items, item_id, item_text, window), "item-windows")
    windows = listed.select("window", "len").distinct()
    tokens = windows.select("window", "len", F.posexplode(F.split("window", " ")).alias("offset", "word"))
    texts = materialize(docs.select(row_key(id_column, text).alias("row"), words_of(F.col(text)).alias("words")), "doc-words")

    in_benchmark = _bitmap(tokens.select("word").distinct())
    counts = (texts.select(F.explode("words").alias("word")).where(in_benchmark(F.col("word")))
              .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    counted = materialize(tokens.join(counts, "word", "left"), "item-words")
    rarest = counted.groupBy("window", "len").agg(
        F.min(F.struct("n", "word", "offset")).alias("r"), F.count("n").alias("found"))
    prefixes = materialize(rarest.where("found = len").select("window", "len", "r.word", "r.offset"), "prefixes")

    listed_word = _bitmap(prefixes.select("word").distinct())
    around = F.array_compact(F.transform("words", lambda w, i: F.when(listed_word(w), F.struct(
        w.alias("word"), i.alias("place"),
        F.slice("words", F.greatest(i - (window - 1), F.lit(0)) + 1, 2 * window - 1).alias("near")))))
    places = texts.select("row", F.size("words").alias("n_words"), around.alias("places")).where("n_words > 0").select(
        "row", "n_words", F.explode_outer("places").alias("p")).select("row", "n_words", "p.*")
    places = materialize(places, "prefix-places")

    start = F.col("place") - F.col("offset")
    joined = places.join(_sized(prefixes), "word").where((start >= 0) & (start + F.col("len") <= F.col("n_words")))
    before = F.least(F.col("place"), F.lit(window - 1))
    exact = F.array_join(F.slice("near", before - F.col("offset") + 1, F.col("len")), " ") == F.col("window")
    hits = materialize(joined.where(exact).select("row", "window", start.alias("start"), "len").distinct(), "hits")
    spans = hits.groupBy("row").agg(F.collect_list(F.struct("start", "len")).alias("hits"))
    named = (hits.select("row", "window").distinct().join(_sized(listed.select("window", "item")), "window")
             .groupBy("row").agg(F.collect_set("item").alias("items")))
    return (places.select("row", "n_words").distinct().join(spans, "row", "left").join(named, "row", "left"))


def contamination(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``n_words``, ``n_hit`` (words inside a window), ``items`` (sorted ids as text)."""
    found = find(docs, items, id_column, text)
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        "hits", lambda h: F.sequence(h["start"], h["start"] + h["len"] - 1)))))
    none = F.array().cast("array<string>")
    measured = found.select("row", F.col("n_words").cast("long").alias("n_words"),
                            F.when(F.col("hits").isNull(), 0).otherwise(covered).cast("long").alias("n_hit"),
                            F.array_sort(F.coalesce("items", none)).alias("items"))
    rows = docs.select(F.col(id_column), row_key(id_column, text).alias("row"))
    zero = F.lit(0).cast("long")
    return rows.join(measured, "row", "left").select(
        id_column, F.coalesce("n_words", zero).alias("n_words"), F.coalesce("n_hit", zero).alias("n_hit"),
        F.coalesce("items", none).alias("items"))
