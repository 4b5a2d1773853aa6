"""Repeated line runs: suffixes of line-ID sequences named by prefix doubling, later copies deleted.

A document is the sequence of its lines that hold a word. Each line is known by a 128-bit ID, and the run of 2^k lines that
begins at a line by a name made from the names of its two halves (prefix doubling); a run of any other length is named
by two runs of the largest power of two in it, which overlap. Suffixes that share the name of a length are an interval of common
prefix of at least that length. In each interval the first suffix, by document id and place, stays; the lines that
the others share with it are deleted, unless they overlap it.

A repeated run counts if it holds at least ``MIN_LINES`` lines or at least ``MIN_WORDS`` words. Every maximal run that
counts is the union of its windows of ``MIN_LINES`` lines, or is a shorter one of ``MIN_WORDS`` words, so intervals of these
lengths find all of them, whatever their full length. The first copy of every line stays.

Everything is DataFrame expressions; intervals are combined in the tasks, so a line of most documents is one row a task.
Rows of one id and text count as one document. Null texts stay null. Documents with a null id come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

MIN_LINES = 3
MIN_WORDS = 50
WORD = r"[^\x20\x09-\x0D]+"


def _row(id_column: str, text: str) -> Column:
    return F.xxhash64(F.col(id_column).isNull(), F.col(text).isNull(), F.col(id_column).cast("string"), F.col(text))


def _lines(text: Column) -> Column:
    """Place and text of the lines that hold a word."""
    numbered = F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda line, i: F.struct(
        i.alias("at"), line.alias("line")))
    return F.filter(numbered, lambda x: x["line"].rlike(WORD))


def _pair(left: Column, right: Column, length: int) -> Column:
    """Name of a run from the names of two runs in it."""
    return F.struct(F.xxhash64(F.lit(length), left["a"], right["a"]).alias("a"),
                    F.xxhash64(F.lit(-length), left["b"], right["b"]).alias("b"))


def _doubled(names: str, half: int) -> Column:
    """Names of runs of twice ``half`` lines."""
    return F.transform(F.slice(names, 1, F.greatest(F.size(names) - half, F.lit(0))),
                       lambda x, i: _pair(x, F.get(names, i + half), 2 * half))


def _runs_of(names: str, named: int, length: int) -> Column:
    """Runs of ``length`` lines from the names of runs of ``named`` lines, ``named`` <= ``length`` <= 2 * ``named``."""
    def run(x: Column, i: Column) -> Column:
        name = _pair(x, F.get(names, i + (length - named)), length) if length > named else x
        words = F.get("n0", i)["words"]
        for j in range(1, length):
            words = words + F.get("n0", i + j)["words"]
        return F.struct(i.alias("place"), F.lit(length).alias("len"), name["a"].alias("a"), name["b"].alias("b"),
                        words.alias("words"))
    return F.transform(F.slice(names, 1, F.greatest(F.size("n0") - (length - 1), F.lit(0))), run)


def run_names(docs: DataFrame, id_column: str, text: str, min_lines: int = MIN_LINES,
              min_words: int = MIN_WORDS) -> DataFrame:
    """The runs that count if they are repeated: ``doc``, ``row``, ``place`` (of the first line), ``len``, ``a``, ``b``."""
    level = docs.select(F.col(id_column).cast("long").alias("doc"), _row(id_column, text).alias("row"), F.transform(
        _lines(F.col(text)), lambda x: F.struct(
            F.xxhash64(x["line"]).alias("a"), F.xxhash64(F.lit(1), x["line"]).alias("b"),
            F.regexp_count(x["line"], F.lit(WORD)).alias("words"))).alias("n0"))
    k, windows = 0, []
    for length in range(1, min_lines + 1):
        if length >= 2 << k:
            level = level.withColumn(f"n{k + 1}", _doubled(f"n{k}", 1 << k))
            k += 1
        found = _runs_of(f"n{k}", 1 << k, length)
        if length < min_lines:
            found = F.filter(found, lambda x: x["words"] >= min_words)
        windows.append(found)
    # the outer form, as a plain one would have the array made twice (once to see whether it is empty)
    return level.select("doc", "row", F.explode_outer(F.concat(*windows)).alias("w")).where("w IS NOT NULL").select(
        "doc", "row", "w.place", "w.len", "w.a", "w.b")


def repeated_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES,
                   min_words: int = MIN_WORDS) -> DataFrame:
    """``row`` and ``places``: the numbers of the lines (among those with a word) that repeat an earlier run."""
    names = materialize(run_names(docs, id_column, text, min_lines, min_words), "line-runs")
    place = F.struct("doc", "row", "place")
    intervals = names.groupBy("len", "a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last")).where(
        ~F.col("first").eqNullSafe(F.col("last"))).select("len", "a", "b", "first")
    later = names.join(intervals, ["len", "a", "b"]).where(
        (F.col("row") != F.col("first.row")) | (F.col("place") >= F.col("first.place") + F.col("len")))
    return later.select("row", F.explode(F.sequence("place", F.col("place") + F.col("len") - 1)).alias("place")).groupBy(
        "row").agg(F.collect_set("place").alias("places"))


def runs(repeated: DataFrame) -> DataFrame:
    """Maximal runs among repeated lines: ``row``, ``start`` and ``n_lines``."""
    placed = F.array_sort("places")
    starts = F.filter(placed, lambda x: ~F.array_contains("places", x - 1))
    ends = F.filter(placed, lambda x: ~F.array_contains("places", x + 1))
    return repeated.select("row", F.explode(F.arrays_zip(starts.alias("start"), ends.alias("end"))).alias("r")).select(
        "row", "r.start", (F.col("r.end") - F.col("r.start") + 1).alias("n_lines"))


def remove_repeated(docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES,
                    min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the text without later copies, and ``n_lines`` and ``n_removed`` (lines with a word).

    Lines without a word stay where they are. Columns of these two names are replaced.
    """
    gone = repeated_lines(docs, id_column, text, min_lines, min_words)
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    marked = docs.select(*[F.col(f"`{c}`") for c in kept], _row(id_column, text).alias("__row")).join(
        gone.select(F.col("row").alias("__row"), F.col("places").alias("__places")), "__row", "left")
    split = marked.withColumn("__lines", F.split(F.col(text), "\n", -1)).withColumn("__worded", _lines(F.col(text)))
    out = F.transform("__places", lambda k: F.get("__worded", k)["at"])
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), out)
    shorter = F.array_join(F.transform(stay, lambda i: F.get("__lines", i)), "\n")
    changed = F.when(F.col("__places").isNull(), F.col(text)).otherwise(shorter)
    return split.select(
        *[changed.alias(c) if c == text else F.col(f"`{c}`") for c in kept],
        F.size("__worded").cast("long").alias("n_lines"),
        F.coalesce(F.size("__places"), F.lit(0)).cast("long").alias("n_removed"))
