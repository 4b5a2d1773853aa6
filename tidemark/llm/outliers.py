"""Quality rules: robust multivariate outliers among statistic vectors, per language and source.

The statistics of a text are made from built-in expressions over its whole words and lines. Four of them, transformed, are
the vector: logarithm of the mean word length, logarithm of the symbols per word, square root of the share of repeated lines
and of the share of repeated words. For each cell (language and source) the minimum covariance determinant
is sought by concentration steps: from medians and quartile ranges on, the three quarters (``SUBSET``) of the rows that are
nearest by Mahalanobis distance give the next mean and covariance, until the determinants no longer fall. A row whose
distance from its cell's estimate is beyond the chi-square quantile is rejected.

All sums and quantile sketches are combined in the tasks, so one cell may hold most of the rows. Cells of fewer than
``LEAST_ROWS`` rows are pooled, by language and then all together. ``FLOOR`` is a spread below which a difference does not count,
added to each variance: most texts have no symbol at all, and one symbol is no outlier. It is small enough that each
statistic alone can reject a text. The quantile that bounds the subset is a sketch with a relative rank error of 1 in
``ACCURACY``.

Rows that fail the plain rules take no part in the estimates. A null text has no words; null languages and sources are
values of their own. Rows are told apart by nothing: each gets its own verdict.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import fits_broadcast
from tidemark.session import materialize

LEAST_WORDS = 50
SUBSET = 0.75
STEPS = 100               # far more than are ever taken: steps end when no determinant falls any more
LEAST_ROWS = 50
ACCURACY = 10_000
CONFIDENCE = 0.99999
# Of the shares, at most 1 (lines) and 1/2 (words, by the plain rules): with the limit at 5.3 floors, a text in a cell
# without repeats is rejected beyond 4/9 of its lines or 2/7 of its words, all else as usual. One repeated line of 7 (the median
# text) is 3 floors, one repeated triple of 269 words 1.5, so neither decides alone.
FLOOR = {"word_length": 0.08, "symbols": 0.10, "dup_lines": 0.125, "repeats": 0.10}
NAMES = tuple(FLOOR)
_N = len(NAMES)
_BUCKETS = 64

# Word and symbol patterns of the rules.
WORD, SYMBOL = r"[^\x20\x09-\x0D]+", r"[#*$%&|<>]"


def chi_square(x: float, freedom: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(freedom // 2))


def chi_square_quantile(p: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, freedom) < p else (low, mid)
    return low


#: Makes the covariance of the nearest ``SUBSET`` of normal rows that of all.
CONSISTENCY = SUBSET / chi_square(chi_square_quantile(SUBSET, _N), _N + 2)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines``, ``n_dup_lines`` and
    ``n_repeat_words``. Columns of these names are replaced."""
    made = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in (text, *made)]
    whole = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(
        *kept, F.regexp_extract_all(whole, F.lit(WORD), F.lit(0)).alias("__words"),
        F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(WORD)).alias("__lines"),
        F.regexp_count(whole, F.lit(SYMBOL)).cast("long").alias("n_symbols"))
    words = F.col("__words")
    triples = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
                          lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    hashed = split.withColumn("__triples", triples).withColumn("__sorted", F.sort_array("__triples"))
    again = F.array_distinct(F.filter("__sorted", lambda x, i: (i > 0) & (x == F.get("__sorted", i - 1))))
    # the repeated triples, dealt into short lists by their last bits
    dealt = F.transform(F.sequence(F.lit(0), F.lit(_BUCKETS - 1)),
                        lambda b: F.filter("__again", lambda x: F.pmod(x, F.lit(_BUCKETS)) == b))
    flags = F.transform("__triples", lambda x: F.array_contains(
        F.get("__dealt", F.pmod(x, F.lit(_BUCKETS)).cast("int")), x))
    marked = (hashed.withColumn("__again", again).drop("__sorted")
              .withColumn("__dealt", F.when(F.size("__again") > 0, dealt))
              # named twice here: a column named once would be made again for every triple
              .withColumn("__flags", F.when(F.col("__dealt").isNotNull(), flags)).drop("__dealt", "__triples", "__again"))
    in_flag = lambda i: F.coalesce(F.get("__flags", i), F.lit(False))
    covered = F.size(F.filter(F.transform("__words", lambda w, i: in_flag(i) | in_flag(i - 1) | in_flag(i - 2)),
                              lambda x: x))
    return marked.select(
        *kept, F.size("__words").cast("long").alias("n_words"),
        F.char_length(F.array_join("__words", "")).cast("long").alias("word_chars"), "n_symbols",
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("__flags").isNull(), 0).otherwise(covered).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vector() -> dict[str, Column]:
    return {
        "word_length": F.log(F.col("word_chars") / F.col("n_words")),
        "symbols": F.log(1 + 10 * F.col("n_symbols") / F.col("n_words")),
        "dup_lines": F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))),
        "repeats": F.sqrt(F.col("n_repeat_words") / F.col("n_words")),
    }


def _sized(small: DataFrame) -> DataFrame:
    return F.broadcast(small) if fits_broadcast(small) else small


def _cells(rows: DataFrame, language: str, source: str) -> DataFrame:
    """``rows`` with ``cell``: language and source, or the pool that takes in a cell of too few rows."""
    shown = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null"))
    fine = rows.withColumns({"__fine": F.to_json(F.array(shown(language), shown(source))), "__coarse": shown(language)})
    sizes = fine.groupBy("__fine", "__coarse").agg(F.count(F.lit(1)).alias("n"))
    small = sizes.where(F.col("n") < LEAST_ROWS)
    pools = small.groupBy("__coarse").agg(F.sum("n").alias("pooled"))
    named = sizes.join(pools, "__coarse", "left").select("__fine", F.when(F.col("n") >= LEAST_ROWS, F.col("__fine")).when(
        F.col("pooled") >= LEAST_ROWS, F.col("__coarse")).otherwise(F.lit("rest")).alias("cell"))
    return fine.join(_sized(materialize(named, "cells")), "__fine").drop("__fine", "__coarse")


def _c(i: int, j: int) -> str:
    return f"c{min(i, j)}{max(i, j)}"


def _cholesky() -> dict[str, Column]:
    """Lower triangle of the covariance with the floors added, from columns ``c00``, ``c01`` ..."""
    made: dict[tuple[int, int], Column] = {}
    for i in range(_N):
        for j in range(i + 1):
            left = F.col(_c(i, j)) * CONSISTENCY + (FLOOR[NAMES[i]] ** 2 if i == j else 0)
            for k in range(j):
                left = left - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            made[i, j] = F.sqrt(F.greatest(left, F.lit(1e-12))) if i == j else left / F.col(f"l{j}{j}")
    return {f"l{i}{j}": column for (i, j), column in made.items()}


def _with_factors(estimates: DataFrame) -> DataFrame:
    """Estimates with the factors ``l00`` ... and ``determinant`` (its logarithm), each from the ones before it."""
    for name, column in _cholesky().items():
        estimates = estimates.withColumn(name, column)
    return estimates.withColumn("determinant", sum((2 * F.log(f"l{i}{i}") for i in range(_N)), F.lit(0.0)))


def _distances(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """``rows`` with ``distance``: the squared Mahalanobis distance from the estimate of the cell."""
    keep = [F.col(c) for c in rows.columns]
    out = rows.join(_sized(estimates), "cell", "left")
    for i, name in enumerate(NAMES):
        left = F.col(name) - F.col(f"m{i}")
        for k in range(i):
            left = left - F.col(f"l{i}{k}") * F.col(f"y{k}")
        out = out.withColumn(f"y{i}", left / F.col(f"l{i}{i}"))
    return out.select(*keep, sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(_N)), F.lit(0.0)).alias("distance"))


def _moments() -> list[Column]:
    found = [F.avg(name).alias(f"m{i}") for i, name in enumerate(NAMES)]
    for i in range(_N):
        for j in range(i, _N):
            found.append(F.covar_pop(NAMES[i], NAMES[j]).alias(_c(i, j)))
    return found


def estimate(rows: DataFrame) -> DataFrame:
    """Mean ``m0`` ... and factors ``l00`` ... of the least-determinant subset of each ``cell``."""
    quartiles = rows.groupBy("cell").agg(*[F.percentile_approx(name, [0.25, 0.5, 0.75], ACCURACY).alias(f"q{i}")
                                           for i, name in enumerate(NAMES)])
    spread = lambda i: (F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349
    first = quartiles.select("cell", *[F.col(f"q{i}")[1].alias(f"m{i}") for i in range(_N)], *[
        (F.pow(spread(i), F.lit(2.0)) / CONSISTENCY if i == j else F.lit(0.0)).alias(_c(i, j))
        for i in range(_N) for j in range(i, _N)])
    now = materialize(_with_factors(first), "estimates")
    for step in range(STEPS):
        near = _distances(rows, now)
        bounds = near.groupBy("cell").agg(F.percentile_approx("distance", SUBSET, ACCURACY).alias("bound"))
        subset = near.join(_sized(materialize(bounds, "bounds")), "cell").where(F.col("distance") <= F.col("bound"))
        after = materialize(_with_factors(subset.groupBy("cell").agg(*_moments())), "estimates")
        fell = (after.select("cell", "determinant").join(now.select("cell", F.col("determinant").alias("was")), "cell")
                .where(F.col("determinant") < F.col("was") - 1e-9).limit(1).count())
        now = after
        if step and not fell:
            return now
    warnings.warn(f"determinants still fell after {STEPS} steps", stacklevel=2)
    return now


def judge(docs: DataFrame, language: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``docs`` without the text, with the statistics, ``base_failed``, ``distance`` (null if that) and ``kept``.

    Columns of these names are replaced; all others stay, whatever they are called.
    """
    made = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept")
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in (text, *made)])
    apart = docs.select(own.alias("__own"), F.col(language).alias("__language"), F.col(source).alias("__source"),
                        F.col(text).alias("__text"))
    measured = with_statistics(apart, "__text").withColumn("base_failed", base_failed())
    measured = materialize(measured.withColumns(
        {name: F.when(~F.col("base_failed"), column) for name, column in _vector().items()}), "statistics")
    passed = _cells(measured.where(~F.col("base_failed")), "__language", "__source")
    found = _distances(passed, estimate(passed.select("cell", *NAMES))).drop("cell")
    failed = measured.where("base_failed").withColumn("distance", F.lit(None).cast("double"))
    limit = chi_square_quantile(CONFIDENCE, _N)
    verdict = F.coalesce(~F.col("base_failed") & (F.col("distance") <= limit), F.lit(False)).alias("kept")
    return found.unionByName(failed).select("__own.*", *made[:-1], verdict)
