"""Column checks run as Spark jobs, reported as one row per check.

``failures`` counts missing rows (not_null), values that occur more than once (unique) and distinct values outside
the allowed set (accepted_values). Missing values are ignored by the last two.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import fits_broadcast
from tidemark.operators.tables import Partitioning, Table
from tidemark.session import materialize

NOT_NULL, UNIQUE, ACCEPTED = "not_null", "unique", "accepted_values"
REPORT = "relation string, column_name string, test string, failures long"


@dataclass(frozen=True)
class Check:
    column: str
    test: str
    values: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.test}({self.column}{''.join(f', {value}' for value in self.values)})"


def check_relations(relations: dict[str, DataFrame], checks: dict[str, list[Check]],
                    kept: dict[str, DataFrame] | None = None) -> DataFrame:
    """Columns: relation, column_name, test, failures.

    Each relation is scanned once: a row gives, for each check, what the check has to count (see :func:`_evidence`), and
    all evidence is counted in one aggregation that combines before the shuffle. Only where a hash repeats, the values
    behind it are counted in a second scan of that column. A relation whose evidence is ``kept`` (see :func:`keep_evidence`)
    is not scanned.
    """
    numbered = [(name, check) for name, listed in checks.items() for check in listed]
    kept = kept or {}
    scans = []
    for name, listed in checks.items():
        own = [(i, check) for i, (of, check) in enumerate(numbered) if of == name]
        if listed and name in kept:
            numbers = F.create_map(*[F.lit(x) for i, check in own for x in (check.name, i)])
            scans.append(kept[name].select(numbers[F.col("test")].alias("check"), "hash", "n"))
        elif listed:
            evidence = [_evidence(F.lit(i), check) for i, check in own]
            scans.append(relations[name].select(F.inline(F.array(*evidence))).where("hash IS NOT NULL")
                         .withColumn("n", F.lit(1).cast("long")))
    spark = next(iter(relations.values())).sparkSession
    if not scans:
        return spark.createDataFrame([], REPORT)
    counted = reduce(DataFrame.unionByName, scans).groupBy("check", "hash").agg(F.sum("n").alias("n"))
    is_unique = F.col("check").isin([i for i, (_, c) in enumerate(numbered) if c.test == UNIQUE])
    counted = materialize(counted.where(~is_unique | (F.col("n") > 1)), "check_evidence")
    totals = {row["check"]: row for row in counted.groupBy("check").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("values")).collect()}      # one row per check
    known, suspected = [], []
    for i, (name, check) in enumerate(numbered):
        found = totals.get(i)
        if check.test == UNIQUE and found:
            suspected.append(_count_repeated(name, relations[name], check, counted.where(F.col("check") == i)))
        else:
            failures = 0 if not found else found["rows"] if check.test == NOT_NULL else found["values"]
            known.append((name, check.column, check.test, failures))
    return reduce(DataFrame.unionByName, [spark.createDataFrame(known, REPORT), *suspected])


def keep_evidence(source: Table, checks: list[Check], path: str) -> DataFrame:
    """What the checks have to count in a stored table (``test``, ``hash``, ``n``), kept for each of its partitions.

    Only partitions that are others than at the last check are read; other checks than then read all of them again.
    """
    kept = Table(source.spark, path, Partitioning("of_partition", "part"))
    names = "|".join(sorted(check.name for check in checks))
    state = {_label(p): load for p, load in source.loads().items()} | {_CHECKS: names}
    seen = kept.seen()
    if not kept.exists() or seen.get(_CHECKS) != names:
        kept.overwrite(_by_partition(source, None, checks), state)
    else:
        moved = {p for p in {*state, *seen} if state.get(p) != seen.get(p)}
        if moved:
            partitions = [p for p in source.partitions() if _label(p) in moved]
            kept.replace(sorted(moved), _by_partition(source, partitions, checks), state)
    return kept.read()


_CHECKS = "checks"


def _label(partition: str) -> str:
    return partition or "all"


def _by_partition(source: Table, partitions: list[str] | None, checks: list[Check]) -> DataFrame:
    rows = source.read(partitions, labelled="part").withColumn("part", F.when(F.col("part") == "", "all").otherwise(F.col("part")))
    evidence = F.array(*[_evidence(F.lit(check.name), check) for check in checks])
    found = rows.select("part", F.inline(evidence)).where("hash IS NOT NULL")
    return found.groupBy("part", F.col("check").alias("test"), "hash").agg(F.count(F.lit(1)).alias("n"))


def _evidence(number: Column, check: Check) -> Column:
    """What a row adds to a check: a missing value, a value outside the set, or (unique) any value; by its hash."""
    value = F.col(check.column)
    if check.test == NOT_NULL:
        hashed = F.when(value.isNull(), F.lit(0).cast("long"))
    elif check.test == ACCEPTED:
        hashed = F.when(~value.isin(*check.values), F.xxhash64(value))
    else:
        hashed = F.when(value.isNotNull(), F.xxhash64(value))
    return F.struct(number.alias("check"), hashed.alias("hash"))


def _line(name: str, check: Check, failures: Column) -> list[Column]:
    return [F.lit(name).alias("relation"), F.lit(check.column).alias("column_name"), F.lit(check.test).alias("test"),
            failures.alias("failures")]


def _count_repeated(name: str, df: DataFrame, check: Check, suspects: DataFrame) -> DataFrame:
    values = df.where(F.col(check.column).isNotNull()).select(F.col(check.column).alias("value"))
    hashes = suspects.select("hash")
    if fits_broadcast(hashes):
        values = (values.withColumn("hash", F.xxhash64("value"))
                  .join(F.broadcast(hashes), "hash", "left_semi").drop("hash"))
    counted = values.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.count_if(F.col("n") > 1).alias("n")).select(*_line(name, check, F.col("n")))
