"""Parquet tables that are replaced or upserted partition by partition.

Every write goes to a folder of its own (``data/load=<id>/``). A small file under ``snapshots/`` then names the folder that
holds each partition; creating that file, which only one writer can do for a number, is the commit. So a failed run leaves the
table as it was, an upsert rewrites only the partitions it touches, and a partition that loses all its rows simply drops
out. The file also names the partitioning, so that a table is never written by two. A broken attempt leaves a folder
that nothing names; it does not stop later writes.

Writers may work at the same time. One that finds another's commit on top of what it read looks at the partitions that
commit changed: if it neither read nor wrote them, nor do they hold one of its keys, it commits on top; otherwise an
upsert is done again on the new rows, and a replacement fails with :class:`CommitConflict`.

Columns whose names begin with two underscores are stored and carried along, but not shown: with ``VERSION`` and ``DIGEST``
an upsert knows what it has already seen of a key.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import keyindex
from tidemark.operators.joins import lookup
from tidemark.operators.snapshots import CommitConflict, SnapshotLog
from tidemark.session import delete, materialize

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
HIDDEN = "__"
VERSION, DIGEST = "__version", "__digest"     # of a row as it came in: a later one is larger, an equal one is the same
ATTEMPTS = 5                                  # of an upsert that others overtake
_WHOLE = ""
_FOREIGN = "@"                                # a load of another table, by its folder


@dataclass(frozen=True)
class Partitioning:
    """``value`` is a SQL expression over the table's columns.

    ``fixed`` says that the partition follows from the key alone, so a key can never change partition.
    """

    name: str
    value: str
    fixed: bool = False


class Table:
    def __init__(self, spark: SparkSession, path: str, partitioning: Partitioning | None = None):
        self.spark = spark
        self.path = path
        self.partitioning = partitioning
        self._log = SnapshotLog(spark, f"{path}/snapshots")

    # -- reading ---------------------------------------------------------------------------------------------

    def exists(self) -> bool:
        return self._snapshot() is not None

    def number(self) -> int:
        """Number of the current snapshot; 0 without one."""
        return _number(self._snapshot())

    def numbers(self) -> list[int]:
        """The snapshots that have not expired."""
        return self._log.numbers()

    def partitions(self) -> list[str]:
        snapshot = self._snapshot()
        return sorted(snapshot["loads"]) if snapshot else []

    def loads(self) -> dict[str, str]:
        """The load that holds each partition; a partition that is rewritten gets another one."""
        snapshot = self._snapshot()
        return dict(snapshot["loads"]) if snapshot else {}

    def seen(self) -> dict[str, str]:
        """What the last write kept with the table (see :meth:`overwrite`)."""
        snapshot = self._snapshot()
        return dict(snapshot["seen"]) if snapshot else {}

    def read(self, partitions: list[str] | None = None, hidden: bool = False, labelled: str | None = None) -> DataFrame:
        """The current rows, or those of some partitions only; ``labelled``: with the name of their partition as a column."""
        if labelled is None:
            return self._rows(self._existing(), partitions, hidden=hidden)
        rows = self._rows(self._existing(), partitions, keep_partition=True, hidden=hidden)
        if not self.partitioning:
            return rows.withColumn(labelled, F.lit(_WHOLE))
        return rows.withColumn(labelled, F.coalesce(self.partitioning.name, F.lit(NULL_PARTITION)))

    def read_at(self, number: int, hidden: bool = False, partitions: list[str] | None = None) -> DataFrame:
        """The rows of a snapshot that has not expired, or those of some of its partitions only."""
        return self._rows(self._log.read(number), partitions, hidden=hidden)

    def changes(self, since: int, key: str, ignore: tuple[str, ...] = ()) -> DataFrame:
        """The rows that differ from those of snapshot ``since``, with ``change``: insert, update (the row as it is now) or
        delete (as it was).

        Only partitions that were rewritten are read, and their rows compared by key, nulls being equal to nulls; a row
        that was rewritten but is the same is no change, nor is one that differs in ``ignore`` only. A row without a key
        is none either.
        """
        before, after = self._log.read(since), self._existing()
        moved = sorted(_moved(before, after))
        shown = [f for f in _schema(after).fields if not f.name.startswith(HIDDEN)]

        def packed(snapshot: dict, name: str) -> DataFrame:
            rows = self._rows(snapshot, moved)
            cells = {f.name: F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None).cast(f.dataType) for f in shown}
            compared = F.struct(*[c.alias(n) for n, c in cells.items() if n not in ignore])
            return rows.where(F.col(f"`{key}`").isNotNull()).select(
                F.col(f"`{key}`").alias("__key"), F.struct(*[c.alias(n) for n, c in cells.items()]).alias(name),
                compared.alias(f"{name}_compared"))

        both = packed(before, "__old").join(packed(after, "__new"), "__key", "full_outer")
        change = F.when(F.col("__old").isNull(), "insert").when(F.col("__new").isNull(), "delete").otherwise("update")
        return both.where(~F.col("__old_compared").eqNullSafe(F.col("__new_compared"))).select(
            F.coalesce("__new", "__old").alias("__row"), change.alias("change")).select("__row.*", "change")

    def max_of(self, column: str, latest_partition_only: bool = False):
        """Largest value of a column; from the latest partition alone where partitions follow the column."""
        snapshot = self._existing()
        latest = None
        if latest_partition_only:
            latest = sorted(p for p in snapshot["loads"] if p != NULL_PARTITION)[-1:]
        return self._rows(snapshot, latest).agg(F.max(column)).first()[0]

    def register(self, name: str) -> None:
        """Make the current rows readable as ``name`` (``namespace.table``) in the catalog, over the stored files.

        A view of that name selects the columns from an external table whose partitions lie where the snapshot has them;
        it shows this snapshot until it is registered again.
        """
        snapshot = self._existing()
        files = f"{name}__files"
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in _schema(snapshot).fields]
        loads = snapshot["loads"]
        run = self.spark.sql
        run(f"DROP VIEW IF EXISTS {name}")
        run(f"DROP TABLE IF EXISTS {files}")
        if self.partitioning:
            part = self.partitioning.name
            run(f"CREATE TABLE {files} ({', '.join(fields)}, `{part}` string) USING parquet PARTITIONED BY (`{part}`) "
                f"LOCATION '{self.path}/data'")
            places = " ".join(f"PARTITION (`{part}`='{p}') LOCATION '{self._folder(p, load)}'"
                              for p, load in sorted(loads.items()))
            if places:
                run(f"ALTER TABLE {files} ADD {places}")
        else:
            run(f"CREATE TABLE {files} ({', '.join(fields)}) USING parquet LOCATION '{self._folder(_WHOLE, loads[_WHOLE])}'")
        columns = ", ".join(f"`{c}`" for c in _schema(snapshot).fieldNames() if not c.startswith(HIDDEN))
        run(f"CREATE VIEW {name} AS SELECT {columns} FROM {files}")

    # -- writing ---------------------------------------------------------------------------------------------

    def overwrite(self, df: DataFrame, seen: dict[str, str] | None = None, key: str | None = None,
                  gathered: bool = False) -> None:
        """Replace all rows; the table then has the partitioning it is opened with.

        ``seen`` is kept with the table: the :meth:`loads` of another table that the rows were made from. ``key`` is the
        column that later upserts go by; its index is written along. ``gathered``: rows of a partition lie together already,
        as in a table with the same partitions, and are not shuffled for it.
        """
        base = self._snapshot()
        loads, index = self._write(df, key, gathered)
        if not self._commit(base, loads, index, df.schema, seen, key):
            raise CommitConflict(f"{self.path} was written by another while its rows were replaced")

    def replace(self, partitions: list[str], df: DataFrame, seen: dict[str, str] | None = None,
                key: str | None = None, gathered: bool = False) -> None:
        """Replace the rows of some partitions; all rows of ``df`` have to lie in them. ``gathered``: as in :meth:`overwrite`."""
        base = self._existing()
        self._same_partitioning(base)
        schema = _schema(base)
        new = [f for f in df.schema.fields if f.name not in schema.fieldNames()]
        loads, index = self._write(_as_stored(df, schema), key, gathered) if partitions else ({}, {})
        if not set(loads) <= set(partitions):
            raise ValueError(f"rows of other partitions: {sorted(set(loads) - set(partitions))}")
        if not self._commit(base, loads, index, T.StructType([*schema.fields, *new]), seen, key, set(partitions)):
            raise CommitConflict(f"{self.path}: another has written partitions that were replaced")

    def upsert(self, delta: DataFrame, key: str, seen: dict[str, str] | None = None,
               taken_at: int | None = None) -> DataFrame | None:
        """Replace rows with a key in ``delta``, add the others; columns new in ``delta`` are appended.

        A key that occurs twice in ``delta`` is an error, in the first load as in later ones. ``seen``: as in
        :meth:`overwrite`.

        If ``delta`` has ``VERSION`` and ``DIGEST``, a row replaces a stored one only if its version is larger (a null is
        the smallest) or the stored one came without. An equal version with an equal digest has been seen; with
        another digest it is left out and returned, as nothing tells which of the two is right.

        ``taken_at`` is the number of the snapshot that the rows of ``delta`` were taken from, if they were and no value that
        decides their partition was changed: on that snapshot, no other partition is searched for their keys.
        """
        delta = materialize(delta, "delta")
        self._reject_repeated(delta, key)
        for _ in range(ATTEMPTS):
            snapshot = self._snapshot()
            at_home = taken_at is not None and _number(snapshot) == taken_at
            done, ties = self._upsert_on(snapshot, delta, key, seen, at_home)
            if done:
                return ties
        raise CommitConflict(f"{self.path}: others kept writing the same rows, {ATTEMPTS} times")

    def copy_of(self, source: Table, seen: dict[str, str] | None = None) -> None:
        """Become a copy of the current rows of ``source`` that names its loads; nothing is copied.

        ``source`` gets a note of it, so that :meth:`expire` keeps the loads that a copy still names.
        """
        base, snapshot = self._snapshot(), source._existing()
        source._log.create(f"{hashlib.sha256(self.path.encode()).hexdigest()[:32]}.ref", {"path": self.path, "of": source.path})
        self.partitioning = source.partitioning
        loads = {p: load if load.startswith(_FOREIGN) else f"{_FOREIGN}{source.path}/data/load={load}"
                 for p, load in snapshot["loads"].items()}
        if not self._commit(base, loads, snapshot["index"], _schema(snapshot), seen, snapshot["key"]):
            raise CommitConflict(f"{self.path} was written by another while it became a copy")

    def expire(self, keep: int = 2) -> None:
        """Delete all but the last ``keep`` snapshots, and the loads that neither those nor copies name."""
        numbers = self._log.numbers()
        snapshots = {n: self._log.read(n) for n in numbers}
        live = {load for n in numbers[-keep:] for load in snapshots[n]["loads"].values()}
        for note in self._log.others(".ref"):
            copy = SnapshotLog(self.spark, f"{note['path']}/snapshots")
            named = {load for n in copy.numbers() for load in copy.read(n)["loads"].values()}
            live |= {load.rsplit("load=", 1)[1] for load in named if load.startswith(f"{_FOREIGN}{note['of']}/data/")}
        old = {load for n in numbers[:-keep] for load in snapshots[n]["loads"].values() if not load.startswith(_FOREIGN)}
        for load in old & live:
            self._log.create(f"{load}.old", {"load": load})      # to be looked at again, once its snapshots are gone
        for n in numbers[:-keep]:
            self._log.remove(n)
        gone = (old | {note["load"] for note in self._log.others(".old")}) - live
        self._delete_loads(gone)
        for load in gone:
            self._log.drop(f"{load}.old")

    # -- snapshots -------------------------------------------------------------------------------------------

    def stored_partitioning(self) -> Partitioning | None:
        """The partitioning that the table was last written with, if it exists and has one."""
        snapshot = self._snapshot()
        held = snapshot["partitioning"] if snapshot else None
        return Partitioning(**held) if held else None

    def _same_partitioning(self, snapshot: dict) -> None:
        own = vars(self.partitioning) if self.partitioning else None
        if snapshot["partitioning"] != own:
            raise ValueError(f"{self.path} is partitioned by {snapshot['partitioning']}, not by {own}")

    def _snapshot(self) -> dict | None:
        return self._log.last()

    def _existing(self) -> dict:
        snapshot = self._snapshot()
        if snapshot is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return snapshot

    def _commit(self, base: dict | None, loads: dict[str, str], index: dict[str, list[int]], schema: T.StructType,
                seen: dict[str, str] | None, key: str | None, touched: set[str] | None = None,
                delta: DataFrame | None = None) -> bool:
        """Put ``loads`` in the place of the ``touched`` partitions (None: of all) of ``base``.

        False if another has since written something that this write depends on.
        """
        while True:
            last = self._snapshot()
            if _number(last) != _number(base) and not self._apart(base, last, touched, delta, key):
                self._delete_loads({load for load in loads.values() if not load.startswith(_FOREIGN)})
                return False
            others = {} if touched is None or last is None else {p: x for p, x in last["loads"].items() if p not in touched}
            same_key = last is not None and (key is None or last["key"] == key)
            content = {
                "number": _number(last) + 1, "loads": others | loads, "schema": schema.jsonValue(),
                "key": last["key"] if others and same_key else key,
                "index": ({p: last["index"][p] for p in others if p in last["index"]} if same_key else {}) | index,
                "seen": (last["seen"] if last else {}) if seen is None else seen,
                "partitioning": vars(self.partitioning) if self.partitioning else None}
            if self._log.commit(content):
                return True

    def _delete_loads(self, loads: set[str]) -> None:
        for load in sorted(loads):
            delete(self.spark, f"{self.path}/data/load={load}")
            delete(self.spark, f"{self.path}/index/load={load}")

    def _apart(self, base: dict | None, last: dict, touched: set[str] | None, delta: DataFrame | None, key: str | None) -> bool:
        """Whether what was committed since ``base`` has nothing to do with a write."""
        if base is None or touched is None or any(base[k] != last[k] for k in ("schema", "partitioning")):
            return False
        moved = _moved(base, last)
        if moved & touched:
            return False
        return delta is None or self.partitioning.fixed or not self._holding(last, delta, key, sorted(moved & set(last["loads"])))

    # -- parts -----------------------------------------------------------------------------------------------

    def _upsert_on(self, snapshot: dict | None, delta: DataFrame, key: str,
                   seen: dict[str, str] | None, at_home: bool = False) -> tuple[bool, DataFrame | None]:
        if snapshot is None:
            return self._commit(None, *self._write(delta, key), delta.schema, seen, key), None
        self._same_partitioning(snapshot)
        schema = _schema(snapshot)
        delta = _as_stored(delta, schema)
        touched, ties = self._touched(snapshot, delta, key, at_home), None
        if VERSION in delta.columns and VERSION in schema.fieldNames():
            stale = self._stale(snapshot, delta, key, touched)
            tied = stale.where("__verdict = 'tie'").select(key)
            ties = lookup(delta, tied, [key], spread=None, how="left_semi")
            if not stale.isEmpty():
                delta = lookup(delta, stale.select(key), [key], spread=None, how="left_anti")
                touched = self._touched(snapshot, delta, key, at_home)
        new = [f for f in delta.schema.fields if f.name not in schema.fieldNames()]
        if not touched:
            if new or seen is not None:
                wider = T.StructType([*schema.fields, *new])
                return self._commit(snapshot, {}, {}, wider, seen, key, set()), ties
            return True, ties
        old = self._rows(snapshot, sorted(touched), hidden=True)
        merged = delta
        absent = [c for c in schema.fieldNames() if c not in delta.columns]
        if absent:
            # A replaced row keeps its value in columns that the delta does not carry.
            merged = delta.join(old.select(key, *absent), key, "left")
        kept = lookup(old, delta.select(key), [key], spread=None, how="left_anti")
        merged = kept.unionByName(merged, allowMissingColumns=True)
        loads, index = self._write(merged, key)
        return self._commit(snapshot, loads, index, merged.schema, seen, key, touched, delta), ties

    def _stale(self, snapshot: dict, delta: DataFrame, key: str, touched: set[str]) -> DataFrame:
        """Keys of ``delta`` that are no newer than what is stored, with ``__verdict``: seen (or older), or a tie with other
        content. Only keys, versions and digests are compared and stored, not the rows."""
        held = self._rows(snapshot, sorted(touched), hidden=True).select(
            key, F.col(VERSION).alias("__held_version"), F.col(DIGEST).alias("__held_digest"))
        later = F.coalesce(F.col(VERSION) > F.col("__held_version"),
                           F.col(VERSION).isNotNull() & F.col("__held_version").isNull())
        equal = F.col(VERSION).eqNullSafe(F.col("__held_version"))
        verdict = F.when(equal & (F.col(DIGEST) != F.col("__held_digest")), "tie").otherwise("seen")
        both = delta.select(key, VERSION, DIGEST).join(held.where(F.col("__held_digest").isNotNull()), key)
        return materialize(both.where(~later).select(key, verdict.alias("__verdict")), "versions")

    def _rows(self, snapshot: dict, partitions: list[str] | None, keep_partition: bool = False,
              hidden: bool = False) -> DataFrame:
        schema = _schema(snapshot)
        loads = snapshot["loads"]
        wanted = loads if partitions is None else {p: loads[p] for p in partitions if p in loads}
        columns = [c for c in schema.fieldNames() if hidden or not c.startswith(HIDDEN)]
        stored = schema
        if self.partitioning:
            stored = T.StructType([*schema.fields, T.StructField(self.partitioning.name, T.StringType())])
            columns += [self.partitioning.name] if keep_partition else []
        if not wanted:
            return self.spark.createDataFrame([], stored).select(*columns)
        found = None
        for base in sorted({self._base(load) for load in wanted.values()}):
            folders = [self._folder(p, load) for p, load in sorted(wanted.items()) if self._base(load) == base]
            part = self.spark.read.schema(stored).option("basePath", base).parquet(*folders).select(*columns)
            found = part if found is None else found.union(part)
        return found

    def _base(self, load: str) -> str:
        """Folder of the loads among which ``load`` is."""
        return load[len(_FOREIGN):].rsplit("/", 1)[0] if load.startswith(_FOREIGN) else f"{self.path}/data"

    def _folder(self, partition: str, load: str) -> str:
        folder = load[len(_FOREIGN):] if load.startswith(_FOREIGN) else f"{self.path}/data/load={load}"
        return f"{folder}/{self.partitioning.name}={partition}" if self.partitioning else folder

    def _write(self, df: DataFrame, key: str | None = None, gathered: bool = False) -> tuple[dict[str, str], dict[str, list[int]]]:
        """Write ``df`` to a new folder and return the folder of each partition written, and the range of its keys."""
        load = f"l{uuid.uuid4().hex[:16]}"
        folder = f"{self.path}/data/load={load}"
        if not self.partitioning:
            df.write.parquet(folder)
            return {_WHOLE: load}, {}
        name = self.partitioning.name
        # The names of the partitions, at most, are read back. REBALANCE gathers each partition into few files and lets AQE split a partition that is much larger.
        named = df.withColumn(name, F.expr(self.partitioning.value).cast("string"))
        (named if gathered else named.hint("rebalance", F.col(name))).write.partitionBy(name).parquet(folder)
        stored = T.StructType([*df.schema.fields, T.StructField(name, T.StringType())])
        written = self.spark.read.schema(stored).option("basePath", folder).parquet(folder)
        files = written.inputFiles()
        found = {unquote(part.split("=", 1)[1]) for f in files for part in f.split("/") if part.startswith(f"{name}=")}
        index = {}
        if key is not None and found and not self.partitioning.fixed:
            ranges = keyindex.write(written.select(key, name), key, name, f"{self.path}/index/load={load}")
            index = {p: ranges.get(None if p == NULL_PARTITION else p, []) for p in found}
        return {p: load for p in found}, index

    def _touched(self, snapshot: dict, delta: DataFrame, key: str, at_home: bool = False) -> set[str]:
        """Partitions that gain rows from ``delta`` or hold a row it replaces (at most all partitions' names). ``at_home``: they
        are the same."""
        if not self.partitioning:
            return {_WHOLE} if not delta.isEmpty() else set()
        value, at = F.expr(self.partitioning.value).cast("string"), keyindex.place(key, delta.schema[key].dataType)
        found = delta.groupBy(value.alias("__partition")).agg(F.min(at).alias("low"), F.max(at).alias("high")).collect()
        own = {NULL_PARTITION if row[0] is None else row[0] for row in found}
        known = [row for row in found if row["low"] is not None]
        if self.partitioning.fixed or at_home or not known:
            return own
        span = min(row["low"] for row in known), max(row["high"] for row in known)
        return own | self._holding(snapshot, delta, key, [p for p in snapshot["loads"] if p not in own], span)

    def _holding(self, snapshot: dict, delta: DataFrame, key: str, partitions: list[str],
                 span: tuple[int, int] | None = None) -> set[str]:
        """Those of ``partitions`` that hold a key of ``delta``: by range and prints where they are indexed by ``key``."""
        name = self.partitioning.name
        index = snapshot["index"] if snapshot["key"] == key else {}
        if span is None:
            at = keyindex.place(key, delta.schema[key].dataType)
            span = tuple(delta.agg(F.min(at), F.max(at)).first())
            if span[0] is None:
                return set()
        near = [p for p in partitions if index.get(p) and index[p][0] <= span[1] and span[0] <= index[p][1]]
        bare = [p for p in partitions if p not in index]
        keys = delta.where(F.col(f"`{key}`").isNotNull())
        found = []
        if near:
            stored = keyindex.read(self.spark, name, [self._index_folder(p, snapshot["loads"][p]) for p in near])
            wanted = keys.select(*keyindex.prints(key)).distinct()
            found.append(lookup(stored, wanted, [keyindex.SHARD, keyindex.PRINT], spread=None, how="left_semi"))
        if bare:
            held = self._rows(snapshot, bare, keep_partition=True).select(key, name)
            found.append(lookup(held, keys.select(key), [key], spread=None, how="left_semi"))
        rows = [row for df in found for row in df.select(name).distinct().collect()]        # names of partitions
        return {NULL_PARTITION if row[0] is None else row[0] for row in rows}

    def _index_folder(self, partition: str, load: str) -> tuple[str, str]:
        folder = load[len(_FOREIGN):] if load.startswith(_FOREIGN) else f"{self.path}/data/load={load}"
        root, load_folder = folder.rsplit("/data/", 1)
        return f"{root}/index", f"{root}/index/{load_folder}/{self.partitioning.name}={partition}"

    def _reject_repeated(self, delta: DataFrame, key: str) -> None:
        repeated = delta.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").first()
        if repeated is not None:
            raise ValueError(f"{key} {repeated[0]!r} occurs {repeated['count']} times in the rows to upsert")


def _number(snapshot: dict | None) -> int:
    return snapshot["number"] if snapshot else 0


def _moved(before: dict, after: dict) -> set[str]:
    """Partitions that are not the same load in both snapshots."""
    old, new = before["loads"], after["loads"]
    return {p for p in {*old, *new} if old.get(p) != new.get(p)}


def _schema(snapshot: dict) -> T.StructType:
    return T.StructType.fromJson(snapshot["schema"])


def _as_stored(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns the table already has keep the type they have there."""
    stored = {f.name: f.dataType for f in schema.fields}
    return df.select(*[
        F.col(f.name).cast(stored[f.name]).alias(f.name, metadata=f.metadata)
        if f.name in stored and stored[f.name] != f.dataType else F.col(f.name)
        for f in df.schema.fields
    ])
