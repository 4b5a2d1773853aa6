"""Tables with several writers, versions, the key index, change feeds and copies."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from tests.test_tables import BY_BUCKET, BY_MONTH, content, rows
from tidemark.operators import CommitConflict, Table, keyindex
from tidemark.operators.snapshots import SnapshotLog
from tidemark.operators.tables import DIGEST, NULL_PARTITION, VERSION


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "t")


# -- the log -------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("way", ["_link", "_rename"])
def test_a_number_is_taken_once(spark, path, way):
    log = SnapshotLog(spark, path)
    assert log.last() is None and log.commit({"number": 1, "by": "a"})
    assert not getattr(log, way)("0000000001.json", "{}")
    assert getattr(log, way)("0000000002.json", '{"number": 2, "by": "é"}')
    assert log.numbers() == [1, 2] and log.read(1)["by"] == "a" and log.last()["by"] == "é"


def test_many_writers_of_a_number(spark, path):
    log, won = SnapshotLog(spark, path), []
    threads = [threading.Thread(target=lambda i=i: won.append(i) if log.commit({"number": 1, "by": i}) else None)
               for i in range(16)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and log.read(1)["by"] == won[0]


# -- two writers ---------------------------------------------------------------------------------------------------

def overtaken(table, monkeypatch, other):
    """``other`` runs after the table's next write has read its snapshot and written its rows, but before it commits."""
    commit, done = table._commit, []

    def late(*args, **kwargs):
        if not done:
            done.append(True)
            other()
        return commit(*args, **kwargs)
    monkeypatch.setattr(table, "_commit", late)


START = [("a", "2024-01-01", 1), ("b", "2024-02-01", 2), ("c", "2024-03-01", 3)]


@pytest.fixture(params=[BY_MONTH, BY_BUCKET, None], ids=["month", "bucket", "whole"])
def two(request, spark, path):
    first, second = Table(spark, path, request.param), Table(spark, path, request.param)
    first.upsert(rows(spark, *START), "k")
    return first, second


@pytest.mark.parametrize("other", [("b", "2024-02-01", 20), ("a", "2024-01-02", 20), ("d", "2024-01-05", 20)])
def test_neither_update_is_lost(spark, two, monkeypatch, other):
    first, second = two
    overtaken(first, monkeypatch, lambda: second.upsert(rows(spark, other), "k"))
    first.upsert(rows(spark, ("a", "2024-01-01", 10)), "k")
    expected = {k: (k, d, v) for k, d, v in START} | {other[0]: other} | {"a": ("a", "2024-01-01", 10)}
    assert content(first) == sorted(expected.values())


def test_a_key_that_both_add_in_different_partitions_is_there_once(spark, two, monkeypatch):
    first, second = two
    overtaken(first, monkeypatch, lambda: second.upsert(rows(spark, ("n", "2024-07-01", 1)), "k"))
    first.upsert(rows(spark, ("n", "2024-08-01", 2)), "k")
    assert content(first) == sorted([*START, ("n", "2024-08-01", 2)])


def test_first_writes_of_both_end_in_the_table(spark, path, monkeypatch):
    first, second = Table(spark, path, BY_MONTH), Table(spark, path, BY_MONTH)
    overtaken(first, monkeypatch, lambda: second.upsert(rows(spark, START[1]), "k"))
    first.upsert(rows(spark, START[0]), "k")
    assert content(first) == START[:2]


def test_replacing_what_another_wrote_fails_loudly(spark, two, monkeypatch):
    first, second = two
    overtaken(first, monkeypatch, lambda: second.upsert(rows(spark, ("d", "2024-01-05", 20)), "k"))
    with pytest.raises(CommitConflict):
        first.overwrite(rows(spark, ("z", "2024-01-05", 0)))
    assert ("d", "2024-01-05", 20) in content(second) and len(content(second)) == 4


def test_replaced_partitions_conflict_only_with_their_own(spark, path, monkeypatch):
    first, second = Table(spark, path, BY_MONTH), Table(spark, path, BY_MONTH)
    first.overwrite(rows(spark, *START), key="k")
    overtaken(first, monkeypatch, lambda: second.upsert(rows(spark, ("c", "2024-03-01", 30)), "k"))
    first.replace(["2024-01"], rows(spark, ("a", "2024-01-09", 10)))
    assert content(first) == [("a", "2024-01-09", 10), START[1], ("c", "2024-03-01", 30)]
    monkeypatch.undo()
    overtaken(first, monkeypatch, lambda: second.upsert(rows(spark, ("a", "2024-01-02", 5)), "k"))
    with pytest.raises(CommitConflict):
        first.replace(["2024-01"], rows(spark, ("a", "2024-01-09", 11)))
    with pytest.raises(ValueError, match="other partitions"):
        second.replace(["2024-01"], rows(spark, ("a", "2024-02-09", 10)))


def test_upsert_gives_up_loudly(spark, two, monkeypatch):
    first, second = two
    commit = first._commit

    def always_late(*args, **kwargs):
        second.upsert(rows(spark, ("a", "2024-01-01", second.number())), "k")
        return commit(*args, **kwargs)
    monkeypatch.setattr(first, "_commit", always_late)
    with pytest.raises(CommitConflict, match="kept writing"):
        first.upsert(rows(spark, ("a", "2024-01-01", -1)), "k")
    assert -1 not in {v for _, _, v in content(second)}


def test_writers_in_threads(spark, path):
    Table(spark, path, BY_MONTH).overwrite(rows(spark, *START), key="k")
    failed = []

    def write(i):
        try:
            Table(spark, path, BY_MONTH).upsert(rows(spark, (f"w{i}", f"2024-{4 + i:02d}-01", i)), "k")
        except Exception as error:  # noqa: BLE001
            failed.append(error)
    threads = [threading.Thread(target=write, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    assert content(Table(spark, path, BY_MONTH)) == sorted([*START, *[(f"w{i}", f"2024-{4 + i:02d}-01", i) for i in range(4)]])


# -- the key index -------------------------------------------------------------------------------------------------

def test_places_do_not_fall(spark):
    texts = sorted(["", "1", "9", "10", "99", "100", "é", "ab", "abcdefgh", "abcdefgi", "x" * 500, "0" * 200],
                   key=lambda t: (min(len(t.encode()), 126), t.encode()))
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, k string").select(
        "i", keyindex.place("k", keyindex.T.StringType()).alias("at")).orderBy("i").collect()
    assert [r["at"] for r in found] == sorted(r["at"] for r in found) and len({r["at"] for r in found}) > 8


def months(spark, first, count, per=200):
    return spark.range(first * per, (first + count) * per).selectExpr(
        "cast(id as string) k", f"add_months(date'2020-01-01', int(id / {per})) day", "1 v")


def opened(table, monkeypatch):
    """Partitions whose files, or whose prints, are opened from now on."""
    data, prints = [], []
    read_rows, read_prints = table._rows, keyindex.read
    monkeypatch.setattr(table, "_rows", lambda s, p, *a, **k: (data.append(p), read_rows(s, p, *a, **k))[1])
    monkeypatch.setattr(keyindex, "read", lambda s, n, f: (prints.append(sorted(x.rsplit("=", 1)[1] for _, x in f)),
                                                           read_prints(s, n, f))[1])
    return data, prints


def test_new_ids_open_no_old_partition(spark, path, monkeypatch):
    table = Table(spark, path, BY_MONTH)
    table.overwrite(months(spark, 0, 12), key="k")
    data, prints = opened(table, monkeypatch)
    table.upsert(months(spark, 12, 1).withColumn("v", F.lit(2)), "k")       # ids grow with time
    assert prints == [] and data == [["2021-01"]]
    assert {r.v: r["count"] for r in table.read().groupBy("v").count().collect()} == {1: 2400, 2: 200}


def test_prints_name_the_partitions_that_hold_a_key(spark, path, monkeypatch):
    table = Table(spark, path, BY_MONTH)
    scrambled = lambda df: df.withColumn("k", F.md5("k"))  # noqa: E731    (any id in any month)
    table.overwrite(scrambled(months(spark, 0, 12)), key="k")
    moved = scrambled(spark.createDataFrame([("450", "2021-05-01", 9), ("451", "2020-03-01", 9), ("1900", None, 9),
                                             ("new", "2021-05-02", 9)], "k string, day string, v int")
                      .withColumn("day", F.col("day").cast("date")))
    data, prints = opened(table, monkeypatch)
    table.upsert(moved, "k")
    assert len(prints[0]) == 11 and data == [["2020-03", "2020-10", "2021-05", NULL_PARTITION]]
    assert table.read().count() == 2401 and table.read().where("v = 9").count() == 4


def test_partitions_without_an_index_are_read(spark, path):
    table = Table(spark, path, BY_MONTH)
    table.overwrite(months(spark, 0, 3))
    table.upsert(spark.createDataFrame([("5", "2020-03-05", 7), (None, "2020-01-05", 7)], "k string, day string, v int")
                 .withColumn("day", F.col("day").cast("date")), "k")
    assert table.read().count() == 601 and table.read().where("k = '5'").count() == 1
    table.upsert(rows(spark, ("5", "2020-02-05", 8), ("6", "2020-02-05", 8)), "k")
    assert table.read().count() == 601 and sorted(r.v for r in table.read().where("k in ('5', '6')").collect()) == [8, 8]


# -- versions ------------------------------------------------------------------------------------------------------

def version(spark, *values):
    return spark.createDataFrame([(k, d, v, n, v) for k, d, v, n in values],
                                 f"k string, day string, v int, {VERSION} int, {DIGEST} long").withColumn(
        "day", F.col("day").cast("date"))


EVENTS = [[("a", "2024-01-01", 1, 1), ("b", "2024-01-01", 1, 1)], [("a", "2024-02-01", 2, 2)],
          [("a", "2024-01-03", 3, 3), ("c", "2024-03-01", 1, None)], [("c", "2024-01-01", 4, 1)]]


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 2, 1, 0), (2, 0, 3, 1), (1, 3, 0, 2), (2, 3, 1, 0)])
def test_versions_in_any_order_give_one_result(spark, tmp_path, order):
    table = Table(spark, str(tmp_path / "t"), BY_MONTH)
    for i in [*order, order[0]]:                                   # and the first once more
        assert not (ties := table.upsert(version(spark, *EVENTS[i]), "k")) or ties.isEmpty()
    assert content(table) == [("a", "2024-01-03", 3), ("b", "2024-01-01", 1), ("c", "2024-01-01", 4)]
    assert table.read().columns == ["k", "day", "v"]


def test_old_versions_rewrite_nothing(spark, path):
    table = Table(spark, path, BY_MONTH)
    table.upsert(version(spark, ("a", "2024-01-01", 5, 5), ("b", "2024-02-01", 5, 5)), "k")
    before = table.loads()
    table.upsert(version(spark, ("a", "2024-03-01", 1, 1), ("b", "2024-02-01", 5, 5)), "k")
    assert table.loads() == before
    table.upsert(version(spark, ("a", "2024-01-01", 1, 1), ("b", "2024-02-01", 6, 6)), "k")
    assert table.loads()["2024-01"] == before["2024-01"] and table.loads()["2024-02"] != before["2024-02"]


def test_ties_that_differ_are_returned(spark, path):
    table = Table(spark, path, BY_MONTH)
    table.upsert(version(spark, ("a", "2024-01-01", 5, 5)), "k")
    ties = table.upsert(version(spark, ("a", "2024-01-01", 6, 5), ("b", "2024-01-01", 1, 1)), "k")
    assert [(r.k, r.v) for r in ties.collect()] == [("a", 6)]
    assert content(table) == [("a", "2024-01-01", 5), ("b", "2024-01-01", 1)]


def test_rows_without_versions(spark, path):
    table = Table(spark, path, BY_MONTH)
    table.overwrite(rows(spark, ("a", "2024-01-01", 0), ("b", "2024-01-01", 0)), key="k")
    table.upsert(version(spark, ("a", "2024-01-01", 2, 2)), "k")              # replaces one that came without
    table.upsert(rows(spark, ("a", "2024-01-01", 9)), "k")                    # a plain one replaces, and keeps the version
    table.upsert(version(spark, ("a", "2024-01-01", 1, 1), ("b", "2024-01-01", 1, None)), "k")
    assert content(table) == [("a", "2024-01-01", 9), ("b", "2024-01-01", 1)]


# -- changes and copies --------------------------------------------------------------------------------------------

def test_changes(spark, path):
    table = Table(spark, path, BY_MONTH)
    table.overwrite(rows(spark, *START, ("d", "2024-03-02", None), ("n", None, 7)), key="k")
    since = table.number()
    table.upsert(rows(spark, ("a", "2024-01-01", 1), ("b", "2024-04-01", 2), ("d", "2024-03-02", 4), ("e", "2024-04-01", 5)), "k")
    table.replace(["2024-03"], rows(spark, ("d", "2024-03-02", 4)))
    found = sorted((r.k, str(r.day), r.v, r.change) for r in table.changes(since, "k").collect())
    assert found == [("b", "2024-04-01", 2, "update"), ("c", "2024-03-01", 3, "delete"), ("d", "2024-03-02", 4, "update"),
                     ("e", "2024-04-01", 5, "insert")]
    assert table.changes(table.number(), "k").isEmpty()
    assert sorted(r.k for r in table.changes(since, "k", ignore=("day",)).collect()) == ["c", "d", "e"]
    table.upsert(rows(spark, ("e", "2024-04-01", 5)).withColumn("tier", F.lit("x")), "k")
    assert {r.k: (r.tier, r.change) for r in table.changes(since, "k").collect()}["e"] == ("x", "insert")


@pytest.mark.parametrize("partitioning", [BY_MONTH, None])
def test_copy_by_reference(spark, tmp_path, partitioning):
    table, copy = Table(spark, str(tmp_path / "t"), partitioning), Table(spark, str(tmp_path / "copy"))
    table.overwrite(rows(spark, *START), key="k")
    copy.copy_of(table)
    assert content(copy) == START and not (tmp_path / "copy" / "data").exists()
    for v in range(4):                                            # the copy stays as it was, and its files stay
        table.upsert(rows(spark, ("a", "2024-01-01", 10 + v), ("b", "2024-02-01", v), ("c", "2024-05-01", v)), "k")
    table.expire(keep=1)
    assert content(copy) == START and len(content(table)) == 3
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2
    copy.upsert(rows(spark, ("b", "2024-02-01", 20), ("z", "2024-07-01", 0)), "k")       # a copy can be written to
    assert content(copy) == [START[0], ("b", "2024-02-01", 20), START[2], ("z", "2024-07-01", 0)]
    assert content(table)[1] == ("b", "2024-02-01", 3)
    copy.copy_of(table)
    copy.expire(keep=1)
    table.expire(keep=1)                                          # nobody names the first load any more
    assert content(copy) == content(table)
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1
    other = Table(spark, str(tmp_path / "copy of a copy"))
    other.copy_of(copy)
    assert content(other) == content(table)
