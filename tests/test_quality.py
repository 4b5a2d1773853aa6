from __future__ import annotations

from tidemark.operators import Check, Partitioning, Table, check_relations
from tidemark.operators.quality import ACCEPTED, NOT_NULL, UNIQUE, keep_evidence
from tidemark.plans.checks import DEFAULT_CHECKS, VALUE_CHECKS


def report(relations, checks):
    return {(r.relation, r.column_name, r.test): r.failures for r in check_relations(relations, checks).collect()}


def test_each_kind_of_check(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (2, "odd"), (3, None), (None, "odd")], "k int, s string")
    clean = spark.range(100).selectExpr("id k")
    checks = {"t": [Check("k", UNIQUE), Check("k", NOT_NULL), Check("s", NOT_NULL), Check("s", UNIQUE),
                    Check("s", ACCEPTED, ("a", "b"))],
              "clean": [Check("k", UNIQUE), Check("k", NOT_NULL)]}
    assert report({"t": df, "clean": clean}, checks) == {
        ("t", "k", UNIQUE): 2, ("t", "k", NOT_NULL): 1, ("t", "s", NOT_NULL): 1, ("t", "s", UNIQUE): 2,
        ("t", "s", ACCEPTED): 1, ("clean", "k", UNIQUE): 0, ("clean", "k", NOT_NULL): 0}


def test_value_that_fills_a_third_of_the_rows(spark):
    df = spark.range(30000).selectExpr("if(id % 3 = 0, 'same', cast(id as string)) k")
    assert report({"t": df}, {"t": [Check("k", UNIQUE)]}) == {("t", "k", UNIQUE): 1}


def test_repeated_values_beyond_the_broadcast_limit(spark):
    spark.conf.set("tidemark.broadcast.maxBytes", "0")
    try:
        df = spark.range(2000).selectExpr("cast(id % 1500 as string) k")
        assert report({"t": df}, {"t": [Check("k", UNIQUE)]}) == {("t", "k", UNIQUE): 500}
    finally:
        spark.conf.unset("tidemark.broadcast.maxBytes")


def test_suite_sizes():
    tests = [c.test for listed in DEFAULT_CHECKS.values() for c in listed]
    assert (tests.count(UNIQUE), tests.count(NOT_NULL)) == (13, 25)
    assert sum(len(listed) for listed in VALUE_CHECKS.values()) == 7


def test_one_scan_and_few_jobs(spark, tmp_path):
    """Checks that find nothing repeated take one job of evidence, whatever their number."""
    spark.range(1000).selectExpr("id AS k", "cast(id AS string) AS s").write.parquet(str(tmp_path / "t"))
    checks = {name: [Check("k", UNIQUE), Check("s", UNIQUE), Check("k", NOT_NULL), Check("s", NOT_NULL)]
              for name in ("one", "two", "three")}
    relations = {name: spark.read.parquet(str(tmp_path / "t")) for name in checks}
    spark.sparkContext.setJobGroup("checks", "")
    found = report(relations, checks)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert set(found.values()) == {0} and len(found) == 12
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("checks")) < 10


def test_checks_by_change_read_new_partitions_only(spark, tmp_path, monkeypatch):
    checks = [Check("k", UNIQUE), Check("k", NOT_NULL), Check("v", NOT_NULL), Check("v", ACCEPTED, ("a", "b"))]
    rows = lambda *values: spark.createDataFrame(values, "k string, day string, v string")
    for partitioning in (Partitioning("month", "substring(day, 1, 7)"), None):
        name = "by month" if partitioning else "whole"
        table = Table(spark, str(tmp_path / name), partitioning)
        report = lambda: check_relations(
            {"t": table.read()}, {"t": checks}, {"t": keep_evidence(table, checks, str(tmp_path / f"{name} evidence"))})
        full = lambda: check_relations({"t": table.read()}, {"t": checks})
        same = lambda: sorted(map(str, report().collect())) == sorted(map(str, full().collect()))
        table.overwrite(rows(("x", "2024-01-01", "a"), ("x", "2024-02-01", "c"), (None, None, "a"), ("z", "2024-02-03", None)))
        assert same()
        read, asked = Table.read, []
        monkeypatch.setattr(Table, "read", lambda self, p=None, **k: (asked.append((self.path, p, k)), read(self, p, **k))[1])
        if partitioning:
            table.replace(["2024-02"], rows(("y", "2024-02-01", "d"), ("y", "2024-02-02", "c")))
        else:
            table.overwrite(rows(("y", "2024-02-01", "d"), ("y", "2024-02-02", "c")))
        report()
        assert [p for path, p, k in asked if path == table.path and k] == ([["2024-02"]] if partitioning else [[""]])
        asked.clear()
        report()
        assert not [p for path, p, k in asked if path == table.path and k]          # nothing new, nothing read
        monkeypatch.undo()
        assert same()
        if partitioning:
            table.replace(["2024-02"], rows())
            assert same()
        assert sorted(map(str, check_relations({"t": table.read()}, {"t": checks[:1]}, {
            "t": keep_evidence(table, checks[:1], str(tmp_path / f"{name} evidence"))}).collect())) == sorted(
            map(str, check_relations({"t": table.read()}, {"t": checks[:1]}).collect()))
