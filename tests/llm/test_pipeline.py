"""The pipeline's stages on a small table, and the registered queries on the smallest one."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.compare import difference, duck
from tests.llm import brute
from tidemark.llm import queries
from tidemark.session import materialize

SF = "/root/testdata/sf0.001"
DEALT = {1: "op1_", 2: "op2_", 3: "op3_", 4: "op4_", 5: "op5_", 6: "op6_", 7: "op7_", 8: "op8_", 9: "op9_", 10: "op10_",
         11: "op11_", 12: "op12_", 13: "op13_"}
PER_ROW = [name for name in queries.queries() if not name.startswith(("op11_", "op12_"))]    # those two have tests of their own


def test_queries_are_registered():
    names = list(entry.queries())
    for prefix in DEALT.values():
        assert sum(name.startswith(prefix) for name in names) == 1
    assert "pipeline" in names


@pytest.mark.parametrize("name", PER_ROW)
def test_query_returns_a_row_per_row(spark, name):
    table = "conversations" if name.startswith("op6_") else "documents"
    assert queries.queries()[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert difference(queries.queries()[name](spark, SF), duck(SF), queries.oracle_sql()[name]) is None


def test_stages(spark, tmp_path):
    """Each stage is judged on what the one before it kept."""
    folder = str(tmp_path)
    plain = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10_001, None, None, None, None), (10_002, "", "en", "s", 0), (10_003, "12 ...", None, "s", 6),
                                 (10_001, None, None, None, None)], plain.schema)
    plain.union(odd).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, folder), "stage")
        now = {r.doc_id: r for r in out.collect()}
        if name == "language":
            assert set(rows) - set(now) == {10_001, 10_002, 10_003}
        elif name == "line dedup":
            gone = set(rows) - set(now)
            seen = {line for d, r in rows.items() for line in r.text.split("\n") if d not in gone}
            assert all(line in seen for d in gone for line in rows[d].text.split("\n") if brute.words(line))
            assert all(r.n_chars == len(r.text) for r in now.values() if r.text != rows[r.doc_id].text)
        elif name == "near duplicates":
            classes = {d: c for d, c, _, _ in brute.similar([(d, r.text) for d, r in rows.items()])}
            assert set(now) == {d for d, c in classes.items() if d == c}
        elif name == "decontamination":
            hits = {d: n for d, _, n, _ in brute.contamination([(d, r.text) for d, r in rows.items()], items)}
            assert set(now) == {d for d, n in hits.items() if n == 0} and len(now) < len(rows)
        else:
            assert set(now) == set(rows) and all(now[d].decoded_sha256 == brute.sha(rows[d].text) for d in rows)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        docs, rows = out, now
    last = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, docs.collect()))


def test_one_row_of_a_class_stays_whatever_its_id(spark, tmp_path):
    text = lambda n: " ".join(f"w{n}x{i}" for i in range(60))
    near = text(1) + " more"
    rows = [(5, text(1)), (5, text(1)), (9, near), (None, text(1)), (None, text(2)), (None, text(2)), (7, text(3)), (7, text(4)),
            (3, text(4)), (8, text(5)), (None, ""), (None, None), (None, None)]
    docs = spark.createDataFrame([(d, t, "en", f"s{i}", 1) for i, (d, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text), r.source) for r in out.collect()) == sorted([
        ("5", text(1), "s0"), ("None", text(2), "s4"), ("7", text(3), "s6"), ("3", text(4), "s8"), ("8", text(5), "s9"),
        ("None", "", "s10"), ("None", "None", "s11")])


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path)
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").limit(0).write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
