from __future__ import annotations

import pytest

from tidemark.llm.queries import on_workers


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    on_workers(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from (id, text) pairs, with columns whose names clash with those that operators add."""
    def make(rows, **more):
        names = "doc_id long, text string" + "".join(f", {name} {kind}" for name, (kind, _) in more.items())
        return spark.createDataFrame([(*row, *(value for _, value in more.values())) for row in rows], names)
    return make
