"""Run registered queries in Spark and in DuckDB and compare every value.

    python -m tests.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def difference(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when names, types and all values agree."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    columns = sorted(names)
    expected = Counter(tuple(repr(row[names.index(c)]) for c in columns) for row in result.fetchall())
    actual = Counter(tuple(repr(row[c]) for c in columns) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    if expected == actual:
        return None
    missing, extra = expected - actual, actual - expected
    sample = [dict(zip(columns, rows)) for rows in (next(iter(missing), ()), next(iter(extra), ()))]
    odd = {c: (sample[0].get(c), sample[1].get(c)) for c in columns if sample[0].get(c) != sample[1].get(c)}
    return f"{sum(missing.values())} rows missing, {sum(extra.values())} extra; e.g. {odd}"


def main() -> None:
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, connection = make_session(), duck(sf_dir)
    statements, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if name not in statements or (sys.argv[2:] and name not in sys.argv[2:]):
            continue
        start = time.time()
        problem = difference(query(spark, sf_dir), connection, statements[name])
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
