"""Compare registered queries with their SQL twins: names, types, and the exact bag of rows.

``python -m tests.oracle [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

SPARK_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def database(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    return value


def compare(spark, con, fn, sql: str, sf_dir: str) -> tuple[str | None, int]:
    """``(problem or None, rows)``."""
    df = fn(spark, sf_dir)
    names = sorted(df.columns)
    df = df.select(*names)
    result = con.execute(sql)
    described = {d[0]: str(d[1]) for d in result.description}
    if sorted(described) != names:
        return f"columns {names} vs {sorted(described)}", 0
    types = {f.name: SPARK_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    wrong = {n: (types[n], described[n]) for n in names if types[n] != described[n].upper()}
    rows = [tuple(_plain(v) for v in r) for r in df.collect()]
    order = [d[0] for d in result.description]
    theirs = [tuple(_plain(v) for v in (dict(zip(order, r))[n] for n in names)) for r in result.fetchall()]
    if len(rows) != len(theirs):
        return f"rows {len(rows)} vs {len(theirs)}", len(rows)
    ordering = lambda r: tuple((v is None, str(v)) for v in r)
    for mine, other in zip(sorted(rows, key=ordering), sorted(theirs, key=ordering)):
        if mine != other:
            return f"values {mine} vs {other}", len(rows)
    return (f"types {wrong}" if wrong else None), len(rows)


def main() -> None:
    import __spark_entry__ as entry
    from weirflow.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = local_session(8), database(sf_dir)
    bad = 0
    for name in names:
        fn, sql = entry.queries()[name], entry.oracle_sql().get(name)
        start = time.time()
        try:
            if sql is None:
                problem, rows = None, fn(spark, sf_dir).count()
            else:
                problem, rows = compare(spark, con, fn, sql, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem, rows = f"{type(error).__name__}: {str(error)[:400]}", 0
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} rows={rows} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{bad} of {len(names)} differ")


if __name__ == "__main__":
    main()
