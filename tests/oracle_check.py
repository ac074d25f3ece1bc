"""Compare queries with their SQL counterparts: python tests/oracle_check.py [sf_dir] [query ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

import __spark_entry__ as spark_entry
from carelake.session import local_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _sort_key(row: tuple) -> tuple:
    return tuple((v is None, str(v)) for v in row)


def _plain(value: object) -> object:
    return None if isinstance(value, float) and math.isnan(value) else value


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None where both results are equal, else what differs."""
    frame = spark_entry.queries()[name](spark, sf_dir)
    columns = sorted(frame.columns)
    ours = [tuple(_plain(v) for v in r) for r in frame.select(*columns).collect()]
    cursor = con.execute(spark_entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = [tuple(_plain(r[i]) for i in order) for r in cursor.fetchall()]
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(sorted(ours, key=_sort_key), sorted(theirs, key=_sort_key)):
        if a != b or [type(v) for v in a] != [type(v) for v in b]:
            return f"{dict(zip(columns, a))} against {dict(zip(columns, b))}"
    return None


def main(sf_dir: str = "/root/testdata/sf0.01", *only: str) -> int:
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in only or spark_entry.oracle_sql():
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as error:  # report all queries, not the first failure
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
