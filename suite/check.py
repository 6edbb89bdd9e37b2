"""Compare registered queries with their SQL: ``python -m suite.check SF_DIR [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET max_temp_directory_size = '8GB'")  # SQL that lists all phrases spills far more on large tables
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, name)}.parquet')")
    return con


def plain(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def normal(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr(tuple(plain(r[i]) for i in order)) for r in rows)


def compare(spark, con, sf_dir: str, query, sql: str) -> tuple[str, int]:
    df = query(spark, sf_dir)
    left = normal(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    right = normal(columns, found.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}", len(left[1])
    if left[1] != right[1]:
        only_left, only_right = set(left[1]) - set(right[1]), set(right[1]) - set(left[1])
        return (f"rows {len(left[1])} / {len(right[1])}; only Spark {len(only_left)}: {[x[:300] for x in sorted(only_left)[:3]]}; "
                f"only SQL {len(only_right)}: {[x[:300] for x in sorted(only_right)[:3]]}"), len(left[1])
    return "", len(left[1])


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from recado.session import local_session
    from suite.oracles import ORACLES
    from suite.queries import QUERIES

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con = local_session(8), connect(sf_dir)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            if name in ORACLES:
                problem, n = compare(spark, con, sf_dir, QUERIES[name], ORACLES[name])
            else:
                problem, n = "", len(QUERIES[name](spark, sf_dir).collect())
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            problem, n = f"{type(e).__name__}: {str(e)[:700]}", -1
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok':5}{name:28}{n:8} rows {time.time() - start:6.1f}s {'' if name in ORACLES else '(no SQL)'} {problem}", flush=True)
    print("no result" if bad else "all equal", bad, set(ORACLES) - set(QUERIES))


if __name__ == "__main__":
    main()
