"""Run registered queries and their SQL side by side and compare the values.

    python tools/compare.py [folder] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripweave.plans import oracles, registry  # noqa: E402
from tripweave.session import build_session  # noqa: E402


def normal(value: object) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows_of(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


def compare(spark, folder: str, names: list[str]) -> list[str]:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    queries, sql = registry.queries(), oracles.oracle_sql()
    wrong = []
    for name in names or sorted(queries):
        try:
            start = time.time()
            df = queries[name](spark, folder)
            mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
            took = time.time() - start
            start = time.time()
            result = con.execute(sql[name])
            columns = [d[0] for d in result.description]
            theirs = rows_of(columns, result.fetchall())
            same = sorted(columns) == sorted(df.columns) and mine == theirs
            print(
                f"{'ok   ' if same else 'WRONG'} {name} rows={len(mine)} {took:.2f}s oracle {time.time() - start:.2f}s",
                flush=True,
            )
            if not same:
                print("  columns", sorted(df.columns), sorted(columns), len(theirs))
                print("  only here ", sorted(set(mine) - set(theirs))[:3])
                print("  only there", sorted(set(theirs) - set(mine))[:3])
        except Exception as error:  # report every query, then go on
            same = False
            print(f"FAIL  {name}: {type(error).__name__} {str(error)[:800]}", flush=True)
        if not same:
            wrong.append(name)
    return wrong


if __name__ == "__main__":
    target = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    bad = compare(session, target, sys.argv[2:])
    print("wrong:", bad)
    sys.exit(1 if bad else 0)
