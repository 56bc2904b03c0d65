"""Runs named queries and their SQL side by side and compares all rows."""

from __future__ import annotations

import datetime
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return ("float", repr(value))
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return ("time", str(value))
    return (type(value).__name__, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, query, folder):
    """None when equal, else a description of the first difference."""
    df = query.run(spark, folder)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if query.sql is None:
        return None, len(mine[1])
    result = con.execute(query.sql)
    other = rows_of([d[0] for d in result.description], result.fetchall())
    if mine[0] != other[0]:
        return f"columns {mine[0]} != {other[0]}", len(mine[1])
    if mine[1] != other[1]:
        a, b = set(mine[1]), set(other[1])
        return f"rows {len(mine[1])} vs {len(other[1])}; only Spark {list(a - b)[:3]}; only SQL {list(b - a)[:3]}", len(mine[1])
    return None, len(mine[1])


if __name__ == "__main__":
    from auditlark.catalog import load_all
    from auditlark.session import get_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = get_session(master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name, query in load_all().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem, n = compare(spark, con, query, folder)
        except Exception as error:  # noqa: BLE001
            problem, n = f"{type(error).__name__}: {str(error)[:700]}", -1
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} rows={n} {time.time() - start:.1f}s {problem or ''}", flush=True)
