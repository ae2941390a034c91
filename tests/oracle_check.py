"""Compare queries with their SQL counterparts: python tests/oracle_check.py [folder] [name ...]"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _key(row):
    return tuple((value is None, str(value)) for value in row)


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.date()
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=_key)


def differences(df, con, sql: str) -> list[str]:
    """What differs between a DataFrame and a statement; empty when they agree."""
    result = con.execute(sql)
    theirs = _sorted_rows([d[0] for d in result.description], result.fetchall())
    ours = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if ours[0] != theirs[0]:
        return [f"columns {ours[0]} != {theirs[0]}"]
    if len(ours[1]) != len(theirs[1]):
        return [f"rows {len(ours[1])} != {len(theirs[1])}"]
    found = []
    for mine, other in zip(ours[1], theirs[1]):
        if mine != other or [type(v) for v in mine] != [type(v) for v in other]:
            cells = [(c, a, b) for c, a, b in zip(ours[0], mine, other) if a != b or type(a) is not type(b)]
            found.append(str(cells))
    return found


def main(sf_dir: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from patronlens.workspace import build_session

    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name, sql in oracle_sql().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            wrong = differences(queries()[name](spark, sf_dir), con, sql)
        except Exception as error:  # keep checking the other queries
            wrong = [repr(error)[:1500]]
        failed += bool(wrong)
        print(f"{'FAIL' if wrong else 'ok  '} {name} {time.time() - start:.2f}s", flush=True)
        for line in wrong[:3]:
            print("     ", line[:1500])
        if len(wrong) > 3:
            print(f"      ... {len(wrong)} rows differ")
    unknown = set(oracle_sql()) - set(queries())
    print("without query:", sorted(unknown), "| without SQL:", sorted(set(queries()) - set(oracle_sql())))
    return failed


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    sys.exit(1 if main(folder, sys.argv[2:]) else 0)
