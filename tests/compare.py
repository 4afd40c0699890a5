"""Runs named queries in Spark and their SQL in DuckDB, and compares the result rows.

    python tests/compare.py [sf dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def canonical(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
               "timestamp_ntz": "TIMESTAMP"}


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    """None if schema and rows agree, else what differs."""
    df = query(spark, sf_dir)
    got = df.collect()
    cur = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    mine = {n: SPARK_TYPES.get(t, t) for n, t in df.dtypes}
    if sorted(mine) != sorted(kinds):
        return f"columns differ: {sorted(set(mine) ^ set(kinds))}"
    wrong = {n: (mine[n], kinds[n]) for n in mine if mine[n] != kinds[n]}
    if wrong:
        return f"types differ: {wrong}"
    a, b = canonical(df.columns, got), canonical([d[0] for d in con.execute(sql).description], want)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
        return f"rows differ: {len(a)} vs {len(b)}; columns {sorted(df.columns)}; spark {only_a}; sql {only_b}"
    return None


def session():
    from accolade.session import local_session

    return local_session(app="accolade-compare", folder=tempfile.mkdtemp(prefix="accolade-tests-"))


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    todo, sqls = entry.queries(), entry.oracle_sql()
    names = argv[1:] or list(todo)
    print("without SQL:", sorted(set(todo) - set(sqls)), "without query:", sorted(set(sqls) - set(todo)))
    spark, con, failed = session(), duck(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, todo[name], sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001 - report and go on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
