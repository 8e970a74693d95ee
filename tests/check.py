"""Compare registered queries with their DuckDB statements.

    python tests/check.py [--sf DIR] [name or prefix …]
"""

from __future__ import annotations

import math
import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if pathlib.Path(f"{sf}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(value):
    if value is None:
        return "null"
    if isinstance(value, float):
        return "null" if math.isnan(value) else repr(value)
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(str([plain(row[i]) for i in order]) for row in rows)


KINDS = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "float": "FLOAT"}


def compare(spark_df, con, sql) -> str | None:
    """None when equal, else what differs."""
    got_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    want_rows = rel.fetchall()
    if sorted(spark_df.columns) != sorted(rel.columns):
        return f"columns {spark_df.columns} vs {rel.columns}"
    want_types = dict(zip(rel.columns, map(str, rel.types)))
    odd = {c: (t, want_types[c]) for c, t in spark_df.dtypes if KINDS.get(t, t.upper()) != want_types[c]}
    if odd:
        return f"types {odd}"
    got, want = rows_of(spark_df.columns, got_rows), rows_of(rel.columns, want_rows)
    if got == want:
        return None
    only = [a for a in got if a not in set(want)][:2], [b for b in want if b not in set(got)][:2]
    return f"rows {len(got)} vs {len(want)}; spark only {str(only[0])[:700]} | sql only {str(only[1])[:700]}"


def main(argv):
    from gazetick.queries import QUERIES, SQL
    from gazetick.session import build_session

    sf = "/root/testdata/sf0.01"
    if "--sf" in argv:
        at = argv.index("--sf")
        sf = argv[at + 1]
        del argv[at : at + 2]
    spark = build_session(cores="8")
    con = duck(sf)
    bad = 0
    for name, run in QUERIES.items():
        if argv and not any(name.startswith(a) for a in argv):
            continue
        started = time.time()
        try:
            df = run(spark, sf)
            if name in SQL:
                problem = compare(df, con, SQL[name])
                state = "ok" if problem is None else problem
            else:
                state = f"rows only: {len(df.collect())}"
        except Exception as error:
            state = f"{type(error).__name__}: {str(error)[:600]}"
        bad += not state.startswith(("ok", "rows only"))
        print(f"{name:28s} {time.time() - started:6.1f}s {state}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
