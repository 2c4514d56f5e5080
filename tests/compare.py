"""Run registered queries next to their SQL and compare all rows.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(r[i] for i in order) for r in rows)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "timestamp_ntz": "TIMESTAMP", "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def compare(df, con, sql: str) -> str | None:
    """None when both give the same rows and types, else what differs."""
    res = con.execute(sql)
    types = {d[0]: str(d[1]) for d in res.description}
    names, want = rows_of([d[0] for d in res.description], res.fetchall())
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if names != got_names:
        return f"columns {got_names} != {names}"
    if got != want:
        extra, missing = got - want, want - got
        return (f"rows {sum(got.values())} vs {sum(want.values())}; only spark {list(extra.items())[:3]}; "
                f"only sql {list(missing.items())[:3]}")
    bad = {c: (t, types[c]) for c, t in df.dtypes if KINDS.get(t, t) != types[c]}
    return f"types {bad}" if bad else None


def main(sf_dir: str, only: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from tillwright.session import build_session

    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sql:
                why = compare(df, con, sql[name])
                n = df.count() if why is None else -1
            else:
                why, n = None, df.count()
        except Exception as e:  # noqa: BLE001 - report and go on
            why, n = f"{type(e).__name__}: {str(e)[:1500]}", -1
        bad += why is not None
        print(f"{'ok  ' if why is None else 'FAIL'} {name} rows={n} {time.time() - t0:.1f}s"
              f"{'' if name in sql else ' (no sql)'}{'' if why is None else chr(10) + '     ' + why}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    sys.exit(1 if main(folder, args) else 0)
