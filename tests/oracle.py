"""Run registered jobs against their SQL in DuckDB and compare whole results.

``python -m tests.oracle [sf_dir] [name ...]`` prints one line per job.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def kinds(rows, columns):
    out = {}
    for i, c in enumerate(columns):
        out[c] = sorted({type(r[i]).__name__ for r in rows if r[i] is not None})
    return out


def compare(spark, con, job, sql, sf_dir):
    """None when equal, else a short description of the difference."""
    df = job(spark, sf_dir)
    columns = sorted(df.columns)
    got = [tuple(plain(v) for v in r) for r in df.select(*[df[f"`{c}`"] for c in columns]).collect()]
    if sql is None:
        return None if got else "no rows", len(got)
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    if sorted(names) != columns:
        return f"columns {columns} vs {sorted(names)}", len(got)
    index = [names.index(c) for c in columns]
    want = [tuple(plain(r[i]) for i in index) for r in rel.fetchall()]
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}", len(got)
    key = lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r)
    a, b = sorted(got, key=key), sorted(want, key=key)
    for x, y in zip(a, b):
        if x != y:
            bad = sum(p != q for p, q in zip(a, b))
            return f"{bad} rows differ, first {x} vs {y} ({columns})", len(got)
    if kinds(got, columns) != kinds(want, columns):
        return f"types {kinds(got, columns)} vs {kinds(want, columns)}", len(got)
    return None, len(got)


def main(argv):
    import __spark_entry__ as e
    from riskloom.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    jobs, sqls = e.queries(), e.oracle_sql()
    names = argv[1:] or list(jobs)
    spark = build_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failures = []
    for n in names:
        t = time.time()
        try:
            problem, rows = compare(spark, con, jobs[n], sqls.get(n), sf_dir)
        except Exception as exc:  # report and go on
            problem, rows = f"{type(exc).__name__}: {str(exc)[:600]}", -1
        kind = "sql " if n in sqls else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {n:32s} {rows:8d} rows {time.time() - t:6.2f}s {problem or ''}", flush=True)
        if problem:
            failures.append(n)
    print(f"{len(names) - len(failures)}/{len(names)} agree; failed: {failures}")
    spark.stop()
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
