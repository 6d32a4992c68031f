"""Run a registered query and its SQL side by side and compare rows without regard to order."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return _sorted(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    return _sorted([d[0] for d in result.description], result.fetchall())


def difference(got, wanted) -> str | None:
    """None when equal, else what differs first."""
    if got[0] != wanted[0]:
        return f"columns {got[0]} != {wanted[0]}"
    if len(got[1]) != len(wanted[1]):
        return f"{len(got[1])} rows != {len(wanted[1])}; {got[1][:2]} … {wanted[1][:2]}"
    for a, b in zip(got[1], wanted[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{str(a)[:600]} != {str(b)[:600]}"
    return None


def main(argv: list[str]) -> int:
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from codesieve.session import local_session

    sf_dir = argv[0]
    spark = local_session(8)
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not argv[1:] or any(n.startswith(p) for p in argv[1:])]
    bad = 0
    for name in names:
        start = time.time()
        try:
            got = spark_rows(queries[name](spark, sf_dir))
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: {str(error)[:1500]}", flush=True)
            continue
        took = time.time() - start
        verdict = "rows-only"
        sql_took = 0.0
        if name in oracles:
            start = time.time()
            try:
                problem = difference(got, sql_rows(con, oracles[name]))
            except Exception as error:  # noqa: BLE001
                problem = f"SQL: {str(error)[:800]}"
            sql_took = time.time() - start
            verdict = "ok" if problem is None else f"DIFF {problem}"
            bad += problem is not None
        print(f"{name}: {verdict} rows={len(got[1])} spark={took:.2f}s sql={sql_took:.2f}s", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
