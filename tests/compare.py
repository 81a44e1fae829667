"""Runs registered queries against their SQL in DuckDB and compares whole results."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(value):
    if value is None or isinstance(value, str):
        return value
    number = float(value)
    return None if math.isnan(number) else round(number, 6) + 0.0


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(canonical(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def difference(df, con, sql):
    """``None`` when equal, else a short description of the first difference."""
    table = df.toArrow()
    got = rows_of(table.column_names, [tuple(r.values()) for r in table.to_pylist()])
    answer = con.execute(sql)
    want = rows_of([d[0] for d in answer.description], answer.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"first difference: {str(a)[:300]} != {str(b)[:300]}"
    return None


def main() -> None:
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from versemill.session import build_session

    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("OFF")
    con, oracles, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name in names:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            verdict = difference(df, con, oracles[name]) if name in oracles else f"no SQL, {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        ok = verdict is None or verdict.startswith("no SQL")
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - start:.1f}s {verdict or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
